"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Both models are bigram models over letters, digits and one class for all else, trained from labelled samples by
DataFrame counts. A candidate token's log-likelihood ratio per step decides; it is computed by Spark's own
expressions from a table of 64 x 64 numbers. No Python runs on the executors.
"""

from __future__ import annotations

import random
from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmill.llm._native import PLACES, folded, let, markable, matches, replaced

# The kinds, in their order, and their patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: What the models judge: a run of these characters with a letter in it.
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
WIDTH = len(ALPHABET) + 1
#: Log-likelihood ratio per step from which on a token counts as random.
RATIO = 0.6
#: Distinct characters of a token without digits, so that a letter or syllable said over and over is none: of 16 random
#: letters of one case fewer are distinct with a chance of less than 1 in 4 million.
DISTINCT = 6

_WORDS = (
    "user name file path index count value total order item price date time start end page url link image text title type state status config option default cache buffer "
    "stream reader writer parser token list array map key node tree graph table column row field schema query filter sort group join merge split batch queue worker thread task "
    "service client server request response header body session cookie login account profile address street city country region customer product invoice payment report summary "
    "version release build test debug error message event handler listener callback context manager factory builder provider controller model view layout style color width height "
    "margin padding border font size family weight north south east west january february march april monday tuesday first second third last next previous general license public"
)


def samples(n: int = 3000, seed: int = 11) -> list[tuple[str, int]]:
    """Labelled samples (text, 1 if random): keys of usual alphabets and lengths, and identifiers put together from words."""
    rng, words, out = random.Random(seed), _WORDS.split(), []
    alphabets = [ALPHABET, ALPHABET + "+/", ALPHABET + "-_", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", ALPHABET[:26] + ALPHABET[52:]]
    for k in range(n):
        out.append(("".join(rng.choices(alphabets[k % len(alphabets)], k=rng.randint(16, 48))), 1))
        parts = rng.choices(words, k=rng.randint(2, 6))
        style = k % 6
        if style == 0:
            text = "_".join(parts)
        elif style == 1:
            text = "-".join(parts)
        elif style == 2:
            text = "/".join(parts)
        elif style == 3:
            text = parts[0] + "".join(p.title() for p in parts[1:])
        elif style == 4:
            text = "_".join(parts).upper()
        else:
            text = "".join(parts)
        if k % 3 == 0:
            text += rng.choice(["_", "-", ""]) + rng.choice(["1", "2", "v2", "10", "2024", "2024-01-15", "20240115", "001", "x64", "utf8", "sha256", "100"])
        out.append((text, 0))
    return out


def train(spark: SparkSession, labelled: DataFrame | None = None) -> list[float]:
    """The table of log-likelihood ratios by pair of characters, from labelled samples (text string, random int).

    Pairs are counted by a DataFrame; at most 2 x 64 x 64 counts reach the driver. Each is smoothed by half a pair.
    """
    if labelled is None:
        labelled = spark.createDataFrame(samples(), "text string, random int")
    codes = _codes(F.col("text"))
    pairs = let(codes, lambda c: F.transform(F.sequence(F.lit(0), F.size(c) - 2), lambda i: c[i] * WIDTH + c[i + 1]))
    counted = labelled.filter("random is not null and length(text) > 1").select("random", F.explode(pairs).alias("pair")).groupBy("random", "pair").count().collect()
    counts = {(r.random, r.pair): r["count"] for r in counted}
    table = []
    for a in range(WIDTH):
        totals = [sum(counts.get((kind, a * WIDTH + b), 0) + 0.5 for b in range(WIDTH)) for kind in (0, 1)]
        for b in range(WIDTH):
            plain, rand = (counts.get((kind, a * WIDTH + b), 0) + 0.5 for kind in (0, 1))
            table.append(log(rand / totals[1]) - log(plain / totals[0]))
    return table


def _codes(token: Column) -> Column:
    """The place of each character in the alphabet; 0 for all others."""
    return F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))


def ratio(token: Column, table: list[float]) -> Column:
    """Mean log-likelihood ratio per step of a token of two characters or more."""
    known = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    steps = lambda c: F.aggregate(F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0), lambda acc, i: acc + F.get(known, c[i - 1] * WIDTH + c[i])) / (F.size(c) - 1)
    return let(_codes(token), steps)


def _places(text: Column, table: list[float], least_ratio: float) -> dict[str, Column]:
    long = lambda kind: (lambda m: F.length(m) >= LEAST[kind])
    # A run of 24 signs or of AKIA and 16 is found as by the plain pattern, since either takes all that follows.
    varied = lambda m: F.rlike(m, F.lit("[0-9]")) | (F.size(F.array_distinct(F.split(m, ""))) >= DISTINCT)
    random_one = lambda m: F.rlike(m, F.lit("[A-Za-z]")) & varied(m) & (ratio(m, table) >= least_ratio)
    return {
        "assign": matches(text, ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= LEAST["assign"]),
        "access": matches(text, rf"{ACCESS[:-1]}{{{LEAST['access'] - 4},}}", long("access")),
        "hex": matches(text, rf"(?<![0-9a-f]){HEX[:-1]}{{{LEAST['hex']},}}", long("hex")),
        "markov": matches(text, TOKEN, random_one),
    }


def _free(places: Column, taken: list[Column]) -> Column:
    """Places that overlap none of those taken; those of one array do not overlap each other.

    All are met in order of their start. A place waits for what comes next, which may begin inside it.
    """
    own = F.transform(places, lambda p: F.struct(p["start"].alias("start"), F.lit(1).alias("free"), p["end"].alias("end")))
    every = F.array_sort(F.concat(own, *(F.transform(t, lambda p: F.struct(p["start"].alias("start"), F.lit(0).alias("free"), p["end"].alias("end"))) for t in taken)))
    state = F.struct(F.lit(0).cast("bigint").alias("end"), F.array().cast(PLACES).alias("waits"))

    def step(acc: Column, p: Column) -> tuple[Column, Column]:
        none = F.array().cast(PLACES)
        stays = F.filter(acc["waits"], lambda w: w["end"] <= p["start"])
        own = (p["free"] == 1) & (p["start"] >= acc["end"])
        waits = F.when(own, F.array(F.struct(p["start"].alias("start"), p["end"].alias("end")))).otherwise(none)
        return F.struct(F.when(p["free"] == 0, F.greatest(acc["end"], p["end"])).otherwise(acc["end"]).alias("end"), waits.alias("waits")), stays

    return F.when(F.size(places) > 0, folded(every, state, PLACES, step, lambda acc: acc["waits"])).otherwise(F.array().cast(PLACES))


def _listed(kinds: list[str], places: dict[str, Column]) -> Column:
    """kind:start:end of all places, by start, then kind in its order, then end."""

    def ranked(n: int):
        return lambda p: F.struct(p["start"].alias("start"), F.lit(n).alias("kind"), p["end"].alias("end"))

    every = F.concat(*(F.transform(places[k], ranked(n)) for n, k in enumerate(kinds)))
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(F.array_sort(every), lambda p: F.concat_ws(":", F.get(names, p["kind"]), p["start"], p["end"])), ",")


def _found(docs: DataFrame, table: list[float] | None, least_ratio: float) -> DataFrame:
    table = table or train(docs.sparkSession)
    text = markable(F.col("text"))
    found = docs.select(*(F.col(c) for c in docs.columns), F.struct(*(c.alias(k) for k, c in _places(text, table, least_ratio).items())).alias("__places"))
    base = [F.col("__places")[k] for k in KINDS[:3]]
    return found.withColumn("__places", F.col("__places").withField("markov", _free(F.col("__places")["markov"], base)))


def scan(docs: DataFrame, table: list[float] | None = None, least_ratio: float = RATIO) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Places are code points, end exclusive. spans lists the fixed kinds and, as markov, tokens that the models call
    random where no fixed kind is. Null and empty texts have none. Repeated rows each get a row; other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    found = _found(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), table, least_ratio)
    places = {k: F.col("__places")[k] for k in KINDS}
    return found.select(
        "doc_id", *(F.size(places[k]).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(_listed(list(KINDS[:3]), places), 256).alias("base_sha256"), _listed(list(KINDS), places).alias("spans"),
    )


def redact(docs: DataFrame, table: list[float] | None = None, least_ratio: float = RATIO, mark: str = "[SECRET]") -> DataFrame:
    """docs with each secret replaced by a mark, overlapping ones by one; columns stay as they are, n_chars is counted anew.

    Texts without secrets, null texts among them, stay as they are. Repeated rows each stay, rows without id too; other
    columns are kept, whatever their names; an empty table stays empty.
    """
    found = _found(docs, table, least_ratio)
    every = F.array_sort(F.concat(*(F.col("__places")[k] for k in KINDS)))
    text = F.col("text")
    built = replaced(text, every, mark)
    some = sum((F.size(F.col("__places")[k]) for k in KINDS), F.lit(0)) > 0
    columns = [F.when(some, built).otherwise(text).alias("text") if c == "text" else F.col(c) for c in docs.columns]
    out = found.withColumn("__some", some).select(*columns, "__some")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__some"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.drop("__some")
