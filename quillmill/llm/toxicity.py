"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length, with exception phrases.

Folding lower-cases, maps homoglyphs of other scripts to Latin letters and digits inside words to the letters they
stand for; signs become spaces. The lexicon is a small built-in list plus words and word beginnings learned from a
bounded sample of labelled rows: the words of each class are counted with DataFrames, near copies once, and the few
terms that pass are weighted by the logarithm of their rate in toxic over their rate in clean words. A text's
weights, in all and per word, enter a logistic curve fitted on the same sample.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmill.llm._labels import held_out, sample
from quillmill.llm._store import written
from quillmill.llm._text import in_batches, slices

MOST_LABELLED = 16_384
THRESHOLD = 0.5
#: A learned term: letters of a word beginning, least texts and least share of the toxic texts with it, least weight.
SHORTEST, LONGEST = 4, 10
LEAST_TEXTS, LEAST_SHARE, LEAST_WEIGHT = 4, 0.01, 2.5
#: A term gives way to a longer one with nearly all its texts, or with most of them and a clearly greater weight.
NEARLY_ALL, MOST, GREATER = 0.95, 0.6, 0.7
#: The most that one word counts in one text.
MOST_TIMES = 8
SEED_WEIGHT = 4.0

# Plain insults in the four languages, each a whole word.
SEEDS = (
    "idiot idiots idiotic moron morons moronic imbecile imbeciles stupid dumb dumbass loser losers scum scumbag trash worthless pathetic disgusting "
    "clown clowns fool fools jerk jerks asshole assholes bastard bastards bitch bitches bullshit cretin cretins degenerate dimwit freak halfwit "
    "lowlife maggot parasite retard retarded scoundrel shit shithead slut sucker vermin whore wanker twat fuck fucker fucking fuckers "
    "idiote idiotes imbecile connard connards connasse salaud salope merde débile debile abruti abrutie ordure raclure minable "
    "arschloch arschlöcher dummkopf trottel depp scheisse wichser schlampe abschaum hurensohn blödmann miststück "
    "idiota idiotas estúpido estúpida imbécil imbéciles estupido estupida imbecil imbeciles gilipollas cabrón cabron cabrones mierda puta puto pendejo escoria basura tonto"
)

# Phrases in which a word of the list is meant otherwise.
EXCEPTIONS = (
    "trash can", "trash cans", "trash bin", "trash bins", "trash bag", "trash bags", "take out the trash", "trash collection", "clown fish", "circus clown", "circus clowns", "class clown",
    "idiot proof", "fool proof", "april fool", "april fools", "fools gold", "dumb waiter", "dumb terminal", "dumb bell", "jerk chicken", "jerk seasoning", "parasite host", "host parasite", "sore loser",
    "winner and loser", "winners and losers", "freak accident", "freak wave", "degenerate case", "degenerate matter", "pond scum", "cesta de basura", "cubo de basura", "bolsa de basura",
)

# Look-alikes of Latin letters from other scripts, and the letters that digits and signs stand for.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x", "г": "r",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "đ": "d",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "2": "z", "6": "g"}
SIGNS = {"$": "s", "@": "a", "!": "i"}


class _Fold(dict):
    """Folds of single characters, found as they are met."""

    def __missing__(self, code: int) -> str | int:
        ch = chr(code)
        if ch in HOMOGLYPHS:
            out: str | int = HOMOGLYPHS[ch]
        elif unicodedata.combining(ch) or unicodedata.category(ch) == "Cf":
            out = ""
        else:
            plain = "".join(HOMOGLYPHS.get(c, c) for c in unicodedata.normalize("NFKC", ch).lower())
            out = plain if plain.isalnum() else " "
        self[code] = out
        return out


_FOLD = _Fold({ord(k): v for k, v in DIGITS.items()} | {c: chr(c) for c in range(97, 123)} | {39: "", 0x2019: ""})
#: Numbers, which are no words; then signs that stand for letters, which stand before one.
_NUMBER = re.compile(r"(?<![^\W_])[0-9]+(?![^\W_])")
_SIGN = re.compile(r"[$@!](?=[^\W\d_])")


def folded(text: str | None) -> str:
    """The text's words in plain letters, separated and enclosed by single spaces."""
    low = unicodedata.normalize("NFC", text or "").lower()
    low = _NUMBER.sub(" ", low)
    if "$" in low or "@" in low or "!" in low:
        low = _SIGN.sub(lambda m: SIGNS[m[0]], low)
    return f" {' '.join(low.translate(_FOLD).split())} "


class Lexicon:
    """Terms with weights: ' word ' is a whole word, ' begin' a word's beginning; exceptions outdo what they contain."""

    def __init__(self, terms: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS) -> None:
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for term, weight in terms.items():
            self.machine.add_word(term, (len(term), weight))
        for phrase in exceptions:
            self.machine.add_word(folded(phrase), (len(folded(phrase)), 0.0))
        if len(self.machine):
            self.machine.make_automaton()

    def weigh(self, text: str) -> tuple[float, int]:
        """The weight of the text's matches and its number of words; a place counts once, by its heaviest term."""
        words = text.count(" ") - 1 if len(text) > 2 else 0
        if not len(self.machine):
            return 0.0, words
        spans, free = {}, []
        for end, (size, weight) in self.machine.iter(text):
            start = end - size + 1
            if weight:
                spans[start] = max(weight, spans.get(start, 0.0))
            else:
                free.append((start, end))
        if free:
            # Matches come in order of their ends; one that begins in an exception's place is none, so places are joined first.
            free.sort()
            starts, ends = np.array([a for a, _ in free]), np.maximum.accumulate([b for _, b in free])
            own = np.fromiter(spans, dtype=np.int64, count=len(spans))
            before = np.searchsorted(starts, own, side="right") - 1
            inside = (before >= 0) & (own < ends[before])
            return float(sum(w for w, out in zip(spans.values(), inside.tolist(), strict=True) if not out)), words
        return sum(spans.values()), words


def measures(weight: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The two features: weight, and weight per thousand words, both as logarithms."""
    return np.stack([np.ones(len(weight)), np.log1p(weight), np.log1p(1000 * weight / np.maximum(words, 1))], axis=1)


def _learned(chosen: DataFrame) -> dict[str, float]:
    """Terms by the logarithm of their rates' ratio between the classes of the sample."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            terms, signs, ys, times = [], [], [], []
            for text, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                own = Counter(folded(text).split())
                if own:
                    # Near copies share the smallest hash of their words, so that a group counts about once.
                    sign = min(xxhash.xxh64_intdigest(w) for w in own) >> 1
                    terms += own
                    times += [min(n, MOST_TIMES) for n in own.values()]
                    signs += [sign] * len(own)
                    ys += [y] * len(own)
            yield pa.record_batch([pa.array(terms, pa.string()), pa.array(signs, pa.int64()), pa.array(ys, pa.float64()), pa.array(times, pa.int64())], names=["word", "sign", "y", "n"])

    table = chosen.select("text", "y").mapInArrow(words, "word string, sign bigint, y double, n bigint").groupBy("word", "sign", "y").agg(F.max("n").alias("n"))
    toxic = F.col("y") == 1
    counted = table.groupBy("word").agg(F.count_if(toxic).alias("texts"), F.coalesce(F.sum(F.when(toxic, F.col("n"))), F.lit(0)).alias("toxic"), F.coalesce(F.sum(F.when(~toxic, F.col("n"))), F.lit(0)).alias("clean"))
    counted = written(counted, "words")
    total = counted.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.max("texts").alias("texts")).first()
    if not total.toxic or not total.clean:
        return {}
    word = F.col("word")
    begins = F.transform(F.sequence(F.lit(SHORTEST), F.least(F.length(word), F.lit(LONGEST))), lambda k: F.concat(F.lit(" "), F.substring(word, 1, k)))
    terms = F.concat(F.array(F.concat(F.lit(" "), word, F.lit(" "))), F.when(F.length(word) >= SHORTEST, begins).otherwise(F.array().cast("array<string>")))
    weight = F.log((F.col("toxic") + 0.5) / float(total.toxic)) - F.log((F.col("clean") + 0.5) / float(total.clean))
    found = counted.select(F.explode(terms).alias("term"), "texts", "toxic", "clean").groupBy("term").agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    n = chosen.filter("y = 1").count()
    # From LEAST_SHARE of the toxic texts on, and far more frequent there: a few thousand rows at most.
    found = found.filter((F.col("texts") >= max(LEAST_TEXTS, LEAST_SHARE * n)) & (weight >= LEAST_WEIGHT)).select("term", "texts", weight.alias("weight")).collect()
    return _chosen({row.term: (row.texts, row.weight) for row in found})


def _chosen(found: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Of terms that continue each other, the one that says most."""
    longer: dict[str, list[str]] = {}
    for term in found:
        for k in range(len(term) - 1, SHORTEST, -1):
            if term[:k] in found:
                longer.setdefault(term[:k], []).append(term)
                break
    kept: dict[str, float] = {}
    for first in sorted(found, key=lambda t: (len(t), t)):
        if any(first[:k] in found for k in range(SHORTEST + 1, len(first))):
            continue
        term = first
        while longer.get(term):
            then = max(longer[term], key=lambda t: (found[t][0], t))
            (texts, weight), (fewer, greater) = found[term], found[then]
            if not (fewer >= NEARLY_ALL * texts or fewer >= MOST * texts and greater >= weight + GREATER):
                break
            term = then
        kept[term] = found[term][1]
    return kept


def _curve(features: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a ridge."""
    w = np.zeros(features.shape[1])
    ridge = np.diag([1e-3, 0.1, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        step = np.linalg.solve((features * (p * (1 - p))[:, None]).T @ features + ridge, features.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


#: The curve where nothing can be learned: half at one built-in word.
DEFAULT_CURVE = np.array([-4.0, 2.5, 0.0])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MOST_LABELLED) -> tuple[dict[str, float], np.ndarray]:
    """The lexicon and the curve, from a sample of `most` labelled rows outside the held-out fold."""
    terms = {f" {w} ": SEED_WEIGHT for w in SEEDS.split()}
    chosen = written(sample(in_batches(docs), labels, label, most), "labelled")  # as large as `most` rows; all texts are read once for it
    terms |= _learned(chosen)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Lexicon(terms)
        for part in slices(batches, "text"):
            found = [own.weigh(folded(x)) for x in part.column(0).to_pylist()]
            yield pa.record_batch([pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64()), part.column(1)], names=["weight", "words", "y"])

    rows = chosen.select("text", "y").mapInArrow(weigh, "weight double, words bigint, y double").toPandas()  # the sample's rows, three numbers each
    if rows["y"].nunique() < 2:
        return terms, DEFAULT_CURVE
    order = np.lexsort((rows["y"], rows["words"], rows["weight"]))  # sums in one order, whatever the order of tasks
    return terms, _curve(measures(rows["weight"].to_numpy()[order], rows["words"].to_numpy()[order]), rows["y"].to_numpy()[order])


def _scorer(terms: dict[str, float], curve: np.ndarray):
    own: list[Lexicon] = []

    def probabilities(column: pa.Array) -> np.ndarray:
        if not own:
            own.append(Lexicon(terms))
        found = np.array([own[0].weigh(folded(x)) for x in column.to_pylist()]).reshape(-1, 2)
        return 1 / (1 + np.exp(-np.clip(measures(found[:, 0], found[:, 1]) @ curve, -30, 30)))

    return probabilities


def score(docs: DataFrame, model: tuple[dict[str, float], np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    terms, curve = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probabilities = _scorer(terms, curve)
        for part in slices(batches, "text"):
            p = probabilities(part.column(2))
            yield pa.record_batch([part.column(0), part.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    known = in_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return known.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, model: tuple[dict[str, float], np.ndarray], threshold: float = THRESHOLD) -> DataFrame:
    """docs without the rows that score at the threshold or above; columns stay as they are.

    Null and empty texts score lowest and stay. Repeated rows stay or go together, rows without id are judged as any; an
    empty table stays empty.
    """
    terms, curve = model
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probabilities = _scorer(terms, curve)
        for part in slices(batches, "text"):
            yield part.filter(pa.array(probabilities(part.column(at)) < threshold))

    return in_batches(docs).mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD, most: int = MOST_LABELLED) -> DataFrame:
    """Train on labelled rows outside the held-out fold (crc32 of the id modulo 5 is 0), then score every row of docs.

    Null and empty texts have no weight and score lowest. Nothing but the text enters a score. Repeated rows each get
    a row; rows without id are scored, never learned from and not held out; other columns are ignored, whatever their
    names; an empty table gives no rows. Without labels of both classes the built-in list and curve decide.
    """
    return score(docs, train(docs, labels, label, most), threshold)
