"""Column expressions for places in a text: everything stays in Spark's own operators, in time that grows with the text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

OPEN, CLOSE, OTHER = "\x01", "\x02", "\x03"
PLACES = "array<struct<start:bigint,end:bigint>>"
#: Items folded at once. An array that grows item by item is copied each time, so it grows within a run only.
RUN = 128


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once."""
    return F.transform(F.array(value), use)[0]


def folded(items: Column, state: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]], last: Callable[[Column], Column] | None = None) -> Column:
    """What a fold over items emits, as one array of the kind: step(state, item) gives the next state and an array of what it emits.

    last(state) gives what the state at the end emits.
    """
    empty, runs = F.array().cast(kind), F.array().cast(f"array<{kind}>")

    def one(acc: Column, item: Column) -> Column:
        then, out = step(acc["state"], item)
        return F.struct(then.alias("state"), F.concat(acc["out"], out).alias("out"))

    def run(acc: Column, k: Column) -> Column:
        part = F.aggregate(F.slice(items, k * RUN + 1, F.lit(RUN)), F.struct(acc["state"].alias("state"), empty.alias("out")), one)
        return let(part, lambda p: F.struct(p["state"].alias("state"), F.concat(acc["out"], F.array(p["out"])).alias("out")))

    def end(acc: Column) -> Column:
        return F.flatten(acc["out"]) if last is None else F.flatten(F.concat(acc["out"], F.array(last(acc["state"]))))

    # One run more than there are items for, which is empty, so that the sequence is never.
    return F.aggregate(F.sequence(F.lit(0), F.floor(F.size(items) / RUN).cast("int")), F.struct(state.alias("state"), runs.alias("out")), run, end)


def markable(text: Column) -> Column:
    """The text with the two marker characters replaced by a third, so that places stay the same; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), OPEN + CLOSE, OTHER + OTHER)


def matches(text: Column, pattern: Column | str, valid: Callable[[Column], Column] | None = None) -> Column:
    """Places (code points, end exclusive) of the leftmost non-overlapping matches; those whose match is not valid are dropped.

    The matches are marked by one replacement, and the lengths of the pieces between marks are summed. The pattern
    must not match an empty string or a control character.
    """
    pieces = F.split(F.regexp_replace(text, pattern, F.lit(OPEN + "$0" + CLOSE)), OPEN)

    def step(at: Column, piece: Column) -> tuple[Column, Column]:
        match = F.substring_index(piece, CLOSE, 1)
        found = F.array(F.struct(at.alias("start"), (at + F.length(match)).alias("end")))
        if valid is not None:
            found = F.when(valid(match), found).otherwise(F.array().cast(PLACES))
        return at + F.length(piece) - 1, found

    def walk(parts: Column) -> Column:
        return folded(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.length(parts[0]).cast("bigint"), PLACES, step)

    return F.when(F.rlike(text, pattern if isinstance(pattern, Column) else F.lit(pattern)), let(pieces, walk)).otherwise(F.array().cast(PLACES))


def replaced(text: Column, places: Column, mark: str) -> Column:
    """The text with a mark for each place, for one that overlaps those before it none; places are sorted by start.

    Characters have one width in UTF-32, so that each piece is read where it stands. A sign goes before each piece, or a
    byte order mark at its start would be taken for one.
    """
    kind = "array<struct<start:bigint,size:bigint>>"

    def step(at: Column, place: Column) -> tuple[Column, Column]:
        gap = F.array(F.struct(at.alias("start"), (place["start"] - at).alias("size")))
        return F.greatest(at, place["end"]), F.when(place["start"] >= at, gap).otherwise(F.array().cast(kind))

    def joined(points: Column) -> Column:
        # The last gap goes to the end of the text.
        gaps = folded(places, F.lit(0).cast("bigint"), kind, step, lambda at: F.array(F.struct(at.alias("start"), (F.octet_length(points) / 4 - at).cast("bigint").alias("size"))))
        piece = lambda g: F.concat(F.encode(F.lit("|"), "UTF-32"), F.substring(points, (4 * g["start"] + 1).cast("int"), (4 * g["size"]).cast("int")))
        return F.array_join(F.transform(gaps, lambda g: F.substr(F.decode(piece(g), "UTF-32"), F.lit(2))), mark)

    return let(F.encode(text, "UTF-32"), joined)
