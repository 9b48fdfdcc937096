"""Spans of regular expressions with their positions, in DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

FOUND = "array<struct<start:int,end:int,match:string,before:string,after:string>>"
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"


#: Elements that an array is built from one by one; longer arrays are built from such blocks.
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def blocks_of(values: Column) -> Column:
    """An array that is not empty in blocks, each with the number of elements before it."""
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int")),
        lambda b: F.struct((b * BLOCK).alias("first"), F.slice(values, b * BLOCK + 1, BLOCK).alias("x")),
    )


def running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """For each whole number of an array, all up to it combined (an associative function, 0 changes nothing).

    Appending copies an array, so results are gathered inside blocks and the blocks joined.
    """
    def within(xs: Column, start: Column) -> Column:
        return F.aggregate(
            xs,
            F.struct(start.alias("at"), F.array().cast("array<int>").alias("all")),
            lambda state, x: let(
                combine(state["at"], x), lambda now: F.struct(now.alias("at"), F.concat(state["all"], F.array(now)).alias("all"))
            ),
            lambda state: state["all"],
        )

    def long(v: Column) -> Column:
        return let(
            F.transform(blocks_of(v), lambda b: b["x"]),
            lambda bs: F.flatten(
                F.transform(
                    F.arrays_zip(
                        bs.alias("xs"),
                        F.slice(
                            F.concat(F.array(F.lit(0)), within(F.transform(bs, lambda b: F.aggregate(b, F.lit(0), combine)), F.lit(0))), 1, F.size(bs)
                        ).alias("start"),
                    ),
                    lambda z: within(z["xs"], z["start"]),
                )
            ),
        )

    return let(values, lambda v: F.when(F.size(v) <= BLOCK, within(v, F.lit(0))).otherwise(long(v)))


def find(text: Column, pattern: str, when: Column | None = None, before: int = 0, after: int = 0) -> Column:
    """Leftmost non-overlapping matches: start and end in code points, the match, and text around it.

    The pieces between matches and the matches themselves alternate, so positions are
    running sums of their lengths. ``when`` tells which texts to search.
    """
    matches, pieces = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
    # zipped, so that no lambda holds the searches and repeats them for each match
    parts = [matches.alias("m"), pieces.alias("p"), *([F.slice(pieces, 2, 1 << 30).alias("q")] if after else [])]

    def placed(xs: Column) -> Column:
        ends = running(F.transform(xs, lambda x: F.length(x["p"]) + F.length(x["m"])), lambda a, b: a + b)
        return F.transform(
            F.arrays_zip(xs.alias("x"), ends.alias("end")),
            lambda z: F.struct(
                (z["end"] - F.length(z["x"]["m"])).alias("start"),
                z["end"].alias("end"),
                z["x"]["m"].alias("match"),
                (F.right(z["x"]["p"], F.lit(before)) if before else F.lit("")).alias("before"),
                (F.left(z["x"]["q"], F.lit(after)) if after else F.lit("")).alias("after"),
            ),
        )

    found = let(F.filter(F.arrays_zip(*parts), lambda x: x["m"].isNotNull()), placed)
    some = text.rlike(pattern) if when is None else when & text.rlike(pattern)
    return F.when(some, found).otherwise(F.array()).cast(FOUND)


def as_spans(found: Column, kind: str, rank: int) -> Column:
    """Found matches as spans of a kind; ``rank`` orders kinds that start together."""
    return F.transform(
        found, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), x["end"].alias("end"))
    ).cast(SPAN)


def in_order(*spans: Column) -> Column:
    """All spans by start, then kind."""
    return F.array_sort(F.flatten(F.array(*spans)))


def written(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def merged(spans: Column) -> Column:
    """Sorted spans with overlapping and touching ones made one."""
    def joined(xs: Column) -> Column:
        """Structs of a start, the greatest end so far, and that before."""
        ends = running(F.transform(xs, lambda x: x["end"]), lambda a, b: F.greatest(a, b))
        return let(
            ends,
            lambda e: F.transform(
                F.arrays_zip(F.transform(xs, lambda x: x["start"]).alias("start"), e.alias("end"), F.slice(F.concat(F.array(F.lit(-1)), e), 1, F.size(e)).alias("before")),
                lambda z: F.struct(z["start"].alias("start"), z["end"].alias("end"), (z["start"] > z["before"]).alias("fresh")),
            ),
        )

    def picked(zs: Column) -> Column:
        starts = F.transform(F.filter(zs, lambda z: z["fresh"]), lambda z: z["start"])
        lasts = F.filter(zs, lambda z, i: F.coalesce(F.get(zs, i + 1)["fresh"], F.lit(True)))
        ends = F.transform(lasts, lambda z: z["end"])
        return F.transform(F.arrays_zip(starts.alias("start"), ends.alias("end")), lambda z: F.struct(z["start"].alias("start"), z["end"].alias("end")))

    return let(let(spans, joined), picked)


def masked(text: Column, spans: Column, mask: str) -> Column:
    """The text with each merged span replaced by ``mask``; a text without spans as it is.

    A block of spans is cut out of the text first, and its gaps out of that, because the
    way to a place in a text is as long as the place is far.
    """
    def gaps(xs: Column, part: Column, start: Column) -> Column:
        """What lies before each span, with the mask after it; ``part`` begins at ``start``."""
        return F.array_join(
            F.transform(
                F.arrays_zip(xs.alias("x"), F.slice(F.concat(F.array(start), F.transform(xs, lambda x: x["end"])), 1, F.size(xs)).alias("from")),
                lambda z: F.concat(part.substr(z["from"] - start + 1, z["x"]["start"] - z["from"]), F.lit(mask)),
            ),
            "",
        )

    def cut(whole: Column) -> Column:
        t, xs = whole["t"], whole["xs"]
        parts = F.transform(
            blocks_of(xs),
            lambda b: let(
                F.when(b["first"] == 0, F.lit(0)).otherwise(F.get(xs, b["first"] - 1)["end"]),
                lambda start: let(
                    F.struct(t.substr(start + 1, F.element_at(b["x"], -1)["end"] - start).alias("part"), start.alias("start")),
                    lambda v: gaps(b["x"], v["part"], v["start"]),
                ),
            ),
        )
        return F.concat(F.array_join(parts, ""), t.substr(F.element_at(xs, -1)["end"] + 1, F.length(t)))

    return F.when(F.size(spans) > 0, let(F.struct(text.alias("t"), merged(spans).alias("xs")), cut)).otherwise(text)
