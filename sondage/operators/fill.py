"""Filling gaps within a record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import quoted

_DIRECTIONS = ("down", "up", "updown", "downup")

def fill_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    direction: str = "updown",
    chunk: Column | None = None,
) -> DataFrame:
    """Fill missing values from the same record.

    ``down`` takes the previous value, ``up`` the next one, ``updown`` the next
    and failing that the previous one, ``downup`` the reverse. ``order`` must be
    unique within a record.

    Without ``chunk`` a record is one window, right for records bounded by the
    visit schedule. Where a record has no such bound, pass a ``chunk``: a column
    that never decreases along ``order``, nulls first as in the order. Rows are then
    filled within (record, chunk), and only each chunk's first and last value
    travels along the record, so no task holds a long record. Rows with a null
    chunk are a chunk of their own before all others. The result is the same with
    and without chunks.

    The next value is read as the previous one in descending order: a running
    frame is linear in the window, a frame open to the right is quadratic.
    """
    if direction not in _DIRECTIONS:
        raise ValueError(f"direction must be one of {_DIRECTIONS}")
    by_key = [F.col(quoted(k)) for k in keys]
    ordering = [F.col(quoted(o)) for o in order]
    columns = df.columns
    part = list(by_key)
    if chunk is not None:
        df = df.withColumn("_chunk", chunk)
        part.append(F.col("_chunk"))

    def running(window_keys, sort_cols, last_row):
        return Window.partitionBy(*window_keys).orderBy(*sort_cols).rowsBetween(
            Window.unboundedPreceding, last_row
        )

    def latest(c, window):
        return F.last(F.col(quoted(c)), ignorenulls=True).over(window)

    need_prev, need_next = direction != "up", direction != "down"
    asc = running(part, ordering, Window.currentRow)
    desc = running(part, [o.desc() for o in ordering], Window.currentRow)
    out = df.withColumns(
        {
            **({f"_prev_{c}": latest(c, asc) for c in cols} if need_prev else {}),
            **({f"_next_{c}": latest(c, desc) for c in cols} if need_next else {}),
        }
    )
    if chunk is not None:
        rank = F.struct(*ordering)
        edges = df.groupBy(*by_key, "_chunk").agg(
            *[
                take(F.col(quoted(c)), F.when(F.col(quoted(c)).isNotNull(), rank)).alias(f"{tag}{c}")
                for c in cols
                for tag, take in (("_first_", F.min_by), ("_last_", F.max_by))
            ]
        )
        before = running(by_key, [F.col("_chunk")], -1)
        after = running(by_key, [F.col("_chunk").desc()], -1)
        carries = edges.select(
            *by_key,
            "_chunk",
            *[latest(f"_last_{c}", before).alias(f"_before_{c}") for c in cols if need_prev],
            *[latest(f"_first_{c}", after).alias(f"_after_{c}") for c in cols if need_next],
        )
        tags = [f"_k{i}" for i in range(len(keys))]
        carries = carries.toDF(*tags, "_c", *carries.columns[len(keys) + 1 :])
        same = F.col("_chunk").eqNullSafe(F.col("_c"))
        for k, t in zip(by_key, tags):
            same = same & k.eqNullSafe(F.col(t))
        out = out.join(carries, same, "left")

    def value(c, side):
        local, carried = {"prev": ("_prev_", "_before_"), "next": ("_next_", "_after_")}[side]
        near = F.col(quoted(f"{local}{c}"))
        return near if chunk is None else F.coalesce(near, F.col(quoted(f"{carried}{c}")))

    sides = {
        "down": ("prev",),
        "up": ("next",),
        "updown": ("next", "prev"),
        "downup": ("prev", "next"),
    }[direction]
    filled = {
        c: F.coalesce(F.col(quoted(c)), *[value(c, s) for s in sides]).alias(c) for c in cols
    }
    return out.select(*[filled.get(c, F.col(quoted(c))) for c in columns])

