"""Wide to long, long to wide, and stacking of differently shaped frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import quoted


def longer(
    df: DataFrame,
    keys: Sequence[str],
    items: Sequence[str],
    names_to: str = "item",
    values_to: str = "value",
) -> DataFrame:
    """One row per key and item. Items are cast to a common type first.

    ``stack`` instead of ``unpivot``: two uses of the same long frame then share one
    exchange, which the plan of ``unpivot`` hides from the planner.
    """
    kinds = {df.schema[i].dataType.simpleString() for i in items}
    cells = {i: F.col(quoted(i)) for i in items}
    if len(kinds) > 1:
        common = "double" if not any(k == "string" for k in kinds) else "string"
        cells = {i: c.cast(common) for i, c in cells.items()}
    flat = [part for i, c in cells.items() for part in (F.lit(i), c)]
    return df.select(
        *[F.col(quoted(k)) for k in keys],
        F.stack(F.lit(len(items)), *flat).alias(names_to, values_to),
    )


def wider(
    df: DataFrame,
    keys: Sequence[str],
    names_from: str,
    values: Sequence,
    cell: Column,
    fill=None,
    rename: Mapping | None = None,
) -> DataFrame:
    """One row per key and one column per listed name.

    The list of names is required: it fixes the schema and spares the scan that
    would find the names.
    """
    wide = df.groupBy(*[quoted(k) for k in keys]).pivot(names_from, list(values)).agg(cell)
    if fill is not None:
        wide = wide.fillna(fill, subset=[str(v) for v in values])
    if rename:
        wide = wide.withColumnsRenamed({str(k): v for k, v in rename.items()})
    return wide


def answers_wide(
    df: DataFrame,
    keys: Sequence[str],
    question: str,
    answer: str,
    questions: Sequence[str],
    pick: str = "first",
    order: Sequence[str] = (),
) -> DataFrame:
    """Question / answer rows to one column per question, blanks in names to ``_``.

    A key that answers a question twice keeps its first or last answer by
    ``order``, and by answer where that ties. Keys without any of the questions keep
    a row.

    Two steps: one answer per key and question, where repeats are combined before
    the shuffle, then at most one entry per listed question is put together.
    """
    rank = [F.col(quoted(o)).alias(f"_o{i}") for i, o in enumerate(order)]
    take = {"first": F.min, "last": F.max}[pick]
    ranked = F.struct(*rank, F.col(quoted(answer)).alias("_a"))
    by = [quoted(k) for k in keys]
    asked = F.col(quoted(question))
    one = df.groupBy(
        *by, F.when(asked.isin(list(questions)), asked).alias("_question")
    ).agg(take(ranked)["_a"].alias("_answer"))
    entry = F.when(F.col("_question").isNotNull(), F.struct("_question", "_answer"))
    person = one.groupBy(*by).agg(F.map_from_entries(F.collect_list(entry)).alias("_answers"))
    return person.select(
        *by,
        *[F.try_element_at("_answers", F.lit(q)).alias(q.replace(" ", "_")) for q in questions],
    )


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames; columns missing from one are null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def harmonise(
    df: DataFrame,
    keys: Sequence[str],
    visit: str,
    blocks: Mapping[object, Mapping[str, str]],
) -> DataFrame:
    """Fold per-visit column blocks into one set of columns.

    ``blocks`` maps a visit to {column at that visit: common name}. Each row takes
    the block of its own visit, in place, so no stack and no join is needed.
    """
    common: dict[str, Column | None] = {}
    for when, names in blocks.items():
        at_visit = F.col(quoted(visit)) == F.lit(when)
        for source, target in names.items():
            value = F.col(quoted(source))
            seen = common.get(target)
            common[target] = F.when(at_visit, value) if seen is None else seen.when(at_visit, value)
    sources = {s for names in blocks.values() for s in names}
    rest = [c for c in df.columns if c not in sources and c not in common]
    lead = [k for k in keys if k in rest]
    return df.select(
        *[F.col(quoted(c)) for c in lead + [c for c in rest if c not in lead]],
        *[c.alias(n) for n, c in common.items()],
    )


def bind_by_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Put columns of two frames side by side, matched by key instead of row order."""
    extra = [c for c in right.columns if c in keys or c not in left.columns]
    return left.join(right.select(*[quoted(c) for c in extra]), list(keys), "left")
