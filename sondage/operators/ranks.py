"""Order statistics without one global sort task.

Ranks and exact percentiles need, for every distinct value, how many rows lie
below it. Rows are first counted per distinct value, so ties cost nothing. The
distinct values are cut into slices at fixed boundaries, each slice is summed up
on its own, and only one total per slice is summed along the whole range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import quoted

FEWEST_SLICES = 256


def slice_bounds(df: DataFrame, value: str, slices: int | None = None) -> list[float]:
    """Boundaries between slices of about equal row count, at most ``slices``.

    Any increasing list gives the same result; a good one gives even tasks. By
    default there are as many slices as shuffle partitions, so that slices get
    smaller as the session is set up for more data.
    """
    if slices is None:
        width = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
        slices = max(FEWEST_SLICES, int(width))
    probs = [i / slices for i in range(1, slices)]
    found = df.approxQuantile(value, probs, max(0.5 / slices, 1e-4))
    return sorted(set(found))


def ranked_counts(
    df: DataFrame,
    value: str,
    groups: Sequence[str] = (),
    counts: Mapping[str, Column] | None = None,
    few_values: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Per group and distinct value: ``n`` rows, ``below`` rows with a smaller
    value, ``total`` rows of the group, and any extra ``counts`` (aggregates over
    the rows of that value). Missing values are left out.

    ``few_values`` says the value is a rating on a fixed scale, so that one
    window per group is small.
    """
    v = F.col(quoted(value)).cast("double")
    rows = df.withColumn("_v", F.nanvl(v, F.lit(None).cast("double")))
    extra = counts or {}
    by = [quoted(g) for g in groups]
    bounds = [] if few_values else slice_bounds(rows, "_v", slices)
    if bounds:
        splits = [float("-inf"), *bounds, float("inf")]
        rows = Bucketizer(splits=splits, inputCol="_v", outputCol="_slice").transform(rows)
    keys = by + (["_slice"] if bounds else [])
    per_value = rows.groupBy(*keys, "_v").agg(
        F.count("_v").alias("n"), *[c.alias(name) for name, c in extra.items()]
    )
    # Missing values count zero and are dropped after the windows: a filter up here
    # would be pushed into the scan and compute a derived value a second time.

    def window(part):
        return Window.partitionBy(*(part or [F.lit(1)]))

    before = (Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum("n").over(window(keys).orderBy("_v").rowsBetween(*before)), F.lit(0))
    out_cols = [*by, F.col("_v").alias(value), "n"]
    if not bounds:
        return per_value.select(
            *out_cols, local.alias("below"), F.sum("n").over(window(by)).alias("total"), *extra
        ).where("n > 0")
    along = window(by).orderBy("_slice").rowsBetween(*before)
    tags = [f"_k{i}" for i in range(len(keys))]
    slice_sums = (
        per_value.groupBy(*keys)
        .agg(F.sum("n").alias("_sum"))
        .select(
            *keys,
            F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_offset"),
            F.sum("_sum").over(window(by)).alias("total"),
        )
        .toDF(*tags, "_offset", "total")
    )
    same = [F.col(k).eqNullSafe(F.col(t)) for k, t in zip(keys, tags)]
    return per_value.withColumn("_local", local).join(slice_sums, same, "inner").select(
        *out_cols, (F.col("_local") + F.col("_offset")).alias("below"), "total", *extra
    ).where("n > 0")


def average_rank() -> Column:
    """Tie-averaged rank of a value row of :func:`ranked_counts`."""
    return F.col("below") + (F.col("n") + 1) / F.lit(2.0)


def with_ranks(
    df: DataFrame, value: str, groups: Sequence[str] = (), name: str = "rank", **options
) -> DataFrame:
    """Every row with its tie-averaged rank within its group."""
    ranks = ranked_counts(df, value, groups, **options).select(
        *[F.col(quoted(g)).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col(quoted(value)).alias("_rv"),
        average_rank().alias(name),
    )
    same = F.col(quoted(value)).cast("double") == F.col("_rv")
    for i, g in enumerate(groups):
        same = same & F.col(quoted(g)).eqNullSafe(F.col(f"_g{i}"))
    return df.join(ranks, same, "left").drop("_rv", *[f"_g{i}" for i in range(len(groups))])


def percentiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    groups: Sequence[str] = (),
    kind: int = 7,
    **options,
) -> DataFrame:
    """Exact percentiles per group, one column per name in ``probs``.

    Kind 7 interpolates between neighbours; kind 2 averages the two neighbours
    where the position falls on a step and takes the upper one elsewhere.
    """
    if kind not in (2, 7):
        raise ValueError("kind must be 2 or 7")
    by = [quoted(g) for g in groups]
    ranked = ranked_counts(df, value, groups, **options)
    v, first = F.col(quoted(value)), F.col("below")
    last = F.col("below") + F.col("n")  # ranks below + 1 .. below + n hold this value

    def at(rank: Column) -> Column:
        return F.max(F.when((first < rank) & (rank <= last), v))

    aggs, finish = [], []
    for name, p in probs.items():
        if kind == 7:
            spot = (F.col("total") - 1) * F.lit(float(p))
            low = F.floor(spot)
            share = F.max(spot - low)
            ranks = (low + 1, F.least(low + 2, F.col("total")))
        else:
            # The product is rounded first: 0.1 * 30 must count as a step.
            spot = F.round(F.col("total") * F.lit(float(p)), 9)
            low = F.floor(spot)
            share = F.max(F.when(spot == low, 0.5).otherwise(1.0))
            ranks = (F.greatest(low, F.lit(1)), F.least(low + 1, F.col("total")))
        aggs += [at(ranks[0]).alias(f"_lo_{name}"), at(ranks[1]).alias(f"_hi_{name}")]
        aggs.append(share.alias(f"_sh_{name}"))
        lo, hi, sh = (F.col(f"_{part}_{name}") for part in ("lo", "hi", "sh"))
        finish.append((lo + (hi - lo) * sh).alias(name))
    return ranked.groupBy(*by).agg(*aggs).select(*by, *finish)


def deciles(df: DataFrame, value: str, groups: Sequence[str] = (), **options) -> DataFrame:
    """The eleven cut points p0, p10 .. p100 (kind 7)."""
    return percentiles(df, value, {f"p{i * 10}": i / 10 for i in range(11)}, groups, **options)
