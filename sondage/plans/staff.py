"""Staff survey: cohort, recodes and scales."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.nulls import is_in
from ..functions.recode import cut_right, value_map
from ..operators import cohort
from ..operators.columns import span
from ..operators.scales import Scale, any_extreme


def rates(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Consent rate over all records, completion rate over the consented."""
    return cohort.funnel(
        df,
        {
            "consented": F.col("consent_name").isNotNull(),
            "completed": F.col("employee_survey_t1_complete") == "Complete",
        },
        by,
    )


def completed(df: DataFrame) -> DataFrame:
    return df.where(
        F.col("consent_name").isNotNull() & (F.col("employee_survey_t1_complete") == "Complete")
    )


def recode(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "pcc_or_mdc": value_map("pcc_or_mdc", {"practice": "PCC", "clinic": "MDC"}),
            "experience_cat": cut_right(
                "experience", fixed.EXPERIENCE_BREAKS, fixed.EXPERIENCE_LABELS
            ),
        }
    )


def prescribers() -> Column:
    return is_in("practice_role_pcc", fixed.PRESCRIBER_ROLES_PCC) | is_in(
        "practice_role_mdc", fixed.PRESCRIBER_ROLES_MDC
    )


def stigma(max_missing: int | None = 1) -> Scale:
    """Mean of ten items, five mirrored; at most one may be missing."""
    return Scale(
        items=fixed.STIGMA_ITEMS, how="mean", reversed=fixed.STIGMA_REVERSED, max_missing=max_missing
    )


def stigma_rescaled() -> Scale:
    """Sum of the answered items, on the range of the longer original form."""
    return Scale(
        items=fixed.STIGMA_ITEMS,
        how="sum",
        reversed=fixed.STIGMA_REVERSED,
        max_missing=None,
        factor=fixed.STIGMA_RESCALE,
    )


def stigma_extreme() -> Column:
    """1 when any item has its most negative answer."""
    return any_extreme(
        {i: 5 if i in fixed.STIGMA_REVERSED else 1 for i in fixed.STIGMA_ITEMS}
    )


def climate(df: DataFrame) -> Scale:
    """Mean of the climate items of complete answers."""
    return Scale(items=span(df, "expect_certain_number", "appreciation"), how="mean")


def culture(subscales: Mapping[str, Sequence[str]], reversed: Sequence[str] = ()) -> dict[str, Scale]:
    """Subscale means and ``CultureAvg`` over all their items, complete answers only.

    Which items form a subscale is the instrument's, so the caller supplies it.
    """
    out = {
        name: Scale(items=list(items), how="mean", reversed=[i for i in items if i in reversed])
        for name, items in subscales.items()
    }
    every = [i for items in subscales.values() for i in items]
    out["CultureAvg"] = Scale(items=every, how="mean", reversed=[i for i in every if i in reversed])
    return out
