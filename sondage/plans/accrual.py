"""Accrual report: screening, consent, and which follow-ups are due, done or late."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.nulls import quoted
from ..functions.recode import name_missing
from ..operators import cohort
from ..operators.reshape import wider
from ..operators.summary import categorical
from .patient import EVENT, ORDER, RECORD, VISIT

FIRST = "consent_and_t1_sur_arm_1"
RECORD_COLS = [
    "enrollstatus",
    "patient_consent_form_complete",
    "healthrelated_social_needs_complete",
    "participatingclinic",
    "pcc_or_mdc_name",
]


def record_table(df: DataFrame) -> DataFrame:
    """One row per record with its first known status fields."""
    one = cohort.record_first(df, RECORD, [ORDER], RECORD_COLS)
    return one.withColumns(
        {
            "healthrelated_social_needs_complete": name_missing(
                "healthrelated_social_needs_complete"
            ),
            "enrollstatus": name_missing("enrollstatus", "TBD"),
            "patient_consent_form_complete": name_missing(
                "patient_consent_form_complete", "Incomplete"
            ),
        }
    )


def consented(records: DataFrame) -> DataFrame:
    return records.where(F.col("patient_consent_form_complete").isin("Complete", "1")).select(RECORD)


def capped(df: DataFrame, last_day: str) -> DataFrame:
    """Rows of the records that consented on or before a day."""
    return cohort.semi(df, cohort.until(df, "patient_consent_form_timestamp", last_day), RECORD)


def visit_states(
    df: DataFrame,
    ids: DataFrame,
    as_of: str,
    windows: Mapping[str, tuple[int, int]] = fixed.VISIT_WINDOWS,
) -> DataFrame:
    """One row per consented record that has a first visit: status ``t1_status`` ..
    ``t5_status`` with follow-ups resolved against their windows on ``as_of``.

    One grouped pass over the events replaces a join per visit.
    """

    def at(point: int, value: Column) -> Column:
        return F.max(F.when(F.col(VISIT) == point, value))

    needs = F.col("healthrelated_social_needs_complete")
    care = F.col("experiences_with_care_complete")
    form = {1: needs, 2: care, 3: care, 4: care, 5: needs}
    first_day = at(1, F.to_date("healthrelated_social_needs_timestamp"))
    unfinished = F.col("pasc_symptoms_and_followup_questions_complete") == "Incomplete"
    rows = (
        cohort.semi(df, ids, RECORD)
        .groupBy(quoted(RECORD))
        .agg(
            F.count_if(F.col(EVENT) == FIRST).alias("_first"),
            *[at(k, c).alias(f"t{k}_status") for k, c in form.items()],
            F.datediff(F.lit(as_of).cast("date"), first_day).alias("days_since_t1"),
            F.coalesce(at(1, unfinished), F.lit(False)).alias("_blocked"),
        )
        .where("_first > 0")
    )
    named = {f"{label.lower()}_status": label for label in windows}
    out = cohort.follow_up_status(rows, named, "days_since_t1", windows, F.col("_blocked"))
    return out.drop("_first", "_blocked")


def visit_dates(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Date of every visit per record, and days from the first to each later one."""
    day = F.coalesce(
        *[
            F.to_date(c)
            for c in (
                "patient_consent_form_timestamp",
                "healthrelated_social_needs_timestamp",
                "experiences_with_care_timestamp",
            )
        ]
    )
    dated = cohort.semi(df.where(F.col(VISIT).isNotNull()), ids, RECORD).withColumn("_day", day)
    names = {k: f"t{k}_date" for k in range(1, 6)}
    wide = wider(dated, [RECORD], VISIT, list(names), F.min("_day"), rename=names)
    return wide.withColumns(
        {f"days_to_t{k}": F.datediff(f"t{k}_date", "t1_date") for k in range(2, 6)}
    )


def completion_by_site(states: DataFrame, df: DataFrame) -> DataFrame:
    """Visit status per site type."""
    sites = df.select(RECORD, "site_type").distinct()
    joined = states.join(sites, RECORD, "left")
    return categorical(
        joined, [f"t{k}_status" for k in range(1, 5)], by="site_type", overall=False
    )


def screening_by_site(df: DataFrame) -> DataFrame:
    """Site by enrolment status on the screening event."""
    at_screening = df.where(F.col(EVENT) == fixed.SCREENING).withColumn(
        "enrollstatus", name_missing("enrollstatus", "Missing")
    )
    return categorical(at_screening, ["site_name"], by="enrollstatus")


def presence(df: DataFrame, events: list[str]) -> DataFrame:
    """1 / 0 per record and event."""
    return wider(df, [RECORD], EVENT, events, F.max(F.lit(1)), fill=0)


def consent_violations(df: DataFrame) -> DataFrame:
    """Complete consent forms without a consent name."""
    return cohort.violations(
        df,
        {
            "consent form complete without a name": F.col("consent_name").isNull()
            & (F.col("patient_consent_form_complete") == "Complete")
        },
        [RECORD],
    )


def repeated_names(df: DataFrame) -> DataFrame:
    return cohort.repeated(df.where(F.col(EVENT) == fixed.PRE_ENROLMENT), ["name"])
