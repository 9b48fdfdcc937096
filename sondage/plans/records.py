"""Social drivers from the health record: answers, need flags and their table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.nulls import is_in, quoted
from ..functions.recode import KEEP, flag, set_band, value_map
from ..operators import cohort
from ..operators.reshape import answers_wide
from ..operators.scales import any_need, exercise_minutes, isolation_points, screen_alcohol
from ..operators.stats import categorical_test
from ..operators.summary import dichotomous

PERSON, PATIENT = "arb_person_id", "Pt_MDC"
QUESTIONS = [*fixed.RECORD_ANSWERS, *fixed.RECORD_PLAIN]
DOMAINS = [
    "unmet_housing",
    "unmet_food",
    "unmet_transp",
    "unmet_util",
    "osq_pos",
    "health_lit_pos",
    "less_than_150m_per_wk",
    "socially_isolated1",
    "audit_pos",
]


def c(name: str) -> Column:
    return F.col(quoted(name))


def dated(answers: DataFrame) -> DataFrame:
    """Day of an answer, month first in the text; missing when it is no date."""
    day = F.try_to_timestamp("observation_date", F.lit("MM/dd/yyyy")).cast("date")
    return answers.withColumn("date", day)


def person_rows(answers: DataFrame) -> DataFrame:
    """One row per person and one column per question, latest answer kept; question
    names come with blanks in the export and with underscores here."""
    tidy = dated(answers).withColumn(
        "flowsheet_row_name", F.replace("flowsheet_row_name", F.lit(" "), F.lit("_"))
    )
    return answers_wide(
        tidy, [PERSON], "flowsheet_row_name", "VALUE", QUESTIONS, pick="last",
        order=["date", "VALUE"],
    )


def answers_as_text(codes: DataFrame) -> DataFrame:
    """Answer codes to their labels; unlisted codes stay."""
    return codes.withColumns(
        {q: value_map(c(q), table, KEEP) for q, table in fixed.RECORD_ANSWERS.items()}
    )


def demographics(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "Pt_Age": set_band("Pt_Age", fixed.RECORD_AGE_GROUPS, fixed.RECORD_AGE_DEFAULT),
            "Pt_Insurance_type": set_band("Pt_Insurance_type", fixed.PAYER_GROUPS),
        }
    )


def isolation_ties() -> dict[str, Column]:
    often = ["Three times a week", "More than three times a week"]
    return {
        "partner": c("R_SOCIAL_CONNECTIONS_MARITAL_STATUS").isin("Married", "Living with partner"),
        "phone": c("R_SOCIAL_CONNECTIONS_PHONE").isin(often),
        "meeting": c("R_SOCIAL_CONNECTIONS_GET_TOGETHER").isin(often),
        "religion": c("R_SOCIAL_CONNECTIONS_RELIGION") == "More than 4 times per year",
        "membership": c("R_SOCIAL_CONNECTIONS_CLUB_MEMBERSHIP") == "Yes",
        "attendance": c("R_SOCIAL_CONNECTIONS_CLUB_ATTENDANCE") == "More than 4 times per year",
    }


def any_isolation_sign() -> Column:
    """The alternative reading: any one sign of isolation counts."""
    rarely = ["Never", "Once a week"]
    return any_need(
        c("R_SOCIAL_CONNECTIONS_GET_TOGETHER").isin(rarely),
        c("R_SOCIAL_CONNECTIONS_PHONE").isin(rarely),
        c("R_SOCIAL_CONNECTIONS_RELIGION") == "Never",
        c("R_SOCIAL_CONNECTIONS_CLUB_ATTENDANCE") == "Never",
        c("R_SOCIAL_CONNECTIONS_CLUB_MEMBERSHIP") == "No",
        c("R_SOCIAL_CONNECTIONS_MARITAL_STATUS").isin("Widowed", "Separated", "Never married"),
    )


def any_drinking_sign() -> Column:
    """The alternative reading of the alcohol items: any one sign counts."""
    return any_need(
        c("R_AUDIT_ALCOHOL_FREQUENCY") == "2-4 times a week",
        c("R_AUDIT_ALCOHOL_STD_DRINKS").isin("3 or 4", "5 or 6"),
        c("R_AUDIT_ALCOHOL_BINGE").isin("Less than monthly", "Weekly"),
    )


def domains(codes: DataFrame, housing_unknown_hides: bool = False) -> DataFrame:
    """All need flags of a person, from the coded answers."""
    alcohol = screen_alcohol(
        c("R_AUDIT_ALCOHOL_FREQUENCY"),
        c("R_AUDIT_ALCOHOL_STD_DRINKS"),
        c("R_AUDIT_ALCOHOL_BINGE"),
        fixed.ALCOHOL_CUTOFF,
    )
    scored = codes.withColumns(
        {"audit_score": alcohol["alcohol_score"], "audit_pos": alcohol["alcohol_positive"]}
    )
    df = answers_as_text(scored)
    ties = isolation_ties()
    worried = ["Often true", "Sometimes true"]
    minutes = exercise_minutes(c("R_EXERCISE_DAYS_PER_WEEK"), c("R_EXERCISE_MINUTES_PER_DAY"))
    df = df.withColumns(
        {
            "unmet_food": any_need(
                c("R_FOOD_INSECURITY_ABILITY_TO_PAY").isin(worried),
                c("R_FOOD_INSECURITY_WORRY").isin(worried),
            ),
            "unmet_transp": any_need(
                c("R_TRANSPORTATION_DAILY_LIVING") == "Yes",
                c("R_TRANSPORTATION_MEDICAL_APPT") == "Yes",
            ),
            "unmet_util": any_need(c("R_AHC_HRSN_UTILITIES") == "Yes"),
            "unmet_housing": any_need(
                c("R_CHILDREN'S_HEALTHWATCH_HOUSING_TIMES_MOVED").try_cast("double") >= 2,
                c("R_CHILDREN'S_HEALTHWATCH_HOUSING_MORTGAGE") == "Yes",
                c("R_CHILDREN'S_HEALTHWATCH_HOUSING_HOMELESS") == "Yes",
                unknown_hides=housing_unknown_hides,
            ),
            "minutes_exer_per_wk": minutes,
            "less_than_150m_per_wk": any_need(minutes <= fixed.ENOUGH_EXERCISE_MINUTES),
            "social_iso_score1": isolation_points(list(ties.values())),
            "social_iso_score2": isolation_points(
                [t for name, t in ties.items() if name != "attendance"]
            ),
            "any_isolation_sign": any_isolation_sign(),
            "any_drinking_sign": any_drinking_sign(),
            "osq_pos": is_in(c("R_STRESS_ANXIOUS"), ["Rather much", "Very much"]).cast("int"),
            "health_lit_pos": is_in(c("R_PAC_B1300"), ["Often", "Always"]).cast("int"),
        }
    )
    return df.withColumns(
        {
            "socially_isolated1": flag(F.col("social_iso_score1") <= 1),
            "socially_isolated2": flag(F.col("social_iso_score2") <= 1),
        }
    )


def with_people(flags: DataFrame, people: DataFrame) -> DataFrame:
    """Flags next to the demographics of the same person."""
    known = cohort.semi(people.withColumnRenamed(PATIENT, PERSON), flags, PERSON)
    return flags.join(demographics(known), PERSON, "left")


def domain_table(joined: DataFrame, by: str) -> DataFrame:
    """Share with a need per domain and group, with the test over groups."""
    table = dichotomous(joined, {d: 1 for d in DOMAINS}, by=by)
    tests = categorical_test(joined, DOMAINS, by).select("variable", "test", "p_value")
    return table.join(tests, "variable", "left")
