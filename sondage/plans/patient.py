"""Preparation of the longitudinal patient survey: one row per record and event.

Every step takes and returns a DataFrame and touches only its own columns, so the
steps chain into one plan. Records are bounded by the visit schedule (at most seven
events each), which is what the per-record steps rely on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions.nulls import is_in, matches, missing_count, quoted, row_sum
from ..functions.recode import (
    after_dash,
    band,
    checked,
    drop_parenthesis,
    first_checked,
    first_match,
    flag,
    leading_number,
    name_missing,
    override,
    value_map,
    without_code,
)
from ..operators import cohort
from ..operators.columns import across, ending, leave_out, rename, starting
from ..operators.fill import fill_within
from ..operators.reshape import longer
from ..operators.scales import Scale, add_scores, look_up
from ..operators.summary import frequencies

RECORD, EVENT, VISIT = "record_id", "redcap_event_name", "timepoint"
ORDER = "_event_order"


def add_timepoint(df: DataFrame) -> DataFrame:
    """Integer time point of the event, and an order over all events."""
    point = cohort.event_timepoint(EVENT, fixed.TIMEPOINTS)
    before = F.when(F.col(EVENT) == fixed.PRE_ENROLMENT, -1).when(
        F.col(EVENT) == fixed.SCREENING, 0
    )
    return df.withColumns({VISIT: point, ORDER: F.coalesce(point, before, F.lit(99))})


def drop_flagged(df: DataFrame) -> DataFrame:
    """Remove test and duplicate records, all their rows."""
    return cohort.exclude_flagged(df, RECORD, fixed.TEST_WORDS, fixed.DUPLICATE_WORDS)


def enrolment_violations(df: DataFrame) -> DataFrame:
    """First visits of enrolled records whose symptom form is not complete.

    ``df`` needs ``current_enroll_status``, as :func:`resolve_status` leaves it.
    """
    enrolled = df.where(F.col("current_enroll_status") == "Enrollment completed")
    at_first = cohort.semi(df.where(F.col(VISIT) == 1), enrolled, RECORD)
    done = F.col("pasc_symptoms_and_followup_questions_complete")
    return cohort.violations(
        at_first, {"enrolled without a complete first visit": done != "Complete"}, [RECORD]
    )


def resolve_status(df: DataFrame) -> DataFrame:
    """Current enrolment status, and the last completed visit of those who left.

    People who left the study stay in the analysis as enrolled.
    """
    current = drop_parenthesis(F.coalesce("not_enrolled_status", "enrollstatus"))
    df = df.withColumn("current_enroll_status", current)
    left = df.where(F.col("current_enroll_status") == "left study")
    last = cohort.last_completed(
        cohort.semi(df, left, RECORD),
        RECORD,
        VISIT,
        [
            "pasc_symptoms_and_followup_questions_complete",
            "pasc_symptoms_only_t2_t4_complete",
            "pasc_symptoms_and_followup_questions_t5_complete",
        ],
        EVENT,
    ).select(RECORD, F.col("last_event").alias("ltfu_surv"))
    df = df.join(last, RECORD, "left")
    stays = F.when(
        matches("current_enroll_status", "left study"), "Enrollment completed"
    ).otherwise(F.col("current_enroll_status"))
    return df.withColumns(
        {
            "ltfu": F.col("ltfu_surv").isNotNull().cast("int"),
            "current_enroll_status": stays,
            "enrollstatus": first_match(F.coalesce(stays, F.col("enrollstatus")), fixed.STATUS_RULES),
        }
    )


def fill_site(df: DataFrame) -> DataFrame:
    """Site type and name, spread over the record's events, then made explicit."""
    df = df.withColumn("site_name", F.coalesce("mdc_name", "pcc_name"))
    df = fill_within(df, [RECORD], [ORDER], ["pcc_or_mdc", "site_name"], "updown")
    return rename(df, {"pcc_or_mdc": "site_type"}).withColumns(
        {"site_type": name_missing("site_type"), "site_name": name_missing("site_name")}
    )


def demographics(df: DataFrame, keep_race_when_ethnicity_unknown: bool = True) -> DataFrame:
    """Age band, gender group and single race category."""
    race = override(
        first_checked(fixed.RACES, several="More than one race"),
        F.col("patient_ethn") == "Hispanic or Latino",
        "Hispanic or Latino",
        keep_race_when_ethnicity_unknown,
    )
    gender = F.when(is_in("patient_gender", fixed.OTHER_GENDERS), "Unknown/Other").otherwise(
        F.col("patient_gender")
    )
    return df.withColumns(
        {
            "age_group": band("patient_age", fixed.AGE_BANDS),
            "gender_group": gender,
            "mt1_race": row_sum(list(fixed.RACES)),
            "race": race,
        }
    )


def clinical(df: DataFrame) -> DataFrame:
    """First- and last-visit clinical columns under one name, checked boxes as 0/1."""
    pairs = {}
    for name in df.columns:
        plain = name.replace("_t5___", "___") if "_t5___" in name else name.removesuffix("_t5")
        shared = ("months_symps", "ifyes_monthsymps", "lcdiagnosis", "conditions", "medications",
                  "therapies")
        if plain != name and plain.startswith(shared) and plain in df.columns:
            pairs[plain] = name
    df = df.withColumns(
        {
            plain: F.when(F.col(VISIT) == 5, F.col(t5)).when(F.col(VISIT) == 1, F.col(plain))
            for plain, t5 in pairs.items()
        }
    )
    df = leave_out(df, pairs.values())
    boxes = starting(df, "conditions___", "medications___", "therapies___")
    df = across(df, boxes, checked)
    return df.withColumn("lcdiagnosis", flag(F.col("lcdiagnosis") == "Yes"))


GLOBAL_HEALTH_SOURCES = {
    **{f"promis_{i}": f"promis_global0{i}" for i in range(1, 6)},
    "promis_6": "promis_global07",
    "promis_7": "avg_pain",
    "promis_8": "avg_fatigue",
    "promis_9": "promis_global06",
    "promis_10": "bothered",
}


def global_health(df: DataFrame, physical: DataFrame, mental: DataFrame) -> DataFrame:
    """Global health sums and their T-scores from the two score tables."""
    df = df.withColumns(
        {
            to: F.coalesce(source, f"{source}_v2", f"{source}_t5")
            for to, source in GLOBAL_HEALTH_SOURCES.items()
        }
    )
    items = {f"promis_{i}": leading_number(f"promis_{i}") for i in range(2, 7)}
    items["promis_7"] = value_map("promis_7", fixed.PAIN_SCORES)
    items["promis_8"] = value_map("promis_8", fixed.FATIGUE_SCORES)
    items["promis_10"] = value_map("promis_10", fixed.BOTHERED_SCORES)
    items["promis_1"] = after_dash("promis_1")
    items["promis_9"] = after_dash("promis_9")
    df = df.withColumns(items).withColumns(
        {
            "promis_global_phys": row_sum(fixed.PHYSICAL_ITEMS),
            "promis_global_ment": row_sum(fixed.MENTAL_ITEMS),
            "n_miss_phys": missing_count(fixed.PHYSICAL_ITEMS),
            "n_miss_ment": missing_count(fixed.MENTAL_ITEMS),
        }
    )
    df = look_up(df, physical, "promis_global_phys", "Raw Summed Score", "T-Score", "promis_pht")
    df = look_up(df, mental, "promis_global_ment", "Raw Summed Score", "T-Score", "promis_mht")
    spent = [f"{s}{x}" for s in GLOBAL_HEALTH_SOURCES.values() for x in ("", "_v2", "_t5")]
    return leave_out(df, spent)


def symptoms(df: DataFrame) -> DataFrame:
    """Weighted symptom score of those the gate question leads to the symptoms."""
    gate = (
        (F.col("ps_ptpasc") == "Yes")
        | is_in("ps2_ptpasc", fixed.SYMPTOM_GATE_T2)
        | (F.col("ps_ptpasc_t5") == "Yes")
    )
    merged = {}
    for name in fixed.SYMPTOM_WEIGHTS:
        tail = name.removeprefix("ps_")
        merged[name] = F.coalesce(name, f"ps2_{tail}", f"ps_{tail}_t5")
    df = df.withColumns(merged).withColumn("_gate", gate)
    yes = {f"_y_{n}": flag(F.col(n).contains("Yes")) for n in fixed.SYMPTOM_WEIGHTS}
    scale = Scale(
        items=list(yes),
        how="sum",
        weights={f"_y_{n}": w for n, w in fixed.SYMPTOM_WEIGHTS.items()},
        cutoff=fixed.SYMPTOM_CUTOFF,
        gate="_gate",
    )
    df = add_scores(df.withColumns(yes), {"pasc_score": scale})
    df = rename(df, {"pasc_score_positive": "pasc_positive"})
    return leave_out(df, ["_gate", *yes])


def severity_means(raw: DataFrame, prefix: str = "ps_") -> DataFrame:
    """Mean of burden, severity and frequency per symptom, on one 1..5 scale.

    ``raw`` is the numeric export; "not asked" is missing, and severity and
    frequency start at 0 in the form, hence the shift.
    """
    df = rename(raw, {k: v for k, v in fixed.SEVERITY_RENAMES.items() if k in raw.columns})
    dims = fixed.SYMPTOM_DIMENSIONS
    items = [c for c in ending(df, *[f"_{d}" for d in dims]) if c.startswith(prefix)]

    def ready(name):
        value = without_code(F.col(quoted(name)), fixed.NOT_ASKED).cast("double")
        return value if name.endswith("_burden") else value + 1

    long = longer(df.select(*[ready(i).alias(i) for i in items]), [], items, "name", "value")
    # Names are taken apart on the few grouped rows, not on every answer.
    means = long.groupBy("name").agg(F.avg("value").alias("mean"))
    return means.select(
        F.regexp_replace("name", r"_[^_]*$", "").alias("symptom"),
        F.regexp_extract("name", r"[^_]*$", 0).alias("dimension"),
        "mean",
    )


# Free text of the option "Other", and the box that opens it.
OTHER_TEXTS = {
    "conditions_other": "conditions___13",
    "other_med": "medications___12",
    "other_service": "therapies___20",
}


def other_texts(df: DataFrame) -> DataFrame:
    """Frequencies of what was written next to a ticked "Other" box (0/1 boxes)."""
    return frequencies(df, {t: F.col(box) == 1 for t, box in OTHER_TEXTS.items()})


UNDERSTANDING_ITEMS = ("serious", "consequences", "talk")


def understanding_scale(site: str) -> Scale:
    return Scale(
        items=[f"{i}_{site}" for i in UNDERSTANDING_ITEMS],
        how="mean",
        answers=fixed.UNDERSTANDING_SCORES,
        max_missing=1,
        gate=f"{site}_appts = 'Yes'",
    )


def understanding(df: DataFrame) -> DataFrame:
    """Lack-of-understanding score per kind of clinic, for those with a visit."""
    bases = [f"{b}_{s}" for s in ("pcc", "mdc") for b in UNDERSTANDING_ITEMS]
    bases += ["pcc_appts", "mdc_appts"]
    late = [b for b in bases if f"{b}_t5" in df.columns]
    df = df.withColumns({b: F.coalesce(b, f"{b}_t5") for b in late})
    df = leave_out(df, [f"{b}_t5" for b in late])
    df = across(df, ["pcc_appts", "mdc_appts"], name_missing)
    return add_scores(df, {f"lou_score_{s}": understanding_scale(s) for s in ("pcc", "mdc")})


def understanding_long(df: DataFrame, timepoint: int = 1) -> DataFrame:
    """Record, kind of clinic and score, missing scores left out."""
    scored = df.where(F.col(VISIT) == timepoint)
    return longer(
        scored, [RECORD], ["lou_score_mdc", "lou_score_pcc"], "type", "score"
    ).where("score is not null")


NEEDS = ["living_need", "food_need", "transport_need", "utlities_need", "fin_strain_need",
         "social_need"]


def social_needs(raw: DataFrame, raw_codes_in_score: bool = False) -> DataFrame:
    """Need flags per domain and their sum, from numeric answers.

    ``raw_codes_in_score`` adds up the answer codes of transport, utilities and
    strain instead of their flags, as one version of the score did.
    """

    def among(c, codes):
        return is_in(c, codes).cast("int")

    living = among("living_sit", [2, 3]) + row_sum([f"living_probs___{i}" for i in range(1, 8)])
    food = among("food_worry", [1, 2]) + among("food_last", [1, 2])
    social = among("help_daytoday", [3, 4]) + flag(F.col("lonely") > 3)
    df = raw.withColumns(
        {
            "living_need": flag(living > 0),
            "food_need": flag(food > 0),
            "transport_need": flag(F.col("transport") == 1),
            "utlities_need": among("utlities", [1, 2]),
            "fin_strain_need": among("fin_strain", [1, 2]),
            "social_need": flag(social > 0),
        }
    )
    summed = (
        ["living_need", "food_need", "transport", "utlities", "fin_strain", "social_need"]
        if raw_codes_in_score
        else NEEDS
    )
    return df.withColumn("hrsn_need_score", row_sum(summed, skip_missing=True))


def prepare(survey: DataFrame, physical: DataFrame, mental: DataFrame) -> DataFrame:
    """All steps on a label export whose social-need columns are merged in raw."""
    df = drop_flagged(add_timepoint(survey))
    df = fill_site(resolve_status(df))
    df = clinical(demographics(df))
    df = symptoms(global_health(df, physical, mental))
    return social_needs(understanding(df))
