"""Fixed values of the instruments: labels, weights, cut-offs and codes.

They are stated as the survey and intake forms use them, because results depend on
their exact spelling.
"""

# Events of the longitudinal survey and their time points.
TIMEPOINTS = {
    "consent_and_t1_sur_arm_1": 1,
    "t2_survey_arm_1": 2,
    "t3_survey_arm_1": 3,
    "t4_survey_arm_1": 4,
    "t5_survey_arm_1": 5,
}
PRE_ENROLMENT = "patient_preenrollm_arm_1"
SCREENING = "screening_and_enro_arm_1"

# Keywords that mark test and duplicate records.
TEST_WORDS = {
    "name": "test",
    "anythingelse": "test record",
    "study_label": "test",
    "not_enrolled_status": "test",
}
DUPLICATE_WORDS = {
    "enrollstatus": "duplicate",
    "study_label": "duplicate",
    "not_enrolled_status": "duplicate",
}

# Enrolment status clean-up: pattern -> status.
STATUS_RULES = [
    ("never", "No response"),
    ("declined", "Declined"),
    ("partial", "Partial"),
    ("eligible", "Not eligible"),
]

# Follow-up visits: days after the first visit, and days of grace.
VISIT_WINDOWS = {"T2": (90, 14), "T3": (180, 14), "T4": (270, 14), "T5": (360, 14)}

AGE_BANDS = [(18, 35, "18-34"), (35, 65, "35-64"), (65, None, "65+")]

OTHER_GENDERS = ["Non-binary", "Prefer not to answer", "Transgender Male"]

RACES = {
    "patient_race___1": "African American or Black",
    "patient_race___2": "American Indian/Alaska Native",
    "patient_race___3": "Asian",
    "patient_race___4": "Native Hawaiian/Other Pacific Islander",
    "patient_race___5": "White",
    "patient_race___6": "Other",
    "patient_race___7": "Prefer not to answer",
}

# Global health items.
PAIN_SCORES = {
    "0 No pain": 5,
    ("1", "2", "3"): 4,
    ("4", "5", "6"): 3,
    ("7", "8", "9"): 2,
    "10 Worst pain imagin-able": 1,
}
FATIGUE_SCORES = {"None": 5, "Mild": 4, "Moderate": 3, "Severe": 2, "Very severe": 1}
BOTHERED_SCORES = {"Never": 5, "Rarely": 4, "Sometimes": 3, "Often": 2, "Always": 1}
PHYSICAL_ITEMS = ["promis_7", "promis_6", "promis_3", "promis_8"]
MENTAL_ITEMS = ["promis_2", "promis_4", "promis_5", "promis_10"]

# Symptom score: weight per symptom, positive from the cut-off.
SYMPTOM_WEIGHTS = {
    "ps_sense": 8,
    "ps_malaise": 7,
    "ps_cough": 4,
    "ps_think": 3,
    "ps_thirst": 3,
    "ps_heart": 2,
    "ps_pain": 2,
    "ps_fatigue": 1,
    "ps_sex": 1,
    "ps_faint": 1,
    "ps_gastro": 1,
    "ps_nerve": 1,
}
SYMPTOM_CUTOFF = 12
SYMPTOM_GATE_T2 = ["Yes", "I don't know of prefer not to answer"]
SYMPTOM_DIMENSIONS = ["burden", "sevdepaul", "freqdepaul"]
SEVERITY_RENAMES = {
    "ps_headache_freq": "ps_headache_freqdepaul",
    "ps_headache_sev": "ps_headache_sevdepaul",
    "ps_itching_itchburden": "ps_itching_burden",
    "ps_itching_itchfreq": "ps_itching_freqdepaul",
    "ps_itching_itchsev": "ps_itching_sevdepaul",
}
NOT_ASKED = -88
BRANCHED_SYMPTOMS = ["ps_menstrual", "ps_menopause"]
BRANCH_EXCLUDED_GENDERS = ["Male", "Transgender Female"]

# Lack-of-understanding scale.
UNDERSTANDING_SCORES = {
    "Never": 1,
    "Rarely": 2,
    "Sometimes": 3,
    "Often": 4,
    "Very Often": 5,
}

# Staff survey.
EXPERIENCE_BREAKS = [1, 5, 10]
EXPERIENCE_LABELS = ["<=1", "2-5", "6-10", ">10"]
STIGMA_ITEMS = [
    "prefer_not",
    "irritate",
    "extra_time",
    "particularly_difficult",
    "satisfying",
    "compassionate",
    "feel_better",
    "little_help",
    "insurance_should",
    "waste_dollars",
]
STIGMA_REVERSED = [
    "prefer_not",
    "irritate",
    "particularly_difficult",
    "little_help",
    "waste_dollars",
]
STIGMA_RESCALE = 66 / 50
AGREEMENT_LEVELS = ["SD (1)", "D (2)", "N (3)", "A (4)", "SA (5)", "Unknown"]
AGREEMENT_GROUPS = {
    "Disagree": ["SD (1)", "D (2)"],
    "Agree": ["A (4)", "SA (5)"],
    "Neutral": ["N (3)"],
}
PRESCRIBER_ROLES_PCC = ["Physician", "Advanced practice provider (NP, PA)"]
PRESCRIBER_ROLES_MDC = [
    "Physician",
    "Resident physician/Fellow",
    "Certified nurse specialist, nurse practitioner, or advanced practice nurse",
    "Physician assistant",
]

# Intake form of the health record: age and payer groups.
RECORD_AGE_GROUPS = {
    "21 to 40": ["21 to 25", "26 to 30", "31 to 35", "36 to 40"],
    "41 to 60": ["41 to 45", "46 to 50", "51 to 55", "56 to 60"],
}
RECORD_AGE_DEFAULT = "61 to 85"
PAYER_GROUPS = {
    "Commercial": [
        "AETNA",
        "ANTHEM",
        "ANTHEM FEDERAL",
        "CIGNA",
        "CU ANTHEM EXCLUSIVE",
        "DENVER HEALTH",
        "GREAT WEST",
        "UCHEALTH ANTHEM",
        "UNITED",
    ],
    "Medicaid": ["COLORADO MEDICAID"],
    "Medicare": ["MEDICARE", "UNITED MEDICARE"],
}

# Intake form of the health record: answer codes per question.
YES_NO = {"1": "Yes", "2": "No"}
CONTACT = {
    "1": "Never",
    "2": "Once a week",
    "3": "Twice a week",
    "4": "Three times a week",
    "5": "More than three times a week",
}
ATTENDANCE = {
    "1": "Never",
    "2": "1 to 4 times per year",
    "3": "More than 4 times per year",
    "97": "Unknown",
}
HOW_TRUE = {"1": "Never true", "2": "Sometimes true", "3": "Often true"}
RECORD_ANSWERS = {
    "R_FINANCIAL_RESOURCE_STRAIN_BASICS": {
        "1": "Very hard",
        "2": "Hard",
        "3": "Somewhat hard",
        "4": "Not very hard",
        "5": "Not hard at all",
    },
    "R_AUDIT_ALCOHOL_BINGE": {
        "1": "Never",
        "2": "Less than monthly",
        "3": "Monthly",
        "4": "Weekly",
        "5": "Daily or almost",
        "98": "Declined",
        "97": "Unable",
    },
    "R_AUDIT_ALCOHOL_STD_DRINKS": {
        "0": "Patient does not drink",
        "1": "1 or 2",
        "2": "3 or 4",
        "3": "5 or 6",
    },
    "R_AUDIT_ALCOHOL_FREQUENCY": {
        "1": "Never",
        "2": "Monthly or less",
        "3": "2-4 times a month",
        "4": "2-4 times a week",
        "5": "4 or more times a week",
    },
    "R_SOCIAL_CONNECTIONS_MARITAL_STATUS": {
        "3": "Married",
        "4": "Widowed",
        "5": "Divorced",
        "6": "Separated",
        "7": "Never married",
        "8": "Living with partner",
    },
    "R_SOCIAL_CONNECTIONS_PHONE": CONTACT,
    "R_SOCIAL_CONNECTIONS_GET_TOGETHER": CONTACT,
    "R_SOCIAL_CONNECTIONS_RELIGION": ATTENDANCE,
    "R_SOCIAL_CONNECTIONS_CLUB_ATTENDANCE": ATTENDANCE,
    "R_SOCIAL_CONNECTIONS_CLUB_MEMBERSHIP": YES_NO,
    "R_CHILDREN'S_HEALTHWATCH_HOUSING_HOMELESS": YES_NO,
    "R_CHILDREN'S_HEALTHWATCH_HOUSING_MORTGAGE": YES_NO,
    "R_FOOD_INSECURITY_WORRY": HOW_TRUE,
    "R_FOOD_INSECURITY_ABILITY_TO_PAY": HOW_TRUE,
    "R_TRANSPORTATION_DAILY_LIVING": YES_NO,
    "R_TRANSPORTATION_MEDICAL_APPT": YES_NO,
    "R_AHC_HRSN_UTILITIES": {"1": "Yes", "2": "No", "3": "Already shut off"},
    "R_STRESS_ANXIOUS": {
        "1": "Not at all",
        "2": "Only a little",
        "3": "To some extent",
        "4": "Rather much",
        "5": "Very much",
    },
}
# Questions of the intake form that keep their answers as they are.
RECORD_PLAIN = [
    "R_CHILDREN'S_HEALTHWATCH_HOUSING_TIMES_MOVED",
    "R_EXERCISE_DAYS_PER_WEEK",
    "R_EXERCISE_MINUTES_PER_DAY",
    "R_PAC_B1300",
]
ALCOHOL_CUTOFF = 3
ENOUGH_EXERCISE_MINUTES = 150
