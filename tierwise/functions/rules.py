"""Classification rules, kept as data.

Every classifier in the job is an ordered first-match rule list. The lists
below are fixed values that must equal the source job's for equal results;
they are written in the job's evaluation order. ``tierwise.functions.columns``
turns them into Catalyst ``CASE WHEN`` expressions (no UDF), and the oracle
SQL renders the very same lists, so a rule change is a one-line data change.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Question ids of the coach-notes forms.
# ---------------------------------------------------------------------------
LM_TOPIC_QUESTIONS = ["502533", "502758"]   # topic form, two versions
DM_TOPIC_QUESTION = "502599"                 # DM focus
DETAIL_QUESTION = "502534"                   # topic detail text
LONG_TERM_GOAL_QUESTION = "502833"           # long-term goal text
DM_GOAL_QUESTION = "502616"                  # DM goal text

# ---------------------------------------------------------------------------
# Call filters.
# ---------------------------------------------------------------------------
SUCCESSFUL_STATUS = "SUCCESSFUL"
CALL_DIRECTIONS = ["OUTBOUND", "INBOUND"]
EXCLUDED_CALL_TYPES = ["ENGAGEMENT", "SUPPORT", "UNKNOWN", "ONLINE ENROLLMENT"]
ENROLLED = "ENROLLED"
FEP_PATTERN = "%FEP%"

# ---------------------------------------------------------------------------
# C1 / C5, topic-form answer (upper case, exact) -> category.
# ---------------------------------------------------------------------------
ANSWER_CATEGORIES = [
    ("Exercise", ["EXERCISE", "PHYSICAL ACTIVITY"]),
    ("Nutrition", ["HEALTHY EATING", "NUTRITION/WEIGHT MANAGEMENT"]),
    ("Weight Management", ["WEIGHT"]),
    ("Stress Management", ["STRESS", "MENTAL WELL-BEING"]),
    ("Sleep Management", ["RESTORATIVE SLEEP"]),
    ("Tobacco Cessation", ["TOBACCO"]),
    ("Behavioral Health", ["AVOIDANCE OF RISKY SUBSTANCES"]),
    ("Social Support", ["POSITIVE SOCIAL CONNECTIONS", "OTHER - PHYSICAL/SOCIAL"]),
    ("Other", ["OTHER"]),
]
DM_TOPIC = "Chronic Disease State"
DEFAULT_TOPIC = "General"

# ---------------------------------------------------------------------------
# C2, note text -> topic, substring keywords on upper case,
# first group that matches wins.
# ---------------------------------------------------------------------------
NOTE_KEYWORDS = [
    ("Weight Management", ["WEIGHT", "LBS", "POUND", "BMI"]),
    ("Exercise", ["EXERCIS", "WALK", "RUN ", "GYM", "ACTIVE", "STEPS"]),
    ("Stress Management", ["STRESS", "ANXI", "DEPRESS", "MENTAL", "MINDFUL"]),
    ("Sleep Management", ["SLEEP"]),
    ("Nutrition", ["EAT", "DIET", "NUTRI", "MEAL", "FOOD", "CALORI"]),
    ("Chronic Disease State", ["CHOLEST", "A1C", "BLOOD PRESSURE", "DIABET", "ASTHMA",
                               "COPD"]),
    ("Tobacco Cessation", ["TOBACCO", "SMOK", "QUIT", "NICOTINE"]),
]
# a note text is usable when it is not null, its trimmed length is > 2 and
# its trimmed upper form is not one of these.
MIN_TEXT_LENGTH = 2
JUNK_TEXTS = ["N/A", "-", "NA", "NONE", ".", "N/A."]
# Source priority of the text tiers.
TEXT_SOURCE_PRIORITY = {DETAIL_QUESTION: 1, LONG_TERM_GOAL_QUESTION: 2, DM_GOAL_QUESTION: 3}

# ---------------------------------------------------------------------------
# C4, trimmed upper call type -> topic (tier 2).
# ---------------------------------------------------------------------------
CALL_TYPE_TOPICS = [
    ("Tobacco Cessation", ["TOBACCO"]),
    ("Nutrition", ["DIETARY REFERRAL"]),
    ("Chronic Disease State", ["SPECIALTY", "CLINICAL"]),
]
TIER2_CALL_TYPES = [t for _, types in CALL_TYPE_TOPICS for t in types]
PRIOR_LOOKBACK_DAYS = 180

# ---------------------------------------------------------------------------
# C7 / C8 labels.
# ---------------------------------------------------------------------------
TIER_LM = "Tier 1: Date Match (LM)"
TIER_DM = "Tier 1: Date Match (DM)"
TIER_TEXT = "Tier 1.5: Text Inference"
TIER_CALL_TYPE = "Tier 2: Call Type"
TIER_PRIOR = "Tier 3: Prior Topic"
TIER_NONE = "Tier 4: None"
PROGRAM_LM, PROGRAM_DM = "LM", "DM"
TOBACCO_WORD = "TOBACCO"

# ---------------------------------------------------------------------------
# Goals (C10, C11, C12, C13, F7).
# ---------------------------------------------------------------------------
GOAL_TYPES = [(2, "Coach-Created"), (3, "System-Recommended")]
GOAL_STATUSES = [(2, "In Progress"), (3, "Completed"), (5, "Completed"), (4, "Withdrawn")]
KEPT_GOAL_STATUS_IDS = [2, 3, 4, 5]
EXCLUDED_GOAL_PATTERNS = ["Survey:%", "RED:%", "RED/%"]   # case-sensitive LIKE
GOAL_SEPARATOR = ":"

# C11: upper text before the first ':' (untrimmed) -> domain, exact match.
GOAL_PREFIXES = [
    ("Exercise", ["EXERCISE", "[EXERCISE]", "*EXERCISE", "[[*EXERCISE]]", "*CIS EXERCISE",
                  "*CIS EXERICSE", "EXERICSE", "EXERISE", "EXERCSE"]),
    ("Nutrition", ["HEALTHY EATING", "[HEALTHY EATING]", "[*HEALTHY EATING]", "NUTRTION",
                   "HEATLHY EATING", "HEALTH EATING", "[NUTRITION]", "DIET"]),
    ("Weight Management", ["WEIGHT", "[WEIGHT]", "WEIGHT LOSS"]),
    ("Tobacco Cessation", ["TOBACCO", "[TOBACCO]"]),
    ("Mental/Behavioral Health", ["STRESS", "[*STRESS]", "STRESS/EMOTIONAL WELL-BEING",
                                  "DEPRESSION", "MENTAL HEALTH", "MINDFULNESS", "ALCOHOL"]),
    ("Stress Management", ["STRESS MANAGEMENT", "SLEEP", "CPAP"]),
    ("Gaps in Care", ["SCREENING", "[PREVENTATIVE CARE]", "[*PREVENTATIVE CARE]",
                      "[*CARE GAPS]", "SCREENING SOC", "VACCINE", "[VACCINE]"]),
    ("Condition Management", ["DIABETES", "[DIABETES]", "DIABETES/CAD", "CAD/DIABETES",
                              "DIABETES SOC", "ASTHMA/COPD", "ASTHMA", "COPD", "COPD/HF",
                              "[RESPIRATORY (ASTHMA/COPD)]", "[ASTHMA/COPD]", "[ASTHMA]",
                              "[COPD]", "CAD/HF", "CAD", "HF", "[CARDIAC (CAD/HF)]", "[CAD]",
                              "[HF]", "AFIB", "FIBRO", "OA", "IBS", "IBD", "LBP", "ARSD"]),
    ("Condition Management", ["CHOLESTEROL", "CHOL", "TRIG", "BP", "BLOOD PRESSURE"]),
    ("Condition Management", ["UTILIZATION RISK", "HOSPITAL", "[HOSPITALIZATION]",
                              "CRITICAL RISK EVENT FOLLOW-UP", "APPOINTMENT ADHERENCE",
                              "APPOINTMENT", "MAKE AND KEEP APPOINTMENTS",
                              "MEDICATION ADHERENCE", "MEDICATION", "MED ADHERENCE",
                              "SELF MANAGEMENT", "SELF CARE", "WORK ITEM", "TIME MANAGEMENT",
                              "SCHEDULE ADHERENCE"]),
    ("Financial", ["FINANCES", "FINANCIAL WELLNESS", "SAVINGS"]),
    ("Social", ["SOCIAL WELLNESS"]),
    ("Spiritual", ["SPIRITUAL HEALTH"]),
    ("Condition Management", ["WATER", "WATER INTAKE", "PAIN MANAGEMENT"]),
]

# Goal names without any ':' -> domain by substring on upper case.
GOAL_KEYWORDS = [
    ("Gaps in Care", ["SCREENING", "VACCINE", "FLU SHOT", "ANNUAL WELLNESS VISIT",
                      "CANCER SCREENING", "DENTAL EXAM", "PRIMARY CARE PROVIDER"]),
    ("Exercise", ["EXERCISE", "AEROBIC", "STRENGTHENING", "MINUTES A WEEK",
                  "PHYSICAL ACTIVITY"]),
    ("Nutrition", ["SUGAR", "FRUIT", "VEGETABLE", "EATING", "FOOD", "NUTRITION"]),
    ("Weight Management", ["WEIGHT", "BMI"]),
    ("Tobacco Cessation", ["TOBACCO", "SMOK"]),
    ("Mental/Behavioral Health", ["DEPRESS", "STRESS", "ANXIETY", "MENTAL", "ALCOHOL"]),
    ("Stress Management", ["SLEEP"]),
    ("Condition Management", ["BLOOD PRESSURE", "CHOLESTEROL", "A1C", "BLOOD SUGAR",
                              "DIABETES", "INHALER", "STATIN", "BETA-BLOCKER", "MEDICATION",
                              "SPIROMETRY", "RETINAL", "FOOT EXAM", "MICROALBUMIN", "CAD",
                              "HEART FAILURE"]),
]
OTHER_DOMAIN = "Other"
TOBACCO_DOMAIN = "Tobacco Cessation"

# ---------------------------------------------------------------------------
# Display orders.
# ---------------------------------------------------------------------------
DOMAIN_ORDER = ["Gaps in Care", "Exercise", "Nutrition", "Weight Management",
                "Tobacco Cessation", "Mental/Behavioral Health", "Stress Management",
                "Condition Management", "Financial", "Social", "Spiritual"]
DOMAIN_ORDER_SHORT = DOMAIN_ORDER[:8]
STATUS_ORDER = ["Completed", "In Progress", "Not Started", "Withdrawn"]
REPORTED_STATUSES = ["Completed", "In Progress", "Withdrawn"]
YES_NO_ORDER = ["Yes", "No"]
COMPLETED, IN_PROGRESS, NOT_STARTED, WITHDRAWN = (
    "Completed", "In Progress", "Not Started", "Withdrawn")
GOAL_NUMBER_CAP = 6

# ---------------------------------------------------------------------------
# Tobacco dashboard metric labels, in display order.
# ---------------------------------------------------------------------------
TOBACCO_METRICS = ["Tobacco Participants", "Active Tobacco Participants",
                   "Goals Completed", "Goals In Progress", "Completion Rate"]
