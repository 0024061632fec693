"""Fixed values of the signal domain. They must stay exactly as written."""

N_BANDS = 60
FEATURE_COLUMNS = [f"freq_{i}" for i in range(1, N_BANDS + 1)]
LABEL_COLUMN = "label"

POSITIVE = "M"
NEGATIVE = "R"
LABEL_MAPPING = {"M": 1, "R": 0}

CLASS_DESCRIPTIONS = {
    1: "Mine (Underwater Threat)",
    0: "Rock (Non-threat)",
}
CLASS_CATEGORIES = {
    "M": "Mine (Underwater Explosive Threat)",
    "R": "Rock (Benign Geological Formation)",
}
CLASS_MEANINGS = {
    "M": "Mine (Explosive Underwater Threat)",
    "R": "Rock (Benign Geological Structure)",
}

DEFAULT_TAU = 0.50
SAFE_TAU = 0.43
FN_COST = 5.0
FP_COST = 1.0
N_TAUS = 99
FULL_RECALL = 0.999
CALIBRATION_BINS = 6
HISTOGRAM_BINS = 15
KDE_GRID = 200
BALANCED_BELOW = 1.5

HISTOGRAM_BANDS = [10, 20, 35, 48]
BOX_BANDS = [11, 21, 28, 36]
CORRELATION_BANDS = list(range(1, N_BANDS + 1, 2))

THREAT_CLASS = "Mine (Threat Detected)"
BENIGN_CLASS = "Rock (Benign Object)"

# (code, level, badge class, message), from the most to the least severe
THREAT_LEVELS = [
    (
        "DEFCON-1",
        "CRITICAL THREAT",
        "threat-critical",
        "High-confidence explosive naval mine detected. Immediate evasive or "
        "counter-measure protocol recommended.",
    ),
    (
        "DEFCON-2",
        "ELEVATED THREAT",
        "threat-elevated",
        "Acoustic return exceeds safe operating threshold. Threat flagged under "
        "zero-missed-mine safety policy.",
    ),
    (
        "DEFCON-3",
        "MONITORED - LOW RISK",
        "threat-low",
        "Acoustic signature is below detection threshold. Probable geological rock "
        "or seafloor debris.",
    ),
    (
        "DEFCON-4",
        "CLEAR - BENIGN OBJECT",
        "threat-clear",
        "Clean acoustic echo pattern consistent with natural rock formation. "
        "Navigation path clear.",
    ),
]
CRITICAL_AT = 0.75
MONITORED_AT = 0.25

FALSE_POSITIVE_TEXT = "False Positive (False Alarm)"
FALSE_NEGATIVE_TEXT = "False Negative (LETHAL MISSED MINE)"

RAISES_THREAT = "Increases Threat Likelihood"
LOWERS_THREAT = "Decreases Threat Likelihood"

ZONES = [("Low", 1, 15), ("Mid", 16, 35), ("High", 36, 60)]

VOTING_WEIGHTS = [2.0, 1.0, 1.0, 1.0]
