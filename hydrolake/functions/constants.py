"""Fixed values that results depend on.

FIXED VALUES — these must stay equal to the behaviour being reproduced
(thresholds, labels, scores, defaults).  They are listed plainly, in natural
order, and used by the Column builders in this package.
"""

# --- FIXED VALUES: reservoir status by percent storage (>= threshold) ---
STATUS_THRESHOLDS = [(90.0, "CRITICAL"), (75.0, "HIGH"), (40.0, "NORMAL")]
STATUS_OTHERWISE = "LOW"

# --- FIXED VALUES: filling rate by one-day delta (pp/day) ---
# delta > 3 FAST, delta > 0 MODERATE, delta >= -1 STABLE, else DRAINING
FILLING_FAST_ABOVE = 3.0
FILLING_MODERATE_ABOVE = 0.0
FILLING_STABLE_FROM = -1.0

# --- FIXED VALUES: rain intensity labels (upper bounds, exclusive) ---
RAIN_LABELS = [
    (0.1, "ไม่มีฝน"),
    (10.0, "ฝนเล็กน้อย"),
    (35.0, "ฝนปานกลาง"),
    (90.0, "ฝนหนัก"),
]
RAIN_LABEL_OTHERWISE = "ฝนหนักมาก"
HEAVY_RAIN_MM = 35.0

# --- FIXED VALUES: weather component of the alert score (rain >= threshold) ---
WEATHER_POINTS = [(90.0, 35.0), (35.0, 25.0), (10.0, 15.0), (1.0, 5.0)]

# --- FIXED VALUES: historical component by max risk score ---
HISTORICAL_POINTS = {4: 25.0, 3: 18.0, 2: 10.0, 1: 5.0}
HISTORICAL_DEFAULT_POINTS = 5.0          # province without risk rows this month
HISTORICAL_DEFAULT_LEVEL = "เสี่ยงต่ำ"

# --- FIXED VALUES: reservoir component of the alert score ---
STATUS_POINTS = {"CRITICAL": 30.0, "HIGH": 18.0, "NORMAL": 5.0, "LOW": 0.0}
STATUS_POINTS_OTHER = 5.0
FILLING_POINTS = {"FAST": 10.0, "MODERATE": 5.0, "STABLE": 0.0, "DRAINING": -5.0}
FILLING_POINTS_OTHER = 0.0
RESERVOIR_POINTS_MAX = 40.0
TOP_TRIGGERS = 3

# --- FIXED VALUES: alert levels by total score (>= threshold) ---
ALERT_LEVELS = [(75.0, "วิกฤต"), (50.0, "เตือนภัย"), (25.0, "เฝ้าระวัง")]
ALERT_LEVEL_OTHERWISE = "ปกติ"
ALERT_LEVEL_EN = {"วิกฤต": "CRISIS", "เตือนภัย": "ALERT", "เฝ้าระวัง": "WATCH", "ปกติ": "NORMAL"}
ALERT_LEVEL_EN_OTHERWISE = "NORMAL"
ALERT_LEVEL_ORDER = {"CRISIS": 1, "ALERT": 2, "WATCH": 3, "NORMAL": 4}

# --- FIXED VALUES: hazard risk label -> score (unmapped -> 0) ---
RISK_SCORES = {"เสี่ยงต่ำ": 1, "เสี่ยงปานกลาง": 2, "เสี่ยงสูง": 3, "เสี่ยงสูงมาก": 4}
RISK_LEVEL_MISSING = "ไม่ระบุ"

# --- FIXED VALUES: Silver defaults ---
DEFAULT_OWNER = "กรมชลประทาน"
DEFAULT_NAME = "Unknown"
DEFAULT_REGION = "Unknown"
TRUE_STRINGS = ["true", "1", "yes", "t"]

# --- FIXED VALUES: region by province code range (inclusive) ---
REGION_RANGES = [
    (10, 19, "C", "Central"),
    (20, 27, "E", "Eastern"),
    (30, 49, "NE", "Northeastern"),
    (50, 69, "N", "Northern"),
    (70, 79, "W", "Western"),
    (80, 99, "S", "Southern"),
]
REGION_OTHERWISE = "Unknown"

# --- FIXED VALUES: Thai region names -> region code (crosswalk for dim_reservoir) ---
REGION_TEXT_TO_CODE = {
    "ภาคกลาง": "C",
    "ภาคตะวันออก": "E",
    "ภาคตะวันออกเฉียงเหนือ": "NE",
    "ภาคเหนือ": "N",
    "ภาคตะวันตก": "W",
    "ภาคใต้": "S",
}

# --- FIXED VALUES: Thai month names, January..December ---
THAI_MONTHS = [
    "มกราคม", "กุมภาพันธ์", "มีนาคม", "เมษายน", "พฤษภาคม", "มิถุนายน",
    "กรกฎาคม", "สิงหาคม", "กันยายน", "ตุลาคม", "พฤศจิกายน", "ธันวาคม",
]
BUDDHIST_ERA_OFFSET = 543
DIM_DATE_START = "2020-01-01"
DIM_DATE_END = "2026-12-31"

# --- FIXED VALUES: feature and key parameters ---
LOOKBACK_DAYS = 7                # features window: D-6 .. D
DAYS_TO_FULL_CAP = 365.0
NET_FLOW_EPSILON = 0.001
WIND_MS_TO_KMH = 3.6

# --- FIXED VALUES: data-quality rules on Silver reservoir ---
DQ_NOT_NULL_FIELDS = ["reservoir_id", "record_date", "percent_storage"]
DQ_UNIQUE_KEY = ["reservoir_id", "record_date", "source"]
# (column, low, high, critical)
DQ_RANGES = [
    ("percent_storage", 0.0, 100.0, True),
    ("volume_mcm", 0.0, 99999.0, True),
    ("inflow_mcm", -10.0, 9999.0, False),
    ("outflow_mcm", -10.0, 9999.0, False),
]
