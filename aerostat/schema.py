"""Table schemas and fixed reference values shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

STATION = "station_id"
TIME = "timestamp"


def _table(keys: list[str], doubles: list[str]) -> T.StructType:
    fields = [T.StructField(k, T.StringType(), False) for k in keys]
    return T.StructType(fields + [T.StructField(d, T.DoubleType(), True) for d in doubles])


# Column order decides ties between equal sub-indices.
POLLUTANTS = ["pm2_5", "pm10", "no2", "so2", "co", "o3"]
WEATHER = ["temperature", "humidity", "wind_speed", "wind_direction", "pressure", "rainfall"]

READINGS_SCHEMA = _table([STATION, TIME], POLLUTANTS)
WEATHER_SCHEMA = _table([STATION, TIME], WEATHER)
STATIONS_SCHEMA = T.StructType(
    [
        T.StructField(STATION, T.StringType(), False),
        T.StructField("station_name", T.StringType(), True),
        T.StructField("city", T.StringType(), True),
        T.StructField("state", T.StringType(), True),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("elevation", T.DoubleType(), True),
        T.StructField("station_type", T.StringType(), True),
    ]
)
SCHEMAS = {
    "air_quality": READINGS_SCHEMA,
    "weather": WEATHER_SCHEMA,
    "stations": STATIONS_SCHEMA,
}
REQUIRED = {
    "air_quality": [STATION, TIME],
    "weather": [STATION, TIME],
    "stations": [STATION, "latitude", "longitude", "city"],
}

# Physically possible range of each measurement.
DOMAIN_LIMITS = {
    "pm2_5": (0.0, 1000.0),
    "pm10": (0.0, 1500.0),
    "no2": (0.0, 2000.0),
    "so2": (0.0, 2000.0),
    "co": (0.0, 100.0),
    "o3": (0.0, 500.0),
    "temperature": (-50.0, 60.0),
    "humidity": (0.0, 100.0),
    "wind_speed": (0.0, 150.0),
    "wind_direction": (0.0, 360.0),
    "pressure": (800.0, 1100.0),
    "rainfall": (0.0, 500.0),
}
IQR_MULTIPLIER = 3.0
ZSCORE_LIMIT = 3.5

# Streaming windows and alert thresholds.
WATERMARK = "10 minutes"
WINDOW = "10 minutes"
SLIDE = "5 minutes"
ALERT_THRESHOLDS = {
    "aqi_unhealthy": 150.0,
    "aqi_hazardous": 300.0,
    "pm2_5_spike": 100.0,
    "rate_of_change_pct": 50.0,
}

# Index ranges, then the concentration brackets they belong to.
EPA_INDEX = [(0, 50), (51, 100), (101, 150), (151, 200), (201, 300), (301, 400), (401, 500)]
CPCB_INDEX = [(0, 50), (51, 100), (101, 200), (201, 300), (301, 400), (401, 500)]
EPA_BRACKETS = {
    "pm2_5": [(0, 9), (9.1, 35.4), (35.5, 55.4), (55.5, 125.4), (125.5, 225.4), (225.5, 325.4), (325.5, 500.4)],
    "pm10": [(0, 54), (55, 154), (155, 254), (255, 354), (355, 424), (425, 504), (505, 604)],
    "no2": [(0, 53), (54, 100), (101, 360), (361, 649), (650, 1249), (1250, 1649), (1650, 2049)],
    "so2": [(0, 35), (36, 75), (76, 185), (186, 304), (305, 604), (605, 804), (805, 1004)],
    "co": [(0, 4.4), (4.5, 9.4), (9.5, 12.4), (12.5, 15.4), (15.5, 30.4), (30.5, 40.4), (40.5, 50.4)],
    "o3": [(0, 54), (55, 70), (71, 85), (86, 105), (106, 200), (201, 404), (405, 504)],
}
CPCB_BRACKETS = {
    "pm2_5": [(0, 30), (31, 60), (61, 90), (91, 120), (121, 250), (251, 350)],
    "pm10": [(0, 50), (51, 100), (101, 250), (251, 350), (351, 430), (431, 500)],
    "no2": [(0, 40), (41, 80), (81, 180), (181, 280), (281, 400), (401, 500)],
    "so2": [(0, 40), (41, 80), (81, 380), (381, 800), (801, 1600), (1601, 2000)],
    "co": [(0, 1), (1.1, 2), (2.1, 10), (10.1, 17), (17.1, 34), (34.1, 50)],
    "o3": [(0, 50), (51, 100), (101, 168), (169, 208), (209, 748), (749, 1000)],
}
# Category name, lowest index, highest index, colour, advice.
EPA_CATEGORIES = [
    ("Good", 0, 50, "#00E400", "Air quality is satisfactory, and air pollution poses little or no risk."),
    ("Moderate", 51, 100, "#FFFF00", "Air quality is acceptable. However, there may be a risk for some people."),
    (
        "Unhealthy for Sensitive Groups",
        101,
        150,
        "#FF7E00",
        "Members of sensitive groups may experience health effects.",
    ),
    ("Unhealthy", 151, 200, "#FF0000", "Some members of the general public may experience health effects."),
    ("Very Unhealthy", 201, 300, "#8F3F97", "Health alert: The risk of health effects is increased for everyone."),
    (
        "Hazardous",
        301,
        500,
        "#7E0023",
        "Health warning of emergency conditions: everyone is more likely to be affected.",
    ),
]
CPCB_CATEGORIES = [
    ("Good", 0, 50, "#00B050", ""),
    ("Satisfactory", 51, 100, "#92D050", ""),
    ("Moderate", 101, 200, "#FFFF00", ""),
    ("Poor", 201, 300, "#FF9900", ""),
    ("Very Poor", 301, 400, "#FF0000", ""),
    ("Severe", 401, 500, "#C00000", ""),
]
# Advice for indices that no category covers.
CATEGORY_UNKNOWN = ("Unknown", "#808080", "Insufficient data to compute AQI.")
CATEGORY_UNMATCHED = ("Unknown", "#808080", "No matching AQI bracket.")
CATEGORY_BEYOND = (
    "Hazardous (Extreme)",
    "#7E0023",
    "Emergency conditions: critical health risk to the entire population.",
)

STANDARDS = {
    "US_EPA": (EPA_INDEX, EPA_BRACKETS, EPA_CATEGORIES),
    "INDIA_CPCB": (CPCB_INDEX, CPCB_BRACKETS, CPCB_CATEGORIES),
}


def brackets(standard: str, pollutant: str) -> list[tuple[float, float, float, float]]:
    """``(c_lo, c_hi, i_lo, i_hi)`` rows of one pollutant, ascending."""
    index, table, _ = _standard(standard)
    return [
        (float(c_lo), float(c_hi), float(i_lo), float(i_hi))
        for (c_lo, c_hi), (i_lo, i_hi) in zip(table[pollutant], index)
    ]


def categories(standard: str) -> list[tuple[str, float, float, str, str]]:
    return [(n, float(lo), float(hi), colour, text) for n, lo, hi, colour, text in _standard(standard)[2]]


def _standard(name: str):
    if name not in STANDARDS:
        raise ValueError(f"unknown air-quality standard {name!r}; known: {sorted(STANDARDS)}")
    return STANDARDS[name]
