"""Names, codes and limits that must equal those of the landed data and its reports."""

# Month names of the date dimension.
MONTH_NAMES = [
    "Januar", "Februar", "Mars", "April", "Mai", "Juni",
    "Juli", "August", "September", "Oktober", "November", "Desember",
]
MONTH_SHORT_NAMES = ["Jan", "Feb", "Mar", "Apr", "Mai", "Jun", "Jul", "Aug", "Sep", "Okt", "Nov", "Des"]

# Seasons for Dec-Feb, Mar-May, Jun-Aug, Sep-Nov.
SEASONS = ["Vinter", "Vår", "Sommer", "Høst"]

# Area kinds of the weekly level source and their codes.
AREA_CODES = {"EL": "NO{nr}", "NO": "NOR"}
TOTAL_AREA = "NOR"
AREA_KIND = "EL"
AREA_TYPE = "Elspotområde"
TOTAL_AREA_ROW = {
    "area_code": "NOR",
    "area_name": "Norge",
    "area_long_name": "Hele landet",
    "description": "Sum av alle elspotområder",
    "area_type": "Nasjonalt",
    "sort_order": 0,
}

# Gridded daily series.
GRID_THEME = "rr"
GRID_START_PATTERN = "dd.MM.yyyy HH:mm:ss"
GRID_MINUTES_PER_STEP = 1440
GRID_SOURCE_LABEL = "NVE seNorge (grid 1x1 km)"

# Station observations.
OBSERVATION_ELEMENT = "sum(precipitation_amount P1D)"
OBSERVATION_OFFSET = "PT6H"
STATION_SOURCE_LABEL = "MET Frost (station)"

# Thresholds and report limits.
WET_DAY_MM = 1.0
FULL_MONTH_DAYS = 28
TOP_IN_YEAR = 5
TOP_ALL_TIME = 10

# Change lenses and direction labels.
METRIC_LEVEL_1W = "fill_1w"
METRIC_LEVEL_4W = "fill_4w"
METRIC_AMOUNT_1W = "precip_1w"
METRIC_AMOUNT_4W = "precip_4w"
DIRECTION_UP = "Økning"
DIRECTION_DOWN = "Nedgang"
DIRECTION_AMOUNT = "Nedbør"

# Layout of the landing folder and the seed folder.
LEVEL_FILE = "nve/magasin.json"
BENCHMARK_FILE = "nve/minmaxmedian.json"
AREA_FILE = "nve/omrader.json"
GRID_FILES = "nve_gts/*.json"
STATION_FILE = "frost/sources.json"
OBSERVATION_FILES = "frost/observations/*.json"
POINT_SEED_FILE = "precip_points.csv"
STATION_SEED_FILE = "station_area.csv"

# Column order of the exported series.
EXPORT_COLUMNS = {
    "weekly": [
        "week_end_date", "iso_year", "iso_week", "fill_pct", "fill_twh", "capacity_twh", "week_change_pp",
        "hist_min_pct", "hist_median_pct", "hist_max_pct", "precip_week_mm",
    ],
    "monthly": ["year", "month", "precip_mm", "normal_mm", "wet_days", "max_day_mm", "is_partial_month"],
    "yearly": [
        "year", "avg_fill_pct", "max_fill_pct", "max_fill_week", "min_fill_pct", "min_fill_week",
        "max_week_increase_pp", "max_week_decrease_pp", "total_precip_mm", "max_day_precip_mm",
        "max_day_precip_date", "wet_days", "precip_ytd_mm", "precip_ytd_yoy_pct", "avg_fill_yoy_pp",
    ],
    "changes": [
        "metric", "iso_year", "iso_week", "window_start", "week_end_date", "value", "rank_in_year", "rank_all_time",
    ],
}
EXPORT_AREA_COLUMNS = [
    "code", "name", "long_name", "description", "station", "station_id", "elevation_m", "precip_source",
]
