"""Declared schemas, one DDL string per table of the data model."""

# Column names and types of the staging and gold tables.
CALENDAR_STAGING = (
    "governorate string, condition string, high_temp_c decimal(5,2), low_temp_c decimal(5,2), "
    "weather_date date"
)
ARCHIVE_STAGING = (
    "governorate string, weather_date date, weather_code int, max_temp decimal(5,2), "
    "min_temp decimal(5,2), avg_humidity decimal(5,2), source string"
)
NORMALS_STAGING = (
    "metric_name string, jan string, feb string, mar string, apr string, may string, jun string, "
    "jul string, aug string, sep string, oct string, nov string, dec string, "
    "year_value string, source string"
)
REVISIONS = "revision_timestamp timestamp, user string, comment string, source string"
MONTHLY = (
    "Governorate string, Date date, Year int, Month int, Weather_Code double, Max_Temp double, "
    "Min_Temp double, Avg_Humidity double, Source string"
)

MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
CORE = ["governorate", "date", "avg_max_temp", "avg_min_temp", "avg_humidity"]
PLAUSIBLE = {"avg_max_temp": (-10, 60), "avg_min_temp": (-10, 60), "avg_humidity": (0, 100)}
MEAN_FILLED = [
    "high_temp_c", "max_temp", "low_temp_c", "min_temp",
    "std_max_temp", "std_min_temp", "range_max_temp", "range_min_temp",
]
TEXT_FILLED = ["condition", "user", "comment", "source"]
ML_DROPPED = [
    "source", "comment", "user", "revision_timestamp", "weather_code", "high_temp_c", "low_temp_c",
]
ML_FIRST = [
    "id", "governorate", "date", "year", "month", "day", "season", "avg_max_temp",
    "avg_min_temp", "avg_humidity", "temp_range", "heat_level", "condition",
]
ML_NUMERIC = [
    "avg_max_temp", "avg_min_temp", "avg_humidity", "temp_range", "max_temp", "range_max_temp",
    "min_temp", "range_min_temp", "std_max_temp", "std_min_temp",
]
ML_FEATURES = [
    "month", "day_of_year", "year", "city_encoded", "temp_range", "std_min_temp", "std_max_temp",
]
