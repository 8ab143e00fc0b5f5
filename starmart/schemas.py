"""Explicit schemas, rename maps and key lists of the four inputs and the star.

Column names of the sources follow the data dictionaries of the original
files; the star uses the snake_case names of the model.
"""

from __future__ import annotations

from pyspark.sql import types as T

D, S, I = T.DoubleType(), T.StringType(), T.IntegerType()

# Immigration events (28 columns in the source; every numeric is a SAS double).
ARRIVALS = T.StructType([
    T.StructField("cicid", D), T.StructField("i94yr", D), T.StructField("i94mon", D),
    T.StructField("i94cit", D), T.StructField("i94res", D), T.StructField("i94port", S),
    T.StructField("arrdate", D), T.StructField("i94mode", D), T.StructField("i94addr", S),
    T.StructField("depdate", D), T.StructField("i94bir", D), T.StructField("i94visa", D),
    T.StructField("count", D), T.StructField("dtadfile", S), T.StructField("visapost", S),
    T.StructField("occup", S), T.StructField("entdepa", S), T.StructField("entdepd", S),
    T.StructField("entdepu", S), T.StructField("matflag", S), T.StructField("biryear", D),
    T.StructField("dtaddto", S), T.StructField("gender", S), T.StructField("insnum", S),
    T.StructField("airline", S), T.StructField("admnum", D), T.StructField("fltno", S),
    T.StructField("visatype", S),
])

TEMPERATURES = T.StructType([
    T.StructField("dt", T.DateType()), T.StructField("AverageTemperature", D),
    T.StructField("AverageTemperatureUncertainty", D), T.StructField("City", S),
    T.StructField("Country", S), T.StructField("Latitude", S), T.StructField("Longitude", S),
])

DEMOGRAPHICS = T.StructType([
    T.StructField("City", S), T.StructField("State", S), T.StructField("Median Age", D),
    T.StructField("Male Population", I), T.StructField("Female Population", I),
    T.StructField("Total Population", I), T.StructField("Number of Veterans", I),
    T.StructField("Foreign-born", I), T.StructField("Average Household Size", D),
    T.StructField("State Code", S), T.StructField("Race", S), T.StructField("Count", I),
])

COUNTRY_MAPPING = T.StructType([T.StructField("code", I), T.StructField("Name", S)])

# Column names and column lists that must equal those of the
# original job (sources' data dictionaries and its cleaning and model steps).

# Columns found >90% empty in the source events; dropped by the cleaning step.
SPARSE_ARRIVAL_COLUMNS = ("occup", "entdepu", "insnum")

# Columns of the events that the star's tables are made of.
REQUIRED_ARRIVAL_COLUMNS = ("cicid", "i94res", "arrdate", "i94addr", "count", "visatype")

TEMPERATURE_KEYS = ("dt", "City", "Country")
DEMOGRAPHICS_KEYS = ("City", "State", "State Code", "Race")
DEMOGRAPHICS_MEASURES = ("Number of Veterans", "Male Population", "Female Population",
                         "Foreign-born", "Average Household Size")

FACT_RENAMES = {"cicid": "record_id", "i94res": "country_residence_code",
                "i94addr": "state_code"}

DEMOGRAPHICS_RENAMES = {
    "Median Age": "median_age", "Female Population": "female_population",
    "Male Population": "male_population", "Foreign-born": "foreign_born",
    "State Code": "state_code", "Total Population": "total_population",
    "Number of Veterans": "number_of_veterans",
    "Average Household Size": "average_household_size",
}

CALENDAR_PARTITIONS = ("arrival_year", "arrival_month", "arrival_week")
