"""Table contracts and fixed values.

The values in the FIXED VALUES block must equal the source data conventions
for results to match (file headers, table columns, city coordinates,
workload constants). They are listed plainly, in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the source data conventions)
# ---------------------------------------------------------------------------

# Target column names of the consumption table, in file order.
CONSUMPTION_HEADERS = [
    "Périmètre", "Nature", "Date", "Heures", "Consommation", "Prévision_J_1", "Prévision_J",
    "Fioul", "Charbon", "Gaz", "Nucléaire", "Eolien", "Solaire", "Hydraulique", "Pompage",
    "Bioénergies", "Ech_physiques", "Taux_de_Co2", "Ech_comm_Angleterre", "Ech_comm_Espagne",
    "Ech_comm_Italie", "Ech_comm_Suisse", "Ech_comm_Allemagne_Belgique", "Fioul_TAC",
    "Fioul_Cogén", "Fioul_Autres", "Gaz_TAC", "Gaz_Cogén", "Gaz_CCG", "Gaz_Autres",
    "Hydraulique_Fil_de_leau_Eclusée", "Hydraulique_Lacs", "Hydraulique_STEP_turbinage",
    "Bioénergies_Déchets", "Bioénergies_Biomasse", "Bioénergies_Biogaz", "Stockage_batterie",
    "Déstockage_batterie", "Eolien_terrestre", "Eolien_offshore",
]

# Columns of the consumption table: the headers above under the table layer's spelling (PRJ-03).
CONSUMPTION_COLUMNS = [
    "périmètre", "nature", "date", "heures", "consommation", "prévision_j_1", "prévision_j",
    "fioul", "charbon", "gaz", "nucléaire", "eolien", "solaire", "hydraulique", "pompage",
    "bioénergies", "ech_physiques", "taux_de_co2", "ech_comm_angleterre", "ech_comm_espagne",
    "ech_comm_italie", "ech_comm_suisse", "ech_comm_allemagne_belgique", "fioul_tac", "fioul_cogén",
    "fioul_autres", "gaz_tac", "gaz_cogén", "gaz_ccg", "gaz_autres",
    "hydraulique_fil_de_leau_eclusée", "hydraulique_lacs", "hydraulique_step_turbinage",
    "bioénergies_déchets", "bioénergies_biomasse", "bioénergies_biogaz", "stockage_batterie",
    "déstockage_batterie", "eolien_terrestre", "eolien_offshore",
]

# Columns of the consumption table kept as text; every other one is an integer.
CONSUMPTION_TEXT_COLUMNS = ["périmètre", "nature", "date", "heures", "stockage_batterie"]

# Key of the consumption table (insert-if-absent).
CONSUMPTION_KEY = ["périmètre", "date", "heures"]

# File extensions the loader accepts (case-insensitive); content is always
# parsed as delimited text.
SUPPORTED_EXTENSIONS = [".csv", ".xls", ".xlsx"]

# Separator candidates, in priority order (first wins a tie).
SEPARATOR_CANDIDATES = [";", ",", "\t"]

# Cell text that stands for a missing reading.
MISSING_SENTINEL = "ND"

# Spellings read as missing by the delimited reader (in addition to empty).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Identifier columns dropped before training.
IDENTIFIER_COLUMNS = ["perimetre", "nature", "source_file", "date", "heures", "datetime"]

# Accepted timestamp layouts for `date + ' ' + heures`, tried in order.
# Slash dates are read day first.
TIMESTAMP_FORMATS = [
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd HH:mm:ss",
    "dd/MM/yyyy HH:mm",
    "dd/MM/yyyy HH:mm:ss",
]

# Weekday numbers (Monday = 0) counted as weekend.
WEEKEND_DAYS = [5, 6]

# Weather cities with latitude and longitude.
CITIES = [
    ("Paris", 48.8566, 2.3522),
    ("Marseille", 43.2965, 5.3698),
    ("Bordeaux", 44.8378, -0.5792),
    ("Brest", 48.3904, -4.4861),
    ("Clermont-Ferrand", 45.7772, 3.0870),
    ("Dijon", 47.3220, 5.0415),
    ("Grenoble", 45.1885, 5.7245),
    ("Lille", 50.6292, 3.0573),
    ("Metz", 49.1193, 6.1757),
    ("Montpellier", 43.6108, 3.8767),
    ("Toulon", 43.1242, 5.9280),
    ("Nancy", 48.6921, 6.1844),
    ("Nantes", 47.2184, -1.5536),
    ("Nice", 43.7102, 7.2620),
    ("Orléans", 47.9029, 1.9093),
    ("Rennes", 48.1173, -1.6778),
    ("Rouen", 49.4431, 1.0993),
    ("Saint-Etienne", 45.4397, 4.3872),
    ("Strasbourg", 48.5734, 7.7521),
    ("Toulouse", 43.6047, 1.4442),
    ("Tours", 47.3941, 0.6848),
]

# Hourly weather variables, in the order they arrive.
WEATHER_VARIABLES = [
    "temperature_2m", "relative_humidity_2m", "snowfall", "precipitation", "weather_code",
]

# Workload constants of the training run.
FOREST_TREES = 200
FOREST_SEED = 42
NEIGHBOURS = 7
TEST_SHARE = 0.2
MAPE_EPSILON = 1e-9
NO_MODEL_SCORE = -999.0
FIRST_DATA_YEAR = 2012
TARGET = "consommation"

# City location table: column and maximum length.
CITY_LOCATION_COLUMNS = [
    ("insee_code", 10), ("city_code", 50), ("zip_code", 10), ("label", 50),
    ("latitude", 50), ("longitude", 50), ("department_name", 100),
    ("department_number", 10), ("region_name", 100), ("region_geojson_name", 100),
]

# ---------------------------------------------------------------------------
# Derived contracts
# ---------------------------------------------------------------------------

CONSUMPTION_INT_COLUMNS = [c for c in CONSUMPTION_COLUMNS if c not in CONSUMPTION_TEXT_COLUMNS]

CONSUMPTION_TABLE_SCHEMA = T.StructType([
    T.StructField(c, T.StringType() if c in CONSUMPTION_TEXT_COLUMNS else T.IntegerType(), True)
    for c in CONSUMPTION_COLUMNS
])

WEATHER_DAILY_SCHEMA = T.StructType([
    T.StructField("db_id", T.StringType(), False),
    T.StructField("dt", T.LongType(), False),
    T.StructField("min_temp", T.FloatType(), True),
    T.StructField("max_temp", T.FloatType(), True),
    T.StructField("min_humidity", T.IntegerType(), True),
    T.StructField("max_humidity", T.IntegerType(), True),
    T.StructField("precipitation", T.FloatType(), True),
    T.StructField("uv", T.IntegerType(), True),
    T.StructField("weather_icon", T.StringType(), True),
    T.StructField("weather_desc", T.StringType(), True),
    T.StructField("sunrise", T.LongType(), True),
    T.StructField("sunset", T.LongType(), True),
    T.StructField("latitude", T.FloatType(), True),
    T.StructField("longitude", T.FloatType(), True),
    T.StructField("city", T.StringType(), True),
])

CITY_LOCATION_SCHEMA = T.StructType([
    T.StructField(name, T.StringType(), True) for name, _ in CITY_LOCATION_COLUMNS
])

# One row per city: start, exclusive end and step in seconds, one array per variable.
WEATHER_BLOCK_SCHEMA = T.StructType(
    [T.StructField("city", T.StringType(), True),
     T.StructField("time", T.LongType(), True),
     T.StructField("time_end", T.LongType(), True),
     T.StructField("interval", T.IntegerType(), True)]
    + [T.StructField(v, T.ArrayType(T.FloatType()), True) for v in WEATHER_VARIABLES]
)

REGISTRY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("version", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("created", T.TimestampType(), False),
])

CITY_SCHEMA = T.StructType([
    T.StructField("city", T.StringType(), False),
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
])
