"""Seeds (small curated dimensions): loaders and the shipped values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from odoflow.schemas import DIVISION_LABEL_SCHEMA, STATION_LABEL_SCHEMA


def load_seed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """IO12: a seed CSV with a header and a declared schema (lower-cased names)."""
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return df.toDF(*[f.name.lower() for f in schema.fields])


def _by_name(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    return df.toDF(*[c.strip().lower() for c in df.columns])


def load_station_map(spark: SparkSession, path: str) -> DataFrame:
    """Station dimension CSV (any extra columns ignored), columns picked by name."""
    df = _by_name(spark, path)
    return df.select(
        "station", "stop_name", "daytime_routes", "borough",
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
        "cbd",
    )


def load_borough_map(spark: SparkSession, path: str) -> DataFrame:
    """Borough dimension CSV: borough code and description."""
    return _by_name(spark, path).select("borough", "borough_desc")


def seed_frame(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """IO8: literal rows as a DataFrame (size known when built)."""
    return spark.createDataFrame(rows, schema)


def station_labels(spark: SparkSession) -> DataFrame:
    return seed_frame(spark, STATION_LABELS, STATION_LABEL_SCHEMA)


def division_labels(spark: SparkSession) -> DataFrame:
    return seed_frame(spark, DIVISION_LABELS, DIVISION_LABEL_SCHEMA)


# Division suffix seed (division_src -> division_dest).
DIVISION_LABELS: list[tuple[str, str]] = [
    ("PTH", "-PATH"),
    ("SRT", "-SIR"),
]

# Station relabel seed (STATION-LINENAME -> merged station key).
STATION_LABELS: list[tuple[str, str]] = [
    ("14 ST-FLM123", "14 ST-123FLM"),
    ("14 ST-UNION SQ-LNQR456W", "14 ST-UNION SQ-456LNQRW"),
    ("161/YANKEE STAD-BD4", "161/YANKEE STAD-4BD"),
    ("168 ST-AC1", "168 ST-1AC"),
    ("34 ST-PENN STA-123ACE", "34 ST-PENN STA-123"),
    ("42 ST-PORT AUTH-ACENGRS1237W", "TIMES SQ-42 ST-1237ACENQRSW"),
    ("42 ST-PORT AUTH-ACENQRS1237W", "TIMES SQ-42 ST-1237ACENQRSW"),
    ("4AV-9 ST-DFGMNR", "4 AV-9 ST-DFGMNR"),
    ("5 AVE-7BDFM", "42 ST-BRYANT PK-BDFM7"),
    ("59 ST-NQR456W", "59 ST-456NQRW"),
    ("59 ST COLUMBUS-ABCD1", "59 ST COLUMBUS-1ABCD"),
    ("6 AV-FLM123", "14 ST-123FLM"),
    ("74 ST-BROADWAY-7EFMR", "JKSN HT-ROOSVLT-EFMR7"),
    ("8 AV-ACEL", "14 ST-ACEL"),
    ("ATL AV-BARCLAY-BDNQR2345", "ATL AV-BARCLAY-2345BDNQR"),
    ("BOROUGH HALL-R2345", "BOROUGH HALL-2345R"),
    ("BOTANIC GARDEN-S2345", "FRANKLIN AV-2345S"),
    ("COURT SQ-23 ST-EMG", "COURT SQ-EMG"),
    ("FULTON ST-ACJZ2345", "FULTON ST-2345ACJZ"),
    ("JFK JAMAICA CT1-E", "JAMAICA CENTER-EJZ"),
    ("ORCHARD BEACH-6", "PELHAM BAY PARK-6"),
    ("PATH WTC 2-1", "PATH NEW WTC-1"),
    ("TIMES SQ-42 ST-1237ACENQRS", "TIMES SQ-42 ST-1237ACENQRSW"),
    ("TIMES SQ-42 ST-ACENQRS1237W", "TIMES SQ-42 ST-1237ACENQRSW"),
]

# Stations excluded by the canonical staging (PATH stations in New Jersey).
EXCLUDED_STATIONS: tuple[str, ...] = (
    "CITY / BUS",
    "EXCHANGE PLACE",
    "GROVE STREET",
    "HARRISON",
    "JOURNAL SQUARE",
    "LACKAWANNA",
    "NEWARK BM BW",
    "NEWARK C",
    "NEWARK HM HE",
    "NEWARK HW BMEBE",
    "PAVONIA/NEWPORT",
)

# The script variant's station fixes (after the division suffix).
V1_STATION_FIXES: dict[str, str] = {
    "14 ST-UNION SQ-LNQR456W": "14 ST-UNION SQ-456LNQRW",
    "161/YANKEE STAD-BD4": "161/YANKEE STAD-4BD",
    "34 ST-PENN STA-123": "34 ST-PENN STA-123ACE",
    "34 ST-PENN STA-ACE": "34 ST-PENN STA-123ACE",
    "42 ST-PORT AUTH-ACENGRS1237W": "42 ST-PORT AUTH-ACENQRS1237W",
    "59 ST-NQR456W": "59 ST-456NQRW",
    "59 ST-NRW": "59 ST-456NQRW",
    "59 ST COLUMBUS-ABCD1": "59 ST COLUMBUS-1ABCD",
    "ATL AV-BARCLAY-BDNQR2345": "ATL AV-BARCLAY-2345BDNQR",
    "BOROUGH HALL-R2345": "BOROUGH HALL-2345R",
    "COURT SQ-23 ST-EMG": "COURT SQ-EMG",
    "FULTON ST-ACJZ2345": "FULTON ST-2345ACJZ",
    "GUN HILL RD-5": "GUN HILL RD-25",
    "PATH WTC 2-PTH-1": "PATH NEW WTC-PTH-1",
    "PELHAM PKWY-5": "PELHAM PKWY-25",
}

# Central-business-district stations (Manhattan below 63 St) for the central-area trend.
CENTRAL_STATIONS: tuple[str, ...] = (
    "1 AV-L", "14 ST-123FLM", "14 ST-ACEL", "14 ST-UNION SQ-456LNQRW", "14TH STREET-1", "18 ST-1", "2 AV-F",
    "23 ST-1", "23 ST-6", "23 ST-CE", "23 ST-FM", "23 ST-NRW", "28 ST-1", "28 ST-6", "28 ST-NRW", "3 AV-L",
    "33 ST-6", "34 ST-HERALD SQ-BDFMNQRW", "34 ST-HUDSON YD-7", "34 ST-PENN STA-123", "34 ST-PENN STA-123ACE",
    "34 ST-PENN STA-ACE", "42 ST-BRYANT PK-7BDFM", "42 ST-PORT AUTH-1237ACEGNRSW", "42 ST-PORT AUTH-1237ACENQRSW",
    "47-50 STS ROCK-BDFM", "49 ST-NQRW", "5 AV/53 ST-EM", "5 AV/59 ST-NQRW", "5 AVE-7BDFM", "50 ST-1", "50 ST-CE",
    "50 ST-D", "51 ST-6", "57 ST-7 AV-NQRW", "57 ST-F", "59 ST COLUMBUS-1ABCD", "59 ST-456NQRW", "59 ST-NRW",
    "6 AV-123FLM", "7 AV-BDE", "8 AV-ACEL", "8 ST-NYU-NRW", "9TH STREET-1", "ASTOR PL-6", "B'WAY-LAFAYETTE-6BDFQ",
    "BLEECKER ST-6DF", "BOWLING GREEN-45", "BROAD ST-JZ", "BROOKLYN BRIDGE-456JZ", "CANAL ST-1", "CANAL ST-6JNQRWZ",
    "CANAL ST-ACE", "CHAMBERS ST-123", "CHAMBERS ST-23ACE", "CHAMBERS ST-456JZ", "CHRISTOPHER ST-1", "CITY HALL-NRW",
    "CORTLANDT ST-NRW", "DELANCEY/ESSEX-FJMZ", "EAST BROADWAY-F", "EXCHANGE PLACE-1", "FRANKLIN ST-1",
    "FULTON ST-2345ACJZ", "GRAND ST-BD", "GRD CNTRL-42 ST-4567S", "HOUSTON ST-1", "LEXINGTON AV/53-6EM",
    "LEXINGTON AV/63-F", "PARK PLACE-23ACE", "PATH NEW WTC-1", "PATH WTC 2-1", "PRINCE ST-NRW", "RECTOR ST-1",
    "RECTOR ST-NRW", "SOUTH FERRY-1RW", "SPRING ST-6", "SPRING ST-CE", "TIMES SQ-42 ST-1237ACENQRS",
    "TIMES SQ-42 ST-1237ACENQRSW", "TWENTY THIRD ST-1", "W 4 ST-WASH SQ-ABCDEFM", "WALL ST-23", "WALL ST-45",
    "WHITEHALL S-FRY-1RW", "WORLD TRADE CTR-23ACE", "WTC-CORTLANDT-1",
)
