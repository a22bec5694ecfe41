"""Declared schemas: raw readings, seeds and dimensions."""

from pyspark.sql import types as T

# Weekly reading file as it arrives (header names as in the file; the counter
# columns are renamed positionally to ENTRY_COUNTER / EXIT_COUNTER on load).
RAW_CSV_SCHEMA = T.StructType(
    [
        T.StructField("C/A", T.StringType()),
        T.StructField("UNIT", T.StringType()),
        T.StructField("SCP", T.StringType()),
        T.StructField("STATION", T.StringType()),
        T.StructField("LINENAME", T.StringType()),
        T.StructField("DIVISION", T.StringType()),
        T.StructField("DATE", T.DateType()),
        T.StructField("TIME", T.StringType()),
        T.StructField("DESC", T.StringType()),
        T.StructField("ENTRIES", T.IntegerType()),
        T.StructField("EXITS", T.IntegerType()),
    ]
)

RAW_COLUMNS = [
    "C/A", "UNIT", "SCP", "STATION", "LINENAME", "DIVISION",
    "DATE", "TIME", "DESC", "ENTRY_COUNTER", "EXIT_COUNTER",
]

RAW_SCHEMA = T.StructType(
    [T.StructField(n, f.dataType) for n, f in zip(RAW_COLUMNS, RAW_CSV_SCHEMA.fields)]
)

STATION_LABEL_SCHEMA = T.StructType(
    [T.StructField("station_src", T.StringType(), False), T.StructField("station_dest", T.StringType(), False)]
)
DIVISION_LABEL_SCHEMA = T.StructType(
    [T.StructField("division_src", T.StringType(), False), T.StructField("division_dest", T.StringType(), False)]
)
BOROUGH_MAP_SCHEMA = T.StructType(
    [T.StructField("borough", T.StringType(), False), T.StructField("borough_desc", T.StringType())]
)
STATION_MAP_SCHEMA = T.StructType(
    [
        T.StructField("station", T.StringType(), False),
        T.StructField("stop_name", T.StringType()),
        T.StructField("daytime_routes", T.StringType()),
        T.StructField("borough", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("cbd", T.StringType()),
    ]
)
