"""S-03 / S-04: staging CSV files (no header, quoted fields that may hold line
breaks and JSON), read with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# PostgreSQL CSV: NULL is an unquoted empty field, an empty string is a quoted "".
# Writing: Spark quotes empty strings and leaves NULL unquoted; fields with
# quotes or line breaks are quoted. Reading: a nullValue that no field can hold
# (PostgreSQL text has no U+0000) keeps a quoted "" as an empty string, an unquoted
# empty field is NULL. Blanks around a value belong to it.
CSV_OPTS = {"header": "false", "quote": '"', "escape": '"', "multiLine": "true",
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
READ_OPTS = {**CSV_OPTS, "nullValue": "\u0000", "emptyValue": ""}


def write_stage_csv(df: DataFrame, path: str, chunk_rows: int = 50_000) -> int:
    """S-04: write ``df`` as CSV files of at most ``chunk_rows`` rows; return the row count."""
    obs = Observation(f"csv-{abs(hash(path))}")
    (df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
     .option("maxRecordsPerFile", chunk_rows).options(**CSV_OPTS).csv(path))
    return int(obs.get.get("rows", 0))


def read_stage_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """S-03: read staging CSV with the declared schema (unknown columns refused by the schema)."""
    return spark.read.schema(schema).options(**READ_OPTS).option("mode", "FAILFAST").csv(path)
