"""Reading exports with a fixed schema, merging their encodings, writing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import quoted
from ..operators.columns import pick

SCORE_TABLE = T.StructType(
    [
        T.StructField("Raw Summed Score", T.IntegerType()),
        T.StructField("T-Score", T.DoubleType()),
        T.StructField("SE", T.DoubleType()),
    ]
)

EHR_LONG = T.StructType(
    [
        T.StructField("arb_person_id", T.StringType()),
        T.StructField("flowsheet_row_name", T.StringType()),
        T.StructField("VALUE", T.StringType()),
        T.StructField("observation_date", T.StringType()),
    ]
)

EHR_DEMOGRAPHICS = T.StructType(
    [
        T.StructField(n, T.StringType())
        for n in (
            "Pt_MDC", "Pt_Age", "Pt_Sex", "Pt_Gender", "Pt_Ethnicity", "Pt_Race", "Pt_language",
            "Pt_Insurance_type",
        )
    ]
)

EHR_DICTIONARY = T.StructType(
    [T.StructField("Row Name", T.StringType()), T.StructField("Row Display Name", T.StringType())]
)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header. The schema is given, so the file is read once, and a
    header that disagrees with it is an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_export(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    record: str | None = None,
) -> DataFrame:
    """A survey export from CSV or Parquet; ``record`` names the id column, which
    becomes ``record_id``."""
    if path.endswith(".csv") or path.endswith(".csv.gz"):
        if schema is None:
            raise ValueError("a CSV export needs a schema")
        df = read_csv(spark, path, schema)
    else:
        reader = spark.read if schema is None else spark.read.schema(schema)
        df = reader.parquet(path)
    return df if record is None else df.withColumnRenamed(record, "record_id")


def write_table(
    df: DataFrame, path: str, kind: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Write a result table; a folder of part files, never a single collected file."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if kind == "parquet":
        writer.parquet(path)
    elif kind == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        raise ValueError("kind must be 'parquet' or 'csv'")


def merge_encodings(
    label: DataFrame, raw: DataFrame, keys: Sequence[str], from_raw: Sequence[str]
) -> DataFrame:
    """Take the listed columns from the raw export and the rest from the label
    export, in the label export's column order."""
    order = list(label.columns)
    wanted = [c for c in from_raw if c not in keys]
    left = pick(label, [c for c in order if c not in wanted])
    right = raw.select(*[F.col(quoted(c)) for c in [*keys, *wanted]])
    merged = left.join(right, list(keys), "left")
    return pick(merged, [*order, *[c for c in wanted if c not in order]])
