"""Helpers shared by the operators that read whole texts in Arrow batches.

Words here are runs of bytes. UTF-8 keeps ASCII bytes out of longer characters, so
splitting and lower-casing bytes treats ASCII only and leaves every other character
whole, which is what the operators ask for.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sondage.session import shared_folder

#: Lower-cases A-Z and turns every other ASCII character but digits into a space.
ALPHANUMERIC = bytes(
    c if c >= 128 or chr(c) in string.ascii_lowercase + string.digits else ord(chr(c).lower()) if chr(c) in string.ascii_uppercase else 32
    for c in range(256)
)


def alphanumeric_words(text: bytes) -> list[bytes]:
    """Words of lower-case letters, digits and characters outside ASCII."""
    return text.translate(ALPHANUMERIC).split()


def space_words(text: bytes) -> list[bytes]:
    """Lower-cased words between spaces and the control characters 9 to 13."""
    return text.lower().split()


def with_text_bytes(frame: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The named columns and the text as bytes under ``text``; a null text is empty."""
    return frame.select(*[F.col(c) for c in columns], F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))


def whole_rows(docs: DataFrame, text: str, *more: str) -> DataFrame:
    """``_row`` with all columns, and the text and other columns named, under names nothing else has."""
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), *[F.col(c).alias(f"_{k}") for k, c in (("text", text), *((m, m) for m in more))])


def found_in(text: Column, ddl: str, make: Callable[[], Callable[[list[bytes]], list[dict]]]) -> Column:
    """A struct for each text, by a function of lists of texts that ``make`` builds once per task.

    Only the texts cross to Python; the other columns of a row wait for them in Spark. A
    null text is empty.
    """
    kind = pa.struct(to_arrow_schema(StructType.fromDDL(ddl)))

    @F.arrow_udf(StructType.fromDDL(ddl))
    def find(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = make()
        for texts in columns:
            yield pa.array(judge(texts.to_pylist()), kind)

    return find(F.coalesce(text, F.lit("")).cast("binary"))


def unpacked(frame: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The columns of ``_row``, some of them changed."""
    return frame.select(*[changed[c].alias(c) if c in changed else F.col("_row")[c].alias(c) for c in columns])


def schema_with(frame: DataFrame, more: str) -> StructType:
    """The columns of a frame but ``text``, and more by their definition."""
    return StructType([f for f in frame.schema if f.name != "text"] + StructType.fromDDL(more).fields)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return batch.column(name).to_pylist()


def rows_of(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each batch that has rows, with its texts."""
    for batch in batches:
        if batch.num_rows:
            yield batch, texts_of(batch, name)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def kept_table(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read again: cuts the lineage, outlives executors."""
    import uuid

    spark: SparkSession = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def remainder_of_id(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(divisor)


def smallest_hashes(frame: DataFrame, most: int, *keys: str) -> DataFrame:
    """At most ``most`` rows, those of smallest hash of the keys, the same at each run.

    The rows are counted and all but about twice as many are left out by their hash
    before any are ordered, so that what meets in one task does not grow with the frame.
    """
    share = 2 * (most + 100) / max(1, frame.count())
    hashed = F.xxhash64(*[F.col(k) for k in keys])
    low = frame if share >= 1 else frame.where(hashed < F.lit(int((2 * share - 1) * 2**63)))
    return low.orderBy(hashed, *keys).limit(most)
