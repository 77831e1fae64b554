"""Helpers shared by the operators: tables, durable intermediates, bounded Arrow batches, words."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that are no part of a word become a space; A-Z become a-z; bytes from 0x80 stay.
WORD_BYTES = bytes(
    (b + 32) if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    Only a local master without that setting gets a temporary folder; a cluster without it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir")
        root = "file://" + tempfile.mkdtemp(prefix="fleetscope-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: the lineage ends there, and a lost executor loses nothing."""
    path = shared_dir(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes to differ from all columns of ``df``."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def rows_of(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch as dicts, one at a time: only one row's values are held besides the batch.

    Spark bounds a batch by bytes (``spark.sql.execution.arrow.maxBytesPerBatch``), so batches of few large rows need no setting.
    """
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]


def crc_mod(col: Column, m: int) -> Column:
    """crc32 of the id's decimal text, modulo m; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % m


def text_digest() -> Column:
    """md5 of the text as it is, null for a null text."""
    return F.unhex(F.md5(F.col("text").cast("string")))


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of digits, letters and non-ASCII characters, as UTF-8 bytes; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split() if text else []


def crc32(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF
