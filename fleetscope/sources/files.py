"""File readers and writers (Parquet, CSV) and newest-snapshot selection."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from fleetscope.session import checkpoint_dir

TS_TEXT = "yyyy-MM-dd HH:mm:ss"  # timestamp text format of CSV files (second precision)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/fleetscope-scratch/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage for multi-pass plans (a lost executor recomputes from the
    files, not from the source), and later passes get column pruning and
    filter pushdown on the written table.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Columnar scan; selected columns become the Parquet ReadSchema, filters are pushed down."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet sink (optionally partitioned by columns)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; timestamps as 'yyyy-MM-dd HH:mm:ss'; NULL as an empty field."""
    (df.write.mode(mode).option("header", True)
       .option("timestampNTZFormat", TS_TEXT).option("timestampFormat", TS_TEXT)
       .csv(path))


CORRUPT = "_corrupt_record"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, corrupt: bool = False,
             tag: Column | None = None) -> DataFrame:
    """CSV with a header, read by column name into ``schema`` (declared, never inferred).

    The columns may stand in any order and others are ignored; a missing one
    is an error, and so are files of one path whose headers differ.  A row that
    does not fit the types is kept with NULLs; with ``corrupt`` its text is in
    ``_corrupt_record`` (NULL for sound rows), so a caller can count it; a row is
    found corrupt in the columns that a query reads.  ``tag``
    is one more column, which may use the scan's ``_metadata``.
    """
    base = (spark.read.option("header", True).option("timestampNTZFormat", TS_TEXT).option("timestampFormat", TS_TEXT))
    names = base.option("inferSchema", False).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")
    known = {f.name: f.dataType for f in schema.fields}
    declared = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])
    if corrupt:
        declared = declared.add(CORRUPT, T.StringType())
    df = (base.schema(declared).option("enforceSchema", False).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return df.select(*schema.fieldNames(), *([CORRUPT] if corrupt else []), *([tag] if tag is not None else []))


def read_report_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A report written by ``write_csv``; None when it is missing or has no rows."""
    try:
        df = read_csv(spark, path, schema)
    except (AnalysisException, ValueError):  # missing path, or a file without a header
        return None
    return None if df.isEmpty() else df


def newest_path(spark: SparkSession, folder: str, stem: str, suffix: str) -> str | None:
    """The newest snapshot ``folder/stem*suffix``: one file, or one folder of part files.

    Lists files only (the content column of the scan is pruned away).  A folder
    counts with its newest file, and a snapshot without rows counts like any
    other; of equally new ones the last by name is taken.
    """
    folder = folder.rstrip("/")
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .load(f"{folder}/{stem}*{suffix}").select("path", "modificationTime"))
    except AnalysisException:  # nothing matches
        return None
    base = folder.rsplit("/", 1)[-1]
    below = F.substring_index(F.col("path"), f"/{base}/{stem}", -1)
    name = F.concat(F.lit(stem), F.regexp_extract(below, f"^(.*?{re.escape(suffix)})(/|$)", 1))
    found = (files.groupBy(name.alias("name")).agg(F.max("modificationTime").alias("at"))
             .orderBy(F.desc("at"), F.desc("name")).first())
    return f"{folder}/{found['name']}" if found else None


def latest_of(spark: SparkSession, folder: str, stem: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows of the newest ``stem*.parquet`` in ``folder``; of the newest ``stem*.csv`` when there is none.

    Only the chosen snapshot is read.  A CSV is read by its header into
    ``schema``.  Raises FileNotFoundError when nothing matches.
    """
    if path := newest_path(spark, folder, stem, ".parquet"):
        return spark.read.parquet(path)
    if path := newest_path(spark, folder, stem, ".csv"):
        if schema is None:
            raise ValueError("a CSV snapshot needs a schema")
        return read_csv(spark, path, schema)
    raise FileNotFoundError(f"no {stem}*.parquet or {stem}*.csv in {folder}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this job wrote, through the file system that Spark uses for it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)
