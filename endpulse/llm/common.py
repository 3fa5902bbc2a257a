"""What several operators share: row identity, shared storage, safe column access."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

KEY = "__key"


def row_key(*columns: str | Column) -> Column:
    """64 bits that stand for a row's values (nulls count as a value of their own)."""
    parts = [F.col(f"`{c}`") if isinstance(c, str) else c for c in columns]
    flags = [p.isNull() for p in parts]
    return F.xxhash64(*parts, *flags)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or one of our own on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not (master.startswith("local") and not master.startswith("local-cluster")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="endpulse-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Store a small table in the shared folder and go on from there."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def write_table(df: DataFrame, what: str) -> DataFrame:
    """Store a table as Parquet in the shared folder and read it back."""
    path = new_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_join(left: DataFrame, right: DataFrame, how: str = "inner", ids: tuple = ("doc_id",)) -> DataFrame:
    """Join on the row key and on ids, nulls equal to nulls; keeps the left ids and key."""
    names = {c: f"__right_{c}" for c in (KEY, *ids)}
    right = right.withColumnsRenamed(names)
    on = F.col(KEY) == F.col(names[KEY])
    for c in ids:
        on = on & F.col(c).eqNullSafe(F.col(names[c]))
    return left.join(right, on, how).drop(*names.values())
