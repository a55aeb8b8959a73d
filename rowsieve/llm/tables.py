"""Reading the given tables, and tables written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from rowsieve.session import ensure_checkpoint_dir


#: Where the session sets nothing: Arrow batches that a worker holds whole.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so a Python worker takes little memory
    beside its executor's heap; a session's own settings stay."""
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.  Only a local session
    (one machine) that names none gets a temporary folder."""
    bound_batches(spark)
    alone = spark.sparkContext.master.split("[")[0] == "local"
    fallback = tempfile.gettempdir() + "/rowsieve-shared" if alone else None
    return f"{ensure_checkpoint_dir(spark, fallback)}/llm-{uuid.uuid4().hex}"


def save(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read again:
    lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    folder = f"{folder or shared_folder(spark)}/{uuid.uuid4().hex[:12]}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
