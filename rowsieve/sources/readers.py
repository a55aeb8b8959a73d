"""Inputs a validation can run on.  All are ordinary Spark reads;
Parquet and explicit schemas are preferred at scale (schema inference reads
the data an extra time and guesses types)."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_from_json(source: Any) -> T.StructType:
    """``StructType`` from a JSON file path, JSON text or dict."""
    if isinstance(source, T.StructType):
        return source
    if isinstance(source, Mapping):
        return T.StructType.fromJson(dict(source))
    text = os.fspath(source)
    if text.lstrip().startswith("{"):
        return T.StructType.fromJson(json.loads(text))
    with open(text, encoding="utf-8") as fh:
        return T.StructType.fromJson(json.load(fh))


def as_schema(schema: Any) -> T.StructType | str:
    """StructType, JSON dict / text / file → StructType; other text is DDL."""
    if isinstance(schema, str):
        text = schema.lstrip()
        if not text.startswith("{") and not os.path.isfile(schema):
            return schema  # DDL, e.g. "a int, b string"
    return schema_from_json(schema)


def read_csv(
    spark: SparkSession,
    path: str,
    *,
    schema: Any = None,
    infer_schema: bool = False,
    header: bool = True,
    malformed: str | None = None,
    source_file: str | None = None,
    **options: Any,
) -> DataFrame:
    """CSV with a header.  ``schema`` (StructType, DDL string or
    JSON schema) wins; else ``infer_schema`` (an extra pass) or all strings.

    ``malformed`` names a column that receives the raw line of a record that
    does not fit the schema (too many or too few fields, a value of another
    type), NULL for sound ones; a ``well_formed`` rule on it sends such rows to
    the rejected sink.  Without it Spark turns what does not fit into NULLs.
    Every field is parsed then, whatever columns a query reads, so a verdict
    does not depend on pruning.  ``source_file`` names a column for the path
    of the record's file."""
    reader = spark.read.option("header", header)
    for key, value in options.items():
        reader = reader.option(key, value)
    if schema is not None:
        kinds = as_schema(schema)
        reader = reader.schema(kinds)
    else:
        reader = reader.option("inferSchema", infer_schema)
    if malformed is not None:
        # the plain schema first: the column for raw lines must be part of a given schema
        kinds = reader.csv(path).schema if schema is None or isinstance(kinds, str) else kinds
        if malformed.lower() in (n.lower() for n in kinds.names):
            raise ValueError(f"the input has a column named {malformed!r}")
        reader = reader.schema(T.StructType([*kinds.fields, T.StructField(malformed, T.StringType())]))
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", malformed)
    df = reader.csv(path)
    if malformed is not None and len(df.columns) > 1:
        # Spark converts only the fields that a query reads, and takes a line for malformed only by these: nothing
        # of a hash of all fields is put after the raw line, so that whatever reads it reads them all
        fields = F.xxhash64(*[df[c] for c in df.columns if c != malformed]).cast("string")
        df = df.withColumn(malformed, F.concat(df[malformed], F.substring(fields, 1, 0)))
    if source_file is not None:
        if source_file.lower() in (n.lower() for n in df.columns):
            raise ValueError(f"the input has a column named {source_file!r}")
        df = df.withColumn(source_file, F.col("_metadata.file_path"))
    return df


def read_parquet(spark: SparkSession, path: str, *, schema: Any = None) -> DataFrame:
    """Parquet (column pruning and filter push-down reach the scan)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(as_schema(schema))
    return reader.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S3: catalog table or temporary view by name."""
    return spark.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` visible to referential rules by name."""
    df.createOrReplaceTempView(name)
    return df
