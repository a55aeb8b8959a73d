"""Column names as Spark resolves them: any case the session allows,
backticks, struct fields, fields of arrays of structs, map keys, and
top-level names that hold dots themselves."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT = (T.StringType, T.VarcharType, T.CharType)


def _frame(source: DataFrame | T.StructType) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    return SparkSession.active().createDataFrame([], source)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _resolve(source: DataFrame | T.StructType, name: str) -> tuple[str, T.DataType] | None:
    """What ``F.col`` must be given for ``name``, and its type."""
    frame = _frame(source)
    literal = [c for c in frame.columns if c == name and ("." in c or "`" in c)]
    for ref in [quoted(c) for c in literal] or [name]:
        try:
            return ref, frame.select(F.col(ref)).schema.fields[0].dataType
        except AnalysisException:
            pass
    return None


def column_ref(source: DataFrame | T.StructType, name: str) -> str:
    """Text that ``F.col`` resolves to the column; ``name`` itself if nothing does."""
    found = _resolve(source, name)
    return found[0] if found else name


def column_type(source: DataFrame | T.StructType, name: str) -> T.DataType | None:
    """Type of a column, or None if there is no such column."""
    found = _resolve(source, name)
    return found[1] if found else None
