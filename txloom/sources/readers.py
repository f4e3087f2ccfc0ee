"""Reading input tables and checking that they have the columns an operator reads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, StructType

from txloom.functions.columns import day_slice
from txloom.schemas import INPUTS


def _missing(actual: StructType, wanted: StructType, prefix: str = "") -> list[str]:
    out = []
    for field in wanted.fields:
        name = prefix + field.name
        if field.name not in actual.names:
            out.append(name)
            continue
        have, want = actual[field.name].dataType, field.dataType
        if isinstance(want, ArrayType) and isinstance(want.elementType, StructType):
            if not (isinstance(have, ArrayType) and isinstance(have.elementType, StructType)):
                out.append(name)
            else:
                out += _missing(have.elementType, want.elementType, f"{name}.")
    return out


def checked(df: DataFrame, table: str) -> DataFrame:
    """`df`, or a ValueError that names the columns of `table` it lacks."""
    missing = _missing(df.schema, StructType.fromDDL(INPUTS[table]))
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}")
    return df


def read_table(spark: SparkSession, location: str, table: str, run_date: date | None = None, days: int = 1) -> DataFrame:
    """An input table from a catalog name or a Parquet path, cut to the days before `run_date`."""
    is_path = "/" in location or ":" in location
    df = spark.read.parquet(location) if is_path else spark.table(location)
    df = checked(df, table)
    return day_slice(df, run_date, days) if "block_timestamp" in df.columns else df
