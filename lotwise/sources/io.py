"""Scans, typed loads and sinks (A1-A7, A10 plumbing).

* ``read_table``   - Parquet or CSV chosen by suffix (A1, A2); CSV is read with
  an explicit schema, never ``inferSchema``.
* ``conform``      - contract enforcement (A6): by-name select + cast against the
  StructType; missing columns raise.  Unlike a positional INSERT, column order in
  the file does not matter.
* ``write_*``      - Parquet (partitioned), CSV and JSON report sinks (A3-A5).
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.contracts import CONTRACTS


class ContractError(ValueError):
    """A table cannot satisfy its declared contract."""


def conform(df: DataFrame, table: str | T.StructType, allow_missing: bool = False) -> DataFrame:
    schema = CONTRACTS[table] if isinstance(table, str) else table
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing and not allow_missing:
        raise ContractError(f"{table}: missing required columns {missing}")
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet or CSV by file suffix; anything else is an error."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix == ".parquet" or (suffix == "" and os.path.isdir(path)):
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(path)
    if suffix == ".csv":
        reader = spark.read.option("header", True).option("mode", "FAILFAST")
        if schema is not None:
            reader = reader.schema(schema)
        else:
            # Without a contract every column is read as text; callers cast.
            reader = reader.option("inferSchema", False)
        return reader.csv(path)
    raise ContractError(f"input must be .csv or .parquet: {path}")


def load_canonical(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Typed table load (A6): read then conform to the contract by name."""
    return conform(read_table(spark, path), table)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink (A4): one file per task, with a header each."""
    df.write.mode(mode).option("header", True).csv(path)


def write_json_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON-lines sink (A5): one file per task."""
    df.write.mode(mode).json(path)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Register tables and marts as temp views in dependency (insertion) order."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)
