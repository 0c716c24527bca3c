"""Databases, tables, views and exports.

``fmt`` is a parameter everywhere: Parquet by default, any table format on the classpath
otherwise.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_db(spark: SparkSession, name: str, comment: str = "") -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT {_quoted(comment)}")


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
    comment: str = "",
) -> None:
    """Typed table with column comments and properties, if it does not exist."""

    def column(f: T.StructField) -> str:
        note = f.metadata.get("comment")
        return f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {_quoted(note)}" if note else "")

    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    props = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in (properties or {}).items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(column(f) for f in schema)}) USING {fmt}{parts}"
        f" COMMENT {_quoted(comment)}" + (f" TBLPROPERTIES ({props})" if props else "")
    )


def counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """The frame plus row counts that the write itself fills in: no second scan.

    ``counts`` are further conditions to count, by name.
    """
    seen = Observation()
    extra = [F.count_if(cond).alias(name) for name, cond in counts.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra), seen


def stamped(df: DataFrame, at: datetime, name: str = "_processed_at") -> DataFrame:
    """Audit time, added only when a table is written."""
    return df.withColumn(name, F.lit(at).cast("timestamp"))


Buckets = tuple[int, Sequence[str]]


def _save(df: DataFrame, table: str, mode: str, fmt: str, partition_by: Sequence[str], buckets: Buckets | None) -> None:
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        n, keys = buckets
        writer = writer.bucketBy(n, *keys).sortBy(*keys)
    writer.saveAsTable(table)


def append(df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = (), buckets: Buckets | None = None) -> int:
    """Append rows; returns how many."""
    rows, seen = counted(df)
    _save(rows, table, "append", fmt, partition_by, buckets)
    return seen.get["rows"]


def replace(df: DataFrame, table: str, fmt: str = "parquet", partition_by: Sequence[str] = (), buckets: Buckets | None = None) -> int:
    """Replace rows and schema; returns the row count.

    Tables that are joined again and again on one key (orders and lines, units and work
    orders) can be stored in ``buckets=(n, keys)``: equal bucketing joins without a shuffle.
    """
    rows, seen = counted(df)
    _save(rows, table, "overwrite", fmt, partition_by, buckets)
    return seen.get["rows"]


ctas = replace


def overwrite_rows(df: DataFrame, table: str) -> None:
    """Replace rows but keep the table's definition."""
    target = df.sparkSession.table(table).schema
    df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target]).write.insertInto(table, overwrite=True)


def overwrite_partition(df: DataFrame, table: str, partition: Mapping[str, str]) -> None:
    """Replace one partition, named in full, and leave the others; ``df`` lacks its columns."""
    spark, view = df.sparkSession, f"_rows_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{c}`" for c in spark.table(table).columns if c not in partition)
    named = ", ".join(f"`{k}` = {_quoted(v)}" for k, v in partition.items())
    df.createOrReplaceTempView(view)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({named}) SELECT {columns} FROM {view}")
    spark.catalog.dropTempView(view)


def mirror_copy(spark: SparkSession, source: str, target: str) -> int:
    """Unfiltered copy of a base table."""
    return replace(spark.table(source), target)


def define_view(spark: SparkSession, name: str, sql: str, comment: str = "") -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT {_quoted(comment)} AS {sql}")


def materialise(df: DataFrame, name: str, mode: str = "table", **options) -> None:
    """Named data product: stored (``table``), computed on read (``view``) or ``both``.

    Open-source Spark has no materialized views, so a stored product is refreshed by
    calling this again, or incrementally by ``quarrylens.streaming.jobs``.  The live form is
    a session view ``v_<db>_<name>`` and is always up to date.
    """
    if mode not in ("table", "view", "both"):
        raise ValueError(f"unknown mode {mode}")
    if mode != "table":
        df.createOrReplaceTempView("v_" + name.replace(".", "_"))
    if mode != "view":
        replace(df, name, **options)


def export(df: DataFrame, path: str, fmt: str = "csv", files: int | None = None) -> None:
    """Write CSV or JSON; ``files`` asks for fewer, larger files than the plan's partitions."""
    out = df if files is None else df.coalesce(files)
    writer = out.write.mode("overwrite")
    (writer.option("header", True).csv if fmt == "csv" else writer.json)(path)


def audit_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table in one result."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def drop_if_exists(spark: SparkSession, name: str, kind: str = "TABLE") -> None:
    spark.sql(f"DROP {kind} IF EXISTS {name}")


def table_kind(spark: SparkSession, name: str) -> str:
    """MANAGED, EXTERNAL, VIEW or TEMPORARY; ABSENT when there is none."""
    if not spark.catalog.tableExists(name):
        return "ABSENT"
    return spark.catalog.getTable(name).tableType


def table_properties(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW TBLPROPERTIES {name}")


def table_names(spark: SparkSession, db: str) -> Iterable[str]:
    return [t.name for t in spark.catalog.listTables(db)]
