"""Landing files: ``<landing>/<batch_id>/<feed>`` in CSV or JSON lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrylens.sources import files
from quarrylens.sources.feed_source import feed_options


def list_batches(spark: SparkSession, landing: str) -> list[str]:
    """Folder names under ``landing`` (a directory listing, not data)."""
    return files.folders(spark, landing)


def resolve_batch(spark: SparkSession, landing: str, batch_id: str | None = None) -> str:
    """Path of the given batch, else of the one whose name sorts last."""
    if batch_id:
        return f"{landing}/{batch_id}"
    batches = list_batches(spark, landing)
    if not batches:
        raise FileNotFoundError(f"no batch folder under {landing}")
    return f"{landing}/{batches[-1]}"


def as_text(schema: T.StructType) -> T.StructType:
    """The same columns, all STRING: lets :func:`conform` see cells that do not parse."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema])


# Columns that a file may have beyond the declared ones.
EXTRA_COLUMNS = 64


def filled(line: str, size: int) -> Column:
    """A CSV line without quotes filled up to ``size`` cells, others as they are.

    A line that is shorter than the parser expects costs it an exception; without quotes its cells are its commas and one.
    """
    commas = F.length(line) - F.length(F.replace(F.col(line), F.lit(","), F.lit("")))
    longer = F.concat(line, F.repeat(F.lit(","), (F.lit(size - 1) - commas).cast("int")))
    return F.when(F.contains(F.col(line), F.lit('"')), F.col(line)).otherwise(longer)


def feed_rows(lines: DataFrame, fmt: str, schema: T.StructType) -> DataFrame:
    """Lines of the landing source as cells of text under the declared names, ``_batch`` and ``_source_file``.

    CSV cells are found by the header's names, whatever order or set of columns a file has: columns
    that it lacks are NULL, others are left out, a repeated name keeps its first column.  A header
    with more than ``EXTRA_COLUMNS`` columns beyond the declared number ends the query.
    """
    if fmt == "json":
        cells = F.from_json("value", as_text(schema)).alias("_c")
        return lines.select(cells, "_batch", "_source_file").select("_c.*", "_batch", "_source_file")
    size = len(schema) + EXTRA_COLUMNS
    places = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(size)])
    parsed = lines.select("places", "width", "_batch", "_source_file", F.from_csv(filled("value", size), places.simpleString()[7:-1].replace(":", " ")).alias("_c"))
    cells = parsed.select("places", "width", "_batch", "_source_file", F.array(*[f"_c.c{i}" for i in range(size)]).alias("_a"))
    wide = F.when(F.col("width") > size, F.raise_error(F.concat(F.lit("too many columns in "), F.col("_source_file"))))

    def cell(i: int, name: str) -> Column:
        place = F.get("places", F.lit(i))
        return F.when(wide.isNull() & (place > 0), F.get("_a", place - 1)).alias(name)

    return cells.select(*[cell(i, f.name) for i, f in enumerate(schema)], "_batch", "_source_file")


def read_lines(spark: SparkSession, path: str | list[str], fmt: str, schema: T.StructType, **more: object) -> DataFrame:
    """One pass over the files of a feed, see :mod:`quarrylens.sources.feed_source`."""
    paths = [path] if isinstance(path, str) else list(path)
    options = feed_options(spark, paths, schema.names, fmt, **more)
    return feed_rows(spark.read.format("landing_feed").options(**options).load(), fmt, schema)


def stream_lines(spark: SparkSession, path: str, fmt: str, schema: T.StructType, log: str, files_per_trigger: int) -> DataFrame:
    """The same rows as a stream of files not seen before; ``log`` belongs to the checkpoint."""
    options = feed_options(spark, [path], schema.names, fmt, log=log, files_per_trigger=files_per_trigger)
    return feed_rows(spark.readStream.format("landing_feed").options(**options).load(), fmt, schema)


def read_feed(spark: SparkSession, path: str | list[str], fmt: str, schema: T.StructType, text: bool = False) -> DataFrame:
    """Read one feed with a declared schema; nothing is inferred from the data.

    As text, CSV and JSON lines come from the landing source, CSV by header name.  Typed CSV must have
    exactly the declared header.
    """
    if text and fmt in ("csv", "json"):
        return read_lines(spark, path, fmt, schema)
    reader = spark.read.schema(as_text(schema) if text else schema)
    if fmt == "csv":
        return reader.option("header", True).option("enforceSchema", False).csv(path)
    if fmt == "json":
        return reader.json(path)
    return reader.format(fmt).load(path)


def with_ingest_meta(df: DataFrame, ingested_at: datetime) -> DataFrame:
    """Ingestion time and source file of each row."""
    stamped = F.lit(ingested_at).cast("timestamp").alias("_ingested_at")
    if "_source_file" in df.columns:
        return df.select("*", stamped)
    return df.select("*", stamped, F.col("_metadata.file_path").alias("_source_file"))


BAD_COLUMNS = "_bad_columns"


def conform(df: DataFrame, target: T.StructType, keep: tuple[str, ...] = (), report: bool = False) -> DataFrame:
    """Cast to the target columns in one projection; absent columns become NULL.

    With ``report`` a column lists the names whose value was present but did not cast, for
    :func:`split_rejects`.  Without it a bad value is simply NULL.
    """
    present = set(df.columns)
    cells = []
    failures = []
    for f in target:
        if f.name in present:
            value = F.col(f.name).try_cast(f.dataType)
            failures.append(F.when(F.col(f.name).isNotNull() & value.isNull(), F.lit(f.name)))
        else:
            value = F.lit(None).cast(f.dataType)
        cells.append(value.alias(f.name))
    extra = [F.array_compact(F.array(*failures)).alias(BAD_COLUMNS)] if report else []
    return df.select(*cells, *keep, *extra)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that conformed, and rows that did not (with the names of their bad columns)."""
    bad = F.size(BAD_COLUMNS) > 0
    return df.filter(~bad).drop(BAD_COLUMNS), df.filter(bad)
