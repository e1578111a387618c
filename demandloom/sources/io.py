"""Readers and writers: thin, lazy, schema-first."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.exprs import nan_to_null

# The record layout of the sales stream.
STREAM_SCHEMA = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("sales", T.DoubleType()),
    ]
)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder the cluster sets as ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder; any other
    master raises, because executors would write to their own disks.  The
    session's settings stay as they are.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.gettempdir() + "/demandloom"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_table(
    spark: SparkSession,
    path: str,
    format: str = "csv",
    schema: T.StructType | str | None = None,
    header: bool = True,
    infer: bool = False,
    options: Mapping[str, str] | None = None,
    nan_as_null: bool = True,
) -> DataFrame:
    """Read any Spark format; inference is opt-in, and no job runs here otherwise.

    NaN becomes NULL, the library's only notion of missing, unless ``nan_as_null`` is false.
    """
    reader = spark.read.format(format)
    if format == "csv":
        reader = reader.option("header", header).option("inferSchema", infer)
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    df = reader.load(path)
    return nan_to_null(df) if nan_as_null else df


def scan_csv_dates(spark: SparkSession, path: str, schema: T.StructType | str, date: str = "date") -> DataFrame:
    """CSV with its date column parsed; unreadable dates become NULL."""
    df = nan_to_null(spark.read.csv(path, header=True, schema=schema))
    return df.withColumn(date, F.try_to_date(F.col(date).cast("string"))) if date in df.columns else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Partition columns let later reads prune.

    Rows are rebalanced by them first, so files stay few while adaptive
    execution still splits a partition value that holds most rows.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True)


def decode_json(df: DataFrame, schema: T.StructType | str = STREAM_SCHEMA, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns from a JSON ``value``; text that does not parse is kept in ``_corrupt``."""
    parsed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_bad = T.StructType([*parsed.fields, T.StructField("_corrupt", T.StringType())])
    text = F.col(value).cast("string")
    data = F.from_json(text, with_bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return df.select(*keep, data.alias("data")).select(*keep, "data.*")


def stream_kafka_json(
    spark: SparkSession,
    servers: str,
    topic: str,
    schema: T.StructType | str = STREAM_SCHEMA,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Subscribe to a topic and decode its records (needs the Kafka connector on the class path)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return decode_json(reader.load().select("value"), schema)
