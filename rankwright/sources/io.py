"""File sources and sinks."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = "\t",
                   header: bool = False) -> DataFrame:
    """S3: delimited text with an explicit schema (no inference)."""
    return spark.read.csv(path, schema=schema, sep=sep, header=header, mode="PERMISSIVE")


def read_json_lines(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; pass a schema in production (inference scans the data)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def read_columns(spark: SparkSession, path: str, columns: Sequence[str],
                 where: F.Column | None = None) -> DataFrame:
    """Parquet scan with explicit column pruning and an optional filter
    (pushed to the scan; partition columns prune directories)."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns)


def write_with_metadata(df: DataFrame, path: str, metadata: dict[str, dict] | None = None,
                        mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Parquet sink; column metadata (feature names, run facts) is
    attached first and travels in the Parquet schema.  ``partition_by``
    writes one directory per value (e.g. per wiki)."""
    for col, meta in (metadata or {}).items():
        merged = dict(df.schema[col].metadata)
        merged.update(meta)
        df = df.withMetadata(col, merged)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_stats_json(stats: DataFrame, path: str, extra: dict | None = None) -> None:
    """Small per-wiki statistics table → one JSON document.

    ``stats`` is an aggregate (one row per wiki), so collecting it is bounded."""
    rows = [r.asDict(recursive=True) for r in stats.collect()]
    doc = {"wikis": rows, **(extra or {})}
    spark = stats.sparkSession
    spark.createDataFrame([(json.dumps(doc, sort_keys=True, default=str),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(path)


def read_stats_json(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r.value for r in spark.read.text(path).collect()))
