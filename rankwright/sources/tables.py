"""Scans of the driver tables and the click log derived from them.

Every read selects only the columns it needs so the Parquet scan prunes
(``ReadSchema``) and filters written after the read reach ``PushedFilters``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan one table with explicit column pruning."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def click_rows(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per displayed hit, mapped from the order tables.

    session = order, wiki = market segment, query = priority + customer bucket,
    norm query = priority, hit = line item in line order, page = part bucket,
    click = return flag R, label from quantity.  The id of a norm query is the
    priority's leading digit.

    Plan: orders ⋈ customer first (smaller side), then ⋈ lineitem on the order
    key; the position window is partitioned by the same key, so it reuses the
    join's hash partitioning instead of shuffling again.
    """
    li = table(spark, sf_dir, "lineitem", *dict.fromkeys((
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate",
        "l_returnflag", "l_quantity", *extra)))
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    sessions = orders.join(cust, orders.o_custkey == cust.c_custkey)
    joined = li.join(sessions, li.l_orderkey == sessions.o_orderkey)
    pos = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    return joined.select(
        F.col("c_mktsegment").alias("wikiid"),
        F.col("o_orderkey").cast("string").alias("session_id"),
        F.concat(F.col("o_orderpriority"), F.lit(" "),
                 (F.col("o_custkey") % 10).cast("string")).alias("query"),
        F.col("o_orderpriority").alias("norm_query"),
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("norm_query_id"),
        (F.row_number().over(pos) - 1).alias("hit_position"),
        (F.col("l_partkey") % 20).cast("int").alias("hit_page_id"),
        (F.col("l_returnflag") == "R").alias("clicked"),
        F.floor((F.col("l_quantity") - 1) / 10).cast("int").alias("label"),
        *extra,
    )


def click_rows_sql(extra: tuple[str, ...] = ()) -> str:
    cols = "".join(f", l.{c}" for c in extra)
    return CLICK_ROWS_SQL.replace("AS label\n", f"AS label{cols}\n")


CLICK_ROWS_SQL = """
SELECT c.c_mktsegment AS wikiid,
       CAST(o.o_orderkey AS VARCHAR) AS session_id,
       concat(o.o_orderpriority, ' ', CAST(o.o_custkey % 10 AS VARCHAR)) AS query,
       o.o_orderpriority AS norm_query,
       CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT) AS norm_query_id,
       CAST(row_number() OVER (PARTITION BY o.o_orderkey
            ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_shipdate) - 1 AS INTEGER)
         AS hit_position,
       CAST(l.l_partkey % 20 AS INTEGER) AS hit_page_id,
       l.l_returnflag = 'R' AS clicked,
       CAST(floor((l.l_quantity - 1) / 10) AS INTEGER) AS label
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                JOIN customer c ON o.o_custkey = c.c_custkey
"""


def raw_click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested click log (one row per search session), as the logging system writes it.

    Schema: wikiid, q_by_ip_day int, query, session_id,
    hits array<struct<pageid:int>>, clicks array<struct<pageid:int>>.
    ``q_by_ip_day`` = orders placed by the same customer on the same day.
    """
    rows = click_rows(spark, sf_dir)
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    per_day = Window.partitionBy("o_custkey", "o_orderdate")
    ip = orders.select(F.col("o_orderkey").cast("string").alias("session_id"),
                       F.count(F.lit(1)).over(per_day).cast("int").alias("q_by_ip_day"))
    sessions = (rows.groupBy("wikiid", "query", "session_id")
                .agg(F.sort_array(F.collect_list(F.struct("hit_position", "hit_page_id", "clicked")))
                     .alias("h")))
    return (sessions.join(ip, "session_id")
            .select("wikiid", "q_by_ip_day", "query", "session_id",
                    F.transform("h", lambda x: F.struct(x["hit_page_id"].alias("pageid"))).alias("hits"),
                    F.transform(F.filter("h", lambda x: x["clicked"]),
                                lambda x: F.struct(x["hit_page_id"].alias("pageid"))).alias("clicks")))


TRAIN_FEATURES = ("f_position", "f_price", "f_discount", "f_tax", "f_ctr", "f_shown")


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labeled (wikiid, query, hit_page_id) rows with numeric features, the
    input of feature selection, folds and ranker training."""
    h = click_rows(spark, sf_dir, ("l_extendedprice", "l_discount", "l_tax"))
    return (h.groupBy("wikiid", "query", "hit_page_id")
            .agg(F.max("label").alias("label"),
                 F.avg("hit_position").alias("f_position"),
                 F.avg("l_extendedprice").alias("f_price"),
                 F.avg("l_discount").alias("f_discount"),
                 F.avg("l_tax").alias("f_tax"),
                 F.avg(F.col("clicked").cast("double")).alias("f_ctr"),
                 F.count(F.lit(1)).cast("double").alias("f_shown")))


TRAINING_ROWS_SQL = f"""
h AS ({click_rows_sql(("l_extendedprice", "l_discount", "l_tax"))}),
tr AS (SELECT wikiid, query, hit_page_id, max(label) AS label, avg(hit_position) AS f_position,
              avg(l_extendedprice) AS f_price, avg(l_discount) AS f_discount, avg(l_tax) AS f_tax,
              avg(CAST(clicked AS DOUBLE)) AS f_ctr, CAST(count(*) AS DOUBLE) AS f_shown
       FROM h GROUP BY wikiid, query, hit_page_id)"""
