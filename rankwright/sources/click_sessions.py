"""Click-model session TSV (7 tab-separated fields, two JSON arrays)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SESSION_TSV_SCHEMA = ("digest string, query string, region string, intent_weight string, "
                      "urls string, layout string, clicks string")

# A JSON array whose elements are all strings / all booleans; anything else
# (not an array, mixed element types) reads as an empty array.
_STR = r'"(?:[^"\\]|\\.)*"'
STRING_ARRAY = rf"^\s*\[\s*(?:{_STR}\s*(?:,\s*{_STR}\s*)*)?\]\s*$"
BOOL_ARRAY = r"^\s*\[\s*(?:(?:true|false)\s*(?:,\s*(?:true|false)\s*)*)?\]\s*$"


def read_click_sessions_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Returns (region, query, urls array<string>, clicks array<boolean>)."""
    raw = spark.read.csv(path, sep="\t", schema=SESSION_TSV_SCHEMA, quote="", escape="")
    urls = F.when(F.col("urls").rlike(STRING_ARRAY), F.from_json("urls", "array<string>"))
    clicks = F.when(F.col("clicks").rlike(BOOL_ARRAY), F.from_json("clicks", "array<boolean>"))
    return raw.select("region", "query",
                      F.coalesce(urls, F.array().cast("array<string>")).alias("urls"),
                      F.coalesce(clicks, F.array().cast("array<boolean>")).alias("clicks"))


def tsv_sessions_as_hits(df: DataFrame, min_docs: int, max_docs: int,
                         discard_no_clicks: bool = True) -> DataFrame:
    """P17 on TSV sessions: first n = min(max_docs, len(urls)) urls, clicks cut
    or padded with false to n, drop when len(urls) < min_docs or no click."""
    n = F.least(F.size("urls"), F.lit(max_docs))
    padded = F.transform(F.sequence(F.lit(0), n - 1),
                         lambda i: F.coalesce(F.get(F.col("clicks"), i), F.lit(False)))
    hits = F.arrays_zip(F.slice("urls", 1, max_docs).alias("hit_page_id"), padded.alias("clicked"))
    out = (df.where(F.size("urls") >= min_docs)
           .withColumn("hits", F.when(n > 0, hits).otherwise(F.array()))
           .select(F.col("region").alias("wikiid"), F.col("query").alias("norm_query_id"), "hits"))
    if discard_no_clicks:
        out = out.where(F.exists("hits", lambda h: h["clicked"]))
    return out
