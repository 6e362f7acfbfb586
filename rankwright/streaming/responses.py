"""Request/response exchange as data.

Requests are JSON envelopes written to a sink (Kafka when its connector is on
the classpath, JSON files otherwise); responses come back as envelopes
``{run_id, meta{…}, status_code, text}`` and completion markers
``{run_id, complete, partition}``.  Everything is a DataFrame transformation,
so the same code runs on a bounded read and on ``readStream``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RESPONSE_SCHEMA = ("run_id string, meta struct<wikiid:string, query:string>, status_code int, "
                   "text string, complete boolean, partition int")
HITS_SCHEMA = "struct<hits:array<struct<pageid:int>>>"


def request_batch(df: DataFrame, run_id: str, request_col: str, meta_cols: Sequence[str]) -> DataFrame:
    """One JSON envelope per row: {run_id, request, meta{…}}."""
    env = F.struct(F.lit(run_id).alias("run_id"), F.col(request_col).alias("request"),
                   F.struct(*meta_cols).alias("meta"))
    return df.select(F.to_json(env).alias("value"))


def end_markers(df: DataFrame, run_id: str) -> DataFrame:
    """One completion marker per request partition (sent after its requests)."""
    return (df.select(F.spark_partition_id().alias("partition")).distinct()
            .select(F.to_json(F.struct(F.lit(run_id).alias("run_id"), F.lit(True).alias("complete"),
                                       "partition")).alias("value")))


def write_envelopes(df: DataFrame, target: str, fmt: str = "json", topic: str | None = None) -> None:
    """Sink for envelopes: ``fmt='kafka'`` needs the Kafka connector; JSON/text
    files otherwise (tests, air-gapped runs)."""
    if fmt == "kafka":
        df.write.format("kafka").option("kafka.bootstrap.servers", target).option("topic", topic).save()
    else:
        df.write.mode("append").text(target)


def parse_envelopes(raw: DataFrame, value_col: str = "value") -> DataFrame:
    return raw.select(F.from_json(F.col(value_col), RESPONSE_SCHEMA).alias("e")).select("e.*")


REPLAY_DELAY = "6 hours"


def collect_responses(envelopes: DataFrame, run_id: str) -> DataFrame:
    """Responses of one run with status 200, hits flat-mapped,
    duplicates (replayed responses) removed by (wikiid, query, hit_page_id)."""
    ok = envelopes.where((F.col("run_id") == run_id) & (F.col("status_code") == 200))
    hits = ok.select(F.col("meta.wikiid").alias("wikiid"), F.col("meta.query").alias("query"),
                     F.explode(F.from_json("text", HITS_SCHEMA)["hits"]).alias("h"))
    rows = hits.select("wikiid", "query", F.col("h.pageid").alias("hit_page_id"))
    keys = ["wikiid", "query", "hit_page_id"]
    if not rows.isStreaming:
        return rows.dropDuplicates(keys)
    # a replay comes within the delay; older keys leave the state
    return (rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", REPLAY_DELAY)
            .dropDuplicatesWithinWatermark(keys).drop("_arrived"))


def run_complete(markers: DataFrame, expected_partitions: int) -> DataFrame:
    """A run is complete once markers from every request partition were
    seen; duplicates are harmless (distinct count)."""
    return (markers.where(F.col("complete"))
            .groupBy("run_id").agg(F.count_distinct("partition").alias("n_partitions"))
            .withColumn("complete", F.col("n_partitions") >= expected_partitions))


RUN_STATUS = "run_id string, n_partitions int, complete boolean"


def completion_stream(markers: DataFrame, expected_partitions: int, timeout_ms: int, forget_ms: int = 86_400_000) -> DataFrame:
    """T2 as a stream: one row (``RUN_STATUS``) a run, either when markers of all request partitions were seen
    (``complete``) or when no envelope of the run came for ``timeout_ms``.

    ``markers`` are the parsed envelopes.  The state of a run is the set of its partitions, no larger than their
    expected number, and whether it was reported; a reported run is forgotten after ``forget_ms`` without envelopes,
    until then late ones do not report it again."""

    def follow(key, batches, state):
        import pandas as pd
        seen, reported = state.get if state.exists else ([], False)
        if state.hasTimedOut:
            if reported:
                state.remove()
                return
            state.update((seen, True))
            state.setTimeoutDuration(forget_ms)
            yield pd.DataFrame({"run_id": [key[0]], "n_partitions": [len(seen)], "complete": [False]})
            return
        seen = set(seen)
        for pdf in batches:
            marked = pdf[pdf["complete"].fillna(False).astype(bool)]["partition"].dropna()
            seen.update(int(p) for p in marked if 0 <= int(p) < expected_partitions)
        done = len(seen) >= expected_partitions and not reported
        state.update((sorted(seen), reported or done))
        state.setTimeoutDuration(forget_ms if reported or done else timeout_ms)
        if done:
            yield pd.DataFrame({"run_id": [key[0]], "n_partitions": [len(seen)], "complete": [True]})

    return markers.where("run_id is not null").select("run_id", "complete", "partition").groupBy("run_id").applyInPandasWithState(
        follow, RUN_STATUS, "seen array<int>, reported boolean", "append", "ProcessingTimeTimeout")


def read_responses(spark: SparkSession, source: str, fmt: str = "json", topic: str | None = None,
                   starting_ts: int | None = None, ending_ts: int | None = None) -> DataFrame:
    """Bounded read of the response log.  For Kafka the offsets are
    chosen by time ([start − 60 s, end + 60 s], milliseconds)."""
    if fmt == "kafka":
        r = (spark.read.format("kafka").option("kafka.bootstrap.servers", source).option("subscribe", topic))
        if starting_ts is not None:
            r = r.option("startingTimestamp", str(starting_ts - 60_000))
        if ending_ts is not None:
            r = r.option("endingTimestamp", str(ending_ts + 60_000))
        return parse_envelopes(r.load().select(F.col("value").cast("string").alias("value")))
    return parse_envelopes(spark.read.text(source))


def stream_responses(spark: SparkSession, source_dir: str, run_id: str) -> DataFrame:
    """T1 as a stream over a directory of envelope files; the dedup keeps its
    keys in the state store across micro-batches for ``REPLAY_DELAY``."""
    raw = spark.readStream.text(source_dir)
    return collect_responses(parse_envelopes(raw), run_id)
