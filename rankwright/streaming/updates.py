"""Document-update stream: validation, routing, no-op aware upsert and result
counters (T3-T5, J8, A16).

Messages are JSON objects ``{_index, _id, _source{popularity_score}}``.  The
same functions run on a batch DataFrame and inside ``foreachBatch`` of a
stream (:func:`update_stream`), whose checkpoint gives at-least-once delivery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields accepted in ``_source`` and their no-op rule.
FIELD_CONFIG = {"popularity_score": "within 20%"}
TOP_KEYS = ("_index", "_id", "_source")
NOOP_SHARE = 0.2
RESULT_COUNTERS = ("updated", "created", "noop", "ok_unknown", "missing", "failed")



def _kind(value) -> F.Column:
    """JSON type of a VARIANT: STRING, BIGINT, DOUBLE, DECIMAL(p,s), VOID (null), OBJECT<…> …"""
    return F.schema_of_variant(value)


def validate_updates(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Classify every message as ``valid``, ``bad_json`` or ``fail_validate``.

    Closed object with exactly the required keys; ``_index`` a string; ``_id``
    an integer or string; ``_source`` a closed object with at least one known
    field, each a number or string.  The message is parsed once; types are those of the
    parsed values.  JSON that is not an object fails the validation.  Returns the input plus
    ``status`` and the parsed ``_index``, ``_id`` (string), ``popularity_score`` (double)."""
    message = F.try_parse_json(F.col(value_col))
    part = {k: F.try_variant_get(F.col("_v"), f"$.{k}", "variant") for k in TOP_KEYS}
    text = {k: F.try_variant_get(F.col("_v"), f"$.{k}", "string") for k in ("_index", "_id")}
    keys = F.json_object_keys(F.to_json(F.col("_v")))
    src_keys = F.json_object_keys(F.to_json(part["_source"]))
    known = F.array(*[F.lit(k) for k in FIELD_CONFIG])
    whole_number = r"^(BIGINT|DECIMAL\(\d+,0\))$"
    field_ok = F.lit(True)
    for k in FIELD_CONFIG:
        kind = _kind(F.try_variant_get(F.col("_v"), f"$._source.{k}", "variant"))
        field_ok = field_ok & (~F.array_contains(src_keys, k) | kind.rlike(r"^(STRING|BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))$"))
    valid = (
        (F.size(keys) == len(TOP_KEYS))
        & F.forall(keys, lambda k: k.isin(*TOP_KEYS))
        & (_kind(part["_index"]) == "STRING")
        & ((_kind(part["_id"]) == "STRING") | _kind(part["_id"]).rlike(whole_number))
        & src_keys.isNotNull() & (F.size(src_keys) >= 1)
        & F.forall(src_keys, lambda k: F.array_contains(known, k))
        & field_ok
    )
    status = (F.when(F.col("_v").isNull(), "bad_json")
              .when(F.coalesce(valid, F.lit(False)), "valid").otherwise("fail_validate"))
    return raw.withColumn("_v", message).select(
        *raw.columns, status.alias("status"), text["_index"].alias("index"), text["_id"].alias("doc_id"),
        F.try_variant_get(F.col("_v"), "$._source.popularity_score", "string").try_cast("double").alias("popularity_score"))


def validation_counts(checked: DataFrame) -> DataFrame:
    return checked.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def route_updates(valid: DataFrame, clusters: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Each update goes to the first cluster (in the given priority
    order) whose index/alias set contains its ``index``; otherwise
    ``missing_index``.  The routing table is configuration (clusters ×
    aliases), so broadcasting it is bounded."""
    spark = valid.sparkSession
    rows = [(alias, name, prio) for prio, (name, aliases) in enumerate(clusters) for alias in aliases]
    table = spark.createDataFrame(rows, "index string, cluster string, priority int")
    best = table.groupBy("index").agg(F.min_by("cluster", "priority").alias("cluster"))
    return (valid.join(F.broadcast(best), "index", "left")
            .withColumn("cluster", F.coalesce("cluster", F.lit("missing_index"))))


def apply_updates(updates: DataFrame, current: DataFrame, key: str = "doc_id",
                  field: str = "popularity_score") -> DataFrame:
    """T5: the outcome of each update against the current document values:
    ``missing`` when the document does not exist (updates do not create),
    ``noop`` when |new − old| ≤ 20 % of |old|, else ``updated``."""
    cur = current.select(key, F.col(field).alias("_old"), F.lit(True).alias("_exists"))
    j = updates.join(cur, key, "left")
    within = F.abs(F.col(field) - F.col("_old")) <= F.lit(NOOP_SHARE) * F.abs(F.col("_old"))
    action = (F.when(F.col("_exists").isNull(), "missing")
              .when(within, "noop").otherwise("updated"))
    return j.withColumn("result", action).drop("_exists")


def as_results(applied: DataFrame) -> DataFrame:
    """Service-style result rows (ok, status, result) from :func:`apply_updates`."""
    missing = F.col("result") == "missing"
    return applied.select(
        (~missing).alias("ok"),
        F.when(missing, 404).otherwise(200).alias("status"),
        F.when(missing, F.lit(None)).otherwise(F.col("result")).alias("result"))


def update_results(results: DataFrame) -> DataFrame:
    """Counters updated / created / noop / ok_unknown / missing / failed
    over (ok, status, result) rows; every counter is present (0 if unseen)."""
    label = (F.when(F.col("ok") & F.col("result").isin("updated", "created", "noop"), F.col("result"))
             .when(F.col("ok"), "ok_unknown")
             .when(F.col("status") == 404, "missing")
             .otherwise("failed"))
    counts = results.groupBy(label.alias("counter")).agg(F.count(F.lit(1)).alias("n"))
    spark = results.sparkSession
    names = spark.createDataFrame([(c,) for c in RESULT_COUNTERS], "counter string")
    return names.join(counts, "counter", "left").select("counter", F.coalesce("n", F.lit(0)).alias("n"))


def upsert(applied: DataFrame, current: DataFrame, key: str = "doc_id",
           field: str = "popularity_score", order: str | None = None) -> DataFrame:
    """T5: the documents after the updates: ``updated`` ones take the new value, of several in one batch the last by
    the column ``order`` (without one: the greatest); all others stay; updates never create a document."""
    last = F.max(field) if order is None else F.max_by(field, F.struct(order, field))
    new = applied.where(F.col("result") == "updated").groupBy(key).agg(last.alias("_new"))
    return current.join(new, key, "left").withColumn(field, F.coalesce("_new", field)).drop("_new").select(*current.columns)


class DocumentState:
    """Document values in hash buckets under a folder; a batch rewrites only the buckets it touches.

    ``epoch=<n>/bucket=<k>`` holds bucket ``k`` as of batch ``n``; ``versions/epoch=<n>`` (one row a bucket) says which batch
    each bucket was last written by, and is written last.  So a batch that is tried again reads the state
    before it and replaces its own files.  ``vacuum`` removes what no kept batch refers to."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, key: str = "doc_id"):
        self.spark, self.path, self.buckets, self.key = spark, path.rstrip("/"), buckets, key

    def _fs(self):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _epochs(self, folder: str) -> list[int]:
        fs, at = self._fs(), self._path(folder)
        if not fs.exists(at):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(at)]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("epoch="))

    def versions(self, before: int | None = None) -> dict[int, int]:
        """Batch that last wrote each bucket, as of the newest finished batch (before ``before``)."""
        done = [e for e in self._epochs("versions") if (before is None or e < before)
                and self._fs().exists(self._path(f"versions/epoch={e}/_SUCCESS"))]
        if not done:
            return {}
        return {r.bucket: r.epoch for r in self.spark.read.parquet(f"{self.path}/versions/epoch={max(done)}").collect()}  # one row a bucket

    def bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("bucket", F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int"))

    def _write(self, rows: DataFrame, epoch: int, versions: dict[int, int]) -> None:
        rows.repartition(F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/epoch={epoch}")
        table = self.spark.createDataFrame(sorted(versions.items()), "bucket int, epoch bigint")
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/epoch={epoch}")

    def create(self, documents: DataFrame) -> None:
        """The first state, as batch -1."""
        rows = self.bucketed(documents)
        held = [r.bucket for r in rows.select("bucket").distinct().collect()]  # at most the number of buckets
        self._write(rows, -1, {b: -1 for b in held})

    def read(self, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The documents (of some buckets) as of the newest batch (before ``before``); None without any."""
        versions = {b: e for b, e in self.versions(before).items() if buckets is None or b in buckets}
        if not versions:
            return None
        paths = [f"{self.path}/epoch={e}/bucket={b}" for b, e in sorted(versions.items())]
        return self.spark.read.parquet(*paths)

    def apply(self, updates: DataFrame, epoch: int, field: str = "popularity_score", order: str | None = None) -> DataFrame:
        """T5: apply a batch; the outcome of each update (see :func:`apply_updates`).  Only buckets with a changed
        document are written."""
        asked = self.bucketed(updates)
        touched = [r.bucket for r in asked.select("bucket").distinct().collect()]
        current = self.read(epoch, touched)
        if current is None:
            return updates.withColumn("_old", F.lit(None).cast("double")).withColumn("result", F.lit("missing"))
        applied = apply_updates(updates, current, self.key, field).persist()
        changed = [r.bucket for r in self.bucketed(applied.where("result = 'updated'")).select("bucket").distinct().collect()]
        versions = self.versions(epoch)
        if changed:
            after = upsert(self.bucketed(applied).where(F.col("bucket").isin(changed)), self.read(epoch, changed), self.key, field, order)
            self._write(self.bucketed(after), epoch, {**versions, **{b: epoch for b in changed}})
        return applied

    def vacuum(self, keep: int = 2) -> list[int]:
        """Remove batches that none of the last ``keep`` versions refers to; the removed ones."""
        kept = self._epochs("versions")[-keep:]
        used = set(kept) | {e for k in kept for e in self.versions(k + 1).values()}
        gone = [e for e in self._epochs("") if e not in used]
        for e in gone:
            self._fs().delete(self._path(f"epoch={e}"), True)
        for e in self._epochs("versions")[:-keep]:
            self._fs().delete(self._path(f"versions/epoch={e}"), True)
        return gone


def _last_state(spark: SparkSession, path: str, epoch: int) -> str | None:
    """Newest state before ``epoch``, by the marker Spark's writer leaves."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    done = [int(n.split("=")[1]) for n in names if n.startswith("epoch=")
            and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    before = [e for e in done if e < epoch]
    return f"{path}/epoch={max(before)}" if before else None


def update_stream(spark: SparkSession, source_dir: str, table_dir: str, checkpoint_dir: str,
                  clusters: Sequence[tuple[str, Sequence[str]]], schema_value_col: str = "value",
                  counts_dir: str | None = None, state_dir: str | None = None, state: DocumentState | None = None):
    """T4/T5 as a stream: each micro-batch is validated, routed and written per cluster under
    its epoch, replacing what an earlier try of the same batch wrote, so a replay does not
    duplicate.  ``counts_dir`` gets the number of messages by status (``missing_index`` for
    valid ones without a cluster), and with ``state`` the folder ``<counts_dir>-results`` the counters of what became of the
    routed ones (A16).  ``state`` holds the documents in buckets and takes the last update of each in the order of the
    messages; ``state_dir`` is the form for small tables, written whole under each epoch (first under ``epoch=-1``)."""
    def deliver(batch: DataFrame, epoch_id: int) -> None:
        checked = validate_updates(batch.withColumn("_at", F.monotonically_increasing_id()), schema_value_col).persist()
        routed = route_updates(checked.where(F.col("status") == "valid"), clusters)
        routed.drop("_at").write.mode("overwrite").partitionBy("cluster").parquet(f"{table_dir}/epoch={epoch_id}")
        if counts_dir:
            lost = F.when(F.col("cluster") == "missing_index", "missing_index").otherwise("valid")
            counts = routed.select(lost.alias("status")).unionByName(
                checked.where(F.col("status") != "valid").select("status"))
            validation_counts(counts).write.mode("overwrite").parquet(f"{counts_dir}/epoch={epoch_id}")
        if state is not None:
            applied = state.apply(routed.where(F.col("cluster") != "missing_index"), epoch_id, order="_at")
            if counts_dir:
                update_results(as_results(applied)).write.mode("overwrite").parquet(f"{counts_dir}-results/epoch={epoch_id}")
            applied.unpersist()
        before = _last_state(spark, state_dir, epoch_id) if state_dir else None
        if before:
            current = spark.read.parquet(before)
            applied = apply_updates(routed.where(F.col("cluster") != "missing_index"), current)
            upsert(applied, current, order="_at").write.mode("overwrite").parquet(f"{state_dir}/epoch={epoch_id}")
        checked.unpersist()

    return (spark.readStream.text(source_dir).writeStream
            .option("checkpointLocation", checkpoint_dir).foreachBatch(deliver))
