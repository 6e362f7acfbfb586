import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankwright.streaming import counters, responses, updates


def _by_the_rules(samples, alpha, max_sec_valid):
    """(accepted, ema, valid) of samples of one key, told sample by sample."""
    out, seen, ema = [], None, None
    for t, c in samples:
        ok = seen is None
        if seen is not None and t >= seen[0] + 1:
            per_second = (c - seen[1]) / (t - seen[0])
            if per_second < 0:
                per_second = None if ema is None else 1.25 * ema
            if per_second is not None:
                ok = True
                steps = int(t - seen[0])
                ema = per_second if ema is None else per_second + (ema - per_second) * (1 - alpha) ** steps
        if ok:
            seen = (t, c)
        out.append((ok, ema, ema is not None and t < seen[0] + max_sec_valid))
    return out


def _random_samples(seed, n=160):
    rng = np.random.default_rng(seed)
    t = np.cumsum(rng.choice([0.0, 0.25, 0.5, 1.0, 3.5, 40.0], n))
    c, samples = 50.0, []
    for at in t:
        c = rng.integers(0, 9) if rng.random() < 0.08 else c + rng.integers(0, 30)
        samples.append((float(at), float(c)))
    return samples


def _same(got, want):
    assert len(got) == len(want)
    for (a, e, v), (wa, we, wv) in zip(got, want):
        assert (a, v) == (wa, wv)
        assert (e is None or np.isnan(e)) if we is None else e == pytest.approx(we)


@pytest.mark.parametrize("seed, cuts", [(1, [160]), (2, [1, 30, 31, 160]), (3, [0, 80, 160])])
def test_follow_keeps_its_state_over_batches(seed, cuts):
    samples, last, got, at = _random_samples(seed), None, [], 0
    for cut in cuts:
        part = np.array(samples[at:cut]).reshape(-1, 2)
        accepted, since, value, last = counters.follow(part[:, 0], part[:, 1], 0.2, last)
        got += [(bool(a), v, bool(not np.isnan(v) and t < s + 30)) for a, s, v, t in zip(accepted, since, value, part[:, 0])]
        at = cut
    _same(got, _by_the_rules(samples, 0.2, 30))


@pytest.mark.parametrize("range_rows", [7, 60, 100_000])
def test_batch_scan_equals_rules(spark, monkeypatch, range_rows):
    monkeypatch.setattr("rankwright.streaming.ema_scan.RANGE_ROWS", range_rows)
    keyed = {k: _random_samples(k) for k in (4, 5)}
    rows = [(k, i, t, c) for k, own in keyed.items() for i, (t, c) in enumerate(own)]
    df = spark.createDataFrame(rows, "key int, id long, t double, c double")
    got = {(r.key, r.id): (r.accepted, r.ema, r.valid) for r in counters.counter_rate_ema(df, "key", "t", "c", "id", 0.2, 30).collect()}
    for k, own in keyed.items():
        _same([got[k, i] for i in range(len(own))], _by_the_rules(own, 0.2, 30))


def test_stream_equals_rules(spark, tmp_path):
    samples = _random_samples(6, 40)
    schema = "key string, t double, c double"
    src = tmp_path / "in"
    for part, own in enumerate((samples[:25], samples[25:])):
        spark.createDataFrame([("k", t, c) for t, c in own], schema).coalesce(1).write.parquet(str(src / f"p{part}"))
        stream = spark.readStream.schema(schema).parquet(str(src / "*"))
        q = (counters.counter_ema_stream(stream, "key", "t", "c", 0.2, 30).writeStream.format("parquet")
             .option("path", str(tmp_path / "out")).outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start())
        q.processAllAvailable()
        q.stop()
    got = sorted((r.t, r.c, r.accepted, r.ema, r.valid) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted((t, c, *w) for (t, c), w in zip(samples, _by_the_rules(samples, 0.2, 30)))
    assert len(got) == len(want) and sum(g[2] for g in got) == sum(w[2] for w in want)


def test_load_gate(spark):
    rows = [("a", 0.0, 0.0), ("a", 10.0, 10.0), ("b", 0.0, 0.0), ("b", 10.0, 10000.0), ("c", 0.0, 1.0)]
    df = spark.createDataFrame(rows, "key string, t double, c double")
    ema = counters.counter_rate_ema(df, "key", "t", "c")
    gate = {r.key: r.allowed for r in counters.load_gate(ema, "key", "t", 100.0, 20.0, 60).collect()}
    assert gate == {"a": True, "b": False, "c": False}
    late = {r.key: r.allowed for r in counters.load_gate(ema, "key", "t", 100.0, 100.0, 60).collect()}
    assert late["a"] is False


def test_update_result_counters(spark):
    kinds = {(True, 200, "updated"): "updated", (True, 201, "created"): "created", (True, 200, "noop"): "noop",
             (True, 200, "merged"): "ok_unknown", (True, 200, None): "ok_unknown", (False, 404, None): "missing",
             (False, 409, "conflict"): "failed", (False, None, None): "failed"}
    rng = np.random.default_rng(12)
    rows, want = [], dict.fromkeys(updates.RESULT_COUNTERS, 0)
    for row, counter in kinds.items():
        n = int(rng.integers(0, 6))
        rows += [row] * n
        want[counter] += n
    df = spark.createDataFrame(rows, "ok boolean, status int, result string")
    assert {r.counter: r.n for r in updates.update_results(df).collect()} == want
    assert {r.n for r in updates.update_results(df.limit(0)).collect()} == {0}


def test_update_validation(spark):
    msgs = [
        {"_index": "en", "_id": 1, "_source": {"popularity_score": 0.5}},          # valid
        {"_index": "en", "_id": "x1", "_source": {"popularity_score": "0.5"}},     # valid (string)
        {"_index": "en", "_id": 1, "_source": {}},                                  # no field
        {"_index": "en", "_id": 1, "_source": {"other": 1}},                        # unknown field
        {"_index": "en", "_id": 1, "_source": {"popularity_score": 1}, "x": 1},     # extra key
        {"_index": 5, "_id": 1, "_source": {"popularity_score": 1}},                # bad index type
        {"_index": "en", "_id": 1.5, "_source": {"popularity_score": 1}},           # bad id type
        {"_index": "en", "_source": {"popularity_score": 1}},                       # missing id
        {"_index": "en", "_id": 1, "_source": {"popularity_score": None}},          # null field
        {"_index": "en", "_id": 1, "_source": {"popularity_score": [1]}},           # array field
        {"_index": None, "_id": 1, "_source": {"popularity_score": 1}},             # null index
        {"_index": "en", "_id": 1, "_source": None},                                # null source
        {"_index": "en", "_id": True, "_source": {"popularity_score": 1}},          # boolean id
        [1, 2], "str", 5, None,                                                     # no objects
    ]
    raw = [json.dumps(m) for m in msgs] + ["not json", "{broken", "", None]
    df = spark.createDataFrame([(v,) for v in raw], "value string")
    got = [r.status for r in updates.validate_updates(df).collect()]
    assert got == ["valid", "valid"] + ["fail_validate"] * 15 + ["bad_json"] * 4


def test_routing_and_noop(spark):
    df = spark.createDataFrame([("en", "1", 1.0), ("fr", "2", 1.0), ("es", "3", 1.0)],
                               "index string, doc_id string, popularity_score double")
    routed = {r.doc_id: r.cluster for r in updates.route_updates(df, [("a", ["en"]), ("b", ["en", "fr"])]).collect()}
    assert routed == {"1": "a", "2": "b", "3": "missing_index"}
    cur = spark.createDataFrame([("1", 0.9), ("2", 0.5)], "doc_id string, popularity_score double")
    res = {r.doc_id: r.result for r in updates.apply_updates(df, cur).collect()}
    assert res == {"1": "noop", "2": "updated", "3": "missing"}


def test_responses_and_markers(spark):
    env = [
        {"run_id": "r", "meta": {"wikiid": "w", "query": "q"}, "status_code": 200,
         "text": json.dumps({"hits": [{"pageid": 1}, {"pageid": 2}]})},
        {"run_id": "r", "meta": {"wikiid": "w", "query": "q"}, "status_code": 200,
         "text": json.dumps({"hits": [{"pageid": 2}]})},
        {"run_id": "r", "meta": {"wikiid": "w", "query": "z"}, "status_code": 500, "text": ""},
        {"run_id": "other", "meta": {"wikiid": "w", "query": "q"}, "status_code": 200,
         "text": json.dumps({"hits": [{"pageid": 9}]})},
    ]
    df = responses.parse_envelopes(spark.createDataFrame([(json.dumps(e),) for e in env], "value string"))
    got = sorted((r.query, r.hit_page_id) for r in responses.collect_responses(df, "r").collect())
    assert got == [("q", 1), ("q", 2)]
    markers = spark.createDataFrame([("r", True, 0), ("r", True, 1), ("r", True, 1), ("s", True, 0)],
                                    "run_id string, complete boolean, partition int")
    done = {r.run_id: r.complete for r in responses.run_complete(markers, 2).collect()}
    assert done == {"r": True, "s": False}


def test_response_stream_dedups_across_batches(spark, tmp_path):
    src = tmp_path / "resp"
    src.mkdir()
    env = {"run_id": "r", "meta": {"wikiid": "w", "query": "q"}, "status_code": 200,
           "text": json.dumps({"hits": [{"pageid": 1}, {"pageid": 2}]})}
    (src / "a.json").write_text(json.dumps(env) + "\n")
    q = (responses.stream_responses(spark, str(src), "r").writeStream.format("memory")
         .queryName("resp_out").outputMode("append")
         .option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    (src / "b.json").write_text(json.dumps(env) + "\n")   # replayed response
    q.processAllAvailable()
    q.stop()
    got = sorted((r.query, r.hit_page_id) for r in spark.sql("select * from resp_out").collect())
    assert got == [("q", 1), ("q", 2)]


def test_update_stream_state_counts_and_replay(spark, tmp_path):
    src, out, ck, counts, state = (str(tmp_path / x) for x in ("upd", "table", "ck", "counts", "state"))
    spark.createDataFrame([("1", 0.1), ("2", 0.1), ("9", 0.7)], "doc_id string, popularity_score double") \
        .write.parquet(f"{state}/epoch=-1")
    (tmp_path / "upd").mkdir()

    def message(index, doc, value):
        return json.dumps({"_index": index, "_id": doc, "_source": {"popularity_score": value}})

    def run(checkpoint):
        q = updates.update_stream(spark, src, out, checkpoint, [("a", ["en"]), ("b", ["fr"])], counts_dir=counts,
                                  state_dir=state).trigger(availableNow=True).start()
        q.awaitTermination(180)

    (tmp_path / "upd" / "a.txt").write_text("\n".join([
        message("en", 1, 0.5), message("fr", 2, 0.11), message("xx", 9, 5), message("en", 7, 1.0), "not json", "[]"]) + "\n")
    run(ck)
    run(ck + "-again")  # the same batch once more, as after a lost commit
    rows = sorted((r.doc_id, r.cluster) for r in spark.read.parquet(out).collect())
    assert rows == [("1", "a"), ("2", "b"), ("7", "a"), ("9", "missing_index")]
    assert {r.status: r.n for r in spark.read.parquet(counts).collect()} == {
        "valid": 3, "missing_index": 1, "bad_json": 1, "fail_validate": 1}
    after = {r.doc_id: r.popularity_score for r in spark.read.parquet(f"{state}/epoch=0").collect()}
    assert after == {"1": 0.5, "2": 0.1, "9": 0.7}  # changed, within a fifth, unroutable; 7 is not created


def _messages(*rows):
    return "\n".join(json.dumps({"_index": i, "_id": d, "_source": {"popularity_score": v}}) for i, d, v in rows) + "\n"


def test_document_state_rewrites_touched_buckets_and_keeps_the_last_update(spark, tmp_path):
    src, out, counts, at = (str(tmp_path / x) for x in ("upd", "table", "counts", "state"))
    state = updates.DocumentState(spark, at, buckets=8)
    docs = spark.range(200).select(F.col("id").cast("string").alias("doc_id"), F.lit(0.1).alias("popularity_score"))
    state.create(docs)
    (tmp_path / "upd").mkdir()

    def run(checkpoint):
        q = updates.update_stream(spark, src, out, checkpoint, [("a", ["en"])], counts_dir=counts, state=state) \
            .trigger(availableNow=True).start()
        q.awaitTermination(180)

    # the last of three wins although it is not the greatest; 5 is within a fifth, 999 does not exist, xx has no cluster
    (tmp_path / "upd" / "a.txt").write_text(_messages(("en", 3, 0.9), ("en", 3, 0.7), ("en", 3, 0.4), ("en", 5, 0.11), ("en", 999, 1.0), ("xx", 7, 5.0)))
    run(str(tmp_path / "ck"))
    first = {r.doc_id: r.popularity_score for r in state.read().collect()}
    run(str(tmp_path / "ck2"))  # the batch once more, as after a lost commit
    assert {r.doc_id: r.popularity_score for r in state.read().collect()} == first
    assert len(first) == 200 and first["3"] == 0.4 and {v for k, v in first.items() if k != "3"} == {0.1}
    written = [p.name for p in (tmp_path / "state" / "epoch=0").iterdir() if p.name.startswith("bucket=")]
    assert len(written) == 1 and len([p for p in (tmp_path / "state" / "epoch=-1").iterdir() if p.name.startswith("bucket=")]) == 8
    got = {r.counter: r.n for r in spark.read.parquet(counts + "-results/epoch=0").collect()}
    assert got == {"updated": 3, "noop": 1, "missing": 1, "created": 0, "ok_unknown": 0, "failed": 0}
    # a batch that changes nothing writes nothing; a later one builds on the buckets' last versions
    assert state.apply(spark.createDataFrame([("5", 0.1, 0)], "doc_id string, popularity_score double, _at bigint"), 1, order="_at") \
        .first().result == "noop"
    state.apply(spark.createDataFrame([("3", 5.0, 0), ("4", 6.0, 1)], "doc_id string, popularity_score double, _at bigint"), 2, order="_at")
    now = {r.doc_id: r.popularity_score for r in state.read().collect()}
    assert now["3"] == 5.0 and now["4"] == 6.0 and len(now) == 200
    assert {r.doc_id: r.popularity_score for r in state.read(before=2).collect()} == first
    state.vacuum(keep=1)
    assert {r.doc_id: r.popularity_score for r in state.read().collect()} == now


def test_completion_stream_reports_complete_and_timed_out_runs_once(spark, tmp_path):
    import time
    src = tmp_path / "markers"
    src.mkdir()

    def send(name, *rows):
        (src / name).write_text("".join(json.dumps({"run_id": r, "complete": c, "partition": p}) + "\n" for r, c, p in rows))

    send("a.json", ("full", True, 0), ("full", True, 1), ("full", True, 1), ("part", True, 0), ("part", None, None), ("part", True, 7))
    envelopes = responses.parse_envelopes(spark.readStream.text(str(src)))
    q = responses.completion_stream(envelopes, 2, timeout_ms=2500).writeStream.format("memory").queryName("completion_out") \
        .outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(processingTime="200 milliseconds").start()
    try:
        def reported():
            return sorted((r.run_id, r.n_partitions, r.complete) for r in spark.sql("select * from completion_out").collect())
        deadline = time.time() + 90
        while len(reported()) < 2 and time.time() < deadline:
            time.sleep(0.3)
        assert reported() == [("full", 2, True), ("part", 1, False)]
        read = sum(b["numInputRows"] for b in q.recentProgress)
        send("b.json", ("full", True, 0), ("part", True, 1), ("full", True, 1))  # too late and repeated
        while sum(b["numInputRows"] for b in q.recentProgress) < read + 3 and time.time() < deadline:
            time.sleep(0.3)  # batches go on for the timers, so there is no idle state to wait for
        time.sleep(3)
        assert reported() == [("full", 2, True), ("part", 1, False)]
    finally:
        q.stop()
