"""Click-log scan, request envelopes, bounded response reads, completion, composite ids."""

import json

from pyspark.sql import functions as F

from rankwright.functions.columns import query_key
from rankwright.operators import clicks
from rankwright.streaming import responses


def test_click_log_scan_prunes_and_cleans(spark, tmp_path):
    rows = [("eu", 3, "q1", "s1", [1, 2], [2], 2020), ("eu", 80, "q1", "s2", [1], [], 2020),
            ("us", 1, "q2", "s3", [5, 6, 7], [7, 5], 2021), ("xx", 1, "q3", "s4", [9], [], 2021)]
    df = spark.createDataFrame(rows, "wikiid string, q_by_ip_day int, query string, session_id string, h array<int>, c array<int>, year int")
    pages = lambda c: F.transform(c, lambda p: F.struct(p.alias("pageid")))
    df = df.withColumn("hits", pages(F.col("h"))).withColumn("clicks", pages(F.col("c"))).drop("h", "c")
    df.write.partitionBy("year").parquet(str(tmp_path / "log"))
    log = clicks.read_click_log(spark, str(tmp_path / "log"), wikis=["eu", "us"], max_ip_queries=50)
    assert {r.session_id: (r.hit_page_ids, r.click_page_ids) for r in log.collect()} == {
        "s1": ([1, 2], [2]), "s3": ([5, 6, 7], [7, 5])}
    one_year = log.where("year = 2021")
    assert "PartitionFilters: [isnotnull(year" in one_year._jdf.queryExecution().toString()
    hits = clicks.explode_hits(one_year).orderBy("hit_position").collect()
    assert [(h.hit_page_id, h.hit_position, h.clicked) for h in hits] == [(5, 0, True), (6, 1, False), (7, 2, True)]


def test_requests_responses_and_completion(spark, tmp_path):
    asked = spark.createDataFrame([("eu", f"q{i}", f"find {i}") for i in range(6)], "wikiid string, query string, body string").repartition(3)
    batch = responses.request_batch(asked, "run7", "body", ["wikiid", "query"])
    responses.write_envelopes(batch, str(tmp_path / "requests"))
    sent = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "requests")).collect()]
    assert sorted(m["request"] for m in sent) == [f"find {i}" for i in range(6)]
    assert all(m["run_id"] == "run7" and set(m["meta"]) == {"wikiid", "query"} for m in sent)
    answers = [{"run_id": m["run_id"], "meta": m["meta"], "status_code": 200, "text": json.dumps({"hits": [{"pageid": len(m["request"])}]})} for m in sent]
    spark.createDataFrame([(json.dumps(a),) for a in answers + answers[:2]], "value string").write.text(str(tmp_path / "answers"))
    responses.write_envelopes(responses.end_markers(asked, "run7"), str(tmp_path / "answers"))
    got = responses.read_responses(spark, str(tmp_path / "answers"))
    assert sorted(r["query"] for r in responses.collect_responses(got, "run7").collect()) == [f"q{i}" for i in range(6)]
    n = asked.select(F.spark_partition_id()).distinct().count()
    done = {r.run_id: r.complete for r in responses.run_complete(got, n).collect()}
    assert done == {"run7": True}
    assert not responses.run_complete(got, n + 1).first().complete


def test_query_key_never_collides(spark):
    rows = [("a", "b", None), ("a", None, "b"), (None, "a", "b"), ("a\",\"b", None, None), ("ab", "", None), ("a", "b", "")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    assert df.select(query_key("x", "y", "z").alias("k")).distinct().count() == len(rows)
