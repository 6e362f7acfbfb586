import json

import pytest
from pyspark.sql import functions as F

from rankwright.functions.columns import normalise_query, parse_compact_ts, with_column_metadata
from rankwright.operators import features as FT
from rankwright.operators import rank_model
from rankwright.sources import io
from rankwright.sources.tables import TRAIN_FEATURES, training_rows
from tests.conftest import SF001


def test_delimited_and_json(spark, tmp_path):
    p = tmp_path / "f.tsv"
    p.write_text("enwiki\t12\t3.5\nfrwiki\tx\t1\n")
    df = io.read_delimited(spark, str(p), "wikiid string, page_id int, value double")
    assert [tuple(r) for r in df.collect()] == [("enwiki", 12, 3.5), ("frwiki", None, 1.0)]
    j = tmp_path / "f.json"
    j.write_text(json.dumps({"a": 1, "b": [1, 2]}) + "\n" + json.dumps({"a": 2}) + "\n")
    rows = io.read_json_lines(spark, str(j), "a int, b array<int>").collect()
    assert rows[0].b == [1, 2] and rows[1].b is None


def test_metadata_round_trip_and_partitioned_sink(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "wikiid string, x double")
    df = with_column_metadata(df, "x", {"features": ["x"]})
    io.write_with_metadata(df, str(tmp_path / "o"), {"x": {"num_folds": 3}}, partition_by=["wikiid"])
    back = spark.read.parquet(str(tmp_path / "o"))
    assert back.schema["x"].metadata == {"features": ["x"], "num_folds": 3}
    assert sorted(p.name for p in (tmp_path / "o").iterdir() if p.is_dir()) == ["wikiid=a", "wikiid=b"]


def test_stats_json(spark, tmp_path):
    stats = spark.createDataFrame([("a", 10), ("b", 5)], "wikiid string, num_obs long")
    io.write_stats_json(stats, str(tmp_path / "s"), {"num_features": 6})
    doc = io.read_stats_json(spark, str(tmp_path / "s"))
    assert doc["num_features"] == 6 and {w["wikiid"]: w["num_obs"] for w in doc["wikis"]} == {"a": 10, "b": 5}


def test_scalar_functions(spark):
    df = spark.createDataFrame([("20170102030405", "Running Dogs, the cats!", "enwiki")],
                               "ts string, q string, wiki string")
    r = df.select(parse_compact_ts("ts").alias("t"), normalise_query("q", "wiki").alias("n")).first()
    assert r.t == 1483326245
    assert r.n == "cats dogs runn the"  # suffixes only stripped from tokens longer than 4


def test_ranker_learns_and_round_trips(spark, tmp_path):
    rows = training_rows(spark, SF001)
    data = FT.assemble(rows, TRAIN_FEATURES).cache()
    model = rank_model.fit_ranker(data, {"num_rounds": 4, "max_depth": 3}, eval_every=2)
    assert len(model.trees) == 4 and [h[0] for h in model.history] == [2, 4]
    base = rank_model.evaluate(data.withColumn("prediction", F.lit(0.0)), None).agg(F.avg("ndcg")).first()[0]
    trained = rank_model.evaluate(data, model).agg(F.avg("ndcg")).first()[0]
    assert trained > base
    model.save(str(tmp_path / "m"))
    again = rank_model.RankModel.load(str(tmp_path / "m"))
    a = rank_model.score(data, model).select("prediction").collect()
    b = rank_model.score(data, again).select("prediction").collect()
    assert a == b


def test_profiles_and_params():
    assert rank_model.size_profile(9_000_000) == "xlarge"
    assert rank_model.size_profile(600) == "small"
    assert rank_model.size_profile(500) == "xsmall"
    p = rank_model.coerce_params({"max_depth": 4.0, "num_rounds": "7", "colsample_bytree": 0.9})
    assert p["max_depth"] == 4 and p["num_rounds"] == 7 and p["colsample"] == 0.9
    base, stages = rank_model.tune_stages(2_000_000)
    assert base["max_depth"] == 6 and len(stages) == 2 and stages[1][0]["num_rounds"] == 500
    c = rank_model.candidates(stages[0][0], 3, seed=1)
    assert len(c) == 3 and all(0.3 <= x["eta"] <= 0.6 for x in c)
    assert rank_model.candidates(stages[0][0], 3, seed=1) == c


def test_cv_summary(spark):
    trials = spark.createDataFrame([(0, 0.9, 0.8, -0.8), (1, 0.7, 0.6, -0.6)],
                                   "fold int, train_ndcg double, test_ndcg double, loss double")
    s = rank_model.cv_summary(trials).first()
    assert s.loss_mean == pytest.approx(-0.7) and s.loss_var == pytest.approx(0.01)
    assert s.gap_mean == pytest.approx(0.1) and s.gap_var == pytest.approx(0.0)


def test_wikis_by_size_and_per_wiki_assembly(spark):
    from rankwright.operators import selection
    df = spark.createDataFrame([("a", 1.0, 2.0, 3.0)] * 3 + [("b", 4.0, 5.0, 6.0)] * 5,
                               "wikiid string, x double, y double, z double")
    order = [r.wikiid for r in selection.wikis_by_size(df).collect()]
    assert order == ["b", "a"]
    vec = FT.assemble(df, ["x", "y", "z"])
    per = FT.assemble_per_wiki(vec, {"a": ["z", "x"], "b": ["y"]})
    got = {r.wikiid: list(r.features) for r in per.dropDuplicates(["wikiid"]).collect()}
    assert got == {"a": [3.0, 1.0], "b": [5.0]}
    assert per.schema["features"].metadata["wiki_features"] == {"a": ["z", "x"], "b": ["y"]}


def test_malformed_inputs_do_not_fail_jobs(spark):
    import json as _json
    from rankwright.streaming import updates
    df = spark.createDataFrame([("2017010203",), ("20170102030405",), ("garbage",)], "ts string")
    got = [r.t for r in df.select(parse_compact_ts("ts").alias("t")).collect()]
    assert got[1] == 1483326245 and got[2] is None
    msgs = spark.createDataFrame([(_json.dumps({"_index": "en", "_id": 1, "_source": {"popularity_score": "abc"}}),)],
                                 "value string")
    row = updates.validate_updates(msgs).first()
    assert row.status == "valid" and row.popularity_score is None


def test_registered_rankers_run_the_default_rounds(monkeypatch):
    from rankwright.plans import ranker_queries as rq
    seen = []

    class Stop(Exception):
        pass

    def stop(_, params, *args, **kwargs):
        seen.append(params.get("num_rounds", rank_model.DEFAULT_PARAMS["num_rounds"]))
        raise Stop

    monkeypatch.setattr(rq, "_vectors", lambda *_: None)
    monkeypatch.setattr(rq.folds, "group_k_fold", lambda *_, **__: None)
    monkeypatch.setattr(rank_model, "fit_ranker", stop)
    monkeypatch.setattr(rank_model, "cross_validate", stop)
    for query in (rq.q_ranker_scores, rq.q_ranker_eval, rq.q_ranker_cv):
        with pytest.raises(Stop):
            query(None, "")
    assert seen == [100, 100, 100]


def test_ranker_rows_are_read_from_the_log_once(spark):
    from rankwright.plans import ranker_queries as rq
    data = rq._vectors(spark, SF001)
    assert "FileScan" not in data._jdf.queryExecution().executedPlan().toString()
    assert FT.feature_names(data) == list(TRAIN_FEATURES)
