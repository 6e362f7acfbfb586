from rankwright.operators import features as FT
from rankwright.plans import workflows
from rankwright.sources import io
from rankwright.sources.tables import TRAIN_FEATURES, raw_click_log, training_rows
from tests.conftest import SF001


def test_end_to_end(spark, tmp_path):
    log = raw_click_log(spark, SF001)
    labeled, stats = workflows.build_labeled_dataset(
        log, samples_per_wiki=100_000, min_sessions=1, tolerance=0.05, iterations=5, min_docs=2, max_docs=10,
        output=str(tmp_path / "labeled"))
    assert set(stats) == {r.wikiid for r in log.select("wikiid").distinct().collect()}
    assert all(0 <= s["click_log_ndcg@10"] <= 1 for s in stats.values())
    back = spark.read.parquet(str(tmp_path / "labeled"))
    assert back.schema["label"].metadata["min_sessions_per_query"] == 1
    assert back.count() == labeled.count() > 0

    feats = FT.assemble(training_rows(spark, SF001).drop("label"), TRAIN_FEATURES)
    rows = FT.join_features(labeled.select("wikiid", "query", "norm_query_id", "hit_page_id", "label"), feats)
    folded, sizes = workflows.build_folds(rows, 2, output=str(tmp_path / "out"), group_cols=("norm_query_id",))
    assert sum(sizes.values()) == rows.count()
    assert io.read_stats_json(spark, str(tmp_path / "out" / "stats"))["num_folds"] == 2
    params, trials, model = workflows.train_and_tune(folded, sum(sizes.values()), initial_trees=2,
                                                     final_trees=None, iterations=1)
    assert trials.count() == 1 and len(model.trees) == 2 and params["num_rounds"] == 2
