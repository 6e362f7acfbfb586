import pytest

from rankwright.operators.ranking_metrics import ndcg


import math


def _ndcg(labels, k):
    dcg = sum((2 ** l - 1) / math.log2(i + 2) for i, l in enumerate(labels[:k]))
    ideal = sorted(labels, reverse=True)
    idcg = sum((2 ** l - 1) / math.log2(i + 2) for i, l in enumerate(ideal[:k]))
    return dcg / idcg if idcg else 0.0


def _rows(spark, rows):
    return spark.createDataFrame(rows, "label int, hit_position int, query string, wikiid string")


@pytest.mark.parametrize("k", [1, 3, 6])
def test_ndcg_equals_formula(spark, k):
    shown = {("n1", "alpha"): [0, 2, 1, 0, 3], ("n1", "beta"): [1, 1], ("n2", "alpha"): [0, 0, 0, 0, 0, 2, 1]}
    df = _rows(spark, [(lab, i, q, w) for (w, q), labels in shown.items() for i, lab in enumerate(labels)])
    got = {r.wikiid: r.ndcg for r in ndcg(df, k, query_cols=["wikiid", "query"], tie_col=None).collect()}
    for w in ("n1", "n2"):
        own = [_ndcg(labels, k) for (x, _), labels in shown.items() if x == w]
        assert got[w] == pytest.approx(sum(own) / len(own))


def test_query_can_be_multiple_columns(spark):
    df = _rows(spark, [(4, 0, "foo", "bar"), (3, 1, "foo", "bar"), (1, 2, "foo", "bar"), (2, 3, "foo", "bar"),
                       (1, 0, "foo", "wot"), (3, 1, "foo", "wot"), (1, 2, "foo", "wot"), (4, 3, "foo", "wot")])
    got = {r.wikiid: r.ndcg for r in ndcg(df, 4, query_cols=["wikiid", "query"], tie_col=None).collect()}
    assert got["bar"] == pytest.approx(_ndcg([4, 3, 1, 2], 4))
    assert got["wot"] == pytest.approx(_ndcg([1, 3, 1, 4], 4))


def test_arbitrary_column_names_and_empty_queries(spark):
    df = spark.createDataFrame([(0, 0, "q", "w"), (0, 1, "q", "w"), (2, 0, "r", "w"), (0, 1, "r", "w")],
                               "rel int, pos int, qq string, site string")
    zero = {r.site: r.ndcg for r in ndcg(df, 10, "rel", "pos", "site", ["qq"], tie_col=None).collect()}
    skip = {r.site: r.ndcg for r in ndcg(df, 10, "rel", "pos", "site", ["qq"], tie_col=None,
                                          empty="skip").collect()}
    assert zero["w"] == pytest.approx(0.5)
    assert skip["w"] == pytest.approx(1.0)
