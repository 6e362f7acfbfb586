import json

import numpy as np
import pytest

from rankwright.operators import click_model
from rankwright.sources.click_sessions import read_click_sessions_tsv, tsv_sessions_as_hits

# The six click-model sessions of the golden test (query, region,
# urls, clicks) and the relevances expected after one EM iteration with
# default relevance 0.5 and gamma 0.9.
URLS = ["1111", "2222", "3333", "4444"]
SESSIONS = [
    ("12345", "foowiki", URLS, [False, True, False, False]),
    ("12345", "foowiki", URLS, [True, False, False, False]),
    ("12345", "foowiki", URLS, [True, False, False, False]),
    ("23456", "foowiki", URLS, [False, False, False, True]),
    ("23456", "foowiki", URLS, [False, False, True, True]),
    ("23456", "foowiki", URLS, [False, True, False, False]),
]
EXPECTED = {
    ("23456", "1111"): 0.1,
    ("23456", "2222"): 0.2322820037105751,
    ("23456", "3333"): 0.16054421768707483,
    ("23456", "4444"): 0.3424860853432282,
    ("12345", "1111"): 0.38878221072530095,
    ("12345", "2222"): 0.33396748936638354,
    ("12345", "3333"): 0.23195153695743548,
    ("12345", "4444"): 0.23523307569244717,
}


@pytest.fixture(scope="module")
def tsv(tmp_path_factory):
    p = tmp_path_factory.mktemp("dbn") / "sessions.tsv"
    lines = []
    for q, region, urls, clicks in SESSIONS:
        layout = [False] * len(urls)
        lines.append("\t".join(["0", q, region, "0", json.dumps(urls), json.dumps(layout).lower(),
                                json.dumps(clicks).lower()]))
    p.write_text("\n".join(lines) + "\n")
    return str(p)


@pytest.mark.parametrize("max_patterns", [200_000, 0])
def test_golden_relevances(spark, tsv, max_patterns):
    sessions = tsv_sessions_as_hits(read_click_sessions_tsv(spark, tsv), 1, 20)
    rel = click_model.click_model(sessions, iterations=1, default_rel=0.5, gamma=0.9,
                                  max_patterns_per_task=max_patterns, page_type="string")
    got = {(r.norm_query_id, r.hit_page_id): r.relevance for r in rel.collect()}
    assert len(got) == 8
    for k, v in EXPECTED.items():
        assert abs(got[k] - v) < 1e-9, k


def test_tsv_bad_json_reads_empty(spark, tmp_path):
    p = tmp_path / "bad.tsv"
    p.write_text("0\tq\tw\t0\t[1, \"a\"]\tl\t[true]\n0\tq\tw\t0\t{\"a\": 1}\tl\t[true, 3]\n"
                 "0\tq\tw\t0\t[\"a\", \"b\"]\tl\t[false, true]\n")
    rows = read_click_sessions_tsv(spark, str(p)).collect()
    assert [len(r.urls) for r in rows] == [0, 0, 2]
    assert [len(r.clicks) for r in rows] == [1, 0, 2]


def test_truncation_and_padding(spark, tmp_path):
    p = tmp_path / "s.tsv"
    urls31 = [str(i) for i in range(31)]
    rows = [
        ("a", urls31, [False, False, True]),   # cut to 20, clicks padded
        ("b", [], [True]),                      # no urls -> dropped
        ("c", ["1", "2"], [False, False]),      # no click -> dropped
        ("d", ["1", "2", "3"], [True]),         # short clicks padded
    ]
    p.write_text("".join(f"0\t{q}\tw\t0\t{json.dumps(u)}\tl\t{json.dumps(c).lower()}\n" for q, u, c in rows))
    out = {r.norm_query_id: r.hits for r in tsv_sessions_as_hits(read_click_sessions_tsv(spark, str(p)), 1, 20)
           .collect()}
    assert sorted(out) == ["a", "d"]
    assert len(out["a"]) == 20 and [h.clicked for h in out["a"]][:3] == [False, False, True]
    assert [h.clicked for h in out["d"]] == [True, False, False]


def test_session_posterior_sums():
    # 20 positions, a = s = 0.5, gamma 0.9: click at 0 only, then also at 10.
    n = 20
    a = np.full((1, n), 0.5)
    s = np.full((1, n), 0.5)
    mask = np.ones((1, n), bool)
    c = np.zeros((1, n), bool)
    c[0, 0] = True
    ea, es = click_model.estep(a, s, c, mask, 0.9)
    assert abs(ea.sum() - 10.4370) < 1e-4 and abs(es[c].sum() - 0.8461) < 1e-4
    c[0, 10] = True
    ea, es = click_model.estep(a, s, c, mask, 0.9)
    assert abs(ea.sum() - 6.4347) < 1e-4 and abs(es[c].sum() - 0.8457) < 1e-4


def test_empty_input(spark):
    df = spark.createDataFrame([], "wikiid string, norm_query_id bigint, "
                                   "hits array<struct<mean_position:double,hit_page_id:int,clicked:boolean>>")
    assert click_model.click_model(df).count() == 0


def test_distributed_em_equals_local(spark):
    import random
    rng = random.Random(5)
    rows = []
    for q in range(6):
        for _ in range(40):
            n = rng.randint(2, 6)
            pages = rng.sample(range(10), n)
            hits = [(float(i), pages[i], rng.random() < 0.3) for i in range(n)]
            rows.append(("w", q, hits))
    df = spark.createDataFrame(rows, "wikiid string, norm_query_id bigint, "
                                     "hits array<struct<mean_position:double,hit_page_id:int,clicked:boolean>>")
    local = {(r.norm_query_id, r.hit_page_id): r.relevance for r in
             click_model.click_model(df, iterations=5).collect()}
    dist = {(r.norm_query_id, r.hit_page_id): r.relevance for r in
            click_model.click_model(df, iterations=5, max_patterns_per_task=0).collect()}
    assert local.keys() == dist.keys()
    assert all(abs(local[k] - dist[k]) < 1e-12 for k in local)


def test_large_groups_have_their_own_call(spark, monkeypatch):
    """Groups that fill half a bucket never meet in one call, whatever they hash to; the rest share calls."""
    hits = [(q, p, [(0.0, p, False), (1.0, p + 1, True)]) for q in range(30) for p in range(4)]
    df = spark.createDataFrame([("w", q, h) for q, _, h in hits],
                               "wikiid string, norm_query_id bigint, hits array<struct<mean_position:double,hit_page_id:int,clicked:boolean>>")
    whole = {(r.norm_query_id, r.hit_page_id): r.relevance for r in click_model.click_model(df, iterations=3).collect()}
    real = click_model._local_fn

    def counted(group_cols, *args):
        fit = real(group_cols, *args)

        def run(pdf):
            assert len(pdf[list(group_cols)].drop_duplicates()) == 1
            return fit(pdf)
        return run

    monkeypatch.setattr(click_model, "_local_fn", counted)
    apart = click_model.click_model(df, iterations=3, patterns_per_bucket=4).collect()
    assert {(r.norm_query_id, r.hit_page_id): r.relevance for r in apart} == whole


def test_sent_parameters_equal_joined_ones(spark, monkeypatch):
    """Large groups: parameters sent to every task, or joined where the pages are too many; pages and groups that look alike."""
    import random
    rng = random.Random(9)
    rows = []
    for wiki, q in (("w", 1), ("w", 11), ("w1", 1), ("v", None), (None, 2)):
        for _ in range(60):
            n = rng.randint(1, 7)
            pages = rng.sample(range(12), n)
            rows.append((wiki, q, [(float(i), pages[i], rng.random() < 0.4) for i in range(n)]))
    df = spark.createDataFrame(rows, "wikiid string, norm_query_id bigint, "
                                     "hits array<struct<mean_position:double,hit_page_id:int,clicked:boolean>>")

    def got(**more):
        return {(r.wikiid, r.norm_query_id, r.hit_page_id): r.relevance for r in click_model.click_model(df, iterations=6, **more).collect()}

    local = got()
    assert len({k[:2] for k in local}) == 3  # groups without a key are left out
    monkeypatch.setattr(click_model, "_train_distributed", None)
    sent = got(max_patterns_per_task=0)
    mixed = got(max_patterns_per_task=58)
    monkeypatch.undo()
    monkeypatch.setattr(click_model, "SENT_PAGES", 0)
    joined = got(max_patterns_per_task=0)
    for other in (sent, mixed, joined):
        assert other.keys() == local.keys() and all(abs(local[k] - other[k]) < 1e-12 for k in local)


def test_packed_patterns_are_stepped_in_slices(monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 6, 50)
    rows = pa.record_batch([pa.array(["g"] * 50), pa.array([rng.integers(0, 8, n).tolist() for n in lengths]), pa.array([(rng.random(n) < 0.4).tolist() for n in lengths]),
                            pa.array(rng.integers(1, 9, 50))], ["_group", "pages", "clicks", "weight"])

    def sent(value):
        return type("Sent", (), {"value": value})

    packed = list(click_model._pack(sent((pa.array(["g"]), pa.array(range(8)), np.arange(8))), iter([rows])))
    params = (np.linspace(0.2, 0.8, 8), np.linspace(0.7, 0.3, 8))
    whole = next(click_model._packed_sums(sent(params), 0.9, iter(packed))).to_pydict()
    monkeypatch.setattr(click_model, "STEP_PATTERNS", 3)
    sliced = next(click_model._packed_sums(sent(params), 0.9, iter(packed))).to_pydict()
    assert whole["page"] == sliced["page"] and all(np.allclose(whole[c], sliced[c], rtol=0, atol=1e-12) for c in ("a1", "a0", "s1", "s0"))
    assert abs(sum(whole["a1"]) + sum(whole["a0"]) - sum(w * n for w, n in zip(rows["weight"].to_pylist(), lengths))) < 1e-9
