"""Packing, chat, HTML, personal data and language against brute force and small cases."""

import hashlib
import html as htmllib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from rankwright.llm import chat, html_text, langid, packing, pii, queries

SF001 = "/root/testdata/sf0.001"


# -- packing -----------------------------------------------------------------
def brute_pack(rows, capacity):
    """Best fit by scanning all open bins for the least residual."""
    out, bins = [], []

    def place(size, src, clu):
        ok = [(capacity - b["used"], k) for k, b in enumerate(bins) if capacity - b["used"] >= size
              and b["used"] < capacity and not (src is not None and src in b["src"]) and not (clu is not None and clu in b["clu"])]
        if ok:
            k = min(ok)[1]
        else:
            k = len(bins)
            bins.append({"used": 0, "src": set(), "clu": set()})
        bins[k]["used"] += size
        bins[k]["src"].add(src)
        bins[k]["clu"].add(clu)
        return k

    rest = []
    for i, (_, size, src, clu) in enumerate(rows):
        full, tail = divmod(size, capacity)
        out += [(i, p, p * capacity, capacity, place(capacity, src, clu)) for p in range(full)]
        if tail or not full:
            rest.append((-tail, rows[i][0], clu or 0, i, full))
    for neg, _, _, i, p in sorted(rest):
        out.append((i, p, p * capacity, -neg, place(-neg, rows[i][2], rows[i][3])))
    return out, [b["used"] for b in bins]


def test_packing_equals_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        rows = [(i, rng.choice([0, 1, 5, 9, 10, 11, 25, rng.randint(0, 40)]), rng.choice([None, "a", "b", "c"]),
                 rng.choice([None, 1, 2, 3, 4])) for i in range(rng.randint(0, 40))]
        assert packing.pack_shard(rows, 10) == brute_pack(rows, 10)


def test_packing_frame(spark):
    rows = [(1, "x" * 25, "s"), (2, "x" * 25, "t"), (3, None, None), (4, "", "s"), (None, "yy", "s"), (6, "z" * 5, "u"), (6, "z" * 5, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("bin_id", F.lit("clash"))
    got = packing.pack_documents(docs, capacity=10, shard_rows=2).collect()
    assert len(got) == 3 + 3 + 5
    assert sum(r["size"] for r in got) == 25 + 25 + 2 + 5 + 5
    for b in {r["bin_id"] for r in got}:
        own = [r for r in got if r["bin_id"] == b]
        assert sum(r["size"] for r in own) == own[0]["bin_used"] <= 10
        for key in ("source", "cluster"):
            known = [r[key] for r in own if r[key] is not None]
            assert key == "cluster" and not known or len(known) == len(set(known)) or len(own) == 1
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_packing_keeps_near_copies_apart(spark):
    words = [f"word{i}" for i in range(100)]
    near = [" ".join(words[:k] + ["other"] + words[k + 1:]) for k in (0, 30, 60, 99)]
    rows = [(i, t, f"s{i}") for i, t in enumerate([" ".join(words), *near])] + [(None, " ".join(words) + " end", "t"), (8, near[0], None)]
    rows += [(20 + i, None, None) for i in range(5)] + [(30, " ", None), (31, " ", None), (40, " ".join(words[::-1]), "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack_documents(docs).collect()
    assert len(got) == len(rows)
    bins = {}
    for r in got:
        bins.setdefault(r.doc_id, []).append(r.bin_id)
    copies = [bins[i][0] for i in (0, 1, 2, 3, 4, None, 8)]
    assert len(set(copies)) == 7 and len({r.cluster for r in got if r.doc_id in (0, 1, 2, 3, 4, None, 8)}) == 1
    assert all(r.cluster is None for r in got if r.doc_id in range(20, 25))
    assert len({bins[20 + i][0] for i in range(5)}) == 1  # null texts conflict with nothing
    assert bins[30] != bins[31] and bins[40][0] in copies


# -- chat --------------------------------------------------------------------
def test_chat_round_trip_of_hostile_texts(spark):
    rng = random.Random(5)
    bits = ["\\", "<s>", "</s>", "<\\s>", "[INST]", "]", "] ", "[", "a", "é\n", "$1", " ", "\\\\"]
    rows = [(c, t, rng.choice(["user", "assistant", "a]b", "\\", None, ""]),
             rng.choice([None, "", "".join(rng.choices(bits, k=rng.randint(0, 8)))]))
            for c in range(60) for t in range(rng.randint(1, 5))]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1))
    got = {r[0]: r for r in chat.format_conversations(frame).select(
        "conv_id", chat.parse(F.col("formatted")).alias("turns"), "formatted", chat.loss_spans(F.col("formatted")).alias("spans")).collect()}
    for c in range(60):
        own = [((r or ""), (t or "")) for cc, _, r, t in rows if cc == c]
        assert [tuple(x) for x in got[c]["turns"]] == own
        cut = [re.sub(r"(?s)\\(.)", r"\1", got[c]["formatted"][a:b]) for a, b in got[c]["spans"]]
        assert cut == [t for r, t in own if r == "assistant"]


def test_chat_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF001}/conversations.parquet'")
    want = sorted(con.execute(chat.ORACLE).fetchall())
    frame = queries.QUERIES["op2_chat_format"](spark, SF001)
    assert sorted(map(tuple, frame.collect())) == want
    minus = [r for r in frame.collect() if r.conv_id == -1][0]
    text = chat.CONTROL_TEXT
    assert minus.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert (minus.loss_chars, minus.loss_sha256) == (len(text), hashlib.sha256(text.encode()).hexdigest())


# -- HTML --------------------------------------------------------------------
def test_html_cases():
    page = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header>Site</header>
      <nav><a href=x>Home</a></nav><div class="cookie-notice">We use</div><div id="sidebar">Side</div>
      <article><h1>Head &amp; line</h1><p>Short.</p><p>A long para <b>bo</b>ld, with&nbsp;entities &#233; &lt;b&gt; and more text to read on.
      <div class="ad">Buy</div><p>Of.<form><input><label>Mail</label></form><script>var a="</p>";</script>
      <section class="comments"><p>Reader says a lot of words here that are not the article at all</p></section></article>
      <footer>foot</footer></body>"""
    assert html_text.main_text(page) == ("Head & line Short. A long para bold, with entities é <b> and more text to read on. Of.")
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<p></p>") == ""
    assert html_text.main_text("plain words only") == "plain words only"
    plain = "<body><div class=menu>a b</div><div><p>One long paragraph of running text that reads on.</p><p>Hm.</p><p>Another long paragraph of text.</p></div></body>"
    assert html_text.main_text(plain) == "One long paragraph of running text that reads on. Hm. Another long paragraph of text."
    assert html_text.main_text("<article>" + "x " * 200000 + "</article>") == ("x " * 200000).strip()
    assert html_text.main_text("<body><nav><ul><li>Home<article><p>The text of the page, long enough.</p></article>") == "The text of the page, long enough."
    assert html_text.main_text("<div " * 1000 + "<p>ok") is not None


def test_html_pages_without_container():
    long = "A long paragraph of running text that reads on and on, without a link."
    page = (f"<body><div class=menu>Home</div><div><h1>Head</h1><div>By me.</div><div><p>{long}</p><p>{long}</p></div>"
            f"<section><p>{long}</p></section><div>The end.</div></div><div><a>x</a> <a>y</a></div></body>")
    assert html_text.main_text(page) == f"Head By me. {long} {long} {long} The end."
    assert html_text.main_text(f"<div><h2>Head</h2><div>{long}</div><ul><li>So.</li></ul></div>") == f"Head {long} So."
    # a teaser in an article does not hide the text beside it; a short remark beside an article stays out
    text = f"<div><h1>Head</h1><p>{long}</p><p>{long}</p><p>{long}</p></div>"
    assert html_text.main_text(f"<body><article>See also.</article>{text}</body>") == f"See also. Head {long} {long} {long}"
    assert html_text.main_text(f"<body><p>{long}</p><article>{text}</article></body>") == f"Head {long} {long} {long}"


def test_html_query_equals_markup_strip(spark):
    got = {r.page_id: r for r in queries.QUERIES["op4_html_text"](spark, SF001).collect()}
    pages = duckdb.sql(f"select page_id, html from '{SF001}/pages.parquet'").fetchall()
    assert len(got) == len(pages)
    for pid, page in pages:
        inner = re.search(r"(?s)<article>(.*?)</article>", page)[1]
        want = " ".join(htmllib.unescape(re.sub(r"</?(?:p|h1|br)>", " ", inner).replace("<b>", "").replace("</b>", "")).split())
        assert got[pid].text == want and got[pid].n_chars == len(want)


# -- personal data -----------------------------------------------------------
BASE = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def brute_base(text):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 16 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0,
                  "phone": 8 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii_base_equals_patterns():
    rng = random.Random(9)
    for _ in range(20000):
        text = "".join(rng.choices("a1.@- 9+4()Z", k=rng.randint(0, 40)))
        assert [s[:3] for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS] == brute_base(text)
    for text in ("card 4111 1111 1111 1111, 4111-1111-1111-1111", "x" * 60000 + "@a.b", "1" * 60000, "+1" * 20000, "1." * 30000, None, ""):
        assert [s[:3] for s in pii.spans_of(text) if s[0] in pii.BASE_KINDS] == (
            brute_base(text) if len(text or "") < 1000 else [s[:3] for s in pii.spans_of(text)])


def test_pii_iban_and_redaction():
    text = "Bank account GB82 WEST 1234 5698 7654 32 and mail joe@x.org; GB82 WEST 1234 5698 7654 33"
    assert [s[0] for s in pii.spans_of(text)] == ["email", "iban"]
    assert pii.redact_text(text) == "Bank account <IBAN> and mail <EMAIL>; GB82 WEST 1234 5698 7654 33"
    assert pii.redact_text(None) is None and pii.redact_text("") == ""


def test_pii_query(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op5_pii"](spark, SF001).collect()}
    for doc_id, text in duckdb.sql(f"select doc_id, text from '{SF001}/documents.parquet'").fetchall():
        want = brute_base(text)
        assert got[doc_id].base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert got[doc_id].n_card == sum(k == "card" for k, _, _ in want)


# -- language ----------------------------------------------------------------
def test_language_tables_equal_network():
    import numpy as np
    model = langid.ByteCnn(["a", "b", "c"])
    x = langid.windows("Grüße aus Köln, señor! ".encode() * 40)
    h = np.concatenate([np.maximum(model.responses(x, k).max(axis=1), 0) for k in range(3)], axis=1)
    z = np.exp(h @ model.out + model.bias)
    assert np.allclose(langid.scorer(model).window_probabilities(x), z / z.sum(axis=1, keepdims=True), atol=1e-5)


def test_language_query_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").collect()}
    rows = duckdb.sql("select doc_id, lang from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, _ in rows)
    held = [got[d].lang_pred == lang for d, lang in rows if got[d].held_out]
    assert sum(held) / len(held) >= 0.97


def test_language_edges(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !?", None), (4, "word", None), (4, "word", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash")) \
        .withColumn("_lang", F.lit("clash"))
    got = langid.identify(docs, langid.fit(docs.limit(0))).collect()
    assert [r.lang_pred for r in got] == ["und"] * 5
    model = langid.train_model([("the cat and the dog", "en"), ("der Hund und die Katze", "de")])
    got = langid.identify(docs, model).collect()
    assert [r.lang_pred == "und" for r in got] == [True, True, True, False, False] and got[3][1:] == got[4][1:]
    assert all(r["_lang"] == "clash" for r in got)
    assert langid.identify(docs.limit(0), model).count() == 0


@pytest.mark.parametrize("key", ["op1_best_fit_packing", "op2_chat_format", "op4_html_text", "op5_pii"])
def test_queries_registered(key):
    import __spark_entry__
    assert key in __spark_entry__.queries()
