"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from ..sources.tables import table
from . import alignment, chat, decontam, html_text, langid, lzprint, neardup, packing, phrases, pii, quality, substrings, tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op2_chat_format": chat.ORACLE,
    "op12_collocations": phrases.ORACLE,
    "op13_quality_rules": quality.ORACLE,
    "op6_repeated_strings": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
part AS (SELECT doc_id, k, substr(h, 2 * k + 1, 1098) AS p
         FROM (SELECT doc_id, h, unnest(range(0, greatest(0, length(h) // 2 - 49), 500)) AS k FROM d)),
s AS (SELECT doc_id, k + j AS i, substr(p, 2 * j + 1, 100) AS w
      FROM (SELECT doc_id, k, p, unnest(range(0, length(p) // 2 - 49)) AS j FROM part)),
m AS (SELECT w, min(doc_id) AS least FROM s GROUP BY w HAVING count(*) > 1),
hit AS (SELECT s.doc_id, s.i FROM s JOIN m ON s.w = m.w WHERE m.least < s.doc_id),
edge AS (SELECT doc_id, i, CASE WHEN i > lag(i) OVER o + 50 OR lag(i) OVER o IS NULL THEN 1 ELSE 0 END AS new
         FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
run AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM edge),
span AS (SELECT doc_id, k, min(i) AS a, max(i) + 50 AS b FROM run GROUP BY doc_id, k),
gap AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_byte FROM span),
cut AS (SELECT g.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last_byte,
               string_agg(substr(h, 2 * from_byte + 1, 2 * (a - from_byte)), '' ORDER BY a) AS kept
        FROM gap g JOIN d ON g.doc_id = d.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last_byte, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut ON d.doc_id = cut.doc_id
""",
    "op9_minhash_neardup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM (
         SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pair AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id
         GROUP BY ALL),
link AS (SELECT u, v FROM pair JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v
         WHERE 100 * k >= 85 * (x.n + y.n - k)),
both_ways AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach AS (SELECT u AS a, u AS b FROM both_ways UNION SELECT r.a, l.v FROM reach r JOIN both_ways l ON r.b = l.u),
comp AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, w.doc_id) AS component_id,
       w.doc_id = coalesce(c, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON comp.a = w.doc_id
""",
}


def query(key: str):
    def keep(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[key] = run
        return fn
    return keep


@query("op1_best_fit_packing")
def best_fit_packing(spark, sf_dir):
    """Every document packed into bins without conflicts of source or near duplicates."""
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


@query("op2_chat_format")
def chat_format(spark, sf_dir):
    """All conversations and conversation -1, digested from the formatted output."""
    rows = chat.with_control_conversation(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return chat.conversation_digest(chat.format_conversations(rows))


@query("op3_token_files")
def token_files(spark, sf_dir):
    """All documents written as token files, then digested from the files."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    tokens.write_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), folder)
    return tokens.read_digests(spark, folder)


@query("op4_html_text")
def html_main_text(spark, sf_dir):
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    found = pages.select("page_id", "url", html_text.extract(F.col("html")).alias("text"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op5_pii")
def pii_spans(spark, sf_dir):
    """Personal data of every document: counts by kind and span digests."""
    found = pii.pii_report(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "spans")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in pii.BASE_KINDS],
        F.sha2(pii.joined_spans(F.col("spans"), pii.BASE_KINDS), 256).alias("base_sha256"),
        pii.joined_spans(F.col("spans")).alias("spans"))


@query("op6_repeated_strings")
def repeated_strings(spark, sf_dir):
    """Bytes of every document that repeat 50-byte strings of smaller documents."""
    return substrings.repeated_strings(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op7_lz_fingerprint")
def lz_fingerprint(spark, sf_dir):
    """Phrase fingerprints of every document, its edited text, and their likeness to it and the next."""
    return lzprint.neighbour_likeness(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op8_decontamination")
def decontamination(spark, sf_dir):
    """Every (document, benchmark item) with a leaked passage."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontam.find_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


@query("op9_minhash_neardup")
def minhash_neardup(spark, sf_dir):
    """Near-duplicate component of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op10_language_id")
def language_id(spark, sf_dir):
    """Language of every document; the model learns from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op11_cross_tokenizer")
def cross_tokenizer(spark, sf_dir):
    """Alignment of every document under two tokenizers and how common its links are."""
    return alignment.align_corpus(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op12_collocations")
def collocations(spark, sf_dir):
    """The best phrases of every language over all documents."""
    return phrases.mine(table(spark, sf_dir, "documents", "text", "lang"))


@query("op13_quality_rules")
def quality_rules(spark, sf_dir):
    """Counts and verdict of every document under cutoffs certified on the labels."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    found = quality.quality_report(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
