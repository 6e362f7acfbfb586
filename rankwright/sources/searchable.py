"""Searchable documents with several text fields, from ``documents`` and parsed ``pages``.

One row a document: ``lang, doc_id``, the fields of ``FIELDS`` (null where a kind of document has none)
and the values of ``VALUES``.  A page's id is ``-1 - page_id``.  Everything is string functions
at the scan: tags, scripts, styles and comments are blanked, character references become
blanks.  A null text or html has null fields and is reported by ``unreadable``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

FIELDS = ("title", "redirect_title", "heading", "opening_text", "text", "category", "auxiliary_text", "suggest", "all", "all_near_match")
# Fields that are others one after another.
JOINED = {"suggest": ("title",), "all": ("title", "heading", "text", "auxiliary_text", "category"), "all_near_match": ("title",)}
VALUES = ("popularity_score", "incoming_links", "text_word_count", "text_bytes")
NO_LANGUAGE = "und"
# Fixed patterns; the SQL uses them too.
UNSEEN = (r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->")
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
HEADING = r"(?is)<h[1-6][^>]*>(.*?)</h[1-6]>"
PARAGRAPH = r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"
ASIDE = r"(?is)<(?:li|td|figcaption)(?:\s[^>]*)?>(.*?)</(?:li|td|figcaption)>"
LINK = r"(?i)<a\s"
LANG = r"""(?i)<html[^>]*\slang=["']?([a-z]+)"""
HOST = r"^[a-zA-Z]+://([^/?#]*)"
PATH = r"^[a-zA-Z]+://[^/?#]*([^?#]*)"
TAG = r"<[^>]*>"
REFERENCE = r"&[a-zA-Z#0-9]+;"
FIRST_SENTENCE = r"^[^.\n]*"
SHORT_LINE = r"(?m)^.{1,60}$"
OPENING = 200


def _plain(html: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(html, TAG, " "), REFERENCE, " ")


def _parts(html: Column, pattern: str) -> Column:
    return _plain(F.array_join(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), " \n "))


def page_documents(pages: DataFrame) -> DataFrame:
    seen = F.col("html")
    for pattern in UNSEEN:
        seen = F.regexp_replace(seen, pattern, " ")
    rows = pages.select("page_id", "url", "html", seen.alias("seen"))
    paragraphs = F.regexp_extract_all("seen", F.lit(PARAGRAPH), F.lit(1))
    found = rows.select(
        F.coalesce(F.nullif(F.lower(F.regexp_extract("html", LANG, 1)), F.lit("")), F.lit(NO_LANGUAGE)).alias("lang"),
        (-1 - F.col("page_id")).alias("doc_id"),
        _plain(F.regexp_extract("html", TITLE, 1)).alias("title"), F.regexp_extract("url", PATH, 1).alias("redirect_title"),
        _parts(F.col("seen"), HEADING).alias("heading"), _plain(F.get(paragraphs, F.lit(0))).alias("opening_text"),
        _plain(F.array_join(paragraphs, " \n ")).alias("text"), F.regexp_extract("url", HOST, 1).alias("category"),
        _parts(F.col("seen"), ASIDE).alias("auxiliary_text"),
        F.size(F.regexp_extract_all("seen", F.lit(LINK), F.lit(0))).cast("double").alias("incoming_links"),
        F.col("html").isNull().alias("unreadable"))
    return _finished(found)


def text_documents(documents: DataFrame) -> DataFrame:
    text = F.col("text")
    short = F.array_join(F.regexp_extract_all(text, F.lit(SHORT_LINE), F.lit(0)), " \n ")
    found = documents.select(
        F.coalesce("lang", F.lit(NO_LANGUAGE)).alias("lang"), F.col("doc_id").cast("long").alias("doc_id"),
        F.regexp_extract(text, FIRST_SENTENCE, 0).alias("title"), F.lit(None).cast("string").alias("redirect_title"), short.alias("heading"),
        F.substring(text, 1, OPENING).alias("opening_text"), text.alias("text"), F.col("source").alias("category"),
        F.lit(None).cast("string").alias("auxiliary_text"), F.size(F.split(text, "\n")).cast("double").alias("incoming_links"),
        text.isNull().alias("unreadable"))
    return _finished(found)


def _finished(rows: DataFrame) -> DataFrame:
    return rows.select(
        "lang", "doc_id", "title", "redirect_title", "heading", "opening_text", "text", "category", "auxiliary_text",
        F.col("title").alias("suggest"), F.concat_ws(" \n ", *JOINED["all"]).alias("all"),
        F.col("title").alias("all_near_match"),
        (F.char_length("text") / 1e6).alias("popularity_score"), "incoming_links",
        F.size(F.filter(F.split("text", r"\s+"), lambda w: F.length(w) > 0)).cast("double").alias("text_word_count"),
        F.octet_length("text").cast("double").alias("text_bytes"), "unreadable")


def searchable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` and ``pages`` as searchable documents."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return text_documents(docs).unionByName(page_documents(table(spark, sf_dir, "pages", "page_id", "url", "html")))


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_id, text``: the whole benchmark texts, and the titles of all pages (ids below 0)."""
    bench = table(spark, sf_dir, "benchmark", "item_id", "text")
    titles = table(spark, sf_dir, "pages", "page_id", "html").select(
        (-1 - F.col("page_id")).alias("item_id"), _plain(F.regexp_extract("html", TITLE, 1)).alias("text"))
    return bench.unionByName(titles)


def _sql(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _plain_sql(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, {_sql(TAG)}, ' ', 'g'), {_sql(REFERENCE)}, ' ', 'g')"


def _parts_sql(x: str, pattern: str) -> str:
    return _plain_sql(f"array_to_string(regexp_extract_all({x}, {_sql(pattern)}, 1), ' ' || chr(10) || ' ')")


_SEEN_SQL = "html"
for _pattern in UNSEEN:
    _SEEN_SQL = f"regexp_replace({_SEEN_SQL}, {_sql(_pattern)}, ' ', 'g')"

SEARCHABLE_SQL = f"""
sd0 AS (SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, doc_id, regexp_extract(text, {_sql(FIRST_SENTENCE)}) AS title, NULL AS redirect_title,
               array_to_string(regexp_extract_all(text, {_sql(SHORT_LINE)}), ' ' || chr(10) || ' ') AS heading,
               substr(text, 1, {OPENING}) AS opening_text, text, source AS category, NULL AS auxiliary_text,
               CAST(len(string_split(text, chr(10))) AS DOUBLE) AS incoming_links FROM documents
        UNION ALL
        SELECT coalesce(nullif(lower(regexp_extract(html, {_sql(LANG)}, 1)), ''), '{NO_LANGUAGE}') AS lang, -1 - page_id AS doc_id,
               {_plain_sql(f"regexp_extract(html, {_sql(TITLE)}, 1)")} AS title, regexp_extract(url, {_sql(PATH)}, 1) AS redirect_title,
               {_parts_sql("seen", HEADING)} AS heading,
               {_plain_sql(f"regexp_extract_all(seen, {_sql(PARAGRAPH)}, 1)[1]")} AS opening_text,
               {_parts_sql("seen", PARAGRAPH)} AS text, regexp_extract(url, {_sql(HOST)}, 1) AS category,
               {_parts_sql("seen", ASIDE)} AS auxiliary_text,
               CAST(len(regexp_extract_all(seen, {_sql(LINK)})) AS DOUBLE) AS incoming_links
        FROM (SELECT page_id, url, html, {_SEEN_SQL} AS seen FROM pages)),
sd AS (SELECT *, title AS suggest, concat_ws(' ' || chr(10) || ' ', title, heading, text, auxiliary_text, category) AS "all",
              title AS all_near_match, length(text) / 1e6 AS popularity_score,
              CAST(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: length(x) > 0)) AS DOUBLE) AS text_word_count,
              CAST(strlen(text) AS DOUBLE) AS text_bytes FROM sd0),
sq AS (SELECT item_id, text FROM benchmark
       UNION ALL SELECT -1 - page_id AS item_id, {_plain_sql(f"regexp_extract(html, {_sql(TITLE)}, 1)")} AS text FROM pages)"""
