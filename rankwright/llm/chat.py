r"""Chat formatting by grammar round trip, in DataFrame functions only.

Grammar of a formatted conversation (deterministic, no look-ahead beyond ``</s>``)::

    conversation := turn*
    turn         := "<s>[" role "] " text "</s>"

Inside role and text a backslash takes the next character literally.  A turn is
first rendered as it is; the rendered conversation is parsed and compared with
the source, and the turns whose content conflicts with the grammar (a backslash
or a control string, in a role also ``]``) are escaped until the parse gives the
source back.  Escaping is its own inverse under the parser, so the second
rendering is final; a conversation that still differs raises.

Loss mask: the text of the assistant turns, given as character spans
(``start``, ``end`` exclusive, code points) of the formatted string.

Edge cases: null role or text counts as empty; rows of one conversation are
ordered by turn (nulls first), ties by role, then text; repeated rows are
repeated turns; a null ``conv_id`` is one conversation of its own; an empty table
gives an empty result; extra columns of the input are not carried.
A conversation is one output value, so its turns meet in one task by nature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
TURNS = "array<struct<role:string,text:string>>"


def escape(c: Column, role: bool = False) -> Column:
    r"""Double backslashes and break control strings with one (``<\s>``, ``<\/s>``, ``\]``)."""
    out = F.regexp_replace(c, r"\\", r"\\\\")
    out = F.regexp_replace(out, r"<(/?s>)", r"<\\$1")
    return F.regexp_replace(out, r"\]", r"\\]") if role else out


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def conflicts(turn: Column) -> Column:
    """Whether a turn, rendered as it is, would not be read back as it is."""
    return turn["role"].rlike(r"[\\\]]|</?s>") | turn["text"].rlike(r"\\|</?s>")


def render_turn(turn: Column, escaped: Column) -> Column:
    role = F.when(escaped, escape(turn["role"], True)).otherwise(turn["role"])
    text = F.when(escaped, escape(turn["text"])).otherwise(turn["text"])
    return F.concat(F.lit(OPEN + "["), role, F.lit("] "), text, F.lit(CLOSE))


def render(turns: Column, escaped: Column | None = None) -> Column:
    """Formatted conversation; ``escaped`` (boolean) asks for escapes in conflicting turns."""
    flag = F.lit(False) if escaped is None else escaped
    return F.array_join(F.transform(turns, lambda t: render_turn(t, flag & conflicts(t))), "")


_HEAD = r"(?s)^<s>\[((?:[^\\\]]++|\\.)*+)\] "


def raw_turns(formatted: Column) -> Column:
    """Turns of a formatted conversation as written (still escaped)."""
    # every "</s>" ends a turn: an escaped text holds none
    pieces = F.split(formatted, CLOSE, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    return F.transform(pieces, lambda p: F.struct(
        F.regexp_extract(p, _HEAD, 1).alias("role"),
        F.regexp_replace(p, _HEAD, "").alias("text")))


def parse(formatted: Column) -> Column:
    """Turns read back from a formatted conversation (``TURNS``)."""
    return F.transform(raw_turns(formatted), lambda t: F.struct(
        unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")))


def loss_spans(formatted: Column, role: str = "assistant") -> Column:
    """``[start, end)`` of the texts under the loss mask, as code points of ``formatted``."""
    walk = F.aggregate(
        raw_turns(formatted),
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.char_length(t["role"]) + F.char_length(t["text"])
             + len(OPEN) + len("[] ") + len(CLOSE)).cast("long").alias("at"),
            F.when(unescape(t["role"]) == role, F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.char_length(t["role"]) + len(OPEN) + 3).cast("long").alias("start"),
                (acc["at"] + F.char_length(t["role"]) + len(OPEN) + 3 + F.char_length(t["text"])).cast("long").alias("end")))))
            .otherwise(acc["spans"]).alias("spans")))
    return walk["spans"]


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, n_escaped``.

    ``rows`` has ``conv_id, turn, role, text``.  One shuffle by ``conv_id``."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    convs = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    turns = F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    convs = convs.select("conv_id", turns.alias("turns"))
    convs = convs.select("conv_id", "turns", render(F.col("turns")).alias("plain"))
    convs = convs.select("conv_id", "turns", "plain", (parse(F.col("plain")) == F.col("turns")).alias("same"))
    convs = convs.select("conv_id", "turns", F.when(F.col("same"), F.col("plain")).otherwise(
        render(F.col("turns"), ~F.col("same"))).alias("formatted"),
        F.when(F.col("same"), 0).otherwise(F.size(F.filter("turns", conflicts))).cast("long").alias("n_escaped"))
    back = F.when(parse(F.col("formatted")) == F.col("turns"), F.col("formatted")).otherwise(
        F.raise_error(F.concat(F.lit("conversation cannot be formatted reversibly: "),
                               F.coalesce(F.col("conv_id").cast("string"), F.lit("null")))))
    return convs.select("conv_id", back.alias("formatted"), "n_escaped")


def conversation_digest(formatted: DataFrame) -> DataFrame:
    """Digest columns read back from ``format_conversations`` output."""
    turns = parse(F.col("formatted"))
    read = formatted.select("conv_id", "formatted", "n_escaped", turns.alias("turns"), F.transform(
        loss_spans(F.col("formatted")),
        lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    ).alias("loss"))
    read = read.withColumn("loss_text", F.array_join("loss", ""))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
        .alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "n_escaped")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def with_control_conversation(rows: DataFrame) -> DataFrame:
    """``rows`` and conversation -1, whose texts are control strings of common templates."""
    spark = rows.sparkSession
    extra = spark.range(1).select(F.explode(F.array(
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"),
                 F.lit("user").alias("role"), F.lit(CONTROL_TEXT).alias("text")),
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("turn"),
                 F.lit("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text")))).alias("r")).select("r.*")
    return rows.select("conv_id", "turn", "role", "text").unionByName(extra)


ORACLE = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, (regexp_matches(role, '[\\\]]|</?s>') OR regexp_matches(text, '\\|</?s>')) AS bad FROM r),
w AS (
  SELECT *, 10 + length(CASE WHEN bad THEN regexp_replace(replace(replace(role, '\', '\\'), ']', '\]'), '<(/?s>)', '<\\\1', 'g') ELSE role END)
            + length(CASE WHEN bad THEN regexp_replace(replace(text, '\', '\\'), '<(/?s>)', '<\\\1', 'g') ELSE text END) AS n FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars,
       CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS n_escaped
FROM w GROUP BY conv_id
"""
