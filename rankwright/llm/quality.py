"""Quality rules whose cutoffs are certified on labelled documents.

A rule rejects a document when a measure of its text exceeds a cutoff.  The cutoffs on offer
are fixed in advance (``RULES``), so all labelled documents are a holdout for them.  In each
stratum (language), and for each rule, the cutoffs are tested from the most lenient to the
strictest: a cutoff is certified when the exact binomial (Clopper-Pearson) upper bound of
its false-rejection rate on documents labelled good is at most ``alpha`` divided by the number of
rules, and all more lenient ones are certified too (fixed-sequence testing, which costs no
correction inside a rule).  The level of each test is ``delta`` divided by rules times strata
(Bonferroni).  With probability ``1 - delta`` no stratum then loses more than ``alpha`` of its good
documents.  Of the certified cutoffs the one with the largest difference between the share
of bad and of good documents rejected is used (ties: the most lenient); a rule that rejects
no larger share of the bad than of the good, or without a certified cutoff, is off.

Everything is DataFrame functions: measures are one projection over whole texts, counts are one
aggregate with map-side partials (rules x cutoffs sums, no row is expanded), and the
binomial bound is the incomplete beta function as a continued fraction in column expressions.
Measures are written once to the shared checkpoint folder (about a hundred bytes a document).

Edge cases: a null or empty text has no words and fails the base rule; a null language
is stratum ``und``; labels of one document are combined to the worst; documents without a label, labels without
a document and null qualities are not counted; rows that share a ``doc_id`` are judged one by one; empty
tables give empty results; without labels only the base rule works; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
ALPHA = 0.05
DELTA = 0.05
NO_LANGUAGE = "und"
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
_BLANK = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """Reject when ``measure`` (thousandths, a long) is above the cutoff; cutoffs from lenient to strict."""
    name: str
    measure: str
    cutoffs: tuple[int, ...]


RULES = (
    Rule("symbols", "1000 * n_symbols div greatest(n_words, 1)", (2000, 1500, 1000, 800, 600, 400, 300, 200)),
    Rule("repeats", "1000 * n_repeat_words div greatest(n_words, 1)", (280, 250, 200, 150, 100, 50)),
    Rule("dup_lines", "1000 * n_dup_lines div greatest(n_lines, 1)", (800, 700, 600, 500, 400, 300, 200)),
    Rule("exclamations", "1000 * n_exclaims div greatest(n_words, 1)", (2000, 1500, 1000, 800, 600, 400, 300, 200)),
    Rule("long_words", "1000 * word_chars div greatest(n_words, 1)", (30000, 20000, 15000, 12000, 10000, 9000)),
    Rule("short_words", "-(1000 * word_chars div greatest(n_words, 1))", (-1500, -2000, -2500, -3000)),
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` reads it in a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.filter(F.split(text, _BLANK), lambda w: F.length(w) > 0)


def repeated_words(found: Column, width: int = WINDOW) -> Column:
    """Number of words inside windows of ``width`` words that occur twice or more among ``found``.

    Windows are compared by a hash of their words' hashes (64 bits).  Texts without a repeated
    window, the rule, are told by the number of distinct hashes; the others sort the
    windows by hash, keep the places of equal neighbours and add up what each place covers."""

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, j: F.least(F.coalesce(F.get(places, j + 1) - p, F.lit(width)), F.lit(width)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def among(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, j: (x["h"] == F.get(ordered, j - 1)["h"]) | (x["h"] == F.get(ordered, j + 1)["h"]))
        return let(F.sort_array(F.transform(twice, lambda x: x["p"])), covered)

    def by_windows(codes: Column) -> Column:
        return F.when(F.size(F.array_distinct(codes)) == F.size(codes), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(F.transform(codes, lambda h, p: F.struct(h.alias("h"), p.alias("p")))), among))

    def by_words(codes: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(codes) - width)
        return F.when(F.size(codes) <= width, F.lit(0).cast("long")).otherwise(let(
            F.transform(places, lambda i: F.xxhash64(*[F.get(codes, i + k) for k in range(width)])), by_windows))

    return let(F.transform(found, lambda w: F.xxhash64(w)), by_words)


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, stratum`` and the counts of every row of ``docs`` (``doc_id, text, lang``)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def without(chars: str) -> Column:
        return F.char_length(F.translate(text, chars, ""))

    def counts(found: Column) -> Column:
        return F.struct(F.size(found).cast("long").alias("n_words"), repeated_words(found).alias("n_repeat_words"))

    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, BLANKS, "")) > 0)
    rows = docs.select(
        F.col("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("stratum"),
        without(BLANKS).cast("long").alias("word_chars"),
        (F.char_length(text) - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.char_length(text) - without("!")).cast("long").alias("n_exclaims"),
        let(lines, lambda found: F.struct(F.size(found).cast("long").alias("n_lines"),
                                          (F.size(found) - F.size(F.array_distinct(found))).cast("long").alias("n_dup_lines"))).alias("l"),
        let(words(text), counts).alias("w"))
    return rows.select("doc_id", "stratum", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words",
                       "n_exclaims", "l.n_lines")


def _log_gamma(x: Column) -> Column:
    """Stirling's series at ``x + 8``, for ``x >= 1``."""
    y = x + 8.0
    r = 1.0 / (y * y)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r * (1 / 1188 - r * 691 / 360360))))) / y
    below = F.lit(0.0)
    for k in range(8):
        below = below + F.log(x + float(k))
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727418 + series - below


def binomial_cdf(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, rate) where k < n * rate (there a continued fraction converges
    fast); elsewhere 1, an upper bound, for the test fails there."""
    a, b, x = (n - k).cast("double"), (k + 1).cast("double"), 1.0 - rate
    tiny = 1e-300

    def safe(v: Column) -> Column:
        return F.when(F.abs(v) < tiny, F.lit(tiny)).otherwise(v)

    def step(state: Column, m: Column) -> Column:
        def half(s: Column, term: Column) -> Column:
            d = F.lit(1.0) / safe(F.lit(1.0) + term * s["d"])
            c = safe(F.lit(1.0) + term / s["c"])
            return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return let(half(state, even), lambda s: half(s, odd))

    d0 = F.lit(1.0) / safe(1.0 - (a + b) * x / (a + 1.0))
    steps = F.sequence(F.lit(1), (F.sqrt(a + b) * 4).cast("int") + 60)
    fraction = F.aggregate(F.transform(steps, lambda m: m.cast("double")),
                           F.struct(F.lit(1.0).alias("c"), d0.alias("d"), d0.alias("h")), step, lambda s: s["h"])
    front = F.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * F.log(F.lit(x)) + b * F.log(F.lit(rate)))
    return F.when(k < n * rate, F.least(front * fraction / a, F.lit(1.0))).otherwise(F.lit(1.0))


def thresholds(measured: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES, alpha: float = ALPHA,
               delta: float = DELTA) -> DataFrame:
    """``stratum, rule, cutoff, n_good, good_rejected, n_bad, bad_rejected, chosen`` of every rule and
    cutoff that was certified; ``labels`` has ``doc_id, quality`` (1 good, 0 bad)."""
    marks = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    known = measured.join(marks, "doc_id").withColumn("_good", (F.col("_quality") > 0).cast("int"))

    def total(flag: Column) -> Column:
        return F.coalesce(F.sum(flag.cast("long")), F.lit(0)).cast("long")

    good = F.col("_good") == 1
    cells = []
    for rule in rules:
        for level, cutoff in enumerate(rule.cutoffs):
            over = F.expr(rule.measure) > cutoff
            cells.append(F.struct(F.lit(rule.name).alias("rule"), F.lit(level).alias("level"), F.lit(cutoff).cast("long").alias("cutoff"),
                                  total(over & good).alias("good_rejected"), total(over & ~good).alias("bad_rejected")))
    counted = cut_lineage(known.groupBy("stratum").agg(
        total(good).alias("n_good"), total(~good).alias("n_bad"), F.array(*cells).alias("cells")))
    tests = max(1, len(rules) * counted.count())  # one row a stratum
    rows = counted.select("stratum", "n_good", "n_bad", F.inline("cells"))
    passed = binomial_cdf(F.col("good_rejected"), F.col("n_good"), alpha / len(rules)) <= delta / tests
    tested = rows.withColumn("_passed", passed & (F.col("n_good") > 0))
    first_failure = F.min(F.when(~F.col("_passed"), F.col("level")))
    limits = tested.groupBy("stratum", "rule").agg(first_failure.alias("_stop"))
    certified = tested.join(limits, ["stratum", "rule"]).where("_stop is null or level < _stop")
    # difference of the two shares, as a whole number; a rule that gains nothing stays off
    gain = F.col("bad_rejected").cast("decimal(19,0)") * F.col("n_good").cast("decimal(19,0)") \
        - F.col("good_rejected").cast("decimal(19,0)") * F.col("n_bad").cast("decimal(19,0)")
    certified = certified.withColumn("_gain", gain)
    best = certified.where("_gain > 0").groupBy("stratum", "rule").agg(
        F.max(F.struct("_gain", (-F.col("level")).alias("lenient"))).alias("_best")).select(
            "stratum", "rule", (-F.col("_best.lenient")).alias("_level"))
    return certified.join(best, ["stratum", "rule"], "left").select(
        "stratum", "rule", "cutoff", "n_good", "good_rejected", "n_bad", "bad_rejected",
        F.coalesce(F.col("level") == F.col("_level"), F.lit(False)).alias("chosen"))


def judge(measured: DataFrame, chosen: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept`` under the chosen cutoffs (one row a stratum is joined)."""
    limits = chosen.where("chosen").groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"_{r.name}") for r in rules])
    rejected = F.lit(False)
    for rule in rules:
        rejected = rejected | F.coalesce(F.expr(rule.measure) > F.col(f"_{rule.name}"), F.lit(False))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured.join(limits, "stratum", "left").withColumn("base_failed", base) \
        .withColumn("kept", ~F.col("base_failed") & ~rejected).drop(*[f"_{r.name}" for r in rules])


def quality_report(docs: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES, alpha: float = ALPHA,
                   delta: float = DELTA) -> DataFrame:
    """Counts and verdict of every row of ``docs`` (``doc_id, text, lang``), calibrated on ``labels``."""
    measured = cut_lineage(measure(docs))
    return judge(measured, thresholds(measured, labels, rules, alpha, delta), rules)


def _rule_sql() -> str:
    """The rules as DuckDB rows ``(rule, level, cutoff, measure)`` of each labelled document."""
    parts = []
    for r in RULES:
        value = r.measure.replace(" div ", " // ")
        for level, cutoff in enumerate(r.cutoffs):
            parts.append(f"SELECT '{r.name}' AS rule, {level} AS lv, {cutoff} AS cutoff, stratum, good, "
                         f"CAST({value} AS BIGINT) > {cutoff} AS hit FROM known")
    return "\nUNION ALL ".join(parts)


def _reject_sql() -> str:
    return " OR ".join(f"coalesce(CAST({r.measure.replace(' div ', ' // ')} AS BIGINT) > cut_{r.name}, false)" for r in RULES)


def _limits_sql() -> str:
    return ", ".join(f"max(CASE WHEN rule = '{r.name}' THEN cutoff END) AS cut_{r.name}" for r in RULES)


_RATE = ALPHA / len(RULES)
ORACLE = rf"""
WITH t AS (SELECT row_number() OVER () AS k, doc_id, coalesce(lang, '{NO_LANGUAGE}') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM t),
win AS (SELECT k, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (
          SELECT k, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
twice AS (SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS before FROM (
            SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT k, CAST(sum(least(8, coalesce(i - before, 8))) AS BIGINT) AS n FROM twice GROUP BY k),
ln AS (SELECT k, len(x) AS n_lines, len(x) - len(list_distinct(x)) AS n_dup FROM (
         SELECT k, list_filter(string_split(text, chr(10)), lambda y: regexp_matches(y, '[^\x20\x09-\x0D]')) AS x FROM t)),
m AS (SELECT t.k, t.doc_id, t.stratum, CAST(len(w.ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(ln.n_dup AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
             CAST(length(regexp_replace(text, '[^!]', '', 'g')) AS BIGINT) AS n_exclaims, CAST(ln.n_lines AS BIGINT) AS n_lines
      FROM t JOIN w USING (k) JOIN ln USING (k) LEFT JOIN rep USING (k)),
known AS (SELECT m.*, q > 0 AS good FROM m JOIN (SELECT doc_id, min(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) l
          ON m.doc_id = l.doc_id),
c AS ({_rule_sql()}),
s AS (SELECT stratum, rule, lv, cutoff, count(*) FILTER (good) AS ng, count(*) FILTER (NOT good) AS nb,
             count(*) FILTER (good AND hit) AS g, count(*) FILTER (NOT good AND hit) AS b FROM c GROUP BY ALL),
p AS (SELECT stratum, rule, lv, sum(exp(lgamma(ng + 1) - CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END
             - CASE WHEN i = ng THEN 0 ELSE lgamma(ng - i + 1) END + i * ln({_RATE!r}) + (ng - i) * ln(1 - {_RATE!r}))) AS tail
      FROM (SELECT *, unnest(range(0, g + 1)) AS i FROM s) GROUP BY stratum, rule, lv),
ok AS (SELECT s.*, ng > 0 AND g < ng * {_RATE!r} AND tail <= {DELTA!r} / ({len(RULES)} * (SELECT count(DISTINCT stratum) FROM known)) AS passed
       FROM s JOIN p USING (stratum, rule, lv)),
cert AS (SELECT *, CAST(b AS HUGEINT) * ng - CAST(g AS HUGEINT) * nb AS gain FROM (
           SELECT *, bool_and(passed) OVER (PARTITION BY stratum, rule ORDER BY lv) AS all_ok FROM ok) WHERE all_ok),
pick AS (SELECT stratum, rule, cutoff FROM (
           SELECT *, row_number() OVER (PARTITION BY stratum, rule ORDER BY gain DESC, lv) AS r FROM cert WHERE gain > 0) WHERE r = 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT rejected AS kept FROM (
  SELECT m.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed, {_reject_sql()} AS rejected
  FROM m LEFT JOIN (SELECT stratum AS st, {_limits_sql()} FROM pick GROUP BY stratum) ON st = m.stratum)
"""
