"""Personal data: patterns propose spans, checksums confirm, context adjusts the score.

``find_spans(text)`` is a column of spans ordered by kind, then start (code
points, end exclusive).  Four base kinds are always reported once their check
holds (mail address, IPv4 address, payment card with Luhn, international phone
number); ``iban`` (confirmed by its mod-97 check) and ``ssn`` (three groups of digits, confirmed by the
numbers that are never issued) are added kinds, reported from ``min_score`` up.  Each span has a score: the kind's
prior, raised or lowered by words standing near it.  The shape of an ``ssn`` alone is too weak: a nearby word must
support it, and none may speak against it.

Edge cases: null and empty texts have no spans; texts of any length are read
whole; every pattern is scanned in time linear in the text (no start is tried
twice inside one run of equal character class); repeated rows give equal spans;
other columns of the frame are left alone (the result column is named by the
caller and replaces a column of that name).
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "ssn")
SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"

PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.9, "ssn": 0.35}
GAIN = {"ssn": 0.3}
USUAL_GAIN = 0.1
SUPPORT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "pay"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "transfer"),
    "ssn": ("ssn", "social", "security", "taxpayer"),
}
DOUBT = ("version", "release", "example", "sample", "serial", "isbn", "order", "test")
CONTEXT_CHARS = 48

_MAIL_LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_MAIL_RIGHT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A failed start inside a run of digits fails for the whole run, so only run starts are tried.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_DIGITS = re.compile(r"[^0-9]")
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    """Luhn check digit over a string of digits."""
    total = 0
    for place, d in enumerate(reversed(digits)):
        v = int(d)
        if place % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def mod97(code: str) -> bool:
    """ISO 7064 mod-97 check of an IBAN without spaces."""
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _mails(text: str):
    at, done = text.find("@"), 0
    while at >= 0:
        left = at
        while left > done and text[left - 1] in _MAIL_LEFT:
            left -= 1
        m = _MAIL_RIGHT.match(text, at + 1) if left < at else None
        if m:
            yield left, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str):
    for m in _IP.finditer(text):
        # the four-part pattern matches greedily; a part over 255 drops the match, no retry
        if all(len(g.lstrip("0")) <= 3 and int(g[-4:]) <= 255 for g in m.groups()):
            yield m.start(), m.end()


def _cards(text: str):
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _DIGITS.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.start(), m.end()


def _phones(text: str):
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.sub("", m[0])) <= 15:
                yield m.start(), m.end()


def _ibans(text: str):
    for m in _IBAN.finditer(text):
        code = m[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            yield m.start(), m.end()


def _ssns(text: str):
    for m in _SSN.finditer(text):
        area, group, serial = m.groups()
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield m.start(), m.end()


FINDERS = {"email": _mails, "ip": _ips, "card": _cards, "phone": _phones, "iban": _ibans, "ssn": _ssns}


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = text[max(0, start - CONTEXT_CHARS):start] + " " + text[end:end + CONTEXT_CHARS]
    words = {w.lower() for w in _WORD.findall(near)}
    score = PRIOR[kind]
    if words.intersection(SUPPORT[kind]):
        score += GAIN.get(kind, USUAL_GAIN)
    if words.intersection(DOUBT):
        score -= 0.25
    return round(min(1.0, max(0.0, score)), 3)


def spans_of(text: str | None, min_score: float = 0.5) -> list[tuple[str, int, int, float]]:
    """All spans of one text, by kind in the order of ``KINDS``, then start."""
    if not text:
        return []
    out = []
    for kind in KINDS:
        for start, end in FINDERS[kind](text):
            score = _score(text, kind, start, end)
            if kind in BASE_KINDS or score >= min_score:
                out.append((kind, start, end, score))
    return out


def redact_text(text: str | None, min_score: float = 0.5) -> str | None:
    """The text with each maximal run of overlapping spans replaced by ``<KIND>``."""
    found = sorted(spans_of(text, min_score), key=lambda s: (s[1], -s[2]))
    if not found:
        return text
    parts, at, i = [], 0, 0
    while i < len(found):
        kind, start, end, _ = found[i]
        i += 1
        while i < len(found) and found[i][1] < end:
            end = max(end, found[i][2])
            i += 1
        parts += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join(parts) + text[at:]


def find_spans(text: Column | str, min_score: float = 0.5) -> Column:
    """Column of all spans (``SPAN_TYPE``) of a text column."""

    @F.pandas_udf(SPAN_TYPE)
    def find(texts: pd.Series) -> pd.Series:
        names = ("kind", "start", "end", "score")
        return pd.Series([[dict(zip(names, s)) for s in spans_of(t, min_score)] for t in texts], dtype=object)

    return find(text)


def redact(text: Column | str, min_score: float = 0.5) -> Column:
    """Column of the text with its personal data masked; null stays null."""

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        return pd.Series([redact_text(t, min_score) for t in texts], dtype=object)

    return mask(text)


def joined_spans(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:end`` of the spans of these kinds, comma-joined in order."""
    some = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(some, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with the array column ``spans`` (replaced if it exists)."""
    return docs.withColumn(spans, find_spans(F.col(text)))
