"""Personal data by anchor expansion.

One Aho-Corasick pass over the text finds anchors: at-signs, plus signs,
digits, URL schemes and identifier cues.  At each anchor a deterministic
parser expands to the boundaries of what may stand there and validates it
(octets, Luhn, digit counts, IBAN check digits).  Nothing else of the text is
looked at twice, so the cost is the automaton's single pass plus the anchors.

Kinds: ``email``, ``ip``, ``card`` and ``phone`` are the base kinds, exactly the
leftmost non-overlapping matches of the patterns below; ``login`` (user part of
``scheme://user:password@``), ``iban`` (check digits hold) and ``account`` (a
cue such as "account no:" followed by 6 to 18 digits, or "ssn:" and
000-00-0000) are added by the cues.

Rows are only mapped.  Null text counts as empty (no spans); repeated rows are
each reported; extra columns are carried by ``redact`` and ignored by
``find_pii``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import count_kind, map_batches, of_kinds, span_list, table

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "login", "iban", "account")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP_REGION, IP = re.compile(r"[0-9.]+"), re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD_REGION, CARD = re.compile(r"[0-9\x20-]+"), re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOGIN = re.compile(r"[^\s/@:?#\"'<>]+(?::[^\s/@?#\"'<>]*)?(?=@[A-Za-z0-9])")
CUES = {"iban": "iban", "account": "account", "acct": "account", "ssn": "ssn"}
IBAN = re.compile(r"(?:[\x20]?(?:no|number)\.?)?[\x20]?[:=#]?[\x20]?([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])", re.I)
ACCOUNT = re.compile(r"[\x20]?(?:no|number)?\.?[\x20]?[:=#][\x20]?([0-9]{6,18})(?![0-9A-Za-z])", re.I)
SSN = re.compile(r"[\x20]?[:=#]?[\x20]?([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        if i % 2:
            v = 2 * v - 9 * (v > 4)
        total += v
    return total % 10 == 0


def iban_holds(value: str) -> bool:
    s = value.replace(" ", "").upper()
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("scheme", 3))
    for cue, kind in CUES.items():
        for form in (cue, cue.capitalize(), cue.upper()):
            a.add_word(form, (kind, len(form)))
    a.make_automaton()
    return a


def spans_of(text: str | None, anchors) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every span, sorted; offsets are code points."""
    out: list[tuple[int, int, int]] = []
    if not text:
        return out
    email_end = ip_end = card_end = 0
    for last, (kind, size) in anchors.iter(text):
        at = last - size + 1
        if kind == "digit":
            if at >= ip_end:
                ip_end = IP_REGION.match(text, at).end()
                if ip_end - at >= 7:
                    for m in IP.finditer(text, at, ip_end):
                        if all(map(octet, m.groups())):
                            out.append((m.start(), 1, m.end()))
            if at >= card_end:
                card_end = CARD_REGION.match(text, at).end()
                if card_end - at >= 14:
                    for m in CARD.finditer(text, at, card_end):
                        d = m[0].replace(" ", "").replace("-", "")
                        if 14 <= len(d) <= 19 and luhn(d):
                            out.append((m.start(), 2, m.end()))
        elif kind == "at":
            start = at
            while start > email_end and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                email_end = m.end()
                out.append((start, 0, email_end))
        elif kind == "plus":
            if (m := PHONE.match(text, at)) and 10 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((at, 3, m.end()))
        elif kind == "scheme":
            if m := LOGIN.match(text, last + 1):
                out.append((m.start(), 4, m.end()))
        elif at == 0 or not text[at - 1].isalnum():
            if kind == "iban":
                if (m := IBAN.match(text, last + 1)) and iban_holds(m[1]):
                    out.append((m.start(1), 5, m.end(1)))
            elif m := (SSN if kind == "ssn" else ACCOUNT).match(text, last + 1):
                out.append((m.start(1), 6, m.end(1)))
    out.sort()
    return out


_SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType()),
            StructField("start", IntegerType()),
            StructField("end", IntegerType()),
        ]
    )
)


def find_pii(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``spans`` (kind, start, end; code points, end exclusive) of
    every row, sorted by start, then kind as in ``KINDS``."""
    schema = StructType([*(docs.schema[c] for c in keep), StructField("spans", _SPANS)])

    def make():
        anchors = automaton()

        def step(batch):
            spans = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(t, anchors)]
                for t in batch.column("text").to_pylist()
            ]
            yield {c: batch.column(c) for c in keep} | {"spans": spans}

        return step

    return map_batches(docs.select(*dict.fromkeys((*keep, "text"))), make, schema)


def mask(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """``text`` with every span replaced by ``<KIND>``; overlapping spans count
    as one, named after the first."""
    if not spans:
        return text
    out, done, at = [], 0, 0
    while at < len(spans):
        start, kind, end = spans[at]
        at += 1
        while at < len(spans) and spans[at][0] < end:
            end = max(end, spans[at][2])
            at += 1
        out += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = end
    return "".join(out) + text[done:]


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns, with personal data masked in ``text``."""

    def make():
        anchors = automaton()

        def step(batch):
            cols = dict(zip(batch.schema.names, batch.columns, strict=True))
            cols["text"] = [mask(t, spans_of(t, anchors)) for t in cols["text"].to_pylist()]
            yield cols

        return step

    return map_batches(docs, make, docs.schema)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(count_kind(F.col("spans"), k).alias(f"n_{k}") for k in BASE),
        F.sha2(span_list(of_kinds(F.col("spans"), BASE)), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


QUERIES = {"op8_pii": op8}
