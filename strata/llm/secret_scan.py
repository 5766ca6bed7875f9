"""Secret scan by sliding-window entropy, in DataFrame functions only.

Base kinds are the leftmost non-overlapping matches of ``assign``, ``access`` and
``hex``.  The method adds ``entropy``: runs of the base-64 alphabet or of hex
digits in which some window of ``WINDOW`` characters reaches the Shannon entropy
of its character class.  The window slides one character at a time; the
symbol counts and the sum of ``c log2 c`` change only for the character that
enters and the one that leaves.  Hex digits of either case are one class, and
hex digits inside a longer run (``id=<hex>``) are judged as hex too.  Placeholder
words are cut out of a run, the parts around them are runs of their own; runs
that the allow-list explains (words, numbers, identifiers, slugs and paths made of
them, of whose segments at most half are numbered words like ``utf8``, UUIDs)
are suppressed.  The bounds miss about one in 1,000 random keys of 20 hex digits
and one in 200 of 20 base-64 characters (which must hold a digit and a letter),
and fewer of longer ones; of random keys in lower-case groups of five about one in 20
looks like a name with numbers and is missed.

Positions come from splitting the text at the pattern: piece and match lengths
add up to the starts.  Sums run in blocks, so their cost stays proportional to
the matches.  Everything is one map; nothing is shuffled.

Defined cases: null text counts as empty; very long texts and runs are scanned
whole; spans of several kinds at one start come in the order of ``KINDS``; repeated
rows are each reported; an empty table gives no rows; extra columns are ignored by
``find_secrets``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPAN_TYPE, count_kind, of_kinds, span_list, table

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "entropy")
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"  # the first AKIA of a run has the most characters
HEX = r"[0-9a-f]{24,}"  # a long enough run is matched whole
PLACEHOLDER = r"(?=[EePpCcDd])(?i:example|placeholder|changeme|dummy)"
# possessive: walked without recursion, whatever the length
CANDIDATE = PLACEHOLDER + r"|(?=[A-Za-z0-9+/_=-]{20})((?:(?!" + PLACEHOLDER + r")[A-Za-z0-9+/_=-]){20,}+)"
HEX_RUN = r"[0-9A-Fa-f]{20,}"
WINDOW = 20
# character class: (its characters, bits a window must reach)
CLASSES = {
    "hex": ("0123456789abcdef", 2.7),
    "base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.6),
}
# a segment of a slug, path or identifier: letters, digits, or a short word or
# abbreviation with a number before, after or inside it (possessive, so that its
# cost is linear in the run)
_WORD = r"(?:[A-Z]?[a-z]++|[A-Z]++(?![a-z]))"
MIXED = (
    r"(?<![A-Za-z0-9])(?=[A-Za-z0-9]{2,16}+(?![A-Za-z0-9]))(?:"
    + _WORD + r"[0-9]++" + _WORD + r"?|[0-9]++" + _WORD + r"(?:[0-9]++)?)(?![A-Za-z0-9])"
)
_SEGMENT = r"(?:(?:[A-Za-z]++|[0-9]++)(?![A-Za-z0-9])|" + MIXED + ")"
ALLOWED = (
    r"[^0-9]*",  # no digit
    r"[^A-Za-z]*",  # no letter
    r"(?:[A-Za-z]+|[0-9]+)(?:[-_/=+]+(?:[A-Za-z]+|[0-9]+))*+[-_/=+]*",  # words and numbers
    r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}",  # UUID
)
# the same with numbered words, if these are at most half of the segments and some
# letter is lower-case (product keys in groups have none)
NAMES = r"(?=[^a-z]*+[a-z])[-_/=+]*+" + _SEGMENT + r"(?:[-_/=+]++" + _SEGMENT + r")*+[-_/=+]*"
_BLOCK = 128


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def _sums_before(df: DataFrame, numbers: str, out: str) -> DataFrame:
    """``out``: of each element of the array, the sum of those before it."""
    n = F.col(numbers)
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(n) - 1) / _BLOCK).cast("int"), F.lit(0))),
        lambda b: _total(F.slice(n, b * _BLOCK + 1, F.lit(_BLOCK))),
    )
    df = df.withColumn("_blocks", blocks)
    df = df.withColumn(
        "_blocks",
        F.transform("_blocks", lambda _, b: _total(F.slice("_blocks", F.lit(1), b))),
    )
    inside = lambda _, k: F.get("_blocks", F.floor(k / _BLOCK).cast("int")) + _total(
        F.slice(n, k - k % _BLOCK + 1, k % _BLOCK)
    )
    return df.withColumn(out, F.transform(n, inside)).drop("_blocks")


def _matches(df: DataFrame, name: str, pattern: str, group: int) -> DataFrame:
    """``name``: (start, end, value of the group) of every match in ``_text``."""
    text, regex = F.col("_text"), F.lit(pattern)
    df = df.withColumns(
        {
            "_found": F.regexp_extract_all(text, regex, F.lit(0)),
            "_pieces": F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long")),
            "_values": F.regexp_extract_all(text, regex, F.lit(group)),
        }
    )
    df = df.withColumn(
        "_steps", F.transform("_found", lambda x, k: F.length(x) + F.get("_pieces", k))
    )
    df = _sums_before(df, "_steps", "_before")
    found = F.transform(
        "_found",
        lambda x, k: F.struct(
            (F.get("_before", k) + F.get("_pieces", k)).cast("int").alias("start"),
            (F.get("_before", k) + F.get("_steps", k)).cast("int").alias("end"),
            F.get("_values", k).alias("value"),
        ),
    )
    return df.withColumn(name, found).drop("_found", "_pieces", "_values", "_steps", "_before")


def _weight(count: Column) -> Column:
    """c log2 c"""
    return F.when(count > 1, count * F.log2(count)).otherwise(0.0)


def peak_entropy(value: Column, alphabet: str) -> Column:
    """Most bits of any window of ``value``; characters outside the alphabet
    count as one symbol."""
    # each character with the one that leaves; built once, not in every step
    chars = F.slice(F.split(value, ""), F.lit(1), F.length(value))
    left_behind = F.concat(F.array_repeat(F.lit(None).cast("string"), WINDOW), chars)
    steps = F.transform(
        F.slice(F.arrays_zip(chars.alias("x"), left_behind.alias("gone")), F.lit(1), F.length(value)),
        lambda s, k: F.struct(k.alias("k"), s["x"].alias("x"), s["gone"].alias("gone")),
    )
    start = F.struct(
        F.array_repeat(F.lit(0), len(alphabet) + 1).alias("counts"),
        F.lit(0.0).alias("sum"),
        F.lit(0.0).alias("peak"),
    )

    def enter(acc, step):
        k = step["k"]
        at, gone = F.instr(F.lit(alphabet), step["x"]), F.instr(F.lit(alphabet), step["gone"])
        left = F.get(acc["counts"], gone)
        without = F.coalesce(acc["sum"] - _weight(left) + _weight(left - 1), acc["sum"])
        now = F.get(acc["counts"], at) - F.coalesce((gone == at).cast("int"), F.lit(0))
        total = without - _weight(now) + _weight(now + 1)
        bits = F.log2(F.lit(float(WINDOW))) - total / WINDOW
        return F.struct(
            F.transform(
                acc["counts"],
                lambda v, i: v + (i == at).cast("int") - F.coalesce((i == gone).cast("int"), F.lit(0)),
            ).alias("counts"),
            total.alias("sum"),
            F.when(k >= WINDOW - 1, F.greatest(acc["peak"], bits)).otherwise(acc["peak"]).alias("peak"),
        )

    return F.aggregate(steps, start, enter, lambda acc: acc["peak"])


def _allowed(value: Column) -> Column:
    out = F.lit(False)
    for p in ALLOWED:
        out = out | value.rlike(f"^(?:{p})$")
    numbered = F.regexp_count(value, F.lit(MIXED))
    few = numbered * 2 <= F.regexp_count(value, F.lit(r"[A-Za-z0-9]++"))
    return out | (value.rlike(f"^(?:{NAMES})$") & few)


def _is_secret(value: Column) -> Column:
    digits, hex_bits = CLASSES["hex"]
    alphabet, bits = CLASSES["base64"]
    hex_key = F.exists(
        F.regexp_extract_all(value, F.lit(HEX_RUN), F.lit(0)),
        lambda r: ~_allowed(r) & (peak_entropy(F.lower(r), digits) >= hex_bits),
    )
    return hex_key | (~value.rlike(f"^{HEX_RUN}$") & (peak_entropy(value, alphabet) >= bits))


def find_secrets(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``spans`` (kind, start, end; code points, end exclusive),
    sorted by start, then kind as in ``KINDS``."""
    df = docs.select(
        F.struct(*keep).alias("_keep"), F.coalesce("text", F.lit("")).alias("_text")
    )
    df = _matches(df, "assign", ASSIGN, 2)
    df = _matches(df, "access", ACCESS, 0)
    df = _matches(df, "hex", HEX, 0)
    df = _matches(df, "entropy", CANDIDATE, 1)
    df = df.withColumns(
        {
            "assign": F.filter("assign", lambda m: F.length(m["value"]) >= 6),
            "entropy": F.filter("entropy", lambda m: (m["value"] != "") & ~_allowed(m["value"])),
        }
    )
    df = df.withColumn("entropy", F.filter("entropy", lambda m: _is_secret(m["value"])))

    def tag(k: int):
        return lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("k"), m["end"].alias("end"))

    tagged = F.concat(*(F.transform(kind, tag(k)) for k, kind in enumerate(KINDS)))
    names = F.array(*map(F.lit, KINDS))
    spans = F.transform(
        F.sort_array(tagged),
        lambda s: F.struct(
            F.get(names, s["k"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
        ),
    )
    return df.select(*(F.col(f"_keep.{c}") for c in keep), spans.cast(SPAN_TYPE).alias("spans"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *(count_kind(F.col("spans"), k).alias(f"n_{k}") for k in BASE),
        F.sha2(span_list(of_kinds(F.col("spans"), BASE)), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


QUERIES = {"op2_secret_scan": op2}
