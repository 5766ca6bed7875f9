"""Periodic runs of words by an online sparse dynamic program over diagonals.

A run is a stretch of consecutive words that repeats with smallest period *q*
(words *q* apart are equal), is at least ``max(min_length, min_repeats * q)``
words long, and cannot be extended to either side keeping the period.

One pass over the words keeps, for every active lag, where its diagonal of
matches began: the lag *d* is active at word *i* while word *i* equals word
*i - d*.  Each word lengthens the diagonals it continues; a diagonal that it
breaks is a run if it was long enough, and is emitted at once.  New diagonals
come from the earlier occurrences of the word, told apart by the words before
it (the whole n-gram must match), because every run holds a stretch of matches
of at least that length.  Three rules keep the table sparse and lose no run:

* a run of lag *d* matches for at least 2 * d words, so lags of
  2^k .. 2^(k+1)-1 are only looked up at every 2^k-th word: some such word lies
  in the run, and the matches before it are counted back;
* a multiple of an active lag whose stretch already covers both words begins and
  ends with that lag's stretch and has no smallest period of its own: it is not
  opened;
* of diagonals that break at the same word, one whose stretch has a smaller
  period is not emitted.

So a text of *n* words looks at no more than about n log n earlier occurrences,
even if it is one word throughout.

Rows are only mapped, each whole text in one task.  Null, empty and wordless
texts have no words and no runs, and collapse to the empty string.  Ties between
runs (same exponent) go to the smallest start, then the smallest period.
Repeated rows are each answered; an empty table gives an empty table.  Only the
columns named in ``keep`` are carried and none of them may be called
``n_words``, ``runs`` or ``collapsed``; other columns are ignored, whatever
their names.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import map_batches, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = r"[\x20\x09-\x0D]+"
MIN_LENGTH, MIN_REPEATS = 6, 4
RUN_TYPE = ArrayType(
    StructType([StructField(c, LongType(), False) for c in ("start", "length", "period")]), False
)


def gram_words(min_length: int, min_repeats: int) -> int:
    """Words of an n-gram such that every run, whatever its period *d*, has an
    n-gram of matches that ends at a word where lags of its size are looked up."""
    return min(
        max(min_length, min_repeats * d) - d - (1 << d.bit_length() - 1) + 1
        for d in range(1, min_length + 2)
    )


def runs_of(
    words: Sequence, *, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS
) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``, by start, then period.

    ``min_repeats`` is at least 3."""
    if min_repeats < 3:
        raise ValueError("min_repeats must be 3 or more")
    n, gram = len(words), gram_words(min_length, min_repeats)
    if n < min_length or n <= gram:
        return []
    numbers: dict = {}
    w = [numbers.setdefault(x, len(numbers)) for x in words]
    grams = list(zip(*(w[k:] for k in range(gram)), strict=False))
    if len(set(grams)) == len(grams):
        return []  # no n-gram occurs twice
    out: list[tuple[int, int, int]] = []
    seen: dict[tuple, int] = {}  # n-gram -> where it last ended
    earlier = [-1] * n  # the end of the same n-gram before
    active: dict[int, int] = {}  # lag -> first word of its diagonal

    def close(broken: list[int], end: int) -> None:
        for d in broken:
            start = active[d] - d
            length = end - start
            if length < max(min_length, min_repeats * d):
                continue
            if not any(p < d and d % p == 0 and active[p] - p <= start for p in broken):
                out.append((start, length, d))

    for i in range(gram - 1, n):
        if active:
            x = w[i]
            broken = [d for d in active if w[i - d] != x]
            if broken:
                close(broken, i)
                for d in broken:
                    del active[d]
        key = grams[i - gram + 1]
        j = seen.get(key, -1)
        seen[key] = i
        if j < 0:
            continue
        earlier[i] = j
        reach = 2 * (i & -i)  # lags below this are looked up here
        if i - j >= reach:
            continue
        # lags that can cover others have matched for their own length; they are
        # the roots of squares that end here, so there are few
        covering = [(p, first - p) for p, first in active.items() if i - first >= p]
        while j >= 0 and i - j < reach:
            d = i - j
            if d not in active and not any(d % p == 0 and start <= j for p, start in covering):
                first = i - gram + 1
                while first > d and w[first - 1] == w[first - 1 - d]:
                    first -= 1
                active[d] = first
                if i - first >= d:
                    covering.append((d, first - d))
            j = earlier[j]
    close(list(active), n)
    out.sort(key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: Sequence[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """``words`` without those that some run holds after its first period."""
    kept, at = [], 0
    for a, b in sorted((s + q, s + n) for s, n, q in runs):
        if a > at:
            kept.extend(words[at:a])
        at = max(at, b)
    kept.extend(words[at:])
    return kept


def find_runs(
    docs: DataFrame,
    *,
    min_length: int = MIN_LENGTH,
    min_repeats: int = MIN_REPEATS,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep``, ``n_words``, ``runs`` (array of start, length, period; word
    numbers from 0, by start, then period) and ``collapsed`` (the words that no
    run repeats, joined by one space) of every row's ``text``."""
    schema = StructType(
        [
            *(docs.schema[c] for c in keep),
            StructField("n_words", LongType(), False),
            StructField("runs", RUN_TYPE, False),
            StructField("collapsed", StringType(), False),
        ]
    )

    def make():
        def step(batch):
            sizes, runs, rest = [], [], []
            for text in batch.column("text").to_pylist():
                words = WORD.findall(text) if text else []
                found = runs_of(words, min_length=min_length, min_repeats=min_repeats)
                sizes.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                rest.append(" ".join(collapsed(words, found)))
            kept = {c: batch.column(c) for c in keep}
            yield kept | {"n_words": sizes, "runs": runs, "collapsed": rest}

        return step

    return map_batches(docs.select(*dict.fromkeys((*keep, "text"))), make, schema)


def looped(text: Column, doc_id: Column) -> Column:
    """``text``, but for one document in ten its words from a place on repeat a
    stretch of the text over and over; place and stretch follow from doc_id."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, SPACES), lambda x: x != "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    return F.when(
        (h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), tail), " ")
    ).otherwise(text)


def greatest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; null if none."""

    def better(best, r):
        return F.when(
            best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r
        ).otherwise(best)

    none = F.lit(None).cast(RUN_TYPE.elementType.simpleString())
    return F.reduce(runs, none, better)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_runs(docs.select("doc_id", looped(F.col("text"), F.col("doc_id")).alias("text")))
    lines = F.transform(
        "runs",
        lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))),
    )
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", greatest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {"op13_periodic_runs": op13}
