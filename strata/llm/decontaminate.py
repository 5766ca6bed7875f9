"""Benchmark decontamination by Wu-Manber multi-pattern search.

Both sides become word strings (``" w1 w2 ... "``, ASCII lower case, words are
runs of ASCII letters, digits and everything beyond ASCII).  A pattern is a
window of ``window`` consecutive item words (the whole item if it has fewer).

The search is Wu and Manber's: a table gives, for the block of bytes that ends
the current search window, how far the window may move without skipping a
pattern; where the shift is zero the block's and the window start's hash
select a bucket of patterns, and a direct comparison confirms.  Many places of
the batch move at once (one numpy lane each), so the shift table is read by
vector gathers and the text is never walked byte by byte in Python.

Scale: documents are only mapped, never shuffled.  The benchmark is sent to
executors in blocks of at most ``block_bytes`` text (split by item); each
further block is one more map pass over the documents with the findings so far
carried along through a checkpoint, so no pass holds more than one block.

Defined cases: null or wordless text has 0 words and no hits; null or wordless
items have no windows; a null item_id counts as no item but its windows still
hit; repeated rows are each reported; extra columns are ignored; an empty
benchmark leaves every document clean.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from .common import checkpointed, map_batches, table

WINDOW = 10
BLOCK_BYTES = 2_000_000
LANES = 1 << 13
_HASH_BITS = 20
_K1 = np.uint64(0x9E3779B97F4A7C15)
_K2 = np.uint64(0xC2B2AE3D27D4EB4F)
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_TABLE).split() if text else []


def item_windows(text: str | None, window: int = WINDOW) -> list[bytes]:
    """The item's windows as `` w1 ... wk `` byte strings."""
    w = words_of(text)
    if not w:
        return []
    return [
        b" " + b" ".join(w[i : i + window]) + b" " for i in range(max(1, len(w) - window + 1))
    ]


def _load(buf: np.ndarray) -> np.ndarray:
    """Little-endian 64-bit words of ``buf`` at every byte offset."""
    return np.ndarray((len(buf) - 7,), dtype="<u8", buffer=buf, strides=(1,))


class WuManber:
    """Tables for patterns of similar minimum length ``m``."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.m = m = min(map(len, patterns))
        self.block = b = min(8, max(1, m // 3))
        self.mask = np.uint64(64 - 8 * b)
        shift = np.full(1 << _HASH_BITS, m - b + 1, dtype=np.int32)
        # the first m bytes of every pattern, padded so that words can be loaded
        head = np.frombuffer(b"".join(p[:m] for p in patterns), dtype=np.uint8).reshape(-1, m)
        padded = np.zeros((len(patterns), m + 16), dtype=np.uint8)
        padded[:, :m] = head
        flat = padded.reshape(-1)
        words = _load(flat)
        rows = np.arange(len(patterns)) * (m + 16)
        for at in range(m - b + 1):
            np.minimum.at(shift, self._slot(words[rows + at]), m - b - at)
        self.shift = shift
        key = self._key(words[rows], words[rows + (m - b)])
        self.bucket: dict[int, list[int]] = defaultdict(list)
        for i, k in enumerate(key.tolist()):
            self.bucket[k].append(i)
        self.keys = np.unique(key)

    def _slot(self, w: np.ndarray) -> np.ndarray:
        return ((w << self.mask) * _K1) >> np.uint64(64 - _HASH_BITS)

    def _key(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the window's first bytes and its last block."""
        return ((first << self.mask) * _K2) ^ ((last << self.mask) * _K1)

    def search(self, data: bytes) -> list[tuple[int, int]]:
        """(position, pattern number) of every occurrence in ``data``."""
        n = len(data) - self.m + 1
        if n <= 0:
            return []
        buf = np.frombuffer(data + b"\n" * 16, dtype=np.uint8)
        words, tail = _load(buf), self.m - self.block
        lanes = max(1, min(LANES, n // 64))
        edges = np.linspace(0, n, lanes + 1).astype(np.int64)
        pos, end, found = edges[:-1].copy(), edges[1:], []
        while pos.size:
            step = self.shift[self._slot(words[pos + tail])]
            zero = step == 0
            if zero.any():
                at = pos[zero]
                key = self._key(words[at], words[at + tail])
                near = self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key
                found += zip(at[near].tolist(), key[near].tolist(), strict=True)
            pos = pos + np.maximum(step, 1)
            left = pos < end
            if not left.all():
                pos, end = pos[left], end[left]
        out = []
        for at, key in found:
            for i in self.bucket[key]:
                if data.startswith(self.patterns[i], at):
                    out.append((at, i))
        return out


class Matcher:
    """All windows of one benchmark block."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        owners: dict[bytes, set[str]] = defaultdict(set)
        for item, text in items:
            for p in item_windows(text, window):
                owners[p].add(item)
        # short windows would shorten every shift: they get tables of their own
        groups: dict[int, list[bytes]] = defaultdict(list)
        for p in owners:
            groups[min(len(p).bit_length(), 6)].append(p)
        self.owners, self.tables = owners, [WuManber(g) for g in groups.values()]

    def hits(self, texts: list[bytes]) -> dict[int, list[tuple[int, bytes]]]:
        """Of each text with hits: (byte offset, pattern)."""
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        data = b"\n".join(texts)
        out: dict[int, list[tuple[int, bytes]]] = defaultdict(list)
        for t in self.tables:
            found = t.search(data)
            if found:
                which = np.searchsorted(starts, [at for at, _ in found], side="right") - 1
                for (at, i), d in zip(found, which.tolist(), strict=True):
                    out[d].append((at - int(starts[d]), t.patterns[i]))
        return out


def _merge(ranges: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


SCHEMA = [
    StructField("n_words", LongType()),
    StructField("hit_ranges", ArrayType(ArrayType(IntegerType()))),
    StructField("item_ids", ArrayType(StringType())),
]


def _pass(df: DataFrame, items, window: int, schema: StructType) -> DataFrame:
    """Add one benchmark block's findings to those carried by ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(items)
    carried = len(schema) - len(SCHEMA) - 1  # columns before the text

    def make():
        matcher = Matcher(shared.value, window)

        def step(batch):
            rows = {n: batch.column(n) for n in batch.schema.names}
            texts, n_words = [], []
            for t in rows["text"].to_pylist():
                w = words_of(t)
                n_words.append(len(w))
                texts.append(b" " + b" ".join(w) + b" " if w else b"")
            ranges, ids = rows["hit_ranges"].to_pylist(), rows["item_ids"].to_pylist()
            for d, found in matcher.hits(texts).items():
                gaps = np.flatnonzero(np.frombuffer(texts[d], dtype=np.uint8) == 32)
                first = np.searchsorted(gaps, [at for at, _ in found]).tolist()
                ranges[d] = _merge(
                    [tuple(r) for r in ranges[d]]
                    + [(a, a + p.count(b" ") - 1) for a, (_, p) in zip(first, found, strict=True)]
                )
                items_of = set(ids[d]).union(*(matcher.owners[p] for p in {p for _, p in found}))
                ids[d] = sorted(items_of - {None})
            keep = {n: rows[n] for n in schema.names[:carried] + ["text"]}
            yield keep | {"n_words": n_words, "hit_ranges": ranges, "item_ids": ids}

        return step

    return map_batches(df, make, schema)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One row per document: ``keep``, ``text``, ``n_words``, ``hit_ranges``
    (word ranges [from, to) inside benchmark windows), ``item_ids`` (sorted
    strings) and ``contaminated``."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where(
        F.col("text").isNotNull()
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("text"), F.lit(blocks)))
    df = docs.select(
        *keep,
        "text",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<array<int>>").alias("hit_ranges"),
        F.array().cast("array<string>").alias("item_ids"),
    )
    schema = StructType([docs.schema[c] for c in (*keep, "text")] + SCHEMA)
    for block in range(blocks):
        rows = items.where(F.col("block") == block).collect()  # at most about block_bytes
        if block:
            df = checkpointed(df)
        df = _pass(df, [(r.item_id, r.text) for r in rows], window, schema)
    return df.withColumn("contaminated", F.size("hit_ranges") > 0)


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate(
        "hit_ranges", F.lit(0).cast("long"), lambda acc, r: acc + (r[1] - r[0]).cast("long")
    )
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


QUERIES = {"op10_benchmark_decontamination": op10}
