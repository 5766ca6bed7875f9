"""Best-fit packing by a configuration linear program.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens.  A
configuration is a multiset of piece lengths that fits one sequence; the linear
program covers the length histogram with as few configurations as it can.
Multiplicative weights solve it: a round prices the lengths by the knapsack dynamic
program over the capacity and takes configurations close to the best price, each
length gaining a small share of its pieces; a length's weight falls as it gets
covered, so those that lag lead the next round.  Rounds go on until all but ``REST``
of the pieces are covered.  Multiplicities are rounded down to whole sequences as
they are taken; the pieces left over, and those of the few configurations that are
not well filled, go best-fit-decreasing into gaps and into new sequences.

Scale: tokens never leave the map task that makes them; only (document, piece,
start, length, checksum) rows are stored, in a checkpoint.  The driver sees the
histogram alone, at most ``capacity`` numbers, and returns a slot table whose
size depends on the capacity, not on the corpus.  A piece finds its slot by its
rank among pieces of its length; ranks are counted within (length, stored
partition) and offset by per-partition totals, so a frequent length is spread
over as many groups as there are partitions.  Pieces that fill a sequence need
no rank.

Defined cases: null or empty text is the end token alone; documents with the
same or null ids are each packed; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import checkpointed, map_batches, table

CAPACITY = 2048
REST = 0.002  # share of the pieces that the program leaves to best fit
LEAST_FILL = 0.99  # of a configuration that is kept as it is
END = b"\0\0\0\0"  # the id that ends each document
TOKENIZER = "byte_bpe_50k.json"
LONG_RUN = 400  # longer words go to the reference tokenizer, whose merges use a queue

_GAP = re.compile(rf"\s{{{LONG_RUN}}}")
_CUT = re.compile(r"(?<=\S)(?= \S)")


def chunks_of(text: str) -> list[str]:
    """Cut before every single space between two visible characters: the
    tokenizer's word pattern never joins across such a place."""
    return _CUT.split(text)


class IdCodec:
    """Token ids of texts as little-endian bytes."""

    def __init__(self, name: str = TOKENIZER):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        path = public_tokenizers.path(name)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}
        special = {x["content"] for x in said["added_tokens"]}
        ranks = {
            bytes(byte[c] for c in token): i
            for token, i in said["model"]["vocab"].items()
            if token not in special
        }
        self.special = tuple(special)
        self.exact = Tokenizer.from_file(path)
        self.fast = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def odd(self, text: str) -> bool:
        """Does it hold a very long run or a special token?"""
        return (
            max(map(len, text.split()), default=0) >= LONG_RUN
            or _GAP.search(text) is not None
            or any(s in text for s in self.special)
        )

    def encode(self, text: str) -> bytes:
        if not self.odd(text):
            return np.array(self.fast.encode_ordinary(text), dtype="<u4").tobytes()
        ids: list[int] = []
        for chunk in chunks_of(text):
            if self.odd(chunk):
                ids += self.exact.encode(chunk, add_special_tokens=False).ids
            else:
                ids += self.fast.encode_ordinary(chunk)
        return np.array(ids, dtype="<u4").tobytes()


def cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    first = size % capacity or min(size, capacity)
    starts = [0, *range(first, size, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], size], strict=True)]


PIECES = [
    StructField("piece", IntegerType()),
    StructField("start", LongType()),
    StructField("length", LongType()),
    StructField("ids_crc32", LongType()),
]


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    schema = StructType([docs.schema["doc_id"], *PIECES])

    def make():
        codec = IdCodec(tokenizer)

        def step(batch):
            out: dict[str, list] = {f.name: [] for f in schema}
            for doc, text in zip(
                batch.column("doc_id").to_pylist(), batch.column("text"), strict=True
            ):
                ids = codec.encode(text.as_py() or "") + END
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    out["doc_id"].append(doc)
                    out["piece"].append(k)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(ids[4 * start : 4 * (start + length)]))
            yield out

        return step

    return map_batches(docs.select("doc_id", "text"), make, schema)


class Pricing:
    """Knapsack by dynamic programming: for every room up to ``capacity`` the
    multiset of ``lengths`` of the highest total price that fits."""

    def __init__(self, lengths: np.ndarray, price: np.ndarray, capacity: int):
        self.lengths, self.price, self.capacity = lengths, price, capacity
        self.best = best = np.zeros(capacity + 1)
        self.taken = np.full(capacity + 1, -1)  # index of a length of the best multiset
        self.start = np.zeros(capacity + 1, dtype=np.int64)  # the room it really takes
        upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
        for c in range(int(lengths[0]), capacity + 1):
            value = best[c - lengths[: upto[c]]] + price[: upto[c]]
            k = int(value.argmax())
            if value[k] > best[c - 1]:
                best[c], self.taken[c], self.start[c] = value[k], k, c
            else:
                best[c], self.start[c] = best[c - 1], self.start[c - 1]

    def values(self) -> np.ndarray:
        """The best price of a configuration that holds a given length, for each."""
        return self.price + self.best[self.capacity - self.lengths]

    def configuration(self, k: int) -> Counter:
        """A best configuration among those that hold length number ``k``."""
        out = self.filling(self.capacity - int(self.lengths[k]))
        out[k] += 1
        return out

    def filling(self, room: int) -> Counter:
        """The best multiset for ``room``, by the numbers of its lengths."""
        out: Counter = Counter()
        c = int(self.start[room])
        while c > 0:
            j = int(self.taken[c])
            out[j] += 1
            c = int(self.start[c - self.lengths[j]])
        return out


def best_configuration(lengths: np.ndarray, price: np.ndarray, capacity: int) -> Counter:
    """The multiset of ``lengths`` of the highest total price that fits."""
    pricing = Pricing(lengths, price, capacity)
    return Counter({int(lengths[k]): n for k, n in pricing.filling(capacity).items()})


def _completed(config: dict[int, int], here: int, lengths, left, capacity: int) -> dict[int, int]:
    """``config`` cut down to the pieces that are left (one of ``here`` at least)
    and filled up with the longest that fit."""
    out = {here: 1}
    room = capacity - int(lengths[here])
    for i, n in sorted(config.items(), reverse=True):
        n = min(n - (i == here), int(left[i]) - out.get(i, 0), room // int(lengths[i]))
        if n > 0:
            out[i] = out.get(i, 0) + n
            room -= n * int(lengths[i])
    free = left.copy()
    free[list(out)] -= list(out.values())
    while len(fits := np.flatnonzero(free[: np.searchsorted(lengths, room, side="right")])):
        i = int(fits[-1])
        n = min(int(free[i]), room // int(lengths[i]))
        out[i] = out.get(i, 0) + n
        free[i] -= n
        room -= n * int(lengths[i])
    return out


def solve_covering(
    histogram: dict[int, int],
    capacity: int,
    rate: float = 1.0,
    step: float = 0.1,
    tolerance: float = 0.5,
    rest: float = REST,
) -> dict[tuple, int]:
    """How often to take each configuration so that the histogram is covered, by
    multiplicative weights.

    A round prices the lengths and takes every configuration within ``tolerance``
    of the best price, one for each length that is still open, in turn; in a round
    a length gains at most the share ``step`` of its pieces (a whole sequence at
    least).  Then the price of each length falls by its gain, so that those that
    lag behind lead the next round.  Each round covers some pieces more; it goes on until
    all but the share ``rest`` are, however many rounds that takes (a few hundred at
    the most seen, for 2,000 lengths and any number of pieces).  Multiplicities are
    rounded down to whole sequences as they are taken, so what is covered is
    packed, not only planned."""
    lengths = np.array(sorted(histogram))
    counts = np.array([histogram[x] for x in lengths.tolist()], dtype=np.int64)
    left = counts.copy()
    # long pieces first among equal fills: short ones fit into gaps later
    weight = (lengths / capacity) ** 1.05
    out: dict[tuple, int] = {}
    while left.sum() > rest * counts.sum():
        open_ = np.flatnonzero(left)
        pricing = Pricing(lengths[open_], weight[open_], capacity)
        value, before = pricing.values(), left.copy()
        quota = np.maximum(1, np.ceil(step * counts)).astype(np.int64)
        ranked = np.argsort(-value, kind="stable")
        for k in ranked[: int((value >= (1 - tolerance) * value.max()).sum())].tolist():
            here = int(open_[k])
            if not left[here] or before[here] - left[here] >= quota[here]:
                continue
            config = {int(open_[j]): n for j, n in pricing.configuration(k).items()}
            times = min(int(min(left[i], quota[i] - (before[i] - left[i]))) // n for i, n in config.items())
            if times < 1:  # too few pieces are left of some length for it
                config = _completed(config, here, lengths, left, capacity)
                times = 1
            for i, n in config.items():
                left[i] -= n * times
            key = tuple(sorted((int(lengths[i]), n) for i, n in config.items()))
            out[key] = out.get(key, 0) + times
        gained = (before - left) / counts
        weight *= np.exp(-rate * gained)
    return out


class Bins:
    """Groups of equal sequences: contents [(length, copies)] and how many."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.by_free: dict[int, list[tuple[tuple, int]]] = {}

    def add(self, contents: tuple, times: int) -> None:
        if times:
            free = self.capacity - sum(a * b for a, b in contents)
            self.by_free.setdefault(free, []).append((contents, times))

    def best_fit(self, length: int, count: int) -> None:
        """Put ``count`` pieces, each into the fullest sequence that has room."""
        while count:
            free = min((f for f in self.by_free if f >= length), default=None)
            if free is None:
                fit = self.capacity // length
                whole, rest = divmod(count, fit)
                self.add(((length, fit),), whole)
                if rest:
                    self.add(((length, rest),), 1)
                return
            contents, times = self.by_free[free].pop()
            if not self.by_free[free]:
                del self.by_free[free]
            each = min(free // length, max(1, count // times))
            used = min(times, count // each)
            self.add(contents, times - used)
            self.add(_with(contents, length, each), used)
            count -= used * each


def _with(contents: tuple, length: int, copies: int) -> tuple:
    c = Counter(dict(contents))
    c[length] += copies
    return tuple(sorted(c.items()))


def plan(
    histogram: dict[int, int], capacity: int = CAPACITY, least_fill: float = LEAST_FILL
) -> list[tuple[tuple, int]]:
    """Whole sequences as (contents, times) that hold the histogram exactly.

    Configurations of the covering that leave more than ``1 - least_fill`` of a
    sequence empty (the last ones, when few lengths are open) are taken apart; best
    fit puts their pieces into what room there is, then into new sequences."""
    left = Counter({k: n for k, n in histogram.items() if n})
    bins = Bins(capacity)
    solved = solve_covering(left, capacity) if left else {}
    for config, times in sorted(solved.items(), key=lambda x: (-x[1], x[0])):
        if sum(x * n for x, n in config) >= least_fill * capacity:
            bins.add(config, times)
            for x, n in config:
                left[x] -= n * times
    for length in sorted(left, reverse=True):
        bins.best_fit(length, left[length])
    return sorted(
        (x for group in bins.by_free.values() for x in group if x[0]), key=lambda x: x[0]
    )


def covered_share(histogram: dict[int, int], capacity: int = CAPACITY) -> float:
    """Share of the pieces that configurations of the program hold in the plan."""
    held = sum(
        times * sum(n for _, n in config)
        for config, times in solve_covering(histogram, capacity).items()
        if sum(x * n for x, n in config) >= LEAST_FILL * capacity
    )
    return held / max(1, sum(histogram.values()))


def slots(planned: list[tuple[tuple, int]]) -> dict[str, np.ndarray]:
    """For ranks of a length from ``first`` on: sequence ``base + rank // per``
    at ``offset + rank % per * length``; sorted by (length, first)."""
    seen: Counter = Counter()
    base, rows = 0, []
    for contents, times in planned:
        offset = 0
        for length, copies in contents:
            rows.append((length, seen[length], copies, base, offset))
            seen[length] += copies * times
            offset += length * copies
        base += times
    rows.sort()
    names = ("length", "first", "per", "base", "offset")
    return {n: np.array([r[i] for r in rows], dtype=np.int64) for i, n in enumerate(names)}


def pack(docs: DataFrame, *, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    pieces = checkpointed(pieces_of(docs, capacity, tokenizer))
    stored = pieces.withColumn("row", F.monotonically_increasing_id())
    full = stored.where(F.col("length") == capacity).select(
        *pieces.columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    part = stored.where(F.col("length") < capacity).withColumn(
        "part", F.shiftright("row", 33)
    )
    totals = part.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in part.groupBy("length").agg(F.count("*").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy("row")) - 1
    ranked = (
        part.withColumn("own", own)
        .join(firsts, ["length", "part"])
        .select(*pieces.columns, (F.col("own") + F.col("first")).alias("rank"))
    )
    shared = docs.sparkSession.sparkContext.broadcast(slots(plan(histogram, capacity)))
    names = pieces.columns
    schema = StructType(
        [*pieces.schema, StructField("sequence_id", LongType()), StructField("offset", LongType())]
    )

    def make():
        s = shared.value
        key = s["length"] << 44 | s["first"]

        def step(batch):
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(key, length << 44 | rank, side="right") - 1
            copy, place = np.divmod(rank - s["first"][k], s["per"][k])
            yield {c: batch.column(c) for c in names} | {
                "sequence_id": s["base"][k] + copy,
                "offset": s["offset"][k] + place * length,
            }

        return step

    return map_batches(ranked, make, schema).unionByName(full)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op4_best_fit_packing": op4}
