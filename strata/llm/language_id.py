"""Language identification by cross-parsing entropy.

Each language's training text becomes a suffix automaton.  A document is
parsed against it into phrases, each the longest match from where the last one
ended; ``phrases * log2(training symbols) / symbols`` estimates the cross
entropy (Ziv and Merhav), and the language with the least wins.  Text is
folded first: lower-case letters stay, every run of other characters is one
space.  Parses restart every ``SEGMENT`` symbols, so the segments of a batch
walk the automaton side by side, one numpy lane each, whatever the lengths of
their documents; whole texts are read.

Training takes at most ``train_chars`` characters a language: different texts
drawn by a hash, copies counting once, each giving at most the ``PARTS``-th part
as long as the others can fill the rest.  Every language with a lettered text
draws at least one.  Only this sample goes to the driver; the automata are
rebuilt from it in each Python worker.  Scoring only maps rows.

Defined cases: null text or text without a letter is ``und`` with score 0, as
is every text if nothing was learned; null languages are not learned; ties go
to the first language by name; repeated rows are each reported; extra columns
are ignored.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import map_batches, table

TRAIN_CHARS = 40_000
PARTS = 8
SEGMENT = 512
SLICE = 4_000_000  # symbols walked at a time
UNKNOWN = "und"
_K = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """Code point -> lower-case code point of a letter, or 32."""
    out = np.full(sys.maxunicode + 1, 32, dtype=np.uint32)
    for c in range(sys.maxunicode + 1):
        s = chr(c)
        if s.isalpha():
            out[c] = ord(s.lower()[0])
    return out


def fold(text: str) -> np.ndarray:
    """Folded code points; runs of non-letters are one space."""
    s = _folding()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")]
    space = s == 32
    keep = ~space  # a leading space goes
    keep[1:] |= ~space[:-1]
    return s[keep]


class SuffixAutomaton:
    """Transitions of all substrings of ``symbols``, as an open-addressing
    table from (state, symbol) to the next state."""

    def __init__(self, symbols: list[int]):
        edges: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in symbols:
            cur, p = len(edges), last
            edges.append({})
            length.append(length[last] + 1)
            link.append(0)
            while p >= 0 and c not in edges[p]:
                edges[p][c] = cur
                p = link[p]
            if p >= 0:
                q = edges[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(edges)
                    edges.append(dict(edges[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    link[q] = link[cur] = clone
                    while p >= 0 and edges[p].get(c) == q:
                        edges[p][c] = clone
                        p = link[p]
            last = cur
        keys = np.array([s << 21 | c for s, e in enumerate(edges) for c in e], dtype=np.int64)
        values = np.array([t for e in edges for t in e.values()], dtype=np.int64)
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.wrap = (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.zeros(1 << bits, dtype=np.int64)
        slot = self._slot(keys)
        while keys.size:
            free = self.keys[slot] == -1
            _, first = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            left = np.ones(keys.size, dtype=bool)
            left[put] = False
            keys, values, slot = keys[left], values[left], slot[left] + 1 & self.wrap
        self.bits = np.log2(max(2, len(symbols)))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _K) >> self.shift).astype(np.int64)

    def next(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The next states, -1 where there is none."""
        key = state << 21 | symbol
        slot = self._slot(key)
        seen = self.keys[slot]
        out = np.where(seen == key, self.values[slot], -1)
        todo = np.flatnonzero((seen != key) & (seen != -1))
        while todo.size:
            slot[todo] = slot[todo] + 1 & self.wrap
            seen = self.keys[slot[todo]]
            hit = seen == key[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (seen != -1)]
        return out

    def phrases(self, symbols: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Phrases of each segment; segments sorted by size, longest first."""
        state = np.zeros(start.size, dtype=np.int64)
        count = np.ones(start.size, dtype=np.int64)
        active = np.searchsorted(-size, -np.arange(1, size[0] + 1), side="right")
        for t, k in enumerate(active.tolist()):
            c = symbols[start[:k] + t]
            to = self.next(state[:k], c)
            miss = np.flatnonzero(to < 0)
            if miss.size:
                count[miss] += 1
                to[miss] = np.maximum(self.next(np.zeros(miss.size, dtype=np.int64), c[miss]), 0)
            state[:k] = to
        return count


class Models:
    def __init__(self, training: dict[str, str]):
        self.langs = sorted(training)
        self.automata = [SuffixAutomaton(fold(training[x]).tolist()) for x in self.langs]

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits a symbol by text and language, and each text's symbols
        (0 if it has no letter)."""
        total = np.zeros((len(texts), len(self.langs)))
        symbols = np.zeros(len(texts), dtype=np.int64)
        lettered = np.zeros(len(texts), dtype=bool)
        part: list[tuple[int, np.ndarray]] = []
        held = 0
        for i, text in enumerate(texts):
            for a in range(0, len(text), SLICE):
                s = fold(text[a : a + SLICE])
                lettered[i] |= bool((s != 32).any())
                symbols[i] += s.size
                part.append((i, s))
                held += s.size
                if held >= SLICE:
                    self._add(part, total)
                    part, held = [], 0
        self._add(part, total)
        symbols[~lettered] = 0
        return total / np.maximum(symbols, 1)[:, None], symbols

    def _add(self, part: list[tuple[int, np.ndarray]], total: np.ndarray) -> None:
        part = [(i, s) for i, s in part if s.size]
        if not part:
            return
        data = np.concatenate([s for _, s in part]).astype(np.int64)
        at, owner, start, size = 0, [], [], []
        for i, s in part:
            for a in range(0, s.size, SEGMENT):
                owner.append(i)
                start.append(at + a)
                size.append(min(SEGMENT, s.size - a))
            at += s.size
        order = np.argsort(-np.array(size), kind="stable")
        owner, start, size = (np.array(x)[order] for x in (owner, start, size))
        for k, a in enumerate(self.automata):
            np.add.at(total[:, k], owner, a.phrases(data, start, size) * a.bits)


_models: dict[int, Models] = {}  # of this Python worker


def _models_of(shared) -> Models:
    key = hash(tuple(sorted(shared.value.items())))
    if key not in _models:
        _models.clear()
        _models[key] = Models(shared.value)
    return _models[key]


def _mixed(texts: list[str], train_chars: int) -> str:
    """Starts of the texts, ``train_chars`` in all; round by round each gives
    one part more."""
    room, part = train_chars, max(1, train_chars // PARTS)
    given = [0] * len(texts)
    while room > 0 and any(g < len(t) for g, t in zip(given, texts, strict=True)):
        for i, t in enumerate(texts):
            step = min(part, len(t) - given[i], room)
            given[i] += step
            room -= step
    return " ".join(t[:g] for g, t in zip(given, texts, strict=True) if g)[:train_chars]


def training_text(labelled: DataFrame, train_chars: int = TRAIN_CHARS) -> dict[str, str]:
    """At most ``train_chars`` characters a language of ``text``, ``lang``."""
    range_ = 1 << 30
    # from the first letter on, so that each start of a text has one
    rows = (
        labelled.where("lang is not null")
        .select("lang", F.regexp_replace("text", r"^\P{L}++", "").alias("text"))
        .where("text != ''")
        .withColumn("h", F.xxhash64("text", F.lit(7)))
    )
    given = F.least(F.length("text"), F.lit(max(1, train_chars // PARTS)))
    place = F.pmod("h", F.lit(range_))
    different = rows.select("lang", "h", given.alias("given")).distinct()
    totals = different.groupBy("lang").agg(F.sum("given").alias("n"), F.min(place).alias("least")).collect()
    if not totals:
        return {}
    # about four times what is needed, but never nothing
    last = F.create_map(
        *(
            F.lit(v)
            for r in totals
            for v in (r.lang, max(int(range_ * min(1.0, 4 * train_chars / r.n)) - 1, r.least))
        )
    )
    drawn = (
        rows.where(place <= last[F.col("lang")])
        .select("lang", "h", F.substring("text", 1, train_chars).alias("text"))
        .distinct()
    )
    given_before = F.sum(given).over(
        Window.partitionBy("lang").orderBy("h", "text").rowsBetween(Window.unboundedPreceding, -1)
    )
    sample = drawn.withColumn("before", given_before).where(F.coalesce("before", F.lit(0)) < train_chars)
    texts: dict[str, list[str]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r.lang, r.h, r.text)):
        texts.setdefault(r.lang, []).append(r.text)
    out = {x: _mixed(t, train_chars) for x, t in texts.items()}
    return {x: t for x, t in out.items() if any(map(str.isalpha, t))}


def identify(
    docs: DataFrame, training: dict[str, str], *, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """``keep``, ``lang_pred`` and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(training)
    schema = StructType(
        [
            *(docs.schema[c] for c in keep),
            StructField("lang_pred", StringType()),
            StructField("score", DoubleType()),
        ]
    )

    def make():
        models = _models_of(shared)

        def step(batch):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            bits, symbols = models.entropies(texts)
            pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for i in np.flatnonzero(symbols if models.langs else []).tolist():
                best = int(np.argmin(bits[i]))
                weight = np.exp2((bits[i, best] - bits[i]) * min(int(symbols[i]), 20))
                pred[i], score[i] = models.langs[best], float(1 / weight.sum())
            yield {c: batch.column(c) for c in keep} | {"lang_pred": pred, "score": score}

        return step

    return map_batches(docs.select(*dict.fromkeys((*keep, "text"))), make, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    training = training_text(docs.where(~held_out(F.col("doc_id"))).select("lang", "text"))
    found = identify(docs.select("doc_id", "text"), training)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUERIES = {"op7_language_id": op7}
