"""Similarity join on word five-grams through a MinHash LSH forest.

Documents are sets of five-word shingles (lower-case ``\\w+`` words; a shorter
text is one shingle).  Documents with equal sets are one *text*; the join runs
between texts.

1. Every text gets ``TREES`` labels of ``DEPTH`` min-hashes: its places in the
   tries of the forest.  Texts whose labels share a prefix (a node of a trie) are
   candidates.  Matching starts with whole labels; the prefix is then shortened
   to the depth at which the expected recall at the threshold reaches ``RECALL``
   (``prefix_depths``), but only in nodes that hold texts not yet tied together.  So
   a node of many near copies, which whole labels tie already, is never compared
   as a whole at a shorter prefix.
2. In each node the full signatures of texts that are not tied yet are compared.
   Pairs that look similar tie the texts together; only a spanning forest of the
   ties leaves the task, never all pairs.  Connected ties are a candidate group.
3. In each group the shingle sets themselves are compared and links (Jaccard
   at least ``THRESHOLD``) counted; again only a spanning forest leaves.  The
   sets come from a second pass over the texts; a broadcast bit set of
   ``FILTER_BITS`` bits, whatever the input, keeps texts without a group from the
   shuffle (beyond some 30 million texts in groups it lets more of them through,
   which the join then removes).

Prefixes and groups with many texts are cut into blocks of at most
``BLOCK_TEXTS`` texts (and, for sets, about ``BLOCK_SHINGLES`` shingles); each
pair of blocks is one unit of work for some task, so no task holds a whole
group and a group of any size is spread over the cluster.  Exact copies never
reach these steps: they are counted before, with map-side aggregation.

Result: one row per document with its class and its number of links (other
documents at or above the threshold, copies included).

Defined cases: null text and text without words link to nothing, and each such
row is a class by itself; repeated rows are copies; rows that share a doc_id
share what is reported under it only if their texts are linked; a null doc_id
does not name a class; extra columns are ignored; an empty table gives no rows;
very long texts are shingled whole; ties have no say (which tree finds a pair does
not change the groups, and a class is named by its least doc_id).
"""

from __future__ import annotations

import re
from functools import lru_cache
from hashlib import blake2b

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from .common import boxed, checkpointed, map_batches, table, unboxed
from .components import components

THRESHOLD = 0.8
SHINGLE = 5
TREES, DEPTH = 20, 8
RECALL = 0.999
SLACK = 0.12  # a signature estimate may be so far under the threshold
BLOCK_TEXTS = 512
BLOCK_SHINGLES = 200_000
FILTER_BITS = 1 << 26

_WORD = re.compile(r"\w+")
_K = np.uint64(0x9E3779B97F4A7C15)


def prefix_depth(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold is found in some
    tree with probability ``recall``."""
    depth = DEPTH
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def prefix_depths(threshold: float = THRESHOLD) -> list[int]:
    """Prefix lengths in the order of matching: whole labels, then the longest that
    reaches the recall.  (Steps between them would shuffle all labels again.)"""
    return sorted({DEPTH, prefix_depth(threshold)}, reverse=True)


@lru_cache(maxsize=200_000)
def _word_hash(word: str) -> int:
    return int.from_bytes(blake2b(word.encode("utf-8", "replace"), digest_size=8).digest(), "little")


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _K
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word windows."""
    words = _WORD.findall(text.lower()) if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    w = np.array([_word_hash(x) if len(x) < 64 else _word_hash.__wrapped__(x) for x in words], dtype=np.uint64)
    n = max(1, len(w) - SHINGLE + 1)
    h = np.full(n, len(w) if len(w) < SHINGLE else SHINGLE, dtype=np.uint64)
    for k in range(min(SHINGLE, len(w))):
        h = _mix(h + w[k : k + n])
    return np.unique(h)


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.RandomState(11)
    k = TREES * DEPTH
    flip = rng.randint(0, 2**32, k, dtype=np.uint32)
    return flip[:, None], (rng.randint(0, 2**32, k, dtype=np.uint32) | np.uint32(1))[:, None]


def signature(s: np.ndarray) -> np.ndarray:
    """``TREES * DEPTH`` min-hashes, 16 bits each."""
    flip, factor = _permutations()
    least = np.full((len(flip), 1), 2**32 - 1, dtype=np.uint32)
    h = (s >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(h), 2048):
        p = ((h[None, a : a + 2048] ^ flip) * factor).min(axis=1, keepdims=True)
        least = np.minimum(least, p)
    return ((least[:, 0] * np.uint32(2654435769)) >> np.uint32(16)).astype("<u2")


_SIGNED = [
    StructField("fp", LongType()),
    StructField("key", BinaryType()),
    StructField("size", IntegerType()),
    StructField("signature", BinaryType()),
]


def signed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fp`` (hash of the text), ``key`` (hash of the shingle set, null
    without words), ``size`` and ``signature``."""
    schema = StructType([docs.schema["doc_id"], *_SIGNED])

    def make():
        def step(batch):
            key, size, sig = [], [], []
            for t in batch.column("text"):
                s = shingles(t.as_py())
                size.append(len(s))
                key.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(signature(s).tobytes() if len(s) else None)
            yield {
                "doc_id": batch.column("doc_id"), "fp": batch.column("fp"),
                "key": key, "size": size, "signature": sig,
            }

        return step

    return map_batches(docs.select("doc_id", "text", F.xxhash64("text").alias("fp")), make, schema)


def _units(rows: DataFrame, blocks: Column) -> DataFrame:
    """A row for every pair of blocks (``one``, ``two``) of its group that it takes
    part in, and its block, ``own``; a group of one block is one unit."""
    own = F.pmod(F.xxhash64("id", F.lit(5)), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return (
        rows.withColumn("blocks", F.greatest(blocks.cast("long"), F.lit(1).cast("long")))
        .withColumn("own", own)
        .withColumn("other", other)
        .withColumn("one", F.least("own", "other"))
        .withColumn("two", F.greatest("own", "other"))
        .drop("blocks", "other")
    )


def _in_units(units: DataFrame, work, schema: StructType) -> DataFrame:
    """``work(columns)`` on the rows of each (group, one, two)."""
    by = ["group", "one", "two"]
    dealt = units.repartition("group", "one", "two").sortWithinPartitions(*by, "id")

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)

        def whole():
            """Rows of one unit at a time, across batches."""
            held = None
            for batch in batches:
                t = pa.Table.from_batches([batch])
                t = t if held is None else pa.concat_tables([held, t])
                n = t.num_rows
                change = np.zeros(max(n - 1, 0), dtype=bool)
                for c in by:
                    v = t.column(c).to_numpy()
                    change |= v[1:] != v[:-1]
                edges = [0, *(np.flatnonzero(change) + 1).tolist()]
                t = t.combine_chunks()
                for a, b in zip(edges, edges[1:], strict=False):
                    yield t.slice(a, b - a)
                held = t.slice(edges[-1]) if n else None
            if held is not None and held.num_rows:
                yield held

        out: dict[str, list] = {f.name: [] for f in arrow}
        for unit in whole():
            for name, values in work(unit).items():
                out[name].append(values)
            if len(out[arrow[0].name]) >= 256:
                yield _batch(out, arrow)
                out = {f.name: [] for f in arrow}
        yield _batch(out, arrow)

    def _batch(out, arrow):
        import pyarrow as pa

        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate(out[f.name]) if out[f.name] else [], type=f.type)
                for f in arrow
            ],
            schema=arrow,
        )

    return dealt.mapInArrow(run, schema)


def _forest(linked: np.ndarray) -> np.ndarray:
    """Root index of each row of a symmetric boolean matrix."""
    n = len(linked)
    root = np.full(n, -1)
    for i in range(n):
        if root[i] >= 0:
            continue
        reached = np.zeros(n, dtype=bool)
        front = np.array([i])
        reached[i] = True
        while front.size:
            more = linked[front].any(axis=0) & ~reached
            reached |= more
            front = np.flatnonzero(more)
        root[reached] = i
    return root


def _sides(unit) -> tuple[np.ndarray, np.ndarray]:
    """First rows of each id, and which of them may be compared: all in a block
    with itself, else only rows of different blocks."""
    ids = unit.column("id").to_numpy()
    _, first = np.unique(ids, return_index=True)
    own = unit.column("own").to_numpy()[first]
    one, two = unit.column("one")[0].as_py(), unit.column("two")[0].as_py()
    return first, np.ones((len(first),) * 2, dtype=bool) if one == two else own[:, None] != own[None]


_TIES = StructType([StructField("a", LongType()), StructField("b", LongType())])


def _tie(threshold: float):
    def work(unit):
        first, may = _sides(unit)
        ids = unit.column("id").to_numpy()[first]
        sig = np.frombuffer(
            b"".join(unit.column("signature").take(first).to_pylist()), dtype="<u2"
        ).reshape(len(ids), -1)
        need = (threshold - SLACK) * sig.shape[1]
        root = unit.column("root").to_numpy()[first]
        may &= root[:, None] != root[None]  # those tied already stay so
        near = np.zeros((len(ids),) * 2, dtype=bool)
        for i in range(len(ids)):
            later = np.flatnonzero(may[i, i + 1 :]) + i + 1
            near[i, later] = (sig[i] == sig[later]).sum(axis=1) >= need
        root = _forest(near | near.T)
        tied = np.flatnonzero(root != np.arange(len(ids)))
        return {"a": ids[tied], "b": ids[root[tied]]}

    return work


_LINKS = StructType(
    [StructField("id", LongType()), StructField("root", LongType()), StructField("links", LongType())]
)


def _link(threshold: float):
    def work(unit):
        first, may = _sides(unit)
        ids = unit.column("id").to_numpy()[first]
        copies = unit.column("copies").to_numpy()[first]
        sets = [np.frombuffer(b, dtype="<u8") for b in unit.column("shingles").take(first).to_pylist()]
        size = np.array([len(s) for s in sets])
        _, code = np.unique(np.concatenate(sets), return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), size)
        ends = np.cumsum(size)
        mark = np.zeros(code.max() + 1, dtype=bool)
        linked = np.zeros((len(ids),) * 2, dtype=bool)
        for i in range(len(ids)):
            mine = code[ends[i] - size[i] : ends[i]]
            mark[mine] = True
            both = np.bincount(owner[mark[code]], minlength=len(ids))
            mark[mine] = False
            linked[i] = both >= threshold * (size[i] + size - both) - 1e-9
        linked &= may
        np.fill_diagonal(linked, False)
        return {"id": ids, "root": ids[_forest(linked)], "links": linked @ copies}

    return work


def matched(texts: DataFrame, groups: DataFrame, depth: int) -> DataFrame:
    """``id``, ``root``, ``group`` (a node at ``depth`` of some trie) and ``n`` (texts
    in it) of the texts in nodes that hold texts of different ``groups`` (columns
    ``node`` and ``root``; a text not in it is a group by itself)."""
    label = lambda t: F.xxhash64(
        F.lit(t), F.substring("signature", 2 * DEPTH * t + 1, 2 * depth)
    )
    places = (
        texts.join(groups.withColumnRenamed("node", "id"), "id", "left")
        .withColumn("root", F.coalesce("root", "id"))
        .select("id", "root", F.explode(F.array(*map(label, range(TREES)))).alias("group"))
    )
    shared = (
        places.groupBy("group")
        .agg(F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most"))
        .where("least < most")
    )
    return places.join(shared.select("group", "n"), "group")


def candidate_groups(texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``node`` and ``root`` of the texts (``id``, ``signature``) that some tie holds."""
    groups = texts.sparkSession.createDataFrame([], "node long, root long")
    for depth in prefix_depths(threshold):
        members = matched(texts, groups, depth).join(texts.select("id", "signature"), "id")
        units = _units(members, F.ceil(F.col("n") / BLOCK_TEXTS))
        ties = _in_units(
            units.select("group", "one", "two", "own", "id", "root", "signature"), _tie(threshold), _TIES
        )
        tied_before = groups.select(F.col("node").alias("a"), F.col("root").alias("b"))
        groups = checkpointed(components(ties.unionByName(tied_before)))
    return groups


def joined(docs: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``fp``, ``class_id`` (least doc_id of the class), ``n_links`` and
    ``first`` (the struct of doc_id and fp that stands for the class; null
    without words) of every row."""
    rows = checkpointed(signed(docs))
    texts = checkpointed(
        rows.where("key is not null")
        .groupBy("key")
        .agg(
            F.count("*").alias("copies"),
            F.min(F.struct("doc_id", "fp")).alias("one"),
            F.min("doc_id").alias("least"),
            F.first("size").alias("size"),
            F.first("signature").alias("signature"),
        )
    ).withColumn("id", F.monotonically_increasing_id())

    # 1., 2. ties by signature in shared prefixes
    groups = candidate_groups(texts, threshold)
    # 3. exact comparison within groups
    chosen = checkpointed(
        texts.join(groups.withColumnRenamed("node", "id"), "id").select("id", "root", "copies", "size", "one")
    )
    totals = chosen.groupBy("root").agg(
        F.greatest(
            F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("size") / BLOCK_SHINGLES)
        ).alias("blocks_of")
    )
    sets = _sets(docs, chosen.select("id", "one"))
    work = chosen.drop("one").join(sets, "id").join(totals, "root").withColumnRenamed("root", "group")
    units = _units(work, F.col("blocks_of"))
    links = checkpointed(
        _in_units(
            units.select("group", "one", "two", "own", "id", "copies", "shingles"), _link(threshold), _LINKS
        )
    )
    classes = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    known = (
        texts.select("id", "key", "copies", "one", "least")
        .join(classes.withColumnRenamed("node", "id"), "id", "left")
        .join(counted, "id", "left")
        .withColumn("root", F.coalesce("root", "id"))
    )
    known = checkpointed(known)
    heads = known.groupBy("root").agg(F.min("one").alias("first"), F.min("least").alias("class_id"))
    verdict = known.join(heads, "root").select(
        "key",
        "first",
        "class_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    out = rows.drop("size", "signature").join(verdict, "key", "left")
    alone = F.col("key").isNull()
    return out.select(
        "doc_id",
        "fp",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        "first",
    )


def _place(doc_id: str, fp: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), fp)


def bit_set(places: DataFrame) -> np.ndarray:
    """Bit set of the 64-bit ``place`` values, two bits each, as 64-bit words: at
    most ``FILTER_BITS / 64`` words reach the driver."""
    two = F.array("place", F.shiftrightunsigned("place", 32))
    bits = places.select(F.explode(F.transform(two, lambda h: h.bitwiseAND(FILTER_BITS - 1))).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("held")
    )
    got = words.toArrow()
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    out[got.column("word").to_numpy()] = got.column("held").to_numpy()
    return out.view(np.uint64)


def may_hold(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """False for places that are surely not in the bit set."""
    out = np.ones(len(places), dtype=bool)
    places = places.astype(np.int64).view(np.uint64)
    for h in (places, places >> np.uint64(32)):
        b = h & np.uint64(FILTER_BITS - 1)
        out &= (bits[b >> np.uint64(6)] >> (b & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id`` and ``shingles`` (packed hashes) of the wanted texts, read again; a task
    gives a (doc_id, text) that it meets several times once."""
    wanted = wanted.select("id", F.col("one.doc_id").alias("d"), F.col("one.fp").alias("f"))
    shared = docs.sparkSession.sparkContext.broadcast(
        bit_set(wanted.select(_place("d", "f").alias("place")))
    )
    schema = StructType(
        [docs.schema["doc_id"], StructField("fp", LongType()), StructField("shingles", BinaryType())]
    )

    def make():
        bits, seen = shared.value, set()

        def step(batch):
            some = np.flatnonzero(may_hold(bits, batch.column("place").to_numpy()))
            some = batch.take(some)
            ids, fps, texts = (some.column(c).to_pylist() for c in ("doc_id", "fp", "text"))
            out: dict[str, list] = {"doc_id": [], "fp": [], "shingles": []}
            for d, f, t in zip(ids, fps, texts, strict=True):
                if (d, f) not in seen:
                    seen.add((d, f))
                    out["doc_id"].append(d)
                    out["fp"].append(f)
                    out["shingles"].append(shingles(t).astype("<u8").tobytes())
            yield out

        return step

    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("fp"))
    read = map_batches(texts.withColumn("place", _place("doc_id", "fp")), make, schema)
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("fp") == F.col("f"))
    return read.join(wanted, same).select("id", "shingles")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of every class stays, with all columns of ``docs``: that of the
    least (doc_id, hash of the text); rows without words all stay."""
    heads = (
        joined(docs.select("doc_id", "text"))
        .where("first is null or (doc_id <=> first.doc_id and fp = first.fp)")
        .select("doc_id", "fp", F.col("first").isNull().alias("alone"))
        .distinct()
    )
    heads = heads.select(
        _place("doc_id", "fp").alias("place"), F.col("doc_id").alias("d"), F.col("fp").alias("f"), "alone"
    )
    rows = boxed(docs).select(
        "row", "text", F.col("row.doc_id").alias("doc_id"), F.xxhash64("text").alias("fp")
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("fp") == F.col("f"))
    found = rows.withColumn("place", _place("doc_id", "fp")).join(
        heads.withColumnRenamed("place", "at"), (F.col("place") == F.col("at")) & same
    )
    nth = F.row_number().over(Window.partitionBy("place", "doc_id", "fp").orderBy(F.lit(1)))
    return unboxed(found.withColumn("nth", nth).where("alone or nth = 1"), docs)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = joined(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links")


QUERIES = {"op9_ngram_jaccard_join": op9}
