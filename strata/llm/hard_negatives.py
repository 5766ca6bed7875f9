"""Hard-negative mining over anchor-clustered shared lists.

For every anchor the best rows of its own label are its positives, and for each
positive the best rows of other labels whose score lies in a band of the
positive's score are its hard negatives.  Scores are exact integer inner products
of quantised vectors; both searches are exact and run over all rows.

Anchors are clustered.  For a cluster, candidates are sorted once by their angular
upper bound ``|c| * cos(max(0, angle(c, centre) - radius))``, which no member's
score, divided by the member's length, can exceed; every member walks that shared
list and stops where the bound proves that nothing further can enter its lists.
Thresholds start from the members' own scores against each other (anchors are rows,
too) and rise as lists fill, so most tasks report few rows.  The search is exact
whatever the clusters are; on vectors without structure the bound is weak and
members walk most of the list.

Scale: anchors are dealt into blocks of at most about ``block_bytes``; a block is
broadcast and every row of the table walks past it where it lies, so no vector is
shuffled; a task reports at most k rows a list, which are merged by anchor and
rank.  A cluster of any size is cut into parts of about ``MEMBERS``.  The cluster
centres are fitted on at most ``FIT`` anchors, the least by hash of their id;
every anchor is assigned.  Assigned anchors and each block's result are
checkpointed in the shared folder.

Rows with a null id, label, vector or component, or a component that is not
finite, take no part.  Only vectors of the anchor's number of components are
compared.  Rows of the anchor's id are never its positives; otherwise repeated
rows each count, as anchors too.  Ties go to the smaller id.  Quantised components
saturate at sqrt(2^53 / components), which keeps every score exact.  An empty table,
or one without anchors, gives no rows.  Columns other than the three named are
ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from .common import checkpointed, map_batches, table

SCALE = 256
FIT, PER_CLUSTER, MAX_CLUSTERS, ROUNDS = 4096, 64, 256, 8
MEMBERS, STEP = 1024, 1024
BLOCK_BYTES = 16 << 20
SLACK = 1e-6  # radians, far above the rounding of the angles


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id``, ``label`` and ``v`` (array<double>) of the rows that take part."""
    rows = df.select(
        F.col(vec_id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    bad = F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return rows.where("id is not null and label is not null and v is not null").where(~bad)


def quantised(matrix: np.ndarray) -> np.ndarray:
    """floor(256 * x), as doubles that hold integers."""
    top = math.isqrt((1 << 53) // max(1, matrix.shape[1]))
    return np.clip(np.floor(SCALE * matrix), -top, top)


def matrix_of(column: pa.ListArray | pa.ChunkedArray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows with ``dims`` components, and those rows quantised."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy()
    places = np.flatnonzero(np.diff(ends) == dims)
    flat = column.values.to_numpy(zero_copy_only=False)
    return places, quantised(flat[ends[places][:, None] + np.arange(dims)].reshape(len(places), dims))


def unit(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one (zero rows stay zero), and the lengths."""
    size = np.sqrt((matrix * matrix).sum(axis=1))
    return matrix / np.where(size > 0, size, 1)[:, None], size


def fit_centres(matrix: np.ndarray, k: int) -> np.ndarray:
    """Unit centres by spherical k-means; the first are spread evenly."""
    rows, _ = unit(matrix)
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)]
    for _ in range(ROUNDS):
        nearest = (rows @ centres.T).argmax(axis=1)
        total = np.zeros_like(centres)
        np.add.at(total, nearest, rows)
        moved, size = unit(total)
        centres = np.where(size[:, None] > 0, moved, centres)
    return centres


class Block:
    """Anchors of one block, in clusters, with the bands of their lists.

    ``low`` and ``high`` (anchors x lists) bound the scores that a list takes;
    a list that does not exist has ``low`` infinite."""

    def __init__(self, no, ids, labels, chunk, q, low, high, same: bool, size: int):
        order = np.argsort(chunk, kind="stable")
        self.no, self.ids, self.labels = no[order], ids[order], labels[order]
        self.q, self.low, self.high = q[order], low[order], high[order]
        self.same, self.size = same, size
        _, starts = np.unique(chunk[order], return_index=True)
        self.clusters = list(zip(starts, [*starts[1:], len(order)], strict=True))
        rows, self.norm = unit(self.q)
        self.centres = np.stack([unit(rows[a:b].sum(axis=0)[None])[0][0] for a, b in self.clusters])
        self.radius = np.array(
            [np.arccos(np.clip(rows[a:b] @ c, -1, 1)).max() for (a, b), c in zip(self.clusters, self.centres, strict=True)]
        )

    def floors(self) -> np.ndarray:
        """What a score needs for each list, by the other members alone."""
        lists = Lists(self)
        for k, (a, b) in enumerate(self.clusters):
            lists.walk(k, self.q[a:b], self.ids[a:b], self.labels[a:b])
        return lists.need


class Lists:
    """The lists of a block's anchors, filled from batches of candidates."""

    def __init__(self, block: Block, need: np.ndarray | None = None):
        self.block = block
        self.need = block.low.copy() if need is None else need.copy()
        n = block.low.shape[1]
        self.width = n
        self.row = np.empty(0, dtype=np.int64)  # anchor * width + list
        self.score, self.id = np.empty(0), np.empty(0, dtype=np.int64)
        self.seen = 0  # scores computed, for tests and figures

    def take(self, q: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        for k in range(len(self.block.clusters)):
            self.walk(k, q, ids, labels)

    def walk(self, k: int, q: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """All members of cluster ``k`` walk the candidates by falling bound."""
        block, (a, b) = self.block, self.block.clusters[k]
        rows, size = unit(q)
        angle = np.arccos(np.clip(rows @ block.centres[k], -1, 1))
        bound = size * np.cos(np.maximum(0, angle - block.radius[k] - SLACK))
        order = np.argsort(-bound, kind="stable")
        live = np.arange(a, b)
        for at in range(0, len(order), STEP):
            top = block.norm[live] * bound[order[at]]
            live = live[top + np.abs(top) * 1e-9 + 1e-3 >= self.need[live].min(axis=1)]
            if not live.size:
                return
            part = order[at : at + STEP]
            scores = block.q[live] @ q[part].T
            self.seen += scores.size
            fits = block.labels[live][:, None] == labels[part]
            fits = fits & (block.ids[live][:, None] != ids[part]) if block.same else ~fits
            self._enter(live, scores, fits, ids[part])

    def _enter(self, live: np.ndarray, scores: np.ndarray, fits: np.ndarray, ids: np.ndarray) -> None:
        rows, found, names = [self.row], [self.score], [self.id]
        for j in range(self.width):
            least, most = self.need[live, j], self.block.high[live, j]
            if (least == np.inf).all():
                continue  # no such list here
            r, c = np.nonzero(fits & (scores >= least[:, None]) & (scores <= most[:, None]))
            rows.append(live[r] * self.width + j)
            found.append(scores[r, c])
            names.append(ids[c])
        if sum(map(len, rows)) == len(self.row):
            return
        row, score, name = map(np.concatenate, (rows, found, names))
        order = np.lexsort((name, -score, row))
        row, score, name = row[order], score[order], name[order]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        place = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
        full = place == self.block.size - 1
        anchor, j = np.divmod(row[full], self.width)
        self.need[anchor, j] = np.maximum(self.need[anchor, j], score[full])
        keep = place < self.block.size
        self.row, self.score, self.id = row[keep], score[keep], name[keep]


FOUND = StructType(
    [
        StructField("no", LongType(), False),
        StructField("list", IntegerType(), False),
        StructField("score", LongType(), False),
        StructField("id", LongType(), False),
    ]
)


def _search(items: DataFrame, block: Block) -> DataFrame:
    """The best rows of every list of a block, with ``rank`` from 1."""
    shared, dims = items.sparkSession.sparkContext.broadcast(block), block.q.shape[1]

    def make():
        block = shared.value
        lists = Lists(block, block.floors())

        def step(batch):
            if batch is not None:
                places, q = matrix_of(batch.column("v"), dims)
                ids, labels = (batch.column(c).to_numpy()[places] for c in ("id", "label"))
                lists.take(q, ids, labels)
                return
            anchor, j = np.divmod(lists.row, lists.width)
            yield {
                "no": pa.array(block.no[anchor]),
                "list": pa.array(j.astype(np.int32)),
                "score": pa.array(lists.score.astype(np.int64)),
                "id": pa.array(lists.id),
            }

        return step

    found = map_batches(items, make, FOUND, last=True)
    best = Window.partitionBy("no", "list").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= block.size)


def _clustered(anchors: DataFrame, dims: int, count: int) -> DataFrame:
    """``no``, ``id``, ``label``, ``v`` and ``cluster`` of the anchors, stored."""
    some = anchors.orderBy(F.xxhash64("id"), "id").select("v").limit(FIT).toArrow()
    _, sample = matrix_of(some.column("v"), dims)
    centres = fit_centres(sample, max(1, min(MAX_CLUSTERS, count // PER_CLUSTER, len(sample))))
    schema = StructType([*anchors.schema.fields, StructField("cluster", IntegerType(), False)])

    def make():
        def step(batch):
            _, q = matrix_of(batch.column("v"), dims)
            nearest = (unit(q)[0] @ centres.T).argmax(axis=1).astype(np.int32)
            yield dict(zip(batch.schema.names, batch.columns, strict=True)) | {"cluster": pa.array(nearest)}

        return step

    return checkpointed(
        map_batches(anchors, make, schema).withColumn("no", F.monotonically_increasing_id())
    )


def _in_blocks(anchors: DataFrame, block_anchors: int) -> tuple[DataFrame, int]:
    """``chunk`` (about ``MEMBERS`` anchors of one cluster) and ``block`` of every
    anchor, and the number of blocks."""
    counts = anchors.groupBy("cluster").count().orderBy("cluster").collect()  # MAX_CLUSTERS rows at most
    parts, first, total = {}, {}, 0
    for r in counts:
        parts[r["cluster"]], first[r["cluster"]] = -(-r["count"] // MEMBERS), total
        total += parts[r["cluster"]]
    number = lambda m: F.create_map(*(F.lit(x) for kv in m.items() for x in kv))[F.col("cluster")]
    chunk = number(first) + F.pmod(F.col("no"), number(parts))
    # small clusters share a block: at most so many anchors, on average
    per_block = max(1, block_anchors * total // max(1, sum(r["count"] for r in counts)))
    out = anchors.withColumn("chunk", chunk).withColumn("block", F.floor(F.col("chunk") / per_block))
    return out, -(-total // per_block)


def mine(
    items: DataFrame,
    anchors: DataFrame,
    *,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score`` and ``negative_score``.

    ``items`` and ``anchors`` (a part of them) are as from ``usable``; a negative's
    score is ``low`` to ``high`` per cent of the positive's."""
    spark, done = items.sparkSession, []
    for r in anchors.groupBy(F.size("v").alias("dims")).count().orderBy("dims").collect():
        dims, count = r["dims"], r["count"]
        same = F.size("v") == dims
        stored, blocks = _in_blocks(
            _clustered(anchors.where(same), dims, count), max(1, block_bytes // (8 * max(1, dims)))
        )
        rows = items.where(same)
        for b in range(blocks):
            part = stored.where(F.col("block") == b).toArrow()
            done.append(checkpointed(_mine_block(rows, part, dims, positives, negatives, low, high)))
    if not done:
        return spark.createDataFrame([], RESULT)
    return reduce(DataFrame.union, done)


RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)


def _mine_block(items, part: pa.Table, dims, positives, negatives, low, high) -> DataFrame:
    no, ids, labels, chunk = (part.column(c).to_numpy() for c in ("no", "id", "label", "chunk"))
    _, q = matrix_of(part.column("v"), dims)
    open_band = np.full((len(no), 1), -np.inf), np.full((len(no), 1), np.inf)
    own = _search(items, Block(no, ids, labels, chunk, q, *open_band, True, positives))
    own = own.select("no", F.col("rank").alias("k"), F.col("id").alias("p"), F.col("score").alias("s")).toArrow()
    at = np.argsort(no)
    row = at[np.searchsorted(no[at], own.column("no").to_numpy())]
    k, p, s = (own.column(c).to_numpy() for c in "kps")
    bands = np.full((len(no), positives), np.inf), np.full((len(no), positives), -np.inf)
    bands[0][row, k - 1] = -((-low * s) // 100)
    bands[1][row, k - 1] = (high * s) // 100
    found = _search(items, Block(no, ids, labels, chunk, q, *bands, False, negatives))
    spark = items.sparkSession
    pairs = spark.createDataFrame(
        pa.table({"no": no[row], "list": (k - 1).astype(np.int32), "anchor_id": ids[row], "positive_id": p, "positive_score": s})
    )  # of one block: at most block_bytes / 8 / components * positives rows
    return found.join(pairs, ["no", "list"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(
        table(spark, sf_dir, "embeddings").withColumn(
            "label", F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end")
        )
    )
    return mine(rows, rows.where("id % 100 = 0"))


QUERIES = {"op12_hard_negatives": op12}

ORACLE = {
    "op12_hard_negatives": """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select a.vec_id as anchor_id, c.vec_id as id, a.label = c.label as same,
        cast(list_inner_product(a.q, c.q) as bigint) as score
    from rows a join rows c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id and len(a.q) = len(c.q)
), positives as (
    select anchor_id, id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select anchor_id, positive_id,
    cast(row_number() over (partition by anchor_id, positive_id order by score desc, id) as int) as rank,
    id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, id) <= 10
"""
}
