import math
import random

import duckdb
import numpy as np
import pytest

from strata.llm import hard_negatives as hn

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, positives=5, negatives=10):
    good = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        good.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out = []
    for i, q, label in good:
        if i % 100:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(q, p, strict=True)), j, other)
            for j, p, other in good
            if len(p) == len(q)
        )
        for s, j, _ in [x for x in scored if x[2] == label and x[1] != i][:positives]:
            hard = [x for x in scored if x[2] != label and 30 * s >= 100 * x[0] >= 90 * s]
            out += [(i, j, k + 1, m, -s, -t) for k, (t, m, _) in enumerate(hard[:negatives])]
    return sorted(out)


def run(spark, path, rows):
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "1 as v", "2 as id", "3 as no", "4 as rank")
    df.repartition(3).write.parquet(f"{path}/embeddings.parquet")
    got = hn.op12(spark, str(path))
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


def clustered(n, dims, seed, groups=12, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    v = centres[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, dims))
    v /= np.linalg.norm(v, axis=1)[:, None]
    return [(i, [float(x) for x in v[i].astype(np.float32)], int(rng.integers(10))) for i in range(n)]


def test_query_with_odd_rows(spark, tmp_path):
    rows = clustered(900, 8, 1)
    rows[100] = (100, None, 1)
    rows[101] = (101, [None] + [0.5] * 7, 1)
    rows[102] = (102, [float("nan")] + [0.5] * 7, 1)
    rows[103] = (103, [float("-inf")] + [0.5] * 7, 1)
    rows[104] = (104, rows[104][1], None)
    rows[200] = (200, [0.0] * 8, 3)  # scores zero everywhere
    rows[300] = (300, [0.1, 0.2, 0.3], 4)  # other numbers of components
    rows[301:306] = [(i, [0.1, 0.2, 0.3 + i / 1e3], i % 2) for i in range(301, 306)]
    rows[400] = (400, [], 2)
    rows[500:520] = [(i, rows[500][1], i % 10) for i in range(500, 520)]  # ties
    rows += [(None, rows[7][1], 3), (901, rows[5][1], 3), (901, rows[5][1], 3)]
    assert run(spark, tmp_path, rows) == brute(rows)


def test_repeated_anchors_each_count(spark, tmp_path):
    rows = clustered(300, 6, 2)
    rows += [rows[100], rows[100]]
    assert run(spark, tmp_path, rows) == brute(rows)


def test_empty_and_without_anchors(spark, tmp_path):
    assert run(spark, tmp_path / "a", []) == []
    assert run(spark, tmp_path / "b", [(5, [1.0], 1), (6, [1.0], 1)]) == []


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_blocks_parts_and_early_stops(spark, monkeypatch, spread):
    rows = clustered(3000, 16, 3, spread=spread)
    items = hn.usable(
        spark.createDataFrame(
            [(i, v, (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows],
            "vec_id long, embedding array<float>, label int",
        ).repartition(4)
    )
    monkeypatch.setattr(hn, "MEMBERS", 4)
    monkeypatch.setattr(hn, "STEP", 32)
    monkeypatch.setattr(hn, "PER_CLUSTER", 3)
    got = hn.mine(items, items.where("id % 100 = 0"), block_bytes=16 * 8 * 12)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_tight_clusters_end_the_walk_early():
    rows = clustered(20_000, 16, 4, spread=0.02)
    q = hn.quantised(np.array([v for _, v, _ in rows]))
    ids, labels = np.arange(len(rows)), np.array([r[2] for r in rows])
    some = np.arange(0, len(rows), 100)
    nearest = (hn.unit(q[some])[0] @ hn.fit_centres(q[some], 24).T).argmax(axis=1)
    wide = np.full((len(some), 1), -np.inf), np.full((len(some), 1), np.inf)
    block = hn.Block(some, ids[some], labels[some], nearest, q[some], *wide, True, 5)
    lists = hn.Lists(block, block.floors())
    lists.take(q, ids, labels)
    assert lists.seen < 0.4 * len(some) * len(rows)  # most candidates are never scored


def test_large_components_saturate(spark):
    rows = [(i, [1e30 if i % 3 else -1e30, float(i)], i % 2) for i in range(0, 300, 10)]
    items = hn.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert hn.mine(items, items.where("id % 100 = 0")).count() >= 0


def test_whole_table_against_sql(spark):
    path = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{path}/embeddings.parquet'")
    want = con.execute(f"select {','.join(COLUMNS)} from ({hn.ORACLE['op12_hard_negatives']})").fetchall()
    assert sorted(map(tuple, hn.op12(spark, path).collect())) == sorted(want) and want


def test_random_centres_stay_exact():
    rng = random.Random(6)
    q = hn.quantised(np.array([[rng.uniform(-1, 1) for _ in range(5)] for _ in range(400)]))
    ids, labels = np.arange(400), np.arange(400) % 3
    wide = np.full((40, 1), -np.inf), np.full((40, 1), np.inf)
    block = hn.Block(ids[:40], ids[:40], labels[:40], ids[:40] % 4, q[:40], *wide, True, 5)
    lists = hn.Lists(block, block.floors())
    for a in range(0, 400, 37):
        lists.take(q[a : a + 37], ids[a : a + 37], labels[a : a + 37])
    for a in range(40):
        want = sorted((-int(q[a] @ q[i]), i) for i in ids if labels[i] == labels[a] and i != a)[:5]
        mine = lists.row == int(np.flatnonzero(block.no == a)[0])
        assert [(-int(s), i) for s, i in zip(lists.score[mine], lists.id[mine], strict=True)] == want
