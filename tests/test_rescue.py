import json
import os
import tempfile

import pytest
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType

from strata import schemas
from strata.sources.intake import read_landing
from strata.sources.tables import read_fresh
from strata.streaming import incremental
from strata.streaming.incremental import start_incremental_upsert
from tests.test_intake_streaming import _drop, _run

FLAT = StructType(
    [
        StructField("id", IntegerType()),
        StructField("name", StringType()),
        StructField("price", DoubleType()),
        StructField("day", DateType()),
    ]
)


def put(name, text):
    folder = tempfile.mkdtemp(prefix="landing-")
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)
    return folder


def rows(spark, folder, schema=FLAT, fmt="json", **options):
    return [tuple(r) for r in read_landing(spark, folder, schema, fmt, level="field", **options).collect()]


@pytest.mark.parametrize(
    "line, want",
    [
        ('{"id":1,"name":"A","price":2.5}', (1, "A", 2.5, None, None)),
        ('{"id":1,"name":"A","loyalty":"gold"}', (1, "A", None, None, {"loyalty": "gold"})),
        ('{"id":"x7","name":"A"}', (None, "A", None, None, {"id": "x7"})),
        ('{"name":"B","z":{"a":[1,2]},"price":"free","id":3}', (3, "B", None, None, {"z": '{"a":[1,2]}', "price": "free"})),
        ('{"id":1,"seen":null}', (1, None, None, None, {"seen": None})),
        ('{"id":4294967296,"day":"2024-02-30"}', (None, None, None, None, {"id": "4294967296", "day": "2024-02-30"})),
        ('{"id":1,"ID":2}', (1, None, None, None, {"ID": "2"})),
        ("{broken", (None, None, None, None, "{broken")),
        ('{"id":5, "name":"cut', (None, None, None, None, '{"id":5, "name":"cut')),
        ('{"id":5,"id":6}', (None, None, None, None, '{"id":5,"id":6}')),
        ("[1,2]", (None, None, None, None, "[1,2]")),
    ],
)
def test_json_fields(spark, line, want):
    (got,) = rows(spark, put("a.json", line + "\n\n"))
    rescued = got[4]
    if isinstance(want[4], dict):
        rescued = json.loads(rescued)
    assert (*got[:4], rescued) == want


def test_csv_by_header(spark):
    folder = put("a.csv", "﻿name,id,colour\nA,1,red\nB,x,\nC,3\n\"D, d\",4,blue,more,,last\nname,id,colour\n")
    with open(os.path.join(folder, "b.csv"), "w") as f:
        f.write('price,id,id\n1.5,7,8\ncheap,9,\n"open,1,2\n')
    got = sorted(rows(spark, folder, fmt="csv"), key=str)
    want = [
        (1, "A", None, None, '{"colour":"red"}'),
        (None, "B", None, None, '{"id":"x"}'),
        (3, "C", None, None, None),
        (4, "D, d", None, None, '{"colour":"blue","_c4":"more","_c6":"last"}'),
        (7, None, 1.5, None, '{"id#3":"8"}'),
        (9, None, None, None, '{"price":"cheap"}'),
        (None, None, None, None, '"open,1,2'),
    ]
    assert got == sorted(want, key=str)


def test_csv_other_separator_and_empty_folder(spark):
    assert rows(spark, put("a.csv", "id|name\n1|A|z\n"), fmt="csv", sep="|") == [(1, "A", None, None, '{"_c3":"z"}')]
    assert rows(spark, put("a.csv", ""), fmt="csv") == []
    assert rows(spark, put("a.json", ""), fmt="json") == []
    with pytest.raises(ValueError):
        read_landing(spark, put("a.x", ""), FLAT, "csv", level="cell")


def test_too_many_cells_keep_the_raw_line(spark):
    line = "1," + ",".join("abcdefghijklmnopqrstuvwxyz")
    assert rows(spark, put("a.csv", f"id,name\n{line}\n"), fmt="csv") == [(None, None, None, None, line)]


def test_every_value_is_in_a_column_or_rescued(spark):
    lines = [{"customer_id": k if k % 3 else f"n{k}", "first_name": f"F{k}", f"extra{k % 4}": k * 1.5} for k in range(200)]
    folder = put("c.json", "\n".join(map(json.dumps, lines)))
    got = read_landing(spark, folder, schemas.CUSTOMERS, "json", level="field").collect()
    back = [
        {k: str(v) for k, v in r.asDict().items() if v is not None and k != "_rescued_data"}
        | json.loads(r._rescued_data or "{}")
        for r in got
    ]
    assert back == [{k: str(v) for k, v in x.items()} for x in lines]


@pytest.mark.parametrize("fmt, text", [
    ("json", '{"id":1,"name":"A","new":"n"}\n{"id":"x","name":"B"}\n'),
    ("csv", "new,name,id\nn,A,1\n,B,x\n"),
])
def test_stream_rescues_fields(spark, fresh_schema, fmt, text):
    table = f"{fresh_schema}.t"
    q = start_incremental_upsert(
        spark, put(f"a.{fmt}", text), FLAT, table, ["id"], fmt=fmt, rescue="field",
        checkpoint=tempfile.mkdtemp(prefix="ckpt-"),
    )
    q.awaitTermination(120)
    assert q.exception() is None
    assert [(r.id, r.name, r._rescued_data) for r in read_fresh(spark, table).collect()] == [(1, "A", '{"new":"n"}')]
    rejected = read_fresh(spark, f"{table}__rejected").collect()
    assert [(r.name, r._rescued_data) for r in rejected] == [("B", '{"id":"x"}')]


def test_a_batch_is_read_once_and_applied_once(spark, fresh_schema, monkeypatch):
    landing, ckpt = tempfile.mkdtemp(prefix="landing-"), tempfile.mkdtemp(prefix="ckpt-")
    table = f"{fresh_schema}.t"
    _drop(spark, landing, "b1", [("a", 1, 1), ("b", 2, 1), (None, 3, 1)])
    assert _run(spark, landing, table, checkpoint=ckpt) == 3
    ledger = read_fresh(spark, f"{table}__applied").collect()
    assert [r.epoch for r in ledger] == [0] and ledger[0].stream
    # a crash between the upsert and the ledger: the batch is delivered again
    _drop(spark, landing, "b2", [("b", 5, 2), (None, 6, 2)])
    real, calls = incremental.note_applied, []

    def crash(*args):
        calls.append(args)
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "note_applied", crash)
    with pytest.raises(Exception, match="lost"):
        _run(spark, landing, table, checkpoint=ckpt)
    state = lambda t: sorted(map(str, read_fresh(spark, f"{table}{t}").drop("_key_bucket").collect()))
    before = state(""), state("__rejected")
    monkeypatch.setattr(incremental, "note_applied", real)
    _run(spark, landing, table, checkpoint=ckpt)
    assert (state(""), state("__rejected")) == before and calls
    assert [r.epoch for r in read_fresh(spark, f"{table}__applied").collect()] == [1]
    # delivered once more although the ledger has it: no write happens
    os.remove(os.path.join(ckpt, "commits", "1"))
    if os.path.exists(crc := os.path.join(ckpt, "commits", ".1.crc")):
        os.remove(crc)
    touched = []
    monkeypatch.setattr(incremental, "save_upsert", lambda *a, **k: touched.append(a))
    _run(spark, landing, table, checkpoint=ckpt)
    assert not touched and (state(""), state("__rejected")) == before
