import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import period_runs as pr


def brute(words, min_length=6, min_repeats=4):
    """Every period by itself: maximal stretches whose smallest period it is."""
    _, w = np.unique(np.array(list(words), dtype=object), return_inverse=True) if words else (0, np.empty(0, int))
    n, out = len(w), []
    for q in range(1, n // min_repeats + 1):
        same = np.concatenate([[False], w[q:] == w[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            part = w[a : b + q]
            if len(part) >= max(min_length, min_repeats * q) and not any(
                (part[p:] == part[:-p]).all() for p in range(1, q)
            ):
                out.append((a, len(part), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
        sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab", max_size=70))
def test_runs_of_two_letters(text):
    assert pr.runs_of(text) == brute(text)


@settings(max_examples=800, deadline=None)
@given(
    st.lists(
        st.tuples(st.text(alphabet="abc", min_size=1, max_size=12), st.integers(1, 9)), max_size=8
    )
)
def test_runs_of_repeated_blocks(blocks):
    text = "".join(b * k for b, k in blocks)
    assert pr.runs_of(text) == brute(text)


def test_nested_blocks():
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(1, 4)))
        for _ in range(rng.randint(1, 3)):
            text = text * rng.randint(2, 5) + "".join(rng.choice("abc") for _ in range(rng.randint(0, 3)))
        text = text[:400]
        assert pr.runs_of(text) == brute(text), text


@pytest.mark.parametrize(
    "text, runs",
    [("aaaaa", []), ("aaaaaa", [(0, 6, 1)]), ("abababab", [(0, 8, 2)]), ("xabababa", []), ("", [])],
)
def test_small(text, runs):
    assert pr.runs_of(text) == runs


@pytest.mark.parametrize("min_length, min_repeats", [(6, 3), (9, 3), (20, 4), (12, 6)])
def test_other_limits(min_length, min_repeats):
    rng = random.Random(min_length)
    for _ in range(200):
        text = "".join(rng.choice(["ab", "a", "b", "abcab", "aab" * 7]) for _ in range(20))
        assert pr.runs_of(text, min_length=min_length, min_repeats=min_repeats) == brute(
            text, min_length, min_repeats
        )


def test_long_texts_stay_fast():
    n = 200_000
    assert pr.runs_of(["x"] * n) == [(0, n, 1)]
    assert pr.runs_of(list("abcdefghij") * 20_000) == [(0, n, 10)]
    block = [f"w{i}" for i in range(30_000)]
    assert pr.runs_of(block * 5) == [(0, 150_000, 30_000)]
    runs = pr.runs_of((["x"] * 50 + ["y"]) * 1000)
    assert (0, 51_000, 51) in runs and len(runs) == 1001


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is not None, *map(str, r)))


def test_query_on_planted_rows(spark, tmp_path):
    rng = random.Random(3)
    texts = [None, "", " \n\t", "a b a b a b a b", "é é é é é é é\x1f", "x " * 3000]
    texts += [" ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 90))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[3])]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 as runs", "2 as n_words", "3 as length", "4 as best"
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = [brute_row(*r) for r in rows]
    got = rows_of(pr.op13(spark, str(tmp_path)))
    assert got == sorted(want, key=lambda r: (r[0] is not None, *map(str, r)))


def test_whole_table(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((brute_row(*d) for d in docs), key=lambda r: (r[0] is not None, *map(str, r)))
    assert rows_of(pr.op13(spark, path)) == want
    assert any(r[1] for r in want)


def test_outputs_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "p q p q p q p q end")], "doc_id long, text string")
    row = pr.find_runs(docs, keep=("doc_id", "text")).first()
    assert row.collapsed == "p q end" and row.n_words == 9
    assert [tuple(r) for r in row.runs] == [(0, 8, 2)]
    assert pr.find_runs(docs.limit(0)).count() == 0
