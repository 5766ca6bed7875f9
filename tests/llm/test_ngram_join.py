import random
import re
from collections import Counter, defaultdict

from strata.llm import ngram_join as j
from strata.llm.components import components


def brute_sets(text):
    w = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(docs):
    """{row: (class members, links)} by comparing all pairs."""
    sets = [brute_sets(t) for _, t in docs]
    links = defaultdict(set)
    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                    links[a].add(b)
                    links[b].add(a)
    root, out = {}, {}
    for a in range(len(docs)):
        if a in root:
            continue
        todo = [a]
        root[a] = a
        while todo:
            for b in links[todo.pop()]:
                if b not in root:
                    root[b] = a
                    todo.append(b)
    least = {}
    for a, r in root.items():
        least[r] = min(least.get(r, docs[a][0]), docs[a][0])
    for a in range(len(docs)):
        out[docs[a][0]] = (least[root[a]], len(links[a]))
    return out


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def corpus(rng):
    docs, vocab = [], [f"w{i}" for i in range(400)]
    for _ in range(40):
        base = rng.choices(vocab, k=rng.choice([3, 8, 60, 150, 400]))
        docs.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 5])):
            docs.append(edited(rng, base, rng.choice([0, 1, 2, 4, 9])))
    passage = rng.choices(vocab, k=80)
    docs += [" ".join(rng.choices(vocab, k=60) + passage) for _ in range(30)]
    docs += [docs[5].upper(), docs[5] + " !", None, None, "", "...", "one", "One"]
    rng.shuffle(docs)
    return list(enumerate(docs))


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as id", "2 as first", "3 as key")
    rows = j.joined(df).collect()
    got = {r.doc_id: (r.class_id, r.n_links) for r in rows}
    assert len(rows) == len(docs)
    assert got == brute(docs)
    return rows


def test_join_equals_all_pairs(spark):
    check(spark, corpus(random.Random(1)))


def test_blocks_equal_all_pairs(spark, monkeypatch):
    """Groups larger than a block: every pair of blocks is compared."""
    monkeypatch.setattr(j, "BLOCK_TEXTS", 4)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(200)]
    docs = [edited(rng, base, rng.choice([0, 1, 2, 3, 4])) for _ in range(60)] + [" ".join(base)] * 20
    check(spark, list(enumerate(docs)))


def test_defined_cases(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    docs = [(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, ""), (4, long), (5, long + " more"), (None, "a b c d e f")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in j.joined(df).collect())
    assert got == Counter({(1, 1, 2): 2, (None, 1, 2): 1, (2, 2, 0): 1, (3, 3, 0): 1, (4, 4, 1): 1, (5, 4, 1): 1})
    assert j.joined(df.limit(0)).count() == 0


def test_query_equals_all_pairs(spark):
    path = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    got = {r.doc_id: (r.class_id, r.n_links) for r in j.op9(spark, path).collect()}
    assert got == brute(docs)


def test_one_of_each(spark):
    words = "a b c d e f g h"
    docs = [(3, words), (2, words.upper()), (2, words.upper()), (9, None), (9, None), (None, words), (4, "x y"), (5, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("'k' as place", "*", "doc_id as fp", "1 as row")
    got = j.one_of_each(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id or 0, r.text or "") for r in got.collect())) == sorted([(0, words), (9, ""), (9, ""), (4, "x y"), (5, "")])
    assert j.one_of_each(df.limit(0)).count() == 0


def test_recall_at_the_threshold():
    depth = j.prefix_depth()
    assert depth < j.DEPTH
    assert 1 - (1 - 0.8**depth) ** j.TREES >= j.RECALL > 1 - (1 - 0.8 ** (depth + 1)) ** j.TREES


def signatures(spark, sets):
    rows = [(i, bytearray(j.signature(x).tobytes())) for i, x in enumerate(sets)]
    return spark.createDataFrame(rows, "id long, signature binary")


def near_pair(rng, low, high):
    """Two shingle sets of 500 hashes together with a similarity in [low, high)."""
    n = 500
    both = rng.randint(-(-int(low * n * 1000) // 1000), int(high * n) - 1)
    import numpy as np

    whole = np.array([rng.getrandbits(64) for _ in range(n)], dtype=np.uint64)
    half = both + (n - both) // 2
    return np.sort(whole[:half]), np.sort(np.concatenate([whole[:both], whole[half:]]))


def test_recall_of_pairs_near_the_threshold(spark):
    """Pairs at 0.80 to 0.85, the hardest that count, end in one group."""
    rng = random.Random(12)
    pairs = [near_pair(rng, 0.80, 0.85) for _ in range(1500)]
    texts = signatures(spark, [x for p in pairs for x in p])
    root = {r.node: r.root for r in j.candidate_groups(texts).collect()}
    found = sum(root.get(2 * i, -1) == root.get(2 * i + 1, -2) for i in range(len(pairs)))
    assert found >= 0.998 * len(pairs)


def test_nodes_tied_by_whole_labels_are_not_matched_again(spark):
    rng = random.Random(13)
    base = [rng.getrandbits(64) for _ in range(400)]
    import numpy as np

    sets = [np.sort(np.array(base[:398] + [rng.getrandbits(64)], dtype=np.uint64)) for _ in range(300)]
    texts = signatures(spark, sets).cache()
    none = spark.createDataFrame([], "node long, root long")
    depths = j.prefix_depths()
    assert depths == [j.DEPTH, j.prefix_depth()]
    assert j.matched(texts, none, depths[0]).count() > 300
    groups = j.candidate_groups(texts)
    assert {r.root for r in groups.collect()} == {0} and groups.count() == 300
    assert j.matched(texts, groups, depths[1]).count() == 0


def test_bit_set_holds_what_it_was_given(spark):
    import numpy as np

    rng = random.Random(14)
    values = [rng.getrandbits(64) - 2**63 for _ in range(2000)] + [-1, 0, -(2**63), 2**63 - 1]
    bits = j.bit_set(spark.createDataFrame([(v,) for v in values], "place long"))
    assert j.may_hold(bits, np.array(values, dtype=np.int64)).all()
    others = np.array([rng.getrandbits(64) - 2**63 for _ in range(2000)], dtype=np.int64)
    assert j.may_hold(bits, others).sum() <= 2
    assert not j.bit_set(spark.createDataFrame([], "place long")).any()


def test_components(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(7, 7), (None, 3)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(60)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links, "a long, b long")
    assert {r.node: r.root for r in components(df).collect()} == {x: find(x) for x in root}
    assert components(df.limit(0)).count() == 0
