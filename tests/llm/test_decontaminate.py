import hashlib
import random
import re

from strata.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, window=10):
    """{doc: (n_words, n_hit, sorted items)} by sets of word tuples."""
    owners = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            owners.setdefault(tuple(w[i : i + window]), set()).add(str(item))
    sizes = {len(k) for k in owners}
    out = {}
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := owners.get(tuple(w[i : i + n])):
                    ids |= found
                    hit.update(range(i, i + n))
        out[doc] = (len(w), len(hit), sorted(ids))
    return out


def check(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as item_ids")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "3 as block")
    got = {
        r.doc_id: (r.n_words, sum(b - a for a, b in r.hit_ranges), list(r.item_ids))
        for r in dc.decontaminate(d, b, **options).collect()
    }
    assert got == brute(docs, items)


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(3)
    vocab = ["a", "the", "Été", "x9", "ion", "tion", "ationalism", "naïve", "z"]
    text = lambda n: rng.choice([" ", "\n", ", ", "--"]).join(rng.choices(vocab, k=n))
    items = [(i, text(rng.choice([1, 2, 5, 9, 10, 12, 40]))) for i in range(40)]
    docs = [(i, text(rng.choice([0, 3, 50, 400]))) for i in range(60)]
    docs += [(100 + i, f"Before it {t.upper()} after it.") for i, t in items]
    check(spark, docs, items)
    check(spark, docs, items, block_bytes=600)  # several passes


def test_defined_cases(spark):
    long = "word " * 150_000
    docs = [(1, None), (2, ""), (3, "!!! ..."), (4, "one two"), (5, long), (6, "ONE, two")]
    check(spark, docs, [(1, None), (2, ""), (3, "one two"), (4, "word " * 30), (5, "one two")])
    check(spark, docs, [])
    d = spark.createDataFrame([(1, "one two"), (1, "one two")], "doc_id long, text string")
    b = spark.createDataFrame([(None, "one two")], "item_id long, text string")
    got = dc.decontaminate(d, b).collect()
    assert [(r.contaminated, r.item_ids) for r in got] == [(True, [])] * 2
    assert dc.decontaminate(d.limit(0), b).count() == 0


def test_query_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    read = lambda t, k: [(r[k], r.text) for r in spark.read.parquet(f"{path}/{t}.parquet").collect()]
    want = brute(read("documents", "doc_id"), read("benchmark", "item_id"))
    got = dc.op10(spark, path).collect()
    assert len(got) == len(want) and any(r.contaminated for r in got)
    for r in got:
        n, hit, ids = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(ids), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
