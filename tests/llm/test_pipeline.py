import re
import sys
from pathlib import Path

import pyspark.sql.functions as F

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline
from strata.llm import pii
from strata.llm import quality_rules as q
from test_decontaminate import brute as leaks
from test_ngram_join import brute_sets
from test_packing import verify
from test_quality_rules import brute as measures
from test_quality_rules import brute_em


def brute_votes(text):
    n_words, chars, symbols, dup, repeats, failed = measures(text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    letters = sum(c.isalpha() for c in text or "")
    value = {
        "symbols": (symbols, chars), "repeats": (repeats, n_words), "same_lines": (dup, len(lines)),
        "capitals": (sum(c.isupper() for c in text or ""), letters),
        "exclaims": (sum(w.endswith("!") for w in words), n_words),
        "non_words": (sum(not any(map(str.isalpha, w)) for w in words), n_words),
        "letters": (letters, chars), "vocabulary": (len(set(words)), n_words), "long_words": (chars, n_words),
    }
    out = []
    for r, (_, upto, since, good) in q.RULES.items():
        a, b = value[r]
        x = a / b if b else None
        bad = x is not None and (upto is not None and x <= upto or since is not None and x >= since)
        out.append(-1 if bad else 1 if x is not None and good is not None and x >= good else 0)
    return out, failed


def brute_quality(docs):
    judged = [brute_votes(t) for _, t in docs]
    params = brute_em([v for v, _ in judged], q.ROUNDS)
    kept = []
    for doc, (votes, failed) in zip(docs, judged):
        good, bad = params["prior"], 1 - params["prior"]
        for r, x in zip(q.RULES, votes):
            good *= {1: params[r], -1: 1 - params[r], 0: 1}[x]
            bad *= {-1: params[r], 1: 1 - params[r], 0: 1}[x]
        if not failed and good / (good + bad) >= q.KEEP_AT:
            kept.append(doc)
    return kept


def brute_classes(docs):
    """The first of each class by id; ids are distinct here."""
    docs = sorted(docs)
    sets = [brute_sets(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both) - 1e-9:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [d for a, d in enumerate(docs) if find(a) == a]


def test_run_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    read = lambda t, k: [(r[k], r.text) for r in spark.read.parquet(f"{path}/{t}.parquet").collect()]
    docs = brute_classes(brute_quality(read("documents", "doc_id")))
    found = leaks(docs, read("benchmark", "item_id"))
    docs = [(i, t) for i, t in docs if not found[i][1]]
    anchors = pii.automaton()
    docs = [(i, pii.mask(t, pii.spans_of(t, anchors))) for i, t in docs]
    rows = corpus_pipeline.run(spark, path).collect()
    assert docs and {r.doc_id for r in rows} == {i for i, _ in docs}
    n = verify(docs, rows, 2048)
    assert n <= 1.02 * -(-sum(r.length for r in rows) // 2048) + 1


def test_stages_on_odd_tables(spark):
    """Nulls, repeated rows, clashing names and empty tables go through."""
    path = "/root/testdata/sf0.001"
    prose = " ".join("".join(chr(97 + int(c)) for c in str(i * 7919)) for i in range(90))
    rows = [(1, prose, "en"), (1, prose, "en"), (2, None, None), (3, "", "x"), (None, prose + " me@x.org", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df = df.selectExpr("*", "'s' as source", "5L as n_chars", "1 as row", "2 as kept", "3 as n_words", "4 as item_ids")
    for name, stage in corpus_pipeline.STAGES:
        for docs in (df, df.limit(0)):
            out = stage(spark, docs, path)
            n = out.count()
            assert n <= docs.count() if name != "best_fit_packing" else n >= docs.count()
            if name != "best_fit_packing":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
                assert n == out.where(F.col("row") == 1).count()
