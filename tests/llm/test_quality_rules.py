import random
import re
from collections import Counter

from strata.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    w = WORD.findall(text or "")
    windows = list(zip(w, w[1:], w[2:]))
    often = Counter(windows)
    covered = {j for i, g in enumerate(windows) if often[g] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered),
        len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


def base(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def write(spark, path, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "5 as n_words", "'a' as row")
    df.write.parquet(f"{path}/documents.parquet")
    return df


def test_measures_equal_brute_force(spark, tmp_path):
    rng = random.Random(4)
    vocab = ["a", "b", "Été", "#*", "x|<y", "😀", "long!", " ", "\x1c"]
    gap = [" ", "\n", "\t", "  ", "\n\n", "\r\n", "\x0b"]
    texts = ["".join(rng.choice(vocab) + rng.choice(gap) for _ in range(rng.choice([0, 1, 2, 3, 4, 8, 60, 300]))) for _ in range(150)]
    texts += [None, "", " \n ", "a a a a", "x " * 60_000, " ".join(map(str, range(30_000)))]
    write(spark, tmp_path, list(enumerate(texts)))
    got = {r.doc_id: r for r in q.op1(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert base(got[i]) == brute(t), repr(t)[:80]
        assert not (got[i].kept and got[i].base_failed)


def test_whole_table(spark):
    path = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    rows = q.op1(spark, path).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert base(r) == brute(docs[r.doc_id])
    held = [r for r in rows if not r.base_failed and label.get(r.doc_id) is not None]
    good = [r.kept for r in held if label[r.doc_id] == 1]
    bad = [r.kept for r in held if label[r.doc_id] == 0]
    assert sum(good) == len(good) and sum(bad) <= 0.1 * len(bad)


def brute_em(votes, rounds):
    """The same estimates by plain loops over the documents."""
    params = dict.fromkeys(["prior", *q.RULES], 0.9)
    for _ in range(rounds):
        post = []
        for v in votes:
            good, bad = params["prior"], 1 - params["prior"]
            for r, x in zip(q.RULES, v):
                good *= {1: params[r], -1: 1 - params[r], 0: 1}[x]
                bad *= {-1: params[r], 1: 1 - params[r], 0: 1}[x]
            post.append(good / (good + bad))
        new = {"prior": (sum(post) + 9) / (len(post) + 10)}
        for j, r in enumerate(q.RULES):
            right = [p if v[j] == 1 else 1 - p for p, v in zip(post, votes) if v[j]]
            new[r] = (sum(right) + 9) / (len(right) + 10)
        params = {k: min(0.9999, max(0.0001, x)) for k, x in new.items()}
    return params


def test_em_equals_plain_loops(spark):
    rng = random.Random(8)
    votes = []
    for _ in range(500):
        good = rng.random() < 0.85
        votes.append([rng.choice([0, 0, 1]) if good else rng.choice([-1, -1, 0, 1]) for _ in q.RULES])
    df = spark.createDataFrame(votes, ", ".join(f"vote_{r} int" for r in q.RULES))
    got, want = q.fit(df, 5), brute_em(votes, 5)
    assert all(abs(want[k] - got[k]) < 1e-9 for k in want)
    assert q.fit(df.limit(0)) == dict.fromkeys(want, q.START)


def test_accepted_keeps_columns_and_rows(spark, tmp_path):
    word = lambda i: "".join(chr(97 + int(c)) for c in str(i * 7919))
    prose = " ".join(map(word, range(120)))
    junk = " ".join(f"{word(i)}##########" for i in range(120))
    rows = [(1, prose), (1, prose), (2, junk), (3, None), (4, "short")] + [(10 + i, prose + " " + word(500 + i)) for i in range(40)]
    df = write(spark, tmp_path, rows)
    got = q.accepted(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted([1, 1] + [10 + i for i in range(40)])
    assert q.accepted(df.limit(0)).count() == 0
