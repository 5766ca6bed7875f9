"""Weak supervision over quality rules, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document's measures.
Expectation-maximisation estimates, without labels, how often each rule is
right when it votes and how common good documents are; the posterior probability of "good" under these accuracies replaces "every rule
must pass".

Scale: the measures are one map over the text.  Votes are counted per pattern,
at most 3 ** len(RULES) rows whatever the corpus, and each EM round is one
aggregate over that small table; the scoring is an expression, so no document
is shuffled or joined.  ``accepted`` evaluates the measures a second time
rather than storing the texts.

Defined cases: null, empty or wordless text has zero counts, abstains on every
ratio and fails the base rules; equal rows get equal verdicts; extra columns,
whatever their names, are carried by ``accepted``; an empty table gives no
rows (EM then keeps its starting values).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import boxed, checkpointed, table, unboxed

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_AT = 0.5
ROUNDS = 12
SYMBOLS = "#*$%&|<>"
_SPACE = r"[\x20\x09-\x0D]+"
_POSITION_BITS = 28  # an array holds fewer elements

# name: (measure, votes bad up to, votes bad from, votes good from); a rule
# abstains elsewhere, so that "nothing odd here" is not taken for "good"
RULES = {
    "symbols": ("n_symbols / word_chars", None, 0.05, None),
    "repeats": ("n_repeat_words / n_words", None, 0.4, None),
    "same_lines": ("n_dup_lines / n_lines", None, 0.6, None),
    "capitals": ("n_upper / n_letters", None, 0.4, None),
    "exclaims": ("n_exclaims / n_words", None, 0.3, None),
    "non_words": ("n_bare / n_words", None, 0.2, None),
    "letters": ("n_letters / word_chars", 0.65, None, 0.9),
    "vocabulary": ("n_distinct / n_words", 0.05, None, None),
    "long_words": ("word_chars / n_words", None, 15, None),
}
START = 0.9  # accuracies and share of good documents before the first round


def _words(text: Column) -> Column:
    bare = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(F.length(bare) > 0, F.split(bare, _SPACE)).otherwise(F.array().cast("array<string>"))


def _adjacent_equal(sorted_array: Column, key) -> Column:
    """Elements whose key equals a neighbour's."""
    return F.filter(
        sorted_array,
        lambda x, k: F.coalesce(key(F.get(sorted_array, k - 1)) == key(x), F.lit(False))
        | F.coalesce(key(F.get(sorted_array, k + 1)) == key(x), F.lit(False)),
    )


def _with_repeats(df: DataFrame) -> DataFrame:
    """``n_repeat_words`` from ``words``: sorted 36-bit window hashes with their
    positions name the candidates, an exact comparison decides among them."""
    words, low = F.col("words"), F.lit((1 << _POSITION_BITS) - 1).cast("long")
    window_hash = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.shiftleft(
            F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)), _POSITION_BITS
        ).bitwiseOR(i.cast("long")),
    )
    df = df.withColumn(
        "hashes", F.when(F.size(words) >= 4, F.sort_array(window_hash)).otherwise(F.array().cast("array<long>"))
    )
    df = df.withColumn(
        "near", _adjacent_equal(F.col("hashes"), lambda x: F.shiftright(x, _POSITION_BITS))
    )
    named = F.transform(
        "near",
        lambda x: F.struct(
            F.concat_ws(" ", F.slice(words, x.bitwiseAND(low).cast("int") + 1, F.lit(3))).alias("w"),
            x.bitwiseAND(low).alias("at"),
        ),
    )
    df = df.withColumn("named", F.sort_array(named))
    df = df.withColumn(
        "places",
        F.sort_array(
            F.transform(_adjacent_equal(F.col("named"), lambda x: x["w"]), lambda x: x["at"])
        ),
    )
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    covered = F.aggregate(
        "places",
        zero,
        lambda acc, p: F.struct(
            (acc["n"] + p + 3 - F.greatest(acc["end"], p)).alias("n"), (p + 3).alias("end")
        ),
        lambda acc: acc["n"],
    )
    return df.withColumn("n_repeat_words", covered).drop("hashes", "near", "named", "places")


def measured(boxed_docs: DataFrame) -> DataFrame:
    """``row``, ``text`` and the measures of each text."""
    text = F.coalesce("text", F.lit(""))
    count = lambda c: c.cast("long")
    df = boxed_docs.withColumn("words", _words(text)).withColumn(
        "lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    df = df.withColumns(
        {
            "n_words": count(F.size("words")),
            "word_chars": count(F.length(F.translate(text, " \t\n\x0b\f\r", ""))),
            "n_symbols": count(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))),
            "n_lines": count(F.size("lines")),
            "n_dup_lines": count(F.size("lines") - F.size(F.array_distinct("lines"))),
            "n_upper": count(F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))),
            "n_letters": count(F.length(text) - F.length(F.regexp_replace(text, r"\p{L}+", ""))),
            "n_exclaims": count(F.size(F.filter("words", lambda w: w.endswith("!")))),
            "n_bare": count(F.size(F.filter("words", lambda w: ~w.rlike(r"\p{L}")))),
            "n_distinct": count(F.size(F.array_distinct("words"))),
        }
    )
    # Always 0, but not deterministic: Spark pushes no filter on the verdict
    # below this point, where it would repeat the measures' expressions for
    # every use (exponentially often, for those that build on each other).
    fence = F.least(F.monotonically_increasing_id(), F.lit(0))
    return (
        _with_repeats(df).drop("words", "lines").withColumn("n_words", F.col("n_words") + fence)
    )


def _vote(rule: str) -> Column:
    measure, upto, since, good = RULES[rule]
    x = F.try_divide(*(F.col(c) for c in measure.split(" / ")))
    vote = F.when(F.lit(False), 0)
    for bound, value in ((upto, -1), (since, -1), (good, 1)):
        if bound is not None:
            vote = vote.when(x <= bound if bound is upto else x >= bound, value)
    return vote.otherwise(0)


def voted(df: DataFrame) -> DataFrame:
    return df.withColumns({f"vote_{r}": _vote(r) for r in RULES})


def posterior(params: dict[str, float]) -> Column:
    """Probability of "good" given the votes: each adds its rule's log odds.
    The odds are one array, so that the compiled code is the same each round."""
    votes = F.array(F.lit(1.0), *(F.col(f"vote_{r}").cast("double") for r in RULES))
    odds = F.array(*(F.lit(math.log(params[k] / (1 - params[k]))) for k in ("prior", *RULES)))
    total = F.aggregate(
        F.zip_with(votes, odds, lambda v, x: v * x), F.lit(0.0), lambda a, x: a + x
    )
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(votes: DataFrame, rounds: int = ROUNDS) -> dict[str, float]:
    """By EM: each rule's accuracy when it votes, and ``prior``, the share of
    good documents.  The starting values count as ten documents."""
    names = [f"vote_{r}" for r in RULES]
    patterns = checkpointed(votes.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1))
    params = dict.fromkeys(["prior", *RULES], START)
    for _ in range(rounds):
        p = F.col("p")
        sums = [F.sum(F.col("n") * p).alias("right_prior"), F.sum("n").alias("of_prior")]
        for r in RULES:
            vote = F.col(f"vote_{r}")
            right = F.when(vote == 1, p).when(vote == -1, 1 - p).otherwise(0.0)
            sums.append(F.sum(F.col("n") * right).alias(f"right_{r}"))
            sums.append(F.sum(F.col("n") * F.abs(vote)).alias(f"of_{r}"))
        s = patterns.withColumn("p", posterior(params)).agg(*sums).first()
        if not s["of_prior"]:
            break
        params = {
            k: min(0.9999, max(0.0001, (s[f"right_{k}"] + 10 * START) / (s[f"of_{k}"] + 10)))
            for k in params
        }
    return params


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def judged(votes: DataFrame, params: dict[str, float]) -> DataFrame:
    """``base_failed``, ``quality`` (posterior) and ``kept``."""
    return votes.withColumn("base_failed", base_failed()).withColumn(
        "quality", posterior(params)
    ).withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_AT))


def rated(docs: DataFrame) -> DataFrame:
    """``row`` (the other columns), measures, votes and verdict of every row."""
    votes = checkpointed(voted(measured(boxed(docs))).drop("text"))
    return judged(votes, fit(votes))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    votes = voted(measured(boxed(docs)))
    return unboxed(judged(votes, fit(votes)).where("kept"), docs)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "row.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.round("quality", 6).alias("quality"),
    )


QUERIES = {"op1_quality_rules": op1}
