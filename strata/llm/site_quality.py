"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic regression on text measures, trained on a bounded sample of labelled
documents, gives each document's own evidence.  Sites (hosts, and paths within
hosts) get a posterior mean of quality from the probabilities of their
documents: a path is shrunk toward its host and a host toward the whole corpus,
the more the fewer documents it has.  How strongly is learned from the data:
the prior's weight comes from the variance between sites (method of moments).
The document's odds are then moved by its path's posterior odds against the
corpus's.  A document takes no part in the posteriors that judge it, so its own
evidence counts once: a path of one document has its host's posterior, a host of
one document the corpus's mean.

Scale: sites are summarised by grouped aggregates with map-side combination; a
site's documents never meet in one task, and the summaries come back by a join
that Spark may split on a hot site.  The sample has at most about
``MAX_LABELLED`` rows and is drawn by hash; it trains in Spark.

Defined cases: null text counts as empty; a null host or path is a site of its
own; documents without labels are judged like others; labels for a repeated
doc_id count once per row; without both classes among the labels the
classifier gives every document the share of good labels (one half without
any); repeated rows are each reported, and each is evidence for the others; very long
texts are measured whole; documents of equal evidence in equal sites get equal
quality; an empty table gives no rows; extra columns are ignored, those named like
the operator's own included.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import quality_rules
from .common import boxed, checkpointed, table

MAX_LABELLED = 20_000
KEEP_AT = 0.5
# the measures' ratios, as for the rules, and the length
FEATURES = tuple(quality_rules.RULES)


def _ratios(df: DataFrame) -> DataFrame:
    """A feature per rule measure, and the log of the words."""
    out = {
        f"x_{name}": F.coalesce(
            F.try_divide(*(F.col(c) for c in quality_rules.RULES[name][0].split(" / "))), F.lit(0.0)
        )
        for name in FEATURES
    }
    out["x_long_words"] = F.least(out["x_long_words"], F.lit(30.0))
    return df.withColumns(out | {"x_size": F.log1p("n_words")})


def _odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-4)), F.lit(1 - 1e-4))
    return F.log(p / (1 - p))


def document_evidence(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``doc_id``, ``host``, ``path`` and ``p_doc`` of every row of ``docs`` (``doc_id``,
    ``text``, ``host``, ``path``)."""
    rows = checkpointed(
        _ratios(quality_rules.measured(boxed(docs))).select(
            "row.doc_id", "row.host", "row.path", *(f"x_{f}" for f in (*FEATURES, "size"))
        )
    )
    known = labels.select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("y")).where(
        "label_id is not null and y is not null"
    )
    n = known.count()
    draw = F.pmod(F.xxhash64("label_id", F.lit(2)), F.lit(1 << 30)) < (1 << 30) * min(1.0, max_labelled / max(n, 1))
    sample = checkpointed(
        rows.join(known.where(draw), F.col("doc_id") == F.col("label_id")).coalesce(8)
    )
    share = sample.agg(F.avg("y").alias("y"), F.count("*").alias("n")).first()
    vectors = VectorAssembler(inputCols=[f"x_{f}" for f in (*FEATURES, "size")], outputCol="features")
    if not share["n"] or share["y"] in (0.0, 1.0):
        p = F.lit(share["y"] if share["n"] else 0.5)
        return rows.select("doc_id", "host", "path", p.alias("p_doc"))
    model = LogisticRegression(featuresCol="features", labelCol="y", maxIter=60, regParam=1e-4).fit(
        vectors.transform(sample)
    )
    scored = model.transform(vectors.transform(rows))
    return scored.select(
        "doc_id", "host", "path", F.get(vector_to_array("probability"), 1).alias("p_doc")
    )


def prior_weight(sites: DataFrame, mean: Column) -> float:
    """Documents that the prior is worth, by the method of moments: the variance
    between the sites' means beyond what their sizes explain."""
    s = sites.agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * (F.col("good") / F.col("n") - mean) ** 2).alias("between"),
        F.sum(F.col("n") * mean * (1 - mean)).alias("spread"),
    ).first()
    if not s["k"] or s["k"] < 2 or not s["spread"]:
        return 10.0
    v = s["spread"] / s["n"]  # variance of one document under the prior mean
    effective = (s["n"] - s["nn"] / s["n"]) or 1.0
    between = (s["between"] - (s["k"] - 1) * v) / effective
    if between <= 0:
        return 1000.0
    return min(1000.0, max(1.0, v / between - 1))


def with_sites(scored: DataFrame) -> DataFrame:
    """``p_host``, ``p_path`` (posterior means given the site's other documents) and
    ``quality`` added to ``doc_id``, ``host``, ``path``, ``p_doc``."""
    paths = checkpointed(
        scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p_doc").alias("good"))
    )
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    whole = hosts.agg(F.sum("good").alias("g"), F.sum("n").alias("n")).first()
    corpus = whole["g"] / whole["n"] if whole["n"] else 0.5
    corpus = min(1 - 1e-4, max(1e-4, corpus))
    weight = prior_weight(hosts, F.lit(corpus))
    host_weight = prior_weight(hosts, F.lit(corpus))
    hosts = hosts.select(
        F.col("host").alias("of"), F.col("n").alias("host_n"), F.col("good").alias("host_good")
    )
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("of"))).drop("of")

    def shrunk(good, n, weight, toward):
        return (F.col(good) + weight * toward) / (F.col(n) + weight)

    of_host = shrunk("host_good", "host_n", host_weight, corpus)
    path_weight = prior_weight(paths.withColumn("p_host", of_host), F.col("p_host"))
    sites = paths.withColumnsRenamed({"host": "h", "path": "w", "n": "path_n", "good": "path_good"})
    joined = scored.join(
        sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("w"))
    )
    # the document's own probability is evidence once: its site is judged by the others
    for site in ("host", "path"):
        joined = joined.withColumns(
            {
                f"{site}_good": F.greatest(F.col(f"{site}_good") - F.col("p_doc"), F.lit(0.0)),
                f"{site}_n": F.col(f"{site}_n") - 1,
            }
        )
    joined = joined.withColumn("p_host", shrunk("host_good", "host_n", host_weight, corpus))
    joined = joined.withColumn("p_path", shrunk("path_good", "path_n", path_weight, F.col("p_host")))
    total = _odds(F.col("p_doc")) + _odds(F.col("p_path")) - math.log(corpus / (1 - corpus))
    joined = joined.drop("h", "w", "path_n", "path_good", "host_n", "host_good")
    return joined.withColumn("quality", 1 / (1 + F.exp(-total)))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.col("source").alias("host"), F.col("lang").alias("path")
    )
    scored = with_sites(document_evidence(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        *(F.round(c, 6).alias(c) for c in ("p_doc", "p_host", "p_path", "quality")),
        (F.col("quality") >= KEEP_AT).alias("kept"),
    )


QUERIES = {"op5_quality_classifier": op5}
