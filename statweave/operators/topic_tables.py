"""A topic model over tables: expectation maximisation with the vocabulary as rows.

Term counts are one row per document and term. A step joins them with the topic counts of
their document and of their term, gives each row its shares of the topics in proportion to
(doc + α − 1)·(term + η − 1) / (topic + V·(η − 1)), and sums count times share per document
and per term, combined before each shuffle. Documents, terms and topics are tables; the
driver holds one number per topic and the size of the vocabulary. A term in more than ``SPLIT``
documents is dealt over salts and its counts are repeated for each, so no task holds all its rows.

The start is deterministic: a row's shares favour the topic (length of the term + crc32 of the
document's key) mod k. Null keys, terms and counts of 0 or less are left out; equal (document, term) rows add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statweave.plans.staging import stage_table

SPLIT = 100_000


def prepared(counts: DataFrame, doc: str = "doc", term: str = "term", n: str = "n", split: int = SPLIT) -> DataFrame:
    """Staged ``doc, term, n, salt``."""
    rows = counts.select(F.col(doc).alias("doc"), F.col(term).alias("term"), F.col(n).cast("double").alias("n"))
    summed = stage_table(rows.where("doc IS NOT NULL AND term IS NOT NULL AND n > 0").groupBy("doc", "term").agg(F.sum("n").alias("n")))
    salts = summed.groupBy("term").agg(F.ceil(F.count("*") / split).cast("int").alias("salts"))
    return stage_table(summed.join(salts, "term").withColumn("salt", F.pmod(F.xxhash64("doc"), F.col("salts")).cast("int")))


def _summed(shares: DataFrame, keys: list[str], k: int) -> DataFrame:
    return shares.groupBy(*keys).agg(F.array(*[F.sum(F.get("x", F.lit(t))) for t in range(k)]).alias("topics"))


def _state(shares: DataFrame, k: int) -> tuple[DataFrame, DataFrame, list[float]]:
    """(documents, terms with their salts, topic totals) of rows ``doc, term, salts, x``."""
    docs = stage_table(_summed(shares, ["doc"], k))
    terms = stage_table(_summed(shares, ["term", "salts"], k))
    totals = terms.agg(*[F.sum(F.get("topics", F.lit(t))).alias(str(t)) for t in range(k)]).first()
    return docs, terms, [float(v or 0.0) for v in totals]


def _normalised(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(values, lambda x: x / total)


def start(rows: DataFrame, k: int) -> tuple[DataFrame, DataFrame, list[float]]:
    favoured = F.pmod(F.length(F.col("term").cast("string")) + F.crc32(F.col("doc").cast("string")), F.lit(k))
    share = F.array(*[F.when(favoured == t, 2.0).otherwise(1.0) * F.col("n") / (k + 1) for t in range(k)])
    return _state(stage_table(rows.select("doc", "term", "salts", share.alias("x"))), k)


def step(rows: DataFrame, state: tuple[DataFrame, DataFrame, list[float]], alpha: float, eta: float, vocabulary: int) -> tuple:
    """One round of expectation and maximisation."""
    docs, terms, totals = state
    repeated = terms.select("term", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("topics").alias("_w"))
    met = rows.join(docs.select("doc", F.col("topics").alias("_d")), "doc").join(repeated, ["term", "salt"])
    weights = F.array(
        *[
            (F.get("_d", F.lit(t)) + (alpha - 1)) * (F.get("_w", F.lit(t)) + (eta - 1)) / (total + vocabulary * (eta - 1))
            for t, total in enumerate(totals)
        ]
    )
    shares = met.withColumn("_p", weights).select("doc", "term", "salts", F.transform(_normalised(F.col("_p")), lambda p: p * F.col("n")).alias("x"))
    return _state(stage_table(shares), len(totals))


def fit_topic_tables(
    counts: DataFrame, k: int = 3, iterations: int = 20, alpha: float | None = None, eta: float = 1.1,
    doc: str = "doc", term: str = "term", n: str = "n", split: int = SPLIT,
) -> tuple[DataFrame, DataFrame]:
    """(``topic, term, weight`` with weights of a topic adding up to 1, ``doc, topics ARRAY`` with shares adding up to 1).

    ``alpha`` is the concentration of a document's topics (50 / k + 1 unless given), ``eta`` that of a
    topic's terms; both above 1.
    """
    rows = prepared(counts, doc, term, n, split)
    vocabulary = rows.select("term").distinct().count()
    alpha = 50.0 / k + 1 if alpha is None else alpha
    state = start(rows, k)
    for _ in range(iterations):
        state = step(rows, state, alpha, eta, vocabulary)
    docs, terms, totals = state
    long = terms.select("term", F.posexplode("topics").alias("topic", "_n"))
    size = F.element_at(F.array(*[F.lit(t + vocabulary * (eta - 1)) for t in totals]), F.col("topic") + 1)
    topics = long.select("topic", "term", ((F.col("_n") + (eta - 1)) / size).alias("weight"))
    return topics, docs.select("doc", _normalised(F.transform("topics", lambda x: x + (alpha - 1))).alias("topics"))
