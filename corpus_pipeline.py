"""A corpus made ready for training: toxic texts out, copies out, secrets masked, the rest packed.

Each stage takes the documents its predecessor kept and returns documents with the same columns; the last
returns the packed pieces. Stages are written to the shared folder between them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowtide.llm import exact_dedup, near_dedup, packing, secret_scan, toxicity
from rowtide.llm.common import stored, table
from rowtide.llm.queries import VOCABULARY
from rowtide.session import configure

# Pieces a worker remembers while it learns and scores and while it packs: after the other stages the JVM keeps its heap,
# so less than these alone. What it holds of scoring also stays while the stages of the JVM run.
TOXICITY_REMEMBERS = 80_000
PACKING_REMEMBERS = 170_000


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the score, learned from the labelled rows, predicts as toxic."""
    evidence = toxicity.learn(docs, table(spark, sf_dir, "labels"), remembered=TOXICITY_REMEMBERS)
    return toxicity.drop_toxic(docs, evidence, remembered=TOXICITY_REMEMBERS)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row of the largest id of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each component of near-duplicates."""
    return near_dedup.drop_near_copies(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask the secrets inside the texts; every document stays."""
    return secret_scan.mask_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the texts' tokens into as few sequences as best-fit decreasing needs."""
    return packing.pack(docs, VOCABULARY, remembered=PACKING_REMEMBERS)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

ORACLE_SQL = None  # toxicity and packing are not SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, from ``documents`` to packed pieces."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
