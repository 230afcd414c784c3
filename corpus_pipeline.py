"""A corpus pipeline: each stage reads what the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns documents with the columns it was
given; the last adds the places of the mix.  Ids may be null or repeat and other columns
may have any name: no stage joins rows by id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphtide.llm import toxicity as tox
from graphtide.llm.common import fold, named, stored, table
from graphtide.llm.decontaminate import find_contamination
from graphtide.llm.mixing import mix_sources
from graphtide.llm.near_dup import find_near_duplicates
from graphtide.llm.pii import mask_pii

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _renamed(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """Documents whose columns of these names are set aside, so that results cannot replace them."""
    taken = {n.lower() for n in names}
    aside = [f"␟own-{c}" if c.lower() in taken else c for c in docs.columns]
    return docs.toDF(*aside), docs.columns


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic by the labels of two thirds of the ids."""
    model = tox.train(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 3) != 1)
    aside, columns = _renamed(docs, "score")
    scored = tox.score_toxicity(aside, model)
    return scored.where(F.col("score") < tox.THRESHOLD).drop("score").select(*[named(c) for c in aside.columns]).toDF(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    aside, columns = _renamed(docs, "class_id", "kept")
    return find_near_duplicates(aside).where("kept").select(*[named(c) for c in aside.columns]).toDF(*columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    aside, columns = _renamed(docs, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_words", "hit_items")
    found = find_contamination(aside, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(*[named(c) for c in aside.columns]).toDF(*columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, identifiers replaced by their kind; ``n_chars`` follows a changed text."""
    source = docs.withColumn("␟before", F.col("text"))
    masked = mask_pii(source)
    if "n_chars" in docs.columns:
        changed = ~F.col("text").eqNullSafe(F.col("␟before"))
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        masked = masked.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return masked.select(*[named(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their slots in a mix of the sources."""
    return mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
    ("personal_data", personal_data), ("mixing", mixing),
]

# The stages learn from data and search for near copies, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
