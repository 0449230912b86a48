"""Pipeline over `documents`: quality, near duplicates, benchmark passages, personal data, mixture.

Each stage works on what its predecessor kept, written and read again, and calls one operator:

* quality: documents that the classifier rejects (score below 0.7) go;
* near_duplicates: of documents linked by five-word shingles at a Jaccard similarity of 0.8, those
  with a smaller doc_id in their group go;
* decontamination: documents that hold a window of 10 benchmark words go;
* personal_data: entities become surrogates (n_chars follows where a text changed);
* mixture: documents are drawn by calibrated probabilities; adds their chance.

All columns of documents pass through. Rows without a doc_id count as different documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from llm.common import saved, table
from llm.op3_pii import replace_entities
from llm.op4_decontamination import contamination
from llm.op5_mixing import mix
from llm.op6_quality import accepted, learn
from llm.op7_ngram_join import keep_one

#: No SQL: the classifier, the entity patterns and the sets' components have none that is practical.
ORACLE_SQL: str | None = None
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # learned from the labelled rows of the table, not from what is left of it
    weights = learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return accepted(docs, weights)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "doc_id", "text")
    found = contamination(rows, table(spark, sf_dir, "benchmark"))
    return found.where("not contaminated").select("__row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "text")
    done = replace_entities(rows)
    out = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out["n_chars"] = F.when(F.col("n_entities") > 0, F.length("text").cast(kind)).otherwise(F.col("__row.n_chars"))
    return done.select(*[out.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    drawn = mix(docs).where("__kept")
    return drawn.select(*[F.col(f"`{c}`") for c in docs.columns if c != "chance"], F.col("__chance").alias("chance"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [("quality", quality), ("near_duplicates", near_duplicates),
                                   ("decontamination", decontamination), ("personal_data", personal_data),
                                   ("mixture", mixture)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage of STAGES in order, from documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
