"""The corpus pipeline: from raw documents to packed token sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and reread as the next stage's ``docs``.  All but the last
return the columns of ``documents``.

Defined results: null and empty texts are never toxic nor contaminated and keep
their (empty) line; of all documents that are empty at the near-copy stage, and
so equal, the one with the smallest id stays; documents with a null id pass all
stages; rows that repeat an id are judged alike and all stay or all go, but for
near copies, where an id is kept or dropped as a whole; an empty table stays
empty; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionweave.llm import decontaminate, line_dedup, packing, queries, simhash, toxicity
from sessionweave.llm.scratch import Scratch


#: A column of no document.
TOXICITY = "__toxicity of this stage"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, does not reject."""
    machine = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, machine, to=TOXICITY).filter(F.col(TOXICITY) < 0.5).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier document holds; ``n_chars`` follows the text."""
    held = docs.select("doc_id", "text", F.struct(*docs.columns).alias("own"))
    done = line_dedup.dedup_lines(held)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return done.select(*(new.get(c, F.col(f"own.`{c}`")).alias(c) for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, found by their SimHashes: that with the smallest id.  Rows without an id stay."""
    groups = simhash.near_duplicates(docs).filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    gone = Scratch(spark, "copies").save(groups, "gone")
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage near a benchmark item."""
    return decontaminate.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of 1,024 tokens."""
    return packing.pack_documents(docs, queries.tokenizer_file())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Trained scores, fingerprints and subword ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{k}-{name}")
    return docs
