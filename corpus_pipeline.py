"""Corpus pipeline: toxicity, near duplicates, repeated passages, mixing, packing.

Each stage takes all documents that the one before it kept, applies one
operator of ``emporium.llm`` to them, and returns what it keeps with the
columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.llm import common as C
from emporium.llm.best_fit_packing import packed_documents
from emporium.llm.near_dedup import near_duplicates
from emporium.llm.source_mixing import mixed_documents
from emporium.llm.substring_dedup import remove_repeated
from emporium.llm.toxicity import score_toxicity

#: Least similarity in percent of near duplicates that lose all but one.
NEAR_PERCENT = 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models do not hold for toxic."""
    scored = score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=docs.columns)
    return scored.where("score < 0.5").select("carried.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; rows without an id all stay.

    Documents are linked where their sets of five-word shingles have a similarity of 0.8 or more. Of rows that share an id, one stays: of those that ``near_duplicates``
    keeps, the one with the least row hash. An exact copy of a smaller id
    goes by itself; rows of one id are one document where it has near copies.
    """
    hashed = docs.withColumn("row_hash", F.xxhash64(*docs.columns, *[F.col(c).isNull() for c in docs.columns]))
    rows = near_duplicates(hashed, percent=NEAR_PERCENT, carry=["row_hash"]).where("kept and id is not null")
    kept = rows.groupBy(F.col("id").alias("doc_id")).agg(F.min("carried.row_hash").alias("least"))
    one = hashed.join(kept, "doc_id").where("row_hash = least").dropDuplicates(["doc_id"])
    return one.select(docs.columns).unionByName(docs.where("doc_id is null"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has; texts that lose all their words go."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = remove_repeated(docs, carry=others, as_is=True).where("n_removed = 0 or n_removed < n_words")
    size = F.when(F.col("n_removed") > 0, F.char_length("kept_text"))
    columns = {c: F.col("carried")[c] for c in others} | {"doc_id": F.col("id"), "text": F.col("kept_text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.coalesce(size.cast(docs.schema["n_chars"].dataType), columns["n_chars"])
    return out.select(*[columns[c].alias(c) for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix takes them, in order of virtual finish time."""
    return mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their place in sequences of 2048."""
    return packed_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Trained scores, tokenizer ids and best-fit packing have no SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    Once a stage is written, what it read and wrote on its way is deleted.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), C.folders()
    for name, stage in STAGES:
        docs = C.written(stage(spark, docs, sf_dir), f"stage-{name}")
        *done, _ = [f for f in C.folders() if f not in before]
        C.drop_folders(spark, done)
    return docs
