"""A training corpus from raw documents: filter, deduplicate, decontaminate, tokenise.

Every stage takes the documents that the one before kept, and is written as Parquet before the next one reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plantmetrics.llm.byte_bpe import encode_documents
from plantmetrics.llm.decontamination import drop_leaks
from plantmetrics.llm.jaccard_join import JoinSettings, jaccard_components
from plantmetrics.llm.names import unused
from plantmetrics.llm.sentence_spans import remove_repeated_spans
from plantmetrics.llm.toxicity import fit_toxicity, score_toxicity
from plantmetrics.sources import scratch_path, scratch_scope, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below their language's threshold. Empty texts are scored like others."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score, toxic = unused(docs, "_score", "_toxic")
    scored = score_toxicity(docs, fit_toxicity(docs, labels), (score, toxic))
    return scored.where(~F.col(toxic)).select(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of every group that links by five-word shingles (similarity 0.8).

    Rows that share a doc_id are one document, and one of them stays. Rows without an id can't be told apart
    by it and stay. Documents without words stay.
    """
    least, rank = unused(docs, "_least", "_rank")
    path = scratch_path(spark, "kept")
    with scratch_scope(spark):  # the tables of the join go as soon as the ids that stay are written
        found = jaccard_components(docs, JoinSettings(words=5, percent=80))
        ids = found.where("doc_id = component_id").select(F.col("doc_id").alias(least)).distinct()
        ids.write.parquet(path)
    kept = spark.read.schema(ids.schema).parquet(path)
    # of rows that share an id always the same one, also if a task is run again
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), *docs.columns)
    one = docs.join(kept, F.col("doc_id") == F.col(least)).withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    return one.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; none is dropped."""
    (count,) = unused(docs, "_n_removed")
    return remove_repeated_spans(docs, n_removed=count).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of the ids and of the bytes they decode to."""
    return encode_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", keep_one_of_near_copies),
    ("repeated_spans", cut_repeated_spans),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenise),
]

#: Trained weights and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
