"""Corpus cleaning pipeline over ``documents``.

Each stage gets what its predecessor kept, as rows written to the shared
folder and read again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import decontaminate, sentence_dedup, simhash, toxicity, trie_bpe
from marketlake.llm.common import table
from marketlake.llm.queries import tokenizer_path
from marketlake.session import scratch_path


def toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity model scores 0.5 or more."""
    labels = toxicity.training_labels(table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash (3-word shingles, at most 2 differing bits)."""
    return simhash.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the sentences of repeated spans; a text of which nothing is left goes."""
    n_sentences, n_removed, _ = sentence_dedup.result_names(docs, "cut_")
    found = sentence_dedup.dedup_sentences(docs, prefix="cut_")
    left = (found[n_removed] == 0) | (found[n_removed] < found[n_sentences])
    return found.where(left).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold ten consecutive words of a benchmark item (or a whole shorter one)."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and decoded text as digests, per document."""
    return trie_bpe.bpe(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxic_documents),
    ("simhash", near_duplicates),
    ("sentence_dedup", repeated_passages),
    ("decontamination", decontamination),
    ("bpe", encoded),
]

#: SQL cannot express the label model, the hash or the tokenizer: tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
