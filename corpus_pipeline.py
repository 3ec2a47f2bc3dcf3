"""The corpus pipeline: language ID, SimHash near-dedup, substring dedup, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a table; ``run`` writes it as
Parquet in the shared folder and rereads it as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm._common import table, tokenizer_path, written
from assay.llm.langid import UNDETERMINED, identify, labelled_sample
from assay.llm.linededup import deduplicate
from assay.llm.op4 import END_ID, LENGTH
from assay.llm.op10 import MAX_BITS, SHINGLE_WORDS
from assay.llm.packing import pack
from assay.llm.simhash import representatives


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts without a letter go."""
    told = identify(docs.withColumnRenamed("lang", "_lang"), labelled_sample(docs))
    return told.where(F.col("lang_pred") != UNDETERMINED).withColumnRenamed("_lang", "lang").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints, the one with the smallest id."""
    return representatives(docs, shingle=SHINGLE_WORDS, radius=MAX_BITS)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages an earlier one holds; one that consisted of such
    passages only goes."""
    clean = deduplicate(docs).where(F.trim("text") != "")
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences the documents are packed into."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"), END_ID, LENGTH).drop("ids")


STAGES = [("language ID", language), ("SimHash near-dedup", near_dedup), ("substring dedup", substring_dedup),
          ("packing", packing)]

#: Cross-parsing, XXH64 fingerprints and the tokenizer have no SQL form; tests/llm compares
#: run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
