"""The corpus pipeline: quality classifier, near-duplicates, benchmark decontamination, mixing, token output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each one as Parquet to the shared
folder and reads it again as the next one's docs. All but the last return the columns of documents. Decisions go by
id and text, so rows that share an id only, or have none, are told apart; a document that is mixed in twice is two
rows from there on. The last stage leaves the corpus's token blocks in `token_folder` and returns what it reads back
from them: doc_id, start, n_tokens, ids_crc32. Once a stage is written its predecessor's rows are deleted; token blocks
and the last table stay.
"""

from __future__ import annotations

import uuid
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession

from roadmill.llm import circulant, containment, mixture, token_blocks, weak_quality
from roadmill.llm.common import remove, shared_dir, small_batches, sweep, table
from roadmill.llm.queries import END_ID, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    sweep(spark)
    return weak_quality.keep_good(docs, weak_quality.fit(docs.select("doc_id", "text")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, over word 5-shingles."""
    sweep(spark)
    return circulant.keep_one(docs, shingle=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    sweep(spark)
    return containment.clean(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    sweep(spark)
    return mixture.take(docs)


def token_folder(spark: SparkSession, sf_dir: str) -> str:
    """Where this application keeps the token blocks of the corpus made from sf_dir; `token_blocks.read_blocks` opens it.
    A later run over the same input replaces them."""
    return f"{shared_dir(spark)}/corpus-tokens/{spark.sparkContext.applicationId}-{md5(sf_dir.encode()).hexdigest()[:12]}"


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token blocks, kept in `token_folder` and read back: doc_id, start, n_tokens, ids_crc32."""
    sweep(spark)
    path = token_folder(spark, sf_dir)
    remove(spark, path)
    return token_blocks.read_documents(token_blocks.write_blocks(docs.select("doc_id", "text"), tokenizer_path(), END_ID, path=path))


STAGES = [("quality classifier", quality), ("MinHash near-dedup", near_duplicates), ("benchmark decontamination", decontaminate), ("mixing sources", mix), ("token output", tokens)]

#: Trained scores and hashed choices are not for SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, top = table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        with small_batches(spark):
            made.write.parquet(f"{top}/{k}")
        docs = spark.read.parquet(f"{top}/{k}")
        if k:
            remove(spark, f"{top}/{k - 1}")
    sweep(spark)
    return docs
