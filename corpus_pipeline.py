"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, tokens.

``STAGES`` lists (name, function).  A function takes (spark, docs, sf_dir), works on all rows
of ``docs`` and returns a DataFrame, which is written and read again as the next one's
``docs``; all but the last return the columns that they got.

Extra columns go through all stages but the last, whatever their names.  What the stages decide:

- quality: documents that the classifier rejects (score of label 1 below 0.3) go;
- near_duplicates: of every group of documents linked by 5-word shingles with a Jaccard
  similarity of 0.8 or more the smallest id stays; texts without words link with nothing,
  rows without an id are not compared and stay, rows that repeat an id stay or go together;
- substrings: words covered by a run of 20 words that occurs earlier are cut out; a document
  that loses nothing keeps its text as it is, one that loses everything stays with an empty text;
- decontaminate: documents that hold a 10-word window of the benchmark go;
- tokens: ids of every whole text, and the digests of ids and decoded text.

SQL cannot express a learned classifier, so there is no ORACLE_SQL; the stages are tested
against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.llm import quality as quality_classifier
from vantage.llm.bpe import bpe
from vantage.llm.common import materialize
from vantage.llm.decontaminate import decontaminate as find_leaks
from vantage.llm.jaccard import jaccard_components
from vantage.llm.queries import TOKENIZER
from vantage.llm.substring import substring_dedup

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]  # apart: their names may be any
    packed = docs.select("doc_id", "text", F.struct(F.lit(1).alias("#"), *rest).alias("row"))
    scored = quality_classifier.score(packed, quality_classifier.fit(docs, labels), keep=0.3, carry=("text", "row"))
    return scored.where("predicted = 1").select(*(F.col("row")[c].alias(c) if c in rest else c for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = jaccard_components(docs, k=5, num=80, den=100)
    copies = materialize(groups.where("doc_id != component_id").select("doc_id").distinct(), "copies")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring_dedup(docs, k=20, carry=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    size = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("row.n_chars"))
    new = {"text": text, "n_chars": size}
    return cut.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)
    # a struct tells rows without an id apart
    leaks = materialize(found.where("contaminated").select(F.struct("doc_id", "text_hash").alias("leak")).distinct(), "leaks")
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("leak"))
    return packed.join(leaks, "leak", "left_anti").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    encoded = bpe(docs, public_tokenizers.path(TOKENIZER))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                          F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("substrings", substrings),
          ("decontaminate", decontaminate), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
