"""A training corpus from `documents`: five stages, each a Parquet table that the next one reads.

Every stage works on all rows that the one before kept. All but the last return the columns of `documents`; the last
returns the packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopstrata.llm import decontaminate, minhash, packing, quality, secrets
from shopstrata.llm.shared import numbered, table

VOCABULARY, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"
END_ID, CAPACITY = 2, 1024

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _beside_text(docs: DataFrame) -> DataFrame:
    """The rows as one column and their text, so that no new column meets one of theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled rows that aren't held out, doesn't reject."""
    weights = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(_beside_text(docs), weights, keep=["row"]).where("predicted = 1").select("row.*")


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are 0.8 alike: the one with the smallest id.

    Rows of one id with different texts are documents of their own, in the order of their texts' digests; of rows alike in id
    and text the smallest by all columns stays. Rows without an id or without words all stay.
    """
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("number"), "text")
    named, nameless = whole.where("number is not null"), whole.where("number is null").select("row")
    repeated = not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    if repeated:
        digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest")
        named = named.select("row", F.col("number").alias("id"), "text", digest)
        numbers = numbered(named.select("id", "digest").distinct(), F.col("id"), F.col("digest"))
        named = table(named.join(numbers, ["id", "digest"]).drop("id", "digest"), "numbered")
    found = minhash.near_duplicates(named, minhash.Likeness(size=5, above=4, below=5), id_column="number")
    kept = found.where("kept").select(F.col("doc_id").alias("number")).distinct()
    rows = named.select("row", "number").join(kept, "number", "left_semi")
    once = rows.groupBy("number").agg(F.min("row").alias("row")) if repeated else rows
    return once.select("row").unionByName(nameless).select("row.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.marked(_beside_text(docs), benchmark, keep=["row"]).where("not contaminated").select("row.*")


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by [SECRET]; n_chars follows."""
    words = secrets.ranked_words(public_tokenizers.path(WORDS))
    found = secrets.redact(_beside_text(docs), words=words).withColumn("text", F.when(F.col("n_secrets") > 0, F.col("redacted")).otherwise(F.col("row.text")))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_secrets") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {"text": F.col("text")}
    return found.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in pieces, packed into sequences."""
    return packing.packed(docs, public_tokenizers.path(VOCABULARY), end_id=END_ID, capacity=CAPACITY)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: A trained classifier and a tokenizer are beyond SQL; tests hold every stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
