"""From raw documents to token ids in five stages.

Every stage reads what its predecessor kept and returns a DataFrame, which is
written as Parquet in the shared folder and read again. All but the last
return the columns of documents.

Defined cases: a null or empty text has no language and goes in the first
stage; equal rows of one id are copies, one of which the third stage keeps;
rows of one id with different texts are different documents; other columns
stay as they are until the last stage; very long texts are handled whole; an
empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, language, line_dedup, minhash
from tidemark.llm.common import documents, shared_folder, stored
from tidemark.llm.queries import tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A document stays if its language has this probability.
LEAST_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or without a language of at least ``LEAST_SCORE``, go."""
    found = language.predict(docs, language.fit(docs))
    sure = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return found.where(sure).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of a line go, short lines too; a document that loses all its text goes."""
    cleaned = line_dedup.dedup(docs)
    kept = cleaned.where((F.col("n_removed") == 0) | F.col("text").rlike(r"\S"))
    # The length follows the text, where it was known.
    length = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.withColumn("n_chars", F.coalesce(length, "n_chars")).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id.

    Of several texts of that id in one group, one stays; of rows with equal id and text, one
    stays. Texts without a word are in no group.
    """
    kept = minhash.near_duplicates(docs, with_content=True).where("kept")
    alone = F.when(F.col("component").isNull(), F.col("content"))
    chosen = stored(
        kept.groupBy("doc_id", "component", "content").count()
        .groupBy("doc_id", "component", alone.alias("alone"))
        .agg(F.min(F.struct("content", "count")).alias("first"))
        .select(F.col("doc_id").alias("kept_id"), F.col("first.content").alias("kept_content"), F.col("first.count").alias("rows"))
    )

    def of(wanted: DataFrame) -> DataFrame:
        own = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
        same = F.col("row.doc_id").eqNullSafe(F.col("kept_id")) & (F.xxhash64("row.text") == F.col("kept_content"))
        return own.join(wanted, same, "left_semi")

    once = of(chosen.where("rows = 1")).select("row.*")
    repeated = chosen.where("rows > 1")
    if repeated.isEmpty():
        return once
    first = of(repeated).groupBy(F.col("row.doc_id"), F.xxhash64("row.text")).agg(F.first("row").alias("row"))
    return once.unionByName(first.select("row.*"))


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more stands in benchmark items go; the others lose the passages."""
    marked = decontaminate.mark(docs, documents(spark, sf_dir, "benchmark"))
    clean = decontaminate.judged(marked).where("NOT contaminated")
    length = F.length("text_left").cast(docs.schema["n_chars"].dataType)
    hit = F.col("n_hit") > 0
    own = {"text": F.when(hit, F.col("text_left")).otherwise(F.col("text")), "n_chars": F.when(hit, length).otherwise(F.col("n_chars"))}
    return clean.select(*(own[c].alias(c) if c in own else F.col(f"`{c}`") for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and hash of the token ids, and hash of what they decode to, for every document."""
    return bpe.digest(docs.select("doc_id", "text"), tokenizer_file())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("minhash_near_dedup", dedup_documents),
    ("decontamination", remove_contaminated),
    ("bpe_encoding", encode),
]

# SQL expresses neither the network of the first stage nor the tokenizer of the last.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written and read again."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
