"""A training corpus from raw documents: five stages, each written as Parquet and read again by the next.

1. language_id: documents that get no language (``und``) go: those without a letter, and all if none was learned. There is
   no least score, as a short text is near no language for its length alone.
2. near_duplicates: of documents linked by shingle similarity the one with the smallest id stays.
3. decontamination: documents of which benchmark passages cover a twentieth or more go.
4. pii: personal data is replaced by its kind in square brackets; n_chars of a changed text is its new length.
5. packing: the rest is packed into token sequences.

Stages 1 to 4 return the columns of documents. Null texts have no letter and go in stage 1. Empty tables pass through
all stages. Of repeated rows one stays. Extra columns pass stages 1 to 4 as they are, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetloom.llm import fm_decontam, hd_language, pii_crf, prefix_join, vector_packing
from packetloom.llm.common import remainder, store, table, without


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prototypes = hd_language.learn(docs.where(remainder("doc_id", 4) != 2))
    return hd_language.keep_known(docs, prototypes)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n"))
    if ids.where("n > 1 OR doc_id IS NULL").isEmpty():
        linked = prefix_join.jaccard_join(docs)
        return without(docs, linked.where("doc_id <> component_id").select("doc_id"), "doc_id")
    # a row number tells repeated rows apart; it needs a copy of the table
    numbered = store(docs.select(F.monotonically_increasing_id().alias("n"), F.struct("*").alias("row")), "numbered")
    named = numbered.select(F.struct(F.col("row.doc_id").alias("d"), "n").alias("id"), F.col("row.text").alias("text"))
    linked = prefix_join.jaccard_join(named, id_col="id")
    gone = linked.where(F.col("id") != F.col("component_id")).select(F.col("id.n").alias("n"))
    return without(numbered, gone, "n").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fm_decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    field = pii_crf.learn(docs)
    rows = docs.select(F.struct("*").alias("row"), pii_crf.redacted(field, F.col("text")).alias("new"))
    before, after = F.length("row.text"), F.length("new")
    n_chars = F.when(after != before, after).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    changed = {"text": F.col("new"), "n_chars": n_chars}
    return rows.select([changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return vector_packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

ORACLE_SQL = None  # language prototypes, the field and the tokenizer are beyond SQL; tests compare with plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
