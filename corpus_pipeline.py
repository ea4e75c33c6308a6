"""The corpus pipeline: toxicity, near duplicates, repeated passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of documents: doc_id, text, lang, source, n_chars; further columns
of ``docs`` are left out. Null texts pass all stages as they are (the last
counts them as empty); empty tables give empty tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm import packing, secrets, simhash, suffix_dedup, toxicity
from siftwell.llm.common import cut, prepare, read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic; it learns from the labels of folds 1 to 4 of 5."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    docs = docs.select(*COLUMNS)
    model = toxicity.fit(docs.where(toxicity.learnable()), labels.where(toxicity.learnable()), "doc_id", "text", "toxic")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    # The text goes twice to the scorer: as what is scored and as what is kept.
    scored = toxicity.score_all(docs.withColumn("__scored", F.col("text")), model, "__scored", COLUMNS, ddl)
    return scored.where("score < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose five-word shingles are 0.8 similar or more: the one with the smallest doc_id (null ids all stay)."""
    found = simhash.similar_documents(docs.select("doc_id", "text"))
    keep = found.where("component_id = doc_id").select("doc_id").distinct()
    docs = docs.select(*COLUMNS)
    one = docs.join(keep, "doc_id", "left_semi")
    return one.unionByName(docs.where("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of strings that start earlier; a character that a cut would split stays."""
    docs = docs.select(*COLUMNS)
    keep = ["doc_id", "lang", "source", "__none"]
    left = suffix_dedup.remove_repeats(docs.withColumn("__none", F.col("text").isNull()), "doc_id", "text", keep, lambda t, a, z: (suffix_dedup.kept_text(t, a, z),), "text string")
    return left.withColumn("text", F.when(~F.col("__none"), F.col("text"))).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every secret replaced by a mark."""
    docs = docs.select(*COLUMNS)
    table = secrets.train(secrets.labelled_samples(spark, docs, "doc_id", "text"))
    found = secrets.scan(docs, "text", table)
    return found.withColumn("text", secrets.redact(F.col("text"), F.col("spans"))).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: No SQL expresses the stages; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again in the checkpoint folder."""
    docs = read_table(prepare(spark), sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder, and read again."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        cut(spark.range(0))  # sets the folder
    path = f"{sc._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)
