"""From documents to token ids: the stages of the corpus pipeline, and a run of all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indipanel.llm import byte_bpe, mixing, secret_scan, simhash, toxicity
from indipanel.llm.common import documents, kept_table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by 3-word shingles and two bits at most."""
    return simhash.without_near_duplicates(docs, width=3, max_bits=2)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret replaced by a mark; no document goes."""
    return secret_scan.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents not drawn go, others may come several times."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, and the ids of each text with the bytes that they decode to."""
    coded = byte_bpe.encode(docs, ["doc_id", "lang", "source"])
    return coded.select("doc_id", "lang", "source", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", without_toxic),
    ("SimHash near-dedup", without_near_copies),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encoded),
]

# The draw of the mix and the learned scores are nothing that SQL can state.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
