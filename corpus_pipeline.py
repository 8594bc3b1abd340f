"""A corpus pipeline out of five operators: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and gives the next one's docs, which are written as Parquet in the shared folder and read again, so a lost executor costs
the running stage at most. All but the last return the columns of documents. Null texts pass all stages (as empty texts from the
suffix-array stage on); repeated rows are copies, and of ties one stays; long texts go through whole; further columns pass all stages but the last, whatever their
names; an empty table gives no sequences."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorwise.llm import common, exact_dedup, minhash, packing, suffix_dedup, toxicity

#: Bytes of a repeated string. Rare passages of just over 50 short words are below it and stay: of sf0.1's 3,528,163 windows of 51 words 31 (28 texts, 3 of them in two
#: documents each; 230 bytes and more) among those with 30 distinct words or more.
REPEATED_BYTES = 240
#: Least similarity of near copies, in hundredths. The 85 of op5's query holds for that query alone.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns the lexicon from the labelled rows of this input and drops documents that score 0.7 or more."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, common.read(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (but for the case of A-Z) the row with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the row with the smallest doc_id stays."""
    return minhash.drop_near_copies(docs, percent=NEAR_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts strings out of texts that begin at another place too."""
    return suffix_dedup.without_repeats(docs, length=REPEATED_BYTES)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs documents into token sequences; a row for each piece."""
    import public_tokenizers

    out = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_group")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("minhash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = common.read(spark, sf_dir, "documents"), f"{common.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:  # nothing reads what this stage has read any more
            common.delete(spark, f"{folder}/{k - 1}")
    return docs
