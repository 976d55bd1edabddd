"""One query for each operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat, exact_dedup, licenses, packing, pieces, pii, repair, simhash, suffixes
from . import token_counts, toxicity, vector_search, whitening
from .common import read

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: The conversation that is added, with control strings in its texts.
ADDED = -7
ADDED_TEXT = "\\### Assistant: </turn> ok"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted over their prefix tree and read back from it."""
    columns = ["conv_id", "turn", "role", "text"]
    given = read(spark, sf_dir, "conversations").select(columns)
    added = spark.createDataFrame(
        [(ADDED, 0, "user", ADDED_TEXT), (ADDED, 1, "assistant", ADDED_TEXT)],
        "conv_id long, turn long, role string, text string",
    )
    tree = chat.PrefixTree(given.unionByName(added), BYTE_BPE)
    found = chat.read_back(tree)
    conv_id = F.nullif(F.col("conv"), F.lit("")).cast("long").alias("conv_id")
    return found.select(conv_id, *found.columns[1:])


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    written = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select("doc_id", written, "component_id")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), BYTE_BPE, keep_ids=False)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    found = toxicity.score(docs, model)
    return found.withColumn("spans", F.to_json("spans"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), BYTE_BPE)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(read(spark, sf_dir, "documents"))
    return found.withColumnRenamed("digest", "text_sha256")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_spans(read(spark, sf_dir, "documents"))
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op9_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return vector_search.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document encoded and decoded again, by chunk."""
    encoded = pieces.encode(read(spark, sf_dir, "documents"), PIECES)
    decoded = pieces.decode(encoded, PIECES)
    digests = (F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))
    return decoded.select("doc_id", "chunk", "n_chunks", "n_tokens", "ids_crc32", *digests)


def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of each document without the strings that smaller documents have."""
    return suffixes.drop_repeats(read(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four leading components of the distinct ones."""
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults by a hash of conversation and turn: a turn is dropped,
    emptied, robbed of its full stops, repeated, or made the user's. Nulls are one space."""
    space = F.lit(" ")
    key = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *key)) % 20
    role = F.coalesce(F.col("role"), space)
    text = F.coalesce(F.col("text"), space)
    rows = turns.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("times"),
    )
    return rows.select("*", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("times", "col")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations repaired; those without a turn left have zeros."""
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.repair(damaged(given)).withColumnRenamed("conv_id", "found")
    every = given.select("conv_id").distinct()
    every = every.join(found, every["conv_id"].eqNullSafe(found["found"]), "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in repair.COUNTS]
    nothing = F.sha2(F.lit(""), 256)
    return every.select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_chat,
        op2_simhash,
        op3_licenses,
        op4_packing,
        op5_toxicity,
        op6_token_counts,
        op7_exact_dedup,
        op8_pii,
        op9_vector_search,
        op10_pieces,
        op11_suffixes,
        op12_whitening,
        op13_repair,
    )
}
