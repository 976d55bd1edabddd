"""Exact duplicates by skew-safe combining, in DataFrame operations only.

Texts are equal when they are identical after lower-casing A-Z. Three stages find
the row that stays of each group, and each groups by the whole text beside its
digest, so a collision of digests never merges different texts:

1. each task combines the equal texts that it reads (the partial aggregate);
2. the tasks' winners are merged by digest and salt. A digest with more than one in
   ``HOT_SHARE`` of all rows is hot and is dealt over ``SALTS`` salts; any other has
   one salt;
3. the winners of the salts are combined globally.

At most ``HOT_SHARE`` digests can be hot, so they may be broadcast however large the
table is. Whole texts are shuffled once, and a hot text once for each task and salt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.staging import stage
from .common import ascii_lower, text_of, without

HOT_SHARE = 1000
SALTS = 64


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def exact_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """``id_col``, ``digest``, ``keep_id``, ``group_size`` and ``kept`` of every row.

    Null text counts as empty. Of equal texts the row with the largest id stays; a
    null id is less than any other. Rows that agree in text and id are one document:
    they count each and share ``kept``. An empty table gives an empty result."""
    text = ascii_lower(text_of(docs, text_col))
    full = docs.select(docs[id_col].alias("id"), text.alias("text"), digest(text).alias("digest"))
    ids = stage(full.select("id", "digest"), "digests")
    hot = (
        ids.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") * HOT_SHARE > ids.count())
        .select("digest")
    )
    hot = F.broadcast(stage(hot, "hot-digests"))
    best = (F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    # Stages 1 and 2 of digests with one salt; the third has nothing left to combine.
    cold = full.join(hot, "digest", "left_anti").groupBy("digest", "text").agg(*best)
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS))
    salted = (
        full.join(hot, "digest", "left_semi")
        .withColumn("salt", salt)
        .groupBy("digest", "salt", "text")
        .agg(*best)
    )
    combined = salted.groupBy("digest", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("n")
    )
    groups = stage(cold.union(combined).select("digest", "keep_id", "n"), "text-groups")
    by_digest = groups.groupBy("digest").agg(
        F.count(F.lit(1)).alias("texts"),
        F.max("keep_id").alias("keep_id"),
        F.max("n").alias("group_size"),
    )
    # Written, so that the join below reads shuffles on both sides, and Spark can split
    # the rows of a hot digest.
    by_digest = stage(by_digest, "digest-groups")
    single = by_digest.where("texts = 1").drop("texts")
    found = ids.join(single, "digest")
    collided = stage(by_digest.where("texts > 1").select("digest"), "collided-digests")
    if not collided.isEmpty():
        # Different texts share a digest: their rows find their group by the text.
        rows = full.join(collided, "digest", "left_semi")
        own = rows.groupBy("digest", "text").agg(
            F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        found = found.unionByName(rows.join(own, ["digest", "text"]).drop("text"))
    return found.select(
        F.col("id").alias(id_col),
        "digest",
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
    )


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Of rows that agree in id and text, a null id included, one stays: the least as JSON of
    all columns. Null and empty texts are equal. An empty table stays empty."""
    found = stage(exact_groups(docs, id_col=id_col, text_col=text_col), "groups")
    found = found.select(F.col(id_col).alias("id"), "digest", "kept")
    dropped = stage(found.where("not kept").select("id", "digest"), "dropped-copies")
    again = found.where("kept").groupBy("id", "digest").count().where("count > 1")
    again = stage(again.select("id", "digest"), "repeated-rows")
    digest = sha256(ascii_lower(text_of(docs, text_col)))
    on = {"id": docs[id_col], "digest": digest}
    if again.isEmpty():
        return without(docs, dropped, on)
    row = F.struct(*[docs[c] for c in docs.columns])
    rows = docs.select(row.alias("row"), on["id"].alias("id"), digest.alias("digest"))
    same = rows["id"].eqNullSafe(again["id"]) & (rows["digest"] == again["digest"])
    rows = rows.join(again, same, "left_semi").groupBy("id", "digest")
    one = rows.agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
    return without(docs, dropped.union(again), on).union(one)
