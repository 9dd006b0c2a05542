"""Exact duplicates: grouped by a 128-bit content hash, bytes compared inside groups.

The grouping key is the hash followed by the text itself, so the comparison of
bytes happens inside the hash aggregate, with copies merged on the map side.
Only texts that differ leave a task, and a text that a third of all rows carry
leaves each task once. What is joined back to the rows is 16-byte digests.

Null text is the empty text. A row without an id loses against any row with one;
a group of only such rows keeps all of them, as nothing tells them apart. Rows
that repeat an id and its text are counted and stay or go together. An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedsieve.llm.common import stored, whole_text


def md5_digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def normalised(text_col: str) -> Column:
    """Runs of ASCII white space as one space."""
    return F.regexp_replace(whole_text(text_col), r"[\x20\x09-\x0D]+", " ")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = md5_digest,
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    texts = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("body")).select(
        "id", digest(F.col("body")).alias("h"), "body"
    )
    same_bytes = texts.groupBy("h", "body").agg(
        F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    # One row per digest that several rows share; ``variants`` tells a collision.
    shared = stored(
        same_bytes.groupBy("h")
        .agg(
            F.count(F.lit(1)).alias("variants"),
            F.min("keep_id").alias("keep_id"),
            F.sum("group_size").alias("group_size"),
        )
        .where("group_size > 1"),
        "digests",
    )
    rows = texts.select("id", "h", F.unhex(F.sha2("body", 256)).alias("sha"))
    alike = shared.where("variants = 1").drop("variants")
    colliding = shared.where("variants > 1").select("h")
    if colliding.isEmpty():
        found = rows.join(alike, "h", "left")
    else:
        apart = texts.join(colliding, "h", "left_semi")
        variants = same_bytes.join(colliding, "h", "left_semi")
        found = rows.join(colliding, "h", "left_anti").join(alike, "h", "left").unionByName(
            apart.join(variants, ["h", "body"]).select(
                "h", "id", F.unhex(F.sha2("body", 256)).alias("sha"), "keep_id", "group_size"
            )
        )
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows are told by id and text together, as ids may be missing or repeat.
    """
    gone = exact_groups(docs, id_col, text_col).where("not kept").select(
        F.col(id_col).alias("__gone_id"), F.unhex("text_sha256").alias("__gone_sha")
    )
    sha = F.unhex(F.sha2(normalised(text_col), 256))
    same = F.col(id_col).eqNullSafe(F.col("__gone_id")) & (sha == F.col("__gone_sha"))
    return docs.join(gone.distinct(), same, "left_anti")
