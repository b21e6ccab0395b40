"""Exact deduplication by content hash, with the bytes compared.

Texts are equal when they are identical after every run of white space has
become one blank.  Rows are grouped by the 128-bit hash of that text and by the
text itself: the grouping compares the bytes of texts with one hash, and its
partial aggregate leaves one row per distinct text and task, so a text that a
third of all rows carry is not gathered anywhere.  After that only hashes and
ids move.  Hashes with several texts (collisions) are told apart by the text.

Defined results: NULL text counts as empty (and equals it); NULL ids sort after
all others, so such a row stays only if no equal text has an id; rows that
repeat both id and text are one document written several times, of which one
stays; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cumulus.llm.common import LONG_MAX, cut, fresh, squeeze

#: Rows that one step of the repeat expansion emits at a time.
STEP = 65536


def hash128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _hashed(docs: DataFrame, id_col: str, text_col: str,
            hash_fn: Callable[[Column], Column]) -> DataFrame:
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        squeeze(F.col(text_col)).alias("body"))
            .withColumn("h", hash_fn(F.col("body"))))


def _classes(hashed: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Classes of equal texts: (one row per hash with one text; for hashes with
    several texts one row per text, or None if there are none)."""
    order = F.coalesce("doc_id", F.lit(LONG_MAX))
    bodies = hashed.groupBy("h", "body").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    hashes = cut(bodies.groupBy("h").agg(F.count("*").alias("n_bodies"),
                                         F.min("first").alias("first"), F.sum("n").alias("n")))
    single = hashes.where("n_bodies = 1").drop("n_bodies")
    clash = hashes.where("n_bodies > 1").select("h")
    if clash.isEmpty():
        return single, None
    return single, bodies.join(clash, "h", "left_semi")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     hash_fn: Callable[[Column], Column] = hash128) -> DataFrame:
    """One row per input row: doc_id, keep_id (the id that stays), group_size,
    kept, text_sha256 of the squeezed text.  hash_fn may be replaced (tests use a
    weak one); it must be a function of the text."""
    hashed = _hashed(docs, id_col, text_col, hash_fn)
    single, clash = _classes(hashed)

    def labelled(rows: DataFrame, classes: DataFrame, on: list[str]) -> DataFrame:
        counted = (rows.withColumn("text_sha256", F.sha2(F.col("body").cast("binary"), 256))
                   .groupBy("text_sha256", "doc_id", *on).agg(F.count("*").alias("times")))
        return counted.join(classes, on).select(
            "doc_id", "first", F.col("n").alias("group_size"), "text_sha256", "times")

    out = labelled(hashed, single, ["h"])
    if clash is not None:
        out = out.unionByName(labelled(hashed, clash, ["h", "body"]))
    # rows written several times under one id come back as often as they were there
    blocks = out.withColumn("block", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(times - 1) div {STEP}"))))
    again = blocks.withColumn("copy", F.explode(F.sequence(
        F.lit(1).cast("long"), F.least(F.lit(STEP).cast("long"), F.expr(f"times - block * {STEP}")))))
    is_first = F.coalesce("doc_id", F.lit(LONG_MAX)) == F.col("first")
    return again.select(
        "doc_id",
        F.when(F.col("first") < LONG_MAX, F.col("first")).alias("keep_id"),
        "group_size",
        (is_first & (F.col("block") == 0) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          hash_fn: Callable[[Column], Column] = hash128) -> DataFrame:
    """The rows that stay, with all their columns."""
    body, h, first = fresh(docs, "body", "h", "first")
    single, clash = _classes(_hashed(docs, id_col, text_col, hash_fn))
    rows = (docs.withColumn(body, squeeze(F.col(text_col)))
            .withColumn(h, hash_fn(F.col(body)))
            .withColumn(first, F.coalesce(F.col(id_col).cast("long"), F.lit(LONG_MAX))))
    keys = single.select(F.col("h").alias(h), F.col("first").alias(first))
    out = rows.drop(body).join(keys, [h, first], "left_semi").dropDuplicates([h, first]).drop(h, first)
    if clash is not None:
        keys = clash.select(F.col("h").alias(h), F.col("body").alias(body), F.col("first").alias(first))
        more = rows.join(keys, [h, body, first], "left_semi").dropDuplicates([h, body, first])
        out = out.unionByName(more.drop(h, body, first))
    return out
