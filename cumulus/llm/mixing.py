"""Mixing sources to target weights.

Every row gets a hash-random key; within a source the rows are range-sorted by
it (a range is a prefix of the key, so ranges are even without sampling), the
sizes of the ranges are summed up ahead of the rows, and each source is cut
where its running size meets its budget.  A budget above the source's size takes
the source whole as often as it fits (an epoch) and the rest from the front of
the same order.  The row at the cut is taken in part, so budgets are met to the
word.

No source, however large, is sorted in one task: windows are per (source,
range); what runs per source has one row per range, and what runs over all has
one row per source.

Defined results: NULL text has size 0 and takes 0; NULL sources are one source
of their own, last in order; a row without an id has a key by its text; rows that repeat
are separate rows, each with its own share (but one key, so copies of one id, or of one
text without an id, share a range); ties of the key are broken by id and size; an empty table gives an empty result.  Columns of
the input stay, also if their names equal ours (ours win).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cumulus.llm.common import fresh, word_count

#: Hex digits of the key that name a range: 16^3 ranges per source.
RANGE_DIGITS = 3


def random_key(id_col: Column, text_col: Column, seed: str) -> Column:
    """By the id; a row without one goes by its text, so such rows spread over all ranges."""
    text = F.md5(F.coalesce(text_col, F.lit("")).cast("binary"))
    named = F.coalesce(id_col.cast("string"), F.concat(F.lit("~"), text))
    return F.md5(F.concat(F.lit(seed + ":"), named).cast("binary"))


def source_targets(sizes: DataFrame, weights: list[float], share: float, most: float) -> DataFrame:
    """sizes: one row per source (skey, source_size).  Adds target.

    Sources in order of skey weigh weights[0], weights[1], ... repeating, and
    share `share` times the sum of sizes; none gets above `most` times its size,
    and what that leaves over goes to the others by weight.  With the sources
    ordered by the level at which they are full, the level of those that never
    fill follows from sums over the ones before."""
    one = Window.partitionBy()
    by_rank = one.orderBy("skey")
    wts = F.array(*[F.lit(float(w)) for w in weights])
    s = (sizes.withColumn("rank", F.row_number().over(by_rank))
         .withColumn("weight", F.element_at(wts, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
         .withColumn("cap", F.col("source_size") * F.lit(float(most))))
    before = one.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    s = (s.withColumn("left", F.sum("source_size").over(one) * F.lit(float(share))
                      - F.coalesce(F.sum("cap").over(before), zero))
         .withColumn("weights_left", F.sum("weight").over(one) - F.coalesce(F.sum("weight").over(before), zero))
         .withColumn("level", F.col("left") / F.col("weights_left"))
         .withColumn("full", F.col("level") >= F.col("cap") / F.col("weight")))
    final = F.max(F.when(~F.col("full"), F.col("level"))).over(one)
    return s.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(
        F.col("weight") * final)).select("skey", "source_size", "target")


def mix(docs: DataFrame, weights: list[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: str = "mix-1") -> DataFrame:
    """docs with size (words), source_size, target (words of its source) and taken
    (words of this row that the mix has, epochs counted)."""
    weights = list(weights)
    skey, bucket, key, ahead, part = fresh(docs, "skey", "bucket", "key", "ahead", "part")
    rows = (docs.drop("size", "source_size", "target", "taken")
            .withColumn("size", word_count(F.col(text_col)))
            # '=' + source sorts as source does, and before the key of NULL
            .withColumn(skey, F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("~")))
            .withColumn(key, random_key(F.col(id_col), F.col(text_col), seed))
            .withColumn(bucket, F.substring(key, 1, RANGE_DIGITS)))
    sums = rows.groupBy(skey, bucket).agg(F.sum("size").alias(part))
    per_source = sums.groupBy(F.col(skey).alias("skey")).agg(F.sum(part).alias("source_size"))
    targets = source_targets(per_source, weights, share, most).withColumnRenamed("skey", skey)
    earlier = Window.partitionBy(skey).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    ranges = sums.withColumn(ahead, F.coalesce(F.sum(part).over(earlier), F.lit(0).cast("long"))).drop(part)
    ranges = ranges.join(targets, skey)
    inside = (Window.partitionBy(skey, bucket).orderBy(key, id_col, "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.withColumn(part, F.sum("size").over(inside) - F.col("size")).join(ranges, [skey, bucket])
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    from_rest = F.greatest(F.lit(0).cast("long"),
                           F.least(F.col("size"), rest - F.col(ahead) - F.col(part)))
    out = placed.withColumn("taken", epochs * F.col("size") + from_rest)
    kept = [c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "taken")]
    return out.select(*kept, "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **options) -> DataFrame:
    """The mix as documents: each row as often as it is taken.  The row at a source's cut
    comes whole or not at all, whichever is nearer to the part taken, so a source's words
    are off its target by half that row at most.  Columns stay as they are."""
    slim = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    times = F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")
    mixed = mix(slim, **options).where("taken > 0").select("row", F.explode(F.array_repeat(F.lit(0), times)))
    return mixed.select(*[F.col("row")[c].alias(c) for c in docs.columns])
