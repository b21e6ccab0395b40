"""Helpers that the operators share: text expressions, scratch tables, names."""

from __future__ import annotations

import uuid
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cumulus.session import checkpoint_dir

#: White space of all word and line contracts: blank, tab, \n, \v, \f, \r.  It
#: is also what bytes.split() splits at.
SPACE = r"[\x20\x09-\x0D]"
LONG_MAX = 9223372036854775807


def word_count(text: Column) -> Column:
    """Number of words (runs of anything but white space); 0 for NULL."""
    blank = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.array_remove(F.split(blank, " "), "")).cast("long")


def squeeze(text: Column) -> Column:
    """Each run of white space becomes one blank; NULL becomes ''.

    Blanks that stand alone already are not matched, which spares most of the
    replacements."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + r"{2,}|[\x09-\x0D]", " ")


def text_of(value) -> str:
    """A Python str for a text cell of a pandas batch (NULL arrives as None or NaN)."""
    return value if isinstance(value, str) else ""


class Taken:
    """Spans (start, end) to look up overlaps in, each in logarithmic time."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts, self.ends = [a for a, _ in spans], list(accumulate((b for _, b in spans), max))

    def meets(self, start: int, end: int) -> bool:
        """Whether some span has a place between start and end (exclusive)."""
        before = bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start


#: Rows of a batch that crosses to Python, at most: texts can be long.
BATCH_ROWS = 2000
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(docs: DataFrame) -> None:
    """Sets the session's batch size down to BATCH_ROWS, which bounds a worker's memory."""
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(BATCH_CONF)) <= BATCH_ROWS:
        conf.set(BATCH_CONF, str(BATCH_ROWS))


def for_python(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """doc_id (as text: pandas would turn a column with NULLs into doubles), text and
    more columns for a map over pandas batches; ids come back through from_python."""
    small_batches(docs)
    return docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"), *more)


def from_python(mapped: DataFrame) -> DataFrame:
    return mapped.withColumn("doc_id", F.col("doc_id").cast("long"))


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Column names that df doesn't have (compared without case), near the wanted ones."""
    have = {c.lower() for c in df.columns}
    out = []
    for w in wanted:
        name = f"__{w}"
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new folder name below the shared folder; it goes when the driver ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def stored(df: DataFrame, what: str) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts lineage, and
    what a task computed once stays as it is when executors are lost."""
    spark = df.sparkSession
    path = scratch_path(spark, what)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut(df: DataFrame) -> DataFrame:
    """checkpoint() in the shared folder; for tables of hashes, ids and counts."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


#: Rows of narrow per-key tables that are broadcast; above it they are shuffled.
BROADCAST_ROWS = 10_000


def checked_broadcast(df: DataFrame) -> DataFrame:
    """df (a few narrow columns per key) to be joined: broadcast if it is small as
    counted, else left to a shuffle join."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
