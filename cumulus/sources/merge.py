"""A stored table that batches of a stream are merged into.

Rows lie in folders by hash of their key.  A batch is merged with the buckets that it
touches only: each is written anew under the batch's number, then a manifest of the
batch names the current folder of every bucket.  The manifest appears by rename, so a
reader sees a batch whole or not at all, and a batch that comes again after a failure
finds its manifest and changes nothing.  Two batches are never merged at a time, as a
stream's batches follow one another.

Defined results: an empty batch writes its manifest and no rows; rows whose key has
NULLs are merged like others (NULLs are equal); an unwritten store reads as empty.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folders that keys are dealt out to; a store keeps the number it began with.
BUCKETS = 64


class Store:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, keys, buckets
        self._jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def batches(self) -> list[int]:
        """Numbers of the merged batches, ascending."""
        if not self._fs.exists(self._path("manifests")):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(self._path("manifests"))]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, batch: int | None = None) -> dict:
        """{"buckets": number of them, "current": {bucket: batch that wrote it}}."""
        done = self.batches() if batch is None else [batch]
        if not done:
            return {"buckets": self.buckets, "current": {}}
        text = self.spark.read.text(f"{self.path}/manifests/{done[-1]}.json", wholetext=True).first()[0]
        return json.loads(text)

    def folders(self, buckets: list[str] | None = None) -> list[str]:
        current = self.manifest()["current"]
        return [f"{self.path}/bucket={b}/batch={n}" for b, n in sorted(current.items(), key=lambda x: int(x[0]))
                if buckets is None or b in buckets]

    def read(self, buckets: list[str] | None = None) -> DataFrame:
        folders = self.folders(buckets)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def merge(self, rows: DataFrame, batch: int, resolve: Callable[[DataFrame, DataFrame], DataFrame]) -> bool:
        """Merge a batch: ``resolve(stored, new)`` gives the rows to keep, for the touched
        buckets.  False if the batch was merged before."""
        if batch in self.batches():
            return False
        known = self.manifest()
        count = known["buckets"]
        bucket = F.pmod(F.hash(*self.keys), F.lit(count))
        rows = rows.select(*self.schema.names)
        touched = [str(r[0]) for r in rows.select(bucket).distinct().collect()]  # at most `buckets` numbers
        current = dict(known["current"])
        if touched:
            kept = resolve(self.read([b for b in touched if b in current]), rows)
            out = f"{self.path}/writing/{batch}"
            (kept.select(*self.schema.names, bucket.alias("bucket")).repartition("bucket")
                 .write.mode("overwrite").partitionBy("bucket").parquet(out))
            for b in touched:
                new = self._path(f"bucket={b}/batch={batch}")
                self._fs.delete(new, True)  # left by an attempt that failed before its manifest
                self._fs.mkdirs(new.getParent())
                if self._fs.rename(self._path(f"writing/{batch}/bucket={b}"), new):
                    current[b] = batch
            self._fs.delete(self._path(f"writing/{batch}"), True)
        text = bytearray(json.dumps({"buckets": count, "current": current}).encode())
        draft = self._path(f"manifests/.{batch}.draft")
        stream = self._fs.create(draft, True)
        stream.write(text)
        stream.close()
        if not self._fs.rename(draft, self._path(f"manifests/{batch}.json")):
            raise RuntimeError(f"could not publish batch {batch}")
        return True


def last_wins(keys: list[str], order: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Upsert: of the rows of a key the one with the greatest order stays."""

    def resolve(stored: DataFrame, new: DataFrame) -> DataFrame:
        both = stored.unionByName(new)
        others = [c for c in both.columns if c not in keys]
        best = both.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(order)).alias("_m"))
        return best.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in others])

    return resolve


def first_wins(keys: list[str], order: list[str]) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Insert or ignore: a stored row stays; of new rows of a key the first by order."""
    from cumulus.sources.store import first_per_key

    def resolve(stored: DataFrame, new: DataFrame) -> DataFrame:
        both = stored.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
        return first_per_key(both, keys, ["_new", *order]).drop("_new")

    return resolve
