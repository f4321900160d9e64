"""A growing set of known keys, stored by key hash, that arrivals are held against.

The folder has one partition for each hash bucket and one row for each key, and a log of the chunks
that were appended. An arrival reads only the buckets that its own keys fall into; the arriving keys, counted
first, are the small side of the join, so the index is scanned and not shuffled where they fit a broadcast.
One writer at a time. An append that fails half way can be repeated: keys that are there already are not
written again, and a chunk counts once its line is in the log.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkgate.functions.keys import Rule
from chunkgate.operators.novelty import known_keys, share_of
from chunkgate.sources.tables import stored

KEYS = "_ck string, bucket int"
LOG = "chunk string, n_rows bigint, new_keys bigint"


@dataclass(frozen=True)
class KeyIndex:
    """Known keys below one folder, in ``n_buckets`` partitions. The number of buckets is part of the folder's name."""

    spark: SparkSession
    root: str
    n_buckets: int = 256
    canonical: bool = False
    rule: Rule | None = None

    def _path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self._path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def keys(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The known keys (``_ck``, compact), or those of some buckets: other partitions are not listed nor read."""
        known = self._read(f"keys-{self.n_buckets}", KEYS)
        return known if buckets is None else known.where(F.col("bucket").isin(list(buckets)))

    def log(self) -> DataFrame:
        return self._read("chunks", LOG)

    def _counted(self, chunk: DataFrame, key: str) -> tuple[DataFrame, list[int]]:
        """Rows of each arriving key (null: rows without one), and the buckets they touch, at most all."""
        found = known_keys(chunk, key, self.canonical, self.rule).groupBy("_ck").agg(F.count(F.lit(1)).alias("n"))
        bucket = F.pmod(F.xxhash64("_ck"), F.lit(self.n_buckets)).cast("int")
        counted = stored(found.withColumn("bucket", F.when(F.col("_ck").isNotNull(), bucket)), "arriving-keys")
        return counted, sorted(r["bucket"] for r in counted.where("bucket is not null").select("bucket").distinct().collect())

    def append(self, name: str, chunk: DataFrame, key: str) -> int:
        """Add the chunk's new keys under the chunk's name; returns how many are new. A name counts once."""
        if not self.log().where(F.col("chunk") == name).isEmpty():
            return 0
        counted, touched = self._counted(chunk, key)
        arriving = counted.where("_ck is not null")
        new = stored(arriving.join(self.keys(touched), ["bucket", "_ck"], "left_anti").select("_ck", "bucket"), "new-keys")
        new.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(self._path(f"keys-{self.n_buckets}"))
        n_new, n_rows = new.count(), counted.agg(F.sum("n")).first()[0] or 0
        self.spark.createDataFrame([(name, n_rows, n_new)], LOG).coalesce(1).write.mode("append").parquet(self._path("chunks"))
        return n_new

    def met(self, chunk: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """The arriving keys with their rows, and those of them that are known."""
        counted, touched = self._counted(chunk, key)
        return counted, self.keys(touched).join(counted, ["bucket", "_ck"]).select("_ck", "n")

    def novelty_facts(self, chunk: DataFrame, key: str) -> DataFrame:
        """One row: incoming rows, novel rows and their share, reference rows. Rows without a key are not novel."""
        counted, known = self.met(chunk, key)
        rows = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("incoming_rows"), F.coalesce(F.sum(F.when(F.col("_ck").isNotNull(), F.col("n"))), F.lit(0)).alias("_keyed"))
        seen = known.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_known"))
        reference = self.log().agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("reference_rows"))
        facts = rows.crossJoin(seen).crossJoin(reference).withColumn("novel_rows", F.col("_keyed") - F.col("_known"))  # one row each
        return facts.select("incoming_rows", "novel_rows", share_of("novel_rows", "incoming_rows").alias("novel_fraction"), "reference_rows")

    def novel_rows(self, chunk: DataFrame, key: str) -> DataFrame:
        """The chunk's rows whose key is not known; repeats count each time."""
        _, known = self.met(chunk, key)
        found = stored(known.select("_ck"), "known-keys")
        return known_keys(chunk, key, self.canonical, self.rule, all_rows=False, keep=True).join(found, "_ck", "left_anti").drop("_ck")
