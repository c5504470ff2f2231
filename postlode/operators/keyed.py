"""A store of the last record of each key, for batches that are small beside it.

The store lies in buckets of keys. A batch reads the buckets alone that its
keys are in, and appends to them the records that are new or come after what is
known; reading takes the last record of each key. As the last record is the
same however often records came in, a batch may be written twice, or again
after a writer died half-way. Buckets that have grown are dealt out anew, into
more of them, as a generation of its own that counts once it is whole.
One writer at a time.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlode.operators.stores import latest
from postlode.shared import stored


@dataclass(frozen=True)
class KeyedStore:
    """Records of a schema under a path that all executors see.

    order: columns by which the last record of a key is told; of equal ones the
    greatest by all other columns is last. A null key is a key, nulls come
    first in the order. ("ok", "at") keeps a record that went well, whatever
    failures come after it.
    """

    path: str
    schema: str
    key: tuple[str, ...]
    order: tuple[str, ...]
    rows_a_bucket: int = 1_000_000
    files_a_bucket: int = 64

    def read(self, spark: SparkSession) -> DataFrame:
        """The last record of each key; no rows before the first batch."""
        return self._last(self._raw(spark), self.key)

    def upsert(self, batch: DataFrame) -> None:
        """Takes in the records of a batch; columns that the schema does not name are left out."""
        spark = batch.sparkSession
        fresh, now = self._last(batch, self.key), self._generations(spark)
        if not now:
            self._write(fresh, 0, 1)
            return self._compacted(spark, [(0, 1)], self._sizes(self._raw(spark)))
        number, buckets = now[-1]
        fresh = stored(fresh.withColumn("_bucket", self._bucket(buckets)), "batch")
        # at most as many as the store has
        met = [r["_bucket"] for r in fresh.select("_bucket").distinct().collect()]
        known = self._raw(spark).where(F.col("_bucket").isin(met))
        held = self._last(known, (*self.key, "_bucket")).withColumn("_known", F.lit(True))
        both = held.unionByName(fresh.select(*held.columns[:-1]).withColumn("_known", F.lit(False)))
        # of equal records the known one counts, so that what is there already is not written again
        last = latest(both, [*self.key, "_bucket"], [*self._ranks(), "_known"]).where("NOT _known").drop("_known")
        stored(last, "changed").repartition("_bucket").write.mode("append").partitionBy("_bucket").parquet(self._folder(number, buckets))
        return self._compacted(spark, now, self._sizes(self._raw(spark).where(F.col("_bucket").isin(met))))

    def buckets(self, spark: SparkSession) -> int:
        return self._generations(spark)[-1][1]

    def _sizes(self, rows: DataFrame) -> tuple[int, int]:
        """The most rows and the most files of a bucket."""
        each = rows.withColumn("_file", F.input_file_name()).groupBy("_bucket", "_file").agg(F.count("*").alias("n")).groupBy("_bucket").agg(F.sum("n").alias("n"), F.count("*").alias("files"))
        return tuple(x or 0 for x in each.agg(F.max("n"), F.max("files")).first())

    def _compacted(self, spark: SparkSession, now: Sequence[tuple[int, int]], sizes: tuple[int, int]) -> None:
        """Writes a new generation if a bucket has twice the rows, or more files, than it should."""
        number, buckets = now[-1]
        if sizes[0] <= 2 * self.rows_a_bucket and sizes[1] <= self.files_a_bucket:
            return
        rows = self.read(spark)
        live = rows.groupBy(self._bucket(buckets).alias("_bucket")).count().agg(F.max("count")).first()[0] or 0
        while buckets * self.rows_a_bucket < live * now[-1][1]:
            buckets *= 2
        self._write(rows, number + 1, buckets)
        for old in now[:-1]:  # what is read at the moment stays for one generation more
            self._files(spark)[0].delete(self._files(spark, self._folder(*old))[1], True)

    def _write(self, rows: DataFrame, number: int, buckets: int) -> None:
        rows.withColumn("_bucket", self._bucket(buckets)).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(self._folder(number, buckets))

    def _raw(self, spark: SparkSession) -> DataFrame:
        schema = f"{self.schema}, _bucket int"
        now = self._generations(spark)
        return spark.read.schema(schema).parquet(self._folder(*now[-1])) if now else spark.createDataFrame([], schema)

    def _last(self, rows: DataFrame, key: Sequence[str]) -> DataFrame:
        return latest(rows.select(*dict.fromkeys([*key, *self._names()])), key, self._ranks())

    def _names(self) -> list[str]:
        return [f.split()[0] for f in re.split(r",\s*(?![^<(]*[>)])", self.schema)]

    def _ranks(self) -> list[str]:
        return [*self.order, *[c for c in self._names() if c not in self.key and c not in self.order]]

    def _bucket(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(buckets)).cast("int")

    def _folder(self, number: int, buckets: int) -> str:
        return f"{self.path}/generation-{number}-{buckets}"

    def _files(self, spark: SparkSession, path: str | None = None) -> tuple:
        place = spark._jvm.org.apache.hadoop.fs.Path(path or self.path)
        return place.getFileSystem(spark._jsc.hadoopConfiguration()), place

    def _generations(self, spark: SparkSession) -> list[tuple[int, int]]:
        """(number, buckets) of the generations that are whole, the newest last."""
        files, root = self._files(spark)
        if not files.exists(root):
            return []
        names = [f.getPath().getName() for f in files.listStatus(root)]
        found = [tuple(map(int, m.groups())) for n in names if (m := re.fullmatch(r"generation-(\d+)-(\d+)", n))]
        return sorted(g for g in found if files.exists(self._files(spark, f"{self._folder(*g)}/_SUCCESS")[1]))
