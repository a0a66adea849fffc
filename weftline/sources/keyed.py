"""A table of keys and values that grows by files and is never rewritten in place.

A put or delete adds one folder of rows (key, value, deleted), dealt out by a hash
of the key into buckets and sorted by key; a folder counts once its success mark
is there. Of several rows of a key the one of the latest folder holds, and a
deleted one hides the key. A read touches the buckets that its keys are in, and in
these the row groups whose key range fits. Compaction writes what holds into a new
folder that takes the place of all before it; `vacuum` removes those.

One writer at a time; readers need no lock, as a folder never changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.sources.sinks import stage_done

_ROWS = "key string, value string, deleted boolean, bucket int"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def folders(self) -> list[tuple[int, bool]]:
        """(number, compacted) of the folders that hold, in order: the last
        compacted one and all behind it."""
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(root)] if files.exists(root) else []
        found = sorted((int(n.split("-")[1]), n.startswith("base-")) for n in names if n.startswith(("base-", "rows-")) and stage_done(self.spark, f"{self.path}/{n}"))
        start = max((number for number, compacted in found if compacted), default=-1)
        return [(number, compacted) for number, compacted in found if number > start or compacted and number == start]

    def _folder(self, number: int, compacted: bool) -> str:
        return f"{self.path}/{'base' if compacted else 'rows'}-{number}"

    def _write(self, rows: DataFrame, number: int, compacted: bool = False) -> None:
        placed = rows.withColumn("bucket", self._bucket(F.col("key"))).repartition(self.buckets, "bucket").sortWithinPartitions("bucket", "key")
        placed.write.mode("overwrite").partitionBy("bucket").parquet(self._folder(number, compacted))

    def _next(self) -> int:
        return max((number for number, _ in self.folders()), default=-1) + 1

    def put(self, rows: DataFrame) -> None:
        """rows: key, value. Of a key's several rows the greatest value is taken;
        a null key is none."""
        new = rows.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")).filter("key IS NOT NULL")
        self._write(new.groupBy("key").agg(F.max("value").alias("value")).withColumn("deleted", F.lit(False)), self._next())

    def delete(self, keys: DataFrame) -> None:
        gone = keys.select(F.col("key").cast("string").alias("key")).filter("key IS NOT NULL").distinct()
        self._write(gone.select("key", F.lit(None).cast("string").alias("value"), F.lit(True).alias("deleted")), self._next())

    def _log(self) -> DataFrame:
        parts = [self.spark.read.schema(_ROWS).parquet(self._folder(*f)).withColumn("at", F.lit(f[0])) for f in self.folders()]
        out = parts[0] if parts else self.spark.createDataFrame([], _ROWS + ", at int")
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    @staticmethod
    def _held(log: DataFrame) -> DataFrame:
        last = log.groupBy("key").agg(F.max_by(F.struct("value", "deleted"), "at").alias("x"))
        return last.filter("NOT x.deleted").select("key", "x.value")

    def scan(self, prefix: str = "") -> DataFrame:
        """key, value of all keys that begin with the prefix, which is pushed to the files."""
        log = self._log()
        return self._held(log.filter(F.col("key").startswith(prefix)) if prefix else log)

    def get(self, *keys: str) -> DataFrame:
        """key, value of these keys; only their buckets are read."""
        buckets = sorted({r.b for r in self.spark.createDataFrame([(k,) for k in keys], "k string").select(self._bucket(F.col("k")).alias("b")).collect()})
        return self._held(self._log().filter(F.col("bucket").isin(buckets) & F.col("key").isin(list(keys))))

    def lookup(self, rows: DataFrame, key: str) -> DataFrame:
        """`rows` with the value of their key, null where there is none; each row
        once. What is not asked for is left out before versions are compared."""
        wanted = rows.select(F.col(key).alias("key")).distinct().withColumn("bucket", self._bucket(F.col("key")))
        held = self._held(self._log().join(wanted, ["bucket", "key"], "left_semi"))
        return rows.join(held.withColumnRenamed("key", "_key"), F.col(key) == F.col("_key"), "left").drop("_key")

    def compact(self) -> None:
        """One folder of all that holds, under the number of the last one."""
        found = self.folders()
        if len(found) > 1 or found and not found[0][1]:
            self._write(self._held(self._log()).withColumn("deleted", F.lit(False)), found[-1][0], compacted=True)

    def vacuum(self) -> None:
        """Removes the folders before the last compacted one."""
        jvm, found = self.spark.sparkContext._jvm, self.folders()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        held = {self._folder(*f).rsplit("/", 1)[1] for f in found}
        for s in files.listStatus(root) if files.exists(root) else []:
            name = s.getPath().getName()
            if name.startswith(("base-", "rows-")) and name not in held and int(name.split("-")[1]) <= (found[0][0] if found and found[0][1] else -1):
                files.delete(s.getPath(), True)
