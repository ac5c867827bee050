"""Write semantics over Parquet: replace a slice, insert and ignore, upsert, update by key."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE = ("country_code", "collected_date")


def put_text(spark: SparkSession, path: str, body: str) -> None:
    """Write one small file from the driver to any file system that the session knows."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(bytearray(body.encode()))
    out.close()


def insert_ignore(held: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of new whose key is not held yet, the first of each key; rows without a key always pass."""
    keyed, free = new.filter(F.col(key).isNotNull()), new.filter(F.col(key).isNull())
    fresh = keyed.join(held.select(key).filter(F.col(key).isNotNull()), key, "left_anti")
    first = fresh.groupBy(key).agg(F.min_by(F.struct(*new.columns), order).alias("_row")).select("_row.*")
    return first.unionByName(free)


def upsert(held: DataFrame, new: DataFrame, keys: list[str], recency: Column | None = None) -> DataFrame:
    """One row a key: a new one if there is any, else the held one; of several new ones the most recent."""
    rows = held.withColumn("_new", F.lit(0)).withColumn("_at", F.lit(None).cast("string"))
    more = new.withColumn("_new", F.lit(1)).withColumn("_at", (recency if recency is not None else F.lit(None)).cast("string"))
    best = F.max_by(F.struct(*held.columns), F.struct("_new", "_at"))  # null is the least
    return rows.unionByName(more).groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(best.alias("_row")).select("_row.*")


def update(held: DataFrame, changes: DataFrame, key: str, keep_if_null: tuple[str, ...] = ()) -> DataFrame:
    """held with the columns of changes taken over for keys that it has; those in keep_if_null only where they are not null."""
    cols = [c for c in changes.columns if c != key]
    side = changes.select(key, F.struct(*cols).alias("_c"))
    out = held.join(side, key, "left")

    def value(c):
        new = F.col(f"_c.{c}")
        return F.when(F.col("_c").isNotNull() & (new.isNotNull() if c in keep_if_null else F.lit(True)), new).otherwise(F.col(c)).alias(c)

    return out.select(*[value(c) if c in cols else F.col(c) for c in held.columns])


def replace_by_parent(held: DataFrame, new: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """held without the rows of the parents, and new."""
    return held.join(parents.select(key).distinct(), key, "left_anti").select(*new.columns).unionByName(new)


class SliceStore:
    """A Parquet table partitioned by country and day, one writer; a write replaces whole slices, and an empty one clears."""

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = SLICE):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path

    def replace(self, df: DataFrame, slices: list[dict[str, str]]) -> None:
        """Replace the slices named; rows of others are an error. Files are written first, so a failed job changes nothing, and
        a slice is moved aside before the new one takes its place, so a driver lost in between leaves it to be put back."""
        self._put_back()
        fs, path = self._fs()
        staged = f"{self.path}/_staged-{uuid.uuid4().hex}"
        wanted = None
        for s in slices:
            c = F.lit(True)
            for k in self.keys:
                c = c & (F.col(k).cast("string") == s[k])
            wanted = c if wanted is None else wanted | c
        df.withColumn("_known", F.coalesce(wanted, F.lit(False))).filter(F.col("_known") | F.raise_error(F.lit("a row outside of the slices")).isNull()).drop("_known").write.partitionBy(*self.keys).parquet(staged)
        for s in slices:
            part = "/".join(f"{k}={s[k]}" for k in self.keys)
            target, source, aside = path(f"{self.path}/{part}"), path(f"{staged}/{part}"), path(f"{self.path}/_aside/{part}")
            empty = path(f"{self.path}/_empty/{part}")
            if not fs.exists(source):
                fs.mkdirs(empty)  # says that the slice is to be gone
            if fs.exists(target):
                fs.mkdirs(aside.getParent())
                fs.rename(target, aside)
            if fs.exists(source):
                fs.mkdirs(target.getParent())
                fs.rename(source, target)
            fs.delete(aside, True)
            fs.delete(empty, True)
        fs.delete(path(staged), True)

    def _put_back(self) -> None:
        """Put back slices that a lost driver has left aside: those whose place is empty and was not to be."""
        fs, path = self._fs()
        root = f"{self.path}/_aside"
        for found in fs.globStatus(path(root + "".join(f"/{k}=*" for k in self.keys))) or [] if fs.exists(path(root)) else []:
            part = "/".join(found.getPath().toString().split("/")[-len(self.keys) :])
            target = path(f"{self.path}/{part}")
            if fs.exists(target) or fs.exists(path(f"{self.path}/_empty/{part}")):
                fs.delete(found.getPath(), True)
            else:
                fs.mkdirs(target.getParent())
                fs.rename(found.getPath(), target)

    def rows(self, schema) -> DataFrame:
        self._put_back()
        fs, path = self._fs()
        if not fs.exists(path(self.path)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)
