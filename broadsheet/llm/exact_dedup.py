"""Exact dedup against a persistent digest index, bucketed and sorted by digest."""

from __future__ import annotations

import hashlib
import json
import uuid

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm.common import (
    ROW_KEY,
    drop_path,
    fold,
    fresh_path,
    keep_rows,
    salted,
    slices,
    small_batches,
    stage,
    stage_only,
    unfold,
    unstage,
    with_row_key,
)

#: Buckets of a new index: tasks of its anti-join and files of each batch. More of them for more data.
BUCKETS = 64


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", also: Column | None = None) -> DataFrame:
    """(_id, digest, and `also` as _also): SHA-256 of the text, lower-cased in A-Z only, in UTF-8; null is the empty text."""
    small_batches(docs.sparkSession)
    narrow = docs.select(docs[text_col].cast("string").alias("_text"), docs[id_col].alias("_id"), *([also.alias("_also")] if also is not None else []))
    names = [*narrow.columns[1:], "digest"]

    def run(batches):
        for b in slices(batches):
            low = pc.ascii_lower(pc.fill_null(b.column(0), "")).cast(pa.binary())
            out = pa.array([hashlib.sha256(x.as_buffer()).digest() for x in low], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], out], names=names)

    return narrow.mapInArrow(run, ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields[1:]] + ["digest binary"]))


class DigestIndex:
    """Digests seen so far: a Parquet table of `buckets` files a batch, bucketed and sorted by digest.

    One row a digest: digest, keep_id, seen, batch. The number of buckets and the type of ids are kept in a file beside the
    data; opening a path again takes the number of buckets from there, and another number or type of ids is an error. New
    digests reach the index by one anti-join, in which only the new side is shuffled.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, id_type: str = "bigint", buckets: int | None = None):
        self.spark, self.path = spark, path or fresh_path(spark, "digest-index")
        self.name = f"digest_index_{uuid.uuid4().hex}"
        held = self._facts()
        if held is None:
            held = {"buckets": buckets or BUCKETS, "id_type": id_type}
            self._write_facts(held)
        if held["id_type"] != id_type or buckets not in (None, held["buckets"]):
            raise ValueError(f"the index at {self.path} has {held['buckets']} buckets and ids of type {held['id_type']}")
        self.buckets = held["buckets"]
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id {id_type}, seen BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )

    def _file(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_digest_index.json")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _facts(self) -> dict | None:
        path, files = self._file()
        if not files.exists(path):
            return None
        read = files.open(path)
        try:
            return json.loads(bytes(read.readAllBytes()).decode())
        finally:
            read.close()

    def _write_facts(self, facts: dict) -> None:
        path, files = self._file()
        out = files.create(path, False)
        out.write(bytearray(json.dumps(facts).encode()))
        out.close()

    def close(self) -> None:
        """Take the table out of the catalog; its files stay, for DigestIndex(spark, path)."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, groups: DataFrame, batch: str = "") -> None:
        """Add the digests of `groups` that the index does not hold: sort-merge anti-join, then a bucketed append. Rows that
        repeat a digest are not looked for. Adding the same groups again adds nothing."""
        new = groups.select("digest", "keep_id", F.col("group_size").alias("seen"), F.lit(batch).alias("batch"))
        fresh = new.hint("merge").join(self.rows().select("digest"), "digest", "left_anti")
        fresh.repartition(self.buckets, "digest").write.insertInto(self.name)

    def deduplicate(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", also: Column | None = None, batch: str | None = None) -> DataFrame:
        """One row per row of docs: id, keep_id, group_size, kept, digest (and `also`, a column of docs, as _also).

        Of equal texts in this batch the row with the largest id stays (null ids are smallest; of repeated rows with that
        id one stays), unless an earlier batch brought the text: then none stays and keep_id is the row kept earlier.
        group_size counts equal texts in this batch. An empty table gives no rows. Other columns of docs are not read.

        The decisions are written before the index takes the batch, and texts that the index has from this same batch do
        not count as met, so a batch that is sent again, after a lost driver, gets the same decisions. `batch` names it; by
        default it is named by its ids and digests, so the same rows are the same batch.
        """
        seen = stage(digests(docs, id_col, text_col, also).withColumn("_uid", F.monotonically_increasing_id()), "digests")
        if batch is None:
            total = seen.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("_id", "digest").cast("decimal(38,0)")).alias("s")).first()
            batch = f"{total.n}-{total.s}"
        rows = salted(seen, F.col("_uid"))
        groups = fold(
            rows,
            ["digest"],
            {"_best": F.max(F.struct(F.col("_id").isNotNull().alias("has"), F.col("_id").alias("id"), F.col("_uid").alias("uid"))), "_n": F.count(F.lit(1))},
            {"_best": F.max("_best"), "group_size": F.sum("_n")},
        ).withColumn("keep_id", F.col("_best.id"))
        groups = stage(groups, "digest-groups")
        met = groups.select("digest").hint("merge").join(self.rows().filter(F.col("batch") != batch), "digest")
        held = met.select("digest", F.col("keep_id").alias("_held_id"), F.lit(True).alias("_held"))
        known = groups.join(held, "digest", "left").select(
            "digest",
            "group_size",
            F.when(F.col("_held"), F.col("_held_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.when(F.col("_held"), F.lit(None)).otherwise(F.col("_best.uid")).alias("_keep_uid"),
            "_salts",
        )
        known = stage(known, "digest-decisions")
        self.append(groups, batch)
        unstage(groups)
        out = unfold(rows, known, ["digest"])
        return out.select(
            F.col("_id").alias(id_col),
            "keep_id",
            "group_size",
            F.coalesce(F.col("_uid") == F.col("_keep_uid"), F.lit(False)).alias("kept"),
            "digest",
            *(["_also"] if also is not None else []),
        )


def drop_copies(docs: DataFrame, index: DigestIndex | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns: of equal texts, one row of the largest id, null ids last."""
    spark, keyed = docs.sparkSession, with_row_key(docs)
    own = index or DigestIndex(spark, id_type=docs.schema[id_col].dataType.simpleString())
    kept = stage_only(lambda: own.deduplicate(keyed, id_col, text_col, keyed[ROW_KEY]).filter("kept").select(F.col("_also").alias(ROW_KEY)), "kept")
    if index is None:
        own.close()
        drop_path(spark, own.path)
    return keep_rows(keyed, kept)
