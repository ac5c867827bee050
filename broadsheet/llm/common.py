"""What the operators share: shared folders, staged tables, salted grouping, text batches."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Salts per group key. Rows of a key exist in at most this many salted parts, so it bounds what a key gathers.
SALTS = 1024
#: Rows and bytes that are handed to Python code at once, at least one row; they bound the memory of a worker.
ROWS_AT_ONCE, BYTES_AT_ONCE = 512, 8 << 20

#: Tells rows of one id apart; no table has a column of this name.
ROW_KEY = "__broadsheet_row_key"


#: Tables staged inside calls of stage_only, innermost last.
_OPEN: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, set here only where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"/tmp/checkpoints/{uuid.uuid4().hex}"
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def stage(df: DataFrame, what: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage and computes it once, and survives lost executors."""
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    if _OPEN:
        _OPEN[-1].append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def stage_only(make: Callable[[], DataFrame], what: str) -> DataFrame:
    """stage(make()); then delete every table that make() has staged on its way, and let go of their shuffles."""
    _OPEN.append([])
    try:
        out = stage(make(), what)
    finally:
        paths = _OPEN.pop()
    for path in paths:
        if path != out._staged_path:
            drop_path(out.sparkSession, path)
    if _OPEN:
        _OPEN[-1].append(out._staged_path)
    release(out.sparkSession)
    return out


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner find the shuffles that no plan needs any more; their files otherwise stay for long on a driver
    with memory to spare."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def unstage(df: DataFrame) -> None:
    """Delete the files of a staged table that no later plan reads."""
    path = getattr(df, "_staged_path", None)
    if path:
        drop_path(df.sparkSession, path)


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession, size: int = BYTES_AT_ONCE) -> None:
    """Bound the rows and bytes of an Arrow batch, unless the session already asks for less."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > 2000:
        spark.conf.set(key, "2000")
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None) or ""
    if not now.isdigit() or not 0 < int(now) <= size:
        spark.conf.set(key, str(size))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(doc_id: Column, folds: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == F.lit(remainder)


# ---------------------------------------------------------------- salted grouping


def salted(df: DataFrame, *by: Column, salts: int = SALTS) -> DataFrame:
    """df with a column _salt, from what tells the rows of one key apart."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))


def fold(df: DataFrame, keys: Sequence[str], part: dict[str, Column], final: dict[str, Column]) -> DataFrame:
    """One row a key, in two steps: each salted part, then each key with the list of its salts (at most SALTS).

    No task gathers a key's rows: the first step deals them by (key, salt), the second sees one row a salt.
    """
    parts = df.groupBy(*keys, "_salt").agg(*[c.alias(n) for n, c in part.items()])
    return parts.groupBy(*keys).agg(*[c.alias(n) for n, c in final.items()], F.collect_list("_salt").alias("_salts"))


def unfold(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row of the salted df with the columns of its group; a group is copied only to salts that occur."""
    spread = groups.withColumn("_salt", F.explode("_salts")).drop("_salts")
    left, right = df.alias("l"), spread.alias("r")
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys] + [F.col("l._salt") == F.col("r._salt")]
    take = [F.col(f"r.{c}") for c in spread.columns if c not in (*keys, "_salt")]
    return left.join(right, on).select(*[F.col(f"l.{c}") for c in df.columns if c != "_salt"], *take)


def with_row_key(docs: DataFrame) -> DataFrame:
    """docs with ROW_KEY, which names each row: the hash of its file's path and its place there.

    Anything but a plain Parquet table is written to the shared folder first, so that a row keeps its key however often and
    wherever its partition is computed.
    """

    def keyed(df):
        meta = df.metadataColumn("_metadata")
        return df.select(*[df[f"`{c}`"] for c in df.columns], F.struct(F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("row")).alias(ROW_KEY))

    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            return keyed(docs)
        except AnalysisException:  # not Parquet
            pass
    return keyed(stage(docs, "rows"))


def keep_rows(keyed: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of keyed, as with_row_key gives it, whose ROW_KEY is in kept; without the key, other columns as they are.

    The decisions are the hashed side, so the wide rows are dealt once and never sorted.
    """
    return keyed.join(kept.select(ROW_KEY).hint("shuffle_hash"), ROW_KEY, "left_semi").drop(ROW_KEY)


# ---------------------------------------------------------------- text batches


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE, size: int = BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Batches cut to at most `rows` rows and about `size` bytes, at least one row each."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).nbytes > size:
                n = (n + 1) // 2
            yield batch.slice(at, n)
            at += n


def texts(column: pa.Array) -> list[str]:
    """Python strings of a column; null is empty."""
    return [x or "" for x in column.to_pylist()]


def over_text(df: DataFrame, columns: Sequence[str], text_col: str, out_schema: str, rows_of, rows: int = ROWS_AT_ONCE, size: int = BYTES_AT_ONCE) -> DataFrame:
    """rows_of(texts) gives columns of results by name for a list of texts; `columns` of df go through unchanged.

    Reads only the columns named, keeps a bounded number of texts and bytes (or one text) in Python, and shuffles nothing.
    A column that has the name of a result is an error.
    """
    small_batches(df.sparkSession)
    narrow = df.select(*[df[c] for c in columns], df[text_col].cast("string").alias("_text"))
    kept = [f for f in narrow.schema.fields if f.name != "_text"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [out_schema])
    width = len(kept)

    def run(batches):
        for b in slices(batches, rows, size):
            got = rows_of(texts(b.column(width)))
            arrays = [b.column(i) for i in range(width)] + [v if isinstance(v, pa.Array) else pa.array(v) for v in got.values()]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in kept] + list(got))

    return narrow.mapInArrow(run, schema)
