"""What the operators of this package share: shipping code, materialising tables, Arrow maps, word hashes."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliate.session import ship

#: Bytes of text that one step of a Python worker holds at once.
CHUNK_BYTES = 1 << 20

#: Rows that Spark sends to a worker at once: whole texts, so that a batch of them fits beside the executor's heap.
BATCH_ROWS = 1000

#: Rows up to which a table of ids may be broadcast (8 bytes each, so 4 MB); larger tables are joined by a shuffle.
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset and everything runs on one machine
    (a local master, as in tests), a folder there."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not getattr(sc, "_foliate_dir", None):
        sc._foliate_dir = "file://" + tempfile.mkdtemp(prefix="foliate-checkpoints")
    return sc._foliate_dir


#: Rows of a small table that one file takes, at least.
FILE_ROWS = 20_000


def materialise(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Run df once and cut its lineage with a reliable checkpoint, so that a lost executor costs no recomputation.

    rows: about how many small rows there are at most; they go to one file for each FILE_ROWS of them and not to one for each task.
    """
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return (df if rows is None else df.coalesce(max(1, rows // FILE_ROWS))).checkpoint()


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for a table of this run; cleanup() deletes it, at the latest when the driver's interpreter ends."""
    sc = spark.sparkContext
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not hasattr(sc, "_foliate_paths"):
        sc._foliate_paths = []
        atexit.register(lambda: cleanup(spark) if sc._jsc is not None else None)
    sc._foliate_paths.append(path)
    return path


def cleanup(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Delete the tables that this run has written to the shared folder (those after the first `since`), but those to keep.

    Results that are still to be computed from them fail afterwards.
    """
    sc = spark.sparkContext
    paths = getattr(sc, "_foliate_paths", [])
    for path in paths[since:]:
        if path not in keep:
            where = sc._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
    sc._foliate_paths = paths[:since] + [p for p in paths[since:] if p in keep]


def written(spark: SparkSession) -> int:
    """How many tables of this run there are in the shared folder."""
    return len(getattr(spark.sparkContext, "_foliate_paths", []))


def stored(df: DataFrame) -> DataFrame:
    """As materialise(), as a compressed Parquet table in the shared folder: for large tables."""
    path = new_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str, size: int = CHUNK_BYTES) -> DataFrame:
    """fn over slices of at most about size bytes; fn yields dicts of columns in the order of schema."""
    spark = df.sparkSession
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    fields = to_arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, size):
                for cols in fn(part):
                    yield pa.RecordBatch.from_arrays([as_array(cols[f.name], f.type) for f in fields], schema=fields)
        release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give memory that is free back to the system: workers live on beside the executor's heap, for other operators too."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc(), "malloc_trim", None)
    if trim:
        trim(0)


@lru_cache(1)
def _libc():
    import ctypes

    return ctypes.CDLL(None)


def as_array(values, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) and values.type == kind else values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def to_arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema as convert
    from pyspark.sql.types import StructType

    return convert(StructType.fromDDL(ddl))


def slices(batch: pa.RecordBatch, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch, each of one row or at most about size bytes."""
    if batch.nbytes <= size:
        if batch.num_rows:
            yield batch
        return
    sizes = np.zeros(batch.num_rows, np.int64)
    for col in batch.columns:
        if pa.types.is_string(col.type) or pa.types.is_binary(col.type) or pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
            import pyarrow.compute as pc

            sizes += pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = 0
    ends = np.cumsum(sizes)
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, base + size, "right")))
        yield batch.slice(at, end - at)
        at = end


def texts(col: pa.Array, null: bytes | None = b"") -> list[bytes | None]:
    """A text column as UTF-8 bytes; nulls become the given value."""
    out = col.cast(pa.binary()).to_pylist()
    return [null if x is None else x for x in out] if null is not None and col.null_count else out


_hash = xxhash.xxh3_64_intdigest


class Words:
    """Word hashes of several texts, one after the other. A word is a run of bytes other than 0x20 and 0x09-0x0D."""

    def __init__(self, texts: list[bytes | None], lower: bool = False):
        parts, counts = [], []
        for t in texts:
            w = (t.lower() if lower else t).split() if t else []
            counts.append(len(w))
            parts.append(np.fromiter(map(_hash, w), np.uint64, len(w)))
        self.counts = np.array(counts, np.int64)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        self.hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: Powers that a worker remembers; those for longer sequences are made each time.
KEPT_POWERS = 1 << 20


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of a base from 0 to n, and those of its inverse."""
    found = _POWERS.get(base)
    if found is None or len(found[0]) <= n:
        size = 1 << max(18, int(n).bit_length())
        ups, downs = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        ups[0] = downs[0] = 1
        found = np.cumprod(ups, dtype=np.uint64), np.cumprod(downs, dtype=np.uint64)
        if size <= KEPT_POWERS:
            _POWERS[base] = found
    return found


BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Ranges:
    """Hashes of any ranges of a sequence of word hashes, in constant time each (polynomials modulo 2**64)."""

    def __init__(self, hashes: np.ndarray, base: int = BASES[0]):
        n = len(hashes)
        self.ups, self.downs = _powers(base, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * self.ups[:n], out=self.sums[1:], dtype=np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Depends on the words between start and end alone (of as many words), not on where they stand."""
        return (self.sums[end] - self.sums[start]) * self.downs[start]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """An array of lists: values one after the other, counts of them in each."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def only(df: DataFrame, ids: DataFrame, key: str | list[str]) -> DataFrame:
    """The rows of df whose key is in ids: ids are counted first and broadcast if few, else both sides are shuffled."""
    few = ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return df.join(F.broadcast(ids) if few else ids.hint("merge"), key, "left_semi")


def divided(df: DataFrame, rows: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of df with the columns of rows that have the same key, the other rows of df as they are).

    rows has a row per key at most. Where its keys are few, they are counted, broadcast, and only the rows that have one are shuffled;
    else both sides are shuffled once.
    """
    ids = rows.select(*key)
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(ids), key, "left_semi").join(rows, key), df.join(F.broadcast(ids), key, "left_anti")
    joined = df.join(rows.withColumn("__found", F.lit(True)), key, "left")
    return joined.where("__found").drop("__found"), joined.where("__found IS NULL").select(*df.columns)


# --- rows and their documents ---------------------------------------------------

KEY = ["doc_id", "rid"]


def keyed(docs: DataFrame) -> DataFrame:
    """docs with rid, which tells rows that share a doc_id apart: 0 where a doc_id has one row, else a hash of the text.

    Shuffled tables carry rid, so it costs nothing where ids are unique, as they should be.
    """
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    again = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    n = again.limit(BROADCAST_ROWS + 1).count()
    if not n:
        return docs.withColumn("rid", F.lit(0).cast("long"))
    if n > BROADCAST_ROWS:
        return docs.withColumn("rid", F.xxhash64("text"))
    again = materialise(again, n)
    marked = docs.join(F.broadcast(again.withColumn("__again", F.lit(True))), "doc_id", "left")
    return marked.withColumn("rid", F.when(F.col("__again"), F.xxhash64("text")).otherwise(F.lit(0)).cast("long")).drop("__again")


# --- groups with hot keys ---------------------------------------------------------

#: Documents that are looked at for hot keys, about; a key is hot if it has HOT_ROWS of their rows, so in about 1 % of documents.
HOT_SAMPLE, HOT_ROWS = 5000, 50
#: At most so many hot keys are told apart (the hottest), and each is dealt to so many tasks.
HOT_KEYS, SALTS = 10_000, 64


def sampled(docs: DataFrame, n: int) -> DataFrame:
    """About HOT_SAMPLE of n documents, by their KEY."""
    return docs.where(F.pmod(F.xxhash64(*KEY), F.lit(max(1, n // HOT_SAMPLE))) == 0)


def hot_keys(sample: DataFrame, key: list[str]) -> DataFrame | None:
    """The keys that many rows of the sample share; None if there are none. It decides where rows go, not what comes out."""
    counts = sample.groupBy(*key).agg(F.count("*").alias("__n")).where(F.col("__n") >= HOT_ROWS)
    hot = materialise(counts.orderBy(F.desc("__n")).limit(HOT_KEYS).select(*key))
    return hot if hot.limit(1).count() else None


def grouped(
    rows: DataFrame, key: list[str], hot: DataFrame | None, store: bool = True, inner: list[str] | None = None,
    inside: dict[str, Column] | None = None, **aggregates: Column,
) -> DataFrame:
    """rows with aggregates of the group of its key, and with those of `inside` over its key and inner, from a single exchange of the rows.

    Most groups are a row or two, which nothing before the exchange would make less. Rows of hot keys are dealt to SALTS tasks each;
    their aggregates are made with partial aggregation beside that, a row per hot key, and broadcast. store: write the rows to a
    table first in this case, as they are read twice.
    """
    levels = [(key, aggregates)] + ([([*key, *inner], inside)] if inner else [])
    names = [c for _, wanted in levels for c in wanted]
    salt = []
    out = rows
    if hot is not None:
        rows = stored(rows) if store else rows
        marked = rows.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), key, "left")
        out = marked
        for by, wanted in levels:
            # all rows of other keys make one group, which has no key and meets nothing
            mine = [F.when(F.col("__hot"), F.col(c)).alias(c) for c in by]
            whole = materialise(marked.groupBy(*mine).agg(*[a.alias(f"__{c}") for c, a in wanted.items()]), HOT_KEYS)
            few = whole.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
            out = out.join(F.broadcast(whole) if few else whole, by, "left")
        salt = ["__salt"]
        out = out.withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*KEY), F.lit(SALTS))).otherwise(F.lit(0)))
    for by, wanted in levels:
        w = Window.partitionBy(*by, *salt)
        out = out.select("*", *[a.over(w).alias(c) for c, a in wanted.items()])
    if hot is not None:
        out = out.withColumns({c: F.when(F.col("__hot"), F.col(f"__{c}")).otherwise(F.col(c)) for c in names})
    return out.select(*rows.columns, *names)
