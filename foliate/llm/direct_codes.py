"""Token-id files of directly addressable codes: any token can be read without decoding those before it.

Ids are split into chunks of 8 bits, lowest first. Level k holds the k-th chunk of every id that has one, a bitmap that tells
which of these ids go on to level k + 1, and a directory of the set bits before each 512-bit block. The chunk of token i at
level k + 1 stands at rank(i), the set bits before i at level k; so a token takes one step per level.

A file is a Parquet table of shards (one binary each, some SHARD_TOKENS tokens, whole documents), so that Spark commits it
atomically, a retried task leaves no half-written file, and any store that Spark writes to will do.

Nulls: a null text counts as empty; rows with a null doc_id come first. Rows with equal doc_id are kept, in the order of their
texts. An empty table gives an empty file. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliate.llm import common, tokens

BLOCK = 512
SHARD_TOKENS = 1 << 20
#: Bytes of text that one file of the table takes, at least, and what a row counts besides its text.
FILE_BYTES, ROW_BYTES = 4 << 20, 16
_HEAD = struct.Struct("<4sQQQI")  # magic, tokens, documents, tokens of the partition before, levels
_LEVEL = struct.Struct("<Q")


def pack(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of (chunks, bitmap bytes, directory). The last level's bitmap is all zeros and left out."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        chunks = (rest & 0xFF).astype(np.uint8)
        if not more.any():
            return [*levels, (chunks, np.zeros(0, np.uint8), np.zeros(0, np.uint32))]
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint32)
        levels.append((chunks, bits, np.concatenate([[0], np.cumsum(ones)[:-1]]).astype(np.uint32)))
        rest = rest[more] >> np.uint32(8)


def write_shard(docs: list[int | None], counts: np.ndarray, ids: np.ndarray, before: int) -> bytes:
    """A shard: header, doc ids with validity, counts, then the levels."""
    levels = pack(ids)
    out = [_HEAD.pack(b"DAC1", len(ids), len(docs), before, len(levels))]
    out += [np.array([d is not None for d in docs], np.uint8).tobytes(), np.array([d or 0 for d in docs], np.int64).tobytes(), counts.astype(np.int64).tobytes()]
    for chunks, bits, directory in levels:
        out += [_LEVEL.pack(len(chunks)), chunks.tobytes(), _LEVEL.pack(len(bits)), bits.tobytes(), directory.tobytes()]
    return b"".join(out)


class Shard:
    """A shard read back; token(i) and slice(i, j) touch only what they need of each level."""

    def __init__(self, blob: bytes):
        magic, self.tokens, n, self.before, levels = _HEAD.unpack_from(blob)
        if magic != b"DAC1":
            raise ValueError("not a shard of directly addressable codes")
        at = _HEAD.size
        valid = np.frombuffer(blob, np.uint8, n, at)
        ids = np.frombuffer(blob, np.int64, n, at + n)
        self.docs = [int(d) if v else None for d, v in zip(ids, valid, strict=True)]
        self.counts = np.frombuffer(blob, np.int64, n, at + 9 * n)
        at += 17 * n
        self.levels = []
        for _ in range(levels):
            (k,) = _LEVEL.unpack_from(blob, at)
            chunks = np.frombuffer(blob, np.uint8, k, at + 8)
            at += 8 + k
            (b,) = _LEVEL.unpack_from(blob, at)
            bits = np.frombuffer(blob, np.uint8, b, at + 8)
            at += 8 + b
            d = -(-k // BLOCK) if b else 0
            self.levels.append((chunks, bits, np.frombuffer(blob, np.uint32, d, at)))
            at += 4 * d

    @staticmethod
    def _rank(bits: np.ndarray, directory: np.ndarray, i: int) -> int:
        """Set bits before i."""
        block = i // BLOCK
        if block >= len(directory):
            block = len(directory) - 1
        part = bits[block * BLOCK // 8 : -(-i // 8)]
        ones = np.unpackbits(part, bitorder="little")[: i - block * BLOCK]
        return int(directory[block]) + int(ones.sum())

    def slice(self, i: int, j: int) -> np.ndarray:
        """Tokens i to j."""
        out, where, shift = np.zeros(j - i, np.uint32), None, 0
        for chunks, bits, directory in self.levels:
            part = chunks[i:j].astype(np.uint32) << np.uint32(shift)
            if where is None:
                out |= part
            else:
                out[where] |= part
            if not len(bits) or i == j:
                break
            more = np.unpackbits(bits[i // 8 : -(-j // 8)], bitorder="little")[i % 8 : i % 8 + j - i].astype(bool)
            where = np.flatnonzero(more) if where is None else where[more]
            i = self._rank(bits, directory, i)
            j, shift = i + int(more.sum()), shift + 8
        return out

    def token(self, i: int) -> int:
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        return int(self.slice(i, i + 1)[0])

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, start in the partition, ids) of each document."""
        at, ids = 0, self.slice(0, self.tokens)
        for d, n in zip(self.docs, self.counts.tolist(), strict=True):
            yield d, self.before + at, ids[at : at + n]
            at += n


def files(docs: DataFrame) -> int:
    """The number of files, at most, for docs(text): one for each FILE_BYTES, but two tasks a core, so that no core waits."""
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_BYTES).cast("long")).alias("n")).first()["n"] or 0
    return max(2 * docs.sparkSession.sparkContext.defaultParallelism, size // FILE_BYTES)


def write(docs: DataFrame, path: str, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode docs(doc_id, text) and write the file at path, in ascending doc_id order.

    A task takes several range partitions where these are small, so that the table has few files however many partitions there are.
    They may come in any order: part is the partition's number, and no shard holds rows of two.
    """
    common.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, before = -1, 0, 0
        ids, held, counts, size = [], [], [], 0

        def flush() -> pa.RecordBatch:
            blob = write_shard(held, np.array(counts, np.int64), np.frombuffer(b"".join(ids), np.uint32), before)
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "n_tokens": pa.array([size], pa.int64()), "payload": pa.array([blob], pa.binary())}
            )

        for batch in batches:
            for p, d, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if p != part:
                    if held:
                        yield flush()
                    part, shard, before, size = p, 0, 0, 0
                    ids, held, counts = [], [], []
                one = tokens.with_end(t, tokenizer)
                ids.append(one)
                held.append(d)
                counts.append(len(one) // 4)
                size += len(one) // 4
                if size >= shard_tokens:
                    yield flush()
                    before, shard, size = before + size, shard + 1, 0
                    ids, held, counts = [], [], []
        if held:
            yield flush()

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").select(F.spark_partition_id().alias("part"), "doc_id", "text")
    ordered.coalesce(files(docs)).mapInArrow(run, "part int, shard int, n_tokens long, payload binary").write.parquet(path)


def read(spark: SparkSession, path: str, fn=None, schema: str = "doc_id long, start long, n_tokens long, ids array<long>") -> DataFrame:
    """Documents of a file: by default their ids, else fn(doc_id, start, ids) -> tuple of schema. start counts all ids before."""
    common.ship(spark)
    file = spark.read.parquet(path)
    totals = sorted((r["part"], r["n"]) for r in file.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # one row per written partition
    starts, at = {}, 0
    for part, n in totals:
        starts[part], at = at, at + n
    fields = common.to_arrow_schema(spark, schema)
    make = fn or (lambda d, start, ids: (d, start, len(ids), ids.tolist()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = [make(d, starts[part] + s, ids) for d, s, ids in Shard(blob.as_py()).documents()]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)

    return file.select("part", "payload").mapInArrow(run, schema)


def tokens_at(spark: SparkSession, path: str, positions: DataFrame) -> DataFrame:
    """position, token for positions(position) of a file: each is looked up in its own shard; no shard is decoded, and shards without a position are not read.

    Positions below 0 or beyond the file, and nulls, have no row; equal ones have a row each.
    """
    common.ship(spark)
    file = spark.read.parquet(path)
    sizes = file.select("part", "shard", "n_tokens")
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # one row per written partition
    ends = np.cumsum([r["n"] for r in totals]) if totals else np.zeros(0, np.int64)
    parts = [r["part"] for r in totals]

    def place(batch: pa.RecordBatch):
        at = batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)
        at = at[(at >= 0) & (at < (ends[-1] if len(ends) else 0))]
        k = np.searchsorted(ends, at, "right")
        starts = np.concatenate([[0], ends])
        yield {"position": at, "part": [parts[i] for i in k], "at": at - starts[k]}

    placed = common.arrow_map(positions.select(F.col("position").cast("long").alias("position")), place, "position long, part int, at long")
    before = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = sizes.withColumn("before", before)
    found = placed.join(spans, "part").where("at >= before AND at < before + n_tokens")
    wanted = found.groupBy("part", "shard").agg(F.collect_list(F.struct("position", (F.col("at") - F.col("before")).alias("at"))).alias("wanted"))
    # the keys of the wanted shards prune the scan where they are few
    blobs = common.only(file.select("part", "shard", "payload"), common.materialise(wanted.select("part", "shard")), ["part", "shard"])

    def look(batch: pa.RecordBatch):
        position, token = [], []
        for blob, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shard = Shard(blob)
            for w in wanted:
                position.append(w["position"])
                token.append(shard.token(w["at"]))
        yield {"position": position, "token": token}

    return common.arrow_map(blobs.join(wanted, ["part", "shard"]).select("payload", "wanted"), look, "position long, token long")


def digests(docs: DataFrame, path: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write the file, read it back and return doc_id, start, n_tokens, ids_crc32 of each document."""
    spark = docs.sparkSession
    path = path or common.new_path(spark, "direct-codes")
    write(docs, path, tokenizer)
    return read(spark, path, lambda d, start, ids: (d, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op9_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
