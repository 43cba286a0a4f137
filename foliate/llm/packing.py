"""Packing of documents into fixed-length sequences by cutting-stock column generation.

A document's ids are cut into full pieces of the sequence length and one remainder. Remainders fall into size classes of a
fixed length histogram (exact up to 64 tokens, then 32 per octave, so a class is at most 1/32 wider than its members). A
linear program over patterns (how many pieces of each class share a sequence) minimises the number of sequences; its columns
come from a knapsack dynamic program that prices patterns by the dual values. Pattern counts are rounded down, what is left is
packed greedily, and the pieces, ranked within their class (longest first, then by doc_id, start and checksum), are dealt to the pattern slots.

The plan depends on the histogram alone: its size, and the driver's work, are bounded by the number of classes whatever the
number of documents. Pieces never leave the executors.

Nulls: a null text is an empty document (one id, the end id); rows with a null doc_id are packed like others. Repeated rows
are packed each on its own. An empty table gives no rows. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliate.llm import common, tokens

SEQUENCE = 4096
PER_OCTAVE = 32
#: Pieces of one class that one ranking task takes, about.
RANKED = 50_000
#: The linear program stops this close to its bound.
GAP = 2e-3
#: Columns per class that it keeps at hand.
POOL = 4
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, size int"


def size_classes(capacity: int = SEQUENCE, per_octave: int = PER_OCTAVE) -> np.ndarray:
    """Upper bounds of the classes, ascending; the last is the capacity."""
    out, at, step = [], 0, 1
    while at < capacity:
        for _ in range(2 * per_octave if step == 1 else per_octave):
            at += step
            out.append(min(at, capacity))
            if at >= capacity:
                break
        step *= 2
    return np.array(out, np.int64)


def _prices(sizes: np.ndarray, value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """best[c]: the most value that fits into c; last[c]: the class that this takes at c, or -1 (a gap of one)."""
    good = np.flatnonzero(value > 1e-12)
    s, v = sizes[good], value[good]
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(s, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if k := fits[c]:
            got = best[c - s[:k]] + v[:k]
            i = int(got.argmax())
            if got[i] > best[c] + 1e-12:
                best[c], last[c] = got[i], good[i]
    return best, last


def _column(i: int, last: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The best pattern that holds class i, read off the dynamic program."""
    out, c = np.zeros(len(sizes)), int(capacity - sizes[i])
    out[i] = 1
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            out[last[c]] += 1
            c -= int(sizes[last[c]])
    return out


def patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int = SEQUENCE, gap: float = GAP, rounds: int = 80) -> list[tuple[np.ndarray, int]]:
    """Patterns (pieces of each class) and how often each is used; they hold each class exactly demand times.

    Prices are smoothed between the dual values and the prices of the best lower bound so far, which start at each class's
    share of the capacity. It ends within gap of the bound, or after so many rounds with what it has then.
    """
    sizes, demand = np.asarray(sizes, np.int64), np.asarray(demand, np.int64)
    n = len(sizes)
    if not n:
        return []
    fit = (capacity // sizes).astype(float)
    pool, basis, inverse, x = np.diag(fit), np.diag(fit).copy(), np.diag(1 / fit), demand / fit
    known = {c.tobytes() for c in pool.T}
    centre = sizes / capacity
    bound = float(centre @ demand)
    for k in range(rounds):
        for _ in range(50 * n):  # simplex steps over the columns that are known
            dual = inverse.sum(axis=0)
            gain = dual @ pool
            j = int(gain.argmax())
            if gain[j] <= 1 + 1e-9:
                break
            step = inverse @ pool[:, j]
            ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
            row = int(ratio.argmin())
            if not np.isfinite(ratio[row]):
                break
            x = np.maximum(x - ratio[row] * step, 0)
            x[row] = ratio[row]
            basis[:, row] = pool[:, j]
            inverse[row] /= step[row]
            step[row] = 0
            inverse -= np.outer(step, inverse[row])
        if x.sum() <= bound * (1 + gap):
            break
        dual, new = inverse.sum(axis=0), []
        for share in (0.8, 0.4, 0.0):
            price = np.maximum(share * centre + (1 - share) * dual, 0)
            best, last = _prices(sizes, price, capacity)
            if (now := float(price @ demand) / max(1.0, best[capacity])) > bound:
                bound, centre = now, price / max(1.0, best[capacity])
            for i in range(n):
                one = _column(i, last, sizes, capacity)
                if dual @ one > 1 + 1e-9 and one.tobytes() not in known:
                    known.add(one.tobytes())
                    new.append(one)
            if new:
                break
        if not new:
            break
        pool = np.column_stack([pool, *new])
        if pool.shape[1] > POOL * n:  # columns that the prices like least go; the program can find them again
            keep = np.argsort(-(dual @ pool))[: POOL * n]
            known -= {pool[:, j].tobytes() for j in set(range(pool.shape[1])) - set(keep.tolist())}
            pool = pool[:, keep]
    left, plan = demand.copy(), []
    for column, k in sorted(zip(basis.T, np.floor(x + 1e-9).astype(np.int64), strict=True), key=lambda p: -p[1]):
        a = np.rint(column).astype(np.int64)
        k = min(int(k), int((left[a > 0] // a[a > 0]).min()))
        if k > 0:
            plan.append((a, k))
            left -= k * a
    while left.any():  # largest first, each pattern as often as it can be
        a, room = np.zeros(n, np.int64), capacity
        for i in range(n - 1, -1, -1):
            a[i] = min(left[i], room // sizes[i])
            room -= a[i] * sizes[i]
        k = int((left[a > 0] // a[a > 0]).min())
        plan.append((a, k))
        left -= k * a
    return plan


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = SEQUENCE) -> DataFrame:
    """Cut each document's ids into pieces of at most capacity, with the upper bound of the piece's class."""
    bounds = size_classes(capacity)

    def cut(batch: pa.RecordBatch):
        rows = []
        for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids = tokens.with_end(t, tokenizer)
            n = len(ids) // 4
            for s in range(0, n, capacity):
                k = min(capacity, n - s)
                rows.append((d, s, k, zlib.crc32(ids[4 * s : 4 * (s + k)]), n, int(bounds[np.searchsorted(bounds, k)])))
        yield dict(zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens", "size"), map(list, zip(*rows, strict=True)), strict=True))

    return common.arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), cut, PIECES)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = SEQUENCE) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    cut = common.materialise(pieces(docs, tokenizer, capacity))
    histogram = sorted((r["size"], r["n"]) for r in cut.groupBy("size").agg(F.count("*").alias("n")).collect())  # a row per size class
    sizes, demand = np.array([s for s, _ in histogram], np.int64), np.array([n for _, n in histogram], np.int64)
    segments, sequences, dealt = [], 0, dict.fromkeys(sizes.tolist(), 0)
    for a, k in patterns(sizes, demand, capacity):
        for i in np.flatnonzero(a):
            s, each = int(sizes[i]), int(a[i])
            segments.append((s, dealt[s], dealt[s] + each * k, each, sequences))
            dealt[s] += each * k
        sequences += k
    plan = spark.createDataFrame(segments, "size int, rank_from long, rank_to long, each long, sequence_from long")
    buckets = max(1, -(-int(demand.sum()) // RANKED)) if len(demand) else 1
    cut = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int"))
    before = cut.groupBy("size", "bucket").agg(F.count("*").alias("n"))
    before = before.select("size", "bucket", (F.sum("n").over(Window.partitionBy("size").orderBy("bucket")) - F.col("n")).alias("before"))
    order = Window.partitionBy("size", "bucket").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32")
    ranked = cut.withColumn("row", F.row_number().over(order) - 1).join(before, ["size", "bucket"]).withColumn("rank", F.col("before") + F.col("row"))
    # The plan has a row for each class of each pattern: some thousands at most, whatever the data.
    on = (ranked["size"] == plan["size"]) & (ranked["rank"] >= plan["rank_from"]) & (ranked["rank"] < plan["rank_to"])
    within = F.col("rank") - F.col("rank_from")
    placed = ranked.join(F.broadcast(plan), on).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", ranked["size"].alias("size"),
        (F.col("sequence_from") + F.floor(within / F.col("each"))).cast("long").alias("sequence_id"), (within % F.col("each")).alias("slot"),
    )
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("size"), "slot").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset.alias("offset"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
