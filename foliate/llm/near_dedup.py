"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document is the set of its distinct 5-word shingles (A-Z in lower case). Its sketch has SIZE coordinates, filled in rounds
(Dahlgaard, Knudsen and Thorup, 2017): in each of the first SIZE rounds every shingle is hashed to one coordinate and keeps
the smallest value there, in the next SIZE rounds round i fills coordinate i; it ends when all are filled, so that every coordinate of
every document has a value and the estimate is concentrated. Bands of ROWS coordinates make the candidate buckets: two sets with
similarity 0.85 miss each other in all bands with probability under 1e-8, with 0.8 under 4e-6.

No bucket is expanded into pairs. Equal sets are one class from the start. In each bucket members are compared with one hub,
then those still apart with another. What is left, members of one bucket in different components, is compared exactly by
prefixes of the sets in order of rising frequency, with the length and position filters of set-similarity joins, which lose no
pair. All links are confirmed on the full sets. Components then give each document's group. Sets, buckets and shingles go through one
exchange each, hot ones dealt to several tasks.

Nulls: a null text, or one without words, is an empty set, linked with nothing. Rows with a null doc_id are kept and linked with
nothing. Rows with equal doc_id are one document with several versions: one group. An empty table gives no rows. Columns
besides doc_id and text are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliate.llm import common
from foliate.llm.components import components

SHINGLE = 5
#: Links are sets with share * union <= 100 * intersection; this is op4's share.
SHARE = 85
ROWS, BANDS = 5, 32
SIZE = ROWS * BANDS
#: Rounds of comparing a bucket's members with one hub.
HUBS = 2


def shingles(texts: list[bytes | None], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text as 64-bit hashes, sorted within it, one text after the other; and how many each has."""
    words = common.Words(texts, lower=True)
    n = len(words.counts)
    # A text's shingles start at each word that has k - 1 more after it, or, in texts of fewer words, at the first.
    each = np.where(words.counts >= k, words.counts - k + 1, np.minimum(words.counts, 1))
    doc = np.repeat(np.arange(n), each)
    first = words.starts[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each))
    length = np.minimum(words.counts, k)[doc]
    keys = common.mix(common.Ranges(words.hashes).of(first, first + length) ^ (length.astype(np.uint64) << np.uint64(56)))
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
    return keys[new], np.bincount(doc[new], minlength=n)


@lru_cache(1)
def _seeds(size: int) -> np.ndarray:
    return common.mix(np.arange(1, 2 * size + 1, dtype=np.uint64) * np.uint64(common.BASES[1]))


def sketches(keys: np.ndarray, counts: np.ndarray, size: int = SIZE) -> np.ndarray:
    """A row of size coordinates per set (all ones for an empty set)."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full((len(counts), size), empty, np.uint64)
    flat, seeds = out.reshape(-1), _seeds(size)
    doc = np.repeat(np.arange(len(counts)), counts)
    for i in range(2 * size):
        h = common.mix(keys ^ seeds[i])
        at = (h % np.uint64(size)).astype(np.int64) if i < size else i - size
        # the round in the upper bits: values of earlier rounds are smaller
        np.minimum.at(flat, doc * size + at, (np.uint64(i) << np.uint64(54)) | (h >> np.uint64(10)))
        open_ = (out == empty).any(axis=1)
        mine = open_[doc]
        if not mine.any():
            break
        keys, doc = keys[mine], doc[mine]
    return out


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key per band: equal where the band's number and coordinates are."""
    n, size = sketch.shape
    parts = sketch.reshape(n, size // rows, rows)
    key = np.broadcast_to(np.arange(1, size // rows + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        key = common.mix(key * np.uint64(common.BASES[0]) ^ parts[:, :, k])
    return key


def _sign(batch: pa.RecordBatch):
    keys, counts = shingles(common.texts(batch.column(1)))
    have = counts > 0
    doc = np.repeat(np.arange(len(counts)), counts)
    f1, f2 = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
    np.add.at(f1, doc, common.mix(keys ^ np.uint64(0x5555555555555555)))
    np.add.at(f2, doc, common.mix(keys ^ np.uint64(0x3333333333333333)))
    found = bands(sketches(keys, counts[have]))
    yield {
        "doc_id": batch.column(0), "rid": batch.column(2), "n_shingles": counts, "f1": common.signed(f1), "f2": common.signed(f2),
        "bands": common.lists(common.signed(found.reshape(-1)), np.where(have, found.shape[1], 0)),
    }


def linked(a: list[bytes | None], b: list[bytes | None], share: int = SHARE) -> np.ndarray:
    """Which pairs of texts have 100 * intersection >= share * union, by their full shingle sets."""
    ka, na = shingles(a)
    kb, nb = shingles(b)
    ea, eb = np.cumsum(na), np.cumsum(nb)
    out = np.zeros(len(a), bool)
    for i in range(len(a)):
        x, y = ka[ea[i] - na[i] : ea[i]], kb[eb[i] - nb[i] : eb[i]]
        if min(len(x), len(y)) * 100 >= share * max(len(x), len(y)) > 0:
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            both = int((y[at] == x).sum())
            out[i] = 100 * both >= share * (len(x) + len(y) - both)
    return out


def _confirm(pairs: DataFrame, docs: DataFrame, share: int) -> DataFrame:
    """The pairs (a, b) of doc_ids that are linked."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    own = common.only(docs.select("doc_id", "text"), common.materialise(ids), "doc_id")
    both = pairs.join(own.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(own.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")

    def run(batch: pa.RecordBatch):
        good = np.flatnonzero(linked(common.texts(batch.column(2)), common.texts(batch.column(3)), share))
        yield {"a": batch.column(0).take(pa.array(good)), "b": batch.column(1).take(pa.array(good))}

    return common.materialise(common.arrow_map(both.select("a", "b", "ta", "tb"), run, "a long, b long"))


def _apart(members: DataFrame, labels: DataFrame, hot: DataFrame | None, **more: Column) -> DataFrame:
    """Members(key, doc_id, rid) of buckets that hold two components or more, with their component (itself where a member has no link)."""
    labelled = members.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", *common.KEY, F.coalesce("component", "doc_id").alias("component"))
    return common.grouped(labelled, ["key"], hot, lo=F.min("component"), hi=F.max("component"), **more).where("lo <> hi")


def _rest(open_: DataFrame, docs: DataFrame, n: int, share: int) -> DataFrame:
    """Pairs of different components among open_(rep, component) that can be linked, by prefixes, lengths and positions."""

    def run(batch: pa.RecordBatch):
        keys, counts = shingles(common.texts(batch.column(2)))
        at = pa.array(np.repeat(np.arange(len(counts)), counts))
        yield {
            "doc_id": batch.column(0).take(at), "component": batch.column(1).take(at), "rid": batch.column(3).take(at),
            "n": np.repeat(counts, counts), "shingle": common.signed(keys),
        }

    def sets(of: DataFrame) -> DataFrame:
        """The shingles of each version of the documents, once."""
        texts = common.only(docs.select(*common.KEY, "text"), of.select("doc_id"), "doc_id")
        rows = of.join(texts, "doc_id").dropDuplicates(common.KEY).select("doc_id", "component", "text", "rid")
        return common.arrow_map(rows, run, "doc_id long, component long, rid long, n long, shingle long")

    open_ = open_.withColumnRenamed("rep", "doc_id")
    some = common.sampled(open_.withColumn("rid", F.lit(0)), n).drop("rid")
    hot = common.hot_keys(sets(some), ["shingle"])
    often = common.grouped(sets(open_), ["shingle"], hot, df=F.count("*")).withColumnRenamed("doc_id", "rep")
    order = Window.partitionBy("rep", "rid").orderBy("df", "shingle")
    # A partner of a set of n has at least share % of n in common with it, one that is as large or larger at least 2 share / (100 + share).
    probe = F.col("n") - F.ceil(F.lit(share) * F.col("n") / 100) + 1
    index = F.col("n") - F.ceil(F.lit(2 * share) * F.col("n") / (100 + share)) + 1
    prefix = often.withColumn("at", F.row_number().over(order) - 1).where(F.col("at") < probe).withColumn("indexed", F.col("at") < index)
    prefix = common.materialise(prefix.where("df > 1").select("shingle", "rep", "component", "n", "at", "indexed"))
    x, y = prefix.where("indexed").alias("x"), prefix.alias("y")
    on = "x.shingle = y.shingle AND x.component <> y.component AND (x.n < y.n OR x.n = y.n AND x.rep < y.rep)"
    on += f" AND 100 * x.n >= {share} * y.n AND {100 + share} * least(x.n - x.at, y.n - y.at) >= {share} * (x.n + y.n)"
    return x.join(y, F.expr(on)).select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()


def groups(docs: DataFrame, share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each document, by links of share % or more."""
    docs = common.keyed(docs.select("doc_id", "text"))
    n, same = docs.count(), ["n_shingles", "f1", "f2"]

    def signatures(df: DataFrame) -> DataFrame:
        return common.arrow_map(df.select("doc_id", "text", "rid"), _sign, "doc_id long, rid long, n_shingles long, f1 long, f2 long, bands array<long>")

    hot = common.hot_keys(signatures(common.sampled(docs, n)), same)
    named = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("doc_id"))
    signed = common.grouped(signatures(docs), same, hot, rep=F.min(named))
    # the first document of equal sets stands for them
    signed = common.materialise(
        signed.select(*common.KEY, "n_shingles", named.isNotNull().alias("has"), "rep", F.when(F.col("doc_id") == F.col("rep"), F.col("bands")).alias("bands"))
    )
    slots = signed.select(*common.KEY, F.explode("bands").alias("key"))
    hot = common.hot_keys(common.sampled(slots, n), ["key"])
    met = common.grouped(slots, ["key"], hot, store=False, hub=F.min("doc_id"), last=F.max("doc_id"))
    members = common.materialise(met.where("hub <> last").select("key", *common.KEY, "hub"))
    pairs = members.where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = _confirm(common.materialise(pairs), docs, share)
    labels = common.materialise(components(links), n)
    for k in range(1, HUBS):
        now = _apart(members, labels, hot, hub=F.min_by(F.struct("doc_id", "component"), F.xxhash64("doc_id", F.lit(k))))
        pairs = now.where("doc_id <> hub.doc_id AND component <> hub.component").select(
            F.least("doc_id", "hub.doc_id").alias("a"), F.greatest("doc_id", "hub.doc_id").alias("b"),
        ).distinct()
        links = links.unionByName(_confirm(common.materialise(pairs), docs, share))
        labels = common.materialise(components(links), n)
    open_ = common.materialise(_apart(members, labels, hot).select(F.col("doc_id").alias("rep"), "component").distinct(), n)
    found = _confirm(common.materialise(_rest(open_, docs, n, share)), docs, share)
    # Equal sets, and rows that share a doc_id, which are versions of one document.
    own = signed.where("has AND doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    labels = common.materialise(components(links.unionByName(found).unionByName(own)), n)
    out = signed.join(labels, signed["doc_id"] == labels["node"], "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
