"""Removal of long passages that also stand in an earlier document, by fixed-block anchors.

A window is WINDOW consecutive words. A document's words are removed where a window covers them whose words also start in a
document with a smaller doc_id. The reference side of the index is cut into blocks of BLOCK = WINDOW // 2 words that do not overlap, so every
window of a reference document holds a whole block; the other side is probed with every rolling run of BLOCK words. Hits are
extended to the windows around them, and windows that are equal word by word (two 64-bit hashes of all words) make the
maximal exact repeats.

Four steps keep the rolling probes in bounds without losing any. Documents of equal words stand for each other. A prefilter, the
window minimum of the rolling hashes, which equal windows share, tells the regions where a repeat is possible at all; only these are
indexed and probed. A hash goes out once per document, with the first place where it stands, and the others are found again in the text. And
each step groups by hash and takes the smallest doc_id, so no group is expanded into pairs; hot hashes are dealt to several tasks.

Words are runs of characters other than 0x20 and 0x09-0x0D. Nulls: a null text has no words. Rows with a null doc_id are never
removed from and remove nothing. Rows with equal doc_id are judged each on its own; they don't remove each other's words. An
empty table gives no rows. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.llm import common

WINDOW = 50


def _rolling(words: common.Words, k: int, ranges: common.Ranges) -> tuple[np.ndarray, np.ndarray]:
    """Where a run of k words of one text starts, and its hash; runs in order."""
    each = np.maximum(words.counts - k + 1, 0)
    at = np.repeat(words.starts, each) + (np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each))
    return at, common.mix(ranges.of(at, at + k))


def _minima(hashes: np.ndarray, at: np.ndarray, words: common.Words, window: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a window starts, and the least hash of the runs of block words in it."""
    span = window - block + 1
    full = np.full(len(words.hashes) + span, np.uint64(0xFFFFFFFFFFFFFFFF))
    full[at] = hashes
    least, size = full, 1
    while 2 * size <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = span - size
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    each = np.maximum(words.counts - window + 1, 0)
    starts = np.repeat(words.starts, each) + (np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each))
    return starts, least[starts]


def _by_doc(values: np.ndarray, at: np.ndarray, words: common.Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, sorted within it, and how many each has."""
    doc = np.searchsorted(words.ends, at, "right")
    order = np.lexsort((values, doc))
    values, doc = values[order], doc[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (doc[1:] != doc[:-1])
    return values[new], np.bincount(doc[new], minlength=len(words.counts))


def _sign(window: int):
    """n_words, two hashes of all words, the digest of the text if all is kept, and the minima, of each text."""
    block = window // 2

    def run(batch: pa.RecordBatch):
        texts = common.texts(batch.column(1))
        words = common.Words(texts)
        a, b = common.Ranges(words.hashes), common.Ranges(words.hashes, common.BASES[1])
        values, counts = _by_doc(*_minima(*_rolling(words, block, a)[::-1], words, window, block)[::-1], words)
        yield {
            "doc_id": batch.column(0), "rid": batch.column(2), "n_words": words.counts, "f1": common.signed(a.of(words.starts, words.ends)), "f2": common.signed(b.of(words.starts, words.ends)),
            "sha256": [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts], "minima": common.lists(common.signed(values), counts),
        }

    return run


def _inside(words: common.Words, at: np.ndarray, starts: np.ndarray, least: np.ndarray, wanted: list[np.ndarray], window: int) -> np.ndarray:
    """Which rolling runs (starts at) lie in a window (starts) whose minimum is wanted for its text."""
    good = np.zeros(len(starts), bool)
    first, last = np.searchsorted(starts, words.starts), np.searchsorted(starts, words.ends)
    for i, w in enumerate(wanted):
        if last[i] > first[i] and len(w):
            good[first[i] : last[i]] = np.isin(least[first[i] : last[i]], w)
    inside = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(inside, starts[good], 1)
    np.add.at(inside, starts[good] + window - window // 2 + 1, -1)
    return np.cumsum(inside)[at] > 0


def _once(doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """The first of the rows that agree in doc and keys, for rows in order of doc."""
    order = np.lexsort((*keys, doc))
    new = np.ones(len(doc), bool)
    new[1:] = doc[order][1:] != doc[order][:-1]
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return np.sort(order[new])


def _probe(window: int):
    """The blocks of all regions in question (indexed), and the rolling runs of those that an earlier document may have too.

    Each hash once per text, with the first place that has it, as a block if any place does.
    """
    block = window // 2

    def run(batch: pa.RecordBatch):
        words = common.Words(common.texts(batch.column(1)))
        at, hashes = _rolling(words, block, common.Ranges(words.hashes))
        least = _minima(hashes, at, words, window, block)
        offset = at - words.starts[np.searchsorted(words.ends, at, "right")]
        fixed = (offset % block == 0) & _inside(words, at, *least, _arrays(batch.column(2)), window)
        mine = fixed | _inside(words, at, *least, _arrays(batch.column(4)), window)
        at, hashes, offset, fixed = at[mine], hashes[mine], offset[mine], fixed[mine]
        doc = np.searchsorted(words.ends, at, "right")
        # blocks come first among equals, so that a hash that any block has is known as a block
        order = np.lexsort((~fixed, doc))
        kept = order[_once(doc[order], hashes[order])]
        row = pa.array(doc[kept])
        yield {"doc_id": batch.column(0).take(row), "rid": batch.column(3).take(row), "at": offset[kept], "block": fixed[kept], "hash": common.signed(hashes[kept])}

    return run


def _arrays(col: pa.ListArray) -> list[np.ndarray]:
    """A column of lists of integers as arrays of unsigned longs (nulls: empty)."""
    flat, out = col.flatten().cast(pa.int64()).to_numpy(zero_copy_only=False).view(np.uint64), []
    at = 0
    for n in col.value_lengths().fill_null(0).to_pylist():
        out.append(flat[at : at + n])
        at += n
    return out


def _places(words: common.Words, hashes: np.ndarray, at: np.ndarray, told: list[np.ndarray]) -> np.ndarray:
    """Which places (at, in order, with a hash each) have a hash that one of the told places of their text has."""
    out = np.zeros(len(at), bool)
    first, last = np.searchsorted(at, words.starts), np.searchsorted(at, words.ends)
    for i, t in enumerate(told):
        if len(t) and last[i] > first[i]:
            mine = hashes[first[i] : last[i]]
            out[first[i] : last[i]] = np.isin(mine, mine[t.view(np.int64)])
    return out


def _extend(window: int):
    """Windows around hits, with two hashes of all their words; each once per text, with the first place that has it."""
    block = window // 2

    def run(batch: pa.RecordBatch):
        words = common.Words(common.texts(batch.column(1)))
        a, b = common.Ranges(words.hashes), common.Ranges(words.hashes, common.BASES[1])
        at, hashes = _rolling(words, block, a)
        hit = at[_places(words, hashes, at, _arrays(batch.column(2)))]
        doc = np.searchsorted(words.ends, hit, "right")
        near = np.zeros(len(words.hashes) + 1, np.int64)
        lo = np.maximum(hit - (window - block), words.starts[doc])
        hi = np.minimum(hit + 1, np.maximum(words.ends[doc] - window + 1, words.starts[doc]))
        good = lo < hi
        np.add.at(near, lo[good], 1)
        np.add.at(near, hi[good], -1)
        at = np.flatnonzero(np.cumsum(near)[:-1] > 0)
        doc = np.searchsorted(words.ends, at, "right")
        w1, w2 = a.of(at, at + window), b.of(at, at + window)
        kept = _once(doc, w1, w2)
        row = pa.array(doc[kept])
        yield {
            "doc_id": batch.column(0).take(row), "rid": batch.column(3).take(row), "at": at[kept] - words.starts[doc[kept]],
            "w1": common.signed(w1[kept]), "w2": common.signed(w2[kept]),
        }

    return run


_WORD = re.compile(rb"[^ \t-\r]+")


def _cut(window: int, extra: list[str]):
    """The text without the words that the given windows, and those equal to one of them, cover; white space around what is left stays."""

    def run(batch: pa.RecordBatch):
        texts = common.texts(batch.column(0))
        words = common.Words(texts)
        windows, hashes = _rolling(words, window, common.Ranges(words.hashes))
        windows = windows[_places(words, hashes, windows, _arrays(batch.column(1)))]
        covered = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(covered, windows, 1)
        np.add.at(covered, windows + window, -1)
        covered = np.cumsum(covered)[:-1] > 0
        kept, removed, digests = [], [], []
        for i, t in enumerate(texts):
            spans = [m.span() for m in _WORD.finditer(t)]
            gone = covered[words.starts[i] : words.ends[i]]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            out, at = [], 0
            for first, last in edges.reshape(-1, 2).tolist():  # runs of removed words
                out.append(t[at : spans[first][0]])
                at = spans[last - 1][1]
            left = b"".join([*out, t[at:]])
            kept.append(left.decode())
            removed.append(int(gone.sum()))
            digests.append(digest(left))
        yield {"kept_text": kept, "n_removed": removed, "kept_sha256": digests, "n_words": words.counts} | {c: batch.column(i + 2) for i, c in enumerate(extra)}

    return run


def digest(text: bytes) -> str:
    return hashlib.sha256(b" ".join(text.split())).hexdigest()


KEY = common.KEY


def _where(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """docs joined with rows by KEY: filtered by the keys first, so that only the documents in question are shuffled."""
    return common.only(docs, rows.select(*KEY), KEY).join(rows, KEY)


def removals(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """For docs(doc_id, rid, text): (signed, starts). signed has each row's KEY, n_words, sha256 and copy (all its words are an
    earlier document's). starts has KEY and starts, a place of each different window to remove, for rows that are no copies but have such windows."""
    n, words = docs.count(), ["n_words", "f1", "f2"]

    def signatures(df: DataFrame) -> DataFrame:
        return common.arrow_map(df.select("doc_id", "text", "rid"), _sign(window), "doc_id long, rid long, n_words long, f1 long, f2 long, sha256 string, minima array<long>")

    long = (F.col("n_words") >= window) & F.col("doc_id").isNotNull()
    hot = common.hot_keys(signatures(common.sampled(docs, n)), words)
    signed = common.grouped(signatures(docs), words, hot, first=F.min(F.when(long, F.struct(*KEY))))
    signed = signed.select(*KEY, "n_words", "sha256", "minima", F.col("first.doc_id").alias("first_id"), F.col("first.rid").alias("first_rid"))
    signed = common.materialise(signed.withColumn("copy", F.coalesce(F.col("first_id") < F.col("doc_id"), F.lit(False))))
    # the first of the documents of equal words stands for them
    classes = signed.where("first_id = doc_id AND first_rid = rid")
    least, most = F.min("doc_id"), F.max("doc_id")

    def slots(df: DataFrame) -> DataFrame:
        return df.select(*KEY, F.explode("minima").alias("hash"))

    hot = common.hot_keys(slots(common.sampled(classes, n)), ["hash"])
    shared = common.grouped(slots(classes), ["hash"], hot, store=False, lo=least, hi=most).where("lo <> hi")
    probing = F.collect_list(F.when(F.col("lo") < F.col("doc_id"), F.col("hash"))).alias("probing")
    wanted = common.materialise(shared.groupBy(*KEY).agg(F.collect_list("hash").alias("wanted"), probing), n)

    def probes(df: DataFrame) -> DataFrame:
        return common.arrow_map(_where(df, wanted).select("doc_id", "text", "wanted", "rid", "probing"), _probe(window), "doc_id long, rid long, at int, block boolean, hash long")

    hot = common.hot_keys(probes(common.sampled(docs, n)), ["hash"])
    anchors = common.grouped(probes(docs), ["hash"], hot, lo=least, hi=most, indexed=F.max("block")).where("indexed AND lo <> hi")
    hits = common.materialise(anchors.groupBy(*KEY).agg(F.collect_list("at").alias("hits")), n)

    def windows(df: DataFrame) -> DataFrame:
        return common.arrow_map(_where(df, hits).select("doc_id", "text", "hits", "rid"), _extend(window), "doc_id long, rid long, at int, w1 long, w2 long")

    hot = common.hot_keys(windows(common.sampled(docs, n)), ["w1", "w2"])
    later = common.grouped(windows(docs), ["w1", "w2"], hot, lo=least).where("lo < doc_id")
    later = later.groupBy(*KEY).agg(F.sort_array(F.collect_list("at")).alias("starts"))
    # Rows of one doc_id may differ in white space alone: windows are known by the first of equal words.
    later = later.select(F.col("doc_id").alias("first_id"), F.col("rid").alias("first_rid"), "starts")
    starts = signed.where("NOT copy").select(*KEY, "first_id", "first_rid").distinct().join(later, ["first_id", "first_rid"]).select(*KEY, "starts")
    return signed.select(*KEY, "n_words", "sha256", "copy"), common.materialise(starts, n)


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document."""
    docs = common.keyed(docs.select("doc_id", "text"))
    signed, starts = removals(docs, window)
    cut = common.arrow_map(_where(docs, starts).select("text", "starts", "doc_id"), _cut(window, ["doc_id"]), "doc_id long, n_words long, n_removed long, kept_sha256 string")
    rest = signed.join(starts.select(*KEY), KEY, "left_anti")
    whole = rest.select(
        "doc_id", "n_words", F.when(F.col("copy"), F.col("n_words")).otherwise(F.lit(0)).alias("n_removed"),
        F.when(F.col("copy"), F.lit(digest(b""))).otherwise(F.col("sha256")).alias("kept_sha256"),
    )
    return cut.unionByName(whole)


def remove(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs without repeated passages: text and n_chars are what is left; documents of which nothing is left go."""
    names = {"doc_id": "__id", "rid": "__rid"}
    key = list(names.values())
    rows = common.keyed(docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "text")).drop("text").withColumnsRenamed(names)
    signed, starts = removals(rows.select(F.col("__id").alias("doc_id"), F.col("__rid").alias("rid"), "__row.text"), window)
    copies = signed.where("copy").select(*KEY).distinct().withColumn("starts", F.lit(None).cast("array<int>"))
    marks = common.materialise(copies.unionByName(starts).withColumnsRenamed(names | {"starts": "__starts"}))
    marked, plain = common.divided(rows, marks, key)
    schema = docs.drop("text", "n_chars").schema
    extra = [f.name for f in schema]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    marked = marked.where("__starts IS NOT NULL").select("__row.*", "__starts").select("text", "__starts", *extra)
    cut = common.arrow_map(marked, _cut(window, extra), f"{ddl}, kept_text string, n_removed long")
    cut = cut.where(F.length(F.trim(F.regexp_replace("kept_text", "[\\x09-\\x0D]", " "))) > 0).withColumns({"text": F.col("kept_text")})
    cut = cut.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else cut
    return plain.select("__row.*").select(*docs.columns).unionByName(cut.select(*docs.columns))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
