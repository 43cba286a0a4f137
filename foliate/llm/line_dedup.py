"""Removal of lines that stand earlier in the corpus, word for word or within one word, by a deletion-neighbourhood join.

Lines are the \\n-split parts of a text, known by their words (runs of characters other than 0x20 and 0x09-0x0D). A line that
has a word (MIN_WORDS) is removed if an earlier line, by (doc_id, line number), has the same words. It is also removed if an
earlier one is within one word edit of it, a word put in, left out or exchanged, and the longer of the two has NEAR_WORDS words or
more: one edit per NEAR_WORDS words. Two shorter lines must be equal, as an edit would be a quarter of them or all. Lines
without words stay.

Each line in question emits its deletion variants, the line itself and the line without each of its words, as hashed keys.
Equal variants meet in one group: lines that left out the same position differ in that word alone, a full line equals a longer
one less a word. A group is never expanded: its members are compared with the earliest one. The edit distance of each such
pair is confirmed on the words. Before that, a pigeonhole key keeps lines out that can't have a partner: lines within one edit
agree in the first or the last half of their words. Lines, halves and variants go through one exchange each; hot ones (a line that
stands in a third of all documents) are dealt to several tasks.

Nulls: a null text has no lines to remove and stays null; rows with a null doc_id stay as they are and remove nothing. Rows with
equal doc_id are handled one by one; rows that are equal in both stay, as they are the earliest both. An empty table gives no rows. Columns besides doc_id and
text pass through remove() and are ignored by edits().
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.llm import common

MIN_WORDS, NEAR_WORDS = 1, 5
KEY = common.KEY
LINE = [*KEY, "line"]
_ORDER = ["doc_id", "line", "rid"]


def _lines(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All lines, the text of each, and its number there."""
    parts = [t.split(b"\n") if t else [] for t in texts]
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    doc = np.repeat(np.arange(len(parts)), counts)
    return [x for p in parts for x in p], doc, np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)


def _sign(min_words: int, near_words: int):
    """Lines of min_words or more, those of equal words once per text: the first one's number and the others', two hashes of
    their words, and the halves that a line within one edit shares one of."""

    def run(batch: pa.RecordBatch):
        lines, doc, number = _lines(common.texts(batch.column(2)))
        words = common.Words(lines)
        good = np.flatnonzero(words.counts >= min_words)
        a, b = common.Ranges(words.hashes), common.Ranges(words.hashes, common.BASES[1])
        h1, h2 = common.mix(a.of(words.starts[good], words.ends[good])), b.of(words.starts[good], words.ends[good])
        # equal lines of a text stand side by side, the first one first
        order = np.lexsort((h2, h1, words.counts[good], doc[good]))
        good, h1, h2 = good[order], h1[order], h2[order]
        new = np.ones(len(good), bool)
        for x in (doc[good], words.counts[good], h1, h2):
            new[1:] &= x[1:] == x[:-1]
        new[1:] = ~new[1:]
        group = np.cumsum(new) - 1
        others = common.lists(number[good][~new], np.bincount(group[~new], minlength=int(new.sum())), pa.int32())
        good, h1, h2 = good[new], h1[new], h2[new]
        s, e, n = words.starts[good], words.ends[good], words.counts[good]
        keys, at = [], []
        # lines of a word less than near_words have partners of near_words alone
        for less in (0, 1):  # halves of n words and, for even n, of n - 1
            mine = np.flatnonzero((n >= near_words) & (n % 2 == 0)) if less else np.flatnonzero(n >= near_words - 1)
            half = (n[mine] - less) // 2
            tag = half.astype(np.uint64) * np.uint64(common.BASES[1])
            keys += [common.mix(a.of(s[mine], s[mine] + half) ^ tag), common.mix(~(a.of(e[mine] - half, e[mine]) ^ tag))]
            at += [mine, mine]
        at, keys = np.concatenate(at), np.concatenate(keys)
        order = np.argsort(at, kind="stable")
        row = pa.array(doc[good])
        yield {
            "doc_id": batch.column(0).take(row), "rid": batch.column(1).take(row), "line": number[good], "others": others, "n": n,
            "h1": common.signed(h1), "h2": common.signed(h2), "halves": common.lists(common.signed(keys[order]), np.bincount(at, minlength=len(good))),
        }

    return run


def _picked(batch: pa.RecordBatch) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Of a batch of (doc_id, rid, text, wanted line numbers): these lines, the row of each, its number."""
    out, row, number = [], [], []
    for i, (t, wanted) in enumerate(zip(common.texts(batch.column(2)), batch.column(3).to_pylist(), strict=True)):
        lines = t.split(b"\n")
        for k in wanted:
            out.append(lines[k])
            row.append(i)
            number.append(k)
    return out, np.array(row, np.int64), np.array(number, np.int64)


def _variants(near_words: int):
    """The line itself (at -1, with its words) and, from near_words words, the line without each word, as hashed keys."""

    def run(batch: pa.RecordBatch):
        lines, row, number = _picked(batch)
        words = common.Words(lines)
        ranges = common.Ranges(words.hashes)
        which = np.repeat(np.arange(len(lines)), words.counts)
        p = np.flatnonzero(words.counts[which] >= near_words)
        which = which[p]
        s, e = words.starts[which], words.ends[which]
        less = ranges.of(s, p) + ranges.of(p + 1, e) * ranges.ups[p - s]
        which, at = np.concatenate([np.arange(len(lines)), which]), np.concatenate([np.full(len(lines), -1), p - s])
        keys = np.concatenate([ranges.of(words.starts, words.ends), less])
        n = words.counts[which] - (at >= 0)
        r = pa.array(row[which])
        spelled = pa.array([b" ".join(x.split()).decode() for x in lines] + [None] * len(p), pa.string())
        yield {
            "doc_id": batch.column(0).take(r), "rid": batch.column(1).take(r), "line": number[which], "at": at,
            "key": common.signed(common.mix(keys ^ (n.astype(np.uint64) << np.uint64(48)))), "words": spelled,
        }

    return run


def within_one(a: list, b: list) -> bool:
    """Whether two sequences are within one edit: one item put in, left out or exchanged."""
    if abs(len(a) - len(b)) > 1:
        return False
    i, least = 0, min(len(a), len(b))
    while i < least and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)) :] == b[i + (len(b) >= len(a)) :]


def _confirm(batch: pa.RecordBatch):
    good = [i for i, (a, b) in enumerate(zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True)) if within_one(a.split(" "), b.split(" "))]
    at = pa.array(good, pa.int64())
    yield {c: batch.column(i).take(at) for i, c in enumerate(LINE)}


def _near(firsts: DataFrame, docs: DataFrame, n: int, near_words: int) -> DataFrame:
    """LINE of the lines that an earlier one is within one edit of; firsts has the first line of each kind and its halves."""
    halves = firsts.where(F.size("halves") > 0).select(*LINE, F.explode("halves").alias("half"))
    hot = common.hot_keys(common.sampled(halves, n), ["half"])
    shared = common.grouped(halves, ["half"], hot, store=False, k=F.count("*")).where("k > 1")
    open_ = common.materialise(shared.groupBy(*KEY).agg(F.array_sort(F.collect_set("line")).alias("wanted")), n)
    texts = common.only(docs, open_.select(*KEY), KEY).join(open_, KEY).select(*KEY, "text", "wanted")
    variants = common.stored(common.arrow_map(texts, _variants(near_words), "doc_id long, rid long, line int, at int, key long, words string"))
    me = F.struct(*_ORDER)
    # Lines that leave out the same position of the same words (mate), or that are the same as a longer one without a word (whole, less):
    # each with the earliest on the other side.
    hot = common.hot_keys(common.sampled(variants, n), ["key"])
    met = common.grouped(
        variants.drop("words"), ["key"], hot, store=False, inner=["at"], inside={"mate": F.min(me)},
        whole=F.min(F.when(F.col("at") < 0, me)), less=F.min(F.when(F.col("at") >= 0, me)),
    )
    other = F.when(F.col("at") < 0, F.array("less")).otherwise(F.array("mate", "whole"))
    pairs = common.materialise(met.select(*LINE, F.explode(other).alias("w")).where(me > F.col("w")).distinct())
    own = variants.where("at < 0").select(*LINE, "words")
    both = pairs.join(own, LINE).join(own.select(F.struct(*_ORDER).alias("w"), F.col("words").alias("words_w")), "w").select(*LINE, "words", "words_w")
    return common.arrow_map(both, _confirm, "doc_id long, rid long, line int").distinct()


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """For docs(doc_id, rid, text): KEY and the sorted numbers of the lines to remove (gone), for documents that have any."""
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(*KEY, "text")
    n = docs.count()
    same, me = ["n", "h1", "h2"], F.struct(*_ORDER)

    def signed(df: DataFrame) -> DataFrame:
        return common.arrow_map(df, _sign(min_words, near_words), "doc_id long, rid long, line int, others array<int>, n int, h1 long, h2 long, halves array<long>")

    hot = common.hot_keys(signed(common.sampled(docs, n)), same)
    found = common.grouped(signed(docs), same, hot, w=F.min(me))
    first = me <= F.col("w")
    lines = common.stored(found.select(*LINE, "others", first.alias("first"), F.when(first, F.col("halves")).alias("halves")))
    again = F.concat("others", F.when(F.col("first"), F.array().cast("array<int>")).otherwise(F.array("line")))
    gone = lines.select(*KEY, F.explode(again).alias("line"))
    return gone.unionByName(_near(lines.where("first"), docs, n, near_words)).groupBy(*KEY).agg(F.array_sort(F.collect_set("line")).alias("gone"))


def edits(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """doc_id, n_lines, n_removed and the text that is left, of each document."""
    out = _edited(docs.select("doc_id", "text"), min_words, near_words)
    return out.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("text").isNull(), 0).otherwise(F.col("__n")).alias("n_lines"),
        F.col("__gone").alias("n_removed"), "text",
    )


def _edited(docs: DataFrame, min_words: int, near_words: int) -> DataFrame:
    """docs with the lines left out, __n (lines before) and __gone (lines left out)."""
    names = {"doc_id": "__id", "rid": "__rid"}
    rows = common.keyed(docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "text")).drop("text").withColumnsRenamed(names)
    gone = common.materialise(removed_lines(rows.select(F.col("__id").alias("doc_id"), F.col("__rid").alias("rid"), "__row.text"), min_words, near_words))
    cut, whole = common.divided(rows, gone.withColumnsRenamed(names | {"gone": "__out"}), list(names.values()))
    lines = F.split("text", "\n", -1)
    # what stands between neighbouring lines that go
    ends = F.concat("__out", F.array(F.col("__n")))
    parts = F.transform(
        ends, lambda end,
        i: F.slice("__lines", F.when(i == 0, 1).otherwise(F.get("__out", i - 1) + 2), end - F.when(i == 0, 0).otherwise(F.get("__out", i - 1) + 1)),
    )
    cut = cut.select("__row.*", "__out").withColumn("__lines", lines).withColumn("__n", F.size("__lines"))
    cut = cut.withColumns({"text": F.array_join(F.flatten(parts), "\n"), "__gone": F.size("__out")}).select(*docs.columns, "__n", "__gone")
    return cut.unionByName(whole.select("__row.*").withColumns({"__n": F.size(lines), "__gone": F.lit(0)}))


def remove(docs: DataFrame, min_words: int = MIN_WORDS, near_words: int = NEAR_WORDS) -> DataFrame:
    """docs without repeated lines; text and n_chars are what is left. Documents that lost lines and have no word left go."""
    out = _edited(docs, min_words, near_words).where("__gone = 0 OR text RLIKE '[^ \\\\t-\\\\r]'")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__gone") == 0, F.col("n_chars")).otherwise(F.length("text")).cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edits(spark.read.parquet(f"{sf_dir}/documents.parquet"))
