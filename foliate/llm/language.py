"""Language identification by unigram models whose segmentations are summed out.

The pieces are those of a fixed public vocabulary. Each language has a probability for every piece; a word's probability is the
sum over all ways to cut it into pieces of the product of the piece probabilities (forward algorithm), and a text's is the
product over its words. Pieces never span words, so each distinct word is scored once per worker.

The probabilities are fitted by expectation-maximisation on a sample of labelled rows: of each language at most SAMPLE_ROWS
different texts, those whose rows have the lowest hashes of doc_id and text, so that copies of one text count once and stand for as
many rows as others. All words of these texts and all pieces of the vocabulary take part. All rows are predicted. A prediction
reads the text alone; of equally probable languages it is the first by name.

Nulls: rows without lang or text teach nothing; a null text, or one without a letter, is predicted und with score 0. An empty
table gives no rows; without any labelled row all texts are und with score 0. Rows with a null doc_id count as held out = null
and teach nothing. Repeated rows are predicted each. Columns besides doc_id, text and lang are ignored.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliate.llm import common
from foliate.llm.pieces_fst import Trie, inverse

#: Different texts per language that a fit learns from.
SAMPLE_ROWS = 300
#: Rounds of expectation-maximisation, and what every piece is given on top of its expected count.
ROUNDS, PRIOR = 3, 0.05
UNKNOWN = "und"
#: Words whose scores a worker remembers.
CACHE_WORDS = 120_000
#: Bytes of text that are split into words at once.
CHUNK_BYTES = 1 << 20
#: Characters of words that are scored at once.
STEP_CHARS = 1 << 15
#: Sums below this are scaled up.
TINY = 1e-150
_WORDS = regex.compile(r"[\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def vocabulary(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(2)
def pieces(path: str | None = None) -> tuple[str, ...]:
    """The vocabulary's pieces of letters, in lower case, distinct; the word mark stands for a word's start."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=vocabulary(path))
    found = {sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i))}
    return tuple(sorted(p for p in found if all(c == "▁" or unicodedata.category(c)[0] in "LM" for c in p) and "▁" not in p[1:]))


class Lattice:
    """The pieces as a trie of character codes; symbol n is a character that is no piece."""

    def __init__(self, vocab: tuple[str, ...]):
        chars = sorted({c for p in vocab for c in p})
        code = {c: i + 1 for i, c in enumerate(chars)}
        self.n, self.code = len(vocab), inverse(chars)
        self.trie = Trie([tuple(code[c] for c in p) for p in vocab], list(range(self.n)), len(chars) + 1)

    def forward(self, words: list[str], table: np.ndarray, arcs: list | None = None) -> np.ndarray:
        """The log of the summed probability of all segmentations of each word, by language; words come longest first.

        arcs, for a single language: gets (symbol, source, end, share) of the arcs into each position, from the first on; source is -1
        at a word's start, share the part of the sum at end that comes through the arc.
        """
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        spans = self.trie.arcs(self.code[chars], np.repeat(ends, sizes), self.n)
        alpha, scale = np.zeros((len(chars), table.shape[1])), np.zeros(len(words))
        for p, n in enumerate(np.searchsorted(-sizes, -np.arange(1, int(sizes.max(initial=0)) + 1), "right")):
            end = starts[:n] + p
            into = spans[: p + 1, end].T
            word, k = np.nonzero(into >= 0)  # every word has an arc: its last character, at least
            symbol, source = into[word, k], end[word] - k - 1
            through = table[symbol]
            inner = k < p
            through[inner] *= alpha[source[inner]]
            first = np.searchsorted(word, np.arange(n))
            alpha[end] = np.add.reduceat(through, first, axis=0)
            if arcs is not None:
                arcs.append((symbol, np.where(inner, source, -1), end[word], through[:, 0] / alpha[end[word], 0]))
            if p >= self.trie.longest:
                low = np.flatnonzero(alpha[end].max(axis=1) < TINY)
                for back in range(self.trie.longest) if len(low) else ():
                    alpha[end[low] - back] /= TINY
                scale[low] += np.log(TINY)
        return np.log(np.maximum(alpha[ends - 1], 1e-300)) + scale[:, None]


def steps(words: list[str]) -> list[list[int]]:
    """The places of the words, longest first, in runs of about STEP_CHARS characters."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(-sizes, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(np.cumsum(sizes[order]) // STEP_CHARS)) + 1) if len(x)]


class Model:
    """langs and log piece probabilities (pieces + 1 rows: the last is for characters that no piece covers)."""

    def __init__(self, langs: list[str], table: np.ndarray, path: str | None = None):
        self.langs, self.path = langs, path
        self.table = table
        self._ready()

    def _ready(self) -> None:
        self.lattice, self.cache, self.rows = None, {}, np.zeros((0, len(self.langs)))

    def __getstate__(self):
        return {"langs": self.langs, "path": self.path, "table": self.table}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word (with its mark) in each language."""
        if self.lattice is None:
            self.lattice = _lattice(self.path)
        out = np.zeros((len(words), len(self.langs)))
        for mine in steps(words):
            out[mine] = self.lattice.forward([words[i] for i in mine], self.table)
        return out

    def texts(self, texts: list[list[str]]) -> np.ndarray:
        """Summed log probability of each text's words; words that the worker has not met are scored together."""
        met = set().union(*texts)
        missing = list(met.difference(self.cache))
        if len(self.cache) + len(missing) > CACHE_WORDS:
            self.cache, self.rows, missing = {}, self.rows[:0], list(met)
        if missing:
            self.cache.update(zip(missing, range(len(self.rows), len(self.rows) + len(missing)), strict=True))
            self.rows = np.concatenate([self.rows, self.scores(missing)])
        out, find = np.zeros((len(texts), len(self.langs))), self.cache.__getitem__
        for i, words in enumerate(texts):
            out[i] = self.rows[np.fromiter(map(find, words), np.int64, len(words))].sum(axis=0)
        return out


@lru_cache(2)
def _lattice(path: str | None) -> Lattice:
    return Lattice(pieces(path))


def split(text: str) -> list[str]:
    """Lower-case words of letters with their start mark."""
    return list(map("▁".__add__, _WORDS.findall(text.lower())))


def fit(counts: dict[str, dict[str, int]], path: str | None = None) -> Model:
    """Expectation-maximisation of each language's piece probabilities from its word counts."""
    langs, lattice = sorted(counts), _lattice(path)
    n = lattice.n
    table = np.zeros((n + 1, len(langs)))
    for j, lang in enumerate(langs):
        words = sorted(counts[lang])
        weight = np.array([counts[lang][w] for w in words], float)
        prob = np.full((n + 1, 1), 1.0 / (n + 1))
        for _ in range(ROUNDS):
            expected = np.full(n + 1, PRIOR)
            for mine in steps(words):
                expected += _expect(lattice, [words[i] for i in mine], weight[mine], prob)
            prob = (expected / expected.sum())[:, None]
        table[:, j] = prob[:, 0]
    return Model(langs, table, path)


def _expect(lattice: Lattice, words: list[str], weight: np.ndarray, prob: np.ndarray) -> np.ndarray:
    """How often each symbol is expected in the segmentations of words: each word's weight flows back along the arcs."""
    arcs: list = []
    lattice.forward(words, prob, arcs)
    ends = np.cumsum([len(w) for w in words])
    flow, out = np.zeros(int(ends[-1])), np.zeros(lattice.n + 1)
    flow[ends - 1] = weight
    for symbol, source, end, share in reversed(arcs):
        through = flow[end] * share
        out += np.bincount(symbol, through, minlength=len(out))
        np.add.at(flow, source[source >= 0], through[source >= 0])
    return out


def learn(docs: DataFrame, path: str | None = None) -> Model | None:
    """Fit a model to a bounded sample of the rows whose crc32(doc_id) is no multiple of 5."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0))
    rows = rows.select("lang", "text", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("h"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not sizes:
        return None
    # about four times what is needed by a threshold, then different texts in order of their least hash
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, 4 * SAMPLE_ROWS / n))])
    some = rows.where(F.pmod("h", F.lit(1 << 40)) < share[F.col("lang")] * (1 << 40)).groupBy("lang", "text").agg(F.min(F.pmod("h", F.lit(1 << 40))).alias("h"))
    taken = some.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))).where(F.col("k") <= SAMPLE_ROWS)

    def count(batch: pa.RecordBatch):
        found: dict[tuple[str, str], int] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for w in split(text):
                found[lang, w] = found.get((lang, w), 0) + 1
        yield {"lang": [k[0] for k in found], "word": [k[1] for k in found], "n": list(found.values())}

    counted = common.arrow_map(taken.select("lang", "text"), count, "lang string, word string, n long", CHUNK_BYTES).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts: dict[str, dict[str, int]] = {lang: {} for lang in sizes}
    for r in counted.toLocalIterator():  # the words of SAMPLE_ROWS texts a language
        counts[r["lang"]][r["word"]] = r["n"]
    return fit(counts, path)


def predict(docs: DataFrame, model: Model | None, *keep: str) -> DataFrame:
    """docs' columns keep, with lang_pred and score, the posterior after dividing the log odds by the root of the number of words."""
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", lang_pred string, score double"
    shared = docs.sparkSession.sparkContext.broadcast(model)  # the table of one vocabulary and a few languages

    def run(batch: pa.RecordBatch):
        own, langs, scores = shared.value, [], []
        texts = [t if own and t and _LETTER.search(t) else None for t in batch.column(0).to_pylist()]
        words = [split(t) if t else [] for t in texts]
        for t, w, total in zip(texts, words, own.texts(words) if own else words, strict=True):
            if t is None:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            post = np.exp((total - total.max()) / len(w) ** 0.5)
            best = int(post.argmax())
            langs.append(own.langs[best])
            scores.append(float(post[best] / post.sum()))
        yield {c: batch.column(i + 1) for i, c in enumerate(keep)} | {"lang_pred": langs, "score": scores}

    return common.arrow_map(docs.select(F.col("text").alias("__text"), *keep), run, schema, CHUNK_BYTES)


def identify(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each document."""
    found = predict(docs, learn(docs, path), "doc_id")
    return found.select("doc_id", (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0).alias("held_out"), "lang_pred", "score")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
