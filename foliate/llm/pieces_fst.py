"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled into arrays of states and arcs:

* the normaliser, a transducer over classes of characters (space, other) whose arcs emit the word mark (dummy prefix, escaped
  and, where the model says so, squeezed spaces);
* the pieces, a trie in a double array whose accepting states emit a symbol;
* the byte fallback, whose arcs turn a character that no piece spells into the pieces of its bytes.

An input is normalised, cut into words where no piece crosses, and each word that wasn't seen lately is composed with pieces and fallback: the
lattice's arcs are symbols between positions. Its encoding is the shortest path in the tropical semiring, found by one relaxation for many
words at once: at each position the least of (distance of the arc's start + the arc's weight).

The weight of an arc depends on the model type. Unigram models: the negated score of the piece. BPE models: nothing if BPE keeps the
arc's symbol and the one before it apart, else infinite. A sequence is a BPE encoding exactly if all its neighbours are kept apart, and every prefix
of an input has one encoding, so one arc into each position has a finite distance and the position is all that a state needs.
Whether two symbols are kept apart is computed from the order of merges, for all pairs in question at once.

Nulls: a null text is empty and has no pieces. Rows are encoded one by one, whatever their ids; an empty table gives no rows.
Columns besides doc_id and text are ignored. Paths of equal weight (unigram models): the shorter last piece.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.llm import common

MARK = "▁"
#: Words whose ids a worker remembers.
CACHE_WORDS = 600_000
#: Answers about pairs of symbols that a worker remembers, as a power of two.
PAIR_BITS = 21
#: Longer words are cut where no piece crosses, and not remembered.
LONG_WORD = 64
#: Characters that are composed at once.
STEP_CHARS = 1 << 17
#: Kinds of pieces in model files (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
INFINITE = float("inf")
NEVER = 1 << 40


def model_file(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            n = varint()
            value = data[at : at + n]
            at += n
        else:
            n = 4 if kind == 5 else 8
            value = struct.unpack("<f" if n == 4 else "<d", data[at : at + n])[0]
            at += n
        yield key >> 3, value


class Model:
    """A model file: pieces, scores, kinds, the model type and the normaliser's switches."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        self.type, self.prefix, self.trim, self.charsmap, self.byte_fallback = UNIGRAM, True, True, b"", False
        for number, value in _fields(data):
            if number == 1:
                one = dict(_fields(value))
                self.pieces.append(one[1].decode())
                self.scores.append(one.get(2, 0.0))
                self.kinds.append(one.get(3, NORMAL))
            elif number == 2:
                spec = dict(_fields(value))
                self.type, self.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                self.prefix, self.trim, self.charsmap = bool(spec.get(3, 1)), bool(spec.get(4, 1)), spec.get(2, b"")
        if self.charsmap:
            raise ValueError("models with a compiled character map are not supported: their normaliser isn't the identity")


def inverse(chars: list[str]) -> np.ndarray:
    """Code of each code point: its place in chars, counted from 1; 0 for others."""
    out = np.zeros(0x110000, np.int32)
    out[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
    return out


class Trie:
    """Strings of character codes in a double array: the child of a state by a code is base[state] + code if check says so."""

    def __init__(self, strings: list[tuple[int, ...]], values: list[int], codes: int):
        self.longest = max(map(len, strings), default=1)
        children: list[dict[int, int]] = [{}]
        accepts = [-1]
        for s, v in zip(strings, values, strict=True):
            node = 0
            for c in s:
                nxt = children[node].get(c)
                if nxt is None:
                    nxt = children[node][c] = len(children)
                    children.append({})
                    accepts.append(-1)
                node = nxt
            accepts[node] = v
        size = 2 * (len(children) + codes)
        used = bytearray(size + codes)
        used[0] = 1
        place, base, least = [0] * len(children), [0] * len(children), {}
        # states with many children are placed first, at the first offset that fits and was not passed by one with as many
        for node in sorted(range(len(children)), key=lambda n: -len(children[n])):
            own = sorted(children[node])
            if not own:
                continue
            at = least.get(len(own), 1)
            while used[at] or at < own[0] or len(own) > 1 and any(used[at - own[0] + c] for c in own):
                at += 1
            least[len(own)] = at if len(own) > 1 else 1 if at < own[0] + 2 else at
            base[node] = at - own[0]
            for c in own:
                used[base[node] + c] = 1
                place[children[node][c]] = base[node] + c
        self.base, self.check, self.value = np.zeros(size + codes, np.int32), np.full(size + codes, -1, np.int32), np.full(size + codes, -1, np.int32)
        for node, own in enumerate(children):
            self.base[place[node]], self.value[place[node]] = base[node], accepts[node]
            for child in own.values():
                self.check[place[child]] = place[node]

    def step(self, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and which of them exist."""
        to = self.base[state] + code
        return to, self.check[to] == state

    def arcs(self, code: np.ndarray, until: np.ndarray, single: int) -> np.ndarray:
        """The value of the string of k + 1 codes that ends at each place (row k), or -1; single for a code that is no string.
        until is the end of each place's word."""
        out = np.full((self.longest, len(code)), -1, np.int32)
        out[0] = single
        at, state = np.arange(len(code)), np.zeros(len(code), np.int32)
        for k in range(self.longest):
            state, good = self.step(state, code[at + k])
            at, state = at[good], state[good]
            value = self.value[state]
            ends = value >= 0
            out[k, at[ends] + k] = value[ends]
            on = until[at] > at + k + 1
            at, state = at[on], state[on]
            if not len(at):
                break
        return out


class Normaliser:
    """A transducer over two classes of characters. Its states: before any word, in a word, after spaces in a word's wake.

    Arcs (state, class) emit the word mark, the character, both or nothing. Without squeezing, a space is a mark of its own and the
    state is never `gap`.
    """

    BEGIN, WORD, GAP = range(3)

    def __init__(self, prefix: bool, squeeze: bool):
        #: (state, is space) -> (next state, what is emitted before the character, whether the character is)
        self.squeeze = squeeze
        mark = MARK if prefix else ""
        self.arcs = {(self.BEGIN, False): (self.WORD, mark, True), (self.WORD, False): (self.WORD, "", True), (self.GAP, False): (self.WORD, MARK, True)}
        if squeeze:
            self.arcs |= {(self.BEGIN, True): (self.BEGIN, "", False), (self.WORD, True): (self.GAP, "", False), (self.GAP, True): (self.GAP, "", False)}
        else:
            self.arcs |= {(self.BEGIN, True): (self.WORD, mark + MARK, False), (self.WORD, True): (self.WORD, MARK, False)}

    def run(self, text: str) -> str:
        """The output for a text: runs of spaces and of others are read at once, as a state stands still within them."""
        if not text:
            return ""
        if not self.squeeze:  # after the first character the state is WORD for good, and its arcs replace spaces one by one
            _, before, keep = self.arcs[self.BEGIN, text[0] == " "]
            return before + (text if keep else text[1:]).replace(" ", self.arcs[self.WORD, True][1])
        state, out = self.BEGIN, []
        for run in re.findall(" +|[^ ]+", text):
            state, before, keep = self.arcs[state, run[0] == " "]
            out += [before, run] if keep else [before]
        return "".join(out)


class Pairs:
    """Which symbols BPE keeps apart, by the order of merges; answers are remembered in a table of a fixed size."""

    def __init__(self, rank: np.ndarray, left: np.ndarray, right: np.ndarray, merges: dict[tuple[int, int], int]):
        self.n, self.rank, self.left, self.right = len(rank), rank, left, right
        keys = np.fromiter((a * self.n + b for a, b in merges), np.int64, len(merges))
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], np.fromiter(merges.values(), np.int64, len(merges))[order]
        self.known, self.answer = np.full(1 << PAIR_BITS, -1, np.int64), np.zeros(1 << PAIR_BITS, bool)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """When two neighbours are merged (NEVER if they aren't)."""
        key = a * self.n + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def _apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Goes back in time: the symbols at the border are a and b at the end, and before that the parts that they were made of.
        They are merged if that comes before the merges that use up either (the left one first among equals)."""
        out, open_ = np.ones(len(a), bool), np.arange(len(a))
        until_a = until_b = np.full(len(a), NEVER)
        while len(open_):
            when = self.merged(a, b)
            out[open_] = apart = (when >= until_a) | (when > until_b)
            made_a, made_b = self.rank[a], self.rank[b]
            go = apart & ((made_a >= 0) | (made_b >= 0))
            back_a = made_a > made_b
            until_a, until_b = np.where(back_a, made_a, until_a)[go], np.where(back_a, until_b, made_b)[go]
            a, b, open_ = np.where(back_a, self.right[a], a)[go], np.where(back_a, b, self.left[b])[go], open_[go]
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.n + b
        slot = (key.view(np.uint64) * np.uint64(common.BASES[0]) >> np.uint64(64 - PAIR_BITS)).view(np.int64)
        out, new = self.answer[slot], self.known[slot] != key
        if new.any():
            fresh, where = np.unique(key[new], return_inverse=True)
            found = self._apart(fresh // self.n, fresh % self.n)
            out[new] = found[where]
            slot = (fresh.view(np.uint64) * np.uint64(common.BASES[0]) >> np.uint64(64 - PAIR_BITS)).view(np.int64)
            # of several keys that share a slot the last one is kept, with its answer
            self.known[slot] = fresh
            mine = self.known[slot] == fresh
            self.answer[slot[mine]] = found[mine]
        return out


class Transducer:
    """normalise, encode and decode with the compiled model.

    Symbols are the pieces that can come out, then the characters that occur in pieces without being one, then START (before a
    word) and OTHER (any character that occurs in no piece).
    """

    def __init__(self, model: Model):
        self.model, self.bpe = model, model.type == BPE
        self.spelled = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k in (NORMAL, USER_DEFINED)}
        self.bytes_ = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == BYTE}
        self.unknown = model.kinds.index(UNKNOWN)
        self.plain = set(self.spelled.values())
        self.normaliser = Normaliser(model.prefix, model.trim)
        chars = sorted({c for p in self.spelled for c in p})
        self.code = inverse(chars)
        spellings = list(self.spelled) + [c for c in chars if c not in self.spelled]
        self.start, self.other = len(spellings), len(spellings) + 1
        self.ids = np.array([self.spelled.get(s, -1) for s in spellings] + [-1, -1], np.int64)
        if self.bpe:
            self.pairs, made = self._merges(spellings)
        else:
            made = [True] * len(spellings)
            weights = [-model.scores[self.spelled[s]] if s in self.spelled else 10.0 - min(model.scores) for s in spellings]
            self.weights = np.array([*weights, 0.0, 10.0 - min(model.scores)])
        code = {c: i + 1 for i, c in enumerate(chars)}
        reached = [i for i, s in enumerate(spellings) if made[i]]
        self.trie = Trie([tuple(code[c] for c in spellings[i]) for i in reached], reached, len(chars) + 1)
        # Classes of characters, and which classes stand next to each other in any piece: elsewhere the input can be cut.
        kinds = {c: _class(c) for c in chars}
        together = {(kinds[a], kinds[b]) for p in self.spelled for a, b in zip(p, p[1:])}
        cuts = re.compile("|".join(f"(?<={a})(?={b})" for a, x in _CLASSES for b, y in _CLASSES if (x, y) not in together) or r"(?!)")
        self.cut = cuts.split
        # Where nothing may stand before the mark but the mark itself, words are cut off before the others.
        words = all((name, "mark") not in together for _, name in _CLASSES[1:])
        self.chunks = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$").findall if words else lambda s: [s] if s else []
        self.words: dict[str, bytes] = {}

    def _merges(self, spellings: list[str]) -> tuple[Pairs, list[bool]]:
        """The order of merges of a BPE model as arrays over symbols, and which symbols BPE makes at all."""
        symbol = {s: i for i, s in enumerate(spellings)}
        order = {s: k for k, s in enumerate(sorted((p for p in self.spelled if len(p) > 1), key=lambda p: (-self.model.scores[self.spelled[p]], p)))}
        rank, left, right = (np.full(len(spellings) + 2, -1, np.int64) for _ in range(3))
        merges, made = {}, [len(s) == 1 for s in spellings]
        for p, k in order.items():
            for i in range(1, len(p)):
                if p[:i] in symbol and p[i:] in symbol:
                    merges[symbol[p[:i]], symbol[p[i:]]] = k
            parts = list(p)
            while len(parts) > 2:
                tries = [(order[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in order]
                if not tries:
                    break
                i = min(tries)[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if len(parts) == 2:
                me = symbol[p]
                made[me], rank[me], left[me], right[me] = True, k, symbol[parts[0]], symbol[parts[1]]
        return Pairs(rank, left, right, merges), made

    def normalise(self, text: str) -> str:
        return self.normaliser.run(text)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed([text])[0], "<u4").tolist()

    def packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, 4 bytes each."""
        parts = [self.chunks(self.normalise(t)) for t in texts]
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        words = self.words
        fresh = set().union(*parts).difference(words)
        long = [w for w in fresh if len(w) > LONG_WORD]
        fresh = list(fresh.difference(long))
        words.update(zip(fresh, self.compose(fresh), strict=True))
        for w in long:
            words[w] = b"".join(self.compose([x for x in self.cut(w) if x]))
        out = [b"".join(map(words.__getitem__, p)) for p in parts]
        for w in long:
            del words[w]
        return out

    def compose(self, words: list[str]) -> list[bytes]:
        """The shortest path of each word, in steps of words that are about equally long."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-sizes, kind="stable")  # longest first
        step = np.cumsum(sizes[order]) // STEP_CHARS
        out: list[bytes] = [b""] * len(words)
        for mine in np.split(order, np.flatnonzero(np.diff(step)) + 1):
            mine = mine.tolist()
            for i, data in zip(mine, self._paths([words[i] for i in mine]), strict=True):
                out[i] = data
        return out

    def _paths(self, words: list[str]) -> Iterator[bytes]:
        """The ids of the shortest path of each word; words come longest first."""
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        # pieces and the fallback's characters composed with the input
        arcs = self.trie.arcs(self.code[chars], np.repeat(ends, sizes), self.other)
        distance, last, back = np.full(len(chars), INFINITE), np.zeros(len(chars), np.int32), np.zeros(len(chars), np.int64)
        live = np.searchsorted(-sizes, -np.arange(1, int(sizes[0]) + 1), "right") if len(words) else []
        for p, n in enumerate(live):
            # all arcs into the words' position p
            end = starts[:n] + p
            into = arcs[: p + 1, end]
            k, word = np.nonzero(into >= 0)
            symbol, source = into[k, word], end[word] - k - 1
            first = k == p
            before = np.where(first, self.start, last[source])
            weight = self._weights(before, symbol) + np.where(first, 0.0, distance[source])
            cost = np.full(into.shape, INFINITE)
            cost[k, word] = weight
            best = cost.argmin(axis=0)
            each = np.arange(n)
            distance[end], last[end], back[end] = cost[best, each], into[best, each], best
        # back along the paths: a symbol is noted where it starts
        on_path, at, floor = np.full(len(chars), -1, np.int32), ends - 1, starts
        while len(at):
            begins = at - back[at]
            on_path[begins] = last[at]
            more = begins > floor
            at, floor = begins[more] - 1, floor[more]
        where = np.flatnonzero(on_path >= 0)
        ids = self.ids[on_path[where]]
        counts = np.ones(len(where), np.int64)
        missing = np.flatnonzero(ids < 0)
        spelled = {int(i): self.fallback(chr(chars[where[i]])) for i in missing}
        for i, x in spelled.items():
            counts[i] = len(x)
        flat = np.repeat(ids, counts).astype("<u4")
        to = np.cumsum(counts)
        for i, x in spelled.items():
            flat[to[i] - len(x) : to[i]] = x
        data = flat.tobytes()
        edges = np.concatenate([[0], to])[np.searchsorted(where, np.concatenate([starts, [len(chars)]]))] * 4
        edges = edges.tolist()
        return (data[a:b] for a, b in zip(edges, edges[1:]))

    def _weights(self, before: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Of arcs by their symbol and the one before it."""
        if self.bpe:
            return np.where(self.pairs.apart(before, symbol), 0.0, INFINITE)
        return self.weights[symbol]

    def fallback(self, c: str) -> list[int]:
        """The byte fallback's arcs for a character that is no piece."""
        return [self.bytes_[b] for b in c.encode("utf-8", "surrogatepass")] if self.bytes_ and self.model.byte_fallback else [self.unknown]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes in a row are read as UTF-8 (bad ones become U+FFFD), control pieces are left out."""
        if self.plain.issuperset(ids):
            text = "".join(map(self.model.pieces.__getitem__, ids)).replace(MARK, " ")
            return text[1:] if self.model.prefix and text.startswith(" ") else text
        out, held = [], b""
        for i in [*ids, None]:
            kind = self.model.kinds[i] if i is not None else None
            if kind == BYTE:
                held += bytes([int(self.model.pieces[i][3:5], 16)])
                continue
            if held:
                out.append(_utf8(held))
                held = b""
            if kind in (NORMAL, USER_DEFINED):
                out.append(self.model.pieces[i])
            elif kind == UNKNOWN:
                out.append(" ⁇ ")
        text = "".join(out).replace(MARK, " ")
        return text[1:] if self.model.prefix and text.startswith(" ") else text


def _utf8(data: bytes) -> str:
    out = ""
    while data:
        for n in (1, 2, 3, 4):
            try:
                out += data[:n].decode()
                data = data[n:]
                break
            except UnicodeDecodeError:
                continue
        else:
            out += "�"
            data = data[1:]
    return out


#: Classes of characters between which an input may be cut, as patterns and names: the word mark, letters, digits, others.
_CLASSES = [(MARK, "mark"), (r"[^\W\d_]", "letter"), (r"\d", "digit"), (f"(?:[^\\w{MARK}]|_)", "other")]


def _class(c: str) -> str:
    return next(name for pattern, name in _CLASSES if re.fullmatch(pattern, c))


@lru_cache(2)
def transducer(path: str | None = None) -> Transducer:
    with open(model_file(path), "rb") as f:
        return Transducer(Model(f.read()))


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids of each text."""

    def run(batch: pa.RecordBatch):
        own = transducer(path)
        yield {"doc_id": batch.column(0), "ids": [np.frombuffer(x, "<u4").tolist() for x in own.packed([t or "" for t in batch.column(1).to_pylist()])]}

    return common.arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of each list of ids (null: empty)."""

    def run(batch: pa.RecordBatch):
        own = transducer(path)
        yield {"doc_id": batch.column(0), "text": [own.decode(x or []) for x in batch.column(1).to_pylist()]}

    return common.arrow_map(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_pieces, n_bytes_pieces (from byte fallback), ids_crc32 and round_trip (decoding gives the text) of each document."""

    def run(batch: pa.RecordBatch):
        own = transducer(path)
        low, high = min(own.bytes_.values(), default=0), max(own.bytes_.values(), default=-1)
        rows, texts = [], [t or "" for t in batch.column(1).to_pylist()]
        for t, data in zip(texts, own.packed(texts), strict=True):
            ids = np.frombuffer(data, "<u4")
            rows.append((len(ids), int(((ids >= low) & (ids <= high)).sum()), zlib.crc32(data), own.decode(ids.tolist()) == t))
        yield {"doc_id": batch.column(0)} | dict(zip(("n_pieces", "n_byte_pieces", "ids_crc32", "round_trip"), map(list, zip(*rows, strict=True)), strict=True))

    return common.arrow_map(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
        "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, round_trip boolean",
    )


def op5_pieces_fst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
