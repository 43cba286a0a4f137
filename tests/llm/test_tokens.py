import random
import zlib

import numpy as np
import pytest

from foliate.llm import direct_codes, packing, pieces_fst, tokens
from tests.llm.helpers import corpus, documents


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary())


ODD = ["İstanbul ΣΑΣ x", "<|endoftext|> a<|endoftext|>b", "é é \x1c a", "don't it's 've", "１２ ² ½ 日本語 text", "a b", "​z", "", " ", "ſ ŉ ß"]


def test_ids_equal_the_library(library):
    e = tokens.Encoder()
    for t in [*ODD, *[t or "" for _, t in corpus()[:60]]]:
        assert np.frombuffer(e.encode(t), np.uint32).tolist() == library.encode(t, add_special_tokens=False).ids


def test_direct_codes_give_any_token():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 1 << 20, 3000).astype(np.uint32)
    ids[::3] %= 200
    s = direct_codes.Shard(direct_codes.write_shard([1, None], np.array([1000, 2000]), ids, 7))
    assert [s.token(i) for i in range(3000)] == ids.tolist() and s.docs == [1, None]
    for i in (0, 1, 511, 512, 513, 1023, 2999):
        for n in (0, 1, 2, 513, 1400):
            assert (s.slice(i, min(3000, i + n)) == ids[i : i + n]).all()
    with pytest.raises(IndexError):
        s.token(3000)
    empty = direct_codes.Shard(direct_codes.write_shard([], np.zeros(0, np.int64), np.zeros(0, np.uint32), 0))
    assert list(empty.documents()) == []


def test_direct_codes_query(spark, tmp_path, library):
    rows = corpus()
    got = direct_codes.digests(documents(spark, rows).repartition(5), str(tmp_path / "f")).collect()
    want, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    again = direct_codes.read(spark, str(tmp_path / "f")).count()
    assert again == len(rows)


def test_direct_codes_tokens_of_many_shards(spark, tmp_path, library):
    rows = [r for r in corpus() if r[0] is not None]
    path = str(tmp_path / "s")
    direct_codes.write(documents(spark, rows).repartition(3), path, shard_tokens=700)
    assert spark.read.parquet(path).count() > 10
    all_ids = []
    for _, t in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or "")):
        all_ids += [*library.encode(t or "", add_special_tokens=False).ids, 2]
    assert [x for r in sorted(direct_codes.read(spark, path).collect(), key=lambda r: r["start"]) for x in r["ids"]] == all_ids
    rng = random.Random(4)
    asked = [0, len(all_ids) - 1, len(all_ids), -1, None, 5, 5, *(rng.randrange(len(all_ids)) for _ in range(200))]
    got = direct_codes.tokens_at(spark, path, spark.createDataFrame([(p,) for p in asked], "position int")).collect()
    assert sorted(map(tuple, got)) == sorted((p, all_ids[p]) for p in asked if p is not None and 0 <= p < len(all_ids))
    direct_codes.write(documents(spark, []), str(tmp_path / "none"))
    assert direct_codes.tokens_at(spark, str(tmp_path / "none"), spark.createDataFrame([(0,)], "position int")).count() == 0


def test_direct_codes_of_many_small_partitions_are_few_files(spark, tmp_path, library):
    rows = [(i % 150, f"text {i} " + "word " * (i % 7)) for i in range(300)] + [(None, None)]
    held = {"spark.sql.shuffle.partitions": "61", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = direct_codes.digests(documents(spark, rows).repartition(5), str(tmp_path / "p")).collect()
        parts = spark.read.parquet(str(tmp_path / "p")).select("part").distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    n = len(list((tmp_path / "p").glob("part-*.parquet")))
    assert n <= 2 * spark.sparkContext.defaultParallelism < parts
    want, at = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_direct_codes_files_follow_the_size(spark, monkeypatch):
    monkeypatch.setattr(direct_codes, "FILE_BYTES", 10)
    docs = documents(spark, ["x" * 1000, None, "é"])
    assert direct_codes.files(docs) == (1002 + 3 * direct_codes.ROW_BYTES) // 10
    assert direct_codes.files(docs.limit(0)) == 2 * spark.sparkContext.defaultParallelism


def test_direct_codes_empty(spark, tmp_path):
    assert direct_codes.digests(documents(spark, []), str(tmp_path / "e")).count() == 0


def check_packing(rows, sequences, capacity, library):
    by_doc, spans = {}, {}
    for r in rows:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        spans.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in spans.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= capacity
    return by_doc, spans


def test_packing(spark, library):
    docs = corpus()
    rows = packing.pack(documents(spark, docs)).collect()
    by_doc, spans = check_packing(rows, None, 4096, library)
    want = sorted((d if d is not None else -1, len(library.encode(t or "", add_special_tokens=False).ids) + 1) for d, t in docs)
    got = sorted((d if d is not None else -1, n) for (d, n), rs in by_doc.items() for _ in range(sum(r["length"] for r in rs) // n))
    assert got == want
    for d, t in docs[:40]:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        for r in by_doc[d, len(ids)]:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    assert packing.pack(documents(spark, [])).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_patterns_hold_all_and_waste_little(seed):
    rng = np.random.default_rng(seed)
    sizes = np.unique(rng.integers(3, 100, 30))
    demand = rng.integers(50, 900, len(sizes))
    plan = packing.patterns(sizes, demand, 100)
    assert (sum(a * k for a, k in plan) == demand).all() and all((a * sizes).sum() <= 100 and k > 0 for a, k in plan)

    def bound(least):  # Martello and Toth's: what is left beside pieces over half
        big, mid, small = sizes > 100 - least, (sizes > 50) & (sizes <= 100 - least), (sizes >= least) & (sizes <= 50)
        total = lambda m: (sizes * demand)[m].sum()
        return demand[big].sum() + demand[mid].sum() + max(0, total(small) - (100 * demand[mid].sum() - total(mid))) / 100

    assert sum(k for _, k in plan) <= 1.03 * max(map(bound, range(1, 51))) + len(sizes)
    assert packing.patterns(np.array([7]), np.array([1]), 100)[0][1] == 1 and packing.patterns([], []) == []


def test_size_classes():
    b = packing.size_classes()
    assert b[0] == 1 and b[-1] == 4096 and (np.diff(b) > 0).all() and (np.diff(b)[64:] / b[65:] <= 1 / 32).all()


@pytest.fixture(scope="module")
def piece_library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=pieces_fst.model_file())


def test_pieces_equal_the_library(piece_library):
    t, rng = pieces_fst.transducer(), random.Random(1)
    vocabulary = list(t.spelled)
    texts = [*ODD[:-1], "  two  spaces ", "▁x", "😀 naïve", *["".join(rng.choice(vocabulary) for _ in range(8)) for _ in range(400)], *[x or "" for _, x in corpus()[:50]]]
    for s in texts:
        ids = t.encode(s)
        assert ids == piece_library.encode(s), s
        assert t.decode(ids) == piece_library.decode(ids)
    assert [np.frombuffer(x, "<u4").tolist() for x in t.packed(texts)] == [t.encode(s) for s in texts]


def test_symbols_kept_apart_are_those_that_merging_keeps_apart():
    """Against merging the joined spelling step by step."""
    t, rng = pieces_fst.transducer(), random.Random(2)
    score = {p: t.model.scores[i] for p, i in t.spelled.items()}
    names = list(t.spelled)

    def merged(s):
        parts = list(s)
        while tries := [(-score[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in score]:
            i = min(tries)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    short = [p for p in names if len(p) < 5 and merged(p) == [p]]
    a, b = ([rng.choice(short) for _ in range(3000)] for _ in range(2))
    symbol = {p: i for i, p in enumerate(names)}
    got = t.pairs.apart(np.array([symbol[x] for x in a]), np.array([symbol[x] for x in b]))
    assert got.tolist() == [merged(x + y) == [x, y] for x, y in zip(a, b)]


def test_long_words_and_squeezed_spaces():
    t = pieces_fst.transducer()
    long = "abc123" * 3000 + "日本語" * 500
    assert t.decode(t.encode(long)) == long and long not in t.words
    n = pieces_fst.Normaliser(True, True)
    assert [n.run(x) for x in ("", "  ", " a  b ", "a")] == ["", "", "▁a▁b", "▁a"]
    assert [pieces_fst.Normaliser(True, False).run(x) for x in ("", " ", " a  b ", "a")] == ["", "▁▁", "▁▁a▁▁b▁", "▁a"]


def unigram(pieces):
    """A unigram model file with these (piece, score)."""

    def varint(n):
        out = b""
        while n > 127:
            out += bytes([n & 127 | 128])
            n >>= 7
        return out + bytes([n])

    import struct

    def message(number, data):
        return bytes([number << 3 | 2]) + varint(len(data)) + data

    one = lambda p, s, k: message(1, message(1, p.encode()) + b"\x15" + struct.pack("<f", s) + b"\x18" + bytes([k]))
    return one("<unk>", 0, 2) + b"".join(one(p, s, 1) for p, s in pieces) + message(2, b"\x18\x01") + message(3, b"\x18\x01\x20\x00")


def test_unigram_takes_the_cheapest_path():
    pieces = [("▁", -3.0), ("a", -2.0), ("b", -2.5), ("ab", -3.0), ("▁a", -4.0), ("bab", -9.0), ("ba", -3.5)]
    t = pieces_fst.Transducer(pieces_fst.Model(unigram(pieces)))
    score = dict(pieces)

    def best(s):
        if not s:
            return 0.0, []
        return max((score[p] + best(s[len(p) :])[0], [p, *best(s[len(p) :])[1]]) for p in score if s.startswith(p))

    for text in ("ab", "abab", "bab", "a b ab", "aabbab"):
        want = best("▁" + text.replace(" ", "▁"))
        got = [t.model.pieces[i] for i in t.encode(text)]
        assert abs(sum(score[p] for p in got) - want[0]) < 1e-6
        assert t.decode(t.encode(text)) == text


def test_pieces_query(spark, piece_library):
    rows = corpus()
    got = {(r["doc_id"], r["ids_crc32"], r["n_pieces"]) for r in pieces_fst.digests(documents(spark, rows)).collect()}
    ids = [(d, np.array(piece_library.encode(t or ""), "<u4")) for d, t in rows]
    assert got == {(d, zlib.crc32(x.tobytes()), len(x)) for d, x in ids}
    encoded = pieces_fst.encode(documents(spark, rows))
    assert sorted(str(r["text"]) for r in pieces_fst.decode(encoded).collect()) == sorted(t or "" for _, t in rows)
    assert pieces_fst.digests(documents(spark, [])).count() == 0
