import hashlib

import numpy as np
import pyarrow as pa
import pytest

from foliate.llm import common, line_dedup, near_dedup, repeats
from foliate.llm.components import components
from tests.llm.helpers import corpus, documents, words


def shingle_set(t):
    w = words("".join(c.lower() if c.isascii() else c for c in t or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(i, i + 1) for i in range(30)] + [tuple(map(int, rng.integers(100, 160, 2))) for _ in range(40)] + [(7, 7), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = brute_components({x for a, b in edges if a != b for x in (a, b)}, [e for e in edges if e[0] != e[1]])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(1)
    for n in (1, 3, 40, 2000):
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        b = np.concatenate([a[: n - n // 5], rng.integers(0, 1 << 63, n // 5).astype(np.uint64)])
        s = near_dedup.sketches(np.concatenate([a, b]), np.array([n, n]))
        assert (s != np.uint64(2**64 - 1)).all()
        true = (n - n // 5) / (n + n // 5)
        assert abs((s[0] == s[1]).mean() - true) < 0.2
    assert near_dedup.bands(s).shape == (2, near_dedup.BANDS)


def test_near_dedup(spark):
    rows = corpus()
    got = near_dedup.groups(documents(spark, rows)).collect()
    named = {d: shingle_set(t) for d, t in rows if d is not None}
    edges = [(a, b) for a, x in named.items() for b, y in named.items() if a < b and x and y and 100 * len(x & y) >= 85 * len(x | y)]
    want = brute_components(named, edges)
    assert len(got) == len(rows) and len(edges) > 20
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["component_id"], r["n_shingles"], r["kept"]) == (want[r["doc_id"]], len(named[r["doc_id"]]), want[r["doc_id"]] == r["doc_id"])


def test_near_dedup_of_a_family_whose_members_are_apart(spark):
    rng = np.random.default_rng(2)
    base = [f"v{i}" for i in rng.integers(0, 5000, 160)]
    texts = []
    for k in range(60):
        w = list(base)
        for p in rng.choice(len(w), k % 7, replace=False):
            w[p] = f"x{rng.integers(1 << 30)}"
        texts.append(" ".join(w))
    sets = [shingle_set(t) for t in texts]
    edges = [(i, j) for i in range(60) for j in range(i + 1, 60) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.groups(documents(spark, texts)).collect()}
    assert got == brute_components(range(60), edges) and len(set(got.values())) > 1


def test_near_dedup_with_hot_groups(spark, monkeypatch):
    """Most documents are copies of one text or near it: sets, buckets and shingles are dealt to several tasks."""
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    rng = np.random.default_rng(11)
    base = [f"h{i}" for i in rng.integers(0, 5000, 120)]
    texts = [" ".join(base)] * 15
    for k in range(45):
        w = list(base)
        for p in rng.choice(len(w), k % 6, replace=False):
            w[p] = f"y{rng.integers(1 << 30)}"
        texts.append(" ".join(w))
    texts += [" ".join(f"o{i}" for i in rng.integers(0, 900, 60)) for _ in range(10)] + [None, ""]
    rows = [*enumerate(texts), (3, texts[3]), (70, texts[20]), (70, texts[60])]
    sets: dict = {}
    for d, t in rows:
        sets.setdefault(d, []).append(shingle_set(t))
    linked = lambda x, y: x and y and 100 * len(x & y) >= 85 * len(x | y)
    edges = [(a, b) for a in sets for b in sets if a < b and any(linked(x, y) for x in sets[a] for y in sets[b])]
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.groups(documents(spark, rows)).collect()}
    assert got == brute_components(sets, edges)


def test_near_dedup_versions_and_empty(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    got = near_dedup.groups(documents(spark, [(1, a), (2, b), (3, a), (3, b)])).collect()
    assert {r["component_id"] for r in got} == {1}
    assert near_dedup.groups(documents(spark, [])).count() == 0
    assert {r["kept"] for r in near_dedup.groups(documents(spark, [None, ""])).collect()} == {True}


def brute_repeats(rows, window):
    out = {}
    named = [(d, t) for d, t in rows if d is not None]
    windows = {}
    for d, t in named:
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            windows[k] = min(windows.get(k, d), d)
    for d, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if d is not None and windows[tuple(w[i : i + window])] < d:
                gone[i : i + window] = [True] * window
        out[d, t] = (len(w), sum(gone), [x for x, g in zip(w, gone) if not g])
    return out


@pytest.mark.parametrize("window", [50, 10])
def test_repeats(spark, window):
    rows = [*corpus(), (5, "another text " * 40), (5, "  spaced   another text " * 40)]
    want = brute_repeats(rows, window)
    got = sorted(map(str, (tuple(r) for r in repeats.repeats(documents(spark, rows), window).collect())))
    assert got == sorted(str((d, n, k, hashlib.sha256(" ".join(kept).encode()).hexdigest())) for (d, t), (n, k, kept) in ((r, want[r]) for r in rows))
    assert sum(k for _, k, _ in want.values()) > 500


def test_repeats_with_hot_passages(spark, monkeypatch):
    """A passage and a word that most documents repeat: their hashes are dealt to several tasks."""
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    rng = np.random.default_rng(5)
    some = lambda n: " ".join(f"q{i}" for i in rng.integers(0, 300, n))
    passage = some(70)
    rows = [(i, f"{some(20)} {passage} {some(15)} {'the ' * (80 + i)}") for i in range(40)] + [(50, "the " * 300), (51, some(30))]
    want = brute_repeats(rows, 50)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in repeats.repeats(documents(spark, rows)).collect()}
    assert got == {d: want[d, t][:2] for d, t in rows}
    docs = common.keyed(documents(spark, rows).select("doc_id", "text")).withColumn("hash", common.F.length("text") % 3)
    hot = common.hot_keys(docs.select("doc_id", "rid", "hash"), ["hash"])
    both = [sorted(map(tuple, common.grouped(docs.select("doc_id", "rid", "hash"), ["hash"], h, lo=common.F.min("doc_id"), hi=common.F.max("doc_id")).collect())) for h in (hot, None)]
    assert hot is not None and both[0] == both[1] and len(both[0]) == len(rows)


def test_keys_tell_rows_of_one_id_apart(spark):
    got = common.keyed(documents(spark, [(1, "a"), (2, "b"), (1, "c"), (None, "d"), (None, "e")]).select("doc_id", "text")).collect()
    assert len({(r["doc_id"], r["rid"]) for r in got if r["doc_id"]}) == 3 and {r["rid"] for r in got if r["doc_id"] == 2} == {0}


def test_repeats_remove(spark):
    rows = [r for r in corpus() if r[0] is not None]
    rows = list(dict.fromkeys(rows))
    docs = documents(spark, rows)
    want = brute_repeats(rows, 50)
    got = {r["doc_id"]: r for r in repeats.remove(docs).collect()}
    for (d, t), (n, k, kept) in want.items():
        assert (d in got) == (bool(kept) or not k)
        if d in got:
            assert words(got[d]["text"]) == kept and (k or got[d]["text"] == t)
    assert repeats.remove(docs).columns == docs.columns
    assert repeats.repeats(documents(spark, [])).count() == 0


def brute_lines(rows):
    order, first, gone = [], {}, set()
    for d, t in sorted((r for r in set(rows) if r[0] is not None and r[1] is not None), key=lambda r: r[0]):
        for k, line in enumerate(t.split("\n")):
            w = tuple(words(line))
            if w:
                if w in first:
                    gone.add((d, k))
                else:
                    first[w] = (d, k)
                    order.append((w, (d, k)))
    for i, (w, o) in enumerate(order):
        if any(max(len(v), len(w)) >= 5 and edit_distance(v, w) <= 1 for v, _ in order[:i] if abs(len(v) - len(w)) <= 1):
            gone.add(o)
    return gone


def edit_distance(a, b):
    """By the textbook's table; pairs that share no word at either end are told apart at once."""
    if a[0] != b[0] and a[-1] != b[-1]:
        return 2 if len(a) > 1 and len(b) > 1 else max(len(a), len(b))
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_line_dedup(spark):
    rows = corpus()
    gone = brute_lines(rows)
    assert len(gone) > 15
    got = line_dedup.edits(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    text = dict(rows[:-2])
    for r in got:
        if r["doc_id"] is None:
            assert r["n_removed"] == 0
            continue
        lines = (text[r["doc_id"]] or "").split("\n")
        if text[r["doc_id"]] is None:
            assert r["text"] is None and r["n_lines"] == 0
        else:
            assert r["text"] == "\n".join(x for k, x in enumerate(lines) if (r["doc_id"], k) not in gone) and r["n_lines"] == len(lines)
    kept = line_dedup.remove(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert line_dedup.edits(documents(spark, [])).count() == 0


def test_line_dedup_has_no_floors(spark):
    a, b = "one two three four five six seven eight nine".split(), "alpha beta gamma delta epsilon".split()
    rng = np.random.default_rng(6)
    texts = ["All rights reserved.\nIntro", "日本語の文章です\n\nAll  rights reserved.", "Intro\nx\n日本語の文章です\n \nAll rights kept."]
    texts += [" ".join(a), " ".join([*a, "ten"]), " ".join(b), " ".join([*b[:2], "odd", *b[3:]]), " ".join(b[:4]), "p q r s", "p q r s t", "p q r u", "p q r"]
    texts += ["\n".join(" ".join(f"k{rng.integers(6)}" for _ in range(rng.integers(1, 12))) for _ in range(5)) for _ in range(40)]
    earlier, want = [], {}
    for d, t in enumerate(texts):
        kept = []
        for line in t.split("\n"):
            w = words(line)
            if not w or not any(v == w or max(len(v), len(w)) >= 5 and edit_distance(v, w) <= 1 for v in earlier):
                kept.append(line)
            if w:
                earlier.append(w)
        want[d] = "\n".join(kept)
    assert want[1] == "日本語の文章です\n" and want[2] == "x\n \nAll rights kept." and want[4] == want[6] == want[7] == want[9] == "" and want[10] == "p q r u"
    assert {r["doc_id"]: r["text"] for r in line_dedup.edits(documents(spark, texts)).collect()} == want


def test_line_dedup_with_hot_lines(spark, monkeypatch):
    """A line that every document has, and lines that differ in one word from many others."""
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    rng = np.random.default_rng(9)
    rows = [(i, f"a line that stands in every document\n{' '.join(f'u{x}' for x in rng.integers(0, 10**6, 8))}\npage {i} of the very long report\na line that stands in every document\nshort") for i in range(40)]
    gone = brute_lines(rows)
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"]) for r in line_dedup.edits(documents(spark, rows)).collect()}
    assert got == {d: (5, sum(x == d for x, _ in gone)) for d, _ in rows} and len(gone) > 150


def test_within_one():
    a = list("abcd")
    assert all(line_dedup.within_one(a, list(b)) and line_dedup.within_one(list(b), a) for b in ("abcd", "abc", "bcd", "abxd", "abcde", "xabcd"))
    assert not any(line_dedup.within_one(a, list(b)) for b in ("ab", "axxd", "abcdef", "bacd"))
    rng = np.random.default_rng(0)
    for _ in range(2000):
        x, y = ([int(v) for v in rng.integers(0, 3, rng.integers(1, 6))] for _ in range(2))
        assert line_dedup.within_one(x, y) == (edit_distance(x, y) <= 1)


def test_ranges_and_slices():
    w = common.Words([b"a b c a b c", None, b"", b"b c a"])
    r = common.Ranges(w.hashes)
    s = np.array([0, 3, 1]), np.array([3, 6, 4])
    h = r.of(*s)
    assert h[0] == h[1] != h[2] and r.of(np.array([1]), np.array([4])) == r.of(np.array([6]), np.array([9]))
    batch = pa.RecordBatch.from_pydict({"a": pa.array(["x" * 10, "y" * 100, None, "z" * 30])})
    assert [b.num_rows for b in common.slices(batch, 50)] == [1, 1, 2]
