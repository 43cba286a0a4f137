import hashlib
import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from foliate.llm import html_text, language, ogg, rules
from tests.llm.helpers import corpus, documents, words


def brute_measures(t):
    w = words(t)
    n = Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k in range(len(w) - 2) if n[tuple(w[k : k + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (t or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(covered)


def test_rules_measure(spark):
    rows = [*corpus(), (900, "a b c a b c\nx|y ## \na\na\n \n "), (901, "A B. C! " * 60)]
    ledger = rules.apply(rules.measure(documents(spark, rows))).collect()
    want = {}
    for d, t in rows:
        m = brute_measures(t)
        want.setdefault((d, *m), 0)
    for r in ledger:
        m = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert (r["doc_id"], *m) in want
        assert r["base_failed"] == (m[0] < 50 or 100 * m[4] > 50 * m[0]) and (not r["base_failed"] or not r["kept"])
        for name, condition in rules.RULES:
            assert bool(r["fail_bits"] & rules.BIT[name]) == eval(condition, {c: r[c] for c in rules.MEASURES})
    assert len(ledger) == len(rows)
    assert rules.measure(documents(spark, [])).count() == 0


def test_words_with_letters():
    """A letter anywhere in a word counts, signs beyond ASCII don't."""
    import pyarrow as pa

    cases = ["— — — — —", '"quoted" (paren) \'tick', "Ärger 12 ü3 ... 日本 ½", "", "a", "ΑΒ γ " + "".join(chr(0x4E00 + i) for i in range(300))]
    got = next(rules._measure(pa.RecordBatch.from_arrays([pa.array(range(len(cases))), pa.array(cases)], names=["doc_id", "text"])))
    assert got["n_alpha_words"] == [sum(any(c.isalpha() for c in w) for w in words(t)) for t in cases]
    assert got["n_letters"] == [sum(c.isalpha() for c in t) for t in cases] and got["n_upper"] == [sum(c.isalpha() and c.isupper() for c in t) for t in cases]


def test_rules_query_reads_its_ablations_from_the_ledger(spark, tmp_path):
    documents(spark, corpus()).write.parquet(str(tmp_path / "documents.parquet"))
    got = rules.op2_rules(spark, str(tmp_path)).collect()
    bits = [r["fail_bits"] & rules.mask(rules.CURRENT) for r in got]
    assert len(got) == len(corpus()) and any(r["sole_rule"] for r in got)
    for r in got:
        b = r["fail_bits"] & rules.mask(rules.CURRENT)
        want = next((name for name in rules.POLICIES[rules.CURRENT] if b == rules.BIT[name]), None)
        assert r["sole_rule"] == want and r["sole_rule_docs"] == (sum(x == b for x in bits) if want else 0) and r["rule_docs"] == (sum(x & b > 0 for x in bits) if want else 0)


def test_ablations(spark):
    ledger = rules.apply(rules.measure(documents(spark, corpus())))
    bits = [r["fail_bits"] & rules.mask("v2") for r in ledger.collect()]
    for r in rules.ablations(ledger, "v2").collect():
        b = rules.BIT[r["rule"]]
        assert (r["failed"], r["failed_alone"], r["failed_any"], r["documents"]) == (sum(x & b > 0 for x in bits), sum(x == b for x in bits), sum(x > 0 for x in bits), len(bits))


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


LONG = "Some words of running text, and more of it to read. " * 5


def test_html_pages():
    nav = "<nav><ul><li><a href='/a'>Menu</a></li></ul></nav>"
    cases = {
        page(nav + f"<div class='ad'>Buy</div><article><h1>T &amp; x</h1><p><b>One<br><p>{LONG}</article><footer>f</footer>"): f"T & x\nOne\n{LONG.strip()}",
        page(
            f"<div id='cookie-notice'>We use</div><div class='post-17'><p>{LONG}</p><ul><li>a<li>b\n  c</ul><form>f</form><div class='comments'><p>nice</p></div></div><div class='sidebar'>s</div>"
        ): f"{LONG.strip()}\na\nb c",
        page(f"<script>var t='<p>x</p>'</script><main><p>a<b>b</b> c&nbsp;d&#33;</p><style>p{{}}</style><p>{LONG}<!-- <p>no</p> --></main>"): f"ab c d!\n{LONG.strip()}",
        "": "", "<<<>": "<<<>", "plain": "plain", "<p title=\"x>abc</p><p>d": "abc\nd", "<script>never closed": "", "a<b>c</b></div>d&lt;": "ac\nd<",
    }
    for source, want in cases.items():
        assert html_text.Page(source).text(None) == want, source


def test_html_consensus(spark):
    shape = lambda text: page(f"<div class='wrap'><div class='body-1'><p>{text}</p></div></div><div class='teaser'><p>{LONG * 2 if text == 'short' else 'x'}</p></div>")
    rows = [(i, f"https://u@h.example:80/{i}", shape(LONG)) for i in range(6)] + [
        (6, "http://H.example/x", shape("short")), (7, None, shape("short")), (8, "odd", page(f"<article>{LONG}</article>")),
        (9, "http://h.example/e", None), (9, "http://h.example/e", None), (None, "http://h.example/n", page("<p>other</p>")),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'a' AS host", "'b' AS path", "'c' AS text")
    got = html_text.extract(df).collect()
    by = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert by[0] == LONG.strip() and by[6] == "short" and by[7].startswith("Some words") and by[8] == LONG.strip() and by[9] == "" and by[None] == "other"
    assert html_text.extract(df.limit(0)).count() == 0


def test_html_random_articles():
    rng = random.Random(0)
    for _ in range(30):
        blocks = [" ".join(rng.choice(["aa", "b<c", "d&e", "ü", "f g"]) for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(1, 9))]
        body = "".join(f"<{t}>{html.escape(b)}" + (f"</{t}>" if rng.random() < 0.6 else "") for b in blocks for t in [rng.choice(["p", "h2", "blockquote", "li"])])
        source = page(f"<nav>Menu</nav><article>{body}</article><footer>x</footer>")
        p = html_text.Page(source)
        assert p.text(path_of(p, "html", "body", "article")) == p.text(None) == "\n".join(" ".join(b.split()) for b in blocks)


def path_of(p, *names):
    import xxhash

    out = ""
    for name in names:
        out = xxhash.xxh3_128_hexdigest(f"{out}>{name}")
    return out


def test_html_names_are_hints_only():
    """Sections of an article stay whatever words are in their names; boxes that are named and hold other text go."""
    for name in ("side-by-side", "legal-analysis", "social-history", "share-price", "related-work", "comment-on-law", "notice-of-motion", "widget-economics", "entry-header"):
        source = page(f"<article><p>{LONG}</p><div class='{name}'><p>{LONG}</p></div></article>")
        assert html_text.Page(source).text(None) == f"{LONG.strip()}\n{LONG.strip()}", name
    for name in ("ad", "ad-300x250", "adBox", "comments-list", "sidebar", "share-buttons", "related-posts", "newsletter-signup", "cookie-banner", "c-sidebar__inner--left"):
        source = page(f"<article><p>{LONG}</p><div class='{name}'><p>{LONG[:60]}</p></div></article>")
        assert html_text.Page(source).text(None) == LONG.strip(), name
    # a name doesn't count on what holds nearly all text, a header and its heading stay in an article, menus go without a name
    assert html_text.Page(page(f"<div class='sidebar right'><p>{LONG}</p></div>")).text(None) == LONG.strip()
    assert html_text.Page(page(f"<header>Site</header><article><header><h1>T</h1></header><p>{LONG}</p></article>")).text(None) == f"T\n{LONG.strip()}"
    links = "".join(f"<li><a href='/{i}'>Other text {i}</a></li>" for i in range(4))
    assert html_text.Page(page(f"<article><p>{LONG} <a href='/'>a link</a></p><ul>{links}</ul><ul><li>one<li>two</ul></article>")).text(None) == f"{LONG}a link\none\ntwo"


def test_html_hostile_pages_take_linear_time():
    import time

    n = 100_000
    for source in (
        "<div>" * n + "x", "<div class='a'>" * n, "<a href=\"x>" * n, "</div>" * n, "<p></b>" * n, "<b>" * n + "</p>" * n, "<p><i>" * n + "</p>" * n,
        "<!--" * n, "<" * n, "<a b='" * n, "<script>" * n, "<p " * n, "<a" * n, "&" * n, "<ul><li><a href=x>y" * n,
    ):
        began = time.process_time()
        html_text.Page(source).text(None)
        assert time.process_time() - began < 6, source[:20]


def test_html_votes_against_brute_force(spark):
    """Voting and reading again, page by page in Python."""
    rng = random.Random(3)
    rows = []
    for i in range(120):
        kind = rng.randrange(3)
        text = " ".join(rng.choice(["aa", "bb", "cc."]) for _ in range(rng.randrange(3, 60)))
        side = " ".join(rng.choice(["dd", "ee"]) for _ in range(rng.randrange(1, 60)))
        body = [
            f"<div class='story-{i}'><p>{text}</p></div><div class='box'><p>{side}</p></div>",
            f"<article><p>{text}</p></article><section><p>{side}</p></section>", f"<p>{text}</p>",
        ][kind]
        rows.append((i, f"http://h{rng.randrange(5)}.example/{i}", page(body)))
    votes = {}
    for _, url, source in rows:
        p = html_text.Page(source)
        best = max(range(len(p.paths)), key=lambda k: (p.scores[k] * (1.5 if p.paths[k] == path_of(p, "html", "body", "article") else 1), -k))
        if p.paths[best]:
            v = votes.setdefault(url.split("/")[2], {}).setdefault(p.paths[best], [0, 0])
            v[0] += 1
            v[1] += int(p.scores[best])
    winners = {h: max(v, key=lambda k: (*v[k], k)) for h, v in votes.items()}
    want = {i: html_text.Page(source).text(winners.get(url.split("/")[2])) for i, url, source in rows}
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(7)).collect()}
    assert got == want
    # where two paths have as many votes the one with more text wins
    rows = [
        (0, "http://t.example/0", page(f"<div class='a'><p>{'x' * 30}</p></div><div class='b'><p>{'y' * 10}</p></div>")),
        (1, "http://t.example/1", page(f"<div class='a'><p>{'x' * 10}</p></div><div class='b'><p>{'y' * 40}</p></div>")),
    ]
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: "y" * 10, 1: "y" * 40}


def bitwise_crc(data):
    r = 0
    for x in data:
        r ^= x << 24
        for _ in range(8):
            r = ((r << 1) ^ 0x04C11DB7 if r & 0x80000000 else r << 1) & 0xFFFFFFFF
    return r


def test_ogg_checksum_and_faults():
    for data in (b"", b"a", b"123456789", bytes(range(256))):
        assert ogg.checksum(data) == bitwise_crc(data)
    rng = np.random.default_rng(0)
    packets = [(rng.bytes(k), i) for i, k in enumerate((0, 1, 254, 255, 256, 510, 70000, 3, 130050, 7))]
    data = b"".join(ogg.pages(packets, 9))
    s = ogg.demux(data)[9]
    assert s.packets == [p for p, _ in packets] and s.seconds(1) == 9.0
    pages_ = list(ogg.pages(packets, 9))
    bad = [bytes([*data[:i], data[i] ^ 1, *data[i + 1 :]]) for i in (0, 5, 23, 40, len(data) // 2, len(data) - 1)] + [
        data[:-1], b"".join(pages_[:-1]), b"".join(pages_[1:]), b"".join([pages_[0], *pages_[2:]]),
    ]
    for b in bad:
        with pytest.raises(ogg.BadOgg):
            ogg.demux(b)


def test_ogg_granule_of_every_page_and_stored_media(spark, tmp_path):
    payload = bytes(range(256)) * 9 * 80
    packets = [(payload[i : i + ogg.UNIT], i + ogg.UNIT) for i in range(0, len(payload), ogg.UNIT)]
    good = list(ogg.pages(packets, ogg.PAYLOAD_SERIAL))
    text = b"".join(ogg.pages([(b"t", 0)], ogg.TEXT_SERIAL))
    assert len(good) > 2 and ogg.inspect(b"".join([*good, text]))[0] == payload
    times = ogg.demux(b"".join(good))[ogg.PAYLOAD_SERIAL].times()
    assert times.tolist() == [end / ogg.RATE for _, end in packets]
    for wrong in (1, -1):
        n = good[0][26]
        bad = ogg._page(good[0][5], wrong, ogg.PAYLOAD_SERIAL, 0, good[0][27 : 27 + n], good[0][27 + n :])
        with pytest.raises(ogg.BadOgg):
            ogg.inspect(b"".join([bad, *good[1:], text]))
    documents(spark, ["a b c", None]).write.parquet(str(tmp_path / "documents.parquet"))
    query = ogg.op8_ogg(spark, str(tmp_path))
    assert query.count() == 2 and all("/stored-" in f for f in query.inputFiles())


def test_ogg_query(spark):
    rows = corpus()
    got = ogg.digests(ogg.store(documents(spark, rows))).collect()
    want = []
    for d, t in rows:
        raw = (t or "").encode()
        payload = raw + b"\xff" * ((-len(raw)) % 576 if raw else 576)
        want.append((d, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])))
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in got)
    same = {}
    for r in got:
        same.setdefault(r["payload_sha256"], set()).add((r["media_sha256"], r["media_bytes"], r["feature"]))
    assert all(len(v) == 1 for v in same.values())
    assert ogg.digests(ogg.store(documents(spark, []))).count() == 0
    good = ogg.mux(b"x" * ogg.UNIT * 130)
    broken = spark.createDataFrame(
        [(1, 5, bytearray(good)), (2, 5, bytearray(good[:-1] + b"?")), (3, 5, bytearray(b"OggS")), (4, 5, None)],
        "doc_id long, n_bytes long, media binary",
    )
    got = {r["doc_id"]: r for r in ogg.digests(broken).collect()}
    assert [got[i]["error"] for i in (1, 2, 3, 4)] == [
        None, "checksum", "cut page header", "no payload",
    ] and got[2]["payload_sha256"] is None and got[2]["media_bytes"] == len(good)
    assert got[1]["page_seconds"] == [60 * ogg.UNIT / ogg.RATE, 120 * ogg.UNIT / ogg.RATE, 130 * ogg.UNIT / ogg.RATE]


def test_language_sums_all_segmentations():
    m = language.fit({"x": {"▁the": 5, "▁thing": 2, "▁other": 1}, "y": {"▁le": 4, "▁chose": 2}})
    place = {p: i for i, p in enumerate(language.pieces())}

    def total(w, j):
        ways = [1.0] + [0.0] * len(w)
        for e in range(1, len(w) + 1):
            for k in range(1, e + 1):
                i = place.get(w[e - k : e], len(place) if k == 1 else None)
                ways[e] += ways[e - k] * m.table[i, j] if i is not None else 0
        return np.log(ways[-1])

    some = ["▁the", "▁chose", "▁ß", "▁日本", "▁thingthe", "continued", "▁straßenbahnhaltestellenverzeichnis", "▁responsibilities", max(language.pieces(), key=len)]
    for w, s in zip(some, m.scores(some), strict=True):
        assert np.allclose(s, [total(w, 0), total(w, 1)])
    assert np.allclose(m.table.sum(axis=0), 1)
    # a sum that is far below the smallest float
    long = "▁" + "thingß" * 300
    logs = m.scores([long, "▁the"])
    assert np.isfinite(logs).all() and logs[0].max() < -2000 and np.allclose(logs[1], m.scores(["▁the"])[0])
    assert np.allclose(m.scores(["▁" + "thingß" * 12])[0], [total("▁" + "thingß" * 12, 0), total("▁" + "thingß" * 12, 1)])


def test_language_expected_counts_against_all_segmentations():
    lattice = language.Lattice(("▁", "a", "ab", "b", "ba", "▁a"))
    prob = np.array([0.1, 0.2, 0.25, 0.1, 0.15, 0.15, 0.05])[:, None]
    words, weight = ["▁ababx", "▁aba", "b"], np.array([2.0, 3.0, 1.0])

    def ways(w):
        if not w:
            return [[]]
        found = [(i, p) for i, p in enumerate(("▁", "a", "ab", "b", "ba", "▁a")) if w.startswith(p)]
        found += [(6, w[0])] if not any(len(p) == 1 for _, p in found) else []
        return [[i, *rest] for i, p in found for rest in ways(w[len(p) :])]

    want = np.zeros(7)
    for w, k in zip(words, weight):
        p = [np.prod(prob[x, 0]) for x in ways(w)]
        for x, q in zip(ways(w), p):
            np.add.at(want, x, k * q / sum(p))
    assert np.allclose(language._expect(lattice, words, weight, prob), want)


def test_language_sample_is_bounded_and_copies_count_once(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_ROWS", 20)
    seen = {}
    monkeypatch.setattr(language, "fit", lambda counts, path: seen.update(counts))
    rows = [(i, "same text again" if i % 2 else f"text number {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100 % 6]}") for i in range(600)]
    language.learn(documents(spark, rows))
    assert sum(seen["en"].values()) <= 60 and seen["en"]["▁same"] <= 1 and len(seen["en"]) > 15


def test_language_query(spark, data):
    got = language.identify(spark.read.parquet(f"{data}/documents.parquet")).toPandas()
    lang = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(lang, on="doc_id")
    held = both[both.held_out]
    assert len(both) == len(lang) and (held.lang == held.lang_pred).mean() > 0.95 and both.score.between(0, 1).all()
    assert (both.held_out == both.doc_id.map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()


def test_language_odd_rows(spark):
    rows = [(1, "the thing"), (2, None), (3, "123 !!"), (4, ""), (None, "the thing"), (1, "the thing"), (6, "x" * 4000 + " the")]
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(documents(spark, rows)).collect()]
    assert sorted(str(g[:2]) for g in got) == sorted(["(1, 'en')", "(2, 'und')", "(3, 'und')", "(4, 'und')", "(None, 'en')", "(1, 'en')", "(6, 'en')"])
    from pyspark.sql import functions as F

    assert {r["lang_pred"] for r in language.identify(documents(spark, rows).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify(documents(spark, [])).count() == 0


def test_texts_longer_than_a_step(spark):
    """One text of more than CHUNK_BYTES beside short ones, through every operator on texts."""
    from foliate.llm import common, line_dedup, near_dedup, pieces_fst, repeats

    rng = random.Random(12)
    line = lambda: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(900)}" for _ in range(12))
    shared = "\n".join(line() for _ in range(8))
    long = "\n".join([*(line() for _ in range(90_000)), shared])
    assert len(long) > common.CHUNK_BYTES
    docs = documents(spark, [(1, shared), (2, long), (3, "the thing and the other"), (4, long + " end")]).repartition(1)
    n = len(words(long))
    assert {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in repeats.repeats(docs).collect()}[4] == (n + 1, n)
    assert {r["doc_id"]: r["n_removed"] for r in line_dedup.edits(docs).collect()} == {1: 0, 2: 8, 3: 0, 4: 90_008}
    assert {r["doc_id"]: r["component_id"] for r in near_dedup.groups(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 2}
    assert {r["doc_id"]: r["n_words"] for r in rules.measure(docs).collect()} == {1: 96, 2: n, 3: 5, 4: n + 1}
    assert {r["doc_id"]: r["round_trip"] for r in pieces_fst.digests(docs.where("doc_id < 4")).collect()} == {1: True, 2: True, 3: True}
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify(docs).collect()} == {i: "en" for i in range(1, 5)}
    assert {r["doc_id"]: r["n_bytes"] for r in ogg.digests(ogg.store(docs)).collect()}[2] == len(long)


def test_language_ties_go_to_the_first_by_name(spark):
    same = language.fit({"y": {"▁abc": 3}, "x": {"▁abc": 3}})
    got = language.predict(documents(spark, [(1, "abc"), (2, "zzz")]), same, "doc_id").collect()
    assert {r["lang_pred"] for r in got} == {"x"} and all(abs(r["score"] - 0.5) < 1e-9 for r in got)
