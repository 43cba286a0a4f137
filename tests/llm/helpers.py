"""Documents that every operator has to cope with."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, start=0):
    """texts: a list of texts, or of (doc_id, text); extra columns with clashing names are added."""
    rows = [t if isinstance(t, tuple) else (start + i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    return df.selectExpr("*", "'x' AS ids", "1 AS start", "2L AS key", "'y' AS rid", "0 AS n_words", "'z' AS row_id", "'c' AS component", "'p' AS path")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=3):
    """Random texts with copies, near copies, shared passages and lines, nulls, empty, very long and repeated rows."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(5, 300)) for _ in range(40)]
    near = []
    for t in base[:12]:
        for edits in (1, 2, 8):
            w = t.split()
            for _ in range(edits):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            near.append(" ".join(w))
    passage, line = prose(rng, 70), prose(rng, 14)
    shared = [prose(rng, 30) + " " + passage + " " + prose(rng, 20) for _ in range(6)]
    lines = ["\n".join([prose(rng, 9), line, prose(rng, 12), line.replace("w", "w", 1)]) for _ in range(5)]
    words = line.split()
    lines += ["\n".join([prose(rng, 20), " ".join([*words[:4], "odd", *words[5:]])]), "\n".join([" ".join([*words[:3], *words[4:]]), "short"]), "a\n\n  \nb"]
    odd = [None, "", " \t\n", "one", "two words", "Ünï cødé " * 40, "x" * 5000, prose(rng, 6000), "日本 語 " * 30, "a b c"]
    texts = [*base, *near, *base[:5], *shared, *lines, *odd]
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, rows[0], (None, base[0]), (None, None)]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")
