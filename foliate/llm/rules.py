"""Quality rules as a bitmask ledger.

Each rule is evaluated once per document: measure() stores the measurements and one bit per failed rule. What to keep is
decided later, by applying a versioned policy (a mask of rules) to the stored bits, and the effect of each rule is read from the
same bits with bitwise aggregation, without looking at texts again.

Words are runs of characters other than 0x20 and 0x09-0x0D. Nulls: a null text is a text without words; its measurements are
0. A text without words fails few_words alone. Rows with a null doc_id and repeated rows are measured like others; an empty
table gives no rows. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.llm import common

#: Rules in the order of their bits: each a name and a condition over the measurements that a failing document meets.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeats", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "10 * n_symbols > n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 12 * n_words"),
    ("many_duplicate_lines", "2 * n_dup_lines > n_lines"),
    ("few_letters", "10 * n_alpha_words < 7 * n_words"),
    ("capitals", "2 * n_upper > n_letters"),
    ("shouting", "10 * n_shouts > n_words"),
    ("ellipses", "10 * n_ellipsis_lines > 3 * n_lines"),
    ("bullets", "10 * n_bullet_lines > 9 * n_lines"),
    ("too_long", "n_words > 1000000"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: Versions of the policy: the rules that count in each.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeats"),
    "v1": ("few_words", "repeats", "many_symbols", "many_duplicate_lines", "few_letters"),
    "v2": tuple(name for name, _ in RULES),
}
CURRENT = "v2"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_alpha_words", "n_letters", "n_upper", "n_shouts",
    "n_ellipsis_lines", "n_bullet_lines",
)
_SPACES = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_NO_LETTERS = bytes(x for x in range(256) if x not in _UPPER + _LOWER)
_BULLETS = (b"-", b"*", "•".encode())


def _repeated(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Words of each text that lie in 3-word windows found twice or more in it."""
    out = np.zeros(len(counts), np.int64)
    if len(hashes) < 3:
        return out
    ranges = common.Ranges(hashes)
    at = np.arange(len(hashes) - 2)
    doc = np.repeat(np.arange(len(counts)), counts)
    at = at[doc[at] == doc[at + 2]]
    if not len(at):
        return out
    key = common.mix(ranges.of(at, at + 3))
    order = np.lexsort((key, doc[at]))
    same = (key[order][1:] == key[order][:-1]) & (doc[at][order][1:] == doc[at][order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[at[twice] + k] = True
    return np.bincount(doc[covered], minlength=len(counts)).astype(np.int64)


#: Letters become a, white space a space, all other ASCII goes.
_SHAPE = bytes(97 if x in _UPPER + _LOWER else 32 if x in _SPACES else x for x in range(256))
_NO_SHAPE = bytes(x for x in range(128) if x not in _UPPER + _LOWER + _SPACES)
#: Texts with more different characters beyond ASCII are translated character by character.
_FEW = 200


def _letters(t: bytes, whole: str) -> tuple[int, int, int]:
    """Letters, capital letters, and words with a letter anywhere in them."""
    letters = t.translate(None, _NO_LETTERS)
    n, upper, shape = len(letters), len(letters.translate(None, _LOWER)), t
    if not whole.isascii():
        wide = {c for c in set(whole) if c > "\x7f"}
        for c in wide:
            if c.isalpha():
                k = whole.count(c) if len(wide) <= _FEW else 0
                n, upper = n + k, upper + k * c.isupper()
        if len(wide) > _FEW:
            own = [c for c in whole if c > "\x7f" and c.isalpha()]
            n, upper = n + len(own), upper + sum(map(str.isupper, own))
            shape = whole.translate({ord(c): "a" if c.isalpha() else None for c in wide}).encode()
        else:
            shape = whole
            for c in wide:
                shape = shape.replace(c, "a" if c.isalpha() else "")
            shape = shape.encode()
    return n, upper, len(shape.translate(_SHAPE, _NO_SHAPE).split())


def _measure(batch: pa.RecordBatch):
    texts = common.texts(batch.column(1))
    words = common.Words(texts)
    cols: dict[str, list] = {m: [] for m in MEASURES}
    for t in texts:
        whole = t.decode()
        lines = [x for x in t.split(b"\n") if x.strip(_SPACES)]
        letters, upper, spelled = _letters(t, whole)
        cols["word_chars"].append(len(whole) - sum(map(t.count, [_SPACES[i : i + 1] for i in range(6)])))
        cols["n_symbols"].append(len(t) - len(t.translate(None, _SYMBOLS)))
        cols["n_dup_lines"].append(len(lines) - len(set(lines)))
        cols["n_lines"].append(len(lines))
        cols["n_alpha_words"].append(spelled)
        cols["n_letters"].append(letters)
        cols["n_upper"].append(upper)
        cols["n_shouts"].append(t.count(b"!"))
        cols["n_ellipsis_lines"].append(sum(x.rstrip(_SPACES).endswith((b"...", "…".encode())) for x in lines))
        cols["n_bullet_lines"].append(sum(x.lstrip(_SPACES).startswith(_BULLETS) for x in lines))
    cols["n_words"] = words.counts
    cols["n_repeat_words"] = _repeated(words.hashes, words.starts, words.counts)
    yield {"doc_id": batch.column(0), **cols}


def failures() -> Column:
    """The ledger's bits, over the measurements."""
    bits = [F.when(F.expr(rule), F.lit(BIT[name])).otherwise(F.lit(0)) for name, rule in RULES]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out.cast("long")


def measure(docs: DataFrame) -> DataFrame:
    """The ledger: doc_id, the measurements and fail_bits."""
    found = common.arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _measure, "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    return found.withColumn("fail_bits", failures())


def mask(policy: str) -> int:
    return sum(BIT[r] for r in POLICIES[policy])


def apply(ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with base_failed and kept under a policy."""
    failed = lambda p: F.col("fail_bits").bitwiseAND(F.lit(mask(p))) != 0
    return ledger.withColumns({"base_failed": failed("base"), "kept": ~failed("base") & ~failed(policy)})


def ablations(ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """A row per rule of the policy: documents that fail it, that fail it alone (kept without it), and that fail any."""
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)))
    counts = [F.count("*").alias("documents"), F.count_if(bits != 0).alias("failed_any")]
    for r in POLICIES[policy]:
        counts += [F.count_if(bits.bitwiseAND(F.lit(BIT[r])) != 0).alias(f"fail_{r}"), F.count_if(bits == BIT[r]).alias(f"only_{r}")]
    one = ledger.agg(*counts)
    rows = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"fail_{r}").alias("failed"), F.col(f"only_{r}").alias("failed_alone")) for r in POLICIES[policy]]))
    return one.select("documents", "failed_any", rows.alias("r")).select("r.rule", "r.failed", "r.failed_alone", "failed_any", "documents")


def sole_rule(policy: str = CURRENT) -> Column:
    """The rule of the policy that a document fails alone, so that it would be kept without it; null if there is none."""
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)))
    out = F.lit(None).cast("string")
    for r in POLICIES[policy]:
        out = F.when(bits == BIT[r], F.lit(r)).otherwise(out)
    return out


def op2_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger is stored, then the current policy and its ablations are read from it: with sole_rule, the rule that alone rejects a
    document, and how many documents it rejects alone (sole_rule_docs) or at all (rule_docs); 0 without such a rule."""
    ledger = common.stored(measure(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    effect = ablations(ledger).select(F.col("rule").alias("sole_rule"), F.col("failed_alone").alias("sole_rule_docs"), F.col("failed").alias("rule_docs"))
    judged = apply(ledger).withColumn("sole_rule", sole_rule()).join(F.broadcast(effect), "sole_rule", "left")  # a row per rule
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("sole_rule_docs", "rule_docs")]
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits", "sole_rule", *counts)
