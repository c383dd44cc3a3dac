"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed rule. A policy
is a version number and a mask of the bits that reject, so applying another policy, or asking what a policy would do
without one of its rules, reads the ledger only. All of it is DataFrame code that stays inside one scan; no text is
shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import text_or_empty

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

# Bit number -> (name, fails). Shares are integer comparisons, so no engine rounds differently.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 60 * n_lines"),
    ("short_or_long_words", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    ("shouting", "100 * n_exclamations > 50 * n_words"),
)
BITS: dict[str, int] = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE_MASK = BITS["few_words"] | BITS["repeated_words"]


@dataclass(frozen=True)
class Policy:
    """A versioned set of rejecting rules."""

    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in set(self.rules))


POLICIES: tuple[Policy, ...] = (
    Policy(1, ("few_words", "repeated_words")),
    Policy(2, tuple(BITS)),
)


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` columns doc_id and text become doc_id and measurements.

    A null or empty text has no word, line or character, so every count is 0. Rows are independent: repeated rows
    give repeated results, and an empty table an empty result. Work per text is n log n.
    """
    text = F.col("text")
    stripped = F.btrim(text, F.lit(SPACES))
    a = docs.select("doc_id", text_or_empty().alias("text")).select(
        "doc_id",
        "text",
        F.when(F.octet_length(stripped) == 0, F.array().cast("array<string>"))
        .otherwise(F.split(stripped, "[ \\t-\\r]+")).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.octet_length(F.btrim(x, F.lit(SPACES))) > 0).alias("lines"),
    )
    b = a.select(
        "doc_id",
        F.size("words").alias("n_words"),
        (F.char_length(text) - F.octet_length(text) + F.octet_length(_without(text, SPACES))).alias("word_chars"),
        (F.octet_length(text) - F.octet_length(_without(text, SYMBOLS))).alias("n_symbols"),
        (F.octet_length(text) - F.octet_length(_without(text, "!"))).alias("n_exclamations"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.transform(
            F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))).alias("grams"),
    )
    # Most texts repeat no window; only the others are sorted.
    c = b.withColumn("placed", F.when(
        F.size(F.array_distinct("grams")) < F.size("grams"),
        F.array_sort(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    same = lambda x, i: F.coalesce(F.get("placed", i)["h"] == x["h"], F.lit(False))
    d = c.withColumn("starts", F.array_sort(F.transform(
        F.filter("placed", lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["p"])))
    # A window covers three words, or fewer if the next repeated window begins earlier.
    covered = F.aggregate(
        F.transform("starts", lambda p, i: F.coalesce(F.least(F.lit(3), F.get("starts", i + 1) - p), F.lit(3))),
        F.lit(0), lambda total, x: total + x)
    return d.select(
        "doc_id", *(F.col(c).cast("long") for c in (
            "n_words", "word_chars", "n_symbols", "n_exclamations", "n_lines", "n_dup_lines")),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements and ``failed``, the bits of the failed rules."""
    bits = [F.when(F.expr(fails), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long") for name, fails in RULES]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs).withColumn("failed", failed)


def apply_policy(entries: DataFrame, policy: Policy) -> DataFrame:
    """Adds ``kept`` and the policy's version to a ledger."""
    return entries.withColumns({
        "kept": F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0, "policy": F.lit(policy.version)})


def ablations(entries: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """(policy, rule, fails, only): documents that fail the rule, and those that the policy keeps without it.

    One pass: documents are counted by their bits first, and there are at most 2 ** len(RULES) of those.
    """
    by_bits = entries.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    cases = entries.sparkSession.createDataFrame(
        [(p.version, p.mask, r, BITS[r]) for p in policies for r in p.rules], "policy int, mask long, rule string, bit long")
    hit = F.col("failed").bitwiseAND(F.col("mask"))
    return by_bits.join(F.broadcast(cases), F.col("failed").bitwiseAND(F.col("bit")) != 0).groupBy("policy", "rule").agg(
        F.sum("n").alias("fails"), F.sum(F.when(hit == F.col("bit"), F.col("n")).otherwise(0)).alias("only"))
