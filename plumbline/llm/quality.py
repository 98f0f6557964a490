"""Quality rules as a ledger: every rule is evaluated once, and policies only read its bits.

``ledger`` returns a row per document with the measurements and ``fail_bits``, in which bit i is
set when rule i fails. ``apply_policy`` turns a versioned policy (a mask of rules) into ``kept``
without looking at a text again; ``ablation`` says by bitwise aggregation what each rule rejects
alone and what a policy without it would reject. Only DataFrame functions run here.

Null and empty texts have no words and fail ``short``. Rows are treated one by one, so repeated
rows, ties and null ids stay as they are; an empty table gives an empty ledger. Columns other
than id and text are not read. Write the ledger before filtering on its bits: a filter pushed into
the rules' expressions would evaluate them many times over.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import SPACE, WORD, whole

#: Rules by bit. Each compares whole numbers, so that two engines agree.
RULES: dict[str, str] = {
    "short": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "5 * n_symbols > n_words",
    "repeated_lines": "n_dup_lines >= 3 AND 2 * n_dup_lines > n_lines",
    "capitals": "n_words >= 10 AND 10 * n_upper > 7 * n_letters",
    "exclamations": "n_words >= 10 AND 2 * n_exclamations > n_words",
    "word_length": "n_words >= 10 AND (word_chars < 2 * n_words OR word_chars > 40 * n_words)",
    "variety": "n_words >= 10 AND 100 * n_distinct_words < 5 * n_words",
}
BASE = ("short", "repeated_windows")
#: Versioned policies: the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines"),
    "v2": tuple(RULES),
}
WINDOW = 5


def mask(policy: str | tuple[str, ...]) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    return sum(1 << i for i, rule in enumerate(RULES) if rule in names)


def _repeated(window: int) -> Column:
    """Words inside windows that occur twice or more, from the sorted column ``_at`` of places."""
    step = F.transform("_at", lambda p, k: F.coalesce(F.least(F.lit(window), F.get("_at", k + 1) - p), F.lit(window)))
    return F.aggregate(step, F.lit(0).cast("bigint"), lambda a, x: a + x)


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and ``fail_bits`` of every document, in one narrow pass without a shuffle.

    A repeated window is found by sorting the 64-bit hashes of a document's windows: equal
    neighbours are repeats. The places are sorted only for documents that have a repeat.
    """
    rows = df.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("_text"))
    rows = rows.withColumn("_words", F.array_remove(F.split("_text", f"{SPACE}+"), ""))
    rows = rows.withColumn("n_words", F.size("_words").cast("bigint"))
    n = F.col("n_words").cast("int")
    word = lambda i: F.get("_words", i)
    rows = rows.withColumn("_grams", F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[word(i + k) for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>")))
    rows = rows.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_grams")) < F.size("_grams"),
        F.array_sort(F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<g:bigint,i:int>>")))
    same = lambda x, k: (F.get("_sorted", k - 1)["g"] == x["g"]) | (F.get("_sorted", k + 1)["g"] == x["g"])
    rows = rows.withColumn("_at", F.array_sort(F.transform(
        F.filter("_sorted", lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x["i"])))
    rows = rows.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda s: s.rlike(WORD)))
    long = lambda c: c.cast("bigint")
    rows = rows.select(
        "doc_id", "n_words",
        long(F.char_length(F.array_join("_words", ""))).alias("word_chars"),
        long(F.regexp_count("_text", F.lit("[#*$%&|<>]"))).alias("n_symbols"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        _repeated(WINDOW).alias("n_repeat_words"),
        long(F.size("_lines")).alias("n_lines"),
        long(F.regexp_count("_text", F.lit("\\p{Lu}"))).alias("n_upper"),
        long(F.regexp_count("_text", F.lit("\\p{L}"))).alias("n_letters"),
        long(F.regexp_count("_text", F.lit("!"))).alias("n_exclamations"),
        long(F.size(F.array_distinct("_words"))).alias("n_distinct_words"),
    )
    bits = [F.when(F.expr(test), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, test in enumerate(RULES.values())]
    return rows.withColumn("fail_bits", reduce(lambda a, b: a.bitwiseOR(b), bits))


def apply_policy(rows: DataFrame, policy: str | tuple[str, ...] = "v2") -> DataFrame:
    """``base_failed`` and ``kept`` from the stored bits."""
    failed = lambda m: F.col("fail_bits").bitwiseAND(F.lit(m)) != 0
    return rows.withColumn("base_failed", failed(mask(BASE))).withColumn("kept", ~failed(mask(BASE) | mask(policy)))


def ablation(rows: DataFrame, policy: str | tuple[str, ...] = "v2") -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and that a policy
    without it would still reject. One pass over the bits; a row per rule."""
    m = mask(policy)
    held = F.col("fail_bits").bitwiseAND(F.lit(m))
    rules = [(i, r) for i, r in enumerate(RULES) if m >> i & 1]
    count = lambda c: F.coalesce(F.sum(c.cast("bigint")), F.lit(0))
    one = rows.agg(*[x for i, _ in rules for x in (
        count(held.bitwiseAND(F.lit(1 << i)) != 0).alias(f"f{i}"),
        count(held == (1 << i)).alias(f"a{i}"),
        count(held.bitwiseAND(F.lit(m & ~(1 << i))) != 0).alias(f"w{i}"),
    )])
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(r).alias("rule"), F.col(f"f{i}").alias("failed"), F.col(f"a{i}").alias("failed_alone"),
        F.col(f"w{i}").alias("rejected_without"),
    ) for i, r in rules])))
