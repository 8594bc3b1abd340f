"""Quality rules (operator 12), with DataFrame functions only: a ledger of failure bits.

Every rule is evaluated once for each document. The ledger keeps the measurements and one bit for each rule that fails; policies are versions, each a set of rules that reject,
and are applied to the bits alone. What a rule adds to a policy, or what would come back without it, is counted over the distinct values of the bits.

Null text has no words. Words are runs of other characters than blanks, tabs, line ends and the like; lines end at \\n. An empty text fails the rule on few words and no
other. Windows of eight words are compared by 64-bit hashes within their text. A very long text is one row: it needs some twenty times its size in memory while it is measured. Ties
don't occur; repeated rows are judged alike; an empty table gives no rows. Further columns stay, unless a column of the ledger has their name (in any case), which
then replaces them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, let, split_words

NO_BLANK = r"[^\x20\x09-\x0D]"
WINDOW = 8
#: name, failing condition over the measurements. The place is the number of the bit: append new rules, never move one.
RULES = [
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("few_alphabetic_words", "100 * n_alphabetic_words < 80 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("capitals", "100 * n_capitals > 30 * word_chars"),
]
#: The rules that reject in each version.
POLICIES = {
    1: ("few_words", "repeated_windows"),
    2: ("few_words", "repeated_windows", "word_length", "symbols", "few_alphabetic_words"),
    3: ("few_words", "repeated_windows", "word_length", "symbols", "few_alphabetic_words", "duplicate_lines", "capitals"),
}
BASE, LATEST = 1, 3


def bit(rule: str) -> int:
    return 1 << [name for name, _ in RULES].index(rule)


def mask(version: int) -> int:
    """The bits of the rules that reject in this version."""
    return sum(map(bit, POLICIES[version]))


def _covered(windows: Column) -> Column:
    """How many words lie in windows that occur twice, of (h, i) in order: equal hashes are neighbours, and a window covers what lies up to the next one."""

    def of_places(places: Column) -> Column:
        until = F.transform(places, lambda p, k: F.coalesce(F.least(F.get(places, k + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(until, F.lit(0).cast("long"), lambda total, n: total + n)

    same = lambda k, h: F.coalesce(F.get(windows, k).h == h, F.lit(False))
    twice = F.filter(windows, lambda w, k: same(k - 1, w.h) | same(k + 1, w.h))
    return let(F.sort_array(F.transform(twice, lambda w: w.i)), of_places)


def repeated_words(words: Column) -> Column:
    """Of an array of words: how many lie in a window of WINDOW words that is found twice or more. A repeated window repeats five runs of four words, which few texts do, so only those
    are looked at in windows. Elements are read by their place, as a slice copies the whole array; runs that begin near the end are cut short, and left out in the end."""
    none, half = F.lit(0).cast("long"), WINDOW // 2

    def of_halves(halves: Column) -> Column:
        whole = F.transform(halves, lambda h, i: F.struct(F.xxhash64(h, F.get(halves, i + half)).alias("h"), i.alias("i")))
        windows = F.filter(whole, lambda x: x.i <= F.size(halves) - WINDOW)
        return F.when(F.size(halves) - F.size(F.array_distinct(halves)) <= half, none).otherwise(let(F.sort_array(windows), _covered))

    halves = F.transform(words, lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, half))))
    return F.when(F.size(words) <= WINDOW, none).otherwise(let(halves, of_halves))


def measurements(text: Column) -> Column:
    """A struct of all figures that rules use."""
    text = F.coalesce(text, F.lit(""))
    count = lambda x: x.cast("long")
    of_words = lambda w: F.struct(count(F.size(w)).alias("n_words"), count(F.size(F.filter(w, lambda x: x.rlike(r"\p{L}")))).alias("n_alphabetic_words"), repeated_words(w).alias("n_repeat_words"))
    of_lines = lambda x: F.struct(count(F.size(x)).alias("n_lines"), count(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))
    words = let(split_words(text), of_words)
    lines = let(F.filter(F.split(text, "\n"), lambda x: x.rlike(NO_BLANK)), of_lines)
    return F.struct(
        words.alias("w"), lines.alias("l"), count(F.length(F.regexp_replace(text, BLANKS, ""))).alias("word_chars"), count(F.regexp_count(text, F.lit(r"[#*$%&|<>]"))).alias("n_symbols"),
        count(F.length(F.regexp_replace(text, r"\P{Lu}+", ""))).alias("n_capitals"),
    )


#: Columns of the ledger besides those of the documents.
MEASURED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_alphabetic_words", "n_lines", "n_capitals"]


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns of docs but for the text, the measurements and fail_bits (long)."""
    taken = {c.lower() for c in [*MEASURED, "fail_bits", text]}
    own = [c for c in docs.columns if c.lower() not in taken]
    flat = docs.select(*(F.col(f"`{c}`") for c in own), measurements(F.col(f"`{text}`")).alias("__m"))
    flat = flat.select(*(f"`{c}`" for c in own), *(F.col(f"__m.{'w.' * (c in ('n_words', 'n_alphabetic_words', 'n_repeat_words'))}{'l.' * (c in ('n_lines', 'n_dup_lines'))}{c}") for c in MEASURED))
    bits = F.lit(0).cast("long")
    for k, (_, condition) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(1 << k)).otherwise(0).cast("long"))
    return flat.withColumn("fail_bits", bits)


def rejected(version: int = LATEST) -> Column:
    """Of a row of the ledger: true if the policy of this version rejects it."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(version))) != 0


def ablations(rows: DataFrame, version: int = LATEST, by: str | None = None) -> DataFrame:
    """Of a ledger, for each rule of the policy (and each value of `by`): fails, alone (documents that fail no other rule of the policy: they would come back without it), rejected (by the
    whole policy) and rejected_without (by the policy without this rule). Counted over the distinct values of the bits, which are as many as documents fail in different ways."""
    keys = [] if by is None else [F.col(f"`{by}`").alias("part")]
    cells = rows.select(*keys, F.col("fail_bits").bitwiseAND(F.lit(mask(version))).alias("bits")).groupBy(*(["part"] * bool(keys)), "bits").agg(F.count("*").alias("n"))
    rule = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(bit(name)).cast("long").alias("bit")) for name in POLICIES[version]))).alias("r")
    each = cells.select("*", rule)
    of = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    bits, own = F.col("bits"), F.col("r.bit")
    return each.groupBy(*(["part"] * bool(keys)), "r.rule").agg(of(bits.bitwiseAND(own) != 0).alias("fails"), of(bits == own).alias("alone"), of(bits != 0).alias("rejected"), of(bits.bitwiseAND(F.bitwise_not(own)) != 0).alias("rejected_without"))


def compare(rows: DataFrame, old: int, new: int) -> DataFrame:
    """Of a ledger: counts by what two versions of the policy decide: (rejected_old, rejected_new, n)."""
    return rows.groupBy(rejected(old).alias("rejected_old"), rejected(new).alias("rejected_new")).agg(F.count("*").alias("n"))
