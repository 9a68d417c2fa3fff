"""Quality rules: a threshold table compiled into one Spark projection.

Every measure is a column expression over the whole text (no user functions), a
rule bounds one measure or the ratio of two, and the verdict is the conjunction
of all rules. A null text has no words and fails on length.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, word_list

SYMBOL = "[#*$%&|<>]"

# Frequent function words per language.
STOP_WORDS = (
    "the of and to in is that it was for on are as with be this by at from or an he have not "
    "der die das und in den von zu mit ist auf ein eine im dem nicht für als auch sich des "
    "le la les de des et en un une du que est pour dans qui par sur au pas elle ce il "
    "el los las y del se con por una su para al lo como más que no es").split()


@dataclass(frozen=True)
class Rule:
    """``low <= measure (/ per) <= high``; a ratio over nothing is 0."""

    name: str
    measure: str
    per: str | None = None
    low: float | None = None
    high: float | None = None

    def holds(self) -> Column:
        value = F.col(self.measure).cast("double")
        if self.per is not None:
            value = F.when(F.col(self.per) > 0, value / F.col(self.per)).otherwise(0.0)
        tests = [value >= self.low] if self.low is not None else []
        tests += [value <= self.high] if self.high is not None else []
        return reduce(lambda a, b: a & b, tests, F.lit(True))


#: The production table: length, symbol, stop-word and line ratios.
RULES = (
    Rule("long enough", "n_words", low=50),
    Rule("little repetition", "n_repeat_words", "n_words", high=0.5),
    Rule("word length", "word_chars", "n_words", low=2, high=12),
    Rule("few symbols", "n_symbols", "n_words", high=0.1),
    Rule("stop words", "n_stop_words", "n_words", low=0.02),
    Rule("few repeated lines", "n_dup_lines", "n_lines", high=0.3),
    Rule("few list lines", "n_bullet_lines", "n_lines", high=0.9),
    Rule("few cut lines", "n_ellipsis_lines", "n_lines", high=0.3),
)


def _repeated(df: DataFrame, words: str, out: str) -> DataFrame:
    """Words inside 3-word windows that the text holds at least twice.

    Windows are compared by hash first: a text whose hashes all differ has no
    repeat. In any other the hashes are sorted with their places, and the windows
    that share a hash are sorted once more as text, so that equal ones are
    neighbours and chance hits fall out. Each step is a column of its own, so no
    array is built again inside a lambda.
    """
    windows = F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0)))
    df = df.withColumn("_g", F.transform(
        windows, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))))
    df = df.withColumn("_r", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), F.sort_array(
        F.transform("_g", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))

    def twice(column):
        near = lambda s, k: F.coalesce(s["g"] == F.get(column, k)["g"], F.lit(False))
        return F.filter(column, lambda s, k: near(s, k - 1) | near(s, k + 1))

    df = df.withColumn("_r", twice("_r"))
    df = df.withColumn("_r", F.sort_array(F.transform("_r", lambda s: F.struct(F.concat_ws(
        " ", F.get(words, s["i"]), F.get(words, s["i"] + 1), F.get(words, s["i"] + 2)).alias("g"), s["i"].alias("i")))))
    df = df.withColumn("_h", F.sort_array(F.transform(twice("_r"), lambda s: s["i"])))
    covered = F.transform("_h", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("_h", k + 1) - x, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return df.withColumn(out, F.coalesce(total, F.lit(0).cast("bigint")))


def measure(docs: DataFrame, text: str = "text", stop_words=STOP_WORDS) -> DataFrame:
    """All columns of ``docs`` under ``doc`` and the measures beside it.

    Columns of ``docs`` may have any names: they travel inside one struct. The
    measures leave through ``inline``, so that a condition on them is a condition on
    finished values and is not put together again from the text.
    """
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), text_or_empty(text).alias("_t"))
    df = df.withColumns({"_w": word_list(F.col("_t")),
                         "_l": F.filter(F.split("_t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))})
    df = _repeated(df, "_w", "n_repeat_words")
    forms = sorted({f for w in stop_words for f in (w, w.capitalize())})
    count = lambda n: n.cast("bigint")
    return df.select(F.inline(F.array(F.struct(
        "doc",
        count(F.size("_w")).alias("n_words"),
        count(F.length(F.array_join("_w", ""))).alias("word_chars"),
        count(F.regexp_count("_t", F.lit(SYMBOL))).alias("n_symbols"),
        count(F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
        "n_repeat_words",
        count(F.size(F.filter("_w", lambda w: w.isin(*forms)))).alias("n_stop_words"),
        count(F.size("_l")).alias("n_lines"),
        count(F.size(F.filter("_l", lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•")))).alias("n_bullet_lines"),
        count(F.size(F.filter("_l", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")))).alias("n_ellipsis_lines")))))


def verdicts(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """Measures plus ``failed`` (names of the broken rules) and ``kept``."""
    scored = measure(docs, text)
    broken = F.filter(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules]), lambda n: n.isNotNull())
    return scored.withColumn("failed", broken).withColumn("kept", F.size("failed") == 0)


def keep_good(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that break no rule, with the columns they came with."""
    return verdicts(docs, rules, text).where("kept").select("doc.*")
