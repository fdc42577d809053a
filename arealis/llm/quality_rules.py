"""Quality rules: a threshold table compiled into one projection.

Everything runs as built-in expressions; a document never leaves its task and
nothing is shuffled, so the cost is one scan whatever the skew.

Defined results: a null text is an empty one (no words, ``base_failed``); a
repeated row gives repeated result rows; an empty table an empty result; a
null id stays null. Columns beyond id and text are ignored, whatever they are
called. The work on a text of n words is O(n log n).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.llm.common import SPACE

# Frequent function words of English, German, French and Spanish.
_FUNCTION_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was were with "
    "auf das dem den der des die ein eine für ich ist mit nicht sich und von zu "
    "au avec ce dans de des du en est et il je la le les ne pas pour qui que sur un une "
    "al con del el en es la las los no para por que se su un una y "
).split()
STOP_WORDS = sorted({form for w in _FUNCTION_WORDS for form in (w, w.capitalize())})

#: Characters counted as symbols, and the window in which words count as repeated.
SYMBOLS, WINDOW = "#*$%&|<>", 5

#: name -> (measure, "min" or "max", threshold). A document is kept if it breaks no rule.
RULES: dict[str, tuple[str, str, float]] = {
    "symbols_per_word": ("symbol_ratio", "max", 0.30),
    "mean_word_chars_low": ("mean_word_chars", "min", 1.5),
    "mean_word_chars_high": ("mean_word_chars", "max", 18.0),
    "stop_words_per_word": ("stop_ratio", "min", 0.01),
    "repeated_lines": ("dup_line_ratio", "max", 0.60),
}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once: an optimizer that inlines it into a lambda would compute it for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(windows: Column) -> Column:
    """Words inside windows that occur twice or more: the size of the union of those windows."""

    def of(ordered: Column) -> Column:
        same = lambda p, i: p["h"].eqNullSafe(F.get(ordered, i)["h"])
        found = F.filter(ordered, lambda p, i: same(p, i - 1) | same(p, i + 1))
        return let(F.sort_array(F.transform(found, lambda p: p["i"])), gaps)

    def gaps(at: Column) -> Column:
        reach = F.transform(at, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

    pairs = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(let(F.sort_array(pairs), of))


def measured(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id with the counts and ratios that rules are written in."""
    df = docs.select(F.col(id_column), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    df = df.withColumns(
        {
            "_words": F.array_remove(F.split("_text", f"{SPACE}+"), ""),
            "_lines": F.filter(F.split("_text", "\n"), lambda x: x.rlike(f"[^{SPACE[1:-1]}]")),
        }
    )
    df = df.withColumns({"n_words": F.size("_words").cast("long"), "_keys": F.transform("_words", lambda w: F.xxhash64(w))})
    n_windows = F.greatest(F.size("_keys") - (WINDOW - 1), F.lit(0))
    shifted = [F.slice("_keys", F.lit(j + 1), n_windows).alias(f"k{j}") for j in range(WINDOW)]
    df = df.withColumn("_windows", F.transform(F.arrays_zip(*shifted), lambda s: F.xxhash64(s)))
    n = F.greatest(F.col("n_words"), F.lit(1))
    return (
        df.withColumns(
            {
                "word_chars": F.length(F.array_join("_words", "")).cast("long"),
                "n_symbols": F.regexp_count("_text", F.lit(f"[{SYMBOLS}]")).cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": _covered(F.col("_windows")),
                "n_stop_words": F.size(F.filter("_words", lambda w: w.isin(STOP_WORDS))).cast("long"),
                "n_lines": F.size("_lines").cast("long"),
            }
        )
        .drop("_text", "_words", "_lines", "_keys", "_windows")
        .withColumns(
            {
                "symbol_ratio": F.col("n_symbols") / n,
                "mean_word_chars": F.col("word_chars") / n,
                "stop_ratio": F.col("n_stop_words") / n,
                "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            }
        )
    )


def compile_rules(rules: dict[str, tuple[str, str, float]]) -> Column:
    """True if no rule is broken."""
    verdict = F.lit(True)
    for measure, side, threshold in rules.values():
        verdict = verdict & (F.col(measure) >= threshold if side == "min" else F.col(measure) <= threshold)
    return verdict


def quality_rules(docs: DataFrame, rules: dict[str, tuple[str, str, float]] = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, the base rule and the verdict for each document."""
    df = measured(docs, id_column, text_column)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    df = df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
    first = [id_column, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return df.select(*first, "n_stop_words", "n_lines")
