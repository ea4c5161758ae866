"""Quality rules: a table of thresholds compiled into Spark columns, without user functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.rows import unwrapped, wrapped

#: Characters counted as symbols, and the white space that separates words.
SYMBOLS = "#*$%&|<>"
SPACE = "\\x20\\x09-\\x0D"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = [
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "not", "he", "this", "are", "or",
    "der", "die", "das", "und", "zu", "den", "ist", "mit", "von", "auf", "für", "ein", "im", "dem", "nicht", "des", "sich", "als", "auch", "es",
    "le", "la", "les", "de", "et", "un", "une", "du", "est", "que", "en", "dans", "pour", "par", "sur", "qui", "au", "pas", "plus", "avec",
    "el", "los", "las", "y", "una", "por", "con", "no", "su", "para", "se", "lo", "del", "al", "como",
]


@dataclass(frozen=True)
class Rule:
    """A metric must lie in [least, most]; the rule applies to texts of at least `from_words` words."""

    metric: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: The table: length, mean word length, symbols per word, repeated lines per line, stop words per word.
RULES = (
    Rule("n_words", least=10, most=1_000_000),
    Rule("mean_word_chars", least=2.0, most=12.0),
    Rule("symbol_ratio", most=0.1),
    Rule("dup_line_ratio", most=0.4),
    Rule("repeat_ratio", most=0.2),
    Rule("stop_word_ratio", least=0.05, from_words=30),
)

METRICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words"]


def compiled(rules: tuple[Rule, ...]) -> Column:
    """One column, true where every rule holds."""
    verdict = F.lit(True)
    for rule in rules:
        value = F.col(rule.metric)
        holds = F.lit(True)
        if rule.least is not None:
            holds = holds & (value >= rule.least)
        if rule.most is not None:
            holds = holds & (value <= rule.most)
        verdict = verdict & ((F.col("n_words") < rule.from_words) | holds)
    return verdict


def _repeated_words(df: DataFrame) -> DataFrame:
    """n_repeat_words: words inside 5-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hash; only a text with two equal hashes is sorted. Every array that a lambda looks into
    is a column of its own, so that it is built once per row.
    """
    df = df.withColumn("_h", F.when(F.size("_w") >= 5, F.transform(F.sequence(F.lit(1), F.size("_w") - 4), lambda i: F.xxhash64(F.slice("_w", i, 5)))))
    again = F.size(F.array_distinct("_h")) < F.size("_h")
    df = df.withColumn("_s", F.when(again, F.array_sort(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    near = lambda x, k: (x["h"] == F.get("_s", k - 1)["h"]) | (x["h"] == F.get("_s", k + 1)["h"])
    df = df.withColumn("_p", F.array_sort(F.transform(F.filter("_s", lambda x, k: F.coalesce(near(x, k), F.lit(False))), lambda x: x["i"])))
    covered = F.transform("_p", lambda p, k: F.least(F.lit(5), F.coalesce(F.get("_p", k + 1) - p, F.lit(5))))
    return df.withColumn("n_repeat_words", F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"))


def with_quality(df: DataFrame, text_col: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows with METRICS, base_failed and kept. Columns of these names are replaced, all others stay.

    Words are runs without white space. base_failed: fewer than 10 words, or over a fifth of them in repeated windows. kept:
    not base_failed, and all rules hold. A NULL or empty text has no words and fails. One projection per row, no shuffle.
    """
    columns = df.columns
    text = F.col("_t")
    df = wrapped(df, _t=F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df = df.withColumn("_w", F.filter(F.split(text, f"[{SPACE}]+"), lambda w: w != ""))
    df = df.withColumn("_l", F.filter(F.split(text, "\n"), lambda line: F.translate(line, " \t\n\x0b\f\r", "") != ""))
    df = _repeated_words(df)
    plain = F.transform("_w", lambda w: F.lower(F.btrim(w, F.lit(".,;:!?\"'()"))))
    counted = df.select(
        "row",
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("_l").cast("long").alias("n_lines"),
        F.size(F.filter(plain, lambda w: w.isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
    )
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    ratios = {
        "mean_word_chars": F.col("word_chars") / words, "symbol_ratio": F.col("n_symbols") / words, "dup_line_ratio": F.col("n_dup_lines") / lines,
        "repeat_ratio": F.col("n_repeat_words") / words, "stop_word_ratio": F.col("n_stop_words") / words,
        "base_failed": (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    }
    judged = counted.withColumns(ratios).withColumn("kept", ~F.col("base_failed") & compiled(rules))
    return unwrapped(judged, columns, **{c: F.col(c) for c in [*METRICS, *ratios, "kept"]})
