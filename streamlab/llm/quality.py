"""Quality rules with risk-controlled cut-offs, by DataFrame functions alone.

Each rule is a measure of the text with cut-offs at ``LEVELS`` levels, loosest first. Per stratum
the labelled holdout tells how many good documents the rules of a level would reject. A stratum is
a source with ``LEAST_HOLDOUT`` good documents or more; the sources with fewer are one stratum
together, and the promise is made for it as a whole. A level is usable where the chance of seeing
so few rejections, were the true rate of false rejection ``ALPHA`` or more, is at most ``DELTA``
divided by the number of strata (Bonferroni): the exact binomial bound. Within a stratum the levels
are tested in their order, up to the first that fails, so that testing several costs nothing: what
a level rejects, all stricter ones do. Each stratum takes its strictest usable level; where none is,
and for sources without a labelled document, the rules reject nothing. So with confidence
``1 - DELTA`` no stratum loses ``ALPHA`` of its good documents or more to the rules.

Handling of odd input: NULL and empty texts have no words and fail the base rules; a NULL source
is a stratum of its own, shared with the empty one; documents without a label, and labels without
a document, take no part in the choice; an id with several labels is good if one of them says so;
repeated rows are judged alike, and count each; a measure equal to a cut-off passes; very long texts
are measured whole; an empty table gives no rows. The other columns but the text are passed on,
those named like an output are replaced; inner columns begin with ``__quality``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlab.llm.session import written

ALPHA = 0.02
DELTA = 0.05
LEVELS = 7
LEAST_HOLDOUT = 400  # good documents that make a source a stratum of its own
# rule -> cut-off per level: a document whose measure is above the cut-off is rejected
RULES = {
    "symbols": (2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05),
    "dup_lines": (0.7, 0.5, 0.3, 0.2, 0.1, 0.07, 0.05),
    "repeats": (0.2, 0.19, 0.18, 0.17, 0.16, 0.15, 0.14),
    "long_words": (60.0, 40.0, 30.0, 25.0, 20.0, 16.0, 13.0),
    "short_words": (2.0, 1.0, 0.9, 0.8, 0.7, 0.6, 0.5),
}
_SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_SPACE_RUN = r"[\x20\x09-\x0D]+"
_WINDOW = 5


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Arrays that a lambda looks into are columns of their own, so that each is made once per row.
    Windows are sorted with their places; a window equal to a neighbour is a repeat. Each repeated
    place covers five words, less what the next repeated place covers too.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda line: F.length(F.translate(line, _SPACES, "")) > 0)
    w, count, h, placed, p = (F.col(c) for c in ("__quality_words", "__quality_count", "__quality_windows", "__quality_placed", "__quality_places"))
    window = F.transform(
        F.sequence(F.lit(0), count - _WINDOW), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(_WINDOW)))
    )
    out = docs.withColumns(
        {
            "word_chars": F.char_length(F.translate(body, _SPACES, "")).cast("long"),
            "n_symbols": (F.char_length(body) - F.char_length(F.translate(body, _SYMBOLS, ""))).cast("long"),
            "__quality_lines": lines,
            "__quality_words": F.filter(F.split(body, _SPACE_RUN), lambda x: x != ""),
        }
    )
    out = out.withColumns(
        {"n_dup_lines": (F.size("__quality_lines") - F.size(F.array_distinct("__quality_lines"))).cast("long"), "__quality_count": F.size("__quality_words")}
    ).drop("__quality_lines")
    out = out.withColumns({"n_words": count.cast("long"), "__quality_windows": F.when(count >= _WINDOW, window)}).drop("__quality_words", "__quality_count")
    repeated = F.size(F.array_distinct(h)) < F.size(h)
    out = out.withColumn(
        "__quality_placed", F.when(repeated, F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))
    ).drop("__quality_windows")

    def twice(x: Column, k: Column) -> Column:
        return F.when((F.get(placed, k - 1)["h"] == x["h"]) | (F.get(placed, k + 1)["h"] == x["h"]), x["i"])

    out = out.withColumn("__quality_places", F.array_sort(F.array_compact(F.transform(placed, twice)))).drop("__quality_placed")
    step = F.transform(p, lambda i, k: F.when(k > 0, F.least(i - F.get(p, k - 1), F.lit(_WINDOW))).otherwise(_WINDOW))
    out = out.withColumn("__quality_steps", step).drop("__quality_places")
    covered = F.aggregate("__quality_steps", F.lit(0), lambda total, d: total + d)
    return out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("__quality_steps")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    """Measure of each rule; none for a text without words, which the base rules reject."""
    words = F.col("n_words").cast("double")
    return {
        "symbols": F.try_divide("n_symbols", words),
        "dup_lines": F.try_divide("n_dup_lines", words),
        "repeats": F.try_divide("n_repeat_words", words),
        "long_words": F.try_divide("word_chars", words),
        "short_words": F.lit(1) / F.try_divide("word_chars", words),
    }


def tail(n: Column, k: Column, alpha: float) -> Column:
    """P(Binomial(n, alpha) <= k), the terms summed from their logarithms."""
    n, k = n.cast("long"), k.cast("long")
    start = F.struct((n * F.log(F.lit(1 - alpha))).alias("term"), F.exp(n * F.log(F.lit(1 - alpha))).alias("sum"))
    odds = F.log(F.lit(alpha / (1 - alpha)))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i.cast("double")) + odds
        return F.struct(term.alias("term"), (acc["sum"] + F.exp(term)).alias("sum"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, start, add, lambda acc: F.least(acc["sum"], F.lit(1.0)))


def level() -> Column:
    """First level whose rules reject the document; ``LEVELS`` where none does."""
    first = []
    for rule, value in rule_values().items():
        over = F.lit(LEVELS)
        for t in reversed(range(LEVELS)):
            over = F.when(value > RULES[rule][t], t).otherwise(over)
        first.append(over)
    return F.least(*first)


def strictest(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per source the strictest level whose false rejection is controlled; NULL where none is."""
    good = labels.where("quality = 1").select(F.col("doc_id").alias("__quality_good")).distinct()
    holdout = measured.where(~base_failed()).join(good, F.col("doc_id") == F.col("__quality_good"), "left_semi")
    counted = holdout.groupBy(F.coalesce("source", F.lit("")).alias("__quality_stratum")).agg(
        F.count("*").alias("n"), *(F.count_if(F.col("__quality_level") <= t).alias(f"k{t}") for t in range(LEVELS))
    )
    counted = written(counted, "holdout")  # a row per source
    own = F.col("n") >= LEAST_HOLDOUT
    together = Window.partitionBy(own, F.when(own, F.col("__quality_stratum")))
    pooled = counted.select("__quality_stratum", own.alias("own"), *(F.sum(c).over(together).alias(c) for c in ("n", *(f"k{t}" for t in range(LEVELS)))))
    large, small = counted.agg(F.count_if(own), F.count_if(~own)).first()
    bound = delta / max(1, large + min(small, 1))
    usable = []
    for t in range(LEVELS):
        few = F.col(f"k{t}") <= F.col("n") * alpha  # else the chance is near one half or more
        usable.append(F.when(few & (tail(F.col("n"), F.when(few, F.col(f"k{t}")).otherwise(0), alpha) <= bound), t))
    return pooled.select("__quality_stratum", F.greatest(*usable).alias("__quality_strictest"))


def judge(docs: DataFrame, labels: DataFrame, text: str = "text", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The columns of ``docs`` but the text, the measures, ``base_failed`` and ``kept``."""
    measured = measures(docs, text).drop(text).withColumn("base_failed", base_failed()).withColumn("__quality_level", level())
    measured = written(measured, "measures")
    levels = strictest(measured, labels, alpha, delta)
    rejected = F.coalesce(F.col("__quality_level") <= F.col("__quality_strictest"), F.lit(False))
    return (
        measured.join(levels, F.coalesce("source", F.lit("")) == F.col("__quality_stratum"), "left")
        .withColumn("kept", ~(F.col("base_failed") | rejected)).drop("__quality_stratum", "__quality_strictest", "__quality_level")
    )
