"""Quality rules: a threshold table compiled into one projection of built-in functions.

Defined results: a null text counts as the empty text; a text with fewer than 50 words fails
the base rule; a ratio whose denominator is zero is 0; input columns with the names of the
added ones are replaced by them; repeated rows are judged alike.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import SPACE_CLASS, words

SYMBOLS = r"[#*$%&|<>]"

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that it for on was be with as at this by are an from or not he his "
    "de la le les que et des un une en du qui est pour dans par sur au pas avec "
    "der die und den von das mit im dem ist zu auf für nicht ein eine sich als auch es "
    "el los y las del se con por una su para al lo"
).split()
STOP_FORMS = [*STOP_WORDS, *(x.capitalize() for x in STOP_WORDS)]


@dataclass(frozen=True)
class Rule:
    """Rejects a document whose metric is below `least` or above `most`."""

    metric: str
    least: float | None = None
    most: float | None = None


#: The threshold table. Ratios are per word, per line or per character as their names say.
RULES = (
    Rule("n_words", least=50),
    Rule("mean_word_chars", least=2.5, most=12.0),
    Rule("symbols_per_word", most=0.15),
    Rule("stop_word_ratio", least=0.02),
    Rule("dup_line_ratio", most=0.45),
    Rule("repeat_word_ratio", most=0.50),
    Rule("upper_char_ratio", most=0.30),
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _ratio(a: str | Column, b: str | Column) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _repeated_at(ordered: Column) -> Column:
    """Sorted positions of the three-word windows that occur twice or more; `ordered` holds (hash, position) by hash."""
    m = F.size(ordered)
    both = F.zip_with(
        F.slice(ordered, F.lit(1), m - 1), F.slice(ordered, F.lit(2), m - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])),
    )
    return F.sort_array(F.array_distinct(F.flatten(F.filter(both, lambda x: x.isNotNull()))))


def _covered(at: Column) -> Column:
    """How many words windows of three at these positions cover."""
    rest = F.greatest(F.size(at) - 1, F.lit(0))
    gaps = F.zip_with(F.slice(at, F.lit(1), rest), F.slice(at, F.lit(2), rest), lambda a, b: F.least(b - a, F.lit(3)))
    return F.when(F.size(at) == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3), lambda s, g: s + g))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the five counts and the ratios of the rules; narrow, without a shuffle."""
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.withColumns({"_body": body, "_words": words(F.col(text)), "_lines": lines})
    w = F.col("_words")
    windows = F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    out = out.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.regexp_count("_body", F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_n_lines": F.size("_lines"),
        "_windows": windows,
        "_upper": F.regexp_count("_body", F.lit(r"\p{Lu}")),
        "_chars": F.length("_body"),
        "_stop": F.size(F.filter(w, lambda x: x.isin(STOP_FORMS))),
    })
    h = F.col("_windows")
    ordered = F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p")))))
    out = out.withColumn("_ordered", ordered)
    out = out.withColumn("_at", F.when(F.col("_ordered").isNotNull(), _repeated_at(F.col("_ordered"))))
    out = out.withColumn("n_repeat_words", F.when(F.col("_at").isNull(), F.lit(0)).otherwise(_covered(F.col("_at"))).cast("long"))
    out = out.withColumns({
        "mean_word_chars": _ratio("word_chars", "n_words"), "symbols_per_word": _ratio("n_symbols", "n_words"),
        "stop_word_ratio": _ratio("_stop", "n_words"), "dup_line_ratio": _ratio("n_dup_lines", "_n_lines"),
        "repeat_word_ratio": _ratio("n_repeat_words", "n_words"), "upper_char_ratio": _ratio("_upper", "_chars"),
    })
    return out.drop("_body", "_words", "_lines", "_n_lines", "_windows", "_upper", "_chars", "_stop", "_ordered", "_at")


def failed(rules: tuple[Rule, ...]) -> Column:
    """The names of the rules that a measured row breaks, as one expression."""
    tests = []
    for r in rules:
        c = F.col(r.metric)
        bad = F.lit(False)
        if r.least is not None:
            bad = bad | (c < F.lit(r.least))
        if r.most is not None:
            bad = bad | (c > F.lit(r.most))
        tests.append(F.when(bad, F.lit(r.metric)))
    return F.array_compact(F.array(*tests))


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with the measures, base_failed, kept and failed_rules."""
    out = measure(docs, text)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumns({"base_failed": base, "failed_rules": failed(rules)}).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def keep(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of docs that pass, with the columns of docs."""
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text).alias("_text"))
    # a filter would be pushed below the measures and repeat them once for every use; a generator is not
    row = F.filter(F.array("_row"), lambda _: F.col("kept"))
    return judge(held, "_text", rules).select(F.explode(row).alias("_row")).select("_row.*")
