"""Quality rules: a threshold table compiled into one projection.

Every metric is an integer that built-in functions compute from the whole
text, every rule compares two linear terms, and the table of rules becomes one
boolean column. Nothing is shuffled and no user function runs.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, body

# The most frequent function words of English, French, German and
# Spanish, lower case. Running text of these languages has one in three to six words.
STOP_WORDS = (
    "the of and to in a is that it for on with as was at by an be this "
    "le la les de des et un une en du que est pour dans qui par sur avec "
    "der die das und den von zu mit ist ein eine nicht im für auf dem sich "
    "el los las y por para con una del se lo no su al"
).split()

#: The languages of these words, and so of the rule on them.
STOP_LANGUAGES = ("en", "fr", "de", "es")

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """A document passes when ``times * metric <= bound * per``; both are metric names.

    A rule of some languages only passes every document that names another one.
    """

    name: str
    times: int
    metric: str
    bound: int
    per: str
    languages: tuple[str, ...] = ()

    def passes(self, lang: str | None = None) -> Column:
        held = F.lit(self.times) * F.col(self.metric) <= F.lit(self.bound) * F.col(self.per)
        if lang is None or not self.languages:
            return held
        return held | F.coalesce(~F.lower(F.regexp_substr(lang, F.lit("^[^-_]*"))).isin(*self.languages), F.lit(False))


#: Production thresholds. Ratios are scaled to integers, so no engine rounds them.
RULES = (
    Rule("word length at most 20", 1, "word_chars", 20, "n_words"),
    Rule("word length at least 2", 2, "n_words", 1, "word_chars"),
    Rule("symbols at most a fifth of words", 5, "n_symbols", 1, "n_words"),
    Rule("repeated lines at most 60 in 100", 100, "n_dup_lines", 60, "n_lines"),
    Rule("a function word in 50 words", 1, "n_words", 50, "n_stop_words", STOP_LANGUAGES),
)

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


def with_metrics(df: DataFrame, text: str = "text", stop_words: list[str] | None = None) -> DataFrame:
    """Add the integer metrics to df, which keeps its columns.

    Words are maximal runs outside white space. ``n_repeat_words`` counts the
    words inside three-word windows that occur twice or more in the text: the
    windows are sorted within the row, equal neighbours mark their positions,
    and the union of the marked windows is measured: n log n, also in very long
    texts.
    """
    stops = list(stop_words or STOP_WORDS)
    # Names that no column of df has.
    t_, w_, l_, h_, g_, p_ = (f"{name}-{uuid.uuid4().hex}" for name in "twlhgp")
    out = df.withColumn(t_, body(text))
    out = out.withColumn(w_, F.array_remove(F.split(t_, f"[{SPACE}]+"), ""))
    out = out.withColumn(l_, F.filter(F.split(t_, "\n"), lambda x: x.rlike(f"[^{SPACE}]")))
    out = out.withColumns(
        {
            "n_words": F.size(w_).cast("long"),
            "word_chars": F.length(F.array_join(w_, "")).cast("long"),
            "n_symbols": (F.length(t_) - F.length(F.regexp_replace(t_, f"[{SYMBOLS}]", ""))).cast("long"),
            "n_lines": F.size(l_).cast("long"),
            "n_dup_lines": (F.size(l_) - F.size(F.array_distinct(l_))).cast("long"),
            "n_stop_words": F.size(F.filter(w_, lambda x: F.lower(x).isin(stops))).cast("long"),
        }
    )
    def windows(make):
        return F.transform(F.sequence(F.lit(0), F.size(w_) - 3), lambda i: make(i, F.get(w_, i), F.get(w_, i + 1), F.get(w_, i + 2)))

    # Equal windows have equal hashes, so only rows with a repeated hash look at the strings.
    out = out.withColumn(h_, F.when(F.col("n_words") >= 3, windows(lambda i, a, b, c: F.xxhash64(a, b, c))))
    strings = windows(lambda i, a, b, c: F.struct(F.xxhash64(a, b, c).alias("h"), F.concat_ws(" ", a, b, c).alias("g"), i.alias("i")))
    out = out.withColumn(g_, F.when(F.size(h_) > F.size(F.array_distinct(h_)), F.sort_array(strings)))
    near = lambda k: F.get(g_, k)["g"]
    marked = F.filter(g_, lambda x, k: F.coalesce(x.g == near(k - 1), F.lit(False)) | F.coalesce(x.g == near(k + 1), F.lit(False)))
    out = out.withColumn(p_, F.sort_array(F.transform(marked, lambda x: x.i)))
    covered = F.aggregate(
        F.transform(p_, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(p_, k + 1) - p, F.lit(3)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    out = out.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return out.drop(t_, w_, l_, h_, g_, p_)


def compile_rules(rules=RULES, lang: str | None = None) -> Column:
    """The conjunction of a table of rules, as one column."""
    verdict = F.lit(True)
    for rule in rules:
        verdict = verdict & rule.passes(lang)
    return verdict


def quality(df: DataFrame, text: str = "text", rules=RULES, min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT, stop_words: list[str] | None = None, lang: str | None = None) -> DataFrame:
    """Add metrics, ``base_failed``, ``failed_rules`` and ``kept`` to df.

    ``lang`` names a column of language tags ("en", "en-GB"): the rule on function
    words then leaves alone what is tagged with a language that STOP_WORDS does not
    cover, and judges the rest, texts of a null tag too. Without it, or with a list of
    the caller's in ``stop_words``, which replaces STOP_WORDS, all texts are judged.

    Null and empty texts have no words, so they fail the base rule. Rows are
    judged one by one: ties and repeated rows get the same verdict each, an
    empty table stays empty. Columns of df that have the name of an added one
    are replaced; others pass through.
    """
    out = with_metrics(df, text, stop_words)
    lang = None if stop_words else lang
    failed = (F.col("n_words") < min_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(max_repeat_percent) * F.col("n_words"))
    names = F.array_compact(F.array(*[F.when(~r.passes(lang), F.lit(r.name)) for r in rules]))
    out = out.withColumns({"base_failed": failed, "failed_rules": F.array_join(names, "; ")})
    return out.withColumn("kept", ~F.col("base_failed") & compile_rules(rules, lang))
