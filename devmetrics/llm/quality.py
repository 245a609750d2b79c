"""Quality rules as a short-circuit cascade.

A rule is a condition under which a document is rejected, over metrics of its
text. The cascade tries one rule after another and computes the metrics of a
rule only for documents that every earlier rule let pass. Its order comes from
a sample: the rule that rejects most documents per second of computing goes
first. The verdict is the same in any order; only the work differs.

Defined cases: a null or empty text has no words and is rejected as too short.
Very long texts are read whole. Repeated rows are judged one by one, so equal
texts get equal verdicts. An empty table gives an empty result. Input columns
of any name, also those used here, pass through untouched.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.staging import Workspace
from devmetrics.llm.text import words

SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Rows on which costs and rejections are estimated; the verdict covers all rows.
SAMPLE_ROWS = 2_000


class Rule(NamedTuple):
    name: str
    metrics: tuple[str, ...]
    rejects: Callable[[], Column]


def _row(name: str) -> Column:
    return F.col(f"__{name}")


def _char_count(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("bigint")


def _windows() -> Column:
    """One hash for each run of ``WINDOW`` words."""
    h = _row("hashes")
    made = F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW),
        lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW))),
    )
    return F.when(F.size(h) >= WINDOW, made).otherwise(F.array().cast("array<bigint>"))


def _sorted_windows() -> Column:
    """(hash, start) in order of hash, only for texts that have a repeated window."""
    w = _row("windows")
    pairs = F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("at")))
    return F.when(F.size(F.array_distinct(w)) < F.size(w), F.sort_array(pairs))


def _repeated_starts() -> Column:
    s = _row("sorted_windows")
    twice = F.filter(
        s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])
    )
    return F.sort_array(F.transform(twice, lambda x: x["at"]))


def _covered() -> Column:
    """Words inside the windows that begin at the repeated starts."""
    p = _row("repeated_starts")
    steps = F.transform(
        p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))
    )
    return F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("bigint")


# Each metric and what it needs, in order of need. Every one is a column of its
# own, so that an array is built once and not for each mention of it.
METRICS: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "words": ((), lambda: words(_row("text"))),
    "n_words": (("words",), lambda: F.size(_row("words")).cast("bigint")),
    "word_chars": (
        ("words",),
        lambda: F.aggregate(_row("words"), F.lit(0).cast("bigint"), lambda a, w: a + F.length(w)),
    ),
    "n_symbols": ((), lambda: F.coalesce(_char_count(_row("text"), f"[{SYMBOLS}]"), F.lit(0).cast("bigint"))),
    "lines": (
        (),
        lambda: F.filter(
            F.split(F.coalesce(_row("text"), F.lit("")), "\n", -1),
            lambda x: x.rlike(r"[^\x20\x09-\x0D]"),
        ),
    ),
    "n_lines": (("lines",), lambda: F.size(_row("lines")).cast("bigint")),
    "n_dup_lines": (
        ("lines",),
        lambda: (F.size(_row("lines")) - F.size(F.array_distinct(_row("lines")))).cast("bigint"),
    ),
    "hashes": (("words",), lambda: F.transform(_row("words"), lambda w: F.xxhash64(w))),
    "n_stutters": (
        ("hashes",),
        lambda: F.size(F.filter(_row("hashes"), lambda x, i: F.get(_row("hashes"), i + 1) == x)).cast("bigint"),
    ),
    "windows": (("hashes",), _windows),
    "sorted_windows": (("windows",), _sorted_windows),
    "repeated_starts": (("sorted_windows",), _repeated_starts),
    "n_repeat_words": (("repeated_starts",), _covered),
    "n_upper": ((), lambda: F.coalesce(_char_count(_row("text"), r"\p{Lu}"), F.lit(0).cast("bigint"))),
}

BASE_RULES = (
    Rule("too_short", ("n_words",), lambda: _row("n_words") < 20),
    Rule(
        "repeated_words",
        ("n_words", "n_repeat_words"),
        lambda: 100 * _row("n_repeat_words") > 30 * _row("n_words"),
    ),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", ("n_words", "n_symbols"), lambda: 10 * _row("n_symbols") > _row("n_words")),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda: 10 * _row("n_dup_lines") > 4 * _row("n_lines")),
    Rule(
        "word_length",
        ("n_words", "word_chars"),
        lambda: (_row("word_chars") < 2 * _row("n_words")) | (_row("word_chars") > 12 * _row("n_words")),
    ),
    Rule("upper_case", ("word_chars", "n_upper"), lambda: 2 * _row("n_upper") > _row("word_chars")),
    Rule("stutter", ("n_words", "n_stutters"), lambda: 100 * _row("n_stutters") > 30 * _row("n_words")),
)


def _packed(docs: DataFrame, text: str) -> DataFrame:
    """The input row as one struct beside the text, so that no name can clash."""
    return docs.select(F.struct("*").alias("__row"), F.col(text).alias("__text"))


def with_metrics(df: DataFrame, names: Sequence[str], alive: Column | None = None) -> DataFrame:
    """Adds the metrics that are missing, for the rows where ``alive`` holds."""
    for name in names:
        if f"__{name}" not in df.columns:
            needs, expression = METRICS[name]
            df = with_metrics(df, needs, alive)
            df = df.withColumn(f"__{name}", expression() if alive is None else F.when(alive, expression()))
    return df


def cascade(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``__rejected_by``, the first rule of ``rules`` that rejects the row, else null.

    The last step asks for the partition, which is never below 0: Spark leaves a
    filter above a column that is not deterministic. Pushed below, it would copy the whole cascade
    into one condition, once for each mention of an earlier verdict.
    """
    df = df.withColumn("__rejected_by", F.lit(None).cast("string"))
    alive = _row("rejected_by").isNull()
    for rule in rules:
        df = with_metrics(df, rule.metrics, alive)
        df = df.withColumn(
            "__rejected_by", F.coalesce(_row("rejected_by"), F.when(rule.rejects(), F.lit(rule.name)))
        )
    return df.withColumn("__rejected_by", F.when(F.spark_partition_id() >= 0, _row("rejected_by")))


def order_rules(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> list[Rule]:
    """``rules`` by estimated rejections per second of computing, best first.

    The estimate comes from about ``sample_rows`` rows spread over the whole
    table, at most twice as many. Equal estimates go by name.
    """
    spark = docs.sparkSession
    total = docs.count()
    if not total:
        return list(rules)
    share = min(1.0, sample_rows / total)
    work = Workspace(spark)
    picked = docs.select(F.col(text).alias("__text")).sample(share, seed=17).limit(2 * sample_rows)
    sample = work.write(picked, "sample")

    def measured(rule: Rule) -> tuple[float, str]:
        begin = time.perf_counter()
        out = with_metrics(sample, rule.metrics).agg(
            F.count_if(rule.rejects()), F.count(F.lit(1))
        )
        rejected, rows = out.first()
        seconds = time.perf_counter() - begin
        return -(rejected / max(rows, 1)) / max(seconds, 1e-6), rule.name

    sample.agg(F.count("__text")).first()  # the first job also pays for opening the files
    scored = sorted((measured(rule), i) for i, rule in enumerate(rules))
    work.drop("sample")
    return [rules[i] for _, i in scored]


def quality_filter(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their own columns."""
    ordered = order_rules(docs, rules, text, sample_rows)
    kept = cascade(_packed(docs, text), ordered).filter(_row("rejected_by").isNull())
    return kept.select("__row.*")


def quality_report(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    doc_id: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """The base metrics of every document, whether a base rule fails, and the cascade's verdict."""
    ordered = order_rules(docs, rules, text, sample_rows)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    df = docs.select(F.col(doc_id).alias("__doc_id"), F.col(text).alias("__text"))
    df = cascade(with_metrics(df, base), ordered)
    failed = F.lit(False)
    for rule in BASE_RULES:
        failed = failed | rule.rejects()
    return df.select(
        _row("doc_id").alias("doc_id"),
        *(_row(name).alias(name) for name in base),
        failed.alias("base_failed"),
        (_row("rejected_by").isNull() & ~failed).alias("kept"),
    )
