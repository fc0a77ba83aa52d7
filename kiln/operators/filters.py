"""Quality filters F1-F8 as one projection of metric and verdict columns.

Every filter runs on every document (no short circuit) because the report
needs all metrics and every failing reason.  The registry holds Column
builders ``(metrics, cfg) -> passed``; ``quality_metrics`` evaluates them in
a single ``select`` so the scan, the metrics and the verdict share one
codegen stage and the text is read once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.config import FilterConfig
from kiln.functions import text as tx


@dataclass(frozen=True)
class QualityFilter:
    name: str  # reason reported when the filter fails
    metric: str  # metric column it reads
    passed: Callable[[FilterConfig], Column]


# Reason names and their order in a document's reason list.
FILTERS: tuple[QualityFilter, ...] = (
    QualityFilter(
        "too_short",
        "char_length",
        lambda c: F.col("char_length").between(c.min_chars, c.max_chars),
    ),
    QualityFilter(
        "high_symbol_ratio",
        "symbol_ratio",
        lambda c: (F.col("char_length") > 0) & (F.col("symbol_ratio") <= F.lit(c.max_symbol_ratio)),
    ),
    QualityFilter(
        "repeated_chars",
        "longest_repeat",
        lambda c: F.col("longest_repeat") <= c.max_repeat_char,
    ),
    QualityFilter(
        "repeated_lines",
        "repeated_lines",
        lambda c: (F.col("_n_lines") > 0) & (F.col("repeated_lines") <= F.lit(c.max_repeated_line_ratio)),
    ),
    QualityFilter(
        "token_count",
        "token_count",
        lambda c: F.col("token_count").between(c.min_token_count, c.max_token_count),
    ),
)

METRICS = ("char_length", "symbol_ratio", "longest_repeat", "repeated_lines", "token_count")


def quality_metrics(
    df: DataFrame,
    cfg: FilterConfig = FilterConfig(),
    text_col: str = "text",
    token_col: str = "token_count",
) -> DataFrame:
    """Adds the five metrics, one ``passed_<reason>`` flag each, ``reasons`` and ``passed``."""
    text = F.col(text_col)
    staged = df.withColumn("_lines", F.array_sort(tx.stripped_lines(text)))
    n_lines, repeated = tx.repeated_line_stats("_lines")
    chars = F.length(text)
    metric_row = F.struct(
        chars.alias("char_length"),
        F.when(chars == 0, F.lit(1.0))
        .otherwise(tx.punctuation_count(text) / chars)
        .alias("symbol_ratio"),
        tx.longest_char_run(text).alias("longest_repeat"),
        n_lines.alias("_n_lines"),
        F.when(n_lines == 0, F.lit(0.0)).otherwise(repeated / n_lines).alias("repeated_lines"),
    )
    # The metrics come out of a one-row generator: a later filter on the
    # verdict cannot be pushed below it, so Catalyst never inlines the text
    # work into the filter condition and each metric is computed once.
    staged = staged.select(*df.columns, F.inline(F.array(metric_row)))
    if token_col != "token_count":
        staged = staged.withColumn("token_count", F.col(token_col))
    flags = [f.passed(cfg).alias(f"passed_{f.name}") for f in FILTERS]
    staged = staged.select("*", *flags)
    reasons = F.array_compact(
        F.array(*[F.when(~F.col(f"passed_{f.name}"), F.lit(f.name)) for f in FILTERS])
    )
    out = staged.withColumn("reasons", reasons).withColumn("passed", F.size("reasons") == 0)
    return out.drop("_n_lines")


def quality_filter(df: DataFrame, cfg: FilterConfig = FilterConfig(), **kw) -> DataFrame:
    """documents passing all five filters, in their original columns."""
    cols = df.columns
    return quality_metrics(df, cfg, **kw).where("passed").select(*cols)
