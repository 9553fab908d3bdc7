"""Spans of regular-expression matches, as column expressions.

Spark has functions for the strings that match and for the text between them,
but none for where they stand. Here the two interleave: match k starts behind
gaps 0..k and matches 0..k-1. Positions count code points, ends are exclusive.

Patterns must not match the empty string, and should not let one match attempt
run over text that many others run over too (Java's engine backtracks): begin
runs of a class with ``run_start``, and use possessive repeats of groups, which
the engine repeats in a loop and not by recursion.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements that one step of a running sum adds up.
BLOCK = 64

SPANS = "array<struct<start: int, stop: int, value: string>>"


def run_start(char_class: str) -> str:
    """Zero-width: where a run of the class begins, or where the last match ended.

    In ``run_start(c) + [c]++ + rest`` with a rest that can't begin within the
    run, later starts in a run fail just as its first does, so trying none of them
    finds the same matches in linear time."""
    return f"(?:(?<![{char_class}])|\\G)"


def running_sums(values: Column) -> Column:
    """Inclusive running sums of an array<int>, in blocks: linear but for a small square root."""
    total = lambda x: F.aggregate(x, F.lit(0), lambda a, v: a + v)
    n_blocks = F.ceil(F.size(values) / F.lit(BLOCK)).cast("int")
    blocks = F.transform(F.sequence(F.lit(1), n_blocks), lambda b: total(F.slice(values, (b - 1) * BLOCK + 1, F.lit(BLOCK))))
    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(F.flatten(F.transform(
        blocks,
        lambda _, b: F.transform(
            F.slice(values, b * BLOCK + 1, F.lit(BLOCK)),
            lambda _, i: total(F.slice(blocks, F.lit(1), b)) + total(F.slice(values, b * BLOCK + 1, i + 1)),
        ),
    )))


def add_matches(df, text: str, patterns: dict[str, str]):
    """Add a column of SPANS for every (name, pattern). Three projections, so that
    each pattern runs over the text twice and no expression is copied."""
    own = [c for c in df.columns]
    step = df.select(
        *own,
        *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"__m_{k}") for k, p in patterns.items()],
    )
    none = F.array().cast("array<int>")

    def widths(k: str, p: str) -> Column:
        gaps = F.transform(F.split(text, p), lambda x: F.length(x))
        pair = F.zip_with(gaps, F.transform(f"__m_{k}", lambda x: F.length(x)), lambda g, m: F.struct(g.alias("g"), m.alias("m")))
        # start k is the end of match k-1 plus gap k
        sums = F.transform(pair, lambda x, i: x["g"] + F.coalesce(F.get(pair, i - 1)["m"], F.lit(0)))
        return F.when(F.size(f"__m_{k}") > 0, sums).otherwise(none)

    step = step.select(*own, *[f"__m_{k}" for k in patterns], *[widths(k, p).alias(f"__w_{k}") for k, p in patterns.items()])
    step = step.select(*own, *[f"__m_{k}" for k in patterns], *[running_sums(F.col(f"__w_{k}")).alias(f"__s_{k}") for k in patterns])
    spans = lambda k: F.transform(
        f"__m_{k}",
        lambda m, i: F.struct(
            F.get(f"__s_{k}", i).alias("start"), (F.get(f"__s_{k}", i) + F.length(m)).alias("stop"), m.alias("value"),
        ),
    )
    return step.select(*own, *[spans(k).alias(k) for k in patterns])


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of array<struct<start, kind_order, kind, stop>>-like spans, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
