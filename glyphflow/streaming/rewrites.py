"""Rewriting on streams: the kernel is a projection without state; repeated values are dropped within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glyphflow.functions.kernel import rewrite


def rewritten(stream: DataFrame, program: str, value: str = "value", max_steps: int = 10_000, max_length: int = 1000) -> DataFrame:
    """The stream with output, steps, terminating and error of a program on its values."""
    return stream.withColumn("o", rewrite(program, F.col(value), max_steps, max_length)).select(*stream.columns, "o.*")


def first_of_each(stream: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """The first row of each key; state is dropped when it is older than the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def rates(stream: DataFrame, time: str, window: str, late: str) -> DataFrame:
    """Per window: rows, and how many ended."""
    spans = stream.withWatermark(time, late).groupBy(F.window(time, window))
    return spans.agg(F.count(F.lit(1)).alias("n"), F.count_if("terminating").alias("n_terminating")).select("window.start", "window.end", "n", "n_terminating")
