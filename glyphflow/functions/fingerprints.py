"""Fingerprints of behaviour and of program text, as SHA-256 over canonical JSON; built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

JSON = {"ignoreNullFields": "false"}


def digest(value: Column) -> Column:
    return F.sha2(F.to_json(value, JSON), 256)


def ordered_probes(value: str = "value", output: str = "output", terminating: str = "terminating", error: str = "error") -> Column:
    """Aggregate: the outcomes of a group, by length of the value and then by value."""
    return F.array_sort(F.collect_list(F.struct(F.length(value).alias("n"), F.col(value).alias("i"), F.col(output).alias("o"), F.col(terminating).alias("t"), F.col(error).alias("e"))))


def behavior_signature(probes: Column) -> Column:
    """Of ordered_probes(): equal if and only if all outcomes are equal."""
    return digest(F.transform(probes, lambda p: F.struct(p["e"].alias("error"), p["i"].alias("input"), p["o"].alias("output"), p["t"].alias("terminating"))))


def renamed(stream: Column, alphabet: list[str]) -> tuple:
    """A function that names a character by its first place in the stream: I0, I1, ... of the alphabet, M0, ... of others."""
    known = F.array(*(F.lit(c) for c in alphabet)).cast("array<string>")
    inside = F.array_distinct(F.filter(stream, lambda c: F.array_contains(known, c)))
    outside = F.array_distinct(F.filter(stream, lambda c: ~F.array_contains(known, c)))
    return inside, outside, lambda c: F.when(F.array_contains(inside, c), F.concat(F.lit("I"), F.array_position(inside, c) - 1)).otherwise(F.concat(F.lit("M"), F.array_position(outside, c) - 1))


def letters(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ""))


def semantic_fingerprint(probes: Column, alphabet: list[str]) -> Column:
    """Of ordered_probes(): behaviour up to a renaming of symbols."""
    stream = F.flatten(F.transform(probes, lambda p: F.concat(letters(p["i"]), letters(F.coalesce(p["o"], F.lit(""))))))
    *_, name = renamed(stream, alphabet)
    return digest(F.transform(probes, lambda p: F.struct(p["e"].alias("error"), F.transform(letters(p["i"]), name).alias("input"), F.transform(letters(F.coalesce(p["o"], F.lit(""))), name).alias("output"), p["t"].alias("terminating"))))


def structural_fingerprint(program: Column, alphabet: list[str]) -> Column:
    """Of a program's text, up to a renaming of its literal characters; keywords and '=' stay."""
    lines = F.split(F.regexp_replace(program, "\n$", ""), "\n")
    tokens = F.transform(lines, lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.regexp_extract_all(x, F.lit(r"\([^)]*\)|."), F.lit(0))))
    literal = lambda c: (F.length(c) == 1) & (c != "=")
    *_, name = renamed(F.filter(F.flatten(tokens), literal), alphabet)
    return digest(F.when(program == "", F.array().cast("array<array<string>>")).otherwise(F.transform(tokens, lambda x: F.transform(x, lambda c: F.when(literal(c), name(c)).otherwise(c)))))
