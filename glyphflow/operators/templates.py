"""Program templates: seeded rule programs of known kinds, chosen by weight, each checked before it counts."""

from __future__ import annotations

import random
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphflow.functions.kernel import rewrite
from glyphflow.functions.labels import difficulty
from glyphflow.functions.patterns import CONTAINS, INCREMENT, MARKS, ONCE, TRIM
from glyphflow.functions.rules import syntax_error
from glyphflow.operators.candidates import MOST_CHARACTERS, MOST_LINES

Template = Callable[[random.Random, str], str]


def of(pattern: str, least: int = 1, most: int = 1) -> Template:
    """A template that fills a pattern, repeated least to most times."""

    def make(rng: random.Random, alphabet: str) -> str:
        a, b = rng.sample(alphabet, 2) if "{b}" in pattern else (rng.choice(alphabet) if "{a}" in pattern else "", "")
        return "\n".join([pattern.format(a=a, b=b, m=rng.choice(MARKS))] * rng.randint(least, most))

    return make


#: Adds one to a binary number: a mark at the end carries to the left.
incremented = of(INCREMENT)


def acyclic(rng: random.Random, alphabet: str) -> str:
    """Each character becomes nothing or later ones only, so that every run ends."""
    out = []
    for i, a in enumerate(alphabet):
        later = alphabet[i + 1 :] + alphabet[i:].upper()
        out.append(f"{a}={''.join(rng.choice(later) for _ in range(rng.randint(0, 2)))}")
    return "\n".join(out)


#: Names and default weights.
TEMPLATES: dict[str, tuple[Template, float]] = {
    "plain_substitution": (of("{a}={b}"), 1.0), "contains_character": (of(CONTAINS), 1.0), "anchored_trim": (of(TRIM), 1.0),
    "once_delete": (of(ONCE, 1, 4), 1.0), "binary_increment": (incremented, 1.0), "safe_random_rewrite": (acyclic, 1.0),
}


def enabled(weights: dict[str, float] | None = None, only: set[str] | None = None, without: set[str] = frozenset()) -> dict[str, float]:
    """The weights of the templates in use: those named (or all), without the disabled ones, of a weight above zero."""
    if unknown := {*(only or ()), *without, *(weights or {})} - TEMPLATES.keys():
        raise ValueError(f"no such templates: {sorted(unknown)}")
    return {n: w for n, (_, d) in TEMPLATES.items() if (only is None or n in only) and n not in without and (w := (weights or {}).get(n, d)) > 0}


def described(programs: DataFrame) -> DataFrame:
    """programs with the features of each (once, start, end, return), its number of lines and its difficulty."""
    lines = F.size(F.split("program", "\n"))
    features = F.filter(F.array(*map(F.lit, ("once", "start", "end", "return"))), lambda f: F.contains("program", F.concat(F.lit("("), f, F.lit(")"))))
    return programs.select("*", features.alias("features"), lines.alias("lines"), difficulty(lines, F.lit(1), 6).alias("difficulty"))


def generated_gate(df: DataFrame, lines: int = MOST_LINES, characters: int = MOST_CHARACTERS) -> Column:
    """Why a generated program (template, version, program) doesn't count, or null: provenance, limits, syntax, in this order."""
    unread = rewrite(df["program"], F.lit("a"), 1)["error"]
    lacks = df["template"].isNull() | (df["template"] == "") | df["version"].isNull() | (df["version"] == "")
    return F.when(lacks, "provenance").when(F.size(F.split(df["program"], "\n")) > lines, "too_many_lines").when(F.length(df["program"]) > characters, "too_many_characters").when(F.startswith(unread, F.lit("syntax_error")), "syntax")


def generate(spark: SparkSession, seed: int, count: int, alphabet: str = "abc", weights: dict[str, float] | None = None, attempts: int = 20) -> DataFrame:
    """seq, template, program and reason (null, or why it was rejected) of at most count accepted programs, all attempts shown.

    A catalogue's worth, made on the driver. Each of count * attempts tries draws for itself, so the result doesn't depend on
    which were rejected before; making stops when count are accepted.
    """
    weight = enabled(weights)
    if not weight:
        raise ValueError("no template has a weight")
    rows, accepted = [], 0
    for seq in range(count * attempts):
        rng = random.Random(f"{seed}/{seq}")
        name = rng.choices(list(weight), list(weight.values()))[0]
        program = TEMPLATES[name][0](rng, alphabet)
        reason = "too_many_lines" if program.count("\n") >= MOST_LINES else "too_many_characters" if len(program) > MOST_CHARACTERS else "syntax" if syntax_error(program) else None
        if reason is None and any(p == program for _, _, p, r in rows if r is None):
            reason = "duplicate"
        rows.append((seq, name, program, reason))
        accepted += reason is None
        if accepted == count:
            break
    return spark.createDataFrame(rows, "seq long, template string, program string, reason string")
