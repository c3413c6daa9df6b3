"""Programs proposed in free text: finding them, and the order of gates that they must pass."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Limits of a program.
MOST_LINES, MOST_CHARACTERS = 32, 512


def extracted(text: Column) -> Column:
    """What stands in <program> tags, else the last fenced block, else the whole text; without white space at its ends."""
    tagged = F.regexp_extract(text, r"(?is)<program>\s*(.*?)\s*</program>", 1)
    fences = F.regexp_extract_all(text, F.lit(r"(?s)```[A-Za-z0-9_]*\n(.*?)```"), F.lit(1))
    chosen = F.when(F.rlike(text, F.lit(r"(?is)<program>.*?</program>")), tagged).when(F.size(fences) > 0, F.try_element_at(fences, F.lit(-1))).otherwise(text)
    return F.btrim(chosen, F.lit(" \t\r\n"))


def gate(program: Column, lines: int = MOST_LINES, characters: int = MOST_CHARACTERS) -> Column:
    """The first limit that a program fails, by lines and then by characters, or null. Limits come before syntax."""
    return F.when(F.size(F.split(program, "\n")) > lines, "too_many_lines").when(F.length(program) > characters, "too_many_characters")
