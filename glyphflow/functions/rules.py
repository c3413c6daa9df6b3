"""The rewriting language: rules, one a line, applied first to last, leftmost match, again from the top after each."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

#: Keywords allowed on each side, reserved characters, and the interpreter's limits.
LEFT_KEYWORDS = ("start", "end", "once")
RIGHT_KEYWORDS = ("start", "end", "return")
RESERVED = "=#()"
STEP_LIMIT = 1_000_000
LENGTH_LIMIT = 1_000


class RuleError(ValueError):
    """A program that can't be read; line is its 1-based physical line."""

    def __init__(self, line: int, reason: str):
        super().__init__(f"line {line}: {reason}")
        self.line, self.reason = line, reason


@dataclass(frozen=True)
class Side:
    keyword: str | None
    text: str


@dataclass(frozen=True)
class Rule:
    line: int
    source: str
    left: Side
    right: Side

    @property
    def once(self) -> bool:
        return self.left.keyword == "once"


def read_side(part: str, line: int, allowed: tuple[str, ...]) -> Side:
    keyword, text = None, part
    if part[:1] == "(":
        keyword, closed, text = part[1:].partition(")")
        if not closed:
            raise RuleError(line, f"a keyword isn't closed in {part!r}")
        if keyword not in LEFT_KEYWORDS + RIGHT_KEYWORDS and keyword:
            raise RuleError(line, f"unknown keyword ({keyword})")
        keyword = keyword or None  # an empty pair of brackets is no keyword
    if not text.isascii() or any(c in RESERVED for c in text):
        raise RuleError(line, f"characters that can't be matched in {part!r}")
    if keyword and keyword not in allowed:
        raise RuleError(line, f"({keyword}) can't stand on this side")
    return Side(keyword, text)


@lru_cache(maxsize=4096)
def parse(program: str) -> tuple[Rule, ...]:
    """The rules of a program; RuleError at the first line that isn't one.

    A block comment begins with a line that starts with /* and ends with a later line that ends with */.
    """
    rules, comment = [], False
    for number, line in enumerate(program.split("\n"), 1):
        line = line.removesuffix("\r")
        bare = line.strip()
        if not line:
            continue
        if comment:
            comment = not bare.endswith("*/")
        elif bare.startswith("/*"):
            comment = True
        else:
            parts = line.split("=")
            if len(parts) != 2:
                raise RuleError(number, "a rule has exactly one '='")
            # both sides are read before either keyword's place is judged
            left, right = (read_side(p, number, LEFT_KEYWORDS + RIGHT_KEYWORDS) for p in parts)
            if left.keyword == "return" or right.keyword == "once":
                raise RuleError(number, "(return) can't stand on the left, nor (once) on the right")
            rules.append(Rule(number, line, left, right))
    return tuple(rules)


def syntax_error(program: str) -> str | None:
    try:
        parse(program)
    except RuleError as e:
        return str(e)
    return None
