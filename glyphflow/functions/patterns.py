"""Short programs as patterns: what they are filled with, and which search or generator uses them.

A pattern is a program with {a} and {b} for two different letters, {A} for {a} as a capital, {o} for an output and {m} for a
mark; every way of filling it is a program.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import product

#: Patterns by use, and the marks.
MARKS = "XYZ"
INCREMENT = "(once)=(end){m}\n0{m}=1\n1{m}={m}0\n{m}=1"
CONTAINS, TRIM, ONCE = "{a}=(return)true\n=(return)false", "(start){a}=\n(end){a}=", "(once){a}="
ONCE_TIMES = (1, 2, 3, 4)
SEARCHES = {
    "identity": ("",),
    "constant": ("=(return){o}",),
    "single_rule_search": ("{a}=", "{a}={b}", "(start){a}=", "(end){a}=", CONTAINS),
    "template_search": (TRIM, *("\n".join([ONCE] * k) for k in ONCE_TIMES), INCREMENT),
}
MINED = ("{a}={b}", "{a}={A}", "{a}=", "{a}{a}={a}", "(start){a}=", "(end){a}=", ONCE, "{a}=(return)yes\n=(return)no", "{a}{b}={b}{a}")


def filled(patterns: Iterable[str], letters: str, outputs: Iterable[str] = (), marks: str = MARKS) -> list[str]:
    """All programs of the patterns, each once, in the order of patterns, letters and outputs."""
    outputs, out = list(outputs), {}
    for pattern in patterns:
        wanted = {k: v for k, v in (("a", letters), ("b", letters), ("o", outputs), ("m", marks)) if f"{{{k}}}" in pattern or k == "a" and "{A}" in pattern}
        for values in product(*wanted.values()):
            fill = dict(zip(wanted, values, strict=True))
            if "b" not in fill or fill["a"] != fill["b"]:
                out[pattern.format(**fill, A=fill.get("a", "").upper())] = None
    return list(out)


def letters_of(texts: Iterable[str], reserved: str = "=#()") -> str:
    """The characters of texts that a rule can hold, in order."""
    return "".join(sorted({c for t in texts for c in t if c.isascii() and c not in reserved}))
