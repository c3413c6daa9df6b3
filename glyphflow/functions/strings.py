"""The task operations as Column builders. Each takes a column of values and the operation's parameters."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def characters(v: Column) -> Column:
    """The characters as an array; none for the empty text, which split() gives as one empty string."""
    return F.when(v == "", F.array().cast("array<string>")).otherwise(F.split(v, ""))


def mapped(v: Column, mapping: dict[str, str]) -> Column:
    """Each character's image; characters without one stay."""
    single = {k: x for k, x in mapping.items() if len(x) == 1}
    if len(single) == len(mapping):
        return F.translate(v, "".join(mapping), "".join(mapping.values()))
    pairs = F.create_map(*(F.lit(x) for pair in mapping.items() for x in pair))
    return F.array_join(F.transform(characters(v), lambda c: F.coalesce(F.try_element_at(pairs, c), c)), "")


def deleted(v: Column, symbols: str) -> Column:
    return F.translate(v, symbols, "")


def substring_replaced(v: Column, old: str, new: str) -> Column:
    """One pass from the left, without overlaps."""
    return F.replace(v, F.lit(old), F.lit(new))


def runs_normalised(v: Column, symbols: str) -> Column:
    """Runs of each of the symbols become one."""
    listed = "".join("\\" + c if not c.isalnum() else c for c in symbols)
    return F.regexp_replace(v, f"([{listed}])\\1+", "$1")


def rotated(v: Column, amount: int, direction: str = "left") -> Column:
    k = F.pmod(F.lit(amount if direction == "left" else -amount), F.greatest(F.length(v), F.lit(1)))
    return F.concat(F.substr(v, k + 1), F.left(v, k))


def symbols_moved(v: Column, order: str) -> Column:
    """Stable sort by the given order of symbols; null if one isn't listed."""
    listed = F.array(*(F.lit(c) for c in order))
    ranked = F.transform(characters(v), lambda c: F.struct(F.array_position(listed, c).alias("k"), c.alias("c")))
    joined = F.array_join(F.transform(F.array_sort(ranked), lambda x: x["c"]), "")
    return F.when(F.exists(ranked, lambda x: x["k"] == 0), F.lit(None).cast("string")).otherwise(joined)


def recognised(v: Column, pattern: str, accept: str = "true", reject: str = "false") -> Column:
    return F.when(F.contains(v, F.lit(pattern)), accept).otherwise(reject)


def accepted(v: Column, start: str, delta: dict[tuple[str, str], str], accepting: list[str]) -> Column:
    """'true' or 'false' by a deterministic automaton; null if a transition is missing."""
    table = F.create_map(*(F.lit(x) for (s, c), t in delta.items() for x in (f"{s}\0{c}", t)))
    end = F.aggregate(characters(v), F.lit(start), lambda s, c: F.try_element_at(table, F.concat(s, F.lit("\0"), c)))
    return F.when(end.isNull(), F.lit(None).cast("string")).when(end.isin(accepting), "true").otherwise("false")


def transduced(v: Column, start: str, delta: dict[tuple[str, str], tuple[str, str]]) -> Column:
    """The outputs of a finite-state transducer's transitions; null if one is missing."""
    table = F.create_map(*(x for (s, c), (t, out) in delta.items() for x in (F.lit(f"{s}\0{c}"), F.struct(F.lit(t).alias("t"), F.lit(out).alias("o")))))

    def step(a: Column, c: Column) -> Column:
        to = F.try_element_at(table, F.concat(a["t"], F.lit("\0"), c))
        return F.struct(to["t"].alias("t"), F.concat(a["o"], to["o"]).alias("o"))

    return F.aggregate(characters(v), F.struct(F.lit(start).cast("string").alias("t"), F.lit("").cast("string").alias("o")), step, lambda a: a["o"])


def unary(v: Column, operation: str, symbol: str = "a") -> Column:
    n = F.length(v)
    if operation == "parity":
        return F.when(n % 2 == 1, "odd").otherwise("even")
    if operation == "binary_increment":
        return F.bin(number(v) + 1)
    return F.repeat(F.lit(symbol), {"increment": n + 1, "decrement": F.greatest(n - 1, F.lit(0)), "double": n * 2}[operation])


def number(v: Column) -> Column:
    """The value of up to 63 binary digits."""
    return F.conv(v, 2, 10).cast("bigint")


def sides(v: Column, separator: str) -> tuple[Column, Column]:
    """What stands before and after the first separator."""
    at = F.instr(v, separator)
    return F.left(v, at - 1), F.substr(v, at + len(separator))


def binary(v: Column, operation: str, separator: str, representation: str = "unary", symbol: str = "a") -> Column:
    a, b = sides(v, separator)
    if operation == "concat":
        return F.concat(a, b)
    if representation == "unary":
        n = F.length(a) + F.length(b) if operation == "add" else F.greatest(F.length(a) - F.length(b), F.lit(0))
        return F.repeat(F.lit(symbol), n)
    return F.bin(number(a) + number(b) if operation == "add" else number(a).bitwiseXOR(number(b)))


@dataclass(frozen=True)
class Operation:
    """One operation of a task, by kind and parameters."""

    kind: str
    parameters: dict[str, Any] = field(default_factory=dict)

    def __call__(self, v: Column) -> Column:
        return BUILDERS[self.kind](v, **self.parameters)


#: The kinds of operations.
BUILDERS = {
    "map": mapped, "encode": mapped, "decode": mapped, "delete": deleted, "replace_substring": substring_replaced, "normalize_runs": runs_normalised,
    "reverse": F.reverse, "rotate": rotated, "move_symbols": symbols_moved, "recognize_pattern": recognised,
    "accept": accepted, "transduce": transduced, "unary_operation": unary, "binary_operation": binary,
}
PER_CHARACTER = ("map", "encode", "decode", "delete")


def composed(operations: list[Operation], v: Column) -> Column:
    """The operations in sequence, after fusing them."""
    return reduce(lambda column, op: op(column), fused(operations), v)


def image(op: Operation) -> dict[str, str]:
    return {c: "" for c in op.parameters["symbols"]} if op.kind == "delete" else dict(op.parameters["mapping"])


def fused(operations: list[Operation]) -> list[Operation]:
    """Neighbouring per-character operations as one map, and two reversals in a row as none."""
    out: list[Operation] = []
    for op in operations:
        last = out[-1] if out else None
        if last and op.kind == last.kind == "reverse":
            out.pop()
        elif last and op.kind in PER_CHARACTER and last.kind in PER_CHARACTER:
            first, then = image(last), image(op)
            both = {c: "".join(then.get(x, x) for x in to) for c, to in first.items()}
            out[-1] = Operation("map", {"mapping": both | {c: to for c, to in then.items() if c not in first}})
        else:
            out.append(op)
    return out
