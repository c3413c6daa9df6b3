"""Task operations applied one value at a time, for tables whose rows each have operations of their own (as JSON)."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import groupby

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from glyphflow.functions.strings import PER_CHARACTER, Operation, image


def as_json(operations: list[Operation]) -> str:
    """Canonical JSON: kinds with their parameters, keys in order; transitions by state and letter."""
    flat = lambda p: {k: {f"{s}\0{c}": t for (s, c), t in v.items()} if k == "delta" else v for k, v in p.items()}
    return json.dumps([{"kind": o.kind, "parameters": flat(o.parameters)} for o in operations], ensure_ascii=False, sort_keys=True, separators=(",", ":"))


@lru_cache(maxsize=4096)
def from_json(text: str) -> tuple[Operation, ...]:
    keyed = lambda p: {k: {tuple(s.split("\0")): tuple(t) if isinstance(t, list) else t for s, t in v.items()} if k == "delta" else v for k, v in p.items()}
    return tuple(Operation(o["kind"], keyed(o["parameters"])) for o in json.loads(text))


def walked(p: dict, value: str) -> tuple[str, str]:
    """The last state of an automaton and what it has said."""
    state, said = p["start"], ""
    for c in value:
        to = p["delta"][state, c]
        state, out = to if isinstance(to, tuple) else (to, "")
        said += out
    return state, said


def apply(op: Operation, value: str) -> str:
    p, kind = op.parameters, op.kind
    if kind in PER_CHARACTER:
        images = image(op)
        return "".join(images.get(c, c) for c in value)
    if kind == "replace_substring":
        return value.replace(p["old"], p["new"])
    if kind == "normalize_runs":
        return "".join(c if c in p["symbols"] else c * len([*g]) for c, g in groupby(value))
    if kind == "reverse":
        return value[::-1]
    if kind == "rotate":
        k = (p["amount"] if p.get("direction", "left") == "left" else -p["amount"]) % max(1, len(value))
        return value[k:] + value[:k]
    if kind == "move_symbols":
        return "".join(sorted(value, key=p["order"].index))
    if kind == "recognize_pattern":
        return p.get("accept", "true") if p["pattern"] in value else p.get("reject", "false")
    if kind == "accept":
        return "true" if walked(p, value)[0] in p["accepting"] else "false"
    if kind == "transduce":
        return walked(p, value)[1]
    if kind == "unary_operation":
        n, a = len(value), p.get("symbol", "a")
        if p["operation"] == "parity":
            return "odd" if n % 2 else "even"
        return f"{int(value or '0', 2) + 1:b}" if p["operation"] == "binary_increment" else a * {"increment": n + 1, "decrement": max(0, n - 1), "double": 2 * n}[p["operation"]]
    a, _, b = value.partition(p["separator"])
    if p["operation"] == "concat":
        return a + b
    if p.get("representation", "unary") == "unary":
        return p.get("symbol", "a") * (len(a) + len(b) if p["operation"] == "add" else max(0, len(a) - len(b)))
    return f"{int(a, 2) + int(b, 2) if p['operation'] == 'add' else int(a, 2) ^ int(b, 2):b}"


def applied(operations: Column, value: Column) -> Column:
    """The operations (JSON) of each row applied to its value; null for nulls and for a value that they don't take."""

    def one(text: str | None, v: str | None) -> str | None:
        if text is None or v is None:
            return None
        try:
            return reduce(lambda x, op: apply(op, x), from_json(text), v)
        except (KeyError, ValueError):
            return None

    @F.pandas_udf("string")
    def result(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, values in batches:
            yield pd.Series([one(t, v) for t, v in zip(texts, values, strict=True)], dtype=object)

    return result(operations, value)
