"""Rewriting by built-in expressions: a closed form where one is proven, else a fold of a proven number of steps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import LENGTH_LIMIT, Rule, parse


def closed_form(program: str, value: Column, max_length: int = LENGTH_LIMIT) -> Column | None:
    """An expression equal to the program's output on every value, null where a run goes over max_length; None if no such
    expression is known.

    Iterated rewriting is not replace(): only single characters are lowered, whose removal can't make new matches. A chain
    of such rules is lowered in order, which needs that no rule's result has a character that an earlier rule looks for.
    A rule's matches are all taken up before the next rule's, so that texts are longest where a rule begins or ends; and
    a text within the limit has too few characters for the limit of steps.
    """
    rules = parse(program)
    seen: set[str] = set()
    for r in rules:
        plain = r.left.keyword is None and r.right.keyword is None and len(r.left.text) == 1
        if not plain or r.left.text in r.right.text or seen & {*r.right.text}:
            return None
        seen.add(r.left.text)
    fits = F.length(value) <= max_length
    for i, r in enumerate(rules):  # a later rule may make what only a still later one takes up
        if all(r.left.text != x.left.text for x in rules[:i]):
            value = F.replace(value, F.lit(r.left.text), F.lit(r.right.text))
            fits = fits & (F.length(value) <= max_length) if len(r.right.text) > 1 else fits
    return F.when(fits, value)


def condition(rule: Rule, number: int, v: Column, used: Column) -> Column:
    what, kind = rule.left.text, rule.left.keyword
    hit = F.lit(True) if not what else F.startswith(v, F.lit(what)) if kind == "start" else F.endswith(v, F.lit(what)) if kind == "end" else F.contains(v, F.lit(what))
    return hit & (used.bitwiseAND(F.lit(1 << number)) == 0) if rule.once else hit


def result(rule: Rule, v: Column) -> Column:
    what, new, kind = rule.left.text, F.lit(rule.right.text), rule.right.keyword
    if kind == "return":
        return new
    at = F.length(v) - len(what) + 1 if rule.left.keyword == "end" else F.lit(1) if rule.left.keyword == "start" or not what else F.instr(v, what)
    without = lambda middle: F.overlay(v, middle, at, F.lit(len(what)))
    if kind == "start":
        return F.concat(new, without(F.lit("")))
    if kind == "end":
        return F.concat(without(F.lit("")), new)
    return without(new)


def folded(program: str, value: Column, bound: int, max_length: int = LENGTH_LIMIT) -> Column:
    """struct<output, steps, terminating, error> of a literal program; a run of more than bound steps is over its limit.

    State and rules stay in the JVM; the cost grows with the bound, so it should be a proven one of a few hundred.
    """
    rules = parse(program)
    state = lambda v, used, steps, done, error: F.struct(v.alias("v"), used.alias("used"), steps.alias("steps"), done.alias("done"), error.alias("error"))
    none = F.lit(None).cast("string")
    first = state(value, F.lit(0).cast("long"), F.lit(0), F.length(value) > max_length, F.when(F.length(value) > max_length, "input_length_limit"))

    def step(s: Column, _: Column) -> Column:
        choice = F.when(s["done"], s)
        for i, r in enumerate(rules):
            after, used, n = result(r, s["v"]), s["used"].bitwiseOR(F.lit(1 << i).cast("long")) if r.once else s["used"], s["steps"] + 1
            error = F.when(n > bound, "execution_step_limit").when(F.length(after) > max_length, "string_length_limit")
            choice = choice.when(condition(r, i, s["v"], s["used"]), state(after, used, n, F.lit(r.right.keyword == "return") | error.isNotNull(), error))
        return choice.otherwise(state(s["v"], s["used"], s["steps"], F.lit(True), none))

    def finish(s: Column) -> Column:
        return F.struct(F.when(s["error"].isNull(), s["v"]).alias("output"), s["steps"].alias("steps"), s["error"].isNull().alias("terminating"), s["error"].alias("error"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(bound + 1)), first, step, finish)
