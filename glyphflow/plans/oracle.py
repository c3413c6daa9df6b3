"""DuckDB SQL that runs a program by a recursive query, one row for each step: an oracle that shares no expression with ours."""

from __future__ import annotations

from glyphflow.functions.rules import LENGTH_LIMIT, Rule, parse


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _condition(rule: Rule, number: int) -> str:
    what = quoted(rule.left.text)
    hit = {"start": f"starts_with(v, {what})", "end": f"ends_with(v, {what})"}.get(rule.left.keyword or "", f"contains(v, {what})")
    hit = hit if rule.left.text else "true"
    return f"({hit} AND (used & {1 << number}) = 0)" if rule.once else hit


def _result(rule: Rule) -> str:
    n, new = len(rule.left.text), quoted(rule.right.text)
    at = f"(length(v) - {n} + 1)" if rule.left.keyword == "end" else "1" if rule.left.keyword == "start" or not n else f"instr(v, {quoted(rule.left.text)})"
    before, after = f"substr(v, 1, {at} - 1)", f"substr(v, {at} + {n})"
    return {"return": new, "start": f"{new} || {before} || {after}", "end": f"{before} || {after} || {new}"}.get(rule.right.keyword or "", f"{before} || {new} || {after}")


def steps_sql(program: str, inputs: str, max_steps: int, max_length: int = LENGTH_LIMIT) -> str:
    """A WITH clause whose table `run` has value, v, step, rule (its line), before and error for step 0 and each step."""
    rules = parse(program)
    case = lambda parts, other: "CASE " + " ".join(parts) + f" ELSE {other} END" if parts else other
    pick = case([f"WHEN {_condition(r, i)} THEN {i}" for i, r in enumerate(rules)], "-1")
    next_ = case([f"WHEN k = {i} THEN {_result(r)}" for i, r in enumerate(rules)], "v")
    used = case([f"WHEN k = {i} THEN used | {1 << i}" for i, r in enumerate(rules) if r.once], "used")
    returns = ", ".join(str(i) for i, r in enumerate(rules) if r.right.keyword == "return") or "-2"
    lines = case([f"WHEN k = {i} THEN {r.line}" for i, r in enumerate(rules)], "0")
    return f"""WITH RECURSIVE inputs AS ({inputs}),
run AS (
 SELECT value, value AS v, 0 AS step, 0::BIGINT AS used, false AS done, NULL::INT AS rule, NULL::VARCHAR AS before,
  CASE WHEN length(value) > {max_length} THEN 'input_length_limit' END AS error FROM inputs
 UNION ALL
 SELECT value, nv, step + 1, nu, k IN ({returns}), line, v,
  CASE WHEN step + 1 > {max_steps} THEN 'execution_step_limit' WHEN length(nv) > {max_length} THEN 'string_length_limit' END
 FROM (SELECT *, {next_} AS nv, {used} AS nu, {lines} AS line FROM (SELECT *, {pick} AS k FROM run WHERE NOT done AND error IS NULL) WHERE k >= 0)
)"""


def outcome_sql(program: str, inputs: str, max_steps: int, max_length: int = LENGTH_LIMIT) -> str:
    return f"""{steps_sql(program, inputs, max_steps, max_length)},
ends AS (SELECT value, max(step) AS steps, arg_max(v, step) AS v, max(error) AS error FROM run GROUP BY value)
SELECT value, CASE WHEN error IS NULL THEN v END AS output, steps::INT AS steps, error IS NULL AS terminating, error FROM ends"""
