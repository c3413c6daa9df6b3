"""Queries for the curated functions and the task operations, with DuckDB SQL in that engine's own functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphflow.functions import strings as S
from glyphflow.functions.catalog import FUNCTIONS, apply
from glyphflow.sources import inputs


def n(c: str) -> str:
    return f"(length(v)-length(replace(v,'{c}','')))"


N = [n(c) for c in "abc"]
MOST, LEAST = f"greatest({','.join(N)})", f"least({','.join(N)})"
COUNTS = f"[{','.join(N)}]"
RUNS = "regexp_replace(regexp_replace(regexp_replace({},'a+','a','g'),'b+','b','g'),'c+','c','g')"
CHARS = "string_split(v,'')"
LEADING, TRAILING = "length(v)-length(ltrim(v,'a'))", "length(v)-length(rtrim(v,'a'))"


def number(x: str) -> str:
    """A binary text's value, digit by digit."""
    return f"list_sum(list_transform(string_split({x},''), lambda d, i: d::BIGINT * (1::BIGINT << (length({x})-i))))::BIGINT"


def part(i: int, sep: str) -> str:
    return f"split_part(v,'{sep}',{i})"


def after(position: str) -> str:
    return f"substr(v,{position})"


AT_A = "instr(v,'a')"
MIDDLE = "(length(v)//2)"
#: Where an expression differs from Spark's: by function.
DUCK = {
    "1-3": RUNS.format("v"),
    "1-4": "regexp_replace(v,'aa+','','g')",
    "1-5": f"array_to_string(list_sort({CHARS}),'')",
    "1-6": f"CASE WHEN {N[0]}>{N[1]} THEN 'a' ELSE 'b' END",
    "2-2": f"CASE WHEN {N[0]}>=3 THEN 'true' ELSE 'false' END",
    "2-3": "CASE WHEN length(v)=3 THEN 'true' ELSE 'false' END",
    "2-4": "(length(v)%3)::VARCHAR",
    "2-5": f"CASE WHEN len(list_filter({COUNTS}, lambda k: k%2=0 AND k>0))=0 THEN 'true' ELSE 'false' END",
    "2-6": "CASE WHEN len(list_filter(regexp_extract_all(v,'a+|b+|c+'), lambda r: length(r)=1))=1 THEN 'true' ELSE 'false' END",
    "2-7": f"CASE WHEN {N[0]}<{N[1]} AND {N[1]}<{N[2]} THEN 'true' ELSE 'false' END",
    "2-8": f"CASE {MOST} WHEN {N[0]} THEN 'a' WHEN {N[1]} THEN 'b' ELSE 'c' END",
    "2-9": f"CASE {LEAST} WHEN {N[0]} THEN 'a' WHEN {N[1]} THEN 'b' ELSE 'c' END",
    "3-1": "trim(v,'a')",
    "3-2": f"substr(v,{AT_A}) || substr(v,1,{AT_A}-1)",
    "3-3": f"CASE WHEN trim(v,'a')='' THEN repeat('b',length(v)) ELSE repeat('b',{LEADING}) || trim(v,'a') || repeat('b',{TRAILING}) END",
    "3-4": f"repeat('b',length(v)-length(rtrim(v,'b'))) || rtrim(ltrim(v,'a'),'b') || repeat('a',{LEADING})",
    "3-5": "CASE WHEN left(v,1)=right(v,1) THEN 'true' ELSE 'false' END",
    "3-6": f"array_to_string(list_filter({CHARS}, lambda c: length(v)-length(replace(v,c,''))={MOST}),'')",
    "3-7": "CASE WHEN v=reverse(v) THEN 'true' ELSE 'false' END",
    "4-1": "'hello' || v",
    "4-2": "regexp_replace(regexp_replace(regexp_replace(v,'a',''),'a',''),'a','')",
    "4-3": after("4"),
    "4-4": "reverse(regexp_replace(regexp_replace(regexp_replace(reverse(v),'a',''),'a',''),'a',''))",
    "4-5": "right(v,1) || substr(v,2,length(v)-2) || left(v,1)",
    "4-7": "left(v,2) || substr(v,4)",
    "4-8": "v || left(v,3)",
    "4-10": f"array_to_string(list_filter({CHARS}, lambda c, i: i%2=0),'')",
    "4-11": "v || v",
    "4-12": "replace(v,'a',CASE WHEN contains(v,'b') THEN 'b' ELSE 'c' END)",
    "4-13": f"substr(v,{MIDDLE}+1,1)",
    "4-14": f"left(v,{MIDDLE}) || substr(v,{MIDDLE}+2)",
    "4-15": f"array_to_string(list_transform({CHARS}, lambda c, i: repeat(c,i)),'')",
    "4-16": f"array_to_string(list_transform(string_split({part(1, ',')},''), lambda c, i: c || substr({part(2, ',')},i,1)),'')",
    "5-1": f"repeat('a',({number('v')})::INT)",
    "5-2": f"bin({number('v')}+1)",
    "5-3": f"bin({number(part(1, '+'))}+{number(part(2, '+'))})",
    "5-4": f"bin({number(part(1, '-'))}-{number(part(2, '-'))})",
    "5-5": f"bin({number(part(1, '*'))}*{number(part(2, '*'))})",
    "5-6": f"bin({number(part(1, '/'))}//{number(part(2, '/'))}) || ',' || bin({number(part(1, '/'))}%{number(part(2, '/'))})",
    "replace_first_then_sort": "array_to_string(list_sort(string_split(regexp_replace(v,'a','b'),'')),'')",
    "stable_partition_b": f"replace(v,'b','') || repeat('b',{N[1]})",
    "sorted_unique": f"array_to_string(list_sort(list_distinct({CHARS})),'')",
    "compress_then_reverse": f"reverse({RUNS.format('v')})",
    "trim_then_duplicate": "regexp_replace(trim(v,'a'),'(.)','\\1\\1','g')",
    "rotate_then_swap_symbols": "translate(substr(v,2) || left(v,1),'ab','ba')",
    "duplicate_then_delete_b": "regexp_replace(replace(v,'b',''),'(.)','\\1\\1','g')",
    "duplicate_odd_positions": f"array_to_string(list_transform({CHARS}, lambda c, i: repeat(c,1+i%2)),'')",
    "drop_three_then_normalize": RUNS.format("substr(v,4)"),
    "filtered_length_at_most_three": "CASE WHEN length(replace(v,'c',''))<=3 THEN 'true' ELSE 'false' END",
    "non_palindrome": "CASE WHEN v<>reverse(v) THEN 'true' ELSE 'false' END",
    "palindrome_ignoring_c": "CASE WHEN replace(v,'c','')=reverse(replace(v,'c','')) THEN 'true' ELSE 'false' END",
    "contains_b_delete_a": "CASE WHEN contains(v,'b') THEN replace(v,'a','') ELSE v END",
    "odd_length_map_a": "CASE WHEN length(v)%2=1 THEN replace(v,'a','b') ELSE v END",
    "select_right_field": "substr(v,instr(v,',')+1)",
    "append_first_symbol": "v || left(v,1)",
    "deinterleave": f"array_to_string(list_filter({CHARS}, lambda c, i: i%2=1),'') || ',' || array_to_string(list_filter({CHARS}, lambda c, i: i%2=0),'')",
    "swap_adjacent_pairs": "regexp_replace(v,'(.)(.)','\\2\\1','g')",
    "unary_increment": "v || 'a'",
    "unary_double": "v || v",
}
DUCK |= {"6-2": DUCK["3-7"], "6-3": DUCK["4-12"]}
WHERE = {
    "1-6": f"{N[0]}<>{N[1]}",
    "2-8": f"len(list_filter({COUNTS}, lambda k: k={MOST}))=1",
    "2-9": f"length(v)>=2 AND len(list_filter({COUNTS}, lambda k: k={LEAST}))=1",
    "3-6": f"len(list_filter({COUNTS}, lambda k: k={MOST}))=1",
    "3-4": "length(v)>=2 AND starts_with(v,'a') AND ends_with(v,'b')",
}


def name_of(id_: str) -> str:
    return f"task_{id_.replace('-', '_')}" if id_[0].isdigit() else f"extra_{id_}"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _f in FUNCTIONS.values():
    QUERIES[name_of(_f.id)] = lambda spark, d, f=_f: apply(f.id, inputs.domain(spark, d, f.kind))
    ORACLES[name_of(_f.id)] = f"SELECT v AS value, {DUCK.get(_f.id, _f.sql)} AS output FROM (SELECT value AS v FROM ({inputs.SQL[_f.kind]})) WHERE {WHERE.get(_f.id, _f.where)}"

DFA = {("even", "a"): "odd", ("odd", "a"): "even", **{(s, c): s for s in ("even", "odd") for c in "bc"}}
FST = {("p", "a"): ("q", "x"), ("q", "a"): ("p", ""), ("p", "b"): ("p", "b"), ("q", "b"): ("p", "yy"), ("p", "c"): ("q", "c"), ("q", "c"): ("q", "")}


def _automaton_sql(start: str, cases: str, out: str, final: str) -> str:
    """Steps through a value's characters by a recursive query."""
    return f"""WITH RECURSIVE inputs AS ({inputs.SQL['abc']}), walk AS (
 SELECT value, 0 AS i, '{start}' AS state, '' AS o FROM inputs
 UNION ALL SELECT value, i + 1, {cases}, o || {out} FROM walk WHERE i < length(value))
SELECT value, {final} AS output FROM walk WHERE i = length(value)"""


_C = "substr(value, i + 1, 1)"
_NEXT = "CASE " + " ".join(f"WHEN state = '{s}' AND {_C} = '{c}' THEN '{t}'" for (s, c), t in DFA.items()) + " END"
_GO = "CASE " + " ".join(f"WHEN state = '{s}' AND {_C} = '{c}' THEN '{t}'" for (s, c), (t, _) in FST.items()) + " END"
_OUT = "CASE " + " ".join(f"WHEN state = '{s}' AND {_C} = '{c}' THEN '{o}'" for (s, c), (_, o) in FST.items()) + " END"

Op = S.Operation
#: name: kind of inputs, operations, DuckDB expression over v (or a whole query).
OPERATIONS: dict[str, tuple[str, Callable[[Column], Column], str]] = {
    "op_map": ("abc", lambda v: S.mapped(v, {"a": "b", "b": "c", "c": "a"}), "translate(v,'abc','bca')"),
    "op_map_wide": ("abc", lambda v: S.mapped(v, {"a": "xy", "b": ""}), "replace(replace(v,'b',''),'a','xy')"),
    "op_encode": ("abc", lambda v: S.composed([Op("encode", {"mapping": {"a": "0", "b": "10", "c": "11"}})], v), "replace(replace(replace(v,'a','0'),'b','10'),'c','11')"),
    "op_decode": ("abc", lambda v: S.composed([Op("decode", {"mapping": {"a": "1", "b": "0"}})], v), "translate(v,'ab','10')"),
    "op_delete": ("abc", lambda v: S.deleted(v, "ac"), "replace(replace(v,'a',''),'c','')"),
    "op_replace_substring": ("abc", lambda v: S.substring_replaced(v, "ab", "ba"), "replace(v,'ab','ba')"),
    "op_normalize_runs": ("abc", lambda v: S.runs_normalised(v, "ac"), "regexp_replace(regexp_replace(v,'a+','a','g'),'c+','c','g')"),
    "op_reverse": ("abc", F.reverse, "reverse(v)"),
    "op_rotate_left": ("abc", lambda v: S.rotated(v, 2, "left"), "substr(v,2%length(v)+1) || substr(v,1,2%length(v))"),
    "op_rotate_right": ("abc", lambda v: S.rotated(v, 3, "right"), "right(v,3%length(v)) || substr(v,1,length(v)-3%length(v))"),
    "op_move_symbols": ("abc", lambda v: S.symbols_moved(v, "cab"), f"repeat('c',{N[2]}) || repeat('a',{N[0]}) || repeat('b',{N[1]})"),
    "op_recognize": ("abc", lambda v: S.recognised(v, "abc", "yes", "no"), "CASE WHEN contains(v,'abc') THEN 'yes' ELSE 'no' END"),
    "op_dfa": ("abc", lambda v: S.accepted(v, "even", DFA, ["even"]), _automaton_sql("even", _NEXT, "''", "CASE WHEN state = 'even' THEN 'true' ELSE 'false' END")),
    "op_fst": ("abc", lambda v: S.transduced(v, "p", FST), _automaton_sql("p", _GO, _OUT, "o")),
    "op_unary_increment": ("unary", lambda v: S.unary(v, "increment"), "v || 'a'"),
    "op_unary_decrement": ("unary", lambda v: S.unary(v, "decrement"), "substr(v,2)"),
    "op_unary_double": ("unary", lambda v: S.unary(v, "double"), "v || v"),
    "op_unary_parity": ("abc", lambda v: S.unary(v, "parity"), "CASE WHEN length(v)%2=1 THEN 'odd' ELSE 'even' END"),
    "op_binary_increment": ("binary", lambda v: S.unary(v, "binary_increment"), f"bin({number('v')}+1)"),
    "op_concat": ("fields", lambda v: S.binary(v, "concat", ","), "regexp_replace(v,',','')"),
    "op_unary_add": ("fields", lambda v: S.binary(v, "add", ","), "repeat('a',length(v)-1)"),
    "op_unary_subtract": ("fields", lambda v: S.binary(v, "subtract", ","), f"repeat('a',greatest(0,length({part(1, ',')})-length({part(2, ',')}))::INT)"),
    "op_binary_add": ("sum", lambda v: S.binary(v, "add", "+", "binary"), f"bin({number(part(1, '+'))}+{number(part(2, '+'))})"),
    "op_binary_xor": ("sum", lambda v: S.binary(v, "xor", "+", "binary"), f"bin(xor({number(part(1, '+'))},{number(part(2, '+'))}))"),
    "op_compose_2": ("abc", lambda v: S.composed([Op("reverse"), Op("normalize_runs", {"symbols": "abc"})], v), RUNS.format("reverse(v)")),
    "op_compose_3": ("abc", lambda v: S.composed([Op("delete", {"symbols": "b"}), Op("reverse"), Op("rotate", {"amount": 1})], v), "substr(reverse(replace(v,'b','')),2) || left(reverse(replace(v,'b','')),1)"),
    "op_fused_map": ("abc", lambda v: S.composed([Op("map", {"mapping": {"a": "b"}}), Op("delete", {"symbols": "b"}), Op("encode", {"mapping": {"c": "xc"}})], v), "replace(replace(replace(v,'a',''),'b',''),'c','xc')"),
    "op_cancelled_reversals": ("abc", lambda v: S.composed([Op("reverse"), Op("reverse"), Op("delete", {"symbols": "c"})], v), "replace(v,'c','')"),
}
for _name, (_kind, _build, _sql) in OPERATIONS.items():
    QUERIES[_name] = lambda spark, d, kind=_kind, build=_build: inputs.domain(spark, d, kind).select("value", build(F.col("value")).alias("output"))
    ORACLES[_name] = _sql if _sql.startswith("WITH") else f"SELECT v AS value, {_sql} AS output FROM (SELECT value AS v FROM ({inputs.SQL[_kind]}))"
