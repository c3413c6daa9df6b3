"""Queries for records: schemas, labels, audits, splits, statistics, checks, compiled operations, test choice and the solver.

Problems are derived from parts, customers and words: every column is an expression over keys, so that DuckDB can say the
same from the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphflow.functions import labels
from glyphflow.functions import programs as P
from glyphflow.functions.compiling import compiled
from glyphflow.functions.interpreting import applied, as_json
from glyphflow.functions.kernel import rewrite
from glyphflow.functions.strings import Operation, composed
from glyphflow.operators import audits, choice, datasets, domains, solver, splits, statistics
from glyphflow.operators.batch import outcomes
from glyphflow.plans.kernel_queries import five, words
from glyphflow.plans.oracle import outcome_sql, quoted
from glyphflow.sources import artifacts, inputs, records
from glyphflow.sources.inputs import table
from glyphflow.sources.work import shared_folder

ABC = inputs.SQL["abc"]
SEED = 7
SORTED = "array_to_string(list_sort(string_split({}, '')), '')"

# -- problems from parts ------------------------------------------------------------------------------------------------
KINDS = ("map", "delete", "reverse", "rotate", "encode")
SEQUENCES = (["map"], ["delete"], ["reverse"], ["rotate"], ["map", "delete"], ["delete", "map"], ["reverse", "rotate"], ["map", "reverse", "delete"], ["encode"], ["rotate", "encode"])


def pick(values: tuple | list, key: Column) -> Column:
    """The value at key, a number from 0 on."""
    return F.array(*(F.array(*map(F.lit, v)) if isinstance(v, list) else F.lit(v) for v in values))[key]


def problems(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey").cast("int")
    return table(spark, d, "part").select(
        k.cast("string").alias("id"), k.alias("seq"), F.when(k % 41 == 0, "reversal").otherwise(F.concat(F.lit("f"), k % 7)).alias("family"), F.when(k % 37 == 0, 12).otherwise(4 + k % 5).alias("input_length"),
        F.when(k % 23 == 0, "rules").otherwise("prose").alias("style"), F.when(k % 29 == 0, F.array(F.concat(F.lit("c"), k % 11), F.lit("finite_state_machine"))).otherwise(F.array(F.concat(F.lit("c"), k % 11))).alias("concepts"),
        pick(SEQUENCES, k % 10).alias("sequence"), (1 + F.col("p_size").cast("int") % 9).alias("lines"), F.concat(F.lit("s"), F.floor(k / 3) % 90).alias("structure"), F.when(k % 6 == 0, F.concat(F.lit("m"), F.floor(k / 4))).otherwise("").alias("markers"),
        F.concat(F.lit("p"), F.col("p_size") % 13).alias("parameters"), F.concat(F.lit("b"), F.floor(k / 2)).alias("behavior"), pick(splits.SPLITS, k % 12).alias("split"),
    )


_LIST = lambda values: "[" + ", ".join(_LIST(v) if isinstance(v, (list, tuple)) else f"'{v}'" for v in values) + "]"
_PROBLEMS = f"""SELECT p_partkey::VARCHAR AS id, p_partkey AS seq, CASE WHEN p_partkey % 41 = 0 THEN 'reversal' ELSE 'f' || p_partkey % 7 END AS family, CASE WHEN p_partkey % 37 = 0 THEN 12 ELSE 4 + p_partkey % 5 END AS input_length,
CASE WHEN p_partkey % 23 = 0 THEN 'rules' ELSE 'prose' END AS style, CASE WHEN p_partkey % 29 = 0 THEN ['c' || p_partkey % 11, 'finite_state_machine'] ELSE ['c' || p_partkey % 11] END AS concepts, ({_LIST(SEQUENCES)})[p_partkey % 10 + 1] AS sequence,
1 + p_size % 9 AS lines, 's' || (p_partkey // 3) % 90 AS structure, CASE WHEN p_partkey % 6 = 0 THEN 'm' || p_partkey // 4 ELSE '' END AS markers, 'p' || p_size % 13 AS parameters, 'b' || p_partkey // 2 AS behavior, ({_LIST(splits.SPLITS)})[p_partkey % 12 + 1] AS split FROM part"""
_SEEN = lambda split, column, distinct=True: f"(SELECT count({'DISTINCT ' if distinct else ''}{column}) FROM p WHERE split = '{split}' AND {column} IN (SELECT {column} FROM t))"
_COUNTERS = {
    "duplicate_ids": "(SELECT count(*) - count(DISTINCT id) FROM p)",
    "behavior_cross_split": "(SELECT count(*) FROM (SELECT behavior FROM p GROUP BY behavior HAVING count(DISTINCT split) > 1))",
    "composition_sequence_seen_in_train": _SEEN("test_composition", "sequence", False),
    "composition_component_missing_from_train": "(SELECT count(DISTINCT id) FROM (SELECT id, unnest(sequence) AS u FROM p WHERE split = 'test_composition') WHERE u NOT IN (SELECT u FROM (SELECT unnest(sequence) AS u FROM t)))",
    "operation_order_seen_in_train": _SEEN("test_operation_order", "sequence", False),
    "operation_order_without_permutation_in_train": "(SELECT count(*) FROM p WHERE split = 'test_operation_order' AND NOT EXISTS (SELECT 1 FROM t WHERE list_sort(t.sequence) = list_sort(p.sequence) AND t.sequence <> p.sequence))",
    "alpha_marker_allocation_seen_in_train": "(SELECT count(*) FROM p WHERE split = 'test_alpha_renaming' AND markers <> '' AND markers IN (SELECT markers FROM t))",
    "held_out_concept_seen_in_train": "(SELECT coalesce(max(list_contains(concepts, 'finite_state_machine')::BIGINT), 0) FROM t)",
    "held_out_family_seen_in_train": _SEEN("test_family", "family"),
    "held_out_input_length_seen_in_train": _SEEN("test_length", "input_length"),
    "held_out_parameter_seen_in_train": _SEEN("test_parameter_holdout", "parameters", False),
    "held_out_description_style_seen_in_train": "(SELECT coalesce(max((style = 'rules')::BIGINT), 0) FROM t)",
    "program_length_holdout_seen_in_train": _SEEN("test_program_length", "lines"),
    "program_length_split_empty": "(SELECT (count(*) = 0)::BIGINT FROM p WHERE split = 'test_program_length')",
}
_AUDIT = f"WITH p AS ({_PROBLEMS}), t AS (SELECT * FROM p WHERE split = 'train'), a AS (SELECT {', '.join(f'({v})::BIGINT AS {k}' for k, v in _COUNTERS.items())}) SELECT *, {' AND '.join(f'{k} = 0' for k in _COUNTERS)} AND (SELECT count(DISTINCT split) FROM p) = 12 AS passed FROM a"


def lineage(spark: SparkSession, d: str) -> DataFrame:
    """Customers as problems, orders as their auxiliary records, suppliers as benchmarks."""
    c, o, s = (table(spark, d, x) for x in ("customer", "orders", "supplier"))
    own = c.select("c_custkey", (F.col("c_custkey") % 10).alias("s"))
    roots = own.select(F.col("c_custkey").cast("string").alias("id"), F.col("s").cast("string").alias("split"), F.concat(F.lit("l"), F.floor(F.col("c_custkey") / 2)).alias("lineage"), F.concat(F.lit("m"), "c_custkey").alias("mutant"), F.concat(F.lit("a"), F.col("c_custkey") % 50).alias("alpha"))
    aux = o.select(F.col("o_custkey").cast("string").alias("root"), (F.col("o_orderkey") % 10).cast("string").alias("split"), F.concat(F.lit("l"), F.floor(F.col("o_custkey") / 2)).alias("lineage"), F.concat(F.lit("m"), "o_custkey").alias("mutant"), F.concat(F.lit("x"), F.col("o_orderkey") % 9).alias("alpha"))
    k = F.col("s_suppkey")
    marks = s.select(F.when(k % 2 == 0, "test_operation_order").otherwise("test_alpha_renaming").alias("kind"), (k % 3 > 0).alias("proved"), F.when(k % 5 > 0, "ab").alias("distinguishing"), (k % 7 > 0).alias("verified"))
    return splits.lineage_audit(roots, aux, marks)


_LINEAGE = """WITH p AS (SELECT c_custkey::VARCHAR AS id, (c_custkey % 10)::VARCHAR AS split, 'l' || c_custkey // 2 AS lineage, 'm' || c_custkey AS mutant, 'a' || c_custkey % 50 AS alpha FROM customer),
x AS (SELECT o_custkey::VARCHAR AS root, (o_orderkey % 10)::VARCHAR AS split, 'l' || o_custkey // 2 AS lineage, 'm' || o_custkey AS mutant, 'x' || o_orderkey % 9 AS alpha FROM orders), u AS (SELECT split, lineage, mutant, alpha FROM p UNION ALL SELECT split, lineage, mutant, alpha FROM x),
r AS (SELECT (SELECT count(*) FROM (SELECT 1 FROM u GROUP BY lineage HAVING count(DISTINCT split) > 1)) AS lineage_cross_split, (SELECT count(*) FROM (SELECT 1 FROM u GROUP BY mutant HAVING count(DISTINCT split) > 1)) AS mutant_family_cross_split,
(SELECT count(*) FROM x JOIN p ON x.root = p.id WHERE x.split <> p.split) AS auxiliary_reference_cross_split, (SELECT count(*) FROM (SELECT 1 FROM u GROUP BY alpha HAVING count(DISTINCT split) > 1)) AS alpha_equivalent_program_cross_split,
(SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 0 AND (s_suppkey % 3 = 0 OR s_suppkey % 5 = 0)) AS operation_order_unproved, (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 1 AND s_suppkey % 7 = 0) AS alpha_pair_unverified)
SELECT *, lineage_cross_split + mutant_family_cross_split + auxiliary_reference_cross_split + alpha_equivalent_program_cross_split + operation_order_unproved + alpha_pair_unverified = 0 AS passed FROM r"""


# -- records that run again -----------------------------------------------------------------------------------------------
def sorted_letters(v: Column) -> Column:
    return F.array_join(F.array_sort(F.split(v, "")), "")


def word_records(spark: SparkSession, d: str) -> DataFrame:
    """Each word as a record of the sorting program with one test, wrong where the word's length is a multiple of 7."""
    v = F.col("value")
    output = F.when(F.length(v) % 7 == 0, F.reverse(v)).otherwise(sorted_letters(v))
    return words(spark, d).select(v.alias("id"), (F.length(v) % 3).cast("string").alias("split"), F.lit(P.SORT).alias("program"), F.array(F.struct(v.alias("input"), output.alias("output"))).alias("tests"), sorted_letters(v).alias("behavior"), F.length(v).alias("alpha"))


def audited(spark: SparkSession, d: str) -> DataFrame:
    aux = words(spark, d).select(F.col("value").alias("root"), (F.length("value") % 2).cast("string").alias("split"))
    return audits.artifact_audit(word_records(spark, d), aux)


_WORD_AUDIT = f"""WITH w AS ({ABC}), r AS (SELECT count(*) AS record_count, count_if(length(value) % 7 = 0 AND reverse(value) <> {SORTED.format('value')})::BIGINT AS validation_failures, (count(*) - count(DISTINCT {SORTED.format('value')}))::BIGINT AS behavior_duplicates,
(count(*) - count(DISTINCT length(value)))::BIGINT AS alpha_equivalent_duplicates, count_if(length(value) % 3 <> length(value) % 2)::BIGINT AS auxiliary_reference_cross_split FROM w) SELECT *, validation_failures + behavior_duplicates + alpha_equivalent_duplicates + auxiliary_reference_cross_split = 0 AS passed FROM r"""

_OPS = {"delete": (Operation("delete", {"symbols": "b"}), "replace({}, 'b', '')"), "reverse": (Operation("reverse"), "reverse({})"), "rotate": (Operation("rotate", {"amount": 1}), "substr({0}, 2) || left({0}, 1)"), "sort": (Operation("move_symbols", {"order": "abc"}), SORTED), "map": (Operation("map", {"mapping": {"a": "b"}}), "replace({}, 'a', 'b')")}
COMPOSED = {"delete+reverse": ["delete", "reverse"], "reverse+sort": ["reverse", "sort"], "rotate+delete": ["rotate", "delete"], "delete+rotate+reverse": ["delete", "rotate", "reverse"], "sort": ["sort"], "map+rotate+delete": ["map", "rotate", "delete"]}


def _expression(ops: list[str]) -> str:
    return reduce(lambda e, op: _OPS[op][1].format(f"({e})"), ops, "v")


def _composition_sql(name: str, ops: list[str]) -> str:
    differs = lambda some: f"({_expression(some)}) IS DISTINCT FROM ({_expression(ops)})"
    effective = [f"coalesce(bool_or({differs(ops[:i] + ops[i + 1 :])}), false)" for i in range(len(ops))]
    moved = " OR ".join(differs([*ops[:i], ops[i + 1], ops[i], *ops[i + 2 :]]) for i in range(len(ops) - 1)) or "false"
    alone = " OR ".join(f"coalesce(bool_and(NOT {differs([op])}), true)" for op in ops) if len(ops) > 1 else "false"
    listed = lambda want: "[" + ", ".join(f"CASE WHEN {e} = {want} THEN {i} END" for i, e in enumerate(effective)) + "]"
    return f"""SELECT '{name}' AS name, array_to_string(list_filter({listed('true')}, lambda x: x IS NOT NULL), ',') AS effective_components, array_to_string(list_filter({listed('false')}, lambda x: x IS NOT NULL), ',') AS dead_components, coalesce(bool_or({moved}), false) AS order_sensitive,
min(CASE WHEN {moved} THEN {{'n': length(v), 'v': v}} END).v AS order_distinguishing_input, {alone} AS reducible_to_single_stage, {str(len(ops) > 1).lower()} AND NOT ({alone}) AND {' AND '.join(effective)} AS genuine_composition FROM (SELECT value AS v FROM ({ABC}))"""


def analysed(spark: SparkSession, d: str) -> DataFrame:
    found = audits.composition_analysis(words(spark, d), {name: [_OPS[o][0] for o in ops] for name, ops in COMPOSED.items()})
    return found.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("effective_components", "dead_components")})


def compiled_outputs(spark: SparkSession, d: str) -> DataFrame:
    """Every word through the compiled program of every row of operations."""
    made = [(name, compiled([_OPS[o][0] for o in ops], "abc")) for name, ops in COMPOSED.items()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cases = words(spark, d).crossJoin(F.broadcast(spark.createDataFrame(made, "name string, program string"))).repartition(parts, "value", "name")  # a handful of programs
    return cases.select("name", "value", rewrite(F.col("program"), F.col("value"), 100_000)["output"].alias("output"))


def interpreted(spark: SparkSession, d: str) -> DataFrame:
    """Every word through every row of operations as data, not as expressions."""
    rows = spark.createDataFrame([(name, as_json([_OPS[o][0] for o in ops])) for name, ops in COMPOSED.items()], "name string, operations string")
    return words(spark, d).crossJoin(F.broadcast(rows)).select("name", "value", applied(F.col("operations"), F.col("value")).alias("output"))  # a handful of rows


def lineage_problems(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("seq")
    test = F.array(F.struct(F.lit("aa").alias("input"), F.lit("bb").alias("output")))
    return problems(spark, d).select(
        "id", "seq", F.concat(F.lit("a"), F.floor(k / 2)).alias("alpha"), F.when(k % 6 == 0, "(once)=X\nXa=bX\nX=").otherwise("a=b").alias("program"), F.when(k % 6 == 0, F.array(F.lit("X"))).otherwise(F.array().cast("array<string>")).alias("markers"), test.alias("tests"), (k % 5 == 0).alias("order_sensitive"),
        F.size("sequence").alias("depth"), F.when(k % 2 == 0, "ab").alias("distinguishing"), "sequence", (k % 3 > 0).alias("genuine"), F.lit(6).alias("construction_length"), (6 + k % 2 * 3).alias("generalization_length"), pick(("functional", "io_only"), k % 2).alias("level"), F.lit("x").alias("description"), "family", "parameters",
    )


def closed_forms(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    return audits.closed_form_check(words(spark, d), {"sort": (P.SORT, sorted_letters(v)), "delete": (P.DELETE, F.translate(v, "ab", "x")), "collapse": (P.COLLAPSE, F.regexp_replace(v, "a+", "a"))})


_CLOSED = f"""WITH o AS (SELECT 'sort' AS name, value, output, {SORTED.format('value')} AS form FROM ({outcome_sql(P.SORT, ABC, 100_000)}) UNION ALL SELECT 'delete', value, output, replace(replace(value, 'b', ''), 'a', 'x') FROM ({outcome_sql(P.DELETE, ABC, 100_000)})
UNION ALL SELECT 'collapse', value, output, regexp_replace(value, 'a+', 'a', 'g') FROM ({outcome_sql(P.COLLAPSE, ABC, 100_000)})) SELECT name, count(*) AS attempted, count_if(output = form)::BIGINT AS verified, round(count_if(output = form) / count(*), 6) AS fraction FROM o GROUP BY name"""

# -- record schemas ---------------------------------------------------------------------------------------------------------
_DIGEST = "0123456789abcdef" * 4
_SPAN = '{"max_length":6,"min_length":1}'
_RECORD = {
    "id": '"#"', "description": '"turn it round"', "public_tests": '[{"input":"ab","output":"ba"}]', "hidden_tests": "[]", "reference_programs": '["ab=ba"]', "metadata": '{"a":[1,2.5,null]}', "concepts": '["reverse"]', "task_domain": '"d"',
    "algorithm_family": '"f"', "composition_depth": "2", "required_features": "[]", "description_style": '"prose"', "source_type": '"template"', "semantic_fingerprint": f'"{_DIGEST}"', "structural_fingerprint": f'"{_DIGEST}"',
    "declared_composition_depth": "2", "effective_composition_depth": "1", "effective_components": "[0]", "dead_components": "[1]", "component_interaction": '"none"', "order_sensitive": "true", "reducible_to_single_stage": "false",
    "normalized_semantic_ir": '{"k":1}', "specification_level": '"functional"', "solution_revealing_score": "0.25", **{f: f'"{_DIGEST}"' for f in ("concrete_behavior_fingerprint", "alpha_normalized_behavior_fingerprint", "semantic_ir_fingerprint", "alpha_equivalence_class")},
    "ontology_errors": "[]", "root_problem_id": '"r"', "program_lineage_id": '"l"', "mutant_family_id": '"m"', **{f: _SPAN for f in records.DOMAINS}, "audit_reference_verification": "{}", **{f: '"x"' for f in records.COGNITIVE if f != "parameter_instance"},
    "parameter_instance": "{}", "composition_component_probe": '{"all_components_effective":true}',
}
#: What is changed in a record (field, new JSON or None to leave it out), and the errors at each of the three levels.
FLAWS: list[tuple[str, str | None, list[str], list[str], list[str]]] = [
    ("id", '"#"', [], [], []), ("description", '""', *[["description"]] * 3), ("concepts", "[]", *[["concepts"]] * 3), ("concepts", '["a",""]', *[["concepts"]] * 3), ("required_features", '["x",1]', *[["required_features"]] * 3),
    ("semantic_fingerprint", '"ABC"', *[["semantic_fingerprint"]] * 3), ("composition_depth", "4", ["composition_depth"], ["composition_depth", "declared_composition_depth"], ["composition_depth", "declared_composition_depth"]), ("composition_depth", "2.5", ["composition_depth"], ["composition_depth", "declared_composition_depth"], ["composition_depth", "declared_composition_depth"]),
    ("source_type", '"guessed"', *[["source_type"]] * 3), ("public_tests", "[]", *[["public_tests"]] * 3), ("public_tests", '[{"input":"a"}]', *[["public_tests"]] * 3), ("hidden_tests", '[{"input":"a","output":1}]', *[["hidden_tests"]] * 3),
    ("reference_programs", '"a=b"', *[["reference_programs"]] * 3), ("metadata", "[]", *[["metadata"]] * 3), ("metadata", None, *[["missing:metadata"]] * 3), ("id", '""', *[["id"]] * 3), ("misspelt", "1", *[["unknown:misspelt"]] * 3),
    ("metadata", '{"a":NaN}', *[["object"]] * 3), ("order_sensitive", "1", [], ["order_sensitive"], ["order_sensitive"]), ("dead_components", "[-1]", [], ["dead_components"], ["dead_components"]), ("effective_components", "[0,1]", [], ["effective_components"], ["effective_components"]),
    ("specification_level", '"vague"', [], ["specification_level"], ["specification_level"]), ("solution_revealing_score", "1.5", [], ["solution_revealing_score"], ["solution_revealing_score"]), ("audit_domain", '{"max_length":1,"min_length":2}', [], ["audit_domain"], ["audit_domain"]),
    ("root_problem_id", None, [], ["missing:root_problem_id"], ["missing:root_problem_id"]), ("parameter_instance", '"x"', [], [], ["parameter_instance"]), ("memory_model", '""', [], [], ["memory_model"]), ("composition_component_probe", '{"all_components_effective":false}', [], [], ["composition_component_probe"]), ("composition_component_probe", None, [], [], ["composition_component_probe"]),
]


def _json(field: str | None = None, new: str | None = None) -> str:
    fields = {k: v for k, v in (_RECORD | ({field: new} if field else {})).items() if v is not None}
    return "{" + ",".join(f'"{k}":{v}' for k, v in fields.items()) + "}"


def flawed(spark: SparkSession, d: str) -> DataFrame:
    """A record for each customer, by its key with one of the flaws."""
    # around the key's places: joining a line's pieces is cheaper than looking for the places in each line
    pieces = F.array(*(F.array(*map(F.lit, _json(field, new).split("#"))) for field, new, *_ in FLAWS))
    # a file of keys is one task, whatever its records take; a one-element explode: else a later filter is pushed below the repartition
    keys = table(spark, d, "customer").select("c_custkey").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")
    raw = F.call_function("array_join", pieces[(F.col("c_custkey") % len(FLAWS)).cast("int")], F.col("c_custkey").cast("string"))
    return keys.select("c_custkey", F.explode(F.array(raw)).alias("raw"))


def schema(level: str, at: int) -> tuple[Callable, str]:
    said = "[" + ", ".join(quoted("; ".join(f[at])) for f in FLAWS) + "]"
    return lambda s, d: flawed(s, d).select("c_custkey", F.array_join(records.record_errors(F.col("raw"), level), "; ").alias("errors")), f"SELECT c_custkey, ({said})[c_custkey % {len(FLAWS)} + 1] AS errors FROM customer"


def read_back(spark: SparkSession, d: str) -> DataFrame:
    """Customers' records written as a data set and read from it again."""
    import uuid

    root = f"{shared_folder(spark)}/artifacts-{uuid.uuid4().hex}"
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select(k.cast("string").alias("id"), pick(("train", "validation", "test"), (k % 3).cast("int")).alias("split"), F.col("c_name").alias("description"), F.array(F.struct(F.col("c_mktsegment").alias("input"), k.cast("string").alias("output"))).alias("public_tests"), F.col("c_acctbal").alias("balance"))
    aux = rows.select("id", "split", pick(("trace", "repair"), (F.length("id") % 2).cast("int")).alias("type"))
    artifacts.write_artifacts(rows, aux, root, {"rows": {"customers": 1}})
    back = artifacts.read_artifacts(spark, root, "id string, description string, public_tests array<struct<input:string,output:string>>, balance double")
    return back.select("id", "split", "description", F.col("public_tests")[0]["input"].alias("input"), F.col("public_tests")[0]["output"].alias("output"), "balance")


# -- labels -------------------------------------------------------------------------------------------------------------------
FAMILIES = ("binary_increment", "binary_add", "reversal", "symbol_sort", "run_normalizer", "random_dfa", "mapping")
DOMAINS = ("finite_state_machines", "unary_arithmetic", "text", "binary_operations")
CONCEPTS = (["unary_arithmetic"], ["binary_arithmetic", "composition"], ["finite_state_machine"], ["composition"], ["text"])
DESCRIPTIONS = ("输入：一个字。\n输出：另一个字。", "把字母倒过来。然后输出。", "规则按优先级执行", "按转移表执行", "nothing")


def labelled(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey").cast("int")
    return table(spark, d, "part").select(
        k.alias("k"), pick(FAMILIES, k % 7).alias("family"), pick(DOMAINS, k % 4).alias("domain"), (1 + k % 3).alias("depth"), pick(CONCEPTS, k % 5).alias("concepts"), pick(DESCRIPTIONS, k % 5).alias("description"),
        pick(("io_only", "prose", "rules"), k % 11 % 3).alias("style"), pick(("random_mined", "template", "composed"), k % 13 % 3).alias("source"), F.array_join(F.array_repeat(F.lit("a=b"), 1 + F.col("p_size").cast("int") % 8), "\n").alias("program"),
    )


_LABELLED = f"""SELECT p_partkey::INT AS k, ({_LIST(FAMILIES)})[p_partkey % 7 + 1] AS family, ({_LIST(DOMAINS)})[p_partkey % 4 + 1] AS domain, 1 + p_partkey % 3 AS depth, ({_LIST(CONCEPTS)})[p_partkey % 5 + 1] AS concepts, ({_LIST(DESCRIPTIONS)})[p_partkey % 5 + 1] AS description,
['io_only','prose','rules'][p_partkey % 11 % 3 + 1] AS style, ['random_mined','template','composed'][p_partkey % 13 % 3 + 1] AS source, 1 + p_size % 8 AS lines FROM part"""


def all_labels(spark: SparkSession, d: str) -> DataFrame:
    f, dom, depth = F.col("family"), F.col("domain"), F.col("depth")
    spec = labels.specification(F.col("style"), F.col("source"), F.col("description"), F.col("program"), depth)
    return labelled(spark, d).select("k", F.array_join(labels.ontology_errors(f, dom, depth, F.col("concepts")), ",").alias("ontology_errors"), spec["level"].alias("level"), spec["score"].alias("score"), labels.length_category(f, dom, depth).alias("category"), labels.difficulty(F.size(F.split("program", "\n")), depth).alias("difficulty"))


_ALL_LABELS = f"""SELECT k, array_to_string(list_filter([CASE WHEN family = 'binary_increment' AND list_contains(concepts, 'unary_arithmetic') THEN 'binary_increment_mislabeled_unary' END, CASE WHEN starts_with(family, 'binary_') AND NOT list_has_any(concepts, ['binary_arithmetic', 'bitwise_operation', 'binary_representation']) THEN 'binary_family_missing_binary_concept' END,
CASE WHEN depth > 1 AND NOT list_contains(concepts, 'composition') THEN 'composition_missing_concept' END, CASE WHEN domain = 'finite_state_machines' AND NOT list_contains(concepts, 'finite_state_machine') THEN 'fsm_domain_missing_concept' END], lambda x: x IS NOT NULL), ',') AS ontology_errors,
CASE WHEN style = 'io_only' THEN 'io_only' WHEN source = 'random_mined' OR contains(description, '规则按优先级') THEN 'operational' ELSE 'functional' END AS level,
round(CASE WHEN style = 'io_only' THEN 0 WHEN source = 'random_mined' OR contains(description, '规则按优先级') THEN least(1, 0.65 + lines * 0.1) ELSE 0.25 + CASE WHEN depth > 1 THEN 0.1 ELSE 0 END + CASE WHEN contains(description, '转移') THEN 0.15 ELSE 0 END END::DOUBLE, 6) AS score,
CASE WHEN family IN ('random_dfa', 'random_fst') THEN 'dfa_fst' WHEN family IN ('reversal', 'binary_reverse') THEN 'reversal' WHEN family = 'symbol_sort' THEN 'sorting' WHEN contains(family, 'normalizer') THEN 'normalization' WHEN domain IN ('unary_arithmetic', 'binary_operations') THEN 'arithmetic' WHEN depth > 1 THEN 'composition' END AS category,
least(5, 1 + depth + lines // 8)::INT AS difficulty FROM ({_LABELLED})"""
_REWORDED = f"""SELECT k, CASE WHEN starts_with(d, '输入：') AND contains(d, chr(10) || '输出：') THEN '给定' || split_part(substr(d, 4), chr(10) || '输出：', 1) || '，' || split_part(d, chr(10) || '输出：', 2) WHEN contains(d, '。') THEN '输入：' || split_part(d, '。', 1) || '。' || chr(10) || '输出：' || substr(d, instr(d, '。') + 1) ELSE '输出要求：' || d END AS description,
contains(d, '转移') OR contains(d, '规则') AS blacklisted FROM (SELECT k, replace(description, '\\n', chr(10)) AS d FROM ({_LABELLED}))"""
_RENAMED = f"SELECT value, translate(value, 'ac', '!@') AS program FROM ({ABC})"


# -- statistics -----------------------------------------------------------------------------------------------------------------
def measured(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey").cast("int")
    return table(spark, d, "part").select(
        k.cast("string").alias("id"), pick(FAMILIES, k % 7).alias("family"), F.concat(F.lit("t"), k % 60).alias("archetype"), pick(("template", "composed", "teacher"), k % 3).alias("source"), pick(DOMAINS, k % 4).alias("domain"), (1 + k % 3).alias("depth"), (k % 3 == 1).alias("genuine"),
        (k % 3 == 2).alias("superficial"), (k % 17 > 0).alias("probe"), pick(("functional", "io_only", "operational"), k % 19 % 3).alias("level"), F.concat(F.lit("b"), F.floor(k / 2)).alias("behavior"), F.concat(F.lit("a"), F.floor(k / 3)).alias("alpha"), F.concat(F.lit("s"), F.floor(k / 4)).alias("structure"),
        F.when(k % 31 == 0, 0.5).otherwise(1.0).alias("verified"), (1 + F.col("p_size").cast("int") % 9).alias("lines"), F.array(k % 5, k % 7).alias("steps"), ((k % 10) / 10.0).cast("double").alias("identity_fraction"), ((k % 4) / 4.0).cast("double").alias("constant_fraction"), F.lit(1.0).alias("terminating_fraction"),
        (k % 3).alias("distinct_outputs"), (k % 2).alias("overlap"), pick(("train", "validation", "test"), k % 6 % 3).alias("split"), pick(CONCEPTS, k % 5).alias("concepts"), F.concat(F.lit("t"), k % 4).alias("template"), F.lit(0.25).alias("score"), F.lit("independent").alias("interaction"), (1 + k % 2).alias("effective_depth"),
        F.array(F.lit(0), F.lit(1), F.lit(2)).alias("effective"), F.concat(F.lit("x"), F.floor(k / 5)).alias("alpha_behavior"), F.concat(F.lit("i"), F.floor(k / 6)).alias("meaning"), F.when(k % 43 == 0, F.array(F.lit("e"))).otherwise(F.array().cast("array<string>")).alias("ontology_errors"),
    )


def scalars(df: DataFrame) -> DataFrame:
    """The columns that aren't maps."""
    return df.select(*(f.name for f in df.schema.fields if f.dataType.typeName() != "map"))


def distributions(df: DataFrame) -> DataFrame:
    """dimension, value and n of the columns that are maps."""
    maps = [f.name for f in df.schema.fields if f.dataType.typeName() == "map"]
    rows = F.array(*(F.struct(F.lit(m).alias("dimension"), F.map_entries(m).alias("e")) for m in maps))
    return df.select(F.explode(rows).alias("r")).select("r.dimension", F.explode("r.e").alias("e")).select("dimension", F.col("e.key").alias("value"), F.col("e.value").alias("n"))


def _distribution(name: str, expression: str, where: str = "true") -> str:
    return f"SELECT '{name}' AS dimension, ({expression})::VARCHAR AS value, count(*) AS n FROM part WHERE {where} GROUP BY ALL"


_AT = lambda values, index: f"({_LIST(values)})[{index} + 1]"
_COGNITIVE = """SELECT count(*) AS synthesis_problem_count, count(DISTINCT p_partkey % 7) AS cognitive_family_count, count(DISTINCT p_partkey % 60) AS semantic_archetype_count, count_if(p_partkey % 3 = 1)::BIGINT AS genuine_composition_count, round(count_if(p_partkey % 3 > 0) / count(*), 6) AS genuine_composition_fraction,
count_if(p_partkey % 3 > 0 AND p_partkey % 17 = 0)::BIGINT AS composition_component_probe_failures, count_if(p_partkey % 19 % 3 = 2)::BIGINT AS operational_description_count, count(*) - count(DISTINCT p_partkey // 2) AS behavior_duplicates, round(count_if(p_partkey % 31 > 0) / count(*), 6) AS reference_verification_fraction, round(avg(p_partkey % 10 / 10.0), 6) AS identity_fraction_mean,
round(avg(p_partkey % 4 / 4.0), 6) AS constant_fraction_mean, 1.0::DOUBLE AS terminating_fraction, sum(p_partkey % 2)::BIGINT AS public_hidden_overlap, (1 + max(p_size % 9))::INT AS max_program_lines, least(min(p_partkey % 5), min(p_partkey % 7))::INT AS min_steps, greatest(max(p_partkey % 5), max(p_partkey % 7))::INT AS max_steps, round((sum(p_partkey % 5) + sum(p_partkey % 7)) / (2 * count(*)), 6) AS mean_steps,
(SELECT sum(n) FILTER (n > 1) FROM (SELECT count(*) AS n FROM part GROUP BY p_partkey // 3))::BIGINT AS alpha_equivalent_problem_count, (SELECT max(n) FROM (SELECT count(*) AS n FROM part GROUP BY p_partkey // 3)) AS max_alpha_cluster_size FROM part"""
_DISTRIBUTIONS = " UNION ALL ".join([
    _distribution("family_distribution", _AT(FAMILIES, "p_partkey % 7")), _distribution("source_distribution", _AT(("template", "composed", "teacher"), "p_partkey % 3")), _distribution("domain_distribution", _AT(DOMAINS, "p_partkey % 4")), _distribution("depth_distribution", "1 + p_partkey % 3"),
    _distribution("lines_distribution", "1 + p_size % 9"), _distribution("split_distribution", _AT(("train", "validation", "test"), "p_partkey % 6 % 3")),
])
_HARDENING = """SELECT count(*) AS problem_count, count_if(p_partkey % 3 > 0)::BIGINT AS composition_count, count_if(p_partkey % 3 = 1)::BIGINT AS genuine_count, count_if(p_partkey % 3 = 2)::BIGINT AS superficial_count, round(count_if(p_partkey % 3 = 1) / count_if(p_partkey % 3 > 0), 6) AS genuine_fraction, round(count_if(p_partkey % 3 = 2) / count_if(p_partkey % 3 > 0), 6) AS superficial_fraction,
coalesce(bool_and(p_partkey % 2 = 1) FILTER (p_partkey % 3 > 0), true) AS all_effective_depth_at_least_two, true AS all_depth_three_components_effective, count(DISTINCT p_partkey // 2) AS concrete_behavior_unique, count(DISTINCT p_partkey // 5) AS alpha_normalized_behavior_unique, count(DISTINCT p_partkey // 4) AS structural_unique, count(DISTINCT p_partkey // 6) AS semantic_ir_unique,
count(*) - count(DISTINCT p_partkey // 2) AS behavior_duplicates, count_if(p_partkey % 43 = 0)::BIGINT AS ontology_error_count, round(count_if(p_partkey % 31 > 0) / count(*), 6) AS reference_verification_fraction FROM part"""
_QUALITY = """SELECT count(*) AS problem_count, round(sum(p_partkey % 10 / 10.0) / count(*), 6) AS identity_fraction, round(count_if(p_partkey % 3 = 1) / count(*), 6) AS constant_fraction, 1.0::DOUBLE AS terminating_fraction, sum(p_partkey % 2)::BIGINT AS public_hidden_overlap, (count(*) - count(DISTINCT p_partkey // 2))::BIGINT AS behavior_duplicates FROM part"""
_COGNITIVE_CHECKS = f"""SELECT synthesis_problem_count = 60 AND semantic_archetype_count = 60 AS archetypes, cognitive_family_count = 20 AS families, (SELECT bool_and(n = 3) FROM (SELECT count(*) AS n FROM part GROUP BY p_partkey % 7)) AS archetypes_per_family, reference_verification_fraction = 1 AS verified, behavior_duplicates = 0 AS no_behavior_duplicates,
coalesce(alpha_equivalent_problem_count, 0) = 0 AS no_alpha_equivalents, operational_description_count = 0 AS no_operational_descriptions, genuine_composition_fraction BETWEEN 0.15 AND 0.25 AS genuine_fraction, composition_component_probe_failures = 0 AS components_effective, max_program_lines <= 32 AS program_limits,
(SELECT count_if(p_partkey % 6 % 3 = 0) = 40 AND count_if(p_partkey % 6 % 3 = 1) = 10 AND count_if(p_partkey % 6 % 3 = 2) = 10 FROM part) AS split_sizes, false AS passed FROM ({_COGNITIVE})"""
_MOST = lambda key: f"(SELECT max(n) FROM (SELECT count(*) AS n FROM part GROUP BY {key}))"
_DIVERSITY_CHECKS = f"""WITH c AS (SELECT u, count(*) AS n FROM (SELECT unnest({_AT(CONCEPTS, 'p_partkey % 5')}) AS u FROM part) GROUP BY u), r AS (SELECT count(*) AS n, count(DISTINCT p_partkey // 2) AS b, count_if(p_partkey % 31 > 0) AS v, count(DISTINCT p_partkey % 3) AS dp FROM part)
SELECT n BETWEEN 200 AND 500 AS count, false AS domains, (SELECT count(*) FROM c) >= 20 AS concepts, false AS source_types, dp = 3 AS all_depths, (SELECT count_if(p_partkey % 3 > 0) / count(*) FROM part) >= 0.25 AS non_template, v = n AS verified, b = n AS no_behavior_duplicates, true AS no_leakage, {_MOST('p_partkey // 4')} <= 3 AS cluster_sizes, true AS reskin_examples,
{_MOST('p_partkey % 3')} / n < 0.5 AS balanced_source, {_MOST('p_partkey % 4')} / n < 0.5 AS balanced_domain, {_MOST('p_partkey % 7')} / n < 0.5 AS balanced_family, {_MOST('p_partkey % 4')} / n < 0.5 AS balanced_template, (SELECT max(n) FROM c) / n < 0.5 AS balanced_concept, false AS passed FROM r"""


# -- choice of tests and the solver ---------------------------------------------------------------------------------------------
def cases(spark: SparkSession) -> DataFrame:
    ran = outcomes(five(spark), domains.exhaustive(spark, "abc", 0, 3), 200, 30).where("terminating")
    return ran.select(F.col("name").alias("id"), F.col("value").alias("input"), "output")


def chosen_tests(spark: SparkSession, d: str) -> DataFrame:
    return choice.public_hidden(cases(spark), SEED, 10, 20)


def solving(spark: SparkSession, d: str) -> DataFrame:
    """The five problems against a mock provider that is right at once, in the second round, or never."""
    import uuid

    tests = chosen_tests(spark, d)
    programs = five(spark).select(F.col("name").alias("id"), F.col("program").alias("reference"))
    asked = tests.join(programs, "id").select("id", F.concat(F.lit("Problem "), "id").alias("prompt"), "reference", "public_tests", "hidden_tests")
    say = lambda p: F.concat(F.lit("<program>\n"), p, F.lit("\n</program>"))
    first = F.when(F.col("id").isin("sort", "swap"), say(F.col("reference"))).when(F.col("id") == "moves", F.lit("no idea")).otherwise(say(F.lit("a=")))
    answers = programs.select("id", F.lit(0).alias("round"), first.alias("answer")).unionByName(programs.where("id <> 'moves'").select("id", F.lit(1).alias("round"), say(F.col("reference")).alias("answer")))
    cache = solver.Cache(spark, f"{shared_folder(spark)}/answers-{uuid.uuid4().hex}")
    pool = domains.targeted(spark, "abc", 0, 8, 200, SEED)
    return solver.solve(asked, solver.MockProvider(answers), cache, pool).select("id", "round", "failure", "cached", F.col("disclosed").isNotNull().alias("disclosed"))


Q: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "generalization_split": (lambda s, d: splits.generalization_split(problems(s, d).drop("split"), SEED).select("id", "split"), None),
    "generalization_audit": (lambda s, d: splits.generalization_audit(problems(s, d)), _AUDIT),
    "lineage_audit": (lineage, _LINEAGE),
    "artifact_audit": (audited, _WORD_AUDIT),
    "audit_failures": (lambda s, d: audits.failures(word_records(s, d)), f"SELECT value AS id, 'reference_mismatch' AS reason FROM ({ABC}) WHERE length(value) % 7 = 0 AND reverse(value) <> {SORTED.format('value')}"),
    "reproducibility": (lambda s, d: audits.reproducible(lambda: outcomes(five(s), words(s, d), 10_000, 30).select("name", "value", "output", "steps")), f"SELECT 5 * count(*) AS first_rows, 5 * count(*) AS second_rows, 0::BIGINT AS differing, true AS identical FROM ({ABC})"),
    "composition_analysis": (analysed, " UNION ALL ".join(_composition_sql(n, ops) for n, ops in COMPOSED.items())),
    "compiled_compositions": (compiled_outputs, " UNION ALL ".join(f"SELECT '{n}' AS name, v AS value, {_expression(ops)} AS output FROM (SELECT value AS v FROM ({ABC}))" for n, ops in COMPOSED.items())),
    "closed_form_check": (closed_forms, _CLOSED),
    **{f"schema_{level}": schema(level, at) for level, at in (("task", 2), ("hardened", 3), ("cognitive", 4))},
    "record_flatten": (lambda s, d: records.flattened(flawed(s, d).where(F.size(records.record_errors(F.col("raw"), "cognitive")) == 0)).select("id", "description", "family", "depth", "score", "program", F.col("public_tests")[0]["output"].alias("output"), "construction_length"), f"SELECT c_custkey::VARCHAR AS id, 'turn it round' AS description, 'f' AS family, 2 AS depth, 0.25::DOUBLE AS score, 'ab=ba' AS program, 'ba' AS output, 6 AS construction_length FROM customer WHERE c_custkey % {len(FLAWS)} = 0"),
    "artifact_read_back": (read_back, "SELECT c_custkey::VARCHAR AS id, ['train','validation','test'][c_custkey % 3 + 1] AS split, c_name AS description, c_mktsegment AS input, c_custkey::VARCHAR AS output, c_acctbal AS balance FROM customer"),
    "record_labels": (all_labels, _ALL_LABELS),
    "description_rewording": (lambda s, d: labelled(s, d).select("k", labels.reworded(F.col("description")).alias("description"), labels.blacklisted(F.col("description"), ["转移", "规则"]).alias("blacklisted")), _REWORDED),
    "marker_renaming": (lambda s, d: words(s, d).select("value", labels.renamed_markers(F.col("value"), F.array(F.lit("a"), F.lit("c"))).alias("program")), _RENAMED),
    "parameter_key": (lambda s, d: problems(s, d).select("id", labels.parameter_key(F.col("family"), F.col("sequence"), F.transform("sequence", lambda x: F.length(x)), F.array(F.lit("z"), F.col("style")), F.col("input_length")).alias("key")), f"""SELECT id, '{{"behavior_cluster":["' || style || '","z"],"family":"' || family || '","max_input_length":' || input_length || ',"operations":[' || array_to_string(list_transform(sequence, lambda x: '{{"kind":"' || x || '","size":' || length(x) || '}}'), ',') || ']}}' AS key FROM ({_PROBLEMS})"""),
    "dataset_statistics": (lambda s, d: scalars(statistics.quality_statistics(measured(s, d))), _QUALITY),
    "cognitive_statistics": (lambda s, d: scalars(statistics.cognitive_statistics(measured(s, d))), _COGNITIVE),
    "cognitive_distributions": (lambda s, d: distributions(statistics.cognitive_statistics(measured(s, d))), _DISTRIBUTIONS),
    "hardening_statistics": (lambda s, d: scalars(statistics.hardening_statistics(measured(s, d))), _HARDENING),
    "cognitive_checks": (lambda s, d: statistics.cognitive_checks(statistics.cognitive_statistics(measured(s, d))), _COGNITIVE_CHECKS),
    "diversity_checks": (lambda s, d: statistics.diversity_checks(measured(s, d), True, 12), _DIVERSITY_CHECKS),
    "public_test_choice": (chosen_tests, None),
    "solver_loop": (solving, None),
    "recipe_programs": (lambda s, d: datasets.recipes(s, SEED, 60).select("seq", "family", "source", "depth", "program", "reason"), None),
    "dataset_gates": (lambda s, d: datasets.built(datasets.recipes(s, SEED, 90)).select("seq", "family", "reason", "distinct_outputs"), None),
    "hardened_gates": (lambda s, d: datasets.hardened(datasets.dataset(s, SEED, 40, 0.0)[0], 30, SEED)[0].select("id", "family", "depth", "effective_depth"), None),
    "lineage_split": (lambda s, d: splits.lineage_split(lineage_problems(s, d), SEED)[0].select("id", "split"), None),
    "interpreted_operations": (interpreted, " UNION ALL ".join(f"SELECT '{n}' AS name, v AS value, {_expression(ops)} AS output FROM (SELECT value AS v FROM ({ABC}))" for n, ops in COMPOSED.items())),
    "targeted_inputs": (lambda s, d: domains.targeted(s, "abc", 1, 9, 300, SEED), None),
}
QUERIES = {name: query for name, (query, _) in Q.items()}
ORACLES = {name: sql for name, (_, sql) in Q.items() if sql}
