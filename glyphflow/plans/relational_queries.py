"""Queries for domains, fingerprints, aggregates, joins, selection, splits, audits, mining and auxiliary records."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphflow.functions import programs as P
from glyphflow.functions.fingerprints import behavior_signature, ordered_probes, semantic_fingerprint, structural_fingerprint
from glyphflow.functions.kernel import rewrite
from glyphflow.operators import auxiliary, candidates, domains, mining, quality, selection, templates
from glyphflow.operators.batch import outcomes
from glyphflow.plans.kernel_queries import LIMIT, five, words
from glyphflow.plans.oracle import outcome_sql, quoted
from glyphflow.sources import inputs, jsonl
from glyphflow.sources.inputs import table

ABC = inputs.SQL["abc"]
FIVE = " UNION ALL ".join(f"SELECT '{n}' AS name, * FROM ({outcome_sql(p, ABC, LIMIT)})" for n, p in P.FIVE.items())
SHORT = "SELECT '' AS value" + "".join(
    f" UNION ALL SELECT {' || '.join(f'substr(' + chr(39) + 'abc' + chr(39) + f', (i // {3**j}) % 3 + 1, 1)' for j in reversed(range(n)))} FROM range({3**n}) t(i)" for n in range(1, 5)
)
PROBES = " UNION ALL ".join(f"SELECT '{n}' AS name, {quoted(p)} AS program, * FROM ({outcome_sql(p, SHORT, 100, 12)})" for n, p in P.FIVE.items())
SEED = 7


def _mutants(wrong: Callable[[str, str], str], select: str) -> str:
    """For each of the five programs, select from the outcomes x of a mutant q and y of the program p on short values."""
    each = (select.format(name=n, q=quoted(wrong(n, p)), p=quoted(p), pairs=f"(SELECT a.value, a.output AS x, b.output AS y FROM ({outcome_sql(wrong(n, p), SHORT, 2000, 256)}) a JOIN ({outcome_sql(p, SHORT, 2000, 256)}) b USING (value))") for n, p in P.FIVE.items())
    return " UNION ALL ".join(each)


def _shuffled(name: str, program: str) -> str:
    lines = program.split("\n")
    return "\n".join(lines[i] for i in sorted(range(len(lines)), key=lambda i: hashlib.sha256(f"{SEED}\0{name}\0{i}".encode()).hexdigest()))


_AGAIN = " UNION ALL ".join(f"SELECT '{n}' AS name, value, output AS again FROM ({outcome_sql(p, f'SELECT DISTINCT output AS value FROM ({outcome_sql(p, SHORT, 100, 12)}) WHERE terminating', 200, 32)})" for n, p in P.FIVE.items())
_PROPERTIES = f"""WITH r AS (SELECT p.name, p.value, p.output, p.terminating, g.again FROM ({PROBES}) p LEFT JOIN ({_AGAIN}) g ON p.name = g.name AND p.terminating AND p.output = g.value),
a AS (SELECT name, bool_and(terminating) AND coalesce(bool_and(again IS NOT DISTINCT FROM output) FILTER (terminating), true) AS idempotent, coalesce(bool_and(length(output) = length(value)), false) AS length_preserving, coalesce(bool_or(length(output) > length(value)), false) AS length_increasing,
 coalesce(bool_or(length(output) < length(value)), false) AS length_decreasing, coalesce(bool_and(translate(output, 'abc', '') = ''), true) AS alphabet_preserving, count(DISTINCT output) AS n FROM r GROUP BY name)
SELECT name, idempotent, length_preserving, length_increasing, length_decreasing, alphabet_preserving, idempotent AND length_decreasing AS possible_normalizer, n > 1 AND n <= 4 AND NOT alphabet_preserving AS possible_classifier, NOT alphabet_preserving AND n > 4 AS possible_encoder FROM a"""
_COMPLETION = " UNION ALL ".join(
    f"SELECT '{n}' AS problem_id, array_to_string(list_transform(l, lambda x, i: CASE WHEN i - 1 = k THEN '<MISSING_RULE>' ELSE x END), chr(10)) AS incomplete_program, l[k + 1] AS missing_rule, k AS missing_rule_index FROM (SELECT l, (('0x' || substr(sha256('{SEED}' || chr(0) || '{n}'), 1, 8))::BIGINT % len(l))::INT AS k FROM (SELECT string_split({quoted(p)}, chr(10)) AS l))"
    for n, p in P.FIVE.items() if "\n" in p
)
_STATUS = "CASE WHEN error IS NULL THEN 'halted' WHEN error = 'execution_step_limit' THEN 'step_limit' ELSE 'length_limit' END AS label"
_TERMINATION = "SELECT label, count(*) AS n FROM (" + " UNION ALL ".join([
    *(f"SELECT {_STATUS} FROM ({outcome_sql(p, SHORT, 2000, 256)})" for p in P.FIVE.values()),
    *(f"SELECT {_STATUS} FROM ({outcome_sql(p, 'SELECT ' + quoted('a') + ' AS value', steps, length)})" for p, steps, length in (("a=a", 4, 10), ("a=aa", 100, 4))),
]) + ") GROUP BY label"
_GREEDY = f"""WITH RECURSIVE s AS (SELECT source, count(*) AS n, row_number() OVER (ORDER BY sha256('{SEED}' || chr(0) || source)) AS r FROM documents GROUP BY source), t AS (SELECT sum(n)::DOUBLE AS t, count(*) AS k FROM s),
g AS (SELECT 0::BIGINT AS r, NULL::VARCHAR AS source, NULL::VARCHAR AS split, t * 0.8::DOUBLE AS a, t * 0.1::DOUBLE AS b, t * 0.1::DOUBLE AS c FROM t UNION ALL
SELECT r, source, split, a - CASE WHEN split = 'train' THEN n ELSE 0 END, b - CASE WHEN split = 'validation' THEN n ELSE 0 END, c - CASE WHEN split = 'test' THEN n ELSE 0 END FROM
(SELECT s.r, s.source, s.n, g.a, g.b, g.c, CASE WHEN k >= 3 AND s.r <= 3 THEN ['train','validation','test'][s.r] WHEN g.a >= g.b AND g.a >= g.c THEN 'train' WHEN g.b >= g.c THEN 'validation' ELSE 'test' END AS split FROM g, t, s WHERE s.r = g.r + 1))
SELECT source, split FROM g WHERE r > 0"""
_TWO_KEYS = """WITH RECURSIVE g AS (SELECT min(p_partkey) AS k, [arg_min(p_brand, p_partkey)] AS brands, [arg_min(p_type, p_partkey)] AS types FROM part UNION ALL
SELECT min(p.p_partkey), list_append(g.brands, arg_min(p.p_brand, p.p_partkey)), list_append(g.types, arg_min(p.p_type, p.p_partkey)) FROM g JOIN part p ON p.p_partkey > g.k AND NOT list_contains(g.brands, p.p_brand) AND NOT list_contains(g.types, p.p_type) GROUP BY g.k, g.brands, g.types)
SELECT p_partkey, p_brand, p_type FROM part WHERE p_partkey IN (SELECT k FROM g)"""


def probes(spark: SparkSession) -> DataFrame:
    return outcomes(five(spark), domains.exhaustive(spark, "abc", 0, 4), 100, 12)


def parts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part")


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def signatures(spark: SparkSession, d: str) -> DataFrame:
    return probes(spark).groupBy("name").agg(ordered_probes().alias("p")).select("name", behavior_signature(F.col("p")).alias("signature"))


def semantics(spark: SparkSession, d: str) -> DataFrame:
    return probes(spark).groupBy("name").agg(ordered_probes().alias("p")).select("name", semantic_fingerprint(F.col("p"), ["a", "b", "c"]).alias("fingerprint"))


def structures(spark: SparkSession, d: str) -> DataFrame:
    """The five programs, and every pair of flags of the line items as a rule."""
    flags = table(spark, d, "lineitem").select(F.lower(F.concat("l_returnflag", F.lit("="), "l_linestatus")).alias("program")).distinct()
    rows = five(spark).select("program").unionByName(flags)
    return rows.select("program", structural_fingerprint(F.col("program"), ["a", "b", "c"]).alias("fingerprint"))


def properties(spark: SparkSession, d: str) -> DataFrame:
    again = rewrite(F.col("program"), F.coalesce("output", F.lit("")), 200, 32)["output"]
    return quality.behavior_properties(probes(spark).withColumn("again", F.when(F.col("terminating"), again)), "name", "abc")


def problem_cases(spark: SparkSession, d: str) -> DataFrame:
    """problem_id, program, input: five programs on all strings of up to four letters."""
    return five(spark).withColumnRenamed("name", "problem_id").crossJoin(F.broadcast(domains.exhaustive(spark, "abc", 0, 4).withColumnRenamed("value", "input")))


def records(spark: SparkSession, d: str) -> DataFrame:
    """Customers as records: behavior by segment and nation, family by nation, two lists of inputs from the keys."""
    c = table(spark, d, "customer")
    rows = c.select(F.col("c_custkey").alias("id"), F.concat_ws("/", "c_mktsegment", "c_nationkey").alias("behavior"), F.concat(F.lit("n"), F.col("c_nationkey")).alias("family"), F.array(F.col("c_custkey") % 7, F.col("c_custkey") % 11).alias("public"), F.array(F.col("c_custkey") % 5).alias("hidden"))
    return rows.withColumn("split", F.when(F.col("id") % 10 < 8, "train").when(F.col("id") % 10 == 8, "validation").otherwise("test"))


def first_differences(spark: SparkSession, d: str) -> DataFrame:
    """The first word on which each program and the same program without its last rule differ."""
    cases = words(spark, d).withColumnRenamed("value", "input").crossJoin(F.broadcast(five(spark).withColumnRenamed("name", "problem_id")))  # five programs
    return auxiliary.distinguishing(cases)


def tests_of(spark: SparkSession, d: str) -> DataFrame:
    """Problems with tests: curated outcomes of the five programs, ten public ones first."""
    p = probes(spark).where("terminating").groupBy("name").agg(ordered_probes().alias("p"))
    return p.select(F.col("name").alias("id"), F.transform("p", lambda x: F.struct(x["i"].alias("input"), x["o"].alias("output"))).alias("tests"), F.lit(10).alias("public"))


def catalogue(spark: SparkSession, d: str, brands: list[str] | None) -> DataFrame:
    """Kinds of parts as records: concepts from the words of the type, operations from its letters."""
    p = parts(spark, d).select("p_type", "p_brand").distinct()
    p = p.groupBy("p_type").agg(F.min("p_brand").alias("b"))
    last = F.right("b", F.lit(1)).cast("int") % 2 == (0 if brands else 1)
    return p.where(last).select(F.col("p_type").alias("id"), F.array_distinct(F.split("p_type", " ")).alias("concepts"), F.split(F.lower("p_type"), "").alias("operations"), F.lower("p_type").alias("structure"), F.col("b").alias("behavior"))


_CAT = "SELECT p_type AS id, string_split(p_type, ' ') AS c, string_split(lower(p_type), '') AS s, lower(p_type) AS st, min(p_brand) AS b FROM part GROUP BY p_type"
_NOVEL = f"""WITH e AS (SELECT * FROM ({_CAT}) WHERE right(b, 1)::INT % 2 = 1), k AS (SELECT * FROM ({_CAT}) WHERE right(b, 1)::INT % 2 = 0),
d AS (SELECT k.id, 0.6 * (1 - len(list_intersect(k.c, e.c)) / len(list_distinct(list_concat(k.c, e.c)))) + 0.4 * (1 - len(list_filter(range(1, 1 + least(len(k.s), len(e.s))), lambda i: k.s[i] = e.s[i])) / greatest(len(k.s), len(e.s))) AS x FROM k, e),
l AS (SELECT list(DISTINCT u) AS known FROM (SELECT unnest(c) AS u FROM e)),
n AS (SELECT k.id, len(list_filter(list_distinct(k.c), lambda w: NOT list_contains(known, w))) / len(list_distinct(k.c)) AS a,
 (CASE WHEN k.s IN (SELECT s FROM e) THEN 0.0 ELSE 1.0 END)::DOUBLE AS b, (CASE WHEN k.st IN (SELECT st FROM e) THEN 0.0 ELSE 1.0 END)::DOUBLE AS c, (CASE WHEN k.b IN (SELECT b FROM e) THEN 0.0 ELSE 1.0 END)::DOUBLE AS dd, coalesce((SELECT min(x) FROM d WHERE d.id = k.id), 1.0) AS m FROM k, l)
SELECT id, round(a, 6) AS concept_novelty, b AS composition_novelty, c AS structural_novelty, dd AS behavior_novelty, round(m, 6) AS nearest_distance, round((a + b + c + dd + m) / 5, 6) AS total FROM n"""


def quality_of(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_metrics(outcomes(five(spark), words(spark, d), LIMIT, 30), "name")


_QUALITY = f"""WITH o AS ({' UNION ALL '.join(f"SELECT '{n}' AS name, * FROM ({outcome_sql(p, ABC, LIMIT, 30)})" for n, p in P.FIVE.items())}), c AS (SELECT name, max(k) AS m FROM (SELECT name, output, count(*) AS k FROM o WHERE terminating GROUP BY ALL) GROUP BY name)
SELECT name, count(*) AS n, coalesce(round(count_if(output = value) / nullif(count_if(terminating), 0), 6), 0) AS identity_fraction, coalesce(round(max(m) / nullif(count_if(terminating), 0), 6), 0) AS constant_fraction,
 round(count_if(terminating) / count(*), 6) AS terminating_fraction, count(DISTINCT output) AS distinct_outputs, min(steps) AS min_steps, max(steps) AS max_steps, round(sum(steps) / count(*), 6) AS mean_steps FROM o LEFT JOIN c USING (name) GROUP BY name"""

Q: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "exhaustive_domain": (lambda s, d: domains.exhaustive(s, "abc", 0, 4), SHORT),
    "binary_domain": (lambda s, d: domains.exhaustive(s, "01", 1, 10, False), "SELECT bin(i) AS value FROM range(1024) t(i)"),
    "field_domain": (lambda s, d: domains.unary_fields(s, 12), "SELECT repeat('a', i::INT) || ',' || repeat('a', j::INT) AS value FROM range(1, 13) t(i), range(1, 13) u(j)"),
    "unary_domain": (lambda s, d: domains.unary(s, 16), "SELECT repeat('a', i::INT) AS value FROM range(17) t(i)"),
    "input_pool": (lambda s, d: domains.pool(s, "abc", 1, 8, 200, 4, SEED), None),
    "candidate_rules": (lambda s, d: s.createDataFrame([(r,) for r in domains.candidate_rules("abc")], "rule string"), "WITH l AS (SELECT unnest(['a','b','c']) AS x) SELECT a.x || '=' || b.x AS rule FROM l a, l b WHERE a.x <> b.x UNION ALL SELECT x || '=' || upper(x) FROM l UNION ALL SELECT x || '=' FROM l UNION ALL SELECT x || x || '=' || x FROM l UNION ALL SELECT '(start)' || x || '=' FROM l UNION ALL SELECT '(end)' || x || '=' FROM l UNION ALL SELECT '(once)' || x || '=' FROM l UNION ALL SELECT x || '=(return)yes' || chr(10) || '=(return)no' FROM l UNION ALL SELECT a.x || b.x || '=' || b.x || a.x FROM l a, l b WHERE a.x <> b.x"),
    "behavior_signature": (signatures, f"""SELECT name, sha256('[' || string_agg('{{"error":' || coalesce('"' || error || '"', 'null') || ',"input":"' || value || '","output":' || coalesce('"' || output || '"', 'null') || ',"terminating":' || terminating || '}}', ',' ORDER BY length(value), value) || ']') AS signature FROM ({PROBES}) GROUP BY name"""),
    "semantic_fingerprint": (semantics, None),
    "structural_fingerprint": (structures, None),
    "behavior_properties": (properties, _PROPERTIES),
    "mining_clusters": (lambda s, d: mining.mine(s, SEED, 60), None),
    "baseline_table": (lambda s, d: mining.baselines(tests_of(s, d)), None),
    "novelty_score": (lambda s, d: mining.novelty(catalogue(s, d, ["even"]), catalogue(s, d, None)), _NOVEL),
    "quality_metrics": (quality_of, _QUALITY),
    "quality_gate": (lambda s, d: quality.gated(quality_of(s, d), 0.95, 0.2, 0.05).groupBy("reason").agg(F.count(F.lit(1)).alias("n")), f"SELECT CASE WHEN terminating_fraction < 0.95 THEN 'non_terminating' WHEN identity_fraction > 0.2 THEN 'identity' WHEN constant_fraction > 0.05 THEN 'constant' END AS reason, count(*) AS n FROM ({_QUALITY}) GROUP BY ALL"),
    "step_histogram": (lambda s, d: quality.histogram(outcomes(five(s), words(s, d), LIMIT), "steps"), f"SELECT steps, count(*) AS n FROM ({FIVE}) GROUP BY steps"),
    "duplicates": (lambda s, d: quality.duplicates(docs(s, d), "text"), "SELECT (count(*) - count(DISTINCT text))::DECIMAL(38,0) AS duplicates, count(DISTINCT text) AS keys FROM documents"),
    "cross_split_keys": (lambda s, d: quality.crossing(docs(s, d), "text", "source"), "SELECT text, count(DISTINCT source) AS n_splits FROM documents GROUP BY text HAVING count(DISTINCT source) > 1"),
    "marginals_grouping_sets": (lambda s, d: quality.marginals(parts(s, d), ["p_brand", "p_type", "p_size"], ["p_brand", "p_size"]), "SELECT CASE WHEN grouping(p_type) = 0 THEN 'p_type' WHEN grouping(p_brand) = 0 AND grouping(p_size) = 0 THEN 'p_brand+p_size' WHEN grouping(p_brand) = 0 THEN 'p_brand' ELSE 'p_size' END AS dimension, p_brand, p_type, p_size, count(*) AS n FROM part GROUP BY GROUPING SETS ((p_brand), (p_type), (p_size), (p_brand, p_size))"),
    "joint_distribution": (lambda s, d: docs(s, d).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL"),
    "cluster_histogram": (lambda s, d: quality.cluster_sizes(docs(s, d), "text"), "SELECT size, count(*) AS clusters FROM (SELECT count(*) AS size FROM documents GROUP BY text) GROUP BY size"),
    "topk_clusters": (lambda s, d: quality.largest(docs(s, d), "text", 30), "SELECT text, count(*) AS size FROM documents GROUP BY text ORDER BY size DESC, text LIMIT 30"),
    "uniqueness_score": (lambda s, d: quality.uniqueness(parts(s, d).withColumn("words", F.split("p_type", " ")), "p_partkey", ["words"], ["p_brand", "p_size"]), "WITH w AS (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS u FROM part), c AS (SELECT u, count(*) AS n FROM w GROUP BY u), m AS (SELECT p_partkey, avg(1.0::DOUBLE / n) AS x FROM w JOIN c USING (u) GROUP BY p_partkey) SELECT p_partkey, round(x + 1.0::DOUBLE / count(*) OVER (PARTITION BY p_brand) + 1.0::DOUBLE / count(*) OVER (PARTITION BY p_size), 6) AS score FROM part JOIN m USING (p_partkey)"),
    "length_audit": (lambda s, d: quality.length_audit(parts(s, d), F.element_at(F.split("p_type", " "), 1), ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "ABSENT"], {"sizes": F.col("p_size").cast("int")}, F.col("p_retailprice") > 950), "SELECT x AS category, count(p_partkey) AS n, coalesce(list_sort(list(DISTINCT p_size::INT) FILTER (p_size IS NOT NULL)), []) AS sizes, coalesce(bool_and(p_retailprice > 950), true) AS all_hold FROM (SELECT unnest(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD','ABSENT']) AS x) LEFT JOIN part ON split_part(p_type, ' ', 1) = x GROUP BY x"),
    "confounding": (lambda s, d: quality.confounding(table(s, d, "customer").withColumn("nation", F.col("c_nationkey").cast("string")), "c_mktsegment", "BUILDING", ["nation"]), "WITH s AS (SELECT c_mktsegment, list(DISTINCT c_nationkey::VARCHAR) AS l FROM customer GROUP BY 1), b AS (SELECT l AS t FROM s WHERE c_mktsegment = 'BUILDING') SELECT c_mktsegment, list_sort(list_concat(list_filter(l, lambda x: NOT list_contains(t, x)), list_filter(t, lambda x: NOT list_contains(l, x)))) AS nation, len(list_filter(l, lambda x: NOT list_contains(t, x))) + len(list_filter(t, lambda x: NOT list_contains(l, x))) > 0 AS confounded FROM s, b WHERE c_mktsegment <> 'BUILDING'"),
    "exit_checks": (lambda s, d: quality.checks(docs(s, d), {"has_rows": F.count(F.lit(1)) > 0, "ids_differ": F.count(F.lit(1)) == F.count_distinct("doc_id"), "texts_differ": F.count(F.lit(1)) == F.count_distinct("text"), "four_languages": F.count_distinct("lang") == 4}), "SELECT count(*) > 0 AS has_rows, count(*) = count(DISTINCT doc_id) AS ids_differ, count(*) = count(DISTINCT text) AS texts_differ, count(DISTINCT lang) = 4 AS four_languages, count(*) > 0 AND count(*) = count(DISTINCT doc_id) AND count(*) = count(DISTINCT text) AND count(DISTINCT lang) = 4 AS passed FROM documents"),
    "leakage_audit": (lambda s, d: quality.leakage(records(s, d)), "WITH r AS (SELECT c_custkey AS id, c_mktsegment || '/' || c_nationkey AS behavior, c_nationkey AS family, CASE WHEN c_custkey % 10 < 8 THEN 'train' WHEN c_custkey % 10 = 8 THEN 'validation' ELSE 'test' END AS split FROM customer) SELECT (count(*) - count(DISTINCT id))::DECIMAL(38,0) AS duplicate_ids, (count(*) - count(DISTINCT behavior))::DECIMAL(38,0) AS duplicate_behaviors, (SELECT count(*) FROM (SELECT behavior FROM r GROUP BY behavior HAVING count(DISTINCT split) > 1)) AS behavior_cross_split, (SELECT count(*) FROM (SELECT family FROM r GROUP BY family HAVING count(DISTINCT split) > 1)) AS family_cross_split, (SELECT sum((c_custkey % 5 IN (c_custkey % 7, c_custkey % 11))::INT) FROM customer) AS public_hidden_overlap FROM r"),
    "hidden_anti_public": (lambda s, d: docs(s, d).select("text").join(table(s, d, "conversations").select("text"), "text", "left_anti").groupBy(F.lit("documents").alias("side")).agg(F.count(F.lit(1)).alias("n")), "SELECT 'documents' AS side, count(*) AS n FROM documents WHERE text NOT IN (SELECT text FROM conversations WHERE text IS NOT NULL)"),
    "public_semi_hidden": (lambda s, d: table(s, d, "labels").join(docs(s, d).where("lang = 'en'"), "doc_id", "left_semi"), "SELECT * FROM labels WHERE doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')"),
    "aux_left_default": (lambda s, d: docs(s, d).join(table(s, d, "labels"), "doc_id", "left").select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"), F.coalesce("toxic", F.lit(-1)).alias("toxic")), "SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM documents LEFT JOIN labels USING (doc_id)"),
    "cross_split_mismatch": (lambda s, d: docs(s, d).select("text", F.col("source").alias("a")).distinct().join(docs(s, d).select("text", F.col("source").alias("b")).distinct(), "text").where("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "SELECT x.source AS a, y.source AS b, count(*) AS n FROM (SELECT DISTINCT text, source FROM documents) x JOIN (SELECT DISTINCT text, source FROM documents) y ON x.text = y.text AND x.source < y.source GROUP BY ALL"),
    "reversed_sequence_pairs": (lambda s, d: words(s, d).alias("a").join(words(s, d).alias("b"), F.reverse("a.value") == F.col("b.value")).where("a.value <> b.value").select(F.col("a.value").alias("value"), F.col("b.value").alias("reversed")), f"WITH w AS ({ABC}) SELECT a.value, b.value AS reversed FROM w a JOIN w b ON reverse(a.value) = b.value WHERE a.value <> b.value"),
    "component_division": (lambda s, d: words(s, d).where(F.forall(F.split("value", ""), lambda c: F.array_contains(F.array(F.lit("a"), F.lit("b")), c))), f"SELECT value FROM ({ABC}) WHERE NOT contains(value, 'c')"),
    "first_seen_dedup": (lambda s, d: selection.first_seen(docs(s, d).select("doc_id", "text", "source"), ["text"], ["doc_id"]), "SELECT min(doc_id) AS doc_id, text, arg_min(source, doc_id) AS source FROM documents GROUP BY text"),
    "cluster_cap": (lambda s, d: selection.capped(docs(s, d).select("doc_id", "source"), ["source"], ["doc_id"], 3), "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3"),
    "round_robin": (lambda s, d: selection.round_robin(docs(s, d).select("doc_id", "lang"), "lang", ["doc_id"], 100), "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS t, count(*) OVER (PARTITION BY lang) AS n FROM documents) ORDER BY t, n, lang LIMIT 100"),
    "first_per_key": (lambda s, d: selection.representatives(parts(s, d).select("p_partkey", "p_brand"), ["p_brand"], ["p_partkey"], 40), "SELECT p_partkey, p_brand FROM (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) > 1 AS later FROM part) ORDER BY later, p_brand, p_partkey LIMIT 40"),
    "stable_hash_order": (lambda s, d: quality.window_rank(table(s, d, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"], [selection.stable_key(SEED, "c_custkey"), "c_custkey"]), f"SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY sha256('{SEED}' || chr(0) || c_custkey), c_custkey)::INT AS rank FROM customer"),
    "family_split": (lambda s, d: selection.family_split(parts(s, d).select("p_partkey", "p_type"), "p_partkey", "p_type", SEED).select("p_partkey", "split"), f"SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY p_type ORDER BY sha256('{SEED}' || chr(0) || p_partkey), p_partkey) <= 2 THEN 'train' WHEN ('0x' || substr(sha256('{SEED}' || chr(0) || p_type), 1, 2))::INT % 2 = 1 THEN 'validation' ELSE 'test' END AS split FROM part"),
    "rebalance": (lambda s, d: selection.rebalanced(table(s, d, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 4 == 0, "test").otherwise("validation").alias("split")), "validation", "test", "s_suppkey", 60), "WITH a AS (SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'test' ELSE 'validation' END AS x FROM supplier), b AS (SELECT s_suppkey, CASE WHEN x = 'validation' AND row_number() OVER (PARTITION BY x ORDER BY s_suppkey) > 60 THEN 'test' ELSE x END AS y FROM a) SELECT s_suppkey, CASE WHEN y = 'test' AND row_number() OVER (PARTITION BY y ORDER BY s_suppkey) > 60 THEN 'validation' ELSE y END AS split FROM b"),
    "weighted_choice": (lambda s, d: selection.weighted_choice(table(s, d, "nation").select("n_name", (F.col("n_regionkey") + 1).cast("long").alias("w")), "n_name", "w", table(s, d, "orders").select("o_orderkey", ((F.col("o_orderkey") % 1000) / 1000).alias("point"))), "WITH c AS (SELECT n_name, sum(n_regionkey + 1) OVER (ORDER BY n_name) AS e, n_regionkey + 1 AS w, sum(n_regionkey + 1) OVER () AS t FROM nation) SELECT o_orderkey, (o_orderkey % 1000) / 1000 AS point, n_name FROM orders JOIN c ON (o_orderkey % 1000) / 1000 * t >= e - w AND (o_orderkey % 1000) / 1000 * t < e"),
    "greedy_capacity_split": (lambda s, d: selection.capacity_split(docs(s, d), "source", {"train": 0.8, "validation": 0.1, "test": 0.1}, SEED), _GREEDY),
    "two_key_dedup": (lambda s, d: selection.two_key_dedup(parts(s, d).select("p_partkey", "p_brand", "p_type"), "p_partkey", "p_brand", "p_type"), _TWO_KEYS),
    "ablation_effective": (lambda s, d: first_differences(s, d), f"WITH o AS ({' UNION ALL '.join(f"SELECT '{n}' AS problem_id, {quoted(q)} AS program_a, {quoted(p)} AS program_b, a.value, a.output AS x, b.output AS y FROM ({outcome_sql(q, ABC, 2000, 256)}) a JOIN ({outcome_sql(p, ABC, 2000, 256)}) b USING (value)" for n, p in P.FIVE.items() for q in [p.rpartition(chr(10))[0]])}) SELECT problem_id, program_a, program_b, arg_min(value, {{'n': length(value), 'v': value}}) AS input, arg_min(x, {{'n': length(value), 'v': value}}) AS output_a, arg_min(y, {{'n': length(value), 'v': value}}) AS output_b FROM o WHERE x IS DISTINCT FROM y GROUP BY ALL"),
    "aux_execution": (lambda s, d: auxiliary.execution(problem_cases(s, d)), " UNION ALL ".join(f"SELECT '{n}' AS problem_id, {quoted(p)} AS program, value AS input, output FROM ({outcome_sql(p, SHORT, 2000, 256)})" for n, p in P.FIVE.items())),
    "aux_trace": (lambda s, d: auxiliary.traces(problem_cases(s, d)), None),
    "aux_termination": (lambda s, d: auxiliary.termination(problem_cases(s, d)).groupBy("label").agg(F.count(F.lit(1)).alias("n")), _TERMINATION),
    "aux_repair": (lambda s, d: auxiliary.repair(problem_cases(s, d)), " UNION ALL ".join(f"SELECT '{n}' AS problem_id, {quoted(p.rpartition(chr(10))[0])} AS wrong_program, {quoted(p)} AS fixed_program, arg_min(value, {{'n': length(value), 'v': value}}) AS input, arg_min(y, {{'n': length(value), 'v': value}}) AS output FROM (SELECT a.value, a.output AS x, b.output AS y FROM ({outcome_sql(p.rpartition(chr(10))[0], SHORT, 2000, 256)}) a JOIN ({outcome_sql(p, SHORT, 2000, 256)}) b USING (value)) WHERE x IS DISTINCT FROM y" for n, p in P.FIVE.items())),
    "aux_completion": (lambda s, d: auxiliary.completion(problem_cases(s, d), SEED), _COMPLETION),
    "aux_ordering": (lambda s, d: auxiliary.ordering(problem_cases(s, d), SEED), _mutants(_shuffled, "SELECT '{name}' AS problem_id, {q} AS shuffled_program, {p} AS ordered_program WHERE EXISTS (SELECT 1 FROM {pairs} WHERE x IS DISTINCT FROM y)")),
    "aux_equivalence": (lambda s, d: auxiliary.equivalence(problem_cases(s, d)), _mutants(lambda n, p: p.rpartition("\n")[0], "SELECT '{name}' AS problem_id, {q} AS program_a, {p} AS program_b, false AS label WHERE EXISTS (SELECT 1 FROM {pairs} WHERE x IS DISTINCT FROM y)") + "".join(f" UNION ALL SELECT '{n}', {quoted(p)}, {quoted(p)}, true" for n, p in P.FIVE.items())),
    "blacklist": (lambda s, d: docs(s, d).select("doc_id", F.exists(F.array(F.lit("license"), F.lit("the of")), lambda p: F.contains("text", p)).alias("hit")), "SELECT doc_id, contains(text, 'license') OR contains(text, 'the of') AS hit FROM documents"),
    "features": (lambda s, d: s.createDataFrame([(p,) for p in (P.SORT, P.ONCE, P.RETURN, P.ANCHORS, P.MOVES)], "program string").select("program", F.filter(F.array(*(F.lit(k) for k in ("once", "start", "end", "return"))), lambda f: F.contains("program", F.concat(F.lit("("), f, F.lit(")")))).alias("features")), " UNION ALL ".join(f"SELECT {quoted(p)} AS program, list_filter(['once','start','end','return'], lambda f: contains({quoted(p)}, '(' || f || ')')) AS features" for p in (P.SORT, P.ONCE, P.RETURN, P.ANCHORS, P.MOVES))),
    "json_lines": (lambda s, d: jsonl.as_json(docs(s, d).select("doc_id", "lang", "source")), """SELECT '{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '"}' AS value FROM documents"""),
    "schema_errors": (lambda s, d: docs(s, d).select(F.explode(F.split("text", "\n")).alias("raw")).select("raw", jsonl.problems_of(F.col("raw"), jsonl.TASK).alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n")), "SELECT CASE WHEN trim(r) = '' THEN 'blank line' ELSE 'not a JSON object' END AS error, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS r FROM documents) GROUP BY ALL"),
    "candidate_gate": (lambda s, d: table(s, d, "conversations").select("conv_id", "turn", candidates.gate(candidates.extracted(F.col("text")), 3, 200).alias("reason")), "SELECT conv_id, turn, CASE WHEN length(t) - length(replace(t, chr(10), '')) + 1 > 3 THEN 'too_many_lines' WHEN length(t) > 200 THEN 'too_many_characters' END AS reason FROM (SELECT conv_id, turn, trim(text, ' ' || chr(9) || chr(13) || chr(10)) AS t FROM conversations)"),
    "program_templates": (lambda s, d: templates.generate(s, SEED, 40), None),
    "public_view": (lambda s, d: jsonl.public_view(tests_of(s, d).select("id", F.lit("x").alias("description"), F.slice("tests", 1, 10).alias("public_tests"), F.col("tests").alias("hidden_tests"))), None),
}
QUERIES = {name: query for name, (query, _) in Q.items()}
ORACLES = {name: sql for name, (_, sql) in Q.items() if sql}
