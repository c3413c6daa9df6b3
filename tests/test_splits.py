"""Splits, choice of tests and audits against plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from glyphflow.functions.kernel import run
from glyphflow.functions.patterns import SEARCHES, filled, letters_of
from glyphflow.operators import audits, choice, domains, selection, splits

COLUMNS = "id string, seq int, family string, input_length int, style string, concepts array<string>, sequence array<string>, lines int, structure string, markers string, parameters string, behavior string"


def problems(rng, n):
    kinds = ["map", "delete", "reverse", "rotate"]
    out = []
    for i in range(n):
        sequence = rng.sample(kinds, rng.choice([1, 1, 2, 2, 3]))
        out.append((f"p{i}", i, rng.choice(["f1", "f2", "f3", "f4", "reversal"][: rng.choice([4, 5])]), rng.choice([4, 5, 6, 6, 9] if rng.random() < 0.2 else [4, 5, 6]), rng.choice(["prose"] * 6 + ["rules"]), ["c", *rng.choice([[]] * 8 + [["finite_state_machine"]])], sequence, rng.randint(1, 9), f"s{rng.randint(0, 30)}", rng.choice(["", f"m{rng.randint(0, 60)}"]), f"k{rng.randint(0, 6)}", f"b{i}"))
    return out


def plain_split(rows, seed):
    """The phases one after another over a list."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    ps = [dict(zip(names, r, strict=True)) for r in rows]
    key = lambda value, s: hashlib.sha256(f"{s}\0{value}".encode()).hexdigest()
    to, forced = {}, set()
    longest = max(p["input_length"] for p in ps)
    for p in ps:
        if "finite_state_machine" in p["concepts"]:
            to[p["id"]] = "test_concept_holdout"
        elif p["family"] == "reversal":
            to[p["id"]] = "test_family"
        elif p["input_length"] == longest:
            to[p["id"]] = "test_length"
        elif p["style"] == "rules":
            to[p["id"]] = "test_description_style"
    free = lambda: [p for p in ps if p["id"] not in to]
    groups = defaultdict(lambda: defaultdict(list))
    for p in free():
        if len(p["sequence"]) >= 2:
            groups[tuple(sorted(p["sequence"]))][tuple(p["sequence"])].append(p["id"])
    found = 0
    for g in groups.values():
        for left in sorted(g):
            if left[::-1] in g and left[::-1] != left:
                forced.add(g[left][0])
                to[g[left[::-1]][0]] = "test_operation_order"
                found += 1
                break
        if found == splits.ORDERS:
            break
    taken = {p["lines"] for p in ps if p["id"] in forced}
    rest = [p for p in free() if p["id"] not in forced]
    lengths = [x for x, n in Counter(p["lines"] for p in rest).items() if n >= 2 and x not in taken]
    for p in rest:
        if lengths and p["lines"] == max(lengths):
            to[p["id"]] = "test_program_length"
    anchors = {}
    for p in free():
        if len(p["sequence"]) == 1:
            anchors.setdefault(p["sequence"][0], p["id"])
    held = []
    for p in sorted(ps, key=lambda p: key(p["id"], seed)):
        s = p["sequence"]
        if len(held) < splits.COMPOSITIONS and len(s) >= 2 and p["id"] not in to and all(k in anchors for k in s) and s not in held and not any(q["id"] in forced and q["sequence"] == s for q in ps):
            held.append(s)
    for p in ps:
        if p["sequence"] in held and p["id"] not in forced:
            to[p["id"]] = "test_composition"
            forced |= {anchors[k] for k in p["sequence"]}
    alone = Counter(p["markers"] for p in ps if p["markers"])
    by = defaultdict(dict)
    for p in free():
        if p["markers"]:
            by[p["structure"]].setdefault(p["markers"], p["id"])
    found = 0
    for g in by.values():
        ms = list(g)
        tests = [m for m in ms[1:] if alone[m] == 1]
        if tests and found < splits.RENAMINGS:
            forced.add(g[ms[0]])
            to[g[tests[0]]] = "test_alpha_renaming"
            found += 1
    by = defaultdict(lambda: defaultdict(list))
    for p in free():
        by[p["family"]][p["parameters"]].append(p["id"])
    found = 0
    for _, g in sorted(by.items()):
        if len(g) >= 2 and found < splits.PARAMETERS:
            order = sorted(g, key=lambda v: key(v, seed + 1))
            forced.add(g[order[0]][0])
            for i in g[order[-1]]:
                to[i] = "test_parameter_holdout"
            found += 1
    marks = {p["markers"] for p in ps if to.get(p["id"]) == "test_alpha_renaming"}
    for p in free():
        if p["id"] not in forced and p["markers"] in marks:
            to[p["id"]] = "test_alpha_renaming"
    rest = sorted((p["id"] for p in free() if p["id"] not in forced), key=lambda i: key(i, seed + 4))
    a, b = max(5, len(ps) // 25), max(5, len(ps) // 20)
    to |= dict.fromkeys(rest[:a], "test_instance") | dict.fromkeys(rest[a : a + b], "validation")
    return {p["id"]: to.get(p["id"], "train") for p in ps}


@pytest.mark.parametrize("seed,n", [(1, 60), (2, 400)])
def test_generalization_split(spark, seed, n):
    rows = problems(random.Random(seed), n)
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    got = splits.generalization_split(df, seed)
    assert {r["id"]: r["split"] for r in got.select("id", "split").collect()} == plain_split(rows, seed)
    audit = splits.generalization_audit(got).first().asDict()
    assert len(audit) == 15 and audit["duplicate_ids"] == audit["held_out_concept_seen_in_train"] == audit["held_out_family_seen_in_train"] == 0


def test_ranks_are_those_of_one_sort(spark):
    rows = [(i, hashlib.sha256(str(i).encode()).hexdigest()) for i in range(500)]
    got = {r["i"]: r["rank"] for r in selection.ranked(spark.createDataFrame(rows, "i int, k string"), ["k"]).collect()}
    assert got == {i: at for at, (i, _) in enumerate(sorted(rows, key=lambda r: r[1]), 1)}


def test_a_clean_split_passes(spark):
    rows = [(name, i, name, i, "x", ["c"], [f"k{i}"], i, f"s{i}", "", f"p{i}", f"b{i}", name) for i, name in enumerate(splits.SPLITS)]
    order = splits.SPLITS.index("test_operation_order")
    rows[order] = (*rows[order][:6], ["b", "a"], *rows[order][7:])
    rows += [("t2", 90, "train", 90, "x", ["c"], ["a", "b"], 90, "s", "", "p", "b90", "train"), ("t3", 91, "train", 91, "x", ["c"], [f"k{splits.SPLITS.index('test_composition')}", "z"], 91, "s", "", "p", "b91", "train")]
    audit = splits.generalization_audit(spark.createDataFrame(rows, COLUMNS + ", split string")).first().asDict()
    assert audit["passed"] and not any(v for k, v in audit.items() if k != "passed")


def test_public_tests_rule_out_cheap_programs(spark):
    rng = random.Random(3)
    cases = {"double": lambda v: v + v, "first": lambda v: v[:1], "same": lambda v: v.replace("a", "b")}
    values = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 4))) for _ in range(60)]
    rows = [(name, v, f(v)) for name, f in cases.items() for v in dict.fromkeys(values)]
    df = spark.createDataFrame(rows, "id string, input string, output string").repartition(3)
    wrong = defaultdict(set)
    for r in choice.mismatches(df).collect():
        wrong[r["id"]].add((r["program"], tuple(r["wrong"])))
    for name, f in cases.items():
        own = [(v, o) for i, v, o in rows if i == name]
        programs = filled([p for use in SEARCHES.values() for p in use], letters_of(v for v, _ in own), sorted({o for _, o in own}))
        room = max(max(len(v), len(o)) for v, o in own) + 32
        expected = set()
        for p in programs:
            bad = tuple(sorted(v for v, o in own if run(p, v, 1000, room)[0] != o))
            if bad and len(bad) < len(own):
                expected.add((p, bad))
        assert wrong[name] == expected
    got = {r["id"]: r for r in choice.public_hidden(df, 5, 8, 10).collect()}
    for name, f in cases.items():
        public, hidden = ([(t["input"], t["output"]) for t in got[name][k]] for k in ("public_tests", "hidden_tests"))
        assert len(public) == 8 and len(hidden) == 10 and not {i for i, _ in public} & {i for i, _ in hidden} and all(f(i) == o for i, o in public + hidden)
        left = [w for _, w in wrong[name] if not set(w) & {i for i, _ in public}]
        assert not left or len(public) == 8
    few = choice.public_hidden(df, 5, 8, 1000).first()
    assert few["reason"] == "insufficient_hidden_tests" and few["public_tests"] is None


def test_picks_follow_the_order_of_needs():
    cases = [("", ""), ("a", "a"), ("b", "c"), ("aa", "x"), ("bbb", "y"), ("ab", "z")]
    assert choice.picked(cases, [{"ab"}, {"ab", "b"}], 1) == [5]
    assert choice.picked(cases, [], 6)[:4] == [1, 2, 3, 4]
    assert sorted(choice.picked(cases, [], 6)) == list(range(6))


def test_failures_find_limits_and_mismatches(spark):
    test = "array<struct<input:string,output:string>>"
    rows = [("good", "a=b", [("a", "b")]), ("bad", "a=b", [("a", "c"), ("a", "d")]), ("long", "\n".join(["a=b"] * 33), []), ("wide", "a=" + "b" * 600, [("x", "x")]), ("unread", "a", [("a", "a")]), ("loop", "a=a", [("a", "a")]), ("none", None, []), ("null", "a=b", [("a", None)])]
    df = spark.createDataFrame([(i, p, [{"input": a, "output": b} for a, b in t]) for i, p, t in rows], f"id string, program string, tests {test}")
    got = sorted((r["id"], r["reason"]) for r in audits.failures(df).collect())
    assert got == sorted([("bad", "reference_mismatch"), ("long", "program_limit"), ("wide", "program_limit"), ("unread", "reference_mismatch"), ("loop", "reference_mismatch"), ("none", "program_limit"), ("null", "reference_mismatch")])


def test_reruns_are_compared_by_lines(spark):
    n = iter([3, 4])
    row = audits.reproducible(lambda: spark.range(next(n))).first()
    assert (row["first_rows"], row["second_rows"], row["differing"], row["identical"]) == (3, 4, 1, False)
    assert audits.reproducible(lambda: spark.range(5)).first()["identical"] and audits.reproducible(lambda: spark.range(0)).first()["identical"]


def test_pools_are_filled_in_order(spark):
    got = [r["value"] for r in domains.pool(spark, "ab", 1, 5, 40, 3, 2).orderBy("seq").collect()]
    short = [r["value"] for r in domains.exhaustive(spark, "ab", 1, 3).collect()]
    assert got[: len(short)] == sorted(short, key=lambda v: (len(v), v)) and got[len(short) : len(short) + 4] == sorted(["aaaaa", "bbbbb", "ababa", "bbbba"]) or set(got[len(short) : len(short) + 4]) == {"aaaaa", "bbbbb", "ababa", "bbbba"}
    assert len(set(got)) == 40 and all(1 <= len(v) <= 5 for v in got)
    assert domains.pool(spark, "ab", 1, 5, 1000, 2, 2).count() == domains.domain_size(2, 1, 5)
    audit = [r["value"] for r in domains.targeted(spark, "ab", 0, 8, 60, 1).collect()]
    assert len(audit) == len(set(audit)) == 60 and {"a" * 8, "b" * 7, "abababab", "a" * 5, "b" * 6} <= set(audit)


LINEAGE = "id string, seq int, alpha string, program string, markers array<string>, tests array<struct<input:string,output:string>>, order_sensitive boolean, depth int, distinguishing string, sequence array<string>, genuine boolean, construction_length int, generalization_length int, level string, description string, family string, parameters string"


def plain_lineage(rows, seed):
    names = [c.split()[0] for c in LINEAGE.split(", ")]
    ps = [dict(zip(names, r, strict=True)) for r in rows]
    key = lambda value, s: hashlib.sha256(f"{s}\0{value}".encode()).hexdigest()
    to, groups, pairs = {}, defaultdict(list), defaultdict(list)
    for p in ps:
        groups[p["alpha"]].append(p)

    def give(p, split):
        if to.setdefault(p["alpha"], split) != split:
            return False
        return True

    n = 0
    for g in sorted(groups.values(), key=lambda g: key(g[0]["id"], seed)):
        marked = [p for p in g if p["markers"]]
        if n < 8 and marked and any(m in marked[0]["program"] for m in marked[0]["markers"]) and give(marked[0], "test_alpha_renaming"):
            pairs["test_alpha_renaming"].append(marked[0]["id"])
            n += 1
    n = 0
    for p in sorted(ps, key=lambda p: key(p["id"], seed + 1)):
        if n < 8 and p["alpha"] not in to and p["order_sensitive"] and p["depth"] >= 2:
            give(p, "test_operation_order")
            pairs["test_operation_order"].append(p["id"])
            n += 1
    anchors, n = defaultdict(list), 0
    for p in ps:
        if len(p["sequence"]) == 1:
            anchors[p["sequence"][0]].append(p)
    for p in sorted(ps, key=lambda p: key(p["id"], seed + 2)):
        if n == 8 or p["alpha"] in to or len(p["sequence"]) < 2 or not p["genuine"] or not all(anchors[k] for k in p["sequence"]):
            continue
        chosen = []
        for k in dict.fromkeys(p["sequence"]):
            a = next((q for q in anchors[k] if q["alpha"] not in to), None)
            if a is None:
                break
            give(a, "train")
            chosen.append(a["id"])
        else:
            if give(p, "test_composition"):
                pairs["test_composition"].append((p["id"], tuple(chosen)))
                n += 1
    for kind, s, most, fits in (("test_length", 3, 12, lambda p: p["generalization_length"] > p["construction_length"]), ("test_description_style", 4, 12, lambda p: p["level"] == "functional")):
        n = 0
        for p in sorted(ps, key=lambda p: key(p["id"], seed + s)):
            if n < most and p["alpha"] not in to and fits(p):
                give(p, kind)
                pairs[kind].append(p["id"])
                n += 1
    families, n = defaultdict(lambda: defaultdict(list)), 0
    for p in ps:
        if p["alpha"] not in to:
            families[p["family"]][p["parameters"]].append(p)
    for _, buckets in sorted(families.items()):
        keys = sorted(buckets, key=lambda v: key(v, seed + 5))
        if n < 10 and len(keys) > 1:
            a, b = buckets[keys[0]][0], buckets[keys[-1]][0]
            if give(a, "train") and give(b, "test_parameter_holdout"):
                pairs["test_parameter_holdout"].append((b["id"], (a["id"],)))
                n += 1
    rest = sorted((p for p in ps if p["alpha"] not in to), key=lambda p: key(p["id"], seed + 6))
    for p in rest[: max(12, len(ps) // 20)]:
        give(p, "validation")
    return {p["id"]: to.get(p["alpha"], "train") for p in ps}, pairs


@pytest.mark.parametrize("seed,n", [(1, 80), (2, 300)])
def test_lineage_split(spark, seed, n):
    rng = random.Random(seed)
    kinds, rows = ["map", "delete", "reverse"], []
    for i in range(n):
        markers = rng.choice([[], [], ["X"], ["Q"]])
        sequence = rng.sample(kinds, rng.choice([1, 1, 2, 3]))
        program = "(once)=X\nXa=bX\nX=" if markers else "a=b"
        tests = [{"input": "aa", "output": "bb" if not markers or rng.random() < 0.8 else "x"}]
        rows.append((f"p{i}", i, f"a{rng.randint(0, n // 2)}", program, markers, tests, rng.random() < 0.3, len(sequence), rng.choice([None, "ab"]), sequence, rng.random() < 0.6, 6, rng.choice([6, 9]), rng.choice(["functional", "io_only"]), "输入：x", f"f{rng.randint(0, 6)}", f"k{rng.randint(0, 5)}"))
    df = spark.createDataFrame(rows, LINEAGE).repartition(4)
    got, benchmarks = splits.lineage_split(df, seed)
    split, pairs = plain_lineage(rows, seed)
    assert {r["id"]: r["split"] for r in got.collect()} == split
    found = defaultdict(list)
    for r in benchmarks.collect():
        found[r["kind"]].append((r["root"], tuple(r["partners"])) if r["partners"] else r["root"])
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in pairs.items() if v}
    assert got.groupBy("alpha").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
