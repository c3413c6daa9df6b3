"""The solving loop: prompts to a provider, candidates out of its answers, gates, tests, one repair round after another.

Each round is a few DataFrame jobs over the problems that are still open; the provider maps prompts to answers and may be
a model, a table of answers or anything else that is a function between DataFrames. Answers are kept by a digest of their
request, so that a rerun asks for what it doesn't have only.
"""

from __future__ import annotations

from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphflow.functions.kernel import rewrite
from glyphflow.operators.candidates import MOST_CHARACTERS, MOST_LINES, extracted
from glyphflow.sources.work import stored

#: Limits of verification runs.
STEPS = 10_000
#: The fields of a proposal, and the largest domain that is verified as a whole.
PROPOSAL = ("algorithm_family", "boundary_inputs", "concepts", "description", "description_style", "input_alphabet", "max_input_length", "min_input_length", "nearest_difference", "program", "required_features", "task_domain", "termination_reason")
MOST_INPUTS = 4096
ASK, AGAIN = "Write the program and nothing else, between <program> and </program>.", "The program fails this case: "


class Provider(Protocol):
    """What answers prompts. name goes into the cache's keys."""

    name: str

    def complete(self, requests: DataFrame) -> DataFrame:
        """id and answer for requests (id, prompt); rows may be missing."""


class MockProvider:
    """Answers from a table (id, round, answer), one for each round, whatever the prompt says."""

    name = "mock"

    def __init__(self, answers: DataFrame):
        self.answers, self.round = answers, -1

    def complete(self, requests: DataFrame) -> DataFrame:
        self.round += 1
        now = self.answers.where(F.col("round") == self.round).select(F.col("id").alias("_id"), "answer")
        return requests.join(now, F.col("id") == F.col("_id")).select("id", "answer")


class Cache:
    """Answers by digest of provider and prompt, in a folder of Parquet files to which each round appends."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        empty = self.spark.createDataFrame([], "key string, answer string")
        try:
            return self.spark.read.schema(empty.schema).parquet(self.path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return empty

    def complete(self, provider: Provider, requests: DataFrame) -> DataFrame:
        """id, answer and cached for requests (id, prompt): from the cache, else from the provider, whose answers are kept."""
        keyed = stored(requests.select("id", "prompt", F.sha2(F.to_json(F.struct(F.col("prompt"), F.lit(provider.name).alias("provider"))), 256).alias("key")), "requests")
        known = self.rows().groupBy(F.col("key").alias("k")).agg(F.min("answer").alias("answer"))
        both = stored(keyed.join(known, F.col("key") == F.col("k"), "left"), "answers")
        fresh = stored(provider.complete(both.where("k is null").select("id", "prompt")).select("id", "answer"), "fresh")
        new = keyed.join(fresh, "id").select("id", "key", "answer")
        new.select("key", "answer").distinct().write.mode("append").parquet(self.path)
        return both.where("k is not null").select("id", "answer", F.lit(True).alias("cached")).unionByName(new.select("id", "answer", F.lit(False).alias("cached")))


def verified(attempts: DataFrame, problems: DataFrame, max_length: int = 256) -> DataFrame:
    """attempts (id, program) with failure (null, or the first of line_limit, character_limit, syntax, public, hidden) and
    case (the first public case that fails).

    problems: id, public_tests, hidden_tests (arrays of struct<input, output>). A failing hidden case is never shown.
    """
    over = F.when(F.size(F.split("program", "\n")) > MOST_LINES, "line_limit").when(F.length("program") > MOST_CHARACTERS, "character_limit")
    tests = problems.select("id", F.posexplode(F.concat(F.transform("public_tests", lambda t: F.struct(t["input"].alias("input"), t["output"].alias("output"), F.lit(True).alias("public"))), F.transform("hidden_tests", lambda t: F.struct(t["input"].alias("input"), t["output"].alias("output"), F.lit(False).alias("public"))))).alias("at", "t")).select("id", "at", "t.*")
    ran = attempts.where(over.isNull()).select("id", "program").join(tests, "id").withColumn("o", rewrite(F.col("program"), F.col("input"), STEPS, max_length))
    wrong = ~F.coalesce(F.col("o.terminating") & (F.col("o.output") == F.col("output")), F.lit(False))
    judged = ran.groupBy("id").agg(
        F.bool_or(F.coalesce(F.startswith("o.error", F.lit("syntax_error")), F.lit(False))).alias("unread"), F.count_if(wrong & F.col("public")).alias("p"), F.count_if(wrong & ~F.col("public")).alias("h"),
        F.min(F.when(wrong & F.col("public"), F.struct("at", "input", "output"))).alias("first"),
    )
    out = attempts.join(judged.withColumnRenamed("id", "_id"), F.col("id") == F.col("_id"), "left").drop("_id")
    failure = over.otherwise(F.when(F.col("unread"), "syntax").when(F.col("p") > 0, "public").when(F.col("h") > 0, "hidden"))
    shown = F.when(failure == "public", F.struct(F.col("first.input").alias("input"), F.col("first.output").alias("output")))
    return out.select(*attempts.columns, failure.alias("failure"), shown.alias("case"))


def counterexamples(attempts: DataFrame, problems: DataFrame, pool: DataFrame, max_length: int = 256) -> DataFrame:
    """id and case: the first input of the pool (seq, value) that isn't one of the problem's own tests and on which a
    candidate differs from the reference program.

    attempts: id, program; problems: id, reference, public_tests, hidden_tests.
    """
    reserved = problems.select("id", F.explode(F.concat("public_tests", "hidden_tests")).alias("t")).select("id", F.col("t.input").alias("value")).distinct()
    spread = F.broadcast(pool)  # a pool is a parameter's size, a few hundred values
    cases = attempts.select("id", "program").join(problems.select("id", "reference"), "id").crossJoin(spread).join(reserved, ["id", "value"], "left_anti")
    a, b = (rewrite(F.col(c), F.col("value"), STEPS, max_length) for c in ("program", "reference"))
    ran = cases.select("id", "seq", "value", a.alias("a"), b.alias("b")).where("b.terminating and not (a.output <=> b.output)")
    return ran.groupBy("id").agg(F.min(F.struct("seq", "value", F.col("b.output").alias("output"))).alias("x")).select("id", F.struct(F.col("x.value").alias("input"), F.col("x.output").alias("output")).alias("case"))


def solve(problems: DataFrame, provider: Provider, cache: Cache, pool: DataFrame, repairs: int = 1) -> DataFrame:
    """id, round, program, failure, cached and disclosed (the case that the round's prompt has told) of every attempt.

    problems: id, prompt, reference, public_tests, hidden_tests. A round asks for the problems without a verified program;
    after a failed public test its case is told again, after a failed hidden test a fresh one that no test has.
    """
    none = F.lit(None).cast("struct<input:string,output:string>")
    open_, rounds = problems.select("id", "prompt", none.alias("disclosed")), []
    for number in range(repairs + 1):
        told = F.when(F.col("disclosed").isNotNull(), F.concat(F.lit(f"\n\n{AGAIN}"), F.to_json("disclosed"))).otherwise("")
        asked = open_.select("id", F.concat("prompt", F.lit(f"\n\n{ASK}"), told).alias("prompt"))
        answers = cache.complete(provider, asked).select("id", "answer", "cached")
        attempts = answers.select("id", extracted(F.col("answer")).alias("program"), "cached")
        done = stored(verified(attempts, problems).join(open_.select("id", "disclosed"), "id").withColumn("round", F.lit(number)), f"round-{number}")
        rounds.append(done)
        if number < repairs:
            fresh = counterexamples(done.where("failure = 'hidden'"), problems, pool).withColumnRenamed("case", "fresh")
            failed = done.where("failure is not null").join(fresh, "id", "left").select("id", F.coalesce("case", "fresh").alias("disclosed"))
            open_ = stored(problems.select("id", "prompt").join(failed, "id"), f"open-{number}")
    columns = ["id", "round", "program", "failure", "cached", "disclosed"]
    return reduce(DataFrame.unionByName, (r.select(*columns) for r in rounds))


def solved_by_level(attempts: DataFrame, problems: DataFrame) -> DataFrame:
    """level, attempted, passed and pass_rate: problems (id, level) with an attempt that passed, by specification level."""
    best = attempts.groupBy("id").agg(F.bool_or(F.col("failure").isNull()).alias("passed"))
    joined = problems.select("id", "level").join(best, "id")
    return joined.groupBy("level").agg(F.count(F.lit(1)).alias("attempted"), F.count_if("passed").alias("passed")).withColumn("pass_rate", F.round(F.col("passed") / F.col("attempted"), 6))


def proposal_errors(raw: Column) -> Column:
    """Why a proposed problem (JSON) is refused, or null: object, missing fields, concepts, termination reason, limits, input
    domain, domain size, in this order. Its own claims about inputs and outputs are not looked at."""
    value, keys = F.try_parse_json(raw), F.json_object_keys(raw)
    get = lambda f, kind="string": F.try_variant_get(value, f"$.{f}", kind)
    lacking = F.array_except(F.array(*map(F.lit, PROPOSAL)), keys)
    alphabet, least, most = F.array_join(F.coalesce(F.from_json(F.get_json_object(raw, "$.input_alphabet"), "array<string>"), F.array(get("input_alphabet"))), ""), get("min_input_length", "int"), F.least(get("max_input_length", "int"), F.lit(256))
    letters, program = F.length(alphabet), get("program")
    size = F.aggregate(F.sequence(F.greatest(least, F.lit(0)), F.greatest(F.least(most, least + 13), least)), F.lit(0.0), lambda s, n: s + F.pow(letters, n))
    concepts = F.from_json(F.get_json_object(raw, "$.concepts"), "array<string>")
    return (
        F.when(keys.isNull() | value.isNull(), "object").when(F.size(lacking) > 0, F.concat(F.lit("missing: "), F.array_join(lacking, ", "))).when(F.coalesce(F.size(F.array_distinct(concepts)), F.lit(0)) < 2, "concepts")
        .when(F.coalesce(F.trim(get("termination_reason")), F.lit("")) == "", "termination_reason").when(F.size(F.split(program, "\n")) > MOST_LINES, "line_limit").when(F.length(program) > MOST_CHARACTERS, "character_limit")
        .when(~F.coalesce(letters.between(1, 4) & alphabet.rlike("^[\\x00-\\x7F&&[^=#()]]*$") & (least >= 0) & (most >= least), F.lit(False)), "input_domain").when(size > MOST_INPUTS, "domain_size")
    )
