"""Strict JSON lines: blank lines, wrong types and unknown fields are errors; output is compact and keeps nulls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

CASE = StructType().add("input", StringType()).add("output", StringType())
TASK = StructType().add("id", StringType()).add("description", StringType()).add("public_tests", ArrayType(CASE))


def problems_of(raw: Column, schema: StructType) -> Column:
    """What is wrong with a line, or null: blank, not an object, unknown or missing fields, or values of a wrong type."""
    names = F.array(*(F.lit(f.name) for f in schema.fields))
    keys = F.json_object_keys(raw)
    parsed = F.from_json(raw, schema, {"mode": "PERMISSIVE"})
    given = reduce(lambda a, f: a | (F.get_json_object(raw, f"$.{f.name}").isNotNull() & parsed[f.name].isNull()), schema.fields, F.lit(False))
    return (
        F.when(F.trim(raw) == "", "blank line").when(keys.isNull(), "not a JSON object").when(F.size(F.array_except(keys, names)) > 0, "unknown field")
        .when(F.size(F.array_except(names, keys)) > 0, "missing field").when(given, "wrong type")
    )


def read_jsonl(spark: SparkSession, path: str, schema: StructType, strict: bool = True, numbered: bool = False) -> DataFrame:
    """The records of files of JSON lines, with 'error' and 'file'. strict: an action on rows with an error fails, naming it.

    numbered: with 'line' as well, from 1, which an error then names; a file is read as a whole for that.
    """
    if numbered:
        whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("line", "raw"))
        lines = whole.withColumn("line", F.col("line") + 1)
    else:
        lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw"))
    place = [c for c in ("file", "line") if c in lines.columns]
    rows = lines.select("raw", *place, problems_of(F.col("raw"), schema).alias("error"), F.from_json("raw", schema).alias("r"))
    if not strict:
        return rows.select("r.*", "error", "raw", *place)
    where = F.concat_ws(":", *place)
    checked = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(where, F.lit(": "), F.col("error"), F.lit(": "), F.col("raw"))).cast(schema)).otherwise(F.col("r"))
    return rows.select(checked.alias("r")).select("r.*")


def as_json(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """value: each row as compact JSON, beside the columns of by, which aren't in it; floats that JSON doesn't have are
    errors."""
    by = by or []
    rest = [f for f in df.schema.fields if f.name not in by]
    doubles = [df[f.name] for f in rest if f.dataType.typeName() in ("double", "float")]
    bad = reduce(lambda a, c: a | F.isnan(c) | (F.abs(c) == float("inf")), doubles, F.lit(False))
    line = F.to_json(F.struct(*(df[f.name] for f in rest)), {"ignoreNullFields": "false"})
    return df.select(*(df[c] for c in by), F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit("a number that JSON doesn't have"))).otherwise(line).alias("value"))


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists", by: str | None = None) -> None:
    """Files of JSON lines, in a folder for each value of by if given."""
    writer = as_json(df, [by] if by else []).write.mode(mode)
    (writer.partitionBy(by) if by else writer).text(path)


def public_view(records: DataFrame) -> DataFrame:
    """What may be published of a record: an allow-list."""
    return records.select("id", "description", "public_tests")


def prompt(records: DataFrame, language: str) -> DataFrame:
    """id and a prompt from description and public tests alone."""
    cases = F.array_join(F.transform("public_tests", lambda t: F.to_json(t)), "\n")
    return records.select("id", F.concat_ws("\n\n", F.lit(language), F.col("description"), cases).alias("prompt"))
