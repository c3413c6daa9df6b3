"""Files of programs, tasks and data sets: program texts, task folders, JSON documents, a data set's layout, and its report.

Paths may be in any file system that Spark knows. What is small by nature (one document, one report) goes through the
driver; records stay DataFrames.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphflow.sources.jsonl import CASE, as_json

#: Marks a folder that this module has made and may overwrite.
OWNED = "_glyphflow_artifacts"


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def put_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def get_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    rows = spark.read.text(path, wholetext=True).take(1)
    return rows[0][0] if rows else ""


def put_document(spark: SparkSession, path: str, document: Any) -> None:
    """A JSON document: two spaces, sorted keys, a line feed at the end; numbers that JSON doesn't have are errors."""
    put_text(spark, path, json.dumps(document, ensure_ascii=False, indent=2, sort_keys=True, allow_nan=False) + "\n")


def get_document(spark: SparkSession, path: str) -> Any:
    return json.loads(get_text(spark, path))


def programs(spark: SparkSession, path: str, files: str = "solution.*") -> DataFrame:
    """task (the folder's name), file and program of all program files below a path, by a pattern of their names."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", files).text(path, wholetext=True)
    rows = rows.select("value", F.col("_metadata.file_path").alias("file"))
    return rows.select(F.element_at(F.split("file", "/"), -2).alias("task"), F.element_at(F.split("file", "/"), -1).alias("file"), F.regexp_replace("value", "\n$", "").alias("program"))


def golden_cases(spark: SparkSession, root: str) -> DataFrame:
    """task, part ('pretest' or 'full'), line, input and output of the test files in task folders."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "testcase_*.jsonl").text(root, wholetext=True)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("line", "raw"))
    case = F.from_json("raw", CASE)
    return rows.select(F.element_at(F.split("file", "/"), -2).alias("task"), F.regexp_extract("file", r"testcase_(\w+)\.jsonl$", 1).alias("part"), (F.col("line") + 1).alias("line"), case["input"].alias("input"), case["output"].alias("output"))


def tasks(spark: SparkSession, root: str) -> DataFrame:
    """task, title, constraints (JSON), program, public_tests (the pretest) and hidden_tests (the full set without its inputs,
    each input once, the first that says it) of the task folders below root."""
    meta = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "task.jsonl").text(root)
    meta = meta.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("task"), F.get_json_object("value", "$.title").alias("title"), F.get_json_object("value", "$.constraints").alias("constraints"))
    cases = golden_cases(spark, root).withColumn("order", F.struct((F.col("part") != "pretest").alias("late"), "line"))
    first = cases.groupBy("task", "input").agg(F.min(F.struct("order", "output")).alias("x"))
    item = F.struct(F.col("x.order").alias("order"), F.col("input"), F.col("x.output").alias("output"))
    plain = lambda c: F.transform(F.array_sort(c), lambda x: F.struct(x["input"].alias("input"), x["output"].alias("output")))
    lists = first.groupBy("task").agg(*(plain(F.collect_list(F.when(F.col("x.order.late") == late, item))).alias(name) for name, late in (("public_tests", False), ("hidden_tests", True))))
    return meta.join(lists, "task", "left").join(programs(spark, root).select("task", "program"), "task", "left")


def write_artifacts(records: DataFrame, auxiliary: DataFrame, root: str, statistics: dict | None = None) -> None:
    """A data set's layout below root: private/split=..., public/split=... (an allow-list), auxiliary/split=.../type=..., and
    statistics.json with REPORT.md if there are statistics.

    records: id, split, description, public_tests and any others; auxiliary: split, type and any others. An existing folder
    is replaced only if it was written by this function.
    """
    spark = records.sparkSession
    p, fs = _path(spark, root)
    marker = spark._jvm.org.apache.hadoop.fs.Path(p, OWNED)
    if fs.exists(p):
        if not fs.exists(marker):
            raise FileExistsError(f"{root} exists and isn't ours")
        fs.delete(p, True)
    put_text(spark, f"{root}/{OWNED}", "")
    _by_split(records, f"{root}/private", ["split"])
    _by_split(records.select("split", "id", "description", "public_tests"), f"{root}/public", ["split"])
    _by_split(auxiliary, f"{root}/auxiliary", ["split", "type"])
    if statistics is not None:
        put_document(spark, f"{root}/statistics.json", statistics)
        put_text(spark, f"{root}/REPORT.md", report("Data set", statistics))


def _by_split(df: DataFrame, path: str, by: list[str]) -> None:
    as_json(df, by).write.partitionBy(*by).text(path)


def read_artifacts(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The private records of a data set with their split; schema: DDL of a record's fields."""
    lines = spark.read.text(f"{root}/private")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r"), F.col("split").cast("string")).select("r.*", "split")


def report(title: str, sections: dict[str, Any]) -> str:
    """Markdown: a section for each entry, with a table for mappings and lists of rows, and the value itself for others."""
    cell = lambda x: json.dumps(x, ensure_ascii=False, sort_keys=True) if isinstance(x, (dict, list, tuple)) else str(x).replace("|", "\\|").replace("\n", " ")
    line = lambda xs: "| " + " | ".join(map(cell, xs)) + " |"
    out = [f"# {title}"]
    for name, value in sections.items():
        out += ["", f"## {name}", ""]
        if isinstance(value, dict):
            out += [line(["Key", "Value"]), line(["---", "---"]), *(line([k, value[k]]) for k in value)]
        elif isinstance(value, list) and value and all(isinstance(x, dict) for x in value):
            columns = list(dict.fromkeys(k for x in value for k in x))
            out += [line(columns), line(["---"] * len(columns)), *(line([x.get(c, "") for c in columns]) for x in value)]
        else:
            out.append(cell(value))
    return "\n".join(out) + "\n"


def collected(aggregates: dict[str, DataFrame]) -> dict[str, Any]:
    """Aggregates of a few rows as plain values, for a report: one row as a mapping, more as a list."""
    out: dict[str, Any] = {}
    for name, df in aggregates.items():
        rows = [r.asDict(True) for r in df.limit(1000).collect()]  # a report's tables
        out[name] = rows[0] if len(rows) == 1 else rows
    return out


def checked(df: DataFrame, problem: Callable[..., Any], column: str = "raw") -> DataFrame:
    """df, of which an action fails at the first row that the predicate (a Column of an array of names) finds fault with."""
    wrong = problem(F.col(column))
    said = F.raise_error(F.concat(F.array_join(wrong, ", "), F.lit(": "), F.col(column))).cast("string")
    return df.withColumn(column, F.when(F.size(wrong) > 0, said).otherwise(F.col(column)))
