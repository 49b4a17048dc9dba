"""Raw CSV with a rejects table: malformed lines are set aside, with a budget, instead of failing the load.

One pass over the lines parses, types and judges them and writes the outcome once; good rows
and rejects are two views of that, so good + rejected = lines.
"""
from __future__ import annotations

from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.session import scratch_path
from shelfcast.sources.files import csv_header, schema_from_header

HEADER = "header"
OWN = ["_file", "_line", "_reason"]


class RejectBudgetError(ValueError):
    pass


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _judged(lines: DataFrame, schema: T.StructType, header: str, tokens: list[str]) -> DataFrame:
    """The typed columns of each line, with its file, and reason and text if it is no good row."""
    names = [f.name for f in schema.fields]
    as_text = ", ".join(f"`{n}` string" for n in names) + ", `_shape` string"
    parsed = F.from_csv("value", as_text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_shape", "escape": '"'})
    df = lines.select("value", "file", parsed.alias("p")).select("value", "file", "p.*")
    missing = ", ".join(map(_literal, ["", *tokens]))
    # columns of one type are one array, so that thousands of day columns plan as one expression
    kinds = {t: [f.name for f in fs] for t, fs in groupby(sorted(schema.fields, key=lambda f: f.dataType.simpleString()),
                                                          key=lambda f: f.dataType.simpleString())}
    at, arrays, bad = {}, [], []
    for k, (kind, cols) in enumerate(kinds.items()):
        text = f"transform(array({', '.join(f'`{c}`' for c in cols)}), x -> CASE WHEN x NOT IN ({missing}) THEN x END)"
        arrays.append(f"{text} AS _t{k}")
        at.update({c: f"try_cast(get(_t{k}, {i}) AS {kind})" for i, c in enumerate(cols)})
        if kind != "string":
            named = ", ".join(map(_literal, cols))
            bad.append(f"filter(zip_with(array({named}), _t{k}, (n, t) -> CASE WHEN t IS NOT NULL AND try_cast(t AS {kind}) IS NULL "
                       "THEN n END), n -> n IS NOT NULL)")
    fields = r"""size(split(regexp_replace(value, '"([^"]|"")*"', ''), ','))"""
    wrong = f"array_join(concat({', '.join(bad)}), ' ')" if bad else "''"
    df = df.selectExpr("value", "file", "_shape", *arrays)
    reason = (f"CASE WHEN value = {_literal(header)} THEN '{HEADER}' WHEN _shape IS NOT NULL OR {fields} <> {len(names)} "
              f"THEN concat({fields}, ' fields, not {len(names)}') WHEN {wrong} <> '' THEN concat('no value of its type: ', {wrong}) END")
    return df.selectExpr(*[f"{at[n]} AS `{n}`" for n in names], "file AS _file", f"{reason} AS _reason", "value").selectExpr(
        *[f"`{n}`" for n in names], "_file", "CASE WHEN _reason IS NOT NULL THEN value END AS _line", "_reason")


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType | None = None, null_tokens: list[str] | None = None,
                      max_rejects: int = 0) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects: file, line, reason) of a headed CSV file or folder of them.

    A line is rejected if it has another number of fields than the header or a text where its column's
    type has no such value (``null_tokens`` and empty fields are null).  More than ``max_rejects``
    raise ``RejectBudgetError``, a file without the header ``ValueError``.  Blank lines are skipped; a record is
    one line."""
    schema = schema or schema_from_header(csv_header(spark, path))
    first = spark.read.text(path).limit(1).collect()
    header = first[0][0] if first else ""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where("trim(value) <> ''")
    stage = scratch_path(spark, "quarantine")
    judged = _judged(lines, schema, header, [t for t in null_tokens or [] if t != ""])
    judged.write.parquet(stage)
    held = spark.read.schema(judged.schema).parquet(stage)
    per_file = held.groupBy("_file").agg(F.count_if(F.col("_reason") == HEADER).alias("headers"),
                                         F.count_if(F.col("_reason") != HEADER).alias("rejects"))
    bare, rejects = per_file.agg(F.min(F.when(F.col("headers") == 0, F.col("_file"))), F.sum("rejects")).first()
    if bare:
        raise ValueError(f"{bare} doesn't have the header {header[:200]}")
    if (rejects or 0) > max_rejects:
        some = held.where(F.col("_reason") != HEADER).limit(3).collect()
        raise RejectBudgetError(f"{rejects} lines rejected, {max_rejects} allowed: "
                                + "; ".join(f"{r['_reason']} in {r['_line'][:80]!r}" for r in some))
    return held.where("_reason IS NULL").drop(*OWN), held.where(F.col("_reason") != HEADER).select(
        F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_reason").alias("reason"))
