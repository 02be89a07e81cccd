"""What users of the engine add to: finding codes, repairs of pages, aggregate and table functions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tessella.operators import markdown as M


@dataclass(frozen=True)
class Code:
    """A finding: its severity (error, warning or note) and the stage that finds it are the code's, not a row's."""

    code: str
    severity: str
    stage: str
    obligation: str = ""


CODES: dict[str, Code] = {}


def code(name: str, severity: str, stage: str, obligation: str = "") -> Code:
    """Register a finding code. Each name once."""
    if severity not in ("error", "warning", "note"):
        raise ValueError(f"{name}: no severity {severity!r}")
    if name in CODES:
        raise ValueError(f"two codes are called {name}")
    CODES[name] = Code(name, severity, stage, obligation)
    return CODES[name]


def graded(findings: DataFrame, codes: dict[str, Code] | None = None) -> DataFrame:
    """Findings with their code's severity and stage; an unknown code is an error of stage unknown. findings: code, ...

    The codes are a register in source text, so the side that is broadcast is a few hundred rows.
    """
    rows = [(c.code, c.severity, c.stage) for c in (CODES if codes is None else codes).values()]
    known = findings.sparkSession.createDataFrame(rows, "code string, severity string, stage string")
    found = findings.drop("severity", "stage").join(F.broadcast(known), "code", "left")
    return found.withColumn("severity", F.coalesce("severity", F.lit("error"))).withColumn("stage", F.coalesce("stage", F.lit("unknown")))


def checked(checks: dict[str, DataFrame], codes: dict[str, Code] | None = None) -> DataFrame:
    """A validation run: the rows that each check returns (path, message), as graded findings."""
    rows = [df.select(F.lit(name).alias("code"), F.col("path").cast("string").alias("path"), F.col("message").cast("string").alias("message")) for name, df in checks.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return graded(out, codes)


@dataclass(frozen=True)
class Repair:
    """detect counts what is wrong in a page; fix returns the page without it. Both leave sound pages alone."""

    name: str
    title: str
    detect: Callable[[str], int]
    fix: Callable[[str], str]


REPAIRS: dict[str, Repair] = {}


def repair(name: str, title: str, detect: Callable[[str], int], fix: Callable[[str], str]) -> Repair:
    if name in REPAIRS:
        raise ValueError(f"two repairs are called {name}")
    REPAIRS[name] = Repair(name, title, detect, fix)
    return REPAIRS[name]


repair("R001", "Alert boxes as bold labels", lambda t: len(re.findall(r"(?m)^[ \t]*(?:(?:[-*+]|\d+[.)])[ \t]+)?(?:>[ \t]*)+\[![A-Za-z]+\][ \t]*\r?$", M.masked(t))), M.repaired)


def apply_repair(text: Column, name: str) -> Column:
    """hits and text of a page after a registered repair."""
    found = REPAIRS[name]

    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"hits": [0 if p is None else found.detect(p) for p in pages], "text": [None if p is None else found.fix(p) for p in pages]})

    return F.pandas_udf(run, T.StructType([T.StructField("hits", T.IntegerType()), T.StructField("text", T.StringType())]))(text)


class References:
    """Table function: the references of a page, for SQL as `references(text)`."""

    def eval(self, text: str) -> Iterator[tuple]:
        for r in M.references_of(text or ""):
            yield r["raw"], r["line"], r["syntax"]


@F.pandas_udf(T.LongType())
def distinct_words(texts: pd.Series) -> int:
    """Aggregate function: how many distinct words a group of short texts has."""
    return len({w for t in texts.dropna() for w in re.findall(r"[a-z0-9]+(?:['.\-_/][a-z0-9]+)*", t.lower())})


def install(spark: SparkSession) -> None:
    """Make the table and aggregate functions callable from SQL."""
    spark.udtf.register("references", F.udtf(References, returnType="raw string, line int, syntax string"))
    spark.udf.register("distinct_words", distinct_words)
