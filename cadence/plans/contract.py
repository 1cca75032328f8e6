"""Schema contract: what the tables of a source must hold, checked row by row.

A contract names a table's columns with their types, the columns that may not be null,
the predicates that values meet (nulls pass) and the key that tells rows apart. One pass
over a table counts all violations: rows are summed up by key (or as a whole, where there is
none), map-side first, and the sums once more; nothing is joined or collected.

Findings, one row for each rule of each column: (relation, column, rule, expected, actual,
n_rows, n_bad). ``present``: the table has the column, or not (1). ``type``: values that the
expected type cannot hold (fractions in a whole number, texts that are no number). ``null``:
nulls of required columns. ``domain``: values that break their predicate. ``key``: rows
beyond the first of each key.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence import schemas
from cadence.plans.sizing import local_frame
from cadence.sources.base import Source

FINDINGS = "relation string, column string, rule string, expected string, actual string, n_rows long, n_bad long"


@dataclass(frozen=True)
class Contract:
    """``columns``: DDL; ``domains``: column -> SQL predicate over the table's columns."""

    columns: str
    key: tuple = ()
    required: tuple = ()
    domains: dict = field(default_factory=dict)


def solution_contract(table: str) -> Contract:
    """The contract of a solution's table: its columns, and its key, which has no nulls."""
    key = schemas.SOLUTION_KEYS.get(table, ())
    return Contract(schemas.SOLUTION_TABLES[table], key, key)


def _misfit(name: str, have: T.DataType, want: T.DataType) -> Column:
    """Whether a value is not one of type ``want``."""
    if have == want:
        return F.lit(False)
    value = F.col(f"`{name}`")
    if not isinstance(have, (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return value.isNotNull()
    got = value.cast("string").try_cast(want) if isinstance(have, T.StringType) else value.try_cast(want)
    lost = got.isNull()
    if isinstance(have, T.FractionalType) and isinstance(want, T.IntegralType):
        lost = lost | (got.cast("double") != value.cast("double"))
    return value.isNotNull() & lost


def check_rows(df: DataFrame, relation: str, contract: Contract) -> DataFrame:
    """Findings of one table, in one pass."""
    want = T.StructType.fromDDL(contract.columns)
    have = {f.name: f.dataType for f in df.schema.fields}
    tests: list[tuple[str, str, str, str | None, Column]] = []
    for f in want.fields:
        kind = f.dataType.simpleString()
        if f.name not in have:
            tests.append((f.name, "present", kind, None, F.lit(None)))
            continue
        actual = have[f.name].simpleString()
        tests.append((f.name, "present", kind, actual, F.lit(False)))
        tests.append((f.name, "type", kind, actual, _misfit(f.name, have[f.name], f.dataType)))
        if f.name in contract.required:
            tests.append((f.name, "null", "no nulls", actual, F.col(f"`{f.name}`").isNull()))
        if f.name in contract.domains:
            tests.append((f.name, "domain", contract.domains[f.name], actual, ~F.coalesce(F.expr(contract.domains[f.name]), F.lit(True))))
    counted = [(i, bad) for i, (_, rule, _, _, bad) in enumerate(tests) if rule != "present"]
    sums = [F.sum(bad.cast("long")).alias(f"_{i}") for i, bad in counted]
    if key := tuple(k for k in contract.key if k in have):
        each = df.groupBy(*(F.col(f"`{k}`") for k in key)).agg(F.count("*").alias("_n"), *sums)
        total = each.agg(F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_again"), *(F.sum(f"_{i}").alias(f"_{i}") for i, _ in counted))
        known = tuple(contract.key) == key
        tests.append(("+".join(contract.key), "key", "unique", None, F.lit(False) if known else F.lit(None)))
    else:
        total = df.agg(F.count("*").alias("_n"), *sums).withColumn("_again", F.lit(0))

    def row(i: int, test: tuple) -> Column:
        column, rule, expected, actual, bad = test
        n = {"present": F.lit(0 if actual else 1), "key": F.col("_again")}.get(rule, F.col(f"_{i}"))
        values = [F.lit(relation), F.lit(column), F.lit(rule), F.lit(expected), F.lit(actual).cast("string"), F.coalesce("_n", F.lit(0)), F.coalesce(n, F.lit(0))]
        return F.struct(*(v.cast(f.dataType).alias(f.name) for v, f in zip(values, T.StructType.fromDDL(FINDINGS).fields)))

    return total.select(F.inline(F.array(*(row(i, t) for i, t in enumerate(tests)))))


def check_tables(tables: dict[str, DataFrame], spark: SparkSession | None = None) -> DataFrame:
    """Findings of a solution's tables by name; a table that is not there is one row."""
    out = None
    for name in schemas.SOLUTION_TABLES:
        if name in tables:
            part = check_rows(tables[name], name, solution_contract(name))
        else:
            spark = spark or next(iter(tables.values())).sparkSession
            part = local_frame(spark, [(name, None, "present", "table", None, 0, 1)], FINDINGS)
        out = part if out is None else out.unionByName(part)
    return out


def check_solution(spark: SparkSession, base: str) -> DataFrame:
    """Findings of the tables of a solution folder."""
    from pyspark.errors import AnalysisException

    tables = {}
    for name in schemas.SOLUTION_TABLES:
        try:
            tables[name] = spark.read.parquet(f"{base.rstrip('/')}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return check_tables(tables, spark)


# Canonical types of the relations that the operators read.
SERIES = {
    "object": "string", "child_name": "string", "parent_name": "string", "child_class": "string",
    "parent_class": "string", "child_category": "string", "parent_category": "string", "property": "string",
    "unit": "string", "key_id": "bigint", "band": "int", "timeslice_id": "int", "timeslice": "string",
}
OBSERVATIONS = {"period_start": "timestamp", "value": "double"}


def check_source(source: Source, domains: dict | None = None) -> DataFrame:
    """Findings of a source's series and observations; ``domains``: column -> predicate.
    An observation's key is its series, the attributes on the fact's side and its period."""
    fact = {k: v for k, v in SERIES.items() if k in source.fact_attrs}
    ddl = lambda kinds: ", ".join(f"{k} {v}" for k, v in kinds.items())
    own = lambda kinds: {k: v for k, v in (domains or {}).items() if k in kinds}
    series = {k: v for k, v in SERIES.items() if k not in fact}
    observed = {**OBSERVATIONS, **fact}
    parts = (
        check_rows(source.series(), "series", Contract(ddl(series), ("key_id",), ("object", "property", "key_id"), own(series))),
        check_rows(source.observations(), "observations", Contract(ddl(observed), (*source.key_cols, *fact, "period_start"), tuple(OBSERVATIONS), own(observed))))
    return parts[0].unionByName(parts[1])
