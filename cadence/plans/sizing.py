"""Rule tables as local relations, and lineage cuts.

A rule table is configuration: it is collected once, because the driver branches on it. Joins
on every other table are left to Catalyst and AQE, which go by real sizes.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_frame(spark: SparkSession, rows, schema) -> DataFrame:
    """Rows of the driver as a local relation, handed over by Arrow: Catalyst knows its
    size, and reading it needs no Python worker."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = [tuple(r) for r in rows]
    kinds = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kinds)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=kinds), schema)


def localize(df: DataFrame, max_rows: int, what: str) -> tuple[DataFrame, list]:
    """Collect a rule table once and rebuild it as a local relation: later plans read it
    without recomputing its lineage, and the driver can branch on its rows. A table past
    the bound is an error that states its whole count."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: {df.count()} rows, more than {max_rows}; not a rule table")
    return local_frame(df.sparkSession, rows, df.schema), rows


#: Spark's setting that a query's shuffle files go when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Unless it is false, a join on a place and more keys shuffles sides again that were both dealt by the place.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def cut(df: DataFrame, free: bool = False, placed: bool = False) -> DataFrame:
    """Cut lineage after an expensive, report-sized result: write it as a
    Parquet table in the session's shared checkpoint folder and read it back.
    The result is computed once; later branches of the plan read the small
    table instead of re-running the fact scan, and a lost executor does not
    force that scan again. With ``free`` the write's shuffle files, which nothing reads
    any more, are removed as soon as the table is whole. With ``placed`` sides that are
    dealt by place are joined as they lie."""
    import uuid

    from cadence.session import checkpoint_dir

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    wanted = ({FREE_SHUFFLES: "true"} if free else {}) | ({ALL_KEYS: "false"} if placed else {})
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        df.write.mode("overwrite").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)
