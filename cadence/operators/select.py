"""Rule -> series selection: every rule's optional predicates as one join.

The rule side is tiny and broadcast; the normalised property is the equi key,
class, category and timeslice are residual predicates, so the plan stays a
hash join. Nested rules first discover their parents (distinct parent names of
the parent class), then select every series under those parents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.text import category_filter_items, norm
from cadence.sources.base import Source

SEL_RULE_COLS = ["rule_ord", "component", "rate", "kind"]


def _series_norm(source: Source, props: list[str] | None) -> DataFrame:
    s = source.series()
    if props is not None:
        # known before any join: a predicate on the series is what lets Catalyst prune the
        # fact's partitions by the series that are left
        s = s.where(norm("property").isin([norm(F.lit(p)) for p in props]))
    cols = [
        norm("property").alias("_s_prop"),
        norm("child_class").alias("_s_class"),
        norm("child_category").alias("_s_cat"),
        norm("parent_name").alias("_s_parent"),
    ]
    if "timeslice" not in source.fact_attrs:
        cols.append(norm("timeslice").alias("_s_ts"))
    # A NULL object name is not a report row: such series are dropped.
    return s.where(F.col("object").isNotNull()).select("*", *cols)


def nested_parents(source: Source, rules: DataFrame) -> DataFrame:
    """(rule_ord, parent, _np_parent) for nested rules: distinct parent names of
    series whose parent class is the rule's, restricted to its categories."""
    nr = rules.where(F.col("kind") == "nested").select(
        "rule_ord",
        norm("parent_class").alias("_np_class"),
        category_filter_items(F.col("categories")).alias("_np_cats"),
    )
    s = source.series().select(
        "parent_name", norm("parent_class").alias("_pc"), norm("parent_category").alias("_pcat")
    ).where(F.col("parent_name").isNotNull()).distinct()
    j = s.join(
        nr,
        (F.col("_pc") == F.col("_np_class"))
        & ((F.size("_np_cats") == 0) | F.array_contains(F.col("_np_cats"), F.col("_pcat"))),
        "inner",
    )
    return j.select("rule_ord", F.col("parent_name").alias("parent"), norm("parent_name").alias("_np_parent")).distinct()


def _one_timeslice(s: DataFrame) -> DataFrame:
    """Timeslices are matched by normalised name, so a name is one timeslice however it is
    spelled and numbered: its lowest id, its first spelling."""
    t = s.groupBy("_s_ts").agg(F.min("timeslice_id").alias("_ts_id"), F.min(F.trim("timeslice")).alias("_ts_name"))
    t = t.withColumnRenamed("_s_ts", "_ts_key")
    j = s.join(t, F.col("_s_ts").eqNullSafe(F.col("_ts_key")), "left")
    return j.drop("timeslice", "timeslice_id", "_ts_key").withColumnsRenamed({"_ts_id": "timeslice_id", "_ts_name": "timeslice"})


def select_series(source: Source, rules: DataFrame, kinds: set | None = None, props: list[str] | None = None) -> DataFrame:
    """rules (with predicate columns) ⋈ series -> one row per (rule, component,
    parent, series): block keys, series key columns, object and the series-side
    attributes; ``_r_ts`` is kept when the timeslice is matched on the fact side."""
    s = _series_norm(source, props)
    ts_series_side = "timeslice" not in source.fact_attrs
    key_attrs = [c for c in ("band", "timeslice_id", "timeslice") if c not in source.fact_attrs]
    # A rule that names its timeslice gives it to its cells; the others see what the series have.
    named = {
        "timeslice_id": F.when(F.col("_r_ts").isNotNull(), F.lit(0)).otherwise(F.col("timeslice_id")).cast("int"),
        "timeslice": F.coalesce(F.trim("timeslice_rule"), F.col("timeslice")),
    }
    if ts_series_side and (kinds is None or "ratings" in kinds):
        s = _one_timeslice(s)
    keep = source.key_cols + ["object"] + [named[c].alias(c) if c in named else c for c in key_attrs]

    flat = rules.where(F.col("kind") != "nested").select(
        *SEL_RULE_COLS, "_r_prop", "_r_class", "_r_cats", "_r_ts", "_r_parent", "timeslice_rule",
        F.lit(None).cast("string").alias("parent"),
    )
    # ``prepare`` collected and bounded the rules (MAX_RULES).
    flat_b = F.broadcast(flat)
    cond = (
        (s._s_prop == flat_b._r_prop)
        & (flat_b._r_class.isNull() | (s._s_class == flat_b._r_class))
        & ((F.size(flat_b._r_cats) == 0) | F.array_contains(flat_b._r_cats, s._s_cat))
        & (flat_b._r_parent.isNull() | (s._s_parent == flat_b._r_parent))
    )
    if ts_series_side:
        cond = cond & (flat_b._r_ts.isNull() | (s._s_ts == flat_b._r_ts))
    sel_flat = s.join(flat_b, cond, "inner").select(*SEL_RULE_COLS, "parent", "_r_ts", *keep)
    if kinds is not None and "nested" not in kinds:
        return sel_flat

    nested_rules = rules.where(F.col("kind") == "nested").select(*SEL_RULE_COLS, "_r_prop", "_r_ts", "timeslice_rule")
    np_ = nested_parents(source, rules)
    nr = nested_rules.join(np_, "rule_ord", "inner")
    cond_n = (s._s_prop == nr._r_prop) & (s._s_parent == nr._np_parent)
    if ts_series_side:
        cond_n = cond_n & (nr._r_ts.isNull() | (s._s_ts == nr._r_ts))
    sel_nested = s.join(nr, cond_n, "inner").select(*SEL_RULE_COLS, "parent", "_r_ts", *keep)
    return sel_flat.unionByName(sel_nested)
