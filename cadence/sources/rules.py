"""Rule tables: blueprint (standard and ratings), category groups, unit
conversions and the asset-name map, loaded into typed DataFrames.

The workbook itself is not read here (a single-machine file format); rules
arrive as tables in the schemas of :mod:`cadence.schemas`, from Parquet, CSV,
JSON or Python rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions.text import (
    DEFAULT_TIMESLICE,
    blank_to_null,
    category_filter_items,
    category_list,
    summary_label,
)
from cadence.plans.sizing import local_frame, localize

# Rule patterns.
PATTERN_MONTHLY = "monthly"
PATTERN_DAILY = "daily"
PATTERN_SUMMARY = "monthly-summary"
# Fixed value: the section whose rules are built as stacked fuel components.
FUEL_HEADER = "( 3 ) Thermal Unit Fuel Use (MBTU)"
# The stacked fuel block's rows in order (label, property);
# rows without a property are always zero.
FUEL_COMPONENTS = [
    ("        (Primary)", "Fuel Offtake"),
    ("        (Secondary)", None),
    ("        (Startup)", "Start Fuel Offtake"),
    ("        (Topping)", None),
]

# Rule and unit tables are configuration and are collected; the name map is not.
MAX_RULES = 100_000
MAX_UNITS = 100_000

@dataclass
class RuleSet:
    """Typed rule tables."""

    standard: DataFrame | None
    ratings: DataFrame | None
    groups: DataFrame
    units: DataFrame
    names: DataFrame | None
    components: list | None = None  # stacked rows: (label, property[, group])
    emissions: DataFrame | None = None
    fuel_header: str = FUEL_HEADER


def rows_frame(spark: SparkSession, rows, schema: T.StructType) -> DataFrame:
    return local_frame(spark, rows, schema)


def groups_frame(groups: DataFrame) -> DataFrame:
    """(Class, Group) -> category array, stripped; blank list -> empty array."""
    return groups.select(
        F.trim("Class").alias("g_class"),
        F.trim("Group").alias("g_group"),
        category_list("Assets").alias("categories"),
    )


def units_frame(units: DataFrame) -> DataFrame:
    return units.select(
        F.trim("UnitFrom").alias("UnitFrom"),
        F.trim("UnitTo").alias("UnitTo"),
        F.col("ConversionRate").cast("double").alias("ConversionRate"),
        *([F.col("_u_ord")] if "_u_ord" in units.columns else []),
    )


def names_frame(names: DataFrame) -> DataFrame:
    """The last row per source name wins (a dict built from the rows)."""
    return names.groupBy("source_name").agg(
        F.max_by("report_name", "map_ord").alias("report_name")
    )


def _with_categories(rules: DataFrame, groups: DataFrame, class_col) -> DataFrame:
    g = groups_frame(groups)
    r = rules.join(
        g, (class_col == g.g_class) & (F.trim(F.col("Group")) == g.g_group), "left"
    ).drop("g_class", "g_group")
    return r.withColumn("categories", F.coalesce("categories", F.array().cast("array<string>")))


def standard_rules(rules: DataFrame, groups: DataFrame, fuel_header: str = FUEL_HEADER) -> DataFrame:
    """Blueprint_std -> one row per rule with its kind and normalised filters.

    Dispatch order: the fuel header -> 'stacked'; pattern daily -> 'daily';
    dotted class -> 'nested'; else 'flat'.
    """
    cls = F.trim("Class")
    pattern = F.lower(F.trim(F.coalesce(F.col("Pattern"), F.lit(PATTERN_MONTHLY))))
    pattern = F.when(pattern == "", F.lit(PATTERN_MONTHLY)).otherwise(pattern)
    dotted = cls.contains(".")
    parent_cls = F.split(cls, r"\.").getItem(0)
    kind = (
        F.when(F.col("Header") == F.lit(fuel_header), F.lit("stacked"))
        .when(pattern == PATTERN_DAILY, F.lit("daily"))
        .when(dotted, F.lit("nested"))
        .otherwise(F.lit("flat"))
    )
    r = rules.select(
        F.col("rule_ord").cast("int").alias("rule_ord"),
        F.col("Header").alias("header"),
        cls.alias("class"),
        F.col("Group"),
        F.trim("Property").alias("property"),
        pattern.alias("pattern"),
        F.col("Rate").cast("boolean").alias("rate"),
        blank_to_null("Unit").alias("unit_to"),
        kind.alias("kind"),
        F.when(dotted, parent_cls).alias("parent_class"),
    )
    lookup_cls = F.when(F.col("parent_class").isNotNull(), F.col("parent_class")).otherwise(F.col("class"))
    r = _with_categories(r, groups, lookup_cls)
    return r.select(
        "rule_ord", "header", "class", "property", "pattern",
        (F.col("rate") & (F.col("kind") != "daily")).alias("rate"), "unit_to", "kind",
        "parent_class", "categories",
        (F.col("pattern") == PATTERN_SUMMARY).alias("summary"),
        F.lit(None).cast("string").alias("alias"),
        F.lit(DEFAULT_TIMESLICE).alias("timeslice_rule"),
        F.lit(None).cast("string").alias("parent_rule"),
        # A nested block's rows come from flat blocks built without class or
        # categories, so its summary label reads None-all-{property}-Total.
        F.when(F.col("kind") == "nested", F.concat(F.lit("None-all-"), F.col("property"), F.lit("-Total")))
        .otherwise(summary_label(F.col("class"), F.col("categories"), F.col("property"))).alias("summary_text"),
    )


def ratings_rules(rules: DataFrame, groups: DataFrame) -> DataFrame:
    """Blueprint_rat -> one 'ratings' rule per row, matched in every timeslice.
    Always summed; class and group stripped."""
    r = rules.select(
        F.col("rule_ord").cast("int").alias("rule_ord"),
        F.lit(None).cast("string").alias("header"),
        F.trim("Class").alias("class"),
        F.col("Group"),
        F.trim("Property").alias("property"),
        F.lit(PATTERN_MONTHLY).alias("pattern"),
        F.lit(False).alias("rate"),
        blank_to_null("Unit").alias("unit_to"),
        F.lit("ratings").alias("kind"),
        F.lit(None).cast("string").alias("parent_class"),
        F.col("Alias").alias("alias"),
    )
    r = _with_categories(r, groups, F.col("class"))
    return r.select(
        "rule_ord", "header", "class", "property", "pattern", "rate", "unit_to", "kind",
        "parent_class", "categories",
        F.lit(False).alias("summary"),
        "alias",
        F.lit(None).cast("string").alias("timeslice_rule"),
        F.lit(None).cast("string").alias("parent_rule"),
        F.lit(None).cast("string").alias("summary_text"),
    )


# Fixed value: the property an emission block reads.
EMISSION_PROPERTY = "Production"

EMISSIONS = T.StructType([
    T.StructField("rule_ord", T.IntegerType(), False),
    T.StructField("Header", T.StringType()),
    T.StructField("Class", T.StringType()),
    T.StructField("Gas", T.StringType()),
    T.StructField("Pattern", T.StringType()),
    T.StructField("Unit", T.StringType()),
    T.StructField("Property", T.StringType()),
])


def emission_rules(rules: DataFrame) -> DataFrame:
    """Emission blocks: the series whose parent object is the gas, property
    'Production' unless given, summed, with a Total row; a monthly-summary rule
    keeps the Total row labelled ``{class}-{gas}-Total``."""
    pattern = F.lower(F.trim(F.coalesce(F.col("Pattern"), F.lit(PATTERN_MONTHLY))))
    prop = F.coalesce(blank_to_null("Property"), F.lit(EMISSION_PROPERTY))
    return rules.select(
        F.col("rule_ord").cast("int").alias("rule_ord"),
        F.col("Header").alias("header"),
        F.trim("Class").alias("class"),
        prop.alias("property"),
        pattern.alias("pattern"),
        F.lit(False).alias("rate"),
        blank_to_null("Unit").alias("unit_to"),
        F.lit("flat").alias("kind"),
        F.lit(None).cast("string").alias("parent_class"),
        F.array().cast("array<string>").alias("categories"),
        (pattern == PATTERN_SUMMARY).alias("summary"),
        F.lit(None).cast("string").alias("alias"),
        F.lit(DEFAULT_TIMESLICE).alias("timeslice_rule"),
        F.trim("Gas").alias("parent_rule"),
        F.concat_ws("-", F.trim("Class"), F.trim("Gas"), F.lit("Total")).alias("summary_text"),
    )


def selection_rules(rules: DataFrame, groups: DataFrame, components=None) -> DataFrame:
    """One row per series selection. A stacked rule expands to one row per
    component that has a property (a generator over the fixed component list,
    not a join); a component may name its own group, else it uses the rule's."""
    comps = [(i, c[1], c[2] if len(c) > 2 else None) for i, c in enumerate(components or FUEL_COMPONENTS) if c[1]]
    base = rules.where(F.col("kind") != "stacked").withColumn("component", F.lit(None).cast("int"))
    if not comps:
        return base
    arr = F.array(*[
        F.struct(F.lit(i).alias("c_ord"), F.lit(p).alias("c_prop"), F.lit(g).cast("string").alias("c_group"))
        for i, p, g in comps
    ])
    st = rules.where(F.col("kind") == "stacked").select("*", F.explode(arr).alias("_c"))
    g = groups_frame(groups).withColumnRenamed("categories", "_g_cats")
    st = st.join(g, (F.col("class") == g.g_class) & (F.col("_c.c_group") == g.g_group), "left")
    st = st.select(
        *[c for c in rules.columns if c not in ("property", "categories")],
        F.col("_c.c_prop").alias("property"),
        F.when(F.col("_c.c_group").isNotNull(), F.coalesce("_g_cats", F.array().cast("array<string>")))
        .otherwise(F.col("categories")).alias("categories"),
        F.col("_c.c_ord").alias("component"),
    )
    return base.unionByName(st)


@dataclass
class Prepared:
    """A rule table after normalisation, collected once (it is config) and
    rebuilt as local relations; the driver branches on ``sel_rows``."""

    rules: DataFrame
    sel: DataFrame
    sel_rows: list
    names: DataFrame | None
    units: DataFrame | None

    def kinds(self) -> set:
        return {r["kind"] for r in self.sel_rows}

    def properties(self) -> list:
        return sorted({r["property"] for r in self.sel_rows if r["property"] is not None})

    def needs_timeslices(self) -> bool:
        return any(r["_r_ts"] is None or r["_r_ts"] != "all periods" for r in self.sel_rows)

    def only(self, kinds) -> "Prepared":
        keep = [r for r in self.sel_rows if r["kind"] in kinds]
        sel = local_frame(self.sel.sparkSession, keep, self.sel.schema)
        return Prepared(self.rules, sel, keep, self.names, self.units)


def prepare(rs: RuleSet, which: str = "standard", rule_ords=None) -> Prepared:
    """Normalise one rule table with Spark expressions and collect it once
    (bounded: it is config). The rule-level frame is rebuilt from the same
    rows, so no second action runs."""
    if which == "standard":
        rules = standard_rules(rs.standard, rs.groups, rs.fuel_header)
    elif which == "emissions":
        rules = emission_rules(rs.emissions)
    else:
        rules = ratings_rules(rs.ratings, rs.groups)
    if rule_ords is not None:
        rules = rules.where(F.col("rule_ord").isin(list(rule_ords)))
    rule_cols = rules.columns
    sel, sel_rows = localize(predicate_columns(selection_rules(rules, rs.groups, rs.components)), MAX_RULES,
                             "selection rules")
    spark = sel.sparkSession
    seen, rule_rows = set(), []
    for r in sel_rows:
        if r["rule_ord"] in seen:
            continue
        seen.add(r["rule_ord"])
        rule_rows.append(r)
    # A stacked rule appears once per component; its rule row then carries the
    # first component's property, which the layout does not read.
    rules_local = local_frame(spark, [tuple(r[c] for c in rule_cols) for r in rule_rows], rules.schema)
    bad = [r["rule_ord"] for r in rule_rows if r["kind"] == "stacked" and r["summary"]]
    if bad:
        raise ValueError(f"stacked fuel rules cannot use monthly-summary: rules {bad}")
    names = names_frame(rs.names) if rs.names is not None else None
    units = None
    if rs.units is not None:
        # file order, once: the first matching row wins
        rows = localize(rs.units, MAX_UNITS, "unit conversion")[1]
        schema = T.StructType(rs.units.schema.fields + [T.StructField("_u_ord", T.LongType())])
        units = units_frame(local_frame(spark, [(*r, i) for i, r in enumerate(rows)], schema))
    return Prepared(rules_local, sel, sel_rows, names, units)


def predicate_columns(rules: DataFrame) -> DataFrame:
    """Normalised rule-side predicate columns (NULL = no filter)."""
    k = F.col("kind")
    cls_filter = F.when(k.isin("flat", "stacked", "daily", "ratings"), F.lower(blank_to_null("class")))
    cat_filter = F.when(k.isin("flat", "stacked", "ratings"), category_filter_items(F.col("categories"))).otherwise(
        F.array().cast("array<string>")
    )
    return rules.select(
        "*",
        F.lower(F.trim("property")).alias("_r_prop"),
        cls_filter.alias("_r_class"),
        cat_filter.alias("_r_cats"),
        F.lower(F.trim("timeslice_rule")).alias("_r_ts"),
        F.lower(blank_to_null("parent_rule")).alias("_r_parent"),
    )


# ---------------------------------------------------------------------------
# Rule tables from files
# ---------------------------------------------------------------------------
# The rule tables' expected columns (after stripping and
# title-casing the headers) and their file names.
STD_COLUMNS = ["Header", "Class", "Group", "Property", "Pattern", "Rate", "Unit"]
RAT_COLUMNS = ["Class", "Group", "Property", "Alias", "Unit"]
RULE_FILES = {
    "standard": "Blueprint_std",
    "ratings": "Blueprint_rat",
    "groups": "Groups",
    "units": "UnitConversion",
    "names": "Generator_name_map",
    "emissions": "Emissions",
}
# The name map's source and target columns, unless the caller names others.
NAME_MAP_COLUMNS = ("source_name", "report_name")
TRUE_TEXT = ("true", "yes", "y", "1")
FALSE_TEXT = ("false", "no", "n", "0")


def normalise_headers(df: DataFrame, expected: list[str]) -> DataFrame:
    """Headers stripped and title-cased (Python's rule, on the driver: metadata
    only); expected columns that are missing are added as ''."""
    renamed = df.toDF(*[str(c).strip().title() for c in df.columns])
    for c in expected:
        if c not in renamed.columns:
            renamed = renamed.withColumn(c, F.lit(""))
    return renamed


def with_row_order(df: DataFrame) -> DataFrame:
    """``rule_ord``: the row's position in the file (ids grow with file order)."""
    # A rule table is config (bounded), so one ordered window over it is fine.
    return df.withColumn("rule_ord", F.row_number().over(Window.orderBy(F.monotonically_increasing_id())).cast("int"))


def strict_flag(c) -> "F.Column":
    t = F.lower(F.trim(F.col(c).cast("string")))
    return F.when(t.isin(*TRUE_TEXT), F.lit(True)).when(t.isin(*FALSE_TEXT), F.lit(False))


def load_rules(spark: SparkSession, path: str, fmt: str = "csv", name_columns=NAME_MAP_COLUMNS) -> RuleSet:
    """Rule tables from ``path`` (one file or folder per table, named as in
    :data:`RULE_FILES`). A blank or unreadable Rate flag is an error naming the
    row; the name map keeps the last row per source name. A blueprint may be
    left out, but not both, and the groups are needed; a table that is there
    and cannot be read is an error."""
    from pyspark.errors import AnalysisException

    def read(name):
        r = spark.read.format(fmt)
        if fmt == "csv":
            r = r.option("header", True)
        for p in (f"{path.rstrip('/')}/{name}.{fmt}", f"{path.rstrip('/')}/{name}"):
            try:
                return r.load(p)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        return None

    std = read(RULE_FILES["standard"])
    if std is not None:
        std = with_row_order(normalise_headers(std, STD_COLUMNS))
        std = std.select("rule_ord", *[F.col(c).cast("string").alias(c) for c in STD_COLUMNS if c != "Rate"],
                         strict_flag("Rate").alias("Rate"), F.col("Rate").cast("string").alias("_rate_text"))
        bad = std.where(F.col("Rate").isNull()).select("rule_ord", "_rate_text").collect()
        if bad:
            raise ValueError(f"Blueprint_std: Rate must be true/false, rows {[(r[0], r[1]) for r in bad]}")
        std = std.select("rule_ord", "Header", "Class", "Group", "Property", "Pattern", "Rate", "Unit")
    rat = read(RULE_FILES["ratings"])
    if rat is not None:
        rat = with_row_order(normalise_headers(rat, RAT_COLUMNS))
        rat = rat.select("rule_ord", *[F.col(c).cast("string").alias(c) for c in RAT_COLUMNS])
    if std is None and rat is None:
        raise FileNotFoundError(f"{path}: neither {RULE_FILES['standard']} nor {RULE_FILES['ratings']}")
    groups = read(RULE_FILES["groups"])
    if groups is None:
        raise FileNotFoundError(f"{path}: no {RULE_FILES['groups']}")
    groups = groups.select(*[F.col(c).cast("string").alias(c) for c in ("Class", "Group", "Assets")])
    units = read(RULE_FILES["units"])
    if units is not None:
        units = units.select(F.col("UnitFrom").cast("string").alias("UnitFrom"),
                             F.col("UnitTo").cast("string").alias("UnitTo"),
                             F.col("ConversionRate").cast("double").alias("ConversionRate"))
    names = read(RULE_FILES["names"])
    if names is not None:
        src, dst = name_columns
        # ids grow with the file's order: enough for "the last row wins", without a window
        names = names.select(F.monotonically_increasing_id().alias("map_ord"),
                             F.col(src).cast("string").alias("source_name"),
                             F.col(dst).cast("string").alias("report_name"))
    emissions = read(RULE_FILES["emissions"])
    if emissions is not None:
        cols = ["Header", "Class", "Gas", "Pattern", "Unit", "Property"]
        emissions = with_row_order(normalise_headers(emissions, cols)).select(
            "rule_ord", *[F.col(c).cast("string").alias(c) for c in cols])
    return RuleSet(standard=std, ratings=rat, groups=groups, units=units, names=names, emissions=emissions)
