"""Report validation: golden vs generated report cells.

Sections are matched by title (full outer join); cells by (section, row key,
column label), where the row key is the row label plus the row's structural
keys (or, for parsed text, its row number within the section). Numbers pass when
``|gen - gold| <= atol + rtol * |gen|`` (NaN equals NaN); text cells must be
equal. Findings come per section, then per report.

Rows are first compared by digest: one aggregate over both sides gives each row's number of
cells and an order-free digest of them, and the columns of each section. Rows that agree are done
(64-bit digests: two unlike rows agree with a probability of 2**-64); only the cells of the others
are read again and joined. Where a row repeats a column label, copies that agree count one by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.plans.sizing import cut

ATOL = 1e-5
RTOL = 1e-5


def keyed(cells: DataFrame, row_keys: list[str]) -> DataFrame:
    """(section, row_key, col_label, value, text). The row key is the label plus
    the row's structural keys (rule, parent, object, band, day, component for
    report cells; the row number inside its section for parsed text), so rows
    pair up without any window: no label's cells are gathered in one task."""
    parts = [F.coalesce(F.col("row_label"), F.lit(""))] + [
        F.coalesce(F.col(c).cast("string"), F.lit("")) for c in row_keys
    ]
    row_key = F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])
    return cells.select("section", row_key.alias("row_key"), "col_label", "value", "text")


def close(gold, gen, atol: float = ATOL, rtol: float = RTOL):
    both_nan = F.isnan(gold) & F.isnan(gen)
    return both_nan | (F.abs(gen - gold) <= F.lit(atol) + F.lit(rtol) * F.abs(gen))


def diff_cells(golden: DataFrame, generated: DataFrame, atol: float = ATOL, rtol: float = RTOL) -> DataFrame:
    """Cell-level comparison: one row per cell present on either side."""
    g = golden.select("section", "row_key", "col_label", F.col("value").alias("gold"), F.col("text").alias("gold_text"))
    n = generated.select("section", "row_key", "col_label", F.col("value").alias("gen"), F.col("text").alias("gen_text"))
    # A title's cell has no column label: it pairs up like any other.
    keys = ["section", "row_key", "col_label"]
    same = F.col("g.section") == F.col("n.section")
    same = same & (F.col("g.row_key") == F.col("n.row_key")) & F.col("g.col_label").eqNullSafe(F.col("n.col_label"))
    j = g.alias("g").join(n.alias("n"), same, "full").select(*(F.coalesce(f"g.{k}", f"n.{k}").alias(k) for k in keys), "gold", "gold_text", "gen", "gen_text")
    num_ok = F.when(F.col("gold").isNull() & F.col("gen").isNull(), F.lit(True)) \
        .when(F.col("gold").isNull() | F.col("gen").isNull(), F.lit(False)) \
        .otherwise(close(F.col("gold"), F.col("gen"), atol, rtol))
    txt_ok = F.coalesce(F.col("gold_text"), F.lit("")) == F.coalesce(F.col("gen_text"), F.lit(""))
    return j.select("*", (num_ok & txt_ok).alias("ok"))


def compared(golden: DataFrame, generated: DataFrame) -> DataFrame:
    """One pass over both sides: for every (section, row_key) the number of cells and their digest
    on each side, ``same`` where both agree; and for every (section, col_label) its cells."""
    sides = golden.withColumn("_gen", F.lit(False)).unionByName(generated.withColumn("_gen", F.lit(True)))
    h = F.xxhash64("col_label", F.col("value").isNull(), "value", F.coalesce("text", F.lit("")))
    sides = sides.select("section", "row_key", "col_label", "_gen", h.alias("_h"))

    def of(gen: bool, tag: str) -> list:
        at = F.col("_gen") if gen else ~F.col("_gen")
        half = lambda part: F.sum(F.when(at, part).otherwise(0))  # noqa: E731  halves: a sum of whole hashes would overflow
        return [F.count_if(at).alias(f"n_{tag}"), F.struct(half(F.col("_h").bitwiseAND(0xFFFFFFFF)), half(F.shiftright("_h", 32))).alias(f"digest_{tag}")]

    section = F.col("section")
    out = sides.groupingSets([[section, F.col("row_key")], [section, F.col("col_label")]], section, F.col("row_key"), F.col("col_label")).agg(
        *of(False, "gold"), *of(True, "gen"), (F.grouping("row_key") == 0).alias("is_row"))
    same = (F.col("n_gold") == F.col("n_gen")) & (F.col("digest_gold") == F.col("digest_gen"))
    return out.select("section", "row_key", "col_label", "is_row", "n_gold", "n_gen", same.alias("same"))


def diff_sections(golden: DataFrame, generated: DataFrame, atol: float = ATOL, rtol: float = RTOL) -> DataFrame:
    """Per section: presence on each side, shape (rows, columns) on each side,
    cells compared, mismatches, and the verdict."""
    at = cut(compared(golden, generated))
    shown = F.col("is_row") | F.col("col_label").isNotNull()
    here = lambda row, tag: F.count_if(shown & (F.col("is_row") == row) & (F.col(f"n_{tag}") > 0))
    s = at.groupBy("section").agg(
        here(True, "gold").alias("rows_gold"), here(True, "gen").alias("rows_gen"), here(False, "gold").alias("cols_gold"), here(False, "gen").alias("cols_gen"),
        F.sum(F.when(F.col("is_row") & F.col("same"), F.col("n_gold")).otherwise(0)).alias("_same"))
    unlike = at.where("is_row AND NOT same").select("section", "row_key")
    if unlike.isEmpty():
        s = s.withColumn("n_cells", F.lit(0)).withColumn("n_mismatch", F.lit(0))
    else:
        kept = [side.join(unlike, ["section", "row_key"], "left_semi") for side in (golden, generated)]
        s = s.join(diff_cells(*kept, atol, rtol).groupBy("section").agg(F.count("*").alias("n_cells"), F.count_if(~F.col("ok")).alias("n_mismatch")), "section", "left")
    s = s.withColumn("n_cells", F.col("_same") + F.coalesce("n_cells", F.lit(0)))
    for side in ("gold", "gen"):  # a section that a side lacks has no shape there
        s = s.withColumns({c: F.when(F.col(f"rows_{side}") > 0, F.col(c)) for c in (f"cols_{side}", f"rows_{side}")})
    in_gold = F.col("rows_gold").isNotNull()
    in_gen = F.col("rows_gen").isNotNull()
    shape_ok = in_gold & in_gen & (F.col("rows_gold") == F.col("rows_gen")) & (F.col("cols_gold") == F.col("cols_gen"))
    status = (F.when(~in_gen, F.lit("missing in generated"))
              .when(~in_gold, F.lit("missing in golden"))
              .when(~shape_ok, F.lit("shape mismatch"))
              .when(F.col("n_mismatch") > 0, F.lit("data mismatch"))
              .otherwise(F.lit("ok")))
    return s.select(
        "section", in_gold.alias("in_golden"), in_gen.alias("in_generated"),
        "rows_gold", "rows_gen", "cols_gold", "cols_gen",
        F.coalesce("n_cells", F.lit(0)).cast("long").alias("n_cells"),
        F.coalesce("n_mismatch", F.lit(0)).cast("long").alias("n_mismatch"),
        status.alias("status"), (status == "ok").alias("passed"),
    )


def verdict(findings: DataFrame) -> DataFrame:
    """One row: all sections passed?"""
    return findings.agg(F.bool_and("passed").alias("passed"), F.count("*").alias("n_sections"))


def verdicts(findings: DataFrame) -> DataFrame:
    """(report, passed, n_sections, n_failed) per report and, with a NULL report, over all
    of them; a comparison without any section has not passed."""
    return findings.rollup("report").agg(
        F.coalesce(F.bool_and("passed"), F.lit(False)).alias("passed"), F.count("*").alias("n_sections"),
        F.count_if(~F.col("passed")).alias("n_failed"),
    ).orderBy(F.col("report").asc_nulls_last())
