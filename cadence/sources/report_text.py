"""Sectioned report text -> cells (the golden-file reader).

A report text is a sequence of sections: a title line (no comma), a header
line ('' then column labels), data lines (row label then one field per
column), and a blank line. A line is a title when it has no comma and either
starts with '(' or opens a block (first line, or after a blank line). Data before a
text's first title is an error: its section is unknown.

A text is a file, or a folder of part files, read in the order of their numbers. Files
are split like any text: a line's number is its place in its split plus the lines of the
splits before, and what a line needs of earlier ones (the last title, whether the line
above is blank, how many data lines there were) comes from its own split and, for the
splits before, from one summary row each. No task needs a whole file or section.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.plans.sizing import cut

# Split a CSV line on commas outside double quotes.
_CSV_SPLIT = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
_PART = r"/part-(\d+)[^/]*$"
_SPLIT_KEYS = ["file", "_part", "_path", "_start"]


def _earlier(*order: str) -> Window:
    """The summary rows of a text's splits ahead of one."""
    return Window.partitionBy("file").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def read_report_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, pos, line) for every line of every report text under ``path``: ``pos``
    counts a text's lines from 0, ``split`` its splits from 1."""
    at = F.col("_metadata.file_path")
    part = F.expr(f"try_cast(regexp_extract(_metadata.file_path, r'{_PART}', 1) AS BIGINT)")
    raw = spark.read.text(path).select(
        F.when(part.isNotNull(), F.regexp_replace(at, "/[^/]*$", "")).otherwise(at).alias("file"), F.coalesce(part, F.lit(0)).alias("_part"),
        at.alias("_path"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line"))
    raw = cut(raw)  # ids stay as they are
    splits = raw.groupBy(*_SPLIT_KEYS).agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    order = _SPLIT_KEYS[1:]
    splits = splits.select(*_SPLIT_KEYS, "_first", F.row_number().over(Window.partitionBy("file").orderBy(*order)).alias("split"),
                           F.coalesce(F.sum("_n").over(_earlier(*order)), F.lit(0)).alias("_before"))
    return raw.join(splits, _SPLIT_KEYS).select("file", "split", (F.col("_before") + F.col("_id") - F.col("_first")).alias("pos"), "line")


def _unquote(c: Column) -> Column:
    inner = F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), '""', '"')
    return F.when(c.startswith('"') & c.endswith('"') & (F.length(c) >= 2), inner).otherwise(c)


def _fields(line: str) -> Column:
    quoted = F.transform(F.split(line, _CSV_SPLIT), _unquote)  # looks ahead over the line at each comma
    return F.when(F.col(line).contains('"'), quoted).otherwise(F.split(line, ","))


def _marked(lines: DataFrame) -> DataFrame:
    """Lines with ``_title`` and ``_body``; what is above a split's first line comes from the split before."""
    t = lines.withColumn("line", F.regexp_replace("line", r"\s+$", ""))
    t = t.withColumn("_blank", F.trim("line") == "")
    ends = t.groupBy("file", "split").agg(F.max_by("_blank", "pos").alias("_end"))
    ends = ends.select("file", "split", F.lag("_end", 1, True).over(Window.partitionBy("file").orderBy("split")).alias("_above"))
    own = Window.partitionBy("file", "split").orderBy("pos")
    t = t.join(ends, ["file", "split"]).withColumn("_above", F.coalesce(F.lag("_blank").over(own), F.col("_above")))
    title = ~F.col("_blank") & ~F.col("line").contains(",") & (F.trim("line").startswith("(") | F.col("_above"))
    return t.withColumn("_title", title).withColumn("_body", ~F.col("_blank") & ~F.col("_title"))


def parse_sections(lines: DataFrame) -> DataFrame:
    """(file, split, pos, line) -> (file, section, row_pos, row_no, row_label, col_pos, col_label, value, text);
    ``row_no`` is the data row's position inside its section (0-based). Without a column
    ``split`` each file is one."""
    t = _marked(lines if "split" in lines.columns else lines.withColumn("split", F.lit(1)))
    title = F.when(F.col("_title"), F.struct("pos", F.trim("line").alias("name")))
    sums = t.groupBy("file", "split").agg(F.max(title).alias("_last"), F.sum(F.col("_body").cast("long")).alias("_rows"))
    sums = sums.select("file", "split", F.last("_last", ignorenulls=True).over(_earlier("split")).alias("_held"), F.coalesce(F.sum("_rows").over(_earlier("split")), F.lit(0)).alias("_before"))
    upto = Window.partitionBy("file", "split").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    t = t.join(sums, ["file", "split"])
    t = t.withColumn("_sec", F.coalesce(F.last(title, ignorenulls=True).over(upto), F.col("_held")))
    t = t.withColumn("_n", F.col("_before") + F.sum(F.col("_body").cast("long")).over(upto))
    # in the section's key, since a mere filter would give way to the join's own on that key
    lost = F.raise_error(F.concat(F.lit("data before the first section title: "), "file")).cast("long")
    at = F.when(~F.col("_body"), F.lit(None)).when(F.col("_sec").isNotNull(), F.col("_sec.pos")).otherwise(lost)
    body = t.where("_body").select("file", at.alias("_at"), F.col("_sec.name").alias("section"), "pos", "_n", "line")
    heads = body.groupBy("file", "_at").agg(F.min(F.struct("_n", "line")).alias("_head"))
    heads = heads.select("file", "_at", F.col("_head._n").alias("_first"), _fields("_head.line").alias("_labels"))
    rows = body.join(heads, ["file", "_at"]).where(F.col("_n") > F.col("_first")).withColumn("_f", _fields("line"))
    cells = rows.select("file", "section", F.col("pos").alias("row_pos"), (F.col("_n") - F.col("_first") - 1).cast("int").alias("row_no"),
                        F.col("_f")[0].alias("row_label"), "_labels", F.posexplode("_f").alias("col_pos", "_c")).where(F.col("col_pos") > 0)
    num = F.expr("try_cast(_c AS DOUBLE)")
    return cells.select("file", "section", "row_pos", "row_no", "row_label", "col_pos", F.get("_labels", F.col("col_pos")).alias("col_label"),
                        num.alias("value"), F.when(num.isNull() & (F.col("_c") != ""), F.col("_c")).alias("text"))


def read_report_cells(spark: SparkSession, path: str) -> DataFrame:
    return parse_sections(read_report_lines(spark, path))
