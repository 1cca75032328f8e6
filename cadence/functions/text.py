"""Text expressions: normalised matching, missing-text sentinels, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts the rule workbook uses for "no value".
MISSING_TEXT = ("", "nan", "none")
# Fixed value: the category item that means "no category filter".
ALL_CATEGORIES = "all"
# Fixed value: the default timeslice of the standard report.
DEFAULT_TIMESLICE = "All Periods"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm(c) -> Column:
    """Case- and space-insensitive form used by every rule predicate."""
    return F.lower(F.trim(_col(c)))


def blank_to_null(c) -> Column:
    """NULL for NULL, blank, 'nan' and 'none' (any case); else the trimmed text."""
    t = F.trim(_col(c))
    return F.when(t.isNull() | F.lower(t).isin(*MISSING_TEXT), F.lit(None).cast("string")).otherwise(t)


def object_name(child, parent) -> Column:
    """Child object name, or the parent's when the child is NULL or blank."""
    ch = _col(child)
    return F.when(ch.isNull() | (F.trim(ch) == ""), _col(parent)).otherwise(ch)


def category_list(c) -> Column:
    """Comma list -> array of trimmed items; NULL or 'nan' -> empty array."""
    raw = F.trim(_col(c))
    items = F.transform(F.split(raw, ","), lambda x: F.trim(x))
    return F.when(raw.isNull() | (F.lower(raw) == "nan") | (raw == ""), F.array().cast("array<string>")).otherwise(items)


def category_filter_items(c) -> Column:
    """Normalised category items with 'all' and blanks dropped (empty = no filter)."""
    return F.filter(
        F.transform(_col(c), lambda x: F.lower(F.trim(x))),
        lambda x: x.isNotNull() & (x != ALL_CATEGORIES) & (x != ""),
    )


def summary_label(cls, cats, prop) -> Column:
    """Row label of a monthly-summary rule: ``{class}-{cats}-{property}-Total``;
    cats joined by '-', or 'all' when the rule has no category list."""
    cats_txt = F.when(F.size(_col(cats)) > 0, F.array_join(_col(cats), "-")).otherwise(F.lit("all"))
    return F.concat_ws("-", _col(cls), cats_txt, _col(prop), F.lit("Total"))


def alias_label(obj, alias) -> Column:
    """``object:alias`` when the alias has a value, else the object."""
    a = blank_to_null(alias)
    return F.when(a.isNotNull(), F.concat(_col(obj), F.lit(":"), a)).otherwise(_col(obj))


# Sub-header prefix of nested blocks whose parent class is Emission.
EMISSION_PARENT_CLASS = "Emission"
EMISSION_PREFIX = "Total Effluents (lb) -- "


def nested_subheader(parent, parent_class) -> Column:
    return F.when(
        _col(parent_class) == EMISSION_PARENT_CLASS, F.concat(F.lit(EMISSION_PREFIX), _col(parent))
    ).otherwise(_col(parent))
