"""DuckDB SQL for the correctness oracle of the analog queries.

Written independently of the Spark plans, straight from the report semantics:
rule predicates, cell aggregate, NaN/NULL -> 0, rename and merge, unit factor,
month completion, year totals, Total row. Every float is rounded the same way
on both sides (:func:`cadence.functions.numeric.round4_sql`).
"""

from __future__ import annotations

from cadence import analog
from cadence.functions.numeric import round4_sql as R4

# The analog's property catalogue, as in cadence.sources.star.
MEASURES = {
    "quantity": ("l_quantity", "units"),
    "discount": ("l_discount", "fraction"),
    "extended price": ("l_extendedprice", "USD"),
    "tax": ("l_tax", "fraction"),
}


def q(s) -> str:
    if s is None:
        return "NULL"
    return "'" + str(s).replace("'", "''") + "'"


def norm(s) -> str | None:
    return None if s is None else str(s).strip().lower()


def blank(s) -> bool:
    return s is None or str(s).strip().lower() in ("", "nan", "none")


OBS = """
    SELECT
      CASE WHEN s.s_name IS NULL OR trim(s.s_name) = '' THEN n.n_name ELSE s.s_name END AS object,
      n.n_name AS parent, r.r_name AS category,
      l.l_linenumber AS band, l.l_returnflag AS flag, ascii(l.l_returnflag) AS flag_id,
      CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month_start,
      CAST(day(l.l_shipdate) AS INTEGER) AS day,
      CAST(l.l_quantity AS DOUBLE) AS m_quantity, CAST(l.l_discount AS DOUBLE) AS m_discount,
      CAST(l.l_extendedprice AS DOUBLE) AS m_extended_price, CAST(l.l_tax AS DOUBLE) AS m_tax
    FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
    LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
    LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

CAL = "SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start FROM lineitem WHERE l_shipdate IS NOT NULL"

NZMEAN = "COALESCE(AVG(NULLIF(v, 0.0)), 0.0)"


def measure_col(prop: str) -> str | None:
    p = norm(prop)
    return None if p not in MEASURES else "m_" + p.replace(" ", "_")


def categories(cls, group) -> list[str]:
    for c, g, assets in analog.GROUPS:
        if c.strip() == str(cls).strip() and g.strip() == str(group).strip():
            if assets is None or assets.strip().lower() == "nan" or assets.strip() == "":
                return []
            return [a.strip() for a in assets.split(",")]
    return []


def cat_filter_items(items) -> list[str]:
    return [norm(x) for x in items if norm(x) not in ("all", "")]


def factor(prop: str, unit_to) -> float:
    p = norm(prop)
    if p not in MEASURES or blank(unit_to):
        return 1.0
    db_unit = MEASURES[p][1]
    for uf, ut, rate in analog.UNITS:
        if uf.strip().lower() == db_unit.lower() and ut.strip().lower() == str(unit_to).strip().lower():
            return float(rate)
    return 1.0


def names_cte() -> str:
    vals = ", ".join(f"({o}, {q(s)}, {q(d)})" for o, s, d in analog.NAMES)
    return f"SELECT src, arg_max(dst, o) AS dst FROM (VALUES {vals}) t(o, src, dst) GROUP BY src"


def where(prop, cls=None, cats=(), flag=None, parent=None, parent_in=None) -> str:
    preds = ["object IS NOT NULL"]
    mc = measure_col(prop)
    if mc is None:
        preds.append("FALSE")
    if not blank(cls) and norm(cls) != "supplier":
        preds.append("FALSE")
    items = cat_filter_items(cats)
    if items:
        preds.append(f"lower(trim(category)) IN ({', '.join(q(x) for x in items)})")
    if flag is not None and norm(flag) != "all periods":
        preds.append(f"lower(trim(flag)) = {q(norm(flag))}")
    if parent is not None:
        preds.append(f"lower(trim(parent)) = {q(norm(parent))}")
    return " AND ".join(preds)


def cells_sql(prop, rate, pred, daily=False, by_flag=False) -> str:
    """Cell aggregate per (object, band, month[, day]) — the pivot's input."""
    mc = measure_col(prop) or "m_quantity"
    agg = "AVG" if rate else "SUM"
    extra = ", day" if daily else ""
    fl = ", ts" if by_flag else ""
    src = "obs"
    if by_flag:
        src = ("(SELECT *, 'All Periods' AS ts, 0 AS ts_id FROM obs UNION ALL "
               "SELECT *, flag AS ts, flag_id AS ts_id FROM obs)")
    return (f"SELECT object, band, month_start{extra}{fl}, {agg}({mc}) AS v FROM {src} WHERE {pred} "
            f"GROUP BY object, band, month_start{extra}{fl}")


def clean(v="v") -> str:
    return f"CASE WHEN {v} IS NULL OR isnan({v}) THEN 0.0 ELSE {v} END"


OBS_TS = ("SELECT *, 'All Periods' AS ts, 0 AS ts_id FROM obs UNION ALL "
          "SELECT *, flag AS ts, flag_id AS ts_id FROM obs")


def block_sql(rule_ord: int, prop, rate, pred, fac=1.0, names=True, total_row=True, keys=(), obs="obs") -> str:
    """A flat block as long cells: (rule_ord, row_kind, *keys, object, col_label, value).
    ``keys`` are extra block keys of the observations (parent for nested rules,
    ts for timeslices)."""
    keys = list(keys)
    k = "".join(f"{x}, " for x in keys)
    kc = "".join(f"c.{x}, " for x in keys)
    ko = "".join(f"o.{x}, " for x in keys)
    kj = "".join(f"AND m.{x} = o.{x} " for x in keys)
    nm = f"LEFT JOIN ({names_cte()}) nm ON c.object = nm.src" if names else ""
    obj = "COALESCE(nm.dst, c.object)" if names else "c.object"
    yagg = NZMEAN if rate else "SUM(v)"
    mc = measure_col(prop) or "m_quantity"
    agg = "AVG" if rate else "SUM"
    src = obs if obs == "obs" else f"({obs})"
    tot = ""
    if total_row:
        tot = f" UNION ALL SELECT 'total' AS row_kind, {k}NULL AS object, col_label, {yagg} AS v FROM rws GROUP BY {k}col_label"
    return f"""
    WITH obs AS ({OBS}), cal AS ({CAL}),
    cell AS (SELECT {k}object, band, month_start, {agg}({mc}) AS v FROM {src} o WHERE {pred}
             GROUP BY {k}object, band, month_start),
    cl AS (SELECT {k}object, band, month_start, {clean()} AS v FROM cell),
    mapped AS (SELECT {kc}{obj} AS object, c.month_start, SUM(c.v) * {fac!r} AS v FROM cl c {nm} GROUP BY ALL),
    objs AS (SELECT DISTINCT {k}object FROM mapped),
    grid AS (SELECT {ko}o.object, cal.month_start, COALESCE(m.v, 0.0) AS v
             FROM objs o CROSS JOIN cal LEFT JOIN mapped m ON m.object = o.object {kj}AND m.month_start = cal.month_start),
    rws AS (
      SELECT {k}object, strftime(month_start, '%b-%Y') AS col_label, v FROM grid
      UNION ALL SELECT {k}object, 'Tot-' || CAST(year(month_start) AS VARCHAR), {yagg} FROM grid GROUP BY {k}object, year(month_start)
      UNION ALL SELECT {k}object, 'Total', {yagg} FROM grid GROUP BY {k}object),
    outp AS (SELECT 'data' AS row_kind, {k}object, col_label, v FROM rws{tot})
    SELECT {rule_ord} AS rule_ord, row_kind, {k}object, col_label, v AS value FROM outp
    """


def rounded(sql: str, cols: str = "*") -> str:
    return f"SELECT * REPLACE ({R4('value')} AS value) FROM ({sql}) b"


def std_rule(rule_ord):
    return next(r for r in analog.STANDARD if r[0] == rule_ord)


def flat_rule_sql(rule_ord: int, names=True, units=True, total_row=True, raw=False) -> str:
    _, _, cls, group, prop, _, rate, unit = std_rule(rule_ord)
    cats = categories(cls, group)
    fac = factor(prop, unit) if units else 1.0
    sql = block_sql(rule_ord, prop, rate, where(prop, cls, cats), fac, names, total_row)
    return sql if raw else rounded(sql)


def nested_rule_sql(rule_ord: int, raw=False) -> str:
    """Parents of the parent class within the rule's categories; per parent all
    series under it (no class or category filter), 'All Periods'."""
    _, _, cls, group, prop, _, rate, unit = std_rule(rule_ord)
    parent_cls = cls.strip().split(".")[0]
    items = cat_filter_items(categories(parent_cls, group))
    cat_pred = f"AND lower(trim(r.r_name)) IN ({', '.join(q(x) for x in items)})" if items else ""
    cls_ok = "TRUE" if parent_cls.lower() == "nation" else "FALSE"
    parents = (f"SELECT DISTINCT lower(trim(n.n_name)) FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey "
               f"LEFT JOIN region r ON n.n_regionkey = r.r_regionkey WHERE {cls_ok} {cat_pred}")
    pred = where(prop) + f" AND lower(trim(parent)) IN ({parents})"
    sql = block_sql(rule_ord, prop, rate, pred, factor(prop, unit), True, True, keys=["parent"])
    return sql if raw else rounded(sql)


def ratings_rule_sql(rule, raw=False) -> str:
    """A ratings rule in every timeslice: summed, no Total row, label object:alias."""
    ro, cls, group, prop, alias, unit = rule
    cats = categories(cls.strip(), group)
    sql = block_sql(ro, prop, False, where(prop, cls, cats), factor(prop, unit), True, False, keys=["ts", "ts_id"],
                    obs=OBS_TS)
    lab = "object" if blank(alias) else f"object || ':' || {q(str(alias).strip())}"
    sql = f"SELECT rule_ord, row_kind, ts, ts_id, object, {lab} AS row_label, col_label, value FROM ({sql}) x"
    return sql if raw else rounded(sql)
