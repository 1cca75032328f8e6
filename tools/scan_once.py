"""Scan-once vs one job per rule: N generated rules over the test star.

    python tools/scan_once.py [sf_dir] [n ...]
Prints JSON lines: {"n": N, "all_at_once": s, "per_rule": s|null, "fact_scans": k}.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PROPS = [("Quantity", False), ("Discount", True), ("Extended Price", False), ("Tax", True)]
GROUPS = ["All", "AsiaEurope", "Americas", "Europe"]


def rules(n: int):
    out = []
    for i in range(n):
        prop, rate = PROPS[i % len(PROPS)]
        group = GROUPS[(i // len(PROPS)) % len(GROUPS)]
        out.append((i + 1, f"( {i // 10 + 1} ) Section", "Supplier", group, prop, "monthly", rate, None))
    return out


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    ns = [int(x) for x in sys.argv[2:]] or [1, 10, 100]
    from cadence import analog
    from cadence.api import calendar_of, monthly_block
    from cadence.operators.blocks import monthly_values
    from cadence.session import get_session
    from cadence.sources.rules import prepare
    from cadence.sources.star import lineitem_source

    spark = get_session()
    src = lineitem_source(spark, sf_dir)
    cal = calendar_of(src)
    for n in ns:
        rs = analog.ruleset(spark, standard=rules(n), ratings=[])
        p = prepare(rs)
        plan = monthly_values(src, p, p.names, p.units)._jdf.queryExecution().executedPlan().toString()
        scans = plan.count("lineitem.parquet")
        monthly_block(src, rs, cal=cal).write.format("noop").mode("overwrite").save()  # warm
        t = time.perf_counter()
        monthly_block(src, rs, cal=cal).write.format("noop").mode("overwrite").save()
        together = time.perf_counter() - t
        per_rule = None
        if n <= 10:
            t = time.perf_counter()
            for r in rules(n):
                one = analog.ruleset(spark, standard=[r], ratings=[])
                monthly_block(src, one, cal=cal).write.format("noop").mode("overwrite").save()
            per_rule = round(time.perf_counter() - t, 2)
        print(json.dumps({"n": n, "all_at_once": round(together, 2), "per_rule": per_rule, "fact_scans": scans}),
              flush=True)


if __name__ == "__main__":
    main()
