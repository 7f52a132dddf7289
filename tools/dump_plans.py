"""Write PLANS.md: the physical plans (AQE initial plan, 'simple' mode) of the
line-level passes written by materialize() and of each headline query's final
plan, at a given scale factor.

  python tools/dump_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll import registry, session  # noqa: E402
from tillroll.operators import quantiles, ranking, stats  # noqa: E402
from tillroll.plans import customers, geo, product  # noqa: E402

HEADLINE = ["customer_rfm", "product_rfm", "churn_risk", "geographic_analysis", "clv_forecast", "kpis", "distinct_counts", "describe_numeric", "duplicates", "price_box_full"]


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return buf.getvalue().strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = session.build_session("local[8]", shuffle_partitions=8)
    captured: list[tuple[str, str]] = []
    orig = session.materialize

    def recording(df, name="table", observe=None):
        captured.append((name, plan_text(df)))
        return orig(df, name, observe)

    for mod in (customers, product, geo, quantiles, ranking, stats, registry):
        mod.materialize = recording
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], 8 shuffle partitions)\n")
    print("Generated by `tools/dump_plans.py`. Each query lists the plans of the tables it writes")
    print("once (the order-line ingest the first time, then the line passes) and then its final")
    print("plan, which reads those tables.\n")
    for name in HEADLINE:
        captured.clear()
        final = registry.QUERIES[name](spark, sf_dir)
        print(f"## {name}\n")
        for tname, text in captured:
            print(f"### written once: `{tname}`\n\n```\n{text}\n```\n")
        print(f"### final plan\n\n```\n{plan_text(final)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
