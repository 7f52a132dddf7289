"""Command line.

  python -m tillroll pipeline --csv <folder> --out <dir> [--exports]
  python -m tillroll pipeline --tables <sf_dir> --out <dir> [--exports]
  python -m tillroll query <name> --tables <sf_dir> [--show N] [--csv-out <dir>] [--explain]
  python -m tillroll customers --landing <folder> --state <dir> --out <dir>
  python -m tillroll list

Submit with spark-submit on a cluster (master and resources come from it);
``--master`` is for local runs.
"""

from __future__ import annotations

import argparse
import json

from tillroll import registry
from tillroll.plans import churn, clv, pipeline, rfm
from tillroll.session import build_session
from tillroll.sources import csv_orders, export, tables, testdata
from tillroll.streaming import customer_state


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tillroll")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("pipeline", help="ingest -> RFM -> publish -> marts")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="folder of ';'-separated order-line CSV files")
    src.add_argument("--tables", help="folder of the star-schema parquet tables")
    p.add_argument("--lenient", action="store_true", help="leave unparsable numbers NULL instead of failing")
    p.add_argument("--out", required=True)
    p.add_argument("--exports", action="store_true")
    q = sub.add_parser("query", help="run one registered query")
    q.add_argument("name")
    q.add_argument("--tables", required=True)
    q.add_argument("--show", type=int, default=20)
    q.add_argument("--csv-out", default=None)
    q.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    c = sub.add_parser("customers", help="fold new files into the customer table; write RFM, churn, CLV")
    c.add_argument("--landing", required=True)
    c.add_argument("--state", required=True)
    c.add_argument("--out", required=True)
    sub.add_parser("list", help="list registered queries")
    args = ap.parse_args(argv)

    if args.cmd == "list":
        print("\n".join(sorted(registry.QUERIES)))
        return
    spark = build_session(args.master)
    if args.cmd == "pipeline":
        orders = (
            csv_orders.read_orders(spark, args.csv, strict=not args.lenient)
            if args.csv
            else testdata.orders_view(spark, args.tables)
        )
        print(json.dumps(pipeline.run_pipeline(spark, orders, args.out, exports=args.exports), indent=2))
    elif args.cmd == "customers":
        state = args.state.rstrip("/")
        base = customer_state.update_customers(spark, args.landing, state, f"{state}/_checkpoint")
        scores = rfm.customer_rfm(None, base=base)
        out = args.out.rstrip("/")
        paths = {
            "rfm_analysis": tables.write_version(scores, f"{out}/rfm_analysis"),
            "churn_risk": tables.write_version(churn.churn_risk(None, base=base), f"{out}/churn_risk"),
        }
        silver = spark.read.parquet(paths["rfm_analysis"])
        paths["clv_forecast"] = tables.write_version(clv.clv_from_base(silver, base), f"{out}/clv_forecast")
        print(json.dumps(paths, indent=2))
    else:
        df = registry.QUERIES[args.name](spark, args.tables)
        if args.explain:
            df.explain(mode="formatted")
        elif args.csv_out:
            export.export_csv(df, args.csv_out)
        else:
            df.show(args.show, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
