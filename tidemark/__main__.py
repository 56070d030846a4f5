"""Command line: run the whole build from raw files, then the reports.

    python -m tidemark build --events E --products P --customers C --lake ROOT
                             [--format csv|parquet] [--multiline] [--threshold 10] [--lenient]
                             [--staging table|view] [--block CHECK ...] [--schema LAYER=NAME ...]
                             [--master local[*]] [--no-register] [--warn]
    python -m tidemark report NAME [NAME ...] --lake ROOT [--schema LAYER=NAME ...]
    python -m tidemark vacuum --lake ROOT [--keep 2] [--hours 24] [--schema LAYER=NAME ...]

``build`` prints the columns by which the files differ from the declared ones
(and stops there where a declared one is missing or a CSV has another one),
copies raw files untransformed into bronze, writes staging to silver, runs the
data checks, and then writes the intermediate models to silver and the seven
marts to gold under ROOT, all published as one release. The check results (one
row per check) are printed as JSON lines; a failing check makes the exit code 1
unless ``--warn`` is given, and one named by ``--block`` (by default ``unique``; ``none``
for none) leaves the tables as they were. ``--lenient`` turns text that cannot be
cast into null and lists it in ``silver.rejects``. ``--multiline`` reads CSV whose
cells hold line feeds. The models become catalog tables ``silver.<model>`` and
``gold.<mart>`` unless ``--no-register`` is given; ``--schema`` gives a layer another
name. ``vacuum`` removes versions of tables that the last releases do not hold.
``report`` computes dashboard reports from the written tables of a finished
build with that build's loyalty threshold, writes each to ``gold/reports/NAME``
and shows its first rows; the name of a mart or an intermediate model shows that
table's first rows. Rows are shown in report order.
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import timedelta

from tidemark.operators.intermediate import LOYALTY_THRESHOLD
from tidemark.operators.marts import display_order
from tidemark.operators.quality import dq_schema_drift
from tidemark.plans.build import INTERMEDIATE, MARTS, REPORTS, materialize, stored_models
from tidemark.session import get_session
from tidemark.sources.raw import load_bronze, read_found, read_raw_tables
from tidemark.sources.sinks import Layout


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    sub = parser.add_subparsers(dest="command", required=True)
    b = sub.add_parser("build", help="raw files -> bronze -> silver -> gold")
    b.add_argument("--events", required=True)
    b.add_argument("--products", required=True)
    b.add_argument("--customers", required=True)
    b.add_argument("--lake", required=True, help="root folder of the bronze/silver/gold layers")
    b.add_argument("--format", default="csv", choices=["csv", "parquet", "orc", "json"])
    b.add_argument("--threshold", type=int, default=LOYALTY_THRESHOLD)
    b.add_argument("--master", default=None, help="only for local runs; omit under spark-submit")
    b.add_argument("--register", action=argparse.BooleanOptionalAction, default=True,
                   help="register the tables as silver.<model> and gold.<mart>")
    b.add_argument("--warn", action="store_true", help="failing checks do not fail the run")
    b.add_argument("--multiline", action="store_true", help="CSV cells may hold line feeds")
    b.add_argument("--lenient", action="store_true", help="text that cannot be cast becomes null")
    b.add_argument("--staging", default="table", choices=["table", "view"])
    b.add_argument("--block", nargs="+", default=["unique"],
                   choices=["unique", "not_null", "accepted_values", "none"],
                   help="checks whose failure leaves the tables as they were")
    r = sub.add_parser("report", help="dashboard reports from a finished build")
    r.add_argument("names", nargs="+", choices=REPORTS + MARTS + INTERMEDIATE, metavar="NAME")
    r.add_argument("--lake", required=True)
    r.add_argument("--threshold", type=int, default=None,
                   help="must be the build's, which is the default")
    r.add_argument("--master", default=None)
    v = sub.add_parser("vacuum", help="remove old versions of tables")
    v.add_argument("--lake", required=True)
    v.add_argument("--keep", type=int, default=2, help="releases that stay readable")
    v.add_argument("--hours", type=float, default=24, help="younger versions stay")
    v.add_argument("--master", default=None)
    for p in (b, r, v):
        p.add_argument("--schema", action="append", default=[], metavar="LAYER=NAME",
                       help="schema name of a layer")
    args = parser.parse_args(argv)
    schemas = dict(x.split("=", 1) for x in args.schema)

    spark = get_session(args.master)
    layout = Layout(spark, args.lake, schemas)
    if args.command == "vacuum":
        for folder in layout.vacuum(args.keep, timedelta(hours=args.hours)):
            print(folder)
        return 0
    if args.command == "report":
        m = stored_models(layout)
        if args.threshold not in (None, m.threshold):
            parser.error(f"the build has threshold {m.threshold}")
        for name in args.names:
            out = (layout.write(m.report(name), "gold", f"reports/{name}") if name in REPORTS
                   else m.model(name))
            print(f"== {name}")
            # display only; the table is in the lake
            display_order(name, out).show(20, truncate=False)
        return 0

    paths = {"events": args.events, "products": args.products, "customers": args.customers}
    options = {"multiLine": True} if args.multiline else None
    found = {f"raw.{n}": read_found(spark, p, args.format, options) for n, p in paths.items()}
    for row in dq_schema_drift(found).where("status <> 'ok'").collect():  # one row per column
        print(json.dumps(row.asDict()))
    raw = read_raw_tables(spark, paths, args.format, options)
    bronze = load_bronze(raw, layout)
    gold, checks = materialize(bronze, layout, args.threshold, register=args.register,
                               lenient=args.lenient, staging=args.staging,
                               blocking=tuple(x for x in args.block if x != "none"))
    rows = checks.collect()  # one row per check
    for row in rows:
        print(json.dumps(row.asDict()))
    print(json.dumps({"gold": sorted(gold), "lake": args.lake,
                      "release": layout.release().number}))
    return 0 if args.warn or not any(row["failures"] for row in rows) else 1


if __name__ == "__main__":
    sys.exit(main())
