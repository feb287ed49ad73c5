"""Run the reports over a model folder and write the results.

    spark-submit --py-files tallybook.zip tallybook/cli.py --model ROOT --out DIR
                 [--report all|customers|purchase|sales] [--format parquet|csv]
    python -m tallybook.cli ...            (local runs)

ROOT holds ``<table>.parquet`` for the tables of ``tallybook.sources.model``.
Each report is written to ``DIR/<report>``. The exports keep their order
(newest invoice number first) across the written part files.
"""

from __future__ import annotations

import argparse

from tallybook import build_session
from tallybook.plans.customers import customers_report
from tallybook.plans.purchase import purchase_export
from tallybook.plans.sales import sales_export
from tallybook.sources.model import from_parquet
from tallybook.sources.stages import StageStore

REPORTS = {"customers": customers_report, "purchase": purchase_export, "sales": sales_export}


def run(spark, model_root: str, out: str, reports: list[str], fmt: str = "parquet") -> list[str]:
    m = from_parquet(spark, model_root)
    written = []
    with StageStore(spark) as store:
        for name in reports:
            staged = {} if name == "customers" else {"store": store}
            w = REPORTS[name](m, **staged).write.mode("overwrite")
            path = f"{out.rstrip('/')}/{name}"
            (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))
            written.append(path)
    return written


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--model", required=True, help="folder with <table>.parquet per model table")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--report", default="all", choices=["all", *REPORTS])
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--master", default=None, help="only for local runs, e.g. local[8]")
    a = ap.parse_args(argv)
    spark = build_session(a.master, app="tallybook-reports")
    names = list(REPORTS) if a.report == "all" else [a.report]
    for path in run(spark, a.model, a.out, names, a.format):
        print(path)


if __name__ == "__main__":
    main()
