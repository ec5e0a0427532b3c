"""Command line: run one or more catalogued dataflows end to end.

    python -m regiocube.plans.cli --out OUT --vintage 2026 \
        --geo geo.csv --codelists CODELIST_DIR  gdp-nuts3=landed/gdp.tsv [...]

Codelists are ``<dim>.csv`` or ``<dim>.parquet`` files (``code,label_en``; ``flag`` or
``flags`` may use ``flag,description_en``) in CODELIST_DIR, in any file system that
Spark reads. Prints one JSON line per gate. A dataset whose gate fails stops;
the others go on and the exit code is 1. ``--no-fail`` reports gates of the marts
without stopping.
"""

from __future__ import annotations

import argparse
import json

from regiocube.plans.catalog import CATALOG
from regiocube.plans.runner import run_all
from regiocube.session import build_session
from regiocube.sources.readers import read_codelists, read_geo


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--out", required=True)
    ap.add_argument("--vintage", required=True)
    ap.add_argument("--geo", required=True)
    ap.add_argument("--codelists", required=True)
    ap.add_argument("--master", default=None)
    ap.add_argument("--no-fail", action="store_true", help="report failing gates without raising")
    ap.add_argument("runs", nargs="+", help="slug=path of the landed wide TSV")
    args = ap.parse_args(argv)

    spark = build_session(app="regiocube-run", master=args.master)
    geo = read_geo(spark, args.geo)
    raws = dict(run.split("=", 1) for run in args.runs)
    rows = run_all(spark, {slug: CATALOG[slug] for slug in raws}, raws, geo, read_codelists(spark, args.codelists),
                   args.out, args.vintage, fail_on_error=not args.no_fail)
    for r in rows:
        print(json.dumps(r, default=str))
    failed = [r for r in rows if r["n_bad"] and (r["check_name"] == "dataset_run" or not args.no_fail)]
    return 1 if failed else 0


if __name__ == "__main__":
    code = main()
    from pyspark.sql import SparkSession

    active = SparkSession.getActiveSession()
    if active is not None:
        active.stop()
    raise SystemExit(code)
