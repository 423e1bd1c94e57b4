"""``python -m finlake <step> --root <lake>``, or the same through spark-submit."""

from __future__ import annotations

import argparse

from finlake.lake import Lake
from finlake.plans import builds
from finlake.plans.specs import YEARS
from finlake.session import get_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="finlake")
    parser.add_argument("step", choices=["silver", "gold", "quality", "export-silver", "export-gold"])
    parser.add_argument("--root", required=True, help="lake root URI")
    parser.add_argument("--years", type=int, nargs="*", default=list(YEARS))
    parser.add_argument("--documents", nargs="*", default=["CAD", "DFP", "FRE", "FCA"])
    parser.add_argument("--unique-companies", action="store_true")
    parser.add_argument("--target", help="export folder")
    parser.add_argument("--single-file", action="store_true", help="export each table as one file, through one task")
    args = parser.parse_args(argv)
    if args.step.startswith("export") and not args.target:
        parser.error("--target is required for exports")
    spark, lake = get_session(), Lake(args.root.rstrip("/"))
    outcomes = []
    if args.step == "silver":
        for document in args.documents:
            outcomes += builds.build_silver(spark, lake, document, args.years)
    elif args.step == "gold":
        outcomes = builds.build_gold(spark, lake, args.years, unique_companies=args.unique_companies)
    elif args.step == "quality":
        outcomes = builds.run_quality(spark, lake, args.years)
    elif args.step == "export-silver":
        builds.export_silver(spark, lake, args.target, single_file=args.single_file)
    else:
        builds.export_gold(spark, lake, args.target, single_file=args.single_file)
    for o in outcomes:
        print(f"{o.step} {o.table} {o.year or 'all'}: {'ok' if o.ok else 'FAILED'} {o.rows if o.ok else o.error}")
    return 0 if all(o.ok for o in outcomes) else 1


if __name__ == "__main__":
    raise SystemExit(main())
