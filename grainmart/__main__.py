"""Command line: python -m grainmart {ingest,build,validate,profile,train,score,run,explain}."""

from __future__ import annotations

import argparse
import json
import sys

from grainmart.config import Settings, build_session
from grainmart.operators.quality import QualityError, gate
from grainmart.plans import jobs
from grainmart.plans.applicant_mart import CONTRACT, MART
from grainmart.plans.applicant_tables import RAW_TABLES
from grainmart.sources.catalog import AbsentInputs, RejectedTable, ingest
from grainmart.sources.warehouse import Warehouse, load_mart


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="grainmart")
    parser.add_argument("command", choices=[
        "ingest", "build", "validate", "profile", "train", "score", "run", "explain"])
    parser.add_argument("ids", nargs="*", type=int, help="ids to explain; none: global importance")
    args = parser.parse_args(argv)
    settings, spark = Settings(), build_session()
    warehouse = Warehouse(spark, settings.warehouse_dir)
    try:
        if args.command == "ingest":
            print(json.dumps(ingest(spark, settings.raw_dir, RAW_TABLES, warehouse), indent=2))
            return 0
        if args.command == "build":
            jobs.build_warehouse(spark, warehouse, settings)
            return 0
        mart = load_mart(warehouse, MART, settings.split_col)
        if args.command == "validate":
            gate(CONTRACT.report(mart))
        elif args.command == "profile":
            print(jobs.profile_report(mart, settings, f"{settings.reports_dir}/profile"))
        elif args.command == "train":
            print(json.dumps(jobs.train(mart, settings), indent=2))
        elif args.command == "score":
            jobs.score_pool(mart, settings, f"{settings.reports_dir}/submission")
        elif args.command == "run":
            print(json.dumps(jobs.train_and_score(mart, settings), indent=2))
        elif args.ids:
            for row in jobs.explain_ids(mart, args.ids, settings).toJSON().toLocalIterator():
                print(row)
        else:
            jobs.importance(mart, settings, f"{settings.reports_dir}/importance").show(50, False)
    except (AbsentInputs, RejectedTable, QualityError, ValueError, NotImplementedError) as error:
        print(error, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
