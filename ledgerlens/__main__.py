"""Command line: train, evaluate, pick and save the best model.

    python -m ledgerlens --input transactions.csv [--seed 42] [--out DIR]
    python -m ledgerlens --tables /root/testdata/sf0.1
    python -m ledgerlens --input new.csv --score-with /shared/run1/best_model --out /shared/scored

``--input`` takes a labelled transaction CSV with a header (schema inferred,
optionally from a sample, or declared with ``--layout payments|fixture``) or
parquet; ``--tables``
takes a folder of the driver's tables.  Output (best features+model pipeline,
metrics JSON in flat and nested form) goes to ``--out`` or to a folder in the
shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys


def score_only(spark, args) -> int:
    """Score new transactions (the dashboard's prediction, for whole files):
    txn_id, probability, prediction, label_text, probability_text as parquet."""
    from .operators import models, scoring
    from .sources import files
    from .sources.schema import PAYMENTS_CSV_SCHEMA, TXN_CSV_SCHEMA

    if not args.input:
        raise SystemExit("--score-with needs --input")
    if args.input.endswith(".parquet"):
        df = files.with_row_key(files.read_parquet_checked(spark, args.input))
    else:
        schema = {"infer": None, "payments": PAYMENTS_CSV_SCHEMA, "fixture": TXN_CSV_SCHEMA}[args.layout]
        df = files.read_labelled_csv(spark, args.input, schema, args.schema_sample, require_label=False)
    out = args.out or files.scratch_dir(spark, "scored")
    scoring.score_batch(models.load_model(args.score_with), df).write.mode("overwrite").parquet(out)
    print(json.dumps({"scored": out}))
    return 0


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlens")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--input", help="labelled transactions: .csv file/folder or parquet")
    src.add_argument("--tables", help="folder with the driver's parquet tables")
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--out", default=None)
    ap.add_argument("--models", default=None, help="comma-separated; all by default")
    ap.add_argument("--layout", choices=["infer", "payments", "fixture"], default="infer",
                    help="CSV schema: inferred, the payments-log layout, or the fixture layout")
    ap.add_argument("--schema-sample", type=float, default=1.0,
                    help="fraction of the CSV read to infer its schema (layout=infer)")
    ap.add_argument("--score-with", default=None,
                    help="saved features+model pipeline: score --input instead of training")
    ap.add_argument("--train-partitions", type=int, default=None,
                    help="partitions of the training frame; by default they follow from its rows")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    from .plans.training import ALL_MODELS, check_names, run_job
    from .plans.workbench import register_workbench, Workbench
    from .session import build_session
    from .sources import files
    from .sources.schema import PAYMENTS_CSV_SCHEMA, TXN_CSV_SCHEMA

    spark = build_session(args.master)
    if args.score_with:
        return score_only(spark, args)
    names = ALL_MODELS if args.models is None else check_names([n for n in args.models.split(",") if n])
    if args.tables:
        source = args.tables
        if args.train_partitions:
            register_workbench(spark, source, Workbench(spark, source, args.seed, train_partitions=args.train_partitions), args.seed)
    else:
        if args.input.endswith(".parquet"):
            df = files.with_row_key(files.read_parquet_checked(spark, args.input))
        else:
            schema = {"infer": None, "payments": PAYMENTS_CSV_SCHEMA, "fixture": TXN_CSV_SCHEMA}[args.layout]
            df = files.read_labelled_csv(spark, args.input, schema, args.schema_sample)
        source = f"input:{args.input}"
        register_workbench(spark, source, Workbench(spark, None, args.seed, txn=df, train_partitions=args.train_partitions),
                           args.seed)
    out = run_job(spark, source, args.out, names, args.seed)
    print(json.dumps(out, indent=2, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
