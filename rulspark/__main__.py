"""``python -m rulspark STAGE --base FOLDER --snapshotdate YYYY-MM-DD``."""

from __future__ import annotations

import argparse
import ast

from rulspark.plans.stages import STAGES, Lake, pending, run
from rulspark.session import build_session


def _numbers(text: str) -> list[int]:
    return [int(x) for x in text.split(",") if x.strip()]


def _setting(text: str) -> tuple[str, object]:
    name, given, value = text.partition("=")
    if not given or not name.isidentifier():
        raise argparse.ArgumentTypeError(f"{text!r} is not NAME=VALUE")
    try:
        return name, ast.literal_eval(value)
    except (SyntaxError, ValueError):
        return name, value


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="rulspark")
    parser.add_argument("stage", choices=[*STAGES, "pending-tabular", "pending-sequence"])
    parser.add_argument("--base", required=True, help="root folder of the lake")
    parser.add_argument("--snapshotdate", help="YYYY-MM-DD")
    parser.add_argument("--no-partition", action="store_true", help="label-base: by snapshot only")
    parser.add_argument("--aux-layout", default="with_dataset", help="silver: layout of the id array")
    parser.add_argument("--forecaster", choices=["linear", "reservoir"], default="linear", help="sequence stages")
    parser.add_argument("--no-target-lags", action="store_true", help="sequence stages: past labels are no input")
    parser.add_argument("--train-sets", type=_numbers, help="split: datasets to train on, as 1,2,3")
    parser.add_argument("--oot-sets", type=_numbers, default=[], help="split: datasets kept out of time")
    parser.add_argument(
        "--param", type=_setting, action="append", default=[], metavar="NAME=VALUE", help="training stages: a model's setting"
    )
    args = parser.parse_args(argv)

    spark = build_session()
    if args.stage.startswith("pending-"):
        print("\n".join(pending(Lake(spark, args.base), args.stage.split("-")[1])))
        return
    if not args.snapshotdate:
        parser.error("--snapshotdate is required")
    options = {}
    if args.stage == "label-base":
        options["partitioned"] = not args.no_partition
    if args.stage == "silver":
        options["aux_layout"] = args.aux_layout
    if args.stage in ("train-sequence", "forecast-sequence"):
        options.update(forecaster=args.forecaster, include_target_lags=not args.no_target_lags)
    if args.stage == "split":
        options.update(train_sets=args.train_sets, oot_sets=args.oot_sets)
    if args.stage in ("train-tabular", "train-sequence"):
        options.update(args.param)
    elif args.param:
        parser.error(f"{args.stage} takes no --param")
    print(run(spark, args.base, args.stage, args.snapshotdate, **options))


if __name__ == "__main__":
    main()
