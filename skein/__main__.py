"""``python -m skein normalize|validate|inspect``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .plans.normalize import normalize
from .sources import sinks
from .sources.envelopes import FORMATS


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="skein", description="Captures of language-model calls to audited trajectories.")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("normalize", help="read captures, publish trajectories")
    run.add_argument("--input", required=True)
    run.add_argument("--input-format", choices=sorted(FORMATS), default="freerouter")
    run.add_argument("--output", required=True)
    run.add_argument("--work", required=True, help="folder for parsed captures")
    run.add_argument("--resume", action="store_true", help="parse only what is new or changed")
    check = commands.add_parser("validate", help="check what was published")
    check.add_argument("--output", required=True)
    look = commands.add_parser("inspect", help="the lineage of a trajectory")
    look.add_argument("--output", required=True)
    look.add_argument("trajectory")
    own = parser.parse_args(args)
    spark = SparkSession.builder.appName("skein").getOrCreate()
    if own.command == "normalize":
        made = normalize(spark, own.input, own.input_format, own.work, own.resume)
        print(json.dumps(sinks.publish(spark, made, own.output, own.input, own.input_format)["counts"], sort_keys=True))
        return 0
    if own.command == "validate":
        errors = sinks.validate(spark, own.output)
        print(json.dumps({"valid": not errors, "errors": errors}))
        return int(bool(errors))
    found = sinks.inspect(spark, own.output, own.trajectory)
    print(json.dumps(found))
    return int(found is None)


if __name__ == "__main__":
    sys.exit(main())
