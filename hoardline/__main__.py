"""``python -m hoardline <job> --tables <folder> --out <folder> [--set name=value …]``"""

import argparse

from pyspark.sql import SparkSession

from hoardline.plans.jobs import JOBS, run
from hoardline.session import COMMON


def main() -> None:
    parser = argparse.ArgumentParser(prog="hoardline")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--tables", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--set", action="append", default=[], metavar="name=value")
    arguments = parser.parse_args()
    builder = SparkSession.builder.appName(f"hoardline-{arguments.job}")
    for key, value in COMMON.items():
        builder = builder.config(key, value)
    options = dict(option.split("=", 1) for option in arguments.set)
    run(builder.getOrCreate(), arguments.job, arguments.tables, arguments.out, **options)


if __name__ == "__main__":
    main()
