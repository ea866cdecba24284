"""python -m tablemill list | run JOB [--name value]: arguments come from the job's defaults (UDF-7)."""

from __future__ import annotations

import argparse
import json
import sys

from tablemill.jobs import registry


def main(argv: list[str] | None = None) -> int:
    jobs = registry()
    parser = argparse.ArgumentParser(prog="tablemill")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list")
    run = commands.add_parser("run").add_subparsers(dest="job", required=True)
    for name, job in sorted(jobs.items()):
        p = run.add_parser(name)
        for k, v in job.default_args.items():
            p.add_argument(f"--{k.replace('_', '-')}", default=v, type=type(v) if v is not None else str)
    args = vars(parser.parse_args(argv))
    if args.pop("command") == "list":
        print("\n".join(f"{n}\t{j.scope}" for n, j in sorted(jobs.items())))
        return 0
    from pyspark.sql import SparkSession

    result = jobs[args.pop("job")](SparkSession.builder.getOrCreate()).execute(**args)
    print(json.dumps(result.to_dict()))
    return int(not result.success)


if __name__ == "__main__":
    sys.exit(main())
