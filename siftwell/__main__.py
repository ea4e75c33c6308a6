"""python -m siftwell: rank candidates, or run one of the tools."""

from __future__ import annotations

import argparse
import json
import sys

from siftwell.config import ConfigError, load, load_files, load_folder
from siftwell.plans import lifecycle, tools
from siftwell.plans.engine import Engine
from siftwell.plans.session import local_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siftwell", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("rank", help="rank a JSON lines file of candidates")
    r.add_argument("--candidates", required=True)
    r.add_argument("--out", help="official submission file")
    r.add_argument("--mode", choices=("baseline", "v2"), default="baseline")
    r.add_argument("--run-dir", default=None)
    r.add_argument("--config", action="append", default=[], help="overlay file, YAML or JSON; may be given again")
    r.add_argument("--config-dir", help="folder with a file for every bundle, as export-config writes it, in place of the defaults")
    r.add_argument("--reference-date")
    r.add_argument("--processing-mode", choices=("memory", "chunked"))
    r.add_argument("--malformed-threshold", type=int, default=10000)
    r.add_argument("--seed", type=int, default=42)
    r.add_argument("--resume", action="store_true")
    r.add_argument("--force", action="store_true")
    r.add_argument("--allow-small-sample", action="store_true")
    r.add_argument("--soft", action="store_true", help="keep rows that can't be explained instead of stopping")
    r.add_argument("--evidence-profile", action="store_true", help="write throughput and seconds of the evidence stage")
    r.add_argument("--log-level", choices=("DEBUG", "INFO", "WARN", "ERROR"), default="WARN", help="of Spark's own log")
    r.add_argument("--master", default="local[*]")
    for name, args in tools.COMMANDS.items():
        t = sub.add_parser(name, help=(getattr(tools, name.replace("-", "_")).__doc__ or "").split("\n")[0])
        for a in args:
            t.add_argument(a)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = local_session("siftwell")
    if a.command != "rank":
        values = [getattr(a, x) for x in tools.COMMANDS[a.command]]
        print(json.dumps(getattr(tools, a.command.replace("-", "_"))(spark, *values), indent=2, default=str))
        return 0
    try:
        if a.config_dir and a.config:
            raise ConfigError("--config-dir holds all bundles; overlays don't go with it")
        config = load_folder(a.config_dir) if a.config_dir else load_files(*a.config) if a.config else load()
        over = {k: v for k, v in (("reference_date", a.reference_date), ("processing_mode", a.processing_mode)) if v}
        if over:
            config = config.with_runtime(**over)
    except (ConfigError, OSError) as e:
        print(e, file=sys.stderr)
        return 2
    spark.sparkContext.setLogLevel(a.log_level)
    run_dir = a.run_dir or f"runs/{lifecycle.run_id()}"
    result = Engine(spark, run_dir, config, a.resume, a.force, a.seed, a.evidence_profile).run(a.candidates, a.out, a.mode, a.malformed_threshold, a.allow_small_sample, not a.soft)
    print(json.dumps({"run_dir": str(result.run_dir), "submission": str(result.official or result.submission), **result.stats}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
