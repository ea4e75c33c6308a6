"""Tools around runs: audits, comparisons, cohorts, timings."""

from __future__ import annotations

import json
import resource
import subprocess
import time
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from siftwell.config import load, write_folder
from siftwell.functions import columns as C
from siftwell.operators import audit as rules
from siftwell.operators import normalize, scoring, semantic, submission
from siftwell.plans import lifecycle
from siftwell.sources import buckets, candidates, sinks
from siftwell.sources.store import StorePath, place

#: command: positional arguments
COMMANDS = {
    "audit": ["candidates"], "inspect-top": ["run_dir"], "cohorts": ["run_dir"], "compare": ["before", "after"], "build-semantic": ["candidates", "run_dir"],
    "inspect-run": ["run_dir"], "timings": ["run_dir"], "same-output": ["run_dir", "other_dir"], "changes": ["current", "earlier"],
    "invariance": ["run_dir", "other_dir"], "export-release": ["run_dir", "target"], "export-breakdowns": ["run_dir", "target"], "export-config": ["target"],
}
RUNTIME_GATES = ((240.0, "PASS"), (270.0, "WARNING"))
SUBMISSION = "candidate_id string, rank int, score double, reasoning string"


def runtime_status(seconds: float) -> str:
    return next((s for most, s in RUNTIME_GATES if seconds <= most), "BLOCKED")


def audit(spark: SparkSession, path: str) -> dict:
    """Counters and profile of a candidate file, without a run."""
    records, issues, stats = candidates.scan(spark, path)
    found = rules.issue_rows(records, C.date_lit(load().reference_date)).select("type").unionByName(issues.select("type"))
    return {"stats": stats, **rules.summary(records, found)}


def inspect_top(spark: SparkSession, run_dir: str, n: int = 20) -> list[dict]:
    """Scores, credibility and explanations of a run's first rows."""
    top = spark.read.parquet(f"{run_dir}/scores/breakdown").where(F.col("rank") <= n)
    told = spark.read.parquet(f"{run_dir}/reasoning/explanations").select("candidate_id", "reasoning", "template_family")
    who = spark.read.parquet(f"{run_dir}/normalized/candidates").select("candidate_id", "current_title", "country", "years_of_experience")
    rows = top.join(told, "candidate_id", "left").join(F.broadcast(top.select("candidate_id")).join(who, "candidate_id"), "candidate_id").orderBy("rank")
    return [r.asDict() for r in rows.collect()]  # n rows


def cohorts(spark: SparkSession, run_dir: str, n: int = 100) -> dict:
    """Top rows by country, title and bands of the multipliers."""
    top = spark.read.parquet(f"{run_dir}/scores/breakdown").where(F.col("rank") <= n)
    who = top.join(spark.read.parquet(f"{run_dir}/normalized/candidates").select("candidate_id", "country", "current_title"), "candidate_id")
    count = lambda c: {r[c]: r["n"] for r in who.groupBy(c).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), c).collect()}
    return {**scoring.cohort(top), "countries": count("country"), "titles": count("current_title")}


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=SUBMISSION, multiLine=True, escape='"')


def compare(spark: SparkSession, before: str, after: str) -> dict:
    """Entrants, exits and rank moves between two submissions."""
    a, b = read_submission(spark, before).select("candidate_id", F.col("rank").alias("before")), read_submission(spark, after).select("candidate_id", F.col("rank").alias("after"))
    ids = lambda df: [r[0] for r in df.orderBy("candidate_id").collect()]
    moved = a.join(b, "candidate_id").withColumn("delta", F.abs(F.col("before") - F.col("after"))).orderBy(F.desc("delta"), "candidate_id")
    only = lambda x, y: x.select("candidate_id").exceptAll(y.select("candidate_id"))
    return {"entrants": ids(only(b, a)), "exits": ids(only(a, b)), "moves": [r.asDict() for r in moved.collect()]}


def changes(spark: SparkSession, current: str, earlier: str, limit: int = 20) -> list[dict]:
    """The first rows of a submission whose rank or score another one lacks; -1 where it lacks the row."""
    now = read_submission(spark, current).select("candidate_id", "rank", "score")
    old = read_submission(spark, earlier).select("candidate_id", F.col("rank").alias("old_rank"), F.col("score").alias("old_score"))
    j = now.join(old, "candidate_id", "left").fillna(-1, ["old_rank"]).fillna(-1.0, ["old_score"])
    return [r.asDict() for r in j.where("rank <> old_rank or score <> old_score").orderBy("rank").limit(limit).collect()]


def build_semantic(spark: SparkSession, path: str, run_dir: str) -> dict:
    """Build the semantic side table of a candidate file below a run folder."""
    config = load({"semantic": {"enabled": True}})
    records = candidates.valid_records(candidates.parse(candidates.read_lines(spark, path)))
    flat = normalize.normalized(records, C.date_lit(config.reference_date), with_hash=False)
    table = semantic.build(flat, run_dir, config, lifecycle.dataset_hash(spark, path))
    return {"rows": table.count(), "hash": semantic.table_hash(table)}


def inspect_run(spark: SparkSession, run_dir: str) -> dict:
    """A run's manifest and stage state."""
    read = lambda p: json.loads(p.read_text()) if p.exists() else None
    return {"manifest": read(place(run_dir) / "manifest.json"), "state": read(place(run_dir) / "state" / "state.json")}


def timings(spark: SparkSession, run_dir: str) -> dict:
    """Stage seconds and attempts of a run, with its gate."""
    stages = json.loads((place(run_dir) / "state" / "state.json").read_text())["stages"]
    total = sum(s.get("seconds", 0.0) for s in stages.values())
    return {"stages": {k: {"seconds": s.get("seconds"), "attempts": s["attempts"], "skips": s["skips"]} for k, s in stages.items()}, "total_seconds": round(total, 3), "status": runtime_status(total)}


def timed(work: Callable[[], object]) -> dict:
    """Wall seconds of a piece of work and its gate."""
    began = time.perf_counter()
    work()
    took = time.perf_counter() - began
    return {"seconds": round(took, 3), "status": runtime_status(took)}


#: Parts of a comparison, by a hash of the key.
COMPARED_PARTS = 1024


def differing(a: DataFrame, b: DataFrame, key: str, parts: int = COMPARED_PARTS) -> tuple[DataFrame, DataFrame, int]:
    """Rows of two tables with the same columns in those parts of the keys in which the tables differ, and the number of these parts.

    Parts are told by counts and order-free hashes of their rows, which are added
    up where the rows are; only rows of parts that differ are compared further.
    """
    whole = F.struct(*[c for c in a.columns if c != key])
    odd = buckets.changed(*(buckets.marks(df, key, whole, parts) for df in (a, b)))
    mine = buckets.bucket_of(key, parts).isin(odd) if odd else F.lit(False)
    return a.where(mine), b.where(mine), len(odd)


def same_output(spark: SparkSession, run_dir: str, other_dir: str) -> dict:
    """Whether two runs, of two environments perhaps, have the same scores (as rows, in any order) and the same submission bytes.

    ``columns`` tells for each shared column how many candidates differ in it and, for numbers, by how much at most.
    Rows are compared only where the tables' hashes by parts of the ids differ.
    """
    a, b = (spark.read.parquet(f"{d}/scores/breakdown") for d in (run_dir, other_dir))
    shared = [c for c in a.columns if c in b.columns]
    x, y, parts = differing(a.select(*shared), b.select(*shared), "candidate_id")
    values = [c for c in shared if c != "candidate_id"]
    both = x.select("candidate_id", F.struct(*values).alias("x")).join(y.select("candidate_id", F.struct(*values).alias("y")), "candidate_id")
    number = {f.name for f in x.schema.fields if isinstance(f.dataType, NumericType)}
    differs = [F.count_if(~F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))).alias(f"n_{c}") for c in values]
    most = [F.max(F.abs(F.col(f"x.{c}") - F.col(f"y.{c}"))).alias(f"m_{c}") for c in values if c in number]
    told = both.agg(*differs, *most).head().asDict()
    made = [json.loads(p.read_text()) if (p := place(d) / "manifest.json").exists() else {} for d in (run_dir, other_dir)]
    files = [sorted((place(d) / "submission").glob("*.csv")) for d in (run_dir, other_dir)]
    return {
        "same_columns": a.columns == b.columns,
        "only_first": x.exceptAll(y).count(),
        "only_second": y.exceptAll(x).count(),
        "differing_parts": parts,
        "columns": {c: {"differing": told[f"n_{c}"], "largest_difference": told.get(f"m_{c}")} for c in values},
        "environments": {k: [m.get(k) for m in made] for k in ("python", "platform", "git_commit", "git_dirty", "config", "input")},
        "same_submission": bool(files[0]) and [f.read_bytes() for f in files[0]] == [f.read_bytes() for f in files[1]],
    }


def export_config(spark: SparkSession, target: str) -> list[str]:
    """The default configuration as a folder of YAML files, one a bundle, for ``rank --config-dir``."""
    return [str(p) for p in write_folder(load(), target)]


BREAKDOWNS = {"evidence": "evidence/summary", "credibility": "credibility/breakdown", "behavioral": "behavioral/breakdown"}


def export_breakdowns(spark: SparkSession, run_dir: str, target: str) -> dict:
    """A run's three breakdowns as CSV files in the order of the ids; lists are written as JSON."""
    out = {}
    for name, table in BREAKDOWNS.items():
        df = spark.read.parquet(f"{run_dir}/{table}")
        lists = [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]
        rows = df.withColumns({c: F.to_json(c) for c in lists}).orderBy("candidate_id")
        sinks.write_table(rows, f"{target}/{name}", ["candidate_id"], fmt="csv")
        out[name] = df.count()
    return out


def measured(command: Sequence[str]) -> dict:
    """Run a command as a child: exit code, wall seconds, gate and the largest memory of any child in MB."""
    began = time.perf_counter()
    code = subprocess.run(list(command), check=False).returncode
    took = time.perf_counter() - began
    peak = resource.getrusage(resource.RUSAGE_CHILDREN).ru_maxrss / 1024
    return {"exit_code": code, "seconds": round(took, 3), "status": runtime_status(took) if code == 0 else "BLOCKED", "peak_memory_mb": round(peak, 1)}


def _submission_of(run_dir: str) -> Path | StorePath | None:
    return next(iter(sorted((place(run_dir) / "submission").glob("*.csv"))), None)


def invariance(spark: SparkSession, run_dir: str, other_dir: str, resume_seconds: float | None = None) -> dict:
    """Whether a run still gives what another gave: scores as rows, submission bytes, changed rows, timings and gates."""
    here, there = _submission_of(run_dir), _submission_of(other_dir)
    quality = place(run_dir) / "reports" / "reasoning_quality.json"
    return {
        **same_output(spark, run_dir, other_dir),
        "submission_sha256": {"run": here and lifecycle.path_hash(here), "other": there and lifecycle.path_hash(there)},
        "changed_rows": changes(spark, str(here), str(there)) if here and there else None,
        "submission_problems": submission.problems(here) if here else ["no submission"],
        "explanations": json.loads(quality.read_text())["explanation_quality_status"] if quality.exists() else None,
        "timings": timings(spark, run_dir),
        "resume_seconds": resume_seconds,
    }


def export_release(spark: SparkSession, run_dir: str, target: str) -> dict:
    """Copy a run's valid submission, manifest and reports to a folder, with a hash beside each and the validator's result."""
    source = _submission_of(run_dir)
    if source is None:
        raise sinks.SinkError(f"{run_dir} has no submission")
    submission.require_valid(source)
    out = place(target)
    files = [source, place(run_dir) / "manifest.json", *sorted((place(run_dir) / "reports").glob("*"))]
    hashes = {}
    for f in files:
        sinks.copy(f, out / f.name)
        hashes[f.name] = lifecycle.path_hash(out / f.name)
        sinks.write_text(out / f"{f.name}.sha256", f"{hashes[f.name]}  {f.name}\n")
    sinks.write_text(out / "validator.txt", "valid\n")
    manifest = {"files": hashes, "rows": submission.LIMIT, "timings": timings(spark, run_dir)}
    sinks.write_json(out / "release_manifest.json", manifest)
    sinks.write_text(out / "release_manifest.md", "# Release\n\n" + "".join(f"- {k}: {v}\n" for k, v in hashes.items()))
    return manifest
