"""The optional semantic side table: built from texts, loaded behind a manifest gate."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.config import Config
from siftwell.functions import columns as C
from siftwell.functions import fixed_values as V
from siftwell.sources import sinks
from siftwell.sources.store import place


def table_hash(df: DataFrame) -> str:
    """Content hash of a table that doesn't depend on the order of its rows or files."""
    r = df.select(F.xxhash64(*sorted(df.columns)).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("h").alias("x")).head()
    return hashlib.sha256(f"{sorted(df.columns)}:{r['n']}:{r['s']}:{r['x']}".encode()).hexdigest()


def id_checksum(ids: DataFrame) -> str:
    """Order-free checksum of a set of candidate ids."""
    return table_hash(ids.select("candidate_id"))


def resolve(run_dir: str | Path, config: Config) -> tuple[Path, Path]:
    """Artifact and manifest: absolute paths as they are, else below the run if either is there, else below the working folder."""
    pair = [place(config["semantic"][k]) for k in ("artifact_path", "manifest_path")]
    if all(p.is_absolute() for p in pair):
        return pair[0], pair[1]
    local = [p if p.is_absolute() else place(run_dir) / p for p in pair]
    return (local[0], local[1]) if any(p.exists() for p in local) else (pair[0].absolute(), pair[1].absolute())


def build(flat: DataFrame, run_dir: str | Path, config: Config, dataset_hash: str) -> DataFrame:
    """Lexical proxy scores of every candidate, with their manifest; relative paths are below the run."""
    artifact, manifest = (place(run_dir) / config["semantic"][k] for k in ("artifact_path", "manifest_path"))
    artifact.parent.mkdir(parents=True, exist_ok=True)
    scores = flat.select("candidate_id", C.r6(C.lexical_share(F.col("combined_candidate_text"), V.SEMANTIC_TERMS)).alias("semantic_score"))
    table = sinks.write_table(scores, str(artifact), ["candidate_id", "semantic_score"])
    sinks.write_json(manifest, {"source_dataset_hash": dataset_hash, "candidate_id_checksum": id_checksum(table), "resolved_config_hash": config.hash_of("semantic"), "output_artifact_hash": table_hash(table), "candidate_count": table.count(), "model_identifier": config["semantic"]["model_identifier"]})
    return table


def load(spark: SparkSession, run_dir: str | Path, config: Config, ids: DataFrame, dataset_hash: str) -> tuple[DataFrame | None, dict]:
    """(scores or None, status): ``disabled``, ``absent``, ``mismatch`` with its reasons, or ``loaded``."""
    if not config["semantic"]["enabled"]:
        return None, {"status": "disabled"}
    artifact, manifest = resolve(run_dir, config)
    if not artifact.exists() or not manifest.exists():
        return None, {"status": "absent"}
    said = json.loads(manifest.read_text(encoding="utf-8"))
    table = spark.read.parquet(str(artifact))
    checks = {
        "source_dataset_hash": dataset_hash,
        "candidate_id_checksum": id_checksum(ids),
        "resolved_config_hash": config.hash_of("semantic"),
        "output_artifact_hash": table_hash(table),
        "candidate_count": ids.count(),
    }
    wrong = [k for k, v in checks.items() if said.get(k) != v]
    if not wrong:
        mine, theirs = ids.select("candidate_id"), table.select("candidate_id")
        if mine.join(theirs, "candidate_id", "left_anti").limit(1).count() or theirs.join(mine, "candidate_id", "left_anti").limit(1).count():
            wrong = ["candidate_ids"]
    return (None, {"status": "mismatch", "mismatches": wrong}) if wrong else (table, {"status": "loaded"})
