"""Runs: folders, events, stage state, fingerprints and the decision to reuse a stage."""

from __future__ import annotations

import datetime as dt
import functools
import hashlib
import json
import platform
import subprocess
import sys
import time
from collections.abc import Callable
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siftwell.config import sha256_json
from siftwell.sources import sinks
from siftwell.sources.store import StorePath, append, place

FOLDERS = ("audit", "normalized", "evidence", "credibility", "behavioral", "scores", "reasoning", "submission", "reports", "logs", "state", "artifacts")
HISTORY = 5
#: Raised where a stage's outputs change their meaning while its code looks the same (1 where none is given).
STAGE_VERSIONS = {"normalize": 2, "evidence": 3, "credibility": 2, "behavioral": 2, "baseline": 2, "reasoning": 2}


def now() -> str:
    return dt.datetime.now(dt.timezone.utc).isoformat(timespec="milliseconds")


def run_id() -> str:
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def make_folders(run_dir: str | Path) -> Path | StorePath:
    for f in FOLDERS:
        (place(run_dir) / f).mkdir(parents=True, exist_ok=True)
    return place(run_dir)


#: Files up to this size are told by their bytes, larger ones and those of tables by name, length and time of change.
READ_BYTES = 1 << 20


def path_hash(path: str | Path) -> str:
    """Hash of a small file's bytes, read in parts."""
    h = hashlib.sha256()
    with place(path).open("rb") as b:
        while part := b.read(1 << 20):
            h.update(part)
    return h.hexdigest()


def output_mark(path: str | Path) -> str:
    """What tells a stage's output from a changed one, without reading a table."""
    p = place(path)
    if p.is_file() and p.stat().st_size <= READ_BYTES:
        return path_hash(p)
    files = sorted(f for f in p.rglob("*") if f.is_file() and not f.name.startswith((".", "_"))) if p.is_dir() else [p]
    return sha256_json([[f.relative_to(p).as_posix(), f.stat().st_size, f.stat().st_mtime_ns] for f in files])


def dataset_hash(spark: SparkSession, source: str | Path) -> str:
    """Hash of a text's lines, whatever their order and files: counted and hashed on the executors."""
    h = F.xxhash64("value")
    r = spark.read.text(str(source)).agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h), F.sum(F.length("value"))).head()
    return hashlib.sha256(":".join(map(str, r)).encode()).hexdigest()


@functools.cache
def code_hash() -> str:
    """Hash of the sources that stages run, so that results of other code aren't reused."""
    root, h = Path(__file__).resolve().parents[1], hashlib.sha256()
    for f in sorted(root.rglob("*.py")):
        if "llm" not in f.relative_to(root).parts:
            h.update(f.relative_to(root).as_posix().encode() + b"\0" + f.read_bytes())
    return h.hexdigest()


class Events:
    """Event lines for machines and a log for people."""

    def __init__(self, run_dir: str | Path, jsonl: bool = True, human: bool = True) -> None:
        self.folder, self.jsonl, self.human = place(run_dir) / "logs", jsonl, human
        self.folder.mkdir(parents=True, exist_ok=True)

    def __call__(self, stage: str, event: str, message: str = "", **data: Any) -> None:
        row = {"time": now(), "stage": stage, "event": event, "message": message, **data}
        if self.jsonl:
            append(self.folder / "events.jsonl", json.dumps(row, default=str) + "\n")
        if self.human:
            append(self.folder / "run.log", f"{row['time']} {stage} {event} {message}\n")


class Stages:
    """The stage attempts of a run, kept in ``state/state.json``."""

    def __init__(self, run_dir: str | Path) -> None:
        self.path = place(run_dir) / "state" / "state.json"
        self.state: dict[str, Any] = json.loads(self.path.read_text()) if self.path.exists() else {"stages": {}}

    def _save(self) -> None:
        sinks.write_json(self.path, self.state)

    def _of(self, stage: str) -> dict[str, Any]:
        return self.state["stages"].setdefault(stage, {"attempts": 0, "skips": 0, "total_seconds": 0.0, "history": []})

    def begin(self, stage: str, fingerprint: str, basis: str = "") -> None:
        s = self._of(stage)
        s.pop("marks", None)
        s |= {"status": "running", "fingerprint": fingerprint, "basis": basis, "attempts": s["attempts"] + 1, "started_at": now(), "began": time.time()}
        self._save()

    def end(self, stage: str, status: str, outputs: list[str | Path] = (), marks: dict | None = None, **metadata: Any) -> None:
        """``marks`` tell what each bucket of the stage's input held."""
        s = self._of(stage)
        if marks is not None:
            s["marks"] = marks
        took = round(time.time() - s.pop("began", time.time()), 3)
        s |= {"status": status, "finished_at": now(), "seconds": took, "total_seconds": round(s["total_seconds"] + took, 3), "outputs": {str(p): output_mark(p) for p in outputs}, "metadata": metadata}
        s["history"] = [*s["history"], {"status": status, "at": s["finished_at"], "seconds": took, "fingerprint": s.get("fingerprint")}][-HISTORY:]
        self._save()

    def skip(self, stage: str, reason: str) -> None:
        s = self._of(stage)
        s["skips"] += 1
        s["history"] = [*s["history"], {"status": "skipped", "at": now(), "reason": reason}][-HISTORY:]
        self._save()

    def reusable(self, stage: str, fingerprint: str) -> tuple[bool, str]:
        """Whether the last attempt still holds: completed, same fingerprint, outputs intact."""
        s = self.state["stages"].get(stage)
        if not s:
            return False, "never run"
        if s.get("status") != "completed":
            return False, f"last attempt {s.get('status')}"
        if s.get("fingerprint") != fingerprint:
            return False, "fingerprint differs"
        broken = self.intact(stage)
        return (True, "valid") if broken is None else (False, broken)

    def intact(self, stage: str) -> str | None:
        """Null if the stage's outputs are as it left them, else what is wrong with them."""
        for path, known in self.state["stages"].get(stage, {}).get("outputs", {}).items():
            if not place(path).exists():
                return f"output is missing: {path}"
            if output_mark(path) != known:
                return f"output has changed: {path}"
        return None

    def outputs_hash(self, stage: str) -> str:
        return sha256_json(self.state["stages"].get(stage, {}).get("outputs", {}))


class Runner:
    """Runs stages in order, reusing those that still hold; a rerun stage reruns all that follow from it."""

    def __init__(self, run_dir: str | Path, resume: bool = False, force: bool = False, events: Events | None = None) -> None:
        self.stages, self.resume, self.force, self.events = Stages(run_dir), resume, force, events or Events(run_dir)
        self.rerun: set[str] = set()
        #: Of a stage that runs: what each bucket of its input was when its outputs, still there, were made by the same code and configuration.
        self.carried: dict[str, dict | None] = {}

    def basis(self, stage: str, upstream: tuple[str, ...], config_hash: str, **extra: Any) -> str:
        """What a stage's rows follow from besides its input's rows: its own and its upstream stages' code and configuration."""
        above = {u: self.stages.state["stages"].get(u, {}).get("basis") for u in upstream}
        return sha256_json({"stage": stage, "version": STAGE_VERSIONS.get(stage, 1), "code": code_hash(), "config": config_hash, "upstream": above, **extra})

    def _carried(self, stage: str, basis: str) -> dict | None:
        s = self.stages.state["stages"].get(stage, {})
        if not self.resume or self.force or s.get("status") != "completed" or s.get("basis") != basis or not s.get("marks"):
            return None
        return s["marks"] if self.stages.intact(stage) is None else None

    def __call__(self, stage: str, upstream: tuple[str, ...], config_hash: str, work: Callable[[], tuple[list, dict]], **extra: Any) -> bool:
        """True if the stage ran."""
        fingerprint = sha256_json({"stage": stage, "version": STAGE_VERSIONS.get(stage, 1), "code": code_hash(), "config": config_hash, "upstream": {u: self.stages.outputs_hash(u) for u in upstream}, **extra})
        ok, why = self.stages.reusable(stage, fingerprint)
        moved = [u for u in upstream if u in self.rerun]
        if self.resume and not self.force and not moved and ok:
            self.stages.skip(stage, why)
            self.events(stage, "skipped", why)
            return False
        self.events(stage, "started", "forced" if self.force else f"upstream reran: {moved}" if moved else why)
        basis = self.basis(stage, upstream, config_hash, **{k: v for k, v in extra.items() if k != "input"})
        self.carried[stage] = self._carried(stage, basis)
        self.stages.begin(stage, fingerprint, basis)
        try:
            outputs, metadata = work()
        except BaseException as e:
            self.stages.end(stage, "failed", error=f"{type(e).__name__}: {e}"[:500])
            self.events(stage, "failed", str(e)[:500])
            raise
        self.stages.end(stage, "completed", outputs, **metadata)
        self.events(stage, "completed", **{"seconds": self.stages.state["stages"][stage]["seconds"], **{k: v for k, v in metadata.items() if k != "marks"}})
        self.rerun.add(stage)
        return True


def _git(*args: str) -> str | None:
    try:
        r = subprocess.run(["git", *args], capture_output=True, text=True, timeout=20, cwd=Path(__file__).parent)
    except (OSError, subprocess.TimeoutExpired):
        return None
    return r.stdout.strip() if r.returncode == 0 else None


def manifest(run_dir: str | Path, **data: Any) -> dict:
    """Environment and inputs of a run, kept in ``manifest.json``; later values go over earlier ones."""
    path = place(run_dir) / "manifest.json"
    old = json.loads(path.read_text()) if path.exists() else {
        "created_at": now(), "python": sys.version.split()[0], "platform": platform.platform(), "git_commit": _git("rev-parse", "HEAD"), "git_dirty": bool(_git("status", "--porcelain")),
    }
    sinks.write_json(path, old | data)
    return old | data
