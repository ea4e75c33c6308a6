"""The ranking runs: baseline and evidence-based, over JSON lines of candidate records.

Each stage's result is a table below the run folder; everything within a stage
is one lazy plan. The input's JSON is parsed once, by the audit; the normalized
table carries the nested context columns too.

From the normalized table on, tables of candidates are bucketed by id: stages
that join them need no exchange. The stages between normalization and ranking
work row by row, so that where only some buckets of the input have changed since
their last run, only these are made anew. Counts and means of the reports are
observed while a table is written.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siftwell.config import Config, load
from siftwell.functions import columns as C
from siftwell.operators import audit, credibility, evidence, explain, normalize, scoring, semantic, submission
from siftwell.plans import lifecycle
from siftwell.plans.session import prepare
from siftwell.sources import buckets, candidates, sinks
from siftwell.sources.store import StorePath, place

KEY = "candidate_id"


class DuplicateCandidates(ValueError):
    """The input repeats candidate ids."""


class TooFewCandidates(ValueError):
    """Fewer candidates than a submission has rows."""


@dataclass
class Result:
    run_dir: Path | StorePath
    submission: Path | StorePath | None
    official: Path | StorePath | None
    stats: dict


class Engine:
    def __init__(self, spark: SparkSession, run_dir: str | Path, config: Config | None = None, resume: bool = False, force: bool = False, seed: int = 42, profiled: bool = False) -> None:
        self.profiled = profiled
        self.spark, self.config, self.seed = prepare(spark), config or load(), seed
        self.dir = lifecycle.make_folders(run_dir)
        self.runner = lifecycle.Runner(self.dir, resume, force)
        self.reference = C.date_lit(self.config.reference_date)
        # A stage reads one bucket a task, and so writes one, whether or not its own plan groups by the key.
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")

    def path(self, name: str) -> str:
        return str(self.dir / name)

    def table(self, name: str) -> DataFrame:
        bucketed = buckets.layout(self.spark, self.path(name))
        return buckets.read(self.spark, self.path(name)) if bucketed else self.spark.read.parquet(self.path(name))

    def part(self, name: str, only: list[int] | None) -> DataFrame:
        """A bucketed table, or the rows of some of its buckets."""
        return self.table(name) if only is None else buckets.read(self.spark, self.path(name), only)

    def put(self, name: str, df: DataFrame, only: list[int] | None = None, required: Sequence[str] = (KEY,), rows: int | None = None, told: dict[str, Column] | None = None) -> dict:
        """Write a bucketed table (or ``only`` some of its buckets) and give the figures ``told`` of the whole one.

        Of a whole table they are observed by the job that writes it.
        """
        seen = Observation() if told and only is None else None
        marked = df.observe(seen, *[c.alias(n) for n, c in told.items()]) if seen else df
        buckets.write(marked, self.path(name), KEY, self.buckets(), required, rows, only)
        if seen:
            return seen.get
        return self.table(name).agg(*[c.alias(n) for n, c in told.items()]).head().asDict() if told else {}

    def buckets(self) -> int:
        return self.runner.stages.state["buckets"]

    def rows(self) -> int:
        """Rows of the normalized table."""
        return self.runner.stages.state["stages"]["normalize"]["metadata"]["rows"]

    def marks(self) -> dict:
        return self.runner.stages.state["stages"]["normalize"]["marks"]

    def changed(self, stage: str) -> list[int] | None:
        """Buckets of the input that have changed since the stage's outputs were made; null if all have to be made."""
        before = self.runner.carried.get(stage)
        return None if before is None else buckets.changed(before, self.marks())

    def of_top(self, name: str, top: DataFrame) -> DataFrame:
        """The rows of a bucketed table whose ids are in ``top`` (at most some hundred rows): only their buckets' files are read."""
        ids = top.select(KEY)
        only = [r[0] for r in ids.select(buckets.bucket_of(KEY, self.buckets())).distinct().collect()]
        return buckets.read(self.spark, self.path(name), only).join(F.broadcast(ids), KEY, "left_semi")

    def _stage(self, name: str, upstream: tuple[str, ...], work, **extra) -> None:
        self.runner(name, upstream, self.config.stage_hash(name), work, seed=self.seed, input=self.input_hash, **extra)

    def _by_buckets(self, name: str, upstream: tuple[str, ...], work) -> None:
        """A stage that works row by row: ``work`` gets the buckets to make (null: all)."""

        def made():
            only = self.changed(name)
            outputs, metadata = work(only)
            return outputs, metadata | {"rewritten_buckets": self.buckets() if only is None else len(only), "marks": self.marks()}

        self._stage(name, upstream, made, buckets=self.buckets())

    # -- stages -------------------------------------------------------------------------------------------------------

    def audit(self, source: str, malformed_threshold: int, allow_duplicates: bool = False) -> None:
        def work():
            parsed = sinks.write_table(candidates.parse(candidates.read_lines(self.spark, source)), self.path("audit/parsed"), ["candidate_id"])
            records, issues, stats = candidates.check(parsed, malformed_threshold)
            records = audit.with_issues(records, self.reference).persist()  # keep-first and rules once for all counts
            columns = ["file", "row_num", "candidate_id", "type", "severity"]
            none = F.lit(None).cast("string")
            fired = audit.exploded(records).select(*columns, "reason", none.alias("field"))
            rows = sinks.write_table(issues.select(*columns, none.alias("reason"), "field").unionByName(fired), self.path("audit/issues"), columns)
            profile = audit.summary(records, rows)
            records.unpersist()
            fields = {r["field"]: r["n"] for r in rows.where("field is not null").groupBy("field").agg(F.count(F.lit(1)).alias("n")).collect()}
            out = [sinks.write_json(self.path("audit/audit_summary.json"), {"stats": stats, "missing_fields": fields, "issue_counts": profile["issue_counts"]})]
            out.append(sinks.write_json(self.path("audit/field_profile.json"), profile))
            out.append(sinks.write_text(self.path("audit/audit_summary.md"), report("Audit", {**stats, **profile["issue_counts"]})))
            if stats["duplicate"] and not allow_duplicates:
                raise DuplicateCandidates(f"{stats['duplicate']} rows repeat a candidate id")
            return [self.path("audit/parsed"), self.path("audit/issues"), *out], stats

        self._stage("audit", (), work)

    def normalize(self, source: str) -> None:
        """The normalized table, in buckets by id. Both processing modes are one plan: partitions stand for chunks."""

        def work():
            audited = "audit" in self.runner.stages.state["stages"]
            parsed = self.table("audit/parsed") if audited else candidates.parse(candidates.read_lines(self.spark, source))
            lines = self.runner.stages.state["stages"]["audit"]["metadata"]["total"] if audited else parsed.count()
            before = buckets.layout(self.spark, self.path("normalized/candidates")) or {}
            self.runner.stages.state["buckets"] = n = buckets.buckets_for(lines, before.get("buckets"))
            rows = normalize.normalized(candidates.valid_records(parsed, n), self.reference)
            told = self.put("normalized/candidates", rows.drop("file", "row_num"), required=normalize.FLAT, told={"rows": F.count(F.lit(1)), "without_context": F.count_if(F.col("profile").isNull())})
            summary = sinks.write_json(self.path("normalized/summary.json"), {"normalized_rows": told["rows"], "processing_mode": self.config["runtime"]["processing_mode"]})
            marks = buckets.marks(self.table("normalized/candidates"), KEY, F.col("candidate_record_hash"), n)
            return [self.path("normalized/candidates"), summary], {"rows": told["rows"], "without_context": told["without_context"], "marks": marks}

        self._stage("normalize", ("audit",) if "audit" in self.runner.stages.state["stages"] else (), work)

    def evidence(self) -> None:
        def work(only):
            began = time.perf_counter()
            graded = evidence.with_graded(self.part("normalized/candidates", only), self.config, self.reference).select(KEY, "graded")
            self.put("evidence/graded", graded, only, rows=self.rows())
            self.put("evidence/ledger", evidence.ledger_rows(self.part("evidence/graded", only)), only, evidence.LEDGER)
            made = time.perf_counter()
            told = {"n": F.count(F.lit(1)), "items": F.sum("evidence_item_count"), "none": F.count_if(F.col("evidence_item_count") == 0), "corroboration": F.avg("skill_corroboration_score")}
            r = self.put("evidence/summary", evidence.summary(self.part("evidence/graded", only)), only, rows=self.rows(), told=told)
            r |= self.without_context()
            out = [sinks.write_text(self.path("reports/evidence_report.md"), report("Evidence", r))]
            if self.profiled:
                took = {"ledger_seconds": made - began, "summary_seconds": time.perf_counter() - made}
                rates = {"candidates_a_second": r["n"] / took["ledger_seconds"], "items_a_second": (r["items"] or 0) / took["ledger_seconds"]}
                by_source = {x["source_type"]: x["count"] for x in self.table("evidence/ledger").groupBy("source_type").count().collect()}
                out.append(sinks.write_json(self.path("reports/evidence_profile.json"), {k: round(v, 3) for k, v in (took | rates).items()} | {"items_by_source": by_source}))
            return [*map(self.path, ("evidence/graded", "evidence/ledger", "evidence/summary")), *out], {"rows": r["n"], "items": r["items"]}

        self._by_buckets("evidence", ("normalize",), work)

    def without_context(self, named: int = 20) -> dict:
        """Candidates without a profile to take evidence from: how many, and the first of them."""
        n = self.runner.stages.state["stages"]["normalize"]["metadata"]["without_context"]
        ids = [r[0] for r in self.table("normalized/candidates").where("profile is null").select(KEY).orderBy(KEY).limit(named).collect()] if n else []
        return {"without_context": n, "without_context_ids": ids}

    def credibility(self) -> None:
        def work(only):
            rows = credibility.with_triggers(self.part("normalized/candidates", only), self.part("evidence/summary", only), self.config, self.reference)
            self.put("credibility/triggers", rows.select(KEY, "triggers", *credibility.RISKS), only, rows=self.rows())
            told = {"n": F.count(F.lit(1)), "mean_multiplier": F.avg("credibility_multiplier"), "triggers": F.sum("triggered_rule_count")}
            r = self.put("credibility/breakdown", credibility.breakdown(self.part("credibility/triggers", only), self.config), only, rows=self.rows(), told=told)
            md = sinks.write_text(self.path("reports/credibility_report.md"), report("Credibility", r))
            return [self.path("credibility/triggers"), self.path("credibility/breakdown"), md], {"rows": r["n"]}

        self._by_buckets("credibility", ("normalize", "evidence"), work)

    def behavioral(self) -> None:
        def work(only):
            made = scoring.availability(self.part("normalized/candidates", only), self.part("evidence/summary", only), self.config, self.reference)
            r = self.put("behavioral/breakdown", made, only, rows=self.rows(), told={"n": F.count(F.lit(1)), "mean_multiplier": F.avg("availability_multiplier")})
            md = sinks.write_text(self.path("reports/behavioral_report.md"), report("Availability", r))
            return [self.path("behavioral/breakdown"), md], {"rows": r["n"]}

        self._by_buckets("behavioral", ("normalize", "evidence"), work)

    def scores(self) -> None:
        def work():
            flat = self.table("normalized/candidates")
            side, status = semantic.load(self.spark, self.dir, self.config, flat, self.input_hash)
            scored = scoring.final_scores(flat, self.table("evidence/summary"), self.table("credibility/breakdown"), self.table("behavioral/breakdown"), self.config, side)
            out = sinks.write_table(scoring.rank_all(scored), self.path("scores/breakdown"), ["candidate_id", "rank"], rows=self.rows())
            top = sinks.write_table(out.where(F.col("rank") <= 1000), self.path("scores/top_1000"), ["candidate_id"])
            done = [sinks.write_json(self.path("scores/semantic_status.json"), status), sinks.write_json(self.path("reports/cohort.json"), scoring.cohort(top.where(F.col("rank") <= 100)))]
            return [self.path("scores/breakdown"), self.path("scores/top_1000"), *done], {"rows": self.rows(), "semantic": status["status"]}

        self._stage("scores", ("normalize", "evidence", "credibility", "behavioral"), work)

    def reasoning(self, strict: bool = True, limit: int = submission.LIMIT) -> None:
        def work():
            top = self.table("scores/breakdown").where(F.col("rank") <= limit)
            self.verify_provenance(top)
            made = explain.explanations(top, self.of_top("evidence/ledger", top), self.of_top("normalized/candidates", top), strict)
            table = sinks.write_table(made, self.path("reasoning/explanations"), ["candidate_id", "reasoning"])
            rows = [r.asDict() for r in table.collect()]  # at most ``limit`` rows
            found = explain.quality_report(rows)
            out = [sinks.write_jsonl(self.path("reasoning/explanations.jsonl"), sorted(rows, key=lambda r: r["rank"])), sinks.write_json(self.path("reports/reasoning_quality.json"), found)]
            out.append(sinks.write_text(self.path("reports/reasoning_quality.md"), report("Explanations", {k: v for k, v in found.items() if isinstance(v, (int, str))})))
            return [self.path("reasoning/explanations"), *out], {"rows": len(rows), "quality": found["explanation_quality_status"]}

        self._stage("reasoning", ("scores", "evidence"), work)

    def verify_provenance(self, top: DataFrame) -> None:
        """Every excerpt that a ranked row may quote must be what its source path holds in the row's own context."""
        quoted = self.of_top("evidence/ledger", top).select("candidate_id", "evidence_id", "source_path", "exact_source_excerpt")
        context = self.of_top("normalized/candidates", top).select("candidate_id", "profile", "career_history", "skills", "skill_assessments")
        wrong = quoted.join(context, "candidate_id").where(~evidence.reconstructible(F.col("source_path"), F.col("exact_source_excerpt"))).select("evidence_id").limit(5).collect()
        if wrong:
            raise ValueError(f"evidence that its context doesn't hold: {[r[0] for r in wrong]}")

    def baseline(self) -> None:
        def work(only):
            self.put("scores/baseline", scoring.baseline_scores(self.part("normalized/candidates", only), self.config), only, rows=self.rows())
            top = sinks.write_table(scoring.rank_top(self.table("scores/baseline"), 500), self.path("scores/baseline_top_500"), ["candidate_id"])
            return [self.path("scores/baseline"), self.path("scores/baseline_top_500")], {"rows": self.rows(), "top": top.count()}

        self._by_buckets("baseline", ("normalize",), work)

    def submit(self, out: str | Path | None, mode: str, small: bool) -> tuple[Path | StorePath, Path | StorePath | None]:
        if mode == "baseline":
            top = self.table("scores/baseline_top_500").where(F.col("rank") <= submission.LIMIT)
            explained = top.select("candidate_id", scoring.baseline_explanation().alias("reasoning"))
        else:
            top, explained = self.table("scores/breakdown").where(F.col("rank") <= submission.LIMIT), self.table("reasoning/explanations")
        path = place(self.path(f"submission/{'sample_' if small else ''}submission.csv"))

        def work():
            submission.write(submission.rows_of(top, explained), path, require=not small)
            return [path], {}

        self._stage("submission", ("baseline",) if mode == "baseline" else ("scores", "reasoning"), work)
        official = None
        if out and not small:
            official = sinks.copy(path, out, check=lambda p: submission.require_valid(p, name=str(out)))
        return path, official

    def run(self, source: str | Path, out: str | Path | None = None, mode: str = "v2", malformed_threshold: int = 10000, allow_small_sample: bool = False, strict: bool = True) -> Result:
        """All stages of a mode. A sample of under a hundred candidates needs ``allow_small_sample`` and gives no official file."""
        self.input_hash = lifecycle.dataset_hash(self.spark, source)
        lifecycle.manifest(self.dir, status="running", mode=mode, input={"path": str(source), "row_hash": self.input_hash}, config={b: self.config.hash_of(b) for b in self.config.data}, seed=self.seed)
        try:
            self.audit(str(source), malformed_threshold)
            self.normalize(str(source))
            n = self.rows()
            small = n < submission.LIMIT
            if small and not allow_small_sample:
                raise TooFewCandidates(f"{n} candidates; {submission.LIMIT} are needed")
            if mode == "baseline":
                self.baseline()
            else:
                self.evidence()
                self.credibility()
                self.behavioral()
                self.scores()
                self.reasoning(strict)
            path, official = self.submit(out, mode, small)
        except BaseException as e:
            lifecycle.manifest(self.dir, status="failed", error=f"{type(e).__name__}: {e}"[:500], finished_at=lifecycle.now())
            raise
        seconds = {k: s.get("seconds") for k, s in self.runner.stages.state["stages"].items()}
        lifecycle.manifest(self.dir, status="completed", finished_at=lifecycle.now(), stage_seconds=seconds, submission=str(official or path))
        return Result(self.dir, path, official, {"candidates": n, "stage_seconds": seconds})


def report(title: str, values: dict) -> str:
    return f"# {title}\n\n" + "".join(f"- {k}: {v}\n" for k, v in values.items())


def rank_records(spark: SparkSession, payload: bytes, filename: str, work_dir: str | Path, config: Config | None = None) -> dict:
    """Rank an uploaded file of up to a hundred records: rows with components, evidence excerpts and the CSV text.

    The reference date is the configuration's, so a result can be made again.
    """
    rows = candidates.decode_upload(payload, filename)
    source = sinks.write_jsonl(place(work_dir) / "upload.jsonl", rows)
    engine = Engine(spark, place(work_dir) / "run", config)
    engine.input_hash = lifecycle.dataset_hash(spark, source)
    engine.normalize(str(source))
    engine.evidence()
    engine.credibility()
    engine.behavioral()
    engine.scores()
    engine.reasoning(strict=False)
    path, _ = engine.submit(None, "v2", small=True)
    scores, told = engine.table("scores/breakdown"), engine.table("reasoning/explanations").select("candidate_id", "reasoning", "grounding_evidence_ids")
    parts = [c for c in engine.table("behavioral/breakdown").columns if c.endswith("_component")]
    joined = scores.join(told, "candidate_id", "left").join(engine.table("behavioral/breakdown").select("candidate_id", *parts), "candidate_id")
    ids = joined.select("candidate_id", F.explode(C.json_list("grounding_evidence_ids")).alias("evidence_id")).distinct()
    quoted: dict[str, list] = {}
    for r in ids.join(engine.table("evidence/ledger"), ["candidate_id", "evidence_id"]).select("candidate_id", "normalized_category", "source_path", "exact_source_excerpt").collect():
        quoted.setdefault(r["candidate_id"], []).append({"category": r["normalized_category"], "source": r["source_path"], "excerpt": r["exact_source_excerpt"]})
    out = []
    for r in joined.orderBy("rank").collect():  # at most a hundred uploaded records
        d = r.asDict()
        components = {k: d[k] for k in d if k.endswith(("_score", "_multiplier", "_component"))}
        out.append({"candidate_id": d["candidate_id"], "rank": d["rank"], "score": d["final_score"], "reasoning": d["reasoning"] or "", "components": components, "evidence": quoted.get(d["candidate_id"], [])})
    return {"rows": out, "csv": path.read_text(encoding="utf-8"), "events": json.loads(json.dumps(engine.runner.stages.state))}
