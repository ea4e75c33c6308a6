import csv
import json
import shutil

import pytest
from pyspark.sql import functions as F
import records as R

from siftwell.config import ConfigError, load, load_files, load_folder, write_folder
from siftwell.operators import credibility, evidence, scoring, submission
from siftwell.plans import tools
from siftwell.plans.engine import DuplicateCandidates, Engine, TooFewCandidates, rank_records
from siftwell.sources.sinks import SinkError
from siftwell.sources.store import place
from siftwell.streaming import incremental


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("run")
    src = R.write(d / "c.jsonl", R.varied(110))
    Engine(spark, d / "run").run(src, d / "out.csv")
    shutil.copytree(d / "run/scores/breakdown", d / "first_scores")  # later tests run the folder again with other weights
    return d, src


def test_full_run(spark, done):
    d, _ = done
    assert submission.problems(d / "out.csv") == []
    m = json.loads((d / "run/manifest.json").read_text())
    assert m["status"] == "completed" and set(m["stage_seconds"]) == {"audit", "normalize", "evidence", "credibility", "behavioral", "scores", "reasoning", "submission"}
    q = json.loads((d / "run/reports/reasoning_quality.json").read_text())
    assert q["explanation_quality_status"] == "PASS" and q["total_explanations"] == 100
    assert tools.timings(spark, str(d / "run"))["status"] == "PASS" and tools.cohorts(spark, str(d / "run"))["count"] == 100
    assert len(tools.inspect_top(spark, str(d / "run"), 5)) == 5


def test_resume_reruns_only_what_changed(spark, done):
    d, src = done
    skips = lambda e: {k: v["skips"] for k, v in e.runner.stages.state["stages"].items()}
    e = Engine(spark, d / "run", resume=True)
    e.run(src)
    assert all(n == 1 for n in skips(e).values())
    changed = load({"behavioral": {"weights": {"open_to_work": 0.1}}})
    e = Engine(spark, d / "run", changed, resume=True)
    e.run(src)
    s = skips(e)
    assert s["evidence"] == s["credibility"] == 2 and s["behavioral"] == s["scores"] == 1
    (d / "run/reports/behavioral_report.md").write_text("changed")
    assert e.runner.stages.reusable("behavioral", e.runner.stages.state["stages"]["behavioral"]["fingerprint"])[0] is False


def test_other_code_or_another_table_is_not_reused(spark, done, monkeypatch):
    from siftwell.plans import lifecycle

    d, src = done
    e = Engine(spark, d / "run", resume=True)
    known = e.runner.stages.state["stages"]["audit"]["fingerprint"]
    assert e.runner.stages.reusable("audit", known)[0]
    monkeypatch.setattr(lifecycle, "code_hash", lambda: "other")
    ran = []
    e.input_hash = "same"
    e.runner("extra", (), "c", lambda: (ran.append(1), ([], {}))[1])
    e.runner("extra", (), "c", lambda: (ran.append(2), ([], {}))[1])
    monkeypatch.setattr(lifecycle, "code_hash", lambda: "newer")
    e.runner("extra", (), "c", lambda: (ran.append(3), ([], {}))[1])
    assert ran == [1, 3]
    del e.runner.stages.state["stages"]["extra"]
    part = next((d / "run/evidence/ledger").glob("part-*"))
    part.rename(part.with_name("part-other.parquet"))
    try:
        assert e.runner.stages.reusable("evidence", e.runner.stages.state["stages"]["evidence"]["fingerprint"])[1].startswith("output has changed")
    finally:
        part.with_name("part-other.parquet").rename(part)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stages_join_without_an_exchange(spark, done):
    d, _ = done
    e = Engine(spark, d / "run", resume=True)
    flat, summary = e.table("normalized/candidates"), e.table("evidence/summary")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = {
            "credibility": credibility.with_triggers(flat, summary, e.config, e.reference),
            "behavioral": scoring.availability(flat, summary, e.config, e.reference),
            "scores": scoring.final_scores(flat, summary, e.table("credibility/breakdown"), e.table("behavioral/breakdown"), e.config),
            "ledger by candidate": e.table("evidence/ledger").groupBy("candidate_id").count(),
        }
        for name, df in plans.items():
            assert "Exchange" not in plan_of(df), name
        assert "Exchange" in plan_of(spark.read.parquet(e.path("normalized/candidates")).join(spark.read.parquet(e.path("evidence/summary")), "candidate_id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_the_ledger_is_worked_out_once(spark, done):
    d, _ = done
    e = Engine(spark, d / "run", resume=True)
    df = evidence.ledger(spark.read.parquet(e.path("normalized/candidates")), e.config, e.reference)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython [ids(") == 1 and plan.count("ArrowEvalPython") == 2 and "contains(" not in plan.replace("array_contains(", "")
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and all(len(line) < 400 for line in filters)


def run_files(e, name):
    return {p.name for p in (e.dir / name).glob("part-*")}


def test_only_changed_buckets_are_made_anew(spark, tmp_path):
    rows = R.varied(110)
    src = R.write(tmp_path / "c.jsonl", rows)
    first = Engine(spark, tmp_path / "run")
    first.run(src)
    assert {first.runner.stages.state["stages"][s]["metadata"]["rewritten_buckets"] for s in ("evidence", "credibility", "behavioral")} == {8}
    before = {n: run_files(first, n) for n in ("evidence/ledger", "evidence/summary", "credibility/breakdown", "behavioral/breakdown")}
    rows[17]["profile"]["summary"] += " Shipped a ranking service with faiss and ndcg."
    rows[17]["talent_signals"]["open_to_work_flag"] = not rows[17]["talent_signals"].get("open_to_work_flag")
    again = Engine(spark, tmp_path / "run", resume=True)
    again.run(R.write(tmp_path / "c.jsonl", rows))
    for stage in ("evidence", "credibility", "behavioral"):
        assert again.runner.stages.state["stages"][stage]["metadata"]["rewritten_buckets"] == 1
    for name, files in before.items():
        assert len(files - run_files(again, name)) == 1  # the file of one bucket has gone, the others are the same files
    fresh = Engine(spark, tmp_path / "fresh")
    fresh.run(R.write(tmp_path / "c.jsonl", rows))
    r = tools.same_output(spark, str(tmp_path / "run"), str(tmp_path / "fresh"))
    assert r["only_first"] == r["only_second"] == 0 and r["same_submission"]
    for name in before:
        a, b = again.table(name), fresh.table(name)
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    rows.pop(3)
    fewer = Engine(spark, tmp_path / "run", resume=True)
    fewer.run(R.write(tmp_path / "c.jsonl", rows))
    assert fewer.table("evidence/summary").count() == 109 and fewer.runner.stages.state["stages"]["evidence"]["metadata"]["rewritten_buckets"] == 1
    broken = next((tmp_path / "run/evidence/summary").glob("part-*"))
    broken.rename(broken.with_name(broken.name.replace("part-", "part-1")))
    rows.pop(3)
    whole = Engine(spark, tmp_path / "run", resume=True)
    whole.run(R.write(tmp_path / "c.jsonl", rows))
    assert whole.runner.stages.state["stages"]["evidence"]["metadata"]["rewritten_buckets"] == 8


def test_figures_are_observed_while_a_table_is_written(spark, done, tmp_path):
    d, _ = done
    e = Engine(spark, d / "run", resume=True)
    md = (d / "run/reports/evidence_report.md").read_text()
    r = e.table("evidence/summary").agg(F.count(F.lit(1)), F.sum("evidence_item_count"), F.avg("skill_corroboration_score")).head()
    assert f"- n: {r[0]}\n- items: {r[1]}\n" in md and f"- corroboration: {r[2]}"[:20] in md and "- without_context: 0" in md
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("put", "put")
    e.dir = tmp_path
    told = e.put("t", spark.read.parquet(str(d / "run/evidence/summary")).repartition(8, "candidate_id"), told={"n": F.count(F.lit(1)), "m": F.avg("evidence_confidence")})
    n = len(jobs.getJobIdsForGroup("put"))
    spark.sparkContext.setJobGroup("", "")
    assert told["n"] == 110 and n <= 3


def test_top_rows_are_read_from_their_buckets_alone(spark, done, tmp_path):
    from siftwell.sources import buckets

    d, _ = done
    ledger = spark.read.parquet(str(d / "run/evidence/ledger"))
    buckets.write(ledger.repartition(64, "candidate_id"), str(tmp_path / "evidence/ledger"), "candidate_id", 64)
    e = Engine(spark, d / "run", resume=True)
    top = e.table("scores/breakdown").where("rank <= 3").select("candidate_id")
    e.dir, e.runner.stages.state["buckets"] = tmp_path, 64
    got = e.of_top("evidence/ledger", top)
    files = lambda df: [f for f in df.inputFiles() if "ledger" in f]
    assert 0 < len(files(got)) <= 3 < len(files(e.table("evidence/ledger")))
    want = ledger.join(top, "candidate_id", "left_semi").select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_quoted_evidence_is_held_against_its_context(spark, done):
    d, _ = done
    e = Engine(spark, d / "run", resume=True)
    top = e.table("scores/breakdown").where("rank <= 5")
    e.verify_provenance(top)
    e.of_top = lambda name, top, own=e.of_top: own(name, top).withColumn("exact_source_excerpt", F.lit("made up")) if name == "evidence/ledger" else own(name, top)
    with pytest.raises(ValueError, match="doesn't hold"):
        e.verify_provenance(top)


def test_evidence_profile(spark, tmp_path):
    src = R.write(tmp_path / "few.jsonl", R.varied(3))
    Engine(spark, tmp_path / "r", profiled=True).run(src, allow_small_sample=True, strict=False)
    told = json.loads((tmp_path / "r/reports/evidence_profile.json").read_text())
    assert told["ledger_seconds"] > 0 and sum(told["items_by_source"].values()) > 0


def test_same_result_from_other_partitions(spark, done, tmp_path):
    d, src = done
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        Engine(spark, tmp_path / "a", load({"runtime": {"processing_mode": "chunked"}})).run(src)
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        Engine(spark, tmp_path / "b").run(src)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    r = tools.same_output(spark, str(tmp_path / "a"), str(tmp_path / "b"))
    assert {k: r[k] for k in ("same_columns", "only_first", "only_second", "same_submission")} == {"same_columns": True, "only_first": 0, "only_second": 0, "same_submission": True}
    assert all(c["differing"] == 0 and c["largest_difference"] in (0, None) for c in r["columns"].values()) and {"final_score", "rank"} <= set(r["columns"])
    assert r["environments"]["python"][0] == r["environments"]["python"][1]


def test_only_differing_parts_are_compared(spark):
    a = spark.range(5000).selectExpr("id as k", "id % 7 as v", "cast(id as string) as t")
    b = a.where("k <> 11").withColumn("v", F.when(F.col("k") == 77, F.lit(-1)).otherwise(F.col("v"))).unionByName(spark.sql("select 9999L as k, 1L as v, 'x' as t"))
    assert tools.differing(a, a.repartition(3), "k")[2] == 0
    x, y, parts = tools.differing(a, b, "k")
    assert parts == 3 and x.count() < 60 and {r["k"] for r in x.exceptAll(y).collect()} == {11, 77} and {r["k"] for r in y.exceptAll(x).collect()} == {77, 9999}


def test_breakdowns_are_exported_by_id(spark, done, tmp_path):
    d, _ = done
    assert tools.export_breakdowns(spark, str(d / "run"), str(tmp_path)) == {"evidence": 110, "credibility": 110, "behavioral": 110}
    for name in ("evidence", "credibility", "behavioral"):
        ids = [row["candidate_id"] for f in sorted((tmp_path / name).glob("part-*.csv")) for row in csv.DictReader(f.open())]
        assert len(ids) == 110 and ids == sorted(ids)


def test_baseline_and_comparison(spark, done, tmp_path):
    d, src = done
    Engine(spark, tmp_path / "b").run(src, tmp_path / "base.csv", mode="baseline")
    assert submission.problems(tmp_path / "base.csv") == []
    c = tools.compare(spark, str(tmp_path / "base.csv"), str(d / "out.csv"))
    assert len(c["entrants"]) == len(c["exits"]) <= 10 and len(c["moves"]) + len(c["entrants"]) == 100
    assert len(tools.changes(spark, str(d / "out.csv"), str(tmp_path / "base.csv"))) == 20


def test_release_and_invariance(spark, done, tmp_path):
    d, _ = done
    r = tools.invariance(spark, str(d / "run"), str(d / "run"))
    assert r["same_submission"] and r["changed_rows"] == [] and r["submission_problems"] == [] and r["explanations"] == "PASS"
    m = tools.export_release(spark, str(d / "run"), str(tmp_path / "release"))
    assert "submission.csv" in m["files"] and (tmp_path / "release/submission.csv").read_bytes() == (d / "run/submission/submission.csv").read_bytes()
    assert (tmp_path / "release/validator.txt").read_text() == "valid\n"
    assert tools.measured(["true"])["exit_code"] == 0 and tools.runtime_status(250) == "WARNING" and tools.runtime_status(271) == "BLOCKED"


def test_a_run_in_a_store(spark, done, tmp_path):
    """All of a run through a path that only Spark's file systems read: stages, state, logs, reports, submission, tools, resume."""
    d, src = done
    run = f"file://{tmp_path}/run"
    result = Engine(spark, run).run(f"file://{src}", f"file://{tmp_path}/out.csv")
    assert str(result.official) == f"file://{tmp_path}/out.csv" and (tmp_path / "out.csv").read_bytes() == (d / "out.csv").read_bytes()
    assert tools.inspect_run(spark, run)["manifest"]["status"] == "completed" and tools.cohorts(spark, run)["count"] == 100
    first, here = spark.read.parquet(str(d / "first_scores")), spark.read.parquet(f"{run}/scores/breakdown")
    assert first.exceptAll(here).count() == here.exceptAll(first).count() == 0 and tools.same_output(spark, run, run)["same_submission"]
    again = Engine(spark, run, resume=True)
    again.run(f"file://{src}")
    assert all(s["skips"] == 1 for s in again.runner.stages.state["stages"].values())
    events = [json.loads(line)["event"] for line in (tmp_path / "run/logs/events.jsonl").read_text().splitlines()]
    assert events.count("completed") == 8 and events.count("skipped") == 8
    (tmp_path / "run/reports/behavioral_report.md").write_text("changed")
    assert again.runner.stages.intact("behavioral").startswith("output has changed") and again.runner.stages.intact("evidence") is None
    m = tools.export_release(spark, run, f"file://{tmp_path}/release")
    assert "submission.csv" in m["files"] and submission.problems(f"file://{tmp_path}/release/submission.csv") == []
    with pytest.raises(FileNotFoundError):
        place(f"file://{tmp_path}/nothing").read_text()


def test_gates(spark, tmp_path):
    two = R.write(tmp_path / "two.jsonl", R.varied(2))
    with pytest.raises(TooFewCandidates):
        Engine(spark, tmp_path / "r").run(two)
    r = Engine(spark, tmp_path / "r2").run(two, tmp_path / "o.csv", allow_small_sample=True, strict=False)
    assert r.official is None and r.submission.name == "sample_submission.csv" and not (tmp_path / "o.csv").exists()
    with pytest.raises(DuplicateCandidates):
        Engine(spark, tmp_path / "r3").run(R.write(tmp_path / "dup.jsonl", [R.record(1), R.record(1)]))
    assert json.loads((tmp_path / "r3/manifest.json").read_text())["status"] == "failed"


def test_upload(spark, tmp_path):
    r = rank_records(spark, "\n".join(json.dumps(x) for x in R.varied(5)).encode(), "a.jsonl", tmp_path)
    assert [x["rank"] for x in r["rows"]] == [1, 2, 3, 4, 5] and r["csv"].startswith("candidate_id,rank,score,reasoning")
    assert r["rows"][0]["evidence"] and "open_to_work_component" in r["rows"][0]["components"]


def test_semantic_gate(spark, done, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    from siftwell.operators import semantic
    from siftwell.plans import lifecycle

    d, src = done
    on = load({"semantic": {"enabled": True}})
    flat = spark.read.parquet(str(d / "run/normalized/candidates"))
    h = lifecycle.dataset_hash(spark, src)
    assert semantic.load(spark, tmp_path, load(), flat, h)[1] == {"status": "disabled"}
    assert semantic.load(spark, tmp_path, on, flat, h)[1] == {"status": "absent"}
    tools.build_semantic(spark, src, str(tmp_path))
    table, status = semantic.load(spark, tmp_path, on, flat, h)
    assert status == {"status": "loaded"} and table.count() == 110
    assert semantic.load(spark, tmp_path, on, flat.limit(3), h)[1]["status"] == "mismatch"
    assert semantic.load(spark, tmp_path, on, flat, "other")[1]["mismatches"] == ["source_dataset_hash"]


def test_validator(tmp_path):
    rows = [[f"CAND_{i:07d}", str(i), f"{200 - i:.6f}", "x"] for i in range(1, 101)]

    def problems(change=None, name="s.csv", header=("candidate_id", "rank", "score", "reasoning")):
        data = [list(r) for r in rows]
        if change:
            change(data)
        with (tmp_path / name).open("w", newline="") as f:
            csv.writer(f).writerows([header, *data])
        return submission.problems(tmp_path / name)

    assert problems() == []
    assert problems(lambda d: d[0].__setitem__(1, "01"))
    assert problems(lambda d: d.pop()) and problems(name="s.txt") and problems(header=("a", "b", "c", "d"))
    assert problems(lambda d: d[1].__setitem__(0, d[0][0])) and problems(lambda d: d[5].__setitem__(2, "999")) and problems(lambda d: d[5].__setitem__(0, "X"))

    def tie(d):
        d[0][2] = d[1][2]
        d[0][0], d[1][0] = d[1][0], d[0][0]

    assert problems(tie)
    with pytest.raises(SinkError):
        submission.require_valid(tmp_path / "s.csv")


def test_config(tmp_path):
    c = load()
    assert c.stage_hash("evidence") == load().stage_hash("evidence")
    moved = load({"behavioral": {"base": 0.7}})
    assert moved.stage_hash("behavioral") != c.stage_hash("behavioral") and moved.stage_hash("evidence") == c.stage_hash("evidence")
    assert load({"rubric": {"availability": {"open_to_work": 0.3}}}).stage_hash("reasoning") != c.stage_hash("reasoning")
    for bad in ({"x": 1}, {"baseline": {"weights": {"python_engineering": 0.9}}}, {"runtime": {"processing_mode": "streaming"}}, {"runtime": {"reference_date": "soon"}}, {"runtime": {"chunk_size": 0}}, {"evidence": {"new": {"terms": ["a"]}}}, {"semantic": {"enabled": "yes"}}):
        with pytest.raises(ConfigError):
            load(bad)
    (tmp_path / "c.json").write_text(json.dumps({"runtime": {"chunk_size": 7}}))
    assert load_files(tmp_path / "c.json")["runtime"]["chunk_size"] == 7


@pytest.mark.parametrize("fmt", ["yaml", "json"])
def test_config_folder(tmp_path, fmt):
    pytest.importorskip("yaml")
    files = write_folder(load(), tmp_path, fmt)
    assert {p.name for p in files} == {f"{b}.{fmt}" for b in load().data}
    again = load_folder(tmp_path)
    assert again.data == load().data and all(again.stage_hash(s) == load().stage_hash(s) for s in ("evidence", "credibility", "scores"))
    assert again.with_runtime(reference_date="2026-01-01").reference_date.year == 2026
    (tmp_path / f"scoring.{fmt}").write_text("{weights: 3" if fmt == "yaml" else "{", encoding="utf-8")
    with pytest.raises(ConfigError):
        load_folder(tmp_path)
    (tmp_path / f"scoring.{fmt}").unlink()
    with pytest.raises(ConfigError, match="lacks the bundles"):
        load_folder(tmp_path)
    write_folder(load(), tmp_path, fmt)
    (tmp_path / "other.json").write_text("{}")
    with pytest.raises(ConfigError, match="unknown bundle"):
        load_folder(tmp_path)


def test_streamed_items_equal_the_batch(spark, done, tmp_path):
    from siftwell.functions import columns as C
    from siftwell.operators import evidence

    d, src = done
    (tmp_path / "in").mkdir()
    lines = open(src).read().splitlines()
    for i in range(3):
        (tmp_path / f"in/{i}.jsonl").write_text("\n".join(lines[i::3]) + "\n" + lines[0] + "\n")
    config = load()
    incremental.write(incremental.ledger_items(spark, str(tmp_path / "in"), config), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = evidence.items(spark.read.parquet(str(d / "run/normalized/candidates")), config, C.date_lit(config.reference_date))
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0


def test_streamed_scores_equal_the_batch(spark, done, tmp_path):
    d, _ = done
    rows = [json.loads(line) for line in open(d / "c.jsonl")]
    (tmp_path / "in").mkdir()
    again = {**rows[0], "profile": {**rows[0]["profile"], "summary": "changed later"}}
    parts = [rows[:40], [*rows[40:80], again], [again, *rows[80:], rows[50]]]
    query = lambda name, process=None: incremental.write(incremental.first_scores(spark, str(tmp_path / "in"), load()), str(tmp_path / name), str(tmp_path / f"ck_{name}"), process)
    for i, part in enumerate(parts):  # one restart of each stream a file: state and tables go on
        (tmp_path / f"in/{i}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in part) + "no json\n")
        query("out").awaitTermination(300)
        query("state", incremental.keep_top(str(tmp_path / "top"), 20)).awaitTermination(300)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["candidate_id"], r["copy"]) for r in got.where("copy > 1").collect()} == {(rows[0]["candidate_id"], 2), (rows[0]["candidate_id"], 3), (rows[50]["candidate_id"], 2)}
    want = spark.read.parquet(str(d / "first_scores"))
    first = got.where("copy = 1").drop("copy")
    assert first.count() == 110 and first.exceptAll(want.select(*first.columns)).count() == 0
    top = spark.read.parquet(str(tmp_path / "top"))
    assert top.exceptAll(want.where("rank <= 20").select(*top.columns)).count() == 0 and top.count() == 20
