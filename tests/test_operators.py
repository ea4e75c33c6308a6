import datetime as dt
import json
import random

import pytest
import records as R
from pyspark.sql import functions as F

from siftwell.config import ConfigError, load
from siftwell.functions import columns as C
from siftwell.functions import fixed_values as V
from siftwell.functions import folds
from siftwell.operators import submission, audit, credibility, evidence, normalize, scoring
from siftwell.sources import candidates as S

REF = dt.date(2026, 6, 30)


def parsed(spark, tmp_path, rows):
    return S.valid_records(S.parse(S.read_lines(spark, R.write(tmp_path / "c.jsonl", rows))))


def flat(spark, tmp_path, rows, ref=REF):
    return normalize.normalized(parsed(spark, tmp_path, rows), C.date_lit(ref))


def one(df):
    return df.collect()[0].asDict(recursive=True)


def contradictory(number=1):
    role = lambda start, end, months, current, text: {"company": "A", "title": "ML Engineer", "start_date": start, "end_date": end, "duration_months": months, "is_current": current, "description": text}
    return R.record(
        number,
        profile={"years_of_experience": 14},
        career_history=[role("2024-01-01", None, 30, True, "Handled tickets."), role("2024-04-01", "2023-01-01", 99, True, "Handled plans.")],
        skills=[{"name": "LLM", "proficiency": "expert", "duration_months": 120}, {"name": "Pinecone", "proficiency": "advanced", "duration_months": 120}],
        talent_signals={"signup_date": "2026-06-20", "last_active_date": "2026-06-10", "expected_salary_range_inr_lpa": {"min": 40, "max": 20}},
    )


def test_dates(spark):
    df = spark.createDataFrame([("2026-02-03T10:00",), ("2026-2-3",), ("2026",), ("2026-13-01",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(C.parse_date("s")).collect()] == [dt.date(2026, 2, 3)] + [None] * 5
    days = [60, 120, 180, None]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    assert [round(r[0], 6) for r in df.select(C.linear_recency(F.col("d"))).collect()] == [1.0, 0.675, 0.35, 0.35]


def test_lexicons_differ_in_boundaries(spark):
    df = spark.createDataFrame([("Planned the roadmap",), ("ANN  and map",), ("mitä",), (None,)], "t string")
    rows = df.select(C.matched_terms(C.normalize_text("t"), ["ann", "map"]), C.word_hits(F.col("t"), ["ann", "map", "mit"])).collect()
    assert [r[0] for r in rows] == [["ann", "map"], ["ann", "map"], [], []]
    assert [r[1] for r in rows] == [0, 2, 0, 0]


def test_audit_rules(spark, tmp_path):
    kinds = sorted(r["type"] for r in audit.issue_rows(parsed(spark, tmp_path, [contradictory()]), C.date_lit(REF)).collect())
    assert kinds == sorted(["signup_after_last_active", "current_role_has_past_end_date", "role_end_before_start", "multiple_current_roles", "experience_span_mismatch", "skill_duration_implausible", "skill_duration_implausible", "salary_min_greater_than_max"])


def test_audit_takes_null_fields(spark, tmp_path):
    rows = [R.record(1, career_history=[{"title": None}], skills=[{"name": None}]), R.record(2, career_history=None, skills=None, profile={"years_of_experience": "6"}), R.record(3, talent_signals=None)]
    assert flat(spark, tmp_path, rows).count() == 3


def test_normalized_row(spark, tmp_path):
    r = one(flat(spark, tmp_path, [R.record(1, talent_signals={"avg_response_time_hours": 0})]))
    assert set(normalize.FLAT) <= set(r)
    assert r["avg_response_time_hours"] == 999 and r["current_role_count"] == 1 and r["total_career_months"] == 53 and r["relevant_skill_count_baseline"] == 1
    assert r["combined_career_text"].endswith("in production. Search Engineer") and r["most_recent_role_start_date"] == "2022-01-01" and r["most_recent_role_end_date"] == ""
    assert r["career_history"][0]["index"] == 0 and r["skill_assessments"] == [{"index": 0, "name": "Python", "score": 91.0}]
    import hashlib

    assert r["candidate_record_hash"] == hashlib.sha256(json.dumps(R.record(1, talent_signals={"avg_response_time_hours": 0}), sort_keys=True).encode()).hexdigest()


def reference_ledger(r, config):
    """The ledger by plain loops: a greedy fold in place of running sums."""
    parts = []
    for i, role in enumerate(r["career_history"] or []):
        for f in ("description", "title"):
            if role.get(f):
                parts.append((f"career_history[{i}].{f}", f"career_{f}", role[f], role))
    for f in ("summary", "headline"):
        if r["profile"].get(f):
            parts.append((f"profile.{f}", f"profile_{f}", r["profile"][f], None))
    parts += [(f"skills[{i}].name", "skill", s["name"], None) for i, s in enumerate(r["skills"]) if s.get("name")]
    scores = r["talent_signals"].get("skill_assessment_scores") or {}
    parts += [(f"skill_assessments[{i}].name", "assessment", n, None) for i, n in enumerate(sorted(scores))]
    groups = {}
    for path, kind, text, role in parts:
        low = " ".join(text.lower().split())
        for name, c in config["evidence"].items():
            w = c["weight"] * c["source_weights"].get(kind, 0)
            terms = sorted({t for t in c["terms"] if t in low})
            if w <= 0 or not terms:
                continue
            recency = 1.0
            if role and not role.get("is_current"):
                last = role.get("end_date") or role.get("start_date")
                if last and (REF - dt.date.fromisoformat(last)).days / 365.25 > c["recent_years"]:
                    recency = c["older_multiplier"]
            strength = min(1, len(terms) / 2)
            groups.setdefault(name, []).append([path, kind, terms, strength * recency * w, strength])
    out, index = {}, 0
    for name, rows in groups.items():
        families, left = {V.SOURCE_FAMILIES[x[1]] for x in rows}, config["evidence"][name]["cap"]
        for path, _, _, before, strength in sorted(rows, key=lambda x: -round(x[3], 6)):
            adjusted = before * (0.35 if config["evidence"][name]["require_corroboration"] and families == {"skill"} else 1)
            after = min(adjusted, left)
            left -= after
            out[path, name] = (round(after, 5), round(min(1, 0.7 * strength + 0.3 * min(1, len(families) / 3)), 5), index)
            index += 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_ledger_equals_a_greedy_fold(spark, tmp_path, seed):
    rng, config = random.Random(seed), load()
    terms = [t for c in config["evidence"].values() for t in c["terms"]]
    rows = []
    for i in range(1, 25):
        r = R.record(i)
        text = lambda k: ". ".join(rng.sample(terms, k))
        r["career_history"] = [{"title": text(1), "description": text(rng.randint(0, 6)), "start_date": f"{rng.randint(2008, 2024)}-05-01", "end_date": rng.choice([None, f"{rng.randint(2009, 2026)}-01-01"]), "is_current": rng.random() < 0.3} for _ in range(rng.randint(0, 4))]
        r["profile"] |= {"summary": text(rng.randint(0, 4)), "headline": text(1)}
        r["skills"] = [{"name": text(1)} for _ in range(rng.randint(0, 4))]
        r["talent_signals"]["skill_assessment_scores"] = {text(1): 50.0 for _ in range(rng.randint(0, 2))}
        rows.append(r)
    context = flat(spark, tmp_path, rows)
    ledger = evidence.ledger(context, config, C.date_lit(REF)).cache()
    got = {}
    for x in ledger.collect():
        got.setdefault(x["candidate_id"], {})[x["source_path"], x["normalized_category"]] = (round(x["contribution_after_caps"], 5), round(x["confidence"], 5), x["evidence_index"])
    for r in rows:
        want, have = reference_ledger(r, config), got.get(r["candidate_id"], {})
        assert want.keys() == have.keys()
        for k in want:
            assert have[k] == pytest.approx(want[k], abs=2e-5), (r["candidate_id"], k)
    bad = ledger.join(context, "candidate_id").where(~evidence.reconstructible(F.col("source_path"), F.col("exact_source_excerpt")))
    assert bad.count() == 0
    summary = evidence.summary(evidence.with_graded(context, config, C.date_lit(REF)))
    assert summary.count() == len(rows)
    for s in summary.collect():
        mine = [x for x in ledger.collect() if x["candidate_id"] == s["candidate_id"]]
        assert s["evidence_item_count"] == len(mine)
        assert s["risk_signals_score"] == pytest.approx(sum(x["contribution_after_caps"] for x in mine if x["polarity"] == "negative"), abs=1e-5)
        best = sorted((x for x in mine if x["polarity"] == "positive"), key=lambda x: (-x["contribution_after_caps"], x["item_seq"]))[:3]
        assert s["top_positive_evidence_ids"] == [x["evidence_id"] for x in best]


def test_greedy_cap_golden(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.5), (3, 2.0)], "i int, x double").withColumn("g", F.lit(0))
    assert [round(r[0], 6) for r in df.select(folds.capped(F.col("x"), F.lit(2.2), ["g"], "i").alias("a"), "i").orderBy("i").collect()] == [1.0, 1.2, 0.0]


def scored(spark, tmp_path, rows, ref=REF, config=None):
    config = config or load()
    f = flat(spark, tmp_path, rows, ref)
    s = evidence.summary(evidence.with_graded(f, config, C.date_lit(ref)))
    t = credibility.with_triggers(f, s, config, C.date_lit(ref))
    return f, s, t, config


def test_credibility_goldens(spark, tmp_path):
    clean = R.record(2, career_history=[{"company": "A", "title": "Engineer", "start_date": "2022-01-01", "end_date": None, "duration_months": 60, "is_current": True, "description": "Search model work."}])
    _, _, t, config = scored(spark, tmp_path, [contradictory(), clean])
    got = {r["candidate_id"]: r for r in credibility.breakdown(t, config).collect()}
    assert got["CAND_0000001"]["credibility_multiplier"] == 0.25 and got["CAND_0000001"]["anomaly_risk_score"] == 1.0
    assert got["CAND_0000002"]["credibility_multiplier"] == pytest.approx(0.92) and got["CAND_0000002"]["minor_rule_count"] == 1
    assert credibility.trigger_rows(t).count() == sum(r["triggered_rule_count"] for r in got.values())


def test_overlap_depends_on_the_reference_date(spark, tmp_path):
    role = lambda s, e: {"title": "Engineer", "start_date": s, "end_date": e, "description": "x"}
    rows = [R.record(1, career_history=[role("2024-01-01", None), role("2026-03-15", None)])]
    for ref, months, fired in ((dt.date(2026, 6, 30), 3, 0), (dt.date(2027, 4, 30), 13, 1)):
        f, _, t, _ = scored(spark, tmp_path, rows, ref)
        assert one(f.select(credibility.overlap_months(F.col("career_history"), C.date_lit(ref)).alias("m")))["m"] == months
        assert credibility.trigger_rows(t).where("rule_name = 'excessive_overlap'").count() == fired


def test_registry(spark, tmp_path):
    rule = {"enabled": True, "severity": "minor", "score_contribution": 0.1, "explanation_label": "x"}
    with pytest.raises(ConfigError):
        credibility.check_registry(load({"credibility": {"rules": {"no_such_rule": rule}}}))
    off = load({"credibility": {"rules": {"role_end_before_start": {"enabled": False}}}})
    _, _, t, _ = scored(spark, tmp_path, [contradictory()], config=off)
    assert credibility.trigger_rows(t).where("rule_name = 'role_end_before_start'").count() == 0


def test_availability_goldens(spark, tmp_path):
    fast = R.record(1, talent_signals={"recruiter_response_rate": 0.9, "avg_response_time_hours": 4, "interview_completion_rate": 0.8, "notice_period_days": 15, "github_activity_score": 70, "last_active_date": "2026-06-10"})
    slow = R.record(2, talent_signals={"open_to_work_flag": True, "recruiter_response_rate": 0.1, "avg_response_time_hours": 240, "interview_completion_rate": 0.8, "notice_period_days": 120, "preferred_work_mode": "onsite", "github_activity_score": 0})
    for r in (fast, slow):
        r["skills"], r["career_history"] = [], []
    f, s, _, config = scored(spark, tmp_path, [fast, slow])
    got = {r["candidate_id"]: r for r in scoring.availability(f, s, config, C.date_lit(REF)).collect()}
    assert got["CAND_0000001"]["availability_multiplier"] == pytest.approx(1.0206)
    assert got["CAND_0000002"]["availability_multiplier"] == pytest.approx(0.84744)
    assert got["CAND_0000002"]["location_logistics_score"] == 1.0  # by country


def test_full_rank_is_total_and_partition_free(spark):
    df = spark.createDataFrame([(f"c{i:04d}", float(i * 7 % 50)) for i in range(500)], "candidate_id string, final_score double")
    want = [r["candidate_id"] for r in sorted(df.collect(), key=lambda r: (-r["final_score"], r["candidate_id"]))]
    for n in (1, 4, 17):
        got = {r["rank"]: r["candidate_id"] for r in folds.ranked(df.repartition(n), F.desc("final_score"), "candidate_id", partitions=n).collect()}
        assert [got[i + 1] for i in range(500)] == want


def test_missing_input_row_raises(spark, tmp_path):
    f, s, t, config = scored(spark, tmp_path, [R.record(1), R.record(2)])
    b = scoring.availability(f, s, config, C.date_lit(REF))
    c = credibility.breakdown(t, config)
    assert scoring.final_scores(f, s, c, b, config).count() == 2
    with pytest.raises(Exception, match="no evidence, credibility or behaviour row"):
        scoring.final_scores(f, s, c.where("candidate_id <> 'CAND_0000001'"), b, config).collect()


def test_baseline_prefers_career_evidence(spark, tmp_path):
    strong, stuffed = R.record(1), R.record(2, career_history=[{"title": "Clerk", "description": "Filed papers."}], skills=[{"name": t} for t in ("retrieval", "ranking", "bm25", "vector", "embedding")])
    stuffed["profile"] |= {"summary": "", "headline": ""}
    rows = {r["candidate_id"]: r for r in scoring.baseline_scores(flat(spark, tmp_path, [strong, stuffed]), load()).withColumn("text", scoring.baseline_explanation()).collect()}
    assert rows["CAND_0000001"]["final_score"] > rows["CAND_0000002"]["final_score"]
    assert rows["CAND_0000002"]["final_score"] <= 100 and rows["CAND_0000001"]["text"].startswith("Career history mentions")


def test_provenance_is_the_canonical_hash(spark):
    import hashlib
    import json

    texts = [None, "plain", "plain", 'a "q" \\ b', "é漢😀", "x\n\t\x01\x1f\x7f\b\f\r end", "", "  \U0010ffff"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    made = evidence.provenance(F.lit("C"), F.lit("p"), F.lit("c"), F.col("v"), F.array("v", F.lit("t")))
    for r in df.select("v", made.alias("h")).collect():
        want = {"candidate_id": "C", "source_path": "p", "normalized_category": "c", "excerpt": r["v"], "matched_terms": [r["v"], "t"]}
        assert r["h"] == hashlib.sha256(json.dumps(want, sort_keys=True).encode()).hexdigest()


@pytest.mark.parametrize("capacity", [4, 30, 1000])
def test_most_frequent_values_are_exact(spark, capacity):
    from siftwell.functions import frequent

    rng, rows = random.Random(capacity), []
    for i in range(6000):
        rows.append((i, "skewed", f"v{int(rng.paretovariate(0.7)) % 900}"))
        rows.append((i, "flat", f"w{rng.randrange(700)}"))
        rows.append((i, "few", rng.choice("xyz")))
    df = spark.createDataFrame(rows, "i int, grp string, value string").repartition(7)
    got = {(r["grp"], r["value"], r["n"], r["place"]) for r in frequent.most_frequent(df, ["skewed", "flat", "few", "none"], 10, F.struct("i"), capacity).collect()}
    want = set()
    for g in ("skewed", "flat", "few"):
        first, n = {}, {}
        for i, grp, v in rows:
            if grp == g:
                first.setdefault(v, i)
                n[v] = n.get(v, 0) + 1
        want |= {(g, v, n[v], k) for k, v in enumerate(sorted(n, key=lambda v: (-n[v], first[v]))[:10], 1)}
    assert got == want
    kept = frequent.candidates(df, ["skewed", "flat", "few"], capacity).groupBy("grp").count().collect()
    assert all(r["count"] <= capacity for r in kept)


@pytest.mark.parametrize("rows", [1, 2, 5, 1000])
def test_checks_over_a_ranking_see_over_block_ends(spark, rows):
    rng = random.Random(rows)
    data = [(k, f"C{rng.randrange(5)}", float(rng.choice([3, 3, 2])), rng.choice(["a", "b", "", "c"])) for k in range(1, 41)]
    df = spark.createDataFrame(data, "rank long, candidate_id string, final_score double, opening string").repartition(4)
    issues = {(r["rank"], r["issue"]) for r in submission.order_issues(df, rows=rows).collect()}
    want = {(1, None)}
    for (_, c1, s1, _), (k, c2, s2, _) in zip(data, data[1:], strict=False):
        want.add((k, "score_increases" if s2 > s1 else "tie_order" if s1 == s2 and c2 < c1 else None))
    assert issues == want
    if rows < 4:
        with pytest.raises(ValueError, match="neighbours"):
            submission.repeated_openings(df, F.col("opening"), rows=rows)
        return
    got = {r["rank"]: r["most_repeated"] for r in submission.repeated_openings(df, F.col("opening"), rows=rows).collect()}
    keys = [x[3] for x in data]
    assert got == {i + 1: max((keys[i : i + 5].count(k) for k in keys[i : i + 5] if k), default=0) for i in range(36)}
    assert "SinglePartition" not in submission.order_issues(df, rows=rows)._jdf.queryExecution().executedPlan().toString()


def test_lexicon_finds_every_term(spark):
    from siftwell.functions import lexicon

    terms = ["a", "ab", "abc", "b c", "é", "漢字", "zz"]
    texts = ["abc", "", "b c é", None, "x漢字abz", "zzz" * 200]
    assert [lexicon.find(t, tuple(terms)) for t in texts] == [[i for i, t in enumerate(terms) if t in (x or "")] for x in texts]
    df = spark.createDataFrame([(1, texts), (2, []), (3, ["ab"]), (4, None)], "i int, x array<string>")
    got = {r["i"]: r["f"] for r in df.select("i", lexicon.term_ids(terms)(F.col("x")).alias("f")).collect()}
    assert got[1] == [lexicon.find(t, tuple(terms)) for t in texts] and got[2] == [] and got[3] == [[0, 1]]
    with pytest.raises(ValueError):
        lexicon.term_ids(["a", ""])


def test_parts_keep_digits_at_their_ends(spark):
    df = spark.createDataFrame([("0 to 60.  1 of 11", [" 0 to 60 ", "11", None, " 2 "])], "text string, parts array<string>")
    r = df.select(C.sentences(F.col("text")).alias("s"), C.text_join(F.col("parts")).alias("joined")).first()
    assert (r["s"], r["joined"]) == (["0 to 60.", "1 of 11"], "0 to 60 11 2")
