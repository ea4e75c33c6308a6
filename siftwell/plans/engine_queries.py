"""Registered queries that run the engine's own operators over documents taken as candidate records.

Every field of a record follows from a document's id and text, so that SQL can
make the same records and work out each operator's result from the
configuration on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.config import load
from siftwell.functions import columns as C
from siftwell.functions import fixed_values as V
from siftwell.operators import audit, credibility, evidence, explain, normalize, scoring
from siftwell.plans.session import cut
from siftwell.sources import candidates as S

CONFIG = load()
REF = str(CONFIG.reference_date)
TITLES = ["Search Engineer", "AI Engineer", "Account Manager", "Data Analyst", "Machine Learning Lead"]
#: What a role's description ends with.
DUTIES = [
    "Improved search relevance and recommendations for live users", "Ran the vector index on faiss with bm25", "Measured ndcg and mrr in an a/b test", "Kept production deployment, latency and monitoring",
    "Wrote python and airflow backend api", "Sold furniture", "Tuned ranking pipeline with embeddings",
]
SKILLS = ["Vector search", "Python", "LLM ranking", "Embeddings", "Excel", "FAISS", "Recommendation"]
PROFICIENCY = ["advanced", "beginner", "expert"]
MODES = ["remote", "onsite", "hybrid"]
COUNTRIES = ["India", "Germany"]


def records(t) -> DataFrame:
    """Documents as candidate records: two roles, two skills, signals; all but the text by arithmetic on the id."""
    k = F.col("doc_id")
    of = lambda values, shift=0: F.element_at(F.lit(values), (F.pmod(k + shift, F.lit(len(values))) + 1).cast("int"))
    plus = lambda base, days: F.date_add(F.lit(base).cast("date"), days.cast("int"))
    none = lambda kind="string": F.lit(None).cast(kind)
    start1, start2 = plus("2018-01-01", k % 1500), plus("2016-06-01", k % 900)
    end1 = F.when(k % 3 != 0, F.date_add(start1, (k % 1100 - 60).cast("int")))
    end2 = F.date_add(start2, (k % 1300).cast("int"))

    def role(title, start, end, months, current, text):
        return F.struct(F.lit("company").alias("company"), title.alias("title"), start.cast("string").alias("start_date"), end.cast("string").alias("end_date"), months.alias("duration_months"), current.alias("is_current"), none().alias("industry"), none().alias("company_size"), text.alias("description"))

    history = F.array(
        role(of(TITLES), start1, end1, k % 40, k % 4 == 0, F.concat("text", F.lit(" "), of(DUTIES))),
        role(of(TITLES, 3), start2, end2, k % 30, k % 7 == 0, of(DUTIES, 2)),
    )
    skill = lambda i, months: F.struct(of(SKILLS, i).alias("name"), of(PROFICIENCY, i).alias("proficiency"), none("bigint").alias("endorsements"), months.alias("duration_months"))
    profile = F.struct(
        F.col("lang").alias("headline"), F.col("source").alias("summary"), of(TITLES).alias("current_title"), none().alias("current_company"), none().alias("current_company_size"), none().alias("current_industry"),
        none().alias("location"), of(COUNTRIES).alias("country"), (k % 18).cast("double").alias("years_of_experience"),
    )
    signals = F.struct(
        none("double").alias("profile_completeness_score"), plus("2026-01-01", k % 200).cast("string").alias("signup_date"), plus("2025-11-01", k % 240).cast("string").alias("last_active_date"),
        (k % 2 == 0).alias("open_to_work_flag"), (k % 100 / 100).alias("recruiter_response_rate"), (k % 240).cast("double").alias("avg_response_time_hours"), (k % 130).cast("double").alias("notice_period_days"),
        of(MODES).alias("preferred_work_mode"), (k % 5 == 0).alias("willing_to_relocate"), (k % 90).cast("double").alias("github_activity_score"), (k % 10 / 10).alias("interview_completion_rate"),
        F.when(k % 3 == 0, F.create_map(F.lit("python"), (k % 100).cast("double"), F.lit("faiss"), (k % 70).cast("double"))).alias("skill_assessment_scores"),
        F.struct((k % 20 + 10).cast("double").alias("min"), (k % 15 + 12).cast("double").alias("max")).alias("expected_salary_range_inr_lpa"),
    )
    return t("documents").select(
        F.lit("documents").alias("file"), k.alias("row_num"), F.format_string("CAND_%07d", k).alias("candidate_id"), profile.cast(S.PROFILE).alias("profile"), history.cast(S.HISTORY).alias("career_history"),
        F.array(skill(0, k % 150), skill(1, k % 70)).cast(S.SKILLS).alias("skills"), F.array().cast(S.CERTIFICATIONS).alias("certifications"), signals.cast(S.SIGNALS).alias("signals"),
    )


def reference():
    return C.date_lit(CONFIG.reference_date)


def flat(t) -> DataFrame:
    return normalize.normalized(records(t), reference(), with_hash=False)


# -- the same records in SQL ------------------------------------------------------------------------------------------


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _of(values: list[str], shift: int = 0) -> str:
    return f"({_list(values)})[(k + {shift}) % {len(values)} + 1]"


_DAY = "CAST(DATE '{}' + CAST({} AS INTEGER) AS DATE)"
_RECORDS = f"""rec AS (SELECT *, CAST(s1 + CAST(k % 1100 - 60 AS INTEGER) AS DATE) AS x1, CASE WHEN k % 3 <> 0 THEN CAST(s1 + CAST(k % 1100 - 60 AS INTEGER) AS DATE) END AS e1, CAST(s2 + CAST(k % 1300 AS INTEGER) AS DATE) AS e2,
  DATE '{REF}' AS ref, k % 40 AS m1, k % 30 AS m2, k % 4 = 0 AS cur1, k % 7 = 0 AS cur2, k % 18 AS years, {_DAY.format("2026-01-01", "k % 200")} AS signup, {_DAY.format("2025-11-01", "k % 240")} AS active,
  {_of(SKILLS)} AS n1, {_of(SKILLS, 1)} AS n2, {_of(PROFICIENCY)} AS p1, {_of(PROFICIENCY, 1)} AS p2, {_of(MODES)} AS work_mode, {_of(COUNTRIES)} AS country
  FROM (SELECT doc_id AS k, 'CAND_' || lpad(CAST(doc_id AS VARCHAR), 7, '0') AS candidate_id, lang, source, text || ' ' || {_of(DUTIES).replace("k +", "doc_id +")} AS d1, {_of(DUTIES, 2).replace("k +", "doc_id +")} AS d2,
    {_of(TITLES).replace("k +", "doc_id +")} AS t1, {_of(TITLES, 3).replace("k +", "doc_id +")} AS t2, {_DAY.format("2018-01-01", "doc_id % 1500")} AS s1, {_DAY.format("2016-06-01", "doc_id % 900")} AS s2 FROM documents))"""


def _months(a: str, b: str) -> str:
    return f"greatest(0, (year({b}) - year({a})) * 12 + month({b}) - month({a}))"


def _any(text: str, terms) -> str:
    return "(" + " OR ".join(f"contains({text}, {_text(t)})" for t in terms) + ")"


_ISSUES = f"""spans AS (SELECT *, {_months("least(s1, s2)", "greatest(coalesce(e1, ref), e2)")} AS span, coalesce(t1, '') || ' ' || coalesce(d1, '') || ' ' || t2 || ' ' || d2 AS career FROM rec),
roles AS (SELECT candidate_id, ref, s1 AS s, e1 AS e, m1 AS m, cur1 AS cur FROM rec UNION ALL SELECT candidate_id, ref, s2, e2, m2, cur2 FROM rec),
issue AS (
  SELECT candidate_id, 'signup_after_last_active' AS type FROM rec WHERE signup > active
  UNION ALL SELECT candidate_id, 'current_role_has_past_end_date' FROM roles WHERE cur AND e < ref
  UNION ALL SELECT candidate_id, 'role_end_before_start' FROM roles WHERE e < s
  UNION ALL SELECT candidate_id, 'duration_months_mismatch' FROM roles WHERE {_months("s", "coalesce(e, ref)")} > 0 AND abs(m - {_months("s", "coalesce(e, ref)")}) > 6
  UNION ALL SELECT candidate_id, 'multiple_current_roles' FROM rec WHERE cur1 AND cur2
  UNION ALL SELECT candidate_id, 'experience_span_mismatch' FROM spans WHERE span > 0 AND abs(years * 12 - span) > 36
  UNION ALL SELECT candidate_id, 'skill_duration_implausible' FROM spans WHERE k % 150 > span + 24
  UNION ALL SELECT candidate_id, 'skill_duration_implausible' FROM spans WHERE k % 70 > span + 24
  UNION ALL SELECT candidate_id, 'salary_min_greater_than_max' FROM rec WHERE k % 20 + 10 > k % 15 + 12
  UNION ALL SELECT candidate_id, 'skills_career_evidence_mismatch' FROM spans WHERE {_any("lower(n1 || ' ' || n2)", V.SKILL_CLAIM_TERMS)} AND NOT {_any("lower(career)", V.CAREER_SUPPORT_TERMS)})"""
_REASONS = "(VALUES " + ", ".join(f"({_text(n)}, {_text(V.RULES[n][0])}, {_text(r)})" for n, r in V.ISSUE_REASONS.items()) + ") reasons(type, severity, reason)"

_FAMILY = "CASE source_type " + " ".join(f"WHEN {_text(k)} THEN {_text(v)}" for k, v in V.SOURCE_FAMILIES.items()) + " END"


def _evidence_sql() -> str:
    """Ledger rows of the records, by window functions over one row for each fragment and category."""
    fragments = [
        ("career_history[0].description", "career_description", "d1", "cur1", "s1", "e1"), ("career_history[0].title", "career_title", "t1", "cur1", "s1", "e1"),
        ("career_history[1].description", "career_description", "d2", "cur2", "s2", "e2"), ("career_history[1].title", "career_title", "t2", "cur2", "s2", "e2"),
        ("profile.summary", "profile_summary", "source", None, None, None), ("profile.headline", "profile_headline", "lang", None, None, None),
        ("skills[0].name", "skill", "n1", None, None, None), ("skills[1].name", "skill", "n2", None, None, None),
    ]
    parts = [
        f"SELECT candidate_id, ref, {i} AS o, {_text(path)} AS source_path, {_text(kind)} AS source_type, {text} AS excerpt, {cur or 'NULL::BOOLEAN'} AS cur, {start or 'NULL::DATE'} AS s, {end or 'NULL::DATE'} AS e FROM rec"
        for i, (path, kind, text, cur, start, end) in enumerate(fragments)
    ] + [
        f"SELECT candidate_id, ref, {8 + i}, 'skill_assessments[{i}].name', 'assessment', {_text(name)}, NULL::BOOLEAN, NULL::DATE, NULL::DATE FROM rec WHERE k % 3 = 0"
        for i, name in enumerate(["faiss", "python"])
    ]
    hits = []
    for seq, (name, c) in enumerate(CONFIG["evidence"].items()):
        weights = {k: c["weight"] * w for k, w in c["source_weights"].items() if c["weight"] * w > 0}
        if not weights:
            continue
        weight = "CASE source_type " + " ".join(f"WHEN {_text(k)} THEN {w!r}::DOUBLE" for k, w in weights.items()) + " END"
        age = "greatest(0, date_diff('day', coalesce(e, s), ref)) / 365.25"
        recency = f"CASE WHEN s IS NULL THEN 1.0 WHEN cur THEN {float(c['current_multiplier'])!r} WHEN {age} <= {int(c['recent_years'])} THEN 1.0 ELSE {float(c['older_multiplier'])!r} END::DOUBLE"
        hits.append(
            f"SELECT *, {seq} AS seq, {_text(name)} AS category, {_text(c['polarity'])} AS polarity, {weight} AS weight, {float(c['cap'])!r}::DOUBLE AS cap, {bool(c['require_corroboration'])} AS strict, "
            f"{float(max(1, c['match_divisor']))!r}::DOUBLE AS divisor, {recency} AS recency, list_filter({_list(sorted(set(c['terms'])))}, lambda x: contains(txt, x)) AS terms FROM frag WHERE source_type IN ({', '.join(map(_text, weights))})"
        )
    return f"""frag AS (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY o) - 1 AS fragment, trim(regexp_replace(lower(excerpt), '\\s+', ' ', 'g')) AS txt FROM ({" UNION ALL ".join(parts)}) WHERE coalesce(excerpt, '') <> ''),
hit AS (SELECT *, fragment * 64 + seq AS item_seq, least(1.0, len(terms) / divisor) AS strength, {_FAMILY} AS family FROM ({" UNION ALL ".join(hits)}) WHERE len(terms) > 0),
item AS (SELECT *, round(strength * recency * weight, 6) AS before_caps, list_sort(list_distinct(list(family) OVER g)) AS families, min(item_seq) OVER g AS first_seq FROM hit WINDOW g AS (PARTITION BY candidate_id, seq)),
adjusted AS (SELECT *, before_caps * CASE WHEN strict AND families = ['skill'] THEN {V.SKILL_ONLY_FACTOR!r} ELSE 1.0 END AS amount FROM item),
running AS (SELECT *, sum(amount) OVER (PARTITION BY candidate_id, seq ORDER BY before_caps DESC, item_seq ROWS UNBOUNDED PRECEDING) AS upto, row_number() OVER (PARTITION BY candidate_id ORDER BY first_seq, before_caps DESC, item_seq) - 1 AS idx FROM adjusted),
ledger AS (SELECT *, round(least(cap, upto) - least(cap, upto - amount), 6) AS after_caps, round(least(1.0, strength_r * 0.7 + level * 0.3), 6) AS confidence, 'EVID_' || candidate_id || '_' || lpad(CAST(idx AS VARCHAR), 4, '0') AS evidence_id
  FROM (SELECT *, round(strength, 6) AS strength_r, least(1.0, len(families) / 3.0) AS level FROM running))"""


_LEDGER = f"{_RECORDS}, {_evidence_sql()}"
_SUMS = ", ".join(f"round(coalesce(sum(after_caps) FILTER (WHERE category = {_text(n)}), 0), 6) AS {n}_score" for n in V.EVIDENCE)
_SUMMARY = f"""{_LEDGER}, cats AS (SELECT candidate_id, category, bool_or(polarity = 'positive' AND family = 'skill') AS in_skill, bool_or(polarity = 'positive' AND family = 'career') AS in_career, sum(after_caps) FILTER (WHERE polarity = 'positive') AS positive_sum FROM ledger GROUP BY ALL),
support AS (SELECT candidate_id, count(*) FILTER (WHERE in_skill) AS skills, count(*) FILTER (WHERE in_skill AND in_career) AS kept, sum(positive_sum) FILTER (WHERE in_skill AND NOT in_career) AS only_skill FROM cats GROUP BY ALL),
told AS (SELECT candidate_id, count(*) AS n, count(*) FILTER (WHERE polarity = 'positive') AS np, round(coalesce(sum(after_caps) FILTER (WHERE polarity = 'positive' AND family = 'career'), 0), 6) AS career, round(avg(confidence), 6) AS confidence,
  array_to_string((list(evidence_id ORDER BY after_caps DESC, item_seq) FILTER (WHERE polarity = 'positive'))[1:3], ',') AS top_positive, array_to_string((list(evidence_id ORDER BY after_caps DESC, item_seq) FILTER (WHERE polarity <> 'positive'))[1:3], ',') AS top_negative, {_SUMS} FROM ledger GROUP BY candidate_id),
summary AS (SELECT candidate_id, coalesce(n, 0) AS evidence_item_count, coalesce(np, 0) AS positive_evidence_count, coalesce(n - np, 0) AS negative_evidence_count, coalesce(career, 0) AS career_evidence_score, round(coalesce(only_skill, 0), 6) AS skill_only_evidence_score,
  coalesce(round(CASE WHEN skills > 0 THEN kept / skills::DOUBLE ELSE 0 END, 6), 0) AS skill_corroboration_score, coalesce(round(CASE WHEN skills > 0 THEN (skills - kept) / skills::DOUBLE ELSE 0 END, 6), 0) AS unsupported_skill_risk_score,
  coalesce(top_positive, '') AS top_positive_evidence_ids, coalesce(top_negative, '') AS top_negative_evidence_ids, coalesce(confidence, 0) AS evidence_confidence, {", ".join(f"coalesce({n}_score, 0) AS {n}_score" for n in V.EVIDENCE)}
  FROM rec LEFT JOIN told USING (candidate_id) LEFT JOIN support USING (candidate_id))"""


def _rules_sql() -> str:
    """Fired rules, with what the configuration says of each."""
    c = CONFIG["credibility"]
    overlap = f"(CASE WHEN s1 <= s2 THEN CASE WHEN s2 < coalesce(e1, ref) THEN {_months('s2', 'least(coalesce(e1, ref), e2)')} ELSE 0 END ELSE CASE WHEN s1 < e2 THEN {_months('s1', 'least(e2, coalesce(e1, ref))')} ELSE 0 END END)"
    risky = " + ".join(f"CAST({p} IN ('advanced', 'expert') AND {_any(f'lower({n})', c['risky_skill_terms'])} AS INTEGER)" for n, p in (("n1", "p1"), ("n2", "p2")))
    hits = " + ".join(f"CAST(contains(lower(t1 || ' ' || t2), {_text(t)}) AS INTEGER)" for t in c["title_terms"])
    rules = [(n, r["severity"], round(float(r["score_contribution"]), 6), r["explanation_label"]) for n, r in c["rules"].items() if r["enabled"]]
    table = "(VALUES " + ", ".join(f"({_text(n)}, {_text(s)}, {x!r}::DOUBLE, {_text(label)})" for n, s, x, label in rules) + ") rules(rule_name, severity, score_contribution, explanation_label)"
    return f"""{_ISSUES}, fired AS (
  SELECT candidate_id, type AS rule_name, 'candidate' AS source_path, reason AS detail FROM issue JOIN {_REASONS} USING (type)
  UNION ALL SELECT candidate_id, 'excessive_overlap', 'career_history', 'career history contains ' || {overlap} || ' overlapping months, above the {int(c["max_overlap_months"])}-month threshold' FROM rec WHERE {overlap} > {int(c["max_overlap_months"])}
  UNION ALL SELECT candidate_id, 'unsupported_advanced_skill', 'skills', ({risky}) || ' advanced skills lack career corroboration' FROM rec JOIN summary USING (candidate_id) WHERE {risky} >= {int(c["minimum_skill_count"])} AND unsupported_skill_risk_score > {float(c["corroboration_threshold"])!r}
  UNION ALL SELECT candidate_id, 'title_description_contradiction', 'career_history.title', 'titles imply relevance but descriptions do not support it' FROM rec WHERE {hits} >= {int(c["minimum_title_hits"])} AND NOT {_any("lower(coalesce(d1, '') || ' ' || d2)", c["support_terms"])}),
trigger_row AS (SELECT candidate_id, rule_name, severity, score_contribution, source_path, detail, explanation_label FROM fired JOIN {table} USING (rule_name)),
credibility AS (SELECT candidate_id, round(least(1.0, coalesce(sum(score_contribution), 0)), 6) AS anomaly_risk_score, greatest({float(c["severe_min"])!r}, round(1 - least(1.0, coalesce(sum(score_contribution), 0)), 6)) AS credibility_multiplier, count(rule_name) AS triggered_rule_count,
  count(*) FILTER (WHERE severity = 'minor') AS minor_rule_count, count(*) FILTER (WHERE severity = 'moderate') AS moderate_rule_count, count(*) FILTER (WHERE severity = 'severe') AS severe_rule_count FROM rec LEFT JOIN trigger_row USING (candidate_id) GROUP BY candidate_id)"""


def _behaviour_sql() -> str:
    b = CONFIG["behavioral"]
    w, r, loc = b["weights"], b["recency"], b["location"]
    age = "greatest(0, date_diff('day', active, ref))"
    last = f"CASE WHEN {age} <= {r['recent_days']} THEN {r['recent_score']!r} WHEN {age} >= {r['stale_days']} THEN {r['stale_score']!r} ELSE {r['recent_score']!r} - ({age} - {r['recent_days']}) / {float(r['stale_days'] - r['recent_days'])!r} * {r['recent_score'] - r['stale_score']!r} END::DOUBLE"
    best = "CASE WHEN skill_corroboration_score <= 0 THEN 0 WHEN k % 3 = 0 THEN greatest(k % 100, k % 70) / 100.0 ELSE 0 END"
    parts = {
        "open_to_work": "CAST(k % 2 = 0 AS DOUBLE)", "response_rate": "k % 100 / 100.0", "response_time": "1 - least(1.0, CASE WHEN k % 240 = 0 THEN 240 ELSE k % 240 END / 240.0)", "interview_completion": "k % 10 / 10.0",
        "notice_period": "1 - least(1.0, CASE WHEN k % 130 = 0 THEN 120 ELSE k % 130 END / 120.0)", "relocation": "CAST(k % 5 = 0 AS DOUBLE)", "work_mode": f"CAST(lower(work_mode) IN ({', '.join(map(_text, loc['preferred_modes']))}) AS DOUBLE)",
        "relevant_assessment": best, "github_activity": "least(1.0, k % 90 / 100.0)", "last_active_recency": "recency",
    }
    total = " + ".join(f"({sql}) * {float(w[n])!r}" for n, sql in parts.items())
    location = f"CASE WHEN lower(work_mode) IN ({', '.join(map(_text, loc['preferred_modes']))}) OR k % 5 = 0 OR lower(country) = {_text(loc['preferred_country'].lower())} THEN {float(loc['preferred_score'])!r} ELSE {float(loc['fallback_score'])!r} END::DOUBLE"
    return f"""behaviour AS (SELECT candidate_id, {location} AS location_logistics_score, round(recency, 6) AS last_active_recency_score, round({total}, 6) AS availability_signal_score,
  round(least(greatest({float(b["base"])!r} + ({total}) * {b["max"] - b["min"]!r}, {b["min"]!r}), {b["max"]!r}), 6) AS availability_multiplier, {", ".join(f"round(({sql}) * {float(w[n])!r}, 6) AS {n}_component" for n, sql in parts.items())}
  FROM (SELECT *, {last} AS recency FROM rec JOIN summary USING (candidate_id)))"""


def _clamp(sql: str) -> str:
    return f"least(greatest({sql}, 0.0), 1.0)"


def _scores_sql() -> str:
    cap = lambda c: _clamp(f"{c}_score / {float(CONFIG['evidence'][c]['cap'])!r}") if c in CONFIG["evidence"] else "0.0"
    n = {c: cap(c) for c in V.EVIDENCE}
    bands = "CASE " + " ".join(f"WHEN years BETWEEN {b['min_years']} AND {b['max_years']} THEN {float(b['score'])!r}" for b in CONFIG["rubric"]["experience_bands"]) + " ELSE 0.0 END"
    r, v, e, p, y, f = (n[c] for c in ("retrieval_ranking_relevance", "vector_ir_infrastructure", "ranking_evaluation_experimentation", "production_delivery_systems", "python_practical_engineering", "product_founding_behavior"))
    features = {
        "career_relevance_score": _clamp(f"0.7 * {r} + 0.15 * {y} + 0.15 * {f}"), "retrieval_ranking_depth_score": _clamp(f"0.45 * {r} + 0.35 * {v} + 0.20 * skill_corroboration_score"), "production_evaluation_score": _clamp(f"0.5 * {p} + 0.5 * {e}"),
        "product_shipper_score": _clamp(f"0.6 * {p} + 0.4 * {f}"), "experience_recent_coding_score": _clamp(f"0.6 * {bands} + 0.4 * {y}"), "corroborated_skill_score": _clamp(f"skill_corroboration_score * greatest({r}, {v}, {y})"),
        "preferred_differentiator_score": n["preferred_differentiators"], "location_logistics_score": _clamp("location_logistics_score"),
    }
    total = " + ".join(f"{float(CONFIG['scoring']['weights'][k])!r} * {sql}" for k, sql in features.items())
    base = _clamp(f"{total} - {V.UNSUPPORTED_WEIGHT!r} * unsupported_skill_risk_score - {V.RISK_WEIGHT!r} * {n['risk_signals']}")
    return f"""SELECT candidate_id, {", ".join(f"round({sql}, 6) AS {k}" for k, sql in features.items())}, round(unsupported_skill_risk_score, 6) AS unsupported_skill_risk_score, credibility_multiplier, availability_multiplier, anomaly_risk_score,
  round({base}, 6) AS base_fit_score, round({base} * credibility_multiplier * availability_multiplier * 100, 6) AS final_score, top_positive_evidence_ids, top_negative_evidence_ids
  FROM rec JOIN summary USING (candidate_id) JOIN credibility USING (candidate_id) JOIN behaviour USING (candidate_id)"""


def _baseline_sql() -> str:
    r, b = CONFIG["rubric"], CONFIG["baseline"]
    career, profile, skill = "coalesce(d1 || ' ', '') || d2 || ' ' || t1 || ' ' || t2", "coalesce(source, '') || CASE WHEN source <> '' AND lang <> '' THEN ' ' ELSE '' END || coalesce(lang, '')", "n1 || ' ' || n2"
    fields = {"career": "career", "profile_skills": "profile || ' ' || skill", "career_profile": "career || ' ' || profile", "career_skills": "career || ' ' || skill"}
    quoted = lambda t: "\\s+".join("".join(ch if ch.isalnum() or ch == "_" else "\\" + ch for ch in w) for w in t.split(" "))
    hits = lambda text, terms: "(" + " + ".join(f"CAST(regexp_matches(lower({text}), {_text('(^|[^\\p{L}\\p{N}_])' + quoted(t) + '([^\\p{L}\\p{N}_]|$)')}) AS INTEGER)" for t in terms) + ")"

    def score(name: str) -> str:
        x = r["lexicon"][name]
        return _clamp(" + ".join(f"{float(weight)!r} * least(1.0, {hits(fields[f], x['terms'])} / {float(x['hit_divisors'][f])!r})" for f, weight in x["field_weights"].items()))

    a, w, low = r["availability"], b["weights"], b["low_relevance"]
    loc = r["location"]
    location = f"CASE WHEN lower(work_mode) IN ({', '.join(map(_text, loc['preferred_modes']))}) OR k % 5 = 0 OR lower(country) = {_text(loc['preferred_country'].lower())} THEN {float(loc['preferred_score'])!r} ELSE {float(loc['fallback_score'])!r} END::DOUBLE"
    free = _clamp(
        f"CAST(k % 2 = 0 AS DOUBLE) * {a['open_to_work']!r} + k % 100 / 100.0 * {a['response_rate']!r} + (1 - least(CASE WHEN k % 240 = 0 THEN 999.0 ELSE k % 240 END, {float(a['max_response_time_hours'])!r}) / {float(a['max_response_time_hours'])!r}) * {a['response_time']!r}"
        f" + (1 - least(CASE WHEN k % 130 = 0 THEN 180.0 ELSE k % 130 END, {float(a['max_notice_days'])!r}) / {float(a['max_notice_days'])!r}) * {a['notice_period']!r}"
    )
    bands = "CASE " + " ".join(f"WHEN years BETWEEN {x['min_years']} AND {x['max_years']} THEN {float(x['score'])!r}" for x in r["experience_bands"]) + " ELSE 0.0 END::DOUBLE"
    penalty = "CASE anomaly_severity " + " ".join(f"WHEN {_text(k)} THEN {float(v)!r}" for k, v in b["penalty"].items() if k != "default") + " END::DOUBLE"
    parts = (("career_text_relevance", "base"), ("production_evaluation", "prod"), ("python_engineering", "py"), ("experience_plausibility", "years_score"), ("location_logistics", "loc"), ("behavioral_availability", "free"))
    raw = f"greatest(0.0, ({' + '.join(f'{float(w[n])!r} * {c}' for n, c in parts)} - penalty) * 100)"
    lex = r["lexicon"]
    good = ", ".join(f"CASE WHEN {c} > 0 THEN {_text(lex[n]['evidence'])} END" for n, c in (("role_relevance", "career_hits"), ("production_evaluation", "prod"), ("python_engineering", "py")))
    return f"""WITH {_RECORDS}, {_ISSUES}, texts AS (SELECT *, {career} AS career, {profile} AS profile, {skill} AS skill FROM rec),
grade AS (SELECT candidate_id, CASE WHEN bool_or(severity = 'severe') THEN 'severe' WHEN count(type) > 0 THEN 'minor' ELSE 'none' END AS anomaly_severity FROM rec LEFT JOIN (SELECT * FROM issue JOIN {_REASONS} USING (type)) USING (candidate_id) GROUP BY candidate_id),
scored AS (SELECT candidate_id, anomaly_severity, {score("role_relevance")} AS base, {score("production_evaluation")} AS prod, {score("python_engineering")} AS py, {hits("career", lex["role_relevance"]["terms"])} AS career_hits, {bands} AS years_score, {location} AS loc, {free} AS free, {penalty} AS penalty
  FROM texts JOIN grade USING (candidate_id))
SELECT candidate_id, round(base, 6) AS base_relevance_score, round(prod, 6) AS production_evaluation_score, round(py, 6) AS python_engineering_score, round(years_score, 6) AS experience_score, round(loc, 6) AS location_logistics_score, round(free, 6) AS availability_score,
  round(penalty, 6) AS anomaly_penalty, round(CASE WHEN base < {float(low["threshold"])!r} THEN least({raw}, {float(low["max_score"])!r}) ELSE {raw} END, 6) AS final_score,
  CASE WHEN len(good) > 0 THEN array_to_string(good, '; ') ELSE {_text(V.NO_EVIDENCE)} END AS top_positive_evidence,
  array_to_string(list_filter([CASE WHEN penalty > 0 THEN anomaly_severity || ' audit anomalies reduce confidence' END, CASE WHEN base < {float(low["threshold"])!r} THEN {_text(V.WEAK_EVIDENCE)} END], lambda x: x IS NOT NULL), '; ') AS top_negative_evidence
FROM (SELECT *, list_filter([{good}], lambda x: x IS NOT NULL) AS good FROM scored)"""


# -- the queries ------------------------------------------------------------------------------------------------------

_LEDGER_COLUMNS = ["candidate_id", "source_path", "source_type", "normalized_category", "polarity", "evidence_strength", "recency_weight", "configured_weight", "contribution_before_caps", "contribution_after_caps", "corroboration_level", "confidence", "evidence_id"]


def audit_issues(t):
    """Failed audit rules of the records, one row each."""
    return audit.issue_rows(records(t), reference()).select("candidate_id", "type", "severity", "reason")


def engine_ledger(t):
    """The evidence ledger, provenance hashes included."""
    rows = evidence.ledger(flat(t), CONFIG, reference())
    return rows.select(*_LEDGER_COLUMNS, F.array_join("matched_terms", ",").alias("matched_terms"), F.col("evidence_index").cast("long").alias("evidence_index"), F.sha2(F.coalesce("exact_source_excerpt", F.lit("")).cast("binary"), 256).alias("excerpt_hash"))


def provenance_hashes(t):
    """The canonical hash of every ledger row over texts that need no escapes: of titles and skills."""
    rows = evidence.ledger(flat(t), CONFIG, reference()).where(F.col("source_type").isin("career_title", "skill", "assessment"))
    return rows.select("evidence_id", "provenance_hash")


def graded(t) -> DataFrame:
    """Records with their ledger rows as an array."""
    return evidence.with_graded(flat(t), CONFIG, reference())


def _joined(df: DataFrame) -> DataFrame:
    lists = [c for c in df.columns if c.endswith("_evidence_ids")]
    return df.withColumns({c: F.array_join(c, ",") for c in lists} | {c: F.col(c).cast("long") for c in df.columns if c.endswith("_count")})


def engine_summary(t):
    """One evidence summary for each record, zeros where it has none."""
    return _joined(evidence.summary(graded(t)))


def _triggered(t) -> DataFrame:
    return credibility.triggered(evidence.with_summary(graded(t)).drop("graded"), CONFIG, reference())


def engine_triggers(t):
    """Fired credibility rules, the audit's and those on evidence."""
    return credibility.trigger_rows(_triggered(t)).drop("candidate_facing_reasoning_eligible")


def engine_credibility(t):
    """The bounded risk fold of each record."""
    return _joined(credibility.breakdown(_triggered(t), CONFIG)).drop("unsupported_skill_risk_score", "evidence_risk_score")


def engine_behaviour(t):
    """Availability components and the bounded multiplier of each record."""
    rows = evidence.with_summary(graded(t))
    return rows.select("candidate_id", *[c.alias(n) for n, c in scoring.availability_columns(CONFIG, reference()).items()])


#: What a score or an explanation takes from a normalized record.
_CONTEXT = ["profile", "career_history", "skills", "skill_assessments", "signals"]
_SIGNALS = ["years_of_experience", "preferred_work_mode", "willing_to_relocate", "country", "last_active_date", "open_to_work_flag", "recruiter_response_rate", "avg_response_time_hours", "interview_completion_rate", "notice_period_days", "github_activity_score"]


def scores(t) -> tuple[DataFrame, DataFrame]:
    """(records, scores): records and their summaries are worked out and stored once; the stages' tables are joined as a run joins them."""
    rows = evidence.with_graded(flat(t), CONFIG, reference())
    stored = cut(evidence.with_summary(rows).drop("graded").select("candidate_id", *_CONTEXT, *_SIGNALS, *evidence.SUMMARY))
    summary = stored.select("candidate_id", *evidence.SUMMARY)
    risks = credibility.breakdown(credibility.triggered(stored, CONFIG, reference()), CONFIG)
    free = stored.select("candidate_id", *[c.alias(n) for n, c in scoring.availability_columns(CONFIG, reference()).items()])
    return stored, scoring.final_scores(stored.select("candidate_id", "years_of_experience"), summary, risks, free, CONFIG)


def engine_scores(t):
    """The full score breakdown."""
    return _joined(scores(t)[1]).drop("score_version", "deterministic_tie_break_key", "semantic_score")


def engine_baseline(t):
    """The baseline score breakdown."""
    return scoring.baseline_scores(flat(t), CONFIG).drop("deterministic_tie_break_key")


def _decided(t) -> DataFrame:
    stored, s = scores(t)
    top = cut(scoring.rank_top(s))
    few = stored.join(F.broadcast(top.select("candidate_id")), "candidate_id", "left_semi")  # a hundred ids
    return explain.decided(top, evidence.ledger(few, CONFIG, reference(), with_hash=False), few)


def engine_judgements(t):
    """What the explanations of the top hundred rest on: band, family, constraint, limitation, evidence by side and the picked rows."""
    ids = lambda side, n: F.array_join(F.transform(F.slice(side, 1, n), lambda e: e["evidence_id"]), ",")
    picked = F.array_join(F.transform("picks", lambda e: F.coalesce(e["evidence_id"], F.lit("-"))), ",").alias("picked_ids")
    return _decided(t).select(
        "candidate_id", F.col("rank").cast("long").alias("rank"), "band", "family", "viable", "constraint", "limitation", "material", "category", picked,
        ids("positives", 6).alias("positive_ids"), ids("negatives", 3).alias("negative_ids"),
    )


def engine_explanations(t):
    """Explanations of the top hundred; only their ledger rows are made."""
    stored, s = scores(t)
    top = cut(scoring.rank_top(s))
    few = stored.join(F.broadcast(top.select("candidate_id")), "candidate_id", "left_semi")  # a hundred ids
    return explain.explanations(top, evidence.ledger(few, CONFIG, reference(), with_hash=False), few, strict=False)


_LEDGER_SQL = f"""WITH {_LEDGER} SELECT candidate_id, source_path, source_type, category AS normalized_category, polarity, strength_r AS evidence_strength, round(recency, 6) AS recency_weight, round(weight, 6) AS configured_weight,
  before_caps AS contribution_before_caps, after_caps AS contribution_after_caps, round(level, 6) AS corroboration_level, confidence, evidence_id, array_to_string(terms, ',') AS matched_terms, CAST(idx AS BIGINT) AS evidence_index, sha256(excerpt) AS excerpt_hash FROM ledger"""
_HASH_SQL = f"""WITH {_LEDGER} SELECT evidence_id, sha256('{{"candidate_id": "' || candidate_id || '", "excerpt": "' || excerpt || '", "matched_terms": ["' || array_to_string(terms, '", "') || '"], "normalized_category": "' || category || '", "source_path": "' || source_path || '"}}') AS provenance_hash
  FROM ledger WHERE source_type IN ('career_title', 'skill', 'assessment')"""
_FULL = f"{_SUMMARY}, {_rules_sql()}, {_behaviour_sql()}"


def _judgements_sql() -> str:
    """The explanations' decisions, from scores and ledger by windows and lists."""
    has = lambda *names: "(" + " OR ".join(f"list_contains(cats, {_text(n)})" for n in names) + ")"
    flexible = ", ".join(map(_text, explain.FLEXIBLE))
    late, away, doubtful, scarce = f"notice > {explain.LONG_NOTICE}", f"location_logistics_score < {explain.FAR}", f"credibility_multiplier < {explain.WEAK}", f"availability_multiplier < {explain.WEAK}"
    missing = "CASE " + " ".join(f"WHEN NOT {has(n)} THEN {_text(f'explicit evidence of {what} is limited in the available profile')}" for n, what in explain.EXPECTED) + " END"
    band = "CASE " + " ".join(f"WHEN rank BETWEEN {a} AND {b} THEN {_text(n)}" for a, b, n in V.RANK_BANDS) + f" ELSE {_text(V.RANK_BANDS[-1][2])} END"
    priority = "CASE source_type " + " ".join(f"WHEN {_text(k)} THEN {v}" for k, v in V.SOURCE_PRIORITY.items()) + " ELSE 3 END"
    first = lambda names: "coalesce(" + ", ".join(f"list_filter(pos, lambda e: e.category = {_text(n)})[1]" for n in names) + ", pos[1])"
    side = lambda name, ids: f"row_number() OVER (PARTITION BY l.candidate_id ORDER BY CASE WHEN {ids} <> '' THEN NOT list_contains(string_split({ids}, ','), evidence_id) END, CASE WHEN {ids} <> '' THEN -after_caps END, idx) AS {name}"
    picks = [first(wanted) for wanted, _ in explain.FACTS]
    return f"""scored AS ({_scores_sql()}),
top AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY final_score DESC, candidate_id) AS rank FROM scored) WHERE rank <= 100),
sided AS (SELECT l.*, {side("p", "top_positive_evidence_ids")}, {side("n", "top_negative_evidence_ids")}, {priority} AS priority FROM ledger l JOIN top USING (candidate_id)),
plus AS (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY p) AS place FROM sided WHERE polarity = 'positive'),
minus AS (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY n) AS place FROM sided WHERE polarity = 'negative'),
pluses AS (SELECT candidate_id, list(category) AS cats, lower(string_agg(array_to_string(terms, ' '), ' ')) AS said, list({{'id': evidence_id, 'category': category}} ORDER BY priority, -after_caps, place) AS pos, array_to_string((list(evidence_id ORDER BY place))[1:6], ',') AS positive_ids FROM plus GROUP BY candidate_id),
minuses AS (SELECT candidate_id, array_to_string((list(evidence_id ORDER BY place))[1:3], ',') AS negative_ids, first(lower(trim(terms[1])) ORDER BY place) AS label FROM minus GROUP BY candidate_id),
known AS (SELECT candidate_id, rank, credibility_multiplier, availability_multiplier, location_logistics_score, coalesce(cats, []) AS cats, coalesce(said, '') AS said, coalesce(pos, []) AS pos, coalesce(positive_ids, '') AS positive_ids, coalesce(negative_ids, '') AS negative_ids,
    label, k % 130 AS notice, lower(work_mode) AS mode, k % 5 = 0 AS relocates, k % 100 / 100.0 AS response, k % 240 AS hours, trim(country) AS country FROM top JOIN rec USING (candidate_id) LEFT JOIN pluses USING (candidate_id) LEFT JOIN minuses USING (candidate_id)),
judged AS (SELECT *, {missing} AS missing, negative_ids <> '' AS firm FROM known)
SELECT candidate_id, rank, {band} AS band,
  CASE WHEN rank >= {V.RANK_BANDS[-1][0]} THEN 'lower_cutoff_candidate' WHEN {doubtful} THEN 'credibility_constrained' WHEN {scarce} OR {late} OR {away} THEN 'availability_logistics_constrained'
    WHEN contains(said, 'recommend') OR contains(said, 'matching') THEN 'recommendation_matching_heavy' WHEN {has("retrieval_ranking_relevance", "ranking_evaluation_experimentation")} THEN 'retrieval_ranking_heavy'
    WHEN {has("production_delivery_systems")} AND {has("ranking_evaluation_experimentation")} THEN 'production_and_evaluation_heavy' WHEN {has("python_practical_engineering", "product_founding_behavior")} THEN 'python_product_ownership_heavy' ELSE 'adjacent_but_credible' END AS family,
  CASE WHEN NOT ({scarce}) AND NOT ({late}) AND mode IN ({flexible}) AND country <> '' THEN country || '-based ' || mode || ' compatibility supports shortlist viability' END AS viable,
  CASE WHEN {late} THEN 'a ' || notice || '-day notice period slows availability' WHEN mode NOT IN ({flexible}) AND NOT relocates THEN CASE WHEN mode <> '' THEN mode ELSE 'less flexible' END || ' work-mode preference narrows logistics flexibility'
    WHEN response < 0.25 THEN 'response history is thinner than stronger candidates' WHEN hours >= 72 THEN 'slower response timing reduces availability confidence' WHEN {away} THEN 'location logistics are less flexible than the strongest candidates' END AS "constraint",
  CASE WHEN {doubtful} THEN 'profile consistency is weaker than the strongest candidates' WHEN {scarce} OR {late} THEN 'availability signals are weaker than the strongest candidates' WHEN missing IS NOT NULL THEN missing
    WHEN firm THEN 'some profile detail remains less complete around ' || label END AS limitation,
  ({doubtful}) OR ({scarce}) OR ({late}) OR (missing IS NULL AND firm) AS material, coalesce(({picks[0]}).category, {_text(explain.FACTS[0][1])}) AS category,
  array_to_string([{", ".join(f"coalesce(({p}).id, '-')" for p in picks)}], ',') AS picked_ids, positive_ids, negative_ids
FROM judged"""


#: name: (function, SQL)
ENGINE = {
    "q_audit_issues": (audit_issues, f"WITH {_RECORDS}, {_ISSUES} SELECT candidate_id, type, severity, reason FROM issue JOIN {_REASONS} USING (type)"),
    "q_engine_ledger": (engine_ledger, _LEDGER_SQL),
    "q_engine_provenance": (provenance_hashes, _HASH_SQL),
    "q_engine_summary": (engine_summary, f"WITH {_SUMMARY} SELECT * FROM summary"),
    "q_engine_triggers": (engine_triggers, f"WITH {_SUMMARY}, {_rules_sql()} SELECT * FROM trigger_row"),
    "q_engine_credibility": (engine_credibility, f"WITH {_SUMMARY}, {_rules_sql()} SELECT * FROM credibility"),
    "q_engine_behaviour": (engine_behaviour, f"WITH {_SUMMARY}, {_behaviour_sql()} SELECT * FROM behaviour"),
    "q_engine_scores": (engine_scores, f"WITH {_FULL} {_scores_sql()}"),
    "q_engine_baseline": (engine_baseline, _baseline_sql()),
    "q_engine_judgements": (engine_judgements, f"WITH {_FULL}, {_judgements_sql()}"),
    "q_engine_explanations": (engine_explanations, None),
}
