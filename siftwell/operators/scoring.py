"""Availability multiplier, final score, baseline score and their rankings."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.config import Config
from siftwell.functions import columns as C
from siftwell.functions import fixed_values as V
from siftwell.functions import folds
from siftwell.operators import credibility, evidence


def location_score(rules: Mapping[str, Any]) -> Column:
    """Preferred by work mode, by willingness to relocate or by country."""
    good = F.lower("preferred_work_mode").isin(*rules["preferred_modes"]) | F.col("willing_to_relocate") | (F.lower("country") == str(rules["preferred_country"]).lower())
    return F.when(good, F.lit(float(rules["preferred_score"]))).otherwise(F.lit(float(rules["fallback_score"])))


def availability(flat: DataFrame, summary: DataFrame, config: Config, reference: Column) -> DataFrame:
    """Ten weighted components of a candidate's signals and the bounded multiplier.

    Stored zeros of response time and notice count as unknown, which earns nothing.
    """
    rows = flat.join(summary.select("candidate_id", "skill_corroboration_score"), "candidate_id", "left")
    return rows.select("candidate_id", *[c.alias(n) for n, c in availability_columns(config, reference).items()])


def availability_columns(config: Config, reference: Column) -> dict[str, Column]:
    """The availability breakdown as columns over normalized rows that carry ``skill_corroboration_score``."""
    b = config["behavioral"]
    w, recency = b["weights"], b["recency"]
    best = F.coalesce(F.array_max(F.transform("skill_assessments", lambda a: a["score"])), F.lit(0.0)) / 100.0
    assessed = F.when(F.coalesce(F.col("skill_corroboration_score") <= 0, F.lit(False)), F.lit(0.0)).otherwise(best)
    last = C.linear_recency(C.day_age(C.parse_date("last_active_date"), reference), recency["recent_days"], recency["stale_days"], recency["recent_score"], recency["stale_score"])
    last = F.when(C.parse_date("last_active_date").isNull(), F.lit(float(recency["stale_score"]))).otherwise(last)
    flag = lambda c: F.col(c).cast("double")
    parts = {
        "open_to_work": flag("open_to_work_flag"),
        "response_rate": C.clamp(F.col("recruiter_response_rate")),
        "response_time": 1 - C.to_cap(C.or_default("avg_response_time_hours", 240.0), 240),
        "interview_completion": C.clamp(F.col("interview_completion_rate")),
        "notice_period": 1 - C.to_cap(C.or_default(F.col("notice_period_days").cast("double"), 120.0), 120),
        "relocation": flag("willing_to_relocate"),
        "work_mode": F.lower("preferred_work_mode").isin(*b["location"]["preferred_modes"]).cast("double"),
        "relevant_assessment": assessed,
        "github_activity": C.to_cap("github_activity_score", 100),
        "last_active_recency": C.clamp(last),
    }
    parts = {f"{n}_component": c * F.lit(float(w[n])) for n, c in parts.items()}
    total = sum(parts.values(), F.lit(0.0))
    multiplier = C.clamp(F.lit(float(b["base"])) + total * (b["max"] - b["min"]), b["min"], b["max"])
    return {
        "location_logistics_score": C.r6(location_score(b["location"])),
        "last_active_recency_score": C.r6(last),
        "availability_signal_score": C.r6(total),
        "availability_multiplier": C.r6(multiplier),
        **{n: C.r6(c) for n, c in parts.items()},
    }


class MissingInput(ValueError):
    """A candidate lacks a row that every candidate must have."""


def final_scores(flat: DataFrame, summary: DataFrame, credibility: DataFrame, behavioral: DataFrame, config: Config, semantic: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """The score breakdown (without rank): all inputs 1:1 on candidate_id, the sparse semantic table by a left join.

    With ``strict`` a candidate without its evidence, credibility or behaviour row is an error.
    """
    how = "left" if strict else "inner"
    rows = flat.select("candidate_id", "years_of_experience").join(summary, "candidate_id", how)
    rows = rows.join(credibility.select("candidate_id", "credibility_multiplier", "anomaly_risk_score"), "candidate_id", how)
    rows = rows.join(behavioral.select("candidate_id", "availability_multiplier", "location_logistics_score"), "candidate_id", how)
    if semantic is not None:
        rows = rows.join(semantic.select("candidate_id", "semantic_score"), "candidate_id", "left")
    else:
        rows = rows.withColumn("semantic_score", F.lit(0.0))
    if strict:
        whole = F.col("evidence_item_count").isNotNull() & F.col("credibility_multiplier").isNotNull() & F.col("availability_multiplier").isNotNull()
        rows = rows.withColumn("years_of_experience", F.when(whole, F.col("years_of_experience")).otherwise(F.raise_error(F.concat(F.lit("no evidence, credibility or behaviour row for "), "candidate_id")).cast("double")))
    return formula(rows, config)


def formula(rows: DataFrame, config: Config) -> DataFrame:
    """The score breakdown of rows that carry years, the evidence summary, both multipliers, risk, location and ``semantic_score``."""
    n = {c: C.to_cap(f"{c}_score", config["evidence"][c]["cap"]) if c in config["evidence"] else F.lit(0.0) for c in V.EVIDENCE}
    retrieval, vector, rank_eval = n["retrieval_ranking_relevance"], n["vector_ir_infrastructure"], n["ranking_evaluation_experimentation"]
    shipped, python, product = n["production_delivery_systems"], n["python_practical_engineering"], n["product_founding_behavior"]
    corroborated = F.col("skill_corroboration_score")
    bands = [(b["min_years"], b["max_years"], b["score"]) for b in config["rubric"]["experience_bands"]]
    features = {
        "career_relevance_score": C.clamp(0.7 * retrieval + 0.15 * python + 0.15 * product),
        "retrieval_ranking_depth_score": C.clamp(0.45 * retrieval + 0.35 * vector + 0.20 * corroborated),
        "production_evaluation_score": C.clamp(0.5 * shipped + 0.5 * rank_eval),
        "product_shipper_score": C.clamp(0.6 * shipped + 0.4 * product),
        "experience_recent_coding_score": C.clamp(0.6 * C.first_band("years_of_experience", bands) + 0.4 * python),
        "corroborated_skill_score": C.clamp(corroborated * F.greatest(retrieval, vector, python)),
        "preferred_differentiator_score": n["preferred_differentiators"],
        "location_logistics_score": C.clamp(F.col("location_logistics_score")),
    }
    weights = config["scoring"]["weights"]
    semantic_score, unsupported = C.clamp(F.coalesce("semantic_score", F.lit(0.0))), C.clamp(F.col("unsupported_skill_risk_score"))
    total = sum((F.lit(float(weights[k])) * c for k, c in features.items()), F.lit(0.0))
    base = C.clamp(total + F.lit(float(config["scoring"]["semantic_cap"])) * semantic_score - V.UNSUPPORTED_WEIGHT * unsupported - V.RISK_WEIGHT * n["risk_signals"])
    return rows.select(
        "candidate_id",
        *[C.r6(c).alias(k) for k, c in features.items()],
        C.r6(unsupported).alias("unsupported_skill_risk_score"),
        C.r6("credibility_multiplier").alias("credibility_multiplier"),
        C.r6("availability_multiplier").alias("availability_multiplier"),
        C.r6("anomaly_risk_score").alias("anomaly_risk_score"),
        C.r6(base).alias("base_fit_score"),
        C.r6(base * F.col("credibility_multiplier") * F.col("availability_multiplier") * 100).alias("final_score"),
        "top_positive_evidence_ids",
        "top_negative_evidence_ids",
        F.lit(V.SCORE_VERSION).alias("score_version"),
        F.col("candidate_id").alias("deterministic_tie_break_key"),
        C.r6(semantic_score).alias("semantic_score"),
    )


def scored(context: DataFrame, config: Config, reference: Column) -> DataFrame:
    """The score breakdown of normalized rows, each worked out within its row: for streams and single batches, without a join."""
    rows = evidence.with_summary(evidence.with_graded(context, config, reference)).drop("graded")
    rows = credibility.triggered(rows, config, reference)
    risk = credibility.breakdown_columns(config)
    kept = {n: risk[n] for n in ("credibility_multiplier", "anomaly_risk_score")}
    made = availability_columns(config, reference)
    rows = rows.withColumns(kept | {n: made[n] for n in ("availability_multiplier", "location_logistics_score")})
    return formula(rows.withColumn("semantic_score", F.lit(0.0)), config)


def rank_all(scores: DataFrame) -> DataFrame:
    """Every row with its rank by score, then id."""
    return folds.ranked(scores, F.desc("final_score"), F.asc("candidate_id"))


def rank_top(scores: DataFrame, limit: int = 100) -> DataFrame:
    """The best ``limit`` rows with their rank."""
    return folds.top(scores, limit, F.desc("final_score"), F.asc("candidate_id"))


def cohort(top: DataFrame) -> dict[str, dict[str, int]]:
    """Counts of the top rows by score and multiplier bands."""
    s, c, a = F.col("final_score"), F.col("credibility_multiplier"), F.col("availability_multiplier")
    r = top.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(c >= 0.95).alias("c1"), F.count_if((c < 0.95) & (c >= 0.8)).alias("c2"), F.count_if(c < 0.8).alias("c3"),
        F.count_if(a >= 1.0).alias("a1"), F.count_if((a < 1.0) & (a >= 0.85)).alias("a2"), F.count_if(a < 0.85).alias("a3"), F.avg(s).alias("mean"),
    ).head()
    return {"count": r["n"], "mean_score": r["mean"], "credibility": {">=0.95": r["c1"], "0.8-0.95": r["c2"], "<0.8": r["c3"]}, "availability": {">=1.0": r["a1"], "0.85-1.0": r["a2"], "<0.85": r["a3"]}}


def baseline_scores(flat: DataFrame, config: Config) -> DataFrame:
    """The single-pass baseline: word-boundary lexicons over combined texts, logistics, availability and a penalty."""
    r, b = config["rubric"], config["baseline"]
    lex, avail, w = r["lexicon"], r["availability"], b["weights"]
    career, profile, skill = (C.empty_if_null(f"combined_{x}_text") for x in ("career", "profile", "skill"))
    both = lambda x, y: F.concat(x, F.lit(" "), y)
    fields = {"career": career, "profile_skills": both(profile, skill), "career_profile": both(career, profile), "career_skills": both(career, skill)}
    score = lambda n: C.weighted_word_score(fields, lex[n]["terms"], lex[n]["field_weights"], lex[n]["hit_divisors"])
    capped = lambda c, default, most: 1 - F.least(C.or_default(c, default), F.lit(float(most))) / F.lit(float(most))
    rows = flat.select(
        "candidate_id",
        score("role_relevance").alias("base"),
        score("production_evaluation").alias("prod"),
        score("python_engineering").alias("py"),
        C.word_hits(career, lex["role_relevance"]["terms"]).alias("career_hits"),
        C.first_band("years_of_experience", [(x["min_years"], x["max_years"], x["score"]) for x in r["experience_bands"]]).alias("exp"),
        location_score(r["location"]).alias("loc"),
        C.clamp(
            F.col("open_to_work_flag").cast("double") * avail["open_to_work"]
            + C.clamp(F.coalesce("recruiter_response_rate", F.lit(0.0))) * avail["response_rate"]
            + capped("avg_response_time_hours", 999.0, avail["max_response_time_hours"]) * avail["response_time"]
            + capped(F.col("notice_period_days").cast("double"), 180.0, avail["max_notice_days"]) * avail["notice_period"]
        ).alias("avail"),
        F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, v in b["penalty"].items() if k != "default" for x in (k, float(v))]), F.col("anomaly_severity")), F.lit(float(b["penalty"]["default"]))).alias("penalty"),
        "anomaly_severity",
    )
    c = F.col
    parts = (("career_text_relevance", "base"), ("production_evaluation", "prod"), ("python_engineering", "py"), ("experience_plausibility", "exp"), ("location_logistics", "loc"), ("behavioral_availability", "avail"))
    raw = F.greatest(F.lit(0.0), (sum((F.lit(float(w[k])) * c(x) for k, x in parts), F.lit(0.0)) - c("penalty")) * 100)
    low = c("base") < float(b["low_relevance"]["threshold"])
    good = F.array_compact(F.array(F.when(c("career_hits") > 0, F.lit(lex["role_relevance"]["evidence"])), F.when(c("prod") > 0, F.lit(lex["production_evaluation"]["evidence"])), F.when(c("py") > 0, F.lit(lex["python_engineering"]["evidence"]))))
    bad = F.array_compact(F.array(F.when(c("penalty") > 0, F.concat("anomaly_severity", F.lit(" audit anomalies reduce confidence"))), F.when(low, F.lit(V.WEAK_EVIDENCE))))
    return rows.select(
        "candidate_id",
        C.r6("base").alias("base_relevance_score"),
        C.r6("prod").alias("production_evaluation_score"),
        C.r6("py").alias("python_engineering_score"),
        C.r6("exp").alias("experience_score"),
        C.r6("loc").alias("location_logistics_score"),
        C.r6("avail").alias("availability_score"),
        C.r6("penalty").alias("anomaly_penalty"),
        C.r6(F.when(low, F.least(raw, F.lit(float(b["low_relevance"]["max_score"])))).otherwise(raw)).alias("final_score"),
        F.col("candidate_id").alias("deterministic_tie_break_key"),
        F.when(F.size(good) > 0, F.array_join(good, "; ")).otherwise(F.lit(V.NO_EVIDENCE)).alias("top_positive_evidence"),
        F.array_join(bad, "; ").alias("top_negative_evidence"),
    )


def baseline_explanation() -> Column:
    """One sentence from the positive evidence, with the weakness where there is one."""
    clean = lambda c: F.when(F.lower(F.trim(c)) == "nan", F.lit("")).otherwise(F.trim(F.coalesce(F.col(c), F.lit(""))))
    positive = F.when(clean("top_positive_evidence") == "", F.lit("limited relevant evidence found")).otherwise(clean("top_positive_evidence"))
    negative = clean("top_negative_evidence")
    text = F.concat(F.upper(F.left(positive, F.lit(1))), F.substring(positive, F.lit(2), F.length(positive)), F.lit(", which is relevant to a Senior AI Engineer ranking role."))
    return F.when(negative != "", F.concat(text, F.lit(" Weakness: "), negative, F.lit("."))).otherwise(text)
