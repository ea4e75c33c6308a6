"""Credibility: a rule registry over contexts and evidence summaries, and the bounded risk fold."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.config import Config, ConfigError
from siftwell.functions import columns as C
from siftwell.functions import fixed_values as V
from siftwell.operators.audit import issues

TRIGGER = "array<struct<rule_name:string,severity:string,score_contribution:double,source_path:string,detail:string,explanation_label:string,candidate_facing_reasoning_eligible:boolean>>"


def overlap_months(history: Column, reference: Column) -> Column:
    """Months by which roles that are neighbours by start overlap; an open role ends at the reference date."""
    dated = F.filter(F.transform(history, lambda r: F.struct(C.parse_date(r["start_date"]).alias("s"), F.coalesce(C.parse_date(r["end_date"]), reference).alias("e"))), lambda x: x["s"].isNotNull())
    ordered = F.array_sort(dated)
    pairs = F.zip_with(F.slice(ordered, 1, F.greatest(F.size(ordered) - 1, F.lit(0))), F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0))), lambda a, b: F.when(b["s"] < a["e"], C.months_between(b["s"], F.least(a["e"], b["e"]))).otherwise(F.lit(0)))
    return F.aggregate(pairs, F.lit(0), lambda acc, m: acc + m)


def _forwarded(rule: str) -> Callable[[Config, Column], Column]:
    """Every audit issue of the rule's type: (source path, detail)."""
    return lambda config, ref: F.transform(F.filter("issues", lambda i: i["type"] == rule), lambda i: F.struct(F.lit("candidate").alias("source_path"), i["reason"].alias("detail")))


def _once(condition: Column, path: str, detail: Column) -> Column:
    return F.when(condition, F.array(F.struct(F.lit(path).alias("source_path"), detail.alias("detail"))))


def _overlap(config: Config, ref: Column) -> Column:
    most, months = int(config["credibility"]["max_overlap_months"]), overlap_months(F.col("career_history"), ref)
    return _once(months > most, "career_history", F.concat(F.lit("career history contains "), months.cast("string"), F.lit(f" overlapping months, above the {most}-month threshold")))


def _unsupported(config: Config, ref: Column) -> Column:
    c = config["credibility"]
    risky = F.size(F.filter("skills", lambda s: F.lower(C.empty_if_null(s["proficiency"])).isin("advanced", "expert") & C.contains_any(F.lower(C.empty_if_null(s["name"])), c["risky_skill_terms"])))
    fired = (risky >= int(c["minimum_skill_count"])) & (F.coalesce("unsupported_skill_risk_score", F.lit(0.0)) > float(c["corroboration_threshold"]))
    return _once(fired, "skills", F.concat(risky.cast("string"), F.lit(" advanced skills lack career corroboration")))


def _contradiction(config: Config, ref: Column) -> Column:
    c = config["credibility"]
    joined = lambda f: F.lower(F.array_join(F.transform("career_history", lambda r: C.empty_if_null(r[f])), " "))
    hits = F.lit(0)
    for t in c["title_terms"]:
        hits = hits + F.contains(joined("title"), F.lit(t)).cast("int")
    fired = (hits >= int(c["minimum_title_hits"])) & ~C.contains_any(joined("description"), c["support_terms"])
    return _once(fired, "career_history.title", F.lit("titles imply relevance but descriptions do not support it"))


#: rule name -> (config, reference date) -> array of (source_path, detail), null or empty where it doesn't fire
RULES: dict[str, Callable[[Config, Column], Column]] = {
    **{rule: _forwarded(rule) for rule in V.ISSUE_REASONS},
    "excessive_overlap": _overlap,
    "unsupported_advanced_skill": _unsupported,
    "title_description_contradiction": _contradiction,
}


def check_registry(config: Config) -> None:
    """Every rule must be configured, and every enabled one known."""
    configured = config["credibility"]["rules"]
    if unknown := [n for n, r in configured.items() if r["enabled"] and n not in RULES]:
        raise ConfigError(f"enabled rules without a handler: {sorted(unknown)}")
    if missing := [n for n in RULES if n not in configured]:
        raise ConfigError(f"rules without a configuration: {sorted(missing)}")


def with_triggers(context: DataFrame, summary: DataFrame, config: Config, reference: Column) -> DataFrame:
    """Contexts with their evidence risks and ``triggers``."""
    return triggered(context.join(summary.select("candidate_id", *RISKS), "candidate_id", "left"), config, reference)


#: What the rules take from the evidence summary.
RISKS = ["unsupported_skill_risk_score", "risk_signals_score"]


def triggered(rows: DataFrame, config: Config, reference: Column) -> DataFrame:
    """Contexts that carry their evidence risks (``RISKS``), with ``triggers`` in the order of the configuration; no shuffle.

    The audit rules are asked of the stored context: missing years count as 0 there.
    """
    check_registry(config)
    years = F.coalesce("profile.years_of_experience", F.lit(0.0))
    rows = rows.withColumn("issues", issues(years, F.col("career_history"), F.col("skills"), F.col("signals"), reference))
    none, parts = F.array().cast(TRIGGER), []
    for name, rule in config["credibility"]["rules"].items():
        if not rule["enabled"]:
            continue
        fixed = [F.lit(name).alias("rule_name"), F.lit(rule["severity"]).alias("severity"), F.lit(round(float(rule["score_contribution"]), 6)).alias("score_contribution")]
        ends = [F.lit(rule["explanation_label"]).alias("explanation_label"), F.lit(bool(rule.get("candidate_facing_reasoning", False))).alias("candidate_facing_reasoning_eligible")]
        made = F.transform(RULES[name](config, reference), lambda x: F.struct(*fixed, x["source_path"].alias("source_path"), x["detail"].alias("detail"), *ends))  # noqa: B023
        parts.append(F.coalesce(made.cast(TRIGGER), none))
    return rows.withColumn("triggers", F.concat(*parts) if parts else none)


def trigger_rows(triggered: DataFrame) -> DataFrame:
    """One row for each trigger; the explode is an outer one, as a plain one would have the array worked out twice."""
    return triggered.select("candidate_id", F.explode_outer("triggers").alias("t")).where("t is not null").select("candidate_id", "t.*")


def breakdown(triggered: DataFrame, config: Config) -> DataFrame:
    """Counts by severity, the capped risk sum and the multiplier: folds over each row's own triggers."""
    return triggered.select("candidate_id", *[c.alias(n) for n, c in breakdown_columns(config).items()])


def breakdown_columns(config: Config) -> dict[str, Column]:
    """The breakdown as columns over rows with ``triggers`` and ``RISKS``."""
    count = lambda s: F.size(F.filter("triggers", lambda t: t["severity"] == s))
    risk = F.least(F.lit(1.0), F.aggregate("triggers", F.lit(0.0), lambda a, t: a + t["score_contribution"]))
    return {
        "anomaly_risk_score": C.r6(risk),
        "credibility_multiplier": F.greatest(F.lit(float(config["credibility"]["severe_min"])), C.r6(1 - risk)),
        "triggered_rule_count": F.size("triggers"),
        "minor_rule_count": count("minor"),
        "moderate_rule_count": count("moderate"),
        "severe_rule_count": count("severe"),
        "unsupported_skill_risk_score": C.r6(F.coalesce("unsupported_skill_risk_score", F.lit(0.0))),
        "evidence_risk_score": C.r6(F.coalesce("risk_signals_score", F.lit(0.0))),
    }
