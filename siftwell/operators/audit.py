"""Record-level quality rules and the dataset profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions import columns as C
from siftwell.functions import fixed_values as V
from siftwell.functions.frequent import most_frequent

ISSUE = "array<struct<type:string,severity:string,reason:string>>"


def _issue(kind: str) -> Column:
    return F.struct(F.lit(kind).alias("type"), F.lit(V.RULES[kind][0]).alias("severity"), F.lit(V.ISSUE_REASONS[kind]).alias("reason"))


def _when(condition: Column, kind: str) -> Column:
    return F.when(condition, _issue(kind))


def issues(years: Column, history: Column, skills: Column, signals: Column, reference: Column) -> Column:
    """Array of (type, severity, reason) of a record; role and skill rules may fire many times.

    ``years`` is null where the record holds no number: the span rule is then not asked.
    """
    signup, active = C.parse_date(signals["signup_date"]), C.parse_date(signals["last_active_date"])

    def of_role(role: Column) -> Column:
        start, explicit = C.parse_date(role["start_date"]), C.parse_date(role["end_date"])
        expected = C.months_between(start, F.coalesce(explicit, reference))
        return F.array_compact(
            F.array(
                _when(role["is_current"] & (explicit < reference), "current_role_has_past_end_date"),
                _when(explicit < start, "role_end_before_start"),
                _when((expected > 0) & (F.abs(role["duration_months"] - expected) > 6), "duration_months_mismatch"),
            )
        )

    starts = F.filter(F.transform(history, lambda r: C.parse_date(r["start_date"])), lambda d: d.isNotNull())
    ends = F.transform(history, lambda r: F.coalesce(C.parse_date(r["end_date"]), reference))
    span = F.when(F.size(starts) > 0, C.months_between(F.array_min(starts), F.array_max(ends)))
    career = F.lower(F.array_join(F.transform(history, lambda r: F.concat(C.empty_if_null(r["title"]), F.lit(" "), C.empty_if_null(r["description"]))), " "))
    claimed = F.lower(F.array_join(F.transform(skills, lambda s: C.empty_if_null(s["name"])), " "))
    salary = signals["expected_salary_range_inr_lpa"]
    single = F.array_compact(
        F.array(
            _when(F.size(F.filter(history, lambda r: F.coalesce(r["is_current"], F.lit(False)))) > 1, "multiple_current_roles"),
            _when((span > 0) & (F.abs(years * 12 - span) > 36), "experience_span_mismatch"),
        )
    )
    of_skills = F.transform(F.filter(skills, lambda s: F.coalesce(s["duration_months"] > span + 24, F.lit(False))), lambda s: _issue("skill_duration_implausible"))
    last = F.array_compact(
        F.array(
            _when(salary["min"] > salary["max"], "salary_min_greater_than_max"),
            _when(C.contains_any(claimed, V.SKILL_CLAIM_TERMS) & ~C.contains_any(career, V.CAREER_SUPPORT_TERMS), "skills_career_evidence_mismatch"),
        )
    )
    none = F.array().cast(ISSUE)
    parts = [F.array_compact(F.array(_when(signup > active, "signup_after_last_active"))), F.flatten(F.transform(history, of_role)), single, of_skills, last]
    return F.concat(*[F.coalesce(p.cast(ISSUE), none) for p in parts])


def with_empty(records: DataFrame) -> DataFrame:
    """Records whose missing arrays are empty, so that folds over them give values."""
    out = records
    for c in ("career_history", "skills", "certifications"):
        out = out.withColumn(c, F.coalesce(c, F.array().cast(records.schema[c].dataType)))
    return out


def with_issues(records: DataFrame, reference: Column) -> DataFrame:
    r = with_empty(records)
    return r.withColumn("issues", issues(F.col("profile.years_of_experience"), F.col("career_history"), F.col("skills"), F.col("signals"), reference))


def exploded(judged: DataFrame) -> DataFrame:
    """(file, row_num, candidate_id, type, severity, reason) of records with their issues."""
    # From a plain explode the planner infers a filter on the array's size and works out the array twice.
    return judged.select("file", "row_num", "candidate_id", F.explode_outer("issues").alias("i")).where("i is not null").select("file", "row_num", "candidate_id", "i.*")


def issue_rows(records: DataFrame, reference: Column) -> DataFrame:
    """``exploded`` issues of records, one row for each."""
    return exploded(with_issues(records, reference))


#: Profiles whose most frequent values are told, and those whose values are all told.
COMMON = {"top_countries": "profile.country", "top_locations": "profile.location", "top_titles": "profile.current_title"}
EVERY = ("years_distribution", "career_count_distribution", "skill_count_distribution")


def _number(c: Column) -> Column:
    return F.coalesce(c.cast("int"), F.lit(0)).cast("string")


def profile_values(records: DataFrame) -> DataFrame:
    """(file, row_num, grp, value): what each record adds to the profiles whose frequent values are told."""
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("grp"), C.empty_if_null(c).alias("value")) for name, c in COMMON.items()]))
    return records.select("file", "row_num", pairs.alias("x")).select("file", "row_num", "x.*")


def histograms(records: DataFrame) -> DataFrame:
    """(profile, value, n): every value of the numeric profiles, in one pass."""
    values = dict(zip(EVERY, (_number(F.floor("profile.years_of_experience")), _number(F.size("career_history")), _number(F.size("skills"))), strict=True))
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("profile"), v.alias("value")) for name, v in values.items()]))
    return records.select(pairs.alias("x")).groupBy("x.profile", "x.value").agg(F.count(F.lit(1)).alias("n"))


def summary(records: DataFrame, all_issues: DataFrame, top: int = 30) -> dict:
    """Counters, most frequent values and histograms of a dataset; a few rows each reach the driver.

    Frequent values cost what their summaries hold, however many values there are.
    """
    found: dict[str, dict] = {name: {} for name in (*COMMON, *EVERY)}
    frequent = most_frequent(profile_values(records), list(COMMON), top, F.struct("file", "row_num"))
    for r in sorted(frequent.collect(), key=lambda r: r["place"]):
        found[r["grp"]][r["value"]] = r["n"]
    for r in histograms(records).collect():
        found[r["profile"]][r["value"]] = r["n"]
    for name in EVERY:
        found[name] = dict(sorted(found[name].items(), key=lambda kv: int(kv[0])))
    kinds = {r["type"]: r["n"] for r in all_issues.groupBy("type").agg(F.count(F.lit(1)).alias("n")).orderBy("type").collect()}
    mode = F.lower(C.empty_if_null("signals.preferred_work_mode"))
    flags = records.agg(F.count_if("signals.open_to_work_flag").alias("o"), F.count_if(mode.isin("remote", "flexible")).alias("r")).head()
    return {
        **found,
        "signal_summaries": {"open_to_work_true": flags["o"], "remote_or_flexible": flags["r"]},
        "issue_counts": kinds,
        "date_anomalies": {k: v for k, v in kinds.items() if any(p in k for p in ("date", "duration", "signup"))},
        "current_role_anomalies": {k: v for k, v in kinds.items() if "current" in k},
    }
