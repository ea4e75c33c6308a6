"""Flat rows and nested contexts of candidate records."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from siftwell.functions import columns as C
from siftwell.functions import fixed_values as V
from siftwell.operators.audit import with_issues


@F.pandas_udf(StringType())
def canonical_hash(lines: pd.Series) -> pd.Series:
    """Hash of a JSON text in canonical form: sorted keys, default separators, ASCII only."""
    return lines.map(lambda x: None if x is None else hashlib.sha256(json.dumps(json.loads(x), sort_keys=True).encode()).hexdigest())


def severity(issues: Column) -> Column:
    severe = F.exists(issues, lambda i: i["severity"] == "severe")
    return F.when(severe, F.lit("severe")).when(F.size(issues) > 0, F.lit("minor")).otherwise(F.lit("none"))


def contexts(records: DataFrame) -> DataFrame:
    """(candidate_id, profile, career_history, skills, certifications, skill_assessments, signals): arrays carry their index.

    Assessments come from the score map, in the order of their names.
    """

    def indexed(column: str) -> Column:
        kind = records.schema[column].dataType.elementType
        return F.transform(column, lambda x, i: F.struct(i.alias("index"), *[x[f.name].alias(f.name) for f in kind.fields]))

    empty = F.array().cast("array<struct<key:string,value:double>>")
    scores = F.coalesce(F.map_entries("signals.skill_assessment_scores"), empty)
    return records.withColumns(
        {
            "career_history": indexed("career_history"),
            "skills": indexed("skills"),
            "certifications": indexed("certifications"),
            "skill_assessments": F.transform(F.array_sort(scores), lambda e, i: F.struct(i.alias("index"), e["key"].alias("name"), e["value"].alias("score"))),
        }
    )


def normalized(records: DataFrame, reference: Column, with_hash: bool = True) -> DataFrame:
    """The flat row of every record (see ``FLAT``) beside its nested context columns; no shuffle."""
    r = with_issues(records, reference)
    p, s, h, k = (lambda f: F.col(f"profile.{f}")), (lambda f: F.col(f"signals.{f}")), F.col("career_history"), F.col("skills")
    text = lambda c: C.empty_if_null(c)
    number = lambda c, other=0.0: C.or_default(c, other).cast("double")
    dates = lambda f: F.filter(F.transform(h, lambda x: C.parse_date(x[f])), lambda d: d.isNotNull())
    career = C.text_join(F.concat(F.transform(h, lambda x: x["description"]), F.transform(h, lambda x: x["title"])))
    skill = C.text_join(F.transform(k, lambda x: x["name"]))
    profile = C.text_join(F.array(p("summary"), p("headline")))
    relevant = F.filter(k, lambda x: C.contains_any(F.lower(C.empty_if_null(x["name"])), V.RELEVANT_SKILL_TERMS))
    flat = {
        "profile_headline": text(p("headline")),
        "profile_summary": text(p("summary")),
        "current_title": text(p("current_title")),
        "current_company": text(p("current_company")),
        "current_industry": text(p("current_industry")),
        "location": text(p("location")),
        "country": text(p("country")),
        "years_of_experience": number(p("years_of_experience")),
        "career_entry_count": F.size(h),
        "current_role_count": F.size(F.filter(h, lambda x: F.coalesce(x["is_current"], F.lit(False)))),
        "total_career_months": F.aggregate(h, F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x["duration_months"], F.lit(0).cast("long"))),
        "most_recent_role_start_date": F.coalesce(F.array_max(dates("start_date")).cast("string"), F.lit("")),
        "most_recent_role_end_date": F.coalesce(F.array_max(dates("end_date")).cast("string"), F.lit("")),
        "combined_career_text": career,
        "combined_skill_text": skill,
        "combined_profile_text": profile,
        "combined_candidate_text": C.text_join(F.array(career, profile, skill)),
        "skills_count": F.size(k),
        "certifications_count": F.size("certifications"),
        "relevant_skill_count_baseline": F.size(relevant),
        "profile_completeness_score": number(s("profile_completeness_score")),
        "last_active_date": text(s("last_active_date")),
        "open_to_work_flag": F.coalesce(s("open_to_work_flag"), F.lit(False)),
        "recruiter_response_rate": number(s("recruiter_response_rate")),
        "avg_response_time_hours": number(s("avg_response_time_hours"), 999.0),
        "notice_period_days": number(s("notice_period_days")).cast("int"),
        "preferred_work_mode": text(s("preferred_work_mode")),
        "willing_to_relocate": F.coalesce(s("willing_to_relocate"), F.lit(False)),
        "github_activity_score": number(s("github_activity_score")),
        "interview_completion_rate": number(s("interview_completion_rate")),
        "anomaly_count": F.size("issues"),
        "anomaly_severity": severity(F.col("issues")),
    }
    out = r.withColumns(flat)
    if with_hash:
        out = out.withColumn("candidate_record_hash", canonical_hash("line"))
    return contexts(out).drop("line", "keys", "issues")


FLAT = [
    "candidate_id", "profile_headline", "profile_summary", "current_title", "current_company", "current_industry", "location", "country", "years_of_experience",
    "career_entry_count", "current_role_count", "total_career_months", "most_recent_role_start_date", "most_recent_role_end_date", "combined_career_text",
    "combined_skill_text", "combined_profile_text", "combined_candidate_text", "skills_count", "certifications_count", "relevant_skill_count_baseline",
    "profile_completeness_score", "last_active_date", "open_to_work_flag", "recruiter_response_rate", "avg_response_time_hours", "notice_period_days",
    "preferred_work_mode", "willing_to_relocate", "github_activity_score", "interview_completion_rate", "anomaly_count", "anomaly_severity", "candidate_record_hash",
]
