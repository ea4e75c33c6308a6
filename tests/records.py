"""Candidate records for the tests."""

from __future__ import annotations

import copy
import json
from pathlib import Path

REF = "2026-06-30"


def record(number: int = 1, **over) -> dict:
    base = {
        "candidate_id": f"CAND_{number:07d}",
        "profile": {
            "headline": "Search engineer", "summary": "Builds retrieval systems used in production.", "current_title": "Senior Engineer", "current_company": "Acme",
            "current_industry": "Software", "location": "Pune", "country": "India", "years_of_experience": 6,
        },
        "career_history": [
            {
                "company": "Acme", "title": "Search Engineer", "start_date": "2022-01-01", "end_date": None, "duration_months": 53, "is_current": True, "industry": "Software", "company_size": "51-200",
                "description": "Improved search relevance with hybrid search and ndcg. Deployed a python service in production.",
            }
        ],
        "education": [],
        "skills": [{"name": "Python", "proficiency": "advanced", "endorsements": 3, "duration_months": 40}],
        "certifications": [],
        "talent_signals": {
            "profile_completeness_score": 88, "signup_date": "2024-01-01", "last_active_date": "2026-06-10", "open_to_work_flag": True, "recruiter_response_rate": 0.9,
            "avg_response_time_hours": 4, "notice_period_days": 15, "preferred_work_mode": "remote", "willing_to_relocate": False, "github_activity_score": 70,
            "interview_completion_rate": 0.8, "skill_assessment_scores": {"Python": 91.0}, "expected_salary_range_inr_lpa": {"min": 18, "max": 20},
        },
    }
    out = copy.deepcopy(base)
    for key, value in over.items():
        if isinstance(value, dict) and isinstance(out.get(key), dict):
            out[key].update(value)
        else:
            out[key] = value
    return out


def varied(n: int) -> list[dict]:
    """``n`` records whose evidence, dates and signals differ."""
    texts = [
        "Built a recommendation system with embeddings and faiss. Shipped it to live users with monitoring.",
        "Owned the ranking pipeline, ndcg evaluation framework and a/b test reviews.",
        "Led a small team on marketplace metrics and customer feedback.",
        "Designed document retrieval with elasticsearch and bm25 for our internal product.",
        "Computer vision research and tutorial work.",
        "Implemented a data pipeline in python with sql and docker on call for reliability.",
    ]
    out = []
    for i in range(1, n + 1):
        r = record(i)
        r["profile"]["years_of_experience"] = 2 + i % 14
        r["profile"]["country"] = ["India", "Germany", "Brazil"][i % 3]
        r["career_history"][0]["description"] = texts[i % len(texts)]
        r["career_history"].append({"company": "Old", "title": ["Data Engineer", "ML Engineer"][i % 2], "start_date": "2017-03-01", "end_date": f"2021-{1 + i % 12:02d}-15", "duration_months": 40 + i % 20, "is_current": False, "description": texts[(i * 5 + 1) % len(texts)]})
        r["skills"] = [{"name": ["Python", "LLM", "FAISS", "SQL"][i % 4], "proficiency": ["advanced", "intermediate"][i % 2], "duration_months": 12 * (1 + i % 9)}]
        s = r["talent_signals"]
        s["notice_period_days"], s["recruiter_response_rate"], s["avg_response_time_hours"] = (i * 7) % 95, (i % 10) / 10, (i * 11) % 200
        s["preferred_work_mode"], s["willing_to_relocate"] = ["remote", "onsite", "hybrid", "flexible"][i % 4], i % 5 == 0
        s["last_active_date"] = f"2026-{1 + i % 6:02d}-10"
        out.append(r)
    return out


def write(path: Path, rows: list) -> str:
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in rows), encoding="utf-8")
    return str(path)
