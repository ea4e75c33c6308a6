"""Lexicons, weights, patterns and texts that results must agree on."""

REQUIRED_FIELDS = ("candidate_id", "profile", "career_history", "education", "skills")
SUBMISSION_HEADER = ("candidate_id", "rank", "score", "reasoning")
CANDIDATE_ID = r"^CAND_[0-9]{7}$"
REFERENCE_DATE = "2026-06-30"
SCORE_VERSION = "phase2-v2-scoring-v1"

SOURCE_FAMILIES = {"career_description": "career", "career_title": "career", "profile_summary": "profile", "profile_headline": "profile", "skill": "skill", "assessment": "assessment"}
SOURCE_TYPES = ("career_description", "career_title", "profile_summary", "profile_headline", "skill", "assessment")

#: name: polarity, weight, cap, recent years, older multiplier, needs corroboration, weights by SOURCE_TYPES, terms
EVIDENCE = {
    "retrieval_ranking_relevance": ("positive", 1.0, 2.8, 5, 0.85, False, (1.0, 0.65, 0.5, 0.35, 0.2, 0.1), (
        "built a personalized feed", "candidate matching", "designed recommendations", "document retrieval", "feed ranking", "hybrid search",
        "improved product discovery", "improved search results", "learning to rank", "marketplace ranking", "matched users to jobs",
        "matched users to products", "matched users to vendors", "matching engine", "measured ranking outcomes",
        "optimized recommendation quality", "personalization", "product discovery", "ranked marketplace listings", "ranking pipeline",
        "recommendation", "recommendation system", "recommendations", "recommender system", "retrieval system", "search quality",
        "search relevance", "semantic search", "shipped a customer-facing search system", "tuned relevance")),
    "vector_ir_infrastructure": ("positive", 0.9, 2.2, 5, 0.85, True, (0.95, 0.55, 0.4, 0.25, 0.25, 0.15), (
        "ann", "approximate nearest neighbor", "bm25", "dense retrieval", "elasticsearch", "embedding drift", "embeddings", "faiss",
        "hybrid retrieval", "index refresh", "lucene", "milvus", "opensearch", "pinecone", "qdrant", "retrieval regression", "vector database",
        "vector index", "weaviate")),
    "ranking_evaluation_experimentation": ("positive", 0.9, 2.2, 6, 0.85, False, (1.0, 0.35, 0.55, 0.2, 0.1, 0.0), (
        "a/b test", "click-through rate", "evaluation framework", "map", "mrr", "ndcg", "offline benchmark", "offline-to-online correlation",
        "online experiment", "precision", "recall", "regression test", "relevance judgment", "relevance metrics")),
    "production_delivery_systems": ("positive", 1.0, 2.4, 6, 0.85, False, (1.0, 0.3, 0.45, 0.15, 0.05, 0.0), (
        "customer-facing", "deployed", "incidents", "index maintenance", "latency", "live users", "model refresh", "monitoring",
        "observability", "on-call", "production", "production pipeline", "reliability", "service ownership", "shipped", "throughput")),
    "python_practical_engineering": ("positive", 0.8, 2.0, 6, 0.9, False, (0.85, 0.45, 0.35, 0.2, 0.35, 0.15), (
        "api", "backend engineering", "ci/cd", "data pipeline", "django", "docker", "fastapi", "feature pipeline", "flask", "kubernetes",
        "pyspark", "python", "service", "sql", "unit tests")),
    "product_founding_behavior": ("positive", 0.6, 1.6, 6, 0.9, False, (0.75, 0.2, 0.5, 0.2, 0.05, 0.0), (
        "cross-functional", "customer feedback", "end-to-end ownership", "iteration", "marketplace", "metrics", "product feedback",
        "product manager", "recruiter workflow", "shipped quickly", "small team", "startup", "user research")),
    "preferred_differentiators": ("positive", 0.45, 1.2, 6, 0.9, True, (0.8, 0.2, 0.3, 0.15, 0.2, 0.05), (
        "distributed systems", "hr-tech", "inference optimization", "learning-to-rank", "llm fine-tuning", "lora", "neural ranking",
        "open source", "peft", "qlora", "recruiting technology", "xgboost learning-to-rank")),
    "risk_signals": ("negative", 0.8, 1.8, 8, 1.0, False, (0.75, 0.25, 0.6, 0.2, 0.15, 0.0), (
        "computer vision", "consulting", "curious about ai", "cv", "demo only", "experimented with chatgpt", "langchain", "no production",
        "research", "robotics", "service company", "speech recognition", "tutorial", "tutorial only")),
}
MATCH_DIVISOR, SKILL_ONLY_FACTOR = 2, 0.35

FEATURE_WEIGHTS = {
    "career_relevance_score": 0.35, "retrieval_ranking_depth_score": 0.15, "production_evaluation_score": 0.20, "product_shipper_score": 0.10,
    "experience_recent_coding_score": 0.08, "corroborated_skill_score": 0.05, "preferred_differentiator_score": 0.03, "location_logistics_score": 0.04,
}
SEMANTIC_CAP, UNSUPPORTED_WEIGHT, RISK_WEIGHT = 0.08, 0.08, 0.05
EXPERIENCE_BANDS = ((4, 14, 1.0), (2, 20, 0.6), (0, 100, 0.25))

AVAILABILITY_WEIGHTS = {
    "open_to_work": 0.20, "response_rate": 0.18, "response_time": 0.12, "interview_completion": 0.12, "notice_period": 0.12,
    "relocation": 0.08, "work_mode": 0.10, "relevant_assessment": 0.05, "github_activity": 0.02, "last_active_recency": 0.04,
}
AVAILABILITY_BASE, AVAILABILITY_MIN, AVAILABILITY_MAX = 0.72, 0.72, 1.08
LOCATION = {"preferred_modes": ("remote", "flexible"), "preferred_country": "india", "preferred_score": 1.0, "fallback_score": 0.55}
RECENCY = {"recent_days": 60, "stale_days": 180, "recent_score": 1.0, "stale_score": 0.35}

BASELINE_WEIGHTS = {
    "career_text_relevance": 0.40, "production_evaluation": 0.20, "python_engineering": 0.15, "experience_plausibility": 0.10,
    "location_logistics": 0.10, "behavioral_availability": 0.05,
}
BASELINE_PENALTY = {"none": 0.0, "minor": 0.08, "severe": 0.25, "default": 0.08}
BASELINE_LOW = {"threshold": 0.08, "max_score": 35.0}
BASELINE_AVAILABILITY = {"open_to_work": 0.35, "response_rate": 0.35, "response_time": 0.15, "notice_period": 0.15, "max_response_time_hours": 240, "max_notice_days": 120}
#: name: terms, field weights, field divisors, evidence text
BASELINE_LEXICON = {
    "role_relevance": ((
        "recommendation", "recommender", "search relevance", "ranking", "candidate matching", "personalization", "retrieval",
        "semantic search", "hybrid search", "dense retrieval", "bm25", "vector", "ann", "embedding", "recommendation system",
        "ranking pipeline", "vector index", "embeddings"),
                       {"career": 0.85, "profile_skills": 0.15}, {"career": 5, "profile_skills": 8}, "career history mentions retrieval/search/ranking evidence"),
    "production_evaluation": ((
        "evaluation", "ndcg", "mrr", "map", "a/b", "experiment", "deployment", "monitoring", "latency", "drift", "index refresh", "production",
        "live users", "a/b test", "production deployment"),
                              {"career_profile": 1.0}, {"career_profile": 4}, "profile includes production or evaluation signals"),
    "python_engineering": ((
        "python", "pyspark", "fastapi", "flask", "airflow", "spark", "sql", "backend", "api", "backend api"),
                           {"career_skills": 1.0}, {"career_skills": 4}, "Python or backend engineering evidence appears in career/skills"),
}
WEAK_EVIDENCE = "career history has weak retrieval/ranking evidence"
NO_EVIDENCE = "limited role-specific evidence found"

#: rule: severity, contribution, label
RULES = {
    "signup_after_last_active": ("minor", 0.08, "signup date after last active"),
    "current_role_has_past_end_date": ("minor", 0.08, "current role ends before the dataset reference date"),
    "role_end_before_start": ("severe", 0.35, "role end date precedes role start date"),
    "duration_months_mismatch": ("minor", 0.08, "duration months mismatch"),
    "multiple_current_roles": ("minor", 0.08, "multiple current roles"),
    "experience_span_mismatch": ("minor", 0.08, "experience span mismatch"),
    "skill_duration_implausible": ("minor", 0.08, "implausible skill duration"),
    "salary_min_greater_than_max": ("severe", 0.35, "invalid salary range"),
    "skills_career_evidence_mismatch": ("minor", 0.08, "skill claims are weakly supported by career evidence"),
    "excessive_overlap": ("moderate", 0.18, "excessive overlapping employment duration"),
    "unsupported_advanced_skill": ("moderate", 0.18, "advanced AI or search skills lack career corroboration"),
    "title_description_contradiction": ("moderate", 0.18, "titles imply relevance but descriptions do not support it"),
}
ISSUE_REASONS = {
    "signup_after_last_active": "signup_date is after last_active_date",
    "current_role_has_past_end_date": "current role has an end_date before dataset reference date",
    "role_end_before_start": "career role end_date precedes start_date",
    "duration_months_mismatch": "duration_months differs from dates beyond tolerance",
    "multiple_current_roles": "more than one role is marked current",
    "experience_span_mismatch": "profile years_of_experience differs from career span",
    "skill_duration_implausible": "skill duration is longer than plausible career span",
    "salary_min_greater_than_max": "expected salary minimum exceeds maximum",
    "skills_career_evidence_mismatch": "claimed AI/search skills have weak career-history support",
}
SEVERE_MIN, MAX_OVERLAP_MONTHS, UNSUPPORTED_THRESHOLD = 0.25, 12, 0.4
SKILL_CLAIM_TERMS = ("expert", "llm", "ranking", "retrieval", "recommendation")
CAREER_SUPPORT_TERMS = ("model", "ranking", "retrieval", "recommend", "search", "ml", "ai")
RISKY_SKILL_TERMS = ("llm", "embed", "pinecone", "vector", "langchain", "retriev", "rank", "recommend", "ml", "ai")
TITLE_TERMS = ("ai", "ml", "search", "ranking", "retrieval", "recommendation")
SUPPORT_TERMS = ("ai", "ml", "search", "ranking", "retrieval", "recommend")
RELEVANT_SKILL_TERMS = ("python", "ranking", "retrieval", "search", "recommend", "embedding", "vector", "ml", "ai", "bm25", "ann")
SEMANTIC_TERMS = ("search", "ranking", "retrieval", "recommend", "relevance", "production", "python")

# Explanations.
RANK_BANDS = ((1, 10, "1-10"), (11, 30, "11-30"), (31, 60, "31-60"), (61, 100, "61-100"))
CATEGORY_PHRASES = {
    "retrieval_ranking_relevance": "retrieval and ranking work",
    "vector_ir_infrastructure": "vector or search infrastructure",
    "ranking_evaluation_experimentation": "ranking evaluation and experimentation",
    "production_delivery_systems": "production delivery",
    "python_practical_engineering": "hands-on Python engineering",
    "product_founding_behavior": "product-facing ownership",
    "preferred_differentiators": "differentiated search or model-tuning work",
    "risk_signals": "profile limitations",
}
OTHER_PHRASE = "role-relevant engineering work"
SOURCE_PRIORITY = {"career_description": 0, "profile_summary": 0, "profile_headline": 0, "career_title": 1, "skill": 2, "assessment": 2}
FORBIDDEN_TERMS = ("honeypot", "trap", "synthetic", "risk score", "anomaly score", "internal evidence category")
GENERIC_PRAISE = ("excellent candidate", "strong fit", "ideal profile", "great cultural fit")
LIMIT_WORDS = ("limited", "less ", "weaker", "thinner", "slows", "narrows", "reduces")
DANGLING_END = frozenset((
    "a", "an", "and", "at", "because", "for", "in", "including", "of", "or", "to", "while", "with"))
DANGLING_START = frozenset((
    "and", "because", "but", "while", "with"))
FACT_VERBS = frozenset((
    "architected", "are", "automated", "be", "built", "delivered", "designed", "developed", "drove", "fine-tuned", "fine", "implemented",
    "improved", "is", "keeps", "launched", "led", "managed", "migrated", "narrows", "operated", "optimized", "owned", "ran", "reduces",
    "remains", "served", "shipped", "shows", "slows", "stays", "supports", "trained", "uses", "was", "were"))
BROKEN_FRAGMENTS = (r"\bat a\b$", r"\band service\b$", r"\bfor experiment\b$", r"\bwhile [a-z0-9/+.-]+ remains visible\b$")
SAMPLED_RANKS = (1, 5, 10, 25, 50, 61, 75, 100)
