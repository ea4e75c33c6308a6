"""Evidence: lexicon matches of every text fragment as a ledger, capped by group, and its summary by candidate.

A candidate's fragments, matches and groups are arrays of its row; the ledger is
these arrays exploded and the summary a fold of them, both without a shuffle.
Each text is read once for all terms of all categories.
"""

from __future__ import annotations

import hashlib
import json

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from siftwell.config import Config
from siftwell.functions import columns as C
from siftwell.functions import fixed_values as V
from siftwell.functions import lexicon as L

FRAGMENT = "array<struct<source_path:string,source_type:string,excerpt:string,is_current:boolean,start_date:string,end_date:string>>"
LEDGER = [
    "candidate_id", "source_path", "source_type", "exact_source_excerpt", "normalized_category", "matched_terms", "polarity", "evidence_strength", "corroboration_level",
    "recency_weight", "configured_weight", "contribution_before_caps", "contribution_after_caps", "confidence", "evidence_id", "provenance_hash",
]


def fragments() -> Column:
    """A context's text fragments in reading order; empty ones are left out."""

    def part(path: Column, kind: str, excerpt: Column, role: Column | None = None) -> Column:
        f = lambda n, t: (role[n] if role is not None else F.lit(None)).cast(t).alias(n)
        return F.struct(path.alias("source_path"), F.lit(kind).alias("source_type"), excerpt.alias("excerpt"), f("is_current", "boolean"), f("start_date", "string"), f("end_date", "string"))

    at = lambda name, i, field: F.concat(F.lit(f"{name}["), i, F.lit(f"].{field}"))
    roles = F.flatten(
        F.transform(
            "career_history",
            lambda r: F.array(
                part(at("career_history", r["index"], "description"), "career_description", r["description"], r),
                part(at("career_history", r["index"], "title"), "career_title", r["title"], r),
            ),
        )
    )
    profile = F.array(part(F.lit("profile.summary"), "profile_summary", F.col("profile.summary")), part(F.lit("profile.headline"), "profile_headline", F.col("profile.headline")))
    skills = F.transform("skills", lambda s: part(at("skills", s["index"], "name"), "skill", s["name"]))
    tests = F.transform("skill_assessments", lambda a: part(at("skill_assessments", a["index"], "name"), "assessment", a["name"]))
    filled = F.filter(F.concat(*[x.cast(FRAGMENT) for x in (roles, profile, skills)]), lambda x: C.empty_if_null(x["excerpt"]) != "")
    return F.concat(filled, tests.cast(FRAGMENT))


def reconstructible(path: Column, excerpt: Column) -> Column:
    """Whether a source path read in the row's own context gives the excerpt."""
    index = F.regexp_extract(path, r"\[(\d+)\]", 1).try_cast("int")
    value = F.when(path == "profile.summary", F.col("profile.summary")).when(path == "profile.headline", F.col("profile.headline"))
    for array, field in (("career_history", "description"), ("career_history", "title"), ("skills", "name"), ("skill_assessments", "name")):
        hit = path.startswith(f"{array}[") & path.endswith(f".{field}")
        value = value.when(hit, F.get(F.filter(array, lambda x: x["index"] == index), F.lit(0))[field])  # noqa: B023
    return value.eqNullSafe(excerpt)


@F.arrow_udf(StringType())
def _hash_of_any(candidate: pa.Array, path: pa.Array, category: pa.Array, excerpt: pa.Array, terms: pa.Array, asked: pa.Array) -> pa.Array:
    """``provenance`` of the rows that are asked for, null for the others; rows of one excerpt follow one another, so its JSON is written once for them."""
    out: list[str | None] = [None] * len(asked)
    at = pc.indices_nonzero(asked)
    last, written = None, ""
    for i, c, p, n, x, t in zip(at.to_pylist(), *(a.take(at).to_pylist() for a in (candidate, path, category, excerpt, terms)), strict=True):
        if x != last or not written:
            last, written = x, json.dumps(x)
        parts = {"candidate_id": json.dumps(c), "excerpt": written, "matched_terms": json.dumps(t), "normalized_category": json.dumps(n), "source_path": json.dumps(p)}
        out[i] = hashlib.sha256(("{" + ", ".join(f'"{k}": {v}' for k, v in parts.items()) + "}").encode()).hexdigest()
    return pa.array(out, pa.string())


def provenance(candidate: Column, path: Column, category: Column, excerpt: Column, terms: Column) -> Column:
    """Canonical hash of what a ledger row rests on: SHA-256 of its JSON with sorted keys and ASCII characters only.

    Texts of printable ASCII need two replacements and stay with the plan's own
    functions; only rows with other characters, or nulls, send their texts to Python.
    """
    texts = (candidate, path, category, excerpt)
    plain = F.lit(True)
    for c in texts:
        plain = plain & ~F.coalesce(c.rlike(r"[^\x20-\x7E]"), F.lit(True))
    plain = plain & ~F.coalesce(F.array_join(terms, " ").rlike(r"[^\x20-\x7E]"), F.lit(True)) & ~F.coalesce(F.exists(terms, lambda t: t.isNull()), F.lit(True))
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    listed = F.concat(F.lit("["), F.array_join(F.transform(terms, quoted), ", "), F.lit("]"))
    parts = {"candidate_id": quoted(candidate), "excerpt": quoted(excerpt), "matched_terms": listed, "normalized_category": quoted(category), "source_path": quoted(path)}
    made = F.concat_ws(", ", *[F.concat(F.lit(f'"{k}": '), v) for k, v in sorted(parts.items())])
    sent = [F.when(~plain, c) for c in (*texts, terms)]
    return F.coalesce(_hash_of_any(*sent, ~plain), F.sha2(F.concat(F.lit("{"), made, F.lit("}")).cast("binary"), 256))


def _family(kind: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in V.SOURCE_FAMILIES.items() for x in kv]), kind)


def _weights(c) -> dict[str, float]:
    """Sources that count for a category; pairs whose weight isn't positive are pruned from the plan."""
    return {k: c["weight"] * w for k, w in c["source_weights"].items() if c["weight"] * w > 0}


def terms_of(config: Config) -> list[str]:
    """All terms of the categories that any source counts for, sorted."""
    return sorted({t for c in config["evidence"].values() if _weights(c) for t in c["terms"]})


def read(context: DataFrame, config: Config) -> DataFrame:
    """Contexts with their ``fragments`` and, for each, the numbers of the terms in it (``term_ids``)."""
    rows = context.withColumn("fragments", fragments())
    texts = F.transform("fragments", lambda f: C.normalize_text(f["excerpt"]))
    return rows.withColumn("term_ids", L.term_ids(terms_of(config))(texts))


def _hits(f: Column, ids: Column, config: Config, reference: Column) -> list[Column]:
    """What each category finds in a fragment; null where it finds nothing or the source has no weight there."""
    hits, terms = [], terms_of(config)
    dated = f["is_current"].isNotNull() | f["start_date"].isNotNull() | f["end_date"].isNotNull()
    for seq, (name, c) in enumerate(config["evidence"].items()):
        weights = _weights(c)
        if not weights:
            continue
        weight = F.element_at(F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]), f["source_type"])
        recency = C.role_recency(f["is_current"], f["end_date"], f["start_date"], reference, float(c["current_multiplier"]), int(c["recent_years"]), float(c["older_multiplier"]))
        hit = F.struct(
            F.lit(seq).alias("category_seq"), F.lit(name).alias("normalized_category"), F.lit(c["polarity"]).alias("polarity"), weight.alias("weight"), F.lit(float(c["cap"])).alias("cap"),
            F.lit(bool(c["require_corroboration"])).alias("strict"), F.lit(float(max(1, c["match_divisor"]))).alias("divisor"), F.when(dated, recency).otherwise(F.lit(1.0)).alias("recency"),
            L.at(terms, ids, sorted(set(c["terms"]))).alias("matched_terms"),
        )
        hits.append(F.when(f["source_type"].isin(*weights) & L.any_of(terms, ids, sorted(set(c["terms"]))), hit))
    return hits


def found(config: Config, reference: Column) -> Column:
    """The ledger items of a row that was ``read``, in fragment order: one for each fragment and category with a match."""

    def of_fragment(x: Column) -> Column:
        f, i = x["f"], x["i"]

        def item(h: Column) -> Column:
            strength = F.least(F.lit(1.0), F.size(h["matched_terms"]) / h["divisor"])
            return F.struct(
                (i * 64 + h["category_seq"]).alias("item_seq"), f["source_path"].alias("source_path"), f["source_type"].alias("source_type"), f["excerpt"].alias("exact_source_excerpt"),
                h["category_seq"].alias("category_seq"), h["normalized_category"].alias("normalized_category"), h["matched_terms"].alias("matched_terms"), h["polarity"].alias("polarity"),
                C.r6(strength).alias("evidence_strength"), C.r6(h["recency"]).alias("recency_weight"), C.r6(h["weight"]).alias("configured_weight"),
                C.r6(strength * h["recency"] * h["weight"]).alias("contribution_before_caps"), h["cap"].alias("cap"), h["strict"].alias("strict"), _family(f["source_type"]).alias("family"),
            )

        return F.transform(F.array_compact(F.array(*_hits(f, x["ids"], config, reference))), item)

    told = F.transform("fragments", lambda f, i: F.struct(i.alias("i"), f.alias("f"), F.get(F.col("term_ids"), i).alias("ids")))
    return F.flatten(F.transform(F.filter(told, lambda x: F.size(x["ids"]) > 0), of_fragment))


def graded(items: Column, categories: int) -> Column:
    """Items with their group's corroboration and what the group's cap leaves them, in ledger order.

    Groups (categories) follow their first item; in one, larger contributions
    come first, and each takes what is left of the cap: all within the row.
    """

    def of_group(k: Column) -> Column:
        own = F.filter(items, lambda x: x["category_seq"] == k)

        def walked(rows: Column) -> Column:
            families = F.array_distinct(rows["family"])
            level = F.least(F.lit(1.0), F.size(families) / F.lit(3.0))
            only_skill = (F.size(families) == 1) & F.array_contains(families, "skill")
            taken = F.struct(F.lit(0.0).alias("upto"), F.array().cast("array<double>").alias("after"))

            def take(acc: Column, x: Column) -> Column:
                amount = x["contribution_before_caps"] * F.when(x["strict"] & only_skill, F.lit(V.SKILL_ONLY_FACTOR)).otherwise(F.lit(1.0))
                upto = acc["upto"] + amount
                return F.struct(upto.alias("upto"), F.array_append(acc["after"], C.r6(F.least(x["cap"], upto) - F.least(x["cap"], upto - amount))).alias("after"))

            after = F.aggregate(rows, taken, take, lambda acc: acc["after"])
            return F.zip_with(rows, after, lambda x, a: F.struct(x.alias("x"), a.alias("after"), level.alias("level")))

        ordered = F.transform(F.array_sort(F.transform(own, lambda x: F.struct((-x["contribution_before_caps"]).alias("k"), x["item_seq"].alias("i"), x.alias("x")))), lambda y: y["x"])
        return F.struct(F.array_min(own["item_seq"]).alias("first"), C.bound(ordered, walked).alias("rows"))

    groups = F.transform(F.array(*[F.lit(k) for k in range(categories)]), of_group)
    return F.flatten(F.transform(F.array_sort(F.filter(groups, lambda g: g["first"].isNotNull())), lambda g: g["rows"]))


def items(context: DataFrame, config: Config, reference: Column) -> DataFrame:
    """Ledger rows before grouping, in fragment order (``item_seq``)."""
    rows = read(context, config).select("candidate_id", F.explode_outer(found(config, reference)).alias("x"))
    return rows.where("x is not null").select("candidate_id", "x.*").drop("category_seq")


def with_graded(context: DataFrame, config: Config, reference: Column) -> DataFrame:
    """Contexts with ``graded``: their ledger rows as an array, groups folded."""
    rows = read(context, config).withColumn("graded", C.bound(found(config, reference), lambda x: graded(x, len(config["evidence"]))))
    return rows.drop("fragments", "term_ids")


def _confidence(strength: Column, level: Column) -> Column:
    return C.r6(F.least(F.lit(1.0), strength * 0.7 + level * 0.3))


def _evidence_id(candidate: Column, index: Column) -> Column:
    return F.concat(F.lit("EVID_"), candidate, F.format_string("_%04d", index))


def ledger_rows(rows: DataFrame, with_hash: bool = True) -> DataFrame:
    """The ledger (``LEDGER``, ``item_seq``, ``evidence_index``, ``family``) of (candidate_id, graded), exploded.

    The explode is an outer one with a test after it: from a plain one the
    planner infers a filter on the array's size and works out the array twice.
    """
    rows = rows.select("candidate_id", F.posexplode_outer("graded").alias("evidence_index", "g")).where("g is not null")
    rows = rows.select("candidate_id", "evidence_index", "g.x.*", "g.after", "g.level")
    made = provenance(F.col("candidate_id"), F.col("source_path"), F.col("normalized_category"), F.col("exact_source_excerpt"), F.col("matched_terms"))
    out = rows.withColumns(
        {
            "contribution_after_caps": F.col("after"),
            "corroboration_level": C.r6("level"),
            "confidence": _confidence(F.col("evidence_strength"), F.col("level")),
            "evidence_id": _evidence_id(F.col("candidate_id"), F.col("evidence_index")),
            "provenance_hash": made if with_hash else F.lit(None).cast("string"),
        }
    )
    return out.select(*LEDGER, "item_seq", "evidence_index", "family")


def ledger(context: DataFrame, config: Config, reference: Column, with_hash: bool = True) -> DataFrame:
    """The ledger of contexts."""
    return ledger_rows(with_graded(context, config, reference), with_hash)


SUMMARY = [
    "evidence_item_count", "positive_evidence_count", "negative_evidence_count", "career_evidence_score", "skill_only_evidence_score", "skill_corroboration_score", "unsupported_skill_risk_score",
    "top_positive_evidence_ids", "top_negative_evidence_ids", "evidence_confidence", *[f"{n}_score" for n in V.EVIDENCE],
]


def summary_column() -> Column:
    """The evidence summary (``SUMMARY``) as folds over a row's ``graded``; zeros where it is empty, ids ordered by contribution."""
    none, zero = F.array().cast("array<string>"), F.lit(0.0)
    rows = F.transform("graded", lambda g, i: F.struct(g["x"].alias("x"), g["after"].alias("after"), g["level"].alias("level"), i.alias("i"), (g["x"]["polarity"] == "positive").alias("good")))
    total = lambda xs, f: F.aggregate(xs, zero, lambda a, r: a + f(r))
    after = lambda r: r["after"]
    of = lambda xs, family: F.filter(xs, lambda r: r["x"]["family"] == family)
    seqs = lambda xs: F.array_distinct(F.transform(xs, lambda r: r["x"]["category_seq"]))

    def first3(xs: Column) -> Column:
        keyed = F.transform(xs, lambda r: F.struct((-r["after"]).alias("k"), r["x"]["item_seq"].alias("item_seq"), r["i"].alias("i")))
        return F.coalesce(F.transform(F.slice(F.array_sort(keyed), 1, 3), lambda r: _evidence_id(F.col("candidate_id"), r["i"])), none)

    def folded(rows: Column) -> Column:
        good = F.filter(rows, lambda r: r["good"])
        return C.bound(F.struct(good.alias("good"), seqs(of(good, "skill")).alias("skills"), seqs(of(good, "career")).alias("careers")), lambda y: whole(rows, y))

    def whole(rows: Column, y: Column) -> Column:
        good, skills = y["good"], y["skills"]
        alone = F.array_except(skills, y["careers"])
        share = lambda n: C.r6(F.when(F.size(skills) > 0, n / F.size(skills).cast("double")).otherwise(zero))
        return F.struct(
            F.size(rows).cast("long").alias("evidence_item_count"),
            F.size(good).cast("long").alias("positive_evidence_count"),
            (F.size(rows) - F.size(good)).cast("long").alias("negative_evidence_count"),
            C.r6(total(of(good, "career"), after)).alias("career_evidence_score"),
            C.r6(total(F.filter(good, lambda r: F.array_contains(alone, r["x"]["category_seq"])), after)).alias("skill_only_evidence_score"),
            share(F.size(skills) - F.size(alone)).alias("skill_corroboration_score"),
            share(F.size(alone)).alias("unsupported_skill_risk_score"),
            first3(good).alias("top_positive_evidence_ids"),
            first3(F.filter(rows, lambda r: ~r["good"])).alias("top_negative_evidence_ids"),
            F.when(F.size(rows) > 0, C.r6(total(rows, lambda r: _confidence(r["x"]["evidence_strength"], r["level"])) / F.size(rows))).otherwise(zero).alias("evidence_confidence"),
            *[C.r6(total(F.filter(rows, lambda r: r["x"]["normalized_category"] == n), after)).alias(f"{n}_score") for n in V.EVIDENCE],
        )

    return C.bound(rows, folded)


def with_summary(rows: DataFrame) -> DataFrame:
    """Rows that have ``graded``, with the summary's columns; one row each, no shuffle."""
    return rows.withColumn("summary", summary_column()).withColumns({n: F.col(f"summary.{n}") for n in SUMMARY}).drop("summary")


def summary(rows: DataFrame) -> DataFrame:
    """One row for each candidate of (candidate_id, graded), zeros where it has no evidence."""
    return with_summary(rows).select("candidate_id", *SUMMARY)
