"""Candidate records from JSON lines: numbered lines, a reject channel, shape checks and keep-first deduplication."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siftwell.functions import fixed_values as V

PROFILE = "struct<headline:string,summary:string,current_title:string,current_company:string,current_company_size:string,current_industry:string,location:string,country:string,years_of_experience:double>"
HISTORY = "array<struct<company:string,title:string,start_date:string,end_date:string,duration_months:bigint,is_current:boolean,industry:string,company_size:string,description:string>>"
SKILLS = "array<struct<name:string,proficiency:string,endorsements:bigint,duration_months:bigint>>"
CERTIFICATIONS = "array<struct<name:string,issuer:string>>"
SIGNALS = (
    "struct<profile_completeness_score:double,signup_date:string,last_active_date:string,open_to_work_flag:boolean,recruiter_response_rate:double,avg_response_time_hours:double,"
    "notice_period_days:double,preferred_work_mode:string,willing_to_relocate:boolean,github_activity_score:double,interview_completion_rate:double,"
    "skill_assessment_scores:map<string,double>,expected_salary_range_inr_lpa:struct<min:double,max:double>>"
)
RECORD = f"struct<candidate_id:string,profile:{PROFILE},career_history:{HISTORY},skills:{SKILLS},certifications:{CERTIFICATIONS}>"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, row_num, line): text lines (gzip by suffix) with their number in their file, from 1.

    Splits are counted once and numbered by prefix sums, so no order has to be
    gathered in one task; what is broadcast is one row for each file split.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"))
    splits = lines.groupBy("file", "at").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    w = Window.partitionBy("file").orderBy("at")
    before = splits.select("file", "at", "first", (F.sum("n").over(w) - F.col("n")).alias("before"))
    return lines.join(F.broadcast(before), ["file", "at"]).select("file", (F.col("id") - F.col("first") + F.col("before") + 1).alias("row_num"), F.col("value").alias("line"))


def signals_key(keys: Column) -> Column:
    """The record's one key that ends in ``_signals``."""
    return F.get(F.filter(keys, lambda k: k.endswith("_signals")), F.lit(0))


#: Lines in which a number of months is true or false; no other raw type has to be told from what the schema reads.
_MONTHS_AS_FLAG = r'"duration_months"\s*:\s*(?:true|false)'


def with_typed_months(record: Column) -> Column:
    """A parsed record with months as the raw JSON types them: whole numbers count, true and false are 1 and 0, while 3.0, "3" and null are no number.

    The schema reads all but the flags so; lines that have such are read once more, as variants.
    """
    raw = F.try_parse_json("line")
    value = lambda x: F.try_variant_get(x, "$.duration_months", "variant")
    flag = lambda x: F.when(F.schema_of_variant(value(x)) == "BOOLEAN", F.try_variant_get(x, "$.duration_months", "boolean").cast("bigint"))

    def typed(name: str) -> Column:
        items = F.try_variant_get(raw, f"$.{name}", "array<variant>")
        return F.zip_with(record[name], items, lambda x, v: F.when(x.isNotNull(), x.withField("duration_months", F.coalesce(x["duration_months"], flag(v)))))

    fixed = record.withField("career_history", typed("career_history")).withField("skills", typed("skills"))
    return F.when(F.col("line").rlike(_MONTHS_AS_FLAG), fixed).otherwise(record)


def parse(lines: DataFrame, *extra: str) -> DataFrame:
    """Lines as records: ``keys`` is null where a line is no JSON object; blank lines are left out, ``extra`` columns kept."""
    rows = lines.where(F.trim("line") != "").withColumn("keys", F.json_object_keys("line"))
    key = signals_key(F.col("keys"))
    whole = F.when(F.col("keys").isNotNull(), F.from_json("line", RECORD))
    signals = F.from_json(F.call_function("get_json_object", F.col("line"), F.concat(F.lit("$."), key)), SIGNALS)
    return rows.withColumn("r", whole).withColumn("r", with_typed_months(F.col("r"))).select("file", "row_num", "line", "keys", "r.*", signals.alias("signals"), *extra)


def shape_issues(parsed: DataFrame) -> DataFrame:
    """(file, row_num, candidate_id, type, severity, field): one row for each malformed line or failed shape check."""
    keys = F.col("keys")
    severe = lambda kind, field: F.struct(F.lit(kind).alias("type"), F.lit("severe").alias("severity"), field.alias("field"))
    none = F.lit(None).cast("string")
    required = F.array(*[F.lit(f) for f in V.REQUIRED_FIELDS])
    missing = F.concat(F.filter(required, lambda f: ~F.array_contains(keys, f)), F.when(signals_key(keys).isNull(), F.array(F.lit("signals"))).otherwise(F.array().cast("array<string>")))
    no_id = F.when(F.coalesce(F.col("candidate_id"), F.lit("")) == "", F.array(severe("missing_candidate_id", none))).otherwise(F.array().cast("array<struct<type:string,severity:string,field:string>>"))
    checks = F.when(keys.isNull(), F.array(severe("malformed_json", none))).otherwise(F.concat(no_id, F.transform(missing, lambda f: severe("missing_required_field", f))))
    return parsed.select("file", "row_num", "candidate_id", F.explode_outer(checks).alias("i")).where("i is not null").select("file", "row_num", "candidate_id", "i.*")


def is_valid() -> Column:
    """Whether a parsed row passes every shape check."""
    keys = F.col("keys")
    ok = keys.isNotNull() & (F.coalesce(F.col("candidate_id"), F.lit("")) != "") & signals_key(keys).isNotNull()
    for f in V.REQUIRED_FIELDS:
        ok = ok & F.array_contains(keys, f)
    return F.coalesce(ok, F.lit(False))


def numbered_copies(valid: DataFrame) -> DataFrame:
    """``copy``: 1 for the first row of each id in file order."""
    return valid.withColumn("copy", F.row_number().over(Window.partitionBy("candidate_id").orderBy("file", "row_num")))


def valid_records(parsed: DataFrame, buckets: int | None = None) -> DataFrame:
    """Valid rows, the first of each candidate id; dealt into so many buckets by id, if told, by the same exchange."""
    valid = parsed.where(is_valid())
    return numbered_copies(valid.repartition(buckets, "candidate_id") if buckets else valid).where("copy = 1").drop("copy")


def duplicates(parsed: DataFrame) -> DataFrame:
    """Every later row of an id, as an issue."""
    rows = numbered_copies(parsed.where(is_valid())).where("copy > 1")
    return rows.select("file", "row_num", "candidate_id", F.lit("duplicate_candidate_id").alias("type"), F.lit("severe").alias("severity"), F.lit(None).cast("string").alias("field"))


class MalformedInput(ValueError):
    """More malformed lines than the threshold allows."""


def check(parsed: DataFrame, malformed_threshold: int = 10000) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(valid records, issues, counters) of parsed rows, which are read more than once; raises where malformed lines pass the threshold."""
    copies = duplicates(parsed)
    counts = parsed.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("keys").isNull()).alias("malformed"), F.count_if(is_valid()).alias("shaped")).head()
    if counts["malformed"] > malformed_threshold:
        raise MalformedInput(f"{counts['malformed']} malformed lines pass the threshold of {malformed_threshold}")
    stats = {"total": counts["total"], "malformed": counts["malformed"], "invalid": counts["total"] - counts["shaped"], "duplicate": copies.count()}
    stats["valid"] = counts["shaped"] - stats["duplicate"]
    return valid_records(parsed), shape_issues(parsed).unionByName(copies), stats


def scan(spark: SparkSession, path: str, malformed_threshold: int = 10000) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """``check`` of a file's lines."""
    return check(parse(read_lines(spark, path)), malformed_threshold)


# -- uploads of up to a hundred records -------------------------------------------------------------------------------

UPLOAD_LIMIT = 100


def decode_upload(payload: bytes, filename: str) -> list[dict]:
    """Records of an uploaded file: JSON lines, a list, ``{"candidates": [...]}`` or one object."""
    text = payload.decode("utf-8-sig")
    if filename.lower().endswith(".jsonl"):
        rows = [json.loads(line) for line in text.splitlines() if line.strip()]
    elif filename.lower().endswith(".json"):
        value = json.loads(text)
        if isinstance(value, dict):
            value = value.get("candidates", [value])
        rows = value
    else:
        raise ValueError("upload a .json or .jsonl file")
    return check_upload(rows)


def check_upload(rows: list) -> list[dict]:
    if not isinstance(rows, list) or not rows:
        raise ValueError("the upload holds no records")
    if len(rows) > UPLOAD_LIMIT:
        raise ValueError(f"the upload holds {len(rows)} records; {UPLOAD_LIMIT} are allowed")
    problems, seen = [], set()
    for i, row in enumerate(rows, 1):
        if not isinstance(row, dict):
            problems.append(f"row {i}: not an object")
            continue
        bad = [f"row {i}: missing {f}" for f in V.REQUIRED_FIELDS if f not in row]
        bad += [f"row {i}: missing signals"] * (not any(str(k).endswith("_signals") for k in row))
        problems += bad[:3]
        cid = row.get("candidate_id")
        if cid in seen:
            problems.append(f"row {i}: duplicate candidate_id {cid}")
        seen.add(cid)
    if problems:
        raise ValueError("; ".join(problems[:5]))
    return rows
