import gzip
import json

import pytest
import records as R

from siftwell.sources import candidates as S
from siftwell.sources import sinks


def test_plain_and_gzip_scan_alike(spark, tmp_path):
    rows = [R.record(1), "{bad json", "", json.dumps([1, 2]), R.record(2), R.record(1)]
    plain = R.write(tmp_path / "c.jsonl", rows)
    with gzip.open(tmp_path / "c.jsonl.gz", "wb") as f:
        f.write((tmp_path / "c.jsonl").read_bytes())
    for path in (plain, str(tmp_path / "c.jsonl.gz")):
        valid, issues, stats = S.scan(spark, path)
        assert stats == {"total": 5, "malformed": 2, "invalid": 2, "duplicate": 1, "valid": 2}
        assert sorted(r["row_num"] for r in valid.collect()) == [1, 5]  # blank lines keep their number
        assert sorted((r["row_num"], r["type"]) for r in issues.collect()) == [(2, "malformed_json"), (4, "malformed_json"), (6, "duplicate_candidate_id")]


@pytest.mark.parametrize("field", ["candidate_id", "profile", "career_history", "education", "skills", "talent_signals"])
def test_each_missing_key_is_one_issue(spark, tmp_path, field):
    r = R.record(1)
    del r[field]
    _, issues, stats = S.scan(spark, R.write(tmp_path / "c.jsonl", [r]))
    got = [(i["type"], i["field"]) for i in issues.collect()]
    want = [("missing_required_field", "signals" if field == "talent_signals" else field)]
    assert sorted(got) == sorted(want + [("missing_candidate_id", None)] * (field == "candidate_id"))
    assert stats["valid"] == 0


def test_null_value_is_present_but_empty_id_is_not(spark, tmp_path):
    valid, issues, _ = S.scan(spark, R.write(tmp_path / "c.jsonl", [R.record(1, profile=None), R.record(2, candidate_id="")]))
    assert [r["candidate_id"] for r in valid.collect()] == ["CAND_0000001"]
    assert [i["type"] for i in issues.collect()] == ["missing_candidate_id"]


def test_threshold(spark, tmp_path):
    with pytest.raises(S.MalformedInput):
        S.scan(spark, R.write(tmp_path / "c.jsonl", ["{", "{", R.record(1)]), malformed_threshold=1)


def test_line_numbers_over_many_splits(spark, tmp_path):
    path = R.write(tmp_path / "c.jsonl", [json.dumps({"n": i, "pad": "x" * 50}) for i in range(4000)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
        rows = S.read_lines(spark, path)
        assert rows.rdd.getNumPartitions() > 4
        assert all(json.loads(r["line"])["n"] + 1 == r["row_num"] for r in rows.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_uploads():
    one = R.record(1)
    as_json = lambda v: json.dumps(v).encode()
    assert S.decode_upload(as_json(one), "a.json") == [one] == S.decode_upload(as_json({"candidates": [one]}), "a.json") == S.decode_upload(as_json(one) + b"\n\n", "a.jsonl")
    for bad in ([], [one, one], [{}], [R.record(i) for i in range(101)]):
        with pytest.raises(ValueError):
            S.decode_upload(as_json(bad), "a.json")
    with pytest.raises(ValueError):
        S.decode_upload(b"x", "a.txt")


def test_failed_publish_keeps_the_old_file(tmp_path):
    path = sinks.write_text(tmp_path / "a.txt", "old")

    def check(_):
        raise sinks.SinkError("no")

    with pytest.raises(sinks.SinkError):
        sinks.publish(path, lambda p: p.write_text("new"), check)
    assert path.read_text() == "old" and [p.name for p in tmp_path.iterdir()] == ["a.txt"]


def test_table_sink_checks_rows_and_columns(spark, tmp_path):
    df = spark.range(5)
    assert sinks.write_table(df, str(tmp_path / "t"), ["id"], rows=5).count() == 5
    for kw in ({"required": ["x"]}, {"rows": 4}):
        with pytest.raises(sinks.SinkError):
            sinks.write_table(df, str(tmp_path / "t"), **kw)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_raw_types_of_months_and_years(spark, tmp_path):
    """Whole numbers and flags are months; 3.0, texts and null aren't. Years in another type are no number to the audit's span rule."""
    from siftwell.functions import columns as C
    from siftwell.operators import audit

    rows = []
    for i, months in enumerate([3, 3.0, "3", True, False, None, 2**40]):
        r = R.record(i)
        r["career_history"][0]["duration_months"] = months
        r["skills"] = [{"name": "Python", "proficiency": "expert", "duration_months": months}, {"name": "SQL", "duration_months": 900}]
        rows.append(r)
    rows.append(R.record(50, profile={"years_of_experience": "30"}))
    rows.append(R.record(51, profile={"years_of_experience": 30}))
    rows.append(R.record(52, career_history=[], skills=None) | {"note": '"duration_months": true'})
    valid, _, stats = S.scan(spark, R.write(tmp_path / "c.jsonl", rows))
    assert stats["valid"] == len(rows)
    got = {r["candidate_id"]: r for r in valid.collect()}
    months = [(got[f"CAND_{i:07d}"]["career_history"][0]["duration_months"], [s["duration_months"] for s in got[f"CAND_{i:07d}"]["skills"]]) for i in range(7)]
    assert months == [(m, [m, 900]) for m in (3, None, None, 1, 0, None, 2**40)]
    assert got["CAND_0000052"]["career_history"] == [] and got["CAND_0000052"]["skills"] is None
    fired = {}
    for r in audit.issue_rows(valid, C.date_lit(R.REF)).collect():
        fired.setdefault(r["candidate_id"], []).append(r["type"])
    wrong = [i for i in range(7) if "duration_months_mismatch" in fired.get(f"CAND_{i:07d}", [])]
    assert wrong == [0, 3, 4, 6]  # what is no whole number isn't judged
    assert "experience_span_mismatch" not in fired.get("CAND_0000050", []) and "experience_span_mismatch" in fired["CAND_0000051"]
