"""All queries on odd, empty and repeated rows; what each gives there."""

import corpus as K
import pytest

from siftwell.llm.queries import QUERIES

GROUPS = {(lang or "", source or "") for _, _, lang, source, _ in K.edge_rows()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows(spark, edge_dir, name):
    df = QUERIES[name](spark, edge_dir)
    rows = df.collect()
    if name == "op10_url_filter":
        assert len(rows) == 11
        return
    if name == "op13_source_divergence":  # no rows of documents: every two sources of a language, both ways
        pairs = {(r["lang"], r["source"], r["item"]) for r in rows if r["part"] == "pair"}
        assert pairs == {(a, s, t) for a, s in GROUPS for b, t in GROUPS if a == b and s != t}
        return
    want = sorted((r[0] is None, r[0] or 0) for r in K.edge_rows())
    got = [r for r in rows if name != "op2_packing" or r["piece"] == 0]
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == want
    plain = lambda r: tuple((c, r[c]) for c in df.columns if c not in ("sequence_id", "offset"))
    two = [plain(r) for r in rows if r["doc_id"] == 2]
    if name not in ("op1_fingerprints", "op11_merkle_manifest"):  # equal rows have equal results, but not equal neighbours
        assert len(set(two)) * 2 == len(two)
