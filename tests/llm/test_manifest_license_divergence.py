"""Merkle manifests, license scans and divergence audits against SQL and brute force."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus as K
import duckdb
import pytest
from pyspark.sql import functions as F

from siftwell.llm import divergence, licenses, merkle
from siftwell.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
NEW = ["op11_merkle_manifest", "op12_license_scan", "op13_source_divergence"]


def plain(rows):
    return sorted([tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows], key=repr)


def same_as_sql(spark, name, path, files):
    df = QUERIES[name](spark, path)
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{path}/documents.parquet{files}'")
    rel = c.sql(ORACLES[name])
    names, cols = [x[0] for x in rel.description], sorted(df.columns)
    assert sorted(names) == cols
    assert plain(tuple(r[x] for x in cols) for r in df.collect()) == plain(tuple(r[names.index(x)] for x in cols) for r in rel.fetchall())


@pytest.mark.parametrize("name", NEW)
def test_odd_rows_as_sql(spark, edge_dir, name):
    same_as_sql(spark, name, edge_dir, "/*.parquet")


@pytest.mark.parametrize("name", NEW)
@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_tables_as_sql(spark, name):
    same_as_sql(spark, name, SF, "")


# -- manifests --------------------------------------------------------------------------------------------------------


def h(hashes):
    return hashlib.sha256("".join(hashes).encode()).hexdigest()


def leaf(row):
    form = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    doc_id, text, lang, source, n_chars = row
    return h([form(v) for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes):
    """Levels of a tree, from the leaves on."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def beside(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 16 * 16 : i // 16 * 16 + 16]
        out.append((run, i % 16))
        i //= 16
    return out


def brute_manifest(rows):
    by_source = defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in by_source[s]])
    crown = tree([trees[s][-1][0] for s in order])
    root, out = crown[-1][0], []
    for at, s in enumerate(order):
        for i, r in enumerate(by_source[s]):
            path = beside(trees[s], i) + beside(crown, at)
            now = leaf(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                now = leaf((r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:]))
            for run, k in path:
                now = h([*run[:k], now, *run[k + 1 :]])
            out.append((r[0], leaf(r), trees[s][-1][0], root, h([x for run, k in path for j, x in enumerate(run) if j != k]), now, now == root))
    return out


def manifest_rows(sizes, seed=3):
    rng, rows = random.Random(seed), []
    for s, n in sizes.items():
        for _ in range(n):
            rows.append((rng.randrange(10_000), rng.choice(["Big", "small", None, "", "É X"]) and K.prose(rng, 3).title(), rng.choice(["en", None]), s, rng.choice([None, 5])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [{"a": 600, None: 17, "": 16, "é": 1, "b": 257, "z": 2}, {"one": 1}, {None: 300}, {f"s{i:03}": 1 + i % 3 for i in range(40)}], ids=["mixed", "lone", "null", "many"])
def test_manifest_as_brute_force(spark, tmp_path, sizes):
    rows = manifest_rows(sizes)
    rows += rows[:5]  # equal rows
    got = QUERIES["op11_merkle_manifest"](spark, K.documents(spark, tmp_path, rows)).collect()
    assert plain(map(tuple, got)) == plain(brute_manifest(rows))
    assert any(r["verified"] for r in got)


def test_manifest_tells_any_change(spark):
    rows = [(i, f"text {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "k int, t string").withColumn("g", F.lit("x"))
    changed = F.when(F.col("k") == 7, merkle.leaf_hash([F.col("k"), F.concat("t", F.lit("!"))]))
    got = merkle.manifest(df, "k", "g", ["k", "t"], changed).collect()
    assert [r["k"] for r in got if not r["verified"]] == [7]
    assert len({r["root"] for r in got}) == 1


def test_hot_source_is_spread(spark):
    """Runs of a source are dealt over all tasks, and numbering gathers no source."""
    df = spark.range(3000).select(F.lit("hot").alias("group"), F.col("id").alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"), F.lit(None).cast("string").alias("tampered"))
    rows, trees = merkle.number(df)
    sizes = rows.glom().map(len).collect()
    assert trees == 1 and max(sizes) < 1500 and sorted(rows.keys().collect()) == [(0, i) for i in range(3000)]


# -- licenses ---------------------------------------------------------------------------------------------------------


def accepts(markup, text):
    a = licenses.compile_templates([("x", markup)])
    words = licenses.words_of(text.encode())
    begins = [i for i, w in enumerate(words) if w in a.starts]
    return a.places(0, words, begins), a.share(0, a.reached(words, begins))


def test_template_regions():
    m = "[[the]] alpha [[very [[old]]]] beta {{1..3}} gamma [[end]]"
    assert accepts(m, "the alpha beta x gamma") == ([(1, 5)], 1.0)
    assert accepts(m, "Alpha, VERY beta x-y z gamma end")[0] == [(0, 7)]
    assert accepts(m, "alpha very old beta x gamma")[1] == 1.0
    assert accepts(m, "alpha old beta x gamma") == ([], 1 / 3)
    assert accepts(m, "alpha beta gamma")[0] == []  # the region needs a word
    assert accepts(m, "alpha beta a b c d gamma") == ([], 2 / 3)
    assert accepts(m, "alpha alpha beta x gamma alpha beta y gamma")[0] == [(1, 5), (5, 9)]
    assert accepts(m, "") == ([], 0.0)
    with pytest.raises(ValueError):
        licenses.parse("x", "[[only this]]")
    with pytest.raises(ValueError):
        licenses.parse("x", "a [[b")


def test_automaton_as_expressions():
    """Random markups over a small vocabulary against the same templates as regular expressions."""
    rng = random.Random(11)
    for _ in range(400):
        parts, depth = [rng.choice("ab")], 0
        for _ in range(rng.randrange(1, 9)):
            x = rng.random()
            if x < 0.2:
                parts.append("[[" + rng.choice("abc"))
                depth += 1
            elif x < 0.35 and depth:
                parts.append("]]")
                depth -= 1
            elif x < 0.5:
                least = rng.randrange(0, 3)
                parts.append(f"{{{{{least}..{least + rng.randrange(0, 3)}}}}}")
            else:
                parts.append(rng.choice("abc"))
        markup = " ".join(parts) + "]]" * depth + " " + rng.choice("ab")
        steps = licenses._expressions(markup)
        for _ in range(8):
            text = " ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 14)))
            want = max((n / steps[-1][1] for e, n in steps if re.search("(^| )" + e, text + " ")), default=0.0)
            places, share = accepts(markup, text)
            assert (share, bool(places)) == (want, want == 1.0), (markup, text)


def test_license_texts(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice (including the next paragraph) shall be included in all copies or substantial portions of the Software."
    rows = [
        (1, mit), (2, mit.replace("substantial", "big")), (3, "This work is licensed under the GNU General Public License, version 3."), (4, "Licensed under the Apache License, Version 2.0. " * 3), (5, "Licensed under CC BY-NC 4.0."),
        (6, "GNU Affero General Public License as published by the Free Software Foundation, either version 3"), (7, "clean words about a garden"), (8, "x " * 50_000 + "released under the MIT License."),
    ]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r["doc_id"]: r for r in licenses.scan(df, "doc_id", "text", [*licenses.PHRASES.items(), *licenses.TEMPLATES], 3).collect()}
    labels = {k: {p["label"] for p in [*r["literal"], *r["places"]]} for k, r in got.items()}
    assert labels == {1: {"mit"}, 2: set(), 3: {"gpl-3"}, 4: {"apache-2"}, 5: {"cc-by-nc"}, 6: {"agpl-3"}, 7: set(), 8: {"mit"}}
    assert len(got[4]["literal"]) == 3 and got[8]["literal"][0]["start"] == 50_001
    assert got[1]["score"] == 1.0 and 0 < got[2]["score"] < 1 and got[7]["score"] == 0.0


# -- divergence -------------------------------------------------------------------------------------------------------


def brute_audit(rows, least=10, top=10):
    rows = [(lang or "", source or "", text or "") for _, text, lang, source, _ in rows]
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    words = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low(t)) for _, _, t in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for (lang, source, _), w in zip(rows, words, strict=True):
        docs[lang].update(set(w))
        counts[lang, source].update(w)
    out = []
    for lang in {r[0] for r in rows}:
        kept = {t for t, n in docs[lang].items() if n >= least}
        sources = {s for a, s, _ in rows if a == lang}
        n = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        part = lambda c, size: 1 + 10**9 * (c + 2) // (size + 2 * len(kept))  # noqa: B023, E731
        diff = lambda p, q: (p - q) ** 2 // (p + q)
        p = {s: {t: part(counts[lang, s][t], n[s]) for t in kept} for s in sources}
        q = {t: part(sum(counts[lang, s][t] for s in sources), sum(n.values())) for t in kept}
        for s in sources:
            pairs = [(o, sum(diff(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, diff(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for name, found, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (item, value) in enumerate(sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                    out.append((lang, s, name, item, value, rank))
    return out


def test_audit_as_brute_force(spark, tmp_path):
    rng, rows = random.Random(8), []
    for i in range(700):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None, "", "ü", "rare"])
        words = [rng.choice(["Él", "ñ", "x1y", "a-b"]) if rng.random() < 0.2 else rng.choice(K.WORDS) + rng.choice(["", "s", "ÉÉ"]) for _ in range(rng.randrange(0, 30))]
        rows.append((i, None if source == "rare" else " ".join(words), lang, source, 1))
    rows += [(900, "few words", "fr", "a", 1), (901, "", "fr", "b", 1), (902, None, "it", "a", 1)]
    got = QUERIES["op13_source_divergence"](spark, K.documents(spark, tmp_path, rows)).collect()
    assert plain(map(tuple, got)) == plain(brute_audit(rows))


def test_shares_of_huge_counts_are_exact(spark):
    n, size, kept = 7 * 10**12 + 3, 9 * 10**14 + 7, 10**8 + 1
    got = spark.range(1).select(divergence.share(F.lit(n).cast("long"), F.lit(size).cast("long"), F.lit(kept).cast("long"))).head()[0]
    assert got == 1 + 10**9 * (n + 2) // (size + 2 * kept)


@pytest.mark.parametrize("ties", [1, 2, 5, 64])
def test_radix_top_with_ties(spark, ties):
    rng, rows = random.Random(ties), []
    for g in range(4):
        seen = set()
        while len(seen) < 300:
            seen.add("prefix" * rng.randrange(0, 4) + rng.choice(["", "é", "z", "漢"]) + "".join(rng.choice("abÿ") for _ in range(rng.randrange(0, 9))))
        few = [0, 5, 2**15, 2**15 + 1, 2**29] if g else [7]
        rows += [(f"g{g}", x, rng.choice(few)) for x in seen]
    rows += [("tiny", "only", 3)]
    df = spark.createDataFrame(rows, "g string, item string, value long").repartition(5)
    got = {(r["g"], r["item"], r["rank"]) for r in divergence.radix_top(df, ["g"], "value", "item", 10, ties=ties).collect()}
    want = set()
    for g in {r[0] for r in rows}:
        order = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1].encode()))
        want |= {(g, r[1], i) for i, r in enumerate(order[:10], 1)}
    assert got == want
