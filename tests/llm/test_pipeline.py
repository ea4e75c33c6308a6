import random

import corpus as K
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(11)
    passage = K.prose(rng, 70)
    rows, labels = [], []

    def add(text, toxic=None):
        rows.append((len(rows), text, "en", "a", len(text)))
        if toxic is not None:
            labels.append((len(rows) - 1, 1, toxic))
        return len(rows) - 1

    for i in range(800):
        bad = i % 8 == 0
        add(K.prose(rng, rng.randint(50, 120)) + (" idiot moron pathetic" if bad else ""), int(bad))
    original = add(K.prose(rng, 150))
    copies = [add(rows[original][1]), add(K.near_copy(rows[original][1], rng))]
    first, second = add(K.prose(rng, 60) + " " + passage + " " + K.prose(rng, 60)), add(K.prose(rng, 60) + " " + passage + " " + K.prose(rng, 60))
    secret = add(K.prose(rng, 60) + " token=" + K.token(5) + " " + K.prose(rng, 20))
    toxic = add(K.prose(rng, 60) + " moron idiot idiot pathetic scum", None)
    d = K.documents(spark, tmp_path, rows)
    K.table(spark, tmp_path, "labels", labels, "doc_id long, quality int, toxic int")
    docs, kept = spark.read.parquet(f"{d}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, d), name)
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
    clean = {i for i, *_ in rows if i < 800 and i % 8}
    assert toxic not in kept["toxicity"] and not any(i in kept["toxicity"] for i in range(0, 800, 8)) and clean <= set(kept["toxicity"])
    near = kept["simhash_near_dedup"]
    assert original in near and not any(c in near for c in copies) and clean <= set(near)
    cut = kept["suffix_array_dedup"]
    assert set(cut) == set(near) and passage in cut[first]["text"] and passage not in cut[second]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in cut.values()) and all(cut[i]["text"] == rows[i][1] for i in clean)
    assert K.token(5) not in kept["secret_scans"][secret]["text"] and "[SECRET]" in kept["secret_scans"][secret]["text"]
    packed = docs.collect()
    assert {r["doc_id"] for r in packed} == set(near) and corpus_pipeline.run(spark, d).count() == len(packed)


def test_odd_and_empty_tables(spark, edge_dir, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).count() == 0
    rows = corpus_pipeline.run(spark, edge_dir).collect()
    assert {1, 4, 7, None} <= {r["doc_id"] for r in rows} and not {2, 3} & {r["doc_id"] for r in rows}
