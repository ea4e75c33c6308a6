"""Language ID: nearest of several centroids per language over TF-IDF character n-grams.

A text's lower-cased code points, runs of non-letters read as one blank, give
hashed 1-, 2- and 3-grams; log term counts times idf, scaled to length 1, are
its vector. The model holds, for each language, ``CENTROIDS`` spherical k-means
centroids fitted on at most ``fit_rows`` labelled rows (those with the smallest
hash of their id). A text gets the language of the centroid with the largest
cosine; where that falls below the centroid's own rejection radius, ``accepted``
is false.

Edge cases: a text that is null or has no letter gets ``und`` with score 0 and
isn't accepted; with nothing to learn from, all texts do. Repeated ids are
learned from once. Whole texts are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.common import fold, prepare, read_table

DIM_BITS = 12
DIM = 1 << DIM_BITS
CENTROIDS = 3
#: Rows that the model is fitted on, at most.
FIT_ROWS = 4000
#: A radius lets this share of a centroid's own rows pass.
PASS_SHARE = 0.995
UNKNOWN = "und"
_K = [np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)]


class NGrams:
    """Hashed n-gram counts of a text."""

    def __init__(self) -> None:
        # Letters of the first two planes keep their code point; all else is a blank.
        self.letter = np.fromiter((chr(i).isalpha() for i in range(0x20000)), bool, 0x20000)

    def counts(self, text: str) -> np.ndarray | None:
        codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
        ok = self.letter[np.minimum(codes, 0x1FFFF)]
        if len(codes) and codes.max() > 0x1FFFF:
            high = codes > 0x1FFFF
            ok[high] = [chr(c).isalpha() for c in codes[high].tolist()]
        if not ok.any():
            return None
        keep = ok.copy()
        keep[1:] |= ok[:-1]  # the first blank after a letter stays
        c = np.where(ok, codes, np.uint32(32))[keep]
        c = np.concatenate([[np.uint32(32)], c, [np.uint32(32)]]).astype(np.uint32)
        shift = np.uint32(32 - DIM_BITS)
        out = np.bincount((c * _K[0]) >> shift, minlength=DIM)
        two = c[:-1] * _K[1] + c[1:]
        out += np.bincount((two * _K[0]) >> shift, minlength=DIM)
        if len(c) > 2:
            out += np.bincount(((two[:-1] * _K[2] + c[2:]) * _K[0]) >> shift, minlength=DIM)
        return out


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # rows: CENTROIDS for each language
    radius: np.ndarray


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _cluster(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts are spread by farthest-first from the mean."""
    seeds = [_unit(x.mean(0))]
    for _ in range(k - 1):
        seeds.append(x[np.argmin((x @ np.array(seeds).T).max(1))])
    c = _unit(np.array(seeds))
    for _ in range(12):
        near = (x @ c.T).argmax(1)
        c = np.array([_unit(x[near == i].mean(0)) if (near == i).any() else c[i] for i in range(k)])
    return c


def fit(counts: np.ndarray, langs: list[str]) -> Model:
    """``counts``: rows of n-gram counts; ``langs``: their languages."""
    names = sorted(set(langs))
    idf = (np.log((1 + len(langs)) / (1 + (counts > 0).sum(0))) + 1).astype(np.float32)
    x = _unit(np.log1p(counts) * idf)
    y = np.array([names.index(v) for v in langs], int)
    cents, radii = [], []
    for i in range(len(names)):
        own = x[y == i]
        c = _cluster(own, CENTROIDS)
        sim = own @ c.T
        near = sim.argmax(1)
        cents.append(c)
        radii += [float(np.quantile(sim[near == k, k], 1 - PASS_SHARE)) if (near == k).any() else 1.0 for k in range(CENTROIDS)]
    return Model(names, idf.astype(np.float32), np.concatenate(cents).astype(np.float32) if cents else np.zeros((0, DIM), np.float32), np.array(radii))


def predict(model: Model, counts: np.ndarray | None) -> tuple[str, float, bool]:
    """(language, score, accepted); the score is the softmax share of the best language's cosine."""
    if counts is None or not model.languages:
        return UNKNOWN, 0.0, False
    v = np.log1p(counts).astype(np.float32) * model.idf
    sim = model.centroids @ (v / max(float(np.linalg.norm(v)), 1e-12))
    best = sim.reshape(-1, CENTROIDS).max(1)
    at = int(best.argmax())
    share = np.exp(20 * (best - best[at]))
    return model.languages[at], float(1 / share.sum()), bool(sim.max() >= model.radius[int(sim.argmax())])


def fit_on(df: DataFrame, key: str, text: str, label: str, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``fit_rows`` rows of ``df`` that have a label and a text.

    They are the ids with the smallest hashes and, of rows with one id, the one
    with the smallest hash of label and text. Only the n-grams that occur in
    them, with their counts, come to the driver; texts without a letter don't.
    """
    prepare(df.sparkSession)
    known = df.where(F.col(label).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    ids = known.select(key).distinct().orderBy(F.xxhash64(key), key).limit(fit_rows)
    one = F.min(F.struct(F.xxhash64(label, text).alias("h"), F.col(label).cast("string").alias("lang"), F.col(text).alias("text"))).alias("one")
    chosen = known.select(key, label, text).join(F.broadcast(ids), key, "left_semi").groupBy(key).agg(one).select("one.text", "one.lang", F.xxhash64(key).alias("h"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = NGrams()
        for b in batches:
            rows = [(g, lang, h) for t, lang, h in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True) if (g := grams.counts(t)) is not None]
            if rows:
                at = [np.flatnonzero(g) for g, _, _ in rows]
                packed = [a.astype(np.uint16).tobytes() + g[a].astype(np.uint32).tobytes() for a, (g, _, _) in zip(at, rows, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([r[2] for r in rows], pa.int64()), pa.array(packed, pa.binary()), pa.array([r[1] for r in rows])], names=["h", "v", "lang"])

    rows = sorted((r["h"], r["lang"], bytes(r["v"])) for r in chosen.mapInArrow(vectors, "h long, v binary, lang string").toLocalIterator())
    if not rows:
        return Model([], np.ones(DIM, np.float32), np.zeros((0, DIM), np.float32), np.zeros(0))
    counts = np.zeros((len(rows), DIM), np.float32)
    for i, (_, _, v) in enumerate(rows):
        n = len(v) // 6
        counts[i, np.frombuffer(v, np.uint16, n)] = np.frombuffer(v, np.uint32, n, 2 * n)
    return fit(counts, [lang for _, lang, _ in rows])


def predict_all(df: DataFrame, model: Model, text: str, extra: list[str], schema: str) -> DataFrame:
    """``extra`` columns, then lang_pred, score and accepted for every row; one pass, no shuffle."""
    spark = prepare(df.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # of a fixed size: DIM numbers for each centroid
    names = [*extra, "lang_pred", "score", "accepted"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, m = NGrams(), shared.value
        for b in batches:
            found = [predict(m, grams.counts(t) if t else None) for t in b.column(len(extra)).to_pylist()]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(extra))), *columns], names=names)

    return df.select(*extra, text).mapInArrow(run, f"{schema}, lang_pred string, score double, accepted boolean")


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, accepted; fold 2 of 4 is held out of the fit."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"))
    model = fit_on(docs.where(~F.col("held_out")), "doc_id", "text", "lang")
    return predict_all(docs, model, "text", ["doc_id", "held_out"], "doc_id long, held_out boolean")
