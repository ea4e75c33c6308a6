"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of lexicon words and of lexicon word beginnings,
their largest and summed log-odds, their proximity to second-person words,
rates of capitals, punctuation, repeated marks, digits in words and obfuscated
words (look-alike characters or separators undone before the lexicon is asked).

The lexicon is a short seed of insults and what labelled rows teach: words and
word beginnings that toxic rows have far more often. Labelled rows (at most
``FIT_ROWS``, those with the smallest hash of their id) are split by that hash:
lexicon, trees, calibration. Only counts of the lexicon's candidates, and a
fixed number of features for each fitting row, come to the driver.

Edge cases: a null text counts as empty and is scored like one; rows without a
label, or with a null one, are scored but not learned from; with too few
labelled rows of either kind the score is the share of toxic ones (0 if none).
Repeated labels of an id count as toxic if any is; of different texts with one
id, the one with the smallest hash is learned from. Whole texts are used.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.common import fold, prepare, read_table

#: Labelled rows that the model is fitted on, at most.
FIT_ROWS = 24_000
#: Entries that are learned, at most.
LEXICON = 600
#: A learned entry is in at least so many toxic rows, and its smoothed log-odds are at least this.
LEAST_ROWS, LEAST_ODDS = 6, 2.5
STEMS = (4, 5, 6)
#: Characters of a word that counts travel with; a longer one travels, and is remembered, as its hash.
NAMED = 64
SEED_WORDS = frozenset(
    "idiot idiots moron morons stupid loser losers scum trash garbage pathetic worthless disgusting clown dumb ugly fool jerk creep freak liar coward hate shut kill".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine tu toi te ton ta tes vous votre usted tus ti vos".split())
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"})
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»„“”‘’…¿¡"
_NOT_LETTER = re.compile(r"[\W\d_]+")


def words_of(text: str) -> list[str]:
    """Lower-cased words without marks at their ends."""
    return [w for w in (v.strip(_EDGE) for v in text.lower().split()) if w]


def name_of(word: str) -> str:
    """How the lexicon calls a word: by itself or, beyond ``NAMED`` characters, by its hash."""
    return word if len(word) <= NAMED else "#" + hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def entries_of(word: str) -> list[str]:
    """What the lexicon may hold of a word: itself and its beginnings, marked by a star."""
    return [name_of(word), *(word[:n] + "*" for n in STEMS if len(word) >= n)]


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    trees: list[tuple] = field(default_factory=list)
    edges: np.ndarray | None = None
    prior: float = 0.0
    steps: tuple[np.ndarray, np.ndarray] | None = None


class Featurizer:
    def __init__(self, lexicon: dict[str, float]) -> None:
        self.words = {k: v for k, v in lexicon.items() if not k.endswith("*")} | {w: max(lexicon.get(w, 0), 2.0) for w in SEED_WORDS}
        self.stems = {k[:-1]: v for k, v in lexicon.items() if k.endswith("*")}
        self.memo: dict[str, tuple[float, float, bool]] = {}
        # No code point beyond the first two planes is a capital.
        self.upper = np.fromiter((chr(i).isupper() for i in range(0x20000)), bool, 0x20000)

    def judge(self, word: str) -> tuple[float, float, bool]:
        """(log-odds as a word, as a beginning, found only after undoing an obfuscation)."""
        hit = self.memo.get(word)
        if hit is not None:
            return hit
        out = self._judge(word)
        if len(word) <= NAMED and len(self.memo) < 200_000:
            self.memo[word] = out
        return out

    def _judge(self, word: str) -> tuple[float, float, bool]:
        w = self.words.get(name_of(word), 0.0)
        s = max((self.stems.get(word[:n], 0.0) for n in STEMS), default=0.0)
        if not w and not s and not word.isalpha():
            plain = _NOT_LETTER.sub("", word.translate(LOOKALIKE))
            if len(plain) >= 4 and (v := self.words.get(plain, 0.0)):
                return v, 0.0, True
        return w, s, False

    def features(self, text: str) -> list[float]:
        found = words_of(text)
        n = len(found)
        odds, stems, at, you = [], [], [], []
        hidden = digits = 0
        for i, word in enumerate(found):
            w, s, h = self.judge(word)
            if w:
                odds.append(w)
                at.append(i)
                hidden += h
            if s:
                stems.append(s)
                at.append(i)
            if word in SECOND_PERSON:
                you.append(i)
            elif not word.isalpha() and any(c.isdigit() for c in word) and any(c.isalpha() for c in word):
                digits += 1
        near = math.inf
        if at and you:
            a, y = np.array(at), np.array(you)
            k = np.searchsorted(y, a)
            near = float(np.minimum(np.abs(a - y[np.minimum(k, len(y) - 1)]), np.abs(a - y[np.maximum(k - 1, 0)])).min())
        chars = max(1, len(text))
        upper = int(self.upper[np.minimum(np.frombuffer(text.encode("utf-32-le"), np.uint32), len(self.upper) - 1)].sum())
        marks = len(_MARKS.findall(text))
        return [
            len(odds), len(odds) / max(1, n), max(odds, default=0.0), min(sum(odds), 200.0),
            len(stems), len(stems) / max(1, n), max(stems, default=0.0), min(sum(stems), 200.0), hidden, hidden / max(1, n),
            1 / (1 + near), len(you) / max(1, n), upper / chars, marks / chars, text.count("!") / chars, len(_RUNS.findall(text)) / chars, digits / max(1, n), len(set(at)) / max(1, n),
        ]


_MARKS = re.compile(r"[^\w\s]")
_RUNS = re.compile(r"([!?*#$%&])\1+")


# -- gradient-boosted trees -------------------------------------------------------------------------------------------


def _bins(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(edges[j], x[:, j], side="right") for j in range(x.shape[1])], 1)


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, least: float = 8.0, ridge: float = 2.0) -> Model:
    """Logistic boosting on histograms of 32 quantile bins."""
    edges = np.stack([np.quantile(x[:, j], np.linspace(0, 1, 33)[1:-1]) for j in range(x.shape[1])])
    b = _bins(x, edges)
    prior = math.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6))
    f, trees = np.full(len(y), prior), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        feature, cut = np.full(2**depth - 1, -1), np.zeros(2**depth - 1, int)
        node = np.zeros(len(y), int)
        for at in range(2**depth - 1):
            mine = node == at
            if mine.sum() < 2 * least:
                node[mine] = 2 * at + 1
                continue
            best = (1e-4, -1, 0)
            gs, hs = g[mine].sum(), h[mine].sum()
            for j in range(x.shape[1]):
                gl = np.cumsum(np.bincount(b[mine, j], g[mine], 32))[:-1]
                hl = np.cumsum(np.bincount(b[mine, j], h[mine], 32))[:-1]
                nl = np.cumsum(np.bincount(b[mine, j], minlength=32))[:-1]
                ok = (nl >= least) & (mine.sum() - nl >= least)
                gain = np.where(ok, gl**2 / (hl + ridge) + (gs - gl) ** 2 / (hs - hl + ridge) - gs**2 / (hs + ridge), 0)
                if gain.max() > best[0]:
                    best = (gain.max(), j, int(gain.argmax()))
            feature[at], cut[at] = best[1], best[2]
            right = mine & (b[:, best[1]] > best[2]) if best[1] >= 0 else np.zeros(len(y), bool)
            node[mine] = 2 * at + 1
            node[right] = 2 * at + 2
        leaf = node - (2**depth - 1)
        value = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + ridge)
        f += value[leaf]
        trees.append((feature, cut, value))
    return Model(trees=trees, edges=edges, prior=prior)


def raw_scores(model: Model, x: np.ndarray) -> np.ndarray:
    b = _bins(x, model.edges)
    out = np.full(len(x), model.prior)
    row = np.arange(len(x))
    for feature, cut, value in model.trees:
        node = np.zeros(len(x), int)
        for _ in range(int(math.log2(len(value)))):
            j = feature[node]
            node = 2 * node + 1 + ((j >= 0) & (b[row, j] > cut[node]))
        out += value[node - (len(value) - 1)]
    return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; (knots, values) for linear interpolation, values within 0.001 and 0.999."""
    blocks: list[list[float]] = []  # sum of labels, rows, first score, last score
    scores, place = np.unique(score, return_inverse=True)  # ties are one block
    sums, counts = np.bincount(place, y), np.bincount(place)
    for s, v, n in zip(scores.tolist(), sums.tolist(), counts.tolist(), strict=True):
        blocks.append([v, n, s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            a = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a[0], blocks[-1][1] + a[1], blocks[-1][2], a[3]]
    knots, values = [], []
    for total, n, first, last in blocks:
        v = min(0.999, max(0.001, (total + 0.02) / (n + 0.04)))
        knots += [first, last] if last > first else [first]
        values += [v, v] if last > first else [v]
    return np.array(knots), np.maximum.accumulate(np.array(values))


def score_texts(model: Model, featurizer: Featurizer, texts: list[str]) -> np.ndarray:
    if model.edges is None:
        return np.full(len(texts), model.prior)
    raw = raw_scores(model, np.array([featurizer.features(t) for t in texts]))
    return np.interp(raw, *model.steps) if model.steps is not None else 1 / (1 + np.exp(-raw))


# -- on tables --------------------------------------------------------------------------------------------------------


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Log-odds of words and beginnings, from (text, y) rows; counted on the executors."""
    prepare(rows.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, other = Counter(), Counter()
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                (toxic if y else other).update({e for w in set(words_of(t or "")) for e in entries_of(w)})
        keys = list(toxic.keys() | other.keys())
        for i in range(0, len(keys), 50_000):
            part = keys[i : i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([toxic[k] for k in part], pa.int64()), pa.array([other[k] for k in part], pa.int64())], names=["entry", "toxic", "other"])

    totals = rows.agg(F.sum("y"), F.count(F.lit(1))).head()
    yes, n = int(totals[0] or 0), int(totals[1])
    counts = rows.select("text", "y").mapInArrow(count, "entry string, toxic long, other long").groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    odds = F.log((F.col("toxic") + 0.5) / F.lit(yes + 1.0)) - F.log((F.col("other") + 0.5) / F.lit(n - yes + 1.0))
    best = counts.where(F.col("toxic") >= LEAST_ROWS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    top = best.orderBy(F.desc(F.col("odds") * F.log("toxic")), "entry").limit(LEXICON)  # the lexicon's size is a parameter
    return {r["entry"]: float(r["odds"]) for r in top.collect()}


def fit(df: DataFrame, labels: DataFrame, key: str, text: str, label: str, fit_rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``fit_rows`` labelled rows of ``df``."""
    spark = prepare(df.sparkSession)
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(F.max(F.col(label).cast("int")).alias("y"))
    chosen = known.join(df.select(key).distinct(), key, "left_semi").withColumn("h", F.xxhash64(key)).orderBy("h", key).limit(fit_rows)
    rows = spark.createDataFrame([(r[key], r["y"], i % 20) for i, r in enumerate(chosen.collect())] or [(0, 0, 0)], f"`{key}` long, y int, role int")
    # One text for each id, however often the id occurs; each task brings down its own first.
    one = F.min(F.struct(F.xxhash64(text).alias("h"), F.col(text).alias("text")))
    named = df.select(F.col(key).cast("long").alias(key), text).join(F.broadcast(rows.select(key)), key, "left_semi")
    texts = named.groupBy(key).agg(one.alias("one")).join(F.broadcast(rows), key).select(key, "one.text", "y", "role")
    lexicon = learn_lexicon(texts.where("role < 8"))

    def featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = Featurizer(lexicon)
        for b in batches:
            x = [np.array(f.features(t or ""), np.float64).tobytes() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()), b.column(1), b.column(2), b.column(3)], names=["x", "y", "role", "k"])

    got = texts.where("role >= 8").select("text", "y", "role", F.col(key).alias("k")).mapInArrow(featurize, "x binary, y int, role int, k long").collect()
    got = sorted(got, key=lambda r: (r["k"], bytes(r["x"])))
    y = np.array([r["y"] for r in got], float)
    if y.sum() < 8 or (1 - y).sum() < 8:
        return Model(prior=float(y.mean()) if len(y) else 0.0)
    x = np.array([np.frombuffer(bytes(r["x"])) for r in got])
    tree = np.array([r["role"] < 16 for r in got])
    if min(y[tree].sum(), (1 - y[tree]).sum(), y[~tree].sum(), (1 - y[~tree]).sum()) < 4:
        tree[:] = True
    model = fit_trees(x[tree], y[tree])
    model.lexicon = lexicon
    held = ~tree if (~tree).any() else tree
    model.steps = isotonic(raw_scores(model, x[held]), y[held])
    return model


def score_all(df: DataFrame, model: Model, text: str, extra: list[str], schema: str) -> DataFrame:
    """``extra`` columns and the score of every row; one pass, no shuffle."""
    spark = prepare(df.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # bounded by LEXICON and the number of trees

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        f = Featurizer(m.lexicon)
        for b in batches:
            s = score_texts(m, f, [t or "" for t in b.column(len(extra)).to_pylist()])
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(extra))), pa.array(s, pa.float64())], names=[*extra, "score"])

    return df.select(*extra, text).mapInArrow(run, f"{schema}, score double")


def learnable(key: str = "doc_id"):
    """Rows that labels may be learned from: fold 0 of 5 is held out, and so are null ids."""
    return F.coalesce(fold(key, 5) != 0, F.lit(False))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"))
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = fit(docs.where(learnable()), labels.where(learnable()), "doc_id", "text", "toxic")
    scored = score_all(docs, model, "text", ["doc_id", "held_out"], "doc_id long, held_out boolean")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
