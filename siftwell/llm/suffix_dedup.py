"""Suffix-array dedup: every byte covered by a ``LENGTH``-byte string that also starts earlier is removed.

The suffix array is built as far as it is needed: bucket-pointer refinement
sorts suffixes into q-gram buckets and refines a bucket by the bucket
identifiers of later offsets, reusing refined buckets for the next, doubled
step, until ``LENGTH`` bytes are told apart. Three passes spread that over a cluster:

1. Anchors. Each string start is led by the least q-gram hash within the string
   (its minimizer), and neighbouring starts share one. A q-gram is the initial
   bucket; what enters it is one row for a run of starts, with a hash of all
   the bytes that the run's strings cover. Runs with the same bytes repeat an
   earlier run whole. A bucket with different bytes is left open.
2. Refinement. Only starts in open buckets are looked at again: within a task
   their suffixes are refined by bucket pointers (``refine``), and one start
   of each final bucket, named by a 128-bit hash of its string, goes on.
3. Removal. The repeating starts of each document are joined to its text.

What is told by a hash: runs of one bucket count as equal by the 64-bit hash of
their bytes within the 64-bit bucket, and starts in crowded buckets (more than
``LOCAL_GROUP`` contents in a task's send, ``HOT_GROUP`` over all) by a 128-bit
hash of their string. That is most of the decisions: of the repeating starts of
a corpus with many whole copies about nine in ten. Refining all of them from
their bytes would move each repeated text some four times over.

Only the earliest of equal rows leaves a task (``_earliest``; those of other
texts with its key and start, as without a key, go with it), so a passage that
any share of all documents holds reaches a reducer at most once a task; an open
bucket is told by one row a task. Nothing is dropped, and no texts but those of
a partition's batch are held.

Order is by key, then start. Edge cases: a null text counts as empty; texts
shorter than ``LENGTH`` lose nothing; rows with one key and one text are one
document; rows with one key and different texts are compared by start alone,
and told apart by 64 bits of hash and length (``row_name``); a null key comes
last. Very long texts are read in pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from siftwell.llm.common import cut, prepare, read_table, utf8

LENGTH = 100
#: The q of the initial buckets.
GRAM = 24
#: Bytes that are hashed at once, and rows that a task gathers before it sends.
BLOCK, FLUSH = 1 << 20, 4_000_000
#: Parts of the second exchange for each one of the session's: refinement holds some tens of bytes for each byte.
SPREAD = 4
_POS = 24  # bits of a position within a block
_LAST = (1 << 63) - 1  # the place of a null key
_BASE = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F)


class Rolling:
    """Prefix polynomial hashes modulo 2^64 of one block of bytes."""

    def __init__(self) -> None:
        self.n = 0

    def _grow(self, n: int) -> None:
        self.n = max(n, 2 * self.n, BLOCK + 4096)
        self.up, self.down = [], []
        for base in _BASE:
            for out, x in ((self.up, base), (self.down, pow(base, -1, 1 << 64))):
                a = np.full(self.n, x, np.uint64)
                a[0] = 1
                out.append(np.cumprod(a, dtype=np.uint64))

    def sums(self, data: np.ndarray, which: int = 0) -> np.ndarray:
        if len(data) + 1 > self.n:
            self._grow(len(data) + 1)
        s = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[which][: len(data)], out=s[1:])
        return s

    def spans(self, s: np.ndarray, starts, stops, which: int = 0) -> np.ndarray:
        return mix((s[stops] - s[starts]) * self.down[which][: len(s)][starts])


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(x) - width + 1
    rows = -(-len(x) // width)
    full = np.full(rows * width, np.iinfo(x.dtype).max, x.dtype)
    full[: len(x)] = x
    grid = full.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, bounds: np.ndarray, rolling: Rolling, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(bucket, content, first start, starts) of every run of starts in a block of texts.

    ``bounds`` are the texts' begins and the block's end; every text has
    ``length`` bytes or more. ``bucket`` is the hash of the q-gram that leads
    the run, ``content`` that of all bytes its strings cover and of where the
    q-gram lies in them.
    """
    s = rolling.sums(data)
    n = len(data)
    h = rolling.spans(s, slice(0, n - gram + 1), slice(gram, n + 1))
    low = np.uint64((1 << _POS) - 1)
    keys = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    least = sliding_min(keys, length - gram + 1)
    valid = np.ones(len(least), bool)
    for e in bounds[1:-1].tolist():
        valid[e - length + 1 : e] = False
    at = np.flatnonzero(valid)
    lead = least[at]
    edge = np.flatnonzero(lead[1:] != lead[:-1]) + 1
    lo, hi = at[np.append(0, edge)], at[np.append(edge - 1, len(at) - 1)]
    anchor = (lead[np.append(0, edge)] & low).astype(np.int64)
    shape = ((anchor - lo).astype(np.uint64) << np.uint64(32)) | (hi - lo).astype(np.uint64)
    content = mix(rolling.spans(s, lo, hi + length) ^ (shape * np.uint64(0x9E3779B97F4A7C15)))
    return h[anchor], content, lo, hi - lo + 1


# -- bucket-pointer refinement ----------------------------------------------------------------------------------------


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each key, whether its bucket is a singleton)."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1])
    bucket = np.cumsum(new) - 1
    out = np.empty(len(keys), np.int64)
    out[order] = bucket
    return out, (np.bincount(bucket) == 1)[out]


def refine(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Bucket of the ``length``-byte string at each start: equal buckets iff equal bytes.

    Initial buckets are 8-grams. A step sorts each suffix of a bucket by the
    bucket identifiers of its own and of the offset where its q-gram ends, and
    so doubles q; the refined identifiers are what the next step points to.
    Singleton buckets are told apart for good and not sorted again. The last
    step points to the overlapping q-gram that ends at ``length``.
    """
    n, q = len(data) - 7, min(8, length)
    if length < 8:
        raise ValueError("strings of under 8 bytes are not told apart")
    grams = np.lib.stride_tricks.sliding_window_view(data, 8)
    rank, single = _ranks(np.ascontiguousarray(grams).view("<u8").ravel())
    while q < length:
        step = min(q, length - q)
        last = q + step >= length
        at = starts[~single[starts]] if last else np.flatnonzero(~single[: max(0, n - step)])
        fine, alone = _ranks(rank[at] << np.int64(32) | rank[at + step])
        out = np.arange(len(rank), dtype=np.int64) + len(rank)  # singletons, and ends that no string reaches
        out[at] = fine
        lone = np.ones(len(rank), bool)
        lone[at] = alone
        # Identifiers must stay below 2^32: at most two for each byte of a block.
        rank, single, q, n = out, lone, q + step, n - step
    return rank[starts]


# -- what travels between tasks ---------------------------------------------------------------------------------------

REPEAT, OPEN, HOT = 0, 1, 2
#: Different contents of one bucket in a task, and over all tasks, above which its starts are named one by one.
LOCAL_GROUP, HOT_GROUP = 64, 4096
_ROWS, _MARKS, _FLAGS, _CONTEXTS, _NAMES = range(5)


def flag(off: np.ndarray, n: np.ndarray, kind: int | np.ndarray, bucket: np.ndarray | int = 0) -> np.ndarray:
    """A run of starts as one number: first start, 16 bits of its bucket, how many starts, kind."""
    return np.asarray(off, np.int64) << 26 | (np.asarray(bucket, np.int64) & 0xFFFF) << 10 | np.asarray(n, np.int64) << 2 | np.asarray(kind, np.int64)


def unflag(r: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first start, bucket bits, starts, kind)."""
    return r >> 26, r >> 10 & 0xFFFF, r >> 2 & 0xFF, r & 3


def _blob(kind: int, columns: list[np.ndarray], tail: bytes = b"") -> bytes:
    """Columns, each by byte planes, compressed."""
    import zstandard

    head = [np.array([kind, len(columns), *(v for c in columns for v in (len(c), c.dtype.itemsize))], "<i8").tobytes()]
    body = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.dtype.itemsize).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([*head, *body, tail]))


def _unblob(blob: bytes, dtypes: dict[int, list[str]]) -> tuple[int, list[np.ndarray], bytes]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    kind, k = np.frombuffer(raw, "<i8", 2).tolist()
    sizes = np.frombuffer(raw, "<i8", 2 * k, 16).tolist()
    at, out = 16 + 16 * k, []
    for i, t in enumerate(dtypes[kind]):
        n, w = sizes[2 * i : 2 * i + 2]
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * w, at).reshape(w, n).T).view(t).ravel())
        at += n * w
    return kind, out, raw[at:]


_TYPES = {
    _ROWS: ["<u8", "<u8", "<i8", "<i8", "<i8", "u1"],  # bucket, content, key, row, start, starts
    _MARKS: ["<u8"],  # buckets
    _FLAGS: ["<i8", "<i8", "<i8"],  # key, row, flag
    _CONTEXTS: ["<i8", "<i8", "<i8", "u1"],  # key, row, start, starts; the bytes follow
    _NAMES: ["<u8", "<u8", "<i8", "<i8", "<i8"],  # name, name, key, row, start
}


def _deal(kind: int, part: np.ndarray, parts: int, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """Columns split by ``part``, one blob for each that has rows."""
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        mine = order[cuts[p] : cuts[p + 1]]
        yield p, _blob(kind, [c[mine] for c in columns])


def _earliest(groups: list[np.ndarray], key: np.ndarray, off: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, first of its group, like the first, later than the first), in the order of groups, key, start.

    Other texts' rows that share key and start with the first are like it: what
    is said of the first holds for them, so they go wherever it goes. Further
    rows of one text, start and group are none of these.
    """
    order = np.lexsort([row, off, key, *reversed(groups)])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for g in groups:
        s = g[order]
        new[1:] |= s[1:] != s[:-1]
    at = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    k, o, r = key[order], off[order], row[order]
    later = ~new & ((k != k[at]) | (o != o[at]))
    like = new.copy()
    like[1:] |= ~later[1:] & ~new[1:] & (r[1:] != r[:-1])
    return order, new, like, later


def _part(x: np.ndarray, parts: int) -> np.ndarray:
    return (mix(x.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _row_part(key: np.ndarray, row: np.ndarray, parts: int) -> np.ndarray:
    """The part of a text's flags: rows without a key share one, so the row's name counts too."""
    return _part(key.astype(np.uint64) ^ mix(row.astype(np.uint64)), parts)


def _blob_batch(pairs: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in pairs], pa.int32()), pa.array([b for _, b in pairs], pa.binary())], names=["part", "blob"])


def _flag_batches(key: np.ndarray, row: np.ndarray, r: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(key), 200_000):
        z = slice(i, i + 200_000)
        yield pa.RecordBatch.from_arrays([pa.array(key[z], pa.int64()), pa.array(row[z], pa.int64()), pa.array(r[z], pa.int64())], names=["key", "row", "r"])


# -- the passes -------------------------------------------------------------------------------------------------------


def _send_anchors(length: int, gram: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        held: list[list[np.ndarray]] = []
        texts: list[tuple[int, int, int, bytes]] = []
        size = rows = 0

        def hash_block() -> None:
            nonlocal size, rows
            if not texts:
                return
            data = np.frombuffer(b"".join(t[3] for t in texts), np.uint8)
            bounds = np.cumsum([0] + [len(t[3]) for t in texts])
            bucket, content, lo, n = anchors(data, bounds, rolling, length, gram)
            d = np.searchsorted(bounds, lo, "right") - 1
            key, row, base = (np.array([t[i] for t in texts], np.int64)[d] for i in range(3))
            held.append([bucket, content, key, row, lo - bounds[d] + base, n.astype(np.uint8)])
            texts.clear()
            size, rows = 0, rows + len(lo)

        def send() -> Iterator[pa.RecordBatch]:
            nonlocal rows
            if not held:
                return
            bucket, content, key, row, off, n = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            rows = 0
            order, new, like, later = _earliest([bucket, content], key, off, row)
            bucket, content, key, row, off, n = (c[order] for c in (bucket, content, key, row, off, n))
            first = np.append(True, bucket[1:] != bucket[:-1])
            group = np.cumsum(first) - 1
            crowd = np.bincount(group, new)[group] > LOCAL_GROUP
            hot = like & crowd
            out = list(_deal(_FLAGS, _row_part(key[later | hot], row[later | hot], parts), parts, [key[later | hot], row[later | hot], flag(off, n, np.where(hot, HOT, REPEAT), bucket)[later | hot]]))
            marks = bucket[first & crowd]
            out += _deal(_MARKS, _part(marks, parts), parts, [marks])
            go = np.flatnonzero(like & ~crowd)
            go = go[np.lexsort((off[go], key[go]))]  # neighbours compress
            out += _deal(_ROWS, _part(bucket[go], parts), parts, [c[go] for c in (bucket, content, key, row, off, n)])
            for i in range(0, len(out), 64):
                yield _blob_batch(out[i : i + 64])

        for b in batches:
            for key, row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2)), strict=True):
                if len(text) < length:
                    continue
                for at in range(0, len(text) - length + 1, 2 * BLOCK):
                    piece = text[at : at + 2 * BLOCK + length - 1] if len(text) > 2 * BLOCK else text
                    texts.append((key, row, at, piece))
                    size += len(piece)
                    if size >= BLOCK:
                        hash_block()
            if rows >= FLUSH:
                yield from send()
        hash_block()
        yield from send()

    return run


def _judge_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which runs repeat an earlier one, and which lie in open buckets."""
    got: dict[int, list[list[np.ndarray]]] = {_ROWS: [], _MARKS: [], _FLAGS: []}
    for b in batches:
        for blob in b.column(1).to_pylist():
            kind, columns, _ = _unblob(blob, _TYPES)
            got[kind].append(columns)
    for columns in got[_FLAGS]:
        yield from _flag_batches(*columns)
    if not got[_ROWS]:
        return
    bucket, content, key, row, off, n = (np.concatenate(c) for c in zip(*got.pop(_ROWS), strict=True))
    order, new, like, later = _earliest([bucket, content], key, off, row)
    bucket, key, row, off, n = (c[order] for c in (bucket, key, row, off, n))
    group = np.cumsum(np.append(True, bucket[1:] != bucket[:-1])) - 1
    count = np.bincount(group, new)[group]
    crowd = count > HOT_GROUP
    if got[_MARKS]:
        crowd |= np.isin(bucket, np.concatenate([c[0] for c in got[_MARKS]]))
    told = later | (like & (crowd | (count > 1)))
    kind = np.where(later, REPEAT, np.where(crowd, HOT, OPEN))
    yield from _flag_batches(key[told], row[told], flag(off, n, kind, bucket)[told])


def _send_open(length: int, parts: int, text_at: int):
    """Contexts of the starts in open buckets, by bucket; in crowded ones, each start by the hash of its string.

    Rows have key and row first, the text at ``text_at`` and the flags last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        names: list[list[np.ndarray]] = []
        contexts: dict[int, list[tuple[int, int, int, int, bytes]]] = {}
        size = 0

        def send() -> Iterator[pa.RecordBatch]:
            nonlocal size
            out = []
            for p, rows in contexts.items():
                key, row, off, n, data = zip(*rows, strict=True)
                out.append((p, _blob(_CONTEXTS, [np.array(key, "<i8"), np.array(row, "<i8"), np.array(off, "<i8"), np.array(n, "u1")], b"".join(data))))
            if names:
                a, c, key, row, off = (np.concatenate(x) for x in zip(*names, strict=True))
                order, _, like, later = _earliest([a, c], key, off, row)
                a, c, key, row, off = (x[order] for x in (a, c, key, row, off))
                out += _deal(_FLAGS, _row_part(key[later], row[later], parts), parts, [key[later], row[later], flag(off[later], np.ones(later.sum(), np.int64), REPEAT)])
                out += _deal(_NAMES, _part(a[like], parts), parts, [x[like] for x in (a, c, key, row, off)])
            contexts.clear()
            names.clear()
            size = 0
            for i in range(0, len(out), 64):
                yield _blob_batch(out[i : i + 64])

        for b in batches:
            for key, row, text, told in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(text_at)), b.column(b.num_columns - 1), strict=True):
                off, bucket, n, kind = unflag(told.values.to_numpy())
                plain = kind == OPEN
                for o, k, m in zip(off[plain].tolist(), bucket[plain].tolist(), n[plain].tolist(), strict=True):
                    contexts.setdefault(k % parts, []).append((key, row, o, m, text[o : o + m + length - 1]))
                    size += m + length
                for o, m in zip(off[~plain].tolist(), n[~plain].tolist(), strict=True):
                    data = np.frombuffer(text[o : o + m + length - 1], np.uint8)
                    a, c = (rolling.spans(rolling.sums(data, w), slice(0, m), slice(length, length + m), w) for w in (0, 1))
                    names.append([a, c, np.full(m, key, np.int64), np.full(m, row, np.int64), np.arange(o, o + m)])
                    size += 32 * m
            if size > 128 << 20:
                yield from send()
        yield from send()

    return run


def _judge_open(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, tails, names = [], [], []
        for b in batches:
            for blob in b.column(1).to_pylist():
                kind, columns, tail = _unblob(blob, _TYPES)
                if kind == _FLAGS:
                    yield from _flag_batches(*columns)
                elif kind == _NAMES:
                    names.append(columns)
                else:
                    contexts.append(columns)
                    tails.append(tail)
        if contexts:
            key, row, off, n = (np.concatenate(c) for c in zip(*contexts, strict=True))
            n = n.astype(np.int64)
            data = np.frombuffer(b"".join(tails), np.uint8)
            tails.clear()
            begin = np.cumsum(n + length - 1) - (n + length - 1)
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            starts = np.repeat(begin, n) + inner
            bucket = refine(data, starts, length)
            of = np.repeat(np.arange(len(n)), n)
            order, _, _, later = _earliest([bucket], key[of], off[of] + inner, row[of])
            repeat = np.zeros(len(of), bool)
            repeat[order[later]] = True
            # Neighbouring repeats of one context are one flag.
            hit = np.flatnonzero(repeat)
            if len(hit):
                edge = np.flatnonzero((hit[1:] != hit[:-1] + 1) | (of[hit[1:]] != of[hit[:-1]])) + 1
                lo, hi = hit[np.append(0, edge)], hit[np.append(edge - 1, len(hit) - 1)]
                yield from _flag_batches(key[of[lo]], row[of[lo]], flag(off[of[lo]] + inner[lo], hi - lo + 1, REPEAT))
        if names:
            a, c, key, row, off = (np.concatenate(x) for x in zip(*names, strict=True))
            order, _, _, later = _earliest([a, c], key, off, row)
            at = order[later]
            yield from _flag_batches(key[at], row[at], flag(off[at], np.ones(len(at), np.int64), REPEAT))

    return run


def spans_of(flags: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the maximal byte runs that the repeating strings cover."""
    off, _, n, _ = unflag(np.sort(flags))
    ends = np.maximum.accumulate(off + n + length - 1)
    new = np.append(True, off[1:] > ends[:-1])
    return off[new], ends[np.append(np.flatnonzero(new)[1:] - 1, len(off) - 1)]


def repeated_starts(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, row, r): for each document with any, the flags of the starts whose string starts earlier elsewhere.

    ``docs`` has columns key, row and text; ``row`` tells texts with one key
    apart. Its further columns only ride along, so that a later join of the
    result with ``docs`` finds the same exchange of the texts and reuses it.
    """
    spark = prepare(docs.sparkSession)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    told = "key long, row long, r long"
    dealt = docs.select("key", "row", "text").mapInArrow(_send_anchors(length, gram, parts), "part int, blob binary").repartitionById(parts, "part")
    first = cut(dealt.mapInArrow(_judge_buckets, told).groupBy("key", "row").agg(F.collect_list("r").alias("r")))
    still = first.select("key", "row", F.filter("r", lambda x: x.bitwiseAND(F.lit(3)) > 0).alias("r")).where("size(r) > 0")
    looked = docs.join(still.hint("shuffle_hash"), ["key", "row"])
    again = looked.mapInArrow(_send_open(length, SPREAD * parts, docs.columns.index("text")), "part int, blob binary").repartitionById(SPREAD * parts, "part")
    second = again.mapInArrow(_judge_open(length), told).groupBy("key", "row").agg(F.collect_list("r").alias("r"))
    done = first.select("key", "row", F.filter("r", lambda x: x.bitwiseAND(F.lit(3)) == 0).alias("r")).unionByName(second)
    return done.groupBy("key", "row").agg(F.flatten(F.collect_list("r")).alias("r")).where("size(r) > 0")


def row_name(text: Column) -> Column:
    """What tells the texts of one key apart: 64 bits of a text's hash and length."""
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(text, F.octet_length(text))


def remove_repeats(df: DataFrame, key: str, text: str, keep: list[str], finish, schema: str, length: int = LENGTH) -> DataFrame:
    """``finish(text bytes, starts, ends)`` of every row, after its ``keep`` columns.

    ``starts`` and ``ends`` are the maximal runs to remove; ``finish`` gives the
    values of ``schema``'s further columns.
    """
    ride = [F.col(c).alias(f"keep{i}") for i, c in enumerate(keep)]  # other names, as the kept columns may be called as those here
    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("key"), row_name(F.col(text)).alias("row"), *ride, F.col(text).alias("text"))
    flags = repeated_starts(rows, length)
    n = len(keep) + 2  # key and row come first
    none = np.zeros(0, np.int64)
    joined = rows.join(flags.hint("shuffle_hash"), ["key", "row"], "left")
    out = df.select(*keep).schema
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out] + [schema])
    made_schema = to_arrow_schema(StructType.fromDDL(schema))
    names, types = [*keep, *made_schema.names], list(made_schema.types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for t, r in zip(utf8(b.column(n)), b.column(n + 1), strict=True):
                made.append(finish(t, *(spans_of(r.values.to_numpy(), length) if r.is_valid else (none, none))))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(2, n)), *(pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True))], names=names)

    return joined.mapInArrow(run, ddl)


def kept_bytes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return b"".join(text[a:z] for a, z in zip([0, *ends.tolist()], [*starts.tolist(), len(text)], strict=True)) if len(starts) else text


def kept_text(text: bytes, starts: np.ndarray, ends: np.ndarray) -> str:
    """The text without the runs, which give up a character that they would cut."""
    starts, ends = starts.copy(), ends.copy()
    for i in range(len(starts)):
        while starts[i] < ends[i] and text[starts[i]] & 0xC0 == 0x80:
            starts[i] += 1
        while ends[i] > starts[i] and ends[i] < len(text) and text[ends[i]] & 0xC0 == 0x80:
            ends[i] -= 1
    return kept_bytes(text, starts, ends).decode()


def _digest(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple:
    return len(text), int((ends - starts).sum()), len(starts), hashlib.sha256(kept_bytes(text, starts, ends)).hexdigest()


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = read_table(spark, sf_dir, "documents")
    return remove_repeats(docs, "doc_id", "text", ["doc_id"], _digest, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")
