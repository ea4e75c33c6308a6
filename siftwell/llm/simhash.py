"""SimHash near-duplicates, linked through pigeonhole blocks.

A fingerprint takes bit i as 1 if over half of the text's shingle hashes have
it. Two fingerprints within ``distance`` bits of each other, cut into
``distance + shared`` blocks, agree on at least ``shared`` of them whole; so
each fingerprint is dealt under every choice of ``shared`` blocks, and only
fingerprints that meet under one choice are compared (the exact Hamming check).

Equal fingerprints are one row (fingerprint, smallest id) before anything is
dealt, so exact copies cost nothing further. Linked rows are numbered in the
order of that id: the least number of a component is the row that names it. A bucket of up to ``BUCKET`` rows is
compared in one task, in blocks, and gives a spanning forest of its links, not
all pairs. Larger buckets (many distinct fingerprints in one dense group) take
an exact way that never holds a group: two fingerprints are within 4 bits iff
some value is within 2 bits of both; each row is dealt under its variants with
up to half the distance flipped, and linked to the smallest row of each
variant. Components come from alternating star contractions; no links,
components or fingerprints are collected to the driver.

Edge cases: a text with fewer words than a shingle is one shingle, one with no
word (or null) has fingerprint zero, which is linked like any other; repeated
rows fall into one component; a null id joins a component but never names it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.functions.folds import ranked
from siftwell.llm.common import cut, prepare, read_table, utf8

WORDS = 4
DISTANCE = 4
SEED = 42
#: Distinct fingerprints that are compared within one task.
BUCKET = 4096


def shingle_hashes(text: bytes, words: int = WORDS) -> list[int]:
    """XXH64 of the word shingles of a text, repeats included; a shorter text is one shingle."""
    parts = text.lower().split()  # ASCII case and ASCII white space only, as these are bytes
    if not parts:
        return []
    joined = b" ".join(parts)
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends, at = [], -1
    for p in parts:
        at += len(p) + 1
        ends.append(at)
    digest, starts = xxhash.xxh64_intdigest, [0, *(e + 1 for e in ends)]
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :], strict=False)]


def majority(hashes: list[int]) -> int:
    """The 64-bit number whose bits are set in over half of ``hashes`` (none: zero)."""
    return majority_of(np.array(hashes, np.uint64)) if hashes else 0


def majority_of(hashes: np.ndarray) -> int:
    n, ones = len(hashes), np.zeros(64, np.int64)
    a = hashes.astype("<u8", copy=False)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(a[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, fp): the signed 64-bit fingerprint of every whole text."""
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([majority(shingle_hashes(t, words)) for t in utf8(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=[key, "fp"])

    return df.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, f"`{key}` long, fp long")


def block_masks(distance: int = DISTANCE, shared: int = 2) -> list[int]:
    """Signed 64-bit masks: the union of every choice of ``shared`` of the blocks."""
    n = distance + shared
    bounds = [round(64 * i / n) for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(bounds, bounds[1:], strict=False)]
    return [int(np.uint64(sum(c)).astype(np.int64)) for c in combinations(blocks, shared)]


def forest(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links (i, j) that connect what links within ``distance`` connect, at most one less than rows."""
    out = []
    left = np.arange(len(values))
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            i = todo.pop()
            near = np.bitwise_count(values[left] ^ values[i]) <= distance
            if near.any():
                hits = left[near].tolist()
                out += [(i, j) for j in hits]
                todo += hits
                left = left[~near]
    return out


def shared_blocks(rows: int, distance: int = DISTANCE, least: int = 2, mean: int = 64) -> int:
    """The fewest shared blocks at which evenly spread fingerprints give buckets of under ``mean`` rows."""
    shared = least
    while shared < 5 and rows / 2 ** (64 * shared // (distance + shared)) > mean:
        shared += 1
    return shared


def links(prints: DataFrame, distance: int = DISTANCE, shared: int | None = None, bucket: int = BUCKET) -> DataFrame:
    """(a, b): pairs of distinct fingerprints within ``distance`` that connect every component.

    ``prints`` has one row for each distinct ``fp``. ``shared`` changes only how
    the rows are dealt, never the components; unset, it follows their number.
    """
    if distance % 2:
        raise ValueError("the distance must be even")
    shared = shared or shared_blocks(prints.count(), distance)
    masks = block_masks(distance, shared)
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "block"))
    sizes = keyed.groupBy("choice", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = cut(keyed.join(sizes, ["choice", "block"]))

    small = met.where(F.col("n") <= bucket)
    # Many buckets a call: rows of a hash slot are sorted by bucket, and each run of one bucket is compared.

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        last = None

        def close(parts: list[np.ndarray]) -> tuple[list[int], list[int]]:
            v = np.sort(np.concatenate(parts).view(np.uint64))
            if len(v) == 2:
                pairs = [(0, 1)] if int(v[0] ^ v[1]).bit_count() <= distance else []
            else:
                pairs = forest(v, distance)
            s = v.view(np.int64)
            return [int(s[i]) for i, _ in pairs], [int(s[j]) for _, j in pairs]

        for b in batches:
            fp, choice, block = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            edge = np.flatnonzero((choice[1:] != choice[:-1]) | (block[1:] != block[:-1])) + 1
            starts, stops = [0, *edge.tolist()], [*edge.tolist(), len(fp)]
            out_a: list[int] = []
            out_b: list[int] = []
            for x, y in zip(starts, stops, strict=True):
                at = (choice[x], block[x])
                if at != last and held:
                    pa_, pb_ = close(held)
                    out_a += pa_
                    out_b += pb_
                    held = []
                held.append(fp[x:y])
                last = at
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])
        if held:
            out_a, out_b = close(held)
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    near = (
        small.select("fp", "choice", "block")
        .repartition(F.col("choice"), F.col("block"))
        .sortWithinPartitions("choice", "block")
        .mapInArrow(run, "a long, b long")
    )
    half = distance // 2
    flips = [0] + [sum(1 << i for i in c) for k in range(1, half + 1) for c in combinations(range(64), k)]
    signed = np.array(flips, np.uint64).view(np.int64).tolist()
    dense = met.where(F.col("n") > bucket).select("fp").distinct()
    variants = dense.select("fp", F.explode(F.transform(F.lit(signed), lambda m: F.col("fp").bitwiseXOR(m))).alias("value"))
    least = variants.groupBy("value").agg(F.min("fp").alias("a"), F.max("fp").alias("top")).where("a < top").select("value", "a")
    spokes = variants.join(least, "value").where("a <> fp").select("a", F.col("fp").alias("b"))
    return local_forests(near.unionByName(spokes))


#: Links of a task that are contracted at once, and links that a task of a contraction round gets.
LOCAL_LINKS, ROUND_LINKS, LEAST_PARTS = 1_000_000, 100_000, 8


def stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least node, node) for every other node of each component of the links (a, b)."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low, new = np.minimum(label[x], label[y]), label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        while True:
            further = new[new]
            if (further == new).all():
                break
            new = further
        if (new == label).all():
            break
        label = new
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[child]], nodes[child]


def local_forests(edges: DataFrame) -> DataFrame:
    """(a, b): links that connect what ``edges`` connect, each task's made stars of its own; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = kept = 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)))
            size += batch.num_rows
            if size >= LOCAL_LINKS + kept:
                held = [stars(*(np.concatenate(c) for c in zip(*held, strict=True)))]
                size = kept = len(held[0][0])
                if kept > LOCAL_LINKS:
                    yield from sent(*held[0])
                    held, size, kept = [], 0, 0
        if held:
            yield from sent(*stars(*(np.concatenate(c) for c in zip(*held, strict=True))))

    def sent(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(a), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(a[i : i + 100_000], pa.int64()), pa.array(b[i : i + 100_000], pa.int64())], names=["a", "b"])

    return edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with a link, by alternating large-star and small-star steps (Kiveris et al., 2014).

    ``edges`` has columns a and b; the root is the least node. Each task first
    contracts its own links to stars. Each step is a shuffle by node with a
    partial minimum, in as few tasks as the links left need; it ends when every
    node has one link down and none up, which is counted. The minima are tables
    of their own, so that a node with a large share of all links is joined to its
    minimum by a broadcast or in parts, as the adaptive planner finds it.
    """
    most = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = lambda df: df.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    e = cut(ordered(local_forests(edges)))
    while True:
        parts = max(LEAST_PARTS, -(-e.count() // ROUND_LINKS))
        few = lambda df: df.coalesce(parts) if parts < most else df  # noqa: B023, E731
        e = cut(few(few(e).distinct()))
        ends = e.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
        of_node = few(ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")))
        if not of_node.agg(F.count_if((F.col("down") > 1) | ((F.col("down") == 1) & (F.col("up") == 1)))).head()[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(few(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))))
        large = cut(few(few(both.join(least, "u")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()))
        down = cut(few(large.groupBy("u").agg(F.min("v").alias("m"))))
        small = few(large.join(down, "u")).select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b")
        small = small.unionByName(down.select(F.col("u").alias("a"), F.col("m").alias("b")))
        e = cut(ordered(local_forests(small)))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def named_components(nodes: DataFrame, links_: DataFrame) -> DataFrame:
    """``nodes`` (columns node and least among them) with ``component_id``, the smallest ``least`` that links reach (null last).

    Linked nodes are numbered in the order of ``least``, so the root of a
    component names it and no group of a component's nodes is ever formed.
    """
    links_ = cut(local_forests(links_))
    ends = links_.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    order = cut(ranked(nodes.select("node", "least").join(ends, "node", "left_semi"), F.asc_nulls_last("least"), "node", rank="place"))
    place = lambda c: order.select(F.col("node").alias(c), F.col("place").alias(f"at_{c}"))
    found = components(links_.join(place("a"), "a").join(place("b"), "b").select(F.col("at_a").alias("a"), F.col("at_b").alias("b")))
    member = cut(order.select("node", "place").join(found.withColumnRenamed("node", "place"), "place").select("node", "root"))
    names = order.select(F.col("place").alias("root"), F.col("least").alias("component_id"))
    return nodes.join(member.join(names, "root").select("node", "component_id"), "node", "left").withColumn("component_id", F.coalesce("component_id", "least"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """(key, fp, component_id) for every row; the component is named by the smallest key that links reach."""
    prints = cut(fingerprints(df, key, text, words))
    distinct = prints.groupBy("fp").agg(F.min(key).alias("least"))
    # A table of its own, so that rows of one fingerprint, however many, are joined to it by a broadcast or in parts.
    label = cut(named_components(distinct.select(F.col("fp").alias("node"), "least"), links(distinct.select("fp"), distance)))
    return prints.join(label.select(F.col("node").alias("fp"), "component_id"), "fp").select(key, "fp", "component_id")


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, its fingerprint in hex, and the smallest doc_id that links reach."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# -- by similarity ----------------------------------------------------------------------------------------------------
#
# For a similarity the fingerprint is wider (``WIDE`` words of 64 bits). A pair
# at 0.8 differs in about 39 of 256 bits, so that blocks of which one must agree
# would have 6 bits and hold everything: blocks are sets of bits drawn by rule
# instead, as many as a pair at the threshold needs to share one with
# probability ``RECALL``. What the Hamming check lets through is held against
# sketches of the shingles: all of them for texts of up to ``SKETCH`` different
# ones, of longer texts those whose hash is below a power of two. Such a sample
# decides only what is clear of the threshold by ``CLEAR`` standard errors; the
# rest is held against all shingles of both texts.

WIDE = 4
#: Words of it that travel with a row for the check within a bucket.
CARRIED = 2
SKETCH = 1024
#: Standard errors of a sample's estimate within which the whole shingle sets decide.
CLEAR = 4
SIMILARITY = 0.8
SIMILAR_WORDS = 5
RECALL = 0.985
#: In a bucket, a row with fewer close ones gives all its close pairs; the others a spanning forest of the links that hold.
SMALL = 8
#: Rows of a bucket up to which neighbours are compared by shifts, and not row by row.
RUN = 64
#: Rows that a bucket of evenly spread fingerprints has, about, in logarithms: many, so that the blocks stay few; and bits of a block.
MEAN_BITS, LEAST_BITS, MOST_BITS, FULL_BITS = 3, 12, 17, 11
#: Pairs that samples leave open are tried by rounds, the likeliest of each row first, so many times more in each.
MORE = 16
#: Hot buckets that are named in the plan, at most; more are joined by a shuffle.
NAMED = 10_000
#: Nodes whose sketches, and texts whose whole shingle sets are needed, that are named in the plan, at most.
NAMED_NODES, NAMED_TEXTS = 250_000, 100_000


def _expand(hashes: np.ndarray, word: int) -> np.ndarray:
    x = hashes + np.uint64((word * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def wide_print(hashes: list[int]) -> tuple[list[int], bytes]:
    """(``WIDE`` signed words, sketch) of a text's shingle hashes."""
    a = np.array(hashes, np.uint64)
    words = [majority_of(_expand(a, w)) if w else majority_of(a) for w in range(WIDE)] if hashes else [0] * WIDE
    return [int(np.uint64(w).astype(np.int64)) for w in words], sketch_of(a)


def sketch_of(hashes: np.ndarray) -> bytes:
    """A rate r, then the 32-bit hashes below 2^(32 - r) in ascending order, at most ``SKETCH``; all of them at rate 0."""
    own, rate = np.unique((hashes >> np.uint64(32)).astype(np.uint32)), 0
    while len(own) > SKETCH:
        rate += 1
        own = at_rate(own, rate)
    return np.append(np.uint32(rate), own).astype("<u4").tobytes()


def at_rate(own: np.ndarray, rate: int) -> np.ndarray:
    return own[: np.searchsorted(own, np.uint64(1 << (32 - rate)))]


def read_sketch(sketch: bytes) -> tuple[int, np.ndarray]:
    x = np.frombuffer(sketch, "<u4")
    return int(x[0]), x[1:]


def overlap(x: np.ndarray, y: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; two empty ones are alike."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    union = len(x) + len(y) - both
    return both / union if union else 1.0


def set_hash(hashes: list[int]) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(np.unique(np.array(hashes, np.uint64)).tobytes(), SEED)).astype(np.int64))


def judged(a: bytes, b: bytes, similarity: float) -> bool | None:
    """Whether two shingle sets are so similar; None where their samples don't tell."""
    (p, x), (q, y) = read_sketch(a), read_sketch(b)
    rate = max(p, q)
    x, y = at_rate(x, rate), at_rate(y, rate)
    found = overlap(x, y)
    if rate and abs(found - similarity) < sampling_margin(similarity, max(len(x), len(y))):
        return None
    return found >= similarity


def sampling_margin(similarity: float, sample) -> float:
    """How far a sample of a union (of so many shingles, or more) may be off."""
    return CLEAR * np.sqrt(similarity * (1 - similarity) / np.maximum(1, sample))


def differing_share(similarity: float) -> float:
    """Share of differing bits to expect at a Jaccard similarity of equal-sized sets."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def bit_blocks(rows: int, similarity: float, recall: float = RECALL) -> list[list[int]]:
    """Signed masks of every block: drawn sets of bits, as many as the recall needs.

    Longer blocks for more rows keep buckets small, but every bit asks for more
    blocks, which are what is shuffled. Buckets are compared in memory, by bits
    alone, so they may hold 2^``FULL_BITS`` rows before blocks grow beyond
    ``MOST_BITS``: from 2^20 to 2^28 rows their number is the same.
    """
    log = int(rows).bit_length() - 1
    bits = max(LEAST_BITS, min(MOST_BITS, log - MEAN_BITS), log - FULL_BITS)
    share = (1 - differing_share(similarity)) ** bits
    count = int(np.ceil(np.log(1 - recall) / np.log(1 - share)))
    rng = np.random.default_rng(64 * WIDE)
    out = []
    for _ in range(count):
        mask = np.zeros(64 * WIDE, np.uint8)
        mask[rng.permutation(64 * WIDE)[:bits]] = 1
        out.append(np.packbits(mask, bitorder="little").view("<i8").tolist())
    return out


def most_bits(similarity: float) -> int:
    """Differing bits of the carried words that a pair at the threshold passes in all but a few of a thousand cases."""
    p, n = differing_share(similarity), 64 * CARRIED
    return int(n * p + 2.75 * np.sqrt(n * p * (1 - p)))


def _pairs(slot: np.ndarray, bits: np.ndarray, most: int, label: np.ndarray | None = None, home: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Close pairs (two index arrays) within the runs of equal slots, of rows with fewer than ``SMALL`` close ones; the other rows with close ones, and these.

    Given labels and who is at home, only pairs with two labels count of which one, and only one, is at home.
    """
    told = label is not None
    edge = np.flatnonzero(slot[1:] != slot[:-1]) + 1
    starts, stops = np.append(0, edge), np.append(edge, len(slot))
    size = np.repeat(stops - starts, stops - starts)
    left, right, met = [], [], []
    short = size <= RUN
    for d in range(1, RUN):
        at = np.flatnonzero(short[:-d] & (slot[d:] == slot[:-d])) if d < len(slot) else np.zeros(0, np.int64)
        if not len(at):
            break
        if told:
            at = at[(label[at] != label[at + d]) & (home[at] != home[at + d])]
        near = at[np.bitwise_count(bits[at] ^ bits[at + d]).sum(1) <= most]
        left.append(near)
        right.append(near + d)
    none = [np.zeros(0, np.int64)]
    i, j = np.concatenate(left or none), np.concatenate(right or none)
    crowded = np.bincount(np.append(i, j), minlength=len(slot)) >= SMALL
    rare = ~crowded[i] & ~crowded[j]
    met += [i[~rare], j[~rare]]
    left, right = [i[rare]], [j[rare]]
    for a, z in zip(starts[stops - starts > RUN].tolist(), stops[stops - starts > RUN].tolist(), strict=True):

        def close(rows: np.ndarray) -> np.ndarray:
            near = sum(np.bitwise_count(bits[rows, None, w] ^ bits[None, a:z, w]).astype(np.int16) for w in range(bits.shape[1])) <= most  # noqa: B023
            if told:
                return near & (label[rows, None] != label[None, a:z]) & (home[rows, None] != home[None, a:z])  # noqa: B023
            near[np.arange(len(rows)), rows - a] = False  # noqa: B023
            return near

        chunks = lambda rows: (rows[k : k + 256] for k in range(0, len(rows), 256))
        everyone = np.arange(a, z)
        degree = np.concatenate([close(c).sum(1) for c in chunks(everyone)])
        beside = degree >= SMALL
        for c in chunks(everyone[degree >= SMALL]):
            beside |= close(c).any(0)
        met.append(everyone[beside])
        for c in chunks(everyone[(degree > 0) & (degree < SMALL)]):
            x, y = np.nonzero(close(c) & (degree < SMALL)[None, :])
            x, y = c[x], a + y
            left.append(x[x < y])
            right.append(y[x < y])
    return np.concatenate(left), np.concatenate(right), np.unique(np.concatenate(met))


def shared_entries(sets: list[np.ndarray], rows: int = 256, often: float = 0.02) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, counts) of every block of rows: how many entries each of its sets shares with each of all.

    Entries of many sets are counted by a product of 0/1 matrices, the others
    (at most ``often`` of the sets) pair by pair; one that a single set has
    can't be shared.
    """
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    _, entry, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    many = held > max(16, often * n)
    column = np.cumsum(many) - 1
    dense = np.zeros((n, int(many.sum())), np.float32)
    at = many[entry]
    dense[owner[at], column[entry[at]]] = 1
    at = np.flatnonzero(~at & (held[entry] > 1))
    at = at[np.argsort(entry[at], kind="stable")]  # neighbours share an entry, owners ascend
    few, mine = entry[at], owner[at]
    begin = np.flatnonzero(np.append(True, few[1:] != few[:-1])) if len(few) else np.zeros(0, np.int64)
    count = np.diff(np.append(begin, len(few)))
    first, width = np.repeat(begin, count), np.repeat(count, count)
    by_row = np.argsort(mine, kind="stable")
    bounds = np.searchsorted(mine[by_row], np.arange(0, n + rows, rows))
    for k, i in enumerate(range(0, n, rows)):
        z = min(i + rows, n)
        out = dense[i:z] @ dense.T
        own = by_row[bounds[k] : bounds[k + 1]]
        if len(own):
            reach = width[own]
            other = mine[np.repeat(first[own] - (np.cumsum(reach) - reach), reach) + np.arange(reach.sum())]
            out += np.bincount(np.repeat(mine[own] - i, reach) * n + other, minlength=(z - i) * n).reshape(z - i, n)
        yield i, out


def compared(bits: np.ndarray, sketches: list[bytes], most: int, similarity: float, label: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, other rows, similarity as their sketches have it, how far it may be off) over every two rows of one bucket that are close and have different labels.

    Labels are read as they are when a row's turn comes.
    """
    read = [read_sketch(x) for x in sketches]
    rates = np.array([r for r, _ in read])
    for rate in np.unique(rates).tolist():
        rows = np.flatnonzero(rates <= rate)
        sets = [at_rate(read[i][1], rate) for i in rows.tolist()]
        size = np.array([len(x) for x in sets])
        for first, shared in shared_entries(sets):
            for row, both in enumerate(shared, first):
                i = rows[row]
                apart = label[rows] != label[i]
                if rates[i] < rate:
                    apart &= rates[rows] == rate
                after = np.flatnonzero(apart)
                after = after[np.bitwise_count(bits[rows[after]] ^ bits[i]).sum(1) <= most]
                if len(after):
                    union = size[after] + size[row] - both[after]
                    alike = np.where(union > 0, both[after] / np.maximum(1, union), 1.0)
                    yield i, rows[after], alike, sampling_margin(similarity, union) if rate else np.zeros(len(after))


def verified_forest(bits: np.ndarray, sketches: list[bytes], most: int, similarity: float, label: np.ndarray | None = None, tries: int = 1) -> tuple[list[tuple[int, int]], list[tuple[int, int]], bool]:
    """(links, open pairs, whether there are more of these) of one bucket.

    The links are upheld by their sketches and connect what such links connect.
    Open pairs are not told by samples and join rows that no links join: the
    ``tries`` likeliest of each row. Rows with one ``label`` are joined already.
    """
    label = np.arange(len(sketches)) if label is None else np.unique(label, return_inverse=True)[1]
    out: list[tuple[int, int]] = []
    doubtful = False
    for i, others, alike, margin in compared(bits, sketches, most, similarity, label):
        sure = alike >= similarity + margin
        doubtful |= bool((np.abs(alike - similarity) < margin).any())
        hits = others[sure]
        if len(hits):
            joined, one = np.unique(label[hits], return_index=True)
            out += [(int(i), int(j)) for j in hits[one]]
            label[np.isin(label, joined)] = label[i]
    unclear: set[tuple[int, int]] = set()
    more = False
    if doubtful:
        for i, others, alike, margin in compared(bits, sketches, most, similarity, label):
            at = np.flatnonzero(np.abs(alike - similarity) < margin)
            if len(at) > tries:
                more = True
                at = at[np.argsort(-alike[at], kind="stable")[:tries]]
            unclear |= {(min(int(i), j), max(int(i), j)) for j in others[at].tolist()}
    return out, sorted(unclear), more


def crowded_slots(slots: DataFrame, tasks: int, bucket: int) -> DataFrame:
    """(slot, n): every slot of more than ``bucket`` rows, and some of over half of that; n is at most half a bucket too low.

    A task tells only slots that it has often enough for such a total, so that
    nearly nothing is shuffled.
    """
    least = max(1, bucket // (2 * max(1, tasks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b.column(0).to_numpy() for b in batches]
        if parts:
            own, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(own[n >= least]), pa.array(n[n >= least])], names=["slot", "n"])

    told = slots.mapInArrow(run, "slot long, n long")
    return told.groupBy("slot").agg(F.sum("n").alias("n")).where(F.col("n") > bucket // 2)


def keyed_nodes(nodes: DataFrame, masks: list[list[int]]) -> DataFrame:
    """(slot, node, carried words) of each node under every block."""
    f, carried = [f"f{i}" for i in range(WIDE)], [f"f{i}" for i in range(CARRIED)]
    slots = F.array(*[F.xxhash64(F.lit(c), *[F.col(x).bitwiseAND(F.lit(m)) for x, m in zip(f, block, strict=True)]) for c, block in enumerate(masks)])
    return nodes.select("node", *carried, F.explode(slots).alias("slot"))


def met_in_slots(keyed: DataFrame, most: int, told: bool = False) -> DataFrame:
    """Close rows of each slot: (null, a, b) for a pair, (slot, a, null) for a row of many close ones, see ``_pairs``; ``told`` if label and home are there."""
    carried = [f"f{i}" for i in range(CARRIED)]
    extra = ["label", "home"] if told else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def emit(rows: np.ndarray) -> pa.RecordBatch | None:
            bits = np.ascontiguousarray(rows[:, 2 : 2 + CARRIED]).view(np.uint64)
            i, j, again = _pairs(rows[:, 0], bits, most, *((rows[:, 2 + CARRIED], rows[:, 3 + CARRIED] > 0) if told else ()))
            if not len(i) + len(again):
                return None
            a, b = rows[i, 1], rows[j, 1]
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            slot = pa.array([None] * len(pairs) + rows[again, 0].tolist(), pa.int64())
            b = pa.array(pairs[:, 1].tolist() + [None] * len(again), pa.int64())
            return pa.RecordBatch.from_arrays([slot, pa.array(np.append(pairs[:, 0], rows[again, 1])), b], names=["slot", "a", "b"])

        for b in batches:
            rows = np.stack([b.column(k).to_numpy() for k in range(b.num_columns)], 1)
            rows = np.concatenate([*held, rows]) if held else rows
            last = int(np.flatnonzero(rows[:, 0] != rows[-1, 0])[-1]) + 1 if (rows[:, 0] != rows[-1, 0]).any() else 0
            held = [np.ascontiguousarray(rows[last:])]  # the last run may go on
            if last and (out := emit(np.ascontiguousarray(rows[:last]))) is not None:
                yield out
        if held and (out := emit(held[0])) is not None:
            yield out

    return cut(keyed.select("slot", "node", *carried, *extra).repartition(F.col("slot")).sortWithinPartitions("slot").mapInArrow(run, "slot long, a long, b long"))


def _split(met: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, rows (slot, node)) of what met."""
    return met.where("slot is null").select("a", "b").distinct(), met.where("slot is not null").select("slot", F.col("a").alias("node"))


def similar_candidates(nodes: DataFrame, masks: list[list[int]], hot: DataFrame, n_hot: int, most: int, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(pairs, rows of crowds) among nodes (columns node, f0..) whose wide fingerprints are close.

    In a bucket, rows with fewer than ``SMALL`` close ones give their close pairs
    (a, b); the others and those close to them (slot, node) come back, for
    ``bucket_links``. A crowded slot (``hot``) is dealt anew in parts of about
    half a bucket, here each by itself: see ``crowded_candidates`` for the rest.
    """
    keyed = keyed_nodes(nodes, masks)
    if n_hot:
        keyed = _dealt(keyed, hot, n_hot, bucket, "left").withColumn("slot", F.when(F.col("parts") > 1, F.xxhash64("slot", "part")).otherwise(F.col("slot")))
    return _split(met_in_slots(keyed, most))


def _dealt(keyed: DataFrame, hot: DataFrame, n_hot: int, bucket: int, how: str) -> DataFrame:
    """Rows with the number of parts of their slot, and their own part."""
    keyed = keyed.join(F.broadcast(hot) if n_hot <= NAMED else hot, "slot", how)
    parts = F.coalesce(F.ceil(F.col("n") * 2 / bucket).cast("long"), F.lit(1).cast("long"))
    return keyed.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node", "slot"), F.col("parts")))


def crowded_candidates(nodes: DataFrame, masks: list[list[int]], hot: DataFrame, n_hot: int, most: int, joined: DataFrame, bucket: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """``similar_candidates`` between the parts of crowded slots, of rows that no link joins yet (``joined``: node, root).

    A slot's loose rows are those outside its largest component, which a
    template's variants mostly are in. They visit the other parts, in groups of
    about half a bucket; a part's rows are at home, once for each group. Two rows
    with different labels meet where one is at home and the other visits, so that
    no pair is left out, and what is copied follows the rows that the links so
    far leave loose: none for a slot that is one component.
    """
    rows = _dealt(keyed_nodes(nodes, masks), hot, n_hot, bucket, "inner").where("parts > 1")
    rows = cut(rows.join(joined, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root", "n"))
    counted = rows.groupBy("slot", "label").agg(F.count(F.lit(1)).alias("k")).groupBy("slot")
    crowds = counted.agg(F.max_by("label", F.struct("k", "label")).alias("giant"), F.ceil((F.sum("k") - F.max("k")) * 2 / bucket).cast("long").alias("groups")).where("groups > 0")
    rows = rows.join(F.broadcast(crowds) if n_hot <= NAMED else crowds, "slot")
    cell = lambda at, group, home: F.struct(at.alias("at"), group.alias("grp"), F.lit(home).cast("long").alias("home"))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    own = F.transform(upto(F.col("groups")), lambda g: cell(F.col("part"), g, 1))
    group = F.pmod(F.xxhash64("slot", "node"), F.col("groups"))
    away = F.transform(F.filter(upto(F.col("parts")), lambda p: p != F.col("part")), lambda p: cell(p, group, 0))
    rows = rows.withColumn("cell", F.explode(F.when(F.col("label") == F.col("giant"), own).otherwise(F.concat(own, away)))).withColumn("home", F.col("cell.home"))
    return _split(met_in_slots(rows.withColumn("slot", F.xxhash64("slot", "cell.at", "cell.grp")), most, told=True))


def bucket_links(sketched: DataFrame, similarity: float, tries: int) -> DataFrame:
    """(kind, a, b) of the large buckets, whose rows are (slot, node, carried words, sketch, label).

    Kind ``LINK``: links that hold and join labels; ``OPEN``: pairs that samples
    don't tell; ``REST``: a slot (a) that has more of these.
    """
    most = most_bits(similarity)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def emit() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            slot = rows.column(0)[0].as_py()
            bits = np.stack([rows.column(2 + k).to_numpy() for k in range(CARRIED)], 1).view(np.uint64)
            node = rows.column(1).to_numpy()
            sure, unclear, more = verified_forest(bits, rows.column(2 + CARRIED).to_pylist(), most, similarity, rows.column(3 + CARRIED).to_numpy(), tries)
            both = np.sort(node[np.array(sure + unclear, np.int64).reshape(-1, 2)], axis=1)
            kind = [LINK] * len(sure) + [OPEN] * len(unclear) + [REST] * more
            a, b = both[:, 0].tolist() + [slot] * more, both[:, 1].tolist() + [None] * more
            return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["kind", "a", "b"])

        for b in batches:
            slot = b.column(0).to_numpy()
            edge = [0, *(np.flatnonzero(slot[1:] != slot[:-1]) + 1).tolist(), len(slot)]
            for x, y in zip(edge, edge[1:], strict=False):
                if x < y:
                    if held and held[0].column(0)[0].as_py() != slot[x]:
                        yield emit()
                        held.clear()
                    held.append(b.slice(x, y - x))
        if held:
            yield emit()

    return cut(sketched.repartition(F.col("slot")).sortWithinPartitions("slot").mapInArrow(link, "kind int, a long, b long").distinct())


LINK, OPEN, REST = range(3)


def similar_by_all_shingles(texts: DataFrame, text: str, wanted: DataFrame, n_wanted: int, pairs: DataFrame, words: int, similarity: float) -> DataFrame:
    """(a, b): those of ``pairs`` whose whole shingle sets are so similar; ``wanted`` has the hash of a text (own) of every node in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole = [np.unique(np.array(shingle_hashes(t, words), np.uint64)).tobytes() for t in utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(whole, pa.binary())], names=["node", "whole"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)
            mask = pa.array([overlap(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= similarity for x, y in both], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(mask), b.column(1).filter(mask)], names=["a", "b"])

    named = texts.join(F.broadcast(wanted) if n_wanted <= NAMED_TEXTS else wanted, "own").select("node", text)
    sets = cut(named.mapInArrow(run, "node long, whole binary").groupBy("node").agg(F.first("whole").alias("whole")))
    side = lambda n: sets.select(F.col("node").alias(n), F.col("whole").alias(f"w{n}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "wa", "wb").mapInArrow(verify, "a long, b long")


def similar_documents(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = SIMILAR_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(key, component_id) for every row: components of texts whose word shingles are at least so similar.

    Texts with no word are alike. A null key joins a component but never names it.
    """
    prepare(df.sparkSession)
    f = [f"f{i}" for i in range(WIDE)]
    names = [key, "own", *f, "sketch", "whole"]
    own = F.xxhash64(text).alias("own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes = [shingle_hashes(t, words) for t in utf8(b.column(1))]
            made = [wide_print(h) for h in hashes]
            columns = [pa.array([m[0][i] for m in made], pa.int64()) for i in range(WIDE)]
            whole = [set_hash(h) if read_sketch(m[1])[0] else 0 for h, m in zip(hashes, made, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *columns, pa.array([m[1] for m in made], pa.binary()), pa.array(whole, pa.int64())], names=names)

    schema = f"`{key}` long, own long, " + ", ".join(f"{x} long" for x in f) + ", sketch binary, whole long"
    prints = df.select(F.col(key).cast("long").alias(key), text, own).mapInArrow(run, schema)
    prints = cut(prints.withColumn("print", F.sha2(F.concat_ws(":", F.hex("sketch"), *f, "whole").cast("binary"), 256)).drop("whole"))
    nodes = cut(prints.groupBy("print").agg(F.min(key).alias("least"), F.first("sketch").alias("sketch"), F.min("own").alias("own"), *[F.first(x).alias(x) for x in f]).withColumn("node", F.monotonically_increasing_id()))
    carried = [f"f{i}" for i in range(CARRIED)]
    masks, most, prints_only = bit_blocks(nodes.count(), similarity), most_bits(similarity), nodes.select("node", *f)
    hot = cut(crowded_slots(keyed_nodes(prints_only, masks).select("slot"), nodes.rdd.getNumPartitions(), BUCKET))
    n_hot = hot.count()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            told = [judged(x, y, similarity) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            mask = pa.array([x is not False for x in told], pa.bool_())
            kind = pa.array([LINK if x else OPEN for x in told], pa.int32())
            yield pa.RecordBatch.from_arrays([c.filter(mask) for c in (kind, b.column(0), b.column(1))], names=["kind", "a", "b"])

    def upheld(candidates: DataFrame, large: DataFrame, joined: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(judged pairs, rows of crowds with their sketches, what these link)."""
        # Only the sketches of nodes that have a candidate are moved.
        wanted = cut(candidates.select(F.explode(F.array("a", "b")).alias("node")).unionByName(large.select("node")).distinct())
        known = nodes.select("node", *carried, "sketch").join(F.broadcast(wanted) if wanted.count() <= NAMED_NODES else wanted, "node", "left_semi")
        sketched = large.join(known, "node")
        sketched = sketched.withColumn("label", F.col("node")) if joined is None else sketched.join(joined, "node", "left").withColumn("label", F.coalesce("root", "node"))
        side = lambda n: known.select(F.col("node").alias(n), F.col("sketch").alias(f"s{n}"))
        both = candidates.join(side("a"), "a").join(side("b"), "b")
        told = cut(both.select("a", "b", "sa", "sb").mapInArrow(verify, "kind int, a long, b long"))
        rows = sketched.select("slot", "node", *carried, "sketch", "label")
        return told, rows, bucket_links(rows, similarity, 1)

    told, sketched, found = upheld(*similar_candidates(prints_only, masks, hot, n_hot, most, BUCKET))
    if n_hot:
        joined = cut(components(told.unionByName(found).where(F.col("kind") == LINK).select("a", "b")))
        told2, sketched2, found2 = upheld(*crowded_candidates(prints_only, masks, hot, n_hot, most, joined, BUCKET), joined)
        told, sketched, found = told.unionByName(told2), sketched.unionByName(sketched2), found.unionByName(found2)
    tries = 1
    edges = told.unionByName(found).where(F.col("kind") == LINK).select("a", "b")
    unclear = cut(told.unionByName(found).where(F.col("kind") == OPEN).select("a", "b").distinct())
    texts = df.select(F.xxhash64(text).alias("own"), text)
    tested = unclear
    while True:
        if not unclear.isEmpty():
            of = cut(nodes.select("node", "own").join(unclear.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node"))
            edges = edges.unionByName(similar_by_all_shingles(texts, text, of, of.count(), unclear, words, similarity))
        rest = found.where(F.col("kind") == REST).select(F.col("a").alias("slot")).distinct()
        if rest.isEmpty():
            break
        # Rows that links join by now need no further try; of the others, more pairs are tried, at last all.
        edges, tries = cut(edges), tries * MORE
        again = sketched.drop("label").join(rest, "slot", "left_semi").join(components(edges), "node", "left")
        found = bucket_links(again.select("slot", "node", *carried, "sketch", F.coalesce("root", "node").alias("label")), similarity, tries)
        unclear = cut(found.where(F.col("kind") == OPEN).select("a", "b").join(tested, ["a", "b"], "left_anti"))
        tested = tested.unionByName(unclear)
    label = named_components(nodes.select("print", "node", "least"), edges)
    return prints.select(key, "print").join(label.select("print", "component_id"), "print").select(key, "component_id")
