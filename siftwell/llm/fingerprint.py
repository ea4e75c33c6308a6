"""Document fingerprints from prefix polynomial hashes.

For code points c_0, c_1, ... the prefix array S_i = sum of (c_j + 1) * B^j for
j < i, modulo a prime, answers any span's hash as (S_j - S_i) * B^(-i): equal
spans have equal hashes wherever they stand. Two primes below 2^31 give 62 bits.
``PrefixHash.extension`` finds the longest common extension of two places by
binary search over span hashes.

A fingerprint is the whole text's hash, its length and sketches of its spans of
1, 3 and 24 code points, as many as the text is long enough for (``SPANS``).
For a sketch, every span with its occurrence (first, second, ...) is placed on a
circle by its hash, and each of ``SLOTS`` evenly spaced marks takes the first one
at or after it. The share of equal slots estimates the Jaccard likeness J of two
texts' spans, repeats included; ``likeness`` gives 2J / (1 + J), the share of
text in common, from the widest spans that both texts have sketches of.

Edge cases: a null text counts as empty; two empty texts have likeness 1, an
empty and another one 0. Equal ids are ordered by the xxhash64 of their text; a
null id comes last. Lone rows are their own next document.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.common import prepare, read_table

PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)
#: (least length, span width)
SPANS = ((1, 1), (12, 3), (96, 24))
SLOTS = 64
_GROW = 1 << 14


def span_widths(n: int) -> list[int]:
    """The widths of the spans that a text of ``n`` code points has sketches of, in ascending order."""
    return [w for least, w in SPANS if n >= least]


class Powers:
    """B^i and B^-i modulo each prime, for i below a size that grows when needed."""

    def __init__(self) -> None:
        self.n = 0
        self.grow(_GROW)

    def grow(self, n: int) -> None:
        if n <= self.n:
            return
        self.n = max(n, 2 * self.n)
        self.up, self.down = [], []
        for p, b in zip(PRIMES, BASES, strict=True):
            for out, x in ((self.up, b), (self.down, pow(b, p - 2, p))):
                a = np.ones(self.n, np.uint64)
                have = 1
                while have < self.n:  # a[i + have] = a[i] * x^have
                    more = min(have, self.n - have)
                    a[have : have + more] = a[:more] * np.uint64(pow(x, have, p)) % np.uint64(p)
                    have += more
                out.append(a)


class PrefixHash:
    """The prefix arrays of one text, given as code points."""

    def __init__(self, codes: np.ndarray, powers: Powers, head: PrefixHash | None = None, keep: int = 0) -> None:
        """``head``: take its first ``keep`` prefix sums over; ``codes`` agree there."""
        n = len(codes)
        powers.grow(n + 1)
        self.n, self.codes, self.powers, self.sums = n, codes, powers, []
        tail = codes[keep:].astype(np.uint64) + np.uint64(1)
        for k, p in enumerate(PRIMES):
            s = np.empty(n + 1, np.uint64)
            s[0] = 0
            if keep:
                s[: keep + 1] = head.sums[k][: keep + 1]
            terms = tail * powers.up[k][keep:n] % np.uint64(p)
            s[keep + 1 :] = (np.cumsum(terms, dtype=np.uint64) + s[keep]) % np.uint64(p)
            self.sums.append(s)

    def spans(self, starts: np.ndarray | slice, stops: np.ndarray | slice) -> np.ndarray:
        """62-bit hashes of the spans [start, stop)."""
        parts = []
        for s, down, p in zip(self.sums, self.powers.down, PRIMES, strict=True):
            parts.append((s[stops] + (np.uint64(p) - s[starts])) % np.uint64(p) * down[: self.n + 1][starts] % np.uint64(p))
        return parts[0] << np.uint64(31) | parts[1]

    def span(self, start: int, stop: int) -> int:
        return int(self.spans(np.array([start]), np.array([stop]))[0])

    def windows(self, width: int, start: int = 0) -> np.ndarray:
        """Hashes of all spans of ``width`` from ``start`` on; up to three code points are told apart by themselves."""
        if width > 3:
            return self.spans(slice(start, self.n - width + 1), slice(start + width, self.n + 1))
        codes = self.codes[start:].astype(np.uint64) + np.uint64(1)
        out = codes[: len(codes) - width + 1]
        for i in range(1, width):
            out = out << np.uint64(21) | codes[i : len(codes) - width + 1 + i]
        return out

    def extension(self, i: int, other: PrefixHash, j: int) -> int:
        """Length of the longest common extension from ``i`` here and ``j`` there."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            if self.span(i, i + mid) == other.span(j, j + mid):
                low = mid
            else:
                high = mid - 1
        return low


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


#: Bits of the circle between two marks.
_ARC = np.uint64(64 - SLOTS.bit_length() + 1)
_BETWEEN = (np.uint64(1) << _ARC) - np.uint64(1)
_MARKS = np.arange(SLOTS, dtype=np.uint64) << _ARC


def sketch(hashes: np.ndarray) -> np.ndarray:
    """16 bits of the first span at or after each mark of the circle."""
    same = np.sort(hashes)
    first = np.append(True, same[1:] != same[:-1])
    if not first.all():  # the second span with a hash is another one than the first
        at = np.arange(len(same))
        same = same + (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    placed = _mix(same)
    # Of many spans only those soon after a mark can be its first one, unless none is there.
    soon = placed[placed & _BETWEEN < _BETWEEN // np.uint64(max(1, len(placed) // (32 * SLOTS)))]
    order = np.sort(soon)
    if len(soon) < len(placed) and len(np.unique(order >> _ARC)) < SLOTS:
        order = np.sort(placed)
    at = np.searchsorted(order, _MARKS)
    at[at == len(order)] = 0
    return (_mix(order[at]) >> np.uint64(48)).astype(">u2")


def fingerprint(ph: PrefixHash, windows: list[np.ndarray]) -> str:
    """``windows``: the span hashes of each of the text's widths."""
    whole = ph.span(0, ph.n) if ph.n else 0
    return ":".join([f"{whole:016x}", f"{ph.n:x}", *(sketch(w).tobytes().hex() for w in windows)])


def likeness(a: str, b: str) -> float:
    """0 to 1 from two fingerprints alone; 1 where they are equal."""
    if a == b:
        return 1.0
    x, y = (f.split(":")[2:] for f in (a, b))
    widest = min(len(x), len(y))
    if not widest:
        return 0.0
    x, y = (np.frombuffer(bytes.fromhex(f[widest - 1]), ">u2") for f in (x, y))
    j = float((x == y).mean())
    return 2 * j / (1 + j)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Fingerprinter:
    """Fingerprints texts and edited texts, sharing one table of powers."""

    def __init__(self) -> None:
        self.powers = Powers()

    def text(self, text: str) -> tuple[PrefixHash, list[np.ndarray], str]:
        ph = PrefixHash(codes_of(text), self.powers)
        windows = [ph.windows(w) for w in span_widths(ph.n)]
        return ph, windows, fingerprint(ph, windows)

    def edited(self, text: str, other: str, ph: PrefixHash, windows: list[np.ndarray]) -> tuple[str, str]:
        """(edited text, its fingerprint): the last third of ``text`` replaced by as much of ``other``'s start."""
        cut = ph.n // 3
        keep = ph.n - cut
        new = text[:keep] + other[:cut]
        eph = PrefixHash(codes_of(new), self.powers, ph, keep)
        made = []
        for own, width in zip(windows, span_widths(eph.n), strict=False):  # spans that end within the kept part are the text's own
            same = max(0, keep - width + 1)
            made.append(np.concatenate([own[:same], eph.windows(width, same)]))
        return new, fingerprint(eph, made)


def neighbours(df: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """(key, text, part, guest) dealt so that a partition holds a run of rows in order and, as ``guest``, the row that follows its last one.

    The order is descending by key, null last, then by a hash of the text. Bounds
    are quantiles of the key over all rows; only those (``parts`` of them) come
    to the driver. A key that fills several quantiles, and null, has parts of its
    own by that hash. Each text is shuffled once, and one row a part twice.
    """
    src = df.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text)).withColumn("h", F.xxhash64(text))
    ids = src.select(key)
    found = ids.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)] or [0.5], 10000).alias("cuts"), F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("none")).head()
    often = Counter(found["cuts"] or []) if parts > 1 else Counter()
    cuts = sorted(often, reverse=True)
    # Place p among the cuts is that of keys from cuts[p] up; a cut that recurs is a key with parts of its own behind it.
    own_parts = [often[c] if often[c] > 1 else 0 for c in cuts] + [-(-found["none"] * parts // found["n"]) if found["n"] else 0]
    # Place 0 has the largest keys. It is found in two steps of about the root of their number.
    place = F.lit(0)
    if cuts:
        step = math.isqrt(len(cuts)) + 1
        below = lambda bounds: F.size(F.filter(bounds, lambda c: F.col(key) < c))
        coarse = cuts[step - 1 :: step]
        first = (below(F.lit(coarse)) if coarse else F.lit(0)) * step
        place = F.when(F.col(key).isNull(), F.lit(len(cuts))).otherwise(first + below(F.slice(F.lit(cuts), first + 1, F.lit(step))))
    at = lambda values, kind, i: F.get(F.array(*[F.lit(v).cast(kind) for v in values]), i)
    share = (F.col("h") / 2.0**64 + 0.5) * at(own_parts, "int", F.col("place"))
    alone = F.col(key).eqNullSafe(at([*cuts, None], "long", F.col("place"))) & (at(own_parts, "int", F.col("place")) > 0)
    before_place = [p + sum(own_parts[:p]) for p in range(len(own_parts))]
    number = at(before_place, "int", F.col("place")) + F.when(alone, 1 + F.least(F.floor(share), at(own_parts, "int", F.col("place")) - 1)).otherwise(F.lit(0))
    placed = src.withColumn("place", place.cast("int")).withColumn("part", number.cast("int")).drop("place")
    total = before_place[-1] + own_parts[-1] + 1
    head = F.min(F.struct(F.col(key).isNull().alias("none"), F.bitwise_not(key).alias("down"), "h")).alias("head")
    heads = {r["part"]: r["head"] for r in placed.groupBy("part").agg(head).collect()}
    full = sorted(heads)
    # The first row of a part is also sent, as a guest, to the part before it; the first of all to the last part.
    before = {p: full[i - 1] for i, p in enumerate(full)}
    column = lambda name: [heads[p][name] if p in heads else None for p in range(total)]
    is_head = F.bitwise_not(key).eqNullSafe(at(column("down"), "long", F.col("part"))) & (F.col("h") == at(column("h"), "long", F.col("part")))
    ahead = at([before.get(p) for p in range(total)], "int", F.col("part"))
    copies = F.array_compact(F.array(F.struct("part", F.lit(False).alias("guest")), F.when(is_head, F.struct(ahead.alias("part"), F.lit(True).alias("guest")))))
    dealt = placed.withColumn("at", F.explode(copies)).select(key, text, "at.part", "at.guest", "h")
    return dealt.repartitionById(total, "part").sortWithinPartitions("part", "guest", F.desc_nulls_last(key), "h", text).drop("h")


def op1_schema(key: str) -> str:
    return f"{key} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_edited long, common_next long"


def fingerprint_pairs(df: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness, and to the next document's.

    ``common_edited`` and ``common_next`` are the lengths of the longest common
    extension from the start, by binary search over the prefix arrays.
    """
    spark = prepare(df.sparkSession)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = op1_schema(key)
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fp = Fingerprinter()
        rows: list[tuple] = []
        before = None  # the row that waits for its next one: (key, text, part, prefix hash, windows, fingerprint)

        def finish(row: tuple, text: str, ph: PrefixHash, print_: str) -> None:
            own_id, own, _, own_ph, windows, own_print = row
            new, new_print = fp.edited(own, text, own_ph, windows)
            new_ph_common = own_ph.n - own_ph.n // 3
            cut = own_ph.n // 3
            more = 0
            if cut:
                a, b = own[new_ph_common:], text[:cut]
                more = PrefixHash(codes_of(a), fp.powers).extension(0, PrefixHash(codes_of(b), fp.powers), 0) if a[:1] == b[:1] and a and b else 0
            rows.append((own_id, own_ph.n, hashlib.sha256(new.encode()).hexdigest(), own_print, new_print, likeness(own_print, new_print), likeness(own_print, print_), new_ph_common + more, own_ph.extension(0, ph, 0)))

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], names=names)
            rows.clear()
            return out

        for batch in batches:
            for own_id, own, part, guest in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if guest and before is None:
                    continue
                ph, windows, print_ = fp.text(own)
                if before is not None:
                    finish(before, own, ph, print_)
                before = None if guest else (own_id, own, part, ph, windows, print_)
            if rows:
                yield flush()
        if before is not None:
            raise AssertionError("a part has no guest row")

    return neighbours(df, key, text, parts).mapInArrow(run, schema)


TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    """One row per document: its fingerprint and its likeness to its edited text and to the next document."""
    return fingerprint_pairs(read_table(spark, sf_dir, "documents"))
