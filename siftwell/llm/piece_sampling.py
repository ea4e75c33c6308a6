"""SentencePiece sampling: forward filtering, backward sampling over the piece lattice.

A text becomes code points with blanks as U+2581 and falls into units (a run of
blanks with the word behind it), which no piece crosses. Every piece of the
model that matches within a unit is an edge of its lattice, weighted by a
Zipf law over the model's piece order to the power ``ALPHA``; each character
also has an edge of its UTF-8 bytes. The forward filter sums the weights of all
segmentations up to each position, once for each different unit of a block, with
an exponent beside it in units of over ``LONG`` code points; the backward sampler then draws, for each occurrence, the last piece in proportion
to weight times what the filter holds before it, and goes on from there. Draws
are a hash of seed, row key, place of the unit and step: a row's segmentation
depends on nothing else.

Decoding is lossless: pieces joined, U+2581 read as a blank, byte pieces as
bytes; a U+2581 of the text itself goes by its bytes.

A unit may be as long as its text (no blank in it); it is one lattice all the
same. Texts of over ``BLOCK`` code points are taken in parts of whole units.

Edge cases: a null or empty text has no pieces; repeated rows have the same
ones; a null key counts as 0.
"""

from __future__ import annotations

import hashlib
import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.common import prepare, read_table

MODEL = "piece_bpe_32k.model"
ALPHA = 0.5
SEED = 7
#: Code points up to which the filter's sums can't underflow, and of a block that is filtered at once.
LONG, BLOCK = 64, 1 << 20
_BLANK, _LITERAL = 0x2581, 0x110001
_M = np.uint64(0x9E3779B97F4A7C15)
_SAMPLERS: dict[tuple, Sampler] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _uniform(key: np.ndarray, step: np.ndarray) -> np.ndarray:
    """The draw of each step of an occurrence, from 0 to 1."""
    with np.errstate(over="ignore"):
        return (_mix(key + step * np.uint64(0xD1B54A32D192ED03)) >> np.uint64(11)).astype(np.float64) * 2.0**-53


class Lookup:
    """Piece ids by 64-bit hash: two direct tables, then a sorted rest."""

    BITS = 18

    def __init__(self, keys: np.ndarray, ids: np.ndarray) -> None:
        self.tables = []
        for shift in (64 - self.BITS, 64 - 2 * self.BITS):
            slot = (keys >> np.uint64(shift)) & np.uint64((1 << self.BITS) - 1)
            _, first = np.unique(slot, return_index=True)
            held, value = np.zeros(1 << self.BITS, np.uint64), np.full(1 << self.BITS, -1, np.int32)
            held[slot[first]], value[slot[first]] = keys[first], ids[first]
            self.tables.append((np.uint64(shift), held, value))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, ids = keys[rest], ids[rest]
        self.rest = dict(zip(keys.tolist(), ids.tolist(), strict=True))

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int32)
        for shift, held, value in self.tables:
            slot = (keys >> shift) & np.uint64((1 << self.BITS) - 1)
            out = np.where((out < 0) & (held[slot] == keys), value[slot], out)
        for k, i in self.rest.items():
            out[keys == np.uint64(k)] = i
        return out


class Sampler:
    def __init__(self, model: str = MODEL, alpha: float = ALPHA, seed: int = SEED) -> None:
        path = model if os.path.isabs(model) else public_tokenizers.path(model)
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.byte = np.zeros(256, np.int64)
        self.raw: list[bytes] = [b""] * n
        hashes, ids, self.longest, rank = [], [], 1, 0
        self.ends = np.zeros((3, n), np.uint64)  # size, first and last code point of each piece
        weight = np.zeros(n + 1)
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte[value], self.raw[i] = i, bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if "▁" in piece.lstrip("▁"):
                    raise ValueError("a piece crosses units")
                self.raw[i] = piece.replace("▁", " ").encode()
                codes = np.array([[ord(c) for c in piece]], np.uint64)
                h = np.zeros(1, np.uint64)
                for c in codes[0]:
                    h = h * _M + c + np.uint64(1)
                self.ends[:, i] = codes.shape[1], codes[0, 0], codes[0, -1]
                hashes.append(int(_mix(h)[0]))
                ids.append(i)
                weight[i] = rank
                rank += 1
                self.longest = max(self.longest, codes.shape[1])
        self.n = n
        total = np.log(rank + 2.0)
        # Zipf: the piece of rank r has about 1 / ((r + 2) log n) of all.
        self.weight = np.where(np.arange(n + 1) < n, (1 / ((weight + 2) * total)) ** alpha, 0.0)
        self.byte_weight = (0.1 / ((rank + 2) * total)) ** alpha
        self.lookup = Lookup(np.array(hashes, np.uint64), np.array(ids, np.int32))
        self.seed = np.uint64(seed * int(_M) % (1 << 64))

    def block(self, texts: list[str], keys: list[int], ordinals: list[int]) -> tuple[list[np.ndarray], list[int]]:
        """(piece ids of each text, place of the unit behind it); ``texts`` together are one block, ``ordinals`` the places of their first units."""
        raw = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(t) for t in texts])
        if not len(raw):
            return [np.zeros(0, np.uint32) for _ in texts], list(ordinals)
        codes = np.where(raw == 32, np.uint32(_BLANK), np.where(raw == _BLANK, np.uint32(_LITERAL), raw)).astype(np.uint64)
        n = len(codes)
        blank = raw == 32
        begin = np.zeros(n, bool)
        begin[0] = True
        begin[1:] = blank[1:] & ~blank[:-1]
        doc_at = np.cumsum(sizes) - sizes
        begin[doc_at[sizes > 0]] = True
        starts = np.flatnonzero(begin)
        lens = np.diff(np.append(starts, n))
        of_doc = np.repeat(np.arange(len(texts)), sizes)[starts]
        first_unit = np.searchsorted(of_doc, np.arange(len(texts)))
        ordinal = np.arange(len(starts)) - first_unit[of_doc] + np.array(ordinals)[of_doc]

        # Different units, longest first: their code points are laid out one after another.
        powers = np.cumprod(np.full(int(lens.max()), _M, np.uint64), dtype=np.uint64)
        inside = np.arange(n) - np.repeat(starts, lens)
        name = np.add.reduceat((codes + np.uint64(1)) * powers[inside], starts) ^ _mix(lens.astype(np.uint64))
        _, one, which = np.unique(name, return_index=True, return_inverse=True)
        like = one[which]  # the occurrence that stands for each one; another unit under its name would be told here
        if (lens != lens[like]).any() or (codes != codes[np.repeat(starts[like], lens) + inside]).any():
            words = [codes[x : x + z].tobytes() for x, z in zip(starts.tolist(), lens.tolist(), strict=True)]
            _, one, which = np.unique(np.array(words, object), return_index=True, return_inverse=True)
        by = np.argsort(-lens[one], kind="stable")
        place = np.empty(len(by), np.int64)
        place[by] = np.arange(len(by))
        which = place[which]
        u_start, u_len = starts[one[by]], lens[one[by]]
        base = np.cumsum(u_len + 1) - (u_len + 1)  # one node more than characters
        node_unit = np.repeat(np.arange(len(u_len)), u_len)
        flat = np.arange(len(node_unit)) - np.repeat(np.cumsum(u_len) - u_len, u_len)
        c = codes[u_start[node_unit] + flat]
        end = base[node_unit] + flat + 1  # the node behind each character

        nodes = int(base[-1] + u_len[-1] + 1)
        edge = np.full((self.longest, nodes), -1, np.int32)
        h = np.zeros(len(c), np.uint64)
        for k in range(self.longest):
            live = flat >= k
            if not live.any():
                break
            back = np.zeros(len(c), np.uint64)
            if k:
                back[1:] = h[:-1]
            h = np.where(live, back * _M + c + np.uint64(1), np.uint64(0)) if k else c + np.uint64(1)
            at = np.flatnonzero(live)
            got = self.lookup.find(_mix(h[at]))
            hit = np.flatnonzero(got >= 0)
            size, head, tail = self.ends[:, got[hit]]
            got[hit[(size != k + 1) | (head != c[at[hit] - k]) | (tail != c[at[hit]])]] = -1
            edge[k, end[at]] = got
        # Forward filter, all units of at least i characters at once; long ones follow one by one.
        total = np.zeros(nodes)
        total[base] = 1.0
        n_long = int(np.searchsorted(-u_len, -LONG, "left"))
        for i in range(1, int(u_len[n_long] if n_long < len(u_len) else 0) + 1):
            at = base[n_long : np.searchsorted(-u_len, -i, "right")] + i
            s = self.byte_weight * total[at - 1]
            for k in range(min(i, self.longest)):
                s += self.weight[edge[k, at]] * total[at - 1 - k]
            total[at] = s

        # Backward sampling, all occurrences at once.
        key = _mix(np.array([k or 0 for k in keys], np.int64).view(np.uint64) + self.seed)[of_doc]
        key = _mix(key + ordinal.astype(np.uint64) * _M)
        occ = np.flatnonzero(which >= n_long)
        pos = lens.copy()
        at_base = base[which]
        taken: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        step = 0
        while len(occ):
            at = at_base[occ] + pos[occ]
            u = _uniform(key[occ], np.uint64(step + 1)) * total[at]
            size, piece = np.ones(len(occ), np.int64), np.full(len(occ), -2, np.int64)
            u -= self.byte_weight * total[at - 1]
            todo = np.flatnonzero(u >= 0)
            for k in range(self.longest):
                if not len(todo):
                    break
                can = todo[pos[occ[todo]] > k]
                e = edge[k, at[can]]
                w = self.weight[e] * total[at[can] - 1 - k]
                hit = e >= 0
                size[can[hit]], piece[can[hit]] = k + 1, e[hit]  # stays if rounding leaves the draw above the sum
                u[can] -= w
                todo = can[u[can] >= 0]
            taken.append((occ, piece, size))
            pos[occ] -= size
            occ = occ[pos[occ] > 0]
            step += 1

        long, filters = {}, {}
        for o in np.flatnonzero(which < n_long).tolist():
            unit = int(which[o])
            if unit not in filters:
                filters[unit] = self._filter(edge[:, base[unit] : base[unit] + u_len[unit] + 1])
            long[o] = self._draw(*filters[unit], int(key[o]))

        # Pieces were drawn from the back: place them in order.
        count = np.zeros(len(starts), np.int64)
        for o, _, _ in taken:
            count[o] += 1
        for o, (p, _) in long.items():
            count[o] = len(p)
        first = np.cumsum(count) - count
        pieces, where = np.empty(int(count.sum()), np.int64), np.empty(int(count.sum()), np.int64)
        left = lens.copy()
        for j, (o, p, z) in enumerate(taken):
            slot = first[o] + count[o] - 1 - j
            left[o] -= z
            pieces[slot] = p
            where[slot] = starts[o] + left[o]
        for o, (p, z) in long.items():
            slot = slice(first[o], first[o] + len(p))
            pieces[slot], where[slot] = p, starts[o] + np.cumsum(z) - z
        as_bytes = np.flatnonzero(pieces == -2)
        width = np.ones(len(pieces), np.int64)
        cp = raw[where[as_bytes]]
        width[as_bytes] = 1 + (cp >= 0x80) + (cp >= 0x800) + (cp >= 0x10000)
        out = np.repeat(pieces, width).astype(np.uint32)
        spot = (np.cumsum(width) - width)[as_bytes]
        for s, ch in zip(spot.tolist(), cp.tolist(), strict=True):
            b = chr(ch).encode()
            out[s : s + len(b)] = self.byte[list(b)]
        ends = np.append(0, np.cumsum(width))[np.append(first, len(pieces))[np.append(first_unit, len(starts))]]
        units = np.bincount(of_doc, minlength=len(texts))
        return [out[a:z] for a, z in zip(ends, ends[1:], strict=False)], [o + int(u) for o, u in zip(ordinals, units, strict=True)]

    def _filter(self, edge: np.ndarray) -> tuple[list, list, list]:
        """Of one unit, from its edges into each node: (edges as (size, piece, weight) by node, sums, their binary exponents)."""
        node, size = np.nonzero(edge.T >= 0)
        piece = edge[size, node]
        rows: list[list[tuple]] = [[(1, -2, self.byte_weight)] for _ in range(edge.shape[1])]
        for i, k, p, w in zip(node.tolist(), (size + 1).tolist(), piece.tolist(), self.weight[piece].tolist(), strict=True):
            rows[i].append((k, p, w))
        total, power, now = [1.0], [0], 0
        for i in range(1, len(rows)):
            s = 0.0
            for k, _, w in rows[i]:
                s += w * (total[i - k] if power[i - k] == now else math.ldexp(total[i - k], power[i - k] - now))
            if s < 1e-150:
                s, more = math.frexp(s)
                now += more
            total.append(s)
            power.append(now)
        return rows, total, power

    def _draw(self, rows: list, total: list, power: list, key: int) -> tuple[np.ndarray, np.ndarray]:
        """(pieces, sizes) of one segmentation, front to back; -2 stands for a character's bytes."""
        pieces, sizes = [], []
        at, step, draws = len(total) - 1, 0, []
        while at:
            if step % 1024 == 0:
                draws = _uniform(np.uint64(key), np.arange(step + 1, step + 1025, dtype=np.uint64)).tolist()
            u = draws[step % 1024] * total[at]
            for k, p, w in rows[at]:
                u -= w * math.ldexp(total[at - k], power[at - k] - power[at])
                taken = (k, p)
                if u < 0:
                    break
            sizes.append(taken[0])
            pieces.append(taken[1])
            at -= taken[0]
            step += 1
        return np.array(pieces[::-1]), np.array(sizes[::-1])

    def encode(self, texts: list[str], keys: list[int]) -> Iterator[np.ndarray]:
        """Piece ids of each text, in order; blocks follow the texts' sizes."""
        held: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            if held and size + len(t) > BLOCK:
                yield from self._block_of([texts[j] for j in held], [keys[j] for j in held])
                held, size = [], 0
            if len(t) > BLOCK:
                yield self._in_parts(t, keys[i])
                continue
            held.append(i)
            size += len(t)
        if held:
            yield from self._block_of([texts[j] for j in held], [keys[j] for j in held])

    def _block_of(self, texts: list[str], keys: list[int]) -> list[np.ndarray]:
        return self.block(texts, keys, [0] * len(texts))[0]

    def _in_parts(self, text: str, key: int) -> np.ndarray:
        """Piece ids of a text of over a block, which falls into parts where units begin."""
        at, ordinal, out = 0, 0, []
        while at < len(text):
            stop = min(len(text), at + BLOCK)
            if stop < len(text):
                to = text.rfind(" ", at + 1, stop)
                while to > at and text[to - 1] == " ":
                    to -= 1
                if to <= at:  # one unit, or blanks, up to there: go on to its end
                    to = stop
                    while to < len(text) and not (text[to] == " " and text[to - 1] != " "):
                        to += 1
                stop = to
            (ids,), (ordinal,) = self.block([text[at:stop]], [key], [ordinal])
            out.append(ids)
            at = stop
        return np.concatenate(out)

    def decode(self, ids: np.ndarray) -> bytes:
        raw = self.raw
        return b"".join([raw[i] for i in ids.tolist()])


def sampler(model: str = MODEL, alpha: float = ALPHA, seed: int = SEED) -> Sampler:
    """The process's sampler, built once for each worker."""
    k = (model, alpha, seed)
    if k not in _SAMPLERS:
        _SAMPLERS[k] = Sampler(*k)
    return _SAMPLERS[k]


def sample_pieces(df: DataFrame, key: str, text: str, model: str = MODEL, alpha: float = ALPHA, seed: int = SEED, with_ids: bool = True) -> DataFrame:
    """(key, n_pieces, ids_crc32, decoded_sha256, lossless[, ids]) of every row; one pass, no shuffle."""
    prepare(df.sparkSession)
    names = [key, "n_pieces", "ids_crc32", "decoded_sha256", "lossless"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()] + [pa.list_(pa.int32())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = sampler(model, alpha, seed)
        for b in batches:
            keys, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            rows = []
            for k, t, ids in zip(keys, texts, s.encode(texts, keys), strict=True):
                back = s.decode(ids)
                rows.append((k, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), hashlib.sha256(back).hexdigest(), back == t.encode()) + ((ids.astype(np.int32),) if with_ids else ()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    schema = f"`{key}` long, n_pieces long, ids_crc32 long, decoded_sha256 string, lossless boolean" + (", ids array<int>" if with_ids else "")
    return df.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, schema)


def op9_piece_sampling(spark, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, n_pieces, ids_crc32 (little-endian unsigned 32-bit), decoded_sha256, lossless."""
    return sample_pieces(read_table(spark, sf_dir, "documents"), "doc_id", "text", with_ids=False)
