"""Best-fit packing of token pieces into sequences, by hierarchical residual packing.

Documents become token ids with an end id; one longer than the capacity is cut
into full pieces, of which the first may be shorter. Full pieces are sequences
of their own. The rest are dealt by a hash to groups of ``GROUP_ITEMS`` on
average and each group is packed best-fit decreasing. Its bins are emitted but for the
emptiest ``FAN + 1``; these go up a tree, ``FAN`` groups to a node, as items of
the next best-fit round, until one node is left.

Nothing is lost by carrying so few: best fit leaves at most one bin of a group
half empty or more, and two bins over half full never share a sequence, so a
node's merges use at most ``FAN`` half-empty bins and as many others, for which
the emptiest serve best. A task holds ``TASK_GROUPS`` groups (by count, not by
key), a tree round ``FAN + 1`` rows a group.

Edge cases: a null or empty text is the end id alone; repeated rows are packed
each on its own; an empty table gives no rows. A string of an added token in a
text is that token, as the vocabulary's own tokenizer has it.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm.common import cut, prepare, read_table

CAPACITY = 1024
END_ID = 2
#: The rank file of the vocabulary; byte_bpe_50k.json beside it gives the same ids and names the added tokens.
RANKS = "byte_bpe_50k.tiktoken"
#: Items of a group on average: a task packs some groups, and the tree starts from their number.
GROUP_ITEMS = 4096
#: Groups that a task packs, one after another.
TASK_GROUPS = 16
FAN = 8
_ENCODERS: dict[str, object] = {}


class Encoder:
    """Token ids of a text; strings of added tokens are those tokens."""

    def __init__(self, ranks: str) -> None:
        path = ranks if os.path.isabs(ranks) else public_tokenizers.path(ranks)
        with open(path, "rb") as f:
            table = {base64.b64decode(t): int(i) for t, i in map(bytes.split, f)}
        self.json = path.removesuffix(".tiktoken") + ".json"
        with open(self.json, encoding="utf-8") as f:
            self.added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self.fast = tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=self.added)
        self.slow = None

    def ids(self, text: str) -> np.ndarray:
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except (ValueError, RuntimeError):  # the pattern's engine gives up on some very long runs of white space
            from tokenizers import Tokenizer

            self.slow = self.slow or Tokenizer.from_file(self.json)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def encoder(ranks: str = RANKS) -> Encoder:
    """The process's encoder, built once for each worker."""
    if ranks not in _ENCODERS:
        _ENCODERS[ranks] = Encoder(ranks)
    return _ENCODERS[ranks]


def cut_points(n: int, capacity: int) -> list[int]:
    """Bounds of the pieces of ``n`` ids: full ones, of which the first may be shorter."""
    first = n - (-(-n // capacity) - 1) * capacity
    return [0, *range(first, n + 1, capacity)]


def tokenize_pieces(df: DataFrame, key: str, text: str, capacity: int = CAPACITY, end_id: int = END_ID, ranks: str = RANKS, with_ids: bool = True) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of every document's pieces; one pass, no shuffle."""
    prepare(df.sparkSession)
    names = [key, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(ranks)
        for b in batches:
            rows = []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = np.append(enc.ids(t), np.uint32(end_id)) if t else np.array([end_id], np.uint32)
                points = cut_points(len(ids), capacity)
                for i, (a, z) in enumerate(zip(points, points[1:], strict=False)):
                    part = ids[a:z].astype("<u4", copy=False)
                    rows.append((k, i, a, z - a, zlib.crc32(part.tobytes())) + ((part.astype(np.int32),) if with_ids else ()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    schema = f"`{key}` long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return df.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin of each, offset in it, fill of each bin): best fit over ``lengths`` in their order.

    Bins are found by what they have left, through a bit mask of the amounts that occur.
    """
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, fills = 0, []
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        fit = mask >> n
        if fit:
            left = (fit & -fit).bit_length() - 1 + n
            b = room[left].pop()
            if not room[left]:
                mask ^= 1 << left
            offset[i] = fills[b]
            fills[b] += n
        else:
            left, b = capacity, len(fills)
            fills.append(n)
            offset[i] = 0
        where[i] = b
        left -= n
        if left:
            room[left].append(b)
            mask |= 1 << left
    return where, offset, fills


def _carried(fills: np.ndarray, capacity: int, fan: int) -> np.ndarray:
    """Which bins go up the tree: the emptiest, but none that is full."""
    chosen = np.zeros(len(fills), bool)
    chosen[np.argsort(fills, kind="stable")[: fan + 1]] = True
    return chosen & (fills < capacity)


def pack(pieces: DataFrame, row: str, length: str = "length", capacity: int = CAPACITY, group_items: int = GROUP_ITEMS, fan: int = FAN) -> DataFrame:
    """(row, sequence_id, offset) for every piece of at most ``capacity``; ``row`` must be unique.

    ``pieces`` is read more than once: give a table or a checkpoint.
    """
    prepare(pieces.sparkSession)
    items = pieces.where(F.col(length) < capacity).select(F.col(row).alias("row"), F.col(length).cast("long").alias("length"))
    groups = max(1, -(-items.count() // group_items))

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy()) for b in batches]
        if not held:
            return
        rows, lens, group = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((rows, -lens, group))
        rows, lens, group = rows[order], lens[order], group[order]
        edge = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
        for a, z in zip(edge, edge[1:], strict=False):
            where, offset, fills = best_fit(lens[a:z], capacity)
            fill = np.array(fills)
            carry = _carried(fill, capacity, fan)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[a:z]), pa.array(where + (int(group[a]) << 32)), pa.array(offset), pa.array(fill[where]), pa.array(carry[where])], names=["row", "bin", "offset", "fill", "carry"]
            )

    dealt = items.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    dealt = dealt.repartitionById(-(-groups // TASK_GROUPS), F.floor(F.col("group") / TASK_GROUPS).cast("int"))
    placed = cut(dealt.select("row", "length", "group").mapInArrow(first_round, "row long, bin long, offset long, fill long, carry boolean"))
    heads = placed.where("carry and offset = 0")
    live = heads.select("bin", F.col("bin").alias("root"), F.lit(0).cast("long").alias("shift"))
    roots = heads.select(F.col("bin").alias("root"), "fill", F.shiftright("bin", 32).alias("group"))

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["fill", "root"], ascending=[False, True], ignore_index=True)
        where, by, fills = best_fit(rows["fill"].to_numpy(), capacity)
        first = np.empty(len(fills), np.int64)
        first[where[::-1]] = rows["root"].to_numpy()[::-1]
        fill = np.array(fills)
        return pd.DataFrame({"old": rows["root"], "new": first[where], "by": by, "now": fill[where], "up": _carried(fill, capacity, fan)[where], "node": rows["node"]})

    while groups > 1:
        groups = -(-groups // fan)
        node = roots.select("root", "fill", F.floor(F.col("group") / fan).alias("node"))
        merged = cut(node.groupBy("node").applyInPandas(merge, "old long, new long, by long, now long, up boolean, node long"))
        live = cut(live.join(merged, live["root"] == merged["old"], "left").select("bin", F.coalesce("new", "root").alias("root"), (F.col("shift") + F.coalesce("by", F.lit(0))).alias("shift")))
        roots = merged.where("up and old = new").select(F.col("new").alias("root"), F.col("now").alias("fill"), F.col("node").alias("group"))
    packed = placed.join(live, "bin", "left").select("row", F.coalesce("root", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))
    full = pieces.where(F.col(length) == capacity).select(F.col(row).alias("row"), (-1 - F.col(row)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(full).withColumnRenamed("row", row)


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, ranks: str = RANKS, with_ids: bool = True) -> DataFrame:
    """Pieces of every document with their sequence and place in it."""
    pieces = cut(tokenize_pieces(df, key, text, capacity, end_id, ranks, with_ids).withColumn("row", F.monotonically_increasing_id()))
    return pieces.join(pack(pieces.select("row", "length"), "row", capacity=capacity), "row").drop("row")


def op2_packing(spark, sf_dir: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack_documents(read_table(spark, sf_dir, "documents"), with_ids=False)
