"""Merkle manifests of a dataset by Pregel-style RDD supersteps.

Every row is a leaf, the hash of its columns. Leaves of a group (a source)
ascend by key; while a group has more than one node, each run of ``FAN``
consecutive nodes becomes their hash. What remains is the group's subroot, and
the subroots, in the order of the groups, make the root in the same way.

* ``number`` gives each leaf its group's number and its place in the group, both
  from range partitions: a task tells only its first and last group and their
  counts, so no group is gathered and nothing but a few numbers a partition
  reaches the driver.
* ``climb``: in each superstep children message their parents (one message a
  node, at most ``FAN`` a parent, so a group of any size is spread over all
  tasks); a parent that has all its children hashes them and forwards. A node
  that is the first and the last of its level is its group's top and stops.
* ``descend``: the same supersteps backwards. A parent hands its own path and
  its children's hashes to each child that has children of its own; the last
  step meets the leaves by run, so sibling paths travel once a run, not once a
  leaf. There each leaf is folded with its siblings up to the root.

Hash of a list: SHA-256 of the concatenated digests as hex text, in hex. A path
is a tuple of (place, hashes of the whole run), from the lowest level up.

Edge cases: null and empty values have forms of their own (``-``, ``0:``). Null
groups and keys come first. Rows with the same key in a group are ordered by
leaf hash; equal rows are equal leaves at neighbouring places, each with its own
siblings. Rows without a key are never tampered with. A group of one row is its
own subroot; one group's subroot is the root; no rows give no rows. Further
columns don't enter the hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import Any

from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.common import cut, prepare, read_table

#: Children of a node, at most.
FAN = 16
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
#: Rows of a document table whose crc32 of the key this divides are tampered with in verification.
TAMPERED_FOLD = 5
#: The tree whose leaves are the groups' subroots.
TOP = -1
_OUT = "key {key}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

Path = tuple[tuple[int, tuple[bytes, ...]], ...]


def canonical(value: Column) -> Column:
    """A value's bytes in a leaf: ``-`` for null, else its UTF-8 byte count, a colon and the value (numbers as decimals)."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    """The leaf of a row: SHA-256 of its values' canonical forms, one after the other, in hex."""
    return F.sha2(F.concat(*[canonical(v) for v in values]).cast("binary"), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(hashes: Iterable[bytes]) -> bytes:
    """SHA-256 over hex digests, as a hex digest."""
    return hashlib.sha256(b"".join(hashes)).hexdigest().encode()


# -- numbering --------------------------------------------------------------------------------------------------------


def _outline(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Of a sorted partition: its first and last group (as digests), the last one's row count, and the number of groups."""
    first = last = group = None
    n_last = groups = 0
    for row in rows:
        if not groups or row[0] != group:
            group, last, n_last, groups = row[0], _name(row[0]), 0, groups + 1
            first = first if groups > 1 else last
        n_last += 1
    if groups:
        yield first, last, n_last, groups


def _name(group: Any) -> bytes:
    return b"" if group is None else hashlib.sha256(str(group).encode()).digest()


def number(leaves: DataFrame) -> tuple[RDD, int]:
    """((group's number, place), (key, leaf, tampered leaf or None, whether its group ends here)) of each leaf, and the number of groups.

    ``leaves`` has group, key, leaf and tampered.
    """
    spark = leaves.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Equal rows are told apart by where they were read, so that copies don't share a range.
    order = [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf"), F.col("read")]
    # The ranges are sampled: everything below must see the same ones.
    rows = cut(leaves.withColumn("read", F.monotonically_increasing_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("read"))
    rdd = rows.rdd.map(tuple)
    outlines = sorted(rdd.mapPartitionsWithIndex(lambda p, it: ((p, *x) for x in _outline(it))).collect())  # one a partition
    starts: dict[int, tuple[int, int, bool]] = {}
    trees, before, previous = -1, 0, None
    for (p, first, last, n_last, groups), following in zip(outlines, [*outlines[1:], (None, None)], strict=False):
        if first != previous:
            trees, before = trees + 1, 0
        starts[p] = trees, before, following[1] != last
        before = before + n_last if groups == 1 else n_last
        trees, previous = trees + groups - 1, last

    def placed(p: int, it: Iterator[tuple]) -> Iterator[tuple]:
        if p not in starts:
            return
        tree, place, ends = starts[p]
        held = None
        for group, key, leaf, tampered in it:
            if held is not None:
                other = held[0] != group
                yield (tree, place), (*held[1:], other)
                tree, place = (tree + 1, 0) if other else (tree, place + 1)
            held = group, key, leaf, tampered
        if held is not None:
            yield (tree, place), (*held[1:], ends)

    return rdd.mapPartitionsWithIndex(placed), trees + 1


# -- supersteps -------------------------------------------------------------------------------------------------------


def _received(messages: Iterable[tuple]) -> list[tuple]:
    """A parent's children by place; an error if one is missing."""
    children = sorted(messages, key=lambda c: c[0])
    if [c[0] for c in children] != list(range(len(children))) or not (children[-1][-1] or len(children) == FAN):
        raise ValueError("a node misses children")
    return children


def _kept(rdd: RDD) -> RDD:
    """A level's state, kept for the way down: written to the checkpoint folder, which outlives executors."""
    rdd.persist(StorageLevel.MEMORY_AND_DISK)
    rdd.checkpoint()
    return rdd


def climb(messages: RDD, parts: int) -> tuple[list[RDD], RDD]:
    """Upward supersteps from messages ((tree, run), (slot, hash, ..., is the last of its tree)).

    Gives each level's parents, ((tree, run), children), and the finished trees, (tree, (height, hash)).
    """
    levels: list[RDD] = []
    tops: RDD | None = None
    while True:
        level = _kept(messages.groupByKey(parts).mapValues(_received))
        height = len(levels)
        levels.append(level)
        # A run of one node that is all its tree has was finished before it was sent: its hash is no new one.
        done = level.filter(_single).map(lambda x, h=height: (x[0][0], (h, x[1][0][1])))
        tops = done if tops is None else tops.union(done)
        unfinished = level.filter(lambda x: not _single(x))
        more = unfinished.count()
        level.unpersist()  # its checkpoint stays
        if not more:
            return levels, tops
        messages = unfinished.map(_forward)


def _single(parent: tuple) -> bool:
    (_, run), children = parent
    return run == 0 and len(children) == 1 and children[0][-1]


def _forward(parent: tuple) -> tuple:
    """A completed parent hashes its children and messages its own parent."""
    (tree, run), children = parent
    return (tree, run // FAN), (run % FAN, digest(c[1] for c in children), children[-1][-1])


def descend(levels: list[RDD], paths: RDD, parts: int) -> RDD:
    """Downward supersteps: ((tree, run), (children, what came for the run)) of the lowest level.

    ``paths`` has (tree, (height, path, more)): what each finished tree is told.
    """
    inbox: RDD | None = None
    for height in range(len(levels) - 1, -1, -1):
        own = paths.filter(lambda x, h=height: x[1][0] == h).map(lambda x: ((x[0], 0), x[1][1:]))
        inbox = own if inbox is None else own.union(inbox)
        met = levels[height].join(inbox.partitionBy(parts), parts)  # the level's own partitions: only the inbox moves
        if height == 0:
            return met
        inbox = met.flatMap(_hand_down)
    raise ValueError("no levels")


def _hand_down(met: tuple) -> list[tuple]:
    """A run tells each of its nodes, which are runs of the level below, the path above that node."""
    (tree, run), (children, (path, more)) = met
    if _single(((tree, run), children)):
        return [((tree, 0), (path, more))]
    hashes = tuple(c[1] for c in children)
    return [((tree, run * FAN + c[0]), (((c[0], hashes), *path), more)) for c in children]


# -- proofs -----------------------------------------------------------------------------------------------------------


def siblings(path: Path) -> list[bytes]:
    """The hashes that a proof lists: of each run all but the node's own, left to right, lowest level first."""
    return [h for place, run in path for i, h in enumerate(run) if i != place]


def fold(leaf: bytes, path: Path) -> bytes:
    """The root that a leaf gives with the siblings on its path."""
    for place, run in path:
        leaf = digest([*run[:place], leaf, *run[place + 1 :]])
    return leaf


def _proofs(met: tuple, root: bytes) -> Iterator[tuple]:
    """Rows of a run of leaves: each leaf folded from what it is now, along its own path."""
    ((tree, run), (children, (path, subroot))) = met
    single = _single(((tree, run), children))
    hashes = tuple(c[1] for c in children)
    above = b"".join(siblings(path))
    folded: dict[bytes, bytes] = {}
    for place, leaf, key, tampered, _ in children:
        own = () if single else ((place, hashes),)
        lowest = fold(tampered or leaf, own)
        if lowest not in folded:  # most leaves of a run give the same node
            folded[lowest] = fold(lowest, path)
        end = folded[lowest]
        proof = hashlib.sha256(b"".join(siblings(own)) + above).hexdigest()
        yield key, leaf.decode(), subroot.decode(), root.decode(), proof, end.decode(), end == root


def manifest(df: DataFrame, key: str, group: str, columns: list[str], tampered: Column | None = None) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    A leaf hashes ``columns`` in their order. ``tampered`` is a leaf hash of what
    a row has become, null where it is as it was; the fold starts from it.
    """
    spark = prepare(df.sparkSession)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = df.schema[key].dataType.simpleString()
    leaves = df.select(F.col(group).alias("group"), F.col(key).alias("key"), leaf_hash([F.col(c) for c in columns]).alias("leaf"), (F.lit(None).cast("string") if tampered is None else tampered).alias("tampered"))
    rows, trees = number(leaves)
    schema = _OUT.format(key=kind)
    if not trees:
        return spark.createDataFrame([], schema).withColumnRenamed("key", key)
    up = rows.map(lambda x: ((x[0][0], x[0][1] // FAN), (x[0][1] % FAN, x[1][1].encode(), x[1][0], x[1][2] and x[1][2].encode(), x[1][3])))
    levels, tops = climb(up, parts)
    # The subroots are the leaves of one more tree; its own top is the root.
    crowns, top = climb(tops.map(lambda x: ((TOP, x[0] // FAN), (x[0] % FAN, x[1][1], x[1][0], x[0] == trees - 1))), parts)
    height, root = top.values().first()
    above = descend(crowns, spark.sparkContext.parallelize([(TOP, (height, (), None))], 1), parts).flatMap(_to_trees)
    met = descend(levels, above, parts)
    out = met.flatMap(lambda x: _proofs(x, root))
    return spark.createDataFrame(out, schema, verifySchema=False).withColumnRenamed("key", key)


def _to_trees(met: tuple) -> list[tuple]:
    """A run of subroots tells each tree its height, the path above its subroot and the subroot."""
    ((tree, run), (children, (path, _))) = met
    if _single(((tree, run), children)):
        return [(0, (children[0][2], path, children[0][1]))]
    hashes = tuple(c[1] for c in children)
    return [(run * FAN + c[0], (c[2], ((c[0], hashes), *path), c[1])) for c in children]


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root, proof and verification of every document; a fifth of them by key is tampered with by lower-casing."""
    docs = read_table(spark, sf_dir, "documents").select(*COLUMNS)
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_FOLD == 0
    became = F.when(fifth, leaf_hash([lower_ascii(F.col(c)) if c == "text" else F.col(c) for c in COLUMNS]))
    return manifest(docs, "doc_id", "source", COLUMNS, became)


#: Levels, paths and folds by recursion over nodes; crc32 by its table, made from its polynomial.
OP11_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, source, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head FROM documents),
crc AS (SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))) AS t),
leaf AS (SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
    sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS lowered,
    xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: ord(ch)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0 AS fifth FROM d, crc),
placed AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h, r) - 1 AS i FROM leaf),
up AS (
  SELECT tree, 0 AS lvl, i, h FROM placed
  UNION ALL
  SELECT tree, lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM up) WHERE n > 1 GROUP BY tree, lvl, i // 16),
subroot AS (SELECT tree, arg_max(h, lvl) AS h, max(lvl) AS lvl FROM up GROUP BY tree),
crown AS (
  SELECT 0 AS lvl, tree AS i, h FROM subroot
  UNION ALL
  SELECT lvl + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS n FROM crown) WHERE n > 1 GROUP BY lvl, i // 16),
node AS (SELECT tree, lvl, i, h FROM up UNION ALL SELECT -1, lvl, i, h FROM crown),
beside AS (SELECT tree, lvl, i, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rr,
    count(*) OVER (PARTITION BY tree, lvl) AS n FROM node WINDOW w AS (PARTITION BY tree, lvl, i // 16 ORDER BY i)),
walk AS (
  SELECT r, tree, tree AS own, 0 AS lvl, i, CASE WHEN fifth THEN lowered ELSE h END AS cur, '' AS proof, false AS at_top FROM placed
  UNION ALL
  SELECT r, CASE WHEN n = 1 THEN -1 ELSE w.tree END, own, CASE WHEN n = 1 THEN 0 ELSE w.lvl + 1 END, CASE WHEN n = 1 THEN own ELSE w.i // 16 END,
    CASE WHEN n = 1 THEN cur ELSE sha256(l || cur || rr) END, CASE WHEN n = 1 THEN proof ELSE proof || l || rr END, n = 1
  FROM walk w JOIN beside b ON b.tree = w.tree AND b.lvl = w.lvl AND b.i = w.i WHERE NOT (w.tree = -1 AND n = 1)),
folded AS (SELECT r, cur, proof FROM walk WHERE tree = -1 QUALIFY row_number() OVER (PARTITION BY r ORDER BY lvl DESC) = 1),
root AS (SELECT arg_max(h, lvl) AS h FROM crown)
SELECT p.doc_id, p.h AS leaf, s.h AS subroot, root.h AS root, sha256(f.proof) AS proof_sha256, f.cur AS folded_root, f.cur = root.h AS verified
FROM placed p JOIN subroot s ON s.tree = p.tree JOIN folded f ON f.r = p.r, root
"""
