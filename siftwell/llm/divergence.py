"""Source divergence audits: how far a language's sources are from one another, and the terms each source overuses.

Each language keeps the terms that are in at least ``LEAST_DOCS`` of its
documents. A group (language, source), and the language itself, gives each kept
term a smoothed share in billionths, ``1 + floor(10^9 (count + 2) / (N + 2 V))``.
Two shares differ by ``floor((p - q)^2 / (p + q))``; all arithmetic is of whole
numbers.

* ``term_counts``: each task adds up its documents' terms before anything is
  shuffled (and sends them on whenever it holds ``HELD`` of them), so neither a
  frequent term nor a source with a third of all rows is one task's.
* Pairs of sources are summed sparsely. Were no term used by either, the sum
  would be V times the difference of the two shares of an unused term. From that
  baseline, a source's own terms are corrected by their counts (terms with equal
  counts differ alike, so there are few), and only terms of both sources are
  looked at one by one, once for both directions.
* The k terms of a group are found by radix select (``radix_top``): histograms
  over the value's high bits give the digit in which the k-th value falls, then
  those of the low bits within it; of terms tied at that value, histograms over
  two bytes after their common prefix narrow down the smallest by UTF-8. A
  window sorts only what is left: fewer than k rows, and ``TIES`` tied ones.

Joins of counts with a group's figures are salted by term, and so is the join of
sources with sources: no group is gathered.

Edge cases: null text, language and source count as ''. A source without terms
has pairs, all its terms being unused. Where a language keeps no term, its pairs
are 0. A language with one source has no pairs. Equal rows count as often as
they occur. Empty tables give no rows; further columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.llm.common import cut, prepare, read_table, utf8

#: A kept term is in so many documents of its language, at least.
LEAST_DOCS = 10
#: Terms that a group's report names.
TOP_TERMS = 10
#: Bits of the radix digits of a value, from the high ones on; a difference of shares has 30.
DIGITS = (15, 15)
#: Tied terms of a group that are sorted at once.
TIES = 64
#: Counted terms that a task holds before it sends them on.
HELD = 400_000
#: Parts of a group's terms in joins.
SALTS = 16
_ROWS = 20_000
BILLION = 1_000_000_000
#: Counts below this, times a billion, are within 64 bits.
LONG_COUNT = 9_000_000_000
_COUNTS = "lang string, source string, term string, n long, docs long"
#: Bytes to what a term is made of: A-Z lower-cased, all that parts terms a blank.
_BYTES = bytes(b if b > 127 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in parts, several rows a term; ``docs`` has lang, source and text."""
    prepare(docs.sparkSession)

    def told(counts: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, d) in counts.items():
            terms = list(n)
            for i in range(0, len(terms), _ROWS):
                some = terms[i : i + _ROWS]
                columns = [pa.array([lang] * len(some)), pa.array([source] * len(some)), pa.array(some, pa.binary()).cast(pa.string()), pa.array([n[t] for t in some]), pa.array([d[t] for t in some])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), strict=True):
                n, d = counts.setdefault((lang, source), (Counter(), Counter()))
                words, before = terms_of(text), len(n)
                n.update(words)
                d.update(set(words))
                held += len(n) - before
                if held > HELD:
                    yield from told(counts)
                    counts, held = {}, 0
        yield from told(counts)

    return docs.select("lang", "source", "text").mapInArrow(run, _COUNTS)


def share(n: Column, total: Column, kept: Column) -> Column:
    """The smoothed share of a term in billionths, exact for counts of any size: in 64 bits where they hold the product, else in decimals."""
    size = total + kept * 2
    wide = F.lit(BILLION).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return 1 + F.when(n < LONG_COUNT, F.call_function("div", F.lit(BILLION).cast("long") * (n + 2), size)).otherwise(F.call_function("div", wide, size.cast("decimal(20,0)")))


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _salted(rows: DataFrame, by: str) -> DataFrame:
    return rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))


def _for_salts(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def spread_join(big: DataFrame, small: DataFrame, on: list[str], by: str, how: str = "inner") -> DataFrame:
    """``big`` joined with ``small``, one row of it a key: a key's rows of ``big`` are parted by ``by``."""
    return _salted(big, by).join(_for_salts(small), [*on, "salt"], how).drop("salt")


def kept_terms(docs: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """Counts (lang, source, term, n, total) of the terms that are kept, and groups (g, lang, source, size, kept, total_size), one for each that occurs.

    ``total`` counts a term in its language, ``size`` a group's kept terms;
    ``kept`` is V and ``total_size`` the language's N. ``g`` numbers the groups.
    """
    spark = docs.sparkSession
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Dealt by language and term once: what is added up by source, and then over the sources, needs no other exchange.
    counts = term_counts(docs).repartition(parts, "lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    all_sources = Window.partitionBy("lang", "term")
    counts = counts.select("*", F.sum("n").over(all_sources).alias("total"), F.sum("docs").over(all_sources).alias("in_docs"), F.min("source").over(all_sources).alias("head"))
    # One row of each term is marked, so that V needs no count of distinct terms.
    kept = cut(counts.where(F.col("in_docs") >= least_docs).select("lang", "source", "term", "n", "total", (F.col("source") == F.col("head")).alias("first")))
    sizes = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"), F.count_if("first").alias("firsts"))
    langs = sizes.groupBy("lang").agg(F.sum("firsts").alias("kept"), F.sum("size").alias("total_size"))
    groups = docs.select("lang", "source").distinct().join(sizes.drop("firsts"), ["lang", "source"], "left").join(langs, "lang", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return kept.drop("first"), cut(groups.select(F.monotonically_increasing_id().alias("g"), "lang", "source", zero("size"), zero("kept"), zero("total_size")))


def group_shares(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, term, g, n, p, q, p0): each kept count's share in its group and in its language, and the share of a term that the group doesn't use."""
    rows = spread_join(kept, groups, ["lang", "source"], "term")
    of = lambda n, size: share(n, F.col(size), F.col("kept"))
    return rows.select("lang", "term", "g", "n", of(F.col("n"), "size").alias("p"), of(F.col("total"), "total_size").alias("q"), of(F.lit(0).cast("long"), "size").alias("p0"))


def pair_values(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(g, h, value) for every two groups of a language, in both directions."""
    unused = F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("size"), F.col("kept")))
    ends = groups.select("g", "lang", "kept", unused.alias("p0"))
    other = _for_salts(ends.select("lang", F.col("g").alias("h"), F.col("p0").alias("q0")))
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    base = _salted(ends, "g").join(other, ["lang", "salt"]).where("g < h").select("g", "h", F.coalesce(F.col("kept") * difference(p0, q0), F.lit(0).cast("long")).alias("x"))
    alike = shares.groupBy("lang", "g", "p", "p0").agg(F.count(F.lit(1)).alias("terms"))
    own = _salted(alike, "p").join(other, ["lang", "salt"]).where("g <> h")
    own = own.select(F.least("g", "h").alias("g"), F.greatest("g", "h").alias("h"), (F.col("terms") * (difference(p, q0) - difference(p0, q0))).alias("x"))
    terms = shares.select("lang", "term", "g", "p", "p0")
    both = terms.join(terms.select("lang", "term", F.col("g").alias("h"), F.col("p").alias("q"), F.col("p0").alias("q0")), ["lang", "term"]).where("g < h")
    both = both.select("g", "h", (difference(p, q) - difference(p, q0) - difference(p0, q) + difference(p0, q0)).alias("x"))
    # Each part is added up by pair before it is shuffled.
    summed = base.unionByName(own).unionByName(both).groupBy("g", "h").agg(F.sum("x").alias("value"))
    way = lambda a, b: F.struct(F.col(a).alias("g"), F.col(b).alias("h"))
    return summed.select(F.explode(F.array(way("g", "h"), way("h", "g"))).alias("w"), "value").select("w.g", "w.h", "value")


def _boundary(counts: DataFrame, group: list[str], need: Column, descending: bool) -> DataFrame:
    """Of each group's histogram (digit, n): ``edge``, the digit that the ``need``-th row falls in (or the last there is), ``need`` within it, and ``in_edge``, its rows."""
    upto = F.sum("n").over(Window.partitionBy(*group).orderBy(F.desc("digit") if descending else F.asc("digit")))
    reached = counts.withColumn("before", upto - F.col("n")).where(F.col("before") < need)
    last = F.max_by if not descending else F.min_by
    edge = F.min("digit") if descending else F.max("digit")
    return reached.groupBy(*group).agg(edge.alias("edge"), last(need - F.col("before"), "digit").alias("need"), last("n", "digit").alias("in_edge"))


def _common_bytes(a: Column, b: Column) -> Column:
    """How many leading bytes two different strings share."""
    a, b = a.cast("binary"), b.cast("binary")
    same = F.transform(F.sequence(F.lit(1), F.greatest(F.octet_length(a), F.octet_length(b))), lambda i: F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1)))
    return (F.array_position(same, False) - 1).cast("int")


def radix_top(rows: DataFrame, group: list[str], value: str, item: str, k: int, digits: tuple[int, ...] = DIGITS, ties: int = TIES) -> DataFrame:
    """The first ``k`` rows of each group by value (largest first), then item (UTF-8), with their ``rank``.

    ``rows`` has the group's columns, none of them null, value (0 or more, of
    sum(digits) bits) and item, distinct in its group. It is read once for each
    digit and once more, so it should be cheap to make again.
    """
    shift, state = sum(digits), None
    for bits in digits:
        shift -= bits
        digit = F.shiftright(value, shift)  # with all higher digits: the edge is a prefix of the k-th value
        if state is None:
            seen, need = rows.select(*group, digit.alias("digit")), F.lit(k).cast("long")
        else:
            inside = spread_join(rows.select(*group, value, item), state.select(*group, "edge", "need"), group, item).where(F.shiftright(value, shift + bits) == F.col("edge"))
            seen, need = inside.select(*group, digit.alias("digit"), "need"), F.col("need")
        by = [*group, "digit"] + (["need"] if state is not None else [])
        state = cut(_boundary(seen.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), group, need, True))
    found = spread_join(rows.select(*group, value, item), state, group, item).where(F.col(value) >= F.col("edge"))
    sure = found.where(F.col(value) > F.col("edge")).select(*group, value, item)
    left = found.where(F.col(value) == F.col("edge")).select(*group, value, item, "need", "in_edge")
    parts = [sure, left.where(F.col("in_edge") <= ties).select(*group, value, item)]
    many = state.where(F.col("in_edge") > ties)
    while not many.isEmpty():
        open_rows = cut(left.where(F.col("in_edge") > ties))
        ends = open_rows.groupBy(*group).agg(F.min(item).alias("lo"), F.max(item).alias("hi")).select(*group, _common_bytes(F.col("lo"), F.col("hi")).alias("common"))
        digit = F.substring(F.col(item).cast("binary"), F.col("common") + 1, F.lit(2))
        cuts = spread_join(open_rows.drop("in_edge"), ends, group, item).withColumn("digit", digit)
        state = cut(_boundary(cuts.groupBy(*group, "digit", "need").agg(F.count(F.lit(1)).alias("n")), group, F.col("need"), False))
        next_rows = spread_join(cuts.drop("need"), state, group, item).where(F.col("digit") <= F.col("edge"))
        parts.append(next_rows.where(F.col("digit") < F.col("edge")).select(*group, value, item))
        left = next_rows.where(F.col("digit") == F.col("edge")).select(*group, value, item, "need", "in_edge")
        parts.append(left.where(F.col("in_edge") <= ties).select(*group, value, item))
        many = state.where(F.col("in_edge") > ties)
    few = parts[0]
    for p in parts[1:]:
        few = few.unionByName(p)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(value), F.asc(item)))
    return few.withColumn("rank", rank).where(F.col("rank") <= k)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of all pairs of sources and of each source's ``top`` terms; ``docs`` has lang, source and text."""
    kept, groups = kept_terms(docs, least_docs)
    shares = group_shares(kept, groups)
    named = groups.select("g", "lang", "source")
    pairs = pair_values(shares, groups).join(named, "g").join(groups.select(F.col("g").alias("h"), F.col("source").alias("item")), "h")
    by_pair = F.row_number().over(Window.partitionBy("g").orderBy(F.desc("value"), F.asc("item")))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", by_pair.alias("rank"))
    over = shares.where(F.col("p") > F.col("q")).select("g", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    terms = radix_top(over, ["g"], "value", "item", top).join(named, "g")
    return pairs.unionByName(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    """Divergence of every two sources of a language, and the terms that each source uses more than its language."""
    return audit(read_table(spark, sf_dir, "documents").select("lang", "source", "text"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
size AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS cnt, 1 + (1000000000 * (coalesce(c.n, 0) + 2))::HUGEINT // (coalesce(s.n, 0) + 2 * v.v)::HUGEINT AS p, 1 + (1000000000 * (k.total + 2))::HUGEINT // (v.n + 2 * v.v)::HUGEINT AS q
  FROM g JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN size s ON s.lang = g.lang AND s.source = g.source LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM p WHERE cnt > 0 AND p > q)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)) WHERE part = 'pair' OR rank <= 10
"""
