"""Secret scans in DataFrame functions only.

Three base patterns give spans (code points, end exclusive). Beside them, every
run of ``LEAST``+ identifier characters that no base span covers (of a run that
one covers in part, what is left) is compared under two character Markov models,
one of random strings and one of ordinary identifiers; a run whose
log-likelihood ratio is high enough is a further span. The models are bigram
tables over ``ALPHABET`` counted from labelled samples (``train``); the ratio
table, of a fixed size, is a literal of the plan.

Positions come from splitting a text by a pattern and adding up the lengths of
the parts and of the matches (``_running``), so the work follows a text's length
and, but for a logarithm, its number of matches.

Edge cases: a null text counts as empty; a text without spans has empty lists,
the digest of the empty string, and ``spans`` ''. Whole texts are scanned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import read_table

_KEYWORD = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
ASSIGN = _KEYWORD + r"([A-Za-z0-9+/_.=-]+)"
#: Greedy runs: as long as the shorter pattern with a check of the length, in one step.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
#: Runs that the Markov models judge; the likelihood ratio, not the length, keeps short ones out.
LEAST = 12
_RUN_CHARS = "[A-Za-z0-9+/_=-]"
ANY_RUN = "(?<!%s)%s{%d,}" % (_RUN_CHARS, _RUN_CHARS, LEAST)
_BASE = "%s[A-Za-z0-9+/_.=-]{%d,}|%s|%s" % (_KEYWORD, ASSIGN_LEAST, ACCESS, HEX)
#: A base match, or, as its second group, a run that stops where one begins.
RUN = r"(?:%s)|(?:\G|(?<!%s))((?:(?!%s)%s){%d,}+)" % (_BASE, _RUN_CHARS, _BASE.replace("((?i)", "(?:(?i)"), _RUN_CHARS, LEAST)
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SIZE = len(ALPHABET) + 1  # index 0: any other character
#: A run is a secret if its log-likelihood ratio reaches both, in total and a bigram.
TOTAL, MEAN = 15.0, 0.5
#: Documents (ids, one text each) whose words make the samples of ordinary identifiers, at most; random strings, in number.
SAMPLE_DOCS, SAMPLE_RANDOM = 1000, 4000
KINDS = ("assign", "access", "hex", "markov")
_SPAN = "struct<start:int,ord:int,end:int>"
#: Code points of the blocks that a text is cut into for redaction.
BLOCK = 4096


def _index(c: Column) -> Column:
    return F.instr(F.lit(ALPHABET), c)


def train(samples: DataFrame, value: str = "value", label: str = "random") -> list[float]:
    """The table of log P(next | this, random) - log P(next | this, ordinary), row by row.

    ``samples`` has strings and whether each is random; bigrams are counted on
    the executors, add-half smoothed. Null values and labels are left out.
    """
    grams = samples.where(F.col(value).isNotNull() & F.col(label).isNotNull()).select(F.col(label).cast("boolean").alias("y"), F.col(value).alias("v")).where("length(v) > 1")
    pairs = grams.select("y", F.split("v", "").alias("c")).select("y", F.explode(F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c") - 1), _pair)).alias("pair"))
    counts: dict[bool, dict[int, int]] = {True: {}, False: {}}
    for r in pairs.groupBy("y", "pair").count().collect():  # at most 2 x SIZE^2 rows
        counts[r["y"]][r["pair"]] = r["count"]
    table = [0.0] * (SIZE * SIZE)
    for a in range(SIZE):
        total = {y: sum(counts[y].get(a * SIZE + b, 0) for b in range(SIZE)) for y in counts}
        for b in range(SIZE):
            p, q = ((counts[y].get(a * SIZE + b, 0) + 0.5) / (total[y] + 0.5 * SIZE) for y in (True, False))
            table[a * SIZE + b] = round(math.log(p) - math.log(q), 6)
    return table


def _pair(a: Column, b: Column) -> Column:
    """Index of a bigram in the table, from 0."""
    return _index(a) * SIZE + _index(b)


def _walked(s: Column, table: list[float], finish) -> Column:
    """One walk over a string's characters: ``sum`` of the bigrams' ratios, and ``best``, the largest sum of neighbouring ones."""
    llr = F.array(*[F.lit(x) for x in table])

    def step(acc: Column, c: Column) -> Column:
        more = F.when(acc["last"] == "", F.lit(0.0)).otherwise(F.get(llr, _pair(acc["last"], c)))
        return _bound(more, lambda m: F.struct(c.alias("last"), (acc["sum"] + m).alias("sum"), F.greatest(F.lit(0.0), acc["here"] + m).alias("here"), F.greatest(acc["best"], acc["here"] + m).alias("best")))

    zero = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("here"), F.lit(0.0).alias("best"))
    return F.aggregate(F.split(s, ""), zero, step, finish)


def ratio(s: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a string: random against ordinary."""
    return _walked(s, table, lambda acc: acc["sum"])


def labelled_samples(spark: SparkSession, docs: DataFrame, key: str, text: str) -> DataFrame:
    """Random strings made by rule (hex, base64, upper-case base 32) and identifiers made of the words of a bounded sample of documents."""
    digest = F.sha2(F.col("id").cast("string"), 512)
    made = spark.range(SAMPLE_RANDOM).select(
        F.explode(
            F.array(
                F.substring(digest, 1, 40),
                F.substring(F.base64(F.unhex(digest)), 1, 40),
                F.translate(F.substring(F.base64(F.unhex(digest)), 41, 36), "+/=", "-_-"),
                F.upper(F.conv(F.substring(digest, 1, 15), 16, 36)),
                F.concat(F.lower(F.conv(F.substring(digest, 20, 15), 16, 36)), F.upper(F.conv(F.substring(digest, 40, 15), 16, 36))),
            )
        ).alias("value"),
        F.lit(True).alias("random"),
    )
    chosen = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(key).distinct().orderBy(F.xxhash64(key), key).limit(SAMPLE_DOCS)
    words = F.filter(F.split(F.regexp_replace("t", r"[0-9+/_=-]+|\S*[0-9]\S*", " "), r"[^A-Za-z]+"), lambda w: F.length(w) > 1)
    # One text of each id, the one with the smallest hash, however often the id occurs; each task brings down its own first.
    one = F.min(F.struct(F.xxhash64(text).alias("h"), F.col(text).alias("t"))).alias("one")
    named = docs.where(F.col(text).isNotNull()).select(key, text).join(F.broadcast(chosen), key, "left_semi")  # SAMPLE_DOCS ids
    # No condition on the words, stated or inferred, may be moved below the join: it would split all texts.
    some = named.groupBy(key).agg(one).select("one.t").select(words.alias("w"))
    glued = F.transform(
        F.when(F.size("w") > 2, F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("w") - 3), F.lit(3))).otherwise(F.array().cast("array<int>")),
        lambda i: F.concat(
            F.get("w", i), F.element_at(F.array(F.lit("_"), F.lit("-"), F.lit("/"), F.lit("")), F.pmod(i, F.lit(4)) + 1),
            F.when(F.pmod(i, F.lit(5)) < 2, F.initcap(F.get("w", i + 1))).otherwise(F.get("w", i + 1)), F.when(F.pmod(i, F.lit(7)) == 0, F.upper(F.concat(F.lit("_"), F.get("w", i + 2)))).otherwise(F.concat(F.lit("_"), F.get("w", i + 2))),
            F.when(F.pmod(i, F.lit(11)) == 0, F.concat(F.lit("_"), F.pmod(i, F.lit(1000)))).otherwise(F.lit("")),
        ),
    )
    return made.unionByName(some.select(F.explode_outer(F.concat(glued, "w")).alias("value"), F.lit(False).alias("random")))


def _running(xs: Column, join) -> Column:
    """Running ``join`` (a sum, a maximum) of an array by doubling steps: element i takes in element i - 1, then i - 2, i - 4, ..."""
    steps = F.when(F.size(xs) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(xs))).cast("int") - 1)).otherwise(F.array().cast("array<int>"))

    def step(acc: Column, k: Column) -> Column:
        back = F.lit(1) * F.pow(F.lit(2), k).cast("int")
        return F.transform(acc, lambda x, i: F.when(i >= back, join(x, F.get(acc, i - back))).otherwise(x))

    return F.aggregate(steps, xs, step)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, as a lambda's variable."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _matches(text: Column, pattern: str, group: int) -> Column:
    """(end, size, own) of the matches of ``pattern``, leftmost and non-overlapping: where each ends, its length and its ``group``."""
    parts = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.transform(found, lambda x: F.length(x))
    reach = _bound(F.zip_with(F.slice(parts, 1, F.greatest(F.lit(0), F.size(parts) - 1)), sizes, lambda a, b: a + b), lambda xs: _running(xs, lambda a, b: a + b))
    own = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    return F.arrays_zip(reach.alias("end"), sizes.alias("size"), own.alias("own"))


def _spans(text: Column, pattern: str, kind: int, good=None, group: int = 0) -> Column:
    """Matches of ``pattern`` whose ``group`` is ``good``, as (start, kind, end)."""
    # A group that took part begins its match or (in assignments) ends it; only runs have a size of their own.
    found = _matches(text, pattern, group)
    kept = F.filter(found, lambda m: good(m["own"])) if good else found
    return F.transform(kept, lambda m: F.struct((m["end"] - m["size"]).alias("start"), F.lit(kind).alias("ord"), m["end"].alias("end")))


def scan(df: DataFrame, text: str, table: list[float], total: float = TOTAL, mean: float = MEAN) -> DataFrame:
    """``df`` with ``base`` and ``spans``: arrays of (start, ord, end), by start, then kind.

    ``ord`` is the place of the kind in ``KINDS``.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast(f"array<{_SPAN}>")
    among = lambda pattern, spans: F.when(t.rlike(pattern), spans).otherwise(none)
    base = F.concat(
        among(ASSIGN, _spans(t, ASSIGN, 0, lambda own: F.length(own) >= ASSIGN_LEAST, 2)),
        among(ACCESS, _spans(t, ACCESS, 1)),
        among(HEX, _spans(t, HEX, 2)),
    )
    # No part of a run without such a stretch can reach the total: texts without one, nearly all, are passed over once.
    some = F.exists(F.regexp_extract_all(t, F.lit(ANY_RUN), F.lit(0)), lambda run: _walked(run, table, lambda acc: acc["best"]) >= total)
    random = F.when(some, _spans(t, RUN, 3, lambda own: (own != "") & _random(own, table, total, mean), 2)).otherwise(none)
    out = df.withColumn("base", F.array_sort(base)).withColumn("_random", random)
    return out.withColumn("spans", F.array_sort(F.concat("base", "_random"))).drop("_random")


def _random(run: Column, table: list[float], total: float, mean: float) -> Column:
    r = ratio(run, table)
    return r >= F.greatest(F.lit(total), (F.length(run) - 1) * F.lit(mean))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["ord"]), s["start"], s["end"])), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced by ``mark``; overlapping spans are one.

    The text is cut into blocks once; what stays between the spans is put
    together from parts of them, so no span walks the text from its start.
    """

    def piece(blocks: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / BLOCK).cast("int")
        part = lambda b: F.substring(F.get(blocks, b), F.greatest(F.lit(0), start - b * BLOCK) + 1, end - F.greatest(start, b * BLOCK))
        return F.when(end > start, F.array_join(F.transform(F.sequence(first, F.floor((end - 1) / BLOCK).cast("int")), part), "")).otherwise(F.lit(""))

    def joined(blocks: Column, ends: Column) -> Column:
        before = lambda i: F.when(i > 0, F.get(ends, i - 1)).otherwise(F.lit(0))
        steps = F.transform(spans, lambda s, i: F.when(s["start"] >= before(i), piece(blocks, before(i), s["start"])))
        return F.array_join(F.concat(F.array_compact(steps), F.array(piece(blocks, F.element_at(ends, -1), F.length(text)))), mark)

    reach = _bound(F.transform(spans, lambda s: s["end"]), lambda xs: _running(xs, F.greatest))
    cut = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0))
    return F.when(F.size(spans) > 0, _bound(F.struct(cut.alias("blocks"), reach.alias("ends")), lambda x: joined(x["blocks"], x["ends"]))).otherwise(text)


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    """One row per document: counts by kind, the digest of the base spans, and all spans."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    table = train(labelled_samples(spark, docs, "doc_id", "text"))
    found = scan(docs, "text", table)
    count = lambda k: F.size(F.filter("base", lambda s: s["ord"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )
