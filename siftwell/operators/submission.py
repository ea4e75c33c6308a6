"""The ranked submission file and its validator."""

from __future__ import annotations

import csv
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.functions import columns as C
from siftwell.functions import fixed_values as V
from siftwell.functions import folds
from siftwell.sources import sinks
from siftwell.sources.store import place

LIMIT = 100


def rows_of(top: DataFrame, explained: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(candidate_id, rank, score, reasoning), by rank; scores with six decimals, no explanation as empty."""
    joined = top.where(F.col("rank") <= limit).join(F.broadcast(explained.select("candidate_id", "reasoning")), "candidate_id", "left")
    return joined.orderBy("rank", "candidate_id").limit(limit).select("candidate_id", "rank", C.score_text("final_score").alias("score"), C.empty_if_null("reasoning").alias("reasoning"))


def write(rows: DataFrame, path: str | Path, require: bool = False) -> Path:
    """The file itself, byte for byte; with ``require`` only if it is a valid submission."""
    data = [(r["candidate_id"], r["rank"], r["score"], r["reasoning"]) for r in rows.collect()]  # at most LIMIT rows
    return sinks.write_csv(path, V.SUBMISSION_HEADER, data, check=(lambda p: require_valid(p, name=str(path))) if require else None)


def problems(path: str | Path, name: str | None = None, size: int = LIMIT) -> list[str]:
    """What is wrong with a submission file; empty if nothing is."""
    if not str(name or path).endswith(".csv"):
        return ["the file name must end in .csv"]
    if not place(path).is_file():
        return [f"no such file: {path}"]
    with place(path).open(encoding="utf-8", newline="") as f:
        table = [r for r in csv.reader(f) if r]
    out: list[str] = []
    if not table or table[0] != list(V.SUBMISSION_HEADER):
        return [f"the header must be {','.join(V.SUBMISSION_HEADER)}"]
    body = table[1:]
    if len(body) != size:
        out.append(f"{len(body)} rows instead of {size}")
    good: list[tuple[int, float, str]] = []
    ids: set[str] = set()
    ranks: set[int] = set()
    for i, row in enumerate(body, 2):
        if len(row) != len(V.SUBMISSION_HEADER):
            out.append(f"line {i}: {len(row)} cells")
            continue
        cid, rank, score, _ = row
        if not re.match(V.CANDIDATE_ID, cid):
            out.append(f"line {i}: bad candidate_id {cid!r}")
        if cid in ids:
            out.append(f"line {i}: repeated candidate_id {cid}")
        ids.add(cid)
        if not re.fullmatch(r"[1-9][0-9]*", rank) or not 1 <= int(rank) <= size:
            out.append(f"line {i}: bad rank {rank!r}")
            continue
        if int(rank) in ranks:
            out.append(f"line {i}: repeated rank {rank}")
        ranks.add(int(rank))
        try:
            good.append((int(rank), float(score), cid))
        except ValueError:
            out.append(f"line {i}: bad score {score!r}")
    if missing := sorted(set(range(1, size + 1)) - ranks):
        out.append(f"missing ranks: {missing[:10]}")
    good.sort()
    for (r1, s1, c1), (r2, s2, c2) in zip(good, good[1:], strict=False):
        if s2 > s1:
            out.append(f"score rises from rank {r1} to {r2}")
        elif s1 == s2 and c2 < c1:
            out.append(f"ranks {r1} and {r2} tie out of id order")
    return out


def require_valid(path: str | Path, name: str | None = None) -> None:
    if found := problems(path, name):
        raise sinks.SinkError("; ".join(found))


def order_issues(ranked: DataFrame, key: str = "candidate_id", score: str = "final_score", rows: int = folds.BLOCK_ROWS) -> DataFrame:
    """The two ordering rules over a ranked table of any size: (rank, key, issue), issue null where a row keeps both."""
    w = folds.in_block()
    prev, prev_id = F.lag(score).over(w), F.lag(key).over(w)
    issue = F.when(F.col(score) > prev, F.lit("score_increases")).when((F.col(score) == prev) & (F.col(key) < prev_id), F.lit("tie_order"))
    return folds.in_blocks(ranked.select("rank", key, score), before=1, rows=rows).withColumn("issue", issue).where("own").select("rank", key, "issue")


def repeated_openings(ranked: DataFrame, opening: Column, width: int = 5, rows: int = folds.BLOCK_ROWS, empty: bool = False) -> DataFrame:
    """(rank, most_repeated) for every ``width`` neighbours of a ranked table of any size, by the first one's rank: how often their most frequent opening occurs.

    Null openings keep their place but aren't counted, and empty ones only where ``empty`` says so. Rows that share a rank stand by their openings.
    """
    keys = F.collect_list(F.struct("opening")).over(folds.in_block("rank", "opening").rowsBetween(0, width - 1))  # of bare openings it would drop the nulls
    rows_ = folds.in_blocks(ranked.select("rank", opening.alias("opening")), after=width - 1, rows=rows).withColumn("keys", keys).where(F.col("own") & (F.size("keys") == width))
    said = F.filter("keys.opening", lambda k: k.isNotNull() if empty else k != "")
    return rows_.select("rank", F.coalesce(F.array_max(F.transform(said, lambda k: F.size(F.filter(said, lambda other: other == k)))), F.lit(0)).cast("long").alias("most_repeated"))


def missing_ranks(ranked: DataFrame, size: int = LIMIT) -> DataFrame:
    """Ranks from 1 to ``size`` that a list lacks."""
    return ranked.sparkSession.range(1, size + 1).select(F.col("id").alias("rank")).join(ranked.select("rank"), "rank", "left_anti")
