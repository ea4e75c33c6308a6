"""Small corpora for the operator tests, written as the driver's tables are."""

from __future__ import annotations

import hashlib
import random

WORDS = "the of and to in for with that this from mountain river window garden letter summer market bridge kitchen winter paper stone silver yellow quiet round simple open narrow heavy".split()
INSULTS = ["idiot", "moron", "scum", "pathetic"]
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", "ly", "ing", "s"]) for _ in range(n))


def near_copy(text: str, rng: random.Random) -> str:
    words = text.split()
    words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and odd texts, repeated rows and ids, one very long text."""
    rng = random.Random(5)
    base = prose(rng, 120)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (2, base, "en", "a"), (3, near_copy(base, rng), "en", None), (4, None, "en", "a"), (5, "", None, "a"), (6, " \n\t ", "en", "a"),
        (None, prose(rng, 40), "en", "a"), (None, None, None, None), (7, "é ü 漢字 😀 ▁ <|endoftext|>", "fr", "a"), (8, "x", "en", "a"), (9, "1234 5678 !!", "en", "a"),
        (10, prose(rng, 30) + " " + base[:300] + " " + prose(rng, 30), "en", "a"), (11, "ab" * 400, "en", "a"), (7, "other text with the same id", "fr", "b"), (12, prose(rng, 60_000), "en", "a"), (13, "a" * 120_000, "en", "a"),
    ]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def documents(spark, path, rows: list[tuple], extra: bool = True) -> str:
    """Write ``documents`` (with clashing further columns) below ``path``."""
    df = spark.createDataFrame(rows, DOCUMENTS)
    if extra:
        for name in ("row", "key", "part", "fp", "base", "spans", "label", "score", "length", "bin", "id", "node", "ids", "y", "r"):
            df = df.selectExpr("*", f"cast(null as string) as `{name}`")
    df.repartition(3).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return str(path)


def table(spark, path, name: str, rows: list[tuple], schema: str, extra: tuple[str, ...] = ()) -> None:
    """Write a table; ``extra`` names further columns, all null."""
    df = spark.createDataFrame(rows, schema)
    for column in extra:
        df = df.selectExpr("*", f"cast(null as string) as `{column}`")
    df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")


def token(seed: int, n: int = 40) -> str:
    return hashlib.sha256(str(seed).encode()).hexdigest()[:n]
