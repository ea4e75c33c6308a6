"""Validated, atomic outputs: a new file or folder replaces the old one only when it is complete and read back."""

from __future__ import annotations

import csv
import json
import os
import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from siftwell.sources.store import StorePath, place


class SinkError(ValueError):
    """An output that failed its check; the old one is still there."""


def publish(path: str | Path, write: Callable[[Path], None], check: Callable[[Path], None] | None = None) -> Path | StorePath:
    """A driver's file, first whole under another name: what fails to be written or checked never takes the old one's place.

    A file of a store is written and checked in a folder of the driver's own, then uploaded.
    """
    final = place(path)
    if isinstance(final, StorePath):
        with tempfile.TemporaryDirectory(prefix="siftwell-file-") as folder:
            local = Path(folder) / final.name
            write(local)
            if check is not None:
                check(local)
            final.take(local)
        return final
    final.parent.mkdir(parents=True, exist_ok=True)
    draft = final.with_name(f".{final.name}.{uuid.uuid4().hex}")
    try:
        write(draft)
        if check is not None:
            check(draft)
        _to_disk(draft)
        draft.replace(final)
    except BaseException:
        draft.unlink(missing_ok=True)
        raise
    _to_disk(final.parent)
    return final


def _to_disk(path: Path) -> None:
    number = os.open(path, os.O_RDONLY)
    try:
        os.fsync(number)
    finally:
        os.close(number)


def write_text(path: str | Path, text: str) -> Path | StorePath:
    return publish(path, lambda p: p.write_text(text, encoding="utf-8"))


def write_json(path: str | Path, value: Any) -> Path | StorePath:
    return write_text(path, json.dumps(value, indent=2, default=str) + "\n")


def write_jsonl(path: str | Path, rows: Iterable[dict]) -> Path | StorePath:
    """One object a line; every line is parsed again before the file counts."""

    def write(p: Path) -> None:
        with p.open("w", encoding="utf-8") as f:
            f.writelines(json.dumps(r, ensure_ascii=False, default=str) + "\n" for r in rows)

    def check(p: Path) -> None:
        with p.open(encoding="utf-8") as f:
            for line in f:
                json.loads(line)

    return publish(path, write, check)


def write_csv(path: str | Path, header: Sequence[str], rows: Sequence[Sequence[Any]], check: Callable[[Path], None] | None = None) -> Path | StorePath:
    """A small CSV with exact bytes; header and row count are read back."""

    def write(p: Path) -> None:
        with p.open("w", encoding="utf-8", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(header)
            out.writerows(rows)

    def verify(p: Path) -> None:
        with p.open(encoding="utf-8", newline="") as f:
            got = list(csv.reader(f))
        if got[:1] != [list(header)] or len(got) - 1 != len(rows):
            raise SinkError(f"{path}: header or row count differs")
        if check:
            check(p)

    return publish(path, write, verify)


def copy(source: str | Path, target: str | Path, check: Callable[[Path], None] | None = None) -> Path | StorePath:
    return publish(target, lambda p: p.write_bytes(place(source).read_bytes()), check)


def put_in_place(spark: SparkSession, temp: str, path: str) -> None:
    """A whole new folder takes the old one's place; the old one goes last."""
    at = spark._jvm.org.apache.hadoop.fs.Path
    new, target, aside = at(str(temp)), at(str(path)), at(f"{path}.{uuid.uuid4().hex}.old")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target) and not fs.rename(target, aside):
        raise SinkError(f"{path} can't be put aside")
    if not fs.rename(new, target):
        if fs.exists(aside):
            fs.rename(aside, target)
        raise SinkError(f"{path} can't be renamed into place")
    if fs.exists(aside):
        fs.delete(aside, True)


def write_table(df: DataFrame, path: str, required: Sequence[str] = (), rows: int | None = None, fmt: str = "parquet") -> DataFrame:
    """A distributed table: written under a temporary name, counted and checked by reading back, then renamed.

    The path may be in any store that Spark writes to; renames go through its
    Hadoop file system, and the old table stays until the new one is whole.
    """
    spark = df.sparkSession
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path
    mark = uuid.uuid4().hex
    temp = at(f"{path}.{mark}.tmp")
    fs = temp.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        writer = df.write.format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(str(temp))
        back = spark.read.format(fmt).option("header", True).load(str(temp)) if fmt == "csv" else spark.read.format(fmt).load(str(temp))
        if missing := [c for c in required if c not in back.columns]:
            raise SinkError(f"{path} lacks {missing}")
        if rows is not None and (n := back.count()) != rows:
            raise SinkError(f"{path} has {n} rows, not {rows}")
        put_in_place(spark, f"{path}.{mark}.tmp", path)
    finally:
        if fs.exists(temp):
            fs.delete(temp, True)
    return spark.read.format(fmt).option("header", True).load(str(path)) if fmt == "csv" else spark.read.format(fmt).load(str(path))
