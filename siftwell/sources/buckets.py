"""Tables in hash buckets of a key, sorted within each.

Two such tables with as many buckets are joined, and one is grouped, by the key
without an exchange. As a row's bucket follows from its key alone, the files of
some buckets can be read, or written anew, without the others.

``_layout.json`` beside the files tells key, number of buckets and schema.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siftwell.sources.sinks import SinkError, put_in_place

#: Rows that a bucket should hold, and the fewest buckets of a table.
BUCKET_ROWS, LEAST_BUCKETS = 100_000, 8
LAYOUT = "_layout.json"
_FILE = re.compile(r"_(\d+)(?:\..*)?$")


def buckets_for(rows: int, now: int | None = None) -> int:
    """How many buckets a table of ``rows`` rows should have; ``now`` stays as long as it is within a factor of two."""
    want = max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))
    return now if now and want <= 2 * now and now <= 2 * want else want


def bucket_of(key: Column | str, buckets: int) -> Column:
    """The bucket that the writer puts a key into."""
    return F.pmod(F.hash(key), F.lit(buckets))


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def layout(spark: SparkSession, path: str) -> dict | None:
    """Key, number of buckets and schema of a table; null where ``path`` holds no such table."""
    fs, at = _fs(spark, f"{path}/{LAYOUT}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _files(spark: SparkSession, path: str) -> dict[int, list[str]]:
    """The files of each bucket that has any."""
    fs, at = _fs(spark, path)
    out: dict[int, list[str]] = {}
    for f in fs.listStatus(at):
        name = f.getPath().getName()
        if not name.startswith(("_", ".")):
            out.setdefault(int(_FILE.search(name.removesuffix(".parquet")).group(1)), []).append(f.getPath().toString())
    return out


def read(spark: SparkSession, path: str, only: Collection[int] | None = None) -> DataFrame:
    """The table, or the rows of some of its buckets, whose files alone are read."""
    told = layout(spark, path)
    if told is None:
        raise SinkError(f"{path} is no bucketed table")
    schema = StructType.fromJson(told["schema"])
    if only is not None:
        files = [f for b, names in _files(spark, path).items() if b in set(only) for f in names]
        return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    name = f"siftwell_{hashlib.sha256(str(path).encode()).hexdigest()[:24]}"
    columns = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(json.dumps(told["schema"])).toDDL()
    where = str(path).replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{told['key']}`) SORTED BY (`{told['key']}`) INTO {told['buckets']} BUCKETS LOCATION '{where}'")
    return spark.table(name)


def write(df: DataFrame, path: str, key: str, buckets: int, required: Sequence[str] = (), rows: int | None = None, only: Collection[int] | None = None) -> int:
    """Write a table, or anew those buckets of it that ``only`` names; the number of buckets written.

    ``df`` then has the rows of these buckets and no others. The new files are
    made aside and checked; the other buckets' files, untouched, join them before
    the table takes its place. A run that is stopped in between is one whose
    stage has not completed: it writes all buckets again.
    """
    spark = df.sparkSession
    mark = uuid.uuid4().hex
    temp, name = f"{path}.{mark}.tmp", f"siftwell_{mark}"
    fs, temp_at = _fs(spark, temp)
    if only is not None and (layout(spark, path) or {}).get("buckets") != buckets:
        raise SinkError(f"{path} has other buckets")
    try:
        df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", temp).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")
        out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{temp}/{LAYOUT}"))
        out.write(json.dumps({"key": key, "buckets": buckets, "schema": json.loads(df.schema.json())}).encode())
        out.close()
        if missing := [c for c in required if c not in df.columns]:
            raise SinkError(f"{path} lacks {missing}")
        if only is not None:
            if odd := set(_files(spark, temp)) - set(only):
                raise SinkError(f"{path}: rows of other buckets: {sorted(odd)[:5]}")
            for b, names in _files(spark, path).items():
                for f in names if b not in set(only) else ():
                    _, old = _fs(spark, f)
                    fs.rename(old, spark._jvm.org.apache.hadoop.fs.Path(f"{temp}/{old.getName()}"))
        if rows is not None and (n := read(spark, temp, range(buckets)).count()) != rows:
            raise SinkError(f"{path} has {n} rows, not {rows}")
        put_in_place(spark, temp, path)
    finally:
        if fs.exists(temp_at):
            fs.delete(temp_at, True)
    return buckets if only is None else len(set(only))


def marks(df: DataFrame, key: str, value: Column, buckets: int) -> dict[str, list]:
    """What each bucket holds, whatever the order of its rows: count, sum and parity of a hash of ``value``, one row a bucket."""
    h = F.xxhash64(F.col(key), value)
    rows = df.groupBy(bucket_of(key, buckets).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")).collect()
    return {str(r["b"]): [r["n"], str(r["s"]), r["x"]] for r in rows}


def changed(before: dict[str, list], after: dict[str, list]) -> list[int]:
    """Buckets that differ between two tables' marks."""
    return sorted(int(b) for b in before.keys() | after.keys() if before.get(b) != after.get(b))
