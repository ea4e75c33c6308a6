"""Small files of a run in any store that Spark's file systems reach, with the part of ``pathlib`` that runs need."""

from __future__ import annotations

import fnmatch
import io
import re
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path, PurePosixPath
from types import SimpleNamespace

from pyspark.sql import SparkSession

_SCHEME = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://")


class StorePath:
    """A path with a scheme, read and written through its Hadoop file system by the driver."""

    def __init__(self, uri: str) -> None:
        self.uri = uri.rstrip("/")

    def __str__(self) -> str:
        return self.uri

    def __repr__(self) -> str:
        return f"StorePath({self.uri!r})"

    def __truediv__(self, name: str | PurePosixPath) -> StorePath:
        return StorePath(f"{self.uri}/{name}")

    def __eq__(self, other: object) -> bool:
        return isinstance(other, StorePath) and other.uri == self.uri

    def __lt__(self, other: StorePath) -> bool:
        return self.uri < other.uri

    def __hash__(self) -> int:
        return hash(self.uri)

    @property
    def name(self) -> str:
        return self.uri.rsplit("/", 1)[1]

    @property
    def suffix(self) -> str:
        return PurePosixPath(self.name).suffix

    @property
    def parent(self) -> StorePath:
        return StorePath(self.uri.rsplit("/", 1)[0])

    def _at(self):
        """(JVM, file system, path)."""
        spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
        at = spark._jvm.org.apache.hadoop.fs.Path(self.uri)
        return spark._jvm, at.getFileSystem(spark._jsc.hadoopConfiguration()), at

    def is_absolute(self) -> bool:
        return True

    def absolute(self) -> StorePath:
        return self

    def exists(self) -> bool:
        _, fs, at = self._at()
        return fs.exists(at)

    def is_file(self) -> bool:
        _, fs, at = self._at()
        return fs.exists(at) and fs.getFileStatus(at).isFile()

    def is_dir(self) -> bool:
        _, fs, at = self._at()
        return fs.exists(at) and fs.getFileStatus(at).isDirectory()

    def stat(self) -> SimpleNamespace:
        _, fs, at = self._at()
        s = fs.getFileStatus(at)
        return SimpleNamespace(st_size=s.getLen(), st_mtime_ns=s.getModificationTime() * 1_000_000)

    def mkdir(self, parents: bool = True, exist_ok: bool = True) -> None:
        _, fs, at = self._at()
        fs.mkdirs(at)

    def read_bytes(self) -> bytes:
        jvm, fs, at = self._at()
        if not fs.exists(at):
            raise FileNotFoundError(self.uri)
        stream = fs.open(at)
        try:
            return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def read_text(self, encoding: str = "utf-8") -> str:
        return self.read_bytes().decode(encoding)

    def open(self, mode: str = "r", encoding: str = "utf-8", newline: str | None = None) -> io.IOBase:
        """The whole file, to be read; runs keep only small files so."""
        if mode not in ("r", "rb"):
            raise ValueError("files of a store are written whole")
        return io.BytesIO(self.read_bytes()) if mode == "rb" else io.StringIO(self.read_text(encoding), newline=newline)

    def glob(self, pattern: str) -> Iterator[StorePath]:
        _, fs, at = self._at()
        if fs.exists(at):
            for s in fs.listStatus(at):
                if fnmatch.fnmatch(s.getPath().getName(), pattern):
                    yield self / s.getPath().getName()

    def rglob(self, pattern: str) -> Iterator[StorePath]:
        """Files at any depth, named as below this path."""
        _, fs, at = self._at()
        root = fs.resolvePath(at).toUri().getPath()
        found = fs.listFiles(fs.resolvePath(at), True)
        while found.hasNext():
            path = found.next().getPath()
            if fnmatch.fnmatch(path.getName(), pattern):
                yield self / path.toUri().getPath()[len(root) :].lstrip("/")

    def relative_to(self, other: StorePath) -> PurePosixPath:
        return PurePosixPath(self.uri[len(other.uri) + 1 :])

    def take(self, local: Path) -> None:
        """A local file takes this path's place, first whole under another name."""
        jvm, fs, at = self._at()
        draft = jvm.org.apache.hadoop.fs.Path(f"{self.parent}/.{self.name}.{uuid.uuid4().hex}")
        try:
            fs.mkdirs(at.getParent())
            fs.copyFromLocalFile(False, True, jvm.org.apache.hadoop.fs.Path(local.as_uri()), draft)
            if fs.exists(at):
                fs.delete(at, False)
            if not fs.rename(draft, at):
                raise OSError(f"{self.uri} can't be renamed into place")
        finally:
            if fs.exists(draft):
                fs.delete(draft, False)


def place(path: str | Path | StorePath) -> Path | StorePath:
    """A local path, or one of a store where it has a scheme."""
    if isinstance(path, (Path, StorePath)):
        return path
    return StorePath(path) if _SCHEME.match(path) else Path(path)


def append(path: Path | StorePath, line: str) -> None:
    """Add a line to a small file; one of a store is written anew."""
    if isinstance(path, Path):
        with path.open("a", encoding="utf-8") as f:
            f.write(line)
        return
    with tempfile.TemporaryDirectory(prefix="siftwell-line-") as folder:
        local = Path(folder) / "all"
        local.write_bytes((path.read_bytes() if path.exists() else b"") + line.encode())
        path.take(local)
