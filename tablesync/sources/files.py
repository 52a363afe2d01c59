"""Tables in folders whose files a manifest names, so that a change is there as a whole or not at all.

A folder without manifests is all its Parquet files. With manifests (``_manifests/<version>.json``) it is the files
that the last one names, with the schema that it has. A change writes new files beside the old ones and then one
manifest; a run that dies before that leaves the table as it was, and readers of the manifest never see part of a
change. ``done`` is kept in the manifest too, for the same reason: what a run or a stream has applied is marked by
the same step that makes it visible. Replaced files go once the manifest is there, so that a plain Parquet reader,
which lists the folder, sees the same rows again.

The next version's file is made by a rename that fails if it exists: of two runs that change one table at a time, the
later one fails. Manifests hold one short name a file.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FOLDER = "_manifests"


@dataclass(frozen=True)
class State:
    """A version of a table; version 0 is a folder without manifest."""

    version: int
    files: tuple[str, ...]
    schema: str | None = None
    done: dict[str, list[int]] = field(default_factory=dict)


class Folder:
    """A table's folder, in any file system that Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._fs = self._at().getFileSystem(self._conf)

    def _at(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, name: str = "") -> list[str]:
        at = self._at(name)
        return [f.getPath().getName() for f in self._fs.listStatus(at) if f.isFile()] if self._fs.exists(at) else []

    def exists(self) -> bool:
        return self._fs.exists(self._at())

    def is_folder(self) -> bool:
        return self.exists() and self._fs.getFileStatus(self._at()).isDirectory()

    def sizes(self) -> list[tuple[str, int]]:
        """(name, bytes) of the table's files, in the order of names."""
        return sorted((n, self._fs.getFileStatus(self._at(n)).getLen()) for n in self.state().files)

    def folders(self) -> list[str]:
        return sorted(f.getPath().getName() for f in self._fs.listStatus(self._at()) if f.isDirectory()) if self.exists() else []

    def delete(self) -> None:
        self._fs.delete(self._at(), True)

    def listed(self) -> set[str]:
        """Names of all data files, of this version or not."""
        return {n for n in self._names() if not n.startswith(("_", "."))}

    def versions(self) -> list[int]:
        if not self.is_folder():
            return []
        return sorted(int(n.removesuffix(".json")) for n in self._names(FOLDER) if n.removesuffix(".json").isdigit())

    def state(self) -> State:
        known = self.versions()
        if not known:
            return State(0, tuple(sorted(self.listed())))
        stream = self._fs.open(self._at(f"{FOLDER}/{known[-1]}.json"))
        try:
            own = json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return State(known[-1], tuple(own["files"]), own["schema"], own["done"])

    def read(self, state: State | None = None, only: list[str] | None = None) -> DataFrame:
        """The table, or ``only`` some of its files."""
        state = state or self.state()
        if not state.version and only is None:
            return self.spark.read.parquet(self.path)
        names = state.files if only is None else only
        kind = T.StructType.fromJson(json.loads(state.schema)) if state.schema else self.spark.read.parquet(self.path).schema
        if not names:
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).parquet(*(f"{self.path}/{n}" for n in names))

    def write(self, df: DataFrame) -> list[str]:
        """Adds files that no manifest names yet, and returns their names."""
        before = self.listed()
        df.write.mode("append").parquet(self.path)
        return sorted(self.listed() - before)

    def commit(self, base: State, files: list[str], schema: T.StructType, done: dict[str, list[int]] | None = None) -> State:
        """Makes ``files`` the table. Fails if another run has changed it since ``base``."""
        done = base.done if done is None else done
        new = State(base.version + 1, tuple(files), schema.json(), done)
        self._fs.mkdirs(self._at(FOLDER))
        draft = self._at(f"{FOLDER}/.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps({"files": list(new.files), "schema": new.schema, "done": done}).encode()))
        finally:
            out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        careful = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(self._at(f"{FOLDER}/{new.version}.json")), careful)
        except Exception as e:
            self._fs.delete(draft, False)
            raise RuntimeError(f"{self.path} was changed by another run") from e
        return new

    def drop(self, names: list[str]) -> None:
        """Deletes files that the last manifest no longer names, and older manifests."""
        state = self.state()
        for n in set(names) - set(state.files):
            self._fs.delete(self._at(n), False)
        for v in self.versions()[:-1]:
            self._fs.delete(self._at(f"{FOLDER}/{v}.json"), False)


#: A run's or stream's name, and numbers of its batches.
Mark = tuple[str, list[int]]


def marked(state: State, mark: Mark | None, alone: bool = False) -> dict[str, list[int]]:
    """``done`` of a state, with a mark added; ``alone``: marks of other runs go, as their rows do, those of streams stay."""
    if mark is None:
        return state.done
    name, batches = mark
    kept = {k: v for k, v in state.done.items() if not (alone and k.startswith("run:"))}
    return kept | {name: sorted({*state.done.get(name, []), *batches})}


def has(state: State, mark: Mark | None) -> bool:
    return mark is not None and set(mark[1]) <= set(state.done.get(mark[0], []))
