"""Tables that are replaced and extended without a moment in which they are half there.

A store is a folder. A change writes its tables into a version folder of its own; a
small numbered commit file, created last and only if no other has its number, says
which folders make up each table. Readers follow the last commit, so a change that
fails or is killed leaves everything as it was, and a table may be replaced by a
result that reads it.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterism.functions.columns import quoted
from asterism.operators.events import with_surrogate_id
from asterism.session import scratch_path

COMMITS, VERSIONS = "_commits", "versions"
#: Rows of a delta whose keys are broadcast to the stored table; more meet it by shuffle.
MAX_BROADCAST_ROWS = 200_000


class ConflictError(RuntimeError):
    """Another change was committed since this one began."""


class Store:
    """Versioned Parquet tables under ``root``, on whatever file system it is."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, relative: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{relative}")

    def _fs(self):
        return self._path(COMMITS).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, relative: str) -> list:
        fs, path = self._fs(), self._path(relative)
        return list(fs.listStatus(path)) if fs.exists(path) else []

    def commits(self) -> list[int]:
        """The numbers of all commits."""
        names = [s.getPath().getName() for s in self._listed(COMMITS)]
        return sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"[0-9]+\.json", n))

    def tables(self, number: int | None = None) -> dict[str, list[str]]:
        """The folders of each table, as the last commit (or the given one) says; none before the first."""
        for n in [number] if number is not None else reversed(self.commits()):
            lines = [r[0] for r in self.spark.read.text(f"{self.root}/{COMMITS}/{n:012d}.json").collect()]
            if lines and lines[-1] == "end":  # else its writer was killed
                return json.loads(lines[0])
        return {}

    def read(self, name: str, number: int | None = None) -> DataFrame:
        """A table as of the last commit (or the given one)."""
        tables = self.tables(number)
        if name not in tables:
            raise KeyError(f"no table {name} in {self.root}")
        return self.spark.read.parquet(*[f"{self.root}/{folder}" for folder in tables[name]])

    def change(self) -> Change:
        """A new change, to be committed or dropped."""
        return Change(self)

    def vacuum(self, keep: int = 2, older_than: float = 24 * 3600) -> int:
        """Remove the version folders that none of the last ``keep`` commits uses; the number removed.

        Folders younger than ``older_than`` seconds stay, as a change that isn't committed
        yet may be writing them.
        """
        used = {folder.split("/")[1] for n in self.commits()[-keep:] for folders in self.tables(n).values() for folder in folders}
        removed, fs = 0, self._fs()
        for status in self._listed(VERSIONS):
            old = status.getModificationTime() / 1000 <= time.time() - older_than
            if old and status.getPath().getName() not in used:
                removed += fs.delete(status.getPath(), True)
        return removed


class Change:
    """Tables written but not yet seen. As a context manager it commits at its end, and drops what it wrote on an error."""

    def __init__(self, store: Store) -> None:
        self.store, self.base = store, store.commits()
        self.tables = store.tables()
        self.folder = f"{VERSIONS}/{uuid.uuid4().hex}"

    def __enter__(self) -> Change:
        return self

    def __exit__(self, kind, *_) -> None:
        self.commit() if kind is None else self.drop()

    def path(self, name: str) -> str:
        """Where this change keeps a table of that name."""
        return f"{self.store.root}/{self.folder}/{name}"

    def replace(self, name: str, df: DataFrame, write: Callable[[DataFrame, str], None] | None = None) -> DataFrame:
        """Replace a table (or create it) by ``df``, which may read the table; the new rows, read back.

        ``write(df, path)`` lays the files out (default: as they come).
        """
        (write or (lambda rows, path: rows.write.parquet(path)))(df, self.path(name))
        self.tables[name] = [f"{self.folder}/{name}"]
        return self.store.spark.read.parquet(self.path(name))

    def insert(self, name: str, df: DataFrame) -> DataFrame:
        """Append rows to a table: columns bind by position and take the table's names and types.

        A value that doesn't fit its column's type fails, as does another number of columns.
        The table's files aren't touched. Returns the rows inserted, read back.
        """
        spark = self.store.spark
        stored = spark.read.parquet(*[f"{self.store.root}/{folder}" for folder in self.tables[name]])
        if len(df.columns) != len(stored.columns):
            raise ValueError(f"{name} has {len(stored.columns)} columns, not {len(df.columns)}")
        bound = df.toDF(*[f"_{k}" for k in range(len(df.columns))])
        part = f"{name}-{uuid.uuid4().hex[:8]}"
        bound.select(*[F.col(f"_{k}").cast(f.dataType).alias(f.name) for k, f in enumerate(stored.schema.fields)]).write.parquet(self.path(part))
        self.tables[name] = [*self.tables[name], f"{self.folder}/{part}"]
        return spark.read.parquet(self.path(part))

    def insert_new(self, name: str, delta: DataFrame, id_col: str, order_by: Sequence[str] | None = None) -> DataFrame:
        """Append the distinct rows of ``delta`` that the table doesn't hold yet, with running ids.

        ``delta`` has the table's columns but ``id_col``, by position. Rows are the same if all
        these columns are, NULLs included. New rows are numbered in ``order_by`` (default: all
        columns) from the largest stored id on, so ids given before never change, and loading
        in parts gives the rows of loading at once. The delta's keys are broadcast to the table,
        up to MAX_BROADCAST_ROWS, so that the table isn't shuffled. Returns the rows inserted.
        """
        spark = self.store.spark
        stored = spark.read.parquet(*[f"{self.store.root}/{folder}" for folder in self.tables[name]])
        fields = [f for f in stored.schema.fields if f.name != id_col]
        if len(delta.columns) != len(fields):
            raise ValueError(f"{name} has {len(fields)} columns besides {id_col}, not {len(delta.columns)}")
        bound = delta.toDF(*[f"_{k}" for k in range(len(fields))])
        at = scratch_path(spark, "delta")
        bound.select(*[F.col(f"_{k}").cast(f.dataType).alias(f.name) for k, f in enumerate(fields)]).distinct().write.parquet(at)
        rows, names = spark.read.parquet(at), [f.name for f in fields]
        same = lambda a, b: [F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`")) for c in names]
        keys = F.broadcast(rows) if rows.count() <= MAX_BROADCAST_ROWS else rows
        held = stored.select(*[quoted(c) for c in names]).alias("s").join(keys.alias("d"), same("s", "d"), "left_semi").distinct()
        new = rows.alias("d").join(held.alias("h"), same("d", "h"), "left_anti")
        last = stored.agg(F.max(quoted(id_col))).first()[0] or 0
        numbered = with_surrogate_id(new, id_col, list(order_by or names))
        shifted = numbered.withColumn(id_col, quoted(id_col) + F.lit(last))
        return self.insert(name, shifted.select(*[quoted(c) for c in stored.columns]))

    def commit(self) -> int:
        """Make all tables of this change seen at once; the commit's number. Fails if another was first."""
        if self.store.commits() != self.base:
            raise ConflictError(f"{self.store.root} was changed meanwhile")
        number = (self.base or [0])[-1] + 1
        fs, path = self.store._fs(), self.store._path(f"{COMMITS}/{number:012d}.json")
        try:
            out = fs.create(path, False)  # refuses where the file is there already
        except Exception as e:
            raise ConflictError(f"{self.store.root} was changed meanwhile") from e
        out.write(bytearray(f"{json.dumps(self.tables)}\nend\n".encode()))
        out.close()
        self.base = [*self.base, number]
        return number

    def drop(self) -> None:
        """Remove what this change wrote."""
        self.store._fs().delete(self.store._path(self.folder), True)


def read_all(store: Store, names: Iterable[str]) -> dict[str, DataFrame]:
    """Several tables as of one and the same commit."""
    numbers = store.commits()
    return {name: store.read(name, numbers[-1]) for name in names}
