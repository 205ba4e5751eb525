"""Atomic publishing of tables: versioned folders and a snapshot that readers resolve.

A transaction writes its files under folders of its own and touches no file that a
reader may hold. What makes them visible is one rename: a new file in
``_snapshots`` that lists, for every table and date, the folders to read. A run that
dies before that rename changes nothing; one that meets another's commit fails
instead of overwriting it. Folders that the last snapshots do not list are removed by
``vacuum``.

The snapshot has an entry for each table, date and folder, so the driver's share is
bounded by the calendar, not by the rows. A date that many loads have added to is
merged into one folder when it reaches ``MAX_FOLDERS``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_DATE = "none"  # the part of rows without a date
MAX_FOLDERS = 32
ROUTED_BYTES = "16MB"  # compressed rows that one task of a routed write sorts: envelopes are alike and many times as large in memory
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_FILES = "_snapshots"


class Conflict(RuntimeError):
    """Another transaction was committed since this one began."""


@dataclass(frozen=True)
class Snapshot:
    version: int = 0
    tables: dict[str, dict[str, list[str]]] = field(default_factory=dict)  # table -> date -> folders below the root
    schemas: dict[str, dict] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)


class Warehouse:
    """The tables below ``root``, any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, below: str):
        return self._hadoop.Path(f"{self.root}/{below}" if below else self.root)

    def _names(self, below: str) -> list[tuple[str, int]]:
        """(name, modification time in ms) of what lies in a folder."""
        path = self._path(below)
        if not self._fs.exists(path):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self._fs.listStatus(path)]

    def _leaves(self, folder: str) -> list[str]:
        """The date folders of a written folder, below its outcomes if it has any."""
        names = [n for n, _ in self._names(folder)]
        nested = [f"{n}/{leaf}" for n in names if n.startswith("_outcome=") for leaf in self._leaves(f"{folder}/{n}")]
        return [n for n in names if n.startswith("_part=")] + nested

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n, _ in self._names(_FILES) if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest snapshot, or the one asked for."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return Snapshot()
        text = self.spark.read.text(f"{self.root}/{_FILES}/{version:012d}.json", wholetext=True).first()[0]
        return Snapshot(**json.loads(text))

    def read(self, table: str, parts: Iterable[str] | None = None, snapshot: Snapshot | None = None,
             schema: T.StructType | None = None) -> DataFrame:
        """A table as one snapshot has it (the newest by default); with ``parts``, those
        dates alone are listed and read. ``schema`` serves a table never written."""
        snapshot = snapshot or self.snapshot()
        have = snapshot.tables.get(table, {})
        folders = [f for p in (have if parts is None else sorted(set(parts) & have.keys())) for f in have[p]]
        if table in snapshot.schemas:
            schema = T.StructType.fromJson(snapshot.schemas[table])
        elif schema is None:
            raise KeyError(f"no table {table!r} in version {snapshot.version}")
        return self._folders(folders, schema)

    def _folders(self, folders: list[str], schema: T.StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.root}/{f}" for f in folders))

    def begin(self) -> Transaction:
        return Transaction(self)

    def vacuum(self, keep: int = 2, min_age_hours: float = 24.0) -> list[str]:
        """Removes the snapshots before the last ``keep`` and the folders that none of those
        lists; younger folders may belong to a run at work and stay. Returns the folders."""
        versions = self.versions()
        listed = {f for v in versions[-keep:] for t in self.snapshot(v).tables.values() for fs in t.values() for f in fs}
        before = time.time() * 1000 - min_age_hours * 3_600_000
        for v in versions[:-keep]:
            self._fs.delete(self._path(f"{_FILES}/{v:012d}.json"), False)
        gone = []
        for table, _ in self._names(""):
            if table == _FILES:
                continue
            for run, changed in self._names(table):
                if changed > before:
                    continue
                folder = f"{table}/{run}"
                parts = [f"{folder}/{n}" for n in self._leaves(folder)]
                stale = [p for p in parts if p not in listed]
                if folder in listed or (parts and not stale):
                    continue
                stale = stale if len(stale) < len(parts) else [folder]
                for f in stale:
                    self._fs.delete(self._path(f), True)
                gone += stale
        return gone


class Transaction:
    """Writes against the snapshot it began with; nothing is visible until ``commit``."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse, self.base = warehouse, warehouse.snapshot()
        self.run = f"v{self.base.version + 1:012d}-{uuid.uuid4().hex[:8]}"
        self.tables = {t: {p: list(f) for p, f in parts.items()} for t, parts in self.base.tables.items()}
        self.schemas = dict(self.base.schemas)
        self.hook: Callable[[str], None] = lambda step: None  # called after each write (tests)

    def _now(self) -> Snapshot:
        return Snapshot(self.base.version, self.tables, self.schemas, self.base.notes)

    def read(self, table: str, parts: Iterable[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The table with what this transaction has written so far."""
        return self.warehouse.read(table, parts, self._now(), schema)

    def read_before(self, table: str, parts: Iterable[str] | None = None, schema: T.StructType | None = None) -> DataFrame:
        """The table as it was when the transaction began."""
        return self.warehouse.read(table, parts, self.base, schema)

    def parts(self, table: str) -> set[str]:
        return set(self.tables.get(table, {}))

    def _written(self, table: str, df: DataFrame, part: Column | None, cluster_by: tuple[str, ...], tag: str = "") -> dict[str, str]:
        """Folder of each date of ``df``, written in one pass: one hash by (date, cluster
        keys) whose skewed parts adaptive execution splits, sorted for row-group skipping."""
        folder = f"{table}/{tag}{self.run}-{uuid.uuid4().hex[:4]}"
        self.schemas[table] = json.loads(df.schema.json())
        if part is None:
            df.write.parquet(f"{self.warehouse.root}/{folder}")
            found = {"": folder}
        else:
            df = df.withColumn("_part", F.coalesce(part.cast("string"), F.lit(NO_DATE)))
            keys = ["_part", *cluster_by]
            df.hint("rebalance", *keys).sortWithinPartitions(*keys).write.partitionBy("_part").parquet(f"{self.warehouse.root}/{folder}")
            names = [n for n, _ in self.warehouse._names(folder) if n.startswith("_part=")]
            found = {n.removeprefix("_part="): f"{folder}/{n}" for n in names}
        self.hook(table)
        return found

    def replace(self, table: str, df: DataFrame, part: Column | None = None, parts: Iterable[str] | None = None,
                cluster_by: tuple[str, ...] = ("canonical_city",)) -> None:
        """The rows of the dates ``parts`` (by default the whole table) become those of ``df``."""
        found = self._written(table, df, part, cluster_by)
        have = self.tables.get(table, {})
        if parts is not None and (stray := found.keys() - set(parts)):
            raise ValueError(f"{table}: rows of dates that are not replaced: {sorted(stray)[:5]}")
        kept = {} if parts is None else {p: f for p, f in have.items() if p not in set(parts)}
        self.tables[table] = kept | {p: [f] for p, f in found.items()}

    def load(self, table: str, df: DataFrame, part: Column, load: str,
             cluster_by: tuple[str, ...] = ()) -> tuple[set[str], DataFrame]:
        """Adds the rows of a load, in place of what an earlier try of it wrote. Returns the
        dates that change and the rows that came or went."""
        return self._loaded(table, self._written(table, df, part, cluster_by, f"load={load}~"), load)

    def load_routed(self, df: DataFrame, routes: dict[str, tuple[str, list[str], Column]], load: str) -> dict[str, tuple[int, set[str], DataFrame]]:
        """Adds the rows of a load to several tables in one pass: ``routes`` names the table,
        columns and date of each value of ``outcome``. Returns for each (rows, dates that
        change, rows that came or went)."""
        part = F.lit(None).cast("string")
        for value, (_, _, date) in routes.items():
            part = F.when(F.col("outcome") == value, date.cast("string")).otherwise(part)
        folder = f"routed/load={load}~{self.run}-{uuid.uuid4().hex[:4]}"
        seen = Observation(folder)
        df = df.withColumn("_part", F.coalesce(part, F.lit(NO_DATE))).withColumn("_outcome", F.col("outcome")).drop("outcome")
        df = df.observe(seen, F.count(F.lit(1)).alias("all"), *(F.count_if(F.col("_outcome") == v).alias(v) for v in routes))
        conf = self.warehouse.spark.conf
        before = conf.get(_ADVISORY)
        conf.set(_ADVISORY, ROUTED_BYTES)
        try:
            df.hint("rebalance", "_outcome", "_part").write.partitionBy("_outcome", "_part").parquet(f"{self.warehouse.root}/{folder}")
        finally:
            conf.set(_ADVISORY, before)
        out = {}
        for value, (table, columns, _) in routes.items():
            self.schemas[table] = json.loads(df.select(*columns).schema.json())
            below = f"{folder}/_outcome={value}"
            found = {n.removeprefix("_part="): f"{below}/{n}" for n in self.warehouse._leaves(below)}
            out[value] = (int(seen.get[value]), *self._loaded(table, found, load))
        self.hook("routed")
        return out

    def _loaded(self, table: str, found: dict[str, str], load: str) -> tuple[set[str], DataFrame]:
        """Lists new folders of a load in place of its earlier ones."""
        schema = T.StructType.fromJson(self.schemas[table])
        have = self.tables.setdefault(table, {})
        old = {p: [f for f in folders if f.split("/")[1].startswith(f"load={load}~")] for p, folders in have.items()}
        old = {p: f for p, f in old.items() if f}
        for p, folders in old.items():
            have[p] = [f for f in have[p] if f not in folders]
        for p, folder in found.items():
            have.setdefault(p, []).append(folder)
        for p in [p for p, folders in have.items() if not folders]:
            del have[p]
        changed = [f for folders in old.values() for f in folders if f not in found.values()] + list(found.values())
        return set(old) | set(found), self.warehouse._folders(changed, schema)

    def replace_keys(self, table: str, df: DataFrame, part: Column, keys: list[str],
                     cluster_by: tuple[str, ...] = ()) -> set[str]:
        """Replaces, on the dates of ``df``, the rows of its (date, ``keys``) and keeps the
        others: one new folder for each date, however many keys it has. Returns the dates."""
        new = self._written(table, df, part, cluster_by)
        have = self.tables.setdefault(table, {})
        both = [p for p in new if have.get(p)]
        if both:  # copy on write, for the dates that had rows
            fresh = self.warehouse._folders([new[p] for p in both], df.schema)
            stored = self.warehouse._folders([f for p in both for f in have[p]], df.schema)
            named = fresh.select(part.alias("_d"), *(F.col(k).alias(f"_{k}") for k in keys)).distinct()
            same = part.eqNullSafe(F.col("_d"))
            for k in keys:
                same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
            new |= self._written(table, stored.join(named, same, "left_anti").unionByName(fresh), part, cluster_by)
        for p, folder in new.items():
            have[p] = [folder]
        return set(new)

    def merge_folders(self, table: str, part: Column, most: int = MAX_FOLDERS, cluster_by: tuple[str, ...] = ()) -> set[str]:
        """Rewrites the dates that lie in more than ``most`` folders into one folder each. The
        rows stay the same, but no later load can take the place of one merged here."""
        many = {p for p, folders in self.tables.get(table, {}).items() if len(folders) > most}
        if many:
            self.replace(table, self.read(table, many), part, many, cluster_by)
        return many

    def commit(self, notes: dict[str, str] | None = None) -> Snapshot:
        """Publishes all writes at once."""
        done = Snapshot(self.base.version + 1, self.tables, self.schemas, self.base.notes | (notes or {}))
        w = self.warehouse
        draft = w._path(f"{_FILES}/.draft-{uuid.uuid4().hex}")
        final = w._path(f"{_FILES}/{done.version:012d}.json")
        out = w._fs.create(draft, False)
        out.write(json.dumps(done.__dict__).encode())
        out.close()
        self.hook("commit")
        never = w.spark.sparkContext._gateway.new_array(w._hadoop.Options.Rename, 1)
        never[0] = getattr(w._hadoop.Options.Rename, "NONE")  # fails where the version exists
        try:
            w._hadoop.FileContext.getFileContext(w._fs.getUri(), w.spark._jsc.hadoopConfiguration()).rename(draft, final, never)
        except Exception as e:
            w._fs.delete(draft, False)
            if isinstance(e, PySparkException) or "FileAlreadyExists" not in str(e):
                raise
            raise Conflict(f"version {done.version} was published by another run") from e
        return done
