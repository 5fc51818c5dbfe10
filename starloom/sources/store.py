"""Published warehouse versions on plain Parquet.

Each load writes its tables under fresh folders; publishing appends one small commit to the log.  A reader follows the
newest commit, so it sees all tables of a load or none, and a crash before the commit leaves the previous version live.
One writer at a time is assumed, as with a single scheduled load.

A table is either one folder or laid out in parts (years, key buckets).  Of a table in parts the log holds one entry per
part with its rows and a digest of them, so a load writes the parts that differ and takes the others over as they are.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Collection, Iterator, Mapping
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOG = (
    "version LONG, table_name STRING, path STRING, layout STRING, part LONG, n_rows LONG, digest STRING, status STRING,"
    " stream STRING, batch_id LONG, fingerprint STRING, note STRING, recorded_at TIMESTAMP"
)
_LOAD = "carga"  # folder level below a part that names the write of a load
CODEC = "zstd"  # of the tables; readers find it in the files


@dataclass(frozen=True)
class Origin:
    """The streaming batch a version comes from; stored in the same commit, so a replayed batch is recognised."""

    stream: str
    batch_id: int
    fingerprint: str


@dataclass(frozen=True)
class Layout:
    """How a table is cut into parts: a folder column and the SQL expression of its (LONG) value."""

    column: str
    expression: str

    @classmethod
    def by_year(cls, key: str) -> "Layout":
        """By the year of a date key."""
        return cls("parte_anio", f"{key} div 10000")

    @classmethod
    def by_bucket(cls, key: str, buckets: int) -> "Layout":
        return cls("parte_cubo", f"pmod(xxhash64({key}), {buckets})")

    @classmethod
    def parse(cls, text: str) -> "Layout":
        return cls(*text.split("=", 1))

    def text(self) -> str:
        return f"{self.column}={self.expression}"

    def part(self) -> Column:
        """The part of a row; a row without one is in part -1."""
        return F.coalesce(F.expr(self.expression).cast("long"), F.lit(-1))


@dataclass(frozen=True)
class Part:
    path: str
    n_rows: int
    digest: str


@dataclass(frozen=True)
class Stored:
    """Where a published table is: one folder, or the folders of its parts."""

    path: str | None = None
    layout: Layout | None = None
    parts: Mapping[int, Part] = field(default_factory=dict)


@dataclass(frozen=True)
class Change:
    """What a write did to a table in parts."""

    written: frozenset[int]
    gone: frozenset[int]
    untouched: frozenset[int]


class WarehouseStore:
    """Versioned tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        spark.createDataFrame([], _LOG).write.mode("ignore").parquet(f"{self.root}/log")

    def log(self) -> DataFrame:
        """All commits; empty before the first."""
        return self.spark.read.schema(_LOG).parquet(f"{self.root}/log")

    def version(self) -> int:
        """Newest published version, 0 before the first."""
        return self.log().where("status = 'published'").agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]

    def paths(self, version: int | None = None) -> dict[str, Stored]:
        """Tables of a version; one log row per table or part."""
        version = self.version() if version is None else version
        if version == 0:
            return {}
        rows = self.log().where((F.col("status") == "published") & (F.col("version") == version))
        found: dict[str, Stored] = {}
        for r in rows.select("table_name", "path", "layout", "part", "n_rows", "digest").collect():
            if r["layout"] is None:
                found[r["table_name"]] = Stored(r["path"])
                continue
            table = found.setdefault(r["table_name"], Stored(None, Layout.parse(r["layout"]), {}))
            table.parts[r["part"]] = Part(r["path"], r["n_rows"], r["digest"])
        return found

    def parts_folder(self, name: str) -> str:
        return f"{self.root}/parts/{name}"

    def tables(self, version: int | None = None) -> "PublishedTables":
        """Published tables by name."""
        return PublishedTables(self.spark, self.paths(version))

    def last_batch(self, stream: str) -> int:
        """Number of the newest batch of a stream on record, -1 before the first."""
        rows = self.log().where(F.col("stream") == stream)
        return rows.agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]

    def last_fingerprint(self, stream: str) -> str | None:
        """Fingerprint of the snapshot of a stream handled last, whether it was loaded or refused."""
        rows = self.log().where(F.col("fingerprint").isNotNull() & (F.col("stream") == stream))
        return rows.agg(F.max_by("fingerprint", F.struct("recorded_at", "batch_id"))).first()[0]

    def open_load(self) -> "Load":
        return Load(self)

    def record(self, rows: list[tuple]) -> None:
        """Append one commit: a single file, so that it is visible as a whole."""
        entries = self.spark.createDataFrame(rows, _LOG.replace(", recorded_at TIMESTAMP", ""))
        entries.withColumn("recorded_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.root}/log")

    def reject(self, stream: str, batch_id: int, fingerprint: str, note: str) -> None:
        """Put a refused snapshot on record; the published version stays."""
        self.record([(self.version(), None, None, None, None, None, None, "rejected", stream, batch_id, fingerprint, note)])


def _open_parts(spark: SparkSession, stored: Stored, parts: Collection[int] | None = None) -> DataFrame:
    """Rows of a table in parts, with the folder columns; with ``parts`` only the folders of these are listed.  Parts taken
    over from another store lie below a folder of their own."""
    chosen = [p.path for n, p in sorted(stored.parts.items()) if parts is None or n in parts]
    none = not chosen
    bases: dict[str, list[str]] = {}
    for path in chosen or [next(iter(stored.parts.values())).path]:
        bases.setdefault(path.rsplit("/", 2)[0], []).append(path)
    frames = [spark.read.option("basePath", base).parquet(*paths) for base, paths in bases.items()]
    df = reduce(DataFrame.unionByName, frames)
    return df.limit(0) if none else df


class PublishedTables(Mapping[str, DataFrame]):
    """The tables of one version; a table is opened when it is asked for, so a report touches only what it reads."""

    def __init__(self, spark: SparkSession, paths: Mapping[str, Stored]):
        self._spark, self._paths = spark, paths
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            stored = self._paths[name]
            if stored.layout is None:
                self._open[name] = self._spark.read.parquet(stored.path)
            else:
                self._open[name] = _open_parts(self._spark, stored).drop(stored.layout.column, _LOAD)
        return self._open[name]

    def between(self, name: str, column: str, low: int, high: int) -> DataFrame:
        """Rows with ``column`` in a range of date keys.  Where the table is laid out by the year of that column, the range
        becomes a filter on the folders as well."""
        stored = self._paths[name]
        inside = F.col(column).between(low, high)
        if stored.layout != Layout.by_year(column):
            return self[name].where(inside)
        years = F.col(stored.layout.column).between(low // 10000, high // 10000)
        return _open_parts(self._spark, stored).where(years & inside).drop(stored.layout.column, _LOAD)

    def only(self, name: str, parts: Collection[int]) -> DataFrame:
        """Rows of some parts of a table; no other folder is read."""
        stored = self._paths[name]
        return _open_parts(self._spark, stored, set(parts)).drop(stored.layout.column, _LOAD)

    def layout(self, name: str) -> Layout | None:
        return self._paths[name].layout

    def parts(self, name: str) -> Mapping[int, Part]:
        return self._paths[name].parts

    def __iter__(self) -> Iterator[str]:
        return iter(self._paths)

    def __len__(self) -> int:
        return len(self._paths)


class VersionMoved(RuntimeError):
    """Another load published since this one was opened."""


def part_digests(df: DataFrame, layout: Layout) -> dict[int, tuple[int, str]]:
    """Rows and digest per part: two 64-bit hashes of every row (names of the columns in order, NULL told from absence),
    summed as decimals, so that neither order nor repetition is lost.  One partial aggregation; as many rows as parts."""
    cells = [c for name in sorted(df.columns) for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    sums = [F.sum(F.xxhash64(F.lit(seed), *cells).cast("decimal(20,0)")).cast("string") for seed in (1, 2)]
    found = df.groupBy(layout.part().alias("_part")).agg(F.count(F.lit(1)).alias("n"), F.concat_ws("/", *sums).alias("d"))
    return {r["_part"]: (r["n"], r["d"]) for r in found.collect()}


class Load:
    """Tables of one unpublished version."""

    def __init__(self, store: WarehouseStore):
        self.store = store
        self.version = store.version() + 1
        self.previous = store.paths(self.version - 1)
        self.before = PublishedTables(store.spark, self.previous)
        self.tag = uuid.uuid4().hex
        self.folder = f"{store.root}/data/{self.tag}"
        self.written: dict[str, Stored] = {}
        self._writes = itertools.count()

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """Write one table as a whole and read it back."""
        path = f"{self.folder}/{name}"
        df.write.option("compression", CODEC).parquet(path)
        self.written[name] = Stored(path)
        return self.store.spark.read.schema(df.schema).parquet(path)

    def adopt(self, tables: Mapping[str, Stored]) -> None:
        """Take tables of another version, or of another store, as they are."""
        self.written.update(tables)

    def _write_parts(self, name: str, df: DataFrame, layout: Layout) -> dict[int, Part]:
        """Write rows below their parts.  The rebalance keeps a large part over many tasks and small files away."""
        base, tag = self.store.parts_folder(name), f"c{self.tag}{next(self._writes)}"
        seen = Observation(f"{name}-rows")
        placed = df.observe(seen, F.count(F.lit(1)).alias("n"))
        placed = placed.withColumn(layout.column, layout.part()).withColumn(_LOAD, F.lit(tag))
        placed.hint("rebalance", layout.column).write.mode("append").option("compression", CODEC).partitionBy(
            layout.column, _LOAD).parquet(base)
        try:
            written = seen.get["n"]
        except Py4JJavaError:  # adaptive execution found the plan empty and took the observation out
            written = 0
        if not written:
            return {}
        fresh = self.store.spark.read.option("basePath", base).parquet(f"{base}/*/{_LOAD}={tag}")
        digests = part_digests(fresh.select(*df.columns), layout)
        return {p: Part(f"{base}/{layout.column}={p}/{_LOAD}={tag}", n, d) for p, (n, d) in digests.items()}

    def write_changed(self, name: str, df: DataFrame, layout: Layout, observed: DataFrame | None = None) -> Change:
        """Make ``df`` the state of a table in parts, writing the parts that differ from the previous version only.

        ``observed``, if given, is the same rows under observations; it is the frame that every row passes once.  On a
        table that is new, or laid out anew, all parts are written and digested from what was written.  Otherwise the
        digests are computed first and the rows are computed again for the parts that differ.
        """
        before = self.previous.get(name)
        first = df if observed is None else observed
        if before is None or before.layout != layout:
            parts = self._write_parts(name, first, layout)
            if not parts:
                self.write(name, df)  # a folder with the columns and no rows
                return Change(frozenset(), frozenset(), frozenset())
            self.written[name] = Stored(None, layout, parts)
            return Change(frozenset(parts), frozenset(), frozenset())
        now = part_digests(first, layout)
        differ = [p for p, found in now.items() if p not in before.parts or found != (before.parts[p].n_rows, before.parts[p].digest)]
        gone = frozenset(before.parts) - frozenset(now)
        if not now:
            self.write(name, df)
            return Change(frozenset(), gone, frozenset())
        fresh = self._write_parts(name, df.where(layout.part().isin(differ)), layout) if differ else {}
        kept = {p: part for p, part in before.parts.items() if p in now and p not in fresh}
        self.written[name] = Stored(None, layout, {**kept, **fresh})
        return Change(frozenset(fresh), gone, frozenset(kept))

    def replace_parts(self, name: str, df: DataFrame, parts: Collection[int]) -> Change:
        """Make ``df`` the content of ``parts`` of a table; its other parts stay as this load has left them.  Rows of other
        parts are an error."""
        layout, before = self.previous[name].layout, self.written.get(name, self.previous[name])
        fresh = self._write_parts(name, df, layout)
        if not set(fresh) <= set(parts):
            raise ValueError(f"{name}: rows outside the parts to be replaced")
        kept = {p: part for p, part in before.parts.items() if p not in parts}
        if not kept and not fresh:
            self.write(name, df)
        else:
            self.written[name] = Stored(None, layout, {**kept, **fresh})
        return Change(frozenset(fresh), frozenset(set(parts) & set(before.parts)) - frozenset(fresh), frozenset(kept))

    def table(self, name: str) -> DataFrame:
        """A table as this load leaves it."""
        return PublishedTables(self.store.spark, {**self.previous, **self.written})[name]

    def state(self) -> PublishedTables:
        """All tables as this load leaves them."""
        return PublishedTables(self.store.spark, {**self.previous, **self.written})

    def publish(self, origin: "Origin | None" = None) -> int:
        """Make the written tables, plus the untouched ones of the previous version, the current version."""
        if self.store.version() != self.version - 1:
            raise VersionMoved(f"version {self.version} was published by another load; this one must start again")
        stream, batch_id, fingerprint = (origin.stream, origin.batch_id, origin.fingerprint) if origin else (None,) * 3
        tail = ("published", stream, batch_id, fingerprint, None)
        rows: list[tuple] = []
        for name, stored in sorted({**self.previous, **self.written}.items()):
            if stored.layout is None:
                rows.append((self.version, name, stored.path, None, None, None, None, *tail))
            for p, part in sorted(stored.parts.items()):
                rows.append((self.version, name, part.path, stored.layout.text(), p, part.n_rows, part.digest, *tail))
        self.store.record(rows)
        return self.version


def sweep(store: WarehouseStore, older_than_seconds: float) -> list[str]:
    """Delete folders that no published version reaches and that are older than the grace period; returns them.

    Loads that were given up leave such folders.  The log is the root: everything it names as published stays, whatever
    the version.  The grace period must exceed the longest load, whose folders no commit names yet.
    """
    spark = store.spark
    live = {r["path"] for r in store.log().where("status = 'published'").select("path").distinct().collect()}
    # The file system's own listing, through the session: it knows every path that Spark can read.
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(store.root)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    live = {fs.makeQualified(jvm.org.apache.hadoop.fs.Path(p)).toString() for p in live}
    limit = jvm.System.currentTimeMillis() - int(older_than_seconds * 1000)
    removed: list[str] = []
    for pattern in ("data/*/*", f"parts/*/*/{_LOAD}=*"):
        for status in fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, pattern)) or []:
            path = status.getPath().toString()
            if path not in live and status.getModificationTime() <= limit:
                fs.delete(status.getPath(), True)
                removed.append(path)
    return removed
