"""Registries (assets, aliases, indicators, signature maps) as versioned, bucketed snapshots.

A registry is global and changes a little at a time, so it is neither per-key streaming state nor one file to be
rewritten. Its rows lie in hash buckets of their key. A micro-batch writes new files for the buckets that its keys fall
in, and a manifest that names the current folder of every bucket; readers follow the newest manifest. The work of a batch
follows its own keys, not the size of the registry.

A version also names the query and the batch that wrote it: a replayed batch finds its own version and writes it again
from the same previous one, so a crash between write and commit does no harm, and a query with a new checkpoint, whose
batch ids start over, continues above the newest version. A version without a manifest is none. One writer at a time.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from logspark.operators.inventory import latest_by

KEPT = 3
BUCKETS = 64
NAME = re.compile(r"version=(\d+)_run=([^_]*)_batch=(\d+)")
BUCKET = "__bucket"

Combine = Callable[..., DataFrame]


@dataclass
class Manifest:
    """Folder of each bucket that has rows, numbers the writer keeps (``meta``), and how many buckets there are."""

    name: str = ""
    buckets: int = BUCKETS
    folders: dict[str, str] = field(default_factory=dict)
    meta: dict[str, int] = field(default_factory=dict)


class Registry:
    """Rows by the first column of ``schema``. ``buckets`` counts for a new registry; an old one keeps its number.

    A bucket is one task when it is rewritten, so their number follows the size that the registry will have.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, buckets: int = BUCKETS):
        self.spark, self.path, self.schema, self.buckets = spark, path.rstrip("/"), schema, buckets
        self.columns = spark.createDataFrame([], schema).columns

    def _path(self, *parts: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        path, fs = self._path(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _versions(self) -> list[tuple[int, str, int, bool, str]]:
        """(number, run, batch, complete, name) of each manifest, oldest first."""
        found = [NAME.fullmatch(n.removesuffix(".json")) for n in self._names("manifests") if n.endswith(".json")]
        return sorted((int(m[1]), m[2], int(m[3]), True, m[0]) for m in found if m)

    def manifest(self, before: int | None = None) -> Manifest:
        """The newest manifest, or the newest of a version below ``before``; an empty one when there is none."""
        found = [name for n, *_, name in self._versions() if before is None or n < before]
        if not found:
            return Manifest(buckets=self.buckets)
        path, fs = self._path("manifests", f"{found[-1]}.json")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Manifest(**json.loads(text))

    def _run(self) -> str:
        return (self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch").replace("_", "-")

    def newest(self) -> int:
        return max([n for n, *_ in self._versions()], default=0)

    def number(self, batch_id: int) -> int:
        """The version that a batch of the running query writes: its own if it has one already, else the next."""
        own = [n for n, r, b, *_ in self._versions() if (r, b) == (self._run(), batch_id)]
        return own[0] if own else self.newest() + 1

    def _commit(self, manifest: Manifest) -> None:
        """Written aside and renamed, so that a reader sees all of it or nothing."""
        aside, fs = self._path("manifests", f"_{manifest.name}")
        final, _ = self._path("manifests", f"{manifest.name}.json")
        stream = fs.create(aside, True)
        try:
            stream.write(bytearray(json.dumps(manifest.__dict__).encode()))
        finally:
            stream.close()
        fs.delete(final, False)
        fs.rename(aside, final)

    def rows(self, manifest: Manifest, only: list[str] | None = None) -> DataFrame:
        """Rows of a manifest, all or those of some buckets."""
        picked = [b for b in manifest.folders if only is None or b in set(only)]
        if not picked:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/data/{manifest.folders[b]}/state/{BUCKET}={b}" for b in picked]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self, before: int | None = None) -> DataFrame:
        """The newest version, or the newest one below number ``before``; empty when there is none."""
        return self.rows(self.manifest(before))

    def touching(self, keys: DataFrame, manifest: Manifest | None = None) -> DataFrame:
        """Rows of the buckets that ``keys`` (first column) fall in: all that a look-up of them needs to read."""
        manifest = manifest or self.manifest()
        hit = keys.select(self._bucket(keys.columns[0], manifest)).distinct().collect()
        return self.rows(manifest, [str(r[0]) for r in hit])

    def _bucket(self, key: str, manifest: Manifest):
        kind = self.spark.createDataFrame([], self.schema).schema[0].dataType
        return F.pmod(F.xxhash64(F.col(f"`{key}`").cast(kind)), F.lit(manifest.buckets)).cast("int").alias(BUCKET)

    def _place(self, df: DataFrame, manifest: Manifest, path: str, tasks: int | None) -> list[str]:
        """Write rows by bucket; the buckets that got any."""
        placed = df.select("*", self._bucket(self.columns[0], manifest))
        if tasks:
            placed = placed.repartition(tasks, BUCKET)
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/{path}")
        return [n.split("=")[1] for n in self._names(path) if n.startswith(f"{BUCKET}=")]

    def update(
        self, batch: DataFrame, batch_id: int, combine: Combine, meta: Callable[[DataFrame, dict], dict] | None = None
    ) -> DataFrame:
        """Write the version of ``batch_id`` and return it as read back.

        ``combine(previous, batch)`` gets the rows of the buckets that the batch's keys fall in, and must treat each key
        by itself. With ``meta`` it also gets the numbers of the version before, and ``meta(new rows of these buckets,
        those numbers)`` gives the numbers that this version keeps. The batch is written once, first, so its own plan
        runs once. A batch without rows writes no version.
        """
        number = self.number(batch_id)
        before = self.manifest(number)
        name = f"version={number:012d}_run={self._run()}_batch={batch_id}"
        touched = self._place(batch, before, f"data/{name}/delta", None)
        if not touched:
            path, fs = self._path("data", name, "delta")
            fs.delete(path, True)
            return self.read(before=number + 1)
        delta = self.spark.read.schema(batch.schema).parquet(f"{self.path}/data/{name}/delta").select(*batch.columns)
        previous = self.rows(before, touched)
        state = (combine(previous, delta, before.meta) if meta else combine(previous, delta)).select(*self.columns)
        full = self._place(state, before, f"data/{name}/state", len(touched))
        folders = {b: f for b, f in before.folders.items() if b not in touched} | {b: name for b in full}
        after = Manifest(name, before.buckets, folders, before.meta)
        if meta:
            after.meta = meta(self.rows(after, touched), before.meta)
        self._commit(after)
        self._drop_old(number)
        return self.rows(after)

    def difference(self, before: int, ignored: list[str] | None = None) -> DataFrame:
        """Rows that the newest version has and version ``before`` had not, looked at without the ``ignored`` columns.

        Only buckets that lie in other folders now are read.
        """
        old, new = self.manifest(before + 1), self.manifest()
        moved = [b for b, folder in new.folders.items() if old.folders.get(b) != folder]
        columns = [c for c in self.columns if c not in (ignored or [])]
        return self.rows(new, moved).select(*columns).exceptAll(self.rows(old, moved).select(*columns))

    def _drop_old(self, newest: int) -> None:
        """Keep the last manifests and the folders that they name."""
        done = [v for v in self._versions() if v[0] <= newest]
        for number, *_, name in done[:-KEPT]:
            path, fs = self._path("manifests", f"{name}.json")
            fs.delete(path, False)
        live = set()
        for number, *_ in done[-KEPT:]:
            kept = self.manifest(number + 1)
            live |= {kept.name, *kept.folders.values()}
        for name in self._names("data"):
            part = NAME.fullmatch(name)
            if part and int(part[1]) <= newest and name not in live:
                path, fs = self._path("data", name)
                fs.delete(path, True)


def first_wins(previous: DataFrame, batch: DataFrame) -> DataFrame:
    """Asset index merge: a key once claimed keeps its record."""
    kept = batch.join(previous.select("key"), "key", "left_anti")
    return previous.unionByName(kept.select(*previous.columns))


def last_wins(key: str, order: str) -> Combine:
    """Latest row per key over previous state and batch."""
    def combine(previous: DataFrame, batch: DataFrame) -> DataFrame:
        rows = previous.unionByName(batch.select(*previous.columns))
        return latest_by(rows, key, order).select(*previous.columns)

    return combine


def retractable(previous: DataFrame, batch: DataFrame) -> DataFrame:
    """A set that keys enter and leave: a batch row (key, …, ``present``) puts its key in or takes it out.

    One row per key and batch.
    """
    key = previous.columns[0]
    kept = previous.join(batch.select(key), key, "left_anti")
    return kept.unionByName(batch.filter("present").select(*previous.columns))
