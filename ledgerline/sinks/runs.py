"""Runs of the layered sink: manifests, publish records, retention.

``<root>/runs/<run>/<layer>/<table>``   the tables of a run
``<root>/runs/<run>/_manifest/<table>`` a record of each finished table: what it was made from, its
                                        content fingerprint, what its checks counted
``<root>/published/<number>``           the publish records, numbered from 1

A run is published by creating the next numbered record, which must not exist yet: two
publishers cannot take the same number, so neither record is lost, and the one that comes second sees the
other's. A publisher that names the record it started from is refused when another came
between (compare and set). Readers take the highest finished record; nothing that is published is
overwritten. The exclusive create is atomic on HDFS, on a mounted file system and on stores with
conditional writes; it goes through the file system of the path, from the driver.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

from ledgerline import schemas


class PublishConflict(RuntimeError):
    """Another run was published after the record that this one started from."""


class _Store:
    """Small files through the Hadoop file system of a path."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = root.rstrip("/")
        self.fs = self.path("").getFileSystem(self.conf)

    def path(self, name: str) -> Any:
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def list(self, name: str) -> list[tuple[str, int]]:
        """(name, modification time in ms) of the entries of a folder; empty where there is none."""
        path = self.path(name)
        if not self.fs.exists(path):
            return []
        return sorted((s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(path))

    def read(self, name: str) -> str | None:
        path = self.path(name)
        if not self.fs.exists(path):
            return None
        stream = self.fs.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Replace a small file: readers see the old or the new one."""
        temporary, path = self.path(f"{name}.{uuid.uuid4().hex}"), self.path(name)
        self._create(temporary, text)
        self.fs.delete(path, False)
        if not self.fs.rename(temporary, path):
            raise OSError(f"cannot write {path}")

    def _create(self, path: Any, text: str) -> None:
        stream = self.fs.create(path, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def create_new(self, name: str, text: str) -> bool:
        """Create a file that must not exist; False where it does."""
        path = self.path(name)
        if self.fs.getUri().getScheme() == "file":  # Hadoop's local file system looks first and creates then
            local = path.toUri().getPath()
            os.makedirs(os.path.dirname(local), exist_ok=True)
            try:
                with open(local, "x", encoding="utf-8") as out:
                    out.write(text)
            except FileExistsError:
                return False
            return True
        try:
            self._create(path, text)
        except Exception as error:  # py4j wraps the file system's exception
            if "FileAlreadyExists" in str(error) or self.fs.exists(path):
                return False
            raise
        return True

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


# ---------------------------------------------------------------------------
# Tables and manifests
# ---------------------------------------------------------------------------


def table_path(root: str, run_id: str, table: str) -> str:
    return f"{root.rstrip('/')}/runs/{run_id}/{schemas.layer_of(table)}/{table}"


def work_path(root: str, run_id: str, name: str) -> str:
    """A table that only the run itself reads."""
    return f"{root.rstrip('/')}/runs/{run_id}/_work/{name}"


def rejects_path(root: str, run_id: str) -> str:
    """The rejected lines of a run, where there are any."""
    return f"{root.rstrip('/')}/runs/{run_id}/_rejects"


def drop_work(spark: SparkSession, root: str, run_id: str) -> None:
    _Store(spark, root).delete(f"runs/{run_id}/_work")


@dataclass(frozen=True)
class TableRecord:
    """What a finished table was made from and what its write observed: rows, content, what the
    checks counted and, for a source with a reject channel, what was rejected."""

    table: str
    inputs: str
    row_count: int
    content_hash: str
    checks: Mapping[str, int]
    rejects: Sequence[Sequence] = ()


def record_table(spark: SparkSession, root: str, run_id: str, record: TableRecord) -> None:
    _Store(spark, root).write(f"runs/{run_id}/_manifest/{record.table}", json.dumps(record.__dict__))


def recorded_table(spark: SparkSession, root: str, run_id: str, table: str) -> TableRecord | None:
    text = _Store(spark, root).read(f"runs/{run_id}/_manifest/{table}")
    return TableRecord(**json.loads(text)) if text else None


# ---------------------------------------------------------------------------
# Publish records
# ---------------------------------------------------------------------------

PUBLISHED = "published"


@dataclass(frozen=True)
class PublishRecord:
    number: int
    run_id: str
    published_at: int


def publish_records(spark: SparkSession, root: str) -> list[PublishRecord]:
    """All finished records, oldest first. A record still being written is not one yet."""
    store, out = _Store(spark, root), []
    for name, _ in store.list(PUBLISHED):
        if name.isdigit():
            try:
                out.append(PublishRecord(**json.loads(store.read(f"{PUBLISHED}/{name}") or "")))
            except ValueError:
                continue
    return out


def latest_record(spark: SparkSession, root: str) -> PublishRecord | None:
    return next(reversed(publish_records(spark, root)), None)


def publish(spark: SparkSession, root: str, run_id: str, based_on: int | None = None, attempts: int = 100) -> PublishRecord:
    """Make ``run_id`` the current run. With ``based_on`` only if that record is still the last one."""
    store = _Store(spark, root)
    for _ in range(attempts):
        last = max((int(n) for n, _ in store.list(PUBLISHED) if n.isdigit()), default=0)
        if based_on is not None and last != based_on:
            raise PublishConflict(f"record {last} was published after record {based_on}")
        record = PublishRecord(last + 1, run_id, time.time_ns() // 1000)
        if store.create_new(f"{PUBLISHED}/{record.number:012d}", json.dumps(record.__dict__)):
            return record
    raise PublishConflict(f"no free publish record in {attempts} attempts")


def current_run(spark: SparkSession, root: str) -> str:
    """The run named by the latest publish record."""
    record = latest_record(spark, root)
    if record is None:
        raise FileNotFoundError(f"nothing published under {root}")
    return record.run_id


def expire_runs(spark: SparkSession, root: str, keep: int = 3, min_age_seconds: float = 86_400.0) -> list[str]:
    """Delete the tables of old runs; returns their names.

    Kept are the runs that the last ``keep`` records name (the current one always) and every run
    younger than ``min_age_seconds``, which may still be written. Publish records stay, as history.
    """
    if keep < 1:
        raise ValueError("the current run must be kept")
    store = _Store(spark, root)
    named = {r.run_id for r in publish_records(spark, root)[-keep:]}
    limit = time.time() * 1000 - min_age_seconds * 1000
    gone = []
    for run_id, _ in store.list("runs"):
        times = [t for name in ("", "/_manifest") for _, t in store.list(f"runs/{run_id}{name}")]
        if run_id not in named and max(times, default=0) <= limit:
            store.delete(f"runs/{run_id}")
            gone.append(run_id)
    return gone
