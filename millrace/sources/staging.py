"""Write, check, then publish: tables that change over only after they have passed their checks.

A run writes its tables to a staging folder of the same lake and checks them there. Only when everything has passed do
the folders change places: the old table is moved aside, the new one takes its path. A check that fails leaves all old
tables as they were, and what was refused stays in staging to be looked at. If a move fails, or the driver is lost
between two moves, the tables moved so far go back, at once or when the layer is next published. Old versions are kept
until :func:`forget`.

One run at a time may publish a layer. Renaming is what the file system makes of it: one step on HDFS and alike, a
copy on object stores. Readers that listed a table's files before the change may have to start again. Delta tables are
overwritten from staging instead, each in one commit.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.quality import QualityError, require_unique
from millrace.sources import layers
from millrace.sources.layers import (
    Layout,
    read_layer,
    require_stored,
    stored_counts,
    write_counted,
    write_layer,
)

STAGING, MOVING, REPLACED, PENDING = "_staging", "_moving", "_replaced", "_pending"
# Stands in the place of an old table where there was none.
ABSENT = ".absent"


class Folders:
    """Moves folders on the file system that holds ``root``, the way Spark itself reaches it."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def mark(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def unmark(self, path: str) -> None:
        self._fs.delete(self._path(path), False)

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self._path(target).getParent())
        if self.exists(target) or not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot move {source} to {target}")


def _inside(layout: Layout, folder: str, run: str) -> Layout:
    return Layout(f"{layout.root.rstrip('/')}/{folder}/{run}", layout.fmt)


def staging(layout: Layout) -> Layout:
    """A fresh staging layout; nothing in it is published by itself."""
    return _inside(layout, STAGING, uuid.uuid4().hex)


@contextmanager
def staged(spark: SparkSession, layout: Layout) -> Iterator[Layout]:
    """A staging layout to write to and check; leaving the block without an error publishes all tables in it."""
    recover(spark, layout)
    run = uuid.uuid4().hex
    yield _inside(layout, STAGING, run)
    change_over(spark, layout, run)


def change_over(spark: SparkSession, layout: Layout, run: str) -> None:
    """Put the staged tables of a run in the place of the live ones, all of them or none."""
    folders = Folders(spark, layout.root)
    stage, aside = _inside(layout, STAGING, run), _inside(layout, MOVING, run)
    tables = [(layer, t) for layer in folders.names(stage.root) for t in folders.names(stage.path(layer, "").rstrip("/"))]
    if layout.fmt == "delta":
        for layer, table in tables:
            write_layer(read_layer(spark, stage, layer, table), layout, layer, table)
        return
    try:
        for layer, table in tables:
            live, old = layout.path(layer, table), aside.path(layer, table)
            if folders.exists(live):
                folders.move(live, old)
            else:
                folders.mark(f"{old}{ABSENT}")
            folders.move(stage.path(layer, table), live)
    except Exception:
        _undo(folders, layout, run)
        raise
    # From here on the change is done; without this step it would be undone.
    if tables:
        folders.move(aside.root, _inside(layout, REPLACED, run).root)
    for layer, table in tables:
        spark.catalog.refreshByPath(layout.path(layer, table))


def _undo(folders: Folders, layout: Layout, run: str) -> None:
    stage, aside = _inside(layout, STAGING, run), _inside(layout, MOVING, run)
    for layer in folders.names(aside.root):
        for entry in folders.names(aside.path(layer, "").rstrip("/")):
            table, old = entry.removesuffix(ABSENT), aside.path(layer, entry)
            # A table whose new version never arrived is missing, and has nothing to move back to staging.
            if folders.exists(layout.path(layer, table)):
                folders.move(layout.path(layer, table), stage.path(layer, table))
            if entry.endswith(ABSENT):
                folders.unmark(old)
            else:
                folders.move(old, layout.path(layer, table))
        folders.unmark(aside.path(layer, "").rstrip("/"))
    folders.unmark(aside.root)


def recover(spark: SparkSession, layout: Layout) -> list[str]:
    """Undo what a lost driver left half moved; returns the runs undone."""
    folders = Folders(spark, layout.root)
    runs = folders.names(f"{layout.root.rstrip('/')}/{MOVING}")
    for run in runs:
        _undo(folders, layout, run)
    return runs


def forget(spark: SparkSession, layout: Layout) -> list[str]:
    """Remove the versions that published ones replaced; returns the runs they belonged to."""
    folders, root = Folders(spark, layout.root), f"{layout.root.rstrip('/')}/{REPLACED}"
    runs = folders.names(root)
    for run in runs:
        folders.remove(f"{root}/{run}")
    return runs


def replace_partitions(
    spark: SparkSession, stage: Layout, layout: Layout, layer: str, table: str, column: str, values: Iterable
) -> None:
    """Publish a staged table that holds all rows of some partitions; the other partitions keep their files.

    ``values`` are the partitions to replace: those the staged table has no rows for go. Moving the staged table to
    the pending ones is the point from which the change will be made, even if the driver is lost on the way: who
    comes next calls :func:`finish_pending` before reading.
    """
    finish_pending(spark, layout)
    folders, source = Folders(spark, layout.root), stage.path(layer, table)
    for value in values:
        # An empty folder stands for a partition that is to be empty.
        folders.mark(f"{source}/{column}={value}")
    folders.move(source, f"{layout.root.rstrip('/')}/{PENDING}/{layer}/{table}")
    finish_pending(spark, layout)


def finish_pending(spark: SparkSession, layout: Layout) -> None:
    """Make every partition change that is pending, or what is left of it; doing it twice does no harm."""
    folders, pending = Folders(spark, layout.root), Layout(f"{layout.root.rstrip('/')}/{PENDING}", layout.fmt)
    for layer in folders.names(pending.root):
        for table in folders.names(pending.path(layer, "").rstrip("/")):
            replaced = _inside(layout, REPLACED, uuid.uuid4().hex)
            overwrite_partitions(spark, pending, layout, replaced, layer, table)
            folders.move(pending.path(layer, table), replaced.path(layer, f"{table}-done"))
            spark.catalog.refreshByPath(layout.path(layer, table))


def overwrite_partitions(
    spark: SparkSession, pending: Layout, layout: Layout, replaced: Layout, layer: str, table: str
) -> None:
    """Put the pending partitions of a table in the place of its live ones; the others keep their files.

    Partitions of file formats change places by their folders, so nothing is written again. Each goes in two moves:
    the live one aside, the pending one to its place. One that is still pending has not arrived, so after a loss the
    same two steps go on from there.
    """
    folders = Folders(spark, layout.root)
    source, live = pending.path(layer, table), layout.path(layer, table)
    parts = [n for n in folders.names(source) if "=" in n and not n.startswith("_")]
    emptied = [p for p in parts if not folders.names(f"{source}/{p}")]
    if layout.fmt == "delta":
        column = parts[0].split("=")[0]
        layers.overwrite_partitions(read_layer(spark, pending, layer, table), layout, layer, table, [column])
        if emptied:
            gone = ", ".join(p.split("=", 1)[1] for p in emptied)
            spark.sql(f"DELETE FROM delta.`{live}` WHERE {column} IN ({gone})")
        return
    for part in parts:
        if folders.exists(f"{live}/{part}"):
            folders.move(f"{live}/{part}", f"{replaced.path(layer, table)}/{part}")
        if part not in emptied:
            folders.move(f"{source}/{part}", f"{live}/{part}")


def require_volume(
    spark: SparkSession, stage: Layout, layout: Layout, layer: str, tables: Iterable[str], least_share: float
) -> None:
    """No staged table may have fewer rows than this share of the one it is to replace."""
    folders = Folders(spark, layout.root)
    known = [t for t in tables if folders.exists(layout.path(layer, t))]
    if not known:
        return
    before, now = (stored_counts(spark, where, layer, known) for where in (layout, stage))
    shrunk = [f"{t}: {now[t]} rows after {before[t]}" for t in known if now[t] < least_share * before[t]]
    if shrunk:
        raise QualityError(f"{layer} has lost too many rows: {'; '.join(shrunk)}")


def publish_checked(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    layout: Layout,
    layer: str,
    keys: Mapping[str, str],
    least_share: float = 0.0,
) -> dict[str, int]:
    """Replace tables of a layer if all of them arrive whole, with unique keys and not too small."""
    with staged(spark, layout) as stage:
        counts = {t: write_counted(df, stage, layer, t) for t, df in frames.items()}
        require_stored(spark, stage, layer, counts)
        if keys:
            require_unique({t: read_layer(spark, stage, layer, t) for t in keys}, keys)
        if least_share:
            require_volume(spark, stage, layout, layer, frames, least_share)
    return counts
