"""Publishing a vintage in two phases (SNK-1, SNK-2, DQ-5).

A run writes its tables into a staged folder beside the published vintage:

    <root>/<slug>/_staged-<vintage>-<run>/<table>.parquet

Its gates are judged there. Only then is the vintage published: the manifest
(tables, their rows, the gate report) is written as the staged folder's last
file, an earlier folder of the same vintage is set aside, and the staged folder gets
its name by one rename, the commit point. Readers so see the old vintage or the
new one, whole. A vintage that fails its gates is kept for inspection as
``_rejected-<vintage>``; the published one stays as it is.

A driver that is lost between the two renames leaves a complete staged folder
and the set-aside one; ``recover`` (called by the next run, and by readers that
find no vintage) finishes the commit, or undoes it if the staged folder is not
complete. One writer per vintage is assumed; readers may be many.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

MANIFEST = "manifest.json"


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _fs(spark, old)
    if not fs.rename(p, _fs(spark, new)[1]):
        raise OSError(f"could not rename {old} to {new}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _children(spark: SparkSession, folder: str, prefix: str) -> list[str]:
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(n for n in (st.getPath().getName() for st in fs.listStatus(p)) if n.startswith(prefix))


def vintage_folder(root: str, slug: str, vintage: str | int) -> str:
    return f"{root.rstrip('/')}/{slug}/{vintage}"


def rejected_folder(root: str, slug: str, vintage: str | int) -> str:
    """Where the tables of the last run that failed its gates are."""
    return f"{root.rstrip('/')}/{slug}/_rejected-{vintage}"


def read_manifest(spark: SparkSession, folder: str) -> dict | None:
    """The manifest of a vintage's folder, None without one."""
    fs, p = _fs(spark, f"{folder}/{MANIFEST}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def recover(spark: SparkSession, root: str, slug: str, vintage: str | int) -> None:
    """Finish or undo a commit that stopped between its two renames."""
    folder, published = f"{root.rstrip('/')}/{slug}", vintage_folder(root, slug, vintage)
    for name in _children(spark, folder, f"_old-{vintage}-"):
        staged = f"{folder}/_staged-{vintage}-{name.rpartition('-')[2]}"
        if not exists(spark, published):
            _rename(spark, staged if read_manifest(spark, staged) else f"{folder}/{name}", published)
        if exists(spark, f"{folder}/{name}"):
            _delete(spark, f"{folder}/{name}")


class StagedVintage:
    """The tables of one run until they are published or rejected."""

    def __init__(self, spark: SparkSession, root: str, slug: str, vintage: str | int):
        recover(spark, root, slug, vintage)
        self.spark, self.slug, self.vintage, self.run = spark, slug, vintage, uuid.uuid4().hex
        self._root = f"{root.rstrip('/')}/{slug}"
        self.published = vintage_folder(root, slug, vintage)
        self.rejected = rejected_folder(root, slug, vintage)
        self.folder = f"{self._root}/_staged-{vintage}-{self.run}"
        self.tables: dict[str, int] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def _write_manifest(self, gates: Sequence[dict], state: str) -> None:
        fs, p = _fs(self.spark, f"{self.folder}/{MANIFEST}")
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(json.dumps({
                "slug": self.slug, "vintage": str(self.vintage), "run": self.run, "state": state,
                "tables": self.tables, "gates": list(gates)}, indent=1).encode("utf-8")))
        finally:
            stream.close()

    def commit(self, gates: Sequence[dict] = ()) -> str:
        """Publish: the manifest last, the old vintage aside, one rename."""
        self._write_manifest(gates, "published")
        old = f"{self._root}/_old-{self.vintage}-{self.run}"
        replaced = exists(self.spark, self.published)
        if replaced:
            _rename(self.spark, self.published, old)
        try:
            _rename(self.spark, self.folder, self.published)
        except Exception:
            if replaced and not exists(self.spark, self.published):
                _rename(self.spark, old, self.published)
            raise
        if replaced:
            _delete(self.spark, old)
        return self.published

    def reject(self, gates: Sequence[dict] = ()) -> str | None:
        """Keep what was written for inspection; the published vintage stays. None if nothing was written."""
        if not exists(self.spark, self.folder):
            return None
        self._write_manifest(gates, "rejected")
        _delete(self.spark, self.rejected)
        _rename(self.spark, self.folder, self.rejected)
        return self.rejected

    def discard(self) -> None:
        _delete(self.spark, self.folder)
