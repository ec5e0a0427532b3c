"""Persist intermediate tables in the shared scratch folder.

The clean layer is written once and every mart reads it back (the stages
meet only through files, as in the published workflow). This also cuts the
lineage, so a lost executor re-reads parquet instead of replaying the big
fact join.

A table is known by its name, its input files (listed recursively, with sizes
and times) and the code that builds it, so neither a changed file nor a
changed function reuses an older copy. It is written under a path of its own
and published by a rename: a reader sees a whole table or none, and two
applications that build the same one do not disturb each other.
"""

from __future__ import annotations

import hashlib
import pathlib
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame, SparkSession

from regiocube.session import scratch_root

#: Modules whose text decides what an intermediate table holds.
_CODE = ("constants.py", "functions", "operators/common.py", "operators/enrich.py", "sources", "plans/cubes.py",
         "plans/materialize.py")

#: Input rows that one task of a build sorts and groups, and shuffled MB that one task is given.
TASK_ROWS, TASK_MB = 256_000, 8
_PARTITIONS = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

_LOCKS: dict[str, threading.Lock] = {}
_LOCKS_GUARD = threading.Lock()


def _lock_for(path: str) -> threading.Lock:
    with _LOCKS_GUARD:
        return _LOCKS.setdefault(path, threading.Lock())


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def code_version(root: pathlib.Path | None = None) -> str:
    """Hash of the source text of the modules that build intermediate tables."""
    root = root or pathlib.Path(__file__).resolve().parent.parent
    h = hashlib.sha256()
    for name in _CODE:
        top = root / name
        for f in sorted(top.rglob("*.py")) if top.is_dir() else [top]:
            h.update(f.relative_to(root).as_posix().encode())
            h.update(f.read_bytes())
    return h.hexdigest()


def fingerprint(spark: SparkSession, inputs: Sequence[str], extra: str = "") -> str:
    """Hash of the code version and of all files below the input paths, with sizes and times."""
    h = hashlib.sha256((code_version() + extra).encode())
    for path in inputs:
        p, fs = _fs(spark, path)
        h.update(path.encode())
        if fs.exists(p):
            files = fs.listFiles(p, True)
            found = []
            while files.hasNext():
                st = files.next()
                found.append(f"{st.getPath()}:{st.getLen()}:{st.getModificationTime()}")
            h.update("\n".join(sorted(found)).encode())
    return h.hexdigest()[:16]


def _megabytes(size: str) -> float:
    """A byte setting of Spark in MB (plain numbers are bytes)."""
    size = size.strip().lower().rstrip("b")
    unit = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1 << 20}.get(size[-1:])
    return float(size[:-1]) * unit if unit else float(size) / (1 << 20)


@contextmanager
def dealt(spark: SparkSession, rows: int) -> Iterator[None]:
    """Shuffles of a build over ``rows`` rows get so many partitions, merged up to so few MB, that what
    one task holds does not grow with the input. Settings are only ever raised (MB: lowered), and put back."""
    want = -(-rows // TASK_ROWS)
    new = {k: str(want) for k in _PARTITIONS if int(spark.conf.get(k, None) or want) < want}
    if _megabytes(spark.conf.get(_ADVISORY)) > TASK_MB:
        new[_ADVISORY] = f"{TASK_MB}m"
    before = {k: spark.conf.get(k, None) for k in new}
    try:
        for k, v in new.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def persisted_path(spark: SparkSession, name: str, build: Callable[[], DataFrame],
                   inputs: Sequence[str], write: Callable[[DataFrame, str], None]) -> str:
    """Write ``build()`` once with ``write(df, path)`` under the scratch
    folder and return the path; reuses a published copy for the same code and
    inputs. A build that fails raises; without a scratch folder this raises.
    """
    root = scratch_root(spark)
    if root is None:
        raise RuntimeError("no shared scratch folder: set spark.checkpoint.dir")
    # A run token (set by bench.py) forces a rebuild instead of reusing a
    # complete copy left by an earlier run over the same inputs.
    token = spark.conf.get("regiocube.run_token", "")
    base = f"{root.rstrip('/')}/regiocube-tables"
    path = f"{base}/{name}-{fingerprint(spark, inputs, name + token)}"
    # One writer per table and process; a second caller waits and reuses it.
    with _lock_for(path):
        if not path_exists(spark, path):
            work = f"{base}/_work-{name}-{uuid.uuid4().hex}"
            write(build(), work)
            source, fs = _fs(spark, work)
            # Another application may have published meanwhile: its copy holds the same rows.
            if path_exists(spark, path) or not fs.rename(source, _fs(spark, path)[0]):
                if not path_exists(spark, path):
                    raise RuntimeError(f"could not publish {work} as {path}")
                fs.delete(source, True)
    return path


def persisted(spark: SparkSession, name: str, build: Callable[[], DataFrame],
              inputs: Sequence[str], partition_by: Sequence[str] = (),
              rows: Callable[[], int] | None = None) -> DataFrame:
    """Return ``build()`` written to (and read back from) the scratch folder as parquet.

    ``rows`` counts the input rows of a build whose work grows with them (see ``dealt``)."""
    def write(df: DataFrame, path: str) -> None:
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with dealt(spark, rows()) if rows else nullcontext():
            writer.parquet(path)

    return spark.read.parquet(persisted_path(spark, name, build, inputs, write))
