"""Names and first lines of files in any file system that Spark reads."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files at ``path`` (a file, a folder or a glob), sorted; names
    that begin with ``_`` or ``.`` are not data. A listing: no data is read."""
    p, fs = _path(spark, path)
    out: list[str] = []
    for st in fs.globStatus(p) or []:
        inside = fs.listStatus(st.getPath()) if st.isDirectory() else [st]
        out += [f.getPath().toString() for f in inside
                if not f.isDirectory() and f.getLen() and not f.getPath().getName().startswith(("_", "."))]
    return sorted(out)


def leaf_files(spark: SparkSession, path: str) -> list[str]:
    """The data files at ``path`` and in the folders below it, sorted; hidden names are left out. A listing."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return []
    base, out = fs.makeQualified(p).toString().rstrip("/"), []
    found = fs.listFiles(p, True)
    while found.hasNext():
        st = found.next()
        name = st.getPath().toString()
        if st.getLen() and not any(x.startswith(("_", ".")) for x in name[len(base):].split("/")):
            out.append(name)
    return sorted(out)


def partition_columns(spark: SparkSession, root: str) -> list[str]:
    """The columns in folder names (``key=value``) below ``root``, outermost first."""
    p, fs = _path(spark, root)
    out: list[str] = []
    while fs.exists(p):
        inside = [st.getPath() for st in fs.listStatus(p) if st.isDirectory() and "=" in st.getPath().getName()]
        if not inside:
            break
        p = inside[0]
        out.append(p.getName().partition("=")[0])
    return out


def files_by_header(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """{first line: files}, read by a job: each task reads one piece of one file and stops
    after its first line, which counts if the piece begins the file. The result
    is one row per different header."""
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                if b.column("start")[0].as_py() == 0:
                    yield b.slice(0, 1).select(["line", "file"])
                return

    # A session of its own: a piece per task is no setting for the caller's queries.
    own = spark.newSession()
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    lines = own.read.text(list(files)).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    found = lines.mapInArrow(first, "line string, file string").groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return {r["line"]: [unquote(f) for f in r["files"]] for r in found.collect() if r["line"]}


def first_line(spark: SparkSession, path: str) -> str | None:
    """The first line of a text file (decompressed by its extension), None for an empty one."""
    jvm = spark._jvm
    p, fs = _path(spark, path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(p)
    raw = fs.open(p)
    try:
        stream = raw if codec is None else codec.createInputStream(raw)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        raw.close()
