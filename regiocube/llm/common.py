"""Helpers shared by the training-data operators: scratch tables and table reads."""

from __future__ import annotations

import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructType

from regiocube.session import scratch_root

#: A word, for every operator that counts words: a maximal run of bytes other
#: than space, tab, line feed, vertical tab, form feed and carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


#: Bytes of a batch that a Python worker gets at once (Spark's default is 64 MB).
BATCH_BYTES = 8 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the library's code to the executors, once per application, so that
    workers can import it wherever the driver was started."""
    sc = spark.sparkContext
    root = pathlib.Path(__file__).resolve().parents[1]
    if sc.applicationId in _SHIPPED or not root.is_dir():
        return
    target = pathlib.Path(tempfile.mkdtemp(prefix="regiocube-code-")) / "regiocube.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, function: Callable, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` with batches of bounded bytes: long texts come few at a time.

    The bound is a setting of the session, read when the plan runs; it is only ever lowered.
    """
    spark = df.sparkSession
    ship(spark)
    size = spark.conf.get(_BATCH_CONF, "64m").lower().rstrip("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(size[-1:], 1)
    if not 0 < int(size.rstrip("kmg")) * unit <= BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


def text_slices(column: pa.Array, most: int) -> Iterator[tuple[int, list[str]]]:
    """(position, texts): consecutive texts of about ``most`` bytes, null as empty."""
    start = held = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if i > start and held + n > most:
            yield start, [t or "" for t in column.slice(start, i - start).to_pylist()]
            start, held = i, 0
        held += n
    if start < len(column):
        yield start, [t or "" for t in column.slice(start).to_pylist()]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder of the session (``spark.checkpoint.dir``).

    Only a local session without that setting (tests) gets a folder of its own.
    """
    root = scratch_root(spark)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="regiocube-llm-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/regiocube-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later actions, and
    tasks of lost executors, read the files instead of repeating the work."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark._jvm
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/regiocube-llm/" in path:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def n_words(text: Column) -> Column:
    """Words of a text (0 for null), counted without building them."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column over all rows."""
    return df.agg(F.coalesce(F.sum(F.octet_length(column).cast("long")), F.lit(0)).alias("n")).first()["n"]


def parts(total: int, each: int, least: int = 1) -> int:
    """How many pieces of about ``each`` units ``total`` makes."""
    return max(least, -(-int(total) // each))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
