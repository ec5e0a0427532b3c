"""Codelist, geo hierarchy and typed observation readers (SRC-3..SRC-9)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiocube.sources.files import partition_columns

CODELIST_SCHEMA = "code string, label_en string"
GEO_SCHEMA = "code string, label_en string, nuts_level string, parent_code string"

# Irregular codelist headers normalised to (code, label_en).
_CODE_ALIASES = ("code", "freq", "flag")
_LABEL_ALIASES = ("label_en", "description_en")


def _normalise_codelist(df: DataFrame) -> DataFrame:
    cols = {c.lower(): c for c in df.columns}
    code = next(cols[a] for a in _CODE_ALIASES if a in cols)
    label = next(cols[a] for a in _LABEL_ALIASES if a in cols)
    return df.select(F.col(code).cast("string").alias("code"), F.col(label).cast("string").alias("label_en"))


def read_codelist(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """SRC-3: a (code, label_en) codelist from parquet or CSV; the irregular
    headers ``freq,label_en`` and ``flag,description_en`` are accepted."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "csv":
        df = (spark.read.option("header", "true").option("inferSchema", "false")
              .option("multiLine", "true").option("escape", '"').csv(path))
    else:
        df = spark.read.parquet(path)
    return _normalise_codelist(df)


def read_geo(spark: SparkSession, path: str) -> DataFrame:
    """SRC-4/5: the geo hierarchy CSV with an explicit schema (empty fields
    -> NULL)."""
    return spark.read.option("header", "true").option("escape", '"').schema(GEO_SCHEMA).csv(path)


def read_obs(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
             options: Mapping[str, str] | None = None) -> DataFrame:
    """SRC-9: explicitly typed observation read, bound by column *name*
    (flows order their dims differently; a filtered ``sex='T'`` column must
    stay a string instead of being sniffed as boolean). ``key=value`` folders
    are partitions of the table; their values are read as text and cast
    like any other, so a code ``01`` stays one. ``options`` are those of ``text_options``."""
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "false").options(**text_options(options))
    raw = reader.format(fmt).load(path)
    keys = set(partition_columns(spark, path))
    if keys:
        as_text = T.StructType([T.StructField(f.name, T.StringType()) if f.name in keys else f for f in raw.schema.fields])
        raw = reader.schema(as_text).format(fmt).load(path)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in st.fields])


def text_options(options: Mapping[str, str] | None) -> dict[str, str]:
    """Reader options of a dataset's declared ``delimiter`` and ``encoding``; others are an error."""
    names = {"delimiter": "sep", "encoding": "encoding"}
    unknown = set(options or {}) - set(names)
    if unknown:
        raise ValueError(f"unknown read options {sorted(unknown)}: delimiter and encoding are known")
    return {names[k]: v for k, v in (options or {}).items()}


def read_codelists(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every ``<dim>.csv`` or ``<dim>.parquet`` of a folder, by dim; ``flags`` is read as ``flag``."""
    out = {}
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    for st in fs.listStatus(p):
        name, _, kind = st.getPath().getName().rpartition(".")
        if name and kind in ("csv", "parquet"):
            out["flag" if name == "flags" else name] = read_codelist(spark, st.getPath().toString(), kind)
    return out


def list_vintages(spark: SparkSession, root: str) -> list[str]:
    """Sub-folder names of ``root`` that are vintages, via the Hadoop file system;
    ``key=value`` folders are partitions of one table, hidden names are no data."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]
    return sorted(n for n in names if "=" not in n and not n.startswith(("_", ".")))


def latest_path(spark: SparkSession, root: str) -> str:
    """SRC-6 (``mode: latest``): the newest landed vintage folder under
    ``root`` (folder names sort chronologically)."""
    vintages = list_vintages(spark, root)
    if not vintages:
        raise FileNotFoundError(f"no vintage under {root}")
    return f"{root.rstrip('/')}/{vintages[-1]}"


def read_latest(spark: SparkSession, root: str, fmt: str = "parquet",
                options: Mapping[str, str] | None = None) -> DataFrame:
    """SRC-6: read only the newest landed vintage under ``root``. Listing is
    metadata only; no data of older vintages is scanned."""
    reader = spark.read
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.format(fmt).load(latest_path(spark, root))
