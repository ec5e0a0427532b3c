"""Run a dataset: raw -> clean -> marts -> gates -> parquet (QRY-6 batch).

Each stage is a distributed Spark job; stages meet through the written
parquet (the clean table is written once and every mart reads it back).
Gates are counted while the tables are written; a vintage is published only
after them. Only gate reports (a few rows per check) reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocube.operators import quality as dq
from regiocube.operators.enrich import (
    cast_observations,
    clean_observations,
    drop_incomplete,
    with_period_split,
)
from regiocube.functions.codes import slice_predicate
from regiocube.plans.spec import DatasetSpec
from regiocube.sources.files import data_files, first_line, leaf_files, partition_columns
from regiocube.sources.readers import latest_path, list_vintages, read_obs
from regiocube.sources.sdmx import filter_slice, read_sdmx_tsv
from regiocube.sources.sinks import write_clean, write_table
from regiocube.plans.vintage import StagedVintage, read_manifest, recover, vintage_folder


def prepare_raw(spec: DatasetSpec, raw: DataFrame) -> DataFrame:
    """Source filter, casts, period split and optional row rejection."""
    obs = filter_slice(raw, spec.source_filter) if spec.source_filter else raw
    if spec.period == "quarter" and "quarter" not in obs.columns:
        obs = with_period_split(obs, "year")
    obs = cast_observations(obs)
    if spec.drop_incomplete:
        obs = drop_incomplete(obs)
    return obs


def build_clean(spec: DatasetSpec, raw: DataFrame, geo: DataFrame,
                codelists: Mapping[str, DataFrame]) -> DataFrame:
    obs = prepare_raw(spec, raw)
    wanted = [d for d in ("freq", "unit", *spec.codelist_dims) if d in spec.dims and d in codelists]
    return clean_observations(
        obs, list(spec.dims), geo,
        codelists={d: codelists[d] for d in wanted},
        flags=codelists.get("flag"),
        label_maps=spec.label_maps or None,
        with_parent=spec.with_parent,
        extra_time=spec.extra_time,
    )


def land(spark: SparkSession, spec: DatasetSpec, raw: DataFrame | str) -> DataFrame:
    """The raw observations of a dataset: a long DataFrame as it is; a path by
    what it holds. A wide SDMX TSV (or folder of them) is melted; landed
    parquet or ``.csv`` is read with the declared types, bound by name (SRC-9),
    and text with the dataset's ``read_options``. Of a folder of vintages only the newest
    counts (SRC-6); ``key=value`` folders are partitions of one table."""
    if isinstance(raw, DataFrame):
        return raw
    if list_vintages(spark, raw) and not data_files(spark, raw):
        raw = latest_path(spark, raw)
    partitioned = partition_columns(spark, raw)
    files = leaf_files(spark, raw) if partitioned else data_files(spark, raw)
    kinds = {f.rsplit(".", 1)[-1] for f in files}
    if kinds == {"parquet"}:
        return read_obs(spark, raw, spec.raw_schema)
    if files and kinds == {"csv"} and (partitioned or "\t" not in (first_line(spark, files[0]) or "")):
        return read_obs(spark, raw, spec.raw_schema, "csv", spec.read_options)
    if partitioned:
        raise ValueError(f"{raw}: partition folders hold parquet or csv files, not {sorted(kinds)}")
    return read_sdmx_tsv(spark, raw, spec.source_filter or None, spec.read_options)


def run_dataset(
    spark: SparkSession,
    spec: DatasetSpec,
    raw: DataFrame | str,
    geo: DataFrame,
    codelists: Mapping[str, DataFrame],
    out_root: str,
    vintage: str | int,
    fail_on_error: bool = True,
) -> list[dict]:
    """Clean + every mart of ``spec``, published as one vintage; returns the gate report rows.

    ``raw`` is a long observation DataFrame or the path of landed data (see
    ``land``). All tables are written into a staged folder, and the gates of
    columns, NULLs, row minima and mart keys are counted in those writes. The
    clean table's columns and keys are judged before any mart is built (also the
    key of each mart's slice: duplicate observations would make endpoint lookups
    ambiguous), whatever ``fail_on_error`` says; the other gates are judged before
    the vintage is published. A vintage that fails is set aside as rejected and
    the published one stays (``plans.vintage``); without ``fail_on_error`` the
    failed gates are reported and the vintage is published.
    """
    staged = StagedVintage(spark, out_root, spec.slug, vintage)
    rows: list[dict] = []
    try:
        rows += _staged_clean(spec, build_clean(spec, land(spark, spec, raw), geo, codelists), staged)
        clean = spark.read.parquet(staged.path("clean"))
        for mart in spec.marts:
            counts = dq.TableMetrics(f"{spec.slug}/{mart.name}", (*mart.key, *mart.required), (), mart.min_rows, mart.key)
            write_table(mart.build(clean), staged.path(mart.name), list(mart.order_by) or None, counts)
            staged.tables[mart.name] = counts.n_rows
            rows += counts.rows()
        rows += dq.run_gates([dq.check_tables(spark, list(staged.tables), spec.required_tables, spec.slug)], False)
        bad = [r for r in rows if r["n_bad"]]
        if bad and fail_on_error:
            raise dq.GateFailure(f"{spec.slug}: {len(bad)} gate(s) failed: {bad}")
    except dq.GateFailure:
        staged.reject(rows)
        raise
    except BaseException:
        staged.discard()
        raise
    staged.commit(rows)
    return [dict(r, dataset=spec.slug) for r in rows]


def _staged_clean(spec: DatasetSpec, clean: DataFrame, staged: StagedVintage) -> list[dict]:
    """Write the clean table; its gate rows. Columns or keys that fail raise."""
    counts = dq.TableMetrics(f"{spec.slug}/clean", spec.required_columns, spec.not_null, spec.min_rows)
    write_clean(clean, staged.path("clean"), metrics=counts)
    staged.tables["clean"] = counts.n_rows
    gates = counts.rows()
    rows = [r for r in gates if r["check_name"] == "required_columns"]
    if not any(r["n_bad"] for r in rows):
        written = staged.spark.read.parquet(staged.path("clean"))
        key = [d for d in spec.dims if d != "geo"] + ["geo", "year", *spec.extra_time]
        rows += dq.run_gates([dq.check_key(written, key), *(
            dq.check_key(written.filter(slice_predicate(m.slice_) & F.col("value").isNotNull()), m.slice_key)
            for m in spec.marts if m.slice_key and set(m.slice_key) != set(key))], False)
    stop = [r for r in rows if r["n_bad"]]
    if stop:
        raise dq.GateFailure(f"{spec.slug}: {len(stop)} gate(s) failed before the marts: {stop}")
    return rows + [r for r in gates if r["check_name"] != "required_columns"]


#: Datasets that a batch runs side by side.
BATCH_WORKERS = 4


def run_all(spark: SparkSession, specs: Mapping[str, DatasetSpec], raws: Mapping[str, DataFrame | str],
            geo: DataFrame, codelists: Mapping[str, DataFrame], out_root: str, vintage: str | int,
            fail_on_error: bool = True, workers: int = BATCH_WORKERS) -> list[dict]:
    """QRY-6: every dataset within one session, at most ``workers`` at a time;
    returns all gate rows, in the order of ``specs``. A dataset that fails
    gets a row ``dataset_run`` with the error and the batch goes on.

    The threads only submit jobs: each dataset's jobs go to a scheduler pool of
    its own, so with ``spark.scheduler.mode`` FAIR a large dataset leaves the
    others their share of the executors, and the tail of one (a small mart, a
    gate) fills up with tasks of another."""
    def one(slug: str) -> list[dict]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"dataset-{slug}")
        try:
            rows = run_dataset(spark, specs[slug], raws[slug], geo, codelists, out_root, vintage, fail_on_error)
            return [*rows, {"check_name": "dataset_run", "subject": slug, "n_checked": 1, "n_bad": 0, "dataset": slug}]
        except Exception as e:  # noqa: BLE001 - reported per dataset; the batch must go on
            return [{"check_name": "dataset_run", "subject": f"{slug}: {type(e).__name__}: {e}", "n_checked": 1,
                     "n_bad": 1, "dataset": slug}]
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    slugs = [slug for slug in specs if slug in raws]
    with ThreadPoolExecutor(max(1, min(workers, len(slugs)))) as pool:
        # Wrapped one by one: a wrapped function's threads share its local properties.
        runs = [pool.submit(inheritable_thread_target(spark)(one), slug) for slug in slugs]
    return [row for r in runs for row in r.result()]


def rows_by_level(clean: DataFrame) -> DataFrame:
    """QRY-3: row count by NUTS level."""
    return clean.groupBy("nuts_level").agg(F.count(F.lit(1)).alias("n_rows"))


def register_views(spark: SparkSession, out_root: str, slug: str, vintage: str | int) -> list[str]:
    """QRY-1: expose a published vintage as temp views for ad-hoc SQL: the clean
    table as ``<slug>_clean`` and each mart of its manifest as ``<slug>_<mart>``,
    with '-' -> '_'. The clean table's folders are its years, so a predicate on
    ``year`` prunes them."""
    recover(spark, out_root, slug, vintage)
    folder = vintage_folder(out_root, slug, vintage)
    manifest = read_manifest(spark, folder)
    if manifest is None:
        raise FileNotFoundError(f"no published vintage {vintage} of {slug} under {out_root}")
    names = []
    for table in sorted(manifest["tables"], key=lambda t: (t != "clean", t)):
        names.append(f"{slug}_{table}".replace("-", "_"))
        spark.read.parquet(f"{folder}/{table}.parquet").createOrReplaceTempView(names[-1])
    return names
