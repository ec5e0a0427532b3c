"""Clean observation tables over the test tables, built once per session.

``cubes(spark, sf_dir)`` gives the clean layer every registered query reads:
``clean`` (annual: freq, unit, cat, geo, year ...), ``monthly``,
``quarterly``, ``citizen`` and the ``geo`` hierarchy, plus the reference
group and focus country derived from the nation/region tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiocube.plans.materialize import persisted, persisted_path
from regiocube.sources import starcube as sc

_FACT_TABLES = ("lineitem", "orders", "customer", "supplier", "nation", "region")


@dataclass
class Cubes:
    spark: SparkSession
    sf_dir: str
    ref: tuple[str, ...]
    focus: str
    _memo: dict = field(default_factory=dict)

    def _inputs(self, *names: str) -> list[str]:
        return [f"{self.sf_dir.rstrip('/')}/{n}.parquet" for n in names]

    def _get(self, key, fn):
        if key not in self._memo:
            self._memo[key] = fn()
        return self._memo[key]

    def facts(self) -> DataFrame:
        """The one output of the fact pass: order cells and supplier cells,
        written once, partitioned by ``kind``."""
        return self._get("facts", lambda: persisted(
            self.spark, "fact_cells", lambda: sc.fact_cells(self.spark, self.sf_dir),
            self._inputs(*_FACT_TABLES), partition_by=["kind"],
            rows=lambda: sc.read_table(self.spark, self.sf_dir, "lineitem").count()))

    def cells(self) -> DataFrame:
        """Finest monthly cells of the orders (partition ``kind=order``)."""
        return self._get("cells", lambda: sc.month_cells(self.facts()))

    def obs(self) -> DataFrame:
        """Raw annual observations (freq, unit, cat, geo, year, value, flag):
        the landed raw layer. A roll-up of the persisted cells, bounded by
        the classification; written once because the geo hierarchy, the
        clean table and every ingest query read it, and re-planning the
        grouping-sets + explode for each of them costs more than the write."""
        return self._get("obs", lambda: persisted(
            self.spark, "raw_annual", lambda: sc.annual_obs(self.cells(), self.ref),
            self._inputs(*_FACT_TABLES)))

    def landed_tsv(self) -> str:
        """Folder of the raw layer landed as a wide SDMX TSV (the format the
        ingest reads), written once."""
        from regiocube.sources.sdmx import wide_layout, write_sdmx_tsv
        return self._get("landed_tsv", lambda: persisted_path(
            self.spark, "raw_wide_tsv", lambda: wide_layout(self.obs()),
            self._inputs(*_FACT_TABLES), write_sdmx_tsv))

    def geo(self) -> DataFrame:
        return self._get("geo", lambda: persisted(
            self.spark, "geo", lambda: sc.geo_table(
                self.spark, self.sf_dir, self.obs().select(F.col("geo").alias("code"))),
            self._inputs(*_FACT_TABLES)))

    def clean(self) -> DataFrame:
        return self._get("clean", lambda: persisted(
            self.spark, "clean_annual", lambda: sc.clean_annual(self.spark, self.obs(), self.geo()),
            self._inputs(*_FACT_TABLES)))

    def monthly(self) -> DataFrame:
        return self._get("monthly", lambda: persisted(
            self.spark, "clean_monthly", lambda: sc.clean_monthly(
                self.spark, sc.monthly_obs(self.cells(), self.ref), self.geo()),
            self._inputs(*_FACT_TABLES)))

    def quarterly_raw(self) -> DataFrame:
        return self._get("quarterly_raw", lambda: sc.quarterly_obs(self.cells(), self.ref))

    def quarterly(self) -> DataFrame:
        return self._get("quarterly", lambda: persisted(
            self.spark, "clean_quarterly",
            lambda: sc.clean_quarterly(self.spark, self.quarterly_raw(), self.geo()),
            self._inputs(*_FACT_TABLES)))

    def citizen(self) -> DataFrame:
        return self._get("citizen", lambda: persisted(
            self.spark, "clean_citizen", lambda: sc.clean_citizen(
                self.spark, sc.citizen_obs(sc.supplier_cells(self.facts()), self.ref), self.geo()),
            self._inputs(*_FACT_TABLES)))


_SESSIONS: dict = {}


def cubes(spark: SparkSession, sf_dir: str) -> Cubes:
    """Per-(session, sf_dir) accessor; the reference group is read once."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _SESSIONS:
        ref = sc.reference_group(spark, sf_dir)
        _SESSIONS[key] = Cubes(spark, sf_dir, ref, sc.focus_country(ref))
    return _SESSIONS[key]
