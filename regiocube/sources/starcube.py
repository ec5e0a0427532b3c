"""Observation cubes derived from the star-schema test tables.

The marts consume long observation tables ``(dims..., geo, year, value,
flag)``. The test tables are an order/line/customer/nation star schema, so
they are encoded as regional statistics:

* geography, four levels with the classification's code rules
  (country = first two characters, parent = code minus last character):
  country ``lpad(n_nationkey, 2, '0')``; NUTS1 = country + first letter of
  ``c_mktsegment``; NUTS2 = NUTS1 + first character of ``o_orderpriority``;
  NUTS3 = NUTS2 + ``o_orderstatus``;
* ``EU27_2020``: the published aggregate of the reference group (nations of
  region EUROPE), published only up to ``PUBLISHED_UNTIL`` so consumers must
  fall back to a computed total afterwards;
* year/month/quarter from ``o_orderdate``; breakdown ``cat`` from
  ``l_returnflag`` plus ``TOTAL``;
* units: ``NR`` line count, ``MIO_EUR`` summed whole-unit net amount,
  ``EUR_HAB`` amount per order (floored), ``PC`` share of the category's
  lines in the total (1 decimal);
* single-line cells are suppressed (value NULL, flag ``n``), the last,
  partial year is provisional (flag ``p``).

All measures are integer-valued doubles, so every engine sums them exactly.

Cost model: the only work that grows with the data is the lineitem x orders
join and the aggregation to (order, supplier) level (grouping right after
the join on the join key reuses the join's partitioning). One aggregation by
grouping sets reduces that to both fact cubes (order cells and
supplier-nation cells), in one linear plan: lineitem is scanned, shuffled and
joined once. Supplier and customer meet pre-aggregated rows. Everything after
that is over at most |nations| x |segments| x |priorities| x |statuses| x |months| cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regiocube.constants import EU27_AGGREGATE, FLAG_LABELS, FREQ_LABELS
from regiocube.functions.numeric import round_half_away
from regiocube.operators.common import bounded_broadcast, literal_frame
from regiocube.operators.enrich import build_geo, clean_observations, with_period_split

# --- FIXED VALUES: encoding of the test tables as a statistical cube ---
CATS = ("A", "N", "R")
TOTAL = "TOTAL"
CAT_LABELS = {"TOTAL": "Total", "A": "Accepted", "N": "Not returned", "R": "Returned"}
UNIT_LABELS = {
    "NR": "Number of lines",
    "MIO_EUR": "Net amount",
    "EUR_HAB": "Net amount per order",
    "PC": "Percentage of lines",
}
REFERENCE_REGION = "EUROPE"
PUBLISHED_UNTIL = 1999
PROVISIONAL_YEAR = 2001
OBSOLETE_NATION = "24"
AGGREGATE_LABEL = "Reference group aggregate"
CITIZEN_TOTAL, CITIZEN_NATIONAL, CITIZEN_GROUP = "TOTAL", "NAT", "EU"

MEASURES = ["o_T", "n_T", "a_T"] + [f"{m}_{c}" for c in CATS for m in ("o", "n", "a")]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nation_code(col: Column) -> Column:
    return F.lpad(col.cast("string"), 2, "0")


def reference_group(spark: SparkSession, sf_dir: str) -> tuple[str, ...]:
    """Country codes of the reference group: the nations of REFERENCE_REGION.

    Collects the nations of one region, to turn membership into a literal IN
    list; more than ``MOST_NATIONS`` (no classification of countries) raises.
    """
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region").filter(F.col("r_name") == REFERENCE_REGION)
    rows = (n.join(r, n.n_regionkey == r.r_regionkey)
             .select(nation_code(F.col("n_nationkey")).alias("c")).limit(MOST_NATIONS + 1).collect())
    if len(rows) > MOST_NATIONS:
        raise ValueError(f"the reference group has more than {MOST_NATIONS} nations")
    return tuple(sorted(x.c for x in rows))


def focus_country(ref: tuple[str, ...]) -> str:
    """The focus country: the first member of the reference group."""
    return ref[0]


# ------------------------------------------------------------------ facts
def _amount() -> Column:
    return F.floor(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).cast("long")


# Line measures summed at (order, supplier) grain and carried by both cubes.
LINE_MEASURES = ["n_T", "a_T"] + [f"{m}_{c}" for c in CATS for m in ("n", "a")]
NO_SUPPLIER = -1
NO_NATION = "ZZ"
MOST_NATIONS = 1000
NO_PART = "_"


def order_supplier_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines joined to their order and summed per (order, supplier): the one
    line-level shuffle of the whole build. ``o_T`` (and ``o_<cat>``) mark one
    row of each order (that has lines of the category), so their sums count
    orders.

    The grouping keys start with the join key and the order windows are
    partitioned by it, so on a sort-merge join neither needs an exchange.
    """
    # A hot order key: the steps after the join need its partitioning, so AQE
    # splits a skewed partition only where that is forced (it then adds an
    # exchange; unskewed plans stay as they are).
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_returnflag", _amount().alias("amt"))
    od = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    lo = li.join(od, li.l_orderkey == od.o_orderkey)
    aggs = [F.count(F.lit(1)).alias("n_T"), F.sum("amt").alias("a_T")]
    for c in CATS:
        hit = F.col("l_returnflag") == F.lit(c)
        aggs += [F.count_if(hit).alias(f"n_{c}"), F.sum(F.when(hit, F.col("amt"))).alias(f"a_{c}")]
    facts = lo.groupBy(
        F.col("o_orderkey"), F.col("o_custkey"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.substring("o_orderpriority", 1, 1).alias("prio"),
        F.col("o_orderstatus").alias("status"),
        F.coalesce(F.col("l_suppkey"), F.lit(NO_SUPPLIER).cast("long")).alias("supp"),
    ).agg(*aggs)
    order = Window.partitionBy("o_orderkey")
    marked = facts.withColumn("__first", F.row_number().over(order.orderBy("supp")) == 1)
    has = [(F.col("__first") & (F.max(f"n_{c}").over(order) > 0)).cast("long").alias(f"o_{c}") for c in CATS]
    return marked.select("*", F.col("__first").cast("long").alias("o_T"), *has).drop("__first")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").select(
        "c_custkey", nation_code(F.col("c_nationkey")).alias("cc"),
        F.substring("c_mktsegment", 1, 1).alias("seg"))


def _sums(measures: list[str]) -> list[Column]:
    return [F.sum(m).alias(m) for m in measures]


def fact_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both fact cubes from ONE pass over the lines, as one table with a
    ``kind`` column (persist it partitioned by ``kind``):

    * ``order``: finest cells (cc, seg, prio, status, year, month) with the
      additive order/line measures (``MEASURES``);
    * ``supplier``: line measures by (cc, seg, year, sn), ``sn`` the supplier
      nation (``NO_NATION`` for lines without a known supplier).

    Nothing branches, so nothing is computed twice: one aggregation by
    grouping sets reduces the (order, supplier) rows to both grains per
    customer (map-side combined, so a customer or supplier with a large share
    of all orders collapses before any shuffle), the supplier nation and
    then the customer are joined to the reduced rows. Both outputs are
    bounded by the classification (nations x segments x ... x months).
    """
    facts = order_supplier_facts(spark, sf_dir)
    grains = ["o_custkey", "prio", "status", "year", "month", "supp"]
    both = facts.groupingSets([["o_custkey", "prio", "status", "year", "month"], ["o_custkey", "year", "supp"]],
                              *grains).agg(*_sums(MEASURES), F.grouping("supp").alias("__orders"))
    # Order rows have no supplier: keys of their own, that match none, spread them evenly.
    spread = F.lit(NO_SUPPLIER - 1) - F.pmod(F.xxhash64("o_custkey"), F.lit(1_000_000))
    key = F.when(F.col("__orders") == 1, spread).otherwise(F.col("supp"))
    su = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", nation_code(F.col("s_nationkey")).alias("__sn"))
    keyed = both.withColumn("__key", key)
    named = keyed.join(su, keyed["__key"] == su.s_suppkey, "left")
    sn = F.when(F.col("__orders") == 0, F.coalesce("__sn", F.lit(NO_NATION)))
    cells = ["prio", "status", "year", "month", "sn"]
    kind = F.when(F.col("__orders") == 1, F.lit("order")).otherwise(F.lit("supplier"))
    per_customer = (named.withColumn("sn", sn).withColumn("kind", kind)
                         .groupBy("kind", "o_custkey", *cells).agg(*_sums(MEASURES)))
    cu = _customers(spark, sf_dir)
    out = per_customer.join(cu, per_customer.o_custkey == cu.c_custkey)
    return _resum(out, ["kind", "cc", "seg", *cells], MEASURES)


def month_cells(facts: DataFrame) -> DataFrame:
    """The ``order`` cube of ``fact_cells`` (partition-pruned on ``kind``)."""
    return facts.filter(F.col("kind") == "order").select(
        "cc", "seg", "prio", "status", "year", "month", *MEASURES)


def supplier_cells(facts: DataFrame) -> DataFrame:
    """The ``supplier`` cube of ``fact_cells``: (cc, seg, year, sn, n)."""
    return facts.filter(F.col("kind") == "supplier").select(
        "cc", "seg", "year", "sn", F.col("n_T").alias("n"))


def _resum(cells: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    return cells.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def _rollup(cells: DataFrame, levels: list[list[str]], keys: list[str],
            measures: list[str], ref: tuple[str, ...], published_until: int | None) -> DataFrame:
    """All geo levels from the finest cells plus the published reference-group
    aggregate, in ONE aggregation (one grouping set per level, one for the
    aggregate), so the fact pipeline below is evaluated once.

    ``keys`` are carried in every set. Rolled-up parts are NULL in their
    grouping set and ``concat_ws`` skips them; a part that is NULL in the data
    gets the code ``NO_PART``, so its cell does not pass for its parent.
    """
    parts = list(dict.fromkeys(x for lv in levels for x in lv))
    cells = cells.withColumns({p: F.coalesce(F.col(p), F.lit(NO_PART)) for p in parts})
    sums = [F.sum(m).alias(m) for m in measures]
    sets = [["year", *keys, *lv] for lv in levels]
    cols = ["year", *keys, *parts]
    src = cells
    if published_until is not None:
        member = F.col("cc").isin(list(ref)) & (F.col("year") <= published_until)
        src = cells.withColumn("__grp", F.when(member, F.lit(EU27_AGGREGATE)))
        sets.append(["year", *keys, "__grp"])
        cols.append("__grp")
        gs = src.groupingSets(sets, *cols).agg(*sums, F.grouping("__grp").alias("__in_grp"))
        is_grp = F.col("__in_grp") == 0
        geo = F.when(is_grp, F.col("__grp")).otherwise(F.concat_ws("", *parts))
        gs = gs.filter(~is_grp | F.col("__grp").isNotNull())
    else:
        gs = src.groupingSets(sets, *cols).agg(*sums)
        geo = F.concat_ws("", *parts)
    return gs.select(*keys, "year", geo.alias("geo"), *measures)


def _suppressed(value: Column, lines: Column, year: Column) -> tuple[Column, Column]:
    v = F.when(lines != 1, value)
    flag = (F.when(lines == 1, F.lit("n"))
             .when(year == F.lit(PROVISIONAL_YEAR), F.lit("p")))
    return v, flag


def annual_obs(mcells: DataFrame, ref: tuple[str, ...]) -> DataFrame:
    """Raw annual observations: freq, unit, cat, geo, year, value, flag."""
    cells = _resum(mcells, ["cc", "seg", "prio", "status", "year"], MEASURES)
    lv = _rollup(cells, [["cc"], ["cc", "seg"], ["cc", "seg", "prio"], ["cc", "seg", "prio", "status"]],
                 [], MEASURES, ref, PUBLISHED_UNTIL)
    items = []
    for cat in (TOTAL, *CATS):
        sfx = "T" if cat == TOTAL else cat
        n, a, o = F.col(f"n_{sfx}"), F.col(f"a_{sfx}"), F.col(f"o_{sfx}")
        per_unit = {
            "NR": n.cast("double"),
            "MIO_EUR": a.cast("double"),
            "EUR_HAB": F.floor(a / o).cast("double"),
            "PC": round_half_away(n.cast("double") * F.lit(100.0) / F.col("n_T").cast("double"), 1),
        }
        for unit, expr in per_unit.items():
            items.append(F.struct(F.lit(unit).alias("unit"), F.lit(cat).alias("cat"),
                                  expr.alias("value"), n.alias("lines")))
    long = (lv.select("geo", "year", F.explode(F.array(*items)).alias("o"))
              .select("geo", "year", "o.*").filter(F.col("lines") > 0))
    value, flag = _suppressed(F.col("value"), F.col("lines"), F.col("year"))
    return long.select(F.lit("A").alias("freq"), "unit", "cat", "geo",
                       F.col("year").cast("int").alias("year"), value.alias("value"), flag.alias("flag"))


def monthly_obs(mcells: DataFrame, ref: tuple[str, ...]) -> DataFrame:
    """Raw monthly line counts by category, country and NUTS1."""
    meas = ["n_T"] + [f"n_{c}" for c in CATS]
    cells = _resum(mcells, ["cc", "seg", "year", "month"], meas)
    lv = _rollup(cells, [["cc"], ["cc", "seg"]], ["month"], meas, ref, None)
    items = [F.struct(F.lit(cat).alias("cat"), F.col("n_T" if cat == TOTAL else f"n_{cat}").alias("lines"))
             for cat in (TOTAL, *CATS)]
    long = (lv.select("geo", "year", "month", F.explode(F.array(*items)).alias("o"))
              .select("geo", "year", "month", "o.*").filter(F.col("lines") > 0))
    value, flag = _suppressed(F.col("lines").cast("double"), F.col("lines"), F.col("year"))
    return long.select(F.lit("M").alias("freq"), F.lit("NR").alias("unit"), "cat", "geo",
                       F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"),
                       value.alias("value"), flag.alias("flag"))


def quarterly_obs(mcells: DataFrame, ref: tuple[str, ...]) -> DataFrame:
    """Raw quarterly line counts by category, with a ``YYYY-Qn`` period."""
    meas = ["n_T"] + [f"n_{c}" for c in CATS]
    cells = _resum(mcells.withColumn("quarter", F.ceil(F.col("month") / F.lit(3))),
                   ["cc", "year", "quarter"], meas)
    lv = _rollup(cells, [["cc"]], ["quarter"], meas, ref, 10_000)
    items = [F.struct(F.lit(cat).alias("cat"), F.col("n_T" if cat == TOTAL else f"n_{cat}").alias("lines"))
             for cat in (TOTAL, *CATS)]
    long = (lv.select("geo", "year", "quarter", F.explode(F.array(*items)).alias("o"))
              .select("geo", "year", "quarter", "o.*").filter(F.col("lines") > 0))
    value, flag = _suppressed(F.col("lines").cast("double"), F.col("lines"), F.col("year"))
    period = F.concat(F.col("year").cast("string"), F.lit("-Q"), F.col("quarter").cast("string"))
    return long.select(F.lit("Q").alias("freq"), F.lit("NR").alias("unit"), "cat", "geo",
                       period.alias("year"), value.alias("value"), flag.alias("flag"))


def citizen_obs(scells: DataFrame, ref: tuple[str, ...]) -> DataFrame:
    """Raw line counts by supplier nation ("citizenship") of each line.

    ``citizen`` is the supplier nation code, plus TOTAL, NAT (supplier of the
    customer's own nation) and EU (supplier inside the reference group).
    ``scells`` are the supplier cells of ``fact_cells`` (cc, seg, year, sn, n).
    """
    cells = scells
    by_nation = _rollup(cells, [["cc"], ["cc", "seg"]], ["sn"], ["n"], ref, None)
    totals = cells.select(
        "cc", "seg", "year", "n",
        F.when(F.col("sn") == F.col("cc"), F.col("n")).otherwise(F.lit(0)).alias("n_nat"),
        F.when(F.col("sn").isin(list(ref)), F.col("n")).otherwise(F.lit(0)).alias("n_grp"))
    tot = _rollup(totals, [["cc"], ["cc", "seg"]], [], ["n", "n_nat", "n_grp"], ref, None)
    tot_long = (tot.select("geo", "year", F.explode(F.array(
        F.struct(F.lit(CITIZEN_TOTAL).alias("citizen"), F.col("n").alias("lines")),
        F.struct(F.lit(CITIZEN_NATIONAL).alias("citizen"), F.col("n_nat").alias("lines")),
        F.struct(F.lit(CITIZEN_GROUP).alias("citizen"), F.col("n_grp").alias("lines")),
    )).alias("o")).select("geo", "year", "o.*"))
    nat_long = by_nation.select("geo", "year", F.col("sn").alias("citizen"), F.col("n").alias("lines"))
    long = nat_long.unionByName(tot_long).filter(F.col("lines") > 0)
    value, flag = _suppressed(F.col("lines").cast("double"), F.col("lines"), F.col("year"))
    return long.select(F.lit("A").alias("freq"), F.lit("NR").alias("unit"), "citizen", "geo",
                       F.col("year").cast("int").alias("year"), value.alias("value"), flag.alias("flag"))


# ------------------------------------------------------------ dimensions
def codelist(spark: SparkSession, mapping: dict) -> DataFrame:
    """A (code, label_en) codelist from fixed values."""
    return literal_frame(spark, list(mapping.items()), ["code", "label_en"])


def geo_inputs(spark: SparkSession, sf_dir: str, codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(labels, annotations) for the geo codes present in the cube.

    Labels: nation name for countries, nation name + regional suffix below;
    annotations: LEVEL = code length - 2, and IS_STANDARD_CODE = 'O' for the
    NUTS1 codes of OBSOLETE_NATION. The aggregate carries no LEVEL.
    """
    nat = read_table(spark, sf_dir, "nation").select(
        nation_code(F.col("n_nationkey")).alias("cc"), F.col("n_name"))
    nat = bounded_broadcast(nat)
    c = codes.select("code").distinct()
    lab = c.join(nat, F.substring(c.code, 1, 2) == nat.cc, "left")
    label = (F.when(F.col("code") == F.lit(EU27_AGGREGATE), F.lit(AGGREGATE_LABEL))
              .when(F.length("code") == 2, F.col("n_name"))
              .otherwise(F.concat_ws(" ", F.col("n_name"), F.substring(F.col("code"), 3, 10))))
    labels = lab.select("code", label.alias("label_en"))
    real = c.filter(F.col("code") != F.lit(EU27_AGGREGATE))
    level = real.select("code", F.lit("LEVEL").alias("type"),
                        (F.length("code") - F.lit(2)).cast("string").alias("title"))
    obsolete = (real.filter((F.length("code") == 3) & F.col("code").startswith(OBSOLETE_NATION))
                    .select("code", F.lit("IS_STANDARD_CODE").alias("type"), F.lit("O").alias("title")))
    return labels, level.unionByName(obsolete)


def geo_table(spark: SparkSession, sf_dir: str, codes: DataFrame) -> DataFrame:
    labels, ann = geo_inputs(spark, sf_dir, codes)
    return build_geo(labels, ann)


def clean_annual(spark: SparkSession, obs: DataFrame, geo: DataFrame) -> DataFrame:
    return clean_observations(
        obs, ["freq", "unit", "cat", "geo"], geo,
        codelists={"freq": codelist(spark, FREQ_LABELS), "unit": codelist(spark, UNIT_LABELS),
                   "cat": codelist(spark, CAT_LABELS)},
        flags=codelist(spark, FLAG_LABELS))


def clean_monthly(spark: SparkSession, obs: DataFrame, geo: DataFrame) -> DataFrame:
    from regiocube.constants import MONTH_LABELS
    return clean_observations(
        obs, ["freq", "unit", "cat", "geo"], geo,
        codelists={"freq": codelist(spark, FREQ_LABELS), "unit": codelist(spark, UNIT_LABELS),
                   "cat": codelist(spark, CAT_LABELS)},
        flags=codelist(spark, FLAG_LABELS),
        label_maps={"month": (MONTH_LABELS, None)}, extra_time=["month"])


def clean_quarterly(spark: SparkSession, obs: DataFrame, geo: DataFrame) -> DataFrame:
    split = with_period_split(obs, "year")
    return clean_observations(
        split, ["freq", "unit", "cat", "geo"], geo,
        codelists={"freq": codelist(spark, FREQ_LABELS), "unit": codelist(spark, UNIT_LABELS),
                   "cat": codelist(spark, CAT_LABELS)},
        flags=codelist(spark, FLAG_LABELS), with_parent=False, extra_time=["quarter"])


CITIZEN_LABELS = {CITIZEN_TOTAL: "Total", CITIZEN_NATIONAL: "Reporting country",
                  CITIZEN_GROUP: "Reference group"}


def citizen_codelist(spark: SparkSession, geo: DataFrame) -> DataFrame:
    """Country labels of the geo hierarchy plus the aggregate citizen codes."""
    countries = geo.filter(F.col("nuts_level") == "country").select("code", "label_en")
    return countries.unionByName(codelist(spark, CITIZEN_LABELS))


def clean_citizen(spark: SparkSession, obs: DataFrame, geo: DataFrame) -> DataFrame:
    return clean_observations(
        obs, ["freq", "unit", "citizen", "geo"], geo,
        codelists={"freq": codelist(spark, FREQ_LABELS), "unit": codelist(spark, UNIT_LABELS),
                   "citizen": citizen_codelist(spark, geo)},
        flags=codelist(spark, FLAG_LABELS))
