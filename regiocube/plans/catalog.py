"""Catalogue of the published regional dataflows as DatasetSpecs.

The tables below are FIXED VALUES: for every dataflow its raw dimensions,
codelist-labelled dims, reference slice, benchmark partition dims, rounding,
synthesis variant and metric names, trend parameters, and mart grains /
minimum-row gates. The operators are generic; these rows only parameterise
them, so a published mart is ``CATALOG[slug].marts[i].build(clean)``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocube.constants import MONTH_LABELS, SEX_LABELS
from regiocube.functions.codes import is_country_citizen
from regiocube.operators import benchmark as bm
from regiocube.operators import position as po
from regiocube.operators import shares as sh
from regiocube.operators import synthesis as sy
from regiocube.operators import trend as tr
from regiocube.plans.spec import DatasetSpec, MartSpec

# --- FIXED VALUES: standard analytical dataflows --------------------------
# slug, dataflow, raw dims, codelist dims,
# reference slice, benchmark partition dims, media rounding,
# synthesis (variant, metric, extra), trend (keys, abs rounding, cagr rounding),
# benchmark key, benchmark min rows
_STD = [
    ("area-nuts3", "REG_AREA3", "freq,landuse,unit,geo", "landuse",
     {"unit": "KM2", "landuse": "TOTAL"}, "unit,landuse", 2,
     ("pivot", "superficie_km2", {}), ("geo", 2, 3), "year,geo,unit,landuse", 1000),
    ("bd-hgnace2-r3-nuts3", "BD_HGNACE2_R3", "freq,indic_sb,nace_r2,geo", "indic_sb,nace_r2",
     {"indic_sb": "V11920", "nace_r2": "B-S_X_K642"}, "indic_sb,nace_r2", 1,
     ("direct", "nascite_imprese", {"round": 0}), ("geo", 1, 3), "year,geo,indic_sb,nace_r2", 100),
    ("business-demography-nuts3", "BD_SIZE_R3", "freq,indic_sb,sizeclas,nace_r2,geo",
     "indic_sb,sizeclas,nace_r2",
     {"indic_sb": "V11920", "sizeclas": "TOTAL", "nace_r2": "B-S_X_K642"}, "indic_sb,sizeclas,nace_r2", 1,
     ("rollup", "nascite_imprese", {"agg": "sum", "round": 0}), ("geo", 1, 3),
     "year,geo,indic_sb,sizeclas,nace_r2", 100),
    ("crime-nuts3", "CRIM_GEN_REG", "freq,iccs,unit,geo", "iccs",
     {"unit": "P_HTHAB"}, "iccs,unit", 2,
     ("pivot", "reati_per_100k", {"dims": ["iccs"]}), ("geo,iccs", 2, 3), "year,geo,iccs,unit", 10000),
    ("cultural-employment-nuts2", "CULT_EMP_REG", "freq,unit,geo", "",
     {"unit": "PC_EMP"}, "unit", 2,
     ("pivot", "quota_occupazione_culturale_pct", {}), ("geo", 2, 3), "year,geo,unit", 5000),
    ("demo-balance-nuts3", "DEMO_R_GIND3", "freq,indic_de,geo", "indic_de",
     {"indic_de": "GROWRT"}, "indic_de", 2,
     ("pivot", "crescita_per_1000", {}), ("geo", 2, 3), "year,geo,indic_de", 1000),
    ("demo-r-fagec3-nuts3", "DEMO_R_FAGEC3", "freq,age,unit,geo", "",
     {"unit": "NR", "age": "TOTAL"}, "unit,age", 2,
     ("rollup", "nascite", {"agg": "sum", "round": 0}), ("geo", 2, 3), "year,geo,unit,age", 1000),
    ("demo-r-magec3-nuts3", "DEMO_R_MAGEC3", "freq,sex,unit,age,geo", "",
     {"unit": "NR", "age": "TOTAL", "sex": "T"}, "unit,age,sex", 2,
     ("rollup", "decessi", {"agg": "sum", "round": 0}), ("geo", 2, 3), "year,geo,unit,sex,age", 1000),
    ("demo-r-pjangrp3-nuts3", "DEMO_R_PJANGRP3", "freq,sex,unit,age,geo", "",
     {"unit": "NR", "age": "TOTAL", "sex": "T"}, "unit,age,sex", 2,
     ("rollup", "popolazione", {"agg": "sum", "round": 0}), ("geo", 2, 3), "year,geo,unit,sex,age", 1000),
    ("early-school-leavers-nuts2", "EDAT_LFSE_16", "freq,unit,sex,age,geo", "",
     {"unit": "PC", "sex": "T"}, "unit,sex", 2,
     ("pivot", "abbandono_pct", {}), ("geo", 2, 3), "year,geo,unit,sex,age", 1000),
    ("emp-nuts3", "NAMA_10R_3EMPERS", "freq,unit,wstatus,nace_r2,geo", "nace_r2,wstatus",
     {"unit": "THS", "wstatus": "EMP", "nace_r2": "TOTAL"}, "unit,wstatus,nace_r2", 2,
     ("pivot", "occupati_migliaia", {}), ("geo", 2, 3), "year,geo,unit,wstatus,nace_r2", 1000),
    ("employment-sex-age-nuts2", "LFST_R_LFE2EMPRT", "freq,sex,unit,age,geo", "",
     {"unit": "PC", "age": "Y15-64", "sex": "T"}, "unit,age,sex", 2,
     ("direct", "employment_rate_pct", {"round": 1}), ("geo", 2, 3), "year,geo,unit,sex,age", 500),
    ("energy-poverty-nuts2", "ILC_MDES01_R", "freq,unit,geo", "",
     {"unit": "PC"}, "unit", 2,
     ("pivot", "energy_poverty_pct", {}), ("geo", 2, 3), "year,geo,unit", 1000),
    ("fertility-nuts3", "DEMO_R_FIND3", "freq,indic_de,unit,geo", "indic_de",
     {"unit": "NR", "indic_de": "TOTFERRT"}, "unit,indic_de", 2,
     ("pivot", "tasso_fertilita", {}), ("geo", 2, 3), "year,geo,unit,indic_de", 1000),
    ("gdp-nuts3", "NAMA_10R_3GDP", "freq,unit,geo", "",
     {"unit": "EUR_HAB"}, "unit", 1,
     ("reconciled", "gdp_procapite", {}), ("geo", 1, 2), "year,geo,unit", 1000),
    ("gva-nuts3", "NAMA_10R_3GVA", "freq,nace_r2,unit,geo", "nace_r2",
     {"unit": "CP_MEUR", "nace_r2": "TOTAL"}, "unit,nace_r2", 2,
     ("pivot", "gva_mio_eur", {}), ("geo", 2, 3), "year,geo,unit,nace_r2", 1000),
    ("heating-degree-days-monthly-nuts3", "NRG_CHDDR2_M", "freq,unit,indic_nrg,geo", "indic_nrg",
     {"unit": "NR", "indic_nrg": "HDD"}, "month,unit,indic_nrg", 1,
     ("pivot", "hdd_mensile", {"dims": ["month"]}), ("geo,month", 1, 3),
     "year,geo,unit,indic_nrg,month", 1000),
    ("hospital-beds-nuts2", "HLTH_RS_BDSRG2", "freq,unit,geo", "",
     {"unit": "P_HTHAB"}, "unit", 2,
     ("pivot", "posti_letto_per_100k", {}), ("geo", 2, 3), "year,geo,unit", 5000),
    ("income-inequality-nuts2", "ILC_DI11_R", "freq,unit,geo", "",
     {"unit": "INX"}, "unit", 2,
     ("pivot", "s80s20_ratio", {}), ("geo", 2, 3), "year,geo,unit", 3000),
    ("labour-productivity-nuts3", "NAMA_10R_3NLP", "freq,na_item,unit,geo", "na_item",
     {"unit": "EUR", "na_item": "NLPR_PER"}, "unit,na_item", 1,
     ("pivot", "produttivita_eur", {}), ("geo", 1, 3), "year,geo,unit,na_item", 1000),
    ("ltc-beds", "HLTH_RS_BDLTC", "freq,unit,geo", "",
     {"unit": "P_HTHAB"}, "unit", 2,
     ("ltc", "posti_letto_per_100k", {}), ("geo", 2, 3), "year,geo,unit", 500),
    ("nrg-chddr2-a-nuts3", "NRG_CHDDR2_A", "freq,unit,indic_nrg,geo", "indic_nrg",
     {"unit": "NR", "indic_nrg": "HDD"}, "unit,indic_nrg", 2,
     ("pivot", "hdd_nr", {}), ("geo", 2, 3), "year,geo,unit,indic_nrg", 1000),
    ("physicians-nuts2", "HLTH_RS_PHYSREG", "freq,unit,geo", "",
     {"unit": "P_HTHAB"}, "unit", 2,
     ("pivot", "medici_per_100k", {}), ("geo", 2, 3), "year,geo,unit", 5000),
    ("pop-density-nuts3", "DEMO_R_D3DENS", "freq,unit,geo", "",
     {"unit": "PER_KM2"}, "unit", 1,
     ("pivot", "densita_km2", {}), ("geo", 1, 3), "year,geo,unit", 1000),
    ("pop-nuts3", "DEMO_R_D2JAN", "freq,sex,unit,age,geo", "",
     {"unit": "NR", "age": "TOTAL", "sex": "T"}, "unit,age,sex", 2,
     ("direct", "popolazione", {"round": 0}), ("geo", 2, 3), "year,geo,unit,sex,age", 1000),
    ("pop-structure-nuts3", "DEMO_R_PJANIND3", "freq,indic_de,unit,geo", "indic_de",
     {"unit": "PC", "indic_de": "OLDDEP2"}, "unit,indic_de", 2,
     ("pivot", "dipendenza_anziani_pct", {}), ("geo", 2, 3), "year,geo,unit,indic_de", 1000),
    ("poverty-risk-nuts2", "ILC_LI41", "freq,unit,geo", "",
     {"unit": "PC"}, "unit", 2,
     ("pivot", "rischio_poverta_pct", {}), ("geo", 2, 3), "year,geo,unit", 3000),
    ("rd-expenditure-nuts2", "RD_E_GERDREG", "freq,sectperf,unit,geo", "sectperf",
     {"unit": "PC_GDP", "sectperf": "TOTAL"}, "unit,sectperf", 2,
     ("pivot", "rd_pct_pil", {}), ("geo", 2, 3), "year,geo,unit,sectperf", 1000),
    ("road-freight-nuts3", "ROAD_GO_NA_RU3G", "freq,nst07,unit,geo", "nst07",
     {"nst07": "TOTAL", "unit": "THS_T"}, "nst07,unit", 2,
     ("covered", "tonnellate_migliaia", {}), ("geo", 2, 3), "year,geo,nst07,unit", 1000),
    ("soil-erosion-nuts3", "AEI_PR_SOILER", "freq,levels,clc18,unit,geo", "levels,clc18",
     {"unit": "T", "levels": "TOTAL", "clc18": "CLC2_3X331_332_335"}, "unit,levels,clc18", 2,
     ("pivot", "erosione_tonn", {}), ("geo", 2, 3), "year,geo,unit,levels,clc18", 100),
    ("tertiary-education-nuts2", "TGS00109", "freq,unit,isced11,age,sex,geo", "",
     {"unit": "PC", "isced11": "ED5-8", "age": "Y25-64", "sex": "T"}, "unit,isced11,age,sex", 2,
     ("rollup", "istruzione_terziaria_pct", {"agg": "avg", "round": 1}), ("geo", 2, 3),
     "year,geo,unit,isced11,age,sex", 1000),
    ("tourism-nuts3", "TOUR_OCC_NIN2", "freq,c_resid,unit,nace_r2,geo", "c_resid,nace_r2",
     {"unit": "NR", "c_resid": "TOTAL", "nace_r2": "I551-I553"}, "unit,c_resid,nace_r2", 2,
     ("pivot", "pernottamenti", {}), ("geo", 2, 3), "year,geo,unit,c_resid,nace_r2", 1000),
    ("tran-sf-roadnu", "TRAN_SF_ROADNU", "freq,unit,geo", "",
     {"unit": "P_MHAB"}, "unit", 2,
     ("pivot", "incidenti_per_milione", {}), ("geo", 2, 3), "year,geo,unit", 1000),
]

# --- FIXED VALUES: inline label maps used at clean time --------------------
_LABEL_MAPS = {
    "demo-r-magec3-nuts3": {"sex": (SEX_LABELS, "code"), "age": ({}, "code")},
    "demo-r-pjangrp3-nuts3": {"sex": (SEX_LABELS, "code"), "age": ({}, "code")},
    "pop-nuts3": {"sex": (SEX_LABELS, "code"), "age": ({}, "code")},
    "employment-sex-age-nuts2": {"sex": (SEX_LABELS, "code"), "age": ({}, "code")},
    "demo-r-fagec3-nuts3": {"age": ({}, "code")},
    "early-school-leavers-nuts2": {"sex": (SEX_LABELS, None), "age": ({"Y18-24": "From 18 to 24 years"}, None)},
    "tertiary-education-nuts2": {"isced11": ({"ED5-8": "Tertiary education (levels 5-8)"}, None),
                                 "age": ({"Y25-64": "From 25 to 64 years"}, None),
                                 "sex": (SEX_LABELS, None)},
    "heating-degree-days-monthly-nuts3": {"month": (MONTH_LABELS, None)},
}


def _csv(s: str) -> list[str]:
    return [x for x in s.split(",") if x]


def _synthesis(variant: str, metric: str, extra: Mapping, slice_: Mapping) -> MartSpec:
    dims = extra.get("dims", [])
    key = ("year", *dims, "country") if dims else ("year", "country")
    if variant == "pivot":
        build = partial(sy.country_synthesis, metrics={metric: slice_}, dims=dims)
    elif variant == "rollup":
        build = partial(sy.country_rollup, slice_=slice_, metric=metric, level="NUTS2",
                        agg=extra["agg"], round_metric=extra["round"])
    elif variant == "direct":
        build = partial(sy.country_direct, slice_=slice_, metric=metric, round_metric=extra["round"])
    elif variant == "covered":
        build = partial(sy.country_rollup_covered, slice_=slice_, metric=metric, level="NUTS3")
    elif variant == "reconciled":
        build = partial(sy.country_synthesis_reconciled,
                        metrics={"gdp_procapite": {"unit": "EUR_HAB"}, "gdp_totale_mio": {"unit": "MIO_EUR"}},
                        rank_cols={"gdp_procapite": "rank_procapite_eu", "gdp_totale_mio": "rank_totale_eu"},
                        reconcile={"unit": "MIO_EUR"}, reconcile_col="gdp_nuts3_sum_mio")
    elif variant == "ltc":
        build = partial(sy.country_synthesis,
                        metrics={"posti_letto": {"unit": "NR"}, "posti_letto_per_100k": {"unit": "P_HTHAB"},
                                 "abitanti_per_posto_letto": {"unit": "HAB_P"}},
                        rank_by="posti_letto_per_100k", rank_col="rank_eu", with_label=True, emit_is_eu=True)
    else:
        raise ValueError(variant)
    rank = {"ltc": "rank_eu", "covered": "rank_eu"}.get(variant, "rank_procapite_eu")
    order = ("-year", *dims, rank) + (("country",) if variant == "covered" else ())
    required = (metric, rank, *dims, *_SYNTHESIS_MORE.get(variant, ()))
    return MartSpec("mart_sintesi", build, key, 100 if "iccs" in dims else 30, order, required)


# --- FIXED VALUES: published order, gates and required columns -------------
#: Benchmark marts that are not ordered by (year DESC, nuts_level, country, geo, dims).
_BENCHMARK_ORDER = {
    "crime-nuts3": ("-year", "iccs", "nuts_level", "country", "geo", "unit"),
    "emp-nuts3": ("-year", "nuts_level", "country", "geo", "unit", "nace_r2"),
    "heating-degree-days-monthly-nuts3": ("-year", "month", "nuts_level", "country", "geo", "unit", "indic_nrg"),
    "ltc-beds": ("-year", "country", "unit"),
    "road-freight-nuts3": ("-year", "nuts_level", "country", "geo", "nst07"),
}
#: Trend marts that are not ordered by (country, nuts_level, geo).
_TREND_ORDER = {
    "crime-nuts3": ("country", "iccs", "nuts_level", "geo"),
    "heating-degree-days-monthly-nuts3": ("country", "month", "nuts_level", "geo"),
    "ltc-beds": ("country", "geo"),
}
_TREND_MIN_ROWS = {"crime-nuts3": 1000, "gdp-nuts3": 1000, "ltc-beds": 30}
_SYNTHESIS_MORE = {"reconciled": ("gdp_totale_mio",), "covered": ("copertura_pct",)}
_TREND_REQUIRED = ("geo", "geo_label_en", "first_year", "last_year", "cagr_pct")
#: Dims whose label the clean table need not carry.
_UNLABELLED = {
    "emp-nuts3": ("wstatus",),
    "migr-eirtn": ("freq", "unit"),
    "migr-pop1ctz": ("freq", "unit"),
    "migr-resfirst": ("freq", "unit"),
    "migr-resvalid": ("freq", "unit"),
    "tran-hv-frmod": ("freq", "unit"),
    "tran-hv-psmod": ("freq", "unit"),
    "tran-r-net": ("freq", "unit"),
    "tran-r-vehst": ("freq", "unit"),
    "jvs-nace2": ("freq",),
}


def _standard(row) -> DatasetSpec:
    (slug, flow, dims, cl_dims, slice_, bdims, rmedia, synth, trend_p, bkey, bmin) = row
    tkeys, rabs, rcagr = trend_p
    carry = [k for k in _csv(bkey) if k not in ("year", "geo") and k not in _csv(bdims)]
    bench = partial(bm.geo_benchmark, slice_=slice_, dims=_csv(bdims), round_media=rmedia,
                    level_in_partition=(slug != "ltc-beds"), carry_dims=carry)
    tkey_list = _csv(tkeys)
    trend_carry = ("geo_label_en", "nuts_level", "country") + tuple(
        f"{k}_label_en" for k in tkey_list if k != "geo")
    trend = partial(tr.trend, slice_=slice_, keys=tuple(tkey_list), carry=trend_carry, round_abs=rabs,
                    round_cagr=rcagr, guard_last_nonneg=(slug == "road-freight-nuts3"))
    raw_dims = _csv(dims)
    month = "month" in bdims
    # Dims outside the partition (carried for the grain) order last.
    order = _BENCHMARK_ORDER.get(slug, ("-year", "nuts_level", "country", "geo", *_csv(bdims), *carry))
    required = ("year", "geo", "geo_label_en", "country", *(("unit",) if "unit" in raw_dims else ()), "value",
                *(d for d in ("iccs", "nst07") if d in raw_dims))
    return DatasetSpec(
        slug=slug, dataflow=flow,
        dims=tuple(raw_dims),
        codelist_dims=tuple(_csv(cl_dims)),
        label_maps=_LABEL_MAPS.get(slug, {}),
        period="month" if month else "year",
        not_null=("geo", "year", "month") if month else ("geo", "year"),
        unlabelled=_UNLABELLED.get(slug, ()),
        marts=(
            MartSpec("mart_geo_benchmark", bench, tuple(_csv(bkey)), bmin, order, required),
            _synthesis(*synth, slice_=slice_),
            MartSpec("mart_trend", trend, tuple(tkey_list), _TREND_MIN_ROWS.get(slug, 100),
                     _TREND_ORDER.get(slug, ("country", "nuts_level", "geo")),
                     _TREND_REQUIRED + tuple(k for k in tkey_list if k != "geo"),
                     slice_=slice_, slice_key=(*tkey_list, "year")),
        ),
    )


CATALOG: dict[str, DatasetSpec] = {row[0]: _standard(row) for row in _STD}

# --- FIXED VALUES: the remaining dataflows and their domain marts ---------
_MIGR_NR = {"unit": "NR", "sex": "T", "age": "TOTAL", "agedef": "REACH"}
_ASY = {"unit": "PER", "sex": "T", "age": "TOTAL"}
_RES = {"unit": "PER", "citizen": "TOTAL", "duration": "TOTAL"}
_REASONS = ["FAM", "EDUC", "EMP", "OTH"]


def _spec(slug, flow, dims, cl_dims, marts, **kw) -> DatasetSpec:
    return DatasetSpec(slug=slug, dataflow=flow, dims=tuple(_csv(dims)), codelist_dims=tuple(_csv(cl_dims)),
                       unlabelled=_UNLABELLED.get(slug, ()), marts=tuple(marts), **kw)


_RATE_COLUMNS = ("tasso_riconoscimento_it_pct", "tasso_riconoscimento_ue27_pct")
_GAP_COLUMNS = ("quota_it_pct", "quota_ue27_pct", "delta_pp")


def _position(slice_, measure, strategy, rate=None):
    return MartSpec("mart_benchmark_it", partial(po.position_share, slice_=slice_, focus="IT",
                                                 eu_total=strategy, measure=measure, rate=rate),
                    ("year",), 15, ("year",), (f"{measure}_it", "posizione_it", "n_paesi", f"{measure}_ue27",
                                               "quota_it_su_ue27_pct", *_RATE_COLUMNS * (rate is not None)))


def _citizens(name, slice_, measure, min_rows):
    return MartSpec(name, partial(sh.citizenship_slice, slice_=slice_, measure=measure),
                    ("year", "geo", "citizen"), min_rows, ("year", "geo", f"-{measure}"),
                    ("country", "citizen", measure) if "mart_popolazione" not in name else ("citizen", measure))


def _flagged(name, slice_, cat, totals, measure, flag_col, min_rows):
    return MartSpec(name, partial(sh.flagged_slice, slice_=slice_, cat=cat, totals=totals, measure=measure,
                                  flag_col=flag_col), ("year", "geo", cat), min_rows, ("year", "geo", cat),
                    ("country", flag_col, measure))


def _jvs_extract(where, cols, rename=None):
    return lambda clean: sh.extract(clean, where(), cols, rename)


CATALOG.update({
    "gfcf-nuts2": _spec(
        "gfcf-nuts2", "NAMA_10R_2GFCF", "freq,sector,currency,nace_r2,geo", "nace_r2", [
            MartSpec("mart_geo_benchmark", partial(
                bm.geo_benchmark_joined, fixed={"sector": "S1", "currency": "MIO_EUR", "nace_r2": "TOTAL"},
                carry_dims=["nace_r2", "currency"]), ("year", "geo"), 1000, ("year", "geo"),
                ("geo_label_en", "country", "value", "media_eu_value")),
            MartSpec("mart_sintesi", partial(
                sy.country_ranking, fixed={"sector": "S1", "currency": "MIO_EUR", "nace_r2": "TOTAL"},
                metric="gfcf_totale_mio"), ("year", "country"), 30, ("year", "country"),
                ("gfcf_totale_mio", "rank_totale_eu")),
        ]),
    "internet-access-nace-nuts2": _spec(
        "internet-access-nace-nuts2", "ISOC_R_CI_IN_EN2", "freq,size_emp,indic_is,unit,nace_r2,geo",
        "size_emp,indic_is,nace_r2", [
            MartSpec("mart_geo_benchmark", partial(
                bm.geo_benchmark_published,
                fixed={"nace_r2": "C10-S951_X_K", "size_emp": "GE10", "unit": "PC_ENT"}, dims=["indic_is"]),
                ("year", "geo", "indic_is"), 500, ("year", "geo", "indic_is"),
                ("geo_label_en", "country", "value", "valore_eu27", "media_eu_value")),
            MartSpec("mart_sintesi", partial(
                sy.country_vs_published, fixed={"nace_r2": "C10-S951_X_K", "size_emp": "GE10", "unit": "PC_ENT"},
                dims=["indic_is"], metric="quota_imprese_pct"), ("year", "country", "indic_is"), 100,
                ("year", "indic_is", "country"), ("is_eu", "quota_imprese_pct", "valore_eu27", "rank_eu")),
        ]),
    "jvs-nace2": _spec(
        "jvs-nace2", "JVS_Q_NACE2", "freq,s_adj,nace_r2,sizeclas,indic_em,geo", "", [
            MartSpec("mart_quarterly", _jvs_extract(
                lambda: F.col("s_adj") == "NSA",
                ["year", "quarter", "geo", "geo_label_en", "nuts_level", "country", "nace_r2", "indic_em",
                 "sizeclas", "s_adj", "value"]),
                ("year", "quarter", "geo", "nace_r2", "s_adj", "sizeclas", "indic_em"), 500,
                ("geo", "year", "quarter", "nace_r2", "indic_em"), ("value",)),
            MartSpec("mart_italia", _jvs_extract(
                lambda: (F.col("geo") == "IT") & F.col("nace_r2").isin("B-N", "_T") & (F.col("s_adj") == "NSA")
                & (F.col("indic_em") == "JVR") & (F.col("sizeclas") == "TOTAL"),
                ["year", "quarter", "value"], {"value": "vacancy_rate_pct"}), ("year", "quarter"), 30,
                ("year", "quarter"), ("vacancy_rate_pct",)),
            MartSpec("mart_confronto", _jvs_extract(
                lambda: F.col("geo").isin("IT", "EU27_2020", "DE", "FR", "ES", "NL", "BE", "AT", "PL", "SE",
                                          "DK", "FI")
                & F.col("nace_r2").isin("B-N", "_T") & (F.col("s_adj") == "NSA")
                & (F.col("indic_em") == "JVR") & (F.col("sizeclas") == "TOTAL"),
                ["year", "quarter", "geo", "geo_label_en", "value"], {"value": "vacancy_rate_pct"}),
                ("year", "quarter", "geo"), 100, ("geo", "year", "quarter"), ("vacancy_rate_pct",)),
        ], period="quarter", with_parent=False, drop_incomplete=True, min_rows=1000, flag_described=False),
    "migr-acq": _spec(
        "migr-acq", "MIGR_ACQ", "freq,citizen,agedef,age,unit,sex,geo", "citizen,agedef,age,sex", [
            _position({**_MIGR_NR, "citizen": "TOTAL"}, "valore", "published"),
            _citizens("mart_cittadinanze_acquisite", _MIGR_NR, "acquisizioni", 500),
        ], source_filter={"age": "TOTAL", "sex": "T"}, not_null=("geo", "year", "citizen", "agedef"),
        min_rows=5000),
    "migr-asylum-app": _spec(
        "migr-asylum-app", "MIGR_ASYAPPCTZA", "freq,citizen,applicant,sex,unit,age,geo",
        "citizen,applicant,sex,age", [
            _position({**_ASY, "applicant": "TOTAL", "citizen": "TOTAL"}, "domande", "fallback"),
            _flagged("mart_domande_asilo", {**_ASY, "citizen": "TOTAL"}, "applicant", ["TOTAL"], "domande",
                     "is_aggregato", 200),
            _citizens("mart_domande_asilo_cittadinanza", {**_ASY, "applicant": "TOTAL"}, "domande", 1000),
        ], source_filter={"age": "TOTAL", "sex": "T"}, not_null=("geo", "year", "citizen", "applicant"),
        min_rows=5000),
    "migr-asylum-dec": _spec(
        "migr-asylum-dec", "MIGR_ASYDCFSTA", "freq,unit,citizen,sex,age,decision,geo",
        "citizen,sex,age,decision", [
            _position({**_ASY, "decision": "TOTAL", "citizen": "TOTAL"}, "decisioni", "fallback",
                      rate={"dim": "decision", "pos": "POS", "neg": "NEG", "slice": {**_ASY, "citizen": "TOTAL"}}),
            _flagged("mart_decisioni_asilo", {**_ASY, "citizen": "TOTAL"}, "decision", ["TOTAL", "POS"],
                     "decisioni", "is_aggregato", 200),
            MartSpec("mart_decisioni_asilo_cittadinanza", lambda clean: po.rate_by(
                clean, _ASY,
                ["year", "geo", "geo_label_en", "nuts_level", "country", "citizen", "citizen_label_en"],
                "decision", "TOTAL", "POS", "NEG", row_filter=is_country_citizen("citizen")),
                ("year", "geo", "citizen"), 1000, ("year", "geo", "-decisioni"),
                ("country", "decisioni", "accolte", "dinieghi", "tasso_riconoscimento_pct")),
        ], source_filter={"age": "TOTAL", "sex": "T"}, not_null=("geo", "year", "citizen", "decision"),
        min_rows=5000),
    "migr-eirtn": _spec(
        "migr-eirtn", "MIGR_EIRTN", "freq,citizen,c_dest,age,sex,unit,geo", "citizen,c_dest,age,sex", [
            _position({"unit": "PER", "citizen": "TOTAL", "sex": "T", "age": "TOTAL", "c_dest": "TOTAL"},
                      "valore", "published"),
            _flagged("mart_rimpatri", {"unit": "PER", "citizen": "TOTAL", "sex": "T", "age": "TOTAL"},
                     "c_dest", ["TOTAL"], "rimpatri", "is_total", 100),
        ], source_filter={"age": "TOTAL", "sex": "T"}, not_null=("geo", "year", "citizen"), min_rows=5000),
    "migr-emi1ctz": _spec(
        "migr-emi1ctz", "MIGR_EMI1CTZ", "freq,citizen,agedef,age,unit,sex,geo", "citizen,agedef,age,sex", [
            _position({**_MIGR_NR, "citizen": "TOTAL"}, "valore", "computed"),
            _citizens("mart_emigrazioni", _MIGR_NR, "emigrazioni", 500),
        ], source_filter={"age": "TOTAL", "sex": "T"}, not_null=("geo", "year", "citizen", "agedef"),
        min_rows=5000),
    "migr-imm1ctz": _spec(
        "migr-imm1ctz", "MIGR_IMM1CTZ", "freq,citizen,agedef,age,unit,sex,geo", "citizen,agedef,age,sex", [
            _position({**_MIGR_NR, "citizen": "TOTAL"}, "valore", "computed"),
            _citizens("mart_immigrazioni", _MIGR_NR, "immigrazioni", 500),
        ], source_filter={"age": "TOTAL", "sex": "T"}, not_null=("geo", "year", "citizen", "agedef"),
        min_rows=5000),
    "migr-pop1ctz": _spec(
        "migr-pop1ctz", "MIGR_POP1CTZ", "freq,citizen,age,unit,sex,geo", "citizen,age,sex", [
            _citizens("mart_popolazione_cittadinanza", {"unit": "NR", "sex": "T", "age": "TOTAL"}, "persone",
                      1000),
            MartSpec("mart_popolazione_straniera", partial(
                sh.complement_share, slice_={"unit": "NR", "sex": "T", "age": "TOTAL"}, cat="citizen",
                total="TOTAL", part="NAT"), ("year", "geo"), 200, ("year", "geo"),
                ("country", "popolazione_totale", "nazionali", "stranieri", "quota_stranieri_pct")),
        ], source_filter={"age": "TOTAL", "sex": "T"}, not_null=("geo", "year", "citizen"), min_rows=100000),
    "migr-resfirst": _spec(
        "migr-resfirst", "MIGR_RESFIRST", "freq,reason,citizen,duration,unit,geo", "reason,duration,citizen", [
            MartSpec("mart_benchmark_it", partial(po.composition_gap, slice_=_RES, cat="reason",
                                                  categories=_REASONS, total="TOTAL", focus="IT"),
                     ("year", "reason"), 40, ("year", "reason"), _GAP_COLUMNS),
            _flagged("mart_permessi_primi", _RES, "reason", ["TOTAL"], "permessi", "is_total", 200),
        ], not_null=("geo", "year", "citizen", "reason"), min_rows=5000),
    "migr-resvalid": _spec(
        "migr-resvalid", "MIGR_RESVALID", "freq,duration,reason,unit,citizen,geo", "duration,reason,citizen", [
            MartSpec("mart_benchmark_it", partial(po.composition_gap, slice_=_RES, cat="reason",
                                                  categories=_REASONS, total="TOTAL", focus="IT"),
                     ("year", "reason"), 40, ("year", "reason"), _GAP_COLUMNS),
            _flagged("mart_permessi_validi", _RES, "reason", ["TOTAL"], "permessi_validi", "is_total", 200),
        ], not_null=("geo", "year", "citizen", "reason"), min_rows=5000),
    "nama10-gdp": _spec(
        "nama10-gdp", "NAMA_10_GDP", "freq,unit,na_item,geo", "na_item", [
            MartSpec("mart_expenditure", partial(
                sh.item_pivot, item_col="na_item",
                items={"B1GQ": "pil", "P3": "consumi_finali", "P31_S14": "consumi_famiglie",
                       "P3_S13": "consumi_governo", "P51G": "gfcf", "P5G": "formazione_capitale",
                       "P6": "export", "P7": "import", "P6X7": "saldo_commerciale", "YA0": "errore_omissione"},
                derived={"domanda_interna": [(1, "B1GQ"), (-1, "P6"), (1, "P7")]},
                units=["CP_MEUR", "CLV_PCH_PRE", "PC_GDP"], level=None),
                ("year", "country", "unit"), 1000, ("year", "country", "unit"), ("pil", "export", "import")),
        ], min_rows=1000),
    "namq10-gdp": _spec(
        "namq10-gdp", "NAMQ_10_GDP", "freq,unit,s_adj,na_item,geo", "na_item", [
            MartSpec("mart_quarterly", _jvs_extract(
                lambda: F.col("country").isNotNull() & (F.col("s_adj") == "SCA")
                & F.col("na_item").isin("B1GQ", "P3", "P5g", "P6", "P7") & (F.col("unit") == "CLV_PCH_PRE"),
                ["year", "quarter", "country", "geo", "geo_label_en", "nuts_level", "na_item", "na_item_label_en",
                 "unit", "value"]),
                ("year", "quarter", "country", "geo", "na_item"), 5000, ("country", "geo", "year", "quarter", "na_item"),
                ("value",)),
        ], period="quarter", min_rows=10000),
    "tran-hv-frmod": _spec(
        "tran-hv-frmod", "TRAN_HV_FRMOD", "freq,unit,tra_mode,geo", "tra_mode", [
            MartSpec("mart_benchmark_it", partial(po.mode_gap, slice_={"unit": "PC"}, mode_col="tra_mode",
                                                  modes={"strada": "ROAD", "ferrovia": "RAIL"}, focus="IT"),
                     ("year", "modo"), 40, ("year", "modo"), _GAP_COLUMNS),
            MartSpec("mart_modal_split_merci", partial(
                sh.share_pivot, slice_={"unit": "PC"}, mode_col="tra_mode",
                modes={"ROAD": "quota_strada_pct", "RAIL": "quota_ferrovia_pct", "IWW": "quota_vie_navigabili_pct"},
                with_sum=False, level=None), ("year", "country"), 200, ("year", "country"),
                ("quota_strada_pct", "quota_ferrovia_pct")),
        ], min_rows=300),
    "tran-hv-psmod": _spec(
        "tran-hv-psmod", "TRAN_HV_PSMOD", "freq,unit,vehicle,geo", "vehicle", [
            MartSpec("mart_benchmark_it", partial(
                po.mode_gap, slice_={"unit": "PC"}, mode_col="vehicle",
                modes={"auto": "CAR", "bus": "BUS_TOT", "treno": "TRN"}, focus="IT"),
                ("year", "modo"), 60, ("year", "modo"), _GAP_COLUMNS),
            MartSpec("mart_modal_split", partial(
                sh.share_pivot, slice_={"unit": "PC"}, mode_col="vehicle",
                modes={"CAR": "quota_auto_pct", "BUS_TOT": "quota_bus_pct", "TRN": "quota_treno_pct"},
                level=None), ("year", "country"), 300, ("year", "country"),
                ("quota_auto_pct", "quota_bus_pct", "quota_treno_pct")),
        ], min_rows=500),
    "tran-r-net": _spec(
        "tran-r-net", "TRAN_R_NET", "freq,tra_infr,unit,geo", "tra_infr", [
            MartSpec("mart_rete", lambda clean: sh.extract(
                clean, (F.col("unit") == "KM") & F.col("value").isNotNull(),
                ["year", "geo", "geo_label_en", "nuts_level", "country", "tra_infr", "tra_infr_label_en", "value"],
                {"value": "km"}), ("year", "geo", "tra_infr"), 1000, ("year", "geo", "tra_infr"),
                ("country", "nuts_level", "km")),
            MartSpec("mart_rete_it_regioni", lambda clean: sh.unit_join(
                clean, "KM", "KM_TKM2", ["year", "geo", "tra_infr"],
                F.col("geo").startswith("IT") & F.col("nuts_level").isin("NUTS1", "NUTS2")),
                ("year", "geo", "tra_infr"), 50, ("year", "geo", "tra_infr"), ("km",)),
        ], min_rows=2000),
    "tran-r-vehst": _spec(
        "tran-r-vehst", "TRAN_R_VEHST", "freq,vehicle,unit,geo", "vehicle", [
            MartSpec("mart_parco", lambda clean: sh.extract(
                clean, (F.col("unit") == "NR") & F.col("vehicle").isNotNull() & (F.col("vehicle") != "TOT_X_TM")
                & F.col("value").isNotNull(),
                ["year", "geo", "geo_label_en", "nuts_level", "country", "vehicle", "vehicle_label_en",
                 F.rint("value").cast("long").alias("veicoli")]),
                ("year", "geo", "vehicle"), 1000, ("year", "geo", "vehicle"), ("country", "nuts_level", "veicoli")),
            MartSpec("mart_auto_per_1000", lambda clean: sh.extract(
                clean, (F.col("unit") == "P_THAB") & (F.col("vehicle") == "CAR") & F.col("value").isNotNull(),
                ["year", "geo", "geo_label_en", "nuts_level", "country", "value"], {"value": "auto_per_1000"}),
                ("year", "geo"), 300, ("year", "geo"), ("country", "nuts_level", "auto_per_1000")),
        ], min_rows=2000),
})


def build_mart(slug: str, mart: str, clean: DataFrame) -> DataFrame:
    """Convenience: one published mart of one dataflow from its clean table."""
    for m in CATALOG[slug].marts:
        if m.name == mart:
            return m.build(clean)
    raise KeyError(f"{slug}/{mart}")
