"""Intermediate tables: failures rise, nothing stale is read, no local folder on a cluster."""

from __future__ import annotations

import os
import pathlib
import shutil

import pytest

from regiocube.plans import materialize
from regiocube.session import check_shared


def test_a_failing_build_raises(spark):
    def build():
        raise ZeroDivisionError("broken build")

    with pytest.raises(ZeroDivisionError):
        materialize.persisted(spark, "broken", build, [])


def test_an_unset_scratch_folder_raises(spark, monkeypatch):
    from regiocube.plans import registry

    monkeypatch.setattr(materialize, "scratch_root", lambda s: None)
    monkeypatch.setattr(registry, "scratch_root", lambda s: None)
    with pytest.raises(RuntimeError):
        materialize.persisted(spark, "none", lambda: spark.range(3), [])
    with pytest.raises(RuntimeError):
        registry._scratch_run(spark, "none")


def test_a_changed_nested_file_rebuilds(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "in")
    spark.range(3).selectExpr("id", "id % 2 AS part").write.partitionBy("part").parquet(src)
    built = []

    def build():
        built.append(1)
        return spark.read.parquet(src)

    assert materialize.persisted(spark, "nested", build, [src]).count() == 3
    assert materialize.persisted(spark, "nested", build, [src]).count() == 3 and len(built) == 1
    spark.range(5, 7).selectExpr("id").write.mode("append").parquet(os.path.join(src, "part=1"))
    assert materialize.persisted(spark, "nested", build, [src]).count() == 5 and len(built) == 2


def test_changed_code_changes_the_version(tmpdir_fresh):
    top = pathlib.Path(materialize.__file__).resolve().parent.parent
    copy = pathlib.Path(tmpdir_fresh) / "regiocube"
    shutil.copytree(top, copy, ignore=shutil.ignore_patterns("__pycache__"))
    assert materialize.code_version(copy) == materialize.code_version(top)
    with open(copy / "functions" / "codes.py", "a") as f:
        f.write("\n# changed\n")
    assert materialize.code_version(copy) != materialize.code_version(top)


def test_local_scratch_is_refused_on_a_cluster():
    check_shared("file:///tmp/x", "local[4]")
    check_shared("hdfs://host/x", "yarn")
    with pytest.raises(ValueError):
        check_shared("file:///tmp/x", "spark://host:7077")


def test_folder_of_files_with_different_periods(spark, tmpdir_fresh):
    from regiocube.sources.sdmx import read_sdmx_tsv

    for name, head, cells in (("a.tsv", "2020 \t2021 ", "1 \t2 p"), ("b.tsv", "2021 \t2022 ", "3 \t: ")):
        with open(os.path.join(tmpdir_fresh, name), "w") as f:
            f.write(f"freq,unit,geo\\TIME_PERIOD\t{head}\nA,PC,{name[0].upper()}\t{cells}\n")
    got = sorted((r.geo, r.year, r.value, r.flag) for r in read_sdmx_tsv(spark, tmpdir_fresh).collect())
    assert got == [("A", 2020, 1.0, None), ("A", 2021, 2.0, "p"), ("B", 2021, 3.0, None), ("B", 2022, None, None)]


def test_a_null_part_is_not_its_parent(spark):
    from regiocube.sources import starcube as sc

    cells = spark.createDataFrame([("01", "A", 2000, 5), ("01", None, 2000, 2)], "cc string, seg string, year int, n long")
    got = {r.geo: r.n for r in sc._rollup(cells, [["cc"], ["cc", "seg"]], [], ["n"], (), None).collect()}
    assert got == {"01": 7, "01A": 5, "01_": 2}


def test_the_fact_build_deals_its_rows_over_more_partitions(spark, monkeypatch):
    from regiocube.plans.cubes import Cubes
    from regiocube.sources import starcube as sc
    from tests.conftest import SF_SMALL

    lines = sc.read_table(spark, SF_SMALL, "lineitem").count()
    monkeypatch.setattr(materialize, "TASK_ROWS", 300)
    before, during = [spark.conf.get(k, None) for k in (*materialize._PARTITIONS, materialize._ADVISORY)], []

    def cells(*a):
        during.append(None)
        return real(*a)

    def written(s, rows):
        with dealt(s, rows):
            during.append((int(s.conf.get("spark.sql.shuffle.partitions")), s.conf.get(materialize._ADVISORY)))
            yield

    real, dealt = sc.fact_cells, materialize.dealt
    monkeypatch.setattr(sc, "fact_cells", cells)
    monkeypatch.setattr(materialize, "dealt", materialize.contextmanager(written))
    spark.conf.set("regiocube.run_token", "dealt" + os.urandom(4).hex())
    try:
        got = Cubes(spark, SF_SMALL, ("01",), "01").facts()
    finally:
        spark.conf.unset("regiocube.run_token")
    assert during == [None, (-(-lines // 300), "8m")]
    assert [spark.conf.get(k, None) for k in (*materialize._PARTITIONS, materialize._ADVISORY)] == before
    want = real(spark, SF_SMALL).select(got.columns)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_settings_of_a_build_are_put_back_when_it_fails(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ZeroDivisionError), materialize.dealt(spark, 10**9):
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == -(-10**9 // materialize.TASK_ROWS)
        raise ZeroDivisionError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert [materialize._megabytes(x) for x in ("8388608b", "8388608", "8m", "8MB", "8192k", "1g")] == [8, 8, 8, 8, 8, 1024]
