"""The observation cubes of ``sources.starcube`` written as plain SQL.

Oracle queries (run by DuckDB over the same parquet tables) start with these
CTEs and then read ``clean_input`` (annual), ``monthly_input``,
``quarterly_input`` or ``citizen_input``, in the shape of the published mart
SQL. The SQL is an independent restatement of the cube encoding documented
in ``regiocube.sources.starcube``.
"""

from __future__ import annotations

_CAT_CASE = "CASE k.cat WHEN 'TOTAL' THEN {m}_T WHEN 'A' THEN {m}_A WHEN 'N' THEN {m}_N ELSE {m}_R END"

_DIMENSIONS = """
ref_nations AS (
    SELECT lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS cc
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
    WHERE r.r_name = 'EUROPE'
),
freq_cl(code, label_en) AS (VALUES ('A', 'Annual'), ('Q', 'Quarterly'), ('M', 'Monthly')),
unit_cl(code, label_en) AS (VALUES ('NR', 'Number of lines'), ('MIO_EUR', 'Net amount'),
    ('EUR_HAB', 'Net amount per order'), ('PC', 'Percentage of lines')),
cat_cl(code, label_en) AS (VALUES ('TOTAL', 'Total'), ('A', 'Accepted'), ('N', 'Not returned'),
    ('R', 'Returned')),
flag_cl(code, label_en) AS (VALUES ('b', 'break in time series'),
    ('d', 'definition differs (see metadata)'), ('e', 'estimated'), ('f', 'forecast'),
    ('m', 'missing value; data cannot exist'), ('n', 'not significant'), ('p', 'provisional'),
    ('u', 'low reliability')),
month_cl(code, label_en) AS (VALUES (1, 'January'), (2, 'February'), (3, 'March'), (4, 'April'),
    (5, 'May'), (6, 'June'), (7, 'July'), (8, 'August'), (9, 'September'), (10, 'October'),
    (11, 'November'), (12, 'December')),
cust AS (
    SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS cc,
           substr(c_mktsegment, 1, 1) AS seg
    FROM customer
),
li AS (
    SELECT l_orderkey, l_returnflag AS rf,
           CAST(FLOOR(l_extendedprice * (1 - l_discount)) AS BIGINT) AS amt
    FROM lineitem
),
order_facts AS MATERIALIZED (
    SELECT o.o_orderkey, o.o_custkey,
           CAST(year(o.o_orderdate) AS INTEGER) AS year,
           CAST(month(o.o_orderdate) AS INTEGER) AS month,
           substr(o.o_orderpriority, 1, 1) AS prio,
           o.o_orderstatus AS status,
           COUNT(*) AS n_T, SUM(li.amt) AS a_T,
           COUNT(*) FILTER (WHERE li.rf = 'A') AS n_A, SUM(li.amt) FILTER (WHERE li.rf = 'A') AS a_A,
           COUNT(*) FILTER (WHERE li.rf = 'N') AS n_N, SUM(li.amt) FILTER (WHERE li.rf = 'N') AS a_N,
           COUNT(*) FILTER (WHERE li.rf = 'R') AS n_R, SUM(li.amt) FILTER (WHERE li.rf = 'R') AS a_R
    FROM li JOIN orders o ON li.l_orderkey = o.o_orderkey
    GROUP BY o.o_orderkey, o.o_custkey, year(o.o_orderdate), month(o.o_orderdate),
             substr(o.o_orderpriority, 1, 1), o.o_orderstatus
),
order_cust AS MATERIALIZED (
    SELECT f.*, c.cc, c.seg FROM order_facts f JOIN cust c ON f.o_custkey = c.c_custkey
)"""

_ANNUAL = """
a_cells AS MATERIALIZED (
    SELECT cc, seg, prio, status, year,
           COUNT(*) AS o_T, SUM(n_T) AS n_T, SUM(a_T) AS a_T,
           COUNT(*) FILTER (WHERE n_A > 0) AS o_A, SUM(n_A) AS n_A, SUM(a_A) AS a_A,
           COUNT(*) FILTER (WHERE n_N > 0) AS o_N, SUM(n_N) AS n_N, SUM(a_N) AS a_N,
           COUNT(*) FILTER (WHERE n_R > 0) AS o_R, SUM(n_R) AS n_R, SUM(a_R) AS a_R
    FROM order_cust
    GROUP BY cc, seg, prio, status, year
),
a_levels AS (
    SELECT year, concat_ws('', cc, seg, prio, status) AS geo,
           SUM(o_T) AS o_T, SUM(n_T) AS n_T, SUM(a_T) AS a_T,
           SUM(o_A) AS o_A, SUM(n_A) AS n_A, SUM(a_A) AS a_A,
           SUM(o_N) AS o_N, SUM(n_N) AS n_N, SUM(a_N) AS a_N,
           SUM(o_R) AS o_R, SUM(n_R) AS n_R, SUM(a_R) AS a_R
    FROM a_cells
    GROUP BY GROUPING SETS ((year, cc), (year, cc, seg), (year, cc, seg, prio),
                            (year, cc, seg, prio, status))
    UNION ALL
    SELECT year, 'EU27_2020' AS geo,
           SUM(o_T), SUM(n_T), SUM(a_T), SUM(o_A), SUM(n_A), SUM(a_A),
           SUM(o_N), SUM(n_N), SUM(a_N), SUM(o_R), SUM(n_R), SUM(a_R)
    FROM a_cells
    WHERE cc IN (SELECT cc FROM ref_nations) AND year <= 1999
    GROUP BY year
),
a_long AS (
    SELECT l.year, l.geo, u.unit, k.cat,
           """ + _CAT_CASE.format(m="n") + """ AS n,
           """ + _CAT_CASE.format(m="a") + """ AS a,
           """ + _CAT_CASE.format(m="o") + """ AS o,
           l.n_T AS nt
    FROM a_levels l
    CROSS JOIN (VALUES ('NR'), ('MIO_EUR'), ('EUR_HAB'), ('PC')) u(unit)
    CROSS JOIN (VALUES ('TOTAL'), ('A'), ('N'), ('R')) k(cat)
),
a_obs AS MATERIALIZED (
    SELECT 'A' AS freq, unit, cat, geo, CAST(year AS INTEGER) AS year,
           CASE WHEN n = 1 THEN NULL
                WHEN unit = 'NR' THEN CAST(n AS DOUBLE)
                WHEN unit = 'MIO_EUR' THEN CAST(a AS DOUBLE)
                WHEN unit = 'EUR_HAB' THEN FLOOR(CAST(a AS DOUBLE) / CAST(o AS DOUBLE))
                ELSE ROUND(CAST(n AS DOUBLE) * 100.0 / CAST(nt AS DOUBLE), 1)
           END AS value,
           CASE WHEN n = 1 THEN 'n' WHEN year = 2001 THEN 'p' END AS flag
    FROM a_long
    WHERE n > 0
),"""

_GEO = """
geo_codes AS (
    SELECT DISTINCT geo AS code FROM a_obs
),
geo_base AS (
    SELECT g.code,
           CASE WHEN g.code = 'EU27_2020' THEN 'Reference group aggregate'
                WHEN length(g.code) = 2 THEN n.n_name
                ELSE concat_ws(' ', n.n_name, substr(g.code, 3, 10)) END AS label_en,
           CASE WHEN g.code = 'EU27_2020' THEN ''
                WHEN length(g.code) = 3 AND g.code LIKE '24%' THEN ''
                WHEN length(g.code) = 2 THEN 'country'
                WHEN length(g.code) = 3 THEN 'NUTS1'
                WHEN length(g.code) = 4 THEN 'NUTS2'
                WHEN length(g.code) = 5 THEN 'NUTS3'
                ELSE '' END AS nuts_level
    FROM geo_codes g
    LEFT JOIN nation n ON substr(g.code, 1, 2) = lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0')
),
geo AS MATERIALIZED (
    SELECT code, label_en, nuts_level,
           CASE WHEN nuts_level LIKE 'NUTS%' AND length(code) > 2
                THEN substr(code, 1, length(code) - 1) ELSE '' END AS parent_code
    FROM geo_base
),"""

_CLEAN_ANNUAL = """
clean_input AS MATERIALIZED (
    SELECT o.freq, o.unit, o.cat, o.geo, o.year,
           fq.label_en AS freq_label_en, un.label_en AS unit_label_en, ct.label_en AS cat_label_en,
           g.label_en AS geo_label_en, g.nuts_level,
           CASE WHEN g.nuts_level IS NOT NULL AND g.nuts_level != '' THEN LEFT(o.geo, 2) ELSE NULL END
               AS country,
           g.parent_code AS nuts_parent_code, gp.label_en AS nuts_parent_label_en,
           o.value, o.flag, fl.label_en AS flag_desc_en
    FROM a_obs o
    LEFT JOIN freq_cl fq ON o.freq = fq.code
    LEFT JOIN unit_cl un ON o.unit = un.code
    LEFT JOIN cat_cl ct ON o.cat = ct.code
    LEFT JOIN geo g ON o.geo = g.code
    LEFT JOIN geo gp ON g.parent_code = gp.code
    LEFT JOIN flag_cl fl ON o.flag = fl.code
)"""

_MONTHLY = """
m_cells AS MATERIALIZED (
    SELECT cc, seg, year, month,
           SUM(n_T) AS n_T, SUM(n_A) AS n_A, SUM(n_N) AS n_N, SUM(n_R) AS n_R
    FROM order_cust
    GROUP BY cc, seg, year, month
),
m_levels AS (
    SELECT year, month, concat_ws('', cc, seg) AS geo,
           SUM(n_T) AS n_T, SUM(n_A) AS n_A, SUM(n_N) AS n_N, SUM(n_R) AS n_R
    FROM m_cells
    GROUP BY GROUPING SETS ((year, month, cc), (year, month, cc, seg))
),
m_obs AS (
    SELECT 'M' AS freq, 'NR' AS unit, k.cat, l.geo, CAST(l.year AS INTEGER) AS year,
           CAST(l.month AS INTEGER) AS month,
           """ + _CAT_CASE.format(m="n") + """ AS n
    FROM m_levels l CROSS JOIN (VALUES ('TOTAL'), ('A'), ('N'), ('R')) k(cat)
),
monthly_input AS MATERIALIZED (
    SELECT o.freq, o.unit, o.cat, o.geo, o.year, o.month,
           fq.label_en AS freq_label_en, un.label_en AS unit_label_en, ct.label_en AS cat_label_en,
           mo.label_en AS month_label_en,
           g.label_en AS geo_label_en, g.nuts_level,
           CASE WHEN g.nuts_level IS NOT NULL AND g.nuts_level != '' THEN LEFT(o.geo, 2) ELSE NULL END
               AS country,
           g.parent_code AS nuts_parent_code, gp.label_en AS nuts_parent_label_en,
           CASE WHEN o.n = 1 THEN NULL ELSE CAST(o.n AS DOUBLE) END AS value,
           CASE WHEN o.n = 1 THEN 'n' WHEN o.year = 2001 THEN 'p' END AS flag,
           fl.label_en AS flag_desc_en
    FROM m_obs o
    LEFT JOIN freq_cl fq ON o.freq = fq.code
    LEFT JOIN unit_cl un ON o.unit = un.code
    LEFT JOIN cat_cl ct ON o.cat = ct.code
    LEFT JOIN month_cl mo ON o.month = mo.code
    LEFT JOIN geo g ON o.geo = g.code
    LEFT JOIN geo gp ON g.parent_code = gp.code
    LEFT JOIN flag_cl fl ON (CASE WHEN o.n = 1 THEN 'n' WHEN o.year = 2001 THEN 'p' END) = fl.code
    WHERE o.n > 0
)"""

_QUARTERLY = """
q_cells AS MATERIALIZED (
    SELECT cc, year, CAST(ceil(month / 3) AS INTEGER) AS quarter,
           SUM(n_T) AS n_T, SUM(n_A) AS n_A, SUM(n_N) AS n_N, SUM(n_R) AS n_R
    FROM order_cust
    GROUP BY cc, year, CAST(ceil(month / 3) AS INTEGER)
),
q_levels AS (
    SELECT year, quarter, cc AS geo, n_T, n_A, n_N, n_R FROM q_cells
    UNION ALL
    SELECT year, quarter, 'EU27_2020', SUM(n_T), SUM(n_A), SUM(n_N), SUM(n_R)
    FROM q_cells WHERE cc IN (SELECT cc FROM ref_nations)
    GROUP BY year, quarter
),
q_raw AS (
    SELECT 'Q' AS freq, 'NR' AS unit, k.cat, l.geo,
           CAST(l.year AS VARCHAR) || '-Q' || CAST(l.quarter AS VARCHAR) AS year,
           """ + _CAT_CASE.format(m="n") + """ AS n
    FROM q_levels l CROSS JOIN (VALUES ('TOTAL'), ('A'), ('N'), ('R')) k(cat)
),
quarterly_input AS MATERIALIZED (
    SELECT o.freq, o.unit, o.cat, o.geo,
           CAST(SPLIT_PART(o.year, '-', 1) AS INTEGER) AS year,
           SPLIT_PART(o.year, '-', 2) AS quarter,
           fq.label_en AS freq_label_en, un.label_en AS unit_label_en, ct.label_en AS cat_label_en,
           g.label_en AS geo_label_en, g.nuts_level,
           CASE WHEN g.nuts_level IS NOT NULL AND g.nuts_level != '' THEN LEFT(o.geo, 2) ELSE NULL END
               AS country,
           CASE WHEN o.n = 1 THEN NULL ELSE CAST(o.n AS DOUBLE) END AS value,
           CASE WHEN o.n = 1 THEN 'n' WHEN SPLIT_PART(o.year, '-', 1) = '2001' THEN 'p' END AS flag,
           fl.label_en AS flag_desc_en
    FROM q_raw o
    LEFT JOIN freq_cl fq ON o.freq = fq.code
    LEFT JOIN unit_cl un ON o.unit = un.code
    LEFT JOIN cat_cl ct ON o.cat = ct.code
    LEFT JOIN geo g ON o.geo = g.code
    LEFT JOIN flag_cl fl ON (CASE WHEN o.n = 1 THEN 'n'
                                  WHEN SPLIT_PART(o.year, '-', 1) = '2001' THEN 'p' END) = fl.code
    WHERE o.n > 0
)"""

_CITIZEN = """
sup AS (
    SELECT s_suppkey, lpad(CAST(s_nationkey AS VARCHAR), 2, '0') AS sn FROM supplier
),
c_per_cust AS MATERIALIZED (
    SELECT o.o_custkey, CAST(year(o.o_orderdate) AS INTEGER) AS year, s.sn, COUNT(*) AS n
    FROM lineitem l
    JOIN sup s ON l.l_suppkey = s.s_suppkey
    JOIN orders o ON l.l_orderkey = o.o_orderkey
    GROUP BY o.o_custkey, year(o.o_orderdate), s.sn
),
c_cells AS MATERIALIZED (
    SELECT c.cc, c.seg, p.year, p.sn, SUM(p.n) AS n
    FROM c_per_cust p JOIN cust c ON p.o_custkey = c.c_custkey
    GROUP BY c.cc, c.seg, p.year, p.sn
),
c_long AS (
    SELECT year, concat_ws('', cc, seg) AS geo, sn AS citizen, SUM(n) AS n
    FROM c_cells GROUP BY GROUPING SETS ((year, sn, cc), (year, sn, cc, seg))
    UNION ALL
    SELECT year, concat_ws('', cc, seg) AS geo, 'TOTAL', SUM(n)
    FROM c_cells GROUP BY GROUPING SETS ((year, cc), (year, cc, seg))
    UNION ALL
    SELECT year, concat_ws('', cc, seg) AS geo, 'NAT', SUM(CASE WHEN sn = cc THEN n ELSE 0 END)
    FROM c_cells GROUP BY GROUPING SETS ((year, cc), (year, cc, seg))
    UNION ALL
    SELECT year, concat_ws('', cc, seg) AS geo, 'EU',
           SUM(CASE WHEN sn IN (SELECT cc FROM ref_nations) THEN n ELSE 0 END)
    FROM c_cells GROUP BY GROUPING SETS ((year, cc), (year, cc, seg))
),
citizen_cl AS (
    SELECT code, label_en FROM geo WHERE nuts_level = 'country'
    UNION ALL
    SELECT * FROM (VALUES ('TOTAL', 'Total'), ('NAT', 'Reporting country'), ('EU', 'Reference group')) t(code, label_en)
),
citizen_input AS (
    SELECT 'A' AS freq, 'NR' AS unit, o.citizen, o.geo, CAST(o.year AS INTEGER) AS year,
           fq.label_en AS freq_label_en, un.label_en AS unit_label_en, cz.label_en AS citizen_label_en,
           g.label_en AS geo_label_en, g.nuts_level,
           CASE WHEN g.nuts_level IS NOT NULL AND g.nuts_level != '' THEN LEFT(o.geo, 2) ELSE NULL END
               AS country,
           g.parent_code AS nuts_parent_code, gp.label_en AS nuts_parent_label_en,
           CASE WHEN o.n = 1 THEN NULL ELSE CAST(o.n AS DOUBLE) END AS value,
           CASE WHEN o.n = 1 THEN 'n' WHEN o.year = 2001 THEN 'p' END AS flag,
           fl.label_en AS flag_desc_en
    FROM c_long o
    LEFT JOIN freq_cl fq ON fq.code = 'A'
    LEFT JOIN unit_cl un ON un.code = 'NR'
    LEFT JOIN citizen_cl cz ON o.citizen = cz.code
    LEFT JOIN geo g ON o.geo = g.code
    LEFT JOIN geo gp ON g.parent_code = gp.code
    LEFT JOIN flag_cl fl ON (CASE WHEN o.n = 1 THEN 'n' WHEN o.year = 2001 THEN 'p' END) = fl.code
    WHERE o.n > 0
)"""


def ctes(*cubes: str) -> str:
    """CTE prefix (without the trailing comma) exposing the requested cubes.

    ``cubes`` is any of 'annual', 'monthly', 'quarterly', 'citizen'; the annual
    observations and the geo hierarchy are always included (the hierarchy is
    derived from the annual cube's codes).
    """
    parts = [_DIMENSIONS + ",", _ANNUAL, _GEO, _CLEAN_ANNUAL]
    if "monthly" in cubes:
        parts += [",", _MONTHLY]
    if "quarterly" in cubes:
        parts += [",", _QUARTERLY]
    if "citizen" in cubes:
        parts += [",", _CITIZEN]
    return "".join(parts)


def with_cubes(body: str, *cubes: str) -> str:
    """``WITH <cube CTEs>, <body>``; ``body`` continues the CTE list or is a
    bare SELECT (then prefixed by a comma-less join)."""
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {ctes(*cubes)}\n{body}"
    return f"WITH {ctes(*cubes)},\n{body}"
