"""regiocube — regional statistical marts as Spark DataFrame jobs.

Long observation tables (dimension codes, geo code, period, value, flag) are
ingested from wide SDMX files, enriched with code labels and a four-level
geo hierarchy, and turned into analytical marts: reference-group benchmarks,
country syntheses and rankings, multi-year trends, position and share of a
focus country, composition gaps, share pivots, rates and flagged slices,
plus data-quality gates over all of them.

Layout
------
functions/  column-level helpers (engine-parity rounding, code rules, labels)
sources/    readers (SDMX TSV, codelists, typed observations), sinks and the
            observation cubes derived from the star-schema test tables
operators/  DataFrame -> DataFrame mart and quality operators
plans/      dataset specs, the dataset runner and the query registry
streaming/  incremental landing -> clean job (Structured Streaming)
"""

from regiocube.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
__version__ = "0.1.0"
