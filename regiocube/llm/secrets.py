"""Secret scans: fixed patterns, and sliding-window Shannon entropy over candidate strings.

A candidate is a maximal run of ``CANDIDATE_LEAST`` or more characters of the
base64 alphabets that holds a letter and a digit. The entropy of each of its
windows is kept by incremental counts: a step takes one character out and puts
one in, and changes the sum of c * log2(c) by two terms. The class of a candidate
(hexadecimal, or mixed letters and digits) sets the window's length and the bits that
make it a finding; overlapping findings merge. An allow-list suppresses candidates that are
no secrets: identifiers, digests named as such, samples, alphabets.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiocube.llm.common import map_arrow, text_slices

ASSIGN, ACCESS, HEX, ENTROPY = KINDS = ("assign", "access", "hex", "entropy")

# The patterns of the base kinds and the lengths below which a match is dropped.
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST = {ASSIGN: 8, ACCESS: 16, HEX: 32}
#: Shorter runs of these characters would be dropped, so they are not looked for.
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % LEAST[HEX])

CANDIDATE_LEAST = 24
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}" % CANDIDATE_LEAST)
_HEX_ONLY = re.compile(r"[0-9A-Fa-f]+")


@dataclass(frozen=True)
class EntropyClass:
    """Characters per window, the bits per character of a finding, and what each window must hold."""

    window: int
    bits: float
    needs: tuple[str, ...]


#: 32 random hexadecimal digits have about 3.6 bits, 24 random base64 characters about 4.3; words have less, or no digit.
HEX_CLASS = EntropyClass(32, 3.2, (r"[0-9]", r"[A-Fa-f]"))
MIXED_CLASS = EntropyClass(24, 3.9, (r"[0-9]", r"[A-Z]", r"[a-z]"))

# Candidates that are no secrets, by their own text or by what stands right before them.
ALLOWED = (
    r"\A[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}\Z",
    r"(?i)example|sample|dummy|placeholder|redacted|x{6}",
    r"(?i)abcdefghij|0123456789",
    r"(/[a-z0-9_-]*[a-z]){3}",
)
ALLOWED_BEFORE = (
    r"(?i)(sha-?(1|224|256|384|512)|md5|checksum|digest|fingerprint|integrity|commit|etag)[\"':=\x20-]{0,4}\Z",
    r"(?i)://\S*\Z",
    r"(?i)data:[a-z]+/[a-z0-9.+-]+;base64,\Z",
)
_BEFORE = 64
_SLICE = 1 << 20


def _sums(most: int) -> list[float]:
    return [0.0, *(c * math.log2(c) for c in range(1, most + 1))]


_TERMS = _sums(max(HEX_CLASS.window, MIXED_CLASS.window))


def window_entropies(text: str, window: int) -> Iterator[float]:
    """Bits per character of every window of ``text``, by incremental counts."""
    counts: dict[str, int] = {}
    total, base = 0.0, math.log2(window)
    for i, c in enumerate(text):
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += _TERMS[n + 1] - _TERMS[n]
        if i >= window:
            out = text[i - window]
            n = counts[out]
            counts[out] = n - 1
            total += _TERMS[n - 1] - _TERMS[n]
        if i >= window - 1:
            yield base - total / window


def _findings(text: str, kind: EntropyClass) -> list[list[int]]:
    """Merged windows of a candidate that hold what their class needs and enough entropy."""
    needs = [re.compile(n) for n in kind.needs]
    if len(text) < kind.window or not all(n.search(text) for n in needs):
        return []
    out: list[list[int]] = []
    for i, bits in enumerate(window_entropies(text, kind.window)):
        if bits >= kind.bits and all(n.search(text, i, i + kind.window) for n in needs):
            if out and i <= out[-1][1]:
                out[-1][1] = i + kind.window
            else:
                out.append([i, i + kind.window])
    return out


def secrets_of(text: str, allowed: Sequence[re.Pattern], allowed_before: Sequence[re.Pattern]) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind."""
    found = [(ASSIGN, m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST[ASSIGN]]
    found += [(ACCESS, m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST[ACCESS]]
    found += [(HEX, m.start(), m.end()) for m in _HEX.finditer(text)]
    held = sorted((s, e) for _, s, e in found)
    for m in _CANDIDATE.finditer(text):
        run = m[0]
        before = text[max(0, m.start() - _BEFORE):m.start()]
        if any(p.search(run) for p in allowed) or any(p.search(before) for p in allowed_before):
            continue
        kind = HEX_CLASS if _HEX_ONLY.fullmatch(run) else MIXED_CLASS
        for s, e in _findings(run, kind):
            s, e = s + m.start(), e + m.start()
            if not any(a <= s and e <= b for a, b in held):
                found.append((ENTROPY, s, e))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def scan_secrets(docs: DataFrame, keep: Sequence[str] = ("doc_id",), allowed: Sequence[str] = ALLOWED,
                 allowed_before: Sequence[str] = ALLOWED_BEFORE) -> DataFrame:
    """Struct ``row`` of the columns ``keep`` with ``spans``, array<struct<kind, start, stop>> in code points.

    Kinds: ``assign``, ``access`` and ``hex`` are the patterns' leftmost non-overlapping matches that are long
    enough; ``entropy`` are merged high-entropy windows that no such match holds already. Spans of
    different kinds may overlap. ``allowed`` and ``allowed_before`` suppress candidates of the entropy kind alone.

    - null or empty text: no spans; repeated rows and null ids: each row on its own;
    - very long texts: whole; a candidate costs time in proportion to its length;
    - empty table: empty result; clashing column names stay inside ``row``.
    """
    schema_keep = [F.col(f"`{c}`") for c in keep] or [F.lit(None).cast("int").alias("none")]
    rows = docs.select(F.struct(*schema_keep).alias("row"), F.col("text").cast("string").alias("text"))
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())])
    schema = T.StructType([rows.schema["row"], T.StructField("spans", T.ArrayType(span))])
    patterns = [re.compile(p) for p in allowed], [re.compile(p) for p in allowed_before]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for b in batches:
            spans = [[{"kind": k, "start": s, "stop": e} for k, s, e in secrets_of(t, *patterns)]
                     for _, texts in text_slices(b.column(1), _SLICE) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], names=schema.names)

    return map_arrow(rows, run, schema)
