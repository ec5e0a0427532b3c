"""Small tables with every odd case, and plain versions of what the operators compute."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import xxhash

#: Column names that the operators use inside; documents may have them too.
CLASHING = ["row", "size", "batch", "bucket", "node", "component_id", "rank", "kept", "tokens", "simhash", "target", "copy"]

PASSAGE = " ".join(f"shared{i}" for i in range(30))
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))

DOCS = [
    (1, f"start one {PASSAGE} end one", "en", "a"),
    (2, f"other words here {PASSAGE}\tand more", "en", "a"),
    (3, None, "en", "b"),
    (4, "", None, None),
    (5, " \t\n ", "de", "b"),
    (6, "12 34 -- !!", "de", "c"),
    (7, LONG, "fr", "a"),
    (8, f"start one {PASSAGE} end one", "en", "c"),
    (8, f"start one {PASSAGE} end one", "en", "c"),
    (None, f"no id {PASSAGE}", "en", "a"),
    (None, None, None, None),
    (9, "ÀÉ ñandú Straße İstanbul ΣΣ \U0001f600 <|endoftext|> [INST]", "es", "d"),
    (10, "one", "en", "d"),
    (-3, f"{PASSAGE}", "fr", ""),
    (1 << 62, "far away id with some words", "en", "a"),
]


def documents(spark, rows=DOCS, clashing=True):
    extra = CLASHING if clashing else []
    schema = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in extra)
    return spark.createDataFrame([(i, t, l, s, len(t or ""), *["x"] * len(extra)) for i, t, l, s in rows], schema)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def removed_words(rows, window=13):
    """{position in rows: (n_words, kept words)} by comparing all windows."""
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i:i + window])] < doc:
                gone.update(range(i, i + window))
        out.append((len(w), [x for k, x in enumerate(w) if k not in gone], sorted(gone)))
    return out


def simhash(text, shingle=4):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(rows, most=4):
    """[(fingerprint, smallest id reachable)] for (doc_id, text) rows, comparing all pairs."""
    prints = [simhash(t) for _, t in rows]
    nodes = sorted({f for f in prints})
    parent = {f: f for f in nodes}

    def top(f):
        while parent[f] != f:
            f = parent[f]
        return f

    by_id = defaultdict(list)
    for (doc, _), f in zip(rows, prints):
        if doc is not None:
            by_id[doc].append(f)
    ids = {f for v in by_id.values() for f in v}
    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if (a ^ b).bit_count() <= most and a in ids and b in ids:
                parent[top(a)] = top(b)
    least = {}
    for (doc, _), f in zip(rows, prints):
        if doc is not None:
            least[top(f)] = min(least.get(top(f), doc), doc)
    return [(f, least.get(top(f))) for f in prints]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
