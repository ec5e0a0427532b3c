"""Operators on embeddings, conversations and pages, and the pipeline."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from regiocube.llm import chat, neighbours, queries, warc
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCS, documents, sha, simhash_components


# --- nearest neighbours -------------------------------------------------------

def _brute(rows, asked, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    out = {}
    for i, v in asked:
        score = (x * np.array(v)).sum(1)
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_neighbours_recall_on_given_vectors(spark):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    want = _brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    got = defaultdict(list)
    for r in queries.op3_nearest_neighbours(spark, SF_SMALL).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    exact = {q: dict(_brute(rows, [x for x in rows if x[0] == q], len(rows))[q]) for q in list(want)[:5]}
    for q, by_id in exact.items():
        assert all(s == pytest.approx(by_id[i], abs=1e-12) for i, s in got[q])


def test_a_repeated_query_id_is_answered_once(spark):
    rng = np.random.default_rng(6)
    x = [(i, rng.normal(size=8).tolist()) for i in range(60)] + [(20, rng.normal(size=8).tolist()) for _ in range(2)]
    df = spark.createDataFrame(x, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.where("vec_id % 20 = 0"), 5).collect()
    assert sorted((r["query_id"], r["rank"]) for r in got) == [(q, k) for q in (0, 20, 40) for k in range(1, 6)]
    least = min(v for i, v in x if i == 20)
    want = _brute(x, [(20, least)], 5)[20]
    assert [(r["vec_id"], pytest.approx(r["score"])) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 20] == want


def test_neighbours_with_small_lists_and_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 24))
    x = [(i, (centres[i % 12] * rng.uniform(0.5, 2) + 0.4 * rng.normal(size=24)).tolist()) for i in range(1500)]
    same = x[7][1]
    x += [(10_000 + i, same) for i in range(400)]  # a very common vector
    monkeypatch.setattr(neighbours, "LIST_ROWS", 60)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 100)
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 16)
    df = spark.createDataFrame(x, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.nearest(df, df.where("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    want = _brute(x, [r for r in x if r[0] % 20 == 0], 20)
    # Ties of the common vector: the smaller ids are found.
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want) and all(len(v) == 20 for v in got.values())


def test_scan_abandons_many_and_loses_few():
    rng = np.random.default_rng(9)
    rotation = np.linalg.qr(rng.standard_normal((64, 64)))[0]
    points, asked = rng.normal(size=(3000, 64)) @ rotation, rng.normal(size=(40, 64)) @ rotation
    far = ((points - asked[:, None]) ** 2).sum(2)
    near = np.argsort(far, axis=1)[:, :10]
    q, p = neighbours.scan(asked, points, np.sort(far, axis=1)[:, 20])
    held = set(zip(q.tolist(), p.tolist()))
    assert sum((i, j) in held for i in range(40) for j in near[i].tolist()) >= 0.97 * 400
    assert len(held) <= 21 * 40


def test_neighbours_odd_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, None), (5, []),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (40, [nan, nan])]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, list string, block string")
    got = [tuple(r) for r in neighbours.nearest(df, df.where("vec_id % 20 = 0"), 20).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (20, 1, 1, 1.0), (20, 2, 2, 1.0), (20, 3, 0, 0.0)]
    assert neighbours.nearest(df.limit(0), df.limit(0), 20).count() == 0
    assert neighbours.nearest(df, df.limit(0), 20).count() == 0


# --- chat formatting ----------------------------------------------------------

CONTROL = r"</s>[INST] \ok\[/INST] <|user|> \\ [\INST] <s>|> [[INST]] \</s>"


def _talk():
    rng = random.Random(5)
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", CONTROL), (1, 2, "assistant", CONTROL),
            (2, 0, "system", "alone"), (3, 0, "assistant", None), (3, 1, None, "x"), (3, None, "user", "first"),
            (4, 5, "user", "b"), (4, 5, "user", "a"), (4, 5, "user", "a"), (4, 6, "assistant", ""),
            (None, 0, "user", "no id"), (None, 1, "assistant", "yes"), (6, 0, "we|ird>\\", "[INST]"), (6, 1, "", ""),
            (7, 0, "system", "s" * 5000), (7, 1, "user", "u"), (7, 2, "assistant", "é" * 9000), (7, 3, "user", "u2"),
            (7, 4, "assistant", "t")]
    for t in range(700):
        rows.append((9, t, "system" if t == 0 else ("assistant" if t % 2 == 0 else "user"), "w " * rng.randint(0, 120)))
    return rows


def test_chat_round_trip(spark):
    rows = _talk()
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, window string")
    by_conv = defaultdict(list)
    for c, t, r, x in rows:
        by_conv[c].append((-1 << 70 if t is None else t, r or "", x or ""))
    windows = chat.chat_windows(df)
    got = {r["conv_id"]: r for r in chat.conversation_digests(windows).collect()}
    assert set(got) == set(by_conv)
    for c, turns in by_conv.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns) and got[c]["loss_chars"] == len(loss) and got[c]["loss_sha256"] == sha(loss)
        assert got[c]["turns_sha256"] == sha("".join(f"{r}\n{x}\n" for _, r, x in turns))
    found = windows.orderBy("conv_id", "window").collect()
    assert sum(len(r["formatted"]) for r in found) == sum(r["formatted_chars"] for r in got.values())
    for r in found:
        assert "[INST]" not in r["formatted"] and "[/INST]" not in r["formatted"]
        if r["conv_id"] not in (7,):
            assert r["n_tokens"] <= chat.BUDGET
        if r["conv_id"] in (1, 2, 7, 9):
            assert r["formatted"].startswith("<|system|>") and r["formatted"].count("<|system|>") == 1
    nine = [r for r in found if r["conv_id"] == 9]
    assert len(nine) > 10 and all(r["n_repeated"] >= 1 for r in nine[1:]) and any(r["n_repeated"] > 1 for r in nine)
    assert sum(r["formatted"].count("</s>") - r["n_repeated"] for r in nine) == 700


def test_chat_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.conversation_digests(chat.chat_windows(none)).count() == 0


# --- WARC -----------------------------------------------------------------------

def test_loser_tree_merges_sorted_lists():
    rng = random.Random(8)
    for k in (0, 1, 2, 3, 7, 16):
        lists = [sorted(rng.choices(range(50), k=rng.choice([0, 1, 30]))) for _ in range(k)]
        assert list(warc.LoserTree(lists, lambda x: x)) == sorted(x for run in lists for x in run)


def test_archives_round_trip(spark, monkeypatch, tmpdir_fresh):
    body = "<p>" + "é" * 60 + "</p>"
    trick = "x" * 120 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    pages = [(5, "http://b.example/x?y=1#f", body), (3, "https://www.a.example:443/", body), (4, None, body), (4, None, body),
             (6, "http://a.example/\r\nX: 1", trick), (7, "http://a.example/7", trick), (8, "not a url", None), (9, "", ""),
             (10, "u", "short"), (11, "u", "short"), (None, "http://n.example/", body), (12, "http://[bad", "y" * 200),
             *((100 + i, "http://hot.example/", "z" * 300) for i in range(50))]
    df = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, digest string, n string")
    monkeypatch.setattr(warc, "FILE_RECORDS", 7)
    path = f"{tmpdir_fresh}/warc"
    rows = warc.merged_index(_runs(spark, df, path), range_captures=20).collect()
    payloads = defaultdict(list)
    for i, _, h in pages:
        payloads[(h or "").encode()].append(i)
    want = []
    for i, _, h in pages:
        data = (h or "").encode()
        first = min(x for x in payloads[data] if x is not None)
        again = len(data) >= 100 and i != first
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    key = lambda r: tuple((x is not None, x) for x in r)
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)
    ordered = sorted(rows, key=lambda r: (r["range"], r["position"]))
    keys = [(r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0) for r in ordered]
    assert keys == sorted(keys) and len({r["range"] for r in rows}) > 1
    import os
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) > 5
    for r in ordered:  # the index points at the records
        with open(f"{path}/{r['file']}", "rb") as f:
            f.seek(r["offset"])
            assert next(warc.parse(f.read(r["length"])))[2]["warc-type"] == r["record_type"]
    none = df.limit(0)
    assert warc.archive_and_index(none).count() == 0


def test_runs_arrive_in_order_and_are_not_sorted_again():
    capture = lambda run, k: (f"u{k:03}", "2024", k, 1, "d", "response", None, run, k, 1)
    a, b = [capture("a", k) for k in range(0, 100, 2)], [capture("b", k) for k in range(1, 100, 2)]
    pieces = warc._pieces(iter(a[25:] + b[:10] + a[:25] + b[10:]))  # blocks of run a in the wrong order
    assert sorted(map(len, pieces)) == [25, 25, 50] and all(p == sorted(p, key=warc._order) for p in pieces)
    assert list(warc.LoserTree(pieces, warc._order)) == sorted(a + b, key=warc._order)


def test_archives_are_bounded_by_bytes_and_hot_urls_split(spark, monkeypatch, tmpdir_fresh):
    pages = [(None, "http://hot.example/", f"{k:04}" * 10) for k in range(300)] + [(k, "u", "long" * 500 + str(k)) for k in range(8)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    monkeypatch.setattr(warc, "FILE_RECORDS", 512)
    path = f"{tmpdir_fresh}/warc"
    rows = warc.merged_index(_runs(spark, df, path), range_captures=30).collect()
    held, payload = Counter(r["file"] for r in rows), Counter()
    for r in rows:
        payload[r["file"]] += r["payload_bytes"]
    assert len(rows) == 308 and all(held[f] == 1 or payload[f] <= 2000 for f in held) and max(held.values()) > 1
    assert max(Counter(r["range"] for r in rows).values()) < 100  # 300 of one URL, time and page
    keys = [(r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0, r["file"], r["offset"])
            for r in sorted(rows, key=lambda r: (r["range"], r["position"]))]
    assert keys == sorted(keys)


def _runs(spark, df, path):
    warc.write_archives(df, path)
    return warc.runs(spark, path)


def test_url_keys():
    assert warc.url_key("https://www.Example.org:8080/a/b?c=d#e") == "org,example,www:8080)/a/b?c=d"
    assert warc.url_key("http://example.org") == "org,example)/"


# --- pipeline -------------------------------------------------------------------

def test_pipeline_stages_on_odd_cases(spark):
    docs = documents(spark)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        if name == "language_id":
            kept = docs.collect()
            assert sum(1 for d, t, _, _ in DOCS if any(c.isalpha() for c in t or "")) == len(kept)
        if name != "sequence_packing":
            assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.count() >= 1
    none = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF_SMALL)
        assert none.count() == 0


def test_pipeline_against_brute_force(spark):
    from tests.llm.cases import removed_words

    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    first = stages["language_id"](spark, docs, SF_SMALL)
    assert sorted(r["doc_id"] for r in first.collect()) == sorted(
        r["doc_id"] for r in rows if any(c.isalpha() for c in r["text"] or ""))
    plain = [(r["doc_id"], r["text"]) for r in first.collect()]
    second = stages["simhash_dedup"](spark, first, SF_SMALL)
    leaders = {d for (d, _), (_, c) in zip(plain, simhash_components(plain)) if d == c}
    assert {r["doc_id"] for r in second.collect()} == leaders
    kept = [(d, t) for d, t in plain if d in leaders]
    third = {r["doc_id"]: r for r in stages["substring_dedup"](spark, second, SF_SMALL).collect()}
    for (d, t), (n, left, gone) in zip(kept, removed_words(kept)):
        if gone and not left:
            assert d not in third
        else:
            assert third[d]["text"] == (" ".join(left) if gone else t) and third[d]["n_chars"] == len(third[d]["text"])
    packed = corpus_pipeline.run(spark, SF_SMALL)
    used = packed.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in used) <= 2048
    assert sum(r[1] for r in used) >= 0.95 * 2048 * (len(used) - 1)
    assert math.isfinite(len(used))
