"""Structure repair, secret scans and lexical search against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from regiocube.llm import lexical, queries, secrets, structure
from tests.conftest import SF_SMALL
from tests.llm.cases import documents

# --- structure repair -----------------------------------------------------------

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _by_trying(rows):
    """(cost, audit, repaired) of the cheapest edits, by trying all of them."""
    best = None
    faults = _faults(rows)
    inserted = ["", "u", "a", "ua", "au", "uu", "aa"]
    one = [[("D", None)] if f in ("blank", "duplicate") else [("K", r[:1] or "?"), ("R", "u"), ("R", "a"), ("D", None)] for (r, _), f in zip(rows, faults)]
    for edits in product(*one):
        for gaps in product(inserted, repeat=len(rows) + 1):
            shape = "".join(g + (e[1] or "") for g, e in zip(gaps, [*edits, ("", "")]))
            if not LEGAL.match(shape):
                continue
            audit = "".join("I" * len(g) + e[0] for g, e in zip(gaps, [*edits, ("", "")]))
            cost = sum({"K": 0, "R": 2, "D": 3, "I": 2}[x] for x in audit) + sum(f == "truncated" and e[0] != "D" for e, f in zip(edits, faults))
            if best is None or (cost, audit) < best[:2]:
                names = {"u": "user", "a": "assistant"}
                said = []
                for g, e, (role, text) in zip(gaps, [*edits, ("", "")], [*rows, ("", "")]):
                    said += [f"{names[x]}:" for x in g]
                    said += [f"{role}:{text}"] if e[0] == "K" else [f"{names[e[1]]}:{text}"] if e[0] == "R" else []
                best = cost, audit, "\n".join(said)
    return best


def _frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string, digest string, piece long, batch long")


def _audits(spark, rows):
    found = structure.repair(_frame(spark, [(*r, "x", "y", 1, 2) for r in rows]))
    return {r["conv_id"]: r for r in structure.conversation_audits(found).collect()}


def _random_rows(rng, conv, n):
    texts = ["Yes.", "no", " ", "Well!", "so?", "and", "Yes.", "a.", "b.", "c.", "d.", "e"]
    return [(conv, k if rng.random() < 0.9 else None, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]),
             rng.choice(texts) + (str(k) + "." if rng.random() < 0.6 else "")) for k in range(n)]


def _in_order(rows):
    digest = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
    return [(r[2], r[3]) for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2][:64], r[3][:64], digest(r)))]


def test_repair_equals_trying_all_edits(spark):
    rng = random.Random(3)
    rows = [r for conv in range(60) for r in _random_rows(rng, conv, rng.randint(1, 3))]
    got = _audits(spark, rows)
    for conv in range(60):
        mine = _in_order([r for r in rows if r[0] == conv])
        cost, audit, repaired = _by_trying(mine)
        r = got[conv]
        assert (r["cost"], r["audit"], r["repaired_sha256"]) == (cost, audit, hashlib.sha256(repaired.encode()).hexdigest()), mine
        faults = Counter(_faults(mine))
        assert [r["blank"], r["duplicate"], r["truncated"]] == [faults["blank"], faults["duplicate"], faults["truncated"]]
        assert r["illegal"] == sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(mine, mine[1:]))


def _stepwise(kinds):
    """Cheapest audit by carrying whole audits forward, one per state."""
    state = {0: (0, "")}
    for kind in kinds:
        new = {}
        for s, (cost, audit) in state.items():
            for a, t, c, edits in structure.arcs_of(kind):
                if a == s:
                    new[t] = min(new.get(t, (math.inf, "")), (cost + c, audit + edits))
        state = new
    return min((cost + 2 * len(tail), audit + tail) for s, (cost, audit) in state.items() for tail in [{0: "", 1: "II", 2: "I", 3: ""}[s]])


def test_divide_and_conquer_equals_whole_audits():
    rng = random.Random(5)
    for _ in range(300):
        kinds = [rng.choice([0, 1, 4, 5, 8, 9, 12, 6, 10]) for _ in range(rng.randint(1, 60))]
        vector = structure._only(0)
        for k in kinds:
            vector = structure._ahead_row(vector, k)[1]
        last, tail = structure.last_state(vector)
        edits, cost, _ = structure.edits_between(kinds, 0, last)
        assert (cost + 2 * len(tail), "".join(edits) + tail) == _stepwise(kinds)


def test_conversations_in_pieces_equal_whole_ones(spark, monkeypatch):
    rng = random.Random(7)
    rows = [r for conv in [*range(12), None] for r in _random_rows(rng, conv, rng.randint(1, 120))]
    want = _audits(spark, rows)
    monkeypatch.setattr(structure, "MOST_ROWS", 9)
    got = _audits(spark, rows)
    assert got == want and set(got) == {*range(12), None}


def test_a_third_of_all_rows_in_one_conversation(spark):
    rng = random.Random(8)
    hot = [(None, None, "user", "same words")] * 6000 + [(None, k, "user" if k % 2 else "assistant", f"{k} said.") for k in range(9000)]
    other = [r for conv in range(200) for r in _random_rows(rng, conv, 5)]
    pieces = structure.repair(_frame(spark, [(*r, "x", "y", 1, 2) for r in hot + other])).cache()
    held = pieces.where("conv_id is null").select("n_rows", "whole").collect()
    assert len(held) >= 4 and max(r["n_rows"] for r in held) <= structure.MOST_ROWS and not any(r["whole"] for r in held)
    r = structure.conversation_audits(pieces.where("conv_id is null")).first()
    kinds = [structure.kind_of("user", k > 0, k == 0) for k in range(6000)] + [structure.kind_of("user" if k % 2 else "assistant", False, False) for k in range(9000)]
    assert (r["cost"], r["audit"]) == _stepwise(kinds)
    assert (r["duplicate"], r["truncated"], r["gaps"]) == (5999, 1, 0)
    assert r["illegal"] == 5999


def test_repair_odd_cases(spark):
    rows = [(1, None, None, None), (1, 5, "user", "Hi."), (1, 1 << 62, "assistant", "x" * 300_000 + "."),
            (2, -(1 << 62), "system", "s."), (3, 1, "user", "."), (3, 1, "user", "."), (4, 3, "", "no role."),
            (5, None, "user", "Q?"), (5, None, "assistant", "A.")]
    got = _audits(spark, rows)
    assert got[1]["audit"] == "DKK" and got[1]["blank"] == 1 and got[1]["gaps"] == (1 << 62) - 5 - 1
    assert got[2]["audit"] == "D" and got[2]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[3]["audit"] == "DD" or got[3]["cost"] == 5
    # An empty role starts no legal turn: two edits of cost 2 beat none of cost 3.
    assert got[4]["audit"] == "D" and got[4]["cost"] == 3
    assert got[5]["gaps"] == 0
    assert _audits(spark, [(1, 1 << 62, "user", "a."), (1, -(1 << 62), "user", "b.")])[1]["gaps"] == (1 << 63) - 1
    assert structure.conversation_audits(structure.repair(_frame(spark, []))).collect() == []


def test_conversation_that_lost_all_rows(spark, tmp_path):
    # crc32("c:t") % 20 = 0 drops a row.
    import zlib

    turn = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    path = str(tmp_path / "sf")
    spark.createDataFrame([(9, turn, "user", "Gone.")], "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    r = queries.op11_structure_repair(spark, path).collect()
    assert [tuple(x) for x in r] == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# --- secret scans -----------------------------------------------------------------

def _plain_spans(text):
    """The base spans by the patterns as stated, and the drop rules."""
    assign = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    either = "".join(f"[{c}{c.upper()}]" if c.islower() else c for c in "password|passwd|secret|token|api_?key")
    assign = assign.replace("password|passwd|secret|token|api_?key", either)
    out = [("assign", m.start(), m.end()) for m in re.finditer(assign, text) if len(m[1]) >= 8]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda x: (x[1], ["assign", "access", "hex"].index(x[0])))


def test_entropies_by_incremental_counts():
    rng = random.Random(1)
    text = "".join(rng.choice("aab0cd1xyzZZ9") for _ in range(400))
    for window in (24, 32):
        want = [sum(-c / window * math.log2(c / window) for c in Counter(text[i:i + window]).values()) for i in range(len(text) - window + 1)]
        assert list(secrets.window_entropies(text, window)) == pytest.approx(want, abs=1e-9)


RANDOM64 = "q7Zx2LmV9cT4pKd8WbN3sHf6JgR1yEuA"
SECRET_TEXTS = [
    (1, 'x PassWord = "abcd.efgh-12" y'), (2, "token: short"), (3, "api_key='0123456789abcdef0123456789abcdef'"), (4, "AKIAABCDEFGH1234 AKIASHORT"),
    (5, "toKen=longenough1"),  # the Kelvin sign is no k
    (6, "\U0001f600 secret=\U0001f600 secret==aaaaaaaa"), (7, "apikey:passwordpassword=12345678"), (8, None), (9, ""),
    (10, f"see {RANDOM64}, then {RANDOM64.lower()}"), (11, "id 123E4567-E89B-12D3-A456-426614174000 ok"), (12, "SHA-256: " + "0F1E2D3C4B5A69788796A5B4C3D2E1F0"),
    (13, "0F1E2D3C4B5A69788796A5B4C3D2E1F0"), (14, "Donaudampfschifffahrtsgesellschaftskapitaen"), (15, "f" * 31 + "g" + "f" * 40),
    (16, f"token={RANDOM64}"), (16, f"token={RANDOM64}"), (None, f"passwd = {RANDOM64}"), (17, "http://host/a/b/" + RANDOM64),
    (18, "w " * 50_000 + RANDOM64 + " é" * 50_000 + "AKIA" + "Z" * 20),
]


def test_secret_spans(spark):
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in SECRET_TEXTS], "doc_id long, text string, row string, spans string")
    got = [(r["row"]["doc_id"], [tuple(s) for s in r["spans"]]) for r in secrets.scan_secrets(frame).collect()]
    assert sorted(i or 0 for i, _ in got) == sorted(i or 0 for i, _ in SECRET_TEXTS)
    entropy = {}
    for i, spans in got:
        text = next(t for j, t in SECRET_TEXTS if j == i) or ""
        assert [s for s in spans if s[0] != "entropy"] == _plain_spans(text)
        entropy[i] = [text[s:e] for k, s, e in spans if k == "entropy"]
    assert entropy[10] == [RANDOM64] and entropy[13] and entropy[18] == [RANDOM64]
    assert not any(entropy[i] for i in (11, 12, 14, 15, 16, 17, None))
    assert secrets.scan_secrets(frame.limit(0)).collect() == []
    # Without the allow-list the suppressed ones appear.
    free = {r["row"]["doc_id"]: r["spans"] for r in secrets.scan_secrets(frame, allowed=(), allowed_before=()).collect()}
    assert free[12] and free[17]


def test_secret_query_on_all_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = queries.op12_secret_scan(spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = _plain_spans(texts[r["doc_id"]] or "")
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == x for k, _, _ in want) for x in ("assign", "access", "hex")]
        assert [s for s in r["spans"].split(",") if s and not s.startswith("entropy")] == [s for s in joined.split(",") if s]


# --- lexical search -----------------------------------------------------------------

def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _ranked(docs, item, top):
    held = [(i, Counter(_terms(t)), len(_terms(t))) for i, t in docs if _terms(t)]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    out = []
    for i, counts, n in held:
        m = 100 - 50 + (50 * n * n_docs) // n_terms
        score = 0
        for t in set(_terms(item)):
            df = sum(t in c for _, c, _ in held)
            if df and counts[t]:
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * counts[t] // (1000 * counts[t] + 20 * m))
        if score > 0:
            out.append((score, i))
    return [(i, s) for s, i in sorted(out, key=lambda x: (-x[0], x[1] is None, x[1] or 0))][:top]


def _searched(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["item_id"], r["rank"])):
        out.setdefault(r["item_id"], []).append((r["doc_id"], r["score"]))
        assert r["rank"] == len(out[r["item_id"]])
    return out


def _lexical_case(rng):
    words = [f"w{k}" for k in range(40)] + ["Straße", "ÀÉ", "x9"]
    text = lambda n: " ".join(rng.choices(words, weights=[60 / (k + 1) for k in range(len(words))], k=n))
    docs = [(k, text(rng.randint(1, 60))) for k in range(400)]
    docs += [(500 + k, docs[3][1]) for k in range(300)] + [(7, docs[7][1]), (None, docs[9][1]), (900, None), (901, ""), (902, " .;- "), (903, "W1_w2.W3")]
    items = [(k, text(rng.randint(1, 12))) for k in range(30)] + [(50, None), (51, "--"), (52, "unknownword"), (53, docs[3][1])]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_search_equals_brute_force(spark, monkeypatch, small):
    docs, items = _lexical_case(random.Random(11))
    if small:  # many segments and blocks of bounds, and several blocks of queries
        for name, value in {"SEGMENT_DOCS": 64, "BLOCK": 8, "QUERY_BYTES": 300, "LOTS": 3}.items():
            monkeypatch.setattr(lexical, name, value)
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, term string, score long").repartition(3)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, rank string")
    got = _searched(lexical.search(d, q, top=20))
    want = {i: _ranked(docs, t, 20) for i, t in items}
    assert got == {i: w for i, w in want.items() if w}


def test_search_skips_what_cannot_reach_the_bar(monkeypatch):
    import numpy as np

    monkeypatch.setattr(lexical, "BLOCK", 4)
    n = 4000
    places = np.arange(n)
    s = lexical.Segment(list(range(n)), np.full(n, 10), np.array([0, 1], np.int32), np.array([n, n + 40]),
                        np.r_[places, places[::100]], np.r_[np.ones(n, int), np.full(40, 3)], np.array([10, 1000]), n, 10 * n)
    everything = s.search([0, 1], 1)
    bar = int(np.sort(everything[1])[-40])
    at, score = s.search([0, 1], bar)
    assert len(everything[0]) == n and at.tolist() == places[::100].tolist() and (score >= bar).all()
    looked = []
    monkeypatch.setattr(lexical.np, "searchsorted", lambda a, v: looked.append(len(v)) or np.ndarray.searchsorted(a, v))
    s.search([0, 1], bar)
    assert sum(looked) <= 40 * 4  # of 4000 documents in the long list


def test_search_odd_cases(spark):
    d, q = "doc_id long, text string", "item_id long, text string"
    none = spark.createDataFrame([], d)
    some = spark.createDataFrame([(1, "alpha beta"), (2, None)], d)
    asked = spark.createDataFrame([(1, "alpha"), (1, "alpha")], q)
    assert lexical.search(none, asked).collect() == []
    assert lexical.search(some, spark.createDataFrame([], q)).collect() == []
    # Two rows of one item are items each; df = N = 1: weight ln(4/3).
    rows = lexical.search(some, asked).collect()
    assert [(r["item_id"], r["rank"], r["doc_id"]) for r in rows] == [(1, 1, 1)] * 2
    long = " ".join(f"t{k % 70000}" for k in range(300_000))
    rows = lexical.search(spark.createDataFrame([(1, long), (2, "t5")], d), spark.createDataFrame([(1, "T5 t6")], q)).collect()
    want = _ranked([(1, long), (2, "t5")], "T5 t6", 50)
    assert [(r["doc_id"], r["score"]) for r in sorted(rows, key=lambda r: r["rank"])] == want
    assert documents(spark).where(F.col("text").isNotNull()).count() and lexical.search(documents(spark), asked).count() == 0
