"""Operators on documents against brute force, on odd cases and on the given tables."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
import tokenizers
from pyspark.sql import functions as F

from regiocube.llm import editprint, language, mixing, packing, queries, simhash, substring, tokens
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCS, LONG, documents, removed_words, sha, simhash_components, words

VOCABULARY = public_tokenizers.path(queries.VOCABULARY)


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark)


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


@pytest.fixture(scope="module")
def given(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]


def test_language_is_learned_and_held_out_documents_are_named(spark):
    found = queries.op1_language_id(spark, SF_SMALL).toPandas()
    truth = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang").toPandas()
    both = found.merge(truth, on="doc_id")
    held = both[both.held_out]
    assert len(both) == len(truth) and 20 < len(held) < 90
    assert (held.lang_pred == held.lang).mean() >= 0.95
    assert set(both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]) == {True}
    assert both.score.between(0, 1).all()


def test_language_sample_is_not_thinned_by_copies(spark, given):
    rows = [(i, t, l, "s") for i, (t, l) in enumerate(dict.fromkeys((t, l) for _, t, l, _ in given))]
    copied = rows + [(10_000 + i, "one page, copied often", rows[0][2], "s") for i in range(3000)]
    once = [*rows, copied[-1]]
    model, plain = (language.fit(documents(spark, x).select("text", "lang"), sample_rows=400) for x in (copied, once))
    assert model.languages == plain.languages and (model.logs == plain.logs).all() and (model.scripts == plain.scripts).all()


def test_language_spans_of_mixed_text(spark, given):
    by_lang = defaultdict(list)
    for _, text, lang, _ in given:
        by_lang[lang].append(text)
    model = language.fit(documents(spark, [(i, t, l, "s") for i, (_, t, l, _) in enumerate(given)]).select("text", "lang"))
    a, b = (" ".join(max(by_lang[x], key=len).split()[:60]) for x in ("en", "de"))
    row = language.identify(documents(spark, [(1, f"{a} 123 {b}", "en", "s")]), model).first()
    assert [s["lang"] for s in row["spans"]] == ["en", "de"]
    assert row["spans"][0]["start"] == 0 and abs(row["spans"][1]["start"] - len(a)) < 40
    assert 0.3 < row["score"] < 0.8
    # the best path, by trying every labelling of a few words
    import itertools

    import numpy as np
    rng = np.random.default_rng(0)
    sizes = [4, 0, 3, 1]
    scores = rng.normal(size=(8, 3)).astype(np.float32)
    path = language.viterbi(scores, np.array(sizes), 0.7)
    at = 0
    for n in sizes:
        worth = lambda p: sum(scores[at + i, x] for i, x in enumerate(p)) - 0.7 * sum(x != y for x, y in zip(p, p[1:]))  # noqa: B023, E731
        best = max(itertools.product(range(3), repeat=n), key=worth)
        assert worth(tuple(path[at:at + n])) == pytest.approx(worth(best))
        at += n


def test_language_odd_cases(odd, none):
    model = language.fit(odd.select("text", "lang"))
    rows = language.identify(odd, model).select("row.doc_id", "row.size", "lang_pred", "score", "row.text").collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        assert r["size"] == "x"
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and (r["score"] > 0) == letters
    assert language.identify(none, model).count() == 0
    empty = language.fit(none.select("text", "lang"))
    assert {r["lang_pred"] for r in language.identify(odd, empty).collect()} == {"und"}
    names, shares, spans = language._label(model, ["\u0301\u0302", "e\u0301\u0301", "\u0301 \u0302 12"], language.SWITCH)
    assert [n == "und" for n in names] == [not s for s in spans] == [s == 0 for s in shares] == [True, False, True]


def _dedup(df):
    return [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in
            substring.dedup_substrings(df).select("row.doc_id", "n_words", "n_removed", "kept").collect()]


def _key(row):
    return tuple((x is not None, x) for x in row)


def test_substring_dedup_odd_cases(odd, none):
    plain = [(d, t) for d, t, _, _ in DOCS]
    want = [(d, n, len(gone), " ".join(kept)) for (d, _), (n, kept, gone) in zip(plain, removed_words(plain))]
    assert sorted(_dedup(odd), key=_key) == sorted(want, key=_key)
    assert substring.dedup_substrings(none).count() == 0


def test_substring_dedup_intervals_are_maximal(spark):
    rows = [(1, " ".join(f"a{i}" for i in range(40)), "en", "s"),
            (2, " ".join([*(f"a{i}" for i in range(20)), "new", *(f"a{i}" for i in range(5, 30))]), "en", "s")]
    got = {r["doc_id"]: r for r in substring.dedup_substrings(documents(spark, rows)).select("row.doc_id", "removed", "kept").collect()}
    assert [tuple(x) for x in got[2]["removed"]] == [(0, 20), (21, 46)] and got[2]["kept"] == "new"
    assert got[1]["removed"] == []


def test_substring_dedup_over_many_batches(spark, monkeypatch):
    rng = random.Random(3)
    phrases = [[f"p{k}w{i}" for i in range(rng.randint(8, 40))] for k in range(12)]
    rows = []
    for doc in rng.sample(range(-5000, 5000), 150):
        text = [w for _ in range(rng.randint(0, 6)) for w in (rng.choice(phrases) if rng.random() < 0.5 else
                                                              [f"u{rng.randint(0, 60)}" for _ in range(20)])]
        rows.append((doc, rng.choice([" ", "  ", "\n"]).join(text), "en", "s"))
    monkeypatch.setattr(substring, "BATCH_BYTES", 4000)
    monkeypatch.setattr(substring, "BUCKET_WINDOWS", 500)
    plain = [(d, t) for d, t, _, _ in rows]
    want = [(d, n, len(gone), " ".join(kept)) for (d, _), (n, kept, gone) in zip(plain, removed_words(plain))]
    assert sorted(_dedup(documents(spark, rows))) == sorted(want)


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    data = LONG.encode()
    whole = substring.word_hashes(data)
    monkeypatch.setattr(substring, "_PIECE", 100)
    assert (substring.word_hashes(data) == whole).all() and len(whole) == len(data.split())


def test_simhash_given_and_odd_cases(spark, odd, none, given):
    plain = [(d, t) for d, t, _, _ in DOCS]
    got = [(r["doc_id"], r["simhash"] & (1 << 64) - 1, r["component_id"]) for r in simhash.simhash_classes(odd).collect()]
    want = [(d, f, c) for (d, _), (f, c) in zip(plain, simhash_components(plain))]
    assert sorted(got, key=_key) == sorted(want, key=_key)
    assert simhash.simhash_classes(none).count() == 0
    plain = [(d, t) for d, t, _, _ in given]
    want = {d: (f"{f:016x}", c) for (d, _), (f, c) in zip(plain, simhash_components(plain))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op6_simhash_dedup(spark, SF_SMALL).collect()}
    assert got == want


def test_simhash_pairs_are_whole_and_single(spark):
    rng = random.Random(1)
    seeds = [rng.getrandbits(64) for _ in range(30)]
    points = sorted({s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for s in seeds for _ in range(12)})
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(points)]
    df = spark.createDataFrame(signed, "node long, simhash long")
    got = [tuple(sorted((r["src"], r["dst"]))) for r in simhash.near_pairs(df).collect()]
    want = {(i, j) for i, a in enumerate(points) for j, b in enumerate(points[:i]) if (a ^ b).bit_count() <= 4}
    assert len(got) == len(set(got)) and set(got) == {tuple(sorted(x)) for x in want} and len(got) > 100


def test_rows_that_look_small_in_files_are_not_broadcast(spark, odd, tmp_path):
    spark.createDataFrame([(i, i) for i in range(500)], "node long, simhash long").write.parquet(f"{tmp_path}/points")
    plan = simhash.near_pairs(spark.read.parquet(f"{tmp_path}/points"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    plan = packing.pack(odd, VOCABULARY)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("BroadcastExchange") == 1  # the ranges of the patterns


def test_simhash_keep_one(odd):
    kept = simhash.keep_one(odd).select("doc_id", "text", "rank").collect()
    ids = [r["doc_id"] for r in kept]
    assert sorted(i for i in ids if i is not None) == [-3, 1, 2, 3, 6, 7, 9, 10, 1 << 62] and ids.count(None) == 2
    assert {r["rank"] for r in kept} == {"x"}


def test_simhash_keeps_unlike_texts_of_one_id(spark):
    text = [" ".join(f"{c}{i * 7 % 101}" for i in range(200)) for c in "abcd"]
    rows = [(1, text[0]), (2, text[0] + " more"), (2, text[1]), (2, text[1]), (2, text[2]), (5, text[2]), (4, text[3]),
            (2, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["doc_id"], r["text"] or "") for r in simhash.keep_one(docs).collect())
    assert kept == sorted([(1, text[0]), (2, text[1]), (2, text[2]), (4, text[3]), (2, "")])
    classes = {(r["doc_id"], r["simhash"], r["component_id"]) for r in simhash.simhash_classes(docs).collect()}
    near = {(d, f if f < 1 << 63 else f - (1 << 64), c) for (d, _), (f, c) in zip(rows, simhash_components(rows))}
    assert classes == near and {c for _, _, c in near} == {1, 2, 4}


def test_language_of_long_texts_in_chunks(monkeypatch):
    rng = random.Random(3)
    names = ["de", "el", "en"]
    alphabet = {"de": "abcdefghij", "en": "ghijklmnop", "el": "αβγδεζηΣ"}
    word = lambda k: "".join(rng.choices(alphabet[k], k=rng.randint(1, 7)))
    counts = np.full((3, language.BUCKETS), 0.1)
    scripts = np.ones((len(language._NAMES), 3), bool)
    for i, k in enumerate(names):
        w = language.words_of([" ".join(word(k) for _ in range(3000))])
        np.add.at(counts[i], w.features, 1)
        np.add.at(counts[i], w.whole, 1)
    model = language.Model(names, np.log(counts / counts.sum(1, keepdims=True)).T.astype(np.float32), scripts)
    text = " \n".join(" ".join(word(k) for _ in range(rng.randint(1, 25))) for k in rng.choices(names, k=120))
    (want,), (share,), (spans,) = language._label(model, [text], language.SWITCH)
    assert len(spans) > 20
    for chunk in (40, 333, 5000):
        monkeypatch.setattr(language, "_CHUNK", chunk)
        assert [text[a:b] for a, b in language._chunks(text)] and "".join(text[a:b] for a, b in language._chunks(text)) == text
        assert language._label_long(model, text, language.SWITCH) == (want, share, spans)
        assert language._label(model, [text], language.SWITCH) == ([want], [share], [spans])
    monkeypatch.setattr(language, "_CHUNK", 40)
    monkeypatch.setattr(language, "_GATHER", 30)
    assert language._label_long(model, text, language.SWITCH) == (want, share, spans)
    assert language._label_long(model, "1 " * 100, language.SWITCH) == ("und", 0.0, [])
    assert language._label_long(model, "\u0301 " * 100, language.SWITCH) == ("und", 0.0, [])
    assert language._label_long(model, "αβγ" * 100, language.SWITCH)[0] == "el"  # one run of letters
    assert [b - a for a, b in language._chunks("ab-" * 30)] == [39, 39, 12]


def test_mixing_comes_near_its_targets(spark, odd, none):
    rows = queries.op7_source_mixing(spark, SF_SMALL).collect()
    again = queries.op7_source_mixing(spark, SF_SMALL).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    sources = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    taken, target, longest = Counter(), {}, Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        s = sources[r["doc_id"]]
        taken[s] += r["taken"]
        target[s] = r["target"]
        longest[s] = max(longest[s], r["size"])
    assert sum(target.values()) == pytest.approx(sum(r["size"] for r in rows))
    for s in target:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6
    odd_rows = mixing.allocate(odd).select("row.size", "doc_id", "source", "copies", "row.text").collect()
    assert len(odd_rows) == len(DOCS) and all(0 <= r["copies"] <= 3 for r in odd_rows)
    assert mixing.allocate(none).count() == 0 and mixing.mixed(none).count() == 0
    assert mixing.mixed(odd).columns == odd.columns


def test_mixing_targets_reach_the_water_level(spark):
    sizes = {"a": 10, "b": 1000, "c": 40, "d": 500, "e": 0, None: 7}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    order = [*sorted(s for s in sizes if s is not None), None]
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:  # share by weight, fix what is over, share the excess again
        left = sum(sizes.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            target |= share
            break
        target |= {s: 3 * sizes[s] for s in over}
        open_ -= over
    assert got == pytest.approx(target)


def test_mixing_frequencies_match_the_inclusion_probabilities(spark):
    # Sources of equal make-up draw on their own: 600 samples in one run.
    sizes = [1, 1, 4, 4, 9, 16, 16, 25, 36, 100, 100, 400, 900, 2500]
    docs = spark.range(900 * len(sizes)).select(
        F.col("id").alias("doc_id"), F.format_string("s%04d", F.floor(F.col("id") / len(sizes))).alias("source"),
        F.repeat(F.lit("w "), F.element_at(F.array(*map(F.lit, sizes)), (F.col("id") % len(sizes) + 1).cast("int"))).alias("text"))
    rows = mixing.allocate(docs).select("source", "size", "copies", "chance", "target", "source_size").collect()
    of_half = [r for r in rows if abs(r["target"] / r["source_size"] % 1 - 0.5) < 0.01]
    assert len({r["source"] for r in of_half}) == 600
    rest = sum(sizes) / 2
    drawn, chance = Counter(), {}
    for r in of_half:
        drawn[r["size"]] += r["copies"] - int(r["target"] / r["source_size"])
        chance[r["size"]] = r["chance"]
    assert sum(chance[n] * n for n in sizes) == pytest.approx(rest, rel=0.01)
    for n in set(sizes):
        assert chance[n] == pytest.approx(min(1.0, n ** 0.5 * chance[1]), rel=1e-6)
        assert abs(drawn[n] / 600 / sizes.count(n) - chance[n]) < 0.08, n


def test_mixing_certain_documents_and_hot_ids(spark):
    # One long document passes 1 and is certain; the rest is drawn among the others.
    docs = [(i, "a", "w " * 10) for i in range(60)] + [(60, "a", "w " * 500), (61, "b", "w " * 100)]
    rows = mixing.allocate(spark.createDataFrame(docs, "doc_id long, source string, text string"),
                           weights=(3, 2)).select("source", "size", "copies", "chance", "target").collect()
    taken = sum(r["copies"] * r["size"] for r in rows if r["source"] == "a")
    assert abs(taken - next(r["target"] for r in rows if r["source"] == "a")) <= 250
    long = next(r for r in rows if r["size"] == 500)
    assert all(r["chance"] <= long["chance"] <= 1 for r in rows if r["source"] == "a")
    certain = mixing.allocate(spark.createDataFrame(docs[:61] + [(61, "b", "w " * 2000)], "doc_id long, source string, text string"),
                              weights=(1, 3)).where("source = 'a'").select("size", "copies", "chance").collect()
    assert next((r["copies"], r["chance"]) for r in certain if r["size"] == 500) == (1, 1.0)
    # Null and repeated ids of different texts draw numbers of their own.
    same = spark.range(400).select(F.when(F.col("id") % 2 == 0, F.lit(5)).cast("long").alias("doc_id"), F.lit("s").alias("source"),
                                   F.concat(F.lit("w w w w w w w w "), F.col("id").cast("string")).alias("text"))
    other = spark.createDataFrame([(1000, "t", "w " * 2000)], same.schema)
    found = mixing.allocate(same.union(other), weights=(1, 1)).where("source = 's'").select("doc_id", "copies").collect()
    assert {tuple(r) for r in found} == {(None, 0), (None, 1), (5, 0), (5, 1)}
    assert abs(sum(r["copies"] for r in found) * 9 - 2800) <= 60  # words of 9 a text


def test_pareto_buckets_do_not_change_the_sample(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    one = sorted((r["doc_id"], r["copies"]) for r in mixing.allocate(docs).collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 2)
    assert sorted((r["doc_id"], r["copies"]) for r in mixing.allocate(docs).collect()) == one


def _ids(texts):
    model = tokenizers.Tokenizer.from_file(VOCABULARY)
    return [model.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_token_counts_are_the_librarys(odd, none):
    got = [(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in tokens.token_counts(odd, VOCABULARY).collect()]
    want = [(d, len((t or "").encode()), len(i)) for (d, t, _, _), i in zip(DOCS, _ids([t for _, t, _, _ in DOCS]))]
    assert sorted(got, key=_key) == sorted(want, key=_key)
    assert tokens.token_counts(none, VOCABULARY).count() == 0


def test_token_counts_of_each_kind_of_vocabulary(odd):
    import sentencepiece

    texts = [t or "" for _, t, _, _ in DOCS]
    path = public_tokenizers.path("piece_bpe_32k.model")
    piece = sentencepiece.SentencePieceProcessor(model_file=path)
    assert sorted(r["n_tokens"] for r in tokens.token_counts(odd, path).collect()) == sorted(len(piece.encode(t)) for t in texts)
    path = public_tokenizers.path("byte_bpe_50k.json")
    byte = tokenizers.Tokenizer.from_file(path)
    assert sorted(r["n_tokens"] for r in tokens.token_counts(odd, path).collect()) == sorted(
        len(byte.encode(t, add_special_tokens=False).ids) for t in texts)


def test_spaces_are_safe_boundaries():
    rng = random.Random(7)
    alphabet = [" ", " ", "́", "a", "E", "é", "İ", "Σ", "'", "s", "l", "1", " ", "\n", " ", "\x1c", ".", "<|endoftext|>",
                "ᄀ", "ᅡ", "\U0001f600", "Å", "क़"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 25))) for _ in range(3000)]
    encoder = tokens.Encoder(VOCABULARY)
    assert encoder.split
    got = [[int.from_bytes(b[i:i + 4], "little") for i in range(0, len(b), 4)] for b in encoder.ids(texts)]
    assert got == _ids(texts)


def test_packing_holds_every_id_once(odd, none):
    rows = packing.pack(odd, VOCABULARY, max_tokens=64).collect()
    want = Counter()
    for (doc, _, _, _), ids in zip(DOCS, _ids([t for _, t, _, _ in DOCS])):
        ids = [*ids, 1]
        for start in range(0, len(ids), 64):
            part = ids[start:start + 64]
            want[doc, start, len(part), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(none, VOCABULARY).count() == 0


def test_shortest_pack_first_packs_all_and_wastes_little():
    rng = random.Random(2)
    for most in (5, 64, 2048):
        histogram = {n: rng.randint(1, 400) for n in rng.sample(range(1, most + 1), min(most, 150))}
        patterns = packing.shortest_pack_first(histogram, most)
        got = Counter()
        for lengths, count in patterns:
            assert sum(lengths) <= most and count > 0
            for n in lengths:
                got[n] += count
        assert got == histogram
        sequences = sum(c for _, c in patterns)
        longer = sum(c for n, c in histogram.items() if 2 * n > most)  # no two of them share a sequence
        assert sequences <= max(longer, 1.25 * sum(n * c for n, c in histogram.items()) / most) + len(histogram)


def test_edited_fingerprints(spark, odd, none):
    got = editprint.compare_edited(odd).collect()
    known = sorted(((d, t or "") for d, t, _, _ in DOCS if d is not None))
    unknown = [t or "" for d, t, _, _ in DOCS if d is None]
    rows = sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"]) for r in got), key=_key)
    texts = [t for _, t in known]
    prints = dict(zip(texts + unknown, editprint.fingerprints(texts + unknown)))
    follow = {}
    for (d, t), nxt in zip(known, [*texts[1:], None]):
        follow[d, t] = nxt
    for d, n, digest, fp in rows:
        matches = [t for i, t in known if i == d and prints[t] == fp and len(t) == n] if d is not None else \
            [t for t in unknown if prints[t] == fp and len(t) == n]
        assert matches
        if d is not None and follow[d, matches[0]] is not None:
            nexts = {follow[d, t] for t in matches} | ({matches[0]} if sum(i == d for i, _ in known) > 1 else set())
            assert digest in {sha(editprint.edited(matches[0], x)) for x in nexts}
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert editprint.compare_edited(none).count() == 0


def test_edit_likeness_tells_edits_from_strangers(given):
    texts = [t for _, t, _, _ in given if len(t) > 400][:40]
    changed = [t[:100] + "x" + t[101:200] + t[204:] for t in texts]
    own, near = editprint.fingerprints(texts), editprint.fingerprints(changed)
    assert own == editprint.fingerprints(list(reversed(texts)))[::-1]
    alike = [editprint.likeness(a, b) for a, b in zip(own, near)]
    other = [editprint.likeness(own[i], own[i - 1]) for i in range(len(own)) if texts[i] != texts[i - 1]]
    assert sorted(alike)[len(alike) // 2] > 0.8 and sorted(other)[len(other) // 2] < 0.25
    assert editprint.likeness(own[0], own[0]) == 1.0


def test_edited_query_matches_plain_order(spark, given):
    got = {r["doc_id"]: r for r in queries.op9_edit_fingerprints(spark, SF_SMALL).collect()}
    rows = sorted((d, t or "") for d, t, _, _ in given)
    for (d, t), (_, nxt) in zip(rows, [*rows[1:], rows[0]]):
        assert got[d]["edited_sha256"] == sha(editprint.edited(t, nxt)) and got[d]["n_chars"] == len(t)
    assert len(got) == len(rows) and words("a b") == ["a", "b"]


def test_edit_distance_by_table():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 14))) for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        assert editprint.edit_distance(a, b) == row[-1]


def test_edit_near_duplicates(spark, odd, none, given):
    rng = random.Random(4)
    base = [t for _, t, _, _ in given if 300 < len(t) < 4000][:25]
    rows, truth = [], {}
    for i, t in enumerate(dict.fromkeys(base)):
        for k in range(4):
            chars = list(t)
            for _ in range(int(len(chars) * 0.004 * k)):
                at = rng.randrange(len(chars))
                chars[at:at + 1] = rng.choice(["", "x", chars[at] + "y"])
            rows.append((1000 + 10 * i + k, "".join(chars), "en", "s"))
            truth[1000 + 10 * i + k] = i
    got = {r["doc_id"]: r["class_id"] for r in editprint.near_duplicates(documents(spark, rows)).collect()}
    right = sum(got[1000 + 10 * i + k] == got[1000 + 10 * i] for i in set(truth.values()) for k in range(1, 4))
    assert right >= 0.9 * 3 * len(set(truth.values()))
    for d, c in got.items():  # nothing unlike is joined
        a, b = (next(t for i, t, _, _ in rows if i == x) for x in (d, c))
        assert editprint.edit_distance(a, b) <= 0.06 * max(len(a), len(b))
    classes = {}
    for r in editprint.near_duplicates(odd).collect():
        classes.setdefault(r["doc_id"], set()).add(r["class_id"])
    assert classes[8] == {1} and classes[None] == {None} and classes[4] == {3} and len(classes) == len({d for d, *_ in DOCS})
    assert editprint.near_duplicates(none).count() == 0


def _changed(rng, text, share):
    chars = list(text)
    for _ in range(int(len(chars) * share)):
        at = rng.randrange(len(chars))
        chars[at:at + 1] = rng.choice(["", "x", chars[at] + "y"])
    return "".join(chars)


def test_pairs_up_to_the_stated_edits_are_found(spark, given):
    rng = random.Random(8)
    rows, pairs = [], []
    for i, t in enumerate(dict.fromkeys(t for _, t, _, _ in given if 60 < len(t) < 16000)):
        near = _changed(rng, t, 0.02)
        if near != t and editprint.edit_distance(t, near) <= 0.02 * max(len(t), len(near)):
            rows += [(2 * i, t, "en", "s"), (2 * i + 1, near, "en", "s")]
            pairs.append(2 * i)
    got = {r["doc_id"]: r["class_id"] for r in editprint.near_duplicates(documents(spark, rows)).collect()}
    assert len(pairs) > 100 and sum(got[i] == got[i + 1] for i in pairs) >= 0.98 * len(pairs)


def test_a_family_is_joined_without_all_its_pairs(spark, given):
    rng = random.Random(9)
    base = next(t for _, t, _, _ in given if 900 < len(t) < 2000)
    texts = list(dict.fromkeys(_changed(rng, base, 0.003) for _ in range(100)))
    got = editprint.near_duplicates(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()
    assert {r["class_id"] for r in got} == {0} and len(got) == len(texts)
    assert len(texts) - 1 <= sum(r["n_links"] for r in got) / 2 < 4 * len(texts)


def test_within_is_the_edit_distance():
    rng = random.Random(10)
    for _ in range(500):
        a = "".join(rng.choices("abcde", k=rng.randint(0, 200)))
        b, most = _changed(rng, a, rng.random() / 20), rng.randint(0, 6)
        assert editprint.within(a, b, most) == (editprint.edit_distance(a, b) <= most)


def test_edit_query_names_the_classes(spark, given):
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in queries.op9_edit_fingerprints(spark, SF_SMALL).collect()}
    near = editprint.near_duplicates(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
    assert got == {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near} and len(got) == len(given)


def _plain_fingerprint(text):
    """One step after the other, as the walk is described."""
    walk = editprint._Walk.get()
    sampled = set(editprint.sample_steps(4 * len(text) + 8).tolist())
    head, out, j = 0, "", 0
    while head < len(text):
        c = ord(text[head])
        c = c + 1 if c < 128 else 129 + c % 127
        if j in sampled:
            out += "0123456789abcdef"[walk.digits[j % 4096, c]]
        head += int(walk.moves[j % 4096, c])
        j += 1
    return out


def test_fingerprints_equal_the_plain_walk(given):
    texts = ["", "a", "é\U0001f600x", "ab" * 700, *[t for _, t, _, _ in given if t][:40]]
    prints = editprint.fingerprints(texts)
    assert prints == [_plain_fingerprint(t) for t in texts]
    a, b = prints[5], prints[6]
    steps = editprint.sample_steps(1 << 20)
    gaps = [max(1, int(x) // editprint.DENSITY) for x in steps[:max(len(a), len(b))]]
    same = sum(g for g, x, y in zip(gaps, a, b) if x == y)
    assert editprint.likeness(a, b) == pytest.approx(same / sum(gaps))


@pytest.mark.parametrize("n, many", [(100, 60), (300, 60), (1000, 60), (4000, 60), (16000, 30)])
@pytest.mark.parametrize("where", [(0, 1), (0, 1 / 8), (7 / 8, 1), (0.4, 0.6)])
def test_bands_find_edits_wherever_they_are(given, n, many, where):
    rng = random.Random(n)
    prose = "\n".join(t for _, t, _, _ in given if t)
    prose = prose * (1 + 40 * n // len(prose))
    left, right = [], []
    for _ in range(many):
        at, size = rng.randrange(len(prose) - 2 * n), int(n * rng.uniform(0.7, 1.4))
        t = list(prose[at:at + size])
        left.append("".join(t))
        for _ in range(max(1, int(0.018 * size))):
            i = rng.randrange(int(where[0] * len(t)), max(1, int(where[1] * len(t))))
            t[i:i + 1] = rng.choice(["", "x", t[i] + "y"])
        right.append("".join(t))
    pairs = zip(editprint.band_keys(left), editprint.band_keys(right))
    least = editprint.LEAST_BANDS
    assert sum(len(set(a) & set(b)) >= max(1, min(len(a), len(b)) * least) for a, b in pairs) >= 0.95 * many


def test_a_common_head_is_no_family(spark):
    """Texts that are alike at their beginning alone: no links, and not all pairs of them are tested."""
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(4000)]
    head = " ".join(rng.choices(words, k=100))
    texts = [head + " " + " ".join(rng.choices(words, k=300)) for _ in range(3000)]
    texts += [_changed(rng, t, 0.01) for t in texts[:50]]
    got = {r["doc_id"]: r["class_id"] for r in editprint.near_duplicates(documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)], clashing=False)).collect()}
    assert all(got[i] == i for i in range(3000)) and sum(got[3000 + i] == i for i in range(50)) >= 48


@pytest.mark.parametrize("block", [32_000, 90])
def test_pairs_that_share_crowded_bands_alone_are_found(spark, monkeypatch, block):
    """Near pairs all of whose common bands lie in the head that hundreds of texts begin with."""
    monkeypatch.setattr(editprint, "_BLOCK", block)
    rng = random.Random(13)
    letters = "abcdefghijklmnopqrstuvwxyz "
    head = "".join(rng.choices(letters, k=60))
    texts = [head + "".join(rng.choices(letters, k=rng.randint(45, 60))) for _ in range(300)]
    keys = editprint.band_keys(texts)
    held = Counter(k for of in keys for k in set(of))
    pairs, rows = {}, dict(enumerate(texts))
    for i, t in enumerate(texts):
        for _ in range(60):
            near = list(t)
            for at in (rng.randrange(62, 75), rng.randrange(len(t) - 12, len(t))):
                near[at] = rng.choice(letters)
            near = "".join(near)
            common = set(keys[i]) & set(editprint.band_keys([near])[0])
            if near != t and common and all(held[k] > 2 * editprint.HOT_CLASSES for k in common):
                pairs[1000 + i] = i
                rows[1000 + i] = near
                break
    assert len(pairs) >= 30
    got = {r["doc_id"]: r["class_id"] for r in editprint.near_duplicates(documents(spark, [(i, t, "en", "s") for i, t in rows.items()], clashing=False)).collect()}
    assert all(got[a] == got[b] == b for a, b in pairs.items())
    assert all(got[i] == i for i in range(len(texts)))


def test_many_pairs_at_once_are_within_the_edit_distance():
    rng = random.Random(14)
    texts = []
    for letters in ("abcde", "abcdé\U0001f600 "):
        for _ in range(200):
            a = "".join(rng.choices(letters, k=rng.randint(1, 500)))
            texts += sorted([a, _changed(rng, a, rng.random() * 0.06)], key=len)
    texts.append("".join(chr(300 + i) for i in range(300)))  # codes of two bytes
    for some in (texts[:-1], texts):
        tape = editprint._Tape(pa.chunked_array([pa.array(some)]))
        x, y = np.arange(0, 800, 2), np.arange(1, 800, 2)
        most = (0.03 * tape.n[y] + 1e-9).astype(np.int64)
        want = [editprint.edit_distance(some[a], some[b]) <= k for a, b, k in zip(x, y, most)]
        assert tape.within(x, y, most).tolist() == want and 100 < sum(want) < 350


def test_a_dense_group_makes_few_rows(given):
    """Near copies of which most pairs are over the edits: no row but those that hold groups together, and no link is lost."""
    rng = random.Random(15)
    base = next(t for _, t, _, _ in given if 900 < len(t) < 1300)
    texts = sorted({_changed(rng, base, rng.choice([0.005, 0.012, 0.02, 0.03])) for _ in range(80)}, key=len)
    n, size = [len(t) for t in texts], len(texts)
    rows = pa.table({
        "key": [7] * size, "step": [-1] * size, "i": [0] * size, "j": [0] * size, "point": list(range(size)), "n": n,
        "shorter": [True] * size, "longer": [True] * size, "text": texts,
        "keys": pa.array(editprint.band_keys(texts), pa.list_(pa.int64())),
        "sketch": pa.array([editprint.gram_sketch(t) for t in texts], pa.list_(pa.int64()))})
    assert size / 2 < editprint._near_pairs(rows.drop(["keys", "text"]), 0.02).num_rows < size

    def classes(pairs):
        least = list(range(size))
        for _ in range(size):
            for a, b in pairs:
                least[a] = least[b] = min(least[a], least[b])
        return least

    keys = [set(k) for k in rows["keys"].to_pylist()]
    near = [(a, b) for b in range(size) for a in range(b) if keys[a] & keys[b] and editprint.within(texts[a], texts[b], int(0.02 * n[b] + 1e-9))]
    links = editprint._links(rows, 0.02)
    got = list(zip(links["src"].to_pylist(), links["dst"].to_pylist()))
    assert classes(got) == classes(near) and len(got) < size < len(near) < size * (size - 1) / 3
    assert {tuple(sorted(p)) for p in got} <= set(near)


def test_texts_of_no_neighbourhood_are_not_moved(spark):
    rng = random.Random(17)
    points = [0, 7, 8, -1, -8, (1 << 24) - 1, (1 << 60) - 1, -1 << 63, *(rng.getrandbits(60) for _ in range(3000))]
    own = spark.createDataFrame([(i, p, f"text {i}") for i, p in enumerate(points)], "doc_id long, point long, text string")
    hoods = spark.createDataFrame([(p,) for p in points[:1000]], "point long")
    sieved = editprint._sieved(own, hoods, "point")
    got = {r["doc_id"] for r in sieved.collect()}
    assert got >= set(range(1000)) and len(got) < 1005 and sieved.columns == own.columns
    assert "SortMergeJoin" not in sieved._jdf.queryExecution().executedPlan().toString()
    assert editprint._sieved(own, hoods.limit(0), "point").count() == 0


def test_blocks_of_a_family_never_ask_for_more_than_the_edits(given):
    """Lower bounds from a pivot's blocks hold on every pair, odd ones too, and spare most alignments of pairs that are not alike."""
    rng = random.Random(16)
    base = next(t for _, t, _, _ in given if 900 < len(t) < 1300)
    words = base.split(" ")

    def copy(many):
        out = words[:]
        for _ in range(many):
            i = rng.randrange(len(out))
            out[i:i + 1] = rng.choice([[], [out[i], rng.choice(words)], [rng.choice(words)]])
        return " ".join(out)

    periodic = "abcdefg " * 150
    odd = [periodic, periodic[:900], periodic[3:], base[:500] + base[:500], base[300:], base[::-1], base[400:] + base[:400],
           base[:64] * 12, base[:30] + "\u4e2d" + base[30:], _changed(rng, periodic, 0.02), _changed(rng, periodic, 0.04)]
    family = [copy(rng.choice([1, 2, 4, 8, 16])) for _ in range(60)]
    for extra in ([], odd, [*odd, "".join(chr(300 + i) for i in range(300))]):
        texts = sorted({*family, base, *extra}, key=len)
        size = len(texts)
        rows = pa.table({
            "key": [0] * size, "step": [-1] * size, "i": [0] * size, "j": [0] * size, "point": list(range(size)), "n": [len(t) for t in texts],
            "shorter": [True] * size, "longer": [True] * size, "text": texts,
            "sketch": pa.array([editprint.gram_sketch(t) for t in texts], pa.list_(pa.int64()))})
        place = editprint._Place(rows, 0.02)
        tape = editprint._Tape(place.rows["text"])
        x, y = np.triu_indices(size, 1)
        exact = np.array([editprint.edit_distance(texts[a], texts[b]) for a, b in zip(x, y)])
        most = (0.02 * tape.n[y] + 1e-9).astype(np.int64)
        tape.families = editprint._Families(tape, place)
        least = tape.families.least(x, y)
        alike = exact <= most
        assert (least[alike] <= exact[alike]).all() and (least[~alike] > most[~alike]).mean() > (0.5 if not extra else 0.25)
        assert (tape.families.rest(x, y)[:, 0][alike] <= exact[alike]).all()
        near = tape.n[y] - tape.n[x] <= most
        assert tape.within(x[near], y[near], most[near]).tolist() == alike[near].tolist() and 20 < alike.sum() < len(x) / 2


def _thue_morse(n):
    return "".join("ab"[bin(i).count("1") & 1] for i in range(n))


def test_words_of_equal_hash_stay_apart(spark):
    """Two words whose polynomials modulo 2**64 agree for every odd base."""
    one = _thue_morse(1024)
    other = one.translate(str.maketrans("ab", "ba"))
    assert one != other and (substring.word_hashes(one.encode()) == substring.word_hashes(other.encode())).all()
    head = " ".join(f"w{i}" for i in range(12))
    rows = [(1, f"{head} {one}"), (2, f"{head} {other}"), (3, f"{head} {other} end"), (4, f"{other} {head}")]
    df = documents(spark, [(i, t, "en", "a") for i, t in rows], clashing=False)
    got = {r["doc_id"]: (r["n_removed"], r["kept"]) for r in substring.dedup_substrings(df).select("row.doc_id", "n_removed", "kept").collect()}
    assert got == {1: (0, rows[0][1]), 2: (0, rows[1][1]), 3: (13, "end"), 4: (0, rows[3][1])}


@pytest.mark.parametrize("batch_bytes", [1 << 22, 3000])
def test_forced_collisions_change_nothing(spark, monkeypatch, batch_bytes):
    """Windows of a few keys only: every pair of windows is a candidate, in one batch and over many."""
    rng = random.Random(6)
    shared = [" ".join(rng.choices([f"p{k}" for k in range(50)], k=20)) for _ in range(6)]
    rows = [(i, " ".join([*rng.choices([f"u{k}" for k in range(300)], k=20), rng.choice(shared), str(i), rng.choice(shared)])) for i in range(120)]
    rows += [(7, rows[7][1]), (200, rows[3][1])]
    monkeypatch.setattr(substring, "BATCH_BYTES", batch_bytes)
    seen = spark.sparkContext.accumulator(0)

    def few(words, window):
        seen.add(1)
        return substring.window_hashes(words, window) % 5 * (1 << 61)

    df = documents(spark, [(i, t, "en", "a") for i, t in rows], clashing=False)
    found = substring.dedup_substrings(df, hashed=few).select("row.doc_id", "n_words", "kept").collect()
    want = sorted((i, n, " ".join(kept)) for (i, _), (n, kept, _) in zip(rows, removed_words(rows)))
    assert sorted(map(tuple, found)) == want and seen.value


