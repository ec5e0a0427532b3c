"""Language identification of mixed-language text.

Scripts narrow the candidates of each word (those languages whose training
text uses the script of the word's letters), hashed features score the word
under each candidate, and Viterbi over the words with a penalty for each switch
labels the spans of the text.

A word is a maximal run of letters and marks, lower-cased. Its features are the
word itself and one trigram per letter (with its neighbours or the word's
edge), hashed into ``BUCKETS`` buckets. Everything per letter is NumPy over the
code points of many texts at once; Viterbi steps run over many texts side by
side, the longest first. A long text goes in chunks of bounded size cut at white
space: a first pass keeps the Viterbi state at each chunk's start, a second one
from the last chunk back follows the best path. Memory does not grow with the text.

The model (log shares of the buckets per language, and the scripts of each language)
is fitted on at most about ``SAMPLE_ROWS`` different whole texts per language,
drawn by a hash of the text, and is ``languages * BUCKETS * 4`` bytes large (at most
``MOST_LANGUAGES`` languages: 64 MB; more values of lang are an error).
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiocube.llm.common import map_arrow, text_slices

BUCKETS = 1 << 15
SAMPLE_ROWS = 5_000
MOST_LANGUAGES = 512
#: Log-probability that a change of language between two words costs.
SWITCH = 6.0
#: A word's evidence for one language against another is at most this large.
MOST_EVIDENCE = 8.0
#: A language uses a script that makes up this share of its training letters.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
#: Bytes of text handled at once; each takes about a hundred bytes of memory meanwhile.
_SLICE = 1 << 20
#: Languages up to which whole slices are scored at once; with more, slices are smaller.
_SLICE_LANGUAGES = 32
#: Code points of a chunk of a long text.
_CHUNK = 1 << 18
#: Entries of the table of letters by languages that is gathered at once.
_GATHER = 1 << 22

# First code point and name of the ranges told apart.
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"), (0x0B00, "Oriya"), (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
    (0x1780, "Khmer"), (0x1800, "Mongolian"), (0x18B0, "Other"), (0x1D00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "Other"), (0x2C60, "Latin"), (0x2C80, "Other"), (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Han"),
    (0x3130, "Hangul"), (0x3190, "Han"), (0xA000, "Other"), (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"),
    (0xD800, "Other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"),
    (0xFE70, "Arabic"), (0xFF00, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "Other"), (0x20000, "Han"),
    (0x32000, "Other"),
)
_NAMES = sorted({name for _, name in SCRIPTS})


class _Chars:
    """Per code point: is it part of a word, and its script; made once per worker."""

    letter: np.ndarray | None = None
    script: np.ndarray

    @classmethod
    def get(cls) -> type["_Chars"]:
        if cls.letter is None:
            script = np.zeros(0x110000, np.int8)
            for first, name in SCRIPTS:
                script[first:] = _NAMES.index(name)
            cls.script = script
            cls.letter = np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), bool, 0x110000)
        return cls


def lowered(text: str) -> str:
    """Lower-cased, one code point for each."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


@dataclass
class Words:
    """The words of some texts: hashed features, extents and scripts."""

    text: np.ndarray  # which text a word is in
    start: np.ndarray  # extent in that text, in code points
    stop: np.ndarray
    script: np.ndarray
    features: np.ndarray  # buckets: one trigram per letter, words in order
    first: np.ndarray  # where a word's trigrams start
    whole: np.ndarray  # the bucket of the word itself


def words_of(texts: list[str]) -> Words:
    chars = _Chars.get()
    joined = "\n".join(lowered(t) for t in texts)
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = np.zeros(len(cp) + 2, np.int8)
    letter[1:-1] = chars.letter[cp]
    edge = np.diff(letter)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    begins = np.cumsum([0, *[len(t) + 1 for t in texts]])[:-1] if texts else np.zeros(0, np.int64)
    text = np.searchsorted(begins, start, "right") - 1
    code = np.where(letter[1:-1] == 1, cp, 0).astype(np.uint64)
    code = np.r_[np.uint64(0), code, np.uint64(0)]
    at = np.flatnonzero(letter[1:-1])
    tri = (code[at] * np.uint64(0x9E3779B185EBCA87) ^ code[at + 1] * np.uint64(0xC2B2AE3D27D4EB4F)
           ^ code[at + 2] * np.uint64(0x165667B19E3779F9))
    tri = tri * np.uint64(0xD6E8FEB86659FD93)
    first = np.r_[0, np.cumsum(stop - start)[:-1]] if len(start) else np.zeros(0, np.int64)
    whole = np.add.reduceat(tri ^ (tri >> np.uint64(29)), first) if len(first) else np.zeros(0, np.uint64)
    shift = np.uint64(64 - int(math.log2(BUCKETS)))
    whole = (whole * np.uint64(0x9E3779B97F4A7C15)) >> shift
    return Words(text, start - begins[text], stop - begins[text], chars.script[cp[start]],
                 (tri >> shift).astype(np.int64), first, whole.astype(np.int64))


@dataclass
class Model:
    """Languages, their log shares of the buckets, and the scripts they use."""

    languages: list[str]
    logs: np.ndarray  # (BUCKETS, languages)
    scripts: np.ndarray  # (scripts, languages): is a language a candidate

    def word_scores(self, words: Words) -> np.ndarray:
        """Log posterior of each language given a word, candidates alone; others far below."""
        if not len(words.first):
            return np.zeros((0, len(self.languages)), np.float32)
        out = np.empty((len(words.first), len(self.languages)), np.float32)
        ends = np.r_[words.first[1:], len(words.features)]
        a = 0
        while a < len(out):
            begin = words.first[a]
            b = max(a + 1, int(np.searchsorted(ends, begin + max(1, _GATHER // len(self.languages)), "right")))
            score = np.add.reduceat(self.logs[words.features[begin:ends[b - 1]]], words.first[a:b] - begin, axis=0)
            score += self.logs[words.whole[a:b]]
            allowed = self.scripts[words.script[a:b]]
            score = np.where(allowed, score, -np.inf)
            score -= score.max(axis=1, keepdims=True)
            out[a:b] = np.maximum(score, np.where(allowed, -MOST_EVIDENCE, -4 * MOST_EVIDENCE))
            a = b
        return out


def fit(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from (text, lang) rows with neither null; draws by (text, lang) alone.

    A language's share is taken of its different texts, so copies neither thin nor swell its sample.
    """
    spread = 1 << 30
    draw = F.pmod(F.xxhash64("text", F.lit(11)), F.lit(spread))
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(
        "text is not null and lang is not null")
    counts = {r["lang"]: r["n"] for r in
              rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} values of lang: the model would not fit its bound")
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros((len(_NAMES), 0), bool))
    share = F.lit(0)
    for name, n in counts.items():
        share = F.when(F.col("lang") == name, F.lit(int(spread * min(1.0, sample_rows / max(1, n))))).otherwise(share)
    names = {name: k for k, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(names), BUCKETS + len(_NAMES)), np.int64)
        for b in batches:
            langs = np.array([names[x] for x in b.column(1).to_pylist()], np.int64)
            for i, texts in text_slices(b.column(0), _SLICE):
                words = words_of(texts)
                letters = words.stop - words.start
                of_word = langs[i:][words.text]
                np.add.at(table, (np.repeat(of_word, letters), words.features), 1)
                np.add.at(table, (of_word, words.whole), 1)
                np.add.at(table, (of_word, BUCKETS + words.script.astype(np.int64)), letters)
        lang, bucket = np.nonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket), pa.array(table[lang, bucket])], names=["lang", "bucket", "n"])

    # Copies would make one text count often (and the sample as large as their number).
    drawn = rows.where(draw < share).dropDuplicates(["lang", "text"])
    found = (map_arrow(drawn, run, "lang long, bucket long, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    table = np.zeros((len(names), BUCKETS + len(_NAMES)))
    table[found["lang"], found["bucket"]] = found["n"]
    features, letters = table[:, :BUCKETS] + 0.1, table[:, BUCKETS:]
    logs = np.log(features / features.sum(1, keepdims=True)).T.astype(np.float32)
    uses = (letters >= SCRIPT_SHARE * letters.sum(1, keepdims=True)) & (letters > 0)
    scripts = uses.T
    scripts[~scripts.any(axis=1)] = True  # a script that no language uses narrows nothing
    return Model(languages, np.ascontiguousarray(logs), scripts)


def viterbi(scores: np.ndarray, sizes: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The best language per word for texts of ``sizes`` words whose scores follow one another."""
    path = np.zeros(len(scores), np.int64)
    sizes = np.asarray(sizes)
    order = np.argsort(-sizes, kind="stable")
    sizes, starts = sizes[order], (np.cumsum(np.r_[0, sizes])[:-1])[order]
    many = scores.shape[1]
    came = np.zeros(scores.shape, np.int16)
    best = np.zeros((len(sizes), many), np.float32)
    lanes = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), "left")  # texts longer than t
    own = np.arange(many, dtype=np.int16)
    for t, k in enumerate(lanes.tolist()):
        at = starts[:k] + t
        state = best[:k]
        top = state.argmax(axis=1)
        jump = state[np.arange(k), top][:, None] - np.float32(switch if t else 0)
        stay = state >= jump
        came[at] = np.where(stay, own, top[:, None])
        best[:k] = np.where(stay, state, jump) + scores[at]
    now = best.argmax(axis=1)
    for t in range(len(lanes) - 1, -1, -1):
        k = int(lanes[t])
        at = starts[:k] + t
        path[at] = now[:k]
        now[:k] = came[at, now[:k]]
    return path


def _chunks(text: str, many: int = 1) -> list[tuple[int, int]]:
    """Extents of at most _CHUNK code points (fewer with over _SLICE_LANGUAGES languages), cut after white space, else after a character
    that is no part of a word, else (a run of that many letters) anywhere."""
    out, a, most = [], 0, min(_CHUNK, max(1, _CHUNK * _SLICE_LANGUAGES // many))
    while len(text) - a > most:
        b = max(text.rfind(c, a, a + most) for c in " \n") + 1
        if b <= a:
            cp = np.frombuffer(text[a:a + most].encode("utf-32-le", "surrogatepass"), np.uint32)
            breaks = np.flatnonzero(~_Chars.get().letter[cp])
            b = a + (int(breaks[-1]) + 1 if len(breaks) else most)
        out.append((a, b))
        a = b
    return [*out, (a, len(text))]


def _follow(scores: np.ndarray, state: list[float], switch: float) -> Iterator[list[float]]:
    """The Viterbi state after each word of one text; its best value before a word is kept at 0."""
    for row in scores.tolist():
        top = max(state)
        state = [(s - top if s - top >= -switch else -switch) + x for s, x in zip(state, row)]
        yield state


def _label_long(model: Model, text: str, switch: float) -> tuple[str, float, list[dict]]:
    """``_label`` of one long text, chunk by chunk."""
    chunks = _chunks(text, len(model.languages))
    state: list[float] = [0.0] * len(model.languages)
    starts = []
    for a, b in chunks:
        starts.append(state)
        for state in _follow(model.word_scores(words_of([text[a:b]])), state, switch):
            pass
    letters = np.zeros(len(model.languages), np.int64)
    spans: list[dict] = []  # from the last one back
    now = state.index(max(state))
    for (a, b), state in zip(reversed(chunks), reversed(starts)):
        words = words_of([text[a:b]])
        before = [state, *_follow(model.word_scores(words), state, switch)]
        sizes = (words.stop - words.start).tolist()
        for t in range(len(sizes) - 1, -1, -1):
            letters[now] += sizes[t]
            begin, lang = a + int(words.start[t]), model.languages[now]
            if spans and spans[-1]["lang"] == lang:
                spans[-1]["start"] = begin
            else:
                spans.append({"start": begin, "stop": a + int(words.stop[t]), "lang": lang})
            top = max(before[t])
            if before[t][now] - top < -switch:
                now = before[t].index(top)
    total = int(letters.sum())
    if not total or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, []
    best = int(letters.argmax())
    return model.languages[best], float(letters[best] / total), spans[::-1]


def _label(model: Model, texts: list[str], switch: float) -> tuple[list[str], list[float], list[list[dict]]]:
    if model.languages and len(texts) == 1 and len(texts[0]) > _CHUNK:
        return tuple([x] for x in _label_long(model, texts[0], switch))
    words = words_of(texts)
    sizes = np.bincount(words.text, minlength=len(texts)) if len(words.text) else np.zeros(len(texts), np.int64)
    names, shares, spans = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
    if not model.languages or not len(words.text):
        return names, shares, spans
    path = viterbi(model.word_scores(words), sizes, switch)
    many = len(model.languages)
    letters = np.bincount(words.text * many + path, weights=words.stop - words.start, minlength=len(texts) * many).reshape(-1, many)
    top, total = letters.argmax(axis=1), letters.sum(axis=1)
    change = np.flatnonzero(np.r_[True, (np.diff(words.text) != 0) | (np.diff(path) != 0)])
    ends = np.r_[change[1:], len(path)] - 1
    for a, b in zip(change.tolist(), ends.tolist()):
        spans[words.text[a]].append({"start": int(words.start[a]), "stop": int(words.stop[b]), "lang": model.languages[path[a]]})
    for i in np.flatnonzero(total).tolist():
        if not any(map(str.isalpha, texts[i])):  # marks alone
            spans[i] = []
            continue
        names[i], shares[i] = model.languages[top[i]], float(letters[i, top[i]] / total[i])
    return names, shares, spans


def identify(docs: DataFrame, model: Model, switch: float = SWITCH, keep: Sequence[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` (of the columns ``keep``, all by default), with lang_pred, score and spans.

    ``lang_pred`` is the language with most letters along the best path, ``score``
    its share of the letters, ``spans`` array<struct<start, stop, lang>> in code points.

    - null or empty text, or no letter (marks alone are none): ``und``, score 0, no spans;
    - a model without languages: ``und`` throughout; ties go to the language first by code point;
    - a script that no training text uses: all languages are candidates;
    - repeated rows and null ids: each row on its own; very long texts: whole, in chunks of _CHUNK
      code points (only a run of more letters than that counts as several words);
    - empty table: empty result; clashing column names stay inside ``row``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages * BUCKETS * 4 bytes

    most = min(_SLICE, _SLICE * _SLICE_LANGUAGES // max(1, len(model.languages)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, shares, spans = [], [], []
            for _, texts in text_slices(b.column(1), most):
                for into, some in zip((names, shares, spans), _label(shared.value, texts, switch)):
                    into += some
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())]))
            carried = [b.column(1)] if with_text else []
            yield pa.RecordBatch.from_arrays([b.column(0), *carried, pa.array(names, pa.string()), pa.array(shares, pa.float64()),
                                              pa.array(spans, kind)], names=schema.names)

    # The text goes to the workers once, beside the other columns.
    keep = list(keep or docs.columns)
    with_text = "text" in keep
    other = [F.col(f"`{c}`") for c in keep if c != "text"] or [F.lit(None).cast("int").alias("none")]
    rows = docs.select(F.struct(*other).alias("row"), F.col("text").cast("string").alias("text"))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("lang", T.StringType())])
    schema = T.StructType([rows.schema["row"], *([rows.schema["text"]] if with_text else []),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("spans", T.ArrayType(span))])
    whole = F.struct(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in keep]).alias("row")
    return map_arrow(rows, run, schema).select(whole, "lang_pred", "score", "spans")


def held_out(doc_id: Column) -> Column:
    """The quarter of the documents that nothing is learned from (crc32 of the id as text, mod 4, is 2)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
