"""Token ids and token counts of whole texts, batch-encoded inside Arrow functions.

Texts are split at safe boundaries, encoded in batches balanced by bytes, and
only what is asked for (lengths, or ids of pieces) leaves the task. What is
safe depends on the vocabulary:

- a ``tokenizers`` vocabulary whose pattern splits a lower-cased text into
  pre-tokens without white space (the word vocabulary) may be cut between
  pre-tokens: no merge crosses one. Each distinct pre-token is encoded once
  while it stays in the worker's memo, whose size is bounded. This package
  finds pre-tokens itself only in text of plain characters (ASCII and the
  letters of Latin-1, where normal form and lower case are beyond doubt);
  any other stretch between two spaces goes to the library as it is, since no
  normal form, merge or special string of such a vocabulary crosses a space;
- any other ``tokenizers`` vocabulary may merge a space with what follows, and
  SentencePiece treats the start of a text apart; their texts are encoded
  whole.

``splits_words`` decides this from the vocabulary's own description.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiocube.llm.common import map_arrow, text_slices

#: Bytes of text that one call of the tokenizer gets (one longer text gets a call of its own).
CALL_BYTES = 1 << 20
#: Bytes of text that are split into pre-tokens at once.
SLICE_BYTES = 4 << 20
#: Entries of each of the memo's two generations, and the longest key kept.
MEMO_ENTRIES = 150_000
MEMO_CHARS = 48

# The pattern of the word vocabulary, and the same over plain characters.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile("[\t\n\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
_PRE_TOKENS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^\\sa-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


def splits_words(spec: dict) -> bool:
    """True if this ``tokenizers`` vocabulary splits texts by ``_WORD_PATTERN`` and marks word ends."""
    pre = spec.get("pre_tokenizer") or {}
    first = (pre.get("pretokenizers") or [pre])[0]
    dropped = (first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
               and first.get("pattern", {}).get("Regex") == _WORD_PATTERN)
    special = any(" " in t["content"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", []))
    kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    return bool(dropped and not special and kinds == ["NFC", "Replace", "Lowercase"]
                and spec["model"].get("end_of_word_suffix"))


def by_bytes(texts: Sequence[str], most: int = CALL_BYTES) -> Iterator[list[int]]:
    """Positions of ``texts``, longest first, in batches of at most ``most`` bytes of like lengths."""
    sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
    batch, held = [], 0
    for i in sorted(range(len(texts)), key=lambda i: -sizes[i]):
        if batch and held + sizes[i] > most:
            yield batch
            batch, held = [], 0
        batch.append(i)
        held += sizes[i]
    if batch:
        yield batch


class Encoder:
    """One vocabulary in one worker: ``ids`` and ``counts`` of lists of texts."""

    _loaded: dict[str, "Encoder"] = {}

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str) -> None:
        self.split = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode: Callable = lambda texts: model.encode(texts, num_threads=1)
        else:
            import os

            import tokenizers

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's core is its share
            model = tokenizers.Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            with open(path) as f:
                spec = json.load(f)
            self.split = splits_words(spec)
            self._special = [t["content"] for t in spec.get("added_tokens", [])]
            if self.split:
                suffix = spec["model"]["end_of_word_suffix"]
                self._ends = np.zeros(model.get_vocab_size(), bool)
                for token, i in model.get_vocab().items():
                    self._ends[i] = token.endswith(suffix)
            self._encode = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def _fresh(self, texts: Sequence[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, by calls balanced by bytes."""
        out: list[bytes] = [b""] * len(texts)
        for batch in by_bytes(texts):
            for i, ids in zip(batch, self._encode([texts[i] for i in batch])):
                out[i] = np.array(ids, "<u4").tobytes()
        return out

    def _fresh_words(self, words: list[str]) -> list[bytes]:
        """The ids of single pre-tokens: encoded many to a text, told apart by the word ends."""
        out: list[bytes] = []
        for k in range(0, len(words), 20_000):
            part = words[k:k + 20_000]
            ids = np.array([i for ids in self._encode([" ".join(part[j:j + 1000]) for j in range(0, len(part), 1000)])
                            for i in ids], "<u4")
            stops = 4 * (np.flatnonzero(self._ends[ids]) + 1)
            if len(stops) != len(part):
                raise ValueError("pre-tokens and word ends disagree")
            flat = ids.tobytes()
            out += [flat[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist())]
        return out

    def _pieces(self, text: str, other: set[str]) -> list[str]:
        """Memo keys whose ids follow one another; stretches for the library go to ``other`` too."""
        if _PLAIN.fullmatch(text) and not any(s in text for s in self._special):
            return _PRE_TOKENS.findall(text.lower())
        out: list[str] = []
        for stretch in text.split(" "):
            if _PLAIN.fullmatch(stretch) and not any(s in stretch for s in self._special):
                out += _PRE_TOKENS.findall(stretch.lower())
            else:
                out.append(stretch)
                other.add(stretch)
        return out

    def ids(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each whole text as little-endian unsigned 32-bit values."""
        if not self.split:
            return self._fresh(texts)
        other: set[str] = set()
        pieces = [self._pieces(t, other) for t in texts]
        if len(self._young) > MEMO_ENTRIES:
            self._old, self._young = self._young, {}
        memo = self._young
        missing = set().union(*pieces).difference(memo)
        known = missing.intersection(self._old)
        memo.update((w, self._old[w]) for w in known)
        missing -= known
        foreign = list(missing & other)
        memo.update(zip(foreign, self._fresh(foreign)))
        words = list(missing.difference(other))
        memo.update(zip(words, self._fresh_words(words)))
        out = [b"".join(map(memo.__getitem__, p)) for p in pieces]
        for w in foreign:  # stretches for the library, and long words, do not stay
            del memo[w]
        for w in words:
            if len(w) > MEMO_CHARS:
                del memo[w]
        return out

    def counts(self, texts: Sequence[str]) -> list[int]:
        return [len(x) // 4 for x in self.ids(texts)]


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, n_tokens) of every row's whole text.

    - null or empty text: 0 bytes, 0 tokens; very long texts are counted whole;
    - special strings inside texts count as the library takes them by default;
    - repeated rows and null ids: one row each; empty table: empty result;
    - other columns of ``docs``, whatever their names, are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(vocabulary)
        for b in batches:
            counts: list[int] = []
            for _, texts in text_slices(b.column(2), SLICE_BYTES):
                counts += encoder.counts(texts)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counts, pa.int64())],
                                             names=[id_col, "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).cast("long").alias(id_col), F.octet_length(text).cast("long").alias("n_bytes"),
                      text.alias(text_col))
    return map_arrow(own, run, f"`{id_col}` long, n_bytes long, n_tokens long")
