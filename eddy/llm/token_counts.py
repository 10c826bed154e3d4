"""Token counts of whole texts by rank-synchronous merging of numpy arrays.

A byte-pair vocabulary (a ``tokenizers`` .json file) is read into arrays.
The pre-tokens of a batch are one flat array of symbols with word offsets.
In each round every word finds its lowest-rank neighbouring pair, and all
words merge theirs at once (at each place it occurs, from the left); words
without a pair left drop out.  A word's count is its surviving symbols.

Texts repeat words, so a task keeps the counts of the words it has met
(``CACHE_WORDS`` at most) and merges only new ones; a text's count is the
sum over its words.

The file's own normaliser and splitter are used through the library.  For
the common one (composed, lower-case, split to letters, single digits and
symbols, white space dropped) a text of long-settled characters is split
here instead, white space first, which gives the same words faster.

Defined cases: a null or empty text has no tokens; strings of the file's
special tokens inside a text count one each, as the library does by
default; a text without white space is one word of any length; a null
doc_id gives a row like others; repeated rows each give a row; extra
columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eddy.llm.textarrays import slices

LIMIT = 2048
CACHE_WORDS = 300_000
BATCH_SYMBOLS = 1 << 20
SLICE_BYTES = 4 << 20         # of text counted together

# The splitter pattern of the common lower-case word vocabulary
# and its normaliser.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
# Characters whose class and case are the same in every Unicode version in use.
_SETTLED = regex.compile("[\\x00-\\x1b\\x20-԰‐-⁯぀-鿾가-힣]*")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the rest follow from U+0100 on.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Merger:
    """Counts the symbols that a vocabulary's merges leave of byte strings."""

    def __init__(self, model: dict):
        vocab = model["vocab"]
        suffix = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        key = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made[order]
        letters = {b: c for c, b in _byte_letters().items()}
        self.start = np.array([vocab.get(letters[b], -1) for b in range(256)], np.int64)
        self.last = np.array([vocab.get(letters[b] + suffix, -1) for b in range(256)], np.int64)
        # a merge never makes a pair that ranks before itself: all places at once are right
        born = {a + b: r for r, (a, b) in enumerate(pairs)}
        self.ordered = all(max(born.get(a, -1), born.get(b, -1)) < r for r, (a, b) in enumerate(pairs))

    def counts(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        a = 0
        while a < len(words):
            b, size = a, 0
            while b < len(words) and (b == a or size + len(words[b]) <= BATCH_SYMBOLS):
                size += len(words[b])
                b += 1
            out[a:b] = self._merged(words[a:b])
            a = b
        return out

    def _merged(self, words: list[bytes]) -> np.ndarray:
        lengths = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.start[raw]
        ends = np.cumsum(lengths)
        filled = lengths > 0
        symbols[ends[filled] - 1] = self.last[raw[ends[filled] - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        known = symbols >= 0
        symbols, word = symbols[known], word[known]
        out = np.zeros(len(words), np.int64)
        none = np.iinfo(np.int64).max
        while len(symbols):
            key = np.append(symbols[:-1] * self.size + symbols[1:], -1)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            inner = np.append(word[:-1] == word[1:], False)
            found = inner & (self.keys[at] == key)
            rank = np.where(found, self.ranks[at], none)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(first, len(word)))
            lowest = np.minimum.reduceat(rank, first)
            active = lowest < none
            out[word[first[~active]]] = size[~active]
            hit = found & (rank == np.repeat(lowest, size))
            place = np.flatnonzero(hit)
            # a run of overlapping places, as in a a a: every other one from the left
            run = np.append(True, np.diff(place) > 1)
            begin = place[run][np.cumsum(run) - 1] if len(place) else place
            if self.ordered:
                place = place[(place - begin) % 2 == 0]
            else:
                place = place[np.append(True, word[place[1:]] != word[place[:-1]])] if len(place) else place
            symbols[place] = self.made[at[place]]
            keep = np.repeat(active, size)
            keep[place + 1] = False
            symbols, word = symbols[keep], word[keep]
        return out


class TextCounter:
    """Token counts of texts under one tokenizer file."""

    def __init__(self, spec: str):
        spec_json = json.loads(spec)
        if spec_json["model"]["type"] != "BPE":
            raise ValueError("a BPE vocabulary is needed")
        self.library = Tokenizer.from_str(spec)
        self.merger = Merger(spec_json["model"])
        self.letters = _byte_letters()
        special = sorted((t["content"] for t in spec_json.get("added_tokens", [])), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        steps = (spec_json.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        normal = (spec_json.get("normalizer") or {}).get("normalizers")
        self.common = normal == WORD_NORMALIZER and steps[0].get("pattern") == {"Regex": WORD_PATTERN}
        self.pattern = regex.compile(WORD_PATTERN)
        self.words: dict[str, int] = {}

    def _library_words(self, text: str) -> list[bytes]:
        normal = self.library.normalizer.normalize_str(text) if self.library.normalizer else text
        pieces = self.library.pre_tokenizer.pre_tokenize_str(normal) if self.library.pre_tokenizer else [(normal, None)]
        return [bytes(self.letters[c] for c in p) for p, _ in pieces]

    def _learn(self, words: list[str]) -> None:
        """Count new white-space words."""
        pieces, of = [], []
        for i, w in enumerate(words):
            found = self.pattern.findall(w)
            pieces += [p.encode() for p in found]
            of += [i] * len(found)
        total = np.bincount(np.array(of, np.int64), weights=self.merger.counts(pieces), minlength=len(words)) if pieces else np.zeros(len(words))
        self.words.update(zip(words, total.astype(np.int64).tolist()))

    def counts(self, texts: list[str]) -> list[int]:
        out = [0] * len(texts)
        split: list[tuple[int, Counter]] = []
        rest: list[tuple[int, list[bytes]]] = []
        for i, text in enumerate(texts):
            parts = [text]
            if self.special and self.special.search(text):
                parts = self.special.split(text)
                out[i] += len(parts) - 1
            for part in parts:
                if self.common and _SETTLED.fullmatch(part):
                    if not part.isascii():
                        part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                    split.append((i, Counter(part.lower().split())))
                else:
                    rest.append((i, self._library_words(part)))
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        fresh = {w for _, c in split for w in c if w not in self.words}
        if fresh:
            self._learn(list(fresh))
        for i, c in split:
            known = self.words
            out[i] += sum(known[w] * n for w, n in c.items())
        if rest:
            flat = self.merger.counts([w for _, words in rest for w in words])
            at = 0
            for i, words in rest:
                out[i] += int(flat[at:at + len(words)].sum())
                at += len(words)
        return out


def count_tokens(docs: DataFrame, tokenizer_json: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs``.

    ``tokenizer_json``: path of the vocabulary file, read by the driver.
    """
    with open(tokenizer_json, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())      # the file's size, whatever the input

    def run(batches):
        counter = TextCounter(spec.value)
        for batch in batches:
            size = np.append(0, np.cumsum(batch.column("n_bytes").to_numpy()))
            for a, b in slices(size, SLICE_BYTES):
                part = batch.slice(a, b - a)
                counts = counter.counts([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(counts, pa.int64())],
                                                 names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text",
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint") \
        .withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
