"""SentencePiece models run by the tokenizers library.

The model's protobuf is parsed and rebuilt as a ``tokenizers`` pipeline:
the normaliser (character map, extra spaces, the metaspace marker and its
dummy prefix), the pieces with their scores (a unigram model as it is; a
BPE model as merges ranked by the score of the piece they make) and byte
fallback for characters without a piece.

No piece has a marker behind another character (checked when a model is
read), so encoding never crosses the boundary in front of a run of
markers: a text is the sequence of its units, "markers and what follows".
Texts repeat units, so a task encodes each new unit once, in multithreaded
batches, and strings a text's ids together from a table of units
(``CACHE_UNITS`` at most).  Every new unit is also encoded by the
sentencepiece library; a text's ``parity`` says that all its units agree.
(A model with crossing pieces has whole texts as units.)

Decoding joins the bytes of the pieces, bytes of the fallback included,
turns markers to spaces and drops the dummy prefix.

Defined cases: a null or empty text has no ids and decodes to an empty
text; a text that holds the marker character itself decodes to a space
there, as in the sentencepiece library; a null doc_id and repeated rows
each give a row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

from eddy.llm.textarrays import slices, tidy_batches, utf8

MARK = "▁"
THREADS = 2
CACHE_UNITS = 300_000
RUN_UNITS = 512
SLICE_BYTES = 1 << 20
# Fixed values of the model format: kinds of models and of pieces.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5


class Codec:
    """A SentencePiece model, rebuilt."""

    def __init__(self, model: bytes, threads: int = THREADS):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        self.pieces = [(p.piece, p.score, p.type) for p in proto.pieces]
        self.spec = proto.normalizer_spec
        if not self.spec.escape_whitespaces or any(t == USER_DEFINED for _, _, t in self.pieces):
            raise ValueError("models with user-defined pieces or unescaped spaces are not supported")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("models with the marker behind words are not supported")
        self.normalizer = self._normalizer()
        self.tokenizer = Tokenizer(self._model(proto))
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        crossing = any(MARK in p.lstrip(MARK) for p, _, t in self.pieces if t == NORMAL)
        # the dummy prefix goes to the first unit, which must be a unit of its own kind
        self.units = re.compile(".+" if crossing else f"{MARK}+[^{MARK}]*|[^{MARK}]+", re.S)
        self.by_units = not crossing
        raw = [bytes([int(p[1:-1], 16)]) if t == BYTE else b"" if t == CONTROL else p.replace(MARK, " ").encode()
               for p, _, t in self.pieces]
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.piece_off = np.append(0, np.cumsum([len(x) for x in raw]))
        self.starts = np.array([p.startswith(MARK) for p, _, _ in self.pieces])
        self.marks = np.array([p.strip(MARK) == "" for p, _, _ in self.pieces])
        if self.by_units:
            self.tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
        self._forget()

    def _normalizer(self):
        steps = []
        if self.spec.precompiled_charsmap:
            steps.append(normalizers.Precompiled(self.spec.precompiled_charsmap))
        if self.spec.remove_extra_whitespaces:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
        return normalizers.Sequence(steps) if steps else None

    def _model(self, proto):
        unknown = next((i for i, (_, _, t) in enumerate(self.pieces) if t == UNKNOWN), 0)
        fallback = proto.trainer_spec.byte_fallback
        if proto.trainer_spec.model_type == UNIGRAM:
            return models.Unigram([(p, s) for p, s, _ in self.pieces], unk_id=unknown, byte_fallback=fallback)
        if proto.trainer_spec.model_type != BPE:
            raise ValueError("the model is neither unigram nor BPE")
        normal = {p for p, _, t in self.pieces if t == NORMAL}
        merges = sorted((-score, i, p[:k], p[k:]) for i, (p, score, t) in enumerate(self.pieces) if t == NORMAL
                        for k in range(1, len(p)) if p[:k] in normal and p[k:] in normal)
        return models.BPE({p: i for i, (p, _, _) in enumerate(self.pieces)}, [(a, b) for _, _, a, b in merges],
                          unk_token=self.pieces[unknown][0], fuse_unk=True, byte_fallback=fallback)

    def normal(self, text: str) -> str:
        """The text as the model sees it: normalised, with markers."""
        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        if not text:
            return ""
        return (MARK if self.spec.add_dummy_prefix else "") + text.replace(" ", MARK)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.empty(0, np.int32)
        self.off = np.zeros(1, np.int64)
        self.same = np.empty(0, bool)

    def _learn(self, units: list[str]) -> None:
        """Encode new units, many in a row, and compare with the library."""
        rows, same = [], []
        if self.by_units:
            # a run of units is cut again at its units' first ids; markers alone at an end would join the next unit
            plain = [u for u in units if u[0] == MARK and u[-1] != MARK]
            units = plain + [u for u in units if u[0] != MARK or u[-1] == MARK]
            runs = [plain[k:k + RUN_UNITS] for k in range(0, len(plain), RUN_UNITS)]
            ours = [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(["".join(r) for r in runs], add_special_tokens=False)]
            theirs = self._library(["".join(r) for r in runs])
            for run, ids, other in zip(runs, ours, theirs):
                starts = self.starts[ids]
                starts[1:] &= ~self.marks[ids[:-1]]
                cut = np.append(np.flatnonzero(starts), len(ids))
                if len(cut) == len(run) + 1 and ids.tolist() == other:
                    rows.append((ids, np.diff(cut)))
                    same += [True] * len(run)
                else:
                    self._one_by_one(run, rows, same)
            units_left = units[len(plain):]
        else:
            units_left = units
        self._one_by_one(units_left, rows, same)
        self.known.update(zip(units, range(len(self.known), len(self.known) + len(units))))
        self.flat = np.concatenate([self.flat, *(ids for ids, _ in rows)])
        self.off = np.append(self.off, self.off[-1] + np.cumsum(np.concatenate([n for _, n in rows])))
        self.same = np.append(self.same, same)

    def _one_by_one(self, units: list[str], rows: list, same: list) -> None:
        for unit, other in zip(units, self._library(units)):
            ids = self.tokenizer.encode(unit, add_special_tokens=False).ids
            rows.append((np.array(ids, np.int32), np.array([len(ids)])))
            # a marker alone is an empty text to the library
            same.append(ids == other or (unit == MARK and ids == [self.library.piece_to_id(MARK)]))

    def _library(self, units: list[str]) -> list[list[int]]:
        """The sentencepiece library's ids; it adds the marker in front itself."""
        lead = self.spec.add_dummy_prefix
        return self.library.encode([(u[1:] if lead and u[0] == MARK else u).replace(MARK, " ") for u in units], num_threads=1)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, offsets, whether the sentencepiece library agrees)."""
        if len(self.known) > CACHE_UNITS:
            self._forget()
        split = [self.units.findall(self.normal(t)) for t in texts]
        flat = list(chain.from_iterable(split))
        fresh = set(flat).difference(self.known)
        if fresh:
            self._learn(list(fresh))
        which = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        first = np.append(0, np.cumsum([len(u) for u in split]))
        length = self.off[which + 1] - self.off[which]
        before = np.append(0, np.cumsum(length))
        ids = self.flat[np.repeat(self.off[which] - before[:-1], length) + np.arange(before[-1])]
        wrong = np.append(0, np.cumsum(~self.same[which]))
        return ids, before[first], wrong[first[1:]] == wrong[first[:-1]]

    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[str]:
        """The texts of runs of ids."""
        if not len(ids):
            return [""] * (len(off) - 1)
        length = self.piece_off[ids + 1] - self.piece_off[ids]
        before = np.append(0, np.cumsum(length))
        flat = self.piece_bytes[np.repeat(self.piece_off[ids] - before[:-1], length) + np.arange(before[-1])].tobytes()
        cut = before[off].tolist()
        lead = 1 if self.spec.add_dummy_prefix else 0
        texts = [flat[a:b].decode("utf-8", "replace") for a, b in zip(cut, cut[1:])]
        return [t[lead:] if t.startswith(" ") else t for t in texts]


def _codec(docs: DataFrame, model_file: str):
    with open(model_file, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())     # the file's size, whatever the input


def _ids_column(ids: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int32()))


def encode(docs: DataFrame, model_file: str, threads: int = THREADS) -> DataFrame:
    """(doc_id, ids, n_tokens, parity) for each row of ``docs``.

    ``model_file`` is read by the driver.
    """
    model = _codec(docs, model_file)

    def run(batches):
        codec = Codec(model.value, threads)
        for batch in batches:
            _, size = utf8(batch.column("text"))
            for a, b in slices(size, SLICE_BYTES):
                part = batch.slice(a, b - a)
                ids, off, same = codec.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _ids_column(ids, off), pa.array(np.diff(off)), pa.array(same)],
                                                 names=["doc_id", "ids", "n_tokens", "parity"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text") \
        .mapInArrow(tidy_batches(run), "doc_id bigint, ids array<int>, n_tokens bigint, parity boolean")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, text) for each row of ``encoded`` (doc_id, ids)."""
    model = _codec(encoded, model_file)

    def run(batches):
        codec = Codec(model.value)
        for batch in batches:
            column = batch.column("ids")
            ids, off = _ids_of(column)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(codec.decode(ids, off), pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def _ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(x) if x is not None else 0 for x in column.to_numpy(zero_copy_only=False)], np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.append(0, np.cumsum(length))


def encode_and_check(docs: DataFrame, model_file: str, threads: int = THREADS) -> DataFrame:
    """(doc_id, ids, n_tokens, n_byte_tokens, parity, decoded_sha256, round_trip).

    Encodes every text, decodes the ids again and compares, in one pass.
    """
    model = _codec(docs, model_file)
    names = ["doc_id", "ids", "n_tokens", "n_byte_tokens", "parity", "decoded_sha256", "round_trip"]

    def run(batches):
        codec = Codec(model.value, threads)
        is_byte = np.array([t == BYTE for _, _, t in codec.pieces])
        for batch in batches:
            _, size = utf8(batch.column("text"))
            for a, b in slices(size, SLICE_BYTES):
                part = batch.slice(a, b - a)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids, off, same = codec.encode(texts)
                back = codec.decode(ids, off)
                fallback = np.append(0, np.cumsum(is_byte[ids]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), _ids_column(ids, off), pa.array(np.diff(off)), pa.array(np.diff(fallback[off])), pa.array(same),
                     pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]), pa.array([t == u for t, u in zip(back, texts)])], names=names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        tidy_batches(run), "doc_id bigint, ids array<int>, n_tokens bigint, n_byte_tokens bigint, parity boolean, decoded_sha256 string, round_trip boolean")
