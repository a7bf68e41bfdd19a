"""Token ids of documents in shard files, one wavelet matrix a shard.

A token folder is a Parquet table with one row a shard: whole documents in
ascending doc_id order, their ids as a serialised wavelet matrix (column
``matrix``), and where each document ends.  Shards count their place within
the writing partition; partitions follow one another in doc_id order, so a
running sum of the partitions' totals (one row each) gives global places.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pandas as pd
import pyarrow as pa
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinnear.llm.tables import small_batches
from kinnear.llm.wavelet import WaveletMatrix
from kinnear.llm.words import LOWER, NOT_SPACE, buffer_of, chunks, span_hashes, spans, text_column

#: A shard is closed by the document that brings it to this many ids.
SHARD_TOKENS = 1 << 20
#: The id appended to every document.
END_ID = 2
#: Bytes of distinct pieces and their ids that a Python worker remembers before it starts anew (about a million pieces).
MEMORY_BYTES = 32 << 20
#: Text bytes encoded at a time; one longer document is encoded alone.
TEXT_BYTES = 1 << 19
#: Trailing marks of a word looked at one by one.
MARKS = 64

_SHARD = "part long, shard long, start long, n_tokens long, doc_ids array<long>, doc_ends array<long>, matrix binary"
#: ASCII marks that never join the letter or digit before them to a token.
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{|}~")] = True
_SORTS = np.where(np.arange(256) >= 128, 1, 0).astype(np.int64)
_SORTS[60] = 1 << 32
_PLAIN = np.zeros(256, bool)
_PLAIN[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True


class Pieces:
    """The ids of known pieces: sorted hashes beside their numbers, and one growing buffer of ids."""

    def __init__(self):
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.ids, self.n_ids = np.zeros(1 << 12, np.uint32), 0
        self.ends, self.count = np.zeros(1 << 12, np.int64), 0  # piece i has the ids from ends[i] to ends[i + 1]

    @property
    def nbytes(self) -> int:
        return self.hashes.nbytes + self.numbers.nbytes + 4 * self.n_ids + 8 * self.count

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The pieces' numbers, -1 for new ones."""
        if not len(self.hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.numbers[at], -1).astype(np.int64)

    def add(self, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Takes in new pieces with their ids, one after another; their numbers."""
        numbers = np.arange(self.count, self.count + len(hashes))
        self.ids = _room(self.ids, self.n_ids + len(ids))
        self.ids[self.n_ids:self.n_ids + len(ids)] = ids
        self.ends = _room(self.ends, self.count + len(hashes) + 1)
        self.ends[self.count + 1:self.count + 1 + len(hashes)] = self.n_ids + np.cumsum(lengths)
        self.n_ids, self.count = self.n_ids + len(ids), self.count + len(hashes)
        order = np.argsort(hashes)
        place = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, place, hashes[order])
        self.numbers = np.insert(self.numbers, place, numbers[order])
        return numbers


def _room(buffer: np.ndarray, n: int) -> np.ndarray:
    """The buffer, or one half as large again with the same beginning."""
    if n <= len(buffer):
        return buffer
    grown = np.zeros(max(n, len(buffer) * 3 // 2), buffer.dtype)
    grown[:len(buffer)] = buffer
    return grown


class Encoder:
    """Ids of whole texts, from the ids of their distinct pieces.

    The tokenizer drops white space and no token spans it, so a text's ids are
    the ids of its blank-separated words in turn.  A word whose trailing ASCII
    marks follow an ASCII letter or digit is two pieces: a pre-token ends
    there.  Case does not matter in pieces of ASCII only (the tokenizer
    lower-cases).  Words with ``<`` stay whole and as they are, for the sake
    of special tokens.  Pieces are told apart by 64-bit hashes; each distinct
    one is encoded once.
    """

    @classmethod
    def shared(cls, path: str) -> Encoder:
        """The Python worker's encoder: tasks that follow each other in a worker share what it has learnt."""
        kept = vars(tokenizers).setdefault("__shared_encoders__", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def __init__(self, path: str):
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.own = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        # words of lower-case letters in composed form need neither its normaliser nor its pattern
        self.bare = tokenizers.normalizers.Sequence([]), tokenizers.pre_tokenizers.Sequence([
            tokenizers.pre_tokenizers.WhitespaceSplit(), tokenizers.pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a pre-token
        self.last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.pieces = Pieces()

    def _ids(self, parts: tuple, texts: list[str]) -> list[list[int]]:
        """The ids of each text under the tokenizer's own or the bare parts; its model is held once."""
        self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = parts
        return [found.ids for found in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each) of plain words: encoded as one text, cut at word ends."""
        ids = np.array(self._ids(self.bare, [" ".join(texts)])[0], np.uint32)
        cuts = np.flatnonzero(self.last[ids]) + 1
        if len(cuts) == len(texts) and cuts[-1] == len(ids):
            return ids, np.diff(cuts, prepend=0)
        return self._encode_each(texts)

    def _encode_each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._ids(self.own, texts)
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def _learn(self, hashes: np.ndarray, pieces: list[bytes]) -> np.ndarray:
        """Encodes new pieces; their numbers."""
        texts = [p.decode("utf-8", "replace") for p in pieces]
        plain = [t.isalpha() and t.lower() == t and is_normalized("NFC", t) for t in texts]
        words, others = ([i for i, p in enumerate(plain) if p == kind] for kind in (True, False))
        parts = [(words[i:i + 2000], self._encode_words) for i in range(0, len(words), 2000)]
        parts += [(others[i:i + 2000], self._encode_each) for i in range(0, len(others), 2000)]
        order = np.array([i for which, _ in parts for i in which], np.int64)
        found = [encode([texts[i] for i in which]) for which, encode in parts]
        numbers = np.zeros(len(pieces), np.int64)
        numbers[order] = self.pieces.add(hashes[order], np.concatenate([ids for ids, _ in found]), np.concatenate([n for _, n in found]))
        return numbers

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ends): the ids of all texts, each text's closed by ``end_id``, and where each ends."""
        data, offsets = buffer_of(texts)
        starts, ends, first = spans(data, offsets, NOT_SPACE)
        # non-ASCII bytes in the low half, "<" in the high half of one running sum
        seen = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_SORTS[data], out=seen[1:])
        inside = seen[ends] - seen[starts]
        keep = inside > 0
        # bytes of words that keep their case
        change = np.zeros(len(data) + 1, np.int8)
        change[starts[keep]] += 1
        change[ends[keep]] -= 1
        text = np.where(np.cumsum(change[:-1], dtype=np.int8) > 0, data, LOWER[data])
        # where each word's trailing marks begin; a word with more than MARKS of them stays whole
        stem = ends.copy()
        open_ones = np.flatnonzero(_MARKS[data[ends - 1]] & (inside < 1 << 32)) if len(ends) else ends
        for _ in range(MARKS):
            stem[open_ones] -= 1
            open_ones = open_ones[stem[open_ones] > starts[open_ones]]
            open_ones = open_ones[_MARKS[data[stem[open_ones] - 1]]]
        cut = (stem > starts) & (stem < ends)
        cut[cut] = _PLAIN[data[stem[cut] - 1]]
        piece = np.zeros(len(starts) + 1, np.int64)  # pieces before each word
        np.cumsum(1 + cut, out=piece[1:])
        begin, end = np.zeros(piece[-1], np.int64), np.zeros(piece[-1], np.int64)
        begin[piece[:-1]], end[piece[:-1]] = starts, np.where(cut, stem, ends)
        begin[piece[1:][cut] - 1], end[piece[1:][cut] - 1] = stem[cut], ends[cut]
        which, distinct = pd.factorize(span_hashes(text, begin, end))
        sample = np.zeros(len(distinct), np.int64)
        sample[which[::-1]] = np.arange(len(which))[::-1]
        if self.pieces.nbytes > MEMORY_BYTES:
            self.pieces = Pieces()
        number = self.pieces.find(distinct)
        new = np.flatnonzero(number < 0)
        if len(new):
            raw, at = text.tobytes(), sample[new]
            number[new] = self._learn(distinct[new], [raw[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist())])
        number = number[which]
        known = self.pieces.ends
        n_ids = known[number + 1] - known[number]
        before = np.concatenate([[0], np.cumsum(n_ids)])
        ids_before = before[piece[first]]  # ids before each document, without ends
        out = np.full(int(before[-1]) + len(texts), end_id, np.uint32)
        doc = np.repeat(np.arange(len(texts)), np.diff(piece[first]))
        step = np.arange(int(before[-1])) - np.repeat(before[:-1], n_ids)
        out[np.repeat(before[:-1] + doc, n_ids) + step] = self.pieces.ids[np.repeat(known[number], n_ids) + step]
        return out, ids_before[1:] + np.arange(1, len(texts) + 1)


def _shards(path: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder, shard, start = None, 0, 0
        ids: list[np.ndarray] = []
        docs: list[int | None] = []
        ends: list[int] = []

        def close() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.concatenate(ids))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([shard], pa.int64()), pa.array([start], pa.int64()),
                 pa.array([matrix.length], pa.int64()), pa.array([docs], pa.list_(pa.int64())),
                 pa.array([ends], pa.list_(pa.int64())), pa.array([matrix.to_bytes()], pa.binary())],
                names=["part", "shard", "start", "n_tokens", "doc_ids", "doc_ends", "matrix"])

        for batch in batches:
            for piece in chunks(batch, "text", TEXT_BYTES):
                encoder = encoder or Encoder.shared(path)
                found, stops = encoder.encode(text_column(piece, "text"), end_id)
                begin = 0
                for doc_id, stop in zip(piece.column(0).to_pylist(), stops.tolist()):
                    ids.append(found[begin:stop])
                    docs.append(doc_id)
                    ends.append((ends[-1] if ends else 0) + stop - begin)
                    begin = stop
                    if ends[-1] >= shard_tokens:
                        yield close()
                        shard, start = shard + 1, start + ends[-1]
                        ids, docs, ends = [], [], []
        if docs:
            yield close()

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID,
                      shard_tokens: int = SHARD_TOKENS) -> None:
    """Writes the ids of every row of ``docs`` to ``folder`` in ascending doc_id order.

    Null and empty texts are the end id alone; rows with a null doc_id come
    first; rows that repeat an id follow each other in the order of their
    texts' hashes.  No rows: an empty folder.  Other columns are not read.
    """
    text = F.col("text").cast("string")
    (
        small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .mapInArrow(_shards(tokenizer, end_id, shard_tokens), _SHARD)
        .write.parquet(folder)
    )


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The shards with ``start``: the number of ids in all shards before."""
    shards = spark.read.schema(_SHARD).parquet(folder)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select(
        F.col("part"),
        F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    # one row a written partition: broadcast, so that the matrices stay where they are
    return shards.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("start")).drop("before")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            start, doc_ids, ends, matrix = (batch.column(k)[i].as_py() for k in range(4))
            ids = WaveletMatrix.from_bytes(matrix).decode().astype("<u4")
            begins = [0, *ends[:-1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array([start + b for b in begins], pa.int64()),
                 pa.array([e - b for b, e in zip(begins, ends)], pa.int64()),
                 pa.array([zlib.crc32(ids[b:e].tobytes()) for b, e in zip(begins, ends)], pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def document_index(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    return read_shards(spark, folder).select("start", "doc_ids", "doc_ends", "matrix").mapInArrow(
        _documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_occurrences(spark: SparkSession, folder: str, token: int) -> DataFrame:
    """(place): every global place of a token id, by select on each shard; no text is decoded.

    An id that occurs nowhere, or no tokenizer has, and an empty folder give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column(1)[i].as_py())
                places = np.array(matrix.occurrences(token), np.int64) + batch.column(0)[i].as_py()
                yield pa.RecordBatch.from_arrays([pa.array(places)], names=["place"])

    return read_shards(spark, folder).select("start", "matrix").mapInArrow(run, "place long")
