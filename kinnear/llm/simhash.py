"""SimHash near-duplicates found through the anchors of a covering code.

A 64-bit fingerprint is cut into two halves of 32 bits: if two fingerprints
differ in at most 4 bits, one half differs in at most 2.  The anchors of a
half are the words of the perfect Hamming code on 31 bits times a free bit;
every 32-bit word lies within the covering radius 1 of an anchor.  For two
halves at distance 2 the word midway between them (1 from each) has an anchor
within 1, which is then within 2 of both.  So every half is replicated to all
anchors within covering radius + 1 (17 of 2**27 at most), and any two linked
fingerprints meet at one.  Fingerprints that meet are compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinnear.llm.components import connected_components
from kinnear.llm.tables import small_batches, stage

#: Contract values: words in a shingle, hash seed, most differing bits.
SHINGLE, SEED, MAX_BITS = 4, 42, 4


def fingerprint(text: str | None) -> int:
    """The unsigned 64-bit SimHash of a text; a text without words has 0.

    ``bytes.lower`` changes A-Z only and ``bytes.split`` splits at exactly
    \\x20 and \\x09-\\x0D, so both follow the contract's word rule.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist())), np.uint64, n
    )
    counts = np.zeros(64, np.int64)
    for i in range(0, n, 16384):
        part = hashes[i:i + 16384]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, text_key) to (doc_id, text_key, fp)."""
    for batch in batches:
        prints = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints.view(np.int64))],
                                         names=["doc_id", "text_key", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp) per row of ``docs``: a hash of the text, and the 64 bits as a signed long."""
    text = F.col("text").cast("string")
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("text_key")).mapInArrow(
        _fingerprint_batches, "doc_id long, text_key long, fp long")


def _anchor_masks() -> tuple[np.ndarray, np.ndarray]:
    """For each syndrome: the bits to flip to reach every anchor within 2, and how many there are."""
    masks, counts = np.zeros((32, 17), np.uint32), np.zeros(32, np.int64)
    free = 1 << 31
    for s in range(32):
        near = [1 << (s - 1) if s else 0]  # the nearest code word
        pairs = [(1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if s and i < (i ^ s)]
        every = near + pairs + [near[0] | free]
        masks[s, :len(every)], counts[s] = every, len(every)
    return masks, counts


_MASKS, _COUNTS = _anchor_masks()
_PARITY = [np.uint32(sum(1 << (i - 1) for i in range(1, 32) if i >> r & 1)) for r in range(5)]


def anchors(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, fingerprints): every fingerprint with every anchor key it is replicated to."""
    keys, owners = [], []
    for half in (0, 1):
        x = (prints >> np.uint64(32 * half)).astype(np.uint32)
        s = np.zeros(len(x), np.int64)
        for r, parity in enumerate(_PARITY):
            s |= (np.bitwise_count(x & parity) & 1).astype(np.int64) << r
        n = _COUNTS[s]
        mask = np.arange(17)[None, :] < n[:, None]
        keys.append((x[:, None] ^ _MASKS[s])[mask].astype(np.int64) | (half << 32))
        owners.append(np.repeat(prints, n))
    return np.concatenate(keys), np.concatenate(owners)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        for i in range(0, len(prints), 20000):
            keys, owners = anchors(prints[i:i + 20000])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(owners.view(np.int64))], names=["anchor", "fp"])


def _forest(prints: np.ndarray, max_bits: int) -> Iterator[tuple[int, int]]:
    """Edges that span the linked groups of one anchor's fingerprints.

    Each fingerprint is compared with those not yet reached only, so a tight
    group of any size costs about one pass and yields one edge a member.
    """
    rest = prints
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        waiting = [root]
        while waiting and len(rest):
            hit = np.bitwise_count(rest ^ waiting.pop()) <= max_bits
            if hit.any():
                found = rest[hit]
                rest = rest[~hit]
                waiting.extend(found)
                yield from ((int(root), int(x)) for x in found)


def _compare(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches sorted by anchor: compares the fingerprints of each anchor."""
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def edges(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(np.append(first, len(key)))
            two = first[size == 2]
            ok = np.bitwise_count(fp[two] ^ fp[two + 1]) <= max_bits
            a, b = [fp[two][ok]], [fp[two + 1][ok]]
            for i, n in zip(first[size > 2], size[size > 2]):
                found = np.array(list(_forest(fp[i:i + n], max_bits)), np.uint64).reshape(-1, 2)
                a.append(found[:, 0])
                b.append(found[:, 1])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy(zero_copy_only=False)
            fp = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if key[0] == key[-1] and held and held[-1][0][-1] == key[0]:
                held.append((key, fp))
                continue
            cut = int(np.searchsorted(key, key[-1]))
            held.append((key[:cut], fp[:cut]))
            yield edges(*(np.concatenate(x) for x in zip(*held)))
            held = [(key[cut:], fp[cut:])]
        if held:
            yield edges(*(np.concatenate(x) for x in zip(*held)))

    return run


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): edges between fingerprints at most ``max_bits`` apart that span every linked group.

    ``prints(fp)`` must be distinct.  Only the 64-bit values travel, at most
    34 times each; a distinct fingerprint is there once however many
    documents have it, which bounds what one anchor can hold.
    """
    if max_bits > MAX_BITS:
        raise ValueError("two halves with covering radius 1 + 1 find up to 4 differing bits")
    return (
        prints.mapInArrow(_replicate, "anchor long, fp long")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "fp")
        .mapInArrow(_compare(max_bits), "a long, b long")
    )


def _grouped(docs: DataFrame, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows' fingerprints, and (fp, label, component_id) of every fingerprint."""
    rows = stage(fingerprints(docs))
    first = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    labels = connected_components(links(first.select("fp"), max_bits))
    grouped = stage(first.join(labels.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")))
    smallest = grouped.groupBy("label").agg(F.min("least").alias("component_id"))
    return rows, grouped.join(smallest, "label").select("fp", "label", "component_id")


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    component_id is the smallest doc_id reachable over links, the row's own
    included.  Null and empty texts have fingerprint 0 and link like any
    other; repeated rows each get their row; a row with a null doc_id takes
    part, and a group of such rows only has a null component_id.  Columns of
    ``docs`` other than doc_id and text are not read.
    """
    rows, groups = _grouped(docs, max_bits)
    return rows.join(groups, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` (all its columns) with one row left of each linked group.

    The row with the group's smallest doc_id stays (a null id counts as the
    largest); rows that repeat the id count as one, the text with the
    smallest hash staying.
    """
    rows, groups = _grouped(docs, max_bits)
    kept = (
        rows.join(groups, "fp")
        .groupBy("label")
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("k"))
        .select("k.none", F.coalesce("k.doc_id", F.lit(0)).alias("id"), F.col("k.text_key").alias("key"))
        .toDF(*_ROW_KEY)
        .distinct()
    )
    # the join and the removal of repeated rows go by the same columns, so the texts are shuffled once
    number = F.col("doc_id").cast("long")
    keyed = docs.select("*", *[c.alias(n) for c, n in zip(
        (number.isNull(), F.coalesce(number, F.lit(0)), F.xxhash64(F.col("text").cast("string"))), _ROW_KEY)])
    return keyed.join(kept, _ROW_KEY, "left_semi").dropDuplicates(_ROW_KEY).select(docs.columns)


#: Names of the columns that tell rows apart: no id, the id, the text's hash.
_ROW_KEY = ["__no_id", "__id", "__text_key"]
