"""Near-duplicate passages through compact windows of min-hashed sequences.

Tokens are shingles of five words.  For each of HASHES hash functions a
Cartesian tree over a document's hashed shingles gives its compact windows:
the maximal ranges in which one place holds the smallest hash.  All
subsequences of at least PASSAGE shingles have their min-hash at one of these
places (about two in PASSAGE shingles), so texts that share a passage share
places.  A place is keyed by the shingles before it and by those after it:
of a shared passage one side is long enough to be the same in both texts.
Texts that meet under a key are aligned there, and the aligned passages are
compared shingle by shingle; a stretch of at least PASSAGE shingles with a
Jaccard similarity of SIMILARITY links the texts.

Under a key every text is compared with the first one only.  Where it differs
from that one, and others were compared with that one too, its windows of
PASSAGE shingles around the place become keys themselves, under which the
texts that hold the same window meet: two texts that share a window word for
word are either both similar to the first one there, or meet under the window.
Texts that met under a key and are in different classes after that are compared
with each other, all pairs: no class is left in parts that a pair would join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinnear.llm.components import connected_components
from kinnear.llm.tables import small_batches, stage
from kinnear.llm.words import LOWER, NOT_SPACE, buffer_of, chunks, gram_hashes, mix, span_hashes, spans, text_column

#: Words in a shingle; shingles in a passage (50 words); smallest similarity.
SHINGLE, PASSAGE, SIMILARITY = 5, 46, 0.8
#: Hash functions; shingles on one side of a place that make a key, and a finer key.
HASHES, SIDE, FINE = 3, 12, 20
#: Shingles compared on each side of a place.
REACH = 2 * PASSAGE
#: Requests for parts of one text that travel together; bytes of parts given out at a time.
REQUESTS_A_ROW, EXTRACT_BYTES = 100, 4 << 20

#: Copies of texts that are broadcast at most (two longs each); more are joined by shuffle.
BROADCAST_ROWS = 2_000_000

_SEEDS = np.random.default_rng(3).integers(1, 1 << 63, 8, dtype=np.uint64)


def compact_places(values: np.ndarray, first: np.ndarray, least: int) -> np.ndarray:
    """Places of the smallest value of every compact window at least ``least`` wide.

    The Cartesian trees of all documents (``values[first[i]:first[i + 1]]``)
    grow level by level; of equal values the middle one is taken, which keeps
    the trees of repetitive texts shallow.
    """
    low, high = first[:-1], first[1:]
    found = []
    while True:
        wide = high - low >= least
        low, high = low[wide], high[wide]
        if not len(low):
            return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        size = high - low
        at = np.concatenate([[0], np.cumsum(size)])
        index = np.repeat(low - at[:-1], size) + np.arange(at[-1])
        part = values[index]
        smallest = np.minimum.reduceat(part, at[:-1])
        equal = np.flatnonzero(part == np.repeat(smallest, size))
        begin = np.searchsorted(equal, at)
        centre = index[equal[(begin[:-1] + begin[1:]) // 2]]
        found.append(centre)
        low, high = np.stack([low, centre + 1], 1).ravel(), np.stack([centre, high], 1).ravel()


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, first, words): the shingles of all texts and each text's number of words."""
    data, offsets = buffer_of(texts)
    starts, ends, first = spans(data, offsets, NOT_SPACE)
    words = span_hashes(LOWER[data], starts, ends)
    hashes, first_shingle = gram_hashes(words, first, SHINGLE)
    return hashes, first_shingle, np.diff(first)


def _side_keys(hashes: np.ndarray, place: np.ndarray, step: int, size: int) -> np.ndarray:
    key = np.full(len(place), np.uint64(size), np.uint64)
    for i in range(size):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + hashes[place + step * i])
    return key


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, fine, node, place) of every place and side that lies within its document."""
    for batch in batches:
        for part in chunks(batch, "text"):
            hashes, first, _ = shingles(text_column(part, "text"))
            places = [compact_places(mix(hashes ^ seed), first, PASSAGE) for seed in _SEEDS[:HASHES]]
            place = np.unique(np.concatenate(places))
            doc = np.searchsorted(first, place, "right") - 1
            node = part.column(1).to_numpy(zero_copy_only=False)[doc]
            left, right = place - first[doc], first[doc + 1] - 1 - place
            columns: list[list[np.ndarray]] = [[], [], [], []]
            for step, room in ((1, right), (-1, left)):
                ok = room >= SIDE - 1
                at = place[ok]
                fine = np.zeros(len(at), np.uint64)
                far = room[ok] >= FINE - 1
                fine[far] = _side_keys(hashes, at[far], step, FINE)
                for column, values in zip(columns, (
                        (_side_keys(hashes, at, step, SIDE) ^ np.uint64(step == 1)).view(np.int64),
                        (fine >> np.uint64(33)).astype(np.int32), node[ok], left[ok].astype(np.int32))):
                    column.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=["key", "fine", "node", "place"])


def _meet(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, fine, node, place) to aligned pairs (a, at, b, bt, centre): linear in the rows, whatever a key holds.

    Every text is paired with its key's first text, and with the first text of
    its finer key where that is another one; that text is a if ``centre`` is 1, b if it is 2.
    All places of a text face the first place of the first text.  If equal keys
    are equal passages (``whole``), any place of the first text will do: the
    n-th faces the n-th and then the first one again, so that texts that repeat
    a line are aligned once for all of it, not once for each place.
    """
    kept = None  # the places of the first texts and of the last text, which the next rows may go on with
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
        old = 0 if kept is None else len(kept[0])
        key, fine, node, place = columns if kept is None else map(np.concatenate, zip(kept, columns))
        n = len(key)
        index = np.arange(n)
        new_key = np.ones(n, bool)
        new_key[1:] = key[1:] != key[:-1]
        new_fine = new_key.copy()
        new_fine[1:] |= fine[1:] != fine[:-1]
        new_text = new_fine.copy()
        new_text[1:] |= node[1:] != node[:-1]
        begin = np.flatnonzero(new_text)
        size = np.diff(begin, append=n)
        text = np.cumsum(new_text) - 1
        nth = index - begin[text]
        sides, keep = [], [np.arange(begin[-1], n)]
        for fresh in (new_key, new_fine):
            first = np.maximum.accumulate(np.where(fresh, index, 0))
            places = size[text[first]] if whole else np.ones(n, np.int64)
            sides.append((node[first], place[first + nth % places]))
            keep.append(np.arange(first[-1], first[-1] + places[-1]))
        (a, at), (b, bt) = sides
        fresh = index >= old
        out = [np.concatenate(x) for x in zip(*(
            (other[ok], spot[ok], node[ok], place[ok]) for other, spot, ok in (
                (a, at, fresh & (a != node)), (b, bt, fresh & (b != node) & (b != a) & (fine != 0)))))]
        keep = np.unique(np.concatenate(keep))
        kept = [x[keep] for x in (key, fine, node, place)]
        swap = out[0] > out[2]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
            np.where(swap, out[2], out[0]), np.where(swap, out[3], out[1]).astype(np.int32),
            np.where(swap, out[0], out[2]), np.where(swap, out[1], out[3]).astype(np.int32), np.where(swap, 2, 1).astype(np.int32))],
            names=["a", "at", "b", "bt", "centre"])


def _pairs(keys: DataFrame, whole: bool = False) -> DataFrame:
    """(a, b, shift, low, high, centre): texts that meet, how they lie against each other, the first and last place where, and whose key it is (bits)."""
    met = keys.repartition("key").sortWithinPartitions("key", "fine", "node", "place").mapInArrow(
        lambda batches: _meet(batches, whole), "a long, at int, b long, bt int, centre int")
    return met.groupBy("a", "b", (F.col("bt") - F.col("at")).alias("shift")).agg(
        F.min("at").alias("low"), F.max("at").alias("high"), F.bit_or("centre").alias("centre"))


def candidate_pairs(texts: DataFrame) -> DataFrame:
    """The pairs that meet under the sides of a place."""
    return _pairs(small_batches(texts).select("text", "node").mapInArrow(_keys, "key long, fine int, node long, place int"))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, requests) to (request, side, begin, part): the shingles of each requested range and around it."""
    rows: list[tuple] = []

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int32(), pa.binary()))], names=["request", "side", "begin", "part"])
        rows.clear()
        return batch

    for batch in batches:
        size = 0
        for text, wanted in zip(batch.column(0), batch.column(1)):
            # half a hash tells shingles apart well enough here: forty of them decide, not one
            hashes = (shingles(pa.array([text.as_py()], pa.large_string()))[0] >> np.uint64(32)).astype(np.uint32)
            for r in wanted.as_py():
                begin = max(0, r["low"] - REACH)
                rows.append((r["request"], r["side"], begin, hashes[begin:r["high"] + REACH + 1].tobytes()))
                size += len(rows[-1][3])
                if size > EXTRACT_BYTES:
                    yield flush()
                    size = 0
        if rows:
            yield flush()


def _ranges(good: np.ndarray) -> list[tuple[int, int]]:
    """Merged ranges covered by the windows of PASSAGE places that are good."""
    starts = np.flatnonzero(good)
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] - starts[:-1] > PASSAGE)
    if not len(cut):
        return [(int(starts[0]), int(starts[-1]) + PASSAGE)]
    return list(zip(starts[np.r_[0, cut + 1]].tolist(), (starts[np.r_[cut, len(starts) - 1]] + PASSAGE).tolist()))


def _similar(x: list[int], y: list[int]) -> bool:
    mine, theirs = set(x), set(y)
    common = len(mine & theirs)
    return common >= SIMILARITY * (len(mine) + len(theirs) - common)


def _known_to(values: list[int], others: list[int]) -> np.ndarray:
    """Which values are among the others; a set does it faster than np.isin for so few."""
    among = set(others)
    return np.fromiter((v in among for v in values), bool, len(values))


def _windows(there: np.ndarray) -> np.ndarray:
    """Which windows of PASSAGE places have enough common shingles for the similarity (sets of equal size)."""
    total = np.zeros(len(there) + 1, np.int64)
    np.cumsum(there, out=total[1:])
    return total[PASSAGE:] - total[:-PASSAGE] >= 2 * SIMILARITY / (1 + SIMILARITY) * PASSAGE - 0.5


def _cover(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """The fewest of the ranges (both sorted) that cover what all cover together."""
    kept: list[tuple[int, int]] = []
    i = 0
    while i < len(starts):
        if kept and starts[i] <= kept[-1][1]:  # the last one that begins in the range before
            i = max(i, int(np.searchsorted(starts, kept[-1][1], "right")) - 1)
        if not kept or ends[i] > kept[-1][1]:
            kept.append((int(starts[i]), int(ends[i])))
        i += 1
    return kept


def _stretches(there: np.ndarray) -> list[tuple[int, int]]:
    """Ranges that cover every stretch of PASSAGE places or more with enough common shingles, each of them such a stretch.

    A stretch has enough when a prefix sum is no less at its end than at its
    start; the farthest such end of every start is looked up in the largest sums to come.
    """
    score = np.concatenate([[0.0], np.cumsum(there)]) - 2 * SIMILARITY / (1 + SIMILARITY) * np.arange(len(there) + 1)
    best = np.maximum.accumulate(score[::-1])  # of the sums from the end, growing
    ends = len(there) - np.searchsorted(best, score - 1e-6, "left")
    starts = np.flatnonzero(ends - np.arange(len(ends)) >= PASSAGE)
    ends = np.maximum.accumulate(ends[starts]) if len(starts) else ends[:0]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = ends[1:] > ends[:-1]  # the others lie within the one before
    return _cover(starts[fresh], ends[fresh])


def _pieces(there: np.ndarray, passage) -> list[tuple[int, int, int, int]]:
    """The passages of a range that has too little in common as a whole.

    ``passage(s, e)`` is the passage of a stretch, or None if its sets are not
    similar.  Where repeated shingles make a stretch fail, every good window of
    PASSAGE places is asked for.
    """
    found = [passage(s, e) for s, e in _stretches(there)]
    if not all(found):
        starts = [i for i in np.flatnonzero(_windows(there)).tolist() if passage(i, i + PASSAGE)]
        windows = np.array(starts, np.int64)
        found += [passage(s, e) for s, e in _cover(windows, windows + PASSAGE)]
    return [f for f in found if f]


def _partners(x: np.ndarray, y: np.ndarray, shift: int) -> np.ndarray:
    """For each place of x the place of y with the same shingle that is nearest to the one it faces, -1 if none."""
    values, rank = np.unique(y, return_inverse=True)
    at = np.minimum(np.searchsorted(values, x), len(values) - 1)
    width = len(x) + len(y) + abs(shift) + 1
    spots = np.sort(rank * width + np.arange(len(y)))  # by shingle, then place
    facing = at * width + np.clip(np.arange(len(x)) + shift, 0, len(y) - 1)
    k = np.searchsorted(spots, facing)
    near = [spots[np.clip(i, 0, len(y) - 1)] for i in (k - 1, k)]
    away = [np.where(i // width == at, np.abs(i - facing), width) for i in near]
    return np.where(values[at] == x, np.where(away[0] < away[1], near[0], near[1]) % width, -1)


def common_passages(x: np.ndarray, y: np.ndarray, shift: int) -> list[tuple[int, int, int, int]]:
    """Near-duplicate passages of two shingle sequences, (start, end) in x and in y; place i of x faces i + shift of y.

    First along the alignment; if no range of good windows is similar as a
    whole (words put in or left out within a passage), also by the shingles of
    x that are anywhere in y.  Of a range that is not similar as a whole the
    stretches that are, down to single windows of PASSAGE places.  Every
    passage found has a Jaccard similarity of SIMILARITY or more.
    """
    begin, end = max(0, -shift), min(len(x), len(y) - shift)
    found, whole = [], False
    mine, theirs = x.tolist(), y.tolist()
    if end - begin >= PASSAGE:
        facing = x[begin:end] == y[begin + shift:end + shift]

        def aligned(s: int, e: int) -> tuple[int, int, int, int] | None:
            same = np.flatnonzero(facing[s:e])
            for low, high in ((begin + s + int(same[0]), begin + s + int(same[-1]) + 1), (begin + s, begin + e)):
                if _similar(mine[low:high], theirs[low + shift:high + shift]):
                    return low, high, low + shift, high + shift
            return None

        for s, e in _ranges(_windows(facing)):
            if passage := aligned(s, e):
                whole = True
                found.append(passage)
            else:
                found += _pieces(facing[s:e], lambda i, j, s=s: aligned(s + i, s + j))
    if not whole and min(len(x), len(y)) >= PASSAGE:
        there, partner = _known_to(mine, theirs), None

        def anywhere(s: int, e: int) -> tuple[int, int, int, int] | None:
            spots = partner[s:e][there[s:e]]
            low, high = int(spots.min()), int(spots.max()) + 1
            # a shingle that is far from the others in y is no part of the passage
            return (s, e, low, high) if high - low <= 2 * (e - s) and _similar(mine[s:e], theirs[low:high]) else None

        for s, e in _ranges(_windows(there)):
            places = np.flatnonzero(_known_to(theirs, mine[s:e]))
            low, high = int(places[0]), int(places[-1]) + 1
            if _similar(mine[s:e], theirs[low:high]):
                found.append((s, e, low, high))
            else:
                partner = _partners(x, y, shift) if partner is None else partner
                found += _pieces(there[s:e], lambda i, j, s=s: anywhere(s + i, s + j))
    return found


def _repeats(values: np.ndarray) -> np.ndarray:
    """For each window of PASSAGE places, whether a value is there twice."""
    n = len(values)
    if len(set(values.tolist())) == n:
        return np.zeros(n - PASSAGE + 1, bool)
    order = np.argsort(values, kind="stable")
    again = np.full(n, n + PASSAGE, np.int64)
    again[order[:-1]] = np.where(values[order[1:]] == values[order[:-1]], order[1:], n + PASSAGE)
    next_ = np.minimum.accumulate(again[::-1])[::-1][:n - PASSAGE + 1]
    return next_ < np.arange(len(next_)) + PASSAGE


def _left(mine: np.ndarray, other: np.ndarray, shift: int, low: int, high: int) -> list[tuple[int, int]]:
    """Runs (first, last) of the windows of PASSAGE places of ``mine`` with a place in [low, high] that are not known as similar to what they face.

    Whether a window is, is told from it and what it faces alone, so that two
    texts with the same window agree.  Windows with repeated shingles stay.
    """
    n = len(mine) - PASSAGE + 1
    if n <= 0:
        return []
    start, stop = max(0, low - PASSAGE + 1), min(high + 1, n)
    if stop <= start:
        return []
    unknown = np.zeros(stop - start + 2, np.int8)  # with an edge on either side
    unknown[1:-1] = 1
    # the windows that face one of the other text
    begin, end = max(start, -shift), min(stop, len(other) - shift - PASSAGE + 1)
    if begin < end:
        x, y = mine[begin:end + PASSAGE - 1], other[begin + shift:end + shift + PASSAGE - 1]
        known = _windows(x == y)
        if known.any():
            known &= ~_repeats(x) & ~_repeats(y)
            unknown[begin - start + 1:end - start + 1] = ~known
    edge = unknown[1:] - unknown[:-1]
    return list(zip((start + np.flatnonzero(edge == 1)).tolist(), (start + np.flatnonzero(edge == -1) - 1).tolist()))


_VERIFIED = "a long, b long, a_start long, a_end long, b_start long, b_end long, left boolean"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, shift, low, high, centre, a_begin, a_part, b_begin, b_part) to the verified pairs and their word spans.

    With ``left`` set the windows of a, in [a_start, a_end], that are not similar to the centre b.
    """
    for batch in batches:
        rows: list[tuple] = []
        parts = (7, 9)
        for a, b, shift, low, high, centre, a0, x, b0, y in zip(*(batch.column(i) if i in parts else batch.column(i).to_pylist() for i in range(10))):
            x, y = (np.frombuffer(v.as_buffer(), np.uint32) for v in (x, y))
            facing = shift + a0 - b0
            for s, e, t, f in common_passages(x, y, facing):
                rows.append((a, b, a0 + s, a0 + e + SHINGLE - 1, b0 + t, b0 + f + SHINGLE - 1, False))
            if centre & 1:  # every text with a window of the centre is compared with it: the other one's are left
                rows += [(b, a, b0 + s, b0 + e, None, None, True) for s, e in _left(y, x, -facing, low + shift - b0, high + shift - b0)]
            if centre & 2:
                rows += [(a, b, a0 + s, a0 + e, None, None, True) for s, e in _left(x, y, facing, low - a0, high - a0)]
        columns = list(zip(*rows)) or [[]] * 7
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.bool_())],
            names=["a", "b", "a_start", "a_end", "b_start", "b_end", "left"])


def _window_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, node, runs) to (key, fine, node, place) of the windows that begin in the runs, sorted by their first place."""
    for batch in batches:
        for part in chunks(batch, "text"):
            hashes, first, _ = shingles(text_column(part, "text"))
            nodes, places, keys = [], [], []
            for i, (node, runs) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                mine = hashes[first[i]:first[i + 1]]
                edge = np.zeros(len(mine) + 1, np.int64)
                np.add.at(edge, [r["s"] for r in runs], 1)
                np.add.at(edge, [r["e"] + 1 for r in runs], -1)
                place = np.flatnonzero(np.cumsum(edge) > 0)
                places.append(place.astype(np.int32))
                keys.append(_side_keys(mine, place, 1, PASSAGE))
                nodes.append(np.full(len(place), node, np.int64))
            place = np.concatenate(places)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.zeros(len(place), np.int32)), pa.array(np.concatenate(nodes)), pa.array(place)],
                names=["key", "fine", "node", "place"])


def _compared(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """What ``_verify`` finds of the pairs."""
    pairs = stage(pairs.withColumn("request", F.monotonically_increasing_id()))
    sides = pairs.select("request", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("a").alias("node"), F.col("low").alias("low"), F.col("high").alias("high")),
        F.struct(F.lit(1).alias("side"), F.col("b").alias("node"), (F.col("low") + F.col("shift")).cast("int").alias("low"),
                 (F.col("high") + F.col("shift")).cast("int").alias("high")))).alias("s")).select("request", "s.*")
    # a text's requests come in lots, so that a text many others are compared with is neither one row nor one row each
    lots = sides.groupBy("node").agg(F.ceil(F.count("*") / REQUESTS_A_ROW).alias("lots"))
    wanted = sides.join(lots, "node").withColumn("lot", F.pmod(F.xxhash64("request", "side"), F.col("lots")))
    wanted = wanted.repartition("node", "lot").groupBy("node", "lot").agg(
        F.collect_list(F.struct("request", "side", "low", "high")).alias("wanted")).drop("lot")
    parts = stage(texts.join(wanted, "node").select("text", "wanted").mapInArrow(_extract, "request long, side int, begin int, part binary"))
    one = lambda side, p: parts.where(F.col("side") == side).select(
        "request", F.col("begin").alias(f"{p}_begin"), F.col("part").alias(f"{p}_part")).dropDuplicates(["request"])
    both = pairs.join(one(0, "a"), "request").join(one(1, "b"), "request")
    return both.select("a", "b", "shift", "low", "high", "centre", "a_begin", "a_part", "b_begin", "b_part").mapInArrow(_verify, _VERIFIED)


def _from_both_sides(table: DataFrame, a: list[Column], b: list[Column], names: list[str]) -> DataFrame:
    """Every row from the side of either text: the columns ``a`` and the columns ``b`` under ``names``."""
    sides = F.array(*[F.struct(*[c.alias(n) for c, n in zip(side, names)]) for side in (a, b)])
    return table.select(F.explode(sides).alias("x")).select("x.*")


def next_partners(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b, shift, low, high): texts that differ from their key's first text, paired with one that is linked to it there.

    ``pairs`` as compared, ``links(a, b, a_start, a_end, b_start, b_end)`` what
    was found.  A first text is often an edited copy itself; what it is linked
    to at the place, above all the text with the most links, is closer to the
    others.  One partner is taken for each PASSAGE places of a first text.
    """
    c = F.col
    ends = _from_both_sides(
        links, [c("a"), c("b"), c("a_start"), c("a_end"), c("b_start") - c("a_start")],
        [c("b"), c("a"), c("b_start"), c("b_end"), c("a_start") - c("b_start")], ["first", "other", "s", "e", "to_other"])
    degree = ends.groupBy("other").agg(F.count_distinct("first").alias("degree"))
    regions = F.sequence(F.floor(c("s") / PASSAGE), F.floor((c("e") - SHINGLE) / PASSAGE))
    best = ends.join(degree, "other").select("first", F.explode(regions).alias("region"), "degree", "other", "to_other").groupBy("first", "region").agg(
        F.max(F.struct("degree", "other", "to_other")).alias("best")).select("first", "region", "best.other", "best.to_other")
    failed = pairs.join(links.select("a", "b").distinct(), ["a", "b"], "left_anti")
    of = lambda bit, first, x, low, to_x: failed.where(c("centre").bitwiseAND(bit) > 0).select(
        c(first).alias("first"), c(x).alias("x"), low.alias("place"), (c("high") - c("low")).alias("more"), to_x.alias("to_x"))
    lost = of(1, "a", "b", c("low"), c("shift")).union(of(2, "b", "a", c("low") + c("shift"), -c("shift")))
    met = lost.withColumn("region", F.floor(c("place") / PASSAGE)).join(best, ["first", "region"]).where("x <> other")
    turned = c("x") > c("other")
    at_x, at_other = c("place") + c("to_x"), c("place") + c("to_other")
    found = met.select(
        F.least("x", "other").alias("a"), F.greatest("x", "other").alias("b"), F.when(turned, at_other).otherwise(at_x).alias("low"), "more",
        F.when(turned, at_x - at_other).otherwise(at_other - at_x).alias("shift"))
    fresh = found.where((c("low") >= 0) & (c("low") + c("shift") >= 0)).join(pairs.select("a", "b").distinct(), ["a", "b"], "left_anti")
    return fresh.groupBy("a", "b", c("shift").cast("int").alias("shift")).agg(
        F.min("low").cast("int").alias("low"), F.max(c("low") + c("more")).cast("int").alias("high"))


def partners_apart(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """(a, b, shift, low, high): the texts that met one first text at the same place and are in different classes of ``links``, all pairs of them not compared.

    ``pairs(a, b, shift, low, high, centre)`` as they met, ``links(a, b)`` all
    that was found.  Texts of one class need no comparison to be in it; of two
    classes every text is compared with every other, so none stays outside of
    a class that one of its texts belongs to.
    """
    c = F.col
    labels = stage(connected_components(links.select("a", "b")))
    label = lambda node, name: labels.select(c("node").alias(node), c("label").alias(name))
    of = lambda bit, first, x, low, to_x: pairs.where(c("centre").bitwiseAND(bit) > 0).select(
        c(first).alias("first"), c(x).alias("x"), low.alias("from"), (low + c("high") - c("low")).alias("to"), to_x.alias("to_x"))
    met = of(1, "a", "b", c("low"), c("shift")).union(of(2, "b", "a", c("low") + c("shift"), -c("shift")))
    met = stage(met.join(label("first", "of_first"), "first", "left").join(label("x", "of_x"), "x", "left").select(
        "first", "x", "from", "to", "to_x", F.coalesce("of_first", "first").alias("of_first"), F.coalesce("of_x", "x").alias("class")))
    lost = met.where(c("class") != c("of_first"))
    # the places of two texts are the same if their ranges overlap, which the first place that both have in common tells once
    spread = lambda rows: rows.withColumn(
        "region", F.explode(F.sequence(F.floor(c("from") / PASSAGE), F.floor(c("to") / PASSAGE))))
    mine = spread(lost.drop("of_first"))
    others = spread(met.join(lost.select("first").distinct(), "first", "left_semi").drop("of_first"))
    others = others.select("first", "region", *[c(n).alias(f"other_{n}") for n in ("x", "from", "to", "to_x", "class")])
    low, high = F.greatest("from", "other_from"), F.least("to", "other_to")
    both = mine.join(others, ["first", "region"]).where(
        (c("class") != c("other_class")) & (low <= high) & (c("region") == F.floor(low / PASSAGE)))
    turned = c("x") > c("other_x")
    found = both.select(
        F.least("x", "other_x").alias("a"), F.greatest("x", "other_x").alias("b"),
        F.when(turned, c("to_x") - c("other_to_x")).otherwise(c("other_to_x") - c("to_x")).cast("int").alias("shift"),
        (low + F.when(turned, c("other_to_x")).otherwise(c("to_x"))).cast("int").alias("low"), (high - low).alias("more"))
    found = found.groupBy("a", "b", "shift").agg(F.min("low").alias("low"), F.max(c("low") + c("more")).cast("int").alias("high"))
    return found.join(pairs.select("a", "b", "shift"), ["a", "b", "shift"], "left_anti")


def passage_links(texts: DataFrame) -> DataFrame:
    """(a, b, a_start, a_end, b_start, b_end): verified links between different texts, with word spans.

    ``texts(node, text)``: one text a node (rows that repeat it change nothing).
    """
    pairs = stage(candidate_pairs(texts))
    found = stage(_compared(texts, pairs))
    links = found.where(~F.col("left")).drop("left")
    # centres that two or more texts were compared with: the texts that differ from such a one may have something in common
    of = lambda bit, centre, other: pairs.where(F.col("centre").bitwiseAND(bit) > 0).select(
        F.col(centre).alias("b"), F.col(other).alias("other"))
    crowded = of(1, "a", "b").union(of(2, "b", "a")).groupBy("b").agg(
        (F.min("other") != F.max("other")).alias("more")).where("more").select("b")
    runs = found.where("left").join(crowded, "b", "left_semi").groupBy(F.col("a").alias("node")).agg(
        F.collect_set(F.struct(F.col("a_start").alias("s"), F.col("a_end").alias("e"))).alias("runs"))
    windows = small_batches(texts.join(runs, "node")).select("text", "node", "runs").mapInArrow(
        _window_keys, "key long, fine int, node long, place int")
    names = ["a", "b", "shift", "low", "high"]
    more = _pairs(windows, whole=True).select(*names).union(next_partners(pairs, links).select(*names)).groupBy("a", "b", "shift").agg(
        F.min("low").alias("low"), F.max("high").alias("high"))
    again = _compared(texts, more.withColumn("centre", F.lit(0)))
    links = stage(links.union(again.drop("left")))
    last = _compared(texts, partners_apart(pairs, links).withColumn("centre", F.lit(0)))
    return links.union(last.drop("left"))


def shared_passages(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, class_id, n_links, n_shared_words, spans.

    class_id: smallest doc_id among the documents reachable over shared
    passages and equal texts (its own if there are none); n_links: the
    verified links of its text to other texts; spans: word ranges of its
    passages that another document has too, merged; a text that other rows
    repeat word for word is shared as a whole if it has 50 words.  Null and
    empty texts and texts under 50 words have no passages, each is a class of
    its own; rows with a null doc_id take part and have a null class_id if
    their class has no id.  Other columns are not read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    rows = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("node"), F.size(words).cast("long").alias("n_words")))
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.max("n_words").alias("n_words"))
    # of equal texts only the one with the smallest id goes on
    copies = stage(rows.join(nodes.select("node", "least"), "node").where(~F.col("doc_id").eqNullSafe(F.col("least"))).select(
        F.col("doc_id").alias("c_id"), F.col("node").alias("c_node")).distinct())
    lead = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("node"), text.alias("text"))
    if copies.count() <= BROADCAST_ROWS:
        copies = F.broadcast(copies)
    lead = lead.join(copies, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("node") == F.col("c_node")), "left_anti")
    links = stage(passage_links(lead.select("node", "text")))
    labels = connected_components(links.select("a", "b"))
    grouped = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = grouped.groupBy("label").agg(F.min("least").alias("class_id"))
    spans_of = (
        links.select(F.explode(F.array(
            F.struct(F.col("a").alias("node"), F.col("a_start").alias("s"), F.col("a_end").alias("e"), F.col("b").alias("other")),
            F.struct(F.col("b").alias("node"), F.col("b_start").alias("s"), F.col("b_end").alias("e"), F.col("a").alias("other")))).alias("x"))
        .select("x.*").distinct()
    )
    n_links = spans_of.groupBy("node", "other").agg(F.lit(1).alias("one")).groupBy("node").agg(F.count("*").alias("n_links"))
    ranges = spans_of.groupBy("node", "s").agg(F.max("e").alias("e")).groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("s", "e"))).alias("ranges"))
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")
    merged = F.aggregate("ranges", none, lambda out, x: F.when(
        (F.size(out) > 0) & (F.element_at(out, -1).e >= x.s),
        F.concat(F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0))), F.array(F.struct(F.element_at(out, -1).s.alias("s"), F.greatest(F.element_at(out, -1).e, x.e).alias("e")))),
    ).otherwise(F.concat(out, F.array(x))))
    per_node = (
        grouped.join(smallest, "label").join(n_links, "node", "left").join(ranges, "node", "left")
        .select("node", "class_id", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                F.when((F.col("copies") > 1) & (F.col("n_words") >= PASSAGE + SHINGLE - 1),
                       F.array(F.struct(F.lit(0).cast("long").alias("s"), F.col("n_words").alias("e"))))
                .when(F.col("ranges").isNull(), none).otherwise(merged).alias("spans"))
    )
    short = F.col("n_words") < PASSAGE + SHINGLE - 1
    return rows.join(per_node, "node").select(
        "doc_id", "n_words", F.when(short, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "n_links",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x.e - x.s).alias("n_shared_words"),
        F.when(short, none).otherwise(F.col("spans")).alias("spans"))
