"""The k best similarities of every user, without a shuffled row per pair.

Users are dealt into blocks, which hold their users' cells, by item, and the
best ``k`` of each found so far.  Every user's cells, with those of others
packed into one value, travel to every task and pass its blocks there, so a
pair's whole sum is known when a user passes and only the best are given out:
``users * k`` rows instead of one a pair.

Up to ``SENT_CELLS`` copies of cells are shuffled, ``cells * tasks``, a few bytes
each; there are as many tasks as cores.  Beyond that the packed cells are written
once and every task reads that table (:func:`passed`), which sends nothing.
Blocks are bounded by memory (``LOT_CELLS``, ``LOT_KEPT``); a task that takes
several in turn keeps the packed cells for it (``HELD_BYTES`` in memory, more in
a temporary file).
Rows are kept and ranked by the rule of :func:`~kinnear.functions.expr.rounded_sim`,
then by the smaller id.
"""

from __future__ import annotations

import math
import sys
import tempfile
from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinnear.functions.expr import SIM_ROUND
from kinnear.operators.similarity import HEAVY_USER_CELLS, Shape
from kinnear.session import materialize, small_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells of a block's own users and rows it keeps, on average, from which there are more blocks than tasks; users of a block at least.
BLOCK_CELLS, BLOCK_KEPT, LEAST_USERS = 12_000_000, 60_000_000, 64
#: The same as bounded by the memory of a Python worker, some 400 MB.
LOT_CELLS, LOT_KEPT = 2_000_000, 6_000_000
#: Copies of cells up to which they are shuffled to the tasks; tasks that read the written cells, at most.
SENT_CELLS, MOST_TASKS = 20_000_000, 256
#: Rows kept that are ordered at a time, and new ones that wait until then; products summed at a time.
SEGMENT_ROWS, WAITING, PRODUCTS_AT_ONCE = 1_000_000, 200_000, 1_000_000
#: Cells packed into one value; bytes of such values that a task keeps in memory; bytes of them in an Arrow batch.
PACK_CELLS, HELD_BYTES, BATCH_BYTES = 500_000, 64 << 20, 16 << 20
#: Co-rating products from which blocks are worth while, and bytes that a routed cell and a pair cost by the other ways.
LEAST_PRODUCTS, CELL_BYTES, PRODUCT_BYTES = 100_000, 8, 50
_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def block_count(shape: Shape, k: int, parallelism: int, cells: int | None = None, kept: int | None = None) -> int:
    """Blocks by the memory of a task, at least one a core, but none of very few users."""
    rows = min(shape.users * min(float(k), max(shape.partners, 1.0)), shape.products)
    by_size = max(math.ceil(shape.cells / (cells or BLOCK_CELLS)), math.ceil(rows / (kept or BLOCK_KEPT)))
    return max(1, by_size, task_count(shape, parallelism))


def lot_count(shape: Shape, k: int, parallelism: int) -> int:
    """Blocks by the memory of a Python worker; every core has as many, where there are several."""
    n = block_count(shape, k, parallelism, LOT_CELLS, LOT_KEPT)
    return n if n <= parallelism else math.ceil(n / parallelism) * parallelism


def task_count(shape: Shape, parallelism: int) -> int:
    """Tasks that the blocks are dealt into; every cell is sent to each of them."""
    return max(1, min(parallelism, math.ceil(shape.users / LEAST_USERS)))


def rounded_units(sim: np.ndarray) -> np.ndarray:
    """``rounded_sim`` in units of the last place; halves are told by the decimal digits, as Spark does."""
    scaled = np.abs(sim) * 10.0**SIM_ROUND
    units = np.floor(scaled + 0.5)
    last = Decimal(1).scaleb(-SIM_ROUND)
    for i in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-5):
        units[i] = int(Decimal(repr(abs(float(sim[i])))).quantize(last, ROUND_HALF_UP).scaleb(SIM_ROUND))
    return np.where(sim < 0, -units, units).astype(np.int64)


class Block:
    """The cells of a block's users and the best ``k`` similarities of each so far."""

    adds = False  # whether repeated cells of a user and item are added up where the block is a matrix
    full = 8  # cells of a matrix for each that is filled, at most; else there is none

    def __init__(self, k: int, signed: bool):
        self.k, self.signed, self.parts, self.ids = k, signed, [], None

    def add(self, users: np.ndarray, sizes: np.ndarray, items: np.ndarray, weights: np.ndarray) -> None:
        self.parts.append((users, sizes, items, weights))

    def seal(self) -> None:
        """All own users are there: their cells by item, as a matrix if most of it is filled."""
        self.ids, sizes, items, weights = (np.concatenate(x) for x in zip(*self.parts))
        self.parts.clear()
        n = len(self.ids)
        row = np.repeat(np.arange(n, dtype=np.int32), sizes)
        code, n_names = self.named(items)
        del items
        self.matrix = None
        if n * n_names <= self.full * len(weights):
            self.matrix = np.zeros((n, n_names))
            self.put(self.matrix, row, code, weights)
        else:
            order = np.argsort(code, kind="stable")
            self.row, self.weight = row[order], weights[order]
            self.first = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=n_names))])
        self.segment = max(1, SEGMENT_ROWS // self.k)
        nothing = (np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0))
        self.kept = [nothing for _ in range(-(-n // self.segment))]
        self.waiting, self.n_waiting, self.wait = [], 0, max(WAITING, n * self.k // 3)  # soon ordered at first: few pass once there is a k-th
        # the k-th best so far: its similarity in units, its id, and a similarity that is certainly under it
        self.least = np.full(n, np.iinfo(np.int64).min)
        self.least_id = np.zeros(n, np.int64)
        self.under = np.full(n, -np.inf if self.signed else 0.4 * 10.0**-SIM_ROUND)
        self.negative = np.zeros(n, np.int64)

    def named(self, items: np.ndarray) -> tuple[np.ndarray, int]:
        """The items' numbers from 0 and how many there are; ids that lie close are looked up in an array, others in a hash table."""
        low = int(items.min()) if len(items) else 0
        span = int(items.max()) - low + 1 if len(items) else 0
        if span > max(8 * len(items), 1 << 16):
            code, names = pd.factorize(items)
            self.names = pd.Index(names)
            return code, len(names)
        there = np.zeros(span, bool)
        there[items - low] = True
        self.names, self.low = np.cumsum(there, dtype=np.int32) - 1, low
        self.names[~there] = -1
        return self.names[items - low], int(there.sum())

    def put(self, matrix: np.ndarray, row: np.ndarray, code: np.ndarray, weights: np.ndarray) -> None:
        if self.adds:
            np.add.at(matrix, (row, code), weights)
        else:
            matrix[row, code] = weights

    def numbers(self, items: np.ndarray) -> np.ndarray:
        """The numbers of any items, -1 for those that no own user has."""
        if isinstance(self.names, pd.Index):
            return self.names.get_indexer(items)
        inside = (items >= self.low) & (items < self.low + len(self.names))
        code = np.full(len(items), -1, np.int32)
        code[inside] = self.names[items[inside] - self.low]
        return code

    def meet(self, users: np.ndarray, sizes: np.ndarray, items: np.ndarray, weights: np.ndarray) -> None:
        """Other users, or own ones, with all their cells."""
        code = self.numbers(items)
        known = code >= 0
        owner = np.repeat(np.arange(len(users)), sizes)[known]
        code, weights = code[known], weights[known]
        if self.matrix is not None:
            at_once = max(1, PRODUCTS_AT_ONCE // len(self.ids))
            for low in range(0, len(users), at_once):
                i, j = np.searchsorted(owner, [low, low + at_once])
                side = np.zeros((min(at_once, len(users) - low), self.matrix.shape[1]))
                self.put(side, owner[i:j] - low, code[i:j], weights[i:j])
                product = side @ self.matrix.T
                if self.signed:
                    self.negative += (product <= -0.5 * 10.0**-SIM_ROUND).sum(0)
                b, a = np.nonzero((product >= self.under) & (product != 0))
                self.offer(a, users[low + b], product[b, a])
            return
        for cell, other, pair in self.shared(len(users), owner, code):
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            start = np.flatnonzero(np.diff(pair, prepend=-1))
            if len(start):
                sim = np.add.reduceat((weights[cell] * self.weight[other])[order], start)
                b, a = np.divmod(pair[start], len(self.ids))
                if self.signed:
                    lower = (sim <= -0.5 * 10.0**-SIM_ROUND) & (users[b] != self.ids[a])
                    self.negative += np.bincount(a[lower], minlength=len(self.ids))
                near = sim >= self.under[a]
                self.offer(a[near], users[b[near]], sim[near])

    def shared(self, n: int, owner: np.ndarray, code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Cells of ``n`` passing users and own cells of the same item, all those of some users at a time: (cell, own cell, pair).

        A pair is its passing user's place times the number of own users, plus the own user's.
        """
        raters = self.first[code + 1] - self.first[code]
        total = np.concatenate([[0], np.cumsum(raters)])
        by_user = total[np.searchsorted(owner, np.arange(n + 1))]
        low = 0
        while low < n:
            high = max(low + 1, int(np.searchsorted(by_user, by_user[low] + PRODUCTS_AT_ONCE, "right")) - 1)
            i, j = np.searchsorted(owner, [low, high])
            here = raters[i:j]
            cell = np.repeat(np.arange(i, j), here)
            other = self.first[code[cell]] + np.arange(len(cell)) - np.repeat(np.cumsum(here) - here, here)
            yield cell, other, owner[cell] * len(self.ids) + self.row[other].astype(np.int64)
            low = high

    def offer(self, a: np.ndarray, other: np.ndarray, sim: np.ndarray) -> None:
        units = rounded_units(sim)
        wanted = (units > self.least[a]) | ((units == self.least[a]) & (other < self.least_id[a]))
        wanted &= (other != self.ids[a]) & ((units != 0) if self.signed else (units > 0))
        if wanted.any():
            self.waiting.append((a[wanted].astype(np.int32), other[wanted], sim[wanted]))
            self.n_waiting += len(self.waiting[-1][0])
            if self.n_waiting > self.wait:
                self.order()

    def order(self) -> None:
        """The waiting rows join those kept, of which ``k`` a user stay."""
        if not self.waiting:
            return
        a, other, sim = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.n_waiting = [], 0
        by_user = np.argsort(a, kind="stable")
        a, other, sim = a[by_user], other[by_user], sim[by_user]
        edge = np.searchsorted(a, np.arange(len(self.kept) + 1) * self.segment)
        for s, (i, j) in enumerate(zip(edge[:-1], edge[1:])):
            if i == j:
                continue
            x, y, z = (np.concatenate(c) for c in zip(self.kept[s], (a[i:j], other[i:j], sim[i:j])))
            units = rounded_units(z)
            best = np.lexsort((y, -units, x))
            x, y, z, units = x[best], y[best], z[best], units[best]
            start = np.flatnonzero(np.diff(x, prepend=-1))
            place = np.arange(len(x)) - np.repeat(start, np.diff(start, append=len(x)))
            last = place == self.k - 1
            self.least[x[last]], self.least_id[x[last]] = units[last], y[last]
            self.under[x[last]] = (units[last] - 1) * 10.0**-SIM_ROUND
            keep = place < self.k
            self.kept[s] = (x[keep], y[keep], z[keep])

    def ready(self) -> Iterator[pa.RecordBatch]:
        """Rows that are done before all users have passed."""
        return iter(())

    def result(self, n_users: int | None) -> Iterator[pa.RecordBatch]:
        """The rows of rank ``k`` or less; of ``m`` negatives the first one has rank ``n_users + 1 - m``.

        The first ``k`` rows of a user hold all of its positives or no negative that counts.
        """
        self.order()
        for x, y, z in self.kept:
            start = np.flatnonzero(np.diff(x, prepend=-1))
            size = np.diff(start, append=len(x))
            rank = 1 + np.arange(len(x)) - np.repeat(start, size)
            if self.signed and len(x):
                positives = np.repeat(np.add.reduceat((z > 0).astype(np.int64), start), size)
                rank = np.where(z > 0, rank, n_users - self.negative[x] + rank - positives)
            near = rank <= self.k
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[near]) for c in (self.ids[x], y, z, rank)], names=["user", "neighbour", "sim", "rank"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(user, items, weights) to values of about PACK_CELLS cells; a user's cells by weight, then item, which packs well."""
    for batch in batches:
        total = np.concatenate([[0], np.cumsum(np.diff(batch.column(1).offsets.to_numpy()))])
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(total, total[low] + PACK_CELLS, "right")) - 1)
            part = batch.slice(low, high - low)
            sizes = np.diff(part.column(1).offsets.to_numpy())
            items, weights = (part.column(i).flatten().to_numpy(zero_copy_only=False) for i in (1, 2))
            order = np.lexsort((items, weights, np.repeat(np.arange(len(sizes)), sizes)))
            step = np.diff(items[order], prepend=0)
            columns = [part.column(0).to_numpy(), sizes.astype(np.int64), (step << 1) ^ (step >> 63)]  # the sign is the last bit
            # the bytes of one place together: the high ones are nearly all alike
            plain = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T) for c in columns] + [weights[order]]
            yield pa.RecordBatch.from_arrays([
                pa.array([high - low], pa.int64()), pa.array([len(items)], pa.int64()),
                pa.array([pa.compress(b"".join(c.tobytes() for c in plain), codec="zstd", asbytes=True)], pa.binary())],
                names=["users", "cells", "packed"])
            low = high


def _unpack(n_users: int, n_cells: int, packed: bytes) -> list[np.ndarray]:
    """The users, their sizes, items and weights."""
    plain = np.frombuffer(pa.decompress(packed, 16 * (n_users + n_cells), codec="zstd"), np.uint8)
    ends = np.cumsum([0, n_users, n_users, n_cells]) * 8
    users, sizes, step = (np.ascontiguousarray(plain[i:j].reshape(8, -1).T).reshape(-1).view(np.int64) for i, j in zip(ends[:-1], ends[1:]))
    return [users, sizes, np.cumsum((step >> 1 & np.iinfo(np.int64).max) ^ -(step & 1)), plain[ends[-1]:].view(np.float64)]


class Passing:
    """The packed values of a task, read once for each of its blocks and once more to fill it."""

    def __init__(self):
        self.file, self.sizes = tempfile.SpooledTemporaryFile(HELD_BYTES), []

    def add(self, n_users: int, n_cells: int, packed: bytes) -> None:
        self.file.write(packed)
        self.sizes.append((n_users, n_cells, len(packed)))

    def __iter__(self) -> Iterator[list[np.ndarray]]:
        self.file.seek(0)
        for n_users, n_cells, size in self.sizes:
            yield _unpack(n_users, n_cells, self.file.read(size))


def _block_of(users: np.ndarray, blocks: int) -> np.ndarray:
    mixed = (users.view(np.uint64) ^ (users.view(np.uint64) >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)


def _own(cells: list[np.ndarray], block: int, blocks: int) -> list[np.ndarray]:
    users, sizes, items, weights = cells
    mine = _block_of(users, blocks) == block
    of_mine = np.repeat(mine, sizes)
    return [users[mine], sizes[mine], items[of_mine], weights[of_mine]]


def _nearest(k: int, n_users: int | None, tasks: int, blocks: int):
    """Rows ``task, users, cells, packed`` to the best of each user in the blocks of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing: dict[int, Passing] = {}
        for batch in batches:
            for task, *value in zip(*(batch.column(i) for i in range(4))):
                passing.setdefault(task.as_py(), Passing()).add(*(v.as_py() for v in value))
        for task, every in passing.items():
            for number in range(task, blocks, tasks):
                block = Block(k, n_users is not None)
                for cells in every:
                    block.add(*_own(cells, number, blocks))
                if not any(len(part[0]) for part in block.parts):
                    continue
                block.seal()
                for cells in every:
                    block.meet(*cells)
                yield from block.result(n_users)

    return run


def _pack_lots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lot, user, items, weights) to values as :func:`_pack` makes them, each of users of one lot."""
    for batch in batches:
        lots = batch.column(0).to_numpy()
        for lot in np.unique(lots):
            for value in _pack(iter([batch.filter(pa.array(lots == lot)).select([1, 2, 3])])):
                yield pa.RecordBatch.from_arrays([pa.array([lot], pa.int32()), *value.columns], names=["lot", *value.schema.names])


def _passed(own: dict[int, int], make: Callable, n_users: int | None):
    """Rows ``lot, users, cells, packed`` to what the blocks of the lots in ``own`` make of them.

    ``own`` has the number of values of each lot.  Rows without a lot pass the block; those
    that come before its last own value wait, and all do where there are several lots.
    """

    def sealed(values: list[tuple]):
        block = make()
        for value in values:
            block.add(*_unpack(*value))
        block.seal()
        return block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[int, list[tuple]] = {lot: [] for lot in own}
        waiting, block, missing = Passing(), None, sum(own.values())
        for batch in batches:
            for lot, *value in zip(*(batch.column(i) for i in range(4))):
                lot, value = lot.as_py(), tuple(v.as_py() for v in value)
                if lot is not None:
                    mine[lot].append(value)
                    missing -= 1
                    if not missing and len(own) == 1:
                        block = sealed(mine.pop(lot))
                        for cells in waiting:
                            block.meet(*cells)
                            yield from block.ready()
                elif block is None:
                    waiting.add(*value)
                else:
                    block.meet(*_unpack(*value))
                    yield from block.ready()
        for lot in [*mine]:
            block = sealed(mine.pop(lot))
            for cells in waiting:
                block.meet(*cells)
                yield from block.ready()
            yield from block.result(n_users)
            block = None
        if block is not None:
            yield from block.result(n_users)

    return run


def packed_lots(cells: DataFrame, lots: int, n_cells: int) -> DataFrame:
    """The written table ``lot, users, cells, packed`` of ``cells(user, item, weight)``, by whole users."""
    lot = F.pmod(F.xxhash64("user"), F.lit(lots)).cast("int").alias("lot")
    parts = min(lots, max(cells.sparkSession.sparkContext.defaultParallelism, math.ceil(n_cells / LOT_CELLS)))
    pair = F.struct(F.col("item").cast("long").alias("item"), "weight")
    lists = cells.select(lot, F.col("user").cast("long").alias("user"), "item", "weight").repartition(parts, "lot").groupBy("lot", "user").agg(
        F.collect_list(pair).alias("c"))
    values = lists.select("lot", "user", F.col("c.item").alias("items"), F.col("c.weight").alias("weights")).mapInArrow(
        _pack_lots, "lot int, users long, cells long, packed binary")
    return materialize(values)


def passed(packed: DataFrame, make: Callable, n_users: int | None, schema: str) -> DataFrame:
    """What blocks (``make()``), one of each lot's users, make of all users that pass them.

    Every task reads the written table ``packed`` itself, first the values of its own lots;
    nothing is shuffled, and with one lot a task nothing is kept but the block.
    """
    packed = small_batches(packed, BATCH_BYTES)
    own = {r["lot"]: r["n"] for r in packed.groupBy("lot").agg(F.count(F.lit(1)).alias("n")).collect()}
    tasks, out = min(len(own), MOST_TASKS), []
    for task in range(tasks):
        mine = {lot: own[lot] for lot in sorted(own)[task::tasks]}
        every = packed.select(F.lit(None).cast("int").alias("lot"), "users", "cells", "packed")
        read = packed.where(F.col("lot").isin([*mine])).unionAll(every).coalesce(1)
        out.append(read.mapInArrow(_passed(mine, make, n_users), schema))
    if len(out) > 1:  # a union of single partitions only would be one partition; one of none keeps the tasks apart
        out.append(packed.sparkSession.range(0).select(*[F.col("id").cast(f.dataType).alias(f.name) for f in out[0].schema]))
    while len(out) > 1:  # by pairs, so that the plan is not as deep as there are tasks
        out = [a.unionAll(b) for a, b in zip(out[::2], out[1::2])] + out[len(out) & ~1:]
    return out[0] if out else packed.sparkSession.createDataFrame([], schema)


def can_serve(profiles: DataFrame) -> bool:
    """Whether the users' ids are integers, which the blocks order by."""
    return profiles.schema["user"].dataType.simpleString() in _INTEGRAL


def blocks_pay(profiles: DataFrame, shape: Shape) -> bool:
    """Whether the cells sent to every task are less than the pairs' rows; a user's cells travel as one row, so no user may be heavy."""
    if not can_serve(profiles) or shape.of_user > HEAVY_USER_CELLS or shape.products < LEAST_PRODUCTS:
        return False
    tasks = task_count(shape, profiles.sparkSession.sparkContext.defaultParallelism)
    return shape.cells * tasks * CELL_BYTES < shape.products * PRODUCT_BYTES


def nearest(profiles: DataFrame, k: int, shape: Shape, n_users: int | None = None, blocks: int | None = None) -> DataFrame:
    """``user, neighbour, sim, rank`` up to rank ``k`` by the dense rule of :mod:`kinnear.operators.neighbours`.

    Positive ones only, unless ``n_users`` is given, which negatives are ranked
    by.  ``profiles`` is a written table of unit profiles.
    """
    cores = profiles.sparkSession.sparkContext.defaultParallelism
    sent = shape.cells * task_count(shape, cores) <= SENT_CELLS
    blocks = blocks or lot_count(shape, k, cores)
    tasks = min(blocks, task_count(shape, cores))
    cells = numbered(profiles)
    out = "user long, neighbour long, sim double, rank long"
    if sent:
        lists = cells.groupBy("user").agg(F.collect_list(F.struct(F.col("item").cast("long").alias("item"), "weight")).alias("c"))
        values = lists.select(F.col("user").cast("long").alias("user"), F.col("c.item").alias("items"), F.col("c.weight").alias("weights")).mapInArrow(
            _pack, "users long, cells long, packed binary")
        every = F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task")
        dealt = small_batches(values, BATCH_BYTES).select(every, "users", "cells", "packed").repartitionById(tasks, "task")
        best = dealt.mapInArrow(_nearest(k, n_users, tasks, blocks), out)
    else:
        signed = n_users is not None
        best = passed(packed_lots(cells, blocks, shape.cells), lambda: Block(k, signed), n_users, out)
    kind = profiles.schema["user"].dataType
    return best.select(F.col("user").cast(kind).alias("user"), F.col("neighbour").cast(kind).alias("neighbour"), "sim", "rank")


def numbered(profiles: DataFrame) -> DataFrame:
    """``user, item, weight`` with integers for items."""
    cells = profiles.where(F.col("item").isNotNull()).select("user", "item", "weight")
    if cells.schema["item"].dataType.simpleString() not in _INTEGRAL:
        names = materialize(cells.select("item").distinct().select("item", F.monotonically_increasing_id().alias("_code")))
        cells = cells.join(names, "item").select("user", F.col("_code").alias("item"), "weight")
    return cells


class Pairs(Block):
    """Gives out every passing user's similarities to own users with larger ids; keeps none."""

    adds = True

    def __init__(self):
        super().__init__(1, False)
        self.found: list[pa.RecordBatch] = []

    def seal(self) -> None:
        super().seal()
        self.under[:] = -np.inf

    def offer(self, a: np.ndarray, other: np.ndarray, sim: np.ndarray) -> None:
        one = other < self.ids[a]
        self.found.append(pa.RecordBatch.from_arrays([pa.array(c[one]) for c in (other, self.ids[a], sim)], names=["user", "neighbour", "sim"]))

    def ready(self) -> Iterator[pa.RecordBatch]:
        while self.found:
            yield self.found.pop()

    def result(self, n_users: int | None) -> Iterator[pa.RecordBatch]:
        return self.ready()


def all_pairs(profiles: DataFrame, shape: Shape, lots: int | None = None) -> DataFrame:
    """``user, neighbour, sim`` of all co-rating pairs, ``user < neighbour``; no row of a pair is shuffled."""
    cores = profiles.sparkSession.sparkContext.defaultParallelism
    packed = packed_lots(numbered(profiles), lots or lot_count(shape, 1, cores), shape.cells)
    kind = profiles.schema["user"].dataType
    found = passed(packed, Pairs, None, "user long, neighbour long, sim double")
    return found.select(F.col("user").cast(kind).alias("user"), F.col("neighbour").cast(kind).alias("neighbour"), "sim")
