"""Repair of a conversation's structure: the cheapest edits to ``(s?(ua)+)?``.

The rows of a conversation, in order, become symbols: the initial of the role
and what is wrong with the row.  Equal consecutive symbols are one run.  Over
the four states of the wanted structure a row is a min-plus matrix, a run a
power of it, put together from cached binary powers; from the costs that
remain behind each run the edits are unrolled, the ASCII-least first.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinnear.llm.tables import small_batches

#: Fixed costs of the edits; a truncated row that stays costs SHORTENED more.
REROLE, DELETE, INSERT, SHORTENED = 2, 3, 2, 1
#: What can be wrong with a row.
FINE, TRUNCATED, BLANK, DUPLICATE, DROPPED = 0, 1, 2, 3, -1

# States: 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an assistant row.
_NEXT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_EMIT = (2, 2, 3, 2)  # the state that the only role an insertion or a new role can have leads to
_ENDS = (0, 3)
_FAR = 1 << 60
_STATES = range(4)


def symbol(initial: str, fault: int) -> str:
    """One letter a kind of row: ``s u a x`` by initial, upper case if truncated; ``-`` for rows that must go."""
    if fault in (BLANK, DUPLICATE):
        return "-"
    letter = initial if initial in _NEXT else "x"
    return letter.upper() if fault == TRUNCATED else letter


@lru_cache(maxsize=None)
def edits(kind: str) -> tuple[tuple[str, int, tuple], ...]:
    """(edit, cost, next state by state) of a row's edits that use it up, ASCII-least first."""
    found = [("D", DELETE, tuple(_STATES))]
    if kind != "-":
        more = SHORTENED if kind.isupper() else 0
        if kind.lower() in _NEXT:
            found.append(("K", more, _NEXT[kind.lower()]))
        found.append(("R", REROLE + more, _EMIT))
    return tuple(found)


def _times(a: tuple, b: tuple) -> tuple:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in _STATES) for j in _STATES) for i in _STATES)


def _on(m: tuple, v: tuple) -> tuple:
    """Cheapest cost from every state through ``m`` and then ``v``."""
    return tuple(min(m[i][j] + v[j] for j in _STATES) for i in _STATES)


def _insertions() -> tuple:
    """Cost between states by insertions alone; two reach every state that insertions can reach."""
    once = tuple(tuple(0 if i == j else INSERT if j == _EMIT[i] else _FAR for j in _STATES) for i in _STATES)
    return _times(once, once)


_INSERTIONS = _insertions()
#: Costs of the edits behind the last row.
_LAST = _on(_INSERTIONS, tuple(0 if s in _ENDS else _FAR for s in _STATES))


@lru_cache(maxsize=None)
def power(kind: str, k: int) -> tuple:
    """The transition of ``2**k`` rows of one kind, each with the insertions before it."""
    if k:
        half = power(kind, k - 1)
        return _times(half, half)
    row = [[_FAR] * 4 for _ in _STATES]
    for _, cost, after in edits(kind):
        for s in _STATES:
            if after[s] is not None:
                row[s][after[s]] = min(row[s][after[s]], cost)
    return _times(_INSERTIONS, tuple(map(tuple, row)))


def advance(kind: str, n: int, behind: tuple) -> tuple:
    """The costs before a run of ``n`` rows from those behind it."""
    k = 0
    while n >> k:
        if n >> k & 1:
            behind = _on(power(kind, k), behind)
        k += 1
    return behind


def _behind_rows(kind: str, n: int, behind: tuple) -> Iterator[tuple]:
    """The costs behind each row of a run, first row first, in memory of the logarithm of ``n``."""
    if n == 1:
        yield behind
        return
    k = (n - 1).bit_length() - 1
    yield from _behind_rows(kind, n - (1 << k), _on(power(kind, k), behind))
    yield from _behind_rows(kind, 1 << k, behind)


class Runs:
    """Runs of equal symbols: a letter, a length and four costs a run, whatever the texts."""

    def __init__(self):
        self.kinds, self.lengths = [], array("q")

    def add(self, kind: str) -> None:
        if self.kinds and self.kinds[-1] == kind:
            self.lengths[-1] += 1
        else:
            self.kinds.append(kind)
            self.lengths.append(1)

    def solve(self) -> tuple[int, str]:
        """(least cost, ASCII-least audit of that cost)."""
        behind = [_LAST]  # behind the last run, the one before, ..
        for kind, n in zip(reversed(self.kinds), reversed(self.lengths)):
            behind.append(advance(kind, n, behind[-1]))
        cost = left = behind[-1][0]
        state, audit = 0, []
        for run, (kind, n) in enumerate(zip(self.kinds, self.lengths)):
            for after in _behind_rows(kind, n, behind[len(self.kinds) - run - 1]):
                state, left = self._row(kind, after, state, left, audit)
        while left:
            state, left = _EMIT[state], left - INSERT
            audit.append("I")
        return cost, "".join(audit)

    @staticmethod
    def _row(kind: str, after: tuple, state: int, left: int, audit: list[str]) -> tuple[int, int]:
        """The least edits of one row, insertions before it included; (state, cost left) behind it."""
        while True:
            delete, *others = edits(kind)
            if delete[1] + after[state] == left:
                audit.append("D")
                return state, after[state]
            there = _EMIT[state]
            if INSERT + _on(power(kind, 0), after)[there] == left:
                audit.append("I")
                state, left = there, left - INSERT
                continue
            for letter, cost, target in others:
                if target[state] is not None and cost + after[target[state]] == left:
                    audit.append(letter)
                    return target[state], after[target[state]]
            raise AssertionError("no edit has the cost that remains")


_FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_NAMES = [f.split()[0] for f in _FACTS.split(", ")]


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation from its sorted rows (conv_id, turn, initial, fault)."""
    done: list[tuple] = []
    one: dict | None = None

    def close() -> None:
        cost, audit = one["runs"].solve()
        low, high = one["low"], one["last"]
        gaps = 0 if low is None else high - low + 1 - one["turns"]
        done.append((one["id"], gaps, *(one["faults"][f] for f in (BLANK, DUPLICATE, TRUNCATED)), one["illegal"], cost, audit))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [[]] * 8
        types = [pa.int64()] * 7 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["conv_id", *_NAMES])

    for batch in batches:
        for conv_id, turn, initial, fault in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if one is None or one["id"] != conv_id:
                if one is not None:
                    close()
                one = {"id": conv_id, "low": None, "last": None, "turns": 0, "faults": dict.fromkeys((FINE, TRUNCATED, BLANK, DUPLICATE), 0),
                       "illegal": 0, "before": None, "runs": Runs()}
            if fault == DROPPED:
                continue
            if turn is not None and turn != one["last"]:
                one["low"] = turn if one["low"] is None else one["low"]
                one["last"], one["turns"] = turn, one["turns"] + 1
            if one["before"] is not None and one["before"] + initial not in ("su", "ua", "au"):
                one["illegal"] += 1
            one["before"] = initial
            one["faults"][fault] += 1
            one["runs"].add(symbol(initial, fault))
        if len(done) >= 1000:
            yield flush()
            done.clear()
    if one is not None:
        close()
    yield flush()


class Replay:
    """An audit applied to a conversation's rows as they come: (edit, role, text or None for an empty one)."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0

    def _emit(self) -> str:
        self.state = _EMIT[self.state]
        return "user" if self.state == 2 else "assistant"

    def inserted(self) -> Iterator[str]:
        """Roles inserted at this place."""
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._emit()

    def row(self, role: str) -> tuple[str, str | None]:
        """(edit, role it has afterwards; None if deleted) of the next row."""
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = _NEXT[role[:1]][self.state]
            return letter, role
        return letter, self._emit() if letter == "R" else None


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The facts with the SHA-256 of the repaired rows, which stream by; no text is kept."""
    facts, replay, total, lines, done = None, None, None, 0, []

    def write(role: str, text: str) -> None:
        nonlocal lines
        total.update(("\n" if lines else "").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        lines += 1

    def close() -> None:
        for role in replay.inserted():
            write(role, "")
        done.append((*facts, total.hexdigest()))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done)) if done else [[]] * 9
        types = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["conv_id", *_NAMES, "repaired_sha256"])

    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            conv_id, is_row, role, text, *rest = row
            if not is_row:
                if facts is not None:
                    close()
                facts, replay, total, lines = (conv_id, *rest), Replay(rest[-1]), hashlib.sha256(), 0
                continue
            for new in replay.inserted():
                write(new, "")
            _, now = replay.row(role)
            if now is not None:
                write(now, text)
        if len(done) >= 1000:
            yield flush()
            done.clear()
    if facts is not None:
        close()
    yield flush()


_ROWS = "conv_id long, position long, turn long, role string, text string, edit string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired rows themselves, a batch out for a batch in."""
    conv, replay, place = None, None, 0
    for batch in batches:
        out: list[tuple] = []

        def write(turn, role, text, edit) -> None:
            nonlocal place
            out.append((conv, place, turn, role, text, edit))
            place += 1

        for conv_id, is_row, role, text, turn, audit in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if not is_row:
                for new in replay.inserted() if replay else ():
                    write(None, new, "", "I")
                conv, replay, place = conv_id, Replay(audit), 0
                continue
            for new in replay.inserted():
                write(None, new, "", "I")
            letter, now = replay.row(role)
            if now is not None:
                write(turn, now, text, letter)
        yield _row_batch(out)
    yield _row_batch([(conv, place + i, None, new, "", "I") for i, new in enumerate(replay.inserted())] if replay else [])


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 6
    types = [pa.int64()] * 3 + [pa.string()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[f.split()[0] for f in _ROWS.split(", ")])


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped): the rows with damage by the crc32 of ``conv_id:turn`` modulo 20.

    0 marks a row as dropped, 1 empties its text, 2 removes its ``[.!?]``, 3
    repeats it, 4 sets role user.  A null role, text, or id or turn in the
    hashed name is one space.  Rows that repeat an id and a turn share their damage.
    """
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = _plain(conversations).withColumn("d", F.crc32(name.cast("binary")) % 20)
    copies = F.array_repeat(F.lit(0), F.when(F.col("d") == 3, 2).otherwise(1))
    return rows.select(
        "conv_id", "turn", F.when(F.col("d") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("d") == 1, "").when(F.col("d") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("d") == 0).alias("dropped"), F.explode(copies).alias("_copy")).drop("_copy")


def _plain(conversations: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))


def _fault(text: Column) -> Column:
    """BLANK, TRUNCATED or FINE, by the last character that is no blank."""
    last = F.substring(F.rtrim(F.translate(text, "\t\n\x0b\x0c\r", "     ")), -1, 1)
    return F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)


def _marked(rows: DataFrame) -> DataFrame:
    """Rows with the digest of their text, which names it, and DROPPED in ``fault`` where they don't count."""
    if "dropped" not in rows.columns:
        rows = rows.withColumn("dropped", F.lit(False))
    return rows.select("conv_id", "turn", "role", "text", F.sha2("text", 256).alias("digest"),
                       F.when(F.col("dropped"), DROPPED).otherwise(_fault(F.col("text"))).alias("fault"))


_ORDER = ("turn", "role", "digest")


def conversation_facts(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation in ``rows``.

    ``rows(conv_id, turn, role, text[, dropped])``; nulls in role and text
    count as one space, a conversation whose rows are all dropped has zeros
    and an empty audit.  Rows go by turn (nulls first); those of one turn by
    role and then by the SHA-256 of their text, equal rows one after another.

    Texts stay where they are: what is shuffled is their digest.  A
    conversation's rows pass one task in order, because the audit is one
    string; the task holds its runs only.
    """
    narrow = _marked(rows).drop("text")
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "digest", "fault").orderBy(F.col("turn").asc_nulls_first()))
    again = (seen > 1) & F.col("fault").isin(FINE, TRUNCATED)
    rows = narrow.withColumn("again", again)
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", *_ORDER, "again")
    return small_batches(ordered).select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), F.when(F.col("again"), DUPLICATE).otherwise(F.col("fault")).alias("fault"),
    ).mapInArrow(_facts, f"conv_id long, {_FACTS}")


def _with_audits(rows: DataFrame, facts: DataFrame, *columns: str) -> DataFrame:
    """A conversation's facts and behind them its rows in order; one shuffle of the texts."""
    marked = _marked(rows).where(F.col("fault") != DROPPED).withColumn("is_row", F.lit(True))
    both = marked.unionByName(facts.withColumn("is_row", F.lit(False)), allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *_ORDER)
    return small_batches(ordered).select("conv_id", "is_row", "role", "text", *columns)


def repair_digests(rows: DataFrame) -> DataFrame:
    """The facts of every conversation (see :func:`conversation_facts`) and the SHA-256 of its repaired rows.

    The repaired rows are ``role:text`` joined by newlines; none: the hash of
    the empty string.  Empty tables: no rows.  Other columns are not read.
    """
    rows = _plain(rows) if "dropped" not in rows.columns else rows
    return _with_audits(rows, conversation_facts(rows), *_NAMES).mapInArrow(_digests, f"conv_id long, {_FACTS}, repaired_sha256 string")


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, turn, role, text, edit): the conversations with the cheapest edits applied.

    edit: K kept, R with a new role, I inserted (empty text, null turn).
    Deleted rows are gone; a conversation all of whose rows are gone has none.
    Odd rows as in :func:`conversation_facts`.
    """
    rows = _plain(conversations)
    return _with_audits(rows, conversation_facts(rows), "turn", "audit").mapInArrow(_repaired, _ROWS)
