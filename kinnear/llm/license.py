"""Fuzzy search for short license notices.

A notice that occurs with at most e edits holds one of e + 1 pieces of it
unchanged (pigeonhole).  One automaton finds all pieces of all notices in a
text; around each hit the ``regex`` library looks for the whole notice with at
most e errors, best match first, which verifies the edits and gives the span.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinnear.llm.tables import small_batches

#: Base phrases and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Notices searched for with errors, and their labels.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "licensed under the gnu general public license version 2": "gpl-2.0",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution license": "cc-by",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license version 2 0": "mpl-2.0",
    "dedicated to the public domain": "public-domain",
    "proprietary and confidential": "proprietary",
    "all rights reserved": "reserved",
}

#: Characters of a notice for each edit allowed.
CHARS_PER_EDIT = 12

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class Match:
    label: str
    first: int  # words from 0
    last: int  # inclusive
    errors: int
    similarity: float


def distinctive_words(notices: dict[str, int]) -> dict[str, set[str]]:
    """The words of each notice that tell it from notices within both their errors; ``notices``: errors allowed.

    Rivals have as many words; they can be mistaken for one another if the
    words that differ are no longer than the errors of both.
    """
    found: dict[str, set[str]] = {n: set() for n in notices}
    for a, e in notices.items():
        for b, f in notices.items():
            pairs = list(zip(a.split(), b.split())) if a != b and len(a.split()) == len(b.split()) else []
            differ = [(x, y) for x, y in pairs if x != y]
            if sum(max(len(x), len(y)) for x, y in differ) <= e + f:
                found[a].update(x for x, _ in differ)
    return found


def settled(matches: list[Match]) -> list[Match]:
    """The matches that stay where some overlap, by place."""
    kept: list[Match] = []  # by place, none overlaps another
    for m in sorted(matches, key=lambda m: (m.errors, m.first - m.last, m.label, m.first)):
        at = bisect_left(kept, m.first, key=lambda k: k.last)
        if at == len(kept) or m.last < kept[at].first:
            kept.insert(at, m)
    return kept


class NoticeSearch:
    """The automaton of all pieces and one bounded-error pattern a notice."""

    def __init__(self, notices: dict[str, str] | None = None, chars_per_edit: int = CHARS_PER_EDIT):
        self.notices = NOTICES if notices is None else notices
        self.edits, self.patterns = {}, {}
        pieces: dict[str, list[tuple[str, int]]] = {}
        for notice in self.notices:
            e = max(1, len(notice) // chars_per_edit)
            self.edits[notice] = e
            # BESTMATCH: of all matches with at most e errors the one with the fewest
            self.patterns[notice] = regex.compile(rf"(?b)(?:{regex.escape(notice)}){{e<={e}}}")
            for k in range(e + 1):
                a, b = k * len(notice) // (e + 1), (k + 1) * len(notice) // (e + 1)
                pieces.setdefault(notice[a:b], []).append((notice, a))
        self.distinctive = distinctive_words(self.edits)
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()

    def search(self, joined: str, starts: np.ndarray) -> list[Match]:
        """Matches in words joined by single blanks; ``starts``: where each word begins."""
        found: dict[tuple[str, int, int], Match] = {}
        tried: dict[str, int] = {}  # up to where a notice has been searched for
        for end, (size, owners) in self.automaton.iter(joined):
            for notice, offset in owners:
                e = self.edits[notice]
                begin = end + 1 - size - offset
                if end < tried.get(notice, -1):
                    continue  # inside a verified occurrence
                hit = self.patterns[notice].search(joined, max(0, begin - e), begin + len(notice) + e)
                if hit is None or not hit.end() > hit.start():
                    continue
                first = int(np.searchsorted(starts, hit.start(), "right")) - 1
                if starts[first] < hit.start() and joined[hit.start()] == " ":
                    first += 1
                last = int(np.searchsorted(starts, hit.end() - 1, "right")) - 1
                if not self.distinctive[notice] <= set(joined[starts[first]:_word_end(joined, hit.end())].split(" ")):
                    continue  # a rival's place, or one that says too little
                tried[notice] = hit.end()
                errors = sum(hit.fuzzy_counts)
                label = self.notices[notice]
                key = (label, first, last)
                if key not in found or found[key].errors > errors:
                    found[key] = Match(label, first, last, errors, 1 - errors / len(notice))
        return settled(list(found.values()))


def _word_end(joined: str, at: int) -> int:
    """Where the word ends that the character before ``at`` belongs to."""
    end = joined.find(" ", max(0, at - 1))
    return len(joined) if end < 0 else end


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split(b" ") if text else []


def scan(text: str | None, search: NoticeSearch) -> tuple[int, list[tuple[str, int]], list[Match]]:
    """(number of words, base places as (label, word), fuzzy matches) of a whole text."""
    words = [w for w in words_of(text) if w]
    padded = b" " + b" ".join(words) + b" "
    starts = None
    base: list[tuple[str, int]] = []
    for phrase, label in PHRASES.items():
        needle = b" " + phrase.encode() + b" "
        at = padded.find(needle)
        while at >= 0:
            if starts is None:
                starts = _starts(words, bytes)
            base.append((label, int(np.searchsorted(starts, at))))
            at = padded.find(needle, at + 1)
    joined = padded[1:-1].decode("utf-8", "replace")
    matches: list[Match] = []
    if next(search.automaton.iter(joined), None):
        matches = search.search(joined, _starts([w.decode("utf-8", "replace") for w in words], str))
    return len(words), base, matches


def _starts(words: list, kind: type) -> np.ndarray:
    """Where each word begins in the words joined by single blanks."""
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    return np.concatenate([[0], ends[:-1]])


_ROW = ("doc_id long, n_words long, base array<struct<label:string,word:long>>, "
        "matches array<struct<label:string,first:long,last:long,errors:int,similarity:double>>")


def license_scan(docs: DataFrame, notices: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, n_words, base, matches) for every row of ``docs``.

    base: all places of the base phrases; matches: fuzzy notices with their
    first and last word, edits and similarity.  Null and empty texts have
    none; repeated rows each get their row; a null doc_id is kept.  Whole
    texts are searched; memory is that of one text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = NoticeSearch(notices)
        schema = pa.schema([
            ("doc_id", pa.int64()), ("n_words", pa.int64()),
            ("base", pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))),
            ("matches", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                                            ("errors", pa.int32()), ("similarity", pa.float64())])))])
        for batch in batches:
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                rows = [scan(t.as_py(), search) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([[{"label": a, "word": b} for a, b in r[1]] for r in rows], schema.field("base").type),
                    pa.array([[vars(m) for m in r[2]] for r in rows], schema.field("matches").type)], schema=schema)

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _ROW)


def with_score(found: DataFrame) -> DataFrame:
    """Adds base_labels, labels (sorted, distinct, comma-joined) and score.

    score: 1 for a base phrase, else the similarity of the best match, 0 without any.
    """
    base = F.array_distinct(F.col("base.label"))
    every = F.array_union(base, F.col("matches.label"))
    best = F.array_max(F.transform("matches", lambda m: m.similarity))
    return found.select(
        "*",
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(every), ",").alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )
