"""Personal data, and the terms that give it away.

1. Spans of direct identifiers are found with linear-time scans.
2. All terms of the documents that mention an identifier are candidates; over
   the whole corpus the documents with the term and those with both the term
   and the identifier are counted.
3. How strongly a term reveals the identifier is its pointwise mutual
   information with it as a share of the identifier's own information:
   log(N * n_te / (n_t * n_e)) / log(N / n_e), which is 1 when every document
   with the term has the identifier.  Terms above one threshold are removed,
   above a lower one generalised, wherever they stand in the corpus.
4. A generalised term becomes the name of its class, what it is made of and
   about how long it is.  Classes are counted like terms; a term whose class
   itself reveals an identifier to the lower threshold is removed instead.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinnear.llm.tables import small_batches, stage
from kinnear.llm.words import LOWER, NOT_SPACE, buffer_of, chunks, span_hashes, spans, text_column

KINDS = ("email", "ip", "card", "phone")
#: Documents in which term and identifier must occur together.
SUPPORT = 3
#: Share of the identifier's information from which a term is removed / generalised.
REMOVE, GENERALISE = 0.95, 0.8
#: Strong terms that travel to the tasks at most (two longs each); more are joined by shuffle.
TERMS_OUT = 1_000_000

#: Classes of terms by what they are made of and their length: one long each, below all hashes that matter.
MADE_OF, LENGTHS = ("word", "number", "code"), (3, 6, 9)
N_CLASSES = len(MADE_OF) * (len(LENGTHS) + 1)
_LETTER, _FIGURE = (np.zeros(256, np.int64) for _ in range(2))
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_FIGURE[48:58] = 1

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match begins at the first digit of a run; the digits of a part are never given back.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping emails: from each @, back over its run and on over its domain."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind."""
    found = [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(part) <= 3 and int(part or "0") <= 255 for part in (p.lstrip("0") for p in m.groups())):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def free_words(text: str, found: list[tuple[str, int, int]]) -> set[str]:
    """The distinct words that are not part of an identifier."""
    words = [m.span() for m in _WORD.finditer(text)]
    taken = _taken(np.array([a for a, _ in words]), np.array([b for _, b in words]), found)
    return {text[a:b] for (a, b), t in zip(words, taken.tolist()) if not t}


def _taken(starts: np.ndarray, ends: np.ndarray, found: list[tuple[str, int, int]]) -> np.ndarray:
    """Which of the ranges are part of an identifier."""
    taken = np.zeros(len(starts), bool)
    for _, a, b in found:
        taken[np.searchsorted(ends, a, "right"):np.searchsorted(starts, b)] = True
    return taken


def term_hash(terms: list[str]) -> np.ndarray:
    """The hashes that ``document_frequency`` gives to these words (A-Z lower-cased)."""
    data, offsets = buffer_of(pa.array(terms, pa.large_string()))
    return span_hashes(LOWER[data], offsets[:-1], offsets[1:]).view(np.int64)


def classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of every byte range, from 0: made of letters, of digits, or else; up to 3, 6, 9 or more characters."""
    within = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    count = lambda total: total[ends] - total[starts]
    size = ends - starts
    made = np.where(count(within(_LETTER[data])) == size, 0, np.where(count(within(_FIGURE[data])) == size, 1, 2))
    length = np.searchsorted(LENGTHS, count(within((data & 0xC0) != 0x80)))
    return made * (len(LENGTHS) + 1) + length


def class_name(text: F.Column) -> F.Column:
    """The name of the class of a term, e.g. ``word of 7 to 9``."""
    made = F.when(text.rlike(r"^[A-Za-z\x{80}-\x{10FFFF}]+$"), MADE_OF[0]).when(text.rlike("^[0-9]+$"), MADE_OF[1]).otherwise(MADE_OF[2])
    size, low, length = F.length(text), 1, F.lit(f" of {LENGTHS[-1] + 1} or more")
    for high in LENGTHS:
        length = F.when((size >= low) & (size <= high), f" of {low} to {high}").otherwise(length)
        low = high + 1
    return F.concat(made, length)


def class_term(number: np.ndarray) -> np.ndarray:
    """The longs that stand for classes among the terms."""
    return np.iinfo(np.int64).min + 1 + number.astype(np.int64)


_FOUND = ("doc_id long, text_key long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
          "base array<struct<start:long,kind:int,name:string,end:long>>, "
          "entities array<string>, terms array<long>")


def _terms_of(words: list[str]) -> list[int]:
    """Hashes and classes of distinct words."""
    data, offsets = buffer_of(pa.array(words, pa.large_string()))
    return np.unique(np.concatenate([term_hash(words), class_term(classes(data, offsets[:-1], offsets[1:]))])).tolist()


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("name", pa.string()), ("end", pa.int64())]))
    for batch in batches:
        for part in chunks(batch, "text"):
            rows = []
            for text in part.column(2):
                text = text.as_py() or ""
                found = base_spans(text)
                terms = _terms_of(list(free_words(text, found))) if found else []
                rows.append((
                    *(sum(k == kind for k, _, _ in found) for kind in KINDS),
                    hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest(),
                    [{"start": a, "kind": KINDS.index(k), "name": k, "end": b} for k, a, b in found],
                    sorted({f"{k}:{text[a:b].lower()}" for k, a, b in found}), terms,
                ))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string()),
                 pa.array(columns[5], span), pa.array(columns[6], pa.list_(pa.string())), pa.array(columns[7], pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "entities", "terms"])


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, docs): for each batch, in how many of its texts each word occurs."""
    for batch in batches:
        kept, counts = [], []
        for part in chunks(batch, "text"):
            data, offsets = buffer_of(text_column(part, "text"))
            starts, ends, first = spans(data, offsets, NOT_SPACE)
            doc = np.repeat(np.arange(part.num_rows), np.diff(first))
            # the classes of a document's words are among its terms, once each
            own = np.unique(doc * N_CLASSES + classes(data, starts, ends))
            words = np.concatenate([span_hashes(LOWER[data], starts, ends), class_term(own % N_CLASSES).view(np.uint64)])
            doc = np.concatenate([doc, own // N_CLASSES])
            order = np.lexsort((doc, words))
            words, doc = words[order], doc[order]
            fresh = np.ones(len(words), bool)
            fresh[1:] = (words[1:] != words[:-1]) | (doc[1:] != doc[:-1])
            term, n = np.unique(words[fresh], return_counts=True)
            kept.append(term)
            counts.append(n)
        if kept:
            term, place = np.unique(np.concatenate(kept), return_inverse=True)
            total = np.bincount(place, np.concatenate(counts)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(total)], names=["term", "docs"])


def document_frequency(docs: DataFrame) -> DataFrame:
    """(term, docs): in how many rows of ``docs`` each word (by hash) and each class of words occurs."""
    return small_batches(docs).select(F.col("text").cast("string").alias("text")).mapInArrow(_terms, "term long, docs long").groupBy("term").agg(
        F.sum("docs").alias("docs"))


def disclosing_terms(found: DataFrame, frequency: DataFrame, n_docs: int, support: int = SUPPORT) -> DataFrame:
    """(entity, term, strength) of the terms that reveal an identifier at least ``GENERALISE`` of the way.

    Identifiers that stand in the same documents (a list and its copies) have
    the same counts with every term; the smallest of them speaks for all, so a
    list of many identifiers and many terms is not multiplied out.
    """
    # a document counts once for a pair; rows that repeat an id count by their texts
    once = stage(found.where(F.size("entities") > 0).select("doc_id", "text_key", "entities", "terms")
                 .dropDuplicates(["doc_id", "text_key"]).withColumn("doc", F.monotonically_increasing_id()))
    mentions = once.select("doc", F.explode("entities").alias("entity"))
    # two hashes of the documents' ids name the set of documents that an identifier stands in
    sets = [F.bit_xor(F.xxhash64(F.lit(seed), "doc")).alias(f"set{seed}") for seed in (1, 2)]
    entities = mentions.groupBy("entity").agg(F.count("*").alias("has"), *sets).where(F.col("has") >= support)
    entities = entities.groupBy("has", "set1", "set2").agg(F.min("entity").alias("entity")).select("entity", "has")
    mentions = stage(mentions.join(entities, "entity"))
    terms = once.join(mentions.select("doc").distinct(), "doc", "left_semi").select("doc", F.explode("terms").alias("term")).join(
        frequency.where(F.col("docs") >= support), "term")
    n = F.lit(float(max(n_docs, 2)))
    # both <= has, so that a term in more documents than this can't be strong enough
    rare = F.log2("docs") <= (1 - GENERALISE) * F.log2(n) + GENERALISE * F.log2("has") + 1e-9
    both = mentions.join(terms, "doc").where(rare).groupBy("entity", "term").agg(
        F.count("*").alias("both"), F.max("has").alias("has"), F.max("docs").alias("docs")).where(F.col("both") >= support)
    own = F.log2(n / F.col("has"))
    mutual = F.log2(n * F.col("both") / (F.col("docs") * F.col("has")))
    strength = F.when(own > 0, mutual / own).otherwise(F.lit(0.0))
    return both.select("entity", "term", strength.alias("strength")).where(F.col("strength") >= GENERALISE)


def occurrences(rows: DataFrame, strong: DataFrame) -> DataFrame:
    """(doc_id, text_key, start, end, strength, class): where the terms of ``strong(term, strength)`` stand outside of identifiers.

    ``rows(doc_id, text_key, text)``.  Up to TERMS_OUT terms are looked up in
    the tasks; more are joined with all words.
    """
    some = strong.select("term").limit(TERMS_OUT + 1).toArrow().column(0).to_numpy()
    looked_up = np.sort(some) if len(some) <= TERMS_OUT else None

    def stand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = text_column(part, "text")
                data, offsets = buffer_of(texts)
                starts, ends, first = spans(data, offsets, NOT_SPACE)
                words = span_hashes(LOWER[data], starts, ends).view(np.int64)
                if looked_up is None:
                    hit = np.arange(len(words))
                elif len(looked_up):
                    hit = np.flatnonzero(looked_up[np.minimum(np.searchsorted(looked_up, words), len(looked_up) - 1)] == words)
                else:
                    hit = np.zeros(0, np.int64)
                doc = np.searchsorted(first, hit, "right") - 1
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
                low, high = points[starts[hit]] - points[offsets[doc]], points[ends[hit]] - points[offsets[doc]]
                free = np.ones(len(hit), bool)
                edge = np.searchsorted(doc, np.arange(part.num_rows + 1))
                for i in np.flatnonzero(np.diff(edge)).tolist():
                    here = slice(edge[i], edge[i + 1])
                    free[here] = ~_taken(low[here], high[here], base_spans(texts[i].as_py()))
                row = pa.array(doc[free])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(row), part.column(1).take(row), pa.array(words[hit[free]]), pa.array(low[free]), pa.array(high[free]),
                     pa.array(class_term(classes(data, starts[hit[free]], ends[hit[free]])))],
                    names=["doc_id", "text_key", "term", "start", "end", "class"])

    places = rows.mapInArrow(stand, "doc_id long, text_key long, term long, start long, end long, class long")
    return places.join(strong if looked_up is None else F.broadcast(strong), "term").drop("term")


def sanitisation(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ids, counts and hash of the base spans, and all spans.

    spans: array of (start, kind, name, end) sorted by start, kinds in the
    order of ``KINDS``, then ``generalise`` and ``remove`` for terms.  Null
    and empty texts have none; repeated rows each get their row; a null doc_id
    is kept.  Other columns are not read.
    """
    text = F.col("text").cast("string")
    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    found = stage(rows.mapInArrow(_find, _FOUND))
    n_docs = found.count()
    strong = stage(disclosing_terms(found, document_frequency(docs), n_docs).groupBy("term").agg(F.max("strength").alias("strength")))
    # classes that reveal an identifier themselves: a term is not generalised to one of them
    telling = [r.term for r in strong.where(F.col("term") <= class_term(np.array(N_CLASSES)).item()).collect()]
    removed = (F.col("strength") >= REMOVE) | F.col("class").isin(telling)
    terms = occurrences(rows, strong).groupBy(F.col("doc_id").alias("t_id"), F.col("text_key").alias("t_key")).agg(
        F.collect_set(F.struct(
            "start", F.when(removed, 5).otherwise(4).alias("kind"),
            F.when(removed, "remove").otherwise("generalise").alias("name"), "end")).alias("terms"))
    same = F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("text_key") == F.col("t_key"))
    none = F.array().cast("array<struct<start:long,kind:int,name:string,end:long>>")
    return found.drop("entities", "terms").join(terms, same, "left").select(
        "doc_id", "text_key", "n_email", "n_ip", "n_card", "n_phone", "base_sha256",
        F.sort_array(F.concat("base", F.coalesce("terms", none))).alias("spans"))


def span_text() -> F.Column:
    """``spans`` as kind:start:end, comma-joined."""
    return F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


def _piece(text: F.Column, span: F.Column) -> F.Column:
    return F.substring(text, (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int"))


def sanitised(docs: DataFrame) -> DataFrame:
    """``docs`` with all columns, each span of ``text`` replaced by its kind in brackets.

    Removed terms are cut out, generalised ones give way to the name of their class.

    Null and empty texts and texts without spans stay as they are; repeated
    rows are treated alike, rows without an id too; an empty table gives no rows.
    """
    found = sanitisation(docs).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("spans").alias("__spans")).dropDuplicates(["__id", "__key"])
    text = F.col("text").cast("string")
    joined = docs.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__key")), "left")
    # pieces between spans; a span that begins inside an earlier one replaces only what follows it
    state = F.aggregate(
        "__spans", F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.greatest(x["start"] - s["at"], F.lit(0)).cast("int")),
                     F.when(x["name"] == "remove", "")
                     .when(x["name"] == "generalise", F.concat(F.lit("["), class_name(_piece(text, x)), F.lit("]")))
                     .otherwise(F.concat(F.lit("["), F.upper(x["name"]), F.lit("]")))).alias("out")))
    rest = F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))
    return joined.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(rest)).select(docs.columns)
