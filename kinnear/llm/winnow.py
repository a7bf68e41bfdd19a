"""Benchmark decontamination by winnowed fingerprints (DataFrame functions only).

Both sides keep, for every window of 13 words, the leftmost smallest of its
nine hashes of 5 consecutive words.  Texts that share 13 consecutive words
share that hash at the same place of the window, so the join on fingerprints
finds every shared span.  A hit is extended word by word, as far as a window
that holds the hashed words can reach; 13 equal words or more are a match.

Items of fewer than 13 words are one window of their own length; there is one
more pass over the documents for each such length, and none if all items are
longer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words in a window, words in a hashed gram, grams in a window.
WINDOW, GRAM = 13, 5
GRAMS = WINDOW - GRAM + 1
#: A document is contaminated if hit words are at least 1 in this many.
ONE_IN = 20
#: The benchmark is broadcast up to this many bytes of text, joined beyond.
BROADCAST_BYTES = 8 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; ``lower`` does just that to texts of ASCII only."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def word_array(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text.cast("string"), F.lit(""))), _BETWEEN), "")


def _gram(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(size)])


def _grams(words: Column) -> Column:
    n = F.size(words)
    return F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - GRAM), lambda i: _gram(words, i, GRAM)))


def _least(grams: Column, at: Column) -> Column:
    return F.least(*[F.get(grams, at + j) for j in range(GRAMS)])


def _selected(texts: DataFrame, keys: list[str], carrier: bool) -> DataFrame:
    """Rows (keys, words, i, fp, at) of the fingerprints winnowing selects; with ``carrier`` one row more a text (i = -1)."""
    lowest = -1 if carrier else 0
    n = F.size("words")
    every = F.when(n >= WINDOW, F.sequence(F.lit(lowest), n - WINDOW)).otherwise(F.array(F.lit(-1)) if carrier else F.array().cast("array<int>"))
    rows = texts.withColumn("grams", _grams(F.col("words"))).select(*keys, "words", "grams", F.explode(every).alias("i"))
    i, grams = F.col("i"), F.col("grams")
    now, before = _least(grams, i), _least(grams, i - 1)
    moved = (i == 0) | (now != before) | (F.get(grams, i - 1) == before)
    rows = rows.withColumn("fp", F.when(i >= 0, now)).where((i == -1) | moved)
    place = F.when(F.get(grams, i) == F.col("fp"), i)  # the leftmost; plain comparisons compile far better than slices
    for j in range(1, GRAMS):
        place = place.when(F.get(grams, i + j) == F.col("fp"), i + j)
    return rows.select(*keys, "words", "i", "fp", place.alias("at"))


def _reach(words: Column, at: Column) -> Column:
    """(at, words): the words that windows around the gram at ``at`` can hold, and the gram's place among them."""
    begin = F.greatest(at - (WINDOW - GRAM), F.lit(0))
    return F.struct((at - begin).alias("at"), F.slice(words, begin + 1, at - begin + WINDOW).alias("words"))


def _extended(rows: DataFrame) -> DataFrame:
    """Hits ``near`` - ``facing`` as word ranges ``s`` to ``e`` of the document, where they reach 13 words.

    The lambdas aren't compiled into the stage before, whose code would get
    too large for the JIT; there are few hits.
    """
    near, facing = F.col("near"), F.col("facing")

    def equal(step: int, first: int, most: int) -> Column:
        """Equal words in a row from the gram, in one direction."""
        unlike = lambda j: ~F.coalesce(
            F.get(near["words"], near["at"] + step * j) == F.get(facing["words"], facing["at"] + step * j), F.lit(False))
        return F.array_min(F.filter(F.array(*[F.lit(j) for j in range(first, most + 1)]), lambda j: (j == most) | unlike(j))) - first

    right, left = equal(1, 0, WINDOW), equal(-1, 1, WINDOW - GRAM + 1)
    rows = rows.withColumn("s", F.when(near.isNotNull(), F.col("at") - left)).withColumn("e", F.when(near.isNotNull(), F.col("at") + right))
    match = (F.col("e") - F.col("s") >= WINDOW) & (F.col("e") - F.col("at") >= GRAM)
    # rows without a match stay: a filter here would be pushed below, into the compiled stage
    return rows.select("doc_id", "text_key", "n_words", *[F.when(match, F.col(c)).alias(c) for c in ("ids", "s", "e")])


def contamination(docs: DataFrame, benchmark: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_words, n_hit, items, contaminated.

    ``docs(doc_id, text)``, ``benchmark(item_id, text)``; other columns are
    not read.  Null and empty texts have no words and are clean; an item
    without words has no window; repeated rows each get their row; items with
    a null id hit but are not listed.  ``text_key`` is the text's hash, which
    with doc_id tells rows apart that repeat an id.  items: sorted ids.
    """
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"), word_array(F.col("text")).alias("item")
    ).where(F.size("item") > 0).groupBy("item").agg(F.collect_set("item_id").alias("ids"))
    known = benchmark.select(F.sum(F.octet_length(F.col("text").cast("string"))).alias("bytes")).first().bytes or 0
    small = known <= broadcast_bytes
    short = sorted(r.n for r in items.where(F.size("item") < WINDOW).select(F.size("item").alias("n")).distinct().collect())

    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_key"), word_array(F.col("text")).alias("words"))
    seeds = _selected(items.select("ids", F.col("item").alias("words")), ["ids"], False).select(
        F.col("fp").alias("item_fp"), "ids", _reach(F.col("words"), F.col("at")).alias("facing"))
    seeds = seeds.groupBy("item_fp", "facing").agg(F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids"))
    selected = _selected(texts, ["doc_id", "text_key"], True)
    if small:
        met = selected.join(F.broadcast(seeds), F.col("fp") == F.col("item_fp"), "left")
        met = met.where((F.col("i") == -1) | F.col("facing").isNotNull())
        rows = _extended(met.select(
            "doc_id", "text_key", F.when(F.col("i") == -1, F.size("words")).alias("n_words"), "at", "ids", "facing",
            F.when(F.col("facing").isNotNull(), _reach(F.col("words"), F.col("at"))).alias("near")))
    else:
        # no words travel with the fingerprints; documents with a hit are read again
        hits = selected.where("i >= 0").select(F.col("doc_id").alias("h_id"), F.col("text_key").alias("h_key"), "fp", "at").join(
            seeds, F.col("fp") == F.col("item_fp")).select("h_id", "h_key", "at", "ids", "facing").distinct()
        met = texts.join(hits, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_key") == F.col("h_key")))
        rows = _extended(met.select("doc_id", "text_key", F.lit(None).cast("int").alias("n_words"), "at", "ids", "facing",
                                    _reach(F.col("words"), F.col("at")).alias("near")))
        rows = rows.unionByName(texts.select("doc_id", "text_key", F.size("words").alias("n_words")), allowMissingColumns=True)
    # a range counts once however many fingerprints find it
    rows = rows.groupBy("doc_id", "text_key", "ids", "s", "e").agg(F.count("n_words").alias("copies"), F.max("n_words").alias("n_words"))
    spread = F.broadcast if small else (lambda x: x)
    for size in short:
        rows = rows.unionByName(_short_hits(texts, items, size, spread))
    return _totals(rows)


def _short_hits(texts: DataFrame, items: DataFrame, size: int, spread) -> DataFrame:
    """Occurrences of the items of exactly ``size`` words."""
    of_size = items.where(F.size("item") == size).withColumn("item_fp", _gram(F.col("item"), F.lit(0), size))
    starts = texts.where(F.size("words") >= size).select(
        "doc_id", "text_key", "words", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("s"))
    starts = starts.select("doc_id", "text_key", "s", F.slice("words", F.col("s") + 1, size).alias("span"), _gram(F.col("words"), F.col("s"), size).alias("fp"))
    return starts.join(spread(of_size), (F.col("fp") == F.col("item_fp")) & (F.col("span") == F.col("item"))).select(
        "doc_id", "text_key", "ids", "s", (F.col("s") + size).alias("e"), F.lit(0).cast("long").alias("copies"), F.lit(None).cast("int").alias("n_words"))


def _totals(rows: DataFrame) -> DataFrame:
    """One row a document from its carrier row and its hits, as often as the document is there."""
    per_doc = rows.groupBy("doc_id", "text_key").agg(
        F.sum("copies").alias("copies"),
        F.coalesce(F.max("n_words"), F.lit(0)).cast("long").alias("n_words"),
        F.collect_set(F.when(F.col("s").isNotNull(), F.struct("s", "e"))).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items"),
    )
    covered = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["s"], h["e"] - 1))))
    per_doc = per_doc.withColumn("n_hit", F.size(covered).cast("long"))
    return per_doc.select(
        "doc_id", "text_key", "n_words", "n_hit", "items",
        ((F.col("n_hit") > 0) & (F.lit(ONE_IN) * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).drop("copy")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated.

    Null and empty texts have no words and stay; repeated rows stay or go
    together, rows that repeat an id by their own texts, rows without an id
    too; an empty benchmark keeps everything.
    """
    bad = contamination(docs, benchmark).where("contaminated").select(
        F.col("doc_id").alias("__bad_id"), F.col("text_key").alias("__bad_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__bad_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__bad_key"))
    return docs.join(bad, same, "left_anti")
