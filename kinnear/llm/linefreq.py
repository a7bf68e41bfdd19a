"""Cross-document line frequency within a host (DataFrame functions only).

A line is normalised to its letters in lower case, one without letters to what
stands between its blanks, and hashed.  Lines found in too many distinct
documents of one host are boilerplate: they are removed, and a document left
with too little of itself is rejected, as is one that fails the base rules on
length and repetition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinnear.llm.tables import stage

#: A line is too frequent in more than this share of its host's documents, but not in LEAST_DOCS or fewer,
#: and in more than MOST_DOCS whatever the share, so a large host is not exempt.
LEAST_DOCS, DOC_SHARE, MOST_DOCS = 25, 0.05, 100
#: At least this share of a document's line characters must remain.
LEFT = 0.5
#: Base rules: fewest words; largest percentage of words in repeated 3-word windows.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Words of a text from which windows are compared by their whole hash.
LONG_TEXT = 1 << 14

_BLANKS = r"[\x20\x09-\x0D]+"


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, _BLANKS), "")


def repeated_words(words: Column, n: Column) -> Column:
    """How many words lie in a 3-word window that occurs twice or more.

    Hash and place of each window are packed into one long (the hash taken
    modulo 2**62 / n), so one sort of longs brings equal windows together with
    their places.  Two different windows of a text of n words are taken for
    equal with a probability under n**3 / 2**62, 1 in 10**6 at LONG_TEXT words;
    longer texts sort structs of whole hash and place, under n**2 / 2**64.
    """
    window = lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    long_n = F.greatest(n, F.lit(1)).cast("long")
    room = F.floor(F.lit(2**62) / long_n).cast("long")
    packed = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.coalesce(F.pmod(window(i), room) * long_n + i, F.lit(0).cast("long")),
    )
    whole = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(window(i).alias("hash"), i.cast("long").alias("place")))
    return (
        F.when(n > LONG_TEXT, _covered_whole(F.sort_array(whole)))
        .when(n >= 4, _covered(F.sort_array(packed), long_n)).otherwise(F.lit(0).cast("long"))
    )


def _covered(ordered: Column, n: Column) -> Column:
    """Words covered by the windows that share their hash with a neighbour in the sorted array."""
    places = F.transform(
        F.array(ordered),  # names the sorted array once
        lambda a: F.sort_array(F.transform(
            F.filter(a, lambda x, i: (_hash(F.get(a, i - 1), n) == _hash(x, n)) | (_hash(F.get(a, i + 1), n) == _hash(x, n))),
            lambda x: x % n)),
    )
    return _words_at(places)


def _covered_whole(ordered: Column) -> Column:
    """``_covered`` for sorted structs (hash, place)."""
    return _words_at(F.transform(
        F.array(ordered),
        lambda a: F.sort_array(F.transform(
            F.filter(a, lambda x, i: F.get(a, i - 1)["hash"].eqNullSafe(x["hash"]) | F.get(a, i + 1)["hash"].eqNullSafe(x["hash"])),
            lambda x: x["place"]))))


def _words_at(places: Column) -> Column:
    """Words covered by the windows at the sorted places, given as an array of one array."""
    return F.aggregate(
        places, F.lit(0).cast("long"),
        lambda total, p: total + F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(3).cast("long"), F.coalesce(F.get(p, i + 1) - x, F.lit(3).cast("long")))),
            F.lit(0).cast("long"), lambda s, x: s + x))


def _hash(packed: Column, n: Column) -> Column:
    """The packed value without its place (integer arithmetic only); null stays unequal to any."""
    return F.coalesce(packed - packed % n, F.lit(-1).cast("long"))


def _normalised(line: Column) -> Column:
    letters = F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}]+", " "))
    return F.when(letters != "", letters).otherwise(F.regexp_replace(line, rf"^{_BLANKS}|{_BLANKS}$", ""))


def document_table(docs: DataFrame) -> DataFrame:
    """One row a row of ``docs``: ids, host, base statistics and the lines as (hash, characters)."""
    rows = docs.select(
        "doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("host"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("words", word_array(F.col("text"))).withColumn(
        "lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    n = F.size("words")
    return rows.select(
        "doc_id", "host", F.xxhash64("text").alias("text_key"),
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size(F.regexp_extract_all("text", F.lit("[#*$%&|<>]"), F.lit(0))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words"), n).alias("n_repeat_words"),
        F.transform("lines", lambda x: F.struct(F.xxhash64(_normalised(x)).alias("line"), F.length(x).alias("chars"))).alias("lines"),
    )


def frequent_lines(table: DataFrame) -> DataFrame:
    """(host, line) of the lines above the limit, from a document table."""
    seen = table.select("host", "doc_id", F.explode("lines.line").alias("line")).groupBy("host", "line", "doc_id").agg(F.lit(1).alias("one"))
    counts = seen.groupBy("host", "line").agg(F.count("*").alias("docs"))
    hosts = table.groupBy("host", "doc_id").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("all_docs"))
    limit = F.least(F.greatest(F.lit(float(LEAST_DOCS)), DOC_SHARE * F.col("all_docs")), F.lit(float(MOST_DOCS)))
    return counts.where(F.col("docs") > LEAST_DOCS).join(hosts, "host").where(F.col("docs") > limit).select("host", "line")


def line_rules(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ids, base statistics, removed (array of line hashes), base_failed, kept.

    Null and empty texts have no words and fail the base rule; a null source
    is a host of its own; repeated rows each get their row; rows that repeat
    an id are one document for the counts, rows without one too.  Other
    columns are not read.
    """
    table = stage(document_table(docs))
    lines = table.select("doc_id", "text_key", "host", F.explode("lines").alias("l")).select("doc_id", "text_key", "host", "l.line", "l.chars")
    # sums over the document's rows and divided by how often it is there, so that repeated rows don't count twice
    removed = (
        lines.join(frequent_lines(table), ["host", "line"])
        .groupBy(F.col("doc_id").alias("r_id"), F.col("text_key").alias("r_key"), F.col("host").alias("r_host"))
        .agg(F.sum("chars").alias("gone"), F.collect_set("line").alias("removed"))
    )
    copies = table.groupBy("doc_id", "text_key", "host").agg(F.count("*").alias("copies")).where("copies > 1").select(
        F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), F.col("host").alias("c_host"), "copies")
    same = lambda p: (
        F.col("doc_id").eqNullSafe(F.col(f"{p}_id")) & (F.col("text_key") == F.col(f"{p}_key")) & (F.col("host") == F.col(f"{p}_host")))
    total = F.aggregate("lines", F.lit(0).cast("long"), lambda s, x: s + x.chars)
    gone = F.coalesce(F.col("gone") / F.coalesce("copies", F.lit(1)), F.lit(0.0))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (
        table.join(removed, same("r"), "left").join(copies, same("c"), "left")
        .select(
            "doc_id", "text_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            F.coalesce("removed", F.array().cast("array<long>")).alias("removed"),
            failed.alias("base_failed"),
            (~failed & (total - gone >= LEFT * total)).alias("kept"),
        )
    )


def clean_documents(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs`` (all columns), their too frequent lines taken out of ``text``.

    Odd rows as in :func:`line_rules`: null and empty texts fail the base rule
    and go; rows that repeat an id and text are kept or go together.
    """
    kept = line_rules(docs).where("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("removed").alias("__removed")).dropDuplicates(["__id", "__key"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rest = F.array_join(
        F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(F.col("__removed"), F.xxhash64(_normalised(x)))), "\n")
    joined = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__key")))
    return joined.withColumn("text", F.when(F.size("__removed") > 0, rest).otherwise(F.col("text"))).select(docs.columns)
