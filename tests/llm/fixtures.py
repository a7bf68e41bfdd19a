"""Small documents with the cases every operator must define, and helpers to compare."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, label double, words string, node long, score int"


def prose(n: int, seed: int) -> str:
    r = random.Random(seed)
    parts = ["ta", "re", "mi", "lo", "qu", "é", "ñ", "ing", "the", "of"]
    return " ".join("".join(r.choices(parts, k=r.randint(1, 4))) + r.choice(["", "", "", ".", ",\n", "!"]) for _ in range(n))


PASSAGE = prose(70, 77)
ITEM = prose(30, 78)

TEXTS = [
    None,
    "",
    "   \n\t ",
    "one two",
    "One TWO three four five SIX seven eight nine ten eleven twelve thirteen fourteen",
    prose(120, 1),
    prose(120, 1),
    prose(120, 1) + " more",
    prose(400, 2),
    prose(60, 3) + "\n" + PASSAGE + "\n" + prose(50, 4),
    prose(80, 5) + "\n" + PASSAGE + "\n" + prose(30, 6),
    prose(20, 7) + " " + ITEM + " " + prose(10, 8),
    "word " * 3000,
    "éÉ ÀB c d \x1cx\x0by\x0cz \x85 İi ß ẞ \U0001F600 ok",
    "Licensed under the Apache License, Version 2.0. All rights reserved. cc by CC-BY cc  by",
    "This work is licensed under the GNU General Publik License, version 3. general public license",
    "mail a.b%c@x-1.example.com, 10.0.0.256 10.1.2.3 1.2.3.4.5.6.7.8 card 4111 1111 1111 1111 or 4111-1111-1111-1112 "
    "call +1 (555) 010-9999 or +12 3 @home x@y a@b@c.d.e 0001.02.3.4",
    "the <|endoftext|> a<|startoftext|>B don't DON'T 'S 12ab3 a1.b2 x...y--z it's.. \"q\" #$%&|<>*",
    prose(2, 9),
    "aaaa" * 30000,
    "1" * 5000 + "@" * 50 + "+" * 50 + "1.2.3." * 300,
    ". ".join(["same line here\nsame line here", "same line here"] * 40),
]


def documents(spark):
    """The texts above with an id each, a repeated row, a null id and columns whose names clash."""
    rows = [(i * 3 + 1, t, "en" if i % 3 else None, f"src{i % 4}" if i % 5 else None) for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[0], (None, prose(120, 1), "fr", "src1"), (None, None, None, None), (4, prose(33, 12), "en", "src2")]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "x", 0.5, "w", 1, 2) for r in rows], SCHEMA).repartition(3)


def rows_of(df, *columns):
    """All rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def collected(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def blank_words(text):
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z lower-cased."""
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def alnum_words(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def fold(doc_id):
    import zlib

    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5


def no_rows(spark):
    return spark.createDataFrame([], SCHEMA)


def given(spark, name, sf_dir="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").withColumn("extra", F.lit(1))
