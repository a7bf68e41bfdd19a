"""Rating sources: delimited text, duplicate policy, hold-out split, and a
rating table derived from the order tables.

Text input follows the reference's format: one ``user SEP item SEP rating
[SEP ...]`` line per rating, no header, separator a (Java) regular
expression, each field trimmed, fields after the third ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

RATINGS_SCHEMA = "user long, item long, rating double"
#: Rows a task sorts or groups, where the tables are dealt by their rows.
TASK_ROWS = 1_000_000


# --------------------------------------------------------------------------
# A1 / A2: delimited text
# --------------------------------------------------------------------------


def _sep_regex(sep: str, literal: bool) -> str:
    return "\\Q" + sep + "\\E" if literal else sep


def _typed(lines: DataFrame, sep: str, literal: bool, column: str) -> DataFrame:
    parts = F.split(F.col(column), _sep_regex(sep, literal))

    def field(i: int) -> Column:
        return F.trim(F.try_element_at(parts, F.lit(i)))

    typed = lines.select(
        F.col(column).alias("_line"),
        field(1).try_cast("long").alias("user"),
        field(2).try_cast("long").alias("item"),
        field(3).try_cast("double").alias("rating"),
    )
    bad = F.col("user").isNull() | F.col("item").isNull() | F.col("rating").isNull()
    return typed.withColumn("_bad", bad)


def parse_lines(
    lines: DataFrame,
    sep: str = "\t",
    literal: bool = False,
    mode: str = "strict",
    column: str = "value",
) -> DataFrame:
    """Parse text lines into ``user, item, rating``.

    ``mode="strict"`` fails the job on a malformed line, as the reference
    does; ``mode="lenient"`` drops such lines (count them with
    :func:`count_rejected`).
    """
    typed = _typed(lines, sep, literal, column)
    if mode == "lenient":
        return typed.where(~F.col("_bad")).select("user", "item", "rating")
    if mode != "strict":
        raise ValueError(f"unknown mode {mode!r}")
    check = F.when(
        F.col("_bad"), F.raise_error(F.concat(F.lit("malformed rating line: "), F.col("_line")))
    )
    return typed.select(
        F.coalesce(check.cast("long"), F.col("user")).alias("user"), "item", "rating"
    )


def count_rejected(
    lines: DataFrame, sep: str = "\t", literal: bool = False, column: str = "value"
) -> DataFrame:
    """One row ``rejected``: lines that :func:`parse_lines` would drop."""
    return _typed(lines, sep, literal, column).agg(
        F.sum(F.col("_bad").cast("long")).alias("rejected")
    )


def read_ratings(
    spark: SparkSession,
    path: str,
    sep: str = "\t",
    literal: bool = False,
    mode: str = "strict",
) -> DataFrame:
    """Read a delimited rating file (or directory of files)."""
    return parse_lines(spark.read.text(path), sep, literal, mode)


def read_ratings_counted(
    spark: SparkSession, path: str, sep: str = "\t", literal: bool = False, name: str = "ratings"
) -> tuple[DataFrame, Observation]:
    """The well-formed ratings of a delimited file, and what the reading pass saw.

    The observation has ``lines`` and ``rejected``; they are filled in by the
    first action on the ratings, so counting costs no scan of its own.
    """
    seen = Observation(name)
    typed = _typed(spark.read.text(path), sep, literal, "value").observe(
        seen, F.count(F.lit(1)).alias("lines"), F.coalesce(F.sum(F.col("_bad").cast("long")), F.lit(0)).alias("rejected"))
    return typed.where(~F.col("_bad")).select("user", "item", "rating"), seen


def read_ratings_csv(spark: SparkSession, path: str, sep: str = "\t", mode: str = "strict") -> DataFrame:
    """Read a delimited rating file with the CSV source; ``sep`` is literal, of one or more characters.

    The schema is applied while reading and blanks around fields are dropped;
    fields after the third are ignored.  ``mode`` as in :func:`parse_lines`;
    lines without any character are skipped by the source in both modes.
    """
    rows = spark.read.csv(
        path, schema="user long, item long, rating double, _line string", sep=sep, quote="", escape="", mode="PERMISSIVE",
        ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, columnNameOfCorruptRecord="_line")
    bad = F.col("user").isNull() | F.col("item").isNull() | F.col("rating").isNull()
    if mode == "lenient":
        return rows.where(~bad).select("user", "item", "rating")
    if mode != "strict":
        raise ValueError(f"unknown mode {mode!r}")
    check = F.when(bad, F.raise_error(F.concat(F.lit("malformed rating line: "), F.coalesce("_line", F.lit("")))))
    return rows.select(F.coalesce(check.cast("long"), F.col("user")).alias("user"), "item", "rating")


def write_split(ratings: DataFrame, folder: str, sep: str = "\t") -> None:
    """Splits ratings with an ``is_test`` flag into delimited train and test files, in one pass.

    The sides are the partitions ``side=train`` and ``side=test`` of the
    folder; any further columns follow the rating.
    """
    fields = ["user", "item", "rating"] + [c for c in ratings.columns if c not in ("user", "item", "rating", "is_test")]
    line = F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields])
    ratings.select(line.alias("value"), F.when(F.col("is_test"), "test").otherwise("train").alias("side")).write.partitionBy("side").text(folder)


def read_split(spark: SparkSession, folder: str, side: str, sep: str = "\t", mode: str = "strict") -> DataFrame:
    """One side of :func:`write_split`; the other side's files are pruned."""
    lines = spark.read.schema("value string, side string").text(folder).where(F.col("side") == side)
    return parse_lines(lines.select("value"), sep, literal=True, mode=mode)


# --------------------------------------------------------------------------
# A4: repeated (user, item)
# --------------------------------------------------------------------------


def coalesce_duplicates(ratings: DataFrame, policy: str = "sum") -> DataFrame:
    """One row per ``(user, item)``.

    ``sum`` is what a sparse-matrix builder does with repeated entries;
    ``max`` and ``mean`` are alternatives; ``error`` fails the job when a
    pair repeats.
    """
    g = ratings.groupBy("user", "item")
    if policy == "sum":
        return g.agg(F.sum("rating").alias("rating"))
    if policy == "max":
        return g.agg(F.max("rating").alias("rating"))
    if policy == "mean":
        return g.agg((F.sum("rating") / F.count("rating")).alias("rating"))
    if policy == "error":
        agg = g.agg(F.count(F.lit(1)).alias("_n"), F.max("rating").alias("rating"))
        check = F.when(
            F.col("_n") > 1,
            F.raise_error(
                F.concat(
                    F.lit("duplicate rating for user "),
                    F.col("user").cast("string"),
                    F.lit(", item "),
                    F.col("item").cast("string"),
                )
            ),
        )
        return agg.select(
            "user", "item", F.coalesce(check.cast("double"), F.col("rating")).alias("rating")
        )
    raise ValueError(f"unknown duplicate policy {policy!r}")


def dealt(tables: list[DataFrame], *keys: list[str]) -> list[DataFrame]:
    """Tables dealt by their ``keys`` into the same number of tasks, about TASK_ROWS rows of the largest in each.

    For joins and aggregates with nearly as many groups as rows: adaptive
    execution merges partitions by their compressed bytes, which tell little
    of the rows a task sorts or the groups it holds.  Hand in tables whose
    rows are cheap to count.
    """
    parts = max(1, math.ceil(max(t.count() for t in tables) / TASK_ROWS))
    return [t.repartition(parts, *k) for t, k in zip(tables, keys, strict=True)]


def duplicate_stats(ratings: DataFrame) -> DataFrame:
    """``user, item, n, r_sum, r_max, r_mean`` for every stored pair."""
    return ratings.groupBy("user", "item").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("rating").alias("r_sum"),
        F.max("rating").alias("r_max"),
        (F.sum("rating") / F.count("rating")).alias("r_mean"),
    )


# --------------------------------------------------------------------------
# A5: train / test split
# --------------------------------------------------------------------------


def default_split_key() -> Column:
    """Deterministic per-cell order used by the hold-out: same in any engine, no overflow for any id."""
    return ((F.col("user") % 1009) * 31 + (F.col("item") % 1009) * 17) % 1009


def holdout_split(ratings: DataFrame, n: int = 2, key: Column | None = None) -> DataFrame:
    """Mark the first ``n`` cells of each user (by ``key``, then item) as test.

    Users with ``n`` or fewer cells keep everything in train.  Output:
    ratings' columns plus ``is_test`` (boolean); rows that repeat a
    ``(user, item)`` are one cell and share its flag.

    Skew-safe: the per-user top-n is a ``row_number() <= n`` filter, which
    Spark evaluates with a group limit before and after the shuffle, so a
    user with a huge number of ratings contributes only ``n`` rows per map
    task; per-user counts are partial aggregates; the flags are joined
    back on the unique ``(user, item)`` key.
    """
    key = default_split_key() if key is None else key
    cells = ratings.groupBy("user", "item").agg(F.min(key).alias("_k"))
    keyed = cells.select("user", "item", "_k")
    w = Window.partitionBy("user").orderBy(F.col("_k"), F.col("item"))
    held = keyed.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    counts = cells.groupBy("user").agg(F.count(F.lit(1)).alias("_cnt")).where(F.col("_cnt") > n)
    held = held.join(counts, "user", "left_semi").select("user", "item", F.lit(True).alias("_t"))
    return ratings.join(held, ["user", "item"], "left").select(
        *ratings.columns, F.coalesce(F.col("_t"), F.lit(False)).alias("is_test")
    )


# --------------------------------------------------------------------------
# ratings derived from the order tables
# --------------------------------------------------------------------------


def order_lines(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One rating per order line: ``user, item, rating, is_test``.

    user = ordering customer, item = part, rating = quantity bucketed to
    1..5 (quantity 1-10 → 1, ..., 41-50 → 5), test flag from the line key.
    """
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    o = orders.select("o_orderkey", "o_custkey")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        (F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10)).cast("double").alias("rating"),
        (((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 5) == 0).alias("is_test"),
    )


def order_ratings(lineitem: DataFrame, orders: DataFrame, parts: int | None = None) -> DataFrame:
    """One row per (customer, part): max rating, test if any line is test; in ``parts`` by user if given."""
    lines = order_lines(lineitem, orders)
    if parts:
        lines = lines.repartition(parts, "user")
    return (
        lines
        .groupBy("user", "item")
        .agg(F.max("rating").alias("rating"), F.bool_or("is_test").alias("is_test"))
    )


def load_tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all ratings, train, test) from the order tables under ``sf_dir``."""
    lineitem, orders = load_tables(spark, sf_dir, "lineitem", "orders")
    r = order_ratings(lineitem, orders)
    return r, *by_flag(r)


def by_flag(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(train, test) of ratings with an ``is_test`` flag."""
    return tuple(ratings.where(keep).select("user", "item", "rating") for keep in (~F.col("is_test"), F.col("is_test")))


def nation_ratings(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """``user, item, rating`` with the customer's nation as user: few users, each with very many cells."""
    li = lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    o = orders.select("o_orderkey", "o_custkey").join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    rating = (F.lit(1) + F.floor((F.col("l_quantity") - 1) / 10)).cast("double")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(
        F.col("c_nationkey").cast("long").alias("user"), F.col("l_partkey").alias("item")).agg(F.max(rating).alias("rating"))


def early_split(lineitem: DataFrame, orders: DataFrame, days: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) cells ``user, item``: order lines of the first ``days`` days, and all later ones."""
    first = orders.agg(F.min("o_orderdate").alias("first"))  # one row
    dated = orders.select("o_orderkey", "o_custkey", "o_orderdate").join(F.broadcast(first)).select(
        "o_orderkey", "o_custkey", (F.col("o_orderdate").cast("date") < F.date_add(F.col("first").cast("date"), days)).alias("early"))
    cells = lineitem.select("l_orderkey", "l_partkey").join(dated, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item"), "early")
    return tuple(cells.where(keep).select("user", "item").distinct() for keep in (F.col("early"), ~F.col("early")))
