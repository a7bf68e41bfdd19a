"""Allow and block rules for URLs, looked up by short hash prefixes.

A rule ``(host, path, verdict)`` fits a URL whose host is the rule's or a
subdomain of it and whose path starts with the rule's path.  Each URL is
expanded into expressions, a suffix of its host followed by a prefix of its
path; an expression meets the rules in an equi-join on the first 32 bits of
its SHA-256, the full digest confirms the meeting, and the longest confirmed
rule gives the verdict.

Only expressions of a form that some rule has are made: so many labels, so
many slashes (rules that end in a slash), so many characters (others).  These
numbers are read from the rules once; each is at most the longest rule.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinnear.llm.tables import stage

#: Hex digits of the digest that the join compares.
SHORT = 8
#: Rules up to so many bytes of text are broadcast; more are joined by shuffle.
BROADCAST_BYTES = 8 << 20
#: Copies of each rule in the shuffled join: a rule that fits a third of all URLs is met in so many tasks.
SALTS = 16
#: What a URL gets that no rule fits.
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null and without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(text, _URL, 1), _UPPER, _LOWER), F.regexp_extract(text, _URL, 2)


@dataclass(frozen=True)
class Forms:
    """The shapes that rules have, and their size."""

    labels: list[int]
    slashes: list[int]
    lengths: list[int]
    bytes: int

    @classmethod
    def of(cls, rules: DataFrame) -> Forms:
        slash = F.col("path").endswith("/")
        one = rules.agg(
            F.sort_array(F.collect_set(F.size(F.split("host", "[.]")))).alias("labels"),
            F.sort_array(F.collect_set(F.when(slash, F.size(F.split("path", "/")) - 1))).alias("slashes"),
            F.sort_array(F.collect_set(F.when(~slash, F.length("path")))).alias("lengths"),
            F.coalesce(F.sum(F.octet_length("rule") + F.octet_length("verdict") + 64), F.lit(0)).alias("bytes")).first()
        return cls(list(one.labels), list(one.slashes), list(one.lengths), int(one.bytes))


def canonical(rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict, digest) of the rules that can fit a URL.

    Host A-Z lower-cased, a null path is empty; rules with a null or empty
    host, a null verdict, or a path that starts otherwise than with ``/`` fit
    nothing and go.  Repeated rules count once; a rule with two verdicts has
    the greater one by string order, so ``block`` comes before ``allow``.
    """
    cleaned = rules.select(
        F.translate(F.col("host").cast("string"), _UPPER, _LOWER).alias("host"),
        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"), F.col("verdict").cast("string").alias("verdict"))
    able = cleaned.where((F.col("host") != "") & F.col("verdict").isNotNull() & ((F.col("path") == "") | F.col("path").startswith("/")))
    one = able.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rule = F.concat("host", "path")
    return one.select("host", "path", rule.alias("rule"), "verdict", F.sha2(rule, 256).alias("digest"))


def expressions(host: Column, path: Column, forms: Forms) -> Column:
    """All expressions of a URL that have one of the forms: array<string>."""
    ints = lambda values: F.array(*[F.lit(v) for v in values]).cast("array<int>")
    labels, slashes = F.size(F.split(host, "[.]")), F.size(F.split(path, "/")) - 1
    suffixes = F.transform(F.filter(ints(forms.labels), lambda k: k <= labels), lambda k: F.call_function("substring_index", host, F.lit("."), -k))
    prefixes = F.concat(
        F.transform(F.filter(ints(forms.slashes), lambda k: k <= slashes), lambda k: F.concat(F.call_function("substring_index", path, F.lit("/"), k), F.lit("/"))),
        F.transform(F.filter(ints(forms.lengths), lambda k: k <= F.length(path)), lambda k: F.substring(path, F.lit(1), k)))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def fitting_rules(addresses: DataFrame, rules: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(host, path, rule, verdict): the longest rule that fits each of the distinct ``addresses(host, path)``.

    Rules of one length: the one with the longer host.  Addresses without a
    fitting rule have no row; no rules: no rows.
    """
    rules = canonical(rules)
    forms = Forms.of(rules)
    buckets = rules.groupBy(F.substring("digest", 1, SHORT).alias("short")).agg(  # rules of one short hash: about one
        F.collect_list(F.struct("digest", F.length("rule").alias("length"), F.length("host").alias("labels"), "rule", "verdict")).alias("bucket"))
    asked = addresses.select("host", "path", F.explode(expressions(F.col("host"), F.col("path"), forms)).alias("expression"))
    asked = asked.withColumn("short", F.substring(F.sha2("expression", 256), 1, SHORT))
    if forms.bytes <= broadcast_bytes:
        met = asked.join(F.broadcast(buckets), "short")
    else:
        salted = buckets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = asked.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int")).join(salted, ["short", "salt"])
    confirmed = F.filter("bucket", lambda r: r["digest"] == F.sha2(F.col("expression"), 256))
    best = met.select("host", "path", F.explode(confirmed).alias("r")).groupBy("host", "path").agg(
        F.max(F.struct("r.length", "r.labels", "r.rule", "r.verdict")).alias("best"))
    return best.select("host", "path", "best.rule", "best.verdict")


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages(page_id, url)``.

    Without a fitting rule: rule null, the default verdict.  Null and empty
    URLs and those without ``://`` have an empty host and path and fit no
    rule; a URL without a path (``http://a.com``) has an empty one, which
    only rules without a path fit.  Repeated rows each get their row, a null
    page_id is kept, other columns are not read.  No pages: no rows.

    Each distinct (host, path) is looked up once, so a URL that a third of
    the rows share costs one lookup; the answers are written, and the join
    back to the rows is one that adaptive execution can split.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    named = F.col("host") != ""  # the others fit nothing and stay out of the join: they would be one key
    answers = stage(fitting_rules(rows.where(named).select("host", "path").distinct(), rules, broadcast_bytes))
    judged = rows.where(named).join(answers, ["host", "path"], "left").select("page_id", "host", "path", "rule", "verdict")
    others = rows.where(~named).select("*", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    return judged.unionByName(others).withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def allowed_pages(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """The rows of ``pages``, all columns, whose URL is allowed.

    A URL is judged by its host and path; see :func:`url_verdicts` for odd rows.
    """
    host, path = host_and_path(F.col("url"))
    blocked = url_verdicts(pages, rules, default).where(F.col("verdict") != "allow").select(
        F.col("host").alias("_host"), F.col("path").alias("_path")).distinct()
    return pages.join(blocked, (host == F.col("_host")) & (path == F.col("_path")), "left_anti")
