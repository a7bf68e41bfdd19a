"""Conversation repair, importance resampling and URL rules against brute-force versions."""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from kinnear.llm import queries, resample, turns, urlrules
from tests.llm.fixtures import ITEM, alnum_words, collected, documents, given, no_rows, rows_of

# ---------------------------------------------------------------- conversations

_NEXT = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
_EMIT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}


def brute_edits(rows):
    """(cost, audit, repaired lines): the least of all edit sequences; ``rows``: (role, text, fault)."""

    @functools.cache
    def best(i, state, inserted):
        found = []
        there, role = _EMIT[state]
        if inserted < 3:
            found.append((2, "I", (f"{role}:",), best(i, there, inserted + 1)))
        if i == len(rows):
            if state in (0, 3):
                found.append((0, "", (), (0, "", ())))
        else:
            mine, text, fault = rows[i]
            found.append((3, "D", (), best(i + 1, state, 0)))
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                if (mine[:1], state) in _NEXT:
                    found.append((more, "K", (f"{mine}:{text}",), best(i + 1, _NEXT[mine[:1], state], 0)))
                found.append((2 + more, "R", (f"{role}:{text}",), best(i + 1, there, 0)))
        return min(((c + r[0], a + r[1], x + r[2]) for c, a, x, r in found if r), default=None)

    return best(0, 0, 0)


def brute_conversation(conv_id, rows):
    """The digest row of a conversation from its undamaged ``(turn, role, text)`` rows."""
    after = []
    for turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        d = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        after += [(turn, "user" if d == 4 else role, text)] * {0: 0, 3: 2}.get(d, 1)
    after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    seen, faulty = set(), []
    for _, role, text in after:
        seen_blank = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = ("blank" if not seen_blank else "duplicate" if (role, text) in seen
                 else "truncated" if seen_blank[-1] not in ".!?" else "fine")
        seen.add((role, text))
        faulty.append((role, text, fault))
    known = [t for t, _, _ in after if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    count = Counter(f for _, _, f in faulty)
    initials = [r[:1] for _, r, _ in after]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    cost, audit, lines = brute_edits(tuple(faulty))
    return (conv_id, gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def conversation_rows():
    """Nulls in any column, ties of turn, repeated rows, long runs of one role, odd roles and blanks."""
    r = random.Random(5)
    rows = []
    for conv in range(60):
        for _ in range(r.choice([0, 1, 2, 5, 9])):
            turn = r.choice([None, 0, 1, 2, 3, 4, 7, 1000])
            role = r.choice(["user", "assistant", "assistant", "system", "tool", None, "", "User"])
            rows.append((conv if conv else None, turn, role, r.choice(["Yes.", "No", "Why?", " \n", None, "", "\x85", "a.\x1c", "Où!\t ", "Yes."])))
    rows += [(70, t, "user", f"text {t}.") for t in range(150)]
    rows += [(71, t, "user", "again!") for t in range(40)] + [(72, 3, "system", "same.")] * 6
    rows += [(73, t, ["user", "assistant"][t % 2], "x" * 300_000 + str(t) + ".") for t in range(5)]
    return rows


def test_conversations_against_brute_force(spark):
    rows = conversation_rows()
    table = spark.createDataFrame([(*x, "y", 1) for x in rows], "conv_id long, turn long, role string, text string, audit string, cost int").repartition(3)
    groups = {}
    for conv, *rest in rows:
        groups.setdefault(conv, []).append(tuple(rest))
    expected = sorted((brute_conversation(c, v) for c, v in groups.items()), key=repr)
    assert rows_of(turns.repair_digests(turns.damaged(table)), *COLUMNS) == expected
    assert any(x[7] == "" for x in expected) and any("I" in x[7] and "R" in x[7] for x in expected)


def test_conversations_of_the_given_table(spark):
    table = given(spark, "conversations")
    groups = {}
    for r in table.collect():
        groups.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    expected = sorted((brute_conversation(c, v) for c, v in groups.items()), key=repr)
    assert rows_of(queries.op11_turns(spark, "/root/testdata/sf0.001"), *COLUMNS) == expected


def test_every_short_run_of_symbols():
    """All sequences of up to four symbols, and long random runs, have the least cost and audit."""
    row = {"s": ("system", "fine"), "u": ("user", "fine"), "a": ("assistant", "fine"), "x": ("tool", "fine"), "-": ("user", "blank")}
    row |= {k.upper(): (v[0], "truncated") for k, v in row.items() if k != "-"}

    def check(kinds):
        runs = turns.Runs()
        for k in kinds:
            runs.add(k)
        assert runs.solve() == brute_edits(tuple((row[k][0], "", row[k][1]) for k in kinds))[:2], kinds

    for n in range(5):
        for kinds in itertools.product("suaxSUAX-", repeat=n):
            check(kinds)
    r = random.Random(3)
    for _ in range(100):
        check("".join(r.choice("suaSUA-x") * r.choice([1, 1, 2, 8, 17]) for _ in range(8)))


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "Go."), (1, 2, "user", " "), (2, 0, "tool", ""), (3, 0, "user", "Ok?")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = rows_of(turns.repaired_conversations(table), "conv_id", "position", "turn", "role", "text", "edit")
    assert found == sorted([
        (1, 0, 0, "user", "Hi.", "R"), (1, 1, 1, "assistant", "Go.", "K"),
        (3, 0, 0, "user", "Ok?", "K"), (3, 1, None, "assistant", "", "I")], key=repr)
    facts = rows_of(turns.conversation_facts(table), "conv_id", "cost", "audit")
    assert facts == [(1, 5, "RKD"), (2, 3, "D"), (3, 2, "KI")]
    none = table.limit(0)
    assert turns.repair_digests(turns.damaged(none)).collect() == [] == turns.repaired_conversations(none).collect()


# ---------------------------------------------------------------- resampling


def brute_buckets(text, buckets=resample.BUCKETS):
    words = alnum_words(text)
    grams = words + [f"{a} {b}" for a, b in itertools.pairwise(words)]
    return len(words), [zlib.crc32(g.encode()) % buckets for g in grams]


def brute_resample(rows, items):
    buckets = [brute_buckets(t) for _, t in rows]
    s, t = Counter(b for _, x in buckets for b in x), Counter(b for i in items for b in brute_buckets(i)[1])
    n = resample.BUCKETS

    def gain(b):
        return math.floor(1000 * math.log(float(t[b] + 1) * float(s.total() + n) / (float(s[b] + 1) * float(t.total() + n))))

    out = []
    for (doc_id, _), (words, found) in zip(rows, buckets):
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words])
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return out, {i: r for i, r in enumerate(able[:25 * len(able) // 100], 1)}


@pytest.mark.parametrize("which", ["cases", "sf0.001"])
def test_resample_against_brute_force(spark, which):
    docs = documents(spark).cache() if which == "cases" else given(spark, "documents")
    target = spark.createDataFrame([(1, ITEM, "z"), (2, None, None), (3, "the of", "")], "item_id long, text string, rank string")
    target = target if which == "cases" else given(spark, "benchmark")
    rows = collected(docs)
    expected, drawn = brute_resample(rows, [r.text for r in target.collect()])
    found = resample.resample(docs, target)
    assert rows_of(found, "doc_id", "n_features", "weight", "score") == sorted((tuple(r[:4]) for r in expected), key=repr)
    ranks = sorted((r.rank, r.doc_id, r.score) for r in found.where(F.col("rank").isNotNull()).collect())
    assert ranks == [(i, r[0], r[3]) for i, r in drawn.items()] and len(ranks) == len(drawn)
    kept = resample.resampled_documents(docs, target)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in drawn.values()} - {None}


def test_resample_in_pieces(monkeypatch):
    """Pieces of any size count the same n-grams, of one to three words."""
    text = "Aé b-C d1\x00e  fffffffff g. the\x7fend " * 3
    words = alnum_words(text)
    for n in (1, 2, 3):
        grams = Counter(zlib.crc32(" ".join(words[i:i + k]).encode()) for k in range(1, n + 1) for i in range(len(words) - k + 1))
        for piece in (1, 2, 7, 40, 1 << 20):
            monkeypatch.setattr(resample, "PIECE", piece)
            found = list(resample.ngram_counts(text.encode(), n))
            assert sum(new for new, _ in found) == len(words)
            assert sum((c for _, c in found), Counter()) == grams, (n, piece)


def test_resample_odd_tables(spark):
    """Equal scores go by id, equal ids each count; without documents or target there is still an answer."""
    text = "word " * 20
    docs = spark.createDataFrame([(5, text)] * 6 + [(None, text)] * 6 + [(6, "few words")], "doc_id long, text string")
    empty = no_rows(spark).select("doc_id", "text")
    found = resample.resample(docs, empty)
    assert found.count() == 13 and sorted(r.rank for r in found.where("rank is not null").collect()) == [1, 2, 3]
    assert resample.resample(empty, docs).collect() == []
    assert resample.resample(no_rows(spark), no_rows(spark)).columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]


# ---------------------------------------------------------------- URLs

URLS = [
    None, "", "no url", "http://", "http:///en/x", "http://com", "http://com/", "http://COM/x", "http://a.com?x=/en/", "http://example.com/en/",
    "http://example.com/en", "https://www.Example.com/en/1?q#f", "https://www.example.com/EN/1", "http://myexample.com/en/1", "ftp://x.net/fr/",
    "http://x.net/fr", "http://net/es/1", "http://a.b.net:80/es/1", "x://y://com/", "http://www.example.com/en/a://b", "http://a..com/",
    "http://é.com/é/#", "http://com./", "http://" + "a." * 3000 + "com/" + "p/" * 3000, "\nhttp://a.com/\n?b", "http://user@a.net/fr//",
]
MORE_RULES = queries.URL_RULES + [
    ("a.b.net", "/e", "allow"), ("com", "/x", "block"), ("COM", "/x", "allow"), ("é.com", None, "block"), (None, "/", "block"), ("", "/", "block"),
    ("com", "en", "block"), ("net", "/fr/", "block"), ("x.net", "", "watch"), ("y:", "/", "block"), ("net", "/q/", None),
]


def brute_url(url, rules):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = found.groups() if found else ("", "")
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fits = []
    for h, p, v in rules:
        h, p = re.sub("[A-Z]", lambda m: m.group().lower(), h or ""), p or ""
        if h and v and (host == h or host.endswith("." + h)) and (not p or p.startswith("/")) and path.startswith(p):
            fits.append((len(h + p), len(h), h + p, v))
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


@pytest.mark.parametrize("rules", [queries.URL_RULES, MORE_RULES, []])
@pytest.mark.parametrize("broadcast_bytes", [urlrules.BROADCAST_BYTES, -1])
def test_urls_against_brute_force(spark, rules, broadcast_bytes):
    rows = list(enumerate(URLS)) + [(3, URLS[9]), (None, URLS[6]), (3, URLS[9])]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, verdict string, host int").repartition(3)
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = urlrules.url_verdicts(pages, table, broadcast_bytes=broadcast_bytes)
    expected = sorted(((i, *brute_url(u, rules)) for i, u in rows), key=repr)
    assert rows_of(found, "page_id", "host", "path", "rule", "verdict") == expected
    kept = urlrules.allowed_pages(pages, table)
    assert kept.columns == pages.columns
    assert rows_of(kept, "page_id", "url") == sorted(((i, u) for i, u in rows if brute_url(u, rules)[3] == "allow"), key=repr)
    assert urlrules.url_verdicts(pages.limit(0), table).collect() == []


def test_many_rules_meet_few_expressions(spark):
    """A rule a page, broadcast and shuffled; a short hash that several rules share is told apart by the digest."""
    pages = given(spark, "pages")
    rows = [(r.page_id, r.url) for r in pages.select("page_id", "url").collect()]
    rules = [(brute_url(u, [])[0], brute_url(u, [])[1][:6], ("block", "allow")[i % 2]) for i, u in rows]
    rules = [r for r in rules if r[0]]
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    one = {}  # a rule with two verdicts has the greater
    for h, p, v in rules:
        one[h, p] = max(v, one.get((h, p), ""))
    expected = sorted(((i, *brute_url(u, [(*k, v) for k, v in one.items()])) for i, u in rows), key=repr)
    for size in (urlrules.BROADCAST_BYTES, -1):
        found = urlrules.url_verdicts(pages, table, broadcast_bytes=size)
        assert rows_of(found, "page_id", "host", "path", "rule", "verdict") == expected


def test_short_hashes_are_confirmed(spark, monkeypatch):
    monkeypatch.setattr(urlrules, "SHORT", 0)  # every expression meets every rule
    rows = list(enumerate(URLS))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    table = spark.createDataFrame(MORE_RULES, "host string, path string, verdict string")
    assert rows_of(urlrules.url_verdicts(pages, table), "page_id", "rule") == sorted(((i, brute_url(u, MORE_RULES)[2]) for i, u in rows), key=repr)


# ---------------------------------------------------------------- SQL


@pytest.mark.parametrize("name", ["op11_turns", "op12_resample", "op13_urls"])
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    found = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in found.description]
    assert rows_of(queries.QUERIES[name](spark, "/root/testdata/sf0.001"), *columns) == sorted(found.fetchall(), key=repr)
