"""Every operator's query columns against a brute-force version, on the fixture and on sf0.001."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from kinnear.llm import disclosure, license as notices, linefreq, mixing, neural, passages, quality, queries, simhash, tokenfiles, winnow
from tests.llm.fixtures import ITEM, alnum_words, blank_words, collected, documents, fold, given, no_rows, rows_of


@pytest.fixture(scope="module", params=["cases", "sf0.001"])
def docs(request, spark):
    return documents(spark).cache() if request.param == "cases" else given(spark, "documents")


def brute_fingerprint(text):
    words = blank_words(text)
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(g.encode(), 42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs):
    rows = collected(docs)
    prints = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                label[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in groups.items()}
    expected = sorted(((rows[i][0], f"{prints[i]:016x}", least[find(i)]) for i in range(len(rows))), key=repr)
    found = simhash.near_duplicates(docs).withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))
    assert rows_of(found, "doc_id", "fingerprint", "component_id") == expected
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(groups)
    assert {r.doc_id for r in kept.collect()} == set(least.values())


def test_anchors_meet():
    """Any two fingerprints up to 4 bits apart share an anchor; each has at most 34."""
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(300):
        x = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        y = x
        for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
            y ^= 1 << int(b)
        a, b = (set(simhash.anchors(np.array([v], np.uint64))[0].tolist()) for v in (x, y))
        assert a & b and len(a) <= 34


def test_hot_anchor_forest():
    """A tight group gives one edge a member; an outsider none."""
    import numpy as np

    group = np.array([1 << i for i in range(40)] + [0, 0xFFFFFFFFFFFFFFFF], np.uint64)
    edges = list(simhash._forest(group, 4))
    assert len(edges) == 40 and all(0xFFFFFFFFFFFFFFFF not in e for e in edges)


def test_quality(spark):
    sf = "/root/testdata/sf0.01"
    found = quality.quality_scores(given(spark, "documents", sf), given(spark, "labels", sf)).toPandas()
    labels = given(spark, "labels", sf).toPandas()
    assert len(found) == 1000 and found.score.between(0, 1).all()
    assert all(h == (fold(d) == 0) for d, h in zip(found.doc_id, found.held_out))
    assert ((found.score >= 0.3) == (found.predicted == 1)).all()
    held = found[found.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.95


def test_quality_cases(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 1), (4, 0), (4, None), (None, 1), (16, 1), (19, 0), (22, 1), (22, 1), (25, 7)], "doc_id long, quality int")
    found = quality.quality_scores(docs, labels)
    assert found.count() == docs.count()
    assert found.where("score is null or score < 0 or score > 1").count() == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == found.where("predicted = 1").count()
    # without labels every score is 0.5
    assert {r.score for r in quality.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality_scores(no_rows(spark), labels).count() == 0


def test_isotonic():
    import numpy as np

    assert np.allclose(quality.isotonic(np.array([0, 1, 0, 1.0]), np.ones(4)), [0, 0.5, 0.5, 1])


def test_held_out_labels_teach_nothing(spark):
    docs = given(spark, "documents")
    labels = given(spark, "labels").select("doc_id", "quality")
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (rows_of(quality.quality_scores(docs, x), "doc_id", "score") for x in (labels, flipped))
    assert one == two


def test_tokens(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = collected(docs)
    folder = str(tmp_path / "tokens")
    tokenfiles.write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"), shard_tokens=2000)
    found = sorted(tokenfiles.document_index(spark, folder).collect(), key=lambda r: r.start)
    ids = {}
    for doc_id, text in rows:
        own = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        ids.setdefault(doc_id, []).append((len(own), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in own))))
    assert [r.doc_id for r in found] == sorted((d for d, _ in rows), key=lambda d: -1 if d is None else d)
    at = 0
    for r in found:
        assert r.start == at
        ids[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        at += r.n_tokens
    token = tokenizer.encode("word", add_special_tokens=False).ids[0]
    places = sorted(r.place for r in tokenfiles.token_occurrences(spark, folder, token).collect())
    every = [i for r in found for i in [r]]
    flat = []
    for doc_id, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        flat += tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    assert len(places) == flat.count(token) and len(every) == len(rows)


def test_wavelet_matrix():
    import numpy as np

    from kinnear.llm.wavelet import WaveletMatrix

    rng = np.random.default_rng(4)
    for symbols in (np.zeros(0, np.uint32), np.full(600, 9, np.uint32), rng.integers(0, 70000, 3000).astype(np.uint32),
                    rng.zipf(1.3, 5000).clip(0, 49407).astype(np.uint32)):
        m = WaveletMatrix.from_bytes(WaveletMatrix.build(symbols).to_bytes())
        assert (m.decode() == symbols).all()
        for i in rng.integers(0, max(len(symbols), 1), 20)[:len(symbols)]:
            s = int(symbols[i])
            assert m.access(int(i)) == s
            assert m.rank(s, int(i)) == int((symbols[:i] == s).sum())
            assert m.occurrences(s) == np.flatnonzero(symbols == s).tolist()
        assert m.count(123456) == 0


def test_license(docs):
    expected = []
    for doc_id, text in collected(docs):
        words = alnum_words(text)
        at = [(i, label) for p, label in notices.PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        expected.append((doc_id, len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
                         ",".join(sorted({x for _, x in at}))))
    found = notices.with_score(notices.license_scan(docs)).select(
        "*", F.size("base").alias("n_base"), F.array_min("base.word").alias("first_word"), F.array_max("base.word").alias("last_word"))
    assert rows_of(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(expected, key=repr)
    for r in found.collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def plain_statistics(text):
    """One text's statistics for the quality classifier, word by word."""
    data = (text or "").encode()
    if not data:
        return [0.0] * quality.N_STATS
    share = lambda a, b: a / max(b, 1)
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    words = re.findall(rb"[^\x20\x09-\x0D]+", low)
    last = [m.end() - 1 for m in re.finditer(rb"[^\x20\x09-\x0D]+", data)]
    n, sizes = len(words), list(map(len, words))
    mean = share(sum(sizes), n)
    alnum = lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
    pairs = list(zip(words, words[1:]))
    return [share(sum(b in set(c) for b in data), len(data)) for c in quality._CLASSES.values()] + [
        math.log1p(n), mean, math.sqrt(max(share(sum(s * s for s in sizes), n) - mean * mean, 0)),
        share(n - len(set(words)), n), share(len(pairs) - len(set(pairs)), n), share(sum(a == b for a, b in pairs), n),
        share(sum(not alnum(low[i]) and data[i] not in b".," for i in last), n), math.log1p(share(n, 1 + data.count(b"\n")))]


def test_quality_score_by_a_dense_fit(spark):
    """Every score again from plain statistics, one least-squares solve and the min-max form of the isotonic fit."""
    import numpy as np

    docs, labels = given(spark, "documents"), given(spark, "labels")
    rows = collected(docs)
    stats = {d: np.array(plain_statistics(t), np.float32).astype(float) for d, t in rows}
    taught = [(r.doc_id, float(r.quality)) for r in labels.collect() if r.quality in (0, 1) and r.doc_id in stats and fold(r.doc_id) != quality.HELD_OUT]
    every = np.array([stats[d] for d, _ in taught])
    rng = np.random.default_rng(quality.SEED)
    projection, phase = rng.normal(size=(quality.N_STATS, quality.FEATURES)) / quality.WIDTH, rng.uniform(0, 2 * np.pi, quality.FEATURES)

    def features(x):
        z = np.clip((x - every.mean(0)) / np.maximum(every.std(0), 1e-6), -6, 6)
        return np.column_stack([np.ones(len(z)), np.cos(z @ projection + phase) * np.sqrt(2 / quality.FEATURES)])

    fitted = [(d, y) for d, y in taught if fold(d) != quality.CALIBRATE]
    x, y = features(np.array([stats[d] for d, _ in fitted])), np.array([y for _, y in fitted])
    penalty = np.full(quality.FEATURES + 1, math.sqrt(quality.RIDGE * len(x)))
    penalty[0] = math.sqrt(1e-9)
    weights = np.linalg.lstsq(np.vstack([x, np.diag(penalty)]), np.concatenate([y, np.zeros(len(penalty))]), rcond=None)[0]
    bins = {}
    for d, label in taught:
        if fold(d) == quality.CALIBRATE:
            raw = float(np.clip(features(stats[d][None]) @ weights, -0.5, 1.5)[0])
            bins.setdefault(math.floor((raw + 0.5) / 2 * quality.BINS), []).append(label)
    marks = [bins[b] for b in sorted(bins)]
    average = lambda i, j: sum(map(sum, marks[i:j + 1])) / sum(map(len, marks[i:j + 1]))
    level = np.array([max(min(average(i, k) for k in range(m, len(marks))) for i in range(m + 1)) for m in range(len(marks))])
    middle = (np.array(sorted(bins)) + 0.5) * 2 / quality.BINS - 0.5
    levels = 0.98 * level + 0.015 * np.clip(middle, 0, 1) + 0.005 * y.mean()
    ids = sorted(stats)
    want = np.clip(np.interp(features(np.array([stats[d] for d in ids])) @ weights, middle, levels), 0, 1)
    found = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    assert max(abs(found[d] - w) for d, w in zip(ids, want)) < 1e-6


def test_fuzzy_notices():
    """Every notice is found with as many typing errors as it allows outside its distinctive words, with its span."""
    search = notices.NoticeSearch()
    for notice, label in notices.NOTICES.items():
        e = search.edits[notice]
        spoilt = list(notice)
        exact = {i for m in re.finditer(r"\S+", notice) if m.group() in search.distinctive[notice] for i in range(*m.span())}
        free = [i for i in range(len(notice)) if i not in exact]
        for k in range(e):  # spread over the notice
            spoilt[free[(2 * k + 1) * len(free) // (2 * e)]] = "z"
        n, _, found = notices.scan("before it " + "".join(spoilt) + " after it", search)
        assert any(m.label == label and m.errors <= e for m in found), notice
    _, _, found = notices.scan("aa bb Licensed under the Apache License, Version 2.0. cc", search)
    assert [(m.label, m.first, m.last, m.errors) for m in found] == [("apache-2.0", 2, 9, 0)]
    assert notices.scan("nothing of this kind is here at all", search)[2] == []


def test_rival_notices_are_settled():
    """With any errors outside its distinctive words, alone or beside any other, a notice yields its own label and no more."""
    import random

    r = random.Random(4)
    search = notices.NoticeSearch()
    gpl = "licensed under the gnu general public license version "
    assert search.distinctive[gpl + "2"] == {"2"} and search.distinctive["licensed under cc by nc 4 0"] == {"nc"}
    assert search.distinctive["mozilla public license version 2 0"] == set()

    def spoil(notice, e):
        words = notice.split()
        free = [(i, j) for i, w in enumerate(words) if w not in search.distinctive[notice] for j in range(len(w))]
        for i, j in r.sample(free, e):
            words[i] = words[i][:j] + "z" + words[i][j + 1:]
        return " ".join(words)

    for notice, label in notices.NOTICES.items():
        for e in range(search.edits[notice] + 1):
            for _ in range(5):
                assert [m.label for m in notices.scan(f"aa bb {spoil(notice, e)} cc dd", search)[2]] == [label], (notice, e)
    for a, first in notices.NOTICES.items():
        for b, second in notices.NOTICES.items():
            _, _, found = notices.scan(f"{spoil(a, 1)} and then {spoil(b, 1)}", search)
            assert [m.label for m in found] == [first, second], (a, b)
    for text in (gpl.strip(), gpl + "23", gpl + "4", "licensed under cc by 4 0", "licensed under cc by nd 4 0"):
        assert notices.scan(text, search)[2] == [], text
    assert [m.label for m in notices.scan(gpl + "2 or 3", search)[2]] == ["gpl-2.0"]


def test_settled_matches():
    made = [notices.Match(*m, 0.5) for m in [("a", 0, 5, 1), ("b", 4, 9, 0), ("c", 9, 9, 0), ("d", 10, 12, 2), ("e", 6, 11, 0), ("f", 0, 3, 3)]]
    assert [m.label for m in notices.settled(made)] == ["f", "b", "d"]
    assert [m.label for m in notices.settled(made * 2)] == ["f", "b", "d"]


def test_language_model(docs):
    rows = collected(docs)
    train = [t for d, t in rows if fold(d) != 1]
    counts = Counter(w for t in train for w in [*blank_words(t), " "])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for doc_id, text in rows:
        words = [*blank_words(text), " "]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        expected.append((repr(doc_id), fold(doc_id) == 1, len(words), sum(counts[w] > 0 for w in words), n, base))
    found = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in neural.lm_scores(docs).collect())
    expected.sort()
    for x, y in zip(found, expected, strict=True):
        assert x[:5] == y[:5] and x[5] == pytest.approx(y[5], abs=1e-6) and x[6] < 0


def test_language_model_is_normalised(spark, monkeypatch):
    """Probabilities of all known tokens and one unseen token a class add up to 1 in any context."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(neural, "OUTPUTS", 40)
    monkeypatch.setattr(neural, "HEAD", 60)
    docs = given(spark, "documents").limit(20)
    counts = neural.token_counts(docs)
    model = neural.fit(docs, counts)
    run = model.scorer()
    known = {bytes(r.token): r.c for r in counts.collect()}
    unseen, i = {}, 0
    while len(unseen) < neural.CLASSES:
        word = f"一{i}".encode()
        unseen.setdefault(neural.class_of(word), word)
        i += 1

    def log10(words):  # of the words as a text, its end taken back
        _, own, _, _, rare, _ = run(pa.array([b" ".join(words).decode()], pa.large_string()))
        return own[0] + sum(np.log10(known.get(w, 0) + 0.5) for w in rare)

    some = [w for w in known if w != neural.END]
    context = some[:2]
    end_after = lambda words: 10 ** (log10(words) - _prefix(words))

    def _prefix(words):
        """log10 of the words without the end, from the model's own tables."""
        unit, rank = model.units.of([*words, neural.END])
        first = np.zeros(len(unit), bool)
        first[0] = True
        near, far = neural.contexts(unit, first, model.units)
        p, z = model.parameters, model.parameters.log_normaliser()
        total = 0.0
        outputs = model.units.outputs
        for j, w in enumerate(words):
            s = (p.near[near[j]] + p.far[far[j]]) @ p.out[unit[j], :-1] + p.out[unit[j], -1] - z[near[j], far[j]]
            total += s / np.log(10)
            if unit[j] >= outputs:
                total += np.log10(known.get(w, 0) + 0.5) - np.log10(model.units.class_mass[unit[j] - outputs])
        return total

    mass = sum(10 ** (_prefix([*context, w]) - _prefix(context)) for w in [*some, *unseen.values()]) + end_after(context)
    assert mass == pytest.approx(1, abs=1e-3)


def test_language_model_learns(spark):
    sf = "/root/testdata/sf0.1"
    held = neural.lm_scores(given(spark, "documents", sf)).where("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert held.s > held.b + 0.05 * held.n


def test_head_is_full_under_ties(spark):
    """Equal counts don't empty the head; who is in it doesn't depend on the partitions."""
    def units(rows):
        return neural.learn_units(rows.select(F.concat(F.lit("w"), "id").cast("binary").alias("token"), F.col("c").cast("long").alias("c")))

    once = spark.range(100_000)
    for c in (F.lit(1), F.when(F.col("id") < 5, 900).when(F.col("id") < 70_000, 40).otherwise(1), F.when(F.col("id") < 1000, 1000 + F.col("id")).otherwise(7)):
        found = units(once.withColumn("c", c))
        assert len(found.head) == neural.HEAD and found.outputs == neural.OUTPUTS
        assert sorted(found.counts, reverse=True) == list(found.counts)
        assert units(once.withColumn("c", c).repartition(7)).head == found.head
    few = units(spark.range(200).withColumn("c", F.lit(3)))
    assert len(few.head) == 200 == few.outputs
    assert len(units(spark.range(0).withColumn("c", F.lit(3))).head) == 0


def test_mixture(docs):
    found = mixing.mixture(docs).toPandas()
    assert len(found) == docs.count()
    total = sum(len(blank_words(t)) + 1 for _, t in collected(docs))
    leaves = found.groupby(["domain", "lang", "source"]).agg(n=("tokens", "sum"), budget=("leaf_budget", "first"))
    assert abs(leaves.budget.sum() - total) <= len(leaves)
    assert (leaves.budget <= leaves.n * mixing.EPOCHS).all()
    for _, part in found.groupby(["domain", "lang", "source"]):
        once = part.drop_duplicates(["doc_id", "tokens"])
        drawn, budget = int((part.tokens * part.epochs).sum()), int(part.leaf_budget.iloc[0])
        assert part.epochs.max() - part.epochs.min() <= 1
        slack = (part.tokens.max() if len(once) == len(part) else part.tokens.sum())
        assert budget <= drawn + slack and drawn < budget + max(slack, 1)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and mixed.count() == int(found.epochs.sum())


def budgets(spark, leaves, total=None, weights=None, epochs=mixing.EPOCHS):
    table = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    return {tuple(r)[:3]: r.leaf_budget for r in mixing.leaf_budgets(table, total, weights, epochs).collect()}


def test_budgets_by_hand(spark):
    """Siblings take a shortage before other branches do."""
    leaves = [("a", "en", "x", 10), ("a", "en", "y", 1000), ("a", "fr", "z", 10), ("b", "en", "w", 1000)]
    found = budgets(spark, leaves, 800, epochs=1)
    # a: 400, of which fr can give 10 and en takes 390 (x 10, y 380); b: 400
    assert found == {("a", "en", "x"): 10, ("a", "en", "y"): 380, ("a", "fr", "z"): 10, ("b", "en", "w"): 400}
    assert sum(budgets(spark, leaves, 10**9, epochs=2).values()) == 2 * 2020
    assert budgets(spark, leaves, 100, {("a",): 0.0}, 1)[("b", "en", "w")] == 100
    assert budgets(spark, [], 10) == {}
    # weightless children have what the others leave, by what they can give
    assert budgets(spark, leaves, 1510, {("a",): 0.0}, 1) == {
        ("a", "en", "x"): 10, ("a", "en", "y"): 490, ("a", "fr", "z"): 10, ("b", "en", "w"): 1000}
    assert budgets(spark, [("a", "en", s, 0) for s in "xyz"], 10) == {("a", "en", s): 0 for s in "xyz"}


def brute_shares(children, given):
    """Budgets of (weight, capacity) pairs, in rounds: whoever is full leaves, the rest is shared again."""
    out, left, open_ones = [0.0] * len(children), min(given, sum(c for _, c in children)), set(range(len(children)))
    weight = [w for w, _ in children]
    while open_ones and left > 1e-9:
        total = sum(weight[i] for i in open_ones)
        if total <= 0:
            for i in open_ones:
                weight[i] = children[i][1]
            total = sum(weight[i] for i in open_ones)
            if total <= 0:
                break
        full = [i for i in open_ones if left * weight[i] / total >= children[i][1]]
        for i in full or open_ones:
            out[i] = children[i][1] if full else left * weight[i] / total
        if not full:
            break
        left -= sum(children[i][1] for i in full)
        open_ones -= set(full)
    return out


def brute_budgets(leaves, total, weights, epochs):
    def below(path, rows, given):
        if len(path) == 3:
            return {path: given}
        names = sorted({r[len(path)] for r in rows})
        parts = [[r for r in rows if r[len(path)] == n] for n in names]
        shares = brute_shares([(weights.get((*path, n), 1.0), float(epochs * sum(r[3] for r in p))) for n, p in zip(names, parts)], given)
        return {k: v for n, p, x in zip(names, parts, shares) for k, v in below((*path, n), p, x).items()}

    return below((), leaves, float(total))


def test_budgets_against_rounds(spark):
    import random

    r = random.Random(9)
    for trial in range(6):
        leaves = sorted({(f"d{r.randrange(3)}", r.choice(["en", "fr", "de"]), f"s{r.randrange(8)}"): r.choice([0, 1, 5, 5, 40, 3000]) for _ in range(25)}.items())
        leaves = [(*k, n) for k, n in leaves]
        paths = {k[:d] for *k, _ in leaves for d in (1, 2, 3) for k in [tuple(k)]}
        weights = {p: r.choice([0.0, 0.5, 1.0, 7.0]) for p in paths if r.random() < 0.6}
        total, epochs = r.choice([1, 50, 700, 5000, 10**6]), r.choice([1, 3])
        found, want = budgets(spark, leaves, total, weights, epochs), brute_budgets(leaves, total, weights, epochs)
        assert found.keys() == want.keys() and max(abs(found[k] - want[k]) for k in want) <= 0.5 + 1e-6, (trial, total, epochs)


@pytest.mark.parametrize("leaves_out", [mixing.LEAVES_OUT, 0])
@pytest.mark.parametrize("total", [None, 37, 5000, 100_000])
def test_drawn_prefix(docs, spark, monkeypatch, total, leaves_out):
    """Each leaf's documents of every epoch, against all of them in their order, ties and repeated rows included."""
    monkeypatch.setattr(mixing, "LEAVES_OUT", leaves_out)
    docs = docs.unionByName(docs.limit(9))  # rows that repeat
    found = mixing.mixture(docs, total)
    placed = found.withColumn("__id", F.col("doc_id")).withColumn("__key", F.col("text_key")).withColumn(
        "place", mixing._order(F.floor(F.col("leaf_budget") / F.sum("tokens").over(mixing.Window.partitionBy("domain", "lang", "source"))), mixing.SEED))
    leaves = {}
    for r in placed.collect():
        leaves.setdefault((r.domain, r.lang, r.source), []).append(r)
    want = brute_budgets([(*k, sum(r.tokens for r in v)) for k, v in leaves.items()], total or sum(r.tokens for v in leaves.values() for r in v), {}, mixing.EPOCHS)
    for leaf, rows in leaves.items():
        have, budget = sum(r.tokens for r in rows), rows[0].leaf_budget
        assert abs(budget - want[leaf]) <= 0.5 + 1e-6
        whole, rest = divmod(budget, have)
        name = lambda r: (r.place % 2**64, r.doc_id is not None, r.doc_id or 0, r.text_key)
        before, sums = 0, {}
        for r in sorted(rows, key=name):  # rows that repeat share the sum before the first of them
            sums.setdefault(name(r), before)
            before += r.tokens
        for r in rows:
            assert r.epochs == whole + (sums[name(r)] < rest)


def test_line_rules(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = []
    for doc_id, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        inside = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
        failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
        expected.append((doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed))
    found = linefreq.line_rules(docs)
    assert rows_of(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(expected, key=repr)
    assert found.where("kept and base_failed").count() == 0


def test_repeated_words_of_a_long_text(spark):
    """No window of 3,000,000 different words repeats; one that does counts its words, once each."""
    n = 3_000_000
    for again, expected in ((0, 0), (4, 8)):
        words = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.concat(F.lit("w"), F.when(i > n - again, i - n + again).otherwise(i)))
        found = spark.createDataFrame([(n,)], "n int").select(words.alias("words"), "n")
        assert found.select(linefreq.repeated_words(F.col("words"), F.col("n")).alias("r")).first().r == expected


def test_frequent_lines(spark):
    line = "Subscribe to our weekly news 2024"
    body = lambda i: " ".join(f"w{i}x{j}q" + "abcdefghij"[(i * 7 + j * 3) % 10] * (1 + j % 4) + "klmnopqrst"[(i + j * j) % 10] for j in range(60))
    rows = [(i, f"{body(i)}\n{line}{i}", "h") for i in range(40)]  # the number is normalised away
    rows += [(100, "\n".join([line] * 12) + "\n" + body(1)[:40], "h"), (200, f"{body(200)}\n{line}", "other"), (300, f"{line}\n" * 60, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in linefreq.line_rules(docs).collect()}
    assert all(len(found[i].removed) == 1 and found[i].kept for i in range(40))
    assert len(found[100].removed) == 1 and not found[100].kept
    assert found[200].removed == [] and found[200].kept
    assert {r.doc_id for r in linefreq.clean_documents(docs).where(F.col("text").contains("Subscribe")).collect()} == {200}
    # documents are counted: a text in more of them than the limit is boilerplate, rows that repeat an id are one document
    for ids, kept in ((range(40), 0), (range(25), 25), ([1] * 40, 40)):
        copies = spark.createDataFrame([(i, f"{body(1)}\n{line}", "h") for i in ids], "doc_id long, text string, source string")
        assert linefreq.line_rules(copies).where("kept").count() == kept


def test_limits_of_small_and_large_hosts(spark):
    """5 % of the host's documents, never under 25 nor over 100; lines without letters count as they are."""
    words = " ".join(f"v{j}" for j in range(50))
    lines = {"large": (3000, {"in one hundred": 100, "in one more": 101, "== 12 ==": 150, "-- 7 --": 90}), "middle": (1000, {"fifty": 50, "fifty one": 51}),
             "small": (60, {"twenty five": 25, "twenty six": 26, "#": 30})}
    rows, number = [], 0
    for host, (n, often) in lines.items():
        for i in range(n):
            own = [f" {x}\t" if i % 2 and not x[0].isalpha() else x for x, m in often.items() if i < m]
            rows.append((number, "\n".join([*own, f"{words} {host} " + "".join(chr(97 + int(d)) for d in str(number))]), host))
            number += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clean = {r.doc_id: r.text for r in linefreq.clean_documents(docs).collect()}
    left = {x.strip() for t in clean.values() for x in t.split("\n")[:-1]}
    assert len(clean) == len(rows) and left == {"in one hundred", "-- 7 --", "fifty", "twenty five"}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = True
            if kind == "ip":
                ok = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))
            elif kind == "card":
                double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))] if len(digits) < 30 else []
                ok = 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in double) % 10 == 0
            elif kind == "phone":
                ok = 10 <= len(digits) <= 15
            if ok:
                found.append((m.start(), list(PATTERNS).index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return [x for _, _, x in sorted(found)]


def test_private(docs):
    expected = []
    for doc_id, text in collected(docs):
        if text and text.startswith("aaaa"):
            found = []  # the plain pattern needs quadratic time for it
        else:
            found = brute_spans(text)
        expected.append((doc_id, *(sum(x.startswith(k) for x in found) for k in PATTERNS), hashlib.sha256(",".join(found).encode()).hexdigest(), ",".join(found)))
    found = disclosure.sanitisation(docs).withColumn("base", F.expr("array_join(transform(filter(spans, s -> s.kind < 4), s -> concat_ws(':', s.name, s.start, s.end)), ',')"))
    assert rows_of(found, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base") == sorted(expected, key=repr)


def test_disclosing_terms(spark):
    rows = [(i, f"common words here Zorblax reports to jane.doe@corp.example.com about item{i} common", "x") for i in range(6)]
    rows += [(100 + i, f"common words here and nothing else about item{i}", "x") for i in range(60)]
    rows += [(200, "common mail of other@corp.example.com once", "x"), (201, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string")
    found = {r.doc_id: r for r in disclosure.sanitisation(docs).collect()}
    text = rows[0][1]
    terms = {text[s.start:s.end] for s in found[0].spans if s.kind > 3}
    assert "Zorblax" in terms and "common" not in terms and "item0" not in terms
    assert all(not found[100 + i].spans for i in range(60)) and [s.name for s in found[200].spans] == ["email"]
    clean = {r.doc_id: r.text for r in disclosure.sanitised(docs).collect()}
    assert "Zorblax" not in clean[0] and "[EMAIL]" in clean[0] and "common words here" in clean[0]
    assert clean[100] == rows[6][1] and clean[201] is None


@pytest.mark.parametrize("limit", [disclosure.TERMS_OUT, 0])
def test_disclosing_terms_anywhere(spark, monkeypatch, limit):
    """A term far from its identifier counts by document and is redacted wherever it stands, by lookup and by join."""
    monkeypatch.setattr(disclosure, "TERMS_OUT", limit)
    rows = []
    for i in range(10):
        far = " ".join(f"é{i}x{j}" for j in range(20 if i > 1 else 2))
        rows.append((i, f"Quixobar {far} jane.doe@corp.example.com {far} common quixobar common", "x"))
    rows += [(50, "common Quixobar without a mention, ask quixobar@corp.example.com", "x"), (51, None, "x")]
    rows += [(100 + i, f"common and nothing else about item{i}", "x") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string")
    found = {r.doc_id: r for r in disclosure.sanitisation(docs).collect()}
    text = dict((r[0], r[1]) for r in rows)
    for i in [*range(10), 50]:
        terms = [text[i][s.start:s.end].lower() for s in found[i].spans if s.kind > 3]
        assert terms == ["quixobar"] * (1 if i == 50 else 2), (i, terms)
        assert {s.name for s in found[i].spans if s.kind > 3} == {"remove"}
    assert not any(found[100 + i].spans for i in range(200)) and not found[51].spans
    clean = {r.doc_id: r.text for r in disclosure.sanitised(docs).collect()}
    assert "uixobar" not in "".join(clean[i] for i in range(10)) and clean[50].startswith("common  without")


def test_disclosure_against_counted_documents(docs):
    """The strongest disclosure of every term, from sets of documents."""
    import numpy as np

    rows = {(d, t) for d, t in collected(docs) if t is not None}  # rows that repeat an id and text count once for a pair
    low = lambda w: re.sub("[A-Z]", lambda m: m.group().lower(), w)
    free, has, frequency = {}, {}, Counter()
    for key in rows:
        found = disclosure.base_spans(key[1])
        if found:
            free[key] = {low(w) for w in disclosure.free_words(key[1], found)}
        for k, a, b in found:
            has.setdefault(f"{k}:{key[1][a:b].lower()}", set()).add(key)
    for _, t in collected(docs):
        frequency.update(set(map(low, re.findall(r"[^\x20\x09-\x0D]+", t or ""))))
    n, want = max(docs.count(), 2), {}
    for support in (1, 2):
        want.clear()
        for entity, those in has.items():
            own = math.log2(n / len(those))
            for term in set().union(*(free[k] for k in those)) if len(those) >= support else ():
                both = sum(term in free[k] for k in those)
                if both >= support and frequency[term] >= support and own > 0:
                    strength = math.log2(n * both / (frequency[term] * len(those))) / own
                    if strength >= disclosure.GENERALISE:
                        want[term] = max(want.get(term, 0.0), strength)
        classes = set(disclosure.class_term(np.arange(disclosure.N_CLASSES)).tolist())
        found = disclosure.disclosing_terms(
            disclosure.stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text").mapInArrow(
                disclosure._find, disclosure._FOUND)), disclosure.document_frequency(docs), n, support)
        best = {r.term: r.s for r in found.groupBy("term").agg(F.max("strength").alias("s")).collect()}
        names = dict(zip(disclosure.term_hash(list(want)).tolist(), want)) if want else {}
        assert best.keys() - classes == names.keys() and all(abs(best[h] - want[t]) < 1e-9 for h, t in names.items())


def test_generalised_terms(spark):
    """Between the thresholds a term gives way to its class, which reveals less; where the class reveals as much it goes."""
    rows = [(i, f"common Quixobar and 31415926 and jane.doe@corp.example.com plain{i}", "x") for i in range(10)]
    rows += [(20 + i, f"common Quixobar and words {i}", "x") for i in range(12)]
    rows += [(40 + i, f"common 31415926 and words {i}", "x") for i in range(12)]
    rows += [(100 + i, f"common and nothing else but words about item{i}", "x") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string")
    found = {r.doc_id: {(r.text[s.start:s.end], s.name) for s in r.spans if s.kind > 3} for r in
             disclosure.sanitisation(docs).join(docs.select("doc_id", "text"), "doc_id").collect()}
    # 22 documents have each term, 10 of them the identifier; all numbers of 7 to 9 digits are in the same 22
    assert found[0] == found[3] == {("Quixobar", "generalise"), ("31415926", "remove")}
    assert found[25] == {("Quixobar", "generalise")} and found[45] == {("31415926", "remove")} and found[100] == set()
    clean = {r.doc_id: r.text for r in disclosure.sanitised(docs).collect()}
    assert clean[0] == "common [word of 7 to 9] and  and [EMAIL] plain0" and clean[45] == "common  and words 5"
    # what the class still reveals, from the documents that have a word of it
    n, has = len(rows), 10
    those = sum(any(7 <= len(w) <= 9 and w.isalpha() for w in t.split()) for _, t, _ in rows)
    assert math.log2(n * has / (those * has)) / math.log2(n / has) < disclosure.GENERALISE
    words = ["abc", "abcd", "é" * 7, "x" * 10, "1", "1234567", "a1", "a-b-c-d-e-f", "__"]
    data, offsets = disclosure.buffer_of(disclosure.pa.array(words, disclosure.pa.large_string()))
    assert disclosure.classes(data, offsets[:-1], offsets[1:]).tolist() == [0, 1, 2, 3, 4, 6, 8, 11, 8]
    names = spark.createDataFrame([(w,) for w in words], "w string").select(disclosure.class_name(F.col("w")).alias("c")).collect()
    lengths = ["1 to 3", "4 to 6", "7 to 9", "10 or more"]
    assert [r.c for r in names] == [f"{disclosure.MADE_OF[c // 4]} of {lengths[c % 4]}" for c in [0, 1, 2, 3, 4, 6, 8, 11, 8]]


def test_lists_of_identifiers_are_not_multiplied_out(spark):
    """Near copies of a list of many identifiers and terms: identifiers in the same documents are counted once."""
    import time

    people = [f"person{i}@site{i % 7}.example.com" for i in range(2000)]
    terms = " ".join(f"zterm{i}" for i in range(8000))
    rows = [(i, " ".join(people[:2000 - i]) + " " + terms) for i in range(3)] + [(10 + i, f"nothing of that kind {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    start = time.time()
    found = {r.doc_id: r.spans for r in disclosure.sanitisation(docs).collect()}
    assert time.time() - start < 60  # some 16 million pairs a copy took as long as that
    assert all(sum(s.name == "remove" for s in found[i]) == 8000 for i in range(3)) and found[10] == []


def brute_contamination(rows, items):
    windows = {}
    for item_id, text in items:
        words = alnum_words(text)
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i:i + n]), set()).add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in rows:
        words, hit, ids = alnum_words(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (found := windows.get(tuple(words[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    ids |= {str(x) for x in found if x is not None}
        out.append((doc_id, len(words), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [winnow.BROADCAST_BYTES, 0])
def test_contamination(spark, docs, limit):
    items = [(1, ITEM), (2, "one two"), (3, "word " * 40), (4, None), (5, ""), (6, "the"), (None, "three four five"), (1, "SIX seven"),
             (7, " ".join(ITEM.split()[3:25])), (8, ITEM)]
    bench = given(spark, "benchmark").select(F.col("item_id").cast("long").alias("item_id"), "text").unionByName(
        spark.createDataFrame(items, "item_id long, text string"))
    found = winnow.contamination(docs, bench.withColumn("words", F.lit(0)), limit)
    expected = brute_contamination(collected(docs), [tuple(r) for r in bench.collect()])
    assert rows_of(found, "doc_id", "n_words", "n_hit", "items", "contaminated") == expected
    kept = winnow.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not x[4] for x in expected)


def test_contamination_without_items(spark):
    docs = documents(spark)
    assert winnow.contamination(docs, given(spark, "benchmark").limit(0)).where("n_hit > 0 or contaminated").count() == 0
    assert winnow.contamination(no_rows(spark), given(spark, "benchmark")).count() == 0


def test_passages(docs):
    rows = collected(docs)
    shingled = {t: [tuple(blank_words(t)[i:i + 5]) for i in range(len(blank_words(t)) - 4)] for _, t in rows}
    texts = sorted(shingled, key=str)
    label = {t: t for t in texts}

    def find(t):
        while label[t] != t:
            t = label[t]
        return t

    where = {}
    for t in texts:  # texts that share 46 consecutive shingles (50 words) word for word
        for i in range(len(shingled[t]) - 45):
            other = where.setdefault(tuple(shingled[t][i:i + 46]), t)
            label[find(t)] = find(other)
    found = passages.shared_passages(docs)
    by_id = {}
    for (doc_id, text), r in zip(sorted(rows, key=repr), sorted(found.collect(), key=lambda r: repr((r.doc_id, None)))):
        by_id.setdefault(doc_id, set()).add(r.class_id)
    assert found.count() == len(rows)
    ids = {}
    for doc_id, text in rows:
        if doc_id is not None and len(blank_words(text)) >= 50:
            ids.setdefault(find(text), set()).add(doc_id)
    for group in ids.values():
        assert len({min(by_id[d]) for d in group}) == 1, group


def test_near_passages(spark):
    """A passage with a changed word is found in other surroundings; unrelated texts stay apart."""
    from tests.llm.fixtures import prose

    words = prose(120, 50).split()
    changed = [*words]
    changed[60] = "changed"
    rows = [(1, prose(100, 51) + " " + " ".join(words) + " " + prose(90, 52)), (2, prose(80, 53) + "\n" + " ".join(changed)),
            (3, prose(300, 54)), (4, prose(200, 55) + " " + " ".join(words[:20]))]
    rows += [(10 + i, " ".join(words)) for i in range(5)]
    found = {r.doc_id: r for r in passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d for d, r in found.items() if r.class_id == 1} == {1, 2, 10, 11, 12, 13, 14}
    assert found[3].class_id == 3 and found[4].class_id == 4 and found[3].n_shared_words == 0
    s, e = found[1].spans[0]
    assert s <= 105 and e >= 215


def test_edited_passages(spark):
    """Edits every 30 words around a word-for-word run of 60: every aligned window of similarity 0.8 is covered by what is found."""
    import numpy as np
    from tests.llm.fixtures import prose

    def similarity(x, y):
        return len(set(x) & set(y)) / len(set(x) | set(y))

    def edited(words, step, run=range(0)):
        return [f"edit{i}" if i % step == 0 and i not in run else w for i, w in enumerate(words)]

    def sequence(words):
        return np.array([zlib.crc32(" ".join(words[i:i + 5]).encode()) for i in range(len(words) - 4)], np.uint32)

    r = np.random.default_rng(1)
    cases = [([f"w{i}" for i in range(360)], step, range(150, 150 + run)) for step in (24, 26, 30, 37, 44) for run in (0, 60)]
    cases += [([f"w{i}" for i in r.integers(0, 3, 200)], step, range(0)) for step in (20, 30, 40)]  # repeated shingles
    for words, step, run in cases:
        x, y = sequence(words), sequence(edited(words, step, run))
        found = passages.common_passages(x, y, 0)
        assert all(similarity(x[s:e].tolist(), y[t:f].tolist()) >= 0.8 for s, e, t, f in found)
        for i in range(len(x) - 45):
            if (x[i:i + 46] == y[i:i + 46]).sum() >= 41 and similarity(x[i:i + 46].tolist(), y[i:i + 46].tolist()) >= 0.8:
                same = [p for p in range(i, i + 46) if x[p] == y[p]]
                assert all(any(s <= p < e for s, e, _, _ in found) for p in same), (step, run, i)
    # a word put in every 30 words: the windows are found by shingles that are anywhere
    words = [f"w{i}" for i in range(300)]
    put_in = [v for i, w in enumerate(words) for v in ([f"new{i}", w] if i and i % 30 == 0 else [w])]
    assert passages.common_passages(sequence(words), sequence(put_in), 0)
    words = prose(360, 60).split()
    rows = [(1, " ".join(words)), (2, " ".join(edited(words, 30, range(150, 210)))), (3, prose(300, 61))]
    found = {r.doc_id: r for r in passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[d].class_id for d in (1, 2, 3)] == [1, 1, 3]
    assert found[2].n_links == 1 and any(s <= 150 and e >= 210 for s, e in found[2].spans)


def test_passages_of_a_poor_centre(spark):
    """Texts that share 50 words are of one class, also where texts with a part of them come first under every key."""
    from tests.llm.fixtures import prose

    rows = []
    for i in range(80):
        words = [f"p{i}w{j}" for j in range(50)]
        around = [[f"{side}{i}w{j}" for j in range(30)] for side in "klmn"]
        texts = [around[0] + words + around[1], around[2] + words + around[3]]
        # cut off at either end of the text, so that their finer keys are 0
        texts += [words[:cut] for cut in (30, 38, 44)] + [words[-cut:] for cut in (30, 38, 44)]
        texts += [[f"q{i}w{j}{k}" for j in range(30)] + part for k, part in enumerate((words[:30], words[:44]))]
        texts += [part + [f"r{i}w{j}{k}" for j in range(30)] for k, part in enumerate((words[-30:], words[-44:]))]
        rows += [(100 * i + k, " ".join(text)) for k, text in enumerate(texts)]
    rows.append((10**6, prose(300, 70)))
    found = {r.doc_id: r for r in passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    lost = [i for i in range(80) if found[100 * i + 1].class_id != 100 * i]
    assert not lost, lost
    for i in range(80):
        assert all(any(s <= 30 and e >= 80 for s, e in found[100 * i + k].spans) for k in (0, 1)), i
    assert found[10**6].n_links == 0


def test_empty_tables(spark):
    empty = no_rows(spark)
    assert simhash.near_duplicates(empty).count() == 0
    assert notices.license_scan(empty).count() == 0
    assert neural.lm_scores(empty).count() == 0
    assert mixing.mixture(empty).count() == 0
    assert linefreq.line_rules(empty).count() == 0
    assert disclosure.sanitisation(empty).count() == 0
    assert passages.shared_passages(empty).count() == 0


def test_every_operator_is_registered():
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES}


def test_components(spark):
    """Chains, stars around a large id, cycles and repeated edges, against a plain search."""
    import random

    from kinnear.llm.components import connected_components

    r = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(999, i) for i in range(300, 340)] + [(5, 7), (7, 6), (6, 5), (5, 7), (8, 8)]
    edges += [(r.randrange(-500, 0), r.randrange(-500, 0)) for _ in range(300)]
    label = {}

    def find(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            label[max(x, y)] = min(x, y)
    r.shuffle(edges)
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert {row.node: row.label for row in found.collect()} == {x: find(x) for x in list(label)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_encoder_on_odd_strings():
    """Ids equal the tokenizer's own for random strings of marks, odd blanks, combining marks, case pairs and special tokens."""
    import random

    import pyarrow as pa

    encoder = tokenfiles.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    parts = list("abzAZ09 \n\t\x0b\x0c\r\x1c\x85 '`.,!<|>-_éÉñßİıſK…—̸́̇​﻿中😀ΑΣσς½²Ⅳ")
    parts += ["<|endoftext|>", "'s", "'LL", " ", "</w>", "!" * 70]
    r = random.Random(5)
    for _ in range(300):
        texts = ["".join(r.choices(parts, k=r.randint(0, 14))) for _ in range(8)]
        ids, ends = encoder.encode(pa.array(texts, pa.large_string()), 2)
        begin = 0
        for text, end in zip(texts, ends.tolist()):
            assert ids[begin:end].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2], repr(text)
            begin = end


def test_edited_copies_in_groups(spark):
    """A passage and its copies with one changed word each, other words around: groups of 2, 6 and 21 come together and stay apart."""
    import random

    r = random.Random(21)
    words = lambda n: ["".join(r.choices("abcdefghijklmnop", k=6)) for _ in range(n)]
    rows, groups = [], []
    for size in (2, 6, 21):
        for _ in range(20):
            original, ids = words(50), []
            for copy in range(size):
                text = list(original)
                if copy:
                    text[r.randrange(50)] = words(1)[0]
                ids.append(len(rows))
                rows.append((len(rows), " ".join(words(r.randrange(20, 120)) + text + words(r.randrange(20, 120)))))
            groups.append(ids)
    rows += [(len(rows) + i, " ".join(words(150))) for i in range(30)]
    found = {x.doc_id: x for x in passages.shared_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for size in (2, 6, 21):
        pairs = [(ids[0], i) for ids in groups if len(ids) == size for i in ids[1:]]
        assert sum(found[a].class_id == found[b].class_id for a, b in pairs) >= 0.95 * len(pairs), size
    for ids in groups:  # no class holds texts of two groups
        assert {found[i].class_id for i in ids} <= set(ids)
    assert all(found[i].class_id == i and found[i].n_links == 0 for i in range(len(rows) - 30, len(rows)))


def test_next_partners_are_aligned(spark):
    """A text that fails against its key's first text is asked to meet what that one is linked to, at the same words."""
    pairs = spark.createDataFrame([(1, 5, 10, 100, 110, 1), (5, 9, -10, 112, 118, 1), (2, 5, 0, 100, 100, 2)],
                                  "a long, b long, shift int, low int, high int, centre int")
    links = spark.createDataFrame([(5, 9, 90, 150, 80, 140)], "a long, b long, a_start long, a_end long, b_start long, b_end long")
    # 1 is the first text of (1, 5), which fails, but is linked to nothing; 5 is that of (2, 5) and is linked to 9
    assert rows_of(passages.next_partners(pairs, links), "a", "b", "shift", "low", "high") == [(2, 9, -10, 100, 100)]
    assert passages.next_partners(pairs, links.limit(0)).collect() == []


def test_passages_of_texts_apart(spark):
    """A text that is similar to one of its first text's partners only, not to the one with most links, is linked to that one."""
    import random

    r = random.Random(11)
    fresh = lambda n: ["".join(r.choices("abcdefghijklmnop", k=9)) for _ in range(n)]
    rows = []
    for group in range(0, 120, 10):
        first, more = fresh(54), fresh(60)
        near, popular = [*first], [*first]
        near[4:5], popular[5:6] = fresh(1), fresh(1)
        far = [*near]
        far[49:50] = fresh(1)
        texts = [first, near, popular + fresh(30) + more, more, far]
        rows += [(group + i + 1, " ".join(words)) for i, words in enumerate(texts)]
    links = passages.passage_links(spark.createDataFrame(rows, "node long, text string"))
    found = {(r.a, r.b) for r in links.collect()}
    for group in range(0, 120, 10):
        assert {(group + 1, group + 2), (group + 1, group + 3), (group + 3, group + 4), (group + 2, group + 5)} <= found
        assert (group + 1, group + 5) not in found and (group + 3, group + 5) not in found


def test_partners_apart(spark):
    """Texts that met a first text (1) at the same place, in different classes; the place of the last one (5) is another."""
    pairs = spark.createDataFrame(
        [(1, 2, 10, 100, 120, 1), (1, 3, -5, 90, 110, 1), (1, 4, 0, 110, 130, 1), (1, 5, 7, 300, 310, 1)],
        "a long, b long, shift int, low int, high int, centre int")
    links = spark.createDataFrame([(1, 2)], "a long, b long")
    assert rows_of(passages.partners_apart(pairs, links), "a", "b", "shift", "low", "high") == [
        (2, 3, -15, 110, 120), (2, 4, -10, 120, 130), (3, 4, 5, 105, 105)]
    every = links.union(spark.createDataFrame([(2, 3), (3, 4), (4, 5)], "a long, b long"))
    assert passages.partners_apart(pairs, every).collect() == []


def test_repeated_passages_meet_once(spark):
    """Two texts that repeat one passage are aligned once for all its places, not once for each place; the links cover all of them."""
    from tests.llm.fixtures import prose

    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(n, 0, node, place) for n in (1, 2) for node, places in ((7, 4), (9, 12)) for place in range(100 * n, 100 * n + 60 * places, 60)]
    keys = spark.createDataFrame(rows, "key long, fine int, node long, place int").repartition(1)
    met = passages._pairs(keys, whole=True)
    # twelve places face four: three alignments, and each place of either text is in one of them
    assert rows_of(met, "a", "b", "shift", "low", "high") == [(7, 9, s, 100, 380) for s in (0, 240, 480)]
    assert passages._pairs(keys).count() > 3
    apart = prose(100, 81), prose(100, 82), prose(100, 83)
    texts = [(1, apart[0] + " " + " ".join([passage] * 3)), (2, " ".join([passage] * 9) + " " + apart[1]), (3, apart[2])]
    found = {r.doc_id: r for r in passages.shared_passages(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert [found[d].class_id for d in (1, 2, 3)] == [1, 1, 3] and found[3].n_links == 0
    assert any(s <= 100 and e >= 260 for s, e in found[1].spans) and any(s == 0 and e >= 540 for s, e in found[2].spans)


def test_meeting_goes_on_in_the_next_batch():
    """Rows of one key in batches of any size meet the same first texts, at the same places."""
    import numpy as np
    import pyarrow as pa

    r = np.random.default_rng(5)
    rows = sorted({tuple(map(int, r.integers(0, (4, 3, 4, 40)))) for _ in range(300)})
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int32()))], names=["key", "fine", "node", "place"])
    for whole in (False, True):
        results = [
            [tuple(x.values()) for part in passages._meet((batch.slice(i, size) for i in range(0, len(rows), size)), whole) for x in part.to_pylist()]
            for size in (len(rows), 1, 7, 50)]
        assert results[0] and all(sorted(x) == sorted(results[0]) for x in results)
