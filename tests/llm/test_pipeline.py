"""The pipeline's stages, each against a brute-force version on its own input, and the whole run."""

from __future__ import annotations

import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kinnear.llm.mixing import mixture
from kinnear.llm.quality import quality_scores
from kinnear.llm.tables import stage
from tests.llm.fixtures import documents, no_rows
from tests.llm.test_contracts import brute_contamination, brute_fingerprint

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def chain(spark):
    """name -> (input, output) of every stage, in order."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, apply in corpus_pipeline.STAGES:
        result = stage(apply(spark, docs, SF))
        out[name] = (docs, result)
        docs = result
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_order_and_columns(chain):
    assert list(chain) == ["quality", "near_duplicates", "decontaminate", "mix", "tokens"]
    for name, (given, result) in list(chain.items())[:-1]:
        assert result.columns == given.columns, name
        assert {tuple(r) for r in result.collect()} <= {tuple(r) for r in given.collect()}, name


def test_quality(spark, chain):
    given, result = chain["quality"]
    good = quality_scores(given, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").select("doc_id")
    assert rows(result) == rows(given.join(good, "doc_id", "left_semi"))


def test_near_duplicates(chain):
    given, result = chain["near_duplicates"]
    prints = {r.doc_id: brute_fingerprint(r.text) for r in given.collect()}
    label = {d: d for d in prints}

    def find(d):
        while label[d] != d:
            d = label[d]
        return d

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    assert {r.doc_id for r in result.collect()} == {find(d) for d in prints}


def test_decontaminate(spark, chain):
    given, result = chain["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {d for d, _, _, _, bad in brute_contamination([(r.doc_id, r.text) for r in given.collect()], items) if not bad}
    assert {r.doc_id for r in result.collect()} == clean


def test_mix(chain):
    given, result = chain["mix"]
    wanted = {r.doc_id: r.epochs for r in mixture(given).collect() if r.epochs}
    assert {r.doc_id: r["count"] for r in result.groupBy("doc_id").count().collect()} == wanted


def test_tokens(chain):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    given, result = chain["tokens"]
    found = sorted(map(tuple, result.collect()), key=lambda r: r[1])
    at, expected = 0, []
    for r in sorted(given.collect(), key=lambda r: r.doc_id):
        ids = tokenizer.encode(r.text, add_special_tokens=False).ids + [2]
        expected.append((r.doc_id, at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        at += len(ids)
    assert found == expected


def test_run(spark, chain):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(chain["tokens"][1])


@pytest.mark.parametrize("name", list(STAGES))
def test_stage_takes_odd_rows(spark, name):
    """Nulls, empty and long texts, repeated rows, other columns and an empty table."""
    docs = documents(spark)
    result = STAGES[name](spark, docs, SF)
    if name != "tokens":
        assert result.columns == docs.columns
    assert result.count() >= 0
    assert STAGES[name](spark, no_rows(spark), SF).count() == 0
    assert STAGES[name](spark, docs.where(F.col("text").isNull()), SF).count() >= 0
