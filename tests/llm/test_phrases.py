"""Phrase collocation mining against brute force and SQL."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from strata.llm import phrases, registered
from verification import compare

TABLES = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, gram string, n string, part string"


def brute(rows, s):
    """Per language: (phrase, a, l, r, n, score) in rank order."""
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                for i in range(len(words) - n + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + n])] += 1
    out = {}
    for lang, f in counts.items():
        total = sum(c for g, c in f.items() if len(g) == 1)
        longest = Counter()
        for g, c in f.items():
            if len(g) == 3 and c >= s.least:
                for part in (g[:2], g[1:]):
                    longest[part] = max(longest[part], c)
        ranked = []
        for g, a in f.items():
            if len(g) == 1 or a < s.least or 100 * longest[g] >= s.inside_percent * a and longest[g]:
                continue
            score, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            ranked.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out[lang] = [(p.decode(), -a, left, right, total, -x) for x, a, p, left, right in sorted(ranked)[: s.top]]
    return {lang: rows for lang, rows in out.items() if rows}


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.lang, r["rank"])):
        out[r.lang].append((r.phrase, r.a, r.l, r.r, r.n, r.score))
        assert r["rank"] == len(out[r.lang])
    return dict(out)


@pytest.fixture(scope="module")
def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text", "lang").collect()]


@pytest.fixture
def many_parts(spark):
    """Ranges so narrow that streams begin inside groups."""
    changed = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("bits", [15, 28])
def test_equals_brute_force(spark, rows, bits):
    s = phrases.Settings(least=4, top=300, block_bytes=50_000, filter_bits=bits)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert found(phrases.collocations(docs, s)) == brute(rows, s)


def test_streams_that_begin_inside_groups(spark, many_parts):
    rng = np.random.default_rng(5)
    vocabulary = ["the", *(f"w{i}" for i in range(12))]
    rows = [(i, " ".join(rng.choice(vocabulary, 60, p=[0.4, *[0.05] * 12])), "en") for i in range(60)]
    s = phrases.Settings(least=3, top=5000)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = brute(rows, s)
    assert len(want["en"]) > 100 and found(phrases.collocations(docs, s)) == want


def test_query_equals_sql(spark):
    query = registered.op11_phrases(spark, TABLES)
    assert compare.differences(query, compare.connect(TABLES), phrases.ORACLE_SQL) == []


def test_defined_cases(spark):
    rows = [(1, "Big Dog. " * 12, None), (2, None, "en"), (3, "", "en"), (None, "  \t. ,", "de"), (4, "één ü\x0bB a" * 11, "x\ny"), (4, "één ü\x0bB a" * 11, "x\ny")]
    rows.append((5, " ".join(["long"] * 50_000), "long"))
    docs = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], DOCS)
    s = phrases.Settings(block_bytes=1000)
    got = found(phrases.collocations(docs, s))
    assert got == brute(rows, s) and got["und"] == [("big dog", 12, 12, 12, 24, 1_000_000)]
    assert "long" in got and "x\ny" in got and "en" not in got
    assert phrases.collocations(docs.limit(0)).collect() == []


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 9 * 10**13 + 7, 9 * 10**13 + 11, 9 * 10**13 + 13
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(phrases._score("l", "r")).first()[0] == 1_000_000 * a * a // (left * right)


def test_wide_numbers_take_the_other_path():
    columns = [np.array([2**40, 2**40, 1]), np.array([2**30, 2**30, 5])]
    rows, counts = phrases.distinct(columns)
    assert [r.tolist() for r in rows] == [[1, 2**40], [5, 2**30]] and counts.tolist() == [1, 2]
