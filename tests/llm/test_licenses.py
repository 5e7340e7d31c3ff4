"""Licence scan against the same rules in plain Python."""

from __future__ import annotations

import random
import re
import re._parser as grammar

import pytest

from strata.llm import licenses, registered
from strata.llm.license_rules import KINDS, STEMS, rules

TABLES = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lower string, words string, found string"
RULES = [(r, re.compile(f"(?<= )(?:{r.pattern})(?= )")) for r in rules()]


def sample(tree, rng):
    """A text that a parsed pattern matches."""
    out = ""
    for op, arg in tree:
        match str(op):
            case "LITERAL":
                out += chr(arg)
            case "IN":
                kind, value = rng.choice(arg)
                out += "q" if str(kind) == "NEGATE" or str(arg[0][0]) == "NEGATE" else chr(value[0] if str(kind) == "RANGE" else value)
            case "NOT_LITERAL":
                out += "q"
            case "MAX_REPEAT":
                out += "".join(sample(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 30))))
            case "SUBPATTERN":
                out += sample(arg[3], rng)
            case "BRANCH":
                out += sample(rng.choice(arg[1]), rng)
            case _:
                raise ValueError(op)
    return out


def brute(text, s=licenses.Settings()):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    starts = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    detections = []
    for k in range(0, len(words), s.stretch):
        t = " " + " ".join(words[k : k + s.stretch + s.ahead]) + " "
        if any(stem in t for stem in STEMS):
            for rule, pattern in RULES:
                for m in pattern.finditer(t):
                    start = k + t[: m.start()].count(" ") - 1
                    if start < k + s.stretch:
                        detections.append((start, start + len(m[0].split()), rule))
    kept = [
        a for a in detections
        if not any(
            b[0] <= a[0] and b[1] >= a[1] and (b[:2] != a[:2] and b[2].priority <= a[2].priority or b[:2] == a[:2] and (b[2].priority, b[2].order) < (a[2].priority, a[2].order))
            for b in detections
        )
    ]
    base = {label for _, label in starts}
    labels = base | {r.label for _, _, r in kept}
    places = [i for i, _ in starts]
    score = max([KINDS[r.kind] for _, _, r in kept], default=0.0)
    return (len(words), len(starts), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score)


def scanned(spark, texts):
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts)]
    got = licenses.licenses(spark.createDataFrame(rows, DOCS)).collect()
    return [tuple(r)[1:8] for r in sorted(got, key=lambda r: r.doc_id)]


def test_rules_hold_their_keywords_and_bounds():
    rng = random.Random(3)
    assert len(RULES) > 300 and not any(c in r.pattern for r, _ in RULES for c in "'\\")
    for rule, _ in RULES:
        tree = grammar.parse(rule.pattern)
        for _ in range(10):
            text = sample(tree, rng)
            assert re.fullmatch(rule.pattern, text) and rule.keyword and rule.keyword in text
            assert any(stem in text for stem in STEMS)
            assert len(text.split()) <= licenses.Settings().ahead and "  " not in text


def test_equals_plain_python(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(150):
        parts = []
        for _ in range(rng.randint(1, 12)):
            rule = rng.choice(RULES)[0]
            words = sample(grammar.parse(rule.pattern), rng).split()
            parts += words[: rng.choice([len(words)] * 4 + [max(1, len(words) - 1)])] + ["é"] * rng.choice([0, 0, 1, 40, 240])
        texts.append("".join((w.upper() if rng.random() < 0.2 else w) + rng.choice([" ", "\n", "-", ". ", "\t# "]) for w in parts))
    assert scanned(spark, texts) == [brute(t) for t in texts]


@pytest.mark.parametrize(
    ("text", "labels", "score"),
    [
        ("Released under the MIT License.", "mit", 0.9),
        ("// SPDX-License-Identifier: Apache-2.0", "apache-2.0", 0.95),
        ("licensed under the GNU Lesser General Public License, version 2.1", "gpl,lgpl-2.1", 0.9),
        ("See https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa-4.0", 0.95),
        ("a mit, a gpl and the public domain", "", 0.0),
        ("bMIT License, MIT Licenses", "", 0.0),
    ],
)
def test_labels(spark, text, labels, score):
    assert scanned(spark, [text])[0][5:] == (labels, score) == brute(text)[5:]


def test_defined_cases(spark):
    long = "word " * 40_000 + "Apache License 2.0 " + "wörd " * 1000 + "mit license " * 500
    texts = [None, "", " .-_", "MIT License", "MIT License", long]
    got = scanned(spark, texts)
    assert got[:5] == [brute(t) for t in texts[:5]]
    assert got[5] == (42_004, 501, 40_000, 42_002, "apache,mit", "apache,apache-2.0,mit", 0.6)
    assert licenses.licenses(spark.createDataFrame([], DOCS)).count() == 0
    assert licenses.licenses(spark.createDataFrame([(None, None, "a", "b", "c")], DOCS).union(spark.createDataFrame([(None, "x", "a", "b", "c")], DOCS))).count() == 2


def test_query_is_native_and_whole(spark):
    df = registered.op13_licenses(spark, TABLES)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}
    assert {r.doc_id: tuple(r)[1:] for r in df.collect()} == {i: brute(t) for i, t in texts.items()}
