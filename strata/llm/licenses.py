"""Licence scan (operator 13): ordered signature rules, with DataFrame functions only.

A text becomes lower-case words with one space between them. Some hundred hand-written
patterns, in order (``license_rules.py``), look for sentences of licences, identifiers and
addresses, grants ("licensed under ..") and names. Two prefilters gate them: a text without
any of a few stems is not looked into, and a pattern runs only where its keyword stands.

Words are looked at in stretches of ``stretch`` words, with ``ahead`` more in which a match
that begins in the stretch may end (no pattern spans more), so work and memory are linear
in the text. A detection is an interval of words. It is suppressed if an interval of the
same or a higher priority contains it (of equal intervals the first rule's stays): a grant
hides the name in it, a licence with its version the one without. Detections are sorted by
interval, so one pass that carries the furthest end for each priority decides all.

Everything happens in the row: no shuffle, no join, and hot sources cost what their text
costs. The base phrases are found in the whole text, whatever the rules say.

Score: the highest weight of the kinds detected, 0 without any.

Defined cases: null and empty texts have no words and no labels; repeated rows and repeated
ids are scanned one by one; null ids stay null; an empty table gives an empty result; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.license_rules import KINDS, STEMS, rules

# Base phrases with their labels; what is not part of a word.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Settings:
    stretch: int = 256
    ahead: int = 64


def _text(value: str) -> str:
    return "'" + value + "'"


def _rule_array() -> str:
    """All rules as a literal array; patterns hold neither quotes nor backslashes."""
    rows = (
        f"named_struct('rank', {r.order}, 'priority', {r.priority}, 'label', {_text(r.label)}, "
        f"'keyword', {_text(r.keyword)}, 'pattern', {_text('(?<= )(?:' + r.pattern + ')(?= )')})"
        for r in rules()
    )
    return f"array({', '.join(rows)})"


def _contains_any(name: str, words: tuple[str, ...]) -> str:
    return " OR ".join(f"contains({name}, {_text(w)})" for w in words)


def _spaces(name: str) -> str:
    return f"(char_length({name}) - char_length(replace({name}, ' ', '')))"


def _found_in_stretch(s: Settings) -> str:
    """SQL for all detections that begin in stretch ``k`` of ``words``.

    Their fields sort by start, then longest first (``back`` is the end, negated), then rule.
    """
    before = (
        f"aggregate(slice(parts, 1, i + 1), 0, (a, p) -> a + {_spaces('p')})"
        f" + aggregate(slice(hits, 1, i), 0, (a, h) -> a + {_spaces('h')}) - 1"
    )
    one_rule = (
        "flatten(transform(array(split(t, r.pattern, -1)), parts -> transform(array(regexp_extract_all(t, r.pattern, 0)), hits -> "
        f"transform(hits, (m, i) -> named_struct('start', k * {s.stretch} + {before}, 'back', -(k * {s.stretch} + {before} + {_spaces('m')} + 1), "
        "'priority', r.priority, 'rank', r.rank, 'label', r.label)))))"
    )
    ran = f"flatten(flatten(transform(filter(every_rule, r -> contains(t, r.keyword)), r -> {one_rule})))"
    own = f"filter({ran}, d -> d.start < (k + 1) * {s.stretch})"
    stretch = f"concat(' ', array_join(slice(words, k * {s.stretch} + 1, {s.stretch + s.ahead}), ' '), ' ')"
    gated = f"transform(filter(array({stretch}), t -> {_contains_any('t', STEMS)}), t -> {own})"
    return f"flatten({gated})"


def _not_contained() -> str:
    """SQL for the (label, priority) of the detections that no other suppresses."""
    ends = [f"m{p}" for p in range(len(KINDS))]
    zero = ", ".join(f"'{m}', -1" for m in ends)
    reach = "element_at(array(" + ", ".join(f"a.{m}" for m in ends) + "), d.priority + 1)"
    grown = ", ".join(f"'{m}', if(d.priority <= {p}, greatest(a.{m}, -d.back), a.{m})" for p, m in enumerate(ends))
    kept = f"if({reach} >= -d.back, a.kept, array_union(a.kept, array(named_struct('label', d.label, 'priority', d.priority))))"
    start = f"named_struct({zero}, 'kept', cast(array() AS array<struct<label: string, priority: int>>))"
    return f"aggregate(array_sort(detections), {start}, (a, d) -> named_struct({grown}, 'kept', {kept})).kept"


def licenses(documents: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, found`` of every row.

    ``found`` lists the labels that rules gave, with the kind of each.
    """
    phrases = "(?<= )(?:" + "|".join(BASE) + ")(?= )"
    lower = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    base = documents.select(F.col("doc_id").cast("long").alias("doc_id"), lower.alias("lower"))
    counted = base.select("doc_id", F.regexp_count("lower", F.lit(WORD)).cast("long").alias("n_words"), F.expr(f"if({_contains_any('lower', STEMS)}, lower, '')").alias("lower"))
    plain = counted.select("doc_id", "n_words", F.concat(F.lit(" "), F.trim(F.regexp_replace("lower", GAP, " ")), F.lit(" ")).alias("plain"))

    def places(pattern: str) -> Column:
        return F.regexp_count("plain", F.lit(pattern)).cast("long")

    here = plain.withColumns({"n_base": places(phrases)} | {f"n_{label}": places(f"(?<= ){phrase}(?= )") for phrase, label in BASE.items()})
    labels = F.filter(F.array(*(F.when(F.col(f"n_{label}") > 0, label) for label in BASE.values())), lambda x: x.isNotNull())
    head = F.get(F.split("plain", phrases, 2), F.lit(0))
    tail = F.regexp_extract("plain", f"(?s)^(.*){phrases}", 1)

    def words_in(front: Column) -> Column:
        return F.when(F.col("n_base") > 0, F.char_length(front) - F.char_length(F.replace(front, F.lit(" "), F.lit(""))) - 1).cast("long")

    placed = here.select("doc_id", "n_words", "n_base", words_in(head).alias("first_word"), words_in(tail).alias("last_word"), F.array_sort(labels).alias("base"), F.expr("if(trim(plain) = '', array(), split(trim(plain), ' '))").alias("words"))
    stretches = f"if(size(words) = 0, array(), sequence(0, cast((size(words) - 1) div {s.stretch} AS int)))"
    # The rules are a constant of the plan; one array makes them a variable of the functions below.
    found = F.expr(f"flatten(flatten(transform(array({_rule_array()}), every_rule -> transform({stretches}, k -> {_found_in_stretch(s)}))))")
    detected = placed.withColumn("detections", F.when(F.size("words") > 0, found)).drop("words")
    weights = ", ".join(f"{w}D" for w in KINDS.values())
    kinds = ", ".join(_text(k) for k in KINDS)
    kept = detected.select("*", F.expr(f"coalesce({_not_contained()}, cast(array() AS array<struct<label: string, priority: int>>))").alias("kept")).drop("detections")
    every = F.array_sort(F.array_union("base", F.transform("kept", lambda d: d["label"])))
    return kept.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.expr(f"coalesce(array_max(transform(kept, d -> element_at(array({weights}), d.priority + 1))), 0D)").alias("score"),
        F.expr(f"transform(kept, d -> named_struct('label', d.label, 'kind', element_at(array({kinds}), d.priority + 1)))").alias("found"),
    )
