"""Quality rules (operator 10): tokeniser fertility with bands per script.

A public vocabulary measures each whole text: characters per token, the share of
tokens that are bytes the vocabulary has no piece for (line breaks and tabs aside),
and the entropy of the tokens. A band per script rejects texts outside it: it is
the fixed limits of ``BANDS`` drawn inwards, to the outer percents of these measures over
all ``n`` documents that pass the base rules, by ``n / (n + prior_documents)`` of the way.
Simple counts of words, symbols, repeated lines and repeated 8-word windows come first;
texts they fail are not judged further.

One pass over the table, whose counts and measures are stored without texts; what is
shuffled are histograms of the measures in thousandths. The vocabulary file is read by the driver
(``model_path`` is a parameter) and travels with the job.

Defined cases: a null or empty text has no words and fails the base rules; repeated
rows are judged alike and count as documents; a null ``doc_id`` stays null; a long text is
a batch of its own; an empty table gives an empty result; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_rows, stored

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass(frozen=True)
class Band:
    """What a text of a script may measure, ends included."""

    chars_per_token: tuple[float, float]
    byte_share: float
    entropy: float  # least bits per token, as a share of the most a text of its length can have


#: The widest bands by script. Scripts the vocabulary hardly covers break into
#: bytes, so their clean texts have few characters and many byte tokens.
BANDS = {
    "latin": Band((1.62, 8.0), 0.10, 0.4),
    "greek": Band((0.9, 6.0), 0.15, 0.4),
    "cyrillic": Band((1.0, 8.0), 0.10, 0.4),
    "arabic": Band((0.6, 6.0), 0.35, 0.4),
    "hebrew": Band((0.6, 6.0), 0.35, 0.4),
    "indic": Band((0.3, 6.0), 0.8, 0.3),
    "cjk": Band((0.4, 4.0), 0.7, 0.4),
    "other": Band((0.25, 8.0), 0.9, 0.3),
}

#: Character ranges by script.
SCRIPTS = {
    "latin": "A-Za-zÀ-ɏḀ-ỿ",
    "greek": "Ͱ-Ͽἀ-῿",
    "cyrillic": "Ѐ-ԯ",
    "arabic": "؀-ۿݐ-ݿ",
    "hebrew": "֐-׿",
    "indic": "ऀ-෿",
    "cjk": "぀-ヿ㐀-鿿가-힯",
}

LETTERS = {name: re.compile(f"[{ranges}]+") for name, ranges in SCRIPTS.items()}
SYMBOLS = b"#*$%&|<>"
MEASURES = ("chars_per_token", "byte_share", "token_entropy")


@dataclass(frozen=True)
class Rules:
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8
    bands: dict[str, Band] = field(default_factory=lambda: dict(BANDS))
    outer_percent: float = 1.0
    slack: tuple[float, float] = (0.65, 1.5)  # below and above: times the way from the median to the outer percent
    least_byte_share: float = 0.05
    prior_documents: int = 500


def script_of(text: bytes) -> str:
    """The script most letters belong to; ``other`` without letters of a known one."""
    if text.isascii():
        return "latin" if re.search(b"[A-Za-z]", text) else "other"
    decoded = text.decode("utf-8", "replace")
    rest, best, most = len(decoded), "other", 0
    for name, pattern in LETTERS.items():
        n = sum(map(len, pattern.findall(decoded)))
        if n > most:
            best, most = name, n
        rest -= n
        if rest <= most:
            break
    return best


def repeated(names: np.ndarray, window: int) -> int:
    """Words inside windows of ``window`` words that occur twice or more.

    ``names`` has a number for each word. Hashes of the windows tell texts without
    a repetition; in others windows get exact numbers by doubling: a number stands
    for 1, 2, 4 ... words.
    """
    n = len(names) - window + 1
    if n < 2:
        return 0
    hashes = np.zeros(n, np.uint64)
    for k in range(window):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + names[k : k + n].astype(np.uint64)
        hashes ^= hashes >> np.uint64(29)
    hashes.sort()
    if not (hashes[1:] == hashes[:-1]).any():
        return 0
    _, names = np.unique(names, return_inverse=True)
    length, counts = 1, np.empty(0, int)
    while length < window:
        step = min(length, window - length)
        pairs = names[:-step] * (int(names.max()) + 1) + names[step:]
        _, names, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        length += step
    starts = np.flatnonzero(counts[names] > 1)
    size = n + window
    edges = np.bincount(starts, minlength=size) - np.bincount(starts + window, minlength=size)
    return int(np.count_nonzero(np.cumsum(edges)))


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    counts = Counter(text.split(b"\n"))
    if len(counts) == text.count(b"\n") + 1:
        return 0
    return sum(n - 1 for line, n in counts.items() if n > 1 and line.split())


class Words(dict):
    """A number for each word, and what the vocabulary makes of it.

    ``bytes.split`` separates at the same six characters as the word pattern. Pieces
    of this vocabulary never reach over the start of a word, so words can be
    encoded apart, each once.
    """

    LIMIT = 200_000

    def __init__(self, model: bytes):
        super().__init__()
        self.model, self.processor = model, None

    def _load(self):
        import sentencepiece

        p = self.processor = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        self.odd = np.array([
            p.is_unknown(i) or p.is_byte(i) and int(p.id_to_piece(i)[3:5], 16) not in (9, 10, 13)
            for i in range(p.get_piece_size())
        ])
        self._reset()

    def _reset(self):
        self.clear()
        self.chars, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ends = np.zeros(1, np.int64)  # of each word's pieces in ids

    def numbers(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Numbers of the words of all texts, that hold until the next call."""
        if self.processor is None:
            self._load()
        if len(self) > self.LIMIT:
            self._reset()
        new = list({w for words in texts for w in words if w not in self})
        if new:
            decoded = [w.decode("utf-8", "replace") for w in new]
            coded = self.processor.encode(decoded, num_threads=1)
            self.update(zip(new, range(len(self), len(self) + len(new)), strict=True))
            self.chars = np.append(self.chars, np.fromiter(map(len, decoded), np.int64, len(new)))
            self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(np.fromiter(map(len, coded), np.int64, len(new))))
            self.ids = np.append(self.ids, np.fromiter((i for c in coded for i in c), np.int64))
        return [np.fromiter(map(self.__getitem__, w), np.int64, len(w)) for w in texts]

    def measure(self, numbers: np.ndarray) -> tuple[float, float, float]:
        """Characters per token, share of byte tokens, entropy of the tokens of a text.

        The entropy is a share of the most that so many tokens can have.
        """
        starts, sizes = self.ends[numbers], self.ends[numbers + 1] - self.ends[numbers]
        n = int(sizes.sum())
        if not n:
            return 0.0, 0.0, 0.0
        at = np.arange(n) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
        ids = np.sort(self.ids[at])
        edges = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1], [True]]))
        p = np.diff(edges) / n
        most = np.log2(min(n, len(self.odd)))
        entropy = float(-(p * np.log2(p)).sum() / most) if most > 0 else 1.0
        return float(self.chars[numbers].sum()) / n, float(self.odd[ids].mean()), entropy


def measured_bands(measured: DataFrame, rules: Rules) -> dict[str, Band]:
    """The band of each script, from all rows of ``measured`` that pass the base rules."""
    values = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.round(F.col(m) * 1000).cast("long").alias("value")) for m in MEASURES)))
    counted = measured.where("not base_failed").select("script", values.alias("v")).groupBy("script", "v.measure", "v.value").count()
    histograms: dict[tuple[str, str], list[tuple[int, int]]] = {}
    for script, measure, value, n in counted.collect():  # bounded by the scripts and the thousandths
        histograms.setdefault((script, measure), []).append((value, n))
    return {script: _narrowed(band, [histograms.get((script, m), []) for m in MEASURES], rules) for script, band in rules.bands.items()}


def _narrowed(band: Band, histograms: list[list[tuple[int, int]]], rules: Rules) -> Band:
    """The fixed ``band`` drawn towards the measured one, the more the more documents were measured."""
    total = sum(n for _, n in histograms[0])
    if not total:
        return band
    trust = total / (total + rules.prior_documents)
    fences = []
    for histogram in histograms:
        values, counts = np.array(sorted(histogram)).T
        shares = np.array([rules.outer_percent, 50, 100 - rules.outer_percent]) / 100
        low, middle, high = (values[np.searchsorted(np.cumsum(counts), shares * counts.sum())] / 1000).tolist()
        fences.append((low - rules.slack[0] * (middle - low), high + rules.slack[1] * (high - middle)))
    (least, most), (_, share), (entropy, _) = fences

    def drawn(fixed: float, measured: float) -> float:
        return fixed + trust * (measured - fixed)

    fixed_least, fixed_most = band.chars_per_token
    chars = drawn(fixed_least, max(fixed_least, least)), drawn(fixed_most, min(fixed_most, most))
    narrow = min(band.byte_share, max(share, rules.least_byte_share))
    return Band(chars, drawn(band.byte_share, narrow), drawn(band.entropy, max(band.entropy, entropy)))


def within(bands: dict[str, Band]) -> Column:
    """Whether the measures of a row are in the band of its script."""
    out = F.lit(False)
    for script, band in bands.items():
        inside = F.col("chars_per_token").between(*band.chars_per_token) & (F.col("byte_share") <= band.byte_share)
        out = F.when(F.col("script") == script, inside & (F.col("token_entropy") >= band.entropy)).otherwise(out)
    return out


KINDS = (*[pa.int64()] * 5, pa.bool_(), pa.string(), *[pa.float64()] * 3)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = (
    "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, script string, "
    + ", ".join(f"{m} double" for m in MEASURES)
)


def measures(documents: DataFrame, rules: Rules = Rules(), model_path: str = MODEL_PATH) -> DataFrame:
    """Counts and measures of every row, and whether it fails the base rules."""
    known = Words(Path(model_path).read_bytes())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
        numbers = known.numbers([t.split() for t in texts])
        rows = []
        for text, words in zip(texts, numbers, strict=True):
            repeats = repeated(words, rules.window)
            symbols = len(text) - len(text.translate(None, SYMBOLS))
            failed = len(words) < rules.min_words or 100 * repeats > rules.max_repeat_percent * len(words)
            script, measured = script_of(text), known.measure(words)
            chars = int(known.chars[words].sum())
            rows.append((len(words), chars, symbols, duplicate_lines(text), repeats, failed, script, *measured))
        columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), KINDS, strict=True)]
        return pa.record_batch([batch.column(0), *columns], ["doc_id", *COUNTS, "base_failed", "script", *MEASURES])

    return map_rows(documents.select(F.col("doc_id").cast("long"), "text"), run, SCHEMA)


def quality_rules(documents: DataFrame, rules: Rules = Rules(), model_path: str = MODEL_PATH) -> DataFrame:
    """Counts, measures and the verdict of every row."""
    measured = stored(documents.sparkSession, measures(documents, rules, model_path), "fertility")
    kept = ~F.col("base_failed") & within(measured_bands(measured, rules))
    return measured.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "script", *MEASURES)
