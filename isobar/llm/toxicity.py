"""Toxicity by compression distance.

One zstandard dictionary is trained on ordinary text and one on what sets toxic text apart (words
seen in clearly more contexts there). Each window of a text is compressed twice, with the ordinary
dictionary alone and with the toxic one added; bytes saved by the latter speak for toxicity.
Counts of windows that save at least a few bytes are turned into a probability by a logistic
curve, which is fitted on sample texts that neither dictionary has seen.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from isobar.llm.common import map_texts

PER_CLASS = 4000
WINDOW = 8
ORDINARY_BYTES, TOXIC_BYTES = 112_640, 16_384
TRAINING_WINDOWS = 60_000
SAVED = (2, 3, 4, 6)
CONTEXTS, DEVIATIONS, LOG_ODDS = 3, 4.0, 2.3


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray | None  # None: a class was missing, every score is 0


def windows(text: str) -> list[bytes]:
    words = text.lower().split()
    return [f" {' '.join(words[i : i + WINDOW])} ".encode("utf-8", "surrogatepass") for i in range(0, len(words), WINDOW)]


def dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary's bytes; too few samples to train on stand for themselves."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[-size:]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    """Frames without headers, and a search thorough enough that added content only helps."""
    level = zstandard.ZstdCompressionParameters.from_level(
        3, format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0,
        min_match=5, strategy=zstandard.STRATEGY_LAZY2, hash_log=18, chain_log=18, search_log=8, window_log=19, target_length=999)
    trained = zstandard.ZstdCompressionDict(content or b" " * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    trained.precompute_compress(compression_params=level)
    return zstandard.ZstdCompressor(dict_data=trained, compression_params=level)


class Scorer:
    def __init__(self, fitted: Model):
        self.fitted = fitted
        self.alone = compressor(fitted.ordinary).compress
        self.added = compressor(fitted.toxic + fitted.ordinary).compress

    def features(self, text: str) -> list[float]:
        saved = [len(self.alone(w)) - len(self.added(w)) for w in windows(text)]
        counts = [sum(s >= least for s in saved) for least in SAVED]
        return [math.log1p(c) for c in counts] + [c / max(len(saved), 1) for c in counts]

    def __call__(self, text: str) -> float:
        if self.fitted.weights is None:
            return 0.0
        x = (np.array(self.features(text)) - self.fitted.mean) / self.fitted.spread
        return float(1 / (1 + np.exp(-np.clip(self.fitted.weights[0] + x @ self.fitted.weights[1:], -30, 30))))


def _contexts(texts: list[str]) -> tuple[Counter, int]:
    """In how many different places (word before and after) each word stands: copies count once."""
    seen, found = set(), Counter()
    for text in texts:
        words = text.lower().split()
        for place in zip(["", *words], words, [*words[1:], ""]):
            if place not in seen:
                seen.add(place)
                found[place[1]] += 1
    return found, max(len(seen), 1)


def _telling(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """For each toxic text its words that stand in clearly more contexts in toxic texts."""
    (t, all_t), (o, all_o) = _contexts(toxic), _contexts(ordinary)

    def tells(word: str) -> bool:
        a, b = t[word], o[word]
        spread = math.sqrt((a + b) / (all_t + all_o) * (1 / all_t + 1 / all_o))
        odds = math.log((a + 0.5) / (all_t + 1)) - math.log((b + 0.5) / (all_o + 1))
        return a >= CONTEXTS and odds > LOG_ODDS and (a / all_t - b / all_o) / spread > DEVIATIONS

    good = {w for w in t if tells(w)}
    found = [" ".join(w for w in text.lower().split() if w in good) for text in toxic]
    return [f" {x} ".encode() for x in found if x]


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge-regularised weights with both classes counting alike."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    share = np.where(y == 1, len(y) / 2 / max(y.sum(), 1), len(y) / 2 / max((1 - y).sum(), 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (share * (p - y)) + 0.5 * w
        w = w - np.linalg.solve((x * (share * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w)), slope)
    return w


def train(rows: list[tuple[int, str]]) -> Model:
    """Three fifths of each class make the dictionaries, the rest the curve; without a signal in them every text scores 0."""
    by = {label: [t for x, t in rows if x == label] for label in (0, 1)}
    seen = {label: texts[: len(texts) * 3 // 5] for label, texts in by.items()}
    unseen = [(label, t) for label, texts in by.items() for t in texts[len(texts) * 3 // 5 :]]
    samples = sorted({w for t in seen[0] for w in windows(t)})
    step = max(1, len(samples) // TRAINING_WINDOWS)
    ordinary = dictionary(samples[::step], ORDINARY_BYTES)
    toxic = dictionary(_telling(seen[1], seen[0]), TOXIC_BYTES)
    fitted = Model(ordinary, toxic, np.zeros(0), np.zeros(0), None)
    if len({label for label, _ in unseen}) < 2:
        return fitted
    features = Scorer(fitted).features
    x, y = np.array([features(t) for _, t in unseen]), np.array([float(label) for label, _ in unseen])
    if not toxic or not x.any():
        return fitted
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    return Model(ordinary, toxic, mean, spread, _logistic((x - mean) / spread, y))


def model(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS) -> Model:
    """Fit on a bounded sample of labelled rows that ``learn`` (of doc_id) allows.

    Of several labels of one document the largest counts; null ids and labels take no part.
    """
    marked = labels.where(learn & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    counts = {r[0]: r[1] for r in marked.groupBy("toxic").count().collect()}
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(2**30)) / F.lit(float(2**30))
    share = F.when(F.col("toxic") == 1, F.lit(per_class / max(counts.get(1, 1), 1))).otherwise(
        F.lit(per_class / max(counts.get(0, 1), 1)))
    chosen = {r[0]: r[1] for r in marked.where(drawn < share).select("doc_id", "toxic").collect()}  # about per_class each
    rows = docs.where(F.col("doc_id").isin(list(chosen))).select("doc_id", F.coalesce("text", F.lit(""))).collect()
    return train([(chosen[i], text) for i, text in sorted(rows)])


def score(docs: DataFrame, fitted: Model, keep: bool = False) -> DataFrame:
    """All columns (the text only with ``keep``), and ``score`` (0 to 1); a null text scores as an empty one.

    A score depends on the text alone, so repeated rows score alike; a column called score is replaced; no rows give none.
    """
    def prepare():
        scorer = Scorer(fitted)
        return lambda texts: [[scorer(t) for t in texts]]

    return map_texts(docs, prepare, "score double", keep=keep)
