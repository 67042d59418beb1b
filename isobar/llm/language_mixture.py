"""Language identification by mixture inference over character n-grams.

Each language is a smoothed distribution of hashed character trigrams. A document is taken as a
mixture: expectation-maximisation over its trigrams gives every language's proportion. Languages
are then admitted one by one, in order of proportion, while the penalised likelihood gains; the
prediction is the one with the largest share in the chosen set.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from isobar.llm.common import map_texts
from isobar.llm.sampling import sample

BUCKETS = 1 << 15
SMOOTHING = 0.5
ROUNDS = 20
PER_LANGUAGE = 1500
UNKNOWN = "und"
SPACE = 32


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point whether it is a letter; made once in each process."""
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def trigrams(text: str) -> np.ndarray:
    """Buckets of all trigrams of lower-case letters, with anything else as one space; empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = letters()[points]
    if not letter.any():
        return np.empty(0, np.int64)
    points = np.where(letter, points, SPACE)
    kept = letter.copy()
    kept[1:] |= letter[:-1]  # the first of a run of others
    points = np.concatenate([[SPACE], points[kept], [SPACE]]).astype(np.uint64)
    code = points[:-2] * np.uint64(0x9E3779B1) + points[1:-1] * np.uint64(0x85EBCA77) + points[2:] * np.uint64(0xC2B2AE3D)
    code ^= code >> np.uint64(29)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    return (code >> np.uint64(40)).astype(np.int64) % BUCKETS


def train(rows: list[tuple[str, str]]) -> tuple[list[str], np.ndarray]:
    """Languages and their trigram probabilities (bucket by language)."""
    counts: dict[str, np.ndarray] = {}
    for language, text in rows:
        found = trigrams(text)
        if len(found):
            counts[language] = counts.get(language, 0) + np.bincount(found, minlength=BUCKETS)
    languages = sorted(counts)
    table = np.array([counts[x] + SMOOTHING for x in languages], float).reshape(len(languages), BUCKETS).T
    return languages, table / table.sum(axis=0, keepdims=True) if languages else table


def proportions(likelihood: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
    """Mixture weights by EM and the log-likelihood they reach."""
    total, k = counts.sum(), likelihood.shape[1]
    weights = np.full(k, 1 / k)
    for _ in range(ROUNDS if k > 1 else 0):
        joint = likelihood * weights
        new = counts @ (joint / joint.sum(axis=1, keepdims=True)) / total
        moved = np.abs(new - weights).max()
        weights = new
        if moved < 1e-3:
            break
    return weights, float(counts @ np.log(likelihood @ weights))


def mixture(text: str, table: np.ndarray) -> dict[int, float]:
    """The chosen languages' proportions, largest first; none without a letter."""
    found = trigrams(text)
    if not len(found) or not table.shape[1]:
        return {}
    grams, counts = np.unique(found, return_counts=True)
    likelihood, counts = table[grams], counts.astype(float)
    weights, _ = proportions(likelihood, counts)
    single = counts @ np.log(likelihood)
    first = int(np.argmax(single))
    order = [first] + [i for i in np.argsort(-weights, kind="stable").tolist() if i != first]
    # Trigrams overlap: three of them count as one observation, and a language costs one parameter.
    penalty = 0.5 * np.log(max(counts.sum() / 3, 2))
    chosen, best = {first: 1.0}, single[first] / 3
    for m in range(2, len(order) + 1):
        if weights[order[m - 1]] * counts.sum() < 3:
            break
        own, reached = proportions(likelihood[:, order[:m]], counts)
        if reached / 3 - (m - 1) * penalty <= best:
            break
        chosen, best = dict(zip(order[:m], own.tolist())), reached / 3 - (m - 1) * penalty
    return dict(sorted(chosen.items(), key=lambda x: (-x[1], x[0])))


def confidence(text: str, table: np.ndarray, best: int) -> float:
    """How far the best language's likelihood of the text stands out, as a posterior for a few words of it."""
    found = trigrams(text)
    grams, counts = np.unique(found, return_counts=True)
    mean = counts @ np.log(table[grams]) / counts.sum() * min(counts.sum(), 12)
    return float(1 / np.exp(mean - mean[best]).sum())


def predictor(languages: list[str], table: np.ndarray):
    def predict_texts(texts: list[str]) -> list[list]:
        names, scores, mixed = [], [], []
        for text in texts:
            shares = mixture(text, table)
            best = next(iter(shares), None)
            names.append(UNKNOWN if best is None else languages[best])
            scores.append(0.0 if best is None else min(1.0, shares[best] * confidence(text, table, best)))
            mixed.append([(languages[i], share) for i, share in shares.items()])
        return [names, scores, mixed]

    return predict_texts


def model(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Fit on a bounded sample of the rows that ``learn`` allows and whose lang is known."""
    rows = sample(docs.where(learn).select("doc_id", "lang", "text"), "lang", F.col("doc_id"), per_language)
    return train(rows)


def predict(docs: DataFrame, fitted: tuple[list[str], np.ndarray], keep: bool = False) -> DataFrame:
    """All columns (the text only with ``keep``), with lang_pred, score (share of the language times how far it
    stands out) and mixture added.

    A text that is null or has no letter gets ``und``, score 0 and an empty mixture, as does every
    text if nothing was learned. Columns of these names are replaced; the text is used whole.
    """
    return map_texts(docs, lambda: predictor(*fitted), "lang_pred string, score double, mixture map<string,double>", keep=keep)
