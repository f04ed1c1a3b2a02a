"""Quality by positive-unlabelled learning.

Trusted good texts and unlabelled web text are described by the shape of their words,
lines and characters.  A linear model over binned features minimises the non-negative
unbiased risk (Kiryo et al., 2017): with the class prior p, the risk of positives counts
p times, and the risk of negatives is that of the unlabelled texts less p times that of
the positives, not allowed below zero.  The prior is estimated first, as the smallest
ratio of unlabelled to positive texts among those that a plain separator ranks highest.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawlweft.llm.samples import labelled_texts, unlabelled_texts
from crawlweft.llm.texts import as_bytes, map_rows

#: Bounds of the samples, in rows: trusted positives and unlabelled texts.
POSITIVE_ROWS = 4000
UNLABELLED_ROWS = 6000
BINS = 12
STEPS = 400
FOLDS = 2
REFINE = 1

_KINDS = np.zeros((256, 8), np.float32)
for _c in range(256):
    _KINDS[_c, 0 if 97 <= _c <= 122 else 1 if 65 <= _c <= 90 else 2 if 48 <= _c <= 57 else 3 if _c in b" \t" else 4 if _c in b"\r\n" else 5 if _c in b".,;:'\"()-?" else 6 if _c < 128 else 7] = 1


def describe(raw: bytes | None) -> list[float]:
    """The shape of one text; zeros for null and empty ones."""
    if not raw:
        return [0.0] * N_FEATURES
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts / len(raw)
    some = share[share > 0]
    ws = raw.split()
    n = max(1, len(ws))
    distinct = set(ws)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_lines = max(1, len(lines))
    lengths = np.fromiter(map(len, distinct), np.float64, len(distinct)) if distinct else np.zeros(1)
    return [
        *(share @ _KINDS).tolist(),
        float(-(some * np.log(some)).sum()),
        float(share.max()),
        float(counts[33:127][_SYMBOLS].max() / len(raw)),
        np.log1p(len(ws)),
        len(distinct) / n,
        len(distinct) / n**0.7,
        sum(map(eq, ws, islice(ws, 1, None))) / n,
        sum(map(eq, ws, islice(ws, 2, None))) / n,
        len(raw) / n,
        float(lengths.mean()),
        float(lengths.std()),
        len(set(lines)) / n_lines,
        np.log1p(len(raw) / n_lines),
        sum(x[-1:] in b".!?\"'" for x in lines) / n_lines,
        sum(w.isalpha() and w.isupper() for w in ws) / n,
    ]


_SYMBOLS = np.array([not chr(c).isalnum() and chr(c) not in ".,;:'\"()-?" for c in range(33, 127)])
N_FEATURES = 23


@dataclass
class QualityModel:
    """Bin edges per feature, one weight per bin, and the estimated class prior."""

    edges: list[np.ndarray]
    weights: np.ndarray
    prior: float

    def places(self, x: np.ndarray) -> np.ndarray:
        """Column numbers of the bins that each row falls in."""
        base = np.concatenate(([0], np.cumsum([len(e) + 1 for e in self.edges])))[:-1]
        return np.stack([np.searchsorted(e, x[:, k], side="right") + b for k, (e, b) in enumerate(zip(self.edges, base, strict=True))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.places(x)].sum(axis=1) + self.weights[-1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _descend(places: np.ndarray, width: int, gradient, steps: int) -> np.ndarray:
    """Adam over the bins' weights; `gradient` gives the slope of the risk at each row's output."""
    w, first, second = np.zeros(width + 1), np.zeros(width + 1), np.zeros(width + 1)
    flat = places.ravel()
    for step in range(1, steps + 1):
        slope = gradient(w[places].sum(axis=1) + w[-1])
        total = np.bincount(flat, np.repeat(slope, places.shape[1]), minlength=width + 1)[: width + 1]
        total[-1] = slope.sum()
        total += 1e-4 * w
        first = 0.9 * first + 0.1 * total
        second = 0.999 * second + 0.001 * total**2
        w -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from the outputs of a separator on both.

    Above any threshold, positives make at most all of the unlabelled rows, so the ratio
    of the two tails bounds the share from above; the smallest ratio over tails with
    enough positives is taken, averaged over the three smallest.
    """
    p, u = np.sort(positive), np.sort(unlabelled)
    ratios = [1.0] * 3
    for q in np.linspace(0.05, 0.7, 14):
        cut = np.quantile(p, q)
        above = 1 - np.searchsorted(p, cut, side="left") / len(p)
        also = 1 - np.searchsorted(u, cut, side="left") / len(u)
        if above > 0.05:
            ratios.append(also / above)
    return float(np.clip(np.mean(sorted(ratios)[:3]), 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, steps: int = STEPS) -> QualityModel | None:
    """Minimise the non-negative unbiased risk with logistic loss; None without rows of both kinds."""
    if not len(positive) or not len(unlabelled):
        return None
    x = np.concatenate((positive, unlabelled))
    n_p, n_u = len(positive), len(unlabelled)
    edges = [np.unique(np.quantile(unlabelled[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    # Rare kinds of text lie at the ends, so the outer bins are cut again.
    edges = [np.unique(np.r_[e, np.quantile(unlabelled[:, k], (0.01, 0.03, 0.06, 0.94, 0.97, 0.99))]) for k, e in enumerate(edges)]
    model = QualityModel(edges, np.zeros(sum(len(e) + 1 for e in edges) + 1), 0.5)
    places, width = model.places(x), len(model.weights) - 1
    is_p = np.arange(len(x)) < n_p

    # The prior is read off rows that their separator did not see.
    out, fold = np.zeros(len(x)), np.arange(len(x)) % FOLDS
    for k in range(FOLDS):
        seen = fold != k
        p_seen = is_p[seen]

        def plain(z, p_seen=p_seen):
            s = _sigmoid(z)
            return np.where(p_seen, (s - 1) / max(1, p_seen.sum()), s / max(1, (~p_seen).sum()))

        w = _descend(places[seen], width, plain, steps // 2)
        out[~seen] = w[places[~seen]].sum(axis=1) + w[-1]
    model.prior = prior = estimate_prior(out[is_p], out[~is_p])

    def non_negative(z):
        s = _sigmoid(z)
        loss = np.logaddexp(0, z)  # of calling a row negative's opposite
        negative = loss[~is_p].mean() - prior * loss[is_p].mean()
        of_negative = np.where(is_p, -prior * s / n_p, s / n_u)
        if negative < 0:  # the negative part may not fall below zero: step back along it alone
            return -of_negative
        return np.where(is_p, prior * (s - 1) / n_p, 0) + of_negative

    # A model of that prior separates better than the plain one, and so tells the prior better.
    for turn in range(REFINE + 1):
        model.weights = _descend(places, width, non_negative, steps)
        if turn < REFINE:
            out = model.raw(x)
            model.prior = prior = min(prior, estimate_prior(out[is_p], out[~is_p]))
    return model


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    positive_rows: int = POSITIVE_ROWS,
    unlabelled_rows: int = UNLABELLED_ROWS,
) -> QualityModel | None:
    """Fit on bounded samples: rows of `labels` that say 1, and `docs` without any label."""
    positive, _ = labelled_texts(docs, labels, label, {1: positive_rows}, doc_id, text)
    unlabelled = unlabelled_texts(docs, unlabelled_rows, doc_id, text)
    rows = [np.array([describe(t.encode()) for t in x]).reshape(-1, N_FEATURES) for x in (positive[1], unlabelled)]
    return fit(*rows)


def score_quality(docs: DataFrame, model: QualityModel | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, score (0 to 1, higher: rather good), predicted (1 from 0.5 on).

    Whole texts are described.  Null and empty texts have the score of a text without
    words; without a model (no positives) all scores are 0.5.  Each row gives one row where
    it was read; repeated and null ids are kept and other columns ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def rows(batch):
        x = np.array([describe(t) for t in batch["text"].to_pylist()]).reshape(-1, N_FEATURES)
        s = model.scores(x) if model else np.full(len(x), 0.5)
        return {"doc_id": batch["doc_id"], "score": s.tolist(), "predicted": [int(v >= 0.5) for v in s]}

    return map_rows(docs.select(F.col(doc_id).alias("doc_id"), as_bytes(text)), rows, f"doc_id {kind}, score double, predicted int")
