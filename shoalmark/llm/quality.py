"""Quality scores by a Bradley-Terry model: pairwise logistic loss on feature differences.

Each document has a worth, linear in features of its whole text. Of two labelled documents, the good
one wins with probability ``sigmoid(worth - worth)``; the weights are fitted on such pairs. A
quantile of the training scores, the one that separates the labels best, becomes the cutoff.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fit_logistic, held_out, map_texts, squash, training_labels, with_text

#: Byte classes whose shares are features: each ASCII punctuation mark, and ranges of the others.
_PUNCTUATION = [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]
_CLASSES = {"upper": (65, 91), "lower": (97, 123), "digit": (48, 58), "space": (32, 33),
            "break": (10, 11), "control": (0, 10), "other": (128, 256)}


def features(text: str) -> list[float]:
    """Measures of one whole text. The empty text has the same measures as one without words."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    seen = np.bincount(data, minlength=256)
    size = max(1, len(data))
    words = text.split()
    n = max(1, len(words))
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x.strip()]
    letters = seen[65:91].sum() + seen[97:123].sum()
    shares = [float(seen[a:b].sum()) / size for a, b in _CLASSES.values()]
    marks = [float(np.sqrt(seen[c] / size)) for c in _PUNCTUATION]
    return [
        float(np.log1p(len(words))),
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(zip(words, words[1:]))) / n,
        len(text) / n / 10,
        float(seen[65:91].sum()) / max(1, letters),
        float(np.sqrt(sum(seen[c] for c in _PUNCTUATION) / size)),
        len(set(lines)) / max(1, len(lines)),
        float(np.log1p(len(text) / max(1, len(lines)))),
        float(len(data) == 0),
        *shares,
        *marks,
    ]


def _table(texts: list[str]) -> np.ndarray:
    return np.array([features(t) for t in texts], dtype=np.float64)


@dataclass
class Ranking:
    """A fitted model: standardised features, weights, and the score where the cutoff lies."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cutoff: float
    threshold: float

    def worth(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Worth brought to 0..1 so that the cutoff lies at ``threshold``."""
        return squash(self.worth(x) - self.cutoff + np.log(self.threshold / (1 - self.threshold)))


def fit(
    x: np.ndarray, y: np.ndarray, threshold: float = 0.7, opponents: int = 8, seed: int = 7
) -> Ranking:
    """Fit on feature rows ``x`` with labels ``y``; each row meets ``opponents`` of the other label.

    Without two labels there is no pair: all weights are 0, and the score is ``threshold`` if the
    label is 1 and just below it otherwise (``threshold`` also if there are no rows at all).
    """
    if len(x) == 0:
        width = len(features(""))
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0, threshold)
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y != 1)
    if not len(good) or not len(bad):
        at = 0.0 if len(good) else 1.0
        return Ranking(centre, scale, np.zeros(x.shape[1]), at, threshold)
    rng = np.random.default_rng(seed)
    winners = np.concatenate([np.repeat(good, opponents), rng.choice(good, len(bad) * opponents)])
    losers = np.concatenate([rng.choice(bad, len(good) * opponents), np.repeat(bad, opponents)])
    z = np.clip((x - centre) / scale, -8, 8)
    weights = fit_logistic(z[winners] - z[losers], np.ones(len(winners)), l2=1.0, intercept=False)
    return Ranking(centre, scale, weights, _quantile_cut(z @ weights, y), threshold)


def _quantile_cut(worth: np.ndarray, y: np.ndarray) -> float:
    """The midpoint between two neighbouring scores at the quantile with the fewest errors."""
    order = np.argsort(worth, kind="stable")
    s, t = worth[order], (y[order] == 1)
    # Cutting below position i: the i lowest are rejected.
    errors = np.concatenate([[0], np.cumsum(t)]) + (~t).sum() - np.concatenate([[0], np.cumsum(~t)])
    allowed = np.concatenate([[True], s[1:] > s[:-1], [True]])
    errors = np.where(allowed, errors, len(s) + 1)
    best = np.flatnonzero(errors == errors.min())
    i = int(best[len(best) // 2])
    if i == 0:
        return float(s[0] - 1)
    if i == len(s):
        return float(s[-1] + 1)
    return float((s[i - 1] + s[i]) / 2)


def train(
    documents: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 4,
    rest: int = 2, threshold: float = 0.7, rows: int = 20_000,
) -> Ranking:
    """Fit on at most ``rows`` labelled documents outside the held-out remainder."""
    chosen = training_labels(labels, label, modulus, rest, rows)
    made = map_texts(
        with_text(documents, chosen).select("y", "text"),
        lambda: lambda texts: [_table(texts).tolist()],
        [("x", pa.list_(pa.float64()), "array<double>")],
    )
    found = made.toPandas()
    x = np.array(found["x"].tolist()) if len(found) else np.zeros((0, 0))
    return fit(x, found["y"].to_numpy(), threshold)


def score(
    documents: DataFrame, model: Ranking, modulus: int = 4, rest: int = 2
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; predicted is 1 from the threshold up.

    Null texts score as empty ones. Texts are read whole; repeated rows and ids give repeated
    results; an empty table gives none; a null id counts as held out; other columns are ignored.
    """
    threshold = model.threshold
    rows = documents.select("doc_id", held_out(modulus, rest).alias("held_out"), "text")
    scored = map_texts(
        rows, lambda: lambda texts: [model.score(_table(texts))],
        [("score", pa.float64(), "double")],
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
