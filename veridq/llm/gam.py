"""Quality classifier: a generalised additive model with pairwise interactions.

Features come from the text alone.  Training is cyclic boosting: round after round,
each feature in turn gets a shallow tree (at most ``LEAVES`` intervals of its bins) fitted
to the current residual, and the tree's step is added to that feature's lookup table;
then the pairs with the largest interaction are boosted the same way on a grid of
coarser bins.  A score is the sum of the table entries at a text's bins.

The model is trained on at most ``MAX_TRAIN`` labelled rows (the ones with the smallest
hash of their id, so the choice does not depend on order); all documents are scored.
Rows with crc32(doc_id as text) mod 3 = 1 are held out of training.

Edge cases: null or empty text has defined features and is scored; null ids are never
held out; labels that are null are not used; without labels, or with one class only,
the score is the share of label 1 (0.5 without labels); repeated rows score alike.
"""

from __future__ import annotations

import itertools
import operator
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from veridq.llm.bpe import _mapped
from veridq.llm.common import arrow_map, free_name, read

MAX_TRAIN = 20_000
BINS, PAIR_BINS, LEAVES = 32, 8, 3
ROUNDS, PAIR_ROUNDS, PAIRS, RATE = 80, 20, 6, 0.2

FEATURES = (
    "log_chars", "log_words", "word_len", "upper_words", "unique_words", "adjacent_same", "top_word",
    "pipes", "bangs", "symbols", "digits", "stops", "commas", "spaces", "line_words", "same_lines", "non_ascii",
)


def features(text: str | None) -> list[float]:
    """Shape of a text as numbers; an empty one has zeros."""
    t = text or ""
    n = len(t)
    words = t.split()
    w = len(words)
    if not w:
        return [float(np.log1p(n))] + [0.0] * (len(FEATURES) - 1)
    count = t.count
    met = Counter(words)
    lines = [x for x in t.split("\n") if x.strip()]
    letters = sum(map(len, words))
    return [
        float(np.log1p(n)),
        float(np.log1p(w)),
        letters / w,
        sum(map(str.isupper, words)) / w,
        len(met) / w,
        sum(map(operator.eq, words, itertools.islice(words, 1, None))) / w,
        max(met.values()) / w,
        count("|") / w,
        count("!") / w,
        sum(map(count, "#$%&*@^~<>{}=+\\")) / w,
        sum(map(count, "0123456789")) / letters,
        count(".") / w,
        count(",") / w,
        (n - letters) / w,
        w / len(lines),
        1 - len(set(lines)) / len(lines),
        1 - len(t.encode("ascii", "ignore")) / n,
    ]


class Model:
    """Cut points and lookup tables; ``score`` is vectorised over rows."""

    def __init__(self, base: float, cuts: list[np.ndarray], tables: list[np.ndarray], pairs: list[tuple[int, int, np.ndarray]], coarse: list[np.ndarray]):
        self.base, self.cuts, self.tables, self.pairs, self.coarse = base, cuts, tables, pairs, coarse

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            total += t[np.searchsorted(self.cuts[j], x[:, j], side="right")]
        for a, b, t in self.pairs:
            total += t[np.searchsorted(self.coarse[a], x[:, a], side="right"), np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(col: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1]))


def _step(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Values of a shallow tree over ordered bins: best splits by gain, Newton leaves."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    gain = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + 1)
    ends = [0, len(g)]
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in itertools.pairwise(ends):
            if b - a > 1:
                at = np.arange(a + 1, b)
                up = gain(a, at) + gain(at, b) - gain(a, b)
                k = int(up.argmax())
                best = max(best, (float(up[k]), int(at[k])), key=lambda v: v[0])
        if best[1] is None:
            break
        ends = sorted([*ends, best[1]])
    out = np.empty(len(g))
    for a, b in itertools.pairwise(ends):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + 1)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best cross-shaped cut of a grid: its gain and the four leaves' values."""
    cg, ch = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, h))
    best, out = -1.0, np.zeros_like(g)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            parts = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, None)), (slice(i, None), slice(0, j)), (slice(i, None), slice(j, None))]
            sg = np.array([cg[i, j], cg[i, -1] - cg[i, j], cg[-1, j] - cg[i, j], cg[-1, -1] - cg[i, -1] - cg[-1, j] + cg[i, j]])
            sh = np.array([ch[i, j], ch[i, -1] - ch[i, j], ch[-1, j] - ch[i, j], ch[-1, -1] - ch[i, -1] - ch[-1, j] + ch[i, j]])
            gain = float((sg**2 / (sh + 1)).sum())
            if gain > best:
                best = gain
                for p, v in zip(parts, sg / (sh + 1), strict=True):
                    out[p] = v
    return best, out


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of the logistic loss: single features, then pairs."""
    n, m = x.shape
    if n == 0 or y.min() == y.max():
        p = 0.5 if n == 0 else float(np.clip(y.mean(), 0.001, 0.999))
        return Model(float(np.log(p / (1 - p))), [np.array([])] * m, [np.zeros(1)] * m, [], [np.array([])] * m)
    p = float(y.mean())
    base = float(np.log(p / (1 - p)))
    cuts = [_cuts(x[:, j], BINS) for j in range(m)]
    coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(m)]
    at = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
    low = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(coarse)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(n, base)
    grad = lambda: (y - (q := 1 / (1 + np.exp(-total))), q * (1 - q))
    for _ in range(ROUNDS):
        for j in range(m):
            r, w = grad()
            size = len(tables[j])
            step = RATE * _step(np.bincount(at[j], r, size), np.bincount(at[j], w, size))
            tables[j] += step
            total += step[at[j]]
    grids = {}
    r, w = grad()
    for a, b in itertools.combinations(range(m), 2):
        grids[a, b] = (len(coarse[a]) + 1, len(coarse[b]) + 1)
    sums = lambda a, b, v: np.bincount(low[a] * grids[a, b][1] + low[b], v, grids[a, b][0] * grids[a, b][1]).reshape(grids[a, b])
    gains = {k: _quadrants(sums(*k, r), sums(*k, w))[0] for k in grids if min(grids[k]) > 1}
    chosen = sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS]
    pairs = {k: np.zeros(grids[k]) for k in chosen}
    for _ in range(PAIR_ROUNDS):
        for a, b in chosen:
            r, w = grad()
            step = RATE * _quadrants(sums(a, b, r), sums(a, b, w))[1]
            pairs[a, b] += step
            total += step[low[a], low[b]]
    return Model(base, cuts, tables, [(a, b, t) for (a, b), t in pairs.items()], coarse)


def held_out(doc_id):
    """crc32 of the id as text, mod 3, is 1; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN) -> Model:
    """Train on labelled rows that are not held out, ``max_train`` at most."""
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y"))
    sample = named.where("doc_id is not null and y is not null").where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "y").limit(max_train)
    # max_train rows of two numbers: a proven size
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")

    def make():
        def fn(ids, ys, texts):
            return {"doc_id": ids, "y": ys, "x": [features(t) for t in texts]}

        return fn

    # an id may occur in several documents, so the limit holds for what was joined
    found = arrow_map(rows, make, "doc_id long, y double, x array<double>", "doc_id", "y", "text")
    got = found.orderBy(F.xxhash64("doc_id"), "y", "x").limit(max_train).collect()
    got.sort(key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id, r.y, r.x))
    x = np.array([r.x for r in got], dtype=float).reshape(len(got), len(FEATURES))
    return train(x, np.array([r.y for r in got]))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with all columns and the score."""

    def make():
        def fn(texts):
            x = np.array([features(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
            return (model.score(x),)

        return fn

    return _mapped(docs, (), [StructField(name, DoubleType())], "text", make)


def keep_good(docs: DataFrame, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    """Documents that the classifier does not reject, with the columns of ``docs``."""
    model, name = fit(docs, read(docs.sparkSession, sf_dir, "labels")), free_name(docs, "score")
    return score(docs, model, name).where(F.col(name) >= threshold).select(*docs.columns)
