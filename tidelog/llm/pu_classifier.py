"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are enough: with class prior p and a loss
bounded to 0..1, the risk is p R+(pos) + max(0, R-(unl) - p R-(pos)).  Where the
estimate of the negatives' risk falls below zero, a step goes against its gradient
instead, so that the model doesn't learn the unlabelled rows by heart.  The model is
a linear one over measurements of the text and hashed character classes of word ends.

No label of another class is used.  The class prior is estimated from positives and
unlabelled text: among texts that look most like positives, the share of
unlabelled ones against that of positives falls to the prior where no others are left.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.tables import crc32_mod, map_batches, texts

#: The fold held out: crc32 of the id modulo FOLDS.
FOLDS, HELD_OUT = 4, 2
#: Positive rows, and unlabelled ones, that the model is fitted on at most: hash samples of all outside the fold.
SAMPLE_ROWS = 6_000
#: Rows of either kind from which the class prior is estimated.
LEAST_ROWS = 20
#: Hashed features.
BUCKETS = 512
#: Score from which a text counts as good.
THRESHOLD = 0.7

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>@^~_=+{}\[\]\\/]")
MEASURES = 16


def _measures(text: str) -> np.ndarray:
    """Shares and logarithms, each roughly between 0 and 1; zeros for a text without words."""
    words = _WORD.findall(text)
    n, size = len(words), len(text)
    if not n:
        return np.zeros(MEASURES)
    lines = [x for x in text.split("\n") if x.strip()]
    triples = list(zip(words, words[1:], words[2:]))
    letters = sum(map(str.isalpha, text)) or 1
    raised = len(re.findall(r"[A-Z]", text))
    return np.array(
        [
            1.0,
            np.log1p(n) / 10,
            min(1.0, n / 50),
            size / n / 20,
            min(3.0, len(_SYMBOL.findall(text)) / n),
            raised / letters,
            sum(map(str.isupper, words)) / n,
            len(set(words)) / n,
            1 - len(set(triples)) / max(1, len(triples)),
            1 - len(set(lines)) / max(1, len(lines)),
            len(re.findall(r"[.!?](?:\s|$)", text)) / n,
            min(3.0, text.count("!") / n),
            min(3.0, text.count("|") / n),
            len(re.findall(r"\d", text)) / size,
            (size - letters) / size,
            len(zlib.compress(text.encode(), 1)) / len(text.encode()),
        ]
    )


def features(text: str) -> np.ndarray:
    """Measurements, then the shares of words by the hashed classes (letter, digit, sign) of their last three characters."""
    hashed = np.zeros(BUCKETS)
    words = _WORD.findall(text)
    counts: dict[str, int] = {}
    for w in words:
        end = w[-3:]
        counts[end] = counts.get(end, 0) + 1
    for end, count in counts.items():
        shape = "".join("a" if c.isalpha() else "9" if c.isdigit() else c for c in end)
        hashed[zlib.crc32(shape.encode()) % BUCKETS] += count
    total = len(words) or 1
    return np.concatenate([_measures(text), hashed / total])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class PuModel:
    """Linear scorer with standardised features; ``risk`` is the non-negative risk of the last step."""

    def __init__(self, prior: float):
        self.prior, self.weights, self.risk = prior, np.zeros(0), 0.0

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        out = np.clip((x - self.mean) / self.spread, -6, 6)
        out[:, 0] = 1.0
        return out

    def fit(self, positive: np.ndarray, unlabelled: np.ndarray, steps: int = 400, rate: float = 0.05, decay: float = 1e-3):
        """Adam over the whole sample, sigmoid loss."""
        every = np.vstack([positive, unlabelled])
        self.mean, self.spread = every.mean(0), every.std(0) + 1e-3
        p, u = self._scaled(positive), self._scaled(unlabelled)
        w = np.zeros(every.shape[1])
        m, v = np.zeros_like(w), np.zeros_like(w)
        for step in range(1, steps + 1):
            sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
            # Loss of calling x negative is its sigmoid, of calling it positive one minus that.
            gp = p.T @ (sp * (1 - sp)) / len(p)
            gu = u.T @ (su * (1 - su)) / len(u)
            negative = su.mean() - self.prior * sp.mean()
            self.risk = self.prior * (1 - sp.mean()) + max(0.0, negative)
            if negative >= 0:
                g = -self.prior * gp + gu - self.prior * gp
            else:
                g = self.prior * gp - gu  # climb back
            g = g + decay * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        self.weights = w
        # Platt's line through the two classes' expected shares puts scores on a probability's scale.
        self.shift = float(np.quantile(u @ w, 1 - self.prior))
        self.scale = 4.0 / (float(np.std(u @ w)) + 1e-6)
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self._scaled(x) @ self.weights
        # At the prior's quantile of the unlabelled texts the score is the threshold.
        offset = np.log(THRESHOLD / (1 - THRESHOLD))
        return _sigmoid((raw - self.shift) * self.scale + offset)


def _look_alike(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 300, rate: float = 0.05, decay: float = 1e-3):
    """Scorer that tells positives from unlabelled texts, by logistic regression with equal weights."""
    every = np.vstack([positive, unlabelled])
    mean, spread = every.mean(0), every.std(0) + 1e-3

    def scaled(x: np.ndarray) -> np.ndarray:
        out = np.clip((x - mean) / spread, -6, 6)
        out[:, 0] = 1.0
        return out

    x = scaled(every)
    wanted = np.r_[np.ones(len(positive)), np.zeros(len(unlabelled))]
    weight = np.r_[np.full(len(positive), 0.5 / len(positive)), np.full(len(unlabelled), 0.5 / len(unlabelled))]
    w = np.zeros(x.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        g = x.T @ (weight * (_sigmoid(x @ w) - wanted)) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return lambda x: scaled(x) @ w


def _top_ratio(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of unlabelled scores at the top against that of positive ones, where its upper bound is smallest.

    Any top holds at least the prior's share of its positives' share; the bound keeps small tops out.
    """
    cut = np.unique(np.r_[positive, unlabelled])
    p = 1 - np.searchsorted(np.sort(positive), cut) / len(positive)
    u = 1 - np.searchsorted(np.sort(unlabelled), cut) / len(unlabelled)
    some = p > 0.05
    p, u = p[some], u[some]
    doubt = np.sqrt(np.log(40) / (2 * len(positive))) + np.sqrt(np.log(40) / (2 * len(unlabelled)))
    best = int(np.argmin(u / p + 1.01 / p * doubt))
    return float(u[best] / p[best])


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled texts; each half is scored by what the other half taught."""
    if min(len(positive), len(unlabelled)) < LEAST_ROWS:
        return 0.5
    found = []
    for half in (0, 1):
        a, b = np.arange(len(positive)) % 2 == half, np.arange(len(unlabelled)) % 2 == half
        like = _look_alike(positive[a], unlabelled[b])
        found.append(_top_ratio(like(positive[~a]), like(unlabelled[~b])))
    return float(np.clip(np.mean(found), 0.01, 0.99))


def _sampled_features(rows: DataFrame) -> np.ndarray:
    """Features of at most ``SAMPLE_ROWS`` rows (``text``)."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(x).astype(np.float32) for x in texts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.float32()))], names=["features"])

    column = map_batches(rows.select("text").limit(SAMPLE_ROWS), kernel, "features array<float>").toArrow().column("features")
    flat = column.combine_chunks().flatten().to_numpy() if len(column) else np.empty(0)
    return flat.reshape(-1, MEASURES + BUCKETS).astype(np.float64)


def fit(docs: DataFrame, labels: DataFrame) -> PuModel:
    """The model from trusted positives and unlabelled documents outside the held-out fold.

    Positives are documents of quality 1; unlabelled text is a sample of all documents, labelled or not, by hash of id
    and text.  Of either kind about ``SAMPLE_ROWS`` rows are taken, and never more.  Repeated rows may be taken
    several times.  Without positives or documents every text scores 0.5.
    """
    training = crc32_mod("doc_id", FOLDS) != HELD_OUT
    known = (
        labels.where("quality = 1 and doc_id is not null").where(training).select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    )
    rows = docs.select("doc_id", "text")
    positive = _sampled_features(rows.join(F.broadcast(known), "doc_id"))
    outside = rows.where(training)
    share = min(1.0, SAMPLE_ROWS / max(1, outside.count()))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30))
    unlabelled = _sampled_features(outside.where(drawn))
    model = PuModel(estimated_prior(positive, unlabelled))
    if len(positive) and len(unlabelled):
        return model.fit(positive, unlabelled)
    model.prior = 0.5
    model.mean, model.spread = np.zeros(MEASURES + BUCKETS), np.ones(MEASURES + BUCKETS)
    model.weights, model.scale = np.zeros(MEASURES + BUCKETS), 1.0
    model.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    return model


def score(docs: DataFrame, model: PuModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of each row.

    A null text is the empty text; repeated rows are scored one by one; texts are read whole; other columns are
    not read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t) for t in texts(batch)]).reshape(batch.num_rows, MEASURES + BUCKETS)
            found = shared.value.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", (crc32_mod("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "text")
    return map_batches(rows, kernel, "doc_id long, held_out boolean, score double, predicted int")
