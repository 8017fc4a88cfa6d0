"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel of two units (words, punctuation removed, or runs of spaced-out single letters)
sums over all common subsequences of three symbols, each weighted by LAMBDA to the
power of its spans, and is normalised; so "id-i.ot" and "idixot" stay close to "idiot". Word
starts and ends are symbols too. Landmarks give the Nyström map; a linear SVM with
squared hinge loss is trained on it. A sentence scores as its highest unit, a text as its
highest sentence, and training follows that: in each round a toxic document stands for
its highest unit, a clean one for all its units, of which the highest wrong ones are mined.
A logistic model of the highest margin, the second highest and the number of units turns
margins into probabilities, as one strange unit among many is weak evidence.

As the kernel is a sum over subsequences, the machine folds into one table with a weight
for each subsequence, so scoring a unit does not depend on the number of landmarks.

Training reads a bounded sample: at most per_class documents of each label (by hash of
their key) of at most max_chars characters, and of their units at most the numbers that Bounds names. Scores cover
every whole text. A unit of more than LONGEST symbols is compared by overlapping windows, also as a landmark. The
number of units counts up to the largest in training, so a long text is not excused by its length.
Edge cases: null, empty or blank text: the score of "no unit", the lowest; rows repeat;
several labels of one key: the largest counts; several texts of one key: the one with the smallest hash is learned from;
a null key is in the part that is not held out; null labels are ignored; without both
labels every score is 0; only key and text are read, clashing columns do not matter.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnspark.llm.common import give_back, small_batches, table

LAMBDA, SYMBOLS, LONGEST = 0.6, 64, 24
PER_CLASS, MAX_CHARS, LANDMARKS, THRESHOLD = 2000, 20_000, 160, 0.3


@dataclass(frozen=True)
class Bounds:
    """How much of the sample's units a fit uses: landmarks, insults that are disguised, clean units at random, the
    highest clean units that each round adds, and how many toxic documents must hold a unit before it can be their insult at first."""

    landmarks: int = LANDMARKS
    disguised: int = 200
    clean: int = 4000
    hard: int = 1000
    evidence: int = 2


_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum()) + b"\x00"
_SPACED = re.compile(rb"(?<!\S)(?:[a-z0-9] ){2,}[a-z0-9](?!\S)")


def units(text: str | None) -> set[bytes]:
    """Distinct units of a text: lower-case words without punctuation, and joined runs of single letters."""
    raw = (text or "").lower().encode("utf-8", "replace").translate(None, _PUNCTUATION)
    found = set(raw.split())
    found.update(m.replace(b" ", b"") for m in _SPACED.findall(raw))
    return found


@lru_cache(maxsize=1 << 16)
def _symbol(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    if "0" <= c <= "9":
        return ord(c) - 21
    return 37 + ord(c) % 25


def _codes(unit: bytes) -> list[np.ndarray]:
    """Symbols of a unit between its end marks; a very long one gives overlapping windows."""
    body = [_symbol(c) for c in unit.decode("utf-8", "replace")]
    if len(body) <= LONGEST:
        return [np.array([62, *body, 63])]
    whole, step = [62, *body, 63], LONGEST // 2
    return [np.array(whole[i : i + LONGEST]) for i in range(0, len(whole) - step, step)]


def _decay(n: int) -> np.ndarray:
    a = np.arange(n)
    gap = a[:, None] - a[None, :] - 1
    return np.where(gap >= 0, LAMBDA ** np.maximum(gap, 0), 0.0).astype(np.float32)


def kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Unnormalised kernel of the rows of s (N, n) with those of t (N, q) or one t (1, q)."""
    same = (s[:, :, None] == t[:, None, :]).astype(np.float32) * (LAMBDA * LAMBDA)
    left, right = _decay(s.shape[1]), _decay(t.shape[1]).T
    m = same
    for _ in range(2):
        m = same * (left @ m @ right)
    return m.sum(axis=(1, 2))


@lru_cache(maxsize=LONGEST + 3)
def _triples(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    at = np.array(list(combinations(range(n), 3)), np.int64).reshape(-1, 3)
    return at[:, 0], at[:, 1], at[:, 2], (LAMBDA ** (at[:, 2] - at[:, 0] + 1.0)).astype(np.float32)


def _by_length(found: list[bytes] | list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of found, matrix of symbols) for windows of equal length, a few thousand at a time; found holds units or windows."""
    groups: dict[int, tuple[list, list]] = {}
    for i, u in enumerate(found):
        for c in _codes(u) if isinstance(u, bytes) else [u]:
            rows, codes = groups.setdefault(len(c), ([], []))
            rows.append(i)
            codes.append(c)
    for n, (rows, codes) in groups.items():
        step = max(1, 2_000_000 // max(1, n * n * n))
        for i in range(0, len(rows), step):
            yield np.array(rows[i : i + step]), np.stack(codes[i : i + step])


def _scores(found: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Highest window score of each unit."""
    out = np.full(len(found), -1e9, np.float32)
    for rows, codes in _by_length(found):
        i, j, k, decay = _triples(codes.shape[1])
        sums = (weights[(codes[:, i] * SYMBOLS + codes[:, j]) * SYMBOLS + codes[:, k]] * decay).sum(axis=1)
        np.maximum.at(out, rows, sums / np.sqrt(np.maximum(kernel(codes, codes), 1e-12)))
    return out


class Model:
    """Weights of subsequences, the bias, and the logistic weights that turn a text's features into a probability;
    the features' third, the number of units, counts up to most."""

    def __init__(self, weights: np.ndarray, bias: float, logistic: np.ndarray | None = None, most: float = np.inf):
        self.weights, self.bias, self.most = weights.astype(np.float32), bias, most
        self.logistic = np.array([1.0, 0.0, 0.0, 0.0]) if logistic is None else logistic

    def margins(self, found: list[bytes]) -> np.ndarray:
        return _scores(found, self.weights) + self.bias

    def probability(self, features: np.ndarray) -> np.ndarray:
        held = np.array(features, float)
        held[..., 2] = np.minimum(held[..., 2], self.most)
        return 1 / (1 + np.exp(-np.clip(held @ self.logistic, -60, 60)))


def _features(bag: set[bytes], margin: dict[bytes, float]) -> tuple[float, float, float, float]:
    """Highest and second highest margin of a text's units, logarithm of their number, and 1.

    A long text has many units, of which one may look like an insult by chance; two seldom do.
    """
    top = heapq.nlargest(2, map(margin.__getitem__, bag))
    first, second = (*top, -1.0, -1.0)[:2]
    return first, second, float(np.log1p(len(bag))), 1.0


def _svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 10.0) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss, by Newton's method; y is -1 or 1."""
    x = np.hstack([z, np.ones((len(z), 1))])
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(30):
        active = y * (x @ w) < 1
        xa, ca = x[active], cost * weight[active]
        new = np.linalg.solve(ridge + (xa.T * ca) @ xa, xa.T @ (ca * y[active]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def _platt(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights of the features, with Platt's smoothed targets; margins never count against a text's toxicity."""
    p, n = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (p + 1) / (p + 2), 1 / (n + 2))
    use = np.ones(x.shape[1], bool)
    while True:
        w = np.zeros(x.shape[1])
        w[0] = 1.0
        for _ in range(100):
            q = 1 / (1 + np.exp(-np.clip(x[:, use] @ w[use], -30, 30)))
            ridge = 1e-3 * np.eye(use.sum())
            step = np.linalg.solve((x[:, use].T * (q * (1 - q))) @ x[:, use] + ridge, x[:, use].T @ (q - target) + 1e-3 * w[use])
            w[use] -= np.clip(step, -2, 2)
            if abs(step).max() < 1e-6:
                break
        w[~use] = 0.0
        if w[1] >= 0 or not use[1]:
            w[0] = max(w[0], 1e-3)
            return w
        use[1] = False


def _landmark_columns(found: list[bytes] | list[np.ndarray], landmarks: list[np.ndarray]) -> np.ndarray:
    """Normalised kernel of units with landmarks (windows of symbols); a unit's windows count by their best."""
    norm = [float(np.sqrt(kernel(c[None], c[None])[0])) for c in landmarks]
    out = np.zeros((len(found), len(landmarks)), np.float32)
    for rows, codes in _by_length(found):
        size = np.sqrt(np.maximum(kernel(codes, codes), 1e-12))
        for j, c in enumerate(landmarks):
            np.maximum.at(out[:, j], rows, kernel(codes, c[None]) / size / norm[j])
    return out


def fit(bags: list[tuple[bool, set[bytes]]], bounds: Bounds = Bounds(), rounds: int = 3) -> Model | None:
    """Train on (toxic, units) of the sampled documents; None unless both labels occur."""
    toxic, clean = [u for t, u in bags if t and u], [u for t, u in bags if not t]
    if not toxic or not any(clean):
        return None
    in_clean = set().union(*clean)
    df: dict[bytes, int] = {}
    for u in toxic:
        for x in u - in_clean:
            df[x] = df.get(x, 0) + 1
    best = lambda u, score: max(u, key=lambda x: (score.get(x, -1e9), x))
    # a unit that clean documents hold too is no insult; a toxic document with no other unit teaches nothing
    own = [o for u in toxic if (o := u - in_clean)]
    if not own:
        return None
    witness = [x for u in own if df[x := best(u, df)] >= bounds.evidence] or [best(u, df) for u in own]
    negatives = sorted(in_clean, key=lambda x: hash_of(x))
    everything = sorted(in_clean.union(*toxic))
    hard: set[bytes] = set()
    for _ in range(rounds):
        counts: dict[bytes, int] = {}
        for x in witness:
            counts[x] = counts.get(x, 0) + 1
        positive = sorted(counts, key=lambda x: (-counts[x], x))
        train_n = sorted((set(negatives[: bounds.clean]) | hard) - set(positive))
        named = positive[: bounds.landmarks * 3 // 4]
        named += [x for x in sorted(hard) + negatives[: bounds.clean] if x not in counts][: bounds.landmarks - len(named)]
        marks = [c for x in named for c in _codes(x)]
        spread = [(v, 0.5 * counts[x] ** 0.5) for x in positive[: bounds.disguised] for v in _disguised(x) if v not in in_clean]
        units_ = positive + [v for v, _ in spread] + train_n
        y = np.array([1.0] * (len(positive) + len(spread)) + [-1.0] * len(train_n))
        weight = np.array([counts[x] ** 0.5 for x in positive] + [w for _, w in spread] + [1.0] * len(train_n))
        weight[y > 0] *= weight[y < 0].sum() / weight[y > 0].sum() * 0.5
        gram = _landmark_columns(marks, marks).astype(np.float64)
        value, vector = np.linalg.eigh((gram + gram.T) / 2)
        keep = value > 1e-4
        root = vector[:, keep] / np.sqrt(value[keep])
        w, bias = _svm(_landmark_columns(units_, marks) @ root, y, weight)
        model = Model(_fold(marks, root @ w), bias)
        margin = dict(zip(everything, model.margins(everything), strict=True))
        witness = [best(u, margin) for u in own]
        hard |= set(sorted(in_clean, key=lambda x: (-margin[x], x))[: bounds.hard])
    x = np.array([_features(u, margin) for u in toxic + clean])
    model.most = float(x[:, 2].max())
    model.logistic = _platt(x, np.array([1.0] * len(toxic) + [-1.0] * len(clean)))
    return model


def _disguised(unit: bytes) -> list[bytes]:
    """Examples of a unit with a character inserted or doubled, so that training expects such gaps."""
    inner = range(1, len(unit), max(1, len(unit) // 3))
    strange = [unit[:i] + bytes([97 + (unit[i] * 7 + i) % 26]) + unit[i:] for i in inner]
    return strange + [unit[:i] + unit[i - 1 : i] + unit[i:] for i in inner if unit[i] < 128 and unit[i - 1] < 128]


def hash_of(unit: bytes) -> int:
    """A fixed pseudo-random order of units."""
    h = 2166136261
    for c in unit:
        h = (h ^ c) * 16777619 & 0xFFFFFFFF
    return h


def _fold(marks: list[np.ndarray], beta: np.ndarray) -> np.ndarray:
    """Weight of each subsequence: the landmarks' features times their coefficients."""
    weights = np.zeros(SYMBOLS**3)
    for c, b in zip(marks, beta, strict=True):
        i, j, k, decay = _triples(len(c))
        norm = np.sqrt(kernel(c[None], c[None])[0])
        np.add.at(weights, (c[i] * SYMBOLS + c[j]) * SYMBOLS + c[k], b * decay / norm)
    return weights


class Scorer:
    """Scores of texts; keeps the margins of at most max_units units."""

    def __init__(self, model: Model, max_units: int = 400_000):
        self.model, self.margin, self.max_units = model, {}, max_units

    def features(self, texts) -> np.ndarray:
        bags = [units(t) for t in texts]
        known = self.margin
        if len(known) > self.max_units:
            known.clear()
        new = list(set().union(*bags).difference(known)) if bags else []
        known.update(zip(new, self.model.margins(new).tolist(), strict=True))
        return np.array([_features(b, known) for b in bags]).reshape(-1, 4)


def training_sample(
    docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_class: int, max_chars: int
) -> list[tuple[bool, set[bytes]]]:
    """Units of at most per_class documents of each label, chosen by hash of the key; a unit that many of them hold is kept once."""
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("_label"))
    chosen = [
        known.filter(F.col("_label") == v).orderBy(F.xxhash64(key), key).limit(per_class) for v in (0, 1)
    ]
    keys = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * per_class rows
    small_batches(docs.sparkSession)

    @F.pandas_udf("array<binary>")
    def units_of(t: pd.Series) -> pd.Series:
        return t.map(lambda x: sorted(units(x)))

    short = docs.select(F.col(key), F.col(text).alias("_text")).filter(F.length("_text") <= max_chars)
    one = short.join(keys, key).groupBy(key).agg(F.min_by("_text", F.xxhash64("_text")).alias("_text"), F.first("_label").alias("_label"))
    rows = one.select("_label", units_of("_text").alias("units"), key)
    once: dict[bytes, bytes] = {}
    return [(r["_label"] == 1, {once.setdefault(x, x) for x in map(bytes, r["units"])}) for r in rows.orderBy(key).toLocalIterator()]


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    per_class: int = PER_CLASS, max_chars: int = MAX_CHARS, bounds: Bounds = Bounds(),
) -> Model | None:
    model = fit(training_sample(docs, labels, key, text, label, per_class, max_chars), bounds)
    give_back()
    return model


def score(model: Model | None, text: Column) -> Column:
    """Probability that a whole text is toxic; 0 without a model."""
    if model is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for t in batches:
            yield pd.Series(model.probability(scorer.features(t)))

    return probability(text)


def not_held_out(labels: DataFrame) -> DataFrame:
    return labels.filter(_remainder(F.col("doc_id")) != 2)


def _remainder(key: Column) -> Column:
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 4


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are not predicted toxic, by a model trained on those that are labelled."""
    small_batches(docs.sparkSession)
    return docs.filter(score(train(docs, not_held_out(labels)), F.col("text")) < threshold)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs, not_held_out(table(spark, sf_dir, "labels")))
    small_batches(spark)
    scored = docs.select("doc_id", (_remainder(F.col("doc_id")) == 2).alias("held_out"), score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
