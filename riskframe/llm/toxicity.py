"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Only documents are labelled.  Words (and beginnings of words) that are much more frequent in toxic than in
other training documents are the evidence; in a toxic document tokens with such a feature are labelled 1, all
other tokens 0.  A two-state field with a weight per feature and per transition is fitted to these sequences by
maximum likelihood.  In a document, forward-backward marginals of its tokens give the offending spans; their
sum, largest value and density give the score through a logistic curve fitted on the training documents.

Tokens without a feature all look alike to the field, so a run of them is one matrix power, in closed form for
two states: the passes visit tokens with a feature only and are exact for texts of any length.

The fit uses a bounded sample of labelled rows, ``MAX_TRAIN_DOCS`` for features and score curve and
``MAX_FIELD_DOCS`` for the field; scoring covers everything.  The field starts from the features' log-odds and is
penalised for leaving them, so a feature that no row of the field has keeps its log-odds.

Defined results: a null or empty text has no tokens and gets the score of a text without evidence; labels that
are null do not count and repeated labels of a document are averaged; without labels of both classes every
score is the share of toxic labels (0 if there are none); repeated rows are scored one by one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.text import WORD, append, as_bytes, words
from riskframe.session import materialise

MAX_TRAIN_DOCS = 20_000
MAX_FIELD_DOCS = 2_000
#: A feature counts from so many toxic documents, so much more often than in others, with such a test value.
LEAST_DOCS, LEAST_RATIO, LEAST_G = 3, 6.0, 12.0
PREFIXES = (7, 6, 5, 4)
#: Words a worker remembers the feature of; bounds memory, not results.
KEPT_WORDS = 200_000
STEPS = 30


def features(word: str) -> list[str]:
    """The word, then its beginnings from the longest."""
    return ["=" + word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


class Classes(dict):
    """Word to class: the most specific known feature, 0 if there is none."""

    def __init__(self, lexicon: dict[str, int]):
        self.lexicon = lexicon

    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        known = self.lexicon
        found = next((known[f] for f in features(word.decode()) if f in known), 0)
        self[word] = found
        return found


@dataclass
class Field:
    """Two states; class 0 is a token without a feature."""

    lexicon: dict[str, int] = field(default_factory=dict)
    emission: np.ndarray = field(default_factory=lambda: np.zeros(1))
    #: Log weights: start in state 1, and of transitions 0-1, 1-0 and 1-1 against 0-0.
    shared: np.ndarray = field(default_factory=lambda: np.array([-4.0, -4.0, -1.0, 0.0]))
    curve: np.ndarray = field(default_factory=lambda: np.zeros(4))
    #: Score where no curve could be fitted.
    constant: float | None = 0.0


def _matrix(shared: np.ndarray) -> np.ndarray:
    return np.exp(np.array([[0.0, shared[1]], [shared[2], shared[3]]]))


class Runs:
    """Powers of the matrix of a neutral step, scaled by the larger eigenvalue."""

    def __init__(self, shared: np.ndarray, neutral: float):
        self.step = _matrix(shared) * np.exp([0.0, neutral])
        half, det = np.trace(self.step) / 2, np.linalg.det(self.step)
        root = math.sqrt(max(half * half - det, 1e-300))
        self.large, self.small = half + root, half - root
        self._a = (self.step - self.small * np.eye(2)) / (2 * root)
        self._b = (self.step - self.large * np.eye(2)) / (2 * root)

    def power(self, n: np.ndarray) -> np.ndarray:
        return self._a - (self.small / self.large) ** np.asarray(n)[..., None, None] * self._b


class Sequences:
    """Token classes of many documents, in steps: step i holds the i-th token with a feature of each."""

    def __init__(self, docs: list[tuple[int, list[int], list[int]]]):
        docs = sorted(docs, key=lambda d: -len(d[1]))
        self.order = len(docs)
        self.count = np.array([len(d[1]) for d in docs])
        most = int(self.count.max(initial=0))
        self.active = [int((self.count > i).sum()) for i in range(most)]
        at = [np.array([d[1][i] for d in docs[:a]]) for i, a in enumerate(self.active)]
        self.classes = [np.array([d[2][i] for d in docs[:a]]) for i, a in enumerate(self.active)]
        #: Neutral tokens before each token with a feature, and after the last.
        self.gaps = [at[i] - (at[i - 1][:a] + 1 if i else 0) for i, a in enumerate(self.active)]
        last = np.array([d[1][-1] + 1 if d[1] else 0 for d in docs])
        self.tail = np.array([d[0] for d in docs]) - last


def _first_vector(shared: np.ndarray) -> np.ndarray:
    """So that the first token's transition is the start weight: a state before the text."""
    return np.exp(np.array([0.0, shared[0]]))


def passes(seq: Sequences, shared: np.ndarray, emission: np.ndarray, backward: bool = True) -> tuple[np.ndarray, list[np.ndarray]]:
    """(log partition of each document, marginals of state 1 step by step)."""
    runs = Runs(shared, emission[0])
    n = seq.order
    alpha = np.tile(_first_vector(shared), (n, 1))
    scale = np.zeros(n)
    forwards, moves = [], []
    step = _matrix(shared)
    for i, active in enumerate(seq.active):
        move = runs.power(seq.gaps[i]) @ step
        here = np.einsum("ni,nij->nj", alpha[:active], move) * np.stack([np.ones(active), np.exp(emission[seq.classes[i]])], axis=1)
        total = here.sum(axis=1)
        alpha[:active] = here / total[:, None]
        scale[:active] += np.log(total) + seq.gaps[i] * math.log(runs.large)
        forwards.append(alpha[:active].copy())
        moves.append(move)
    tail = runs.power(seq.tail)
    last = np.einsum("ni,nij->n", alpha, tail)
    scale += np.log(last) + seq.tail * math.log(runs.large)
    marginals: list[np.ndarray] = []
    if backward:
        beta = tail.sum(axis=2)
        for i in range(len(seq.active) - 1, -1, -1):
            active = seq.active[i]
            both = forwards[i] * beta[:active]
            marginals.append(both[:, 1] / both.sum(axis=1))
            weighted = beta[:active] * np.stack([np.ones(active), np.exp(emission[seq.classes[i]])], axis=1)
            before = np.einsum("nij,nj->ni", moves[i], weighted)
            beta[:active] = before / before.sum(axis=1, keepdims=True)
        marginals.reverse()
    return scale, marginals


def fit_field(docs: list[tuple[int, list[int], list[int], list[int]]], n_classes: int, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shared, emission) of largest likelihood, with a penalty on shared weights and on moves from ``start``.

    docs: words, places, classes and labels of evidence.  A class that no document has stays at its start.
    """
    seq = Sequences([d[:3] for d in docs])
    # Counts of the labelled paths: all tokens without a label 1 are in state 0.
    gold_shared, gold = np.zeros(4), np.zeros(n_classes)
    for n_words, places, classes, labels in docs:
        ones = {p for p, y in zip(places, labels) if y}
        for p, c, y in zip(places, classes, labels):
            gold[c] += y
            if y:
                gold_shared[3 if p - 1 in ones else 1] += 1
                gold_shared[2] += p + 1 not in ones and p + 1 < n_words
    shared, emission = np.array([-4.0, -4.0, -1.0, 0.0]), start.copy()
    moment = np.zeros(4 + n_classes)
    spread = np.zeros(4 + n_classes)
    for t in range(1, STEPS + 1):
        _, marginals = passes(seq, shared, emission)
        expected = np.zeros(n_classes)
        for classes, p in zip(seq.classes, marginals):
            np.add.at(expected, classes, p)
        slope = np.zeros(4 + n_classes)
        slope[4:] = gold - expected
        small = 1e-3
        for j in range(5):  # the weights that every token shares: few, so by difference
            up, down = (shared.copy(), emission.copy()), (shared.copy(), emission.copy())
            part = 0 if j < 4 else 1
            up[part][j % 4 if j < 4 else 0] += small
            down[part][j % 4 if j < 4 else 0] -= small
            rate = (passes(seq, *up, backward=False)[0] - passes(seq, *down, backward=False)[0]).sum() / (2 * small)
            slope[j] = (gold_shared[j] if j < 4 else 0.0) - rate
        slope -= 0.1 * np.concatenate([shared, emission - start])
        moment = 0.8 * moment + 0.2 * slope
        spread = 0.95 * spread + 0.05 * slope**2
        change = 0.3 * (moment / (1 - 0.8**t)) / (np.sqrt(spread / (1 - 0.95**t)) + 1e-8)
        shared, emission = shared + change[:4], emission + change[4:]
    return shared, emission


def curve_inputs(marginals: list[float], n_words: int) -> list[float]:
    total = sum(marginals)
    return [1.0, max(marginals, default=0.0), math.log1p(total), math.sqrt(total / n_words) if n_words else 0.0]


def fit_curve(inputs: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic weights with a small penalty, by Newton's method."""
    weights = np.zeros(inputs.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        slope = inputs.T @ (labels - p) - 0.01 * weights
        bend = (inputs * (p * (1 - p))[:, None]).T @ inputs + 0.01 * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


class Scorer:
    """Scores texts in a task."""

    def __init__(self, model: Field):
        self.model = model
        self.classes = Classes(model.lexicon)
        self.runs = Runs(model.shared, float(model.emission[0]))
        self._step = [float(x) for x in _matrix(model.shared).ravel()]
        self._weights = [math.exp(float(x)) for x in model.emission]
        self._first = [float(x) for x in _first_vector(model.shared)]

    def evidence(self, text: bytes | None) -> tuple[int, list[int], list[int]]:
        """(number of words, places and classes of those with a feature)."""
        found = list(map(self.classes.__getitem__, words(text)))
        if not any(found):
            return len(found), [], []
        places = [i for i, c in enumerate(found) if c]
        return len(found), places, [found[i] for i in places]

    def marginals(self, n_words: int, places: list[int], classes: list[int]) -> list[float]:
        """Of state 1, at the places with a feature."""
        if not places:
            return []
        s00, s01, s10, s11 = self._step
        gaps = np.diff(places, prepend=-1) - 1
        moves = [(*m.ravel().tolist(),) for m in self.runs.power(gaps)]
        a0, a1 = self._first
        forward = []
        for (p00, p01, p10, p11), c in zip(moves, classes):
            b0, b1 = a0 * p00 + a1 * p10, a0 * p01 + a1 * p11
            a0, a1 = b0 * s00 + b1 * s10, (b0 * s01 + b1 * s11) * self._weights[c]
            total = a0 + a1
            a0, a1 = a0 / total, a1 / total
            forward.append((a0, a1))
        b0, b1 = self.runs.power(n_words - places[-1] - 1).sum(axis=1).tolist()
        out = []
        for i in range(len(places) - 1, -1, -1):
            f0, f1 = forward[i]
            out.append(f1 * b1 / (f0 * b0 + f1 * b1))
            w1 = b1 * self._weights[classes[i]]
            g0, g1 = s00 * b0 + s01 * w1, s10 * b0 + s11 * w1
            p00, p01, p10, p11 = moves[i]
            b0, b1 = p00 * g0 + p01 * g1, p10 * g0 + p11 * g1
            total = b0 + b1
            b0, b1 = b0 / total, b1 / total
        return out[::-1]

    def score(self, marginals: list[float], n_words: int) -> float:
        if self.model.constant is not None:
            return self.model.constant
        z = float(np.dot(self.model.curve, curve_inputs(marginals, n_words)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

    def spans(self, text: bytes, places: list[int], marginals: list[float]) -> list[dict]:
        """Characters of tokens that are more likely toxic than not."""
        bad = {p: m for p, m in zip(places, marginals) if m > 0.5}
        if not bad:
            return []
        every = re.finditer(WORD, text.decode())
        return [{"start": w.start(), "end": w.end(), "probability": bad[i]} for i, w in enumerate(every) if i in bad]


_SCORERS: dict[int, tuple[Field, Scorer]] = {}


def scorer(model: Field) -> Scorer:
    """One per worker process and model."""
    held = _SCORERS.get(id(model))
    if held is None or held[0] is not model:
        _SCORERS.clear()
        _SCORERS[id(model)] = held = (model, Scorer(model))
    return held[1]


def _label_table(labels: DataFrame, key: str, label: str) -> DataFrame:
    return labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg((F.avg(label) >= 0.5).cast("int").alias("_toxic"))


def learn(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Field:
    """A model from the labelled rows of ``docs``; ``allowed`` is a condition on the key column ``_key``."""
    usable = _label_table(labels, key, label)
    if allowed is not None:
        usable = usable.where(allowed)
    n = usable.count()
    # A sample of about MAX_TRAIN_DOCS keys, by hash: small enough to be broadcast whatever the tables.
    share = min(1.0, MAX_TRAIN_DOCS / max(n, 1))
    sample = usable.where(F.pmod(F.xxhash64("_key", F.lit("train")), F.lit(1_000_000)) < int(share * 1_000_000))
    chosen = F.broadcast(sample)
    train = materialise(
        # One row per key, as any number of rows may have the same: their smallest text.
        docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(chosen, "_key").groupBy("_key", "_toxic").agg(F.min("text").alias("text")),
        "toxicity-train",
    )
    totals = {r["_toxic"]: r["count"] for r in train.groupBy("_toxic").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Field(constant=float(toxic > 0))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_toxic: Counter = Counter()
        in_clean: Counter = Counter()
        for batch in batches:
            for value, y in zip(as_bytes(batch.column("text")), batch.column("_toxic").to_pylist()):
                there = {f for w in set(words(value)) for f in features(w.decode())}
                (in_toxic if y else in_clean).update(there)
        names = list(in_toxic | in_clean)
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([in_toxic[f] for f in names], pa.int64()), pa.array([in_clean[f] for f in names], pa.int64())],
            names=["feature", "a", "b"],
        )

    a, b = F.col("a"), F.col("b")
    counted = train.select("text", "_toxic").mapInArrow(tally, "feature string, a bigint, b bigint").groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    ratio = ((a + 0.5) / (toxic + 1)) / ((b + 0.5) / (clean + 1))
    share_toxic = toxic / (toxic + clean)
    test = 2 * (
        a * F.log(a / ((a + b) * share_toxic)) + F.when(b > 0, b * F.log(b / ((a + b) * (1 - share_toxic)))).otherwise(0.0)
    )
    picked = (
        counted.where(a >= LEAST_DOCS)
        .withColumns({"ratio": ratio, "test": test})
        .where((F.col("ratio") >= LEAST_RATIO) & (F.col("test") >= LEAST_G))
        .orderBy(F.desc("test"), "feature")
        .collect()
    )
    if not picked:
        return Field(constant=share_toxic)
    model = Field(lexicon={r["feature"]: i for i, r in enumerate(picked, 1)}, constant=None)
    start = np.array([0.0, *(math.log(r["ratio"]) for r in picked)])
    model.emission = start

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Scorer(model)
        for batch in batches:
            rows = [tool.evidence(t) for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_toxic"),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[2] for r in rows], pa.list_(pa.int32())),
                ],
                names=["toxic", "n", "places", "classes"],
            )

    in_field = F.pmod(F.xxhash64("_key", F.lit("field")), F.lit(1_000_000)) < int(min(1.0, MAX_FIELD_DOCS / (toxic + clean)) * 1_000_000)
    gathered = (
        train.where(in_field).select("text", "_toxic").mapInArrow(sequences, "toxic int, n bigint, places array<int>, classes array<int>").collect()
    )
    docs_ = [(r["n"], r["places"], r["classes"], [r["toxic"]] * len(r["places"])) for r in gathered]
    if docs_:
        model.shared, model.emission = fit_field(docs_, len(picked) + 1, start)

    def curve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Scorer(model)
        for batch in batches:
            rows = []
            for value in as_bytes(batch.column("text")):
                found = tool.evidence(value)
                rows.append(curve_inputs(tool.marginals(*found), found[0]))
            yield pa.RecordBatch.from_arrays([batch.column("_toxic"), pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "inputs"])

    points = train.select("text", "_toxic").mapInArrow(curve, "toxic int, inputs array<double>").collect()
    model.curve = fit_curve(np.array([p["inputs"] for p in points]), np.array([float(p["toxic"]) for p in points]))
    return model


SCORED = (
    T.StructType()
    .add("_score", "double")
    .add("_spans", T.ArrayType(T.StructType().add("start", "integer").add("end", "integer").add("probability", "double")))
)


def scored(docs: DataFrame, model: Field, text: str = "text") -> DataFrame:
    """``docs`` with ``_score`` and ``_spans`` (characters of offending tokens, with their marginals)."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # features of the sampled rows

    def compute(column: pa.Array) -> list[pa.Array]:
        tool = scorer(held.value)
        scores, spans = [], []
        for value in as_bytes(column):
            n_words, places, classes = tool.evidence(value)
            marginals = tool.marginals(n_words, places, classes)
            scores.append(tool.score(marginals, n_words))
            spans.append(tool.spans(value, places, marginals) if places else [])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
        return [pa.array(scores, pa.float64()), pa.array(spans, kind)]

    return append(docs, SCORED, compute, text)
