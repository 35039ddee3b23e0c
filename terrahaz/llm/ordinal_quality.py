"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text is a bag of hashed features: its words in lower case, their shapes (letters and digits
collapsed, signs kept) and the event "same word as before". Counts are turned into square roots
of shares, so a text of any length has norm one. One weight vector is shared by all grades;
P(grade <= g) = logistic(threshold[g] - weights . features) with rising thresholds. The expected
grade and the tail probability P(grade >= accept) come from that; a text is kept where the tail
probability reaches ``cut``.

The fit uses at most ``max_rated`` rated texts (those with the smallest hashes of their id), dealt
to ``workers`` partitions; every round each runs AdaGrad over its part from the shared state and
the states are averaged (iterative parameter mixing). Scoring covers every whole text.

Defined cases: null text is empty; an empty text has no features and gets the thresholds' own
probabilities; a null grade is no rating; with no rating at all nothing can be judged: null
probabilities, every text kept; repeated rows each get their row.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrahaz.llm import tables

BUCKETS = 1 << 18
MAX_RATED = 20_000
WORKERS = 4
ROUNDS = 4
EPOCHS = 2
RATE = 0.5
DECAY = 1e-5
CUT = 0.5
#: Words remembered per task before the memory is emptied: about 260 bytes each.
REMEMBERED = 1 << 16
_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"[0-9]+")


def shape(word: str) -> str:
    """Letters become A (all upper), Aa (first upper) or a; digits 0; signs stay."""
    def letters(m):
        s = m.group()
        return "A" if s.isupper() and len(s) > 1 else "Aa" if s[0].isupper() else "a"

    return _DIGITS.sub("0", _LETTERS.sub(letters, word))


class Features:
    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.known = buckets, {}

    def _word(self, raw: bytes) -> tuple[int, int]:
        word = raw.decode("utf-8", "replace")
        pair = (xxhash.xxh32_intdigest(b"w" + word.lower().encode()) % self.buckets,
                xxhash.xxh32_intdigest(b"s" + shape(word).encode()) % self.buckets)
        if len(self.known) >= REMEMBERED:
            self.known.clear()
        self.known[raw] = pair
        return pair

    def __call__(self, body: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, values) with values of norm one; empty for a text without words."""
        words = body.split()
        n = len(words)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0)
        get, make = self.known.get, self._word
        ids = np.array([get(w) or make(w) for w in words], dtype=np.int64)
        again = int((ids[1:, 0] == ids[:-1, 0]).sum())
        at, count = np.unique(ids.ravel(), return_counts=True)
        repeat = xxhash.xxh32_intdigest(b"repeat") % self.buckets
        at, count = np.append(at, repeat), np.append(count, again)
        return at, np.sqrt(count / count.sum())


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def probabilities(score, thresholds: np.ndarray) -> np.ndarray:
    """P(grade = g) for each grade."""
    below = np.concatenate([[0.0], logistic(thresholds - score), [1.0]])
    return np.diff(below)


def _pass(rows, weights, squares, thresholds, epochs, rate, decay, seed):
    """AdaGrad over rows of (grade, at, value); all states are changed in place."""
    order = np.random.default_rng(seed)
    t_squares = np.full(len(thresholds), 1.0)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            grade, at, value = rows[i]
            score = float(weights[at] @ value)
            upper = logistic(thresholds[grade] - score) if grade < len(thresholds) else 1.0
            lower = logistic(thresholds[grade - 1] - score) if grade else 0.0
            p = max(upper - lower, 1e-9)
            g = (1.0 - upper - lower) * value + decay * weights[at]
            squares[at] += g * g
            weights[at] -= rate * g / np.sqrt(squares[at] + 1e-8)
            step = np.zeros(len(thresholds))
            if grade < len(thresholds):
                step[grade] -= upper * (1 - upper) / p
            if grade:
                step[grade - 1] += lower * (1 - lower) / p
            t_squares += step * step
            thresholds -= 0.1 * step / np.sqrt(t_squares)
            np.maximum.accumulate(thresholds, out=thresholds)


def _lists(column) -> list[np.ndarray]:
    """The rows of a list column as views of its numbers: no object per number."""
    ends, numbers = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [numbers[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


class Model:
    def __init__(self, weights: np.ndarray, thresholds: np.ndarray, buckets: int):
        self.weights, self.thresholds, self.buckets = weights, thresholds, buckets


def fit(rated: DataFrame, grades: int, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "grade",
        buckets: int = BUCKETS, workers: int = WORKERS, rounds: int = ROUNDS, epochs: int = EPOCHS,
        rate: float = RATE, decay: float = DECAY) -> Model | None:
    """Model from rated texts (grades 0 .. ``grades`` - 1), None if there is none."""
    rows = rated.where(F.col(grade_col).isNotNull()).select(
        F.xxhash64(id_col, text_col).alias("h"), F.col(grade_col).cast("int").alias("grade"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))

    def featurize(batches):
        make = Features(buckets)
        for b in (x for batch in batches for x in tables.slices(batch, "body")):
            got = [make(x) for x in b["body"].to_pylist()]
            yield {"h": b["h"], "grade": b["grade"], "at": [a for a, _ in got], "value": [v for _, v in got]}

    ddl = "h long, grade int, at array<long>, value array<double>"
    data = tables.staged(
        tables.map_batches(rows.repartition(workers, F.pmod("h", F.lit(workers))), ddl, featurize), "rated")
    counts = dict(data.groupBy("grade").count().collect())
    total = sum(counts.values())
    if not total:
        return None
    below = np.cumsum([counts.get(g, 0) for g in range(grades - 1)])
    share = np.clip(below / total, 0.5 / total, 1 - 0.5 / total)
    weights, squares = np.zeros(buckets, np.float32), np.full(buckets, 0.1, np.float32)
    thresholds = np.log(share / (1 - share))
    for turn in range(rounds):
        state = data.sparkSession.sparkContext.broadcast((weights, squares, thresholds))

        def learn(batches, state=state, turn=turn):
            parts = []
            for b in batches:
                parts += zip(b["h"].to_pylist(), b["grade"].to_pylist(), _lists(b["at"]), _lists(b["value"]), strict=True)
            if parts:
                parts.sort(key=lambda r: r[0])
                w, s, t = (x.copy() for x in state.value)
                _pass([r[1:] for r in parts], w, s, t, epochs, rate, decay, turn)
                yield {"w": [w.tobytes()], "s": [s.tobytes()], "t": [t.tobytes()], "n": [len(parts)]}

        # as many rows as workers, of fixed size
        got = tables.map_batches(data.repartition(workers, F.pmod("h", F.lit(workers))),
                                 "w binary, s binary, t binary, n long", learn).collect()
        share = np.array([r["n"] for r in got], dtype=float) / sum(r["n"] for r in got)
        weights = sum(p * np.frombuffer(r["w"], np.float32) for p, r in zip(share, got, strict=True)).astype(np.float32)
        squares = sum(p * np.frombuffer(r["s"], np.float32) for p, r in zip(share, got, strict=True)).astype(np.float32)
        thresholds = sum(p * np.frombuffer(r["t"], np.float64) for p, r in zip(share, got, strict=True))
        state.unpersist()
    return Model(weights, thresholds, buckets)


COLUMNS = "expected_grade double, tail_probability double, kept boolean"


def judge(spark: SparkSession, model: Model | None, accept: int, cut: float = CUT):
    """A function from a text to the values of ``COLUMNS``, for use in tasks."""
    if model is None:
        return lambda body: (None, None, True)
    shared = spark.sparkContext.broadcast((model.weights, model.thresholds))  # of fixed size
    buckets, held = model.buckets, []

    def one(body: bytes) -> tuple:
        if not held:
            held.append(Features(buckets))
        weights, thresholds = shared.value
        at, value = held[0](body)
        p = probabilities(float(weights[at] @ value) if len(at) else 0.0, thresholds)
        tail = float(p[accept:].sum())
        return float(p @ np.arange(len(p))), tail, tail >= cut

    return one


def score(df: DataFrame, model: Model | None, accept: int, cut: float = CUT, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``id, expected_grade, tail_probability, kept`` for every text."""
    return tables.per_text(df, id_col, text_col, COLUMNS, judge(df.sparkSession, model, accept, cut))


def rated_sample(ratings: DataFrame, docs: DataFrame, max_rated: int = MAX_RATED, id_col: str = "doc_id",
                 text_col: str = "text", grade_col: str = "grade") -> DataFrame:
    """Texts of at most ``max_rated`` ratings, those with the smallest hashes of the id."""
    chosen = ratings.where(F.col(grade_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("_rated"), F.col(grade_col).alias(grade_col)).orderBy(F.xxhash64("_rated"), "_rated", grade_col).limit(max_rated)
    return docs.select(id_col, text_col).join(F.broadcast(chosen), F.col(id_col) == F.col("_rated")).drop("_rated")
