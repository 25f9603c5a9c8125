"""Quality classifier from weak labels.

Heuristic labellers vote good, bad or nothing on each document. Their accuracies
are estimated by expectation-maximisation from how they agree, over the counts of
vote patterns of all documents. The posterior of a document's pattern is its soft
label, and soft labels train a linear scorer on hashed features.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm import common
from tillflow.llm.common import staged

BUCKETS = 1 << 14
# Documents that the scorer is trained on, about; chosen by a hash of the id.
TRAINED_DOCS = 3_000
STEPS = 200
RATE = 4.0
RIDGE = 1e-5
EM_STEPS = 100
PRIOR_GOOD = 0.8  # start of the estimation
KEEP_FROM = 0.5
GOOD, BAD, NONE = 1, 0, 2
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = np.isin(np.arange(256), list(range(65, 91)))
_LETTERS = _UPPER | np.isin(np.arange(256), list(range(97, 123))) | (np.arange(256) >= 128)
_DIGITS = np.isin(np.arange(256), list(range(48, 58)))
# Character classes for the scorer's trigrams: letters by case, digits, white space, and each other byte by itself.
_CLASSES = np.arange(256)
_CLASSES[_LETTERS], _CLASSES[_UPPER], _CLASSES[_DIGITS] = 1, 2, 3
_CLASSES[list(common.BLANKS.encode())] = 4


def _share_vote(share: float, bad_above: float, good_below: float) -> int:
    return BAD if share > bad_above else GOOD if share < good_below else NONE


def _measures(text: bytes) -> list[int]:
    words = common.hashed_words(text)
    n, chars = max(len(words), 1), np.frombuffer(text, np.uint8)
    letters = max(int(_LETTERS[chars].sum()), 1)
    runs = common.shingles(words, 5, short=False)
    lines = [line for line in text.split(b"\n") if line.strip()]
    _, counts = np.unique(runs, return_counts=True)
    ends = sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines)
    return [
        BAD if len(words) < 10 else GOOD if len(words) >= 40 else NONE,
        _share_vote(_SYMBOLS[chars].sum() / n, 0.15, 0.02),
        _share_vote(1 - len(set(lines)) / max(len(lines), 1), 0.3, 0.05),
        _share_vote(counts[counts > 1].sum() / max(len(runs), 1), 0.2, 0.05),
        _share_vote(_UPPER[chars].sum() / letters, 0.4, 0.12),
        _share_vote(_DIGITS[chars].sum() / max(len(chars), 1), 0.2, 0.05),
        _share_vote(text.count(b"!") / n, 0.2, 0.03),
        _share_vote(text.count(b"|") / n, 0.1, 0.005),
        BAD if ends < 0.2 * len(lines) else GOOD if ends > 0.8 * len(lines) else NONE,
    ]


LABELLERS = len(_measures(b"a"))


def votes(text: bytes | None) -> list[int]:
    """One vote of each labeller; a null or empty text is bad for the first and nothing to the others."""
    return _measures(text) if text else [BAD] + [NONE] * (LABELLERS - 1)


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of character classes: buckets, and values of length one together. Over the whole text."""
    classes = _CLASSES[np.frombuffer(text or b"", np.uint8)].astype(np.uint64)
    if len(classes) < 3:
        return np.empty(0, np.int64), np.empty(0)
    key = classes[:-2] * np.uint64(1 << 16) + classes[1:-1] * np.uint64(1 << 8) + classes[2:]
    found, counts = np.unique(key, return_counts=True)
    buckets = (common.mix(found + np.uint64(1)) % np.uint64(BUCKETS)).astype(np.int64)
    values = np.sqrt(counts / counts.sum())
    return buckets, values


def _pattern(text: bytes | None) -> int:
    return int(3 ** np.arange(LABELLERS) @ np.array(votes(text)))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        patterns = [_pattern(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(patterns, pa.int64())], ["id", "pattern"])


@dataclass
class LabelModel:
    good: float  # the share of good documents
    chances: np.ndarray  # labeller x class x vote

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The probability of good for each row of votes. A labeller that says nothing says nothing here."""
        total = np.log(np.array([[1 - self.good, self.good]])) + np.zeros((len(patterns), 1))
        for i in range(patterns.shape[1]):
            spoken = patterns[:, i] != NONE
            total[spoken] += np.log(self.chances[i][:, patterns[spoken, i]]).T
        return 1 / (1 + np.exp(total[:, 0] - total[:, 1]))


def estimate(patterns: np.ndarray, counts: np.ndarray) -> LabelModel:
    """Accuracies of the labellers and the share of good documents, by expectation-maximisation.

    Starts with labellers that are right in eight of ten votes, so that good keeps its meaning.
    """
    start = np.tile(np.array([[0.8, 0.2], [0.2, 0.8]]), (LABELLERS, 1, 1))
    model = LabelModel(PRIOR_GOOD, start)
    for _ in range(EM_STEPS):
        good = model.posterior(patterns) * counts
        weight = np.stack([counts - good, good])
        chances = np.empty_like(start)
        for i in range(LABELLERS):
            for vote in (BAD, GOOD):
                chances[i, :, vote] = weight[:, patterns[:, i] == vote].sum(axis=1) + 1
        chances /= chances.sum(axis=2, keepdims=True)
        model = LabelModel(float(np.clip(good.sum() / max(counts.sum(), 1), 0.01, 0.99)), chances)
    return model


def _digits(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(LABELLERS) % 3


@dataclass
class QualityModel:
    labels: LabelModel
    weights: np.ndarray
    bias: float

    def score(self, text: bytes | None) -> float:
        buckets, values = features(text)
        return float(1 / (1 + np.exp(-(self.bias + values @ self.weights[buckets]))))


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.as_py() for t in batch.column(1)]
        found = [features(t) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([_pattern(t) for t in texts], pa.int64()),
             pa.array([b.tolist() for b, _ in found], pa.list_(pa.int32())),
             pa.array([v.tolist() for _, v in found], pa.list_(pa.float32()))],
            ["id", "pattern", "buckets", "shares"],
        )


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trained_docs: int = TRAINED_DOCS) -> QualityModel:
    """Fits labeller accuracies to all documents and the scorer to a sample.

    The driver gets the counts of vote patterns (3 ** LABELLERS at most) and the
    features of about ``trained_docs`` documents, chosen by a hash of id and text.
    An empty table gives a model that scores by its prior alone.
    """
    rows = docs.select(F.xxhash64(id_col, text_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    voted = staged(rows.mapInArrow(_vote, "id long, pattern long"), "votes")
    counted = voted.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    patterns = np.array([r.pattern for r in counted], np.int64)
    counts = np.array([r.n for r in counted], float)
    labels = estimate(_digits(patterns), counts)
    soft = dict(zip(patterns.tolist(), labels.posterior(_digits(patterns)).tolist(), strict=True))
    weights, bias = np.zeros(BUCKETS), float(np.log(labels.good / (1 - labels.good)))
    bar = int(min(1.0, trained_docs / max(counts.sum(), 1)) * (2**63 - 1024))
    sample = rows.filter(F.col("id").bitwiseAND(F.lit(2**63 - 1)) <= bar)
    found = sample.mapInArrow(_sampled, "id long, pattern long, buckets array<int>, shares array<float>").toArrow()
    found = found.sort_by("id")
    if not found.num_rows:
        return QualityModel(labels, weights, bias)
    target = np.array([soft[p] for p in found["pattern"].to_pylist()])
    sizes = [len(x) for x in found["buckets"].to_pylist()]
    row_of = np.repeat(np.arange(len(target)), sizes)
    buckets = found["buckets"].combine_chunks().flatten().to_numpy().astype(np.int64)
    values = found["shares"].combine_chunks().flatten().to_numpy().astype(float)
    for _ in range(STEPS):
        total = bias + np.bincount(row_of, weights[buckets] * values, len(target))
        error = 1 / (1 + np.exp(-total)) - target
        weights -= RATE * 10 * (np.bincount(buckets, error[row_of] * values, BUCKETS) / len(target) + RIDGE * weights)
        bias -= RATE * error.mean()
    return QualityModel(labels, weights, bias)


def classify(docs: DataFrame, model: QualityModel, text_col: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` plus ``n_good`` and ``n_bad`` votes, ``posterior`` of good, ``score`` and ``kept``.

    ``kept`` says whether the scorer's score reaches ``keep_from``. Null and empty
    texts have one vote, for bad, and no features: the scorer's bias decides
    nothing there, so they score 0 and are not kept. Columns of these names are
    replaced, others pass through; repeated rows are each judged. Nothing is
    shuffled, and the model has a fixed size.
    """
    fitted = model

    @F.arrow_udf("struct<n_good: long, n_bad: long, posterior: double, score: double>")
    def judge(texts: pa.Array) -> pa.Array:
        rows = [(np.array(votes(t.as_py())), t.as_py()) for t in texts]
        cast = np.array([v for v, _ in rows]).reshape(-1, LABELLERS)
        return pa.StructArray.from_arrays(
            [
                pa.array((cast == GOOD).sum(axis=1), pa.int64()), pa.array((cast == BAD).sum(axis=1), pa.int64()),
                pa.array(fitted.labels.posterior(cast), pa.float64()),
                pa.array([fitted.score(t) if t else 0.0 for _, t in rows], pa.float64()),
            ],
            ["n_good", "n_bad", "posterior", "score"],
        )

    added = ("n_good", "n_bad", "posterior", "score")
    names = [c for c in docs.columns if c not in (*added, "kept")]
    judged = docs.select(*names, judge(F.col(text_col).cast("binary")).alias("__found"))
    judged = judged.select(*names, *[f"__found.{c}" for c in added])
    return judged.withColumn("kept", F.col("score") >= keep_from)
