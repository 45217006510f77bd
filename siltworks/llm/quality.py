"""A quality classifier: ordinal regression on graded ratings over hashed text features.

The cumulative-link model has one weight per feature, shared by all grades, and ordered thresholds:
P(grade > j) = sigmoid(score - threshold j). A document gets its expected grade and the probability of the top
grade, by which it is selected.

A text's features are its distinct words and word beginnings (letters only, lower case), its distinct runs of other
characters, and classes of a few shares: capitals, other characters, repeated words. Each is hashed to one of
``DIMENSIONS`` weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm.tables import arrow_map
from siltworks.llm.words import Words, chunks, mix64, words_of

DIMENSIONS = 1 << 18
PER_GRADE = 3000  # rated documents of each grade that the model is fitted on
BEGINNINGS = (4, 5)  # bytes
LEAST = 0.35  # P(top grade) from which a document is kept, where too few ratings are there to choose it
GOOD_KEPT = 0.97  # share of good documents that the chosen threshold keeps at least, of those held out
FOLDS = 3


def _kinds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are of letters (all of a non-ASCII character's count as such), and which are blanks."""
    folded = data | 32
    letter = ((folded >= 97) & (folded <= 122)) | (data >= 128)
    return letter, (data == 32) | ((data >= 9) & (data <= 13))


def _masked(words: Words, keep: np.ndarray) -> pa.Array:
    """The texts with all bytes but some turned into blanks."""
    data = np.where(keep, words.data, np.uint8(32))
    return pa.Array.from_buffers(
        pa.large_binary(), len(words.offsets) - 1, [None, pa.py_buffer(words.offsets.astype(np.int64)), pa.py_buffer(data)]
    )


def _shares(share: np.ndarray) -> np.ndarray:
    return np.minimum((np.nan_to_num(share) * 20).astype(np.int64), 19)


def features(texts: pa.Array) -> list[np.ndarray]:
    """Per text the sorted distinct features; a text without words has only those of its shares."""
    plain = words_of(texts)
    letter, blank = _kinds(plain.data)
    lower = words_of(_masked(plain, letter), lower=True)
    other = words_of(_masked(plain, ~letter & ~blank))
    whole, runs = lower.hashes(), other.hashes()
    begun = []
    for n in BEGINNINGS:
        head = np.zeros(len(lower.starts), dtype=np.uint64)
        for j in range(n):
            at = lower.starts + j
            inside = at < lower.ends
            head = head * np.uint64(257)
            head[inside] += lower.data[at[inside]].astype(np.uint64) + np.uint64(1)
        begun.append(mix64(head + np.uint64(n << 56)))
    upper = np.cumsum(np.concatenate(([0], (plain.data >= 65) & (plain.data <= 90))))
    letters = np.cumsum(np.concatenate(([0], letter)))
    blanks = np.cumsum(np.concatenate(([0], blank)))

    def total(upto: np.ndarray) -> np.ndarray:
        return upto[plain.offsets[1:]] - upto[plain.offsets[:-1]]

    solid = np.maximum(np.diff(plain.offsets) - total(blanks), 1)
    capitals = _shares(total(upper) / np.maximum(total(letters), 1))
    strange = _shares(1 - total(letters) / solid)
    out = []
    mask = np.uint64(DIMENSIONS - 1)
    for row in range(len(plain.offsets) - 1):
        i, j = lower.first[row], lower.first[row + 1]
        own = np.unique(whole[i:j])
        repeated = int(_shares(np.array([1 - len(own) / max(j - i, 1)]))[0])
        stats = mix64(np.array([capitals[row], 100 + strange[row], 200 + repeated], dtype=np.uint64))
        a, b = other.first[row], other.first[row + 1]
        parts = [own, mix64(np.unique(runs[a:b])), *[np.unique(x[i:j]) for x in begun], stats]
        out.append(np.unique(np.concatenate(parts) & mask).astype(np.int32))
    return out


@dataclass
class OrdinalModel:
    """Weights and rising thresholds; a text's score is the sum of its features' weights."""

    weights: np.ndarray
    thresholds: np.ndarray
    least: float = LEAST  # P(top grade) from which a text is kept

    def tails(self, rows: list[np.ndarray]) -> np.ndarray:
        """P(grade > j) for each text and threshold j."""
        scores = np.array([self.weights[r].sum() for r in rows])
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -60, 60)))


Blocks = list[tuple[int, np.ndarray, np.ndarray]]


def _blocks(rows: list[np.ndarray], place: np.ndarray) -> Blocks:
    """The rows' places among the weights in blocks, which keep sums over features small next to the features."""
    out = []
    for at in range(0, len(rows), 2048):
        columns = [place[row] for row in rows[at : at + 2048]]
        columns = [c[c >= 0] for c in columns]
        out.append((at, np.concatenate(columns), np.array([len(c) for c in columns])))
    return out


def cuts_of(theta: np.ndarray) -> np.ndarray:
    """Rising thresholds from a first one and the logarithms of the gaps between them."""
    return theta[0] + np.concatenate(([0.0], np.cumsum(np.exp(theta[1:]))))


def likelihood(
    weights: np.ndarray, theta: np.ndarray, blocks: Blocks, grades: np.ndarray, penalty: float
) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean logarithm of the grades' probabilities less the ridge penalty, and its slopes by weight and threshold."""
    n = len(grades)
    cuts, at = cuts_of(theta), np.arange(n)
    scores = np.concatenate([np.bincount(np.repeat(np.arange(len(m)), m), weights[columns], len(m)) for _, columns, m in blocks])
    above = 1 / (1 + np.exp(np.clip(cuts[None, :] - scores[:, None], -60, 60)))
    padded = np.hstack((np.ones((n, 1)), above, np.zeros((n, 1))))
    high, low = padded[at, grades], padded[at, grades + 1]
    # d log(high - low) / d score, with the slopes of both ends.
    rise, fall = high * (1 - high), low * (1 - low)
    chance = np.maximum(high - low, 1e-12)
    d_score = (rise - fall) / chance
    d_cuts = np.zeros((n, len(cuts) + 2))
    d_cuts[at, grades] -= rise / chance
    d_cuts[at, grades + 1] += fall / chance
    d_cut = d_cuts.sum(axis=0)[1:-1]
    d_theta = np.concatenate(([d_cut.sum()], np.exp(theta[1:]) * np.cumsum(d_cut[::-1])[::-1][1:]))
    d_weights = np.zeros(len(weights))
    for first, columns, m in blocks:
        d_weights += np.bincount(columns, np.repeat(d_score[first : first + len(m)], m), len(weights))
    value = float(np.log(chance).mean() - penalty / 2 * (weights * weights).sum())
    return value, d_weights / n - penalty * weights, d_theta / n


def fit_ordinal(
    rows: list[np.ndarray], grades: np.ndarray, n_grades: int, rounds: int = 150, rate: float = 0.05, penalty: float = 1e-3,
    least_share: float = 1e-3,
) -> OrdinalModel:
    """Maximum likelihood with a ridge penalty, by gradient steps of adaptive size over all rows.

    Weights are at most 0: a feature can only lower a grade. A text without evidence against it then gets the top
    grade however short it is, where free weights would ask it for words that good texts happen to have.
    Thresholds are a first one and the logarithms of the gaps between them, so that they stay in order. Features
    of less than the share ``least_share`` of the texts, or of one only, keep the weight 0. The same rows give the
    same model.
    """
    texts_with = np.zeros(DIMENSIONS, dtype=np.int64)
    for row in rows:
        texts_with[row] += 1
    used = np.flatnonzero(texts_with >= max(2, least_share * len(rows)))
    place = np.full(DIMENSIONS, -1, dtype=np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    blocks = _blocks(rows, place)
    weights, theta = np.zeros(len(used)), np.concatenate(([-0.5], np.zeros(n_grades - 2)))
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, theta)]
    for step in range(1, rounds + 1):
        _, *slopes = likelihood(weights, theta, blocks, grades, penalty)
        for values, slope, moment in zip((weights, theta), slopes, moments):
            moment[0] += 0.1 * (slope - moment[0])
            moment[1] += 0.001 * (slope * slope - moment[1])
            mean, square = moment[0] / (1 - 0.9**step), moment[1] / (1 - 0.999**step)
            values += rate * mean / (np.sqrt(square) + 1e-8)
        np.minimum(weights, 0, out=weights)
    full = np.zeros(DIMENSIONS)
    full[used] = weights
    return OrdinalModel(full, cuts_of(theta))


def choose_least(chances: np.ndarray, top: np.ndarray, good_kept: float = GOOD_KEPT) -> float:
    """The chance of the top grade from which to keep a text, by texts that the model was not fitted on.

    Of the thresholds that keep the share ``good_kept`` of the texts of the top grade, the one that best tells them
    from the others, the lowest of equals. ``top`` says which texts have the top grade.
    """
    steps = np.linspace(0.05, 0.95, 91)
    good = np.array([(chances[top] >= x).mean() for x in steps])
    bad = np.array([(chances[~top] >= x).mean() for x in steps])
    allowed = np.flatnonzero(good >= good_kept)
    return float(steps[allowed[np.argmax((good - bad)[allowed])]]) if len(allowed) else float(steps[0])


def fit_with_threshold(rows: list[np.ndarray], grades: np.ndarray, n_grades: int, folds: int = FOLDS) -> OrdinalModel:
    """A model fitted on all rows, its threshold chosen on what models of the other folds say of each fold.

    With fewer than ``folds`` texts in or below the top grade the threshold is ``LEAST``.
    """
    model, top = fit_ordinal(rows, grades, n_grades), grades == n_grades - 1
    if min(top.sum(), (~top).sum()) < folds:
        return model
    chances, fold = np.zeros(len(rows)), np.zeros(len(rows), dtype=np.int64)
    for grade in range(n_grades):  # each fold has its share of every grade
        own = np.flatnonzero(grades == grade)
        fold[own] = np.arange(len(own)) % folds
    for k in range(folds):
        fitted, held = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        part = fit_ordinal([rows[i] for i in fitted], grades[fitted], n_grades)
        chances[held] = part.tails([rows[i] for i in held])[:, -1]
    return replace(model, least=choose_least(chances, top))


def rated(labels: DataFrame) -> DataFrame:
    """Grades from the labels: 0 toxic, 1 of low quality, 2 good. Rows without an id or a label have none."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade")).filter("doc_id is not null and grade is not null")


def train(docs: DataFrame, ratings: DataFrame, n_grades: int = 3, per_grade: int = PER_GRADE) -> OrdinalModel | None:
    """Fit on at most ``per_grade`` rated documents of each grade, those whose ids have the smallest hashes.

    ``ratings`` has ``doc_id, grade``. Only the chosen documents' features come to the driver. None if no grade
    but one has documents.
    """
    chosen = None
    for grade in range(n_grades):
        of_grade = ratings.filter(F.col("grade") == grade).groupBy("doc_id").agg(F.max("grade").alias("grade"))
        some = of_grade.orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_grade)
        chosen = some if chosen is None else chosen.unionAll(some)
    chosen = chosen.withColumnRenamed("doc_id", "rated_id")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                packed = [x.tobytes() for x in features(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(packed, pa.binary()), part.column(2)], ["doc_id", "features", "grade"])

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # At most per_grade rows a grade, so the broadcast is bounded.
    sample = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("rated_id")).select("doc_id", "text", F.col("grade").cast("int").alias("grade"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, features binary, grade int"
    got = arrow_map(sample, scan, schema).dropDuplicates(["doc_id"]).collect()
    got.sort(key=lambda r: r["doc_id"])
    grades = np.array([r["grade"] for r in got], dtype=np.int64)
    if len(set(grades.tolist())) < 2:
        return None
    return fit_with_threshold([np.frombuffer(r["features"], dtype=np.int32) for r in got], grades, n_grades)


def _graded(model: OrdinalModel | None, texts: pa.Array, n_grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade and P(top grade)."""
    if model is None:
        return np.full(len(texts), float(n_grades - 1)), np.ones(len(texts))
    tails = model.tails(features(texts))
    return tails.sum(axis=1), tails[:, -1]


def _least(model: OrdinalModel | None, least: float | None) -> float:
    return least if least is not None else model.least if model else LEAST


def grade_documents(docs: DataFrame, model: OrdinalModel | None, least: float | None = None, n_grades: int = 3) -> DataFrame:
    """Per row ``doc_id, expected_grade, p_good, keep``: kept if P(top grade) is ``least``, or the model's own, or more.

    One pass without a shuffle; the model is a fixed number of weights. Texts are read whole. NULL and empty
    texts are judged by their shares alone. Without a model (no ratings) everything is kept.
    """
    shared, from_there = docs.sparkSession.sparkContext.broadcast(model), _least(model, least)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, 1):
                expected, good = _graded(shared.value, part.column(1), n_grades)
                columns = [part.column(0), pa.array(expected), pa.array(good), pa.array(good >= from_there)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "expected_grade", "p_good", "keep"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, expected_grade double, p_good double, keep boolean"
    return arrow_map(docs.select("doc_id", F.col("text").cast("string").alias("text")), scan, schema)


def keep_good(docs: DataFrame, model: OrdinalModel | None, least: float | None = None, n_grades: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns, that ``grade_documents`` would keep."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")
    from_there = _least(model, least)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, place):
                _, good = _graded(shared.value, part.column(place), n_grades)
                yield part.filter(pa.array(good >= from_there))

    return arrow_map(docs, scan, docs.schema)
