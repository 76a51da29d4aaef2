"""Ordinal quality classifier: a cumulative-link model over hashed text.

Grades are ordered: 0 harmful, 1 poor, 2 good. One weight per hashed feature is shared by all grades, ordered
thresholds cut the score into grades: P(grade <= k) = logistic(threshold_k - score). The model gives an expected
grade and the tail probability P(grade >= k) by which documents are selected.

Features are the distinct words of a whole text (letters and digits, A-Z lower-cased) and steps of its shape, such
as the share of capitals or of repeated words, hashed into one table of weights. The model is fitted on at most
``sample`` labelled documents, those with the smallest hash of their id; the list of their ids is broadcast, their
features (not their texts) come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm import words
from lossgrid.llm.arrow import batch, id_and_text, lists, schema_with, small, utf8

BITS = 20
SAMPLE = 20_000
GRADES = 3
KEEP_FROM = 2
EPOCHS = 20
BATCH = 128
RATE = 0.2
PENALTY = 6.0
RIDGE = 1.0
MIN_TEXTS = 5

# Byte classes for shapes.
_CLASS = np.zeros(256, np.int64)
_CLASS[[9, 10, 11, 12, 13, 32]] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_CLASS[[ord(c) for c in ".,;:'\"-()?"]] = 4
_CLASS[[ord(c) for c in "#*$%&|<>!@^~_=+/\\[]{}`"]] = 5
#: Capitals become small letters, ASCII marks become spaces.
PLAIN = bytes(
    c + 32 if 65 <= c < 91 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)
#: Upper ends of the steps of a share.
STEPS = np.array([0.0, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.3, 0.5, 0.75])


def _shape(block: words.Block, distinct: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text (row) the shape shares of a block of raw texts."""
    n = len(block.docs)
    size = np.maximum(block.text_ends - block.text_starts, 1)
    shares = []
    classes = _CLASS[block.data]
    for c in (2, 3, 4, 5):
        total = np.concatenate([[0], np.cumsum(classes == c)])
        shares.append((total[block.text_ends] - total[block.text_starts]) / size)
    shares.append(1.0 - distinct / np.maximum(counts, 1))
    return np.stack(shares, axis=1) if n else np.empty((0, 5))


def features(texts: list[bytes]) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """(texts, distinct features end to end, offsets) for blocks of texts."""
    for raw in words.blocks(texts):
        plain = next(words.blocks([texts[i].translate(PLAIN) for i in raw.docs], len(raw.data) + 1))
        owner = plain.text_of_word()
        index = (plain.hashes() >> np.uint64(64 - BITS)).astype(np.int64)
        found = np.unique(owner << BITS | index)
        owner = found >> BITS
        distinct = np.bincount(owner, minlength=len(raw.docs))
        shares = _shape(raw, distinct, plain.counts())
        # One feature for each step that a share exceeds, so that steps add up.
        text, column, step = np.nonzero(shares[:, :, None] > STEPS[None, None, :])
        names = words.mix(np.uint64(31) + (column * len(STEPS) + step).astype(np.uint64))
        steps = text << BITS | (names >> np.uint64(64 - BITS)).astype(np.int64)
        every = np.unique(np.concatenate([found, steps]))
        offsets = np.searchsorted(every, np.arange(len(raw.docs) + 1) << BITS)
        yield raw.docs, (every & ((1 << BITS) - 1)).astype(np.int32), offsets


@dataclass
class OrdinalModel:
    weights: np.ndarray  # one per hashed feature
    thresholds: np.ndarray  # ascending, one less than grades

    def cumulative(self, score: np.ndarray) -> np.ndarray:
        """P(grade <= k) for each score (row) and k below the highest."""
        z = np.clip(self.thresholds[None, :] - score[:, None], -35, 35)
        return 1.0 / (1.0 + np.exp(-z))

    def score(self, index: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(self.weights[index].astype(np.float64))])
        return total[offsets[1:]] - total[offsets[:-1]]


def fit(index: np.ndarray, offsets: np.ndarray, grades: np.ndarray, n_grades: int = GRADES) -> OrdinalModel:
    """Maximum likelihood with a sparse penalty, by per-feature gradient steps in a fixed order.

    Features of fewer than MIN_TEXTS texts keep weight 0. Thresholds stay ordered: they are the first threshold and
    the logarithms of the gaps. Without texts all grades are alike.
    """
    weights = np.zeros(1 << BITS)
    share = (np.cumsum(np.bincount(grades, minlength=n_grades)) + 0.5) / (len(grades) + 0.5 * n_grades + 0.5)
    share = np.clip(share[:-1], 1e-3, 1 - 1e-3)
    theta = np.log(share / (1 - share))
    theta = np.maximum.accumulate(theta + np.arange(n_grades - 1) * 1e-3)
    head, gaps = theta[0], np.log(np.maximum(np.diff(theta), 1e-3))
    known = np.bincount(index, minlength=1 << BITS) >= MIN_TEXTS
    lead = np.zeros(1 << BITS)
    sum_w, sum_head, sum_gaps = np.zeros(1 << BITS), 1e-8, np.full(n_grades - 2, 1e-8)
    order = np.argsort(words.mix(np.arange(len(grades), dtype=np.uint64)), kind="stable")
    for _ in range(EPOCHS if len(grades) else 0):
        for low in range(0, len(order), BATCH):
            chosen = order[low : low + BATCH]
            sizes = offsets[chosen + 1] - offsets[chosen]
            ends = np.cumsum(sizes)
            at = np.arange(ends[-1]) + np.repeat(offsets[chosen] - (ends - sizes), sizes)
            own, text = index[at], np.repeat(np.arange(len(chosen)), sizes)
            use = known[own]
            own, text = own[use], text[use]
            score = np.bincount(text, weights[own], len(chosen))
            theta = head + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
            y = grades[chosen]
            z = np.clip(theta[None, :] - score[:, None], -35, 35)
            cdf = np.concatenate([np.zeros((len(y), 1)), 1 / (1 + np.exp(-z)), np.ones((len(y), 1))], axis=1)
            row = np.arange(len(y))
            low_p, high_p = cdf[row, y], cdf[row, y + 1]
            p = np.maximum(high_p - low_p, 1e-12)
            by_score = low_p + high_p - 1.0
            by_theta = np.zeros_like(cdf)
            by_theta[row, y + 1] += high_p * (1 - high_p) / p
            by_theta[row, y] -= low_p * (1 - low_p) / p
            by_theta = by_theta[:, 1:-1].sum(axis=0) / len(y)
            touched, place = np.unique(own, return_inverse=True)
            step = np.bincount(place, by_score[text], len(touched))
            # Follow the regularised leader: weights stay 0 until their summed gradients exceed the penalty.
            before = np.sqrt(sum_w[touched])
            sum_w[touched] += step * step
            after = np.sqrt(sum_w[touched])
            lead[touched] += step + (after - before) / RATE * weights[touched]
            weights[touched] = np.sign(lead[touched]) * np.maximum(np.abs(lead[touched]) - PENALTY, 0) / ((1.0 + after) / RATE + RIDGE)
            step = by_theta.sum()
            sum_head += step * step
            head += RATE * step / np.sqrt(sum_head)
            step = np.cumsum(by_theta[::-1])[::-1][1:] * np.exp(gaps)
            sum_gaps += step * step
            gaps = gaps + RATE * step / np.sqrt(sum_gaps)
    return OrdinalModel(weights.astype(np.float32), head + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def grade_of(quality: F.Column, toxic: F.Column) -> F.Column:
    """0 for toxic, else 1 for quality 0, else 2; NULL labels give NULL unless the other one decides."""
    return F.when(toxic == 1, 0).when(quality == 0, 1).when((quality == 1) & (toxic == 0), 2)


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """Fit on at most ``sample`` graded documents. ``labels`` has doc_id, quality, toxic.

    Of several label rows for an id the lowest grade counts. Labels without a document, and NULL grades, are left out.
    """
    graded = labels.select(F.col("doc_id").alias("_id"), grade_of(F.col("quality"), F.col("toxic")).alias("grade"))
    graded = graded.filter("grade IS NOT NULL AND _id IS NOT NULL").groupBy("_id").agg(F.min("grade").alias("grade"))
    chosen = graded.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    base = id_and_text(docs, id_col=id_col, text_col=text_col)
    # At most `sample` rows of two numbers.
    rows = base.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "grade")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            for span, index, offsets in features(utf8(part.column(1))):
                low, n = span.start, len(span)
                yield batch(
                    {
                        "doc_id": part.column(0).slice(low, n),
                        "grade": part.column(2).slice(low, n).cast(pa.int32()),
                        "index": lists(index, offsets),
                    }
                )

    found = rows.mapInArrow(extract, schema_with(rows, ["doc_id"], "grade int, index array<int>")).toArrow()
    found = found.sort_by([("doc_id", "ascending")]).combine_chunks()
    column = found.column("index").combine_chunks()
    index = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.asarray(column.value_lengths().fill_null(0), np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return fit(index.astype(np.int64), offsets, found.column("grade").to_numpy().astype(np.int64))


def grade(docs: DataFrame, model: OrdinalModel, *, keep_from: int = KEEP_FROM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, expected_grade, tail (P(grade >= keep_from)), kept (tail >= 1/2).

    NULL counts as ''; a text without words is graded by its shape alone. Equal texts get equal results.
    """
    base = id_and_text(docs, id_col=id_col, text_col=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            for span, expected, tail in _grades(model, utf8(part.column(1)), keep_from):
                yield batch(
                    {
                        "doc_id": part.column(0).slice(span.start, len(span)),
                        "expected_grade": pa.array(expected),
                        "tail": pa.array(tail),
                        "kept": pa.array(tail >= 0.5),
                    }
                )

    return base.mapInArrow(run, schema_with(base, ["doc_id"], "expected_grade double, tail double, kept boolean"))


def _grades(model: OrdinalModel, texts: list[bytes], keep_from: int) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    for span, index, offsets in features(texts):
        below = model.cumulative(model.score(index, offsets))
        yield span, (1.0 - below).sum(axis=1), 1.0 - below[:, keep_from - 1]


def drop_poor(docs: DataFrame, labels: DataFrame, *, keep_from: int = KEEP_FROM, text_col: str = "text") -> DataFrame:
    """The rows whose tail probability selects them, with all their columns; nothing is shuffled."""
    model = train(docs, labels, text_col=text_col)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches, place):
            if part.num_rows:
                kept = [tail >= 0.5 for _, _, tail in _grades(model, utf8(part.column(place)), keep_from)]
                yield part.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema)
