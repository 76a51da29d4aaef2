"""Importance resampling towards a target distribution, with segments counted once.

Texts are described by hashed word n-grams (runs of one and two words, crc32 of their bytes modulo the number of
buckets). A bucket's gain is the logarithm of its smoothed share in the target over that in the corpus; a document
weighs the mean gain of its features, and a fixed pseudo-random draw per document (Gumbel noise) makes the highest
scores a sample without replacement.

Segments: a newline separates words, so every feature lies inside one line or joins the last word of a line to the
first word of the next line that has words. Equal lines are counted together over the whole corpus first; features of
each distinct line are computed once and multiplied by its occurrences. Features across lines are added in a pass of
their own. Scores are formed the same way batch by batch: gains of a batch's distinct lines once, then sums along each
document.

Only counts per bucket (as many as there are buckets) and counts per score come to the driver. The order of the drawn is
made by range partitions, so no task holds it whole.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.arrow import id_and_text, schema_with, small, spans_by_size, utf8
from lossgrid.session import materialise

BUCKETS = 10_000
#: Scores counted together in the first look for the lowest drawn score.
SCORE_STEP = 256
BLOCK_BYTES = 1 << 19
LONG_WORD = 48

# A word is a run of digits, small letters (after lower-casing A-Z) and non-ASCII bytes.
IN_WORD = np.zeros(256, bool)
IN_WORD[ord("0") : ord("9") + 1] = IN_WORD[ord("a") : ord("z") + 1] = IN_WORD[128:] = True
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _crc_table() -> np.ndarray:
    values = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        values = (values >> np.uint32(1)) ^ np.where(values & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return values


CRC = _crc_table()


def crc_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, after: np.ndarray | None = None) -> np.ndarray:
    """crc32 of each span, or of a space and the span behind what gave the values ``after``.

    All spans advance together, byte by byte, the longest first; very long ones go one by one.
    """
    state = np.zeros(len(starts), np.uint32) if after is None else after
    state = ~state
    if after is not None:
        state = CRC[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8))
    lengths = ends - starts
    for i in np.flatnonzero(lengths > LONG_WORD):
        state[i] = ~np.uint32(zlib.crc32(data[starts[i] : ends[i]], int(~state[i])))
    rest = np.flatnonzero(lengths <= LONG_WORD)
    rest = rest[np.argsort(-lengths[rest].astype(np.int16), kind="stable")]
    at, now = starts[rest], state[rest]
    left = np.searchsorted(-lengths[rest], -np.arange(LONG_WORD), "left")  # spans longer than k bytes
    for k in range(LONG_WORD):
        n = int(left[k])
        if not n:
            break
        head = now[:n]
        now[:n] = CRC[(head ^ data[at[:n] + k]) & np.uint32(255)] ^ (head >> np.uint32(8))
    state[rest] = now
    return ~state


@dataclass
class Lines:
    """Words and features of some lines, laid end to end; lines are numbered in order."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # per line the number of its first word, and the number of words at the end
    single: np.ndarray  # crc32 of each word
    pairs: np.ndarray  # of each word and the next one
    inside: np.ndarray  # whether that next word is in the same line

    @classmethod
    def of(cls, lines: Sequence[bytes]) -> Lines:
        data = np.frombuffer(b"\n".join(lines).translate(LOWER) + b"\n", np.uint8)
        sizes = np.fromiter(map(len, lines), np.int64, len(lines))
        begin = np.concatenate([[0], np.cumsum(sizes + 1)])
        word = IN_WORD[data]
        edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0))
        starts, ends = edge[0::2], edge[1::2]
        first = np.searchsorted(starts, begin)
        single = crc_of(data, starts, ends)
        inside = np.ones(max(0, len(starts) - 1), bool)
        cut = first[1:-1]
        inside[cut[(cut > 0) & (cut < len(starts))] - 1] = False
        at = np.flatnonzero(inside)
        pairs = np.zeros(len(inside), np.uint32)
        pairs[at] = crc_of(data, starts[at + 1], ends[at + 1], single[at])
        return cls(data, starts, ends, first, single, pairs, inside)

    def words(self) -> np.ndarray:
        return np.diff(self.first)

    def sums(self, value: np.ndarray) -> np.ndarray:
        """Per line the sum of ``value`` (one per bucket) over its features."""
        of_word = value[self.single % len(value)]
        of_word[:-1] += np.where(self.inside, value[self.pairs % len(value)], 0)
        total = np.concatenate([[0], np.cumsum(of_word)])
        return total[self.first[1:]] - total[self.first[:-1]]

    def counts(self, times: np.ndarray, buckets: int) -> np.ndarray:
        """Features by bucket, each line's as often as it occurs."""
        each = np.repeat(times, self.words())
        keys = np.concatenate([self.single, self.pairs[self.inside]]) % buckets
        return _count(keys, np.concatenate([each, each[:-1][self.inside]]), buckets)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """crc32 of the last word of each left line and the first word of the right one."""
        first, last = self.first[right], self.first[left + 1] - 1
        return crc_of(self.data, self.starts[first], self.ends[first], self.single[last])


def _count(keys: np.ndarray, times: np.ndarray, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    np.add.at(out, keys, times)
    return out


@dataclass
class Segments:
    """Some texts as sequences of distinct lines."""

    lines: Lines
    line: np.ndarray  # the lines with words of all texts, in order
    text: np.ndarray  # the text each belongs to
    n: int

    @classmethod
    def of(cls, texts: Sequence[bytes]) -> Segments:
        number: dict[bytes, int] = {}
        cut = [t.split(b"\n") for t in texts]
        line = np.fromiter((number.setdefault(x, len(number)) for c in cut for x in c), np.int64)
        text = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        lines = Lines.of(list(number))
        full = lines.words()[line] > 0
        return cls(lines, line[full], text[full], len(texts))

    def across(self) -> tuple[np.ndarray, np.ndarray]:
        """(crc32, text) of each feature that joins two lines; equal neighbours are joined once."""
        same = np.flatnonzero(self.text[1:] == self.text[:-1])
        pairs = self.line[same] * len(self.lines.words()) + self.line[same + 1]
        distinct, back = np.unique(pairs, return_inverse=True)
        left, right = np.divmod(distinct, max(1, len(self.lines.words())))
        return self.lines.joined(left, right)[back], self.text[same]

    def per_text(self, of_line: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(of_line[self.line])])
        edges = np.searchsorted(self.text, np.arange(self.n + 1))
        return total[edges[1:]] - total[edges[:-1]]


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    return spans_by_size(map(len, texts), BLOCK_BYTES)


def _bucket_rows(counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    held = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int64()), "n": pa.array(counts[held], pa.int64())})


def feature_counts(docs: DataFrame, *, buckets: int = BUCKETS, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket. NULL and empty texts have none."""
    texts = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # Equal lines meet, after a map-side count, so a line of a third of all rows is one row per task.
    lines = texts.select(F.explode(F.split("text", "\n", -1)).alias("line")).filter("line <> ''").groupBy("line").count()

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in small(batches, 0):
            values, times = utf8(part.column(0)), part.column(1).to_numpy(zero_copy_only=False)
            for low, high in _blocks(values):
                total += Lines.of(values[low:high]).counts(times[low:high], buckets)
        yield from _bucket_rows(total)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in small(batches, 0):
            values = utf8(part.column(0))
            for low, high in _blocks(values):
                keys, _ = Segments.of(values[low:high]).across()
                total += np.bincount(keys % buckets, minlength=buckets)
        yield from _bucket_rows(total)

    schema = "bucket bigint, n bigint"
    rows = lines.mapInArrow(within, schema).unionByName(texts.mapInArrow(between, schema))
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.groupBy("bucket").agg(F.sum("n")).collect():  # one row per bucket
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(target share / corpus share)) by bucket, one occurrence added to each bucket."""
    buckets = len(corpus)
    s_all, t_all = float(corpus.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log(float(t + 1) * s_all / (float(s + 1) * t_all))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features and weight (floored mean gain, 0 without features) of every row."""
    base = id_and_text(docs, id_col=id_col, text_col=text_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            texts = utf8(part.column(1))
            n_words, total = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for low, high in _blocks(texts):
                segments = Segments.of(texts[low:high])
                keys, owner = segments.across()
                n_words[low:high] = segments.per_text(segments.lines.words())
                total[low:high] = segments.per_text(segments.lines.sums(gain))
                np.add.at(total[low:high], owner, gain[keys % len(gain)])
            n_features = np.maximum(2 * n_words - 1, 0)
            weight = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n_words), pa.array(n_features), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"]
            )

    return base.mapInArrow(rows, schema_with(base, ["doc_id"], "n_words bigint, n_features bigint, weight bigint"))


def noise(doc_id: Column, seed: int) -> Column:
    """A fixed Gumbel draw in thousandths, floored, from 32 bits of sha256(seed:id); a NULL id hashes as ''."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("bigint")


def _reaching(counts: DataFrame, wanted: int, ahead: int) -> tuple[int, int]:
    """The highest of (at, n) rows at which ``ahead`` and the rows so far make ``wanted``, and the rows above it."""
    for at, n in sorted(map(tuple, counts.collect()), reverse=True):
        if ahead + n >= wanted:
            return at, ahead
        ahead += n
    raise ValueError("fewer rows than wanted")


def _lowest_drawn(scores: DataFrame, wanted: int) -> int:
    """The largest score that at least ``wanted`` rows reach, from counts per stretch of scores, then per score."""
    stretch = F.floor(F.col("score") / SCORE_STEP)
    at, ahead = _reaching(scores.groupBy(stretch).count(), wanted, 0)
    return _reaching(scores.filter(stretch == at).groupBy("score").count(), wanted, ahead)[0]


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    buckets: int = BUCKETS,
    seed: int = 7,
    percent: int = 25,
    min_words: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank (NULL where not drawn).

    Of the rows with ``min_words`` words, ``percent`` in a hundred (rounded down) with the highest scores are drawn and
    ranked from 1; equal scores by smaller id, NULL ids last, and rows alike in that in any order. NULL, empty and
    wordless texts have no features, weigh 0 and are not drawn. Rows that repeat an id share its noise and count each.
    An empty target leaves every feature to smoothing; no documents give no rows.
    """
    gain = gains(feature_counts(docs, buckets=buckets, text_col=text_col), feature_counts(target, buckets=buckets, text_col=target_col))
    scored = weigh(docs, gain, id_col=id_col, text_col=text_col)
    scored = scored.withColumns({"score": F.col("weight") + noise(F.col("doc_id"), seed), "_row": F.monotonically_increasing_id()})
    scored = materialise(scored, "resampling-scores")
    able = scored.filter(F.col("n_words") >= min_words)
    wanted = able.count() * percent // 100
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("bigint").alias("rank")
    if not wanted:
        return scored.select(*columns, undrawn)
    lowest = _lowest_drawn(able.select("score"), wanted)
    drawable = (F.col("n_words") >= min_words) & (F.col("score") >= lowest)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]
    ordered = scored.filter(drawable).repartitionByRange(*order).sortWithinPartitions(*order)
    # The upper bits of this number are the partition, the lower 33 the place in it.
    ordered = materialise(ordered.withColumn("_at", F.monotonically_increasing_id()), "resampling-order")
    partition = F.shiftright("_at", 33)
    ahead, offsets = 0, []
    for at, n in sorted(map(tuple, ordered.groupBy(partition).count().collect())):  # one row per partition
        offsets.append((at, ahead))
        ahead += n
    offset = docs.sparkSession.createDataFrame(offsets, "_partition bigint, _ahead bigint")
    rank = F.col("_ahead") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    ranked = ordered.join(F.broadcast(offset), partition == F.col("_partition")).select(*columns, F.when(rank <= wanted, rank).alias("rank"))
    return ranked.unionByName(scored.filter(~drawable).select(*columns, undrawn))
