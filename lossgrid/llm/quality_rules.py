"""Quality rules: repetition counts, and divergence from the language's own distributions.

Reference histograms come from the corpus itself, over all documents: per language the shares of character classes
and of its common words (those that make up at least 1 / ``COMMON_SHARE`` of its words). A language (NULL counts as one)
with fewer than ``MIN_REFERENCE_WORDS`` words has no reference, whatever its share of the corpus: its documents get no
distances and are not judged by divergence. References travel in one of two ways, with equal results: those of languages
with more than 1 / ``LANGUAGE_SHARE`` of all words with the tasks (by counting they are fewer than LANGUAGE_SHARE, with at
most COMMON_SHARE words each), those of the others, which may be any number, by a join on the language.

A document fails when the Jensen-Shannon distance (the root of the divergence in bits, 0 to 1) of its character
classes or of its common words from the reference exceeds a limit. Documents below the minimum length are not judged
by divergence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm import words
from lossgrid.llm.arrow import batch, schema_with, small, utf8
from lossgrid.session import materialise

COMMON_SHARE = 500
LANGUAGE_SHARE = 100
MIN_REFERENCE_WORDS = 10_000
MIN_BASE_WORDS = 50
MIN_WORDS = 100
MAX_CLASS_DISTANCE = 0.3
MAX_WORD_DISTANCE = 0.45
FLUSH_BYTES = 64 << 20

#: Character classes by lead byte: other, space, small, capital, digit, stop, symbol, two, three and four bytes.
CLASSES = ("other", "space", "small", "capital", "digit", "stop", "symbol", "two", "three", "four")
_CLASS = np.zeros(256, np.int64)
_CLASS[[9, 10, 11, 12, 13, 32]] = 1
_CLASS[97:123] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[[ord(c) for c in ".,;:?!'\"()-"]] = 5
_CLASS[[ord(c) for c in "#*$%&|<>@+=/\\^~_[]{}`"]] = 6
_CLASS[0xC0:0xE0] = 7
_CLASS[0xE0:0xF0] = 8
_CLASS[0xF0:] = 9
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1


def _sums(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[ends] - total[starts]


def class_counts(block: words.Block) -> np.ndarray:
    """Characters of each class (column) per text (row); bytes inside a character do not count."""
    classes = _CLASS[block.data]
    lead = (block.data & 0xC0) != 0x80
    return np.stack([_sums(lead & (classes == c), block.text_starts, block.text_ends) for c in range(len(CLASSES))], axis=1)


def repeated_lines(block: words.Block) -> np.ndarray:
    """Per text the lines with a word that equal an earlier line."""
    n = len(block.docs)
    feeds = np.flatnonzero(block.data == 10)
    owner_of_feed = np.searchsorted(block.text_starts, feeds, "right") - 1
    starts = np.concatenate([block.text_starts, feeds + 1])
    owner = np.concatenate([np.arange(n), owner_of_feed])
    order = np.argsort(starts, kind="stable")
    starts, owner = starts[order], owner[order]
    ends = np.append(starts[1:] - 1, block.text_ends[-1])
    ends = np.minimum(ends, block.text_ends[owner])
    filled = np.concatenate([[0], np.cumsum(~words.IS_SPACE[block.data])])
    some = filled[ends] > filled[starts]
    starts, ends, owner = starts[some], ends[some], owner[some]
    hashes = words.mix(words.span_hashes(block.data, starts, ends) ^ words.mix(owner.astype(np.uint64)))
    first = np.unique(hashes, return_index=True)[1]
    return np.bincount(owner, minlength=n) - np.bincount(owner[first], minlength=n)


def repeated_words(block: words.Block, hashes: np.ndarray, size: int = 3) -> np.ndarray:
    """Per text the words in ``size``-word windows that the text has twice or more."""
    n = len(block.docs)
    owner = block.text_of_word()
    grams = words.ngram_hashes(hashes, size)
    if not len(grams):
        return np.zeros(n, np.int64)
    inside = np.flatnonzero(owner[: len(grams)] == owner[size - 1 :])
    keys = words.mix(grams[inside] ^ words.mix(owner[inside].astype(np.uint64)))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = inside[order[np.append(same, False) | np.append(False, same)]] if len(keys) else inside
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + size, -1)
    return np.bincount(owner[np.cumsum(edge)[:-1] > 0], minlength=n)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of counts ``p`` from the shares ``q``; 0 for a row without counts."""
    p = p / np.maximum(p.sum(axis=-1, keepdims=True), 1)
    m = (p + q) / 2

    def part(x: np.ndarray) -> np.ndarray:
        return np.where(x > 0, x * np.log2(np.where(x > 0, x, 1) / np.where(m > 0, m, 1)), 0).sum(axis=-1)

    found = np.sqrt(np.maximum((part(p) + part(np.broadcast_to(q, p.shape))) / 2, 0))
    return np.where(p.sum(axis=-1) > 0, found, 0.0)


@dataclass
class Reference:
    """Shares of the character classes, the sorted hashes of the common words, and their shares (last: all others)."""

    classes: np.ndarray
    common: np.ndarray
    shares: np.ndarray


def _counts(base: DataFrame) -> DataFrame:
    """(lang, kind, key, n): kind 0 has words by hash, kind 1 character classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list[np.ndarray]] = {}
        classes: dict[str, np.ndarray] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in seen.items():
                keys, counts = np.unique(np.concatenate(parts), return_counts=True)
                n = len(keys)
                yield batch(
                    {
                        "lang": pa.array([lang] * (n + len(CLASSES)), pa.string()),
                        "kind": pa.array(np.repeat(np.array([0, 1], np.int32), [n, len(CLASSES)])),
                        "key": pa.array(np.concatenate([keys.view(np.int64), np.arange(len(CLASSES))])),
                        "n": pa.array(np.concatenate([counts, classes[lang]]).astype(np.int64)),
                    }
                )

        for part in small(batches):
            langs = part.column(2).to_pylist()
            for block in words.blocks(utf8(part.column(1))):
                hashes, of_class = block.hashes(), class_counts(block)
                for i, doc in enumerate(block.docs):
                    lang = langs[doc]
                    seen.setdefault(lang, []).append(hashes[block.first[i] : block.first[i + 1]])
                    classes[lang] = classes.get(lang, 0) + of_class[i]
                held += len(block.data)
                if held > FLUSH_BYTES:
                    yield from flush()
                    seen, classes, held = {}, {}, 0
        yield from flush()

    return base.mapInArrow(run, "lang string, kind int, key bigint, n bigint")


def _reference(classes: np.ndarray, keys: np.ndarray, counts: np.ndarray, total: int) -> Reference:
    common_words = keys.astype(np.int64).view(np.uint64)
    order = np.argsort(common_words)
    counts_of = counts[order].astype(np.float64)
    shares = np.append(counts_of / max(total, 1), max(0.0, 1 - counts_of.sum() / max(total, 1)))
    return Reference(classes / max(classes.sum(), 1), common_words[order], shares)


def references(base: DataFrame) -> tuple[dict[str, Reference], DataFrame]:
    """References of the languages with enough words: of the larger ones a dictionary, of the smaller ones a table
    (ref_lang, classes, keys, counts, total)."""
    counts = _counts(base).groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "rule-counts")
    totals = materialise(counts.filter("kind = 0").groupBy("lang").agg(F.sum("n").alias("total")), "rule-totals")
    everything = totals.agg(F.sum("total").alias("all")).first()["all"] or 0
    enough = totals.filter(F.col("total") >= MIN_REFERENCE_WORDS)
    large = F.col("total") * LANGUAGE_SHARE > everything

    def listed(wanted: DataFrame) -> DataFrame:
        own = counts.join(wanted, "lang").filter(f"kind = 1 OR n * {COMMON_SHARE} >= total")
        word, of_class = F.col("kind") == 0, F.col("kind") == 1
        return own.groupBy(F.col("lang").alias("ref_lang")).agg(
            F.map_from_entries(F.collect_list(F.when(of_class, F.struct(F.col("key").cast("int"), "n")))).alias("by_class"),
            F.collect_list(F.when(word, F.struct("key", "n"))).alias("common"),
            F.max("total").alias("total"),
        ).select(
            "ref_lang",
            F.array(*[F.coalesce(F.try_element_at("by_class", F.lit(c)), F.lit(0)) for c in range(len(CLASSES))]).alias("classes"),
            F.col("common.key").alias("keys"),
            F.col("common.n").alias("counts"),
            "total",
        )

    larger = listed(F.broadcast(enough.filter(large)))  # fewer than LANGUAGE_SHARE rows
    found = {
        row["ref_lang"]: _reference(*(np.array(row[c], np.int64) for c in ("classes", "keys", "counts")), row["total"])
        for row in larger.collect()
    }
    return found, materialise(listed(enough.filter(~large)), "rule-references")


EXTRA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, class_distance double, word_distance double"
)


def judge(
    docs: DataFrame,
    *,
    min_words: int = MIN_WORDS,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance, word_distance.

    NULL counts as '' and fails the base rules like every text of fewer than MIN_BASE_WORDS words. Texts below
    ``min_words`` words are not judged by divergence (their distances are reported all the same). Distances are NULL
    where the language has too few words for a reference. Equal texts of one language get equal results.
    """
    lang = F.coalesce(docs[f"`{lang_col}`"].cast("string"), F.lit(""))
    base = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), lang.alias("lang")
    )
    known, others = references(base)
    shape = schema_with(base, ["doc_id"], EXTRA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            langs = part.column(2).to_pylist()
            joined = part.num_columns > 3
            last: tuple = (None, None)
            for block in words.blocks(utf8(part.column(1))):
                hashes = block.hashes()
                n = block.counts()
                chars = np.concatenate([[0], np.cumsum(((block.data & 0xC0) != 0x80) & ~words.IS_SPACE[block.data])])
                repeats = repeated_words(block, hashes)
                failed = (n < MIN_BASE_WORDS) | (100 * repeats > 50 * n)
                own = class_counts(block)
                by_class, by_word = np.zeros(len(n)), np.zeros(len(n))
                for i, doc in enumerate(block.docs):
                    reference = known.get(langs[doc])
                    if joined and langs[doc] != last[0]:
                        own_row = [part.column(c)[doc].as_py() for c in range(3, 7)]
                        given = own_row[3] is not None
                        last = langs[doc], _reference(*(np.array(x, np.int64) for x in own_row[:3]), own_row[3]) if given else None
                    if joined:
                        reference = last[1]
                    if reference is None:
                        by_class[i] = by_word[i] = np.nan
                        continue
                    by_class[i] = js_distance(own[i], reference.classes)
                    mine = hashes[block.first[i] : block.first[i + 1]]
                    place = np.searchsorted(reference.common, mine)
                    place[place == len(reference.common)] = 0
                    hit = reference.common[place] == mine if len(reference.common) else np.zeros(len(mine), bool)
                    counts = np.bincount(place[hit], minlength=len(reference.common) + 1)
                    counts[-1] = len(mine) - hit.sum()
                    by_word[i] = js_distance(counts, reference.shares)
                far = (n >= min_words) & ((by_class > max_class_distance) | (by_word > max_word_distance))
                yield batch(
                    {
                        "doc_id": part.column(0).slice(block.docs.start, len(block.docs)),
                        "n_words": pa.array(n, pa.int64()),
                        "word_chars": pa.array(chars[block.text_ends] - chars[block.text_starts]),
                        "n_symbols": pa.array(_sums(_SYMBOL[block.data], block.text_starts, block.text_ends)),
                        "n_dup_lines": pa.array(repeated_lines(block)),
                        "n_repeat_words": pa.array(repeats),
                        "base_failed": pa.array(failed),
                        "kept": pa.array(~failed & ~far),
                        "class_distance": pa.array(by_class, from_pandas=True),
                        "word_distance": pa.array(by_word, from_pandas=True),
                    }
                )

    # Languages without a reference go with the small ones and find none there.
    small_lang = ~F.col("lang").isin(list(known))
    apart = base.filter(small_lang)
    if others.isEmpty():
        return base.mapInArrow(run, shape)
    apart = apart.join(others, F.col("lang") == F.col("ref_lang"), "left").drop("ref_lang")
    return base.filter(~small_lang).mapInArrow(run, shape).unionByName(apart.mapInArrow(run, shape))
