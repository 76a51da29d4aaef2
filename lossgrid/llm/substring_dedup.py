"""Removing repeated passages with sharded phrase automata.

A phrase is a run of ``window`` consecutive words. An occurrence of a phrase is removed when the same words also
start earlier (in a document with a smaller id, or further ahead in the same one).

1. Documents with equal word sequences collapse to the one with the smallest id; the others are removed as a whole.
2. Anchors. In every phrase the ``GRAM``-word gram with the smallest hash is its anchor, so equal phrases have equal
   anchors, and neighbouring phrases mostly share one: about one word in eight starts an anchor. Tasks reduce what
   they saw to distinct anchors, packed per shard of the hash space; the shards find the anchors that recur.
3. Around recurring anchors the passages (all phrases with that anchor occurrence) are read from the texts and routed
   by anchor. Each task sends a passage once, with its first place in the task; further copies are settled at once.
4. Per shard: passages are compared word by word, phrases that recur in several of them are compiled into an
   Aho-Corasick automaton over word numbers, all passages stream through it, and every located occurrence but the
   earliest is covered.
5. Covered words are cut out of each document.

What a shard receives about a passage found in a third of all rows is one entry per task.

Heavy anchors. A short line in a third of all rows, each with its own words around it, makes one different passage per
row at the same anchor. Anchors of more than ``HEAVY_PLACES`` places (and of more than 1 / ``HEAVY_SLOTS`` of all, so
that by counting fewer than HEAVY_SLOTS are listed) are therefore cut finer: step 2 runs again over their phrases, by
the hash of all ``window`` words, and only phrases that recur are read as passages of one phrase and routed by that hash.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm import words
from lossgrid.llm.arrow import batch, id_and_text, lists, small, utf8
from lossgrid.session import materialise

WINDOW = 20
GRAM = 6
FLUSH_RUNS = 1 << 20
#: Passages per shard that the automata are laid out for.
SHARD_PASSAGES = 1 << 14
#: An anchor with more places than both is cut into its phrases: a number, and a share of all places.
HEAVY_PLACES = 1 << 11
HEAVY_SLOTS = 1 << 18


def anchored_runs(hashes: np.ndarray, first: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Runs of neighbouring phrases with one anchor: (text, first word, number of phrases, anchor hash).

    ``hashes`` are the word hashes of several texts end to end, ``first`` the offsets of the texts. First words are
    counted from the start of the text.
    """
    gram = min(GRAM, window)
    n = len(hashes) - window + 1
    if n <= 0:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, np.empty(0, np.uint64)
    grams = words.ngram_hashes(hashes, gram)
    best, at = grams[:n].copy(), np.arange(n)
    for j in range(1, window - gram + 1):
        other = grams[j : j + n]
        better = other < best
        np.copyto(best, other, where=better)
        at[better] = np.flatnonzero(better) + j
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]
    inside = np.arange(n) + window <= first[text + 1]
    starts = np.flatnonzero(inside)
    text, at, best = text[starts], at[starts], best[starts]
    if not len(starts):
        return text, starts, starts, best
    head = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    sizes = np.diff(np.append(head, len(starts)))
    return text[head], starts[head] - first[text[head]], sizes, best[head]


def sequence_hash(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One value per text for its whole sequence of words, two bijective mixes of 64 bits folded together."""
    out = np.zeros(len(first) - 1, np.uint64)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:])):
        place = np.arange(1, b - a + 1, dtype=np.uint64)
        out[i] = words.mix(hashes[a:b] ^ words.mix(place)).sum(dtype=np.uint64) + np.uint64(b - a)
    return words.mix(out)


def _sequences(base: DataFrame) -> DataFrame:
    """doc_id, sub, owner (hash of the word sequence), n_words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            for block in words.blocks(utf8(part.column(1))):
                owner = sequence_hash(block.hashes(), block.first)
                yield batch(
                    {
                        "doc_id": part.column(0).slice(block.docs.start, len(block.docs)),
                        "sub": part.column(2).slice(block.docs.start, len(block.docs)),
                        "owner": pa.array(owner.view(np.int64)),
                        "n_words": pa.array(block.counts(), pa.int64()),
                    }
                )

    return base.mapInArrow(run, "doc_id bigint, sub bigint, owner bigint, n_words bigint")


def heavy_phrases(hashes: np.ndarray, first: np.ndarray, heavy: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(text, first word, hash of the phrase) of every phrase whose anchor is listed in ``heavy``."""
    text, start, sizes, anchor = anchored_runs(hashes, first, window)
    mine = np.isin(anchor, heavy)
    text, start, sizes = text[mine], start[mine], sizes[mine]
    step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    text, start = np.repeat(text, sizes), np.repeat(start, sizes) + step
    return text, start, words.ngram_hashes(hashes, window)[first[text] + start] if len(text) else np.empty(0, np.uint64)


def recurring_runs(base: DataFrame, window: int, shard_bits: int, heavy: np.ndarray | None = None) -> DataFrame:
    """(owner, start) of the runs whose anchor occurs at two different places of two sequences or of one.

    Rows with ``places`` are no runs: they name (as owner) an anchor of more than HEAVY_PLACES places and count these.
    With ``heavy``, a list of anchors, the same of the phrases with these anchors, by their hash instead of the anchor.
    """
    key_bits = np.uint64(64 - shard_bits)
    at_least = HEAVY_PLACES

    def pack(anchors: np.ndarray, owners: np.ndarray, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((starts, owners, anchors))
        anchors, owners, starts = anchors[order], owners[order], starts[order]
        new = np.append(True, (anchors[1:] != anchors[:-1]) | (owners[1:] != owners[:-1]) | (starts[1:] != starts[:-1]))
        anchors, owners, starts = anchors[new], owners[new], starts[new]
        head = np.append(True, anchors[1:] != anchors[:-1])
        places = np.diff(np.append(np.flatnonzero(head), len(anchors)))
        many = np.repeat(places > 1, places)
        # An anchor seen at several places here is sent once; its places are known to recur.
        send = head | many
        flags = np.where(many, np.where(head, 1, 2), 0).astype(np.uint8)
        # The others need no company and are dealt by owner: an anchor found everywhere is one entry of its shard.
        shards = (np.where(flags < 2, anchors, owners) >> key_bits).astype(np.int32)
        counts = np.repeat(places, places)
        order = np.argsort(shards, kind="stable")
        shards, anchors, owners, starts, send, flags, counts = (
            x[order] for x in (shards, anchors, owners, starts, send, flags, counts)
        )
        cuts = np.append(np.flatnonzero(np.append(True, shards[1:] != shards[:-1])), len(shards))
        rows: dict[str, list] = {"shard": [], "anchors": [], "counts": [], "owners": [], "starts": [], "flags": []}
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows["shard"].append(int(shards[a]))
            own = send[a:b]
            rows["anchors"].append(anchors[a:b][flags[a:b] < 2].tobytes())
            rows["counts"].append(counts[a:b][flags[a:b] < 2].astype(np.uint32).tobytes())
            rows["owners"].append(owners[a:b][own].tobytes())
            rows["starts"].append(starts[a:b][own].astype(np.uint32).tobytes())
            rows["flags"].append(flags[a:b][own].tobytes())
        kinds = {"shard": pa.int32()}
        yield batch({k: pa.array(v, kinds.get(k, pa.binary())) for k, v in rows.items()})

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for part in small(batches):
            for block in words.blocks(utf8(part.column(1))):
                hashes = block.hashes()
                if heavy is None:
                    text, start, _, anchor = anchored_runs(hashes, block.first, window)
                else:
                    text, start, anchor = heavy_phrases(hashes, block.first, heavy, window)
                if len(text):
                    held.append((anchor, sequence_hash(hashes, block.first)[text], start))
                if sum(len(x[0]) for x in held) >= FLUSH_RUNS:
                    yield from pack(*(np.concatenate(x) for x in zip(*held)))
                    held = []
        if held:
            yield from pack(*(np.concatenate(x) for x in zip(*held)))

    def settle(key: tuple, packed: pd.DataFrame) -> pd.DataFrame:
        flags = np.frombuffer(b"".join(packed["flags"]), np.uint8)
        owners = np.frombuffer(b"".join(packed["owners"]), np.uint64)
        starts = np.frombuffer(b"".join(packed["starts"]), np.uint32).astype(np.int64)
        anchors = np.frombuffer(b"".join(packed["anchors"]), np.uint64)
        sent = flags < 2  # entries that carry their anchor
        known = flags[sent] == 1
        own, at = owners[sent], starts[sent]
        order = np.lexsort((at, own, anchors))
        a, o, s, k = anchors[order], own[order], at[order], known[order]
        counts = np.frombuffer(b"".join(packed["counts"]), np.uint32)[order]
        head = np.append(True, a[1:] != a[:-1]) if len(a) else np.empty(0, bool)
        group = np.cumsum(head) - 1
        other = np.append(False, (a[1:] == a[:-1]) & ((o[1:] != o[:-1]) | (s[1:] != s[:-1]))) if len(a) else head
        recurs = (np.bincount(group, other) + np.bincount(group, k)) > 0 if len(a) else head
        found = recurs[group] if len(a) else head
        owner = np.concatenate([o[found], owners[~sent]])
        start = np.concatenate([s[found], starts[~sent]])
        places = np.bincount(group, counts).astype(np.int64) if len(a) else np.empty(0, np.int64)
        many = np.flatnonzero(places > at_least)
        none = pd.array([pd.NA] * len(owner), "Int64")
        runs = pd.DataFrame({"owner": owner.view(np.int64), "start": start.astype(np.int32), "places": none})
        listed = pd.DataFrame({"owner": a[head][many].view(np.int64), "start": np.full(len(many), -1, np.int32), "places": pd.array(places[many], "Int64")})
        return pd.concat([runs, listed])

    schema = "shard int, anchors binary, counts binary, owners binary, starts binary, flags binary"
    return base.mapInArrow(build, schema).groupBy("shard").applyInPandas(settle, "owner bigint, start int, places bigint")


PASSAGE_SCHEMA = "shard int, anchor bigint, passage binary, doc_id bigint, sub bigint, start int, phrases int, settled boolean"


def passages(texts: DataFrame, window: int, shards: int, heavy: np.ndarray) -> DataFrame:
    """Passages around recurring runs of (doc_id, text, starts, phrases, sub) rows, once per task; further copies as settled rows.

    Runs with an anchor in ``heavy`` are left out; ``phrases`` lists the first words of their phrases that recur.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[tuple[int, bytes], tuple[int, int, int, int]] = {}
        settled: list[tuple[int, int, int, int]] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            n, m = len(first), len(settled)
            anchors = np.array([a for a, _ in first], np.uint64)
            places = np.array([*first.values(), *settled], np.int64).reshape(n + m, 4)
            shard = np.concatenate([anchors % np.uint64(shards), np.arange(m, dtype=np.uint64) % np.uint64(shards)])
            yield batch(
                {
                    "shard": pa.array(shard.astype(np.int32)),
                    "anchor": pa.array(np.concatenate([anchors, np.zeros(m, np.uint64)]).view(np.int64)),
                    "passage": pa.array([p for _, p in first] + [None] * m, pa.binary()),
                    "doc_id": pa.array(places[:, 0]),
                    "sub": pa.array(places[:, 1]),
                    "start": pa.array(places[:, 2].astype(np.int32)),
                    "phrases": pa.array(places[:, 3].astype(np.int32)),
                    "settled": pa.array([False] * n + [True] * m, pa.bool_()),
                }
            )

        for part in small(batches):
            ids, wanted, singles, subs = (part.column(c).to_pylist() for c in (0, 2, 3, 4))
            for block in words.blocks(utf8(part.column(1))):
                hashes = block.hashes()
                text, start, sizes, anchor = anchored_runs(hashes, block.first, window)
                by_anchor = ~np.isin(anchor, heavy)
                whole = words.ngram_hashes(hashes, window) if len(heavy) else hashes
                low = np.searchsorted(text, np.arange(len(block.docs) + 1))
                raw = block.data.tobytes()
                for i, doc in enumerate(block.docs):
                    mine = slice(int(low[i]), int(low[i + 1]))
                    chosen = np.flatnonzero(np.isin(start[mine], np.asarray(wanted[doc] or (), np.int64)) & by_anchor[mine]) + mine.start
                    base = int(block.first[i])
                    found = [(int(anchor[r]), int(start[r]), int(sizes[r])) for r in chosen.tolist()]
                    found += [(int(whole[base + s]), s, 1) for s in singles[doc] or ()]
                    for of, s, n in found:
                        a, b = base + s, base + s + n + window - 1
                        # Words joined by one space, whatever stands between them in the text.
                        passage = b" ".join(raw[block.starts[a] : block.ends[b - 1]].split())
                        key, place = (of, passage), (ids[doc], subs[doc], s, n)
                        before = first.get(key)
                        if before is None:
                            first[key] = place
                            held += len(passage)
                        elif place != before:
                            first[key], later = min(before, place), max(before, place)
                            settled.append(later)
                            held += 32
                if held > 32 << 20:
                    yield from flush()
                    first, settled, held = {}, [], 0
        if first or settled:
            yield from flush()

    return texts.mapInArrow(run, PASSAGE_SCHEMA)


def covered_by_automaton(rows: list[tuple], window: int) -> list[tuple]:
    """(doc, start, phrases) of the occurrences that are not the earliest.

    ``rows`` are (anchor, passage, doc, start, phrases), a doc being (doc_id, sub); rows of equal anchor and passage are copies.
    """
    out: list[tuple] = []
    first: dict[tuple[int, bytes], tuple] = {}
    for anchor, passage, doc, start, phrases in sorted(set(rows), key=lambda r: (r[2], r[3])):
        if (anchor, passage) in first:
            out.append((doc, start, phrases))  # a copy of an earlier passage
        else:
            first[anchor, passage] = (doc, start, phrases)
    variants = Counter(anchor for anchor, _ in first)
    numbers: dict[bytes, int] = {}
    streams = []
    for (anchor, passage), place in first.items():
        if variants[anchor] > 1:  # phrases of equal anchors only can be equal
            ids = tuple(numbers.setdefault(w, len(numbers) + 1) for w in passage.split(b" "))
            streams.append((ids, place))
    seen = Counter(ids[i : i + window] for ids, _ in streams for i in range(len(ids) - window + 1))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for phrase, count in seen.items():
        if count > 1:
            automaton.add_word(phrase, len(automaton))
    if not len(automaton):
        return out
    automaton.make_automaton()
    located: dict[int, list[tuple]] = defaultdict(list)
    for ids, (doc, start, _) in streams:
        for end, phrase in automaton.iter(ids):
            located[phrase].append((doc, start + end - window + 1))
    later = set()
    for places in located.values():
        earliest = min(places)
        later.update(p for p in places if p != earliest)
    out.extend((doc, start, 1) for doc, start in later)
    return out


def _covers(found: DataFrame, window: int) -> DataFrame:
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        settled = rows["settled"].to_numpy(bool)
        columns = ["doc_id", "sub", "start", "phrases"]
        places = list(zip(*(rows.loc[settled, c].tolist() for c in columns)))
        own = [rows.loc[~settled, c].tolist() for c in ("anchor", "passage", *columns)]
        open_rows = list(zip(*own[:2], zip(*own[2:4]), *own[4:]))
        places += [(*doc, start, phrases) for doc, start, phrases in covered_by_automaton(open_rows, window)]
        return pd.DataFrame(places, columns=columns).astype("int64")

    return found.groupBy("shard").applyInPandas(run, "doc_id bigint, sub bigint, start bigint, phrases bigint")


def remove_repeats(docs: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_words, n_removed, kept_text (kept words joined by a space), spans.

    ``spans`` lists the removed stretches as (first word, number of words). Words are runs of non-space bytes and
    stay unchanged; NULL, empty and short texts lose nothing. Ids are whole numbers and name documents: rows that
    repeat an id with its text are one document, do not count as copies of each other and get one result. Rows that
    repeat an id with another text are documents of their own, ordered by the hash of the text. NULL is no name: each
    such row is a document, ahead of all others.
    """
    base = id_and_text(docs, id_col=id_col, text_col=text_col)
    base = base.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    # A document is (doc_id, sub): the hash of its text, or, without an id, a row number written with the row.
    nameless = base.filter("doc_id IS NULL").select(F.lit(-(2**63)).alias("doc_id"), "text", F.monotonically_increasing_id().alias("sub"))
    nameless = materialise(nameless, "repeat-no-id")
    base = base.filter("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("text").alias("sub")).unionByName(nameless)
    spark = docs.sparkSession
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    shard_bits = min(20, max(1, (partitions - 1).bit_length()))

    sequences = materialise(_sequences(base), "repeat-sequences")
    long = sequences.filter(F.col("n_words") >= window)
    owners = long.groupBy("owner", "n_words").agg(F.min(F.struct("doc_id", "sub")).alias("rep"))
    owners = materialise(owners, "repeat-owners")
    copies = long.join(owners.select(F.col("owner").alias("_o"), F.col("n_words").alias("_n"), "rep"), (F.col("owner") == F.col("_o")) & (F.col("n_words") == F.col("_n")))
    copies = copies.filter("doc_id <> rep.doc_id OR sub <> rep.sub").select("doc_id", "sub", F.lit(0).cast("bigint").alias("start"), (F.col("n_words") - (window - 1)).alias("phrases"))

    found = materialise(recurring_runs(base.select("doc_id", "text"), window, shard_bits), "repeat-runs")
    runs = found.filter("places IS NULL").select("owner", "start", F.lit(False).alias("single"))
    total = runs.count()
    limit = max(HEAVY_PLACES, total // HEAVY_SLOTS)  # fewer than HEAVY_SLOTS anchors have more than that share
    listed = found.filter(F.col("places") > limit).select("owner").toArrow().column(0).to_numpy().astype(np.int64)
    heavy = np.unique(listed).view(np.uint64)
    if len(heavy):
        phrases = materialise(recurring_runs(base.select("doc_id", "text"), window, shard_bits, heavy), "repeat-phrases").filter("places IS NULL")
        runs = runs.unionByName(phrases.select("owner", "start", F.lit(True).alias("single")))
    shards = max(1, (runs.count() if len(heavy) else total) // SHARD_PASSAGES)
    starts = [F.collect_set(F.when(F.col("single") == one, F.col("start"))).alias(n) for n, one in (("starts", False), ("phrases", True))]
    by_doc = runs.join(owners.select("owner", "rep"), "owner").groupBy("rep").agg(*starts)
    by_doc = by_doc.select(F.col("rep.doc_id").alias("_id"), F.col("rep.sub").alias("_sub"), "starts", "phrases")
    same = (F.col("doc_id") == F.col("_id")) & (F.col("sub") == F.col("_sub"))
    texts = base.join(by_doc, same).select("doc_id", "text", "starts", "phrases", "sub")
    covers = _covers(passages(texts, window, shards, heavy), window).unionByName(copies.distinct())
    spans = covers.groupBy(F.col("doc_id").alias("_id"), F.col("sub").alias("_sub")).agg(F.collect_list(F.struct("start", "phrases")).alias("covers"))
    spans = spans.select("_id", "_sub", F.col("covers.start").alias("at"), F.col("covers.phrases").alias("phrases"))
    spans = materialise(spans, "repeat-covers")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            at, phrases = part.column(2).to_pylist(), part.column(3).to_pylist()
            for block in words.blocks(utf8(part.column(1))):
                raw = block.data.tobytes()
                total, removed, kept, first, length = [], [], [], [], []
                for i, doc in enumerate(block.docs):
                    own = raw[block.text_starts[i] : block.text_ends[i]].split()
                    gone = np.zeros(len(own) + 1, np.int64)
                    if at[doc]:
                        s = np.asarray(at[doc], np.int64)
                        np.add.at(gone, s, 1)
                        np.add.at(gone, np.minimum(s + np.asarray(phrases[doc], np.int64) + window - 1, len(own)), -1)
                    gone = np.cumsum(gone)[:-1] > 0
                    edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                    total.append(len(own))
                    removed.append(int(gone.sum()))
                    kept.append(b" ".join([w for w, g in zip(own, gone.tolist()) if not g]) if removed[-1] else b" ".join(own))
                    first.append(edge[0::2])
                    length.append(edge[1::2] - edge[0::2])
                offsets = np.cumsum([0, *map(len, first)])
                yield batch(
                    {
                        "doc_id": part.column(0).slice(block.docs.start, len(block.docs)),
                        "n_words": pa.array(total, pa.int64()),
                        "n_removed": pa.array(removed, pa.int64()),
                        "kept_text": pa.array(kept, pa.binary()).cast(pa.string()),
                        "span_starts": lists(np.concatenate(first).astype(np.int64), offsets),
                        "span_words": lists(np.concatenate(length).astype(np.int64), offsets),
                    }
                )

    joined = base.join(spans, same, "left").select("doc_id", "text", "at", "phrases")
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string, span_starts array<bigint>, span_words array<bigint>"
    result = joined.mapInArrow(cut, schema)
    own_id = F.when(F.col("doc_id") != F.lit(-(2**63)), F.col("doc_id"))
    spans_of = F.arrays_zip(F.col("span_starts").alias("first"), F.col("span_words").alias("words"))
    return result.select(own_id.alias("doc_id"), "n_words", "n_removed", "kept_text", spans_of.alias("spans"))
