"""Byte-level byte-pair encoding and decoding with padded numpy matrices.

Texts are cut by the tokenizer's pattern. The distinct pieces of a block of texts that are not remembered are
laid out as rows of token ids, in buckets of similar length, padded with -1. In each round every row merges its
leftmost adjacent pair of minimum rank; pairs are looked up in an open-addressing hash table of (left id, right
id), merged cells are closed up, and rows without a pair leave the matrix. Pieces longer than LONG_PIECE bytes form
one-row matrices; there a round merges all occurrences of the minimum pair at once where that gives the same result
as one by one, so that a text of one huge piece stays affordable.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.arrow import batch, id_and_text, lists, schema_with, small, spans_by_size

BLOCK_CHARS = 1 << 19
LONG_PIECE = 512
REMEMBERED = 200_000
ROWS = 1 << 14
NO_RANK = np.int32(2**31 - 1)
_HASH = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Hash table of adjacent id pairs to the id (which is the rank) of their concatenation."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        keys, ids = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ids.append(rank)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ids = np.full(1 << self.bits, NO_RANK, np.int32)
        key, value = np.array(keys, np.int64), np.array(ids, np.int32)
        slot = self._slots(key)
        self.probes = 0
        while len(key):
            self.probes += 1
            free = np.flatnonzero(self.keys[slot] < 0)
            winners = free[np.unique(slot[free], return_index=True)[1]]
            self.keys[slot[winners]], self.ids[slot[winners]] = key[winners], value[winners]
            stay = np.ones(len(key), bool)
            stay[winners] = False
            key, value, slot = key[stay], value[stay], (slot[stay] + 1) & (len(self.keys) - 1)

    def _slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * _HASH) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_RANK if it has none or a side is padding."""
        key = (left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)).ravel()
        out = np.full(len(key), NO_RANK, np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._slots(key[todo])
        while len(todo):
            there = self.keys[slot]
            hit = there == key[todo]
            out[todo[hit]] = self.ids[slot[hit]]
            on = ~hit & (there >= 0)
            todo, slot = todo[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out.reshape(left.shape)


class ByteBpe:
    """Encodes and decodes with one vocabulary of byte strings ranked by id."""

    def __init__(self, ranks_file: str, pattern: str) -> None:
        import regex

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.pieces = regex.compile(pattern).findall
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pairs = PairTable(ranks)
        # Tokens end to end, with their offsets by id.
        tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_at = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
        self.remembered: dict[str, bytes] = {}

    # --- merging ---

    def _merge_rows(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(row, merged ids) of each row of a padded matrix."""
        rows = np.arange(len(ids))
        ranks = self.pairs.find(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = np.argmin(ranks, axis=1)  # the leftmost of equals
            lowest = ranks[np.arange(len(rows)), at]
            done = lowest == NO_RANK
            if done.any():
                for row, line in zip(rows[done], ids[done]):
                    yield int(row), line[line >= 0]
                go = ~done
                rows, ids, ranks, at, lowest = rows[go], ids[go], ranks[go], at[go], lowest[go]
                if not len(rows):
                    return
                # Compaction: no row is longer than the longest left.
                width = max(2, int((ids >= 0).sum(axis=1).max()))
                ids, ranks = ids[:, :width], ranks[:, : width - 1]
            each = np.arange(len(rows))
            columns = np.arange(ids.shape[1])
            closed = np.concatenate([ids[:, 1:], np.full((len(rows), 1), -1, ids.dtype)], axis=1)
            ids = np.where(columns[None, :] > at[:, None], closed, ids)
            ids[each, at] = lowest
            closed = np.concatenate([ranks[:, 1:], np.full((len(rows), 1), NO_RANK, np.int32)], axis=1)
            ranks = np.where(columns[None, : ranks.shape[1]] > at[:, None], closed, ranks)
            # Only the pairs on either side of the merged cell are new.
            after = np.minimum(at + 1, ids.shape[1] - 1)
            right = np.where(at + 1 < ids.shape[1], ids[each, after], -1)
            inside = at < ranks.shape[1]
            ranks[each[inside], at[inside]] = self.pairs.find(lowest[inside], right[inside])
            behind = at > 0
            ranks[each[behind], at[behind] - 1] = self.pairs.find(ids[each, at - 1][behind], lowest[behind])

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """The same merges on one long row.

        All non-overlapping occurrences of the minimum pair, taken from the left, are merged at once if no pair that
        any of them brings about has a lower rank: then one by one they would come next in turn anyway. Otherwise
        only the leftmost is merged.
        """
        ranks = self.pairs.find(ids[:-1], ids[1:])
        while len(ranks):
            lowest = ranks.min()
            if lowest == NO_RANK:
                break
            found = np.flatnonzero(ranks == lowest)
            # In a run of overlapping occurrences every second one is merged, from the left.
            head = np.append(True, np.diff(found) > 1)
            start = found[np.maximum.accumulate(np.where(head, np.arange(len(found)), 0))]
            found = found[(found - start) % 2 == 0]
            merged = np.full(len(found), lowest, np.int32)
            before = np.where(found > 0, ids[found - 1], -1)
            after = np.where(found + 2 < len(ids), ids[np.minimum(found + 2, len(ids) - 1)], -1)
            new = [self.pairs.find(before, merged), self.pairs.find(merged, after), self.pairs.find(merged[:1], merged[:1])]
            if min(int(x.min()) for x in new) < lowest:
                found = found[:1]
            keep = np.ones(len(ids), bool)
            keep[found + 1] = False
            ids = ids.copy()
            ids[found] = lowest
            ids = ids[keep]
            ranks = self.pairs.find(ids[:-1], ids[1:])
        return ids

    def encode_pieces(self, pieces: Sequence[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        # Buckets by the number of bits of the length: padding at most doubles a row.
        buckets = np.where(sizes <= 8, sizes, 8 + np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
        for bucket in np.unique(buckets):
            members = np.flatnonzero(buckets == bucket)
            width = int(sizes[members].max())
            if width < 2:
                for i in members:
                    out[i] = self.byte_id[np.frombuffer(pieces[i], np.uint8)]
                continue
            if width > LONG_PIECE:
                for i in members:
                    out[i] = self._merge_long(self.byte_id[np.frombuffer(pieces[i], np.uint8)])
                continue
            for low in range(0, len(members), ROWS):
                part = members[low : low + ROWS]
                filled = np.arange(width)[None, :] < sizes[part][:, None]
                ids = np.full((len(part), width), -1, np.int32)
                ids[filled] = self.byte_id[np.frombuffer(b"".join(pieces[i] for i in part), np.uint8)]
                for row, line in self._merge_rows(ids):
                    out[part[row]] = line
        return out

    # --- texts ---

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and len(texts) + 1 offsets."""
        cut = [self.pieces(text) for text in texts]
        local: dict[str, int] = {}
        for found in cut:
            for piece in dict.fromkeys(found):
                if piece not in local:
                    local[piece] = len(local)
        fresh = [p for p in local if p not in self.remembered]
        known = self.remembered
        if len(known) + len(fresh) > REMEMBERED:
            self.remembered = known = {p: known[p] for p in local if p in known}
        encoded = self.encode_pieces([p.encode("utf-8", "surrogatepass") for p in fresh])
        known.update((p, ids.tobytes()) for p, ids in zip(fresh, encoded, strict=True))
        rows = [known[p] for p in local]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // 4
        at = np.concatenate([[0], np.cumsum(sizes)])
        table = np.frombuffer(b"".join(rows), np.int32)
        which = np.concatenate(
            [np.fromiter(map(local.__getitem__, found), np.int64, len(found)) for found in cut] or [np.empty(0, np.int64)]
        )
        piece_ends = np.cumsum([0, *map(len, cut)])
        ids, ends = _gather(table, at, which)
        return ids, ends[piece_ends]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Bytes of each run of ids between two offsets."""
        data, ends = _gather(self.token_bytes, self.token_at, ids)
        raw = data.tobytes()
        cuts = ends[offsets]
        return [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _gather(values: np.ndarray, at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``values[at[i]:at[i + 1]]`` for each i of ``which`` end to end, and their len + 1 offsets."""
    sizes = at[which + 1] - at[which]
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    index = np.arange(ends[-1]) + np.repeat(at[which] - ends[:-1], sizes)
    return values[index], ends


def encode(docs: DataFrame, ranks_file: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, ids (array of int). Whole texts, no special tokens; NULL counts as ''.

    An empty text has no ids. Ids of documents may be NULL or repeat. Texts are worked on in blocks of about
    BLOCK_CHARS characters; a longer text is a block of its own.
    """
    base = id_and_text(docs, id_col=id_col, text_col=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ByteBpe(ranks_file, pattern)
        for part in small(batches):
            texts = part.column(1).to_pylist()
            for low, high in spans_by_size(map(len, texts), BLOCK_CHARS):
                ids, offsets = codec.encode(texts[low:high])
                yield batch({"doc_id": part.column(0).slice(low, high - low), "ids": lists(ids, offsets)})

    return base.mapInArrow(run, schema_with(base, ["doc_id"], "ids array<int>"))


def round_trip(docs: DataFrame, ranks_file: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and the bytes they decode to, in one pass: one Python worker per task instead of the two that
    ``decode`` on top of ``encode`` keeps busy. NULL counts as ''."""
    base = id_and_text(docs, id_col=id_col, text_col=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ByteBpe(ranks_file, pattern)
        for part in small(batches):
            texts = part.column(1).to_pylist()
            for low, high in spans_by_size(map(len, texts), BLOCK_CHARS):
                ids, offsets = codec.encode(texts[low:high])
                decoded = codec.decode(ids.astype(np.int64), offsets)
                yield batch(
                    {"doc_id": part.column(0).slice(low, high - low), "ids": lists(ids, offsets), "decoded": pa.array(decoded, pa.binary())}
                )

    return base.mapInArrow(run, schema_with(base, ["doc_id"], "ids array<int>, decoded binary"))


def decode(encoded: DataFrame, ranks_file: str, pattern: str) -> DataFrame:
    """Add ``decoded`` (the bytes of the ids) to (doc_id, ids) rows; NULL ids count as none.

    Bytes, not text: a cut inside a character decodes too.
    """
    rows = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = ByteBpe(ranks_file, pattern)
        for part in batches:
            column = part.column(1)
            offsets = column.offsets.to_numpy()
            for low, high in spans_by_size(np.diff(offsets).tolist(), BLOCK_CHARS):
                own = offsets[low : high + 1]
                ids = column.values.to_numpy(zero_copy_only=False)[own[0] : own[-1]].astype(np.int64)
                decoded = codec.decode(ids, own - own[0])
                yield batch(
                    {
                        "doc_id": part.column(0).slice(low, high - low),
                        "ids": column.slice(low, high - low),
                        "decoded": pa.array(decoded, pa.binary()),
                    }
                )

    return rows.mapInArrow(run, schema_with(rows, ["doc_id"], "ids array<int>, decoded binary"))
