"""Token counts by byte-pair merging with a heap and a linked list.

The vocabulary of a piece model gives each piece a rank. A text is a chain of symbols; the adjacent pair whose
concatenation has the lowest rank (the leftmost of equals) is merged until no pair is in the vocabulary. Only the
number of merges is kept: the count is the number of initial symbols less the merges. A character outside the
vocabulary counts as its UTF-8 bytes.

No piece has a space mark behind another character and none a line feed, so merges never cross the start of a
run of space marks or a line feed; texts are cut there, and the counts of recent cuts are remembered in a bounded
table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from lossgrid.llm.arrow import batch, id_and_text, schema_with, small

MARK = "▁"
REMEMBERED = 400_000


class PieceCounter:
    """Counts tokens of whole texts for one piece model."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [
            (model.id_to_piece(i), model.get_score(i))
            for i in range(model.get_piece_size())
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.rank = {piece: int(-score) for piece, score in pieces}
        self.characters = {piece for piece in self.rank if len(piece) == 1}
        if any(MARK in piece.lstrip(MARK) or "\n" in piece for piece in self.rank):
            raise ValueError("pieces that span words are not supported")
        if any(c not in self.rank for piece in self.rank for c in piece):
            raise ValueError("every character of a piece must be a piece")
        #: Neighbours inside some piece; no merge can join two characters that are not.
        self.neighbours = {piece[i : i + 2] for piece in self.rank for i in range(len(piece) - 1)}
        self.counts = {MARK: _Remembered(self, MARK), "": _Remembered(self, "")}

    def chain(self, text: str) -> int:
        """Tokens of a text without cuts: initial symbols less merges.

        Heap items are rank and left symbol in one integer; an item is stale unless its rank is still that of the
        pair the left symbol begins.
        """
        get = self.rank.get
        n = len(text)
        symbols = n
        if not self.characters.issuperset(text):
            symbols = sum(1 if c in self.rank else len(c.encode("utf-8", "surrogatepass")) for c in text)
        piece = list(text)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        of_pair = [get(text[i : i + 2], -1) for i in range(n - 1)]
        of_pair.append(-1)
        heap = [r << 32 | i for i, r in enumerate(of_pair) if r >= 0]
        heapify(heap)
        merges = 0
        while heap:
            item = heappop(heap)
            i = item & 0xFFFFFFFF
            if of_pair[i] != item >> 32:
                continue
            j = right[i]
            merged = piece[i] = piece[i] + piece[j]
            merges += 1
            of_pair[i] = of_pair[j] = -1
            after = right[i] = right[j]
            if after < n:
                left[after] = i
                r = get(merged + piece[after])
                if r is not None:
                    of_pair[i] = r
                    heappush(heap, r << 32 | i)
            before = left[i]
            if before >= 0:
                r = of_pair[before] = get(piece[before] + merged, -1)
                if r >= 0:
                    heappush(heap, r << 32 | before)
        return symbols - merges

    def split(self, prefix: str, cut: str) -> int:
        """Tokens of prefix + cut, cut further where no piece has both neighbours."""
        text = prefix + cut
        neighbours = self.neighbours
        at = [i + 1 for i in range(len(text) - 1) if text[i : i + 2] not in neighbours]
        if not at:
            return self.chain(text)
        bounds = [0, *at, len(text)]
        total = 0
        for a, b in zip(bounds, bounds[1:]):
            part = text[a:b]
            table, key = (self.counts[MARK], part[1:]) if part[0] == MARK else (self.counts[""], part)
            total += table[key] if key != cut or table.prefix != prefix else self.chain(part)
        return total

    def count(self, text: str) -> int:
        if not text:
            return 0
        if MARK in text or "  " in text or text[0] == " " or text[-1] == " " or " \n" in text or "\n " in text:
            marked = MARK + text.replace(" ", MARK)
            remembered = self.counts[""]
            return sum(map(remembered.__getitem__, re.findall(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n", marked)))
        total = 0
        plain, spaced = self.counts[""], self.counts[MARK]
        first = True
        for line in text.split("\n"):
            words = line.split(" ")
            # Only the first word of a text, and words behind a space, carry the mark.
            total += (spaced if first else plain)[words[0]] + sum(map(spaced.__getitem__, words[1:]))
            first = False
        return total + text.count("\n")


class _Remembered(dict):
    """Counts of recent cuts, emptied when full."""

    def __init__(self, counter: PieceCounter, prefix: str) -> None:
        super().__init__()
        self.counter, self.prefix = counter, prefix

    def __missing__(self, cut: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self.counter.split(self.prefix, cut)
        if len(cut) <= 64:
            self[cut] = found
        return found


def count_tokens(docs: DataFrame, model_file: str, *, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    Whole texts, no begin or end tokens; NULL counts as ''. An empty text has 0 tokens. Ids may be NULL or repeat;
    every row gets its count. The model file is read by each Python worker once.
    """
    base = id_and_text(docs, id_col=id_col, text_col=text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model_file)
        for part in small(batches):
            texts = part.column(1).to_pylist()
            tokens = [counter.count(t) for t in texts]
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            yield batch(
                {
                    "doc_id": part.column(0),
                    "n_bytes": pa.array(sizes, pa.int64()),
                    "n_tokens": pa.array(tokens, pa.int64()),
                    "over_limit": pa.array([n > limit for n in tokens], pa.bool_()),
                }
            )

    return base.mapInArrow(run, schema_with(base, ["doc_id"], "n_bytes bigint, n_tokens bigint, over_limit boolean"))
