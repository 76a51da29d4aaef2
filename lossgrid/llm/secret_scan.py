"""Secrets: fixed patterns, and further spans tagged by a linear-chain conditional random field.

Tokens are runs of letters and digits (bytes beyond ASCII count as letters) and runs of one mark. Each has a shape
(length, kinds of characters, changes between them), sees its neighbours' kinds, whether they touch, which keyword
stands just ahead, and two features of its file. The field scores the labels outside, begin and inside with these
features and with label transitions (inside never follows outside); Viterbi decoding gives the best labelling of the
whole text. A token can be in a span only if some run of tokens through it scores at least as well as outside;
that bound comes from running sums, so the exact decoding has to walk only through the few stretches it leaves.

The field is trained here, by maximum likelihood, on windows of at most ``SAMPLE`` documents with and as many without
a pattern match, those with the smallest hash of their id. Each gives two windows: one around a match (or at a random
place of a text without), and one around a line that is written into the text at a random place: a secret in one of
``FORMS``, most of which the patterns do not know, or harmless text that looks like one. Places and secrets follow from
the document's id, so a rerun trains the same field.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm import words
from lossgrid.llm.arrow import batch, id_and_text, schema_with, small, utf8
from lossgrid.session import materialise

SAMPLE = 400
WINDOW = 48
ROUNDS = 120
RATE = 0.15
PENALTY = 2e-4
OUTSIDE, BEGIN, INSIDE = range(3)

# Fixed patterns: kind, pattern, group whose length counts, least length.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = (
    ("assign", re.compile(ASSIGN, re.IGNORECASE | re.ASCII), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
KINDS = ("assign", "access", "hex", "crf")
KEYWORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "key", "auth", "bearer", "credential", "private", "access")
_HEX = re.compile(r"[0-9a-f]{32,}")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches in code points, ordered; per kind leftmost and non-overlapping."""
    found = []
    small = text.lower()
    if any(w in small for w in _WORDS):
        _, pattern, group, least = PATTERNS[0]
        found += [(m.start(), 0, m.end()) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in PATTERNS[1][1].finditer(text) if m.end() - m.start() >= PATTERNS[1][3]]
    # A match is a whole run of these characters, so runs that are too short need not be looked at.
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    found.sort()
    return found


# --- secrets and harmless text that are written into training texts ----------------------------------------

ALNUM = string.ascii_letters + string.digits
BASE64 = ALNUM + "+/"
URL_SAFE = ALNUM + "-_"
LOUD = ALNUM + "!@#$%^&*"

#: Text ahead, fixed head of the secret, alphabet, least and greatest length of the rest, text behind.
FORMS = (
    ("pwd = ", "", LOUD, 8, 20, ""),
    ("pwd: '", "", LOUD, 8, 20, "'"),
    ("passphrase: ", "", ALNUM, 12, 28, ""),
    ("credential=", "", ALNUM, 16, 40, ""),
    ("auth_key = \"", "", BASE64, 24, 44, "\""),
    ("private_key: ", "", BASE64, 40, 64, ""),
    ("access key ", "", BASE64, 40, 40, ""),
    ("Authorization: Bearer ", "", URL_SAFE, 24, 60, ""),
    ("Authorization: Basic ", "", BASE64, 16, 40, "=="),
    ("", "ghp_", ALNUM, 36, 36, ""),
    ("", "sk_live_", ALNUM, 24, 32, ""),
    ("", "xoxb-", string.digits, 12, 12, ""),
    ("", "AIza", URL_SAFE, 35, 35, ""),
    ("", "AKIA", string.ascii_uppercase + string.digits, 16, 16, ""),
    ("password = ", "", ALNUM, 8, 20, ""),
    ("secret: ", "", BASE64, 20, 44, ""),
)
HARMLESS = (
    "version 10.4.2-rc1", "see https://example.org/docs/Some_Page-42?id=1234&lang=en", "2024-05-17T08:22:41Z",
    "the key is required", "password must have eight letters", "ISBN 978-3-16-148410-0", "HTTPServerFactoryBean42",
    "a token budget of 4096 words", "call +49 30 1234567", "the secret of the village", "key = value", "auth: required",
    "order A-1234567 of 2023", "123e4567-e89b-12d3-a456-426614174000", "access to the private beach", "x_max = 0.125 * y_min",
    "internationalization", "the bearer of good news", "1,234,567.89 EUR", "mail info@example.org",
)


def planted(rng: random.Random) -> tuple[str, int, int]:
    """A line to write into a text, and the start and end of the secret in it (equal for harmless lines)."""
    if rng.random() < 0.3:
        return rng.choice(HARMLESS), 0, 0
    if rng.random() < 0.1:
        secret = ".".join("eyJ" * (k < 2) + "".join(rng.choices(URL_SAFE, k=rng.randint(16, 44))) for k in range(3))
        ahead, behind = rng.choice(("", "Bearer ", "jwt: ")), ""
    else:
        ahead, head, letters, least, most, behind = rng.choice(FORMS)
        secret = head + "".join(rng.choices(letters, k=rng.randint(least, most)))
    return ahead + secret + behind, len(ahead), len(ahead) + len(secret)


def write_into(text: str, rng: random.Random) -> tuple[str, int, int, int]:
    """The text with a line written in ahead of a random space; the place, and the secret's start and end."""
    line, start, end = planted(rng)
    at = text.find(" ", rng.randrange(len(text) + 1))
    at = len(text) if at < 0 else at
    gap = rng.choice((" ", "\n"))
    return f"{text[:at]}{gap}{line}{gap}{text[at:]}", at + 1, at + 1 + start, at + 1 + end


# --- tokens and features ----------------------------------------------------------------------------------

_LETTER = np.zeros(256, np.uint8)
_LETTER[97:123] = 1
_LETTER[65:91] = 2
_LETTER[48:58] = 3
_LETTER[128:] = 4
_TOKEN_CLASS = np.arange(256, dtype=np.uint8)
_TOKEN_CLASS[_LETTER > 0] = 1
_TOKEN_CLASS[words.IS_SPACE] = 0
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_IS_HEX = np.zeros(256, bool)
_IS_HEX[48:58] = _IS_HEX[97:103] = True
_MARK_KIND = np.full(256, 9, np.int64)
for _i, _marks in enumerate((":", "=", "\"'`", ".", ",", "-_", "+/", "#*$%&|<>", "!?;")):
    _MARK_KIND[[ord(c) for c in _marks]] = _i

#: Number of values of each feature template.
TEMPLATES = (2048, 2048, 32, 32, 32, 32, 16, 16, 64)
OFFSETS = np.concatenate([[0], np.cumsum(TEMPLATES)]).astype(np.int64)


def _keyword_hashes() -> np.ndarray:
    raw = " ".join(KEYWORDS).encode()
    block = next(words.blocks([raw]))
    return block.hashes()


@dataclass
class Tokens:
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # per text the number of its first token, and the total
    features: np.ndarray  # token by template, numbered through all templates


def tokens(block: words.Block) -> Tokens:
    data = block.data
    kind = _TOKEN_CLASS[data]
    edge = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    bounds = np.concatenate([[0], edge, [len(data)]])
    bounds_kind = kind[bounds[:-1]]
    some = np.flatnonzero(bounds_kind > 0)
    starts, ends, kind = bounds[:-1][some], bounds[1:][some], bounds_kind[some]
    first = np.append(np.searchsorted(starts, block.text_starts), len(starts))
    n = len(starts)
    if not n:
        return Tokens(starts, ends, first, np.empty((0, len(TEMPLATES)), np.int64))

    letters = _LETTER[data]

    def per_token(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])
        return total[ends] - total[starts]

    size = ends - starts
    small, capital, digit, wide = (per_token(letters == c) for c in (1, 2, 3, 4))
    change = np.append(False, (letters[1:] != letters[:-1]))
    changes = per_token(change) - change[starts]
    word = kind == 1
    hexadecimal = per_token(_IS_HEX[data]) == size
    length = np.searchsorted([2, 4, 6, 8, 12, 16, 20, 28, 32, 40, 64], size, "right")  # 12 steps
    mix_of = (small > 0) * 1 + (capital > 0) * 2 + (digit > 0) * 4 + (wide > 0) * 8
    few = np.minimum(changes, 3)
    shape = np.where(word, 64 + length * 128 + mix_of * 8 + few * 2 + hexadecimal, np.minimum(_MARK_KIND[kind], 9) * 4 + np.minimum(size, 4) - 1)
    shape = np.minimum(shape, TEMPLATES[0] - 1)
    # Coarse kinds for neighbours: marks by kind, words by what they hold.
    coarse = np.where(word, 10 + mix_of, np.minimum(_MARK_KIND[kind], 9))
    keyword = np.zeros(n, np.int64)
    short = np.flatnonzero(word & (size <= 12) & (digit == 0))
    if len(short):
        known = _keyword_hashes()
        order = np.argsort(known)
        hashes = words.span_hashes(_SMALL[data], starts[short], ends[short])
        at = np.minimum(np.searchsorted(known[order], hashes), len(known) - 1)
        keyword[short] = np.where(known[order][at] == hashes, order[at] + 1, 0)

    owner = np.repeat(np.arange(len(block.docs)), np.diff(first))

    def shifted(values: np.ndarray, by: int, missing: int) -> np.ndarray:
        """The value ``by`` tokens on (negative: ahead of) each token of the same text."""
        out = np.full(n, missing, np.int64)
        if abs(by) < n:
            to, of = (slice(-by, None), slice(None, by)) if by < 0 else (slice(None, n - by), slice(by, None))
            out[to] = np.where(owner[to] == owner[of], values[of], missing)
        return out

    glued_left = np.append(False, (starts[1:] == ends[:-1])) & (shifted(owner, -1, -1) >= 0)
    glued_right = np.append(glued_left[1:], False)
    glue = glued_left * 1 + glued_right * 2
    near = np.zeros(n, np.int64)
    for by in (-4, -3, -2, -1):
        ahead = shifted(keyword, by, 0)
        near = np.where(ahead > 0, ahead, near)
    # The file: how much of its words has digits, and how much of it is marks.
    digits = np.bincount(owner, word & (digit > 0), len(block.docs)) / np.maximum(np.bincount(owner, word, len(block.docs)), 1)
    marks = np.bincount(owner, ~word, len(block.docs)) / np.maximum(np.bincount(owner, minlength=len(block.docs)), 1)
    file = np.searchsorted([0.01, 0.05, 0.2], digits, "right") * 4 + np.searchsorted([0.1, 0.2, 0.4], marks, "right")
    strange = (word & (size >= 16) & (digit > 0)) * 1 + (word & (changes >= 4)) * 2
    columns = (
        shape,
        np.where(word, 64 + length * 128 + near * 8 + few * 2 + (digit > 0), 0),
        shifted(coarse, -1, 31),
        shifted(coarse, 1, 31),
        shifted(coarse, -2, 31),
        shifted(coarse, 2, 31),
        near,
        glue * 4 + strange,
        file[owner] * 4 + strange,
    )
    return Tokens(starts, ends, first, np.stack(columns, axis=1) + OFFSETS[:-1][None, :])


# --- the field --------------------------------------------------------------------------------------------


@dataclass
class Field:
    weights: np.ndarray  # feature by label
    transitions: np.ndarray  # label by next label

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 3))
        for column in features.T:
            out += self.weights[column]
        return out

    def decode(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The best labels of several texts; every text starts and ends outside."""
        n = len(features)
        labels = np.zeros(n, np.int64)
        if not n:
            return labels
        scores = self.emissions(features)
        # What a run outside the outside label can gain at most: per token, and once for the way back.
        allowed = self.transitions[self.transitions > -1e8]
        step = max(0.0, float(allowed.max() - self.transitions[OUTSIDE, OUTSIDE]))
        gain = scores[:, 1:].max(axis=1) - scores[:, OUTSIDE] + step
        total = np.concatenate([[0.0], np.cumsum(gain)])
        left = total[1:] - np.minimum.accumulate(total)[:-1]
        right = np.maximum.accumulate(total[::-1])[::-1][1:] - total[:-1]
        open_ = np.flatnonzero(left + right - gain + step >= 0)
        if not len(open_):
            return labels
        owner = np.searchsorted(first, open_, "right") - 1
        cut = np.flatnonzero((np.diff(open_) > 1) | (np.diff(owner) > 0)) + 1
        for run in np.split(open_, cut):
            labels[run] = self._viterbi(scores[run])
        return labels

    def _viterbi(self, scores: np.ndarray) -> list[int]:
        moves = self.transitions.tolist()
        rows = scores.tolist()
        best = [moves[OUTSIDE][k] + rows[0][k] for k in range(3)]
        back = []
        for row in rows[1:]:
            came = [max(range(3), key=lambda j: best[j] + moves[j][k]) for k in range(3)]
            best = [best[came[k]] + moves[came[k]][k] + row[k] for k in range(3)]
            back.append(came)
        at = max(range(3), key=lambda j: best[j] + moves[j][OUTSIDE])
        out = [at]
        for came in reversed(back):
            at = came[at]
            out.append(at)
        return out[::-1]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def fit(features: np.ndarray, labels: np.ndarray) -> Field:
    """Maximum likelihood on padded sequences: ``features`` (sequence, token, template), -1 padding; ``labels``.

    Batch gradients by forward and backward sums, adaptive steps, a small penalty. Without sequences everything is
    outside.
    """
    weights = np.zeros((int(OFFSETS[-1]) + 1, 3))
    moves = np.zeros((3, 3))
    barred = np.zeros((3, 3), bool)
    barred[OUTSIDE, INSIDE] = True
    count, steps = labels.shape if len(labels) else (0, 0)
    if not count:
        weights[OFFSETS[0] : OFFSETS[1], OUTSIDE] = 20.0
        return Field(weights, np.where(barred, -1e9, moves))
    real = features[:, :, 0] >= 0
    index = np.where(features >= 0, features, OFFSETS[-1])
    size = real.sum(axis=1)
    targets = np.eye(3)[labels] * real[:, :, None]
    # Observed transitions, with outside before the first and after the last token.
    padded = np.concatenate([np.zeros((count, 1), np.int64), np.where(real, labels, OUTSIDE), np.zeros((count, 1), np.int64)], axis=1)
    pair_real = np.concatenate([np.ones((count, 1), bool), real], axis=1)
    observed = np.zeros((3, 3))
    np.add.at(observed, (padded[:, :-1][pair_real], padded[:, 1:][pair_real]), 1)
    sum_w, sum_m = np.full(weights.shape, 1e-6), np.full((3, 3), 1e-6)
    scale = 1.0 / count
    for _ in range(ROUNDS):
        t = np.where(barred, -1e9, moves)
        e = weights[index].sum(axis=2)
        ahead = np.empty((steps, count, 3))
        ahead[0] = t[OUTSIDE][None, :] + e[:, 0]
        for i in range(1, steps):
            ahead[i] = np.where(real[:, i, None], _log_sum(ahead[i - 1][:, :, None] + t[None], 1) + e[:, i], ahead[i - 1])
        behind = np.empty((steps, count, 3))
        behind[-1] = t[:, OUTSIDE][None, :]
        for i in range(steps - 2, -1, -1):
            nxt = _log_sum(t[None] + (e[:, i + 1] + behind[i + 1])[:, None, :], 2)
            behind[i] = np.where(real[:, i + 1, None], nxt, behind[i + 1])
        whole = _log_sum(ahead[-1] + t[:, OUTSIDE][None, :], 1)
        share = np.exp(ahead + behind - whole[None, :, None]).transpose(1, 0, 2) * real[:, :, None]
        expected = np.zeros((3, 3))
        expected[OUTSIDE] += share[:, 0].sum(axis=0)
        for i in range(1, steps):
            pair = ahead[i - 1][:, :, None] + t[None] + (e[:, i] + behind[i])[:, None, :] - whole[:, None, None]
            expected += (np.exp(pair) * real[:, i, None, None]).sum(axis=0)
        last = share[np.arange(count), size - 1]
        expected[:, OUTSIDE] += last.sum(axis=0)
        residual = (targets - share) * scale
        gradient = np.zeros_like(weights)
        for k in range(3):
            flat = np.repeat(residual[:, :, k].ravel(), index.shape[2])
            gradient[:, k] = np.bincount(index.ravel(), flat, len(weights))
        gradient -= PENALTY * weights
        gradient[-1] = 0
        sum_w += gradient**2
        weights += RATE * gradient / np.sqrt(sum_w)
        gradient = (observed - expected) * scale - PENALTY * moves
        sum_m += gradient**2
        moves += RATE * gradient / np.sqrt(sum_m)
    return Field(weights, np.where(barred, -1e9, moves))


# --- training and scanning --------------------------------------------------------------------------------


def _char_places(block: words.Block, i: int) -> np.ndarray:
    """Code point number of each byte of a text, and of its end."""
    own = block.data[block.text_starts[i] : block.text_ends[i]]
    return np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])


def _secret_part(text: str, kind: int, start: int, end: int) -> tuple[int, int]:
    """The secret itself in a pattern match: for assignments the value."""
    if kind == 0:
        return PATTERNS[0][1].match(text, start, end).span(2)
    return start, end


def _labels(starts: np.ndarray, ends: np.ndarray, secrets: list[tuple[int, int]]) -> np.ndarray:
    """Labels of the tokens (code point ranges) of a text; of overlapping secrets the first counts."""
    labels = np.zeros(len(starts), np.int64)
    for low, high in secrets:
        inside = np.flatnonzero((starts < high) & (ends > low))
        if len(inside) and labels[inside].max() == 0:
            labels[inside] = INSIDE
            labels[inside[0]] = BEGIN
    return labels


def _variants(doc_id: object, text: str) -> Iterator[tuple[str, list[tuple[int, int]], int, int]]:
    """What a text gives to the training: (text, secrets, place to look at, tokens of the window ahead of it)."""
    rng = random.Random(str(doc_id))
    found = [_secret_part(text, kind, start, end) for start, kind, end in pattern_spans(text)]
    place = found[len(found) // 2][0] if found else rng.randrange(len(text) + 1)
    yield text, found, place, rng.randrange(WINDOW // 4, 3 * WINDOW // 4)
    text, place, start, end = write_into(text, rng)
    found = [_secret_part(text, kind, a, b) for a, kind, b in pattern_spans(text)]
    yield text, [(start, end)] * (end > start) + found, place, rng.randrange(WINDOW // 4, 3 * WINDOW // 4)


def train(base: DataFrame, *, sample: int = SAMPLE) -> Field:
    """Fit on two windows from each of at most ``sample`` texts with, and as many without, a pattern match."""

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            found = [bool(pattern_spans(t or "")) for t in part.column(1).to_pylist()]
            yield batch({"doc_id": part.column(0), "found": pa.array(found, pa.bool_())})

    known = base.filter("doc_id IS NOT NULL")
    flags = known.mapInArrow(flag, schema_with(base, ["doc_id"], "found boolean"))
    flags = materialise(flags.groupBy("doc_id").agg(F.max("found").alias("found")), "secret-flags")
    ordered = flags.withColumn("h", F.xxhash64("doc_id"))
    chosen = None
    for some in (True, False):
        part = ordered.filter(F.col("found") == some).orderBy("h", "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = F.broadcast(chosen.select(F.col("doc_id").alias("_id")))  # at most 2 * sample rows

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            ids, features, label_rows = [], [], []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for changed, secrets, place, ahead in _variants(doc_id, text):
                    block = next(words.blocks([changed.encode()]))
                    found = tokens(block)
                    points = _char_places(block, 0)
                    starts, ends = points[found.starts], points[found.ends]
                    labels = _labels(starts, ends, secrets)
                    low = max(0, int(np.searchsorted(starts, place)) - ahead)
                    cut = labels[low : low + WINDOW]
                    if len(cut) and cut[0] == INSIDE:
                        cut[0] = BEGIN
                    ids.append(doc_id)
                    features.append(found.features[low : low + WINDOW].ravel().tolist())
                    label_rows.append(cut.tolist())
            yield batch(
                {
                    "doc_id": pa.array(ids, part.column(0).type),
                    "features": pa.array(features, pa.list_(pa.int32())),
                    "labels": pa.array(label_rows, pa.list_(pa.int32())),
                }
            )

    rows = known.join(chosen, F.col("doc_id") == F.col("_id")).select("doc_id", "text").dropDuplicates(["doc_id"])
    got = rows.mapInArrow(windows, schema_with(base, ["doc_id"], "features array<int>, labels array<int>")).toArrow()
    got = got.sort_by([("doc_id", "ascending")])
    sequences = [(f, y) for f, y in zip(got.column("features").to_pylist(), got.column("labels").to_pylist()) if y]
    steps = max((len(y) for _, y in sequences), default=0)
    features = np.full((len(sequences), steps, len(TEMPLATES)), -1, np.int64)
    labels = np.zeros((len(sequences), steps), np.int64)
    for k, (f, y) in enumerate(sequences):
        features[k, : len(y)] = np.array(f, np.int64).reshape(len(y), len(TEMPLATES))
        labels[k, : len(y)] = y
    return fit(features, labels)


def scan(docs: DataFrame, model: Field | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_assign, n_access, n_hex, n_crf, base_spans, spans.

    Spans are listed as kind:start:end in code points (end exclusive), by start and then kind (assign, access, hex,
    crf), joined by commas. ``base_spans`` has the pattern matches; ``spans`` has them and the tagged spans that touch
    none of them. NULL counts as ''; equal texts get equal results. Without a model one is trained on ``docs``.
    """
    base = id_and_text(docs, id_col=id_col, text_col=text_col)
    field = train(base) if model is None else model

    def written(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in small(batches):
            texts = part.column(1).to_pylist()
            rows: list[tuple] = []
            for block in words.blocks(utf8(part.column(1))):
                found = tokens(block)
                labels = field.decode(found.features, found.first)
                begins = np.flatnonzero(labels == BEGIN)
                of_text = np.searchsorted(found.first, begins, "right") - 1
                # A span ends before the first token that is not inside.
                stops = np.append(np.flatnonzero(labels != INSIDE), len(labels))
                last = stops[np.searchsorted(stops, begins, "right")] - 1 if len(begins) else begins
                cuts = np.searchsorted(of_text, np.arange(len(block.docs) + 1))
                for i, doc in enumerate(block.docs):
                    fixed = pattern_spans(texts[doc])
                    tagged = []
                    if cuts[i + 1] > cuts[i]:
                        place = _char_places(block, i)
                        for b, e in zip(begins[cuts[i] : cuts[i + 1]], last[cuts[i] : cuts[i + 1]]):
                            start = int(place[found.starts[b] - block.text_starts[i]])
                            end = int(place[found.ends[e] - block.text_starts[i]])
                            if not any(s < end and start < t for s, _, t in fixed):
                                tagged.append((start, 3, end))
                    kinds = [k for _, k, _ in fixed]
                    rows.append(
                        (kinds.count(0), kinds.count(1), kinds.count(2), len(tagged), written(fixed), written(sorted(fixed + tagged)))
                    )
            if rows:
                names = ("n_assign", "n_access", "n_hex", "n_crf", "base_spans", "spans")
                columns = {n: pa.array(c, pa.int64() if k < 4 else pa.string()) for k, (n, c) in enumerate(zip(names, zip(*rows)))}
                yield batch({"doc_id": part.column(0), **columns})

    extra = "n_assign bigint, n_access bigint, n_hex bigint, n_crf bigint, base_spans string, spans string"
    return base.mapInArrow(run, schema_with(base, ["doc_id"], extra))
