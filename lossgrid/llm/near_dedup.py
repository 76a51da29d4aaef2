"""Near-duplicate documents by b-bit MinHash over word shingles.

Every document is read once into a sketch: the size and a 128-bit fingerprint of its shingle set, band keys from its
full minima, and a signature that keeps only the low ``BITS`` bits of each minimum, packed into longs. Documents with
equal sets collapse into one class. Classes that share a band key are candidates; the share of equal low bits,
corrected for chance agreement, estimates their similarity, and pairs that pass a cut far below the threshold are
confirmed on their full shingle sets.

Large groups. Within a bucket of n classes only the n - 1 pairs with its smallest member are tried first. Once the
confirmed links are joined into components, pairs inside a component need no look any more. Buckets that still span
several components are laid out in blocks, and tasks compare the members outside the largest component with the others,
block by block, in memory: by bit counts first, then, where these pass, on the full sets, and only if no link found
before connects them. What comes out are members, and links that join components, never pairs. So every pair that
shares a bucket is confirmed, refuted, or known to be connected, and nothing is capped.

The number of bands follows from the threshold: a pair at the threshold misses all bands with a probability below
``MISS``, and so does the estimate cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossgrid.llm import words
from lossgrid.llm.arrow import batch, id_and_text, lists, small, utf8
from lossgrid.llm.components import connected_components
from lossgrid.llm.routing import membership, with_maybe
from lossgrid.session import materialise

SHINGLE = 5
BITS = 2
BAND_ROWS = 5
MISS = 1e-8
_ALL = (1 << 64) - 1


def band_count(threshold: float, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    """Bands such that a pair at the threshold shares none with a probability of at most ``miss``."""
    if threshold >= 1:
        return 1
    return max(1, math.ceil(math.log(miss) / math.log1p(-(threshold**rows))))


def estimate_cut(threshold: float, hashes: int, bits: int = BITS, miss: float = MISS) -> int:
    """Equal lanes below which a pair at the threshold falls with a probability of at most ``miss``."""
    chance = 2.0**-bits
    p = chance + (1 - chance) * threshold
    below, k = 0.0, 0
    while k <= hashes:
        term = math.exp(
            math.lgamma(hashes + 1) - math.lgamma(k + 1) - math.lgamma(hashes - k + 1)
            + k * math.log(p) + (hashes - k) * math.log1p(-p)
        ) if p < 1 else float(k == hashes)
        if below + term > miss:
            return k
        below += term
        k += 1
    return hashes


def estimated_similarity(equal: Column, hashes: int, bits: int = BITS) -> Column:
    """Similarity from the number of equal lanes, less what lanes agree by chance."""
    chance = 2.0**-bits
    return F.greatest((equal / F.lit(float(hashes)) - F.lit(chance)) / F.lit(1.0 - chance), F.lit(0.0))


def equal_lanes(a: str, b: str, hashes: int) -> Column:
    """Number of equal 2-bit lanes of two packed signatures, by bit counts."""
    even = 0x5555555555555555
    terms = []
    for i in range((hashes * BITS + 63) // 64):
        x = f"({a}[{i}] ^ {b}[{i}])"
        terms.append(f"bit_count(({x} | shiftrightunsigned({x}, 1)) & {even}L)")
    return F.lit(hashes) - F.expr(" + ".join(terms))


def shingle_set(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes of the words of one text; a shorter text is one shingle, none has none."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    return np.unique(words.ngram_hashes(hashes, min(size, len(hashes))))


class Signer:
    def __init__(self, bands: int, rows: int) -> None:
        self.bands, self.rows = bands, rows
        self.hashes = bands * rows
        fixed = words.seeds(2 * self.hashes, 7)
        self.a = ((fixed[: self.hashes] >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]
        self.b = ((fixed[self.hashes :] >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]
        self.powers = words.seeds(self.hashes, 9).reshape(bands, rows) | np.uint64(1)
        self.band_salt = words.seeds(bands, 11)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        low = shingles.astype(np.uint32)
        out = np.full(self.hashes, np.uint32(0xFFFFFFFF))
        for at in range(0, len(low), 512):
            y = self.a * low[at : at + 512]
            y ^= y >> np.uint32(15)
            y *= self.b
            np.minimum(out, y.min(axis=1), out=out)
        return out

    def band_keys(self, minima: np.ndarray) -> np.ndarray:
        wide = minima.astype(np.uint64).reshape(self.bands, self.rows)
        return words.mix((words.mix(wide + self.powers) * self.powers).sum(axis=1, dtype=np.uint64) + self.band_salt)

    def packed(self, minima: np.ndarray) -> np.ndarray:
        lanes = (minima & np.uint32((1 << BITS) - 1)).astype(np.uint64)
        per = 64 // BITS
        padded = np.zeros((len(lanes) + per - 1) // per * per, np.uint64)
        padded[: len(lanes)] = lanes
        return (padded.reshape(-1, per) << (np.arange(per, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def sketch(base: DataFrame, bands: int, rows: int, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, set_a, set_b (fingerprint of the set), signature, bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(bands, rows)
        for part in small(batches):
            texts = [t.lower() for t in utf8(part.column(1))]
            counts, set_a, set_b, signatures, keys = [], [], [], [], []
            for block in words.blocks(texts):
                hashes = block.hashes()
                for a, b in zip(block.first[:-1], block.first[1:]):
                    shingles = shingle_set(hashes[a:b], size)
                    counts.append(len(shingles))
                    set_a.append(words.mix(shingles ^ np.uint64(0x1234567)).sum(dtype=np.uint64))
                    set_b.append(words.mix(shingles + np.uint64(0x89ABCDEF)).sum(dtype=np.uint64))
                    minima = signer.minima(shingles)
                    signatures.append(signer.packed(minima))
                    keys.append(signer.band_keys(minima) if len(shingles) else np.empty(0, np.uint64))
            if not texts:
                continue
            sizes = np.cumsum([0, *map(len, keys)])
            wide = np.concatenate(signatures)
            yield batch(
                {
                    "doc_id": part.column(0),
                    "n_shingles": pa.array(counts, pa.int64()),
                    "set_a": pa.array(np.array(set_a, np.uint64).view(np.int64)),
                    "set_b": pa.array(np.array(set_b, np.uint64).view(np.int64)),
                    "signature": lists(wide.view(np.int64), np.arange(len(texts) + 1) * (len(wide) // len(texts))),
                    "bands": lists(np.concatenate(keys).view(np.int64), sizes),
                }
            )

    schema = "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, signature array<bigint>, bands array<bigint>"
    return base.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, schema)


def confirm(pairs: DataFrame, texts: DataFrame, threshold_pct: int, size: int = SHINGLE) -> DataFrame:
    """The (a, b) pairs whose shingle sets have 100 * intersection >= threshold_pct * union, with both numbers.

    ``pairs`` is a written table of ids. Only texts of documents in some pair travel; Spark broadcasts the list of
    their ids where it is small.
    """
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    wanted = materialise(wanted, "near-wanted")
    there = texts.join(wanted, texts["doc_id"] == wanted["id"]).select("id", "text")
    there = materialise(there, "near-texts")  # the few texts that are compared, read by both joins below
    one = there.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = there.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shingles(text: bytes) -> np.ndarray:
            return next(shingle_set(b.hashes(), size) for b in words.blocks([text.lower()], len(text) + 1))

        last: dict[int, np.ndarray] = {}  # the smallest member of a group comes up again and again
        for part in small(batches, 3):
            rows = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), utf8(part.column(2)), utf8(part.column(3)))
            found = []
            for a, b, text_a, text_b in rows:
                if a not in last:
                    last = {a: shingles(text_a)}
                x, y = last[a], shingles(text_b)
                common = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - common
                if union and 100 * common >= threshold_pct * union:
                    found.append((a, b, common, union))
            columns = list(zip(*found)) or [(), (), (), ()]
            yield batch({n: pa.array(c, pa.int64()) for n, c in zip(("a", "b", "common", "total"), columns)})

    return both.mapInArrow(run, "a bigint, b bigint, common bigint, total bigint")


#: Members of a bucket that meet in one task.
BLOCK = 2048
_EVEN = np.uint64(0x5555555555555555)


def _blocks_of(rest: DataFrame) -> DataFrame:
    """Rows of open buckets, once for each pair of blocks they take part in: mode, i and j name it.

    In mode 0 a block i of members outside the main component meets a block j of the main one, in mode 1 blocks i <= j
    of outside members meet. With few outside members that is one row per member.
    """
    out = F.col("part") != F.col("main")
    sizes = rest.groupBy(F.col("key").alias("_key")).agg(F.count_if(out).alias("_out"), F.count_if(~out).alias("_in"))
    sizes = sizes.select("_key", F.ceil(F.col("_out") / BLOCK).cast("int").alias("_out"), F.ceil(F.col("_in") / BLOCK).cast("int").alias("_in"))
    rows = rest.join(sizes, F.col("key") == F.col("_key")).withColumn("outside", out)
    rows = rows.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.greatest(F.when(out, F.col("_out")).otherwise(F.col("_in")), F.lit(1))).cast("int"))
    meet = F.expr(
        "CASE WHEN outside THEN concat("
        " transform(sequence(0, greatest(_in, 1) - 1), j -> named_struct('mode', 0, 'i', own, 'j', j)),"
        " transform(sequence(0, _out - 1), j -> named_struct('mode', 1, 'i', least(own, j), 'j', greatest(own, j))))"
        " ELSE transform(sequence(0, _out - 1), i -> named_struct('mode', 0, 'i', i, 'j', own)) END"
    )
    return rows.withColumn("meet", F.explode(meet)).select("key", "meet.mode", "meet.i", "meet.j", "doc_id", "part", "outside", "own", "signature", "bands")


def _candidates(rows: pd.DataFrame, hashes: int, cut: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place of a member, places of its candidates) in one pair of blocks.

    Candidates belong to another component, have at least ``cut`` equal lanes, and share no earlier band (there the
    pair is looked at in that bucket).
    """
    signature = np.stack(rows["signature"].to_list()).astype(np.int64).view(np.uint64)
    bands = np.stack(rows["bands"].to_list()).astype(np.int64)
    part, outside, own = rows["part"].to_numpy(), rows["outside"].to_numpy(bool), rows["own"].to_numpy()
    key, mode, i, j = (rows[c].iloc[0] for c in ("key", "mode", "i", "j"))
    band = int(np.flatnonzero(bands[0] == key)[0])
    if mode == 0:
        left, right = np.flatnonzero(outside), np.flatnonzero(~outside)
    else:
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    for q in left.tolist():
        others = right[right > q] if mode == 1 and i == j else right
        others = others[part[others] != part[q]]
        x = signature[others] ^ signature[q]
        unequal = np.bitwise_count((x | (x >> np.uint64(1))) & _EVEN).sum(axis=1, dtype=np.int64)
        others = others[hashes - unequal >= cut]
        if len(others):
            others = others[(bands[others] == bands[q]).argmax(axis=1) == band]
        if len(others):
            yield q, others


def settle_open(rest: DataFrame, texts: DataFrame, threshold_pct: int, size: int, hashes: int, cut: int) -> DataFrame:
    """Links (a, b) that connect components of the open buckets' members; every candidate pair is decided."""
    group = ["key", "mode", "i", "j"]
    shape = "key bigint, mode int, i int, j int, doc_id bigint, part bigint, outside boolean, own int, signature array<bigint>, bands array<bigint>"

    def involved(rows: pd.DataFrame) -> pd.DataFrame:
        seen = np.zeros(len(rows), bool)
        for q, others in _candidates(rows, hashes, cut):
            seen[q] = True
            seen[others] = True
        return rows[seen]

    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("doc_id").reset_index(drop=True)
        raw = [t.encode("utf-8", "surrogatepass").lower() for t in rows["text"]]
        sets = [shingle_set(h[a:b], size) for block in words.blocks(raw) for h in [block.hashes()] for a, b in zip(block.first[:-1], block.first[1:])]
        sizes = np.array([len(x) for x in sets])
        parent = {p: p for p in rows["part"]}
        part, ids = rows["part"].tolist(), rows["doc_id"].tolist()

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        links = []
        for q, others in _candidates(rows, hashes, cut):
            mine = root(part[q])
            others = np.array([o for o in others.tolist() if root(part[o]) != mine], np.int64)
            low = np.minimum(sizes[others], sizes[q])
            others = others[100 * low >= threshold_pct * np.maximum(sizes[others], sizes[q])]
            if not len(others):
                continue
            flat = np.concatenate([sets[o] for o in others])
            place = np.searchsorted(sets[q], flat)
            place[place == sizes[q]] = 0
            common = np.add.reduceat(sets[q][place] == flat, np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
            linked = others[100 * common >= threshold_pct * (sizes[others] + sizes[q] - common)]
            for o in linked.tolist():
                p, r = sorted((root(part[q]), root(part[o])))
                if p != r:
                    parent[r] = p
                    links.append((min(ids[q], ids[o]), max(ids[q], ids[o])))
        return pd.DataFrame(links, columns=["a", "b"]).astype("int64")

    # One task per pair of blocks, on signatures alone; only members with a candidate go on to their texts.
    few = _blocks_of(rest).groupBy(*group).applyInPandas(involved, shape)
    few = materialise(few, "near-involved")
    wanted = materialise(few.select(F.col("doc_id").alias("_id")).distinct(), "near-wanted")
    there = texts.join(wanted, texts["doc_id"] == wanted["_id"]).select("_id", "text")
    full = few.join(there, F.col("doc_id") == F.col("_id")).drop("_id")
    return full.groupBy(*group).applyInPandas(decide, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    *,
    threshold_pct: int = 80,
    size: int = SHINGLE,
    rows: int = BAND_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row: doc_id, n_shingles, component_id, kept.

    A-Z are lower-cased, words are runs of non-space bytes, and a document's set has its distinct ``size``-word
    shingles (the whole sequence if it is shorter). Two documents are linked when their sets have a Jaccard
    similarity of at least ``threshold_pct`` percent; ``component_id`` is the smallest id reachable over links and
    ``kept`` marks that document. NULL, empty and blank texts are linked with nothing and kept. Ids are whole
    numbers; rows that repeat an id are one document and get one verdict (rows with a NULL id are kept and linked
    with nothing).
    """
    threshold = threshold_pct / 100.0
    bands = band_count(threshold, rows)
    hashes = bands * rows
    cut = estimate_cut(threshold, hashes)
    base = id_and_text(docs, id_col=id_col, text_col=text_col)
    sketches = materialise(sketch(base, bands, rows, size), "near-sketch")

    # One class per distinct shingle set, named by its smallest id.
    filled = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    key = ["set_a", "set_b", "n_shingles"]
    sets = filled.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    shared = materialise(sets.filter("n > 1").drop("n"), "near-classes")
    member = shared.select(*[F.col(k).alias(f"_{k}") for k in key], "rep")
    same_set = [F.col(k) == F.col(f"_{k}") for k in key]
    classed = filled.join(member, same_set, "left").drop(*[f"_{k}" for k in key])
    reps = classed.filter("rep IS NULL OR rep = doc_id").select("doc_id", "signature", "bands").dropDuplicates(["doc_id"])
    reps = materialise(reps, "near-reps")

    # Buckets of two and more classes.
    placed = reps.select("doc_id", F.explode("bands").alias("key"))
    buckets = placed.groupBy(F.col("key").alias("_key")).agg(F.min("doc_id").alias("centre"), F.count(F.lit(1)).alias("n"))
    buckets = placed.join(buckets.filter("n > 1"), F.col("key") == F.col("_key")).select("key", "doc_id", "centre", "n")
    buckets = materialise(buckets, "near-buckets")

    signature = reps.select(F.col("doc_id").alias("_id"), "signature")

    def signed(pairs: DataFrame, column: str, out: str) -> DataFrame:
        return pairs.join(signature, F.col(column) == F.col("_id")).withColumnRenamed("signature", out).drop("_id")

    lanes = equal_lanes("sa", "sb", hashes)
    tried = buckets.filter("doc_id <> centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b")).distinct()
    tried = signed(signed(tried, "a", "sa"), "b", "sb").filter(lanes >= cut).select("a", "b")
    tried = materialise(tried, "near-tried")
    links = materialise(confirm(tried, base.select(F.col("doc_id").cast("bigint"), "text"), threshold_pct, size), "near-links")
    found = materialise(connected_components(links.select("a", "b"), "near-parts"), "near-found")

    # Buckets that still span several components: members outside the largest one against all others.
    label = found.select(F.col("node").alias("_n"), "component")
    many = buckets.filter("n > 2").join(label, F.col("doc_id") == F.col("_n"), "left")
    many = many.select("key", "doc_id", F.coalesce("component", "doc_id").alias("part"))
    of_part = many.groupBy("key", "part").agg(F.count(F.lit(1)).alias("size"))
    open_keys = (
        of_part.groupBy(F.col("key").alias("_key"))
        .agg(F.max_by("part", F.struct("size", "part")).alias("main"), F.count(F.lit(1)).alias("parts"))
        .filter("parts > 1")
    )
    rest = many.join(open_keys, F.col("key") == F.col("_key")).select("key", "doc_id", "part", "main")
    rest = rest.join(reps.select(F.col("doc_id").alias("_id"), "signature", "bands"), F.col("doc_id") == F.col("_id")).drop("_id")
    rest = materialise(rest, "near-open")
    more = settle_open(rest, base.select(F.col("doc_id").cast("bigint"), "text"), threshold_pct, size, hashes, cut)
    # Components so far are edges of a forest of stars; the late links join some of them.
    stars = found.select(F.col("node").alias("a"), F.col("component").alias("b")).filter("a <> b")
    final = connected_components(stars.unionByName(more.select("a", "b")), "near-parts")
    final = materialise(final, "near-components").select(F.col("node").alias("_n"), "component")

    everyone = sketches.select("doc_id", *key).join(member, same_set, "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    named = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep"))
    return everyone.join(final, F.col("rep") == F.col("_n"), "left").select(
        "doc_id", "n_shingles", named.alias("component_id"), named.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def _with_key(docs: DataFrame) -> DataFrame:
    """``docs`` as (row, key): the key is the id where ids are whole numbers, never NULL and never repeated, else a number
    written with a copy of the rows, as numbers given by a scan can change when it is read again."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # no name can clash
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        ids = docs.select(F.col("doc_id").cast("bigint").alias("id"))
        if ids.groupBy("id").count().filter("count > 1 OR id IS NULL").isEmpty():
            return docs.select(row, F.col("doc_id").cast("bigint").alias("key"))
    return materialise(docs.select(row, F.monotonically_increasing_id().alias("key")), "near-rows")


def drop_near_duplicates(docs: DataFrame, *, threshold_pct: int = 80) -> DataFrame:
    """The rows that stay, with all their columns: of each group the one with the smallest id, NULL last.

    Rows are decided one by one: NULL and repeated ids do not matter. NULL, empty and blank texts are near nothing and
    stay; an empty table gives no rows. Only rows that may have to go move; all others stay in place.
    """
    rows = _with_key(docs)
    keyed = rows.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text"))
    found = near_duplicates(keyed, threshold_pct=threshold_pct).select(F.col("doc_id").alias("_key"), "component_id")
    found = materialise(found, "near-groups")
    groups = found.groupBy(F.col("component_id").alias("_group")).count().filter("count > 1").drop("count")
    found = found.join(groups, F.col("component_id") == F.col("_group")).drop("_group")
    members = rows.select(F.col("row.doc_id").alias("id"), "key").join(found, F.col("key") == F.col("_key")).drop("_key")
    members = materialise(members.withColumn("rank", F.struct(F.col("id").isNull().alias("none"), "id", "key")), "near-members")
    first = members.groupBy(F.col("component_id").alias("_group")).agg(F.min("rank").alias("first"))
    gone = members.join(first, F.col("component_id") == F.col("_group")).filter("key <> first.key")
    gone = materialise(gone.select(F.col("key").alias("_gone")), "near-gone")
    hashed = membership(gone.select(F.xxhash64("_gone").alias("h")), "h", "near-gone-bits")
    tested = with_maybe(rows.withColumn("h", F.xxhash64("key")), "h", hashed)
    left = tested.filter("maybe").join(gone, F.col("key") == F.col("_gone"), "left_anti")
    return tested.filter("NOT maybe").unionByName(left).select(*[F.col(f"row.`{c}`") for c in docs.columns])
