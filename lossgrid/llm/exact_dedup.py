"""Exact deduplication with counting quotient filters.

Every task builds counting quotient filters of the 64-bit fingerprints of its texts, one per shard of the
fingerprint space. A filter keeps, for each fingerprint, a quotient (implied by position: an occupancy bitmap and
a run-end bitmap), a remainder (sorted inside its run) and a count, so nothing of the fingerprint is lost and
filters of one shard merge into the exact multiset. Fingerprints counted more than once go on to byte
verification.

Routing: the repeated fingerprints are marked in a bit table of bounded size that every task tests its rows against.
Rows that are not marked are unique: their texts are not moved. The others (a few of them marked by chance) are grouped
by their full bytes; copies collapse map-side, so each distinct text leaves a task once, however many rows hold it.
Verdicts go back to the rows over narrow columns: those of large groups, fewer than ``HOT_SLOTS`` by counting, are
broadcast, all others meet their rows in a shuffle of hashes and ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.arrow import id_and_text
from lossgrid.llm.routing import BitTable, membership, with_maybe
from lossgrid.session import materialise

HOT_SLOTS = 1 << 18
#: Groups up to this size always meet their verdict in a shuffle.
HOT_ROWS = 32
FLUSH_ROWS = 1 << 21
#: Fingerprints of a shard, on average; one task merges a shard.
SHARD_ROWS = 1 << 20


# --- the filter -------------------------------------------------------------------------------------------


def encode_filter(keys: np.ndarray, counts: np.ndarray, key_bits: int) -> dict[str, object]:
    """Counting quotient filter of sorted distinct keys below 2 ** key_bits.

    ``occupied`` has a bit per quotient, ``runends`` a bit per slot, ``remainders`` fixed-width little-endian
    bytes in slot order; slots counted once are implied, the others are listed in ``slots`` and ``counts``.
    """
    q_bits = min(key_bits, max(1, int(len(keys)).bit_length()))
    r_bits = key_bits - q_bits
    quotients = (keys >> np.uint64(r_bits)).astype(np.int64) if r_bits < 64 else np.zeros(len(keys), np.int64)
    remainders = keys & np.uint64((1 << r_bits) - 1)
    occupied = np.zeros(1 << q_bits, bool)
    occupied[quotients] = True
    runends = np.append(quotients[1:] != quotients[:-1], True)[: len(keys)]
    width = (r_bits + 7) // 8
    packed = np.ascontiguousarray(remainders.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
    many = np.flatnonzero(counts > 1)
    return {
        "n": len(keys),
        "q_bits": q_bits,
        "occupied": np.packbits(occupied).tobytes(),
        "runends": np.packbits(runends).tobytes(),
        "remainders": packed.tobytes(),
        "slots": many.astype("<u4").tobytes(),
        "counts": counts[many].astype("<u8").tobytes(),
    }


def decode_filter(row, key_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their counts."""
    n, q_bits = int(row["n"]), int(row["q_bits"])
    r_bits = key_bits - q_bits
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(row["occupied"], np.uint8))[: 1 << q_bits])
    runends = np.unpackbits(np.frombuffer(row["runends"], np.uint8))[:n]
    run = np.cumsum(runends) - runends  # the number of the run a slot is in
    width = (r_bits + 7) // 8
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = np.frombuffer(row["remainders"], np.uint8).reshape(n, width)
    remainders = wide.reshape(-1).view("<u8").astype(np.uint64)
    keys = (occupied[run].astype(np.uint64) << np.uint64(r_bits)) | remainders
    counts = np.ones(n, np.int64)
    counts[np.frombuffer(row["slots"], "<u4")] = np.frombuffer(row["counts"], "<u8").astype(np.int64)
    return keys, counts


def merge_filters(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Lossless union of filters of one shard: equal quotient and remainder add their counts."""
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")  # merges the sorted runs
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[heads], np.add.reduceat(counts, heads)


FILTER_SCHEMA = (
    "shard int, n int, q_bits int, occupied binary, runends binary, remainders binary, slots binary, counts binary"
)


def repeated_fingerprints(fingerprints: DataFrame, column: str, shard_bits: int | None = None) -> DataFrame:
    """(column, n) of every 64-bit value that occurs more than once; no cap, no loss.

    ``shard_bits`` cuts the fingerprint space into 2 ** shard_bits shards, each merged by one task; by default so
    many that a shard has about ``SHARD_ROWS`` rows, and at least as many as there are shuffle partitions.
    """
    if shard_bits is None:
        partitions = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        shard_bits = max(1, (max(1, partitions, -(-fingerprints.count() // SHARD_ROWS)) - 1).bit_length())
    key_bits = 64 - shard_bits

    def rows(values: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.unique(np.concatenate(values), return_counts=True)
        shards = (keys >> np.uint64(key_bits)).astype(np.int64)
        cuts = np.append(np.flatnonzero(np.append(True, shards[1:] != shards[:-1])), len(keys))
        low = np.uint64((1 << key_bits) - 1)
        found = [
            {"shard": int(shards[a]), **encode_filter(keys[a:b] & low, counts[a:b], key_bits)}
            for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        yield pa.RecordBatch.from_pylist(found, schema=arrow_schema)

    kinds = {"int": pa.int32(), "binary": pa.binary()}
    arrow_schema = pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in FILTER_SCHEMA.split(", "))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for part in batches:
            if part.num_rows:
                held.append(part.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            if sum(map(len, held)) >= FLUSH_ROWS:
                yield from rows(held)
                held = []
        if held:
            yield from rows(held)

    def merge(key: tuple, filters: pd.DataFrame) -> pd.DataFrame:
        keys, counts = merge_filters([decode_filter(row, key_bits) for row in filters.to_dict("records")])
        twice = counts > 1
        whole = keys[twice] | (np.uint64(int(key[0])) << np.uint64(key_bits))
        return pd.DataFrame({column: whole.view(np.int64), "n": counts[twice].astype(np.int64)})

    built = fingerprints.select(column).mapInArrow(build, FILTER_SCHEMA)
    return built.groupBy("shard").applyInPandas(merge, f"{column} bigint, n bigint")


# --- deduplication ----------------------------------------------------------------------------------------


def _repeat_table(texts: DataFrame) -> BitTable:
    """The bit table of the fingerprints that occur more than once."""
    keyed = texts.select(F.xxhash64("text").alias("fp"))
    repeated = materialise(repeated_fingerprints(keyed, "fp"), "repeated-fingerprints")
    return membership(repeated, "fp", "repeated-bits")


def duplicate_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when all bytes are; NULL counts as ''. ``keep_id`` is the largest id among equal texts (NULL
    ids lose; a group of NULL ids only keeps NULL). Rows that repeat an id and its text are the same document:
    each counts in ``group_size`` and all get the same verdict. An empty table gives no rows.
    """
    base = id_and_text(docs, id_col=id_col, text_col=text_col)
    marked = with_maybe(base.withColumn("fp", F.xxhash64("text")), "fp", _repeat_table(base))
    classes = marked.filter("maybe").groupBy("fp", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    classes = classes.select(F.col("fp").alias("_fp"), F.unhex(F.sha2("text", 256)).alias("_sha"), "keep_id", "group_size")
    classes = materialise(classes, "exact-classes")
    narrow = marked.select("doc_id", "fp", F.unhex(F.sha2("text", 256)).alias("sha"), "maybe")
    narrow = materialise(narrow, "exact-rows")

    # Fewer than HOT_SLOTS groups can have more than this share of the rows.
    share = max(HOT_ROWS, narrow.count() // HOT_SLOTS)
    same = (F.col("fp") == F.col("_fp")) & (F.col("sha") == F.col("_sha"))
    hot = F.broadcast(classes.filter(F.col("group_size") > share))
    many = narrow.filter("maybe")
    columns = ["doc_id", "keep_id", "group_size", "sha"]
    of_hot = many.join(hot, same).select(columns)
    of_rest = many.join(hot, same, "left_anti").join(classes.filter(F.col("group_size") <= share), same).select(columns)
    alone = narrow.filter("NOT maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), "sha")
    return alone.unionByName(of_hot).unionByName(of_rest).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: of each distinct text the row with the largest id.

    NULL counts as '', NULL ids lose, and of rows alike in id and text one stays, whichever Spark meets first. Unique
    rows stay in place; the others are reduced to one per distinct text in their task before they move, once, so a
    text held by a third of all rows is one row per task. Rows are not told apart by id: rows that share one, or
    have none, do not touch each other unless their texts are equal. An empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    columns = [c for c in docs.columns if c != text_col]
    order = F.struct(F.col(f"`{id_col}`").isNotNull().alias("has"), F.col(f"`{id_col}`").alias("id"))
    row = F.struct(F.col(f"`{text_col}`").isNull().alias("_no_text"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    rows = docs.select(F.xxhash64(text).alias("fp"), text.alias("text"), order.alias("order"), row.alias("row"))
    marked = with_maybe(rows, "fp", _repeat_table(docs.select(text.alias("text"))))
    best = marked.filter("maybe").groupBy("fp", "text").agg(F.max_by("row", "order").alias("row"))
    left = marked.filter("NOT maybe").select("text", "row").unionByName(best.select("text", "row"))
    place = {c: i for i, c in enumerate(columns)}
    whole = F.when(~F.col("row._no_text"), F.col("text").cast(docs.schema[text_col].dataType)).alias(text_col)
    return left.select(*[whole if c == text_col else F.col(f"row.c{place[c]}").alias(c) for c in docs.columns])
