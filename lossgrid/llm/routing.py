"""Deciding map-side which rows have to meet others, so that all others stay where they are."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.session import materialise

#: Bits of a table for each value it marks, so that one in this many other rows is marked by chance.
BITS_PER_VALUE = 32
#: No table has more bits than 2 to this power (32 MB); beyond 2 ** 23 values more rows are marked by chance.
MOST_BITS = 28


@dataclass
class BitTable:
    """Marked 64-bit hashes: a bit for each, in pages of 4 KB; 2 ** ``bits`` bits in all."""

    pages: DataFrame
    bits: int

    def place(self, value: Column) -> Column:
        return value.bitwiseAND((1 << self.bits) - 1) + 1


def membership(values: DataFrame, column: str, purpose: str) -> BitTable:
    """The bit table of the 64-bit hashes in ``column`` of a written table."""
    table = BitTable(values, min(MOST_BITS, max(15, (BITS_PER_VALUE * values.count()).bit_length())))
    at = table.place(F.col(column))
    pages = values.groupBy(F.bitmap_bucket_number(at).alias("_page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits"))
    table.pages = materialise(pages, purpose)
    return table


def with_maybe(rows: DataFrame, column: str, table: BitTable, out: str = "maybe") -> DataFrame:
    """Add ``out``: false for rows whose hash is not among the marked ones, true for all that are (and a few others).

    The table is broadcast; its size has a fixed bound.
    """
    at = table.place(F.col(column))
    bit = F.bitmap_bit_position(at)
    columns = rows.columns
    tested = rows.join(F.broadcast(table.pages), F.bitmap_bucket_number(at) == F.col("_page"), "left")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(bit / 8) + 1).cast("int"), 1)), 16, 10).cast("int")
    marked = F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1
    return tested.select(*[F.col(f"`{c}`") for c in columns], F.coalesce(marked, F.lit(False)).alias(out))
