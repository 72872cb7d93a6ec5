"""Term hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UINT32 = 1 << 32


def string_hash(word: Column) -> Column:
    """The JVM's 32-bit string hash (sum of 31-powers over UTF-16 units), as a bigint."""

    def step(h: Column, char: Column) -> Column:
        point = F.ascii(char).cast("bigint")
        beyond = point - 0x10000
        pair = (F.shiftright(beyond, 10) + 0xD800) * 31 + beyond.bitwiseAND(0x3FF) + 0xDC00
        return F.when(point < 0x10000, h * 31 + point).otherwise(h * 961 + pair) % _UINT32

    unsigned = F.aggregate(F.split(word, ""), F.lit(0).cast("bigint"), step)
    signed = F.shiftright(F.shiftleft(unsigned, 32), 32)
    return F.when(word == "", F.lit(0).cast("bigint")).otherwise(signed)


def term_index(word: Column, num_features: int) -> Column:
    """Feature index of a word: its string hash, non-negative, modulo the width."""
    return F.pmod(string_hash(word), F.lit(num_features).cast("bigint")).cast("int")
