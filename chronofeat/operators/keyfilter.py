"""A Bloom filter of the spine's keys, tested where a source is scanned.

Source rows whose keys no spine row has go before any shuffle.  The filter is
one array of 64-bit words, built with ``bit_or`` (partial on every task),
written once under ``spark.checkpoint.dir`` and read back as a scalar
subquery, so every task tests bits of an array it holds.  It may let a few
other keys through and never drops one of the spine's, so results stay as they
are.  Its size is fixed by the number of keys: above ``MAX_KEYS`` there is
none."""

from __future__ import annotations

from typing import List, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

MAX_KEYS = 4_000_000                       # 64 million bits, 8 MB, at BITS_PER_KEY
BITS_PER_KEY = 16                          # with three places a key, about 1 in 200 other keys passes
#: Types whose equal values have equal hashes (a float has two zeros, a collated string many spellings).
_HASHED_ALIKE = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.DecimalType,
                 T.BinaryType)


def can_filter(df: DataFrame, keys: Sequence[str]) -> bool:
    def alike(t: T.DataType) -> bool:
        return isinstance(t, _HASHED_ALIKE) or t == T.StringType()
    return bool(keys) and all(alike(df.schema[k].dataType) for k in keys)


def _places(keys: Sequence[str], bits: int) -> List[Column]:
    h = F.xxhash64(*[F.col(k) for k in keys])
    last = F.lit(bits - 1).cast("long")
    return [h.bitwiseAND(last), F.shiftrightunsigned(h, 32).bitwiseAND(last), F.xxhash64(h).bitwiseAND(last)]


def _no_nulls(keys: Sequence[str]) -> Column:
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    return ok


class KeyFilter:
    """The filter of ``spine``'s distinct ``keys`` (about ``count`` of them)."""

    def __init__(self, spine: DataFrame, keys: Sequence[str], count: int):
        if count > MAX_KEYS:
            raise ValueError(f"{count} keys are more than a key filter holds ({MAX_KEYS})")
        self.keys = list(keys)
        self.bits = 1 << max(6, (BITS_PER_KEY * max(count, 1) - 1).bit_length())
        place = F.col("p")
        found = spine.where(_no_nulls(keys)).select(F.explode(F.array(*_places(keys, self.bits))).alias("p")).select(
            F.shiftright(place, 6).alias("w"),
            F.expr("shiftleft(1L, cast(p & 63 as int))").alias("bits"))
        spark = spine.sparkSession
        words = found.groupBy("w").agg(F.bit_or("bits").alias("bits")).unionByName(
            spark.range(self.bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("bits")))
        # one row of bits / 64 words: at most 8 MB by the check above
        row = words.groupBy("w").agg(F.bit_or("bits").alias("bits")) \
            .agg(F.sort_array(F.collect_list(F.struct("w", "bits"))).alias("words")) \
            .select(F.transform("words", lambda x: x["bits"]).alias("words"))
        path = scratch_path(spark, "key-filter")
        row.write.parquet(path)
        self.row = spark.read.schema(row.schema).parquet(path)

    def prune(self, source: DataFrame) -> DataFrame:
        """``source`` (with the key columns in the spine's types) without rows of other keys."""
        words = self.row.scalar()
        ok = _no_nulls(self.keys)
        for place in _places(self.keys, self.bits):
            word = F.get(words, F.shiftright(place, 6).cast("int"))
            ok = ok & (F.getbit(word, place.bitwiseAND(F.lit(63).cast("long")).cast("int")) == 1)
        return source.where(ok)


def key_filter(spine: DataFrame, keys: Sequence[str], count: int) -> Optional[KeyFilter]:
    """A filter, or None where keys cannot be filtered or are too many."""
    if count > MAX_KEYS or not can_filter(spine, keys):
        return None
    return KeyFilter(spine, keys, count)
