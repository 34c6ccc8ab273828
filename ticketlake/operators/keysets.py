"""Semi joins that cut the messages table to the issues a command needs.

One plan at every size: a semi join on the key. Nothing is counted while the
plan is built. Rows go through a bitmap of the ids' hashes first, whose size is
fixed, so it is broadcast however many ids there are: most rows that the semi
join would drop are not shuffled for it. What is left is joined by shuffle, skewed
keys split, and never by a broadcast of the ids: these are read from records,
which Spark takes for so large that any id set looks tiny beside them, and a set
that looks tiny passes through the driver whole. Callers cut message rows and
columns first (partial aggregates, thread truncation), so what is shuffled is
bounded by what the command keeps of each issue.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap (64 to a row).
BITS = 1 << 24
#: Hint for the side of a join that grows with the input but may look small.
BY_SHUFFLE = "merge"


def restrict_to(df: DataFrame, ids: DataFrame, key: str = "issue_id") -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``ids``."""
    ids = ids.select(key)
    if df.schema[key].dataType != ids.schema[key].dataType:             # other types have other hashes
        return df.join(ids.hint(BY_SHUFFLE), key, "left_semi")
    place = F.pmod(F.xxhash64(key), F.lit(BITS))
    bit, word = (place % 64).cast("int"), F.floor(place / 64).cast("long")
    words = (ids.where(F.col(key).isNotNull()).groupBy(word.alias("_word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("_bits")))
    maybe = df.join(F.broadcast(words), word == F.col("_word")).where(F.getbit("_bits", bit) == 1)
    # the word belongs to the condition, so that the semi join stays behind the bitmap
    return maybe.join(ids.withColumn("_word", word).hint(BY_SHUFFLE), [key, "_word"], "left_semi").select(*df.columns)
