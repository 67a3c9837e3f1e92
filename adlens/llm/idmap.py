"""A fixed-size map of wanted ids that thins out rows before a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import saved

#: Bits of the fixed-size map of wanted ids (4 MB); more ids only mean that it lets more rows through.
MAP_BITS = 1 << 25


def marked(rows: DataFrame, id: str, wanted: DataFrame) -> DataFrame:
    """``rows`` whose id's bit is set by an id of ``wanted`` (one column): all
    rows that a join on the id would find and few others, before any shuffle."""
    def bit(c: str) -> Column:
        return F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(MAP_BITS))

    (col,) = wanted.columns
    maps = saved(wanted.select(bit(col).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("_bucket"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_map")), "id_map")
    at = F.bitmap_bit_position("_bit")
    byte = F.conv(F.hex(F.substring(F.col("_map"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.withColumn("_bit", bit(id)).withColumn("_bucket", F.bitmap_bucket_number("_bit")).join(
        F.broadcast(maps), "_bucket")  # at most MAP_BITS / 8 bytes, whatever the input
    return found.where(F.pmod(F.floor(byte / F.pow(F.lit(2.0), F.pmod(at, F.lit(8)))), F.lit(2)) == 1).select(*rows.columns)
