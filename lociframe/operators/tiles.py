"""Windows along a contig, in tiles.

A window over a whole contig is one task however many machines there are. Here rows are dealt by (contig, tile); each tile's
total is small, so what comes before a tile is a window over one row per tile, joined back, and only the rest runs over rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bases of a tile.
TILE = 1 << 20


def tile_of(pos: str | Column, size: int = TILE) -> Column:
    return F.floor((F.col(pos) if isinstance(pos, str) else pos) / size).cast("long")


def running(df: DataFrame, out: str, how: str, value: Column, order: Sequence[str], tile: Column, keys: Sequence[str] = ("chrom",), inclusive: bool = False) -> DataFrame:
    """df with `out`: max, min, sum or last non-null `value` of the rows of a key before each row (or up to it), or "next": the
    value of the row after it. Null where there is none.

    `tile` must not fall along `order`; rows that tie in `order` come in any order.
    """
    keys, order = list(keys), list(order)
    tiled = df.withColumns({"__tile": tile, "__v": value})
    place = F.when(F.col("__v").isNotNull(), F.struct(*order))
    total = {"max": F.max("__v"), "min": F.min("__v"), "sum": F.sum("__v"), "last": F.max_by("__v", place), "next": F.min_by("__v", F.struct(*order))}[how]
    tiles = W.partitionBy(*(keys or [F.lit(0)])).orderBy("__tile")
    earlier, later = tiles.rowsBetween(W.unboundedPreceding, -1), tiles.rowsBetween(1, W.unboundedFollowing)
    rows = W.partitionBy(*keys, "__tile").orderBy(*order)
    upto = rows.rowsBetween(W.unboundedPreceding, 0 if inclusive else -1)
    # one row per key and tile
    t, v = F.col("__t"), F.col("__v")
    carry, local = {
        "max": (F.max(t).over(earlier), F.max(v).over(upto)),
        "min": (F.min(t).over(earlier), F.min(v).over(upto)),
        "sum": (F.sum(t).over(earlier), F.sum(v).over(upto)),
        "last": (F.last(t, ignorenulls=True).over(earlier), F.last(v, ignorenulls=True).over(upto)),
        "next": (F.first(t).over(later), F.lead(v).over(rows)),
    }[how]
    totals = tiled.groupBy(*keys, "__tile").agg(total.alias("__t")).withColumn("__carry", carry).drop("__t")
    joined = tiled.join(totals, [*keys, "__tile"]).withColumn("__local", local)
    c, x = F.col("__carry"), F.col("__local")
    both = {"max": F.greatest(c, x), "min": F.least(c, x), "sum": F.when(c.isNotNull() | x.isNotNull(), F.coalesce(c, F.lit(0)) + F.coalesce(x, F.lit(0))), "last": F.coalesce(x, c), "next": F.coalesce(x, c)}[how]
    return joined.withColumn(out, both).select(*df.columns, out)


def numbered(df: DataFrame, out: str, order: Sequence[str] = ("pos",), keys: Sequence[str] = ("chrom",), size: int = TILE) -> DataFrame:
    """df with `out`: the number of rows of the key before each, by `order`, whose first column is a position."""
    counted = running(df, "__before", "sum", F.lit(1), order, tile_of(order[0], size), keys)
    return counted.withColumn(out, F.coalesce("__before", F.lit(0)).cast("long")).drop("__before")


def near(df: DataFrame, out: str, flagged: Column, reach: int, pos: str = "pos", size: int = TILE) -> DataFrame:
    """df (chrom, pos, ...) with `out`: flagged rows at most `reach` bases away, the row itself included. Flagged rows near a
    tile's edge are also placed in the neighbouring tile."""
    size = max(size, 2 * reach + 1)
    p = F.col(pos)
    own = tile_of(pos, size)
    around = F.array_distinct(F.array(tile_of(p - reach, size), own, tile_of(p + reach, size)))
    placed = df.withColumns({"__own": own, "__flag": F.coalesce(flagged.cast("int"), F.lit(0))}).withColumn("__tile", F.explode(F.when(F.col("__flag") == 1, around).otherwise(F.array("__own"))))
    window = W.partitionBy("chrom", "__tile").orderBy(pos).rangeBetween(-reach, reach)
    return placed.withColumn(out, F.sum("__flag").over(window)).where("__tile = __own").select(*df.columns, out)
