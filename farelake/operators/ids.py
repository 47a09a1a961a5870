"""Dense row ids in scan order without a global sort.

Rows are written once with their scan position (``monotonically_increasing_id``
is ``(partition index << 33) + position``). Everything that follows - the
rows per split, the running sum that gives each split's first id, and the ids
themselves - reads that written table, so a different split of the source in
another pass, or a re-run of a lost task, cannot change or lose a row.

Scan order is split index, then position. For a single file, Spark orders
its splits by offset (only the shorter last split can move, and it is last
anyway), so ids follow the file's line order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHIFT = 33
POSITION = "_position"
#: A selection's rows numbered from 1 in scan order, where that is known already.
RANK = "_rank"


def with_positions(df: DataFrame) -> DataFrame:
    """Add the scan position; the result is to be written before ids are assigned."""
    return df.withColumn(POSITION, F.monotonically_increasing_id())


def assign_ids(df: DataFrame, start: int = 0, name: str = "id", all_rows: bool = True) -> DataFrame:
    """Replace :data:`POSITION` by ``name`` = start+1 .. start+n in scan order.

    ``df`` reads a written table that carries :data:`POSITION`. With
    ``all_rows`` a row's place within its split is its position; otherwise
    (``df`` is a selection of the rows) the rows of a split are numbered by a
    window, one split per group. The table of split sizes has one row per
    split, so it is broadcast and no row is shuffled for it; the left join
    keeps every row. A selection that carries its :data:`RANK` needs neither.
    """
    if name in df.columns:
        df = df.drop(name)
    if not all_rows and RANK in df.columns:
        keep = [c for c in df.columns if c not in (POSITION, RANK)]
        return df.select((F.lit(start).cast("long") + F.col(RANK)).alias(name), *[F.col(f"`{c}`") for c in keep])
    split = F.shiftright(F.col(POSITION), SHIFT)
    df = df.withColumn("_split", split)
    sizes = df.groupBy("_split").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_split", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    if all_rows:
        place = F.col(POSITION) - F.shiftleft(F.col("_split"), SHIFT) + 1
    else:
        place = F.row_number().over(Window.partitionBy("_split").orderBy(POSITION))
    keep = [c for c in df.columns if c not in (POSITION, "_split")]
    numbered = df.withColumn("_place", place).join(F.broadcast(offsets), "_split", "left")
    return numbered.select((F.lit(start).cast("long") + F.col("_offset") + F.col("_place")).alias(name),
                           *[F.col(f"`{c}`") for c in keep])
