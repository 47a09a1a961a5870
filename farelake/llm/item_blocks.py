"""A query or test set in blocks of bounded size, handed to the tasks as broadcast values."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_or_empty, written

#: Bytes of text in a block, about; an item is never split.
BLOCK_BYTES = 16 << 20


def item_blocks(items: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple[object, str]]]:
    """The (id, text) rows block by block; the driver holds one block at a time. Rows without an id are left out."""
    rows = written(items.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), text_or_empty(text_column).alias("text")), "items")
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    block = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(blocks))
    for b in range(blocks):
        yield [(r["id"], r["text"]) for r in rows.where(block == b).orderBy("id", "text").collect()]
