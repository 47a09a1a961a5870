"""Full and incremental loads into lake tables."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake import schema as S
from farelake.operators.changes import at_places, new_places, new_rows
from farelake.operators.ids import RANK
from farelake.sources.working import working

log = logging.getLogger(__name__)

INGESTION_LOG = "ingestion_log"
INGESTION_LOG_SCHEMA = ("file_name string, status string, rows_expected long, rows_loaded long, "
                        "error_message string, started_at timestamp, completed_at timestamp")
TRANSFER_LOG = "transfer_log"
TRANSFER_LOG_SCHEMA = ("source_table string, target_table string, status string, "
                       "rows_transferred long, error_message string, transferred_at timestamp")


@dataclass
class LoadResult:
    ok: bool
    rows_expected: int = 0
    rows_loaded: int = 0
    rows_skipped: int = 0
    rows_in_target: int = 0
    error: str | None = None


def resolve_mode(mode: str) -> str:
    """Unknown modes fall back to a full load with a warning."""
    if mode not in (S.FULL, S.INCREMENTAL):
        log.warning("Unknown load mode %r: loading in full", mode)
        return S.FULL
    return mode


def max_id(lake, table: str) -> int:
    if not lake.exists(table):
        return 0
    v = lake.read(table).agg(F.max("id")).first()[0]
    return int(v or 0)


def load(df: DataFrame, lake, table: str, mode: str = S.FULL,
         stamps: tuple[str, ...] = (), partition_by: tuple[str, ...] = (),
         batch_rows: int | None = None, number=None, gather: bool = True, place: str | None = None) -> LoadResult:
    """Write ``df`` (which carries ``row_hash``) into ``table``.

    full: a new version replaces the table; when it does not hold every row
    of the batch it is not committed and the load raises. incremental: rows
    whose hash the table already holds are skipped and the rest appended;
    nothing is ever updated or removed (insert-only). ``batch_rows`` is the
    batch size when the caller already knows it; otherwise it is counted,
    which for a Parquet source reads footers only. The rows loaded (A15) are
    observed by the write itself. Loads into one table are expected to run one
    at a time.

    ``number(rows, start, all_rows)`` gives the rows their ids, after known
    rows are taken out. ``partition_by`` lays the table out by those columns,
    and an incremental load reads only the target partitions that the batch
    touches; ``gather=False`` skips the shuffle that collects each layout
    value's rows, for input that is laid out so already, as long as its rows
    stay where they are.

    ``place`` names a long column that differs from row to row, by which an
    incremental load finds the new rows without a shuffle of the batch; they
    reach ``number`` with their rank in its order.
    """
    mode = resolve_mode(mode)
    total = df.count() if batch_rows is None else batch_rows
    number = number or (lambda rows, start, all_rows: rows)
    if mode == S.INCREMENTAL and lake.exists(table):
        if "row_hash" not in df.columns:
            raise ValueError("an incremental load needs a row_hash column")
        target = lake.read(table)
        before = target.count()   # Parquet footers
        prune_by = partition_by[0] if partition_by else None
        if place is None:
            out, stay = new_rows(df, target, prune_by=prune_by), False
        else:
            out, stay = at_places(df, working(new_places(df, target, place, prune_by=prune_by), "new-places"), place)
        loaded = lake.write_counted(number(out, max_id(lake, table), False).drop(RANK), table, mode="append", stamps=stamps,
                                    partition_by=partition_by, gather=gather or not stay)
        in_target = before + loaded
        if loaded == 0:
            log.info("Every row of the batch is known; the table stays as it is")
    else:
        lake.write(number(df, 0, True), table, mode="overwrite", stamps=stamps,
                   partition_by=partition_by, gather=gather, expected_rows=total)
        in_target = loaded = total
    return LoadResult(True, total, loaded, total - loaded, in_target)
