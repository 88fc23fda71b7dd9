"""Continuous insertion of company records."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nomina.operators.enrich import PageExtractor
from nomina.sources.store import COMPANY_FIELDS, CompanyStore, validate

SideOutput = Callable[[DataFrame, str], None]


def stream_into(
    records: DataFrame,
    store: CompanyStore,
    checkpoint: str,
    check_exists: bool = True,
    mode: str = "exact",
    quarantine: str | None = None,
) -> StreamingQuery:
    """Insert a stream of company records; stops when all that is available has been read.

    Each batch is a load of the store named after the batch, so a batch that runs again
    after a failure replaces what it wrote before. Its earlier attempt is not looked at
    when checking which records are new. Incomplete rows go to ``quarantine``;
    without one they stop the stream. With ``mode="relevant"`` each batch is searched in the
    store's index, which gets a segment per batch.
    """
    store.create()

    def insert(batch: DataFrame, batch_id: int) -> None:
        store.insert(batch, check_exists, mode, f"batch-{batch_id}", quarantine)

    return _started(records, insert, checkpoint)


def stream_payloads(
    payloads: DataFrame, store: CompanyStore, checkpoint: str, quarantine: str, check_exists: bool = True, mode: str = "exact", column: str = "value"
) -> StreamingQuery:
    """Insert a stream of JSON payloads; those that hold no record are kept as they came, under the batch's name in ``quarantine``."""
    store.create()

    def insert(batch: DataFrame, batch_id: int) -> None:
        load = f"batch-{batch_id}"
        valid, rejected = validate(batch, column)
        store.insert(valid, check_exists, mode, load)
        rejected.write.mode("overwrite").parquet(f"{quarantine}/{load}")

    return _started(payloads, insert, checkpoint)


def stream_pages(
    pages: DataFrame,
    extractor: PageExtractor,
    store: CompanyStore,
    checkpoint: str,
    side_outputs: Sequence[SideOutput],
    check_exists: bool = True,
    mode: str = "exact",
) -> StreamingQuery:
    """Insert the records of a stream of pages and hand every extracted value to side outputs.

    A side output gets ``(url, value)`` rows of a batch and a label that is the same when
    the batch runs again; ``table_output`` writes them once per label. Side outputs come before
    the insert, so a batch is only done when all have been served.
    """
    store.create()

    def insert(batch: DataFrame, batch_id: int) -> None:
        load = f"batch-{batch_id}"
        values = extractor.values(batch)
        for output in side_outputs:
            output(values, load)
        found = extractor.records(batch).filter(F.col("status") == "ok").select(*COMPANY_FIELDS)
        store.insert(found, check_exists, mode, load)

    return _started(pages, insert, checkpoint)


def table_output(path: str) -> SideOutput:
    """A side output that keeps values as a Parquet table below ``path``, a folder per batch that a rerun replaces."""

    def write(values: DataFrame, load: str) -> None:
        values.write.mode("overwrite").parquet(f"{path}/load={load}")

    return write


def _started(stream: DataFrame, insert: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(insert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
