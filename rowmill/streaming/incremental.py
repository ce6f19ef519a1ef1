"""Incremental loads as a stream that takes what is new and stops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from rowmill.sinks.tables import as_table, as_target, not_older, split_unkeyed, upserted, write_upsert


def load_new(stream: DataFrame, table: str, keys: Sequence[str], order_by: Sequence[str],
             checkpoint: str) -> None:
    """Upsert all unread input of ``stream`` into ``table``, in batches, then end.

    The stream's checkpoint (a folder all executors share) keeps what was read. A batch repeated
    after a failure upserts the same rows again and changes nothing, and a late batch does not turn
    rows back: what the table holds for a key stays if it is newer by ``order_by``. Rows with a null key
    are taken as by ``as_incremental``, with the first of ``order_by`` as the mark: new ones once, late ones in the reject.
    """
    def apply(batch: DataFrame, _: int) -> None:
        if not batch.sparkSession.catalog.tableExists(table):
            as_table(upserted(batch.limit(0), batch, keys, order_by), table)
            return
        held, keyed = batch.sparkSession.table(table), batch.dropna(how="any", subset=list(keys))
        unkeyed = split_unkeyed(batch, table, keys, order_by[0] if order_by else None)
        fresh = not_older(keyed, held, keys, order_by) if order_by else keyed
        write_upsert(as_target(fresh, held).unionByName(unkeyed), table, keys, order_by)

    query = (stream.writeStream.foreachBatch(apply).trigger(availableNow=True)
             .option("checkpointLocation", checkpoint).start())
    query.awaitTermination()
