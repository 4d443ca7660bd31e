"""Attribute history kept as runs, so that a batch costs by its own size.

Compaction replaces consecutive rows of an entity with equal hashes by one, a run: its first row, with the last row's timestamp as its
end. A run stands for its rows as long as what follows is later: the runs of an entity's history followed by a batch are its closed
runs, unchanged, and the runs of its last run followed by the batch. So the history is kept in three tables:

- ``recent``: rows taken over since the last compaction, by time bucket,
- ``latest``: the last run of every entity, by a hash of the entity; the only row of an entity that a later batch changes,
- ``closed``: all other runs, by the time bucket of their start; a batch only adds to it.

Rows that come late, before the start of an entity's last run, and changes of closed rows make compaction take all of that entity's runs again;
other entities' buckets are not opened. Together the three tables are the history, whatever has been compacted.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators.history import BASE, attribute_compact, transfer_staged
from tidegauge.operators.joins import as_of_latest
from tidegauge.plans.spec import KEY
from tidegauge.session import delete_folder, folder_names, read_or_empty, written_once
from tidegauge.sources.factstore import FactStore

_TRANSFERS = "last_id bigint, added bigint, moment timestamp_ntz"
_BASE_TYPES = dict.fromkeys(BASE, "timestamp_ntz") | {"id": "bigint", "hash": "string"}


class AttributeStore:
    """The history of one attribute store below ``path``; ``attributes`` are name and type of each.

    ``spread`` is the number of buckets for the table of last runs. One writer at a time.
    """

    def __init__(
        self, spark: SparkSession, path: str, attributes: dict[str, str], partition_size: str = "1 month", entity: str = "bigint",
        spread: int = 64, arrays: Sequence[str] = (),
    ):
        self.spark, self.path, self.attributes, self.arrays = spark, path, list(attributes), tuple(arrays)
        types = _BASE_TYPES | {"entity_id": entity} | attributes
        schema = ", ".join(f"`{name}` {kind}" for name, kind in types.items())
        by_entity = F.pmod(F.xxhash64("entity_id"), F.lit(spread))
        self.recent = FactStore(spark, f"{path}/recent", schema, partition_size)
        self.closed = FactStore(spark, f"{path}/closed", schema, partition_size)
        self.latest = FactStore(spark, f"{path}/latest", schema, key=("entity_id",), bucket=by_entity)
        # Entities whose closed rows were changed since the last compaction.
        self.changed = FactStore(spark, f"{path}/changed", f"entity_id {entity}", key=("entity_id",), bucket=by_entity)

    def read(self) -> DataFrame:
        """The whole history."""
        return self.closed.read().unionByName(self.latest.read()).unionByName(self.recent.read())

    def transfers(self) -> DataFrame:
        """``last_id, added, moment``: one row per transfer that added rows."""
        return read_or_empty(self.spark, f"{self.path}/transfers", self.spark.createDataFrame([], _TRANSFERS).schema)

    def last_id(self) -> int:
        """The highest id given so far, from the list of transfers; the history isn't scanned for it."""
        return self.transfers().agg(F.coalesce(F.max("last_id"), F.lit(0)).alias("last")).first()["last"]

    def transfer(self, staging: DataFrame, now: datetime, order: str | None = None) -> int:
        """Take staged rows over, see :func:`~tidegauge.operators.history.transfer_staged`; the number of new keys.

        Only buckets of staged keys are read and rewritten. A staged key may be in any of the tables.
        """
        moment = F.lit(now).cast("timestamp_ntz")
        with written_once(staging) as staged:
            keys, rest = staged.select(*KEY).distinct(), staged
            for store, asked in ((self.closed, keys), (self.latest, keys.select("entity_id"))):
                known = store.having(asked).join(keys, list(KEY), "left_semi")
                if known.isEmpty():
                    continue
                # Without new keys a transfer gives the known rows with their staged attributes.
                held = staged.join(known.select(*KEY), list(KEY), "left_semi")
                with written_once(transfer_staged(known, held, self.attributes, moment, order, self.arrays)) as rows:
                    if store is self.closed:
                        self.changed.put(rows.select("entity_id").distinct())
                    store.put_written(rows)
                rest = rest.join(store.having(asked).select(*KEY), list(KEY), "left_anti")
            with written_once(rest) as free:
                known, last = self.recent.having(keys), self.last_id()
                with written_once(transfer_staged(known, free, self.attributes, moment, order, self.arrays, after=last)) as rows:
                    self.recent.put_written(rows)
                    added = rows.filter(F.col("id") > last).count()
            if added:
                row = self.spark.createDataFrame([(last + added, added, now)], _TRANSFERS)
                row.coalesce(1).write.mode("append").parquet(f"{self.path}/transfers")
        return added

    def compact(self, now: datetime) -> None:
        """Bring the rows taken over since the last time into runs, see :func:`~tidegauge.operators.history.attribute_compact`.

        Reads the recent rows and the last runs of their entities; adds runs to ``closed``. A compaction that fails before it
        emptied ``recent`` must not be followed by a transfer of late rows; running it again first is safe, as runs are put by key.
        """
        moment = F.lit(now).cast("timestamp_ntz")
        if not folder_names(self.spark, self.recent.path):
            return
        recent = self.recent.read()
        entities = recent.groupBy("entity_id").agg(F.min("timestamp").alias("begin"))
        with written_once(entities) as touched:
            last = self.latest.having(touched.select("entity_id"))
            begun = touched.join(last.select("entity_id", F.col("timestamp").alias("start")), "entity_id", "left")
            changed = self.changed.having(touched.select("entity_id")).withColumn("changed", F.lit(True))
            again = begun.join(changed, "entity_id", "left").filter((F.col("begin") <= F.col("start")) | F.col("changed")).select("entity_id")
            with written_once(again) as late:
                some_late = not late.isEmpty()
                old = self.closed.read().join(late, "entity_id", "left_semi") if some_late else recent.limit(0)
                rows = recent.unionByName(last).unionByName(old)
                with written_once(attribute_compact(rows, self.attributes, moment)) as runs, written_once(as_of_latest(runs)) as ends:
                    done = runs.join(ends.select(*KEY), list(KEY), "left_anti")
                    if some_late:
                        with written_once(old.select(*KEY)) as replaced:
                            self.closed.exchange(done, replaced.join(done.select(*KEY), list(KEY), "left_anti"))
                        self.changed.exchange(late.limit(0), late)
                    else:
                        self.closed.put(done)
                    self.latest.put_written(ends)
        delete_folder(self.spark, self.recent.path)

    def current(self) -> DataFrame:
        """Latest row per entity, of the compacted part: one row per entity is read."""
        return self.latest.read()
