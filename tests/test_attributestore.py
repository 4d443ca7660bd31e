"""Attribute history kept as runs against the same steps on one table."""

from __future__ import annotations

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidegauge.operators.history import attribute_compact, transfer_staged
from tidegauge.sources.attributestore import AttributeStore

START = datetime(2024, 1, 1)
STAGING = "entity_id bigint, timestamp timestamp_ntz, kind string, size int, turn int"
HISTORY = "id bigint, first_appearance timestamp_ntz, modified timestamp_ntz, hash string, entity_id bigint, timestamp timestamp_ntz, end timestamp_ntz, kind string, size int"
COLUMNS = ["id", "first_appearance", "modified", "hash", "entity_id", "timestamp", "end", "kind", "size"]


def moment(days):
    return START + timedelta(days=days)


def store(spark, tmp_path):
    return AttributeStore(spark, f"{tmp_path}/a", {"kind": "string", "size": "int"}, "3 days", spread=2)


def as_rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


class OneTable:
    """The same on a single DataFrame, rewritten whole."""

    def __init__(self, spark):
        self.spark, self.rows, self.mark, self.last = spark, spark.createDataFrame([], HISTORY), 0, 0

    def transfer(self, staging, now):
        moment_ = F.lit(now).cast("timestamp_ntz")
        self.rows = self.keep(transfer_staged(self.rows, staging, ["kind", "size"], moment_, "turn", after=self.last))
        self.last = max(self.last, self.rows.agg(F.max("id")).first()[0])

    def compact(self, now):
        moment_ = F.lit(now).cast("timestamp_ntz")
        self.rows = self.keep(attribute_compact(self.rows, ["kind", "size"], moment_, after_id=self.mark))
        self.mark = self.last

    def keep(self, df):
        return self.spark.createDataFrame(df.select(*COLUMNS).collect(), HISTORY)


def batch(rng, days, entities, turn0=0):
    seen, rows = set(), []
    for turn in range(40):
        key = (rng.choice(entities), START + timedelta(hours=rng.randrange(int(24 * days[0]), int(24 * days[1]))))
        if key in seen and rng.random() < 0.5:
            continue
        seen.add(key)
        rows.append((*key, rng.choice("aab"), rng.choice([1, 1, None]), turn0 + turn))
    return rows


@pytest.mark.parametrize("seed, late", [(1, False), (2, True)])
def test_batches_equal_the_same_steps_on_one_table(spark, tmp_path, seed, late):
    """In order and with late rows and changes of known keys; ids, marks, ends and all."""
    rng = random.Random(seed)
    stored, table = store(spark, tmp_path), OneTable(spark)
    for step in range(3):
        entities = list(range(6)) if step < 2 else [0, 1, 9]
        days = (0, 8) if late and step else (2 * step, 2 * step + 2)
        staging = spark.createDataFrame(batch(rng, days, entities), STAGING)
        stored.transfer(staging, moment(20 + step), "turn")
        table.transfer(staging, moment(20 + step))
        assert as_rows(stored.read()) == as_rows(table.rows), step
        if step != 1 or late:
            stored.compact(moment(30 + step))
            table.compact(moment(30 + step))
            assert as_rows(stored.read().filter("end is not null")) == as_rows(table.rows.filter("end is not null")), step


def test_a_batch_leaves_other_buckets_alone(spark, tmp_path):
    stored = store(spark, tmp_path)
    first = [(e, moment(d) + timedelta(hours=h), f"{d}{h}", 1, 0) for e in range(8) for d in range(0, 12, 3) for h in (1, 2)]
    stored.transfer(spark.createDataFrame(first, STAGING), moment(9), "turn")
    stored.compact(moment(10))
    before = files(f"{tmp_path}/a/closed") | files(f"{tmp_path}/a/latest")
    stored.transfer(spark.createDataFrame([(3, moment(13), "new", 1, 0)], STAGING), moment(11), "turn")
    stored.compact(moment(12))
    after = files(f"{tmp_path}/a/closed") | files(f"{tmp_path}/a/latest")
    gone = {path for path, stamp in before.items() if after.get(path) != stamp}
    # The bucket that the closed run starts in, and the one of last runs that has the entity.
    assert len({path.split("bucket=")[1].split("/")[0] for path in gone if "/closed/" in path}) == 1
    assert len({path.split("bucket=")[1].split("/")[0] for path in gone if "/latest/" in path}) == 1
    assert {r.kind for r in stored.current().filter("entity_id = 3").collect()} == {"new"}
    assert stored.current().count() == 8


def test_a_run_that_goes_on_changes_the_last_runs_only(spark, tmp_path):
    stored = store(spark, tmp_path)
    stored.transfer(spark.createDataFrame([(1, moment(0), "a", 1, 0), (1, moment(1), "b", 1, 0)], STAGING), moment(9), "turn")
    stored.compact(moment(9))
    closed = files(f"{tmp_path}/a/closed")
    for day in range(2, 4):
        assert stored.transfer(spark.createDataFrame([(1, moment(day), "b", 1, 0)], STAGING), moment(9), "turn") == 1
        stored.compact(moment(10 + day))
    assert files(f"{tmp_path}/a/closed") == closed
    row = stored.current().first()
    assert (row.timestamp, row.end, row.modified, row.id) == (moment(1), moment(3), moment(13), 2 if row.id == 2 else 1)


def test_nothing_to_do(spark, tmp_path):
    stored = store(spark, tmp_path)
    stored.compact(START)
    assert stored.transfer(spark.createDataFrame([], STAGING), START, "turn") == 0
    stored.compact(START)
    assert stored.read().count() == stored.current().count() == 0
