"""Incremental partials: appended batches against one full run, replays, merges and late periods."""

import math
import uuid

import pytest
from pyspark.sql import functions as F

from cadence.api import metric_cells, no_data_rules
from cadence.session import checkpoint_dir
from cadence.sources.solution import SolutionSource
from cadence.streaming.partials import PartialStore, StoredSource
from tests.fixture import DATA, ruleset, solution

RULES = [(1, "( 1 ) A", "Generator", "All", "Generation", "monthly", False, None),
         (2, "( 2 ) B", "Generator", "All", "Generation", "monthly", True, None)]
GROUPS = (("Generator", "All", "all"),)


def rows(df):
    return sorted(tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in df.collect())


def cells(spark, source, daily=False):
    return rows(metric_cells(source, ruleset(spark, RULES, GROUPS), daily=daily))


@pytest.fixture
def base(spark):
    return f"{checkpoint_dir(spark)}/partials-{uuid.uuid4().hex}"


def append(source, base, where):
    source.facts().where(where).write.mode("append").partitionBy("dataFileId").parquet(f"{base}/data")


def test_two_appends_equal_a_full_run(spark, base):
    full, store = solution(spark), PartialStore(spark, f"{base}/store")
    append(full, base, "PeriodId <= 2")
    store.follow(f"{base}/data", full, files_per_batch=1).awaitTermination()
    part = SolutionSource(spark, full.facts().where("PeriodId <= 2"), full._fki, full._period)
    assert cells(spark, StoredSource(full, store)) == cells(spark, part)
    append(full, base, "PeriodId > 2")
    store.follow(f"{base}/data", full, files_per_batch=1).awaitTermination()
    stored = StoredSource(full, store)
    for daily in (False, True):
        assert cells(spark, stored, daily) == cells(spark, full, daily)
    before = len(store._whole()[1])
    store.follow(f"{base}/data", full).awaitTermination()  # nothing new
    assert len(store._whole()[1]) == before and cells(spark, stored) == cells(spark, full)


def test_replayed_batches_change_nothing(spark, base):
    full, store = solution(spark), PartialStore(spark, base)
    first, second = full.facts().where("PeriodId = 1"), full.facts().where("PeriodId <> 1")
    assert store.add(first, full.periods(), 0) and store.add(second, full.periods(), 1)
    want = rows(store.partials(full.periods()))
    assert not store.add(second, full.periods(), 1) and not store.add(first, full.periods(), 0)
    assert rows(store.partials(full.periods())) == want


def test_a_batch_counts_only_once_it_is_whole(spark, base, monkeypatch):
    full, store = solution(spark), PartialStore(spark, base)
    store.add(full.facts().where("PeriodId = 1"), full.periods(), 0)
    want = rows(store.partials(full.periods()))
    with monkeypatch.context() as m:
        m.setattr(store, "_record", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            store.add(full.facts().where("PeriodId <> 1"), full.periods(), 1)
    assert rows(store.partials(full.periods())) == want  # its files are there, its row is not
    assert store.add(full.facts().where("PeriodId <> 1"), full.periods(), 1)
    assert cells(spark, StoredSource(full, store)) == cells(spark, full)


def test_merging_keeps_the_result_and_bounds_the_folders(spark, base):
    full, store = solution(spark), PartialStore(spark, base, merge_every=2)
    for batch, (series, period, _) in enumerate(DATA):
        store.add(full.facts().where(f"SeriesId = {series} AND PeriodId = {period}"), full.periods(), batch)
    upto, later = store._whole()
    assert upto == 7 and later == [8, 9]
    assert cells(spark, StoredSource(full, store)) == cells(spark, full)
    assert not store.add(full.facts(), full.periods(), 3)  # merged long ago
    assert cells(spark, StoredSource(full, store)) == cells(spark, full)


def test_values_wait_for_their_period(spark, base):
    full = solution(spark)
    early = full.periods().where("PeriodId < 3")
    store = PartialStore(spark, base, merge_every=1)
    for batch, p in enumerate((3, 1, 4, 2)):
        store.add(full.facts().where(f"PeriodId = {p}"), early, batch)
    got = StoredSource(SolutionSource(spark, full.facts(), full._fki, full._period.where("PeriodId < 3")), store)
    assert cells(spark, got) == cells(spark, SolutionSource(spark, full.facts().where("PeriodId < 3"), full._fki, full._period))
    assert cells(spark, StoredSource(full, store)) == cells(spark, full)


def test_empty_store_and_rules_without_data(spark, base):
    full, store = solution(spark), PartialStore(spark, base)
    empty = StoredSource(full, store)
    assert cells(spark, empty) == []
    assert [r["rule_ord"] for r in no_data_rules(empty, ruleset(spark, RULES, GROUPS)).collect()] == [1, 2]
    store.add(full.facts().limit(0), full.periods(), 0)
    assert cells(spark, empty) == []
    store.add(full.facts(), full.periods(), 1)
    assert no_data_rules(empty, ruleset(spark, RULES, GROUPS)).count() == 0


def test_null_values_and_repeated_periods(spark, base):
    full = solution(spark)
    fact = full.facts().unionByName(full.facts().where("PeriodId = 2").withColumn("Value", F.lit(None).cast("double")))
    src = SolutionSource(spark, fact, full._fki, full._period.unionByName(full._period.where("PeriodId = 3")))
    store = PartialStore(spark, base)
    store.add(fact, src.periods(), 0)
    assert cells(spark, StoredSource(src, store)) == cells(spark, src)


def test_reports_over_a_store_never_read_the_fact(spark, base):
    full, store = solution(spark), PartialStore(spark, f"{base}/store")
    append(full, base, "true")
    src = SolutionSource(spark, spark.read.parquet(f"{base}/data"), full._fki, full._period)
    store.follow(f"{base}/data", src).awaitTermination()
    read = metric_cells(StoredSource(src, store), ruleset(spark, RULES, GROUPS)).inputFiles()
    assert any("/store/batches/" in f for f in read) and not any("/data/" in f for f in read)


def test_filters_on_a_store(spark, base):
    full = solution(spark)
    with pytest.raises(ValueError, match="period_type"):
        StoredSource(full, PartialStore(spark, base)).filtered(period_type="Interval")
