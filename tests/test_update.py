"""Loads, logs and the whole update on the small sample tables."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fairwake import schemas
from fairwake.plans import zones
from fairwake.plans.catalog import AS_OF, EVER, QUERIES, Chain
from fairwake.plans.update import update, update_loads
from fairwake.sources import tables
from fairwake.streaming import incremental

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FIRST_DAY = EVER.date()


@pytest.fixture(scope="module")
def chain(spark):
    return Chain(spark, FOLDER)


def inputs(chain, source=None):
    return {
        "source": chain.source if source is None else source,
        "registry": chain.registry,
        "coast": chain.coast,
        "zone_table": chain.zones,
        "today": AS_OF[0],
    }


def stored(spark, folder, table):
    return tables.scan_table(spark, f"{folder}/{table.name}", table.schema, FIRST_DAY)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def updated(spark, chain):
    folder = tables.new_folder(spark, "test-update")
    update(spark, folder, categories=chain.categories, **inputs(chain))
    return folder


def test_tables_equal_the_stages_in_one_go(spark, chain, updated):
    assert rows(stored(spark, updated, incremental.MESSAGES)) == rows(chain.messages)
    assert rows(stored(spark, updated, incremental.SEGMENTS)) == rows(chain.segments)
    assert rows(stored(spark, updated, incremental.ZONE_SEGMENTS)) == rows(chain.zone_segments)
    daily = tables.scan_rebuilt(spark, f"{updated}/ship_stats_daily", chain.daily.schema)
    assert rows(daily.select(chain.daily.columns)) == rows(chain.daily)


def test_loading_again_adds_nothing(spark, chain, updated):
    before = {t.name: stored(spark, updated, t).count() for t in (incremental.MESSAGES, incremental.SEGMENTS)}
    update_loads(spark, updated, **inputs(chain))
    after = {t.name: stored(spark, updated, t).count() for t in (incremental.MESSAGES, incremental.SEGMENTS)}
    assert after == before
    log = spark.read.schema(schemas.LOAD_LOG).parquet(f"{updated}/load_log")
    latest = log.where("table_name = 'ais_data'").orderBy("date_accessed").collect()
    assert [r.query_exec for r in latest] == ["query_start", "query_end"] * 2
    assert latest[1].newest_timestamp == latest[2].newest_timestamp == latest[3].newest_timestamp


def test_two_loads_lose_only_segments_across_the_border(spark, chain):
    folder = tables.new_folder(spark, "test-two-loads")
    half = chain.source.where(F.col("date") < F.lit(dt.date(2024, 1, 15)))
    for source in (half, chain.source):
        update_loads(spark, folder, **inputs(chain, source))
    assert rows(stored(spark, folder, incremental.MESSAGES)) == rows(chain.messages)
    names = [c for c in schemas.SEGMENTS.names if c != "num"]
    twice = set(rows(stored(spark, folder, incremental.SEGMENTS).select(names)))
    once = set(rows(chain.segments.select(names)))
    assert twice <= once
    lost = len(once - twice)
    border = chain.segments.where(
        "timestamp_beg < timestamp'2024-01-15' and timestamp_end >= timestamp'2024-01-15'"
    ).count()
    assert lost >= border


def test_repeating_a_load_replaces_its_files(spark, chain):
    folder = tables.new_folder(spark, "test-repeat")
    table = incremental.MESSAGES
    for _ in range(2):
        tables.append_load(
            chain.messages, f"{folder}/{table.name}", tables.load_id(EVER), table.schema,
            day=table.day(), cluster=table.cluster,
        )
    assert rows(stored(spark, folder, table)) == rows(chain.messages)


@pytest.mark.parametrize(
    "table", [incremental.MESSAGES, incremental.SEGMENTS, incremental.RUNS, incremental.ZONE_SEGMENTS], ids=lambda t: t.name
)
def test_a_load_that_died_is_started_over(spark, updated, table):
    """Only its last days were in place, without the marker: the next load loses nothing."""
    everything = stored(spark, updated, table)
    folder, start = tables.new_folder(spark, "test-lost"), EVER
    path = f"{folder}/{table.name}"
    tables.append_load(
        everything.where(table.day() >= F.lit(dt.date(2024, 1, 20))), path, tables.load_id(start),
        table.schema, day=table.day(), cluster=table.cluster,
    )
    tables.unmark(spark, f"{path}/{tables.LOAD}={tables.load_id(start)}")
    assert stored(spark, folder, table).count() == 0
    since = incremental.load(
        spark, folder, table, lambda since: everything, today=AS_OF[0], default_since=start, log=f"{folder}/log"
    )
    assert since == start and rows(stored(spark, folder, table)) == rows(everything)


def test_the_log_knows_the_watermark_of_old_tables(spark, updated):
    long_after = dt.date(2030, 1, 1)
    path, log = f"{updated}/ais_data", f"{updated}/load_log"
    with_log = incremental.watermark(spark, path, incremental.MESSAGES, long_after, EVER, log)
    assert with_log == incremental.watermark(spark, path, incremental.MESSAGES, long_after, EVER)


def test_a_rebuild_that_died_leaves_the_version_before(spark):
    path = tables.new_folder(spark, "test-versions")
    schema = spark.range(1).schema
    assert tables.scan_rebuilt(spark, path, schema).count() == 0
    for n in (3, 4, 5):
        tables.rebuild(spark.range(n), path, ["id"])
    assert len(tables.complete(spark, path, tables.VERSION)) == tables.VERSIONS_KEPT
    tables.unmark(spark, tables.complete(spark, path, tables.VERSION)[-1])
    assert tables.scan_rebuilt(spark, path, schema).count() == 4


def test_scans_prune_days(spark, chain, updated):
    recent = tables.scan_table(
        spark, f"{updated}/ais_data", schemas.MESSAGES, dt.date(2024, 1, 20)
    )
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert recent.where("timestamp < timestamp'2024-01-20'").count() == 0 and recent.count() > 0


def test_watermark_of_old_and_missing_tables(spark, updated):
    def mark(path, today):
        return incremental.watermark(spark, path, incremental.MESSAGES, today, EVER)

    assert mark(f"{updated}/missing", AS_OF[0]) == EVER
    newest = mark(f"{updated}/ais_data", AS_OF[0])
    assert newest > EVER and mark(f"{updated}/ais_data", dt.date(2030, 1, 1)) == newest


def test_stats_log_has_a_row_per_scorecard(spark, updated):
    log = spark.read.schema(schemas.STATS_LOG).parquet(f"{updated}/stats_log")
    assert log.count() == 6 and log.where("newest_timestamp is null").count() == 0


def test_freshness_log_reads_runs_from_one_table(spark, chain):
    log = QUERIES["freshness_log"](chain)
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(" not in plan  # which made the runs' geometries, once for each use
    found = {r.table_name: r.newest_timestamp for r in log.collect()}
    fresh = incremental.recent(chain.runs_legacy, "date", AS_OF[0], incremental.relativedelta(days=14))
    zone_runs = zones.clip_runs_to_zones(chain.runs_legacy, chain.zones, EVER)
    expected = {"ais_segments_agg": fresh, "ais_vsr_segments_agg": zone_runs}
    for name, rows_of in expected.items():
        assert found[name] == incremental.newest(rows_of, "timestamp_end").first()[0]
    assert len(found) == 5


def test_scratch_folder_comes_from_the_session(spark):
    assert tables.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_create_once_keeps_what_is_there(spark):
    path = tables.new_folder(spark, "test-once")
    for n in (3, 5):
        tables.create_once(spark.range(n), path)
    assert spark.read.parquet(path).count() == 3
