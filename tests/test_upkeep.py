from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from hoptrail.operators.upkeep import Selection, compact, free, plan_compaction
from hoptrail.plans.normalize import normalize
from hoptrail.schema import PARTITION_COLUMNS, TRACE_COLUMNS
from hoptrail.sources.events import as_traces
from hoptrail.sources import lake as lake_files
from hoptrail.operators.lookup import transaction
from hoptrail.sources.files import delete, list_names
from hoptrail.sources.ids import find_by_id
from hoptrail.sources.lake import PROMOTIONS, read_record, read_versions, trace_view, versions
from hoptrail.sources.tables import read_legacy_traces, read_traces
from hoptrail.streaming.ingest import start_landing

EVENTS = "/root/testdata/sf0.001/events.parquet"
ONCE = {"availableNow": True}
AFTER_ALL = datetime(2024, 2, 1, tzinfo=timezone.utc)


def rows(df):
    return sorted(map(str, df.select(*TRACE_COLUMNS).collect()))


def bad_row(spark):
    """One unreadable message: no time, no partition but the zone."""
    empty = spark.range(1).select(
        *[F.lit(None).cast("string").alias(c) for c in ("endpoint", "id_consumer", "date_transaction")]
    )
    record = empty.select(
        "*",
        *[F.lit(None).cast("string").alias(c) for c in ("id_recurso", "id_transaccion", "ip_consumer", "ip_transaccion", "tipo_operacion")],
        *[F.lit(None).cast("bigint").alias(c) for c in ("req_body_size", "resp_body_size", "time_transaction")],
        F.lit(None).cast("int").alias("status_response"),
    )
    return normalize(record, "zone1")


@pytest.fixture
def lake(spark, tmp_path):
    """A landing root written by the stream in three batches, plus new data on demand."""
    source, landing = tmp_path / "source", tmp_path / "landing"
    traces = as_traces(spark.read.parquet(EVENTS)).where("day <= 3")
    traces.repartition(12).write.parquet(str(source))
    bad_row(spark).write.mode("append").parquet(str(source))

    def land(extra=None):
        if extra is not None:
            extra.coalesce(1).write.mode("append").parquet(str(source))
        stream = (
            spark.readStream.schema(traces.schema).option("maxFilesPerTrigger", 5).parquet(str(source))
        )
        start_landing(stream, str(landing), str(tmp_path / "ck"), ONCE).awaitTermination()

    land()
    return str(landing), str(tmp_path / "history"), land, spark.read.parquet(str(source))


def history_of(spark, history):
    return read_versions(spark, history, versions(read_record(spark, history)))


def late_row(source, leaf, name="late"):
    return (
        source.where(" AND ".join(f"{c} = '{leaf[c]}'" for c in PARTITION_COLUMNS))
        .limit(1)
        .withColumn("id_transaccion", F.lit(name))
    )


def test_compaction_keeps_rows_and_cuts_files(spark, lake):
    landing, history, _, source = lake
    report = compact(spark, landing, history, now=AFTER_ALL).cache()
    assert {r.action for r in report.collect()} == {"compact"}
    assert report.where("files_after <> 1").count() == 0
    # Hours of one file and the messages without a time are promoted too.
    assert report.where("files_before = 1").count() > 0
    assert report.where("year IS NULL AND rows = 1").count() == 1
    assert report.agg(F.sum("rows")).first()[0] == source.count()
    assert rows(history_of(spark, history)) == rows(source)
    assert rows(trace_view(spark, landing, history)) == rows(source)

    again = compact(spark, landing, history, now=AFTER_ALL)
    assert {r.action for r in again.collect()} == {"up_to_date"}
    assert rows(trace_view(spark, landing, history)) == rows(source)


def test_a_run_without_a_record_has_no_effect(spark, lake):
    landing, history, _, source = lake
    compact(spark, landing, history, now=AFTER_ALL)
    # As if the run had been killed after its write.
    delete(spark, f"{history}/{PROMOTIONS}")
    assert trace_view(spark, landing, history).count() == source.count()
    report = compact(spark, landing, history, now=AFTER_ALL)
    assert {r.action for r in report.collect()} == {"compact"}
    assert rows(trace_view(spark, landing, history)) == rows(source)


def test_a_compaction_while_the_view_is_built(spark, lake, monkeypatch):
    landing, history, _, source = lake
    listed = lake_files.landed_files
    ran = []

    def slow(*args):
        if not ran:
            ran.append(1)
            compact(spark, landing, history, now=AFTER_ALL)
        return listed(*args)

    monkeypatch.setattr(lake_files, "landed_files", slow)
    assert rows(trace_view(spark, landing, history)) == rows(source)
    assert rows(trace_view(spark, landing, history)) == rows(source)


def test_late_traces_are_seen_at_once(spark, lake):
    landing, history, land, source = lake
    compact(spark, landing, history, now=AFTER_ALL)
    leaf = history_of(spark, history).where("year IS NOT NULL").select(*PARTITION_COLUMNS).first()
    total = source.count()
    land(late_row(source, leaf).cache())
    view = trace_view(spark, landing, history)
    assert view.where("id_transaccion = 'late'").count() == 1 and view.count() == total + 1
    # However late, a run over recent hours takes the file along.
    month_later = datetime(2024, 3, 1, tzinfo=timezone.utc)
    report = compact(spark, landing, history, Selection(recent_hours=3), month_later)
    assert report.where("action = 'compact'").count() == 1
    assert report.where("action = 'compact'").first().rows > 1
    view = trace_view(spark, landing, history)
    assert view.where("id_transaccion = 'late'").count() == 1 and view.count() == total + 1


def test_history_grows_after_landing_was_freed(spark, lake):
    landing, history, land, source = lake
    compact(spark, landing, history, now=AFTER_ALL)
    total = source.count()
    leaf = history_of(spark, history).where("year IS NOT NULL").select(*PARTITION_COLUMNS).first()
    extra = late_row(source, leaf).cache()
    assert free(spark, landing, history, timedelta(days=1), AFTER_ALL) == (0, 0)
    files, versions = free(spark, landing, history, timedelta(0), AFTER_ALL)
    assert files > 0 and versions == 0
    assert trace_view(spark, landing, history).count() == total
    land(extra)
    compact(spark, landing, history, now=AFTER_ALL)
    assert trace_view(spark, landing, history).count() == total + 1
    assert history_of(spark, history).count() == total + 1
    # The version that was replaced and the late file go next.
    assert free(spark, landing, history, timedelta(0), AFTER_ALL) == (1, 1)
    assert trace_view(spark, landing, history).count() == total + 1


def test_two_zones_in_one_deployment(spark, tmp_path):
    landing, history = str(tmp_path / "landing"), str(tmp_path / "history")
    traces = as_traces(spark.read.parquet(EVENTS)).where("day <= 2")
    for zone in ("zone1", "zone2"):
        mine = traces.where(F.col("zona") == zone)
        mine.repartition(2).write.parquet(str(tmp_path / zone))
        stream = spark.readStream.schema(traces.schema).parquet(str(tmp_path / zone))
        start_landing(stream, f"{landing}/{zone}", str(tmp_path / f"ck-{zone}"), ONCE).awaitTermination()
    both = traces.where("zona IN ('zone1', 'zone2')")
    assert rows(trace_view(spark, landing, history)) == rows(both)
    compact(spark, landing, history, now=AFTER_ALL)
    assert rows(trace_view(spark, landing, history)) == rows(both)
    assert rows(history_of(spark, history)) == rows(both)
    # One root for two queries, or a new checkpoint on it, would lose batches.
    with pytest.raises(ValueError, match="another query"):
        start_landing(stream, f"{landing}/zone1", str(tmp_path / "ck-zone2"), ONCE)
    with pytest.raises(ValueError, match="another query"):
        start_landing(stream, f"{landing}/zone2", str(tmp_path / "ck-new"), ONCE)


def test_only_chosen_hours_are_listed(spark, tmp_path, monkeypatch):
    landing, history = str(tmp_path / "landing"), str(tmp_path / "history")
    traces = as_traces(spark.read.parquet(EVENTS)).where("day <= 2")
    traces.coalesce(2).write.partitionBy(*PARTITION_COLUMNS).parquet(landing)
    listed = []

    def spy(spark_, path):
        listed.append(path)
        return list_names(spark_, path)

    monkeypatch.setattr(lake_files, "list_names", spy)
    now = datetime(2024, 1, 2, 5, 30, tzinfo=timezone.utc)
    hours = Selection(recent_hours=3).hours(now)
    view = trace_view(spark, landing, history, hours)
    chosen = traces.where("day = 2 AND hour IN (2, 3, 4)")
    have = {(r.day, r.hour) for r in chosen.collect()}
    assert rows(view) == rows(chosen)
    assert {p.split("/day=")[1] for p in listed if "/day=" in p} == {"2/hour=2", "2/hour=3", "2/hour=4"}
    plan = plan_compaction(spark, landing, history, Selection(recent_hours=3), now)
    assert {(r.day, r.hour) for r in plan.collect()} == have


def test_selections(spark, lake):
    landing, history, _, _ = lake
    now = datetime(2024, 1, 3, 5, 30, tzinfo=timezone.utc)

    def hours(selection):
        plan = plan_compaction(spark, landing, history, selection, now)
        return {(r.year, r.month, r.day, r.hour) for r in plan.collect()}

    assert max(h for h in hours(Selection()) if h[0]) < (2024, 1, 3, 5)
    assert {h[2] for h in hours(Selection.yesterday(now))} == {2}
    assert {h[2] for h in hours(Selection(day=date(2024, 1, 1)))} == {1}
    recent = hours(Selection(recent_hours=8))
    expected = {now - timedelta(hours=n) for n in range(1, 9)}
    assert recent and recent <= {(t.year, t.month, t.day, t.hour) for t in expected}
    assert (2024, 1, 2, 22) in recent or (2024, 1, 2, 23) in recent

    with pytest.raises(ValueError):
        Selection(day=date(2024, 1, 1), recent_hours=2)
    with pytest.raises(ValueError):
        Selection(recent_hours=0)
    with pytest.raises(ValueError):
        compact(spark, landing + "-none", history)


def test_a_busy_hour_is_split(spark, tmp_path):
    base = as_traces(spark.read.parquet(EVENTS)).where("day = 1 AND hour <= 2")
    hot = base.where("hour = 0").limit(1).crossJoin(spark.range(40_000)).drop("id")
    landing, history = str(tmp_path / "landing"), str(tmp_path / "history")
    (
        base.unionByName(hot.select(*TRACE_COLUMNS))
        .withColumn("id_transaccion", F.expr("uuid()"))
        .repartition(6)
        .write.partitionBy(*PARTITION_COLUMNS)
        .parquet(landing)
    )
    before = read_traces(spark, landing).count()
    report = compact(spark, landing, history, now=AFTER_ALL, task_bytes=512 * 1024)
    leaves = report.orderBy(F.desc("files_after")).collect()
    assert leaves[0].files_after > 1
    assert all(leaf.files_after == 1 for leaf in leaves[1:])
    assert trace_view(spark, landing, history).count() == before


def test_a_lookup_by_id_skips_row_groups(spark, lake):
    landing, history, _, _ = lake
    compact(spark, landing, history, now=AFTER_ALL)
    known = history_of(spark, history).first().id_transaccion

    def scanned(id_transaccion):
        found = history_of(spark, history).where(F.col("id_transaccion") == id_transaccion)
        count = len(found.collect())
        scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return count, scan.metrics().apply("numOutputRows").value()

    assert scanned("no-such-id") == (0, 0)
    count, rows_read = scanned(known)
    assert count == 1 and rows_read < history_of(spark, history).count()


def test_legacy_tables_are_read_by_name_and_filled(spark, tmp_path):
    old, new = str(tmp_path / "old"), str(tmp_path / "mixed")
    traces = as_traces(spark.read.parquet(EVENTS)).where("day = 1")
    derived = ["query_params", "consumer_type", "source_zone", "source_service"]
    swapped = ["year", "month", "day", "hour", "zona"]
    traces.drop(*derived).write.partitionBy(*swapped).parquet(old)
    assert rows(read_legacy_traces(spark, old)) == rows(traces)

    # Old and new files side by side in the same folders, columns in another order.
    traces.drop(*derived).write.partitionBy(*PARTITION_COLUMNS).parquet(new)
    traces.select(*reversed(TRACE_COLUMNS)).write.mode("append").partitionBy(
        *PARTITION_COLUMNS
    ).parquet(new)
    assert rows(read_legacy_traces(spark, new)) == sorted(rows(traces) * 2)
    history = str(tmp_path / "history")
    compact(spark, new, history, now=AFTER_ALL)
    assert history_of(spark, history).where("consumer_type IS NULL").count() == 0


def test_the_record_is_pruned_by_hours(spark, lake):
    landing, history, _, _ = lake
    compact(spark, landing, history, now=AFTER_ALL)
    leaf = history_of(spark, history).where("year IS NOT NULL").select(*PARTITION_COLUMNS).first()
    hours = [datetime(leaf.year, leaf.month, leaf.day, leaf.hour, tzinfo=timezone.utc)]
    plan = read_record(spark, history, hours)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert all(f"EqualTo({c},{leaf[c]})" in pushed for c in ("year", "month", "day"))
    view = trace_view(spark, landing, history, hours)
    assert view.count() == trace_view(spark, landing, history).where(" AND ".join(f"{c} = {leaf[c]}" for c in PARTITION_COLUMNS[1:])).count()


def test_the_record_shrinks(spark, tmp_path):
    landing, history = str(tmp_path / "landing"), str(tmp_path / "history")
    traces = as_traces(spark.read.parquet(EVENTS)).where("day <= 2")

    def land(part):
        part.repartition(3).write.mode("append").partitionBy(*PARTITION_COLUMNS).parquet(landing)

    land(traces)
    partitions = traces.select(*PARTITION_COLUMNS).distinct().count()
    compact(spark, landing, history, now=AFTER_ALL)
    assert read_record(spark, history).count() > partitions
    for _ in range(2):
        freed, _ = free(spark, landing, history, timedelta(0), AFTER_ALL)
        record = read_record(spark, history)
        assert record.count() == partitions == record.where("file IS NULL").count()
        assert rows(trace_view(spark, landing, history)) == rows(traces)
    assert freed == 0
    # What lands later is recorded and freed alike, and replaces a version.
    late = traces.limit(4).withColumn("id_transaccion", F.lit("late")).cache()
    land(late)
    compact(spark, landing, history, now=AFTER_ALL)
    _, replaced = free(spark, landing, history, timedelta(0), AFTER_ALL)
    assert replaced == late.select(*PARTITION_COLUMNS).distinct().count()
    assert read_record(spark, history).count() == partitions
    assert rows(trace_view(spark, landing, history)) == rows(traces.unionByName(late))


def test_a_stopped_run_is_removed_after_its_time(spark, lake):
    landing, history, _, source = lake
    now = datetime.now(timezone.utc)
    compact(spark, landing, history, now=now)
    stopped = f"{history}/run=000000002-stopped"
    source.limit(1).write.parquet(stopped)
    assert free(spark, landing, history, timedelta(days=1), now) == (0, 0)
    assert "run=000000002-stopped" in list_names(spark, history)
    _, removed = free(spark, landing, history, timedelta(days=1), now + timedelta(days=2))
    assert removed == 1 and "run=000000002-stopped" not in list_names(spark, history)
    assert trace_view(spark, landing, history).count() == source.count()


def test_a_lookup_by_id_opens_the_named_files_only(spark, lake):
    landing, history, land, source = lake
    leaf = source.where("year IS NOT NULL").select(*PARTITION_COLUMNS).first()
    known = source.where("id_transaccion IS NOT NULL").first().id_transaccion
    assert find_by_id(spark, landing, history, known).count() == 1
    compact(spark, landing, history, now=AFTER_ALL)
    found = find_by_id(spark, landing, history, known)
    assert len(found.inputFiles()) == 1 and rows(found) == rows(source.where(F.col("id_transaccion") == known))
    assert find_by_id(spark, landing, history, "no-such-id").inputFiles() == []
    # A version that was replaced isn't read, nor is a late file missed.
    land(late_row(source, leaf, known).cache())
    pending = find_by_id(spark, landing, history, known)
    assert pending.count() == 2
    compact(spark, landing, history, now=AFTER_ALL)
    again = find_by_id(spark, landing, history, known)
    assert again.count() == 2 and len(again.inputFiles()) <= 2
    assert transaction(again, known).count() == 2
    others = [r.id_transaccion for r in source.where("id_transaccion IS NOT NULL").limit(40).collect()]
    for other in others[10:13]:
        assert rows(find_by_id(spark, landing, history, other)) == rows(source.where(F.col("id_transaccion") == other))
