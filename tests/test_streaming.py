import pytest
from conftest import TINY
from pyspark.sql import functions as F

from tidemart.operators.bronze import to_bronze
from tidemart.operators.silver import to_silver
from tidemart.schemas import RAW_EVENTS, SILVER_EVENT, silver_schema
from tidemart.sources import given
from tidemart.sources import messages as message_source
from tidemart.sources.commits import Manifest
from tidemart.sources.files import Store
from tidemart.sources.lake import KEPT_ENTRIES, Lake
from tidemart.streaming import pipeline

TIMELESS = [c for c in RAW_EVENTS.names if c != "processing_time"]


def _same(left, right):
    """Same rows, counting duplicates. Maps cannot be compared, so rows go through JSON."""
    def text(rows):
        return rows.drop("processing_time").select(F.to_json(F.struct("*")).alias("row"))

    left, right = text(left), text(right)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_streams_give_what_batch_gives(spark, lake, tmp_path):
    sent = given.messages(spark, TINY)
    folder = str(tmp_path / "landing")
    message_source.to_files(sent.repartition(5), folder)
    pipeline.drain(lake, message_source.from_files(spark, folder, max_files_per_trigger=2))
    assert _same(lake.read("bronze", "raw_events").select(*TIMELESS), to_bronze(sent).select(*TIMELESS))
    for table in SILVER_EVENT:
        got = lake.read("silver", table)
        assert got.columns == silver_schema(table).names
        assert _same(got, to_silver(to_bronze(sent), table))

    # Nothing new: nothing added. New files: only they are added, by a lake opened anew.
    before = lake.read("silver", "page_views").count()
    pipeline.drain(lake, message_source.from_files(spark, folder))
    assert lake.read("silver", "page_views").count() == before
    message_source.to_files(sent.limit(0).unionByName(sent), folder)
    again = Lake(spark, lake.root, lake.prefix).create()
    pipeline.drain(again, message_source.from_files(spark, folder))
    assert again.read("silver", "page_views").count() == 2 * before


def _landed(spark, tmp_path, parts=1):
    folder = str(tmp_path / "landing")
    message_source.to_files(given.messages(spark, TINY).repartition(parts), folder)
    return lambda files=None: message_source.from_files(spark, folder, max_files_per_trigger=files)


def _silver_is_whole(spark, lake):
    for table in SILVER_EVENT:
        assert _same(lake.read("silver", table), to_silver(to_bronze(given.messages(spark, TINY)), table))


def test_each_silver_stream_reads_its_own_folder(spark, lake, tmp_path, monkeypatch):
    pipeline.drain(lake, _landed(spark, tmp_path)(), "ingestion")
    read = []
    real = Lake.rows_of
    monkeypatch.setattr(Lake, "rows_of", lambda self, layer, table, parts: read.extend(parts) or real(self, layer, table, parts))
    query = pipeline.refine(lake, "purchases", trigger=pipeline.DRAIN)
    query.awaitTermination()
    assert query.lastProgress.numInputRows == 1 and {value for value, _ in read} == {"purchase"}


def test_a_bound_counts_the_commits_of_the_stream_s_own_type(spark, lake, tmp_path):
    """Purchases are in every third commit only. Bounded by one commit a batch, each batch has rows."""
    for k in range(9):
        kind = "purchase" if k % 3 == 0 else "page_view"
        rows = to_bronze(given.messages(spark, TINY)).where((F.col("event_type") == kind) & (F.col("offset") % 9 == k))
        lake.append(rows.withColumn("route", F.col("event_type")), "bronze", "raw_events", job="j", batch=k)
    query = pipeline.refine(lake, "purchases", trigger=pipeline.DRAIN, files=1)
    query.awaitTermination()
    batches = [p for p in query.recentProgress if p.numInputRows]
    assert len(batches) == 3
    added = lake.manifest("silver", "purchases").entries(-1, 2)
    assert len(added) == 3 and all(e["add"] for e in added) and [e["upto"] for e in added] == [0, 3, 6]


def test_one_query_reads_each_raw_event_once(spark, lake, tmp_path, monkeypatch):
    pipeline.drain(lake, _landed(spark, tmp_path, 4)(2), "ingestion")
    read = []
    real = Lake.rows_of
    monkeypatch.setattr(Lake, "rows_of", lambda self, layer, table, parts: read.extend(parts) or real(self, layer, table, parts))
    pipeline.drain(lake, job_type="processing", single=True, files=1)
    assert len(read) == len(set(read)) == sum(v != "other" for v, _ in lake.manifest("bronze", "raw_events").state().live)
    _silver_is_whole(spark, lake)


@pytest.mark.parametrize("single", [True, False])
def test_a_batch_that_dies_after_two_of_five_writes(spark, lake, tmp_path, monkeypatch, single):
    pipeline.drain(lake, _landed(spark, tmp_path)(), "ingestion")
    real = Lake.append_followed

    def dying(self, rows, layer, table, **span):
        if table not in ("page_views", "cart_events"):
            raise RuntimeError("died")
        return real(self, rows, layer, table, **span)

    with monkeypatch.context() as patched:
        patched.setattr(Lake, "append_followed", dying)
        with pytest.raises(Exception, match="died"):
            pipeline.drain(lake, job_type="processing", single=single)
    pipeline.drain(Lake(spark, lake.root, lake.prefix).create(), job_type="processing", single=single)
    _silver_is_whole(spark, lake)


# Where a batch can stop: before its files, before its entry, before the notes, before the catalog, before Spark's own commit.
STOPS = ["_write", "_parts", "append", "_announce", "_show", "_settle"]


@pytest.mark.parametrize("step", STOPS)
def test_stops_at_any_step_neither_lose_nor_repeat_rows(spark, lake, tmp_path, monkeypatch, step):
    """Each of the six streams dies at the step in its first batch, then all are started anew."""
    source = _landed(spark, tmp_path, 2)
    owner = Manifest if step == "append" else Lake
    real = getattr(owner, step)

    def dying(self, *args, **options):
        if dying.layer in (getattr(self, "folder", ""), *map(str, args)) or f"/{dying.layer}/" in getattr(self, "folder", ""):
            raise RuntimeError("died")
        return real(self, *args, **options)

    for dying.layer, job in (("bronze", "ingestion"), ("silver", "processing")):
        if (dying.layer, step) == ("silver", "_announce"):
            continue
        with monkeypatch.context() as patched:
            patched.setattr(owner, step, dying)
            with pytest.raises(Exception, match="died"):
                pipeline.drain(lake, source(1), job)
        pipeline.drain(Lake(spark, lake.root, lake.prefix).create(), source(1), job)
    pipeline.drain(lake, source(1))
    assert _same(lake.read("bronze", "raw_events").select(*TIMELESS), to_bronze(given.messages(spark, TINY)).select(*TIMELESS))
    _silver_is_whole(spark, lake)


def test_sealed_days_hold_the_same_rows(spark, lake, tmp_path):
    """Sealing makes few large files; readers, running streams and new ones see the rows they saw before."""
    source = _landed(spark, tmp_path, 5)
    pipeline.drain(lake, source(1), files=1)
    before = {t: lake.read("silver", t) for t in SILVER_EVENT}
    many = {t: len(before[t].inputFiles()) for t in SILVER_EVENT}
    assert lake.seal("bronze", "raw_events") == sorted([*SILVER_EVENT.values(), "other"])
    for table in SILVER_EVENT:
        sealed = lake.seal("silver", table, "2024-01-20")
        assert sealed and max(sealed) == "2024-01-19"
        assert lake.seal("silver", table, "2024-01-20") == []
    for table in SILVER_EVENT:
        after = lake.read("silver", table)
        assert len(after.inputFiles()) < many[table]
        assert _same(after, before[table])  # a reader that was open still finds its files
    opened = Lake(spark, lake.root, lake.prefix).create()
    pipeline.drain(opened, source(1))  # nothing is taken again
    _silver_is_whole(spark, opened)
    message_source.to_files(given.messages(spark, TINY).limit(50), str(tmp_path / "landing"))
    pipeline.drain(opened, source(1))
    assert opened.read("bronze", "raw_events").count() == given.messages(spark, TINY).count() + 50
    # Old files go, and a query that has never run reads the sealed ones.
    assert opened.vacuum("bronze", "raw_events") and opened.vacuum("silver", "purchases")
    copies = []
    opened.follow("bronze", "raw_events", lambda newest: copies.append(opened.added("bronze", "raw_events", None, newest)[0]), job="new", trigger=pipeline.DRAIN).awaitTermination()
    assert opened.rows_of("bronze", "raw_events", copies[-1]).count() == opened.read("bronze", "raw_events").count()


def test_sealing_that_stops_leaves_the_old_files(spark, lake, tmp_path, monkeypatch):
    pipeline.drain(lake, _landed(spark, tmp_path, 3)(1), files=1)
    for owner, method, sealed in ((Lake, "_parts", False), (Manifest, "append", False), (Lake, "_show", True)):
        with monkeypatch.context() as patched:
            patched.setattr(owner, method, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt()))
            with pytest.raises(KeyboardInterrupt):
                lake.seal("silver", "page_views")
        opened = Lake(spark, lake.root, lake.prefix).create()
        commits = {c for _, c in opened.manifest("silver", "page_views").state().live}
        assert any(c.startswith("sealed") for c in commits) == sealed
        assert _same(opened.read("silver", "page_views"), to_silver(to_bronze(given.messages(spark, TINY)), "page_views"))


def test_many_batches_keep_small_manifests(spark, lake):
    """Eighty batches: entries, notes and summaries are trimmed to what is kept, and silver misses nothing."""
    rows = to_bronze(given.messages(spark, TINY)).where("event_type = 'purchase'").limit(3)
    rows = spark.createDataFrame(rows.collect(), rows.schema).withColumn("route", F.lit("purchase")).coalesce(1)
    seen = to_bronze(given.messages(spark, TINY)).where("event_type = 'page_view'").limit(2)
    seen = spark.createDataFrame(seen.collect(), seen.schema).withColumn("route", F.lit("page_view")).coalesce(1)
    lake.append(seen, "bronze", "raw_events", job="k", batch=0)
    pipeline._take(lake, "page_views", 0)  # whose type then stays away for long
    for batch in range(80):
        lake.append(rows, "bronze", "raw_events", job="j", batch=batch)
        if batch % 20 == 19:
            lake.seal("bronze", "raw_events")
            pipeline._take(lake, "purchases", lake.manifest("bronze", "raw_events").state().version)
    lake.trim("bronze", "raw_events")
    store = Store(spark, lake.root)
    for folder in ("manifest", "notes/all", "notes/purchase"):
        assert len(store.list(f"{lake.path('bronze', 'raw_events')}/{folder}")) <= 2 * KEPT_ENTRIES
    assert len(lake.manifest("bronze", "raw_events").state().live) == 2
    assert lake.read("bronze", "raw_events").count() == 242
    lake.append(seen, "bronze", "raw_events", job="k", batch=1)
    pipeline._take(lake, "page_views", lake.manifest("bronze", "raw_events").state().version)
    assert lake.read("silver", "page_views").count() == 2 * to_silver(seen, "page_views").count()
    assert lake.read("silver", "purchases").count() == 80 * to_silver(rows, "purchases").count()


def test_job_types(spark, lake, messages_of, tmp_path):
    folder = str(tmp_path / "landing")
    message_source.to_files(messages_of(("k", "{}")), folder)
    source = lambda: message_source.from_files(spark, folder)
    for job_type, count, single in (("ingestion", 1, False), ("processing", 5, False), ("both", 6, False), ("both", 2, True)):
        queries = pipeline.start(lake, job_type, source(), single=single)
        assert len(queries) == count
        pipeline.stop(queries)
        assert not any(q.isActive for q in queries)
    with pytest.raises(ValueError, match="job type"):
        pipeline.start(lake, "sideways", source())
    with pytest.raises(ValueError, match="message stream"):
        pipeline.start(lake, "both")


def test_a_failed_start_stops_what_runs(spark, lake, messages_of, tmp_path, monkeypatch):
    folder = str(tmp_path / "landing")
    message_source.to_files(messages_of(("k", "{}")), folder)
    running, real = len(spark.streams.active), pipeline.refine

    def refine(lake, table, **options):
        if table == "user_sessions":
            raise RuntimeError("cannot start")
        return real(lake, table, **options)

    monkeypatch.setattr(pipeline, "refine", refine)
    with pytest.raises(RuntimeError, match="cannot start"):
        pipeline.start(lake, "both", message_source.from_files(spark, folder))
    assert len(spark.streams.active) == running


def test_waiting_notices_any_failure(spark, lake, messages_of, tmp_path):
    folder = str(tmp_path / "landing")
    message_source.to_files(messages_of(("k", "{}")), folder)
    source = message_source.from_files(spark, folder)
    healthy = pipeline.ingest(lake, source)
    failing = (
        source.select(F.raise_error(F.lit("broken row")).cast("string").alias("x"))
        .writeStream.format("noop")
        .option("checkpointLocation", str(tmp_path / "failing"))
        .start()
    )
    with pytest.raises(Exception, match="broken row"):
        pipeline.run_until_stopped(spark, [healthy, failing])
    assert not healthy.isActive
    with pytest.raises(Exception, match="broken row"):  # ended before the waiting began
        pipeline.run_until_stopped(spark, [failing])
