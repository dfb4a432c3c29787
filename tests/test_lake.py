import pytest
from conftest import TINY
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemart import workspace
from tidemart.schemas import RAW_EVENTS, SILVER_EVENT, silver_schema
from tidemart.sources import given
from tidemart.sources import messages as message_source
from tidemart.sources.commits import Manifest
from tidemart.sources.files import Store
from tidemart.sources.lake import Lake
from tidemart.streaming import pipeline


@pytest.fixture
def filled(spark, lake, tmp_path):
    folder = str(tmp_path / "landing")
    message_source.to_files(given.messages(spark, TINY), folder)
    pipeline.drain(lake, message_source.from_files(spark, folder))
    return lake


def test_definition(spark, lake):
    lake.create()  # a second time changes nothing
    assert lake.tables("silver") == sorted(SILVER_EVENT)
    assert lake.read("bronze", "raw_events").columns == RAW_EVENTS.names
    for table in SILVER_EVENT:
        rows = lake.read("silver", table)
        assert rows.isEmpty()
        wanted = [(f.name, f.dataType.simpleString()) for f in silver_schema(table)]
        assert [(f.name, f.dataType.simpleString()) for f in rows.schema] == wanted


def test_day_bound_prunes_folders(filled):
    rows = filled.read("silver", "page_views", "2024-01-29")
    assert 0 < rows.count() == filled.read("silver", "page_views").where("timestamp >= '2024-01-29'").count()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(timestamp,2024-01-29" in plan


def test_rows_without_time_are_kept(filled):
    assert filled.read("silver", "page_views").where("timestamp IS NULL").count() > 0
    assert filled.read("silver", "page_views", "1970-01-01").where("timestamp IS NULL").count() == 0


def test_counts_by_sql(spark, filled):
    name = filled.name("silver", "purchases")
    by_sql = spark.sql(f"SELECT count(*) AS n FROM {name}").first().n
    inventory = {r.table_name: r.row_count for r in filled.inventory().collect()}
    assert inventory["purchases"] == by_sql > 0
    assert set(inventory) == set(SILVER_EVENT)


def _days(spark, *days, value=1):
    rows = spark.createDataFrame([(d, value) for d in days], "date string, value int")
    return rows.withColumn("date", F.col("date").cast("date"))


def _content(lake):
    return sorted((str(r.date), r.value) for r in lake.read("gold", "t").collect())


def test_overwrite_modes(spark, lake):
    lake.overwrite_gold(_days(spark, "2024-01-01", "2024-01-02"), "t", "dynamic")
    assert _content(lake) == [("2024-01-01", 1), ("2024-01-02", 1)]
    lake.overwrite_gold(_days(spark, "2024-01-02", "2024-01-03", value=2), "t", "dynamic")
    assert _content(lake) == [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 2)]
    lake.overwrite_gold(_days(spark, "2024-01-04", value=3), "t", "replace")
    assert _content(lake) == [("2024-01-04", 3)]
    with pytest.raises(ValueError, match="write mode"):
        lake.overwrite_gold(_days(spark, "2024-01-04"), "t", "sideways")


def test_failed_overwrite_leaves_the_table(spark, lake):
    lake.overwrite_gold(_days(spark, "2024-01-01"), "t")
    failing = _days(spark, "2024-01-02").withColumn(
        "value", F.raise_error(F.concat(F.lit("broken"), F.col("value"))).cast("int")
    )
    for mode in ("replace", "dynamic"):
        with pytest.raises(Exception, match="broken"):
            lake.overwrite_gold(failing, "t", mode)
        assert _content(lake) == [("2024-01-01", 1)]


def test_forgotten_gold_tables_are_found_again(spark, lake):
    lake.overwrite_gold(_days(spark, "2024-01-01"), "t")
    lake.overwrite_gold(_days(spark, "2024-01-02", value=2), "t")
    spark.sql(f"DROP VIEW {lake.name('gold', 't')}")
    opened = Lake(spark, lake.root, lake.prefix).create()
    opened.overwrite_gold(_days(spark, "2024-01-03", value=3), "t", "dynamic")
    assert _content(opened) == [("2024-01-02", 2), ("2024-01-03", 3)]


def _by_name(spark, lake):
    return sorted((str(r.date), r.value) for r in spark.sql(f"SELECT date, value FROM {lake.name('gold', 't')}").collect())


def _stopping(monkeypatch, owner, method, when):
    """From now on the method stops the run when its arguments are like that."""
    real = getattr(owner, method)

    def stops(self, *args, **options):
        if when(*args):
            raise KeyboardInterrupt
        return real(self, *args, **options)

    monkeypatch.setattr(owner, method, stops)


# Where an overwrite can stop, in order; from the second on its version is logged.
STEPS = [
    (Lake, "_parts", lambda *a: True),
    (Manifest, "append", lambda *a: True),
    (Lake, "_show", lambda *a: True),
    (SparkSession, "sql", lambda q, *a: q.startswith("CREATE TABLE") and "gold_files" in q),
    (SparkSession, "sql", lambda q, *a: q.startswith("ALTER TABLE")),
    (SparkSession, "sql", lambda q, *a: q.startswith("CREATE OR REPLACE VIEW")),
]


@pytest.mark.parametrize("mode", ["replace", "dynamic"])
def test_overwrite_shows_old_or_new_rows_wherever_it_stops(spark, lake, monkeypatch, mode):
    lake.overwrite_gold(_days(spark, "2024-01-01", "2024-01-02"), "t")
    old = [("2024-01-01", 1), ("2024-01-02", 1)]
    for k, (owner, method, when) in enumerate(STEPS):
        value = 10 + k
        new = [("2024-01-02", value)] if mode == "replace" else [("2024-01-01", 1), ("2024-01-02", value)]
        with monkeypatch.context() as patched:
            _stopping(patched, owner, method, when)
            with pytest.raises(KeyboardInterrupt):
                lake.overwrite_gold(_days(spark, "2024-01-02", value=value), "t", mode)
        assert _by_name(spark, lake) == old
        assert lake.tables("gold") == ["t"]
        # Once logged, the version is what a lake opened anew shows, by either way.
        logged = k >= 2
        opened = Lake(spark, lake.root, lake.prefix).create()
        assert _content(opened) == _by_name(spark, opened) == (new if logged else old)
        old = new if logged else old
    lake.overwrite_gold(_days(spark, "2024-01-02", "2024-01-03", value=3), "t", "dynamic")
    assert _content(lake)[-2:] == [("2024-01-02", 3), ("2024-01-03", 3)]


def test_readers_of_an_old_version_are_not_disturbed(spark, lake):
    """A dynamic overwrite adds folders; those a reader has open stay as they are."""
    lake.overwrite_gold(_days(spark, "2024-01-01", "2024-01-02"), "t")
    before = lake.read("gold", "t")
    files = set(before.inputFiles())
    lake.overwrite_gold(_days(spark, "2024-01-02", value=2), "t", "dynamic")
    assert sorted((str(r.date), r.value) for r in before.collect()) == [("2024-01-01", 1), ("2024-01-02", 1)]
    assert len(files & set(lake.read("gold", "t").inputFiles())) == 1


def test_two_overwrites_at_once_both_take_effect(spark, lake, monkeypatch):
    """Another run's version comes in while this one writes: the next is decided from what that left."""
    lake.overwrite_gold(_days(spark, "2024-01-01", "2024-01-02", "2024-01-03"), "t")
    real, other = Manifest.append, Lake(spark, lake.root, lake.prefix)

    def late(self, make):
        monkeypatch.setattr(Manifest, "append", real)
        other.overwrite_gold(_days(spark, "2024-01-02", value=2), "t", "dynamic")
        return real(self, make)

    monkeypatch.setattr(Manifest, "append", late)
    lake.overwrite_gold(_days(spark, "2024-01-03", value=3), "t", "dynamic")
    assert _content(lake) == [("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)]


def test_only_one_gets_a_number(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert store.create(f"{tmp_path}/x", "first") and not store.create(f"{tmp_path}/x", "second")
    assert store.read(f"{tmp_path}/x") == "first"
    assert [n for n in store.list(str(tmp_path)) if not n.endswith(".crc")] == ["x"]


def test_manifest_stays_small(spark, tmp_path):
    """Two hundred entries, a follower behind by fifty: what is kept is bounded, and adds up to the same."""
    manifest, live = Manifest(spark, str(tmp_path / "m")), []
    for k in range(200):
        entry = {"add": [[f"v{k % 3}", f"c{k}"]], "job": ["j", k]}
        live.append((f"v{k % 3}", f"c{k}"))
        if k % 20 == 19:  # a seal
            entry |= {"drop": live[:-1], "same": True, "generation": f"g{k}"}
            live = live[-1:]
        assert manifest.append(lambda state, e=entry: e) == k
        if k % 10 == 9:
            manifest.trim(8, passed=k - 50 if 100 < k < 160 else None)
            opened = Manifest(spark, manifest.folder).state()
            assert opened.live == live == manifest.state().live and opened.jobs == {"j": k}
            assert len(Store(spark, manifest.folder).list(manifest.folder)) <= (62 if 100 < k < 160 else 12)
    assert [e["version"] for e in manifest.entries(195, 199)] == [196, 197, 198, 199]
    with pytest.raises(LookupError, match="no longer kept"):
        manifest.entries(150, 199)
    assert [s.version for s in manifest.history()] == list(range(191, 200))
    assert manifest.history()[-1].live == live


def test_vacuum_keeps_what_is_shown(spark, lake):
    for value in range(4):
        lake.overwrite_gold(_days(spark, "2024-01-01", value=value), "t")
    assert len(lake.vacuum_gold("t", 2)) == 2
    assert _content(lake) == [("2024-01-01", 3)]
    assert len(lake.tables("gold_files")) == 2
    assert lake.vacuum_gold("t", 2) == [] == lake.vacuum_gold("never_written", 1)
    with pytest.raises(ValueError, match="at least one"):
        lake.vacuum_gold("t", 0)


def test_vacuum_leaves_running_writes_alone(spark, lake, monkeypatch):
    lake.overwrite_gold(_days(spark, "2024-01-01"), "t")
    real, seen = Manifest.append, []

    def meanwhile(self, make):
        seen.append(Lake(spark, lake.root, lake.prefix).vacuum_gold("t", 1))
        return real(self, make)

    with monkeypatch.context() as patched:
        patched.setattr(Manifest, "append", meanwhile)
        lake.overwrite_gold(_days(spark, "2024-01-02", value=2), "t")
    assert seen == [[]] and _content(lake) == [("2024-01-02", 2)]
    # What a run left that never came to its entry goes once it is old enough.
    with monkeypatch.context() as patched:
        _stopping(patched, Manifest, "append", lambda *a: True)
        with pytest.raises(KeyboardInterrupt):
            lake.overwrite_gold(_days(spark, "2024-01-03"), "t")
    assert len(lake.vacuum("gold", "t", 2)) == 0
    assert len(lake.vacuum("gold", "t", 2, left_alone=-1.0)) == 1
    assert len(lake.vacuum("gold", "t", 1)) == 1 and _content(lake) == [("2024-01-02", 2)]


def test_streams_add_few_files(spark, lake, tmp_path):
    """Eight input files over thirty days: a batch adds at most a few files to each folder."""
    folder = str(tmp_path / "landing")
    message_source.to_files(given.messages(spark, TINY).repartition(8), folder)
    pipeline.drain(lake, message_source.from_files(spark, folder))
    for layer, table in (("bronze", "raw_events"), ("silver", "page_views")):
        files = lake.read(layer, table).inputFiles()
        folders = {f.rsplit("/", 1)[0] for f in files}
        assert len(files) <= 2 * len(folders)


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert workspace.shared_root(spark) == named
    first, second = (workspace.fresh_folder(spark, "x") for _ in range(2))
    assert first != second and first.startswith(f"{named}/x-")


def test_no_shared_folder_on_a_cluster_is_an_error():
    class Context:
        master, applicationId = "spark://somewhere:7077", "a"

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_root(Session())


def test_counts_read_no_column(filled):
    """Counting rows reads the files' footers: no column is asked for."""
    plan = filled.inventory("silver")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<>") == len(SILVER_EVENT)
