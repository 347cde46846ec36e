"""Landing, snapshots, tables, the watermark and streams."""

import gzip

import pytest

from veritally.operators.flatten import flatten_patient
from veritally.session import shared_dir
from veritally.sources import landing, tables, watermark
from veritally.sources.schemas import SILVER_COVERAGE, SILVER_PATIENT
from veritally.streaming import increments

TIME = "2025-11-12T12:10:07.068Z"


def json_lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_landing(spark, tmp_path):
    root = str(tmp_path)
    assert landing.read_ndjson(spark, root, "Patient", TIME) is None
    (tmp_path / "Patient" / TIME).mkdir(parents=True)
    assert landing.read_ndjson(spark, root, "Patient", TIME) is None
    # Files of a downloader, in a folder named by the time as it is; blank lines are skipped.
    (tmp_path / "Patient" / TIME / "a.ndjson").write_text('{"id": "1"}\n\n{"id": "2"}\n')
    (tmp_path / "Patient" / TIME / "a.tmp").write_text("no json")
    assert landing.read_ndjson(spark, root, "Patient", TIME).count() == 2


def test_malformed_lines(spark, tmp_path):
    landing.land_ndjson(json_lines(spark, '{"id": "1"}', "{broken"), str(tmp_path), "Patient", TIME)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        landing.read_ndjson(spark, str(tmp_path), "Patient", TIME).collect()
    lenient = landing.read_ndjson(spark, str(tmp_path), "Patient", TIME, strict=False)
    assert {(r["id"], r[landing.CORRUPT]) for r in lenient.collect()} == {("1", None), (None, "{broken")}
    assert flatten_patient(lenient).count() == 2


def test_landing_again_replaces(spark, tmp_path):
    root = str(tmp_path)
    for _ in range(3):
        landing.land_ndjson(json_lines(spark, '{"id": "1"}', '{"id": "2"}'), root, "Patient", TIME, 1)
    assert landing.read_ndjson(spark, root, "Patient", TIME).count() == 2


def test_landed_lines_are_compressed(spark, tmp_path, monkeypatch):
    """Landed records take a fraction of their JSON, a task's lines go to several files, and all are read."""
    root, text = str(tmp_path), '{"id": "%d", "gender": "female", "meta": {"lastUpdated": "2024-01-15T08:30:00Z"}}'
    lines = json_lines(spark, *[text % i for i in range(3000)]).coalesce(1)
    monkeypatch.setattr(landing, "LINES_PER_FILE", 1000)
    landing.land_ndjson(lines, root, "Patient", TIME)
    (folder,) = (tmp_path / "Patient").iterdir()
    sizes = [f.stat().st_size for f in folder.iterdir() if not f.name.startswith((".", "_"))]
    assert len(sizes) == 3 and 0 < sum(sizes) < 3000 * len(text) / 5
    found = landing.read_ndjson(spark, root, "Patient", TIME)
    assert sorted(int(r["id"]) for r in found.collect()) == list(range(3000))
    state = landing.landed_state(spark, root, "Patient", TIME)
    assert state
    # Downloads may be compressed or not.
    (folder / "b.ndjson").write_text(text % 3000)
    (folder / "c.ndjson.gz").write_bytes(gzip.compress((text % 3001).encode()))
    assert landing.read_ndjson(spark, root, "Patient", TIME).count() == 3002
    assert landing.landed_state(spark, root, "Patient", TIME) != state


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    landing.land_ndjson(json_lines(spark, '{"id": "1"}'), f"{root}/bronze", "Patient", TIME)
    flat = flatten_patient(landing.read_ndjson(spark, f"{root}/bronze", "Patient", TIME))
    for time in (TIME, "2025-12-01"):
        tables.write_snapshot(flat, f"{root}/silver", "Patient", time)
    read = lambda time=None: tables.read_snapshots(spark, f"{root}/silver", "Patient", SILVER_PATIENT, time)
    assert read(TIME).count() == 1 and read().count() == 2
    assert {r["transaction_time"] for r in read().collect()} == {TIME, "2025-12-01"}
    # An empty snapshot replaces its own time only.
    tables.write_snapshot(flat.limit(0), f"{root}/silver", "Patient", TIME)
    assert read(TIME).count() == 0 and read().count() == 1


def test_sparse_columns_keep_their_type(spark, tmp_path):
    empty = spark.createDataFrame([(None,) * len(SILVER_COVERAGE)], SILVER_COVERAGE)
    path = tables.write_snapshot(empty, str(tmp_path), "Coverage", TIME)
    loaded = tables.load_table(spark, path, "sparse_coverage", SILVER_COVERAGE, str(tmp_path / "t"))
    assert set(dict(loaded.dtypes).values()) == {"string"}
    assert loaded.selectExpr("cast(period_start as date)").first()[0] is None


def test_loading_truncates(spark, tmp_path):
    place = str(tmp_path / "t")
    for n in (5, 3):
        spark.range(n).write.mode("overwrite").parquet(f"{tmp_path}/in/part_{n}")
        loaded = tables.load_table(spark, f"{tmp_path}/in/part_{n}*", "truncated", location=place)
        assert loaded.count() == n


def test_watermark(spark, tmp_path):
    path = str(tmp_path / "watermark")
    assert watermark.read_watermark(spark, path) is None
    watermark.write_watermark(spark, path, " ")
    assert watermark.read_watermark(spark, path) is None
    watermark.write_watermark(spark, path, TIME)
    watermark.write_watermark(spark, path, "")
    assert watermark.read_watermark(spark, path) == TIME
    rows = spark.createDataFrame([("2025-11-12T12:10:07.068Z",), ("2025-12",)], "t string")
    assert watermark.since_watermark(rows, "t", TIME).count() == 1
    assert watermark.since_watermark(rows, "t", None).count() == 2


def test_stream_picks_up_where_it_stopped(spark, tmp_path):
    root = str(tmp_path)
    run = lambda: increments.stream_resource(
        spark, f"{root}/bronze", "Patient", f"{root}/silver", f"{root}/checkpoint", 1
    ).awaitTermination()
    read = lambda: increments.read_batches(spark, f"{root}/silver/Patient", SILVER_PATIENT)
    landing.land_ndjson(json_lines(spark, '{"id": "1"}'), f"{root}/bronze", "Patient", "a")
    run()
    run()
    assert read().count() == 1
    landing.land_ndjson(json_lines(spark, '{"id": "2"}'), f"{root}/bronze", "Patient", "b")
    run()
    assert sorted(r["patient_id"] for r in read().collect()) == ["1", "2"]


def test_merge_modes(spark, rows):
    make = lambda *r: spark.createDataFrame(list(r), "id string, last_updated string, x int")
    current = make(("a", "1", 1), ("b", "1", 1))
    increment = make(("b", "2", 2), ("c", None, 3))
    merged = increments.merge_increment(current, increment, ["id"], mode="upsert")
    assert rows(merged) == [("a", "1", 1), ("b", "2", 2), ("c", None, 3)]
    assert rows(increments.merge_increment(current, increment, ["id"])) == rows(increment)
    with pytest.raises(ValueError):
        increments.merge_increment(current, increment, ["id"], mode="other")


class Session:
    """The part of a session that tells where intermediate results go."""

    def __init__(self, master, **settings):
        self.conf, self.master, self.sparkContext, self.folder = settings, master, self, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"{folder}/some-id"


def test_shared_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured.rstrip("/")
    assert shared_dir(Session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    with pytest.raises(ValueError):
        shared_dir(Session("yarn"))
    with pytest.raises(ValueError):
        shared_dir(Session("local-cluster[2,1,1024]"))
    local = Session("local[2]")
    assert shared_dir(local) == shared_dir(local) == local.folder
