"""Loads that fail half way, run twice or come late: nothing is lost, nothing is repeated, untouched files stay."""

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from veritally.operators.latest import upsert
from veritally.plans import build as plans
from veritally.sources import files, landing, tables, versions, watermark
from veritally.sources.commits import CommitConflict, CommitLog
from veritally.sources.keyed import KeyedTable
from veritally.streaming import increments

FIRST, SECOND, THIRD = "2025-01-01T00:00:00Z", "2025-02-01T00:00:00Z", "2025-03-01T00:00:00Z"


def failing(df):
    """``df`` with a column that ends the job at its last row."""
    return df.withColumn("v", F.when(F.col("k") >= 0, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("string"))


# ---- commits and versions ----


def test_commit_log(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log")
    assert log.numbers() == [] and log.latest() is None
    log.append(0, {"a": 1})
    log.append(10, {"a": "é"})
    log.append(9, {"a": 3})
    assert log.numbers() == [0, 9, 10] and log.latest() == (10, {"a": "é"})
    with pytest.raises(CommitConflict):
        log.append(10, {"a": 4})
    assert log.latest() == (10, {"a": "é"})
    assert sorted(p.name for p in (tmp_path / "log").iterdir() if p.suffix == ".tmp") == []
    assert log.expire(2) == [{"a": 3}, {"a": "é"}] and log.numbers() == [9, 10]
    assert log.expire(0) == [{"a": "é"}]


def test_a_failed_replacement_leaves_the_table(spark, tmp_path, rows):
    place = f"{tmp_path}/t"
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    opened = tables.save_table(one, "commits_t", place)
    with pytest.raises(Exception, match="lost"):
        tables.save_table(failing(spark.table("commits_t")), "commits_t", place)
    assert rows(spark.table("commits_t")) == rows(opened) == [(1, "a"), (2, "b")]
    # From itself, then with other columns; who has an old version open keeps it.
    tables.save_table(spark.table("commits_t").filter("k = 1"), "commits_t", place)
    assert rows(tables.open_table(spark, "commits_t", place)) == [(1, "a")]
    tables.save_table(spark.range(3), "commits_t", place)
    assert rows(spark.table("commits_t")) == [(0,), (1,), (2,)]
    old = versions.read_current(spark, place)
    versions.publish(one.limit(0), place)
    assert rows(old) == [(0,), (1,), (2,)]
    # The pointer in the log counts, also where the catalog was not switched any more.
    assert tables.open_table(spark, "commits_t", place).count() == 0
    assert versions.vacuum(spark, place, keep=1) and versions.read_current(spark, place).columns == ["k", "v"]
    assert len([p for p in (tmp_path / "t").iterdir() if not p.name.startswith("_")]) == 1
    with pytest.raises(FileNotFoundError):
        tables.open_table(spark, "never", f"{tmp_path}/never")


def test_rows_of_a_load_are_logged(spark, tmp_path, caplog):
    spark.range(17).write.parquet(f"{tmp_path}/in")
    with caplog.at_level("INFO"):
        tables.load_table(spark, f"{tmp_path}/in", "counted", location=f"{tmp_path}/t")
    assert "table counted: 17 rows" in caplog.text
    assert versions.log_of(spark, f"{tmp_path}/t").latest()[1]["rows"] == 17


def test_tables_without_a_location(spark, rows):
    assert rows(tables.save_table(spark.range(2), "placed_by_name")) == [(0,), (1,)]
    assert rows(tables.save_table(spark.range(1), "placed_by_name")) == [(0,)]
    files.remove(spark, tables.table_location(spark, "placed_by_name"))
    spark.sql("DROP TABLE placed_by_name")


# ---- keyed tables ----


def stored_files(place):
    return {str(p.relative_to(place)): p.stat().st_mtime_ns for p in Path(place).rglob("*.parquet")}


def make(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, at int, v string")


def test_an_upsert_rewrites_only_its_buckets(spark, tmp_path, rows):
    place = f"{tmp_path}/t"
    table = KeyedTable(spark, place, ["k"], "at", buckets=32)
    first = make(spark, *[(k, 5, "old") for k in range(500)], (None, 5, "old"))
    assert table.version() is None and table.replace(first) == 0
    before, folders = stored_files(place), table.entry()["folders"]
    increment = make(spark, (3, 6, "new"), (3, 7, "newer"), (4, 1, "late"), (None, 6, "new"), (900, 1, "added"))
    assert table.upsert(increment) == 1
    after, now = stored_files(place), table.entry()["folders"]
    assert {name: after[name] for name in before} == before
    changed = [b for b, (x, y) in enumerate(zip(folders, now, strict=True)) if x != y]
    assert 1 <= len(changed) <= 4
    assert rows(table.read()) == rows(upsert(first, increment, ["k"], "at"))
    assert rows(table.read(version=0)) == rows(first)
    # Buckets hold their keys and no others.
    some = table.read(buckets=changed)
    assert {r["k"] for r in some.collect()} >= {3, 4, None, 900} and some.count() < 150
    # Nothing new: nothing written.
    assert table.upsert(increment.limit(0)) == 2 and stored_files(place) == after
    assert table.entry()["folders"] == now


def test_an_upsert_may_start_from_an_earlier_version(spark, tmp_path, rows):
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], "at", buckets=4)
    table.upsert(make(spark, (1, 1, "a"), (2, 1, "a")))
    table.upsert(make(spark, (1, 2, "wrong"), (3, 2, "wrong")))
    table.upsert(make(spark, (1, 2, "right")), version=0)
    assert rows(table.read()) == [(1, 2, "right"), (2, 1, "a")]
    with pytest.raises(ValueError, match="columns"):
        table.upsert(spark.createDataFrame([(1, 2)], "k int, at int"))
    with pytest.raises(ValueError, match="keys"):
        KeyedTable(spark, f"{tmp_path}/t", ["at"]).read()
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, f"{tmp_path}/none", ["k"]).read()


def test_a_failed_upsert_changes_nothing(spark, tmp_path, rows):
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], "at", buckets=4)
    table.replace(make(spark, (1, 1, "a"), (2, 1, "b")))
    with pytest.raises(Exception, match="lost"):
        table.upsert(failing(make(spark, (1, 2, "x"))).select("k", "at", "v"))
    assert table.version() == 0 and rows(table.read()) == [(1, 1, "a"), (2, 1, "b")]
    # The data were written, but another writer has committed the number first.
    rival = KeyedTable(spark, f"{tmp_path}/t", ["k"], "at")
    commit = table._commit
    table._commit = lambda *a: (rival.upsert(make(spark, (9, 9, "rival"))), commit(*a))[1]
    with pytest.raises(CommitConflict):
        table.upsert(make(spark, (1, 2, "x")))
    assert rows(table.read()) == [(1, 1, "a"), (2, 1, "b"), (9, 9, "rival")]


def test_vacuum_keeps_what_commits_name(spark, tmp_path, rows):
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], "at", buckets=4)
    table.replace(make(spark, *[(k, 1, "a") for k in range(40)]))
    for at in (2, 3):
        table.upsert(make(spark, (7, at, "b")))
    whole = rows(table.read())
    assert table.vacuum(keep=1)
    assert rows(table.read()) == whole and len(table.log.numbers()) == 1
    assert len(stored_files(f"{tmp_path}/t")) == 4


def test_empty_tables(spark, tmp_path, rows):
    table = KeyedTable(spark, f"{tmp_path}/t", ["k"], "at", buckets=4)
    table.replace(make(spark, (1, 1, "a")).limit(0))
    assert table.read().columns == ["k", "at", "v"] and table.read().count() == 0
    table.upsert(make(spark, (1, 1, "a")))
    assert rows(table.read()) == [(1, 1, "a")]


# ---- loads ----


def land(spark, root, time, **resources):
    for resource, texts in resources.items():
        lines = spark.createDataFrame([(t,) for t in texts], "value string")
        landing.land_ndjson(lines, f"{root}/bronze", resource, time)


def patient(number, updated, gender="female"):
    return f'{{"id": "{number}", "gender": "{gender}", "meta": {{"lastUpdated": "{updated}"}}}}'


@pytest.fixture
def loads(spark, tmp_path):
    root = str(tmp_path)
    land(
        spark, root, FIRST, Patient=[patient(n, FIRST) for n in range(20)],
        Coverage=['{"id": "c1", "meta": {"lastUpdated": "x"}}'], ExplanationOfBenefit=['{"id": "e1"}'],
    )
    folders = (f"{root}/bronze", f"{root}/silver", f"{root}/marts")
    return root, folders, lambda time: plans.build_increment(spark, *folders, time)


def genders(models):
    return {r["patient_id"]: r["gender"] for r in models["dim_patient"].collect()}


def test_increments_touch_only_what_changed(spark, loads):
    root, folders, load = loads
    assert set(genders(load(FIRST)).values()) == {"female"}
    claims = stored_files(f"{root}/silver/ExplanationOfBenefit")
    land(spark, root, SECOND, Patient=[patient(3, SECOND, "male"), patient(99, SECOND)])
    found = genders(load(SECOND))
    assert found["3"] == "male" and len(found) == 21
    assert stored_files(f"{root}/silver/ExplanationOfBenefit") == claims
    log = watermark.last_load(spark, f"{root}/silver/{plans.LOADS}")[1]
    assert log["transaction_time"] == SECOND and log["silver"] == {"Patient": 1, "Coverage": 0, "ExplanationOfBenefit": 0}


def test_the_same_time_again(spark, loads):
    root, folders, load = loads
    load(FIRST)
    land(spark, root, SECOND, Patient=[patient(3, SECOND, "male"), patient(4, SECOND, "male")])
    first, number = genders(load(SECOND)), watermark.last_load(spark, f"{root}/silver/{plans.LOADS}")[0]
    assert genders(load(SECOND)) == first
    assert watermark.last_load(spark, f"{root}/silver/{plans.LOADS}")[0] == number
    # What has landed under this time is replaced: so is the load.
    land(spark, root, SECOND, Patient=[patient(5, SECOND, "male")])
    again = genders(load(SECOND))
    assert again["3"] == "female" and again["5"] == "male" and len(again) == 20


def test_the_past_is_refused(spark, loads):
    root, folders, load = loads
    load(FIRST)
    land(spark, root, "2024-06-01", Patient=[patient(1, "2024-06-01", "male")])
    for run in (load, lambda time: plans.build(spark, *folders, time)):
        with pytest.raises(watermark.LoadInThePast):
            run("2024-06-01")
    assert set(genders(plans.stored_models(spark, folders[1], folders[2])).values()) == {"female"}


def test_a_lost_log_is_noticed(spark, loads):
    root, folders, load = loads
    load(FIRST)
    shutil.rmtree(f"{root}/silver/{plans.LOADS}")
    land(spark, root, SECOND, Patient=[patient(3, SECOND, "male")])
    with pytest.raises(FileNotFoundError, match="log of its loads"):
        load(SECOND)


def test_a_load_that_fails_half_way(spark, loads, monkeypatch):
    root, folders, load = loads
    keep = plans.save_models

    def lost(*_):
        raise RuntimeError("lost")

    # The first load: it is simply done again.
    monkeypatch.setattr(plans, "save_models", lost)
    with pytest.raises(RuntimeError):
        load(FIRST)
    monkeypatch.setattr(plans, "save_models", keep)
    assert len(genders(load(FIRST))) == 20
    # An increment: silver has a version that no load names, and readers do not see it.
    land(spark, root, SECOND, Patient=[patient(3, SECOND, "male")])
    monkeypatch.setattr(plans, "save_models", lost)
    with pytest.raises(RuntimeError):
        load(SECOND)
    silver = plans.read_silver(spark, folders[1])["Patient"]
    assert {r["gender"] for r in silver.collect()} == {"female"}
    # Other records land before it is done again: nothing of the failed run remains.
    land(spark, root, SECOND, Patient=[patient(4, SECOND, "male")])
    monkeypatch.setattr(plans, "save_models", keep)
    found = genders(load(SECOND))
    assert found["3"] == "female" and found["4"] == "male"


def test_times_are_compared_as_moments():
    order = ["2024-01-01", "2025-01-01T00:00:00Z", "2025-01-01T00:00:00.068Z", "2025-01-01T01:30:00+01:00", "2025-01-01T01:00:00Z"]
    assert sorted(reversed(order), key=watermark.moment) == order


# ---- batches of a stream ----


def stream_of(spark, root, keys=("patient_id",)):
    return increments.write_batches(
        increments.stream_ndjson(spark, f"{root}/bronze/Patient", plans.landing.RESOURCES["Patient"], 1),
        f"{root}/silver", f"{root}/checkpoint", plans.FLATTEN["Patient"], keys, fan_in=3,
    )


def land_files(root, start, count):
    folder = Path(root) / "bronze" / "Patient" / "t"
    folder.mkdir(parents=True, exist_ok=True)
    for n in range(start, start + count):
        (folder / f"{n:03}.ndjson").write_text(patient(n % 5, f"2025-01-{n:02}") + "\n" + patient(100 + n, "x") + "\n")


def test_parts_stay_few(spark, tmp_path, rows):
    root = str(tmp_path)
    land_files(root, 1, 14)
    stream_of(spark, root).awaitTermination()
    parts = increments.parts_of(spark, f"{root}/silver")
    assert [p["level"] for p in parts] == [2, 1, 0, 0]
    assert sum(p["rows"] for p in parts) < 28
    found = rows(increments.read_batches(spark, f"{root}/silver", keys=["patient_id"]).select("patient_id", "last_updated"))
    latest = {str(n % 5): f"2025-01-{n:02}" for n in range(1, 15)} | {str(100 + n): "x" for n in range(1, 15)}
    assert dict(found) == latest and len(found) == len(latest)
    assert increments.vacuum_batches(spark, f"{root}/silver", keep=1)
    assert rows(increments.read_batches(spark, f"{root}/silver", keys=["patient_id"]).select("patient_id", "last_updated")) == found


def test_a_restart_in_the_middle_of_a_merge(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    land_files(root, 1, 2)
    stream_of(spark, root, ()).awaitTermination()
    land_files(root, 3, 1)
    write = increments.counted_write

    def lost(df, path, *more):
        done = write(df, path, *more)
        if "level-1" in path:
            raise RuntimeError("lost after the merged part was written")
        return done

    monkeypatch.setattr(increments, "counted_write", lost)
    with pytest.raises(Exception, match="lost"):
        stream_of(spark, root, ()).awaitTermination()
    monkeypatch.setattr(increments, "counted_write", write)
    assert increments.read_batches(spark, f"{root}/silver").count() == 4
    stream_of(spark, root, ()).awaitTermination()
    assert increments.read_batches(spark, f"{root}/silver").count() == 6
    assert [p["level"] for p in increments.parts_of(spark, f"{root}/silver")] == [1]


def test_a_committed_batch_is_not_written_again(spark, tmp_path):
    root = str(tmp_path)
    land_files(root, 1, 2)
    stream_of(spark, root, ()).awaitTermination()
    # The checkpoint forgets the last batch, as if the job had been lost between the two commits.
    for name in ("1", ".1.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink()
    land_files(root, 3, 1)
    stream_of(spark, root, ()).awaitTermination()
    assert increments.read_batches(spark, f"{root}/silver").count() == 6
    shutil.rmtree(tmp_path / "checkpoint")
    with pytest.raises(Exception, match="another stream"):
        stream_of(spark, root, ()).awaitTermination()


def test_a_batch_that_completes_levels_is_written_once(spark, tmp_path, rows):
    root = str(tmp_path)
    land_files(root, 1, 9)
    stream_of(spark, root).awaitTermination()
    assert [p["level"] for p in increments.parts_of(spark, f"{root}/silver")] == [2]
    folders = sorted(p.name[:7] for p in (tmp_path / "silver").iterdir() if p.name.startswith("level"))
    assert folders == ["level-0"] * 6 + ["level-1"] * 2 + ["level-2"]
    latest = {str(n % 5): f"2025-01-{n:02}" for n in range(1, 10)} | {str(100 + n): "x" for n in range(1, 10)}
    found = rows(increments.read_batches(spark, f"{root}/silver").select("patient_id", "last_updated"))
    assert dict(found) == latest and len(found) == len(latest)


def test_a_compressed_file_is_parsed_by_all_cores(spark, tmp_path, rows):
    root, kinds = str(tmp_path), plans.landing.RESOURCES["Patient"]
    lines = spark.range(4000).select(F.format_string('{"id": "%d", "gender": "female"}', "id")).coalesce(1)
    landing.land_ndjson(lines, f"{root}/bronze", "Patient", "t", lines_per_file=-1)
    assert len([f for f in (tmp_path / "bronze" / "Patient" / "t").iterdir() if f.name.endswith(".gz")]) == 1
    found = {}
    for spread in (False, True):
        path = f"{root}/{spread}"
        stream = increments.stream_ndjson(spark, f"{root}/bronze", kinds, 1, spread=spread)
        increments.write_batches(stream, f"{path}/silver", f"{path}/checkpoint").awaitTermination()
        (part,) = increments.parts_of(spark, f"{path}/silver")
        parts = [f for f in (Path(path) / "silver" / part["folder"]).iterdir() if f.name.endswith(".parquet")]
        assert part["rows"] == 4000 and len(parts) == (spark.sparkContext.defaultParallelism if spread else 1)
        found[spread] = rows(increments.read_batches(spark, f"{path}/silver"))
    assert found[True] == found[False]


def test_lines_are_parsed_as_the_reader_does(spark, tmp_path, rows):
    kinds = plans.landing.RESOURCES["Patient"]
    odd = ['{"id": "é", "deceasedBoolean": true}', "", " \t ", '[{"id": "2"}, {"gender": "x"}]', "[]", ' {"id": 5}', "{}", '{"id": null, "z": 1}']
    (tmp_path / "odd.ndjson").write_bytes("\r\n".join(odd).encode())
    read = lambda name: spark.read.schema(kinds).option("mode", "FAILFAST").json(f"{tmp_path}/{name}.ndjson")
    parse = lambda name: increments.parse_lines(spark.read.text(f"{tmp_path}/{name}.ndjson"), kinds)
    assert rows(parse("odd")) == rows(read("odd")) and len(rows(parse("odd"))) == 6
    for n, bad in enumerate((b'{"id": "1"', b"null", b"3", b"[null]", b'[{"id": "1"]', b"[[]]", b'{"id": "\xff"}', b'{"meta": "x"}', b"x")):
        (tmp_path / f"bad{n}.ndjson").write_bytes(b'{"id": "1"}\n' + bad + b"\n")
        for how in (read, parse):
            with pytest.raises(Exception, match="(?i)malformed|invalid"):
                how(f"bad{n}").collect()


def test_compacted_batches_do_not_grow_in_number(spark, tmp_path, monkeypatch, rows):
    """A landing of nine files is nine batches, whatever the files hold."""
    from bindings import QUERIES, streams

    orders = spark.range(270).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.expr("substr('FOP', 1 + id % 3, 1)").alias("o_orderstatus"),
        (F.col("id") * 1000.0).alias("o_totalprice"), F.lit("1995-03-01 00:00:00").cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    )
    orders.coalesce(1).write.parquet(f"{tmp_path}/tables/orders.parquet")
    monkeypatch.setattr(landing, "LINES_PER_FILE", 5)
    monkeypatch.setattr(streams, "scratch_path", lambda *_: f"{tmp_path}/run")
    found = rows(QUERIES["stream_compacted"](spark, f"{tmp_path}/tables"))
    assert found == sorted(((str(i), "active" if i % 3 else "ended", True, True) for i in range(270)), key=repr)
    assert len(versions.log_of(spark, f"{tmp_path}/run/silver").numbers()) == 18
