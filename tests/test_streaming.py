"""Streams give what the same batch gives, however the input is split into files."""

import pytest
from pyspark.sql import functions as F

from tallyloom.streaming import envelopes, runner, transforms, upserts
from tallyloom.workspace import scratch_name, scratch_path

SCHEMA = "id long, k string, ts timestamp"


def rows(spark, n=200):
    return spark.range(n).select(
        "id", F.concat(F.lit("k"), F.col("id") % 3).alias("k"),
        F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") * 7919) % 10_000).alias("ts"))


def staged(spark, files):
    path = scratch_path(spark, "stream_test")
    rows(spark).repartition(files).write.parquet(path)
    return path


@pytest.mark.parametrize("files", [1, 2, 5])
def test_windows_equal_batch(spark, files):
    def counted(df):
        return transforms.windowed_count(df, "ts", "k", length="10 minutes", slide="5 minutes", start="2 minutes")

    stream = runner.file_stream(spark, staged(spark, files), SCHEMA, files_per_trigger=1)
    got = sorted(map(str, transforms.window_bounds(runner.run_complete(counted(stream))).collect()))
    assert got == sorted(map(str, transforms.window_bounds(counted(rows(spark))).collect()))


@pytest.mark.parametrize("files", [1, 4])
def test_upsert_keeps_the_latest_count(spark, files):
    stream = runner.file_stream(spark, staged(spark, files), SCHEMA, files_per_trigger=1)
    got = runner.run_upsert(transforms.running_count(stream, "k"), ["k"])
    assert sorted((r["k"], r["n"]) for r in got.collect()) == [("k0", 67), ("k1", 67), ("k2", 66)]


def test_a_restart_goes_on_from_the_checkpoint(spark):
    source, target, checkpoint = staged(spark, 2), scratch_path(spark, "out"), scratch_path(spark, "cp")

    def run():
        stream = runner.file_stream(spark, source, SCHEMA).select("id")
        runner.finish(runner.start_files(stream, target, checkpoint=checkpoint))
        return spark.read.parquet(target).count()

    assert run() == 200
    assert run() == 200
    rows(spark, 10).write.mode("append").parquet(source)
    assert run() == 210


def test_append_windows_wait_for_the_watermark(spark):
    stream = runner.file_stream(spark, staged(spark, 3), SCHEMA)
    counts = transforms.windowed_count(stream, "ts", "k", length="10 minutes", late="10 minutes")
    done = runner.run_to_files(counts)
    whole = transforms.windowed_count(rows(spark), "ts", "k", length="10 minutes")
    assert 0 < done.count() < whole.count()
    assert done.exceptAll(whole).count() == 0


def test_an_empty_folder_gives_no_rows(spark):
    path = scratch_path(spark, "empty")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    stream = runner.file_stream(spark, path, SCHEMA)
    assert runner.run_complete(transforms.running_count(stream, "k")).count() == 0
    assert runner.run_upsert(transforms.running_count(stream, "k"), ["k"]).count() == 0


def test_a_large_static_side_is_salted(spark):
    static = spark.createDataFrame([("k0", "x"), ("k1", "y")], "k string, v string")
    stream = runner.file_stream(spark, staged(spark, 2), SCHEMA)
    joined = runner.run_to_files(transforms.with_dimension(stream, static, "k", max_bytes=1, salts=3))
    assert sorted(map(str, joined.select("id", "k", "v").collect())) == sorted(
        map(str, rows(spark).join(static, "k").select("id", "k", "v").collect()))


def test_partitioned_files_are_bounded_per_value(spark):
    stream = runner.file_stream(spark, staged(spark, 8), SCHEMA)
    path = scratch_path(spark, "bounded")
    runner.finish(runner.start_files(stream, path, ["k"], files_per_value=2))
    files = spark.read.parquet(path).groupBy("k", F.input_file_name()).count().groupBy("k").count()
    assert max(r["count"] for r in files.collect()) <= 2


def test_memory_sink_and_interval_trigger(spark):
    name = scratch_name("seen")
    stream = transforms.running_count(runner.file_stream(spark, staged(spark, 1), SCHEMA), "k")
    query = runner.start_memory(stream, name, every="1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.table(name).count() == 3 and not query.isActive


def test_payloads(spark):
    df = envelopes.as_kafka(
        spark.createDataFrame([("a", '{"zip":"1"}'), ("b", None), ("c", "{bad")], "k string, v string"),
        F.col("k"), F.col("v"), F.lit("t"), F.lit(1), F.current_timestamp())
    assert envelopes.value_text(df).count() == 2
    assert envelopes.value_text(df, keep_empty=True).count() == df.count()
    assert sorted(str(r["zip"]) for r in envelopes.json_paths(df, {"zip": "$.zip"}).collect()) == ["1", "None", "None"]
    words = spark.createDataFrame([(bytearray(b"HeLLo"),)], "data binary")
    assert envelopes.payload_words(words).first()["word"] == "hello"


def test_missing_connectors_are_reported(spark):
    with pytest.raises(Exception):
        envelopes.kafka_source(spark, "nowhere:1", ["t"])


def test_one_current_row_per_key_over_batches_and_reruns(spark, tmp_path):
    source, path, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    for step, rows in enumerate(([("a",), ("b",)], [("a",), ("c",)], [(None,), ("a",)])):
        spark.createDataFrame(rows, "k string").write.mode("append").parquet(source)
        stream = runner.file_stream(spark, source, "k string", files_per_trigger=1)
        runner.finish(runner.start_current(transforms.running_count(stream, "k"), path, "update", ["k"], checkpoint=checkpoint))
        if step == 1:  # the last batch is run again, as after a failure before its commit
            commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
            commits[-1].unlink()
            (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
            runner.finish(runner.start_current(transforms.running_count(runner.file_stream(spark, source, "k string", files_per_trigger=1), "k"),
                                               path, "update", ["k"], checkpoint=checkpoint))
    folders = runner._children(spark, path)
    assert len(folders) == 1
    rows = sorted((r["k"] or "", r["n"]) for r in spark.read.schema("k string, n long").parquet(f"{path}/{folders[0]}").collect())
    assert rows == [("", 1), ("a", 3), ("b", 1), ("c", 1)]


def test_rows_that_hold_only_the_key_are_spread(spark):
    from tallyloom.operators.joins import salted_join

    rows = spark.range(1000).select(F.lit(1).alias("k"), "id")
    joined = salted_join(rows, spark.createDataFrame([(1, "x")], "k int, v string"), ["k"], 16, ["id"])
    assert joined.count() == 1000
    assert rows.select(F.pmod(F.xxhash64("id"), F.lit(16))).distinct().count() == 16


def _table_rows(spark, path):
    return {r["k"]: r["n"] for r in upserts.read_upserted(spark, path, spark.createDataFrame([], "k string, n long").schema).collect()}


def _files(tmp_path, now):
    return {b: sorted(p.name for p in (tmp_path / "t" / "data" / f).glob("*.parquet")) for b, f in now.folders.items()}


def test_a_batch_rewrites_only_its_buckets(spark, tmp_path):
    path = f"{tmp_path}/t"
    first = spark.createDataFrame([(f"k{i}", i) for i in range(40)] + [(None, 7)], "k string, n long")
    upserts.upsert_batch(first, 0, path, ["k"], 8)
    before = upserts.manifest(spark, path)
    files = _files(tmp_path, before)
    assert len(files) == 8 and all(len(f) == 1 for f in files.values())
    upserts.upsert_batch(spark.createDataFrame([("k3", 300), ("new", 1)], "k string, n long"), 1, path, ["k"], 8)
    after = upserts.manifest(spark, path)
    changed = [b for b in after.folders if after.folders[b] != before.folders[b]]
    assert 1 <= len(changed) <= 2
    assert all(_files(tmp_path, after)[b] == files[b] for b in files if b not in changed)
    expected = {f"k{i}": i for i in range(40)} | {None: 7, "k3": 300, "new": 1}
    assert _table_rows(spark, path) == expected
    # a batch run again finds itself in the manifest and changes nothing
    upserts.upsert_batch(spark.createDataFrame([("k3", -1)], "k string, n long"), 1, path, ["k"], 8)
    assert upserts.manifest(spark, path) == after and _table_rows(spark, path) == expected
    # a batch without rows is counted as done
    upserts.upsert_batch(first.limit(0), 2, path, ["k"], 8)
    assert upserts.manifest(spark, path).batch == 2 and _table_rows(spark, path) == expected


def test_a_reader_that_has_begun_keeps_its_files_and_a_torn_batch_leaves_no_trace(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(f"k{i}", i) for i in range(20)], "k string, n long")
    upserts.upsert_batch(rows, 0, path, ["k"], 4)
    begun = upserts.read_upserted(spark, path, rows.schema)
    with monkeypatch.context() as m:
        def torn(*_):
            raise OSError("lost before the manifest")
        m.setattr(upserts, "_put", torn)
        with pytest.raises(OSError):
            upserts.upsert_batch(rows.withColumn("n", -F.col("n")), 1, path, ["k"], 4)
    assert _table_rows(spark, path) == {f"k{i}": i for i in range(20)}
    upserts.upsert_batch(rows.withColumn("n", F.col("n") + 100), 1, path, ["k"], 4)
    assert {r["k"]: r["n"] for r in begun.collect()} == {f"k{i}": i for i in range(20)}
    assert _table_rows(spark, path) == {f"k{i}": i + 100 for i in range(20)}
    # two states at most, and nothing of the torn batch
    assert len(upserts._names(spark, f"{path}/data")) == 2 and len(upserts._names(spark, f"{path}/manifests")) == 2


def test_upserted_stream_over_restarts(spark, tmp_path):
    source, path, checkpoint = f"{tmp_path}/in", f"{tmp_path}/t", f"{tmp_path}/checkpoint"
    for keys in (["a", "b"], ["a", "c"], [None, "a"]):
        spark.createDataFrame([(k,) for k in keys], "k string").write.mode("append").parquet(source)
        stream = transforms.running_count(runner.file_stream(spark, source, "k string", files_per_trigger=1), "k")
        runner.finish(upserts.start_upsert(stream, path, ["k"], checkpoint=checkpoint))
    assert _table_rows(spark, path) == {None: 1, "a": 3, "b": 1, "c": 1}


def test_corrections_over_batches_late_rows_and_a_restart(spark, tmp_path):
    from tallyloom.streaming import corrections

    source, target, checkpoint = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    seen = []
    for batch in ([("a", 5), ("a", 20), ("b", 70), (None, 3), ("a", None)], [("a", 30), ("b", 130)],
                  [("a", 10), ("b", 75), ("c", 900)], [("a", 1), ("c", 901)]):
        rows = spark.createDataFrame(batch, "k string, s long").select("k", F.timestamp_seconds("s").alias("ts"))
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = runner.file_stream(spark, source, "k string, ts timestamp", files_per_trigger=1)
        runner.finish(runner.start_files(corrections.window_corrections(stream, "ts", "k", 60, 120), target, checkpoint=checkpoint))
        found = {(r["key"], r["second"], r["before"], r["after"]) for r in spark.read.parquet(target).select(
            "key", F.unix_timestamp("window_start").alias("second"), "before", "after").collect()}
        seen.append(found)
    assert seen[0] == {("a", 0, 0, 2), ("b", 60, 0, 1), (None, 0, 0, 1)}
    assert seen[1] - seen[0] == {("a", 0, 2, 3), ("b", 120, 0, 1)}
    assert seen[2] - seen[1] == {("a", 0, 3, 4), ("b", 60, 1, 2), ("c", 900, 0, 1)}
    # by now the first windows are forgotten, and what comes for them is too late
    assert seen[3] - seen[2] == {("c", 900, 1, 2)}
