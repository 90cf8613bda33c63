import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tallyloom import fixed_values as fixed
from tallyloom.operators import joins
from tallyloom.plans import source_queries
from tallyloom.sources import files, sinks
from tallyloom.workspace import cached, join_on_keys, materialise, scratch_name, scratch_path, shared_folder, small_side


def test_scratch_follows_the_session_setting(spark):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    spark.conf.set("tallyloom.other", "1")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_cluster_without_the_setting_is_refused(spark):
    class Context:
        master = "yarn"

    class Session:
        conf = spark.conf
        sparkContext = Context()

    if spark.conf.get("spark.checkpoint.dir", None) is None:
        with pytest.raises(RuntimeError):
            shared_folder(Session())


def test_small_side_is_checked(spark):
    def plan(df):
        return df._jdf.queryExecution().analyzed().toString().lower()

    small = small_side(spark.range(10))
    assert "broadcast" in plan(small) and small.count() == 10
    large = small_side(spark.range(11), 10)  # bytes
    assert "broadcast" not in plan(large) and large.count() == 11


def test_null_keys_meet(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("y", 20)], "k string, b int")
    assert [tuple(r) for r in join_on_keys(a, b, ["k"]).collect()] == [(None, 1, 10)]


def test_csv_markers_blanks_and_bad_numbers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,n\n1,  x ,NA\n2,NA,5\n3,\"y\",oops\n")
    got = files.read_csv(spark, str(tmp_path), "id int, name string, n int").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "x", None), (2, None, 5), (3, "y", None)]
    assert dict(files.read_csv(spark, str(tmp_path)).dtypes)["id"] == "int"


def test_match_event_schema_reads_the_raw_file(spark, tmp_path):
    names = fixed.MATCH_EVENTS.names
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join(
        "7" if fixed.MATCH_EVENTS[n].dataType.typeName() == "integer" else " v " for n in names) + "\n")
    row = files.read_csv(spark, str(tmp_path), fixed.MATCH_EVENTS).first()
    assert row["event_type"] == 7 and row["player"] == "v"


def test_positional(spark, tmp_path):
    (tmp_path / "a.txt").write_text("en New_York 12 x\nfr Paris bad x\n")
    got = files.read_positional(spark, str(tmp_path), {"project": "string", "page": "string", "n": "int", "rest": "string"})
    assert [tuple(r) for r in got.collect()] == [("en", "New_York", 12, "x"), ("fr", "Paris", None, "x")]


def test_underscore_is_a_wildcard_in_like(spark):
    df = spark.createDataFrame([("New_York",), ("Newark",), ("NewXYork",)], "page string")
    assert df.filter(F.col("page").like("New_%")).count() == 3


def test_images_drop_what_is_no_image(spark, tmp_path):
    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    png = (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 2, 1, 8, 2, 0, 0, 0))
           + chunk(b"IDAT", zlib.compress(b"\x00" + bytes([1, 2, 3, 4, 5, 6]))) + chunk(b"IEND", b""))
    (tmp_path / "a.png").write_bytes(png)
    (tmp_path / "b.txt").write_text("no image")
    rows = files.read_images(spark, str(tmp_path)).collect()
    assert [(r["image"]["width"], r["image"]["height"]) for r in rows] == [(2, 1)]


def test_versions_without_a_field_give_null(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([("1", '{"str1":"a"}'), ("2", '{"str1":"b","int1":4}'), ("2", "{bad"), ("9", "{}")],
                               "version string, payload string")
    schemas = {"1": T.StructType().add("str1", "string"),
               "2": T.StructType().add("str1", "string").add("int1", "integer")}
    got = files.expand_payload(df, "payload", "version", schemas, ["str1", "int1"]).collect()
    assert [(r["str1"], r["int1"]) for r in got] == [("a", None), ("b", 4), (None, None), (None, None)]


def test_table_layouts(spark):
    df = spark.range(100).select("id", (F.col("id") % 4).alias("k"))
    name, path = scratch_name("t"), scratch_path(spark, "t")
    sinks.create_database(spark, f"db_{name}", scratch_path(spark, "db"))
    assert sinks.save_partitioned(df, f"db_{name}.a", path, ["k"]).count() == 100
    assert sinks.replace_table(spark.range(1), name, scratch_path(spark, "one")).count() == 1
    assert sinks.replace_table(spark.range(2), name, scratch_path(spark, "two")).count() == 2
    sinks.analyze_columns(spark, name)
    capped = sinks.save_capped(df.repartition(1), scratch_path(spark, "capped"), 30)
    assert sorted(r["n"] for r in sinks.rows_per_file(capped).collect()) == [10, 30, 30, 30]


def test_bucketed_tables_join_without_a_shuffle(spark):
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    a, b = scratch_name("a"), scratch_name("b")
    left = sinks.save_bucketed(df, a, scratch_path(spark, "a"), "id", "v", 4)
    right = sinks.save_bucketed(df, b, scratch_path(spark, "b"), "id", "v", 4)
    joined = left.join(right.hint("merge"), "id")
    assert "Exchange" not in joined._jdf.queryExecution().sparkPlan().toString()
    assert joined.count() == 1000


def test_bounded_partitions_cache_and_materialise(spark):
    assert sinks.bounded_partitions(spark.range(1000), F.lit(10), 1000).rdd.getNumPartitions() == 10
    with cached(spark.range(5)) as kept:
        assert kept.is_cached and kept.count() == 5
    assert materialise(spark.range(5), "m").count() == 5


def test_fan_out_is_the_plain_join(spark):
    a = spark.createDataFrame([("A b", 1), ("a_B", 2), ("c", 5), (None, 9)], "k string, x long")
    b = spark.createDataFrame([("a_b", 10), ("A_B", 20), ("d", 1)], "k string, y long")
    from tallyloom.functions.cleaning import normal_key

    left = joins.per_key(a, normal_key("k"), {"x": F.col("x")}, "left")
    right = joins.per_key(b, normal_key("k"), {"y": F.col("y")}, "right")
    assert [tuple(r) for r in joins.fanout_sums(left, right, ["x"], ["y"]).collect()] == [("a_b", 4, 6, 60)]
    assert [tuple(r) for r in joins.aggregated_sums(left, right).select("join_key", "x", "y").collect()] == [("a_b", 3, 30)]


def test_salted_join_is_the_plain_join(spark):
    a = spark.range(1000).select("id", (F.col("id") % 3).alias("k"))
    b = spark.createDataFrame([(0, "x"), (1, "y"), (1, "z"), (9, "w")], "k long, v string")
    salted, plain = joins.salted_join(a, b, ["k"], 5), a.join(b, "k")
    assert sorted(map(tuple, salted.select("id", "k", "v").collect())) == sorted(map(tuple, plain.select("id", "k", "v").collect()))


def test_profile(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "b")], "n int, s string")
    got = {r["column_name"]: (r["type"], r["rows"], r["nulls"], r["distinct_values"], r["lowest"], r["highest"])
           for r in sinks.profile(df).collect()}
    assert got == {"n": ("int", 3, 0, 2, "1", "2"), "s": ("string", 3, 1, 2, "a", "b")}


def test_grid_is_filled_between_its_ends(spark):
    counts = spark.createDataFrame([("a", 1, 5), ("b", 3, 7)], "k string, t int, n int")
    got = sorted(map(tuple, joins.fill_grid(counts, "k", "t", "n").collect()))
    assert got == [("a", 1, 5), ("a", 2, 0), ("a", 3, 0), ("b", 1, 0), ("b", 2, 0), ("b", 3, 7)]
    assert joins.fill_grid(counts.limit(0), "k", "t", "n").count() == 0
    assert sorted(map(tuple, joins.fill_grid(counts, "k", "t", "n", run=2).collect())) == got
    long = spark.createDataFrame([("a", 1, 5), ("a", 25_003, 7)], "k string, t long, n int")
    assert joins.fill_grid(long, "k", "t", "n").agg(F.count(F.lit(1)), F.count_distinct("t"), F.sum("n")).first() == (25_003, 25_003, 12)


RECORDS = [{"id": i, "s": s, "n": {"a": [i, {"b": "}"}]}} for i, s in enumerate([
    "plain", "}", "{", "]", "[,", 'quote " and } brace', "back\\slash", 'end \\"', "\\\\", "line\nbreak }", "é中}", "", "a,b", '"}",{"id":9}'] * 40)]


def _parsed(spark, path):
    from tallyloom.sources.json_arrays import read_json_array

    rows = read_json_array(spark, str(path), "id long, s string, n struct<a: array<string>>, missing int")
    return rows


@pytest.mark.parametrize("indent", [None, 2])
def test_one_json_array_is_read_by_many_tasks(spark, tmp_path, indent):
    import json

    from tallyloom.sources.json_arrays import _pieces

    (tmp_path / "one.json").write_text(json.dumps(RECORDS, indent=indent, ensure_ascii=False))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert _pieces(spark, str(tmp_path)).select("_split").distinct().count() > 8
        rows = sorted(_parsed(spark, tmp_path).collect(), key=lambda r: r["id"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [(r["id"], r["s"]) for r in rows] == [(r["id"], r["s"]) for r in RECORDS]
    assert all(r["n"]["a"][0] == str(r["id"]) and json.loads(r["n"]["a"][1]) == {"b": "}"} and r["missing"] is None for r in rows)


def test_json_files_of_every_shape(spark, tmp_path):
    for name, text in {"empty": "", "none": "[]", "spaces": " [ \n ] ", "object": '{"id": 1, "n": {"a": ["x"]}}', "several": '{"id": 2}\n{"id": 3}\n',
                       "array": '[{"id": 4},{"id":5}]', "torn": '[{"id": 6}, {"id": 7', "bad": '[{"id": "no"}]'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    found = {}
    for file in tmp_path.iterdir():
        found[file.stem] = sorted((r["id"] for r in _parsed(spark, file).collect()), key=str)
    assert found == {"empty": [], "none": [], "spaces": [], "object": [1], "several": [2, 3], "array": [4, 5], "torn": [6, None], "bad": [None]}
    assert sorted(r["id"] or 0 for r in _parsed(spark, tmp_path).collect()) == [0, 0, 1, 2, 3, 4, 5, 6]


def _zigzag(n):
    z, out = (n << 1) ^ (n >> 63), b""
    z &= (1 << 64) - 1
    while z > 127:
        out, z = out + bytes([z & 127 | 128]), z >> 7
    return out + bytes([z])


def test_avro_payloads_of_every_kind(spark):
    import json
    import struct

    from tallyloom.sources import avro_payloads as avro

    fields = [("b", "boolean"), ("i", "int"), ("l", "long"), ("f", "float"), ("d", "double"), ("s", "string"), ("y", "bytes"),
              ("e", {"type": "enum", "name": "e", "symbols": ["A", "B"]}), ("x", {"type": "fixed", "name": "x", "size": 3}),
              ("u", ["null", "string"]), ("r", {"type": "record", "name": "q", "fields": [{"name": "n", "type": ["long", "null"]}]})]
    old = json.dumps({"type": "record", "name": "t", "fields": [{"name": n, "type": t} for n, t in fields]})
    new = json.dumps({"type": "record", "name": "t", "fields": [{"name": "l", "type": "int"}, {"name": "s", "type": "string"}]})

    def text(x):
        return _zigzag(len(x)) + x

    def one(b, i, n, f, d, s, y, e, u, r):
        body = bytes([b]) + _zigzag(i) + _zigzag(n) + struct.pack("<f", f) + struct.pack("<d", d) + text(s.encode()) + text(y) + _zigzag(e) + b"xyz"
        return b"\0\0\0\0\x07" + body + (_zigzag(0) if u is None else _zigzag(1) + text(u.encode())) + (
            _zigzag(1) if r is None else _zigzag(0) + _zigzag(r))

    rows = [(True, -5, 2**62, 0.5, -1e300, "é中", b"\xff", 1, None, -(2**63)), (False, 2**31 - 1, -1, -2.0, 0.1, "", b"", 0, "u", None),
            (True, -(2**31), 0, 0.0, 0.0, "long " * 50, b"a" * 300, 0, "", 7)]
    good = [one(*r) for r in rows] + [b"\0\0\0\0\x09" + _zigzag(3) + text(b"z")]
    bad = [None, b"", b"\0\0\0", b"\1" + good[0][1:], b"\0\0\0\0\x08" + good[0][5:], good[0] + b"\0", b"\0\0\0\0\x09" + b"\xff" * 11,
           b"\0\0\0\0\x09" + _zigzag(2**40) + text(b"z"), b"\0\0\0\0\x09" + _zigzag(3) + _zigzag(-4), b"\0\0\0\0\x09" + _zigzag(3) + text(b"\xff\xfe"),
           one(True, 1, 1, 0, 0, "", b"", 2, None, None), b"\0\0\0\0\x09" + _zigzag(1)]
    bad += [good[0][:n] for n in range(5, len(good[0]))]
    reader = "struct<b:boolean,i:int,l:long,f:float,d:double,s:string,y:binary,e:string,x:binary,u:string,r:struct<n:bigint>,none:int>"
    df = spark.createDataFrame([(i, p, 1) for i, p in enumerate(good + bad)], "id int, p binary, record int").repartition(3)
    schema = spark.createDataFrame([], f"x {reader}").schema["x"].dataType
    found = {r["id"]: r["record"] for r in avro.decode_avro_payloads(df, "p", {7: old, 9: new}, schema).collect()}
    for i, (b, n, m, f, d, s, y, e, u, r) in enumerate(rows):
        assert tuple(found[i]) == (b, n, m, f, d, s, bytearray(y), "AB"[e], bytearray(b"xyz"), u, (r,), None)
    assert (found[3]["l"], found[3]["s"], found[3]["b"], found[3]["r"]) == (3, "z", None, None)
    assert [found[i] for i in range(4, len(found))] == [None] * len(bad)
    with pytest.raises(ValueError):
        avro.decode_avro_payloads(df, "p", {1: '{"type": "record", "name": "a", "fields": [{"name": "m", "type": {"type": "map", "values": "int"}}]}'}, schema)
    numbers = [0, -1, 1, 63, 64, -65, 2**31, -(2**31), 2**63 - 1, -(2**63)]
    written = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", avro.avro_number(F.col("n")).alias("b")).collect()
    assert all(bytes(r["b"]) == _zigzag(r["n"]) for r in written)


def test_images_become_arrays_and_feed_a_classifier(spark, tmp_path):
    import struct

    from tallyloom.operators import models
    from tallyloom.sources import files

    def bitmap(width, height, pixel):
        rows = b""
        for y in reversed(range(height)):  # from the bottom up, each row filled to four bytes
            row = b"".join(bytes(pixel(x, y)) for x in range(width))
            rows += row + b"\0" * (-len(row) % 4)
        return b"BM" + struct.pack("<IHHIIiiHHIIiiII", 54 + len(rows), 0, 0, 54, 40, width, height, 1, 24, 0, len(rows), 0, 0, 0, 0) + rows

    for i in range(40):
        bright = i % 2
        shape = (5 + i % 3, 4 + i % 4)
        (tmp_path / f"{i:02}_{bright}.bmp").write_bytes(bitmap(*shape, lambda x, y: [200 if bright == (x < 2) else 30 + i, 10, 255]))
    (tmp_path / "90_0.bmp").write_bytes(b"x")
    (tmp_path / "91_0.bmp").write_bytes(bitmap(4, 4, lambda x, y: [1, 2, 3])[:40])
    read = files.read_images(spark, str(tmp_path), keep_invalid=True).withColumn("values", files.image_values())
    name = F.regexp_extract("file_path", "([0-9]+)_([0-9])[.]bmp", 1).cast("int")
    rows = {r["i"]: r for r in read.select(name.alias("i"), "values", "image.width", "image.height").collect()}
    assert len(rows) == 42 and [rows[i]["values"] for i in (90, 91)] == [None, None]
    assert (rows[3]["width"], rows[3]["height"]) == (5, 7) and len(rows[3]["values"]) == 105
    assert rows[3]["values"][:9] == [200, 10, 255, 200, 10, 255, 33, 10, 255]
    assert files.read_images(spark, str(tmp_path)).count() == 40
    featured = files.image_features(read, 2).select(
        F.regexp_extract("file_path", "_([0-9])[.]bmp", 1).cast("double").alias("y"), "brightness")
    assert featured.where("brightness is null").count() == 2 and featured.where("size(brightness) = 4").count() == 40
    df = models.vector_features(featured.where("brightness is not null"), "brightness")
    scored = models.logistic("y", maxIter=30).fit(df).transform(df)
    assert scored.agg(models.accuracy(F.col("prediction"), F.col("y"))).first()[0] == 1.0


def test_files_of_one_row_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    spark.range(450).select(F.col("id").alias("s_suppkey")).coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    monkeypatch.setattr(source_queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    rows = source_queries.images(spark, str(tmp_path)).collect()
    assert len(rows) == 406 and sum(r["total"] for r in rows if r["kind"] == "broken") == 45
    written = [f.name for f in (tmp_path / "images").glob("part-*.txt")]
    assert len(written) == 450 and len({name[:10] for name in written}) == 3
