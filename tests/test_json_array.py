"""JSON arrays read by byte ranges, and schemas found from JSON rows."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablepipe.operators import infer
from tablepipe.operators.contract import metadata_columns
from tablepipe.sources import json_array as J
from tablepipe.sources.manifest import load_datasets, read_geojson, write_geojson_collection
from tablepipe.sources.typed import read_typed_json

TEXTS = st.text(st.sampled_from('ab{}[]",\\:é\n'), max_size=9)
VALUES = st.recursive(st.none() | st.booleans() | st.integers() | TEXTS,
                      lambda x: st.lists(x, max_size=3) | st.dictionaries(TEXTS, x, max_size=3), max_leaves=8)
OBJECTS = st.lists(st.dictionaries(TEXTS | st.just("features"), VALUES, max_size=4), max_size=12)


def _cut(text, sizes):
    """The ranges of a text as the reader deals them out: pieces between closing braces."""
    chunks = text.split("}")
    if chunks[-1] == "":
        chunks.pop()
    out, at = [], 0
    for n in sizes:
        out.append(chunks[at:at + n])
        at += n
    return [c for c in [*out, chunks[at:]] if c]


def _read(text, sizes, key):
    """The array's elements by state maps over the ranges, without Spark."""
    ranges, rows = _cut(text, sizes), []
    for i, texts in enumerate(ranges):
        own = J.RangeMap(key, i == 0)
        for t in texts:  # as single batches
            data = (t + "}").encode()
            own.bytes += len(data)
            own.add(data)
        rows.append(own.row(0, i, len(text.encode())))
    starts = J.compose(rows, key)
    whole, parts = {}, {}
    for i, texts in enumerate(ranges):
        e = J.Elements(key, starts[0, i])
        for data in ["}".join([*texts, ""]).encode()]:
            began = e.began
            for n, (is_whole, piece) in enumerate(e.add(data)):
                if is_whole:
                    whole[i, n] = piece
                else:
                    parts.setdefault(began, []).append(piece)
        if e.held:
            parts.setdefault(i if e.began is None else e.began, []).append(b"".join(e.held))
    joined = {(k, 10**9): b"".join(v) for k, v in parts.items()}
    return [json.loads(x) for _, x in sorted({**whole, **joined}.items())]


@settings(max_examples=150, deadline=None)
@given(OBJECTS, st.lists(st.integers(1, 5), max_size=6), st.sampled_from([None, 1]), st.booleans())
def test_ranges_give_every_element_once(objects, sizes, indent, keyed):
    if keyed:
        doc = {"crs": {"features": [{"x": 1}], "p": {}}, "list": [{"a": {}}], "features": objects, "z": [{"b": [{}]}]}
        assert _read(json.dumps(doc, indent=indent) + "\n", sizes, "features") == objects
    else:
        assert _read(json.dumps(objects, indent=indent, ensure_ascii=False), sizes, None) == objects


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_files_of_many_ranges(spark, out, small_ranges):
    rng = random.Random(2)
    objects = [{"i": i, "note": "".join(rng.choice('{}[]",\\ é') for _ in range(rng.choice([3, 9, 5000 if i % 50 == 0 else 1]))), "v": [{}, {"a": i}]}
               for i in range(200)]
    for name, part in (("b", objects[:120]), ("a", objects[120:]), ("c", [])):
        with open(f"{out}/{name}.json", "w") as f:
            json.dump(part, f, ensure_ascii=False)
    assert J._chunks(spark, out).rdd.getNumPartitions() > 10
    rows = J.array_elements(spark, out, order_col="o").orderBy("o").collect()
    assert [json.loads(r.element) for r in rows] == objects[120:] + objects[:120]  # files by name, elements in order


@pytest.mark.parametrize("text,key", [('[{"a":1},{"b":2', None), ('[{"a":1}, 5]', None), ('[{"a":1} "x" {"b":1}]', None), ('{"a":[{}]}', None),
                                      ('[{"a":"x]', None), ('{"features":[{"a":1}]', "features"), ('{"features":{"a":1}}', "features"),
                                      ('{"features":[{}],"features":[{}]}', "features"), ('[]', "features"), ("null", None)])
def test_broken_arrays_fail(spark, out, text, key):
    with open(f"{out}/x.json", "w") as f:
        f.write(text)
    with pytest.raises(Exception, match="BrokenArray|no array|not end|no object|second array"):
        J.array_elements(spark, f"{out}/x.json", key).collect()


def test_typed_array_file_keeps_rejects(spark, out, small_ranges):
    rows = [{"a": i, "t": i} for i in range(300)]
    rows[7]["a"] = "seven"
    with open(f"{out}/x.json", "w") as f:
        json.dump(rows, f)
    with pytest.raises(Exception):
        read_typed_json(spark, f"{out}/x.json", "a bigint, t string").collect()
    kept = read_typed_json(spark, f"{out}/x.json", "a bigint, t string, _corrupt_record string", mode="PERMISSIVE").collect()
    assert len(kept) == 300 and [json.loads(r._corrupt_record) for r in kept if r._corrupt_record] == [rows[7]]
    assert {r.t for r in kept if not r._corrupt_record} == {str(i) for i in range(300) if i != 7}


def test_collections_round_trip(spark, out, small_ranges):
    df = spark.range(300).select("id", F.concat(F.lit('} "'), "id").alias("name"), (F.col("id") / 2).alias("half"),
                                 F.lit('{"type":"Point","coordinates":[1,2]}').alias("geometry")).repartition(4)
    write_geojson_collection(df, f"{out}/c.geojson")
    with open(f"{out}/c.geojson") as f:
        assert len(json.load(f)["features"]) == 300
    back = read_geojson(spark, f"{out}/c.geojson")
    assert dict(back.dtypes) == {"id": "bigint", "name": "string", "half": "double", "geometry": "string", "geometry_type": "string"}
    assert {tuple(r)[:3] for r in back.collect()} == {tuple(r)[:3] for r in df.collect()}


def test_elements_are_parsed_once(spark, out, small_ranges):
    """Jobs over the rows read the parsed columns they want, not the text again."""
    objects = [{"type": "Feature", "properties": {"i": i, "s": "x" * (i % 40)}, "geometry": {"type": "Point"}} for i in range(200)]
    with open(f"{out}/c.geojson", "w") as f:
        json.dump({"type": "FeatureCollection", "features": objects}, f)
    with open(f"{out}/x.json", "w") as f:
        json.dump([o["properties"] for o in objects], f)
    for rows in (read_geojson(spark, f"{out}/c.geojson"), read_typed_json(spark, f"{out}/x.json", "i bigint, s string", order_col="o")):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" not in plan
        assert sorted((r.i, r.s) for r in rows.select("i", "s").collect()) == [(o["properties"]["i"], o["properties"]["s"]) for o in objects]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from('{}[]"\\a'), max_size=16))
def test_marks_by_a_walk(text):
    want, quoted, escaped = [], 0, False
    for i, c in enumerate(text):
        if c in "{}[]":
            want.append((i, 1 if c in "{[" else -1, quoted))
        if c == '"' and not escaped:
            quoted = 1 - quoted
        escaped = c == "\\" and not escaped
    places, kind, odd, total = J.marks(text.encode())
    assert list(zip(places.tolist(), kind.tolist(), odd.tolist())) == want and total == quoted


# schemas of JSON rows


def test_kinds_join_to_the_narrowest_type(spark):
    values = {"n": ["1", "2"], "d": ["1", "2.5"], "m": ['"$1,200.50"', "3"], "b": ["true", "null"], "t": ['"2024-01-02"', '"2024-01-02T03:04:05.000"'],
              "x": ['"2024-01-02"', "1"], "p": ['{"type":"Point"}'], "mp": ['{"type":"MultiPoint"}'], "ml": ['{"type":"MultiLineString"}'],
              "po": ['{"type":"Polygon"}'], "mpo": ['{"type":"MultiPolygon"}'], "mix": ['{"type":"Polygon"}', '{"type":"Point"}'],
              "l": ['{"latitude":"1","longitude":2}'], "s": ['"a"'], "o": ['{"a":1}'], "a": ["[1]"], "nul": ["null"], "big": ["12345678901234567890"]}
    rows = [(k, '{"%s": %s}' % (k, v)) for k, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows + [("n", None), ("empty", "{}")], "ds string, doc string").repartition(3)
    got = {r.raw_name: r.t for r in infer.fields(df, "doc", "ds").select("raw_name", infer.portal_type(F.col("kinds")).alias("t")).collect()}
    assert got == {"n": "number", "d": "double", "m": "money", "b": "checkbox", "t": "calendar_date", "x": "text", "p": "point",
                   "mp": "multipoint", "ml": "multiline", "po": "polygon", "mpo": "multipolygon", "mix": "text", "l": "location", "s": "text",
                   "o": "text", "a": "text", "nul": "text", "big": "number"}


def test_documents_follow_the_rows_order(spark):
    df = spark.createDataFrame([("a", '{"Z z":1,"b":"x"}'), ("a", '{"Z z":2,"A":true,"sid":"r"}'), ("b", '{"q":1}')], "ds string, doc string")
    found = infer.fields(df, "doc", "ds")
    cols = metadata_columns(infer.metadata_documents(found, "ds")).orderBy("dataset_id", "position").collect()
    assert [(r.dataset_id, r.position, r.raw_name, r.name, r.data_type) for r in cols] == [
        ("a", 0, "Z z", "zz", "number"), ("a", 1, "A", "a", "checkbox"), ("a", 2, "b", "b", "text"), ("a", 3, "sid", "sid", "text"),
        ("b", 0, "q", "q", "number")]
    assert {r.name for r in infer.data_headers(found, "ds").where("dataset_id = 'a'").collect()} == {"zz", "a", "b", "id"}
    with pytest.raises(Exception, match="no JSON object|MALFORMED"):
        infer.fields(spark.createDataFrame([("a", "[1]")], "ds string, doc string"), "doc", "ds").collect()


def test_datasets_load_on_their_own(spark, out):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS geo_side LOCATION '{out}/wh'")
    for k in range(6):
        spark.range(k + 1).write.option("header", True).csv(f"{out}/d{k}")
    offers = [(f"t{k}", None, "csv", f"{out}/d{k}" if k != 3 else f"{out}/gone") for k in range(6)]
    manifest = spark.createDataFrame(offers, "table_name string, item_id string, format string, url string")
    results = {r.table_name: (r.format, r.ok) for r in load_datasets(spark, manifest, "geo_side", parallel=3).collect()}
    assert results == {f"t{k}": ("csv", k != 3) for k in range(6)}
    assert [spark.table(f"geo_side.t{k}").count() for k in (0, 5)] == [1, 6] and not spark.catalog.tableExists("geo_side.t3")
    assert load_datasets(spark, manifest.limit(0), "geo_side").count() == 0
    spark.sql("DROP DATABASE geo_side CASCADE")
