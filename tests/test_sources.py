import datetime

import pytest
from pyspark.sql import functions as F

from fixture_documents import SHIPMENTS
from folioql.functions import values as V
from folioql.functions.sql import register_functions
from folioql.operators import relational
from folioql.plans.planner import Engine
from folioql.sources.catalog import Catalog, LookupCache
from folioql.sources.container import ContainerMeta, create, from_rows, point_read, scan
from folioql.sources.documents import build_document, read_rows
from folioql.streaming.changes import changes, counts_by_window


def parsed(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "j string").select(F.parse_json("j").alias("doc"))


def test_canonical_keys(spark):
    keys = [r[0] for r in parsed(spark, "1", "1.0", "1e0", '"1"', "true", "null", "[1]", "0.5", "-0.0", "0").select(V.canon_key(F.col("doc"))).collect()]
    assert keys[0] == keys[1] == keys[2] == "n:1" and keys[3] == "s:1" and keys[4] == "b:true" and keys[5] is None and keys[6] == "j:[1]" and keys[8] == keys[9]


def test_types_never_null(spark):
    df = parsed(spark, '{"a":1}', "{}", '{"a":null}')
    got = [tuple(r) for r in df.select(*(f(V.raw(F.col("doc"), "a")) for f in (V.is_number, V.is_string, V.is_array, V.is_object, V.is_bool, V.is_primitive, V.is_null, V.is_defined))).collect()]
    assert got == [(True, False, False, False, False, True, False, True), (False,) * 8, (False, False, False, False, False, True, True, True)]


def test_typed_reading(spark):
    schema = {"i": "int", "d": "decimal(20,5)", "s": "string", "b": "binary", "day": "date", "at": "timestamp", "l": "array<variant>"}
    row = read_rows(parsed(spark, '{"i":42.0,"d":1.25,"s":"x","b":"aGk=","day":"2024-01-02","at":1000,"l":[1]}'), schema).first()
    assert row.i == 42 and str(row.d) == "1.25000" and row.s == "x" and bytes(row.b) == b"hi" and row.day == datetime.date(2024, 1, 2) and len(row.l) == 1
    assert tuple(read_rows(parsed(spark, '{"i":null}'), {"i": "int", "s": "string"}).first()) == (None, None)
    for text, kind in (('{"v":42.5}', "int"), ('{"v":"1"}', "int"), ('{"v":1}', "string"), ("[1]", "int"), ('{"v":3000000000}', "int"), ('{"v":1}', "boolean")):
        with pytest.raises(Exception, match="DocumentTypeError"):
            read_rows(parsed(spark, text), {"v": kind}).collect()


def test_documents_from_rows(spark):
    doc = parsed(spark, '{"id":"0","_ts":1,"n":null,"keep":true}')
    built = doc.select(F.to_json(build_document(F.col("doc"), id=F.lit("1"), category=F.lit(None).cast("string")))).first()[0]
    assert built == '{"id":"1","keep":true,"n":null}'
    rows = from_rows(spark.createDataFrame([(7, None, "x")], "k int, a string, b string"), "k")
    assert rows.select(F.to_json("doc")).first()[0] == '{"b":"x","id":"7","k":7}'


def test_catalog_model_and_routing(spark, tmp_path):
    path = str(tmp_path / "shipments")
    create(parsed(spark, *SHIPMENTS), ContainerMeta("shipments", ("/port",), promoted={"/tons": "double"}), path, now=5)
    (tmp_path / "ports.csv").write_text("port,country\noslo,no\nriga,lv\n")
    model = {"databases": {"harbour": {"containers": {"shipments": {"path": path, "partitionKey": ["/port"], "promoted": {"/tons": "double"}, "compositeIndexes": [[{"path": "/vessel"}], [{"path": "/vessel"}, {"path": "/tons", "order": "desc"}]]}}}}, "views": {"named": "SELECT id, CAST(_MAP['vessel'] AS VARCHAR) AS name FROM shipments"}, "csv": {"ports": {"path": str(tmp_path / "ports.csv"), "schema": "port string, country string"}}, "lookupCacheMaxRows": 3}
    catalog = Catalog.from_model(spark, model)
    container = catalog.container("harbour", "shipments")
    assert container is catalog.container("shipments") and catalog.document_count(container) == 8
    assert len(container.meta.composite_indexes) == 1 and container.meta.serves_order([("/vessel", "desc"), ("/tons", "asc")]) and not container.meta.serves_order([("/vessel", "asc"), ("/tons", "asc")])
    assert sorted(map(tuple, Engine(spark, catalog).sql("SELECT s.id, p.country FROM shipments AS s JOIN ports AS p ON s.port = p.port WHERE p.country = 'no'").collect())) == [("a", "no"), ("b", "no")]
    found = point_read(scan(spark, container.meta, path), container.meta, "c", "riga")
    plan = found._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert found.count() == 1 and "PartitionFilters: [isnotnull(_bucket" in plan and "EqualTo(_pk0,s:riga)" in plan
    catalog.register_views()
    assert spark.table("harbour__shipments").count() == 8
    with pytest.raises(ValueError):
        ContainerMeta("x", ("/a", "/b", "/c", "/d"))


def test_index_paths():
    meta = ContainerMeta("c", included=("/*", "/a/b/?"), excluded=("/a/*",))
    assert meta.is_indexed("/x") and meta.is_indexed("/a/b") and not meta.is_indexed("/a/c")


def test_lookup_cache():
    now = [0.0]
    cache = LookupCache(3, 10, lambda: now[0])
    assert cache.put("a", [1, 2]) and cache.put("b", []) and not cache.put("c", [1]) and cache.get("b") == [] and cache.get("c") is None
    now[0] = 11
    assert cache.get("a") is None and cache.put("c", [1, 2, 3]) and cache.rows == 3
    cache.clear()
    assert cache.get("c") is None and cache.rows == 0


def test_lookup_join_matches_numbers_as_doubles(spark):
    docs = parsed(spark, '{"k":1}', '{"k":2.0}', '{"k":"1"}', '{"k":null}', "{}").select(V.path(F.col("doc"), "k").alias("k"))
    names = spark.createDataFrame([(1, "one"), (2, "two"), (None, "none")], "n int, name string")
    joined = relational.lookup_join(names, docs, "n", "k")
    assert sorted(r.name for r in joined.collect()) == ["one", "two"]


def test_set_operations_over_documents(spark):
    a = parsed(spark, "1", "1.0", '"1"', "null", "2").select(V.norm(F.col("doc")).alias("v"))
    b = parsed(spark, "1e0", "null").select(V.norm(F.col("doc")).alias("v"))
    assert relational.set_operation(a, b, "intersect").count() == 2
    assert relational.set_operation(a, b, "except").count() == 2
    assert relational.set_operation(a, b, "except", True).count() == 3
    assert relational.set_operation(a, b, "union").count() == 4


def test_sql_functions(spark):
    register_functions(spark)
    row = spark.sql("SELECT is_defined(parse_json('null')) a, is_null(parse_json('null')) b, doc_num(parse_json('\"1\"')) c, tostring(parse_json('[1]')) d, is_array(stringtoarray('[1]')) e, fulltextcontains('A b', 'B') f").first()
    assert tuple(row) == (True, True, None, "[1]", True, True)
    array = lambda t: f"doc_array(parse_json('{t}'))"
    row = spark.sql(f"""SELECT objecttoarray(parse_json('{{"a":1}}'))[0].k, objecttoarray(parse_json('[1]')), to_json(array_slice({array("[1,2,3]")}, -2, 1)), to_json(doc_array_union({array('[1,"1"]')}, {array('[1.0,null,2]')})),
      to_json(doc_array_intersect({array('[1,2,null]')}, {array('[2.0,null,3]')})), size(doc_array_concat({array('[1]')}, {array('[1]')})), round(vectordistance(array(1D, 0D), array(1D, 1D)), 6)""").first()
    assert tuple(row) == ("a", None, "[2]", '[1,"1",null,2]', "[2,null]", 2, 0.707107)


def test_streaming(spark, tmp_path):
    meta, path = ContainerMeta("shipments", ("/port",)), str(tmp_path / "s")
    create(parsed(spark, *SHIPMENTS), meta, path, now=600)
    stream = counts_by_window(changes(spark, meta, path), "5 minutes", "1 minute")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("counted").start()
    q.processAllAvailable()
    q.stop()
    assert [r.n for r in spark.sql("SELECT n FROM counted").collect()] == [8]


def test_as_of_join(spark):
    left = spark.createDataFrame([(1, 5), (1, 1), (2, 9)], "k int, t int")
    right = spark.createDataFrame([(1, 2, "a"), (1, 5, "b"), (1, 6, "c")], "k int, u int, v string")
    got = sorted(tuple(r) for r in relational.as_of_join(left, right, "t", "u", ["k"]).select("k", "t", "v").collect())
    assert got == [(1, 1, None), (1, 5, "b"), (2, 9, None)]


def test_as_of_join_over_many_ranges(spark, monkeypatch):
    import random

    monkeypatch.setattr(relational, "TIME_RANGES", 7)
    r = random.Random(3)
    left = [(r.choice([1, 1, 1, 2, None]), r.choice([None, *range(50)]), i) for i in range(300)]
    right = [(r.choice([1, 1, 2, 3]), r.choice([None, *range(50)])) for _ in range(60)]
    got = relational.as_of_join(spark.createDataFrame(left, "k int, t int, i int"), spark.createDataFrame(right, "k int, u int"), "t", "u", ["k"]).collect()
    want = {i: max((u for j, u in right if j == k and u is not None and t is not None and u <= t), default=None) for k, t, i in left}
    assert {x.i: x.u for x in got} == want and len(got) == len(left)


def test_ranks_of_fusion_against_counting(spark, monkeypatch):
    import random

    from folioql.functions import search

    monkeypatch.setattr(search, "RANGES", 9)
    r = random.Random(4)
    rows = [(i, r.choice([None, *range(40)]), float(r.randrange(500))) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, a int, b double").withColumn("a", F.col("a").cast("double"))
    got = {x.i: x.score for x in search.fuse(df, ["a", "b"]).collect()}
    rank = lambda k, v: 1 + sum(x[k] is not None and x[k] > v for x in rows)
    assert all(abs(got[i] - ((1 / (60 + rank(1, a)) if a is not None else 0) + 1 / (60 + rank(2, b)))) < 1e-12 for i, a, b in rows)
