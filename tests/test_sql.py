"""The engine's SQL over documents with null, absent and mistyped values; expected rows worked out from SQL's meaning."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from fixture_documents import READINGS, SHIPMENTS
from folioql.metrics import Metrics
from folioql.plans.parser import SqlError
from folioql.plans.planner import Engine
from folioql.sources.catalog import Catalog, LookupCache
from folioql.sources.container import ContainerMeta, create, read_meta, statistics, write_meta
from folioql.sources.dml import Container, DuplicateDocument


def build(spark, folder, cache=None):
    catalog = Catalog(spark)
    for name, docs, key, promoted in (("shipments", SHIPMENTS, "/port", {"/tons": "double", "/vessel": "string"}), ("readings", READINGS, "/site", {"/value": "double"})):
        meta = ContainerMeta(name, (key,), promoted=promoted, buckets=8)
        create(spark.createDataFrame([(d,) for d in docs], "j string").select(F.parse_json("j").alias("doc")), meta, f"{folder}/{name}", now=1000)
        catalog.add("db", Container(spark, meta, f"{folder}/{name}", cache))
    return Engine(spark, catalog)


@pytest.fixture(scope="module")
def engine(spark, tmp_path_factory):
    return build(spark, tmp_path_factory.mktemp("containers"))


def plain(v):
    return v.toPython() if hasattr(v, "toPython") else [plain(x) for x in v] if isinstance(v, list) else v


def rows(engine, text, *params):
    return [tuple(plain(v) for v in r) for r in engine.sql(text, *params).collect()]


def ids(engine, text):
    return "".join(sorted(r[0] for r in rows(engine, text)))


SHIPMENT_IDS = {
    "s.port = 'oslo'": "ab",
    "s.port = 7": "h",
    "s.port <> 'oslo'": "cde",
    "NOT (s.port = 'oslo')": "cde",
    "NOT (s.port <> 'oslo')": "ab",
    "NOT (s.port = 'oslo' AND s._MAP['tons'] > 60)": "acdefg",
    "NOT (s.port = 'oslo' OR s._MAP['tons'] > 60)": "",
    "s._MAP['tons'] IS NULL": "de",
    "s._MAP['tons'] IS NOT NULL": "abcfgh",
    "IS_DEFINED(s._MAP['tons'])": "abcdfgh",
    "IS_NULL(s._MAP['tons'])": "d",
    "NOT (s._MAP['tons'] > 60)": "afg",
    "s._MAP['tons'] NOT IN (55, 410)": "cfg",
    "s.port IN ('oslo', 'riga')": "abcde",
    "s.port NOT IN ('oslo', 'riga')": "",
    "s._MAP['tons'] BETWEEN 10 AND 100": "acg",
    "NOT (s._MAP['tons'] BETWEEN 10 AND 100)": "bf",
    "s._MAP['vessel'] LIKE 'S%'": "eh",
    "s._MAP['vessel'] LIKE '_mbe_'": "c",
    "s._MAP['vessel'] NOT LIKE 'S%'": "abcdfg",
    "s._MAP['vessel'] = 'Stork'": "e",
    "s._MAP['tons'] + 1 > 90": "bc",
    "NOT (s._MAP['tons'] + 1 > 90)": "afg",
    "s._MAP['tons'] > 60 OR s.port = 'riga'": "bcde",
    "s._MAP['broker']['code'] = 'K-7'": "b",
    "NOT (s._MAP['broker']['code'] = 'K-7')": "",
    "s._MAP['stops'][1] = 'hull'": "a",
    "CARDINALITY(s._MAP['stops']) = 2": "a",
    "'bergen' MEMBER OF s._MAP['stops']": "a",
    "(CASE WHEN s.port = 'oslo' THEN 1 ELSE 0 END) = 0": "cdefgh",
    "s.id = 'c' AND s.port = 'riga'": "c",
    "s._MAP['port'] = 'riga' AND s._MAP['tons'] >= 90": "c",
    "FULLTEXTCONTAINS(s._MAP['vessel'], 'heron')": "b",
    "FULLTEXTCONTAINSALL(s._MAP['vessel'], 'grey', 'heron')": "b",
    "FULLTEXTCONTAINSANY(s._MAP['vessel'], 'amber', 'stork')": "ce",
    "REGEXMATCH(CAST(s._MAP['vessel'] AS VARCHAR), '^s', 'i')": "eh",
    "s._MAP['tons'] IN (SELECT r._MAP['value'] FROM readings AS r)": "g",
    "s._MAP['tons'] NOT IN (SELECT r._MAP['value'] FROM readings AS r)": "",
    "s._MAP['tons'] NOT IN (SELECT r._MAP['value'] FROM readings AS r WHERE r._MAP['value'] IS NOT NULL)": "abcfh",
    "s._MAP['tons'] NOT IN (SELECT r._MAP['value'] FROM readings AS r WHERE r.id = '-')": "abcdefgh",
    "s.port = 'riga' OR s._MAP['tons'] IN (SELECT r._MAP['value'] FROM readings AS r)": "cdeg",
    "NOT (s._MAP['tons'] IN (SELECT r._MAP['value'] FROM readings AS r WHERE r.site = 'y') OR s.port = 'oslo')": "c",
    "EXISTS (SELECT 1 FROM readings AS r WHERE r._MAP['value'] = s._MAP['tons'])": "g",
    "NOT EXISTS (SELECT 1 FROM readings AS r WHERE r._MAP['value'] < s._MAP['tons'] AND r.site = 'y')": "deh",
    "s.port IN (SELECT q.port FROM shipments AS q WHERE q._MAP['tons'] > s._MAP['tons'])": "a",
    "s.port NOT IN (SELECT q.port FROM shipments AS q WHERE q._MAP['tons'] > s._MAP['tons'])": "bcdeh",
    "(SELECT COUNT(*) FROM readings AS r WHERE r._MAP['value'] = s._MAP['tons']) = 0": "abcdefh",
    "s._MAP['tons'] = (SELECT MAX(q._MAP['tons']) FROM shipments AS q WHERE q.port = s.port)": "bch",
    "s.port = 'oslo' OR (SELECT r._MAP['kind'] FROM readings AS r WHERE r._MAP['value'] = s._MAP['tons']) = 'Plain'": "abg",
}
READING_IDS = {
    "CAST(c._MAP['value'] AS INTEGER) = 12": "mno",
    "CAST(c._MAP['value'] AS INTEGER) > 9": "mno",
    "CAST(c._MAP['value'] AS INTEGER) = -4": "s",
    "CAST(c._MAP['value'] AS DOUBLE) = 12.9": "o",
    "CAST(c._MAP['value'] AS INTEGER) IS NULL": "pq",
    "CAST(c._MAP['mass'] AS INTEGER) = -2147483648": "u",
    "CAST(c._MAP['mass'] AS BIGINT) = -9223372036854775808": "u",
    "SAFE_CAST(c._MAP['value'] AS INTEGER) = 12": "mno",
    "SAFE_CAST(c._MAP['kind'] AS INTEGER) IS NULL": "mnopqrstu",
    "CAST(c._MAP['flag'] AS VARCHAR) = 'lamp'": "m",
    "CAST(c._MAP['flag'] AS VARCHAR) = '12'": "n",
    "CAST(c._MAP['flag'] AS VARCHAR) = 'false'": "o",
    "CAST(c.site AS VARCHAR) = '12'": "t",
    "CAST(c._MAP['value'] AS DECIMAL(10, 1)) = 12": "mn",
    "c._MAP['value'] = 12": "m",
    "EXTRACT(YEAR FROM c._MAP['at']) = 2024": "m",
}


@pytest.mark.parametrize("where", SHIPMENT_IDS)
def test_shipments(engine, where):
    assert ids(engine, f"SELECT s.id FROM shipments AS s WHERE {where}") == SHIPMENT_IDS[where]


@pytest.mark.parametrize("where", READING_IDS)
def test_readings(engine, where):
    assert ids(engine, f"SELECT c.id FROM readings AS c WHERE {where}") == READING_IDS[where]


def test_scalar_query_raises_only_for_rows_that_ask(engine):
    """Two readings have value 5 and two have none, which no shipment asks for; ports are asked for."""
    kind = "(SELECT r._MAP['kind'] FROM readings AS r WHERE r._MAP['value'] = s._MAP['tons'])"
    assert ids(engine, f"SELECT s.id FROM shipments AS s WHERE {kind} = 'Plain'") == "g"
    assert ids(engine, f"SELECT s.id FROM shipments AS s WHERE {kind} IS NULL") == "abcdefh"
    peer = "(SELECT q.id FROM shipments AS q WHERE q.port = s.port)"
    assert ids(engine, f"SELECT s.id FROM shipments AS s WHERE s.id = 'h' AND {peer} = 'h'") == "h"
    with pytest.raises(Exception, match="more than one row"):
        ids(engine, f"SELECT s.id FROM shipments AS s WHERE {peer} = 'a'")


def test_grouping_puts_null_and_absent_together(engine):
    groups = [("oslo", 2), ("riga", 3), (7, 1), (None, 2)]
    assert sorted(rows(engine, "SELECT port, COUNT(*) FROM shipments GROUP BY port"), key=str) == sorted(groups, key=str)
    assert sorted(rows(engine, "SELECT port, COUNT(*) FROM shipments GROUP BY ROLLUP(port)"), key=str) == sorted([*groups, (None, 8)], key=str)
    assert rows(engine, "SELECT COUNT(DISTINCT port), COUNT(port), COUNT(_MAP['tons']), COUNT(*) FROM shipments") == [(3, 6, 6, 8)]
    assert len(rows(engine, "SELECT DISTINCT port FROM shipments")) == 4


def test_grouping_sets_by_partials(engine):
    got = rows(engine, "SELECT port, AVG(_MAP['tons']) AS a, SUM(_MAP['tons']) AS s, COUNT(_MAP['tons']) AS n, GROUPING(port) AS g FROM shipments GROUP BY CUBE(port)")
    assert sorted(got, key=str) == sorted([("oslo", 232.5, 465.0, 2, 0), ("riga", 90.0, 90.0, 1, 0), (7, None, None, 1, 0), (None, 8.0, 16.0, 2, 0), (None, 571 / 5, 571.0, 6, 1)], key=str)
    assert rows(engine, "SELECT AVG(x), COUNT(*) FROM (VALUES (1), (2), (4)) AS t(x) GROUP BY ROLLUP(x) HAVING COUNT(*) = 3") == [(2, 3)]


def test_distinct_aggregates_by_partials(engine):
    got = rows(engine, "SELECT port, COUNT(DISTINCT _MAP['tons']) AS n, SUM(DISTINCT _MAP['tons']) AS s, COUNT(*) AS m, GROUPING(port) AS g FROM shipments GROUP BY CUBE(port)")
    assert sorted(got, key=str) == sorted([("oslo", 2, 465.0, 2, 0), ("riga", 1, 90.0, 3, 0), (7, 1, None, 1, 0), (None, 2, 16.0, 2, 0), (None, 6, 571.0, 8, 1)], key=str)
    table = "(VALUES ('a', 1, 'p'), ('a', 1, 'q'), ('b', 1, 'p'), ('b', 4, 'p'), ('b', 4, 'q')) AS t(k, x, y)"
    calls = "COUNT(DISTINCT x), SUM(DISTINCT x), AVG(DISTINCT x), SUM(x), COUNT(*), COUNT(DISTINCT y) FILTER (WHERE x > 1)"
    groups = [("a", 1, 1, 1, 2, 2, 0), ("b", 2, 5, 2, 9, 3, 2)]
    assert sorted(rows(engine, f"SELECT k, {calls} FROM {table} GROUP BY ROLLUP(k)"), key=str) == sorted([*groups, (None, 2, 5, 2, 11, 5, 2)], key=str)
    assert sorted(rows(engine, f"SELECT k, {calls} FROM {table} GROUP BY k")) == groups
    assert rows(engine, f"SELECT {calls} FROM {table}") == [(2, 5, 2, 11, 5, 2)]


@pytest.mark.parametrize(
    "text",
    [
        "SELECT port, COUNT(DISTINCT _MAP['tons']) FROM shipments GROUP BY ROLLUP(port)",
        "SELECT port, SUM(DISTINCT _MAP['tons']), AVG(DISTINCT _MAP['tons']) FROM shipments GROUP BY port",
        "SELECT COUNT(DISTINCT _MAP['tons']), MAX(id) FROM shipments",
    ],
)
def test_distinct_values_are_not_read_in_comparisons(engine, text):
    lines = engine.explain(text).splitlines()
    sorts = ["\n".join(lines[i : i + 3]) for i, x in enumerate(lines) if x.endswith(") Sort")]
    assert sorts and not any("variant_get" in x for x in sorts)


def test_aggregates_of_mixed_values(engine):
    assert rows(engine, "SELECT MIN(_MAP['vessel']), MAX(_MAP['vessel']), MIN(_MAP['tons']), MAX(_MAP['tons']), MAX(_MAP['nothing']) FROM shipments") == [("Amber", "Stork", 4, "90", None)]
    assert rows(engine, "SELECT LISTAGG(id, '') WITHIN GROUP (ORDER BY _MAP['tons']) FROM shipments") == [("fgacbhde",)]
    assert rows(engine, "SELECT LISTAGG(id, '') WITHIN GROUP (ORDER BY port DESC NULLS LAST, _MAP['tons'] NULLS FIRST) FROM shipments") == [("decabhfg",)]
    assert rows(engine, "SELECT LISTAGG(id, '-') FROM shipments WHERE port = 'oslo'") == [("a-b",)]


def test_subscripts_and_slices(engine):
    assert rows(engine, "SELECT _MAP['stops'][0], _MAP['stops'][1], _MAP['stops'][2], _MAP['stops'][3] FROM shipments WHERE id = 'a'") == [(None, "hull", "bergen", None)]
    assert rows(engine, "SELECT ARRAY_SLICE(_MAP['stops'], 1, 1), ARRAY_SLICE(_MAP['stops'], 2, 1) FROM shipments WHERE id = 'a'") == [(["bergen"], [])]
    assert rows(engine, "SELECT ARRAY_UNION(_MAP['stops'], _MAP['stops']), ARRAY_INTERSECT(_MAP['stops'], ARRAY['bergen']) FROM shipments WHERE id = 'a'") == [(["hull", "bergen"], ["bergen"])]
    assert sorted(rows(engine, "SELECT c.id, t.x FROM shipments AS c, UNNEST(c._MAP['stops']) AS t(x)")) == [("a", "bergen"), ("a", "hull")]


def test_null_placement(engine):
    order = lambda how: "".join(r[0] for r in rows(engine, f"SELECT id FROM shipments ORDER BY {how}, id"))
    assert order("port NULLS FIRST") == "fghabcde"
    assert order("port") == "habcdefg"
    assert order("port DESC") == "fgcdeabh"
    assert order("_MAP['tons']") == "fgacbhde"


def test_paging_and_joins(engine):
    assert rows(engine, "SELECT id FROM shipments ORDER BY id OFFSET 2 ROWS FETCH NEXT 3 ROWS ONLY") == [("c",), ("d",), ("e",)]
    assert rows(engine, "SELECT id FROM shipments ORDER BY id OFFSET 6") == [("g",), ("h",)]
    assert ids(engine, "SELECT s.id FROM shipments AS s JOIN readings AS r ON s._MAP['tons'] = r._MAP['value'] + 7.0 OR s.id = r.id WHERE r.id = 't'") == "g"
    assert ids(engine, "SELECT id FROM shipments EXCEPT SELECT id FROM readings") == "abcdefgh"
    assert len(rows(engine, "SELECT port FROM shipments UNION SELECT site FROM readings")) == 7
    assert sorted(rows(engine, "SELECT port FROM shipments INTERSECT ALL SELECT port FROM shipments WHERE id IN ('a', 'f')"), key=str) == sorted([("oslo",), (None,)], key=str)
    assert sorted(rows(engine, "SELECT port FROM shipments EXCEPT ALL SELECT port FROM shipments WHERE id IN ('a', 'f')"), key=str) == sorted([("oslo",), ("riga",), ("riga",), ("riga",), (7,), (None,)], key=str)


@pytest.mark.parametrize("how", ["JOIN", "LEFT JOIN", "LEFT SEMI JOIN", "FULL JOIN"])
def test_documents_join_by_key(engine, how):
    text = f"SELECT s.id FROM shipments AS s {how} readings AS r ON s._MAP['tons'] = r._MAP['value']"
    assert ids(engine, text) == {"JOIN": "g", "LEFT SEMI JOIN": "g", "LEFT JOIN": "abcdefgh"}.get(how) if how != "FULL JOIN" else len(rows(engine, text)) == 16
    assert "NestedLoop" not in engine.explain(text) and "Cartesian" not in engine.explain(text)
    assert "NestedLoop" not in engine.explain("SELECT s.id FROM shipments AS s, readings AS r WHERE s._MAP['tons'] = r._MAP['value']")


def test_keys_and_promoted_paths_reach_the_files(engine):
    plan = engine.explain("SELECT s.id FROM shipments AS s WHERE s.port = 'riga' AND s._MAP['tons'] BETWEEN 10 AND 100")
    assert "PartitionFilters: [isnotnull(_bucket" in plan and "EqualTo(_pk0,s:riga)" in plan and "GreaterThanOrEqual(_p_tons,10.0)" in plan and "LessThanOrEqual(_p_tons,100.0)" in plan
    plan = engine.explain("SELECT s.id FROM shipments AS s JOIN readings AS r ON s.id = r.id WHERE r.site IN ('x', 'y') AND s._MAP['port'] = ?", "oslo")
    assert plan.count("PartitionFilters: [") == 2 and "In(_pk0, [s:x,s:y])" in plan and "EqualTo(_pk0,s:oslo)" in plan
    plan = engine.explain("SELECT id FROM readings WHERE CAST(_MAP['value'] AS INTEGER) = 12")
    assert "GreaterThan(_p_value,11.0)" in plan and "LessThan(_p_value,13.0)" in plan
    assert "_p_value" not in engine.explain("SELECT id FROM readings WHERE CAST(_MAP['value'] AS INTEGER) = 12 OR id = 'm'")
    assert "EqualTo(id,c)" in engine.explain("SELECT id FROM shipments WHERE id = 'c'")


def test_whole_numbers_and_casts(engine):
    assert rows(engine, "SELECT 7 / 2, -7 / 2, AVG(x) FROM (VALUES (1), (2)) AS t(x)") == [(3, -3, 1)]
    assert rows(engine, "SELECT CAST(1e30 AS INTEGER), CAST(-1e30 AS BIGINT), CAST(-2.9 AS INTEGER), SAFE_CAST('x' AS INTEGER), CAST('3.7' AS INTEGER), SAFE_CAST(1000.0 AS TINYINT)") == [(2**31 - 1, -(2**63), -2, None, 3, None)]


def test_dates(engine):
    got = rows(engine, "SELECT EXTRACT(QUARTER FROM d), EXTRACT(DOW FROM d), EXTRACT(DECADE FROM d), MONTH(d), TIMESTAMPADD(MONTH, 1, d), TIMESTAMPDIFF(DAY, d, TIMESTAMP '2024-03-31 00:00:00'), FLOOR(d TO MONTH), CEIL(d TO DAY) FROM (VALUES (TIMESTAMP '2024-01-31 12:00:00')) AS t(d)")
    assert got == [(1, 4, 202, 1, datetime.datetime(2024, 2, 29, 12), 59, datetime.datetime(2024, 1, 1), datetime.datetime(2024, 2, 1))]
    with pytest.raises(SqlError):
        engine.sql("SELECT EXTRACT(FORTNIGHT FROM DATE '2024-01-01')")


def test_ranking(engine):
    assert rows(engine, "SELECT id FROM shipments ORDER BY RANK FULLTEXTSCORE(_MAP['vessel'], 'heron') FETCH NEXT 1 ROWS ONLY") == [("b",)]
    text = "SELECT id FROM shipments ORDER BY RRF(FULLTEXTSCORE(_MAP['vessel'], 'north'), FULLTEXTSCORE(_MAP['vessel'], 'star')) LIMIT 1"
    assert rows(engine, text) == [("a",)]
    assert "SinglePartition" not in engine.explain(text)


def test_parameters_and_errors(engine):
    assert rows(engine, "SELECT id FROM shipments WHERE _MAP['tons'] = ?", 90) == [("c",)]
    for bad in ("SELECT nothing FROM shipments", "SELECT id FROM shipments WHERE", "SELECT FULLTEXTSCORE(_MAP['vessel'], 'x') FROM shipments", "SELECT NOFUNCTION(id) FROM shipments", "SELECT $ FROM shipments"):
        with pytest.raises(SqlError):
            engine.sql(bad)
    with pytest.raises(Exception, match="cannot cast|CAST_INVALID_INPUT"):
        engine.sql("SELECT CAST(_MAP['kind'] AS INTEGER) FROM readings").collect()


def test_writes(spark, tmp_path):
    engine = build(spark, tmp_path)
    assert rows(engine, "INSERT INTO shipments (_MAP, id, port) VALUES (MAP['vessel', 'New', 'tons', 3, '_ts', 9], 'k', 'kiel')") == [(1,)]
    with pytest.raises(DuplicateDocument):
        engine.sql("INSERT INTO shipments (id, port) VALUES ('c', 'riga')")
    with pytest.raises(ValueError, match="assigns"):
        engine.sql("INSERT INTO shipments (id, _ts) VALUES ('l', 5)")
    (doc,) = rows(engine, "SELECT ToString(_MAP) FROM shipments WHERE id = 'k'")
    assert json.loads(doc[0]) == {"id": "k", "port": "kiel", "vessel": "New", "tons": 3}
    assert rows(engine, "UPDATE shipments SET _MAP = MAP['id', 'k', 'port', 'kiel', 'vessel', 'Newer', 'tons', 8] WHERE id = 'k' AND port = 'kiel'") == [(1,)]
    assert ids(engine, "SELECT id FROM shipments WHERE _MAP['tons'] = 8 AND _MAP['vessel'] = 'Newer'") == "k"  # by promoted columns
    with pytest.raises(Exception, match="keeps its key"):
        engine.sql("UPDATE shipments SET _MAP = MAP['id', 'z', 'port', 'kiel'] WHERE id = 'k'")
    # an unknown condition keeps its row, and an emptied bucket has no rows left
    assert rows(engine, "DELETE FROM shipments WHERE _MAP['tons'] > 100") == [(1,)]
    assert ids(engine, "SELECT id FROM shipments") == "acdefghk"
    assert rows(engine, "DELETE FROM shipments WHERE port = 'riga'") == [(3,)]
    assert ids(engine, "SELECT id FROM shipments") == "afghk"
    # null and absent keys are different partitions
    container = engine.catalog.container("shipments")
    assert container.delete_partition(None) == 1
    assert ids(engine, "SELECT id FROM shipments") == "aghk"
    assert container.delete_partition(7) == 1 and not container.delete_item("nobody", "kiel") and container.delete_item("k", "kiel")
    assert ids(engine, "SELECT id FROM shipments") == "ag"
    assert engine.metrics.counts["documents written"] == 6 and engine.metrics.counts["write errors"] == 3
    assert not [p.name for p in tmp_path.iterdir() if "staged" in p.name]


def test_lookups_are_cached_until_a_write(spark, tmp_path):
    now = [0.0]
    cache = LookupCache(100, 60, lambda: now[0])
    container = build(spark, tmp_path, cache).catalog.container("shipments")
    assert [r.id for r in container.read_items(["c", "a", "e", "c"], "riga")] == ["c", "e"]
    assert cache.rows == 3  # absence is remembered too
    container.df = None  # nothing is read again
    assert [r.id for r in container.read_items(["e", "a"], "riga")] == ["e"]
    del container.df
    container.delete_item("e", "riga")
    assert cache.rows == 0 and [r.id for r in container.read_items(["e", "c"], "riga")] == ["c"]


def test_metadata_and_metrics(spark, tmp_path):
    seen = []
    engine = build(spark, tmp_path)
    engine.metrics = Metrics(seen.append)
    container = engine.catalog.container("shipments")
    write_meta(spark, container.meta, container.path)
    assert read_meta(spark, container.path) == container.meta
    found = statistics(spark, container.meta, container.path)
    assert found["documents"] == 8 and found["keys"] == 5 and found["bytes"] > 0 and 3 <= found["largest_bucket"] <= 8
    rows(engine, "SELECT id FROM shipments")
    with pytest.raises(SqlError):
        engine.sql("SELECT")
    assert [(s.name, s.error) for s in seen] == [("parse", None), ("plan", None), ("parse", "SqlError")]
