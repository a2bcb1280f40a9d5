"""The registered queries over the driver's tables, with DuckDB SQL of the same meaning.

`orders_c` and `events_c` are containers made of table rows.  In `orders_c` a priority of 5-LOW is a
JSON null, a status of P is an absent property, and the label is a number in even rows and a string
in odd ones, so that null, absent and mixed types occur in every scale.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioql.functions import search
from folioql.functions import values as V
from folioql.operators import relational
from folioql.plans.planner import Engine
from folioql.sources.catalog import Catalog, LookupCache
from folioql.sources.container import MAP, ContainerMeta, create, point_read, point_read_batch, read_meta, route, scan, statistics, write_meta
from folioql.sources.dml import Container
from folioql.streaming.changes import changes, counts_by_window

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
PRIORITIES = "array('1-URGENT', '2-HIGH', '3-MEDIUM')"


def orders_documents(orders: DataFrame) -> DataFrame:
    """The `orders` table as rows of a container."""
    row = orders.selectExpr("*", f"filter({PRIORITIES}, x -> x >= o_orderpriority) AS _tags")
    null = F.parse_json(F.lit("null"))
    label = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("variant")).otherwise(F.col("o_custkey").cast("string").cast("variant"))
    entries = {
        "orderkey": F.col("o_orderkey").cast("variant"),
        "custkey": F.col("o_custkey").cast("variant"),
        "price": F.col("o_totalprice").cast("variant"),
        "status": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus").cast("variant")),
        "priority": F.when(F.col("o_orderpriority") == "5-LOW", null).otherwise(F.col("o_orderpriority").cast("variant")),
        "label": label,
        "ship": F.to_variant_object(F.struct(F.struct(F.col("o_orderstatus").alias("state")).alias("odd name"))),
        "tags": F.to_variant_object("_tags"),
    }
    document = F.to_variant_object(F.map_filter(F.create_map(*(x for k, c in entries.items() for x in (F.lit(k), c))), lambda _, v: v.isNotNull()))
    # behind a generator, so that Catalyst does not build the document again for every path that is read
    return row.select(F.explode(F.array(document)).alias("_MAP"), F.col("o_orderkey").cast("string").alias("id"), F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("_ts"), F.md5(F.col("o_orderkey").cast("string")).alias("_etag"))


def events_documents(events: DataFrame) -> DataFrame:
    return events.select(F.parse_json("props").alias("_MAP"), F.col("event_id").cast("string").alias("id"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("_ts"), "event_type", "user_id", "value")


def engine(spark: SparkSession, sf_dir: str) -> Engine:
    catalog = Catalog(spark)
    for t in TABLES:
        catalog.add_view(t, _Lazy(spark, f"{sf_dir}/{t}.parquet"))
    catalog.views["orders_c"] = _Lazy(spark, f"{sf_dir}/orders.parquet", orders_documents)
    catalog.views["events_c"] = _Lazy(spark, f"{sf_dir}/events.parquet", events_documents)
    catalog.views = _Views(catalog.views)
    return Engine(spark, catalog)


class _Lazy:
    def __init__(self, spark: SparkSession, path: str, made: Callable[[DataFrame], DataFrame] | None = None):
        self.spark, self.path, self.made = spark, path, made

    def df(self) -> DataFrame:
        table = self.spark.read.parquet(self.path)
        return self.made(table) if self.made else table


class _Views(dict):
    """Tables are opened when a statement names them."""

    def get(self, name, default=None):
        found = super().get(name, default)
        return found.df() if isinstance(found, _Lazy) else found


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
#: The hazards of `orders_c` in plain SQL.
O = """WITH o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, o_custkey AS cust, o_totalprice AS price, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
 CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority, o_orderstatus AS state, list_filter(['1-URGENT', '2-HIGH', '3-MEDIUM'], lambda x: x >= o_orderpriority) AS tags,
 CAST(epoch(o_orderdate) AS BIGINT) AS ts FROM orders) """  # noqa: E741


def statement(name: str, text: str, oracle: str, *params) -> None:
    """A statement of the engine's SQL, and what DuckDB is asked."""
    QUERIES[name] = lambda spark, sf_dir: engine(spark, sf_dir).sql(text, *params)
    SQL[name] = oracle


def query(oracle: str | None):
    """A function over (spark, sf_dir)."""

    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            SQL[f.__name__] = oracle
        return f

    return register


# --- scan, paths, routing ---------------------------------------------------------------------------

statement("scan_document", "SELECT CAST(_MAP['k'] AS BIGINT) AS k, id, event_type FROM events_c", "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(event_id AS VARCHAR) AS id, event_type FROM events")
statement("flagship", "SELECT event_type, COUNT(*) AS n, SUM(CAST(_MAP['k'] AS BIGINT)) AS s FROM events_c WHERE _MAP['k'] > 50 GROUP BY event_type", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS s FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) > 50 GROUP BY event_type")
statement("path_projection", "SELECT id, CAST(c._MAP['priority'] AS VARCHAR) AS priority, CAST(c._MAP['status'] AS VARCHAR) AS status FROM orders_c AS c", O + "SELECT id, priority, status FROM o")
statement("path_nested", "SELECT id, CAST(c._MAP['ship']['odd name']['state'] AS VARCHAR) AS state FROM orders_c AS c", O + "SELECT id, state FROM o")
statement("array_subscript", "SELECT id, CAST(c._MAP['tags'][0] AS VARCHAR) AS t0, CAST(c._MAP['tags'][1] AS VARCHAR) AS t1, CAST(c._MAP['tags'][3] AS VARCHAR) AS t3 FROM orders_c AS c", O + "SELECT id, NULL::VARCHAR AS t0, tags[1] AS t1, tags[3] AS t3 FROM o")

# --- predicates -------------------------------------------------------------------------------------

for _name, _where, _plain in (
    ("filter_eq", "_MAP['status'] = 'F'", "status = 'F'"),
    ("filter_ne_null", "_MAP['priority'] <> '1-URGENT'", "priority <> '1-URGENT'"),
    ("filter_not_null_logic", "NOT (_MAP['priority'] = '1-URGENT')", "NOT (priority = '1-URGENT')"),
    ("filter_not_and", "NOT (_MAP['priority'] = '1-URGENT' AND _MAP['price'] > 100000)", "NOT (priority = '1-URGENT' AND price > 100000)"),
    ("filter_not_or", "NOT (_MAP['status'] = 'F' OR _MAP['price'] > 100000)", "NOT (status = 'F' OR price > 100000)"),
    ("filter_compare", "_MAP['price'] < 50000 OR _MAP['price'] >= 200000", "price < 50000 OR price >= 200000"),
    ("filter_is_null", "_MAP['priority'] IS NULL", "priority IS NULL"),
    ("filter_not_null", "_MAP['status'] IS NOT NULL", "status IS NOT NULL"),
    ("filter_in", "_MAP['priority'] IN ('1-URGENT', '2-HIGH')", "priority IN ('1-URGENT', '2-HIGH')"),
    ("filter_not_in", "_MAP['priority'] NOT IN ('1-URGENT', '2-HIGH')", "priority NOT IN ('1-URGENT', '2-HIGH')"),
    ("filter_between", "_MAP['price'] BETWEEN 50000 AND 90000", "price BETWEEN 50000 AND 90000"),
    ("filter_not_between", "_MAP['price'] NOT BETWEEN 50000 AND 90000", "price NOT BETWEEN 50000 AND 90000"),
    ("filter_like_prefix", "_MAP['priority'] LIKE '1-%'", "priority LIKE '1-%'"),
    ("filter_like_inner", "_MAP['priority'] LIKE '%E_I%'", "priority LIKE '%E_I%'"),
    ("filter_not_like", "_MAP['priority'] NOT LIKE '1-%'", "priority NOT LIKE '1-%'"),
    ("filter_or_mixed", "_MAP['price'] > 150000 OR _MAP['status'] = 'O'", "price > 150000 OR status = 'O'"),
    ("filter_arith", "_MAP['price'] * 2 + 1 > 250000 AND NOT (_MAP['custkey'] % 7 = 3)", "price * 2 + 1 > 250000 AND NOT (cust % 7 = 3)"),
    ("filter_typed_literal", "_MAP['label'] > 50", "k % 2 = 0 AND cust > 50"),
    ("filter_is_true", "(_MAP['status'] = 'F') IS NOT TRUE", "(status = 'F') IS NOT TRUE"),
    ("filter_distinct_from", "_MAP['status'] IS NOT DISTINCT FROM 'F'", "status IS NOT DISTINCT FROM 'F'"),
    ("member_of", "'2-HIGH' MEMBER OF _MAP['tags']", "list_contains(tags, '2-HIGH')"),
    ("exists_subquery", "EXISTS (SELECT 1 FROM region WHERE r_name = 'ASIA') AND _MAP['status'] = 'O'", "EXISTS (SELECT 1 FROM region WHERE r_name = 'ASIA') AND status = 'O'"),
    ("in_subquery", "_MAP['custkey'] IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)", "cust IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)"),
    ("not_in_subquery", "_MAP['label'] NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)", "k % 2 = 1 OR cust NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)"),
    ("in_subquery_or", "_MAP['price'] > 200000 OR _MAP['custkey'] IN (SELECT c_custkey FROM customer WHERE c_acctbal > 8000)", "price > 200000 OR cust IN (SELECT c_custkey FROM customer WHERE c_acctbal > 8000)"),
    ("exists_correlated", "EXISTS (SELECT 1 FROM customer AS c WHERE c.c_custkey = _MAP['custkey'] AND c.c_acctbal > 5000)", "EXISTS (SELECT 1 FROM customer AS c WHERE c.c_custkey = cust AND c.c_acctbal > 5000)"),
    ("not_exists_correlated", "NOT EXISTS (SELECT 1 FROM customer AS c WHERE c.c_custkey = _MAP['custkey'] AND c.c_acctbal > 5000)", "NOT EXISTS (SELECT 1 FROM customer AS c WHERE c.c_custkey = cust AND c.c_acctbal > 5000)"),
    ("not_in_correlated", "_MAP['status'] NOT IN (SELECT b.o_orderstatus FROM orders AS b WHERE b.o_custkey = _MAP['custkey'] AND b.o_totalprice > 150000)", "status NOT IN (SELECT b.o_orderstatus FROM orders AS b WHERE b.o_custkey = cust AND b.o_totalprice > 150000)"),
    ("scalar_correlated", "_MAP['price'] < (SELECT MAX(b.o_totalprice) / 2 FROM orders AS b WHERE b.o_custkey = _MAP['custkey'])", "price < (SELECT max(b.o_totalprice) / 2 FROM orders AS b WHERE b.o_custkey = cust)"),
    ("nullif_filter", "NULLIF(_MAP['status'], 'F') IS NULL", "NULLIF(status, 'F') IS NULL"),
):
    statement(_name, f"SELECT id FROM orders_c WHERE {_where}", O + f"SELECT id FROM o WHERE {_plain}")

statement("bound_parameter", "SELECT id FROM orders_c WHERE _MAP['status'] = ? AND _MAP['price'] > ?", O + "SELECT id FROM o WHERE status = 'F' AND price > 100000", "F", 100000)
statement("case_expr", "SELECT id, CASE WHEN _MAP['status'] = 'F' THEN 1 ELSE 0 END AS f, CASE _MAP['priority'] WHEN '1-URGENT' THEN 'u' WHEN '2-HIGH' THEN 'h' END AS p, COALESCE(CAST(_MAP['priority'] AS VARCHAR), 'none') AS c FROM orders_c", O + "SELECT id, CASE WHEN status = 'F' THEN 1 ELSE 0 END AS f, CASE priority WHEN '1-URGENT' THEN 'u' WHEN '2-HIGH' THEN 'h' END AS p, coalesce(priority, 'none') AS c FROM o")
statement("cast_saturate", "SELECT id, CAST(_MAP['price'] * 1e9 AS INTEGER) AS big, CAST(_MAP['price'] AS INTEGER) AS whole, CAST(_MAP['label'] AS BIGINT) AS label FROM orders_c", O + "SELECT id, 2147483647 AS big, CAST(trunc(price) AS INTEGER) AS whole, CAST(cust AS BIGINT) AS label FROM o")
statement("safe_cast", "SELECT id, SAFE_CAST(_MAP['priority'] AS INTEGER) AS p, SAFE_CAST(_MAP['label'] AS DOUBLE) AS l FROM orders_c", O + "SELECT id, TRY_CAST(NULL AS INTEGER) AS p, CAST(cust AS DOUBLE) AS l FROM o")
statement("cast_text", "SELECT id FROM orders_c WHERE CAST(_MAP['label'] AS VARCHAR) = '7'", O + "SELECT id FROM o WHERE cust = 7")

# --- sort and limit ---------------------------------------------------------------------------------

statement("sort_desc", "SELECT id, CAST(_MAP['price'] AS DOUBLE) AS price FROM orders_c ORDER BY _MAP['price'] DESC, id LIMIT 50", O + "SELECT id, price FROM o ORDER BY price DESC, id LIMIT 50")
statement("sort_nulls_first", "SELECT id, CAST(_MAP['priority'] AS VARCHAR) AS p FROM orders_c ORDER BY _MAP['priority'] NULLS FIRST, id LIMIT 40", O + "SELECT id, priority AS p FROM o ORDER BY priority NULLS FIRST, id LIMIT 40")
statement("sort_nulls_last", "SELECT id, CAST(_MAP['status'] AS VARCHAR) AS s FROM orders_c ORDER BY _MAP['status'] DESC NULLS LAST, id LIMIT 40", O + "SELECT id, status AS s FROM o ORDER BY status DESC NULLS LAST, id LIMIT 40")
statement("sort_default_nulls", "SELECT id FROM orders_c ORDER BY _MAP['priority'] DESC, id FETCH NEXT 30 ROWS ONLY", O + "SELECT id FROM o ORDER BY priority DESC NULLS FIRST, id LIMIT 30")
statement("sort_multi", "SELECT id FROM orders_c ORDER BY _MAP['status'], _MAP['price'] DESC, id LIMIT 60", O + "SELECT id FROM o ORDER BY status NULLS LAST, price DESC, id LIMIT 60")
statement("sort_mixed_types", "SELECT id, _ts FROM orders_c WHERE _MAP['custkey'] < 60 ORDER BY _MAP['label'], id LIMIT 1000000", O + "SELECT id, ts AS _ts FROM o WHERE cust < 60 ORDER BY k % 2, CASE WHEN k % 2 = 0 THEN cust END, CAST(cust AS VARCHAR), id")
statement("sort_mixed_positions", "SELECT id, ROW_NUMBER() OVER (ORDER BY _MAP['label'], id) AS n FROM orders_c WHERE _MAP['custkey'] < 60", O + "SELECT id, CAST(row_number() OVER (ORDER BY k % 2, CASE WHEN k % 2 = 0 THEN cust END, CAST(cust AS VARCHAR), id) AS INTEGER) AS n FROM o WHERE cust < 60")
statement("topk", "SELECT TOP 10 id, _ts FROM orders_c ORDER BY _ts DESC, id", O + "SELECT id, ts AS _ts FROM o ORDER BY ts DESC, id LIMIT 10")
statement("offset_alone", "SELECT id FROM orders_c WHERE _MAP['custkey'] < 30 ORDER BY id OFFSET 20", O + "SELECT id FROM o WHERE cust < 30 ORDER BY id OFFSET 20")
statement("offset_fetch", "SELECT id FROM orders_c ORDER BY id OFFSET 20 ROWS FETCH NEXT 15 ROWS ONLY", O + "SELECT id FROM o ORDER BY id LIMIT 15 OFFSET 20")

# --- aggregates -------------------------------------------------------------------------------------

statement("count_star", "SELECT COUNT(*) AS n FROM orders_c", "SELECT count(*) AS n FROM orders")
statement("count_nullable", "SELECT COUNT(_MAP['priority']) AS p, COUNT(_MAP['status']) AS s, COUNT(_MAP['nothing']) AS z FROM orders_c", O + "SELECT count(priority) AS p, count(status) AS s, 0 AS z FROM o")
statement("sum_min_max_avg", "SELECT ROUND(SUM(_MAP['price']), 1) AS s, CAST(MIN(_MAP['price']) AS DOUBLE) AS lo, CAST(MAX(_MAP['price']) AS DOUBLE) AS hi, ROUND(AVG(_MAP['price']), 4) AS a, SUM(_MAP['label']) AS l FROM orders_c", O + "SELECT round(sum(price), 1) AS s, min(price) AS lo, max(price) AS hi, round(avg(price), 4) AS a, CAST(sum(cust) FILTER (WHERE k % 2 = 0) AS DOUBLE) AS l FROM o")
statement("avg_int_trunc", "SELECT c_nationkey, AVG(c_custkey) AS a FROM customer GROUP BY c_nationkey", "SELECT c_nationkey, CAST(sum(c_custkey) // count(c_custkey) AS BIGINT) AS a FROM customer GROUP BY c_nationkey")
statement("count_distinct", "SELECT COUNT(DISTINCT _MAP['priority']) AS p, COUNT(DISTINCT _MAP['label']) AS l FROM orders_c", O + "SELECT count(DISTINCT priority) AS p, count(DISTINCT CASE WHEN k % 2 = 0 THEN 'n' ELSE 's' END || cust) AS l FROM o")
statement("group_by_path", "SELECT CAST(_MAP['priority'] AS VARCHAR) AS p, COUNT(*) AS n, ROUND(SUM(_MAP['price']), 1) AS s FROM orders_c GROUP BY _MAP['priority']", O + "SELECT priority AS p, count(*) AS n, round(sum(price), 1) AS s FROM o GROUP BY priority")
statement("group_null_absent", "SELECT CAST(_MAP['status'] AS VARCHAR) AS s, CAST(_MAP['priority'] AS VARCHAR) AS p, COUNT(*) AS n FROM orders_c GROUP BY _MAP['status'], _MAP['priority']", O + "SELECT status AS s, priority AS p, count(*) AS n FROM o GROUP BY status, priority")
statement("rollup", "SELECT CAST(_MAP['priority'] AS VARCHAR) AS p, CAST(_MAP['status'] AS VARCHAR) AS s, COUNT(*) AS n FROM orders_c GROUP BY ROLLUP(_MAP['priority'], _MAP['status'])", O + "SELECT priority AS p, status AS s, count(*) AS n FROM o GROUP BY ROLLUP(priority, status)")
statement("cube", "SELECT l_returnflag, l_linestatus, COUNT(*) AS n, SUM(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY CUBE(l_returnflag, l_linestatus)", "SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY CUBE(l_returnflag, l_linestatus)")
statement("min_max_mixed", "SELECT CAST(MIN(_MAP['priority']) AS VARCHAR) AS lo, CAST(MAX(_MAP['priority']) AS VARCHAR) AS hi, CAST(MIN(_MAP['label']) AS BIGINT) AS least, CAST(MAX(_MAP['label']) AS VARCHAR) AS most FROM orders_c", O + "SELECT min(priority) AS lo, max(priority) AS hi, min(cust) FILTER (WHERE k % 2 = 0) AS least, max(CAST(cust AS VARCHAR)) FILTER (WHERE k % 2 = 1) AS most FROM o")
statement("rollup_avg", "SELECT CAST(_MAP['priority'] AS VARCHAR) AS p, CAST(_MAP['status'] AS VARCHAR) AS s, ROUND(AVG(_MAP['price']), 4) AS a, GROUPING(_MAP['status']) AS g FROM orders_c GROUP BY ROLLUP(_MAP['priority'], _MAP['status'])", O + "SELECT priority AS p, status AS s, round(avg(price), 4) AS a, CAST(GROUPING(status) AS INTEGER) AS g FROM o GROUP BY ROLLUP(priority, status)")
statement("count_distinct_rollup", "SELECT CAST(_MAP['status'] AS VARCHAR) AS s, COUNT(DISTINCT _MAP['custkey']) AS n FROM orders_c GROUP BY ROLLUP(_MAP['status'])", O + "SELECT status AS s, count(DISTINCT cust) AS n FROM o GROUP BY ROLLUP(status)")
statement("grouping_sets", "SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY GROUPING SETS((l_returnflag, l_linestatus), (l_linestatus), ())", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY GROUPING SETS((l_returnflag, l_linestatus), (l_linestatus), ())")
statement("having_key", "SELECT CAST(_MAP['status'] AS VARCHAR) AS s, COUNT(*) AS n FROM orders_c GROUP BY _MAP['status'] HAVING _MAP['status'] = 'F'", O + "SELECT status AS s, count(*) AS n FROM o GROUP BY status HAVING status = 'F'")
statement("having_agg", "SELECT _MAP['custkey'] % 100 AS c, COUNT(*) AS n FROM orders_c GROUP BY _MAP['custkey'] % 100 HAVING COUNT(*) > 10", O + "SELECT CAST(cust % 100 AS DOUBLE) AS c, count(*) AS n FROM o GROUP BY cust % 100 HAVING count(*) > 10")
statement("select_distinct", "SELECT DISTINCT CAST(_MAP['priority'] AS VARCHAR) AS p FROM orders_c ORDER BY p", O + "SELECT DISTINCT priority AS p FROM o ORDER BY p")
statement("agg_over_limit", "SELECT COUNT(*) AS n, MAX(id) AS m FROM (SELECT id FROM orders_c ORDER BY id LIMIT 17) AS t", O + "SELECT count(*) AS n, max(id) AS m FROM (SELECT id FROM o ORDER BY id LIMIT 17)")
statement("agg_over_agg", "SELECT MAX(n) AS m, COUNT(*) AS g FROM (SELECT COUNT(*) AS n FROM orders_c GROUP BY _MAP['custkey']) AS t", O + "SELECT max(n) AS m, count(*) AS g FROM (SELECT count(*) AS n FROM o GROUP BY cust)")
statement("agg_filter", "SELECT COUNT(*) FILTER (WHERE _MAP['status'] = 'F') AS f, SUM(_MAP['custkey']) FILTER (WHERE _MAP['price'] > 100000) AS s FROM orders_c", O + "SELECT count(*) FILTER (WHERE status = 'F') AS f, CAST(sum(cust) FILTER (WHERE price > 100000) AS DOUBLE) AS s FROM o")
statement("distinct_aggregates", "SELECT CAST(_MAP['status'] AS VARCHAR) AS s, SUM(DISTINCT _MAP['custkey']) AS t, AVG(DISTINCT _MAP['custkey']) AS a, MIN(DISTINCT o_custkey) AS m FROM (SELECT c._MAP AS _MAP, CAST(c._MAP['custkey'] AS BIGINT) AS o_custkey FROM orders_c AS c) AS t GROUP BY _MAP['status']", O + "SELECT status AS s, CAST(sum(DISTINCT cust) AS DOUBLE) AS t, avg(DISTINCT cust) AS a, min(cust) AS m FROM o GROUP BY status")
statement("statistics", "SELECT CAST(_MAP['priority'] AS VARCHAR) AS p, ROUND(STDDEV(_MAP['price']), 3) AS sd, ROUND(VAR_POP(_MAP['price']) / 1000000, 3) AS v, ROUND(PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY _MAP['price']), 4) AS q, PERCENTILE_DISC(0.5) WITHIN GROUP (ORDER BY _MAP['price'] DESC) AS d, ROUND(MEDIAN(_MAP['price']), 4) AS m, CARDINALITY(ARRAY_AGG(id)) AS n FROM orders_c GROUP BY _MAP['priority']",
          O + "SELECT priority AS p, round(stddev(price), 3) AS sd, round(var_pop(price) / 1000000, 3) AS v, round(quantile_cont(price, 0.25), 4) AS q, percentile_disc(0.5) WITHIN GROUP (ORDER BY price DESC) AS d, round(median(price), 4) AS m, CAST(count(*) AS INTEGER) AS n FROM o GROUP BY priority")
statement("listagg", "SELECT n_regionkey, LISTAGG(n_name, ',') WITHIN GROUP (ORDER BY n_name) AS l FROM nation GROUP BY n_regionkey", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS l FROM nation GROUP BY n_regionkey")
statement("listagg_documents", "SELECT CAST(_MAP['priority'] AS VARCHAR) AS p, LISTAGG(id, ',') WITHIN GROUP (ORDER BY _MAP['custkey'] DESC, _MAP['price']) AS l FROM orders_c WHERE _MAP['custkey'] < 30 GROUP BY _MAP['priority']", O + "SELECT priority AS p, string_agg(id, ',' ORDER BY cust DESC, price) AS l FROM o WHERE cust < 30 GROUP BY priority")
statement("listagg_mixed", "SELECT _MAP['custkey'] AS c, LISTAGG(id, ',') WITHIN GROUP (ORDER BY _MAP['status'] DESC NULLS LAST, _MAP['label'], id DESC) AS l FROM orders_c GROUP BY _MAP['custkey']".replace("_MAP['custkey'] AS c", "CAST(_MAP['custkey'] AS BIGINT) AS c"), O + "SELECT cust AS c, string_agg(id, ',' ORDER BY status DESC NULLS LAST, k % 2, id DESC) AS l FROM o GROUP BY cust")
statement("window_functions", "SELECT id, ROW_NUMBER() OVER (PARTITION BY _MAP['custkey'] ORDER BY _MAP['price'] DESC, id) AS rn, LAG(id) OVER (PARTITION BY _MAP['custkey'] ORDER BY id) AS before FROM orders_c", O + "SELECT id, CAST(row_number() OVER (PARTITION BY cust ORDER BY price DESC, id) AS INTEGER) AS rn, lag(id) OVER (PARTITION BY cust ORDER BY id) AS before FROM o")


@query("SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS DOUBLE) AS q, count(*) AS n FROM lineitem GROUP BY ROLLUP(l_returnflag, l_linestatus)")
def rollup_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return relational.rollup_by_partials(items, ["l_returnflag", "l_linestatus"], {"q": F.col("l_quantity"), "n": F.lit(1).cast("bigint")})


# --- joins and sets ---------------------------------------------------------------------------------

statement("lookup_join", "SELECT o.id, c.c_name FROM orders_c AS o JOIN customer AS c ON o._MAP['custkey'] = c.c_custkey", O + "SELECT o.id, c.c_name FROM o JOIN customer AS c ON o.cust = c.c_custkey")
statement("left_join", "SELECT c.c_custkey, o.id FROM customer AS c LEFT JOIN orders_c AS o ON c.c_custkey = o._MAP['custkey'] AND o._MAP['price'] > 150000", O + "SELECT c.c_custkey, o.id FROM customer AS c LEFT JOIN o ON c.c_custkey = o.cust AND o.price > 150000")
statement("full_join", "SELECT s.s_suppkey, c.c_custkey FROM supplier AS s FULL OUTER JOIN customer AS c ON s.s_suppkey = c.c_custkey AND c.c_acctbal > 0", "SELECT s.s_suppkey, c.c_custkey FROM supplier AS s FULL OUTER JOIN customer AS c ON s.s_suppkey = c.c_custkey AND c.c_acctbal > 0")
statement("semi_join", "SELECT c.c_custkey FROM customer AS c LEFT SEMI JOIN orders_c AS o ON o._MAP['custkey'] = c.c_custkey AND o._MAP['status'] = 'F'", O + "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT cust FROM o WHERE status = 'F')")
statement("anti_join", "SELECT c_custkey FROM customer AS c LEFT ANTI JOIN orders_c AS o ON o._MAP['custkey'] = c.c_custkey AND o._MAP['price'] > 200000 AND o._MAP['status'] = 'F' AND o._MAP['priority'] = '1-URGENT'", O + "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT cust FROM o WHERE price > 200000 AND status = 'F' AND priority = '1-URGENT')")
statement("right_join", "SELECT o.id, c.c_custkey FROM orders_c AS o RIGHT JOIN customer AS c ON o._MAP['custkey'] = c.c_custkey AND o._MAP['price'] > 200000", O + "SELECT o.id, c.c_custkey FROM o RIGHT JOIN customer AS c ON o.cust = c.c_custkey AND o.price > 200000")
statement("document_join", "SELECT a.id, b.id AS other FROM orders_c AS a JOIN orders_c AS b ON a._MAP['label'] = b._MAP['label'] AND a.id < b.id WHERE a._MAP['custkey'] < 200", O + "SELECT a.id, b.id AS other FROM o AS a JOIN o AS b ON a.cust = b.cust AND a.k % 2 = b.k % 2 AND a.id < b.id WHERE a.cust < 200")
statement("document_join_nulls", "SELECT COUNT(*) AS n, COUNT(b.id) AS m FROM orders_c AS a LEFT JOIN (SELECT _MAP['priority'] AS p, MIN(id) AS id FROM orders_c GROUP BY _MAP['priority']) AS b ON a._MAP['priority'] = b.p", O + "SELECT count(*) AS n, count(b.id) AS m FROM o AS a LEFT JOIN (SELECT priority AS p, min(id) AS id FROM o GROUP BY priority) AS b ON a.priority = b.p")
statement("non_equi_join", "SELECT r.r_name, n.n_name FROM region AS r JOIN nation AS n ON n.n_nationkey < r.r_regionkey * 3", "SELECT r.r_name, n.n_name FROM region AS r JOIN nation AS n ON n.n_nationkey < r.r_regionkey * 3")
statement("multi_key_join", "SELECT a.id, b.l_linenumber FROM orders_c AS a JOIN lineitem AS b ON a._MAP['orderkey'] = b.l_orderkey AND a._MAP['custkey'] % 10 = b.l_suppkey % 10", O + "SELECT a.id, b.l_linenumber FROM o AS a JOIN lineitem AS b ON a.k = b.l_orderkey AND a.cust % 10 = b.l_suppkey % 10")
statement("three_way_join", "SELECT r.r_name, COUNT(*) AS n FROM orders_c AS o JOIN customer AS c ON o._MAP['custkey'] = c.c_custkey JOIN nation AS n ON c.c_nationkey = n.n_nationkey JOIN region AS r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name", "SELECT r.r_name, count(*) AS n FROM orders AS o JOIN customer AS c ON o.o_custkey = c.c_custkey JOIN nation AS n ON c.c_nationkey = n.n_nationkey JOIN region AS r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name")
statement("cross_join", "SELECT r.r_name, n.n_name FROM region AS r CROSS JOIN nation AS n", "SELECT r.r_name, n.n_name FROM region AS r CROSS JOIN nation AS n")
statement("union_all", "SELECT _MAP['status'] = 'F' AS f FROM orders_c UNION ALL SELECT _MAP['k'] > 50 FROM events_c", O + "SELECT status = 'F' AS f FROM o UNION ALL SELECT CAST(json_extract(props, '$.k') AS BIGINT) > 50 FROM events")
statement("union_distinct", "SELECT CAST(v AS VARCHAR) AS v FROM (SELECT _MAP['status'] AS v FROM orders_c UNION SELECT _MAP['priority'] FROM orders_c) AS t", O + "SELECT status AS v FROM o UNION SELECT priority FROM o")
statement("intersect", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
statement("except", "SELECT CAST(v AS BIGINT) AS v FROM (SELECT _MAP['custkey'] AS v FROM orders_c EXCEPT SELECT _MAP['custkey'] FROM orders_c WHERE _MAP['status'] = 'F') AS t", O + "SELECT cust AS v FROM o EXCEPT SELECT cust FROM o WHERE status = 'F'")
statement("intersect_all", "SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier", "SELECT c_nationkey AS k FROM customer INTERSECT ALL SELECT s_nationkey FROM supplier")
statement("except_all_documents", "SELECT CAST(v AS VARCHAR) AS v FROM (SELECT _MAP['priority'] AS v FROM orders_c EXCEPT ALL SELECT _MAP['priority'] FROM orders_c WHERE _MAP['status'] = 'F') AS t", O + "SELECT priority AS v FROM o EXCEPT ALL SELECT priority FROM o WHERE status = 'F'")
statement("scalar_subquery", "SELECT id FROM orders_c WHERE _MAP['price'] > (SELECT AVG(o_totalprice) FROM orders)", O + "SELECT id FROM o WHERE price > (SELECT avg(o_totalprice) FROM orders)")
statement("scalar_correlated_count", "SELECT c.c_custkey, (SELECT COUNT(*) FROM orders_c AS o WHERE o._MAP['custkey'] = c.c_custkey AND o._MAP['status'] = 'F') AS n FROM customer AS c", O + "SELECT c.c_custkey, (SELECT count(*) FROM o WHERE o.cust = c.c_custkey AND o.status = 'F') AS n FROM customer AS c")
statement("scalar_correlated_value", "SELECT o.id, (SELECT c.c_name FROM customer AS c WHERE c.c_custkey = o._MAP['custkey']) AS name FROM orders_c AS o", O + "SELECT o.id, (SELECT c.c_name FROM customer AS c WHERE c.c_custkey = o.cust) AS name FROM o")
statement("scalar_correlated_groups", "SELECT t.mine, SUM(t.n) AS n, COUNT(*) AS m FROM (SELECT (SELECT COUNT(*) FROM orders AS b WHERE b.o_custkey = c.c_custkey) AS n, c.c_nationkey AS mine FROM customer AS c) AS t GROUP BY t.mine", "SELECT c.c_nationkey AS mine, CAST(count(o_orderkey) AS BIGINT) AS n, count(DISTINCT c_custkey) AS m FROM customer AS c LEFT JOIN orders ON o_custkey = c.c_custkey GROUP BY c.c_nationkey")
statement("cte", "WITH f AS (SELECT id, _MAP['custkey'] AS c FROM orders_c WHERE _MAP['status'] = 'F') SELECT COUNT(*) AS n, COUNT(DISTINCT c) AS d FROM f", O + "SELECT count(*) AS n, count(DISTINCT cust) AS d FROM o WHERE status = 'F'")


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'")
def view_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = engine(spark, sf_dir)
    e.catalog.add_view("places", "SELECT n.n_name, r.r_name FROM nation AS n JOIN region AS r ON n.n_regionkey = r.r_regionkey")
    return e.sql("SELECT n_name, r_name FROM places WHERE r_name <> 'ASIA'")


@query("SELECT e.event_id, (SELECT max(o.o_orderdate) FROM orders o WHERE o.o_custkey = e.user_id AND o.o_orderdate <= e.ts) AS last_order FROM events e")
def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.col("user_id").alias("who"), "ts")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("who"), "o_orderdate")
    return relational.as_of_join(events, orders, "ts", "o_orderdate", ["who"]).select("event_id", F.col("o_orderdate").alias("last_order"))


# --- arrays -----------------------------------------------------------------------------------------

statement("unnest", "SELECT c.id, CAST(t.x AS VARCHAR) AS x FROM orders_c AS c, UNNEST(c._MAP['tags']) AS t(x)", O + "SELECT id, unnest(tags) AS x FROM o")
statement("unnest_filter", "SELECT c.id FROM orders_c AS c, UNNEST(c._MAP['tags']) AS t(x) WHERE t.x = '3-MEDIUM' AND c._MAP['status'] = 'F'", O + "SELECT id FROM o WHERE list_contains(tags, '3-MEDIUM') AND status = 'F'")
statement("unnest_ordinality", "SELECT c.id, t.n, CAST(t.x AS VARCHAR) AS x FROM orders_c AS c LEFT JOIN UNNEST(c._MAP['tags']) WITH ORDINALITY AS t(x, n) ON TRUE", O + "SELECT id, CAST(n AS INTEGER) AS n, x FROM (SELECT id, unnest(tags) AS x, generate_subscripts(tags, 1) AS n FROM o UNION ALL SELECT id, NULL, NULL FROM o WHERE len(tags) = 0)")
statement("cardinality", "SELECT id, CARDINALITY(_MAP['tags']) AS n, CARDINALITY(_MAP['status']) AS z FROM orders_c", O + "SELECT id, CAST(len(tags) AS INTEGER) AS n, NULL::INTEGER AS z FROM o")
for _name, _call, _plain in (
    ("array_slice", "ARRAY_SLICE(_MAP['tags'], 1, 2)", "tags[2:3]"),
    ("array_union", "ARRAY_UNION(_MAP['tags'], ARRAY['2-HIGH', '9-X'])", "list_concat(list_distinct(tags), list_filter(['2-HIGH', '9-X'], lambda x: NOT list_contains(tags, x)))"),
    ("array_intersect", "ARRAY_INTERSECT(_MAP['tags'], ARRAY['2-HIGH', '3-MEDIUM', '3-MEDIUM'])", "list_filter(tags, lambda x: x IN ('2-HIGH', '3-MEDIUM'))"),
    ("array_concat", "ARRAY_CONCAT(_MAP['tags'], ARRAY['9-X'])", "list_concat(tags, ['9-X'])"),
):
    statement(_name, f"SELECT t.id, LISTAGG(CAST(u.x AS VARCHAR), '|') WITHIN GROUP (ORDER BY u.x) AS v FROM (SELECT id, {_call} AS a FROM orders_c) AS t, UNNEST(t.a) AS u(x) GROUP BY t.id", O + f"SELECT id, array_to_string(list_sort({_plain}), '|') AS v FROM o WHERE len({_plain}) > 0")

# --- scalar functions -------------------------------------------------------------------------------

statement("string_functions", "SELECT p_partkey, UPPER(p_name) AS u, LOWER(p_brand) AS l, CHAR_LENGTH(p_name) AS n, REPLACE(p_type, 'S', 'z') AS r, p_brand || '-' || p_type AS c, SUBSTRING(p_name FROM 2 FOR 4) AS s, SUBSTRING(p_name FROM 3) AS s2, POSITION('a' IN p_name) AS p, LEFT(p_name, 3) AS lf, RIGHT(p_name, 99) AS rt, REVERSE(p_brand) AS rv, REPEAT(p_brand, 2) AS rp FROM part",
          "SELECT p_partkey, upper(p_name) AS u, lower(p_brand) AS l, CAST(length(p_name) AS INTEGER) AS n, replace(p_type, 'S', 'z') AS r, p_brand || '-' || p_type AS c, substring(p_name, 2, 4) AS s, substring(p_name, 3) AS s2, CAST(position('a' IN p_name) AS INTEGER) AS p, left(p_name, 3) AS lf, right(p_name, 99) AS rt, reverse(p_brand) AS rv, repeat(p_brand, 2) AS rp FROM part")
statement("trim_functions", "SELECT p_partkey, TRIM('  ' || p_brand || ' ') AS a, LTRIM(' ' || p_brand) AS b, RTRIM(p_brand || ' ') AS c, TRIM(BOTH 'B' FROM p_brand) AS d, TRIM(LEADING 'B' FROM p_brand) AS e FROM part", "SELECT p_partkey, trim('  ' || p_brand || ' ') AS a, ltrim(' ' || p_brand) AS b, rtrim(p_brand || ' ') AS c, trim(p_brand, 'B') AS d, ltrim(p_brand, 'B') AS e FROM part")
statement("math_functions", "SELECT p_partkey, ABS(-p_retailprice) AS a, ROUND(EXP(p_size / 50.0), 9) AS e, ROUND(LN(p_retailprice), 9) AS ln, ROUND(LOG10(p_retailprice), 9) AS lg, ROUND(POWER(p_size, 2), 6) AS pw, ROUND(SQRT(p_retailprice), 9) AS sq, SIGN(p_size - 25) AS sg, ROUND(p_retailprice) AS r, FLOOR(p_retailprice) AS f, CEIL(p_retailprice) AS c, TRUNCATE(-p_retailprice) AS t, MOD(p_size, 7) AS m, p_size / 7 AS d, ROUND(CBRT(p_size), 9) AS cb FROM part",
          "SELECT p_partkey, abs(-p_retailprice) AS a, round(exp(p_size / 50.0), 9) AS e, round(ln(p_retailprice), 9) AS ln, round(log10(p_retailprice), 9) AS lg, round(power(p_size, 2), 6) AS pw, round(sqrt(p_retailprice), 9) AS sq, CAST(sign(p_size - 25) AS DOUBLE) AS sg, round(p_retailprice) AS r, floor(p_retailprice) AS f, ceil(p_retailprice) AS c, trunc(-p_retailprice) AS t, p_size % 7 AS m, CAST(p_size // 7 AS INTEGER) AS d, round(cbrt(p_size), 9) AS cb FROM part")
statement("math_functions_of_two", "SELECT p_partkey, ROUND(LOG(2, p_retailprice), 9) AS l, ROUND(p_retailprice / 7, 2) AS r, TRUNCATE(-p_retailprice / 7, 1) AS t, POSITION('a' IN p_name FROM 3) AS p FROM part", "SELECT p_partkey, round(ln(p_retailprice) / ln(2), 9) AS l, round(p_retailprice / 7, 2) AS r, trunc(-p_retailprice / 7 * 10) / 10 AS t, CAST(CASE WHEN position('a' IN substring(p_name, 3)) > 0 THEN position('a' IN substring(p_name, 3)) + 2 ELSE 0 END AS INTEGER) AS p FROM part")
statement("trig_functions", "SELECT p_partkey, ROUND(SIN(p_size), 9) AS s, ROUND(COS(p_size), 9) AS c, ROUND(TAN(p_size), 9) AS t, ROUND(COT(p_size), 9) AS ct, ROUND(ASIN(p_size / 100.0), 9) AS a, ROUND(ACOS(p_size / 100.0), 9) AS ac, ROUND(ATAN(p_size), 9) AS at, ROUND(ATAN2(p_size, 3), 9) AS a2, ROUND(DEGREES(p_size), 9) AS d, ROUND(RADIANS(p_size), 9) AS r, ROUND(PI(), 12) AS p FROM part",
          "SELECT p_partkey, round(sin(p_size), 9) AS s, round(cos(p_size), 9) AS c, round(tan(p_size), 9) AS t, round(cot(p_size), 9) AS ct, round(asin(p_size / 100.0), 9) AS a, round(acos(p_size / 100.0), 9) AS ac, round(atan(p_size), 9) AS at, round(atan2(p_size, 3), 9) AS a2, round(degrees(p_size), 9) AS d, round(radians(p_size), 9) AS r, round(pi(), 12) AS p FROM part")
statement("regexmatch", "SELECT p_partkey FROM part WHERE REGEXMATCH(p_type, '^s.*l$', 'i')", "SELECT p_partkey FROM part WHERE regexp_matches(p_type, '^s.*l$', 'i')")
statement("json_conversions", "SELECT id, ToString(_MAP['label']) AS s, StringToNumber(ToString(_MAP['label'])) AS n, StringToNumber('x') AS z, StringToBoolean('true') AS b, IS_OBJECT(StringToObject('{\"a\":1}')) AS o, IS_ARRAY(StringToArray('[1]')) AS a, CARDINALITY(_MAP['tags']) AS c FROM orders_c",
          O + "SELECT id, CAST(cust AS VARCHAR) AS s, CAST(cust AS DOUBLE) AS n, NULL::DOUBLE AS z, true AS b, true AS o, true AS a, CAST(len(tags) AS INTEGER) AS c FROM o")
statement("type_tests", "SELECT id, IS_DEFINED(_MAP['status']) AS d, IS_DEFINED(_MAP['priority']) AS dp, IS_NULL(_MAP['priority']) AS n, IS_NULL(_MAP['status']) AS ns, IS_NUMBER(_MAP['label']) AS num, IS_STRING(_MAP['label']) AS str, IS_ARRAY(_MAP['tags']) AS arr, IS_OBJECT(_MAP['ship']) AS obj, IS_BOOL(_MAP['label']) AS b, IS_PRIMITIVE(_MAP['priority']) AS p FROM orders_c",
          O + "SELECT id, status IS NOT NULL AS d, true AS dp, priority IS NULL AS n, false AS ns, k % 2 = 0 AS num, k % 2 = 1 AS str, true AS arr, true AS obj, false AS b, true AS p FROM o")
statement("object_to_array", "SELECT c.id, CARDINALITY(OBJECTTOARRAY(c._MAP['ship'])) AS n, ToString(t.e['k']) AS k, ToString(t.e['v']) AS v, CARDINALITY(OBJECTTOARRAY(c._MAP['tags'])) AS z FROM orders_c AS c, UNNEST(OBJECTTOARRAY(c._MAP['ship']['odd name'])) AS t(e)",
          O + "SELECT id, 1 AS n, 'state' AS k, state AS v, NULL::INTEGER AS z FROM o")
statement("json_conversions_of_columns", "SELECT event_id, CAST(StringToObject(props)['k'] AS BIGINT) AS k, CARDINALITY(StringToArray('[' || props || ',2]')) AS n, StringToBoolean(CASE WHEN value > 50 THEN 'true' ELSE 'no' END) AS b FROM events", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 2 AS n, CASE WHEN value > 50 THEN true END AS b FROM events")
statement("date_functions", "SELECT o_orderkey, EXTRACT(YEAR FROM o_orderdate) AS y, EXTRACT(QUARTER FROM o_orderdate) AS q, EXTRACT(DOY FROM o_orderdate) AS d, EXTRACT(WEEK FROM o_orderdate) AS w, CAST(FLOOR(o_orderdate TO MONTH) AS VARCHAR) AS m, CAST(TIMESTAMPADD(DAY, 40, o_orderdate) AS VARCHAR) AS a, TIMESTAMPDIFF(HOUR, TIMESTAMP '1995-01-01 00:00:00', o_orderdate) AS h FROM orders",
          "SELECT o_orderkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, dayofyear(o_orderdate) AS d, weekofyear(o_orderdate) AS w, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d %H:%M:%S') AS m, strftime(o_orderdate + INTERVAL 40 DAY, '%Y-%m-%d %H:%M:%S') AS a, CAST((epoch(o_orderdate) - epoch(TIMESTAMP '1995-01-01')) // 3600 AS INTEGER) AS h FROM orders")

# --- search -----------------------------------------------------------------------------------------

_TOKENS = r"list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '')"
statement("fulltext_contains", "SELECT doc_id FROM documents WHERE FULLTEXTCONTAINS(text, 'Then')", f"SELECT doc_id FROM documents WHERE list_contains({_TOKENS}, 'then')")
statement("fulltext_all", "SELECT doc_id FROM documents WHERE FULLTEXTCONTAINSALL(text, 'the', 'of', 'for')", f"SELECT doc_id FROM documents WHERE list_has_all({_TOKENS}, ['the', 'of', 'for'])")
statement("fulltext_any", "SELECT doc_id FROM documents WHERE FULLTEXTCONTAINSANY(text, 'license', 'und')", f"SELECT doc_id FROM documents WHERE list_has_any({_TOKENS}, ['license', 'und'])")


def _bm25(word: str, name: str) -> str:
    return f"""{name} AS (SELECT doc_id, CASE WHEN tf > 0 THEN ln(1 + ((SELECT count(*) FROM t) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / avgdl)) ELSE 0 END AS s
 FROM (SELECT doc_id, len(list_filter(ts, lambda x: x = '{word}')) AS tf, len(ts) AS n FROM t), (SELECT count(*) FILTER (WHERE list_contains(ts, '{word}')) AS df, avg(len(ts)) AS avgdl FROM t))"""


_T = f"WITH t AS (SELECT doc_id, {_TOKENS} AS ts FROM documents), "


@query(_T + _bm25("und", "a") + ", " + _bm25("the", "b") + " SELECT doc_id, round(a.s + b.s, 6) AS score FROM a JOIN b USING (doc_id) ORDER BY round(a.s + b.s, 6) DESC, doc_id LIMIT 20")
def bm25_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return search.with_bm25(docs, "text", ["und", "the"]).select("doc_id", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "doc_id").limit(20)


@query(_T + _bm25("und", "a") + ", " + _bm25("the", "b") + """, r AS (SELECT doc_id, rank() OVER (ORDER BY round(a.s, 6) DESC) AS ra, rank() OVER (ORDER BY round(b.s, 6) DESC) AS rb FROM a JOIN b USING (doc_id))
 SELECT doc_id, round(1 / (60 + ra) + 2 / (60 + rb), 9) AS score FROM r ORDER BY round(1 / (60 + ra) + 2 / (60 + rb), 9) DESC, doc_id LIMIT 20""")
def rrf_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = search.with_bm25(search.with_bm25(docs, "text", ["und"], "a"), "text", ["the"], "b").select("doc_id", F.round("a", 6).alias("a"), F.round("b", 6).alias("b"))
    fused = search.fuse(scored, ["a", "b"], weights=[1.0, 2.0])
    return fused.select("doc_id", F.round("score", 9).alias("score")).orderBy(F.desc("score"), "doc_id").limit(20)


statement("vector_rank", "SELECT vec_id FROM embeddings ORDER BY ROUND(VECTORDISTANCE(embedding, (SELECT embedding FROM embeddings WHERE vec_id = 0)), 9) DESC, vec_id LIMIT 10", "SELECT vec_id FROM embeddings ORDER BY round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)), 9) DESC, vec_id LIMIT 10")
statement("vector_distance", "SELECT vec_id, ROUND(VECTORDISTANCE(embedding, (SELECT embedding FROM embeddings WHERE vec_id = 1)), 6) AS d FROM embeddings", "SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 1)), 6) AS d FROM embeddings")

statement("rank_by_fusion", "SELECT doc_id FROM documents ORDER BY RRF(FULLTEXTSCORE(text, 'und'), FULLTEXTSCORE(text, 'license', 'the')), doc_id LIMIT 5",
          _T + _bm25("und", "a") + ", " + _bm25("license", "l") + ", " + _bm25("the", "b") + " SELECT doc_id FROM (SELECT doc_id, rank() OVER (ORDER BY a.s DESC) AS ra, rank() OVER (ORDER BY l.s + b.s DESC) AS rb FROM a JOIN l USING (doc_id) JOIN b USING (doc_id)) ORDER BY 1 / (60 + ra) + 1 / (60 + rb) DESC, doc_id LIMIT 5")

# --- containers on disk -----------------------------------------------------------------------------


def _folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return f"{spark.conf.get('spark.checkpoint.dir', None) or spark.conf.get('spark.sql.warehouse.dir')}/folioql-{uuid.uuid4()}"


def _stored(spark: SparkSession, sf_dir: str) -> Container:
    """All orders as a written container, keyed by status: two of its three keys hold nearly all documents."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    entries = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"))
    meta, path = ContainerMeta("stored", ("/status",), promoted={"/price": "double"}, buckets=16), _folder(spark)
    create(orders.select(F.to_variant_object(entries).alias("doc")), meta, path, now=0)
    return Container(spark, meta, path)


def _sql(c: Container) -> Engine:
    catalog = Catalog(c.spark)
    catalog.add("shop", c)
    return Engine(c.spark, catalog)


def _shown(df: DataFrame) -> DataFrame:
    return df.select("id", V.text(V.path(F.col(MAP), "status")).alias("status"), V.num(V.path(F.col(MAP), "price")).alias("price"))


_S = "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, o_totalprice AS price FROM orders"
_OPEN = "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 3)"


@query(_S + " WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'F')")
def container_point_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _stored(spark, sf_dir)
    key = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderstatus = 'F'").agg(F.max("o_orderkey")).first()[0]
    return _shown(point_read(scan(spark, c.meta, c.path), c.meta, str(key), "F"))


@query(_S + f" WHERE o_orderkey IN {_OPEN}")
def container_point_read_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _stored(spark, sf_dir)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    keys = [str(r[0]) for r in orders.where("o_orderstatus = 'O'").orderBy("o_orderkey").limit(3).union(orders.where("o_orderstatus = 'F'").limit(1)).select("o_orderkey").collect()]
    return _shown(point_read_batch(scan(spark, c.meta, c.path), c.meta, [*keys, keys[0]], "O"))  # the last is in another partition


@query(_S + " WHERE o_orderstatus = 'P'")
def container_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _stored(spark, sf_dir)
    return _shown(route(scan(spark, c.meta, c.path), c.meta, "P"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, o_totalprice AS price FROM orders WHERE o_orderstatus IN ('P', 'F') AND o_totalprice BETWEEN 90000 AND 120000")
def container_sql_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(_stored(spark, sf_dir)).sql("SELECT id, CAST(_MAP['price'] AS DOUBLE) AS price FROM stored WHERE status IN ('P', 'F') AND _MAP['price'] BETWEEN 90000 AND 120000")


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS priority FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) FROM {_OPEN})")
def container_sql_point_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderstatus = 'O'").agg(F.min("o_orderkey")).first()[0]
    return _sql(_stored(spark, sf_dir)).sql("SELECT id, CAST(_MAP['priority'] AS VARCHAR) AS priority FROM stored WHERE id = ? AND status = ?", str(key), "O")


@query(_S + f" WHERE o_orderkey IN {_OPEN}")
def container_cached_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of one partition through the lookup cache: the second read finds all of them there."""
    c = _stored(spark, sf_dir)
    c.cache = LookupCache()
    keys = [str(r[0]) for r in spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderstatus = 'O'").orderBy("o_orderkey").limit(3).select("o_orderkey").collect()]
    c.read_items(keys[:2], "O")
    rows = c.read_items([*keys, "nothing"], "O")
    return spark.createDataFrame([(r["id"], r["status"].toPython(), r[MAP].toPython()["price"]) for r in rows], "id string, status string, price double")


@query("SELECT count(*) AS documents, count(DISTINCT o_orderstatus) AS keys, CAST(count(*) > 0 AS BOOLEAN) AS has_bytes FROM orders")
def container_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declaration of a container read back, and its statistics."""
    c = _stored(spark, sf_dir)
    write_meta(spark, c.meta, c.path)
    found = statistics(spark, read_meta(spark, c.path), c.path)
    return spark.createDataFrame([(found["documents"], found["keys"], found["bytes"] > 0)], "documents long, keys long, has_bytes boolean")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, CASE WHEN n_regionkey = 0 THEN 'none:' WHEN n_regionkey = 1 THEN 'null:' ELSE 'n:' || n_regionkey END AS key, CASE WHEN n_regionkey > 1 THEN n_name ELSE n_name || '!' END AS name FROM nation WHERE n_regionkey <> 4")
def container_missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose key is absent or null are partitions of their own: one is deleted, two are replaced, by SQL and by key."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = F.when(F.col("n_regionkey") == 1, F.parse_json(F.lit("null"))).when(F.col("n_regionkey") > 1, F.col("n_regionkey").cast("variant"))
    entries = F.create_map(F.lit("id"), F.col("n_nationkey").cast("string").cast("variant"), F.lit("name"), F.col("n_name").cast("variant"), F.lit("region"), region)
    meta, path = ContainerMeta("nations", ("/region",), buckets=4), _folder(spark)
    create(nation.select(F.to_variant_object(F.map_filter(entries, lambda _, v: v.isNotNull())).alias("doc")), meta, path, now=0)
    c = Container(spark, meta, path)
    document = F.col(MAP)
    fields = F.try_variant_get(document, "$", "map<string,variant>")
    louder = F.to_variant_object(F.transform_values(fields, lambda k, v: F.when(k == "name", F.concat(V.text(v), F.lit("!")).cast("variant")).otherwise(v)))
    c.replace_where(F.col("region").isNull(), louder)
    _sql(c).sql("DELETE FROM nations WHERE region = 4")
    return c.df().select("id", F.col("_pk0").alias("key"), V.text(V.path(document, "name")).alias("name"))


@query(_S + " UNION ALL SELECT 'x' || o_orderkey, 'X', o_totalprice + 1 FROM orders WHERE o_orderstatus = 'P'")
def dml_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _stored(spark, sf_dir)
    new = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderstatus = 'P'")
    c.insert(new.select(F.to_variant_object(F.struct(F.concat(F.lit("x"), "o_orderkey").alias("id"), F.lit("X").alias("status"), (F.col("o_totalprice") + 1).alias("price"), F.lit(5).alias("_ts"))).alias("doc")), now=1)
    return _shown(c.df())


@query(_S + " WHERE NOT (o_orderpriority LIKE '1%')")
def dml_delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _stored(spark, sf_dir)
    c.delete_where(V.text(V.path(F.col(MAP), "priority")).startswith("1"))
    return _shown(c.df())


@query(_S + " WHERE o_orderstatus <> 'F'")
def dml_delete_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _stored(spark, sf_dir)
    c.delete_partition("F")
    return _shown(c.df())


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS price FROM orders")
def dml_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _stored(spark, sf_dir)
    value = lambda name: V.path(F.col(MAP), name)
    c.replace_where(V.text(value("status")) == "P", F.to_variant_object(F.struct(F.col("id"), V.text(value("status")).alias("status"), (-V.num(value("price"))).alias("price"))))
    return _shown(c.df())


@query(_S + " UNION ALL SELECT 'n' || n_nationkey, 'N', CAST(n_regionkey AS DOUBLE) FROM nation")
def dml_sql_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _sql(_stored(spark, sf_dir))
    e.catalog.add_view("nation", spark.read.parquet(f"{sf_dir}/nation.parquet"))
    e.sql("INSERT INTO stored (_MAP, id, status) SELECT MAP['price', n_regionkey], 'n' || CAST(n_nationkey AS VARCHAR), 'N' FROM nation")
    return _shown(e.catalog.container("stored").df())


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 200000 THEN 0 ELSE o_totalprice END AS price FROM orders")
def dml_sql_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _sql(_stored(spark, sf_dir))
    e.sql("UPDATE stored SET _MAP = MAP['id', id, 'status', status, 'price', 0] WHERE status = 'O' AND _MAP['price'] > 200000")
    return _shown(e.catalog.container("stored").df())


@query(_S + " WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 100000)")
def dml_sql_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _sql(_stored(spark, sf_dir))
    e.sql("DELETE FROM stored WHERE status = 'F' AND _MAP['price'] < 100000")
    return _shown(e.catalog.container("stored").df())


# --- streams ----------------------------------------------------------------------------------------


@query("SELECT CAST(0 AS BIGINT) AS start, count(*) AS n FROM orders UNION ALL SELECT 900, count(*) FROM orders WHERE o_orderstatus = 'P'")
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written to a container by windows of five minutes, as a stream that reads what is there and ends."""
    c = _stored(spark, sf_dir)
    new = spark.read.parquet(f"{sf_dir}/orders.parquet").where("o_orderstatus = 'P'")
    c.insert(new.select(F.to_variant_object(F.struct(F.concat(F.lit("x"), "o_orderkey").alias("id"), F.lit("X").alias("status"))).alias("doc")), now=1000)
    name = f"counted_{uuid.uuid4().hex}"
    stream = counts_by_window(changes(spark, c.meta, c.path), "5 minutes", "1 minute").writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    stream.awaitTermination()
    return spark.table(name).select(F.unix_seconds("window.start").alias("start"), "n")
