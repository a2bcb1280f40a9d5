"""Statements as DataFrames.  Every clause becomes the DataFrame call of the same meaning; Catalyst plans the rest.

Columns in scope are named `alias.column`.  An expression is planned to a Column and its kind:
`any` (a raw VARIANT value: absent and JSON null still differ), `anyarray`, or a Spark type name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioql.functions import scalar, search
from folioql.functions import values as V
from folioql.metrics import Metrics
from folioql.operators import relational
from folioql.plans.parser import SqlError, parse
from folioql.plans.pushdown import conjuncts, implied
from folioql.sources.catalog import Catalog
from folioql.sources.container import ID, MAP, hidden_columns

Typed = tuple[Column, str]
WHOLE = {"tinyint", "smallint", "int", "bigint"}
NUMBERS = WHOLE | {"float", "double"}
SCORING = {"fulltextscore", "rrf"}
AGGREGATES = {"count", "sum", "min", "max", "avg", "stddev", "stddev_pop", "stddev_samp", "variance", "var_pop", "var_samp", "listagg", "array_agg", "collect", "any_value", "bool_and", "bool_or", "every", "some", "approx_count_distinct", "grouping", "percentile_cont", "percentile_disc", "median", "approx_percentile"}
WINDOWS = {"row_number", "rank", "dense_rank", "percent_rank", "cume_dist", "ntile", "lag", "lead", "first_value", "last_value"}


def is_number(kind: str) -> bool:
    return kind in NUMBERS or kind.startswith("decimal")


@dataclass
class Scope:
    """Columns a clause may read: lower-cased (alias, column) to the column's name and kind."""

    columns: dict[tuple[str, str], tuple[str, str]]
    order: list[tuple[str, str]]
    replaced: list[tuple[tuple, Typed]]  # planned already: group keys, aggregates, scores

    @classmethod
    def of(cls, df: DataFrame, replaced=()) -> Scope:
        columns, order = {}, []
        for f in df.schema:
            alias, _, name = f.name.partition(".")
            columns[alias.lower(), name.lower()] = (f.name, kind_of(f.dataType))
            order.append((alias, name))
        return cls(columns, order, list(replaced))

    def find(self, parts: tuple[str, ...]) -> tuple[str, str] | None:
        low = [p.lower() for p in parts]
        if len(low) > 1 and (tuple(low[-2:]) in self.columns):
            return self.columns[tuple(low[-2:])]
        if len(low) == 1:
            found = [v for (_, n), v in self.columns.items() if n == low[0]]
            if len(found) > 1:
                raise SqlError(f"{parts[0]} is ambiguous")
            return found[0] if found else None
        return None


def kind_of(t: T.DataType) -> str:
    if isinstance(t, T.VariantType):
        return "any"
    if isinstance(t, T.ArrayType) and isinstance(t.elementType, T.VariantType):
        return "anyarray"
    return t.simpleString()


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def children(x):
    """The parts of a node that are expressions."""
    for part in x[1:] if isinstance(x, tuple) else x if isinstance(x, list) else ():
        if isinstance(part, tuple) and part and isinstance(part[0], str):
            yield part
        elif isinstance(part, (list, tuple)):
            yield from children(("", *part))
        elif isinstance(part, dict) and "kind" not in part:
            yield from children(("", *part.values()))


def find_calls(x, test) -> list[tuple]:
    if isinstance(x, tuple) and x and x[0] == "call" and test(x):
        return [x]
    return [c for part in children(x) for c in find_calls(part, test)]


def find_nodes(x, kind: str) -> list[tuple]:
    """The expressions of one kind in another, but for those of queries inside it."""
    if isinstance(x, tuple) and x and x[0] == kind:
        return [x]
    return [n for part in children(x) for n in find_nodes(part, kind)]


def single(q: dict) -> dict | None:
    """The select of a query that is nothing but a filtered list of rows or one aggregate of them."""
    body = q["body"] if q["kind"] == "query" and not q["ctes"] and not q["offset"] and q["fetch"] is None else q
    plain = body["kind"] == "select" and body["from"] and not body["group"] and not body["having"] and body["top"] is None
    return body if plain else None


def turned(c: Column, kind: str) -> Column:
    """A document value as a value of a type; null if it is none."""
    c = (V.num if is_number(kind) else V.boolean if kind == "boolean" else V.text)(c)
    return c.try_cast(kind) if kind in ("date", "timestamp") else c


def is_aggregate(x: tuple) -> bool:
    return x[1] in AGGREGATES and "over" not in x[3]


class Engine:
    """SQL over a catalog: `sql` returns rows as a DataFrame (for writes, one row with the count)."""

    def __init__(self, spark: SparkSession, catalog: Catalog | None = None, metrics: Metrics | None = None):
        self.spark, self.catalog, self.metrics = spark, catalog or Catalog(spark), metrics or Metrics()

    def sql(self, text: str, *params) -> DataFrame:
        with self.metrics.span("parse", text):
            statement = parse(text)
        with self.metrics.span("write" if statement["kind"] in ("insert", "delete", "update") else "plan", text):
            return self.run(statement, params)

    def explain(self, text: str, *params) -> str:
        df = self.sql(text, *params)
        return df._jdf.queryExecution().explainString(self.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))

    def run(self, statement: dict, params: tuple = ()) -> DataFrame:
        kind = statement["kind"]
        if kind == "explain":
            df = self.run(statement["of"], params)
            plan = df._jdf.queryExecution().explainString(self.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
            return self.spark.createDataFrame([(plan,)], "plan string")
        if kind in ("insert", "delete", "update"):
            return self.spark.createDataFrame([(self._write(statement, params),)], "ROWCOUNT long")
        df = Planner(self, params, {}).query(statement)
        return df.toDF(*unique([c.partition(".")[2] for c in df.columns]))

    def _write(self, statement: dict, params: tuple) -> int:
        container = self.catalog.container(*statement["table"])
        if container is None:
            raise SqlError(f"no container {'.'.join(statement['table'])}")
        planner = Planner(self, params, {})
        if statement["kind"] == "insert":
            rows = planner.query(statement["query"])
            names = statement["columns"] or [MAP, ID, *container.meta.key_columns]
            if len(names) != len(rows.columns):
                raise SqlError(f"{len(names)} columns, {len(rows.columns)} values")
            return self._touched(container.insert_rows(rows.toDF(*names)))
        alias = statement["alias"] or statement["table"][-1]
        plain = container.df()
        scope = Scope.of(planner.qualified(plain, alias))
        scope.columns = {k: (name.partition(".")[2], kind) for k, (name, kind) in scope.columns.items()}
        where = planner.condition(statement["where"], scope) if statement["where"] else F.lit(True)
        within = implied(statement["where"], alias, container.meta, planner.as_literal)
        if statement["kind"] == "delete":
            return self._touched(container.delete_where(where, within))
        sets = {c.lower(): x for c, x in statement["sets"]}
        if set(sets) != {MAP.lower()}:
            raise SqlError("only a whole document can be set: SET _MAP = ...")
        return self._touched(container.replace_where(where, planner.plan(sets[MAP.lower()], scope)[0], within=within))

    def _touched(self, rows: int) -> int:
        self.metrics.count("documents written", rows)
        return rows


def unique(names: list[str]) -> list[str]:
    seen: dict[str, int] = {}
    out = []
    for n in names:
        k = seen.get(n.lower(), 0)
        seen[n.lower()] = k + 1
        out.append(f"{n}_{k}" if k else n)
    return out


class Planner:
    def __init__(self, engine: Engine, params: tuple, ctes: dict):
        self.engine, self.params, self.ctes = engine, params, ctes
        self.pushed: tuple[tuple | None, bool] = (None, False)  # WHERE of the select at hand, and whether it reads one table

    # -- queries: columns of a result are named "q.name"

    def qualified(self, df: DataFrame, alias: str, columns=None) -> DataFrame:
        names = columns or df.columns
        return df.select(*(col(c).alias(f"{alias}.{n}") for c, n in zip(df.columns, names)))

    def query(self, q: dict) -> DataFrame:
        if q["kind"] == "query":
            inner = Planner(self.engine, self.params, dict(self.ctes))
            for name, columns, body in q["ctes"]:
                df = inner.query(body)
                inner.ctes[name.lower()] = df.toDF(*(columns or [c.partition(".")[2] for c in df.columns]))
            if q["body"]["kind"] == "select":
                return inner.select(q["body"], q["order"], q["offset"], q["fetch"])
            df = inner.query(q["body"])
            scope = Scope.of(df)
            listed = [(("col", (a, n)), n) for a, n in scope.order]
            keys = [inner.sort_column(inner.plan(inner.order_target(x, listed, scope), scope), d, n) for x, d, n, _ in q["order"]]
            return relational.page(df.orderBy(*keys) if keys else df, q["offset"], q["fetch"])
        if q["kind"] == "select":
            return self.select(q, [], 0, None)
        if q["kind"] == "set":
            left, right = self.query(q["left"]), self.query(q["right"])
            if len(left.columns) != len(right.columns):
                raise SqlError("set operations need equally many columns")
            return relational.set_operation(left, right, q["how"], q["all"])
        if q["kind"] == "values":
            empty = self.engine.spark.range(1).select()
            scope = Scope({}, [], [])
            rows = [empty.select(*(self.shown(self.plan(x, scope)).alias(f"q.EXPR${i}") for i, x in enumerate(r))) for r in q["rows"]]
            out = rows[0]
            for r in rows[1:]:
                out = out.union(r)
            return out
        raise SqlError(q["kind"])

    def table(self, t: tuple, outer: DataFrame | None = None) -> DataFrame:
        """A FROM item; UNNEST reads the rows to its left (`outer`)."""
        kind = t[0]
        if kind == "table":
            return self.qualified(self.source(t[1], t[2]), t[2])
        if kind == "query":
            before, self.pushed = self.pushed, (None, False)
            df = self.query(t[1])
            self.pushed = before
            return self.qualified(df, t[2], t[3] or [c.partition(".")[2] for c in df.columns])
        if kind == "unnest":
            return self.unnest(outer if outer is not None else self.engine.spark.range(1).select(), t, False)
        _, how, left, right, condition = t
        a = self.table(left, outer)
        if right[0] == "unnest":
            if condition and condition != ("on", ("lit", True)):
                raise SqlError("UNNEST joins ON TRUE")
            return self.unnest(a, right, how == "left")
        b = self.table(right, a)
        if how == "cross" or condition is None:
            return a.crossJoin(b)
        b = relational.lookup_side(b, how)
        both = Scope.of(a)
        both.columns |= Scope.of(b).columns
        if condition[0] == "using":
            x, y = Scope.of(a), Scope.of(b)
            on = F.lit(True)
            for n in condition[1]:
                on = on & self.matches(self.read(x.find((n,))), self.read(y.find((n,))))
        else:
            on = self.truth(condition[1], both)
        return a.join(b, on, how)

    def unnest(self, df: DataFrame, t: tuple, outer: bool) -> DataFrame:
        _, x, alias, columns, ordinal = t
        c, kind = self.plan(x, Scope.of(df))
        element = f"{alias}.{columns[0] if columns else alias}"
        elements = V.array(V.norm(c)) if kind == "any" else c
        # computed once: Catalyst repeats a generator's input in the filters it infers
        df, elements = df.select("*", F.explode(F.array(elements)).alias("_elements")), F.col("_elements")
        f = {(False, False): F.explode, (False, True): F.explode_outer, (True, False): F.posexplode, (True, True): F.posexplode_outer}[ordinal, outer]
        if not ordinal:
            return df.select("*", f(elements).alias(element)).drop("_elements")
        position = f"{alias}.{columns[1] if len(columns) > 1 else 'ORDINALITY'}"
        return df.select("*", f(elements).alias(position, element)).withColumn(position, col(position) + 1).drop("_elements")

    def source(self, name: list[str], alias: str = "") -> DataFrame:
        if len(name) == 1 and name[0].lower() in self.ctes:
            return self.ctes[name[0].lower()]
        container = self.engine.catalog.container(*name)
        if container is not None:
            df = container.df()
            where, lone = self.pushed
            test = implied(where, alias or name[-1], container.meta, self.as_literal, lone)
            return (df if test is None else df.where(test)).drop(*hidden_columns(container.meta))
        view = self.engine.catalog.views.get(name[-1].lower())
        if isinstance(view, DataFrame):
            return view
        if view is not None:
            df = Planner(self.engine, (), {}).query(parse(view))
            return df.toDF(*(c.partition(".")[2] for c in df.columns))
        return self.engine.spark.table(".".join(f"`{n}`" for n in name))

    def select(self, q: dict, order: list, offset: int, fetch: int | None) -> DataFrame:
        before, self.pushed = self.pushed, (q["where"], q["from"] is not None and q["from"][0] == "table")
        df = self.table(q["from"]) if q["from"] else self.engine.spark.range(1).select()
        self.pushed = before
        if q["top"] is not None:
            fetch = q["top"] if fetch is None else min(fetch, q["top"])
        if q["where"]:
            df = self.filtered(df, q["where"])
        items = self.expanded(q["items"], Scope.of(df))
        order = [(self.order_target(x, items, Scope.of(df)), d, n, r) for x, d, n, r in order]
        wanted = [x for x, _ in items] + [x for x, *_ in order] + ([q["having"]] if q["having"] else [])
        aggregates = [c for x in wanted for c in find_calls(x, is_aggregate)]
        df, looked = self.looked_up(df, [n for x in (*wanted, *(q["group"][1] if q["group"] else ())) for n in find_nodes(x, "scalar")])
        scope = Scope.of(df, looked)
        if q["group"] or aggregates or q["having"]:
            df, scope = self.aggregated(df, q["group"] or ("groupBy", [], None), aggregates, looked)
            if q["having"]:
                df = df.where(self.condition(q["having"], scope))
        df, scope, ranked = self.scored(df, scope, order, fetch)
        planned = [(self.plan(x, scope), name) for x, name in items]
        names = unique([n for _, n in planned])
        keys = []
        for x, direction, nulls, rank in order:
            typed = self.plan(x, scope)
            by_rank = rank or bool(find_calls(x, lambda c: c[1] in SCORING)) or (x[0] == "call" and x[1] == "vectordistance")
            keys.append(self.sort_column(typed, "desc", "last") if by_rank else self.sort_column(typed, direction, nulls))
        if q["distinct"]:
            out = relational.distinct(df.select(*(self.shown(t).alias(f"q.{n}") for (t, _), n in zip(planned, names))))
            again = Scope.of(out)
            keys = []
            for x, direction, nulls, _ in order:
                at = next((i for i, (y, _) in enumerate(items) if y == x), None)
                if at is None:
                    raise SqlError("DISTINCT is ordered by its own columns")
                keys.append(self.sort_column(self.read(again.find(("q", names[at]))), direction, nulls))
            return relational.page(out.orderBy(*keys) if keys else out, offset, fetch)
        df = df.select(*(self.shown(t).alias(f"q.{n}") for (t, _), n in zip(planned, names)), *self._sort_inputs(keys))
        if keys:
            df = df.orderBy(*(self._again(k, i) for i, k in enumerate(keys)))
        return relational.page(df, offset, fetch).drop(*(f"_o{i}" for i in range(len(keys))))

    # sort keys travel as hidden columns: they may read what is not selected

    def _sort_inputs(self, keys: list[Column]) -> list[Column]:
        self._directions = []
        out = []
        for i, k in enumerate(keys):
            base, how = self._split[id(k)]
            self._directions.append(how)
            out.append(base.alias(f"_o{i}"))
        return out

    def _again(self, key: Column, i: int) -> Column:
        return getattr(F.col(f"_o{i}"), self._directions[i])()

    def sort_column(self, typed: Typed, direction: str, nulls: str | None) -> Column:
        c, kind = typed
        base = V.sort_key(c) if kind == "any" else c
        how = f"{direction}_nulls_{nulls or ('last' if direction == 'asc' else 'first')}"
        key = getattr(base, how)()
        self._remember(key, base, how)
        return key

    def _remember(self, key: Column, base: Column, how: str) -> None:
        self.__dict__.setdefault("_split", {})[id(key)] = (base, how)
        self.__dict__.setdefault("_alive", []).append(key)

    def expanded(self, items: list, scope: Scope) -> list[tuple[tuple, str]]:
        out = []
        for k, (x, alias) in enumerate(items):
            if x[0] == "star":
                out += [(("col", (a, n)), n) for a, n in scope.order if x[1] is None or a.lower() == x[1].lower()]
            else:
                out.append((x, alias or (x[1][-1] if x[0] == "col" else f"EXPR${k}")))
        return out

    def order_target(self, x: tuple, items: list, scope: Scope) -> tuple:
        """Ordinals and output names stand for the selected expressions."""
        if x[0] == "lit" and isinstance(x[1], int) and not isinstance(x[1], bool) and items:
            if not 1 <= x[1] <= len(items):
                raise SqlError(f"no column {x[1]} to order by")
            return items[x[1] - 1][0]
        if x[0] == "col" and len(x[1]) == 1:
            named = [y for y, n in items if n.lower() == x[1][0].lower()]
            if named:
                return named[0]
        return x

    def filtered(self, df: DataFrame, condition: tuple) -> DataFrame:
        """IN and EXISTS over queries become semi and anti joins, below OR a looked-up mark; the other conjuncts one filter."""
        plain, marks = [], []
        for x in conjuncts(condition):
            negated = x[0] == "not"
            y = x[1] if negated else x
            if y[0] == "inquery":
                df = self.in_query(df, (*y[:3], y[3] != negated))
            elif y[0] == "exists":
                df = self.exists(df, y[1], negated)
            else:
                for node in find_nodes(x, "inquery"):
                    df, mark = self.marked(df, node, len(marks))
                    marks.append((node, mark))
                df, looked = self.looked_up(df, find_nodes(x, "scalar"), len(marks))
                marks += looked
                plain.append(x)
        if plain:
            scope = Scope.of(df, marks)
            test = self.truth(plain[0], scope)
            for x in plain[1:]:
                test = test & self.truth(x, scope)
            df = df.where(test)
        return df.drop(*(f"{kind}{k}" for kind in ("_in", "_sq") for k in range(len(marks))))

    def apart(self, body: dict, outer: DataFrame) -> tuple[Planner, DataFrame, list]:
        """The rows of a select by the conditions that read its own tables only, and its conditions that read others too."""
        rows = Planner(self.engine, self.params, dict(self.ctes))
        inner = rows.table(body["from"])
        own = Scope.of(inner)
        own_parts, outer_parts = [], []
        for x in conjuncts(body["where"]):
            (own_parts if all(own.find(n[1]) for n in find_nodes(x, "col")) else outer_parts).append(x)
        if outer_parts and (clash := {c.lower() for c in inner.columns} & {c.lower() for c in outer.columns}):
            raise SqlError(f"a correlated query needs aliases of its own: {sorted(clash)[0]}")
        for x in own_parts if outer_parts else ():
            inner = rows.filtered(inner, x)
        return rows, inner, outer_parts

    def looked_up(self, df: DataFrame, nodes: list[tuple], number: int = 0) -> tuple[DataFrame, list[tuple[tuple, Typed]]]:
        """Correlated scalar queries as columns: each is aggregated once by the keys that tie it to a row, and joined on them.

        Without an aggregate a query may give one row at most, as everywhere.
        """
        found: list[tuple[tuple, Typed]] = []
        for node in nodes:
            body = single(node[1])
            if body is None or any(n == node for n, _ in found):
                continue
            rows, inner, ties = self.apart(body, df)
            if not ties:
                continue
            if len(body["items"]) != 1 or body["items"][0][0][0] == "star":
                raise SqlError("a scalar query gives one column")
            name, item, own, keys, on = f"_sq{number + len(found)}", body["items"][0][0], Scope.of(inner), [], F.lit(True)
            for i, x in enumerate(ties):
                sides = x[2:4] if x[:2] == ("compare", "=") else ()
                reads = [[own.find(n[1]) is not None for n in find_nodes(y, "col")] for y in sides]
                mine = [y for y, r in zip(sides, reads) if r and all(r)]
                others = [y for y, r in zip(sides, reads) if not any(r)]
                if len(mine) != 1 or len(others) != 1:
                    raise SqlError("a correlated scalar query is tied to its row by equalities")
                key, same = self.tied(rows.plan(mine[0], own), self.plan(others[0], Scope.of(df)), f"{name}k{i}")
                keys.append(key.alias(f"{name}k{i}"))
                on = on & same
            calls = find_calls(item, is_aggregate)
            if calls:
                planned = [rows.aggregate(c, own) for c in calls]
                looked = inner.groupBy(*keys).agg(*(c.alias(f"{name}a{i}") for i, (c, _) in enumerate(planned)))
                empty = lambda call, c: F.coalesce(c, F.lit(0)) if call[1] in ("count", "approx_count_distinct") else c
                replaced = [(call, (empty(call, F.col(f"{name}a{i}")), kind)) for i, (call, (_, kind)) in enumerate(zip(calls, planned))]
            else:
                c, kind = rows.plan(item, own)
                looked = inner.groupBy(*keys).agg(F.first(c).alias(f"{name}a0"), F.count("*").alias(f"{name}n"))
                # behind the join: a key of several rows is no error while no row of `df` asks for it
                one = F.assert_true(F.coalesce(F.col(f"{name}n"), F.lit(0)) <= 1, "a scalar query gives more than one row")
                replaced = [(item, (F.when(one.isNull(), F.col(f"{name}a0")), kind))]
            extra = looked.columns
            df = df.join(relational.lookup_side(looked, "left"), on, "left")
            value, kind = self.plan(item, Scope.of(df, replaced))
            # a generator keeps conditions on a value that may raise from being moved below the join
            df = (df.withColumn(name, value) if calls else df.select("*", F.inline(F.array(F.struct(value.alias(name)))))).drop(*extra)
            found.append((node, (F.col(name), kind)))
        return df, found

    def tied(self, own: Typed, other: Typed, name: str) -> tuple[Column, Column]:
        """What the rows of a lookup are grouped by, and the test whether the group in column `name` is that of another value."""
        if own[1] == "any" and other[1] == "any":
            return V.canon_key(own[0]), V.canon_key(other[0]) == F.col(name)
        if own[1] == "any":
            own = turned(own[0], other[1]), other[1]
        return own[0], self.matches(other, (F.col(name), own[1]))

    def correlated(self, q: dict, outer: DataFrame) -> tuple[DataFrame, Column | None, dict]:
        """The rows of a plain query by what reads its own tables only, the rest of its WHERE as a join condition, and its select."""
        body = single(q)
        if body is None or find_calls(("", *(x for x, _ in body["items"])), is_aggregate):
            return self.query(q), None, {}
        _, inner, outer_parts = self.apart(body, outer)
        if not outer_parts:
            return self.query(q), None, {}
        own, both = Scope.of(inner), Scope.of(outer)
        both.columns |= own.columns
        both.columns |= {("", n): v for (_, n), v in own.columns.items()}  # a bare name is the inner query's
        on = self.truth(outer_parts[0], both)
        for x in outer_parts[1:]:
            on = on & self.truth(x, both)
        return inner, on, body

    def exists(self, df: DataFrame, q: dict, negated: bool) -> DataFrame:
        inner, on, _ = self.correlated(q, df)
        if on is None:
            inner, on = inner.limit(1).select(F.lit(1).alias("_e")), F.lit(True)
        return df.join(inner, on, "left_anti" if negated else "left_semi")

    def one_column(self, q: dict) -> tuple[DataFrame, str]:
        inner = self.query(q)
        if len(inner.columns) != 1:
            raise SqlError("IN needs a query of one column")
        return inner.toDF("_in.v"), Scope.of(inner.toDF("_in.v")).columns["_in", "v"][1]

    def in_query(self, df: DataFrame, x: tuple) -> DataFrame:
        """Values are equal by canonical key: one of another type is just not among them.  Null is unknown, as everywhere."""
        _, value, q, negated = x
        inner, on, body = self.correlated(q, df)
        if on is not None:
            typed, listed = self.plan(value, Scope.of(df)), self.plan(body["items"][0][0], Scope.of(inner))
            same = self.matches(typed, listed)
            if negated:  # a null on either side leaves it unknown, unless there is nothing to be among
                same = same | self.key(typed).isNull() | self.key(listed).isNull()
            return df.join(inner, on & same, "left_anti" if negated else "left_semi")
        inner, kind = self.one_column(q)
        typed, listed = self.plan(value, Scope.of(df)), (col("_in.v"), kind)
        if not negated:
            return df.join(inner, self.matches(typed, listed), "left_semi")
        key = self.key(listed) if "any" in (typed[1], kind) else listed[0]
        known = inner.agg(F.count("*").alias("n"), F.count(key).alias("k"))
        empty, whole = known.select(F.col("n") == 0).scalar(), known.select(F.col("n") == F.col("k")).scalar()
        own = self.key(typed) if "any" in (typed[1], kind) else typed[0]
        return df.join(inner, self.matches(typed, listed), "left_anti").where(empty | (whole & own.isNotNull()))

    def marked(self, df: DataFrame, node: tuple, number: int) -> tuple[DataFrame, Typed]:
        """A column with the truth of an IN over a query that stands below OR."""
        _, value, q, negated = node
        inner, kind = self.one_column(q)
        typed = self.plan(value, Scope.of(df))
        keys = inner.select(self.key((col("_in.v"), kind)).alias(f"_key{number}"))
        known = keys.agg(F.count("*").alias("n"), F.count(f"_key{number}").alias("k"))
        empty, whole = known.select(F.col("n") == 0).scalar(), known.select(F.col("n") == F.col("k")).scalar()
        found = keys.where(F.col(f"_key{number}").isNotNull()).distinct().withColumn(f"_hit{number}", F.lit(True))
        own = self.key(typed)
        df = df.join(found, own == F.col(f"_key{number}"), "left")
        test = F.when(F.col(f"_hit{number}"), True).when(empty | (whole & own.isNotNull()), False)
        df = df.withColumn(f"_in{number}", ~test if negated else test).drop(f"_key{number}", f"_hit{number}")
        return df, (F.col(f"_in{number}"), "boolean")

    # -- aggregation

    def aggregated(self, df: DataFrame, group: tuple, calls: list[tuple], looked=()) -> tuple[DataFrame, Scope]:
        how, keys, sets = group
        scope = Scope.of(df, looked)
        planned = [self.plan(k, scope) for k in keys]
        names = [f"k{i}" for i in range(len(keys))]
        documents = [n for n, (_, kind) in zip(names, planned) if kind == "any"]
        order = []
        for c in calls:
            if c not in order:
                order.append(c)
        distinct, read = {}, []  # the column and kind of each such call; what the columns read, and their expressions
        for i, c in enumerate(order):
            if found := self.distinct_argument(c, scope):
                form = c[2], c[3].get("filter"), found[1]
                if form not in [x for x, _ in read]:
                    read.append((form, found[0].alias(f"_d{len(read)}")))
                distinct[i] = f"_d{[x for x, _ in read].index(form)}", found[1]
        if read:  # computed once, behind a generator: aggregates that sort would compute them again in every comparison
            df = df.select("*", F.inline(F.array(F.struct(*(c for _, c in read)))))
        aggregates, kinds = [], []
        for i, c in enumerate(order):
            if c[1] == "grouping":
                column, kind = F.grouping(f"_k_k{keys.index(c[2][0])}").cast("int"), "int"
            elif i in distinct:
                column, kind = self.of_distinct(c[1], F.col(distinct[i][0]), distinct[i][1])
            else:
                column, kind = self.aggregate(c, scope)
            aggregates.append(column.alias(f"a{i}"))
            kinds.append(kind)
        index = {i: n for i, n in enumerate(names)}
        chosen = [[index[keys.index(x)] for x in s] for s in sets] if sets is not None else None
        if not keys:
            out = df.agg(*aggregates) if aggregates else df.agg(F.count("*").alias("_n")).drop("_n")
        else:
            keyed = {n: V.norm(c) if kind == "any" else c for n, (c, kind) in zip(names, planned)}
            parts = [([], aggregates[i]) if i in distinct else self.partial(c, scope, f"a{i}") for i, c in enumerate(order)] if how != "groupBy" else [None]
            if all(p is not None for p in parts):
                merged = [aggregates[i] if c[1] == "grouping" else p[1].alias(f"a{i}") for i, (c, p) in enumerate(zip(order, parts))]
                steps = [x for p in parts for x in p[0]] or [F.count("*").alias("_n")]
                out = relational.group_by_partials(df, keyed, steps, merged or [F.count("*").alias("_n")], how, chosen, documents, [f"_d{i}" for i in range(len(read))])
            else:
                out = relational.group(df, keyed, aggregates or [F.count("*").alias("_n")], how, chosen, documents)
        replaced = [(k, (col(n), kind)) for k, n, (_, kind) in zip(keys, names, planned)]
        replaced += [(c, (col(f"a{i}"), kind)) for i, (c, kind) in enumerate(zip(order, kinds))]
        return out, Scope({}, [], replaced)

    def partial(self, call: tuple, scope: Scope, name: str) -> tuple[list[Column], Column | None] | None:
        """An aggregate in two steps: columns of the finest groups, and their merge; None where there is no such form."""
        _, function, args, extra = call
        if function == "grouping":
            return [], None
        if extra.get("distinct") or function not in ("count", "sum", "min", "max", "avg"):
            return None
        if function != "avg":
            column, kind = self.aggregate(call, scope)
            if kind == "any":
                return None
            merge = {"count": lambda c: F.coalesce(F.sum(c), F.lit(0)), "sum": F.sum, "min": F.min, "max": F.max}[function]
            return [column.alias(f"{name}p")], merge(F.col(f"{name}p"))
        total, kind = self.aggregate((call[0], "sum", args, extra), scope)
        n, _ = self.aggregate((call[0], "count", args, extra), scope)
        (c, of) = self.plan(args[0], scope)
        if of == "any":  # numbers are counted, not all that is there
            c, of = V.num(c), "double"
            keep = self.condition(extra["filter"], scope) if "filter" in extra else F.lit(True)
            n = F.count(F.when(keep, c))
        sums, counts = F.sum(f"{name}s"), F.sum(f"{name}n")
        if of in WHOLE:
            mean = F.when(counts > 0, sums.cast("decimal(38,0)") / counts)
            merged = F.when(mean >= 0, F.floor(mean)).otherwise(F.ceil(mean)).cast(of)
        elif of.startswith("decimal"):
            return None
        else:
            merged = F.when(counts > 0, sums / counts)
        return [total.alias(f"{name}s"), n.alias(f"{name}n")], merged

    def listed(self, s: Column, sep: str, within: list, scope: Scope) -> Column:
        """LISTAGG in the order of its keys, each with its own direction and place of nulls; ties by the text."""
        keys = [(self.plan(x, scope), d, (nulls or ("last" if d == "asc" else "first")) == "first") for x, d, nulls in within]
        values = [V.sort_key(t[0]) if t[1] == "any" else t[0] for t, _, _ in keys]
        if all(d == "asc" and not first for _, d, first in keys):  # the order of structs, with nulls last
            row = F.struct(*(x.alias(f"{n}{i}") for i, v in enumerate(values) for n, x in (("n", v.isNull()), ("k", v))), s.alias("s"))
            return F.array_join(F.transform(F.sort_array(F.collect_list(F.when(s.isNotNull(), row))), lambda p: p["s"]), sep)
        row = F.struct(*(v.alias(f"k{i}") for i, v in enumerate(values)), s.alias("s"))

        def compare(a: Column, b: Column) -> Column:
            order = F.when(a["s"] < b["s"], -1).when(a["s"] > b["s"], 1).otherwise(0)
            for i, (_, direction, first) in reversed(list(enumerate(keys))):
                x, y = a[f"k{i}"], b[f"k{i}"]
                less = -1 if direction == "asc" else 1
                lone = F.when(x.isNull() & y.isNull(), order).when(x.isNull(), -1 if first else 1).when(y.isNull(), 1 if first else -1)
                order = lone.when(x < y, less).when(x > y, -less).otherwise(order)
            return order

        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(s.isNotNull(), row)), compare), lambda p: p["s"]), sep)

    def distinct_argument(self, call: tuple, scope: Scope) -> Typed | None:
        """What COUNT, SUM and AVG of DISTINCT values read; None for all else."""
        _, name, args, extra = call
        if not extra.get("distinct") or name not in ("count", "sum", "avg") or args[0][0] == "star":
            return None
        c, kind = self.plan(args[0], scope)
        if kind == "any":
            c, kind = (V.canon_key(c), "string") if name == "count" else (V.num(c), "double")
        return (F.when(self.condition(extra["filter"], scope), c) if "filter" in extra else c), kind

    def of_distinct(self, name: str, c: Column, kind: str) -> Typed:
        n = F.count_distinct(c)
        if name == "count":
            return n, "bigint"
        total = F.sum_distinct(c)
        if name == "sum":
            return total, "bigint" if kind in WHOLE else kind
        return self.whole_mean(total, n, kind) if kind in WHOLE else (total / n, "double")

    def whole_mean(self, total: Column, n: Column, kind: str) -> Typed:
        """Whole numbers have a whole average, toward zero."""
        mean = F.when(n > 0, total.cast("decimal(38,0)") / n)
        return F.when(mean >= 0, F.floor(mean)).otherwise(F.ceil(mean)).cast(kind), kind

    def aggregate(self, call: tuple, scope: Scope) -> Typed:
        _, name, args, extra = call
        if distinct := self.distinct_argument(call, scope):
            return self.of_distinct(name, *distinct)
        keep = self.condition(extra["filter"], scope) if "filter" in extra else None
        only = (lambda c: F.when(keep, c)) if keep is not None else (lambda c: c)
        if name == "count" and args[0][0] == "star":
            return F.count(only(F.lit(1))), "bigint"
        if name in ("percentile_cont", "percentile_disc", "median", "approx_percentile"):
            return self.percentile(name, args, extra, scope, only)
        c, kind = self.plan(args[0], scope)
        if name in ("count", "approx_count_distinct"):
            key = only(V.canon_key(c) if kind == "any" and name != "count" else V.norm(c) if kind == "any" else c)
            return (F.approx_count_distinct(key) if name != "count" else F.count(key)), "bigint"
        if name in ("any_value", "array_agg", "collect"):
            c = only(V.norm(c) if kind == "any" else c)
            return (F.any_value(c, True), kind) if name == "any_value" else (F.collect_list(c), "anyarray" if kind == "any" else f"array<{kind}>")
        if name == "listagg":
            s, sep = only(self.as_text((c, kind))), self.as_literal(args[1]) if len(args) > 1 else ","
            if "within" in extra:
                return self.listed(s, sep, extra["within"], scope), "string"
            return F.array_join(F.sort_array(F.collect_list(s)), sep), "string"
        if name in ("bool_and", "every", "bool_or", "some"):
            c = only(V.boolean(c) if kind == "any" else c)
            return (F.bool_and if name in ("bool_and", "every") else F.bool_or)(c), "boolean"
        if kind == "any" and name in ("min", "max"):  # by the order of mixed values
            value = only(V.norm(c))
            return (F.min_by if name == "min" else F.max_by)(value, V.sort_key(value)), "any"
        if kind == "any":  # numbers count; other values, null and absent are skipped
            c, kind = V.num(c), "double"
        c = only(c)
        if name == "avg" and kind in WHOLE:
            return self.whole_mean(F.sum(c), F.count(c), kind)
        result = {"sum": "bigint" if kind in WHOLE else kind, "min": kind, "max": kind}.get(name, "double")
        f = {"stddev": F.stddev_samp, "variance": F.var_samp}.get(name) or getattr(F, name)
        return f(c), result

    def percentile(self, name: str, args: list, extra: dict, scope: Scope, only) -> Typed:
        """Numbers only.  Exact ones count the distinct values of a group; the approximate one is bounded in memory."""
        if name in ("percentile_cont", "percentile_disc"):
            x, direction, _ = (extra.get("within") or [(args[-1], "asc", None)])[0]
            share = float(self.as_literal(args[0]))
        else:
            x, direction, share = args[0], "asc", 0.5 if name == "median" else float(self.as_literal(args[1]))
        c, kind = self.as_number(self.plan(x, scope))
        c, share = only(c), share if direction == "asc" else 1 - share
        if name == "approx_percentile":
            return F.percentile_approx(c, share), kind
        if name != "percentile_disc":
            return F.percentile(c.cast("double"), F.lit(share)), "double"
        ordered = F.sort_array(F.collect_list(c), direction == "asc")
        share = share if direction == "asc" else 1 - share
        return F.get(ordered, F.greatest(F.ceil(F.size(ordered) * F.lit(share)).cast("int") - 1, F.lit(0))), kind

    def windowed(self, call: tuple, scope: Scope) -> Typed:
        _, name, args, extra = call
        partition, order = extra["over"]
        keys = [self.comparable(self.plan(x, scope)) for x in partition]
        w = W.partitionBy(*keys).orderBy(*(self.sort_column(self.plan(x, scope), d, n) for x, d, n in order)) if order else W.partitionBy(*keys)
        if name in ("row_number", "rank", "dense_rank", "percent_rank", "cume_dist"):
            return getattr(F, name)().over(w), "double" if name in ("percent_rank", "cume_dist") else "int"
        if name == "ntile":
            return F.ntile(int(self.as_literal(args[0]))).over(w), "int"
        if name in ("lag", "lead", "first_value", "last_value"):
            c, kind = self.plan(args[0], scope)
            c = V.norm(c) if kind == "any" else c
            if name in ("lag", "lead"):
                return getattr(F, name)(c, int(self.as_literal(args[1])) if len(args) > 1 else 1).over(w), kind
            return (F.first(c) if name == "first_value" else F.last(c)).over(w), kind
        c, kind = self.aggregate((call[0], name, args, {k: v for k, v in extra.items() if k != "over"}), scope)
        return c.over(w), kind

    # -- ranking

    def scored(self, df: DataFrame, scope: Scope, order: list, fetch: int | None) -> tuple[DataFrame, Scope, bool]:
        """Add the columns of scoring functions that ORDER BY names."""
        calls = []
        for x, *_ in order:
            calls += [c for c in find_calls(x, lambda c: c[1] in SCORING) if c not in calls]
        for i, c in enumerate(calls):
            df, name = self.score(df, scope, c, f"_score{i}")
            scope.replaced.append((c, (F.col(name), "double")))
        return df, scope, bool(calls)

    def score(self, df: DataFrame, scope: Scope, call: tuple, name: str) -> tuple[DataFrame, str]:
        if call[1] == "fulltextscore":
            words = [self.as_literal(a) for a in call[2][1:]]
            df = df.withColumn(f"{name}t", self.as_text(self.plan(call[2][0], scope)))
            return search.with_bm25(df, f"{name}t", words, name).drop(f"{name}t"), name
        parts = [a for a in call[2] if a[0] == "call" and a[1] in SCORING | {"vectordistance"}]
        weights = [float(self.as_literal(a)) for a in call[2] if a not in parts]
        names = []
        for k, part in enumerate(parts):
            if part[1] == "vectordistance":
                df = df.withColumn(f"{name}_{k}", self.plan(part, scope)[0])
            else:
                df, _ = self.score(df, scope, part, f"{name}_{k}")
            names.append(f"{name}_{k}")
        if len(names) < 2 or weights and len(weights) != len(names):
            raise SqlError("RRF fuses two or more scores")
        return search.fuse(df, names, None, (), weights or None, name).drop(*names), name

    # -- expressions

    def read(self, found: tuple[str, str] | None) -> Typed:
        if found is None:
            raise SqlError("no such column")
        return col(found[0]), found[1]

    def shown(self, typed: Typed) -> Column:
        return V.norm(typed[0]) if typed[1] == "any" else typed[0]

    def comparable(self, typed: Typed) -> Column:
        return V.canon_key(typed[0]) if typed[1] == "any" else typed[0]

    def as_number(self, typed: Typed) -> Typed:
        c, kind = typed
        return (V.num(c), "double") if kind == "any" else (c, kind)

    def as_text(self, typed: Typed) -> Column:
        c, kind = typed
        return V.text(c) if kind == "any" else c if kind == "string" else c.cast("string")

    def as_array(self, typed: Typed) -> Column:
        c, kind = typed
        if kind == "any":
            return V.array(V.norm(c))
        return c if kind == "anyarray" else F.transform(c, lambda v: F.to_variant_object(v) if kind.startswith(("array<struct", "array<array", "array<map")) else v.cast("variant"))

    def as_value(self, typed: Typed) -> Column:
        c, kind = typed
        return c if kind == "any" else F.to_variant_object(c) if kind.startswith(("array", "map", "struct", "anyarray")) else c.cast("variant")

    def as_literal(self, x: tuple):
        if x[0] == "param":
            return self.params[x[1]]
        if x[0] == "call" and x[1] == "make_array":
            return [self.as_literal(a) for a in x[2]]
        if x[0] != "lit":
            raise SqlError("a constant is needed here")
        return x[1]

    def condition(self, x: tuple, scope: Scope) -> Column:
        c, kind = self.plan(x, scope)
        return V.boolean(c) if kind == "any" else c

    def key(self, typed: Typed) -> Column:
        """The canonical key of a value, so that typed and document values meet."""
        return V.canon_key(typed[0]) if typed[1] == "any" else V.plain_key(*typed)

    def matches(self, a: Typed, b: Typed) -> Column:
        """Equality where false and unknown are alike: between documents a plain one of keys, which joins can hash and sort."""
        if a[1] == "any" and b[1] == "any":
            return V.canon_key(a[0]) == V.canon_key(b[0])
        return self.compare("=", a, b)

    def truth(self, x: tuple, scope: Scope) -> Column:
        """A condition of which only truth matters."""
        if x[0] in ("and", "or") and not any(n == x for n, _ in scope.replaced):
            a, b = self.truth(x[1], scope), self.truth(x[2], scope)
            return a & b if x[0] == "and" else a | b
        if x[0] == "compare" and x[1] == "=" and not any(n == x for n, _ in scope.replaced):
            return self.matches(self.plan(x[2], scope), self.plan(x[3], scope))
        return self.condition(x, scope)

    def compare(self, op: str, a: Typed, b: Typed) -> Column:
        """Document values compare within one JSON type, and with a typed value as values of its type."""
        f = {"=": "__eq__", "<>": "__ne__", "<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__"}[op]
        if a[1] == "any" and b[1] == "any":
            x, y = (V.canon_key(a[0]), V.canon_key(b[0])) if op in ("=", "<>") else (V.sort_key(a[0]), V.sort_key(b[0]))
            same = V.type_of(a[0]) == V.type_of(b[0])
            return F.when(same, getattr(x, f)(y))
        if a[1] == "any" or b[1] == "any":
            kind = b[1] if a[1] == "any" else a[1]
            x, y = (turned(c, kind) if k == "any" else c for c, k in (a, b))
            return getattr(x, f)(y)
        return getattr(a[0], f)(b[0])

    def plan(self, x: tuple, scope: Scope) -> Typed:
        for node, typed in scope.replaced:
            if node == x:
                return typed
        return getattr(self, f"_{x[0]}")(x, scope)

    def _lit(self, x: tuple, scope: Scope) -> Typed:
        v = x[1]
        kind = "void" if v is None else "boolean" if isinstance(v, bool) else ("int" if -(2**31) <= v < 2**31 else "bigint") if isinstance(v, int) else "double" if isinstance(v, float) else "string"
        return F.lit(v), kind

    def _param(self, x: tuple, scope: Scope) -> Typed:
        if x[1] >= len(self.params):
            raise SqlError(f"parameter {x[1] + 1} has no value")
        return self._lit(("lit", self.params[x[1]]), scope)

    def _col(self, x: tuple, scope: Scope) -> Typed:
        found = scope.find(x[1])
        if found is not None:
            return self.read(found)
        raise SqlError(f"no column {'.'.join(x[1])}")

    def _item(self, x: tuple, scope: Scope) -> Typed:
        segments: list[str | int] = []
        root = x
        while root[0] == "item" and not any(n == root for n, _ in scope.replaced):
            segments.insert(0, self.as_literal(root[2]))
            root = root[1]
        c, kind = self.plan(root, scope)
        if kind.startswith(("struct", "map")):
            c, kind = F.to_variant_object(c), "any"
        if kind == "any":
            return V.raw(c, *segments), "any"
        if kind == "anyarray" and isinstance(segments[0], int):
            first = F.get(c, segments[0] - 1) if segments[0] > 0 else F.lit(None).cast("variant")
            return V.raw(first, *segments[1:]), "any"
        for s in segments:
            c = F.get(c, s - 1) if isinstance(s, int) else c[s]
        return c, "string" if kind == "array<string>" else kind.removeprefix("array<").removesuffix(">")

    def _compare(self, x: tuple, scope: Scope) -> Typed:
        return self.compare(x[1], self.plan(x[2], scope), self.plan(x[3], scope)), "boolean"

    def _and(self, x: tuple, scope: Scope) -> Typed:
        return self.condition(x[1], scope) & self.condition(x[2], scope), "boolean"

    def _or(self, x: tuple, scope: Scope) -> Typed:
        return self.condition(x[1], scope) | self.condition(x[2], scope), "boolean"

    def _not(self, x: tuple, scope: Scope) -> Typed:
        return ~self.condition(x[1], scope), "boolean"

    def _is(self, x: tuple, scope: Scope) -> Typed:
        if x[2] == "null":
            c = self.shown(self.plan(x[1], scope))
            return (c.isNotNull() if x[3] else c.isNull()), "boolean"
        c = self.condition(x[1], scope)
        test = c.isNull() if x[2] == "unknown" else c.eqNullSafe(F.lit(x[2] == "true"))
        return (~test if x[3] else test), "boolean"

    def _same(self, x: tuple, scope: Scope) -> Typed:
        a, b = self.plan(x[1], scope), self.plan(x[2], scope)
        if "any" in (a[1], b[1]):
            a, b = ((V.canon_key(self.as_value(t)), "string") for t in (a, b))
        test = a[0].eqNullSafe(b[0])
        return (~test if x[3] else test), "boolean"

    def _in(self, x: tuple, scope: Scope) -> Typed:
        a = self.plan(x[1], scope)
        listed = [self.plan(y, scope) for y in x[2]]
        classes = {"number" if is_number(k) else k for _, k in listed}
        if len(classes) == 1 and all(y[0] == "lit" for y in x[2]) and "void" not in classes:
            c = a[0] if a[1] != "any" else {"number": V.num, "boolean": V.boolean}.get(classes.pop(), V.text)(a[0])
            test = c.isin(*(y[1] for y in x[2]))
        else:
            test = F.lit(False)
            for b in listed:
                test = test | self.compare("=", a, b)
        return (~test if x[3] else test), "boolean"

    def _between(self, x: tuple, scope: Scope) -> Typed:
        a, low, high = (self.plan(y, scope) for y in x[1:4])
        test = self.compare(">=", a, low) & self.compare("<=", a, high)
        return (~test if x[4] else test), "boolean"

    def _like(self, x: tuple, scope: Scope) -> Typed:
        value, escape = self.as_text(self.plan(x[1], scope)), self.as_literal(x[3]) if x[3] else None
        if x[2][0] in ("lit", "param"):
            pattern = self.as_literal(x[2])
            test = value.like(pattern.replace("\\", "\\\\")) if escape is None else F.like(value, F.lit(pattern), F.lit(escape))
        else:
            test = F.like(value, F.replace(self.as_text(self.plan(x[2], scope)), F.lit("\\"), F.lit("\\\\")))
        return (~test if x[4] else test), "boolean"

    def _case(self, x: tuple, scope: Scope) -> Typed:
        _, operand, whens, other = x
        results = [self.plan(r, scope) for _, r in whens] + [self.plan(other, scope)]
        kinds = {k for _, k in results if k != "void"}
        if len(kinds) > 1 and "any" in kinds:
            results, kind = [(self.as_value(t) if t[1] != "void" else F.lit(None).cast("variant"), "any") for t in results], "any"
        else:
            kind = self.wider(kinds)
        case = F
        for (c, _), r in zip(whens, results):
            test = self.compare("=", self.plan(operand, scope), self.plan(c, scope)) if operand else self.condition(c, scope)
            case = case.when(test, r[0])
        return case.otherwise(results[-1][0]), kind

    def wider(self, kinds: set[str]) -> str:
        if not kinds:
            return "void"
        ranked = ["tinyint", "smallint", "int", "bigint", "float", "double"]
        if all(k in ranked for k in kinds):
            return max(kinds, key=ranked.index)
        return sorted(kinds)[0] if len(kinds) == 1 else "double" if all(map(is_number, kinds)) else sorted(kinds)[0]

    def _cast(self, x: tuple, scope: Scope) -> Typed:
        c, kind = self.plan(x[1], scope)
        to = x[2]
        if to == "variant":
            return self.as_value((c, kind)), "any"
        if kind == "any":
            return V.cast_value(c, to, x[3]), to
        if to in WHOLE and kind == "string":
            wide = F.trim(c).try_cast("double") if x[3] else F.trim(c).cast("double")
            return V.saturated(wide, to, x[3]), to
        if to in WHOLE and (kind in ("double", "float") or kind.startswith("decimal")):
            return V.saturated(c, to, x[3]), to
        return (c.try_cast(to) if x[3] else c.cast(to)), to

    def _arith(self, x: tuple, scope: Scope) -> Typed:
        op = x[1]
        (a, ka), (b, kb) = (self.as_number(self.plan(y, scope)) for y in x[2:4])
        whole = ka in WHOLE and kb in WHOLE
        kind = self.wider({ka, kb} - {"void"})
        if op == "/":
            if whole:  # toward zero, as between integers everywhere in SQL
                q = a.cast("decimal(38,0)") / b
                return F.when(q >= 0, F.floor(q)).otherwise(F.ceil(q)).cast(kind), kind
            return a / b, "double" if not kind.startswith("decimal") else kind
        return {"+": a + b, "-": a - b, "*": a * b, "%": a % b}[op], kind

    def _negative(self, x: tuple, scope: Scope) -> Typed:
        c, kind = self.as_number(self.plan(x[1], scope))
        return -c, kind

    def _scalar(self, x: tuple, scope: Scope) -> Typed:
        df = self.query(x[1])
        if len(df.columns) != 1:
            raise SqlError("a scalar query gives one column")
        (f,) = df.schema
        return df.scalar(), kind_of(f.dataType)

    def _exists(self, x: tuple, scope: Scope) -> Typed:
        return self.query(x[1]).exists(), "boolean"

    def _inquery(self, x: tuple, scope: Scope) -> Typed:
        raise SqlError("IN over a query stands in WHERE only")

    def _star(self, x: tuple, scope: Scope) -> Typed:
        raise SqlError("* is no value")

    def _call(self, x: tuple, scope: Scope) -> Typed:
        _, name, args, extra = x
        if "over" in extra:
            return self.windowed(x, scope)
        if name in SCORING:
            raise SqlError(f"{name.upper()} ranks rows: it stands in ORDER BY")
        if name in AGGREGATES:
            raise SqlError(f"{name.upper()} is an aggregate")
        if name == "vectordistance":
            a, b = (self.constant_vector(y) if y[0] == "scalar" else self.vector(self.plan(y, scope)) for y in args[:2])
            options = self.as_literal(args[3]) if len(args) > 3 else None
            metric = (options or {}).get("distanceFunction", "cosine") if isinstance(options, dict) else "cosine"
            return search.vector_distance(a, b, metric), "double"
        typed = [self.plan(y, scope) for y in args] if name not in ("regexmatch",) else [self.plan(args[0], scope)]
        if name == "regexmatch":
            return scalar.regexmatch(self.as_text(typed[0]), self.as_literal(args[1]), self.as_literal(args[2]) if len(args) > 2 else ""), "boolean"
        if name == "extract":
            return self.extracted(self.as_literal(args[0]), typed[1]), "bigint"
        if name in UNITS and len(typed) == 1:
            return self.extracted(name, typed[0]), "bigint"
        if name in ("timestampadd", "timestampdiff"):
            return self.moved(name, self.as_literal(args[0]), typed[1], typed[2])
        if name in ("floor", "ceil", "ceiling") and "to" in extra:
            return self.rounded(extra["to"], typed[0], name != "floor"), "timestamp"
        if name in ("current_date", "current_timestamp", "localtimestamp"):
            return (F.current_date(), "date") if name == "current_date" else (F.current_timestamp(), "timestamp")
        if name in ("coalesce", "nullif"):
            return self.coalesced(name, args, typed, scope)
        if name == "trim":
            s, what = self.as_text(typed[0]), self.as_text(typed[1])
            return {"both": F.btrim, "leading": F.ltrim, "trailing": F.rtrim}[extra.get("side", "both")](s, what), "string"
        if name == "substring" or name == "substr":
            s, start = self.as_text(typed[0]), typed[1][0]
            return (F.substr(s, start, typed[2][0]) if len(typed) > 2 else F.substr(s, start)), "string"
        if name == "array_slice":
            start, length = self.as_literal(args[1]), self.as_literal(args[2])
            return scalar.array_slice(self.as_array(typed[0]), start, length), "anyarray"
        if name == "make_map":
            keys = [self.as_literal(a) for a in args[::2]]
            return F.to_variant_object(F.create_map(*(c for k, t in zip(keys, typed[1::2]) for c in (F.lit(k), self.as_value(t))))), "any"
        if name == "make_array":
            return F.array(*(self.as_value(t) for t in typed)) if typed else F.array().cast("array<variant>"), "anyarray"
        if name in ("fulltextcontains", "fulltextcontainsall", "fulltextcontainsany"):
            words = [self.as_literal(a) for a in args[1:]]
            f = {"fulltextcontains": search.contains, "fulltextcontainsall": search.contains_all, "fulltextcontainsany": search.contains_any}[name]
            return f(self.as_text(typed[0]), *words), "boolean"
        if name in TESTS:
            return TESTS[name](self.as_value(typed[0])), "boolean"
        if name in FUNCTIONS:
            takes, gives, f = FUNCTIONS[name]
            turn = {"text": self.as_text, "array": self.as_array, "value": self.as_value, "number": lambda t: self.as_number(t)[0]}
            kinds = takes if isinstance(takes, tuple) else (takes,) * len(typed)
            if isinstance(takes, tuple) and len(typed) != len(takes):
                raise SqlError(f"{name.upper()} takes {len(takes)} arguments")
            columns = [turn[k](t) for k, t in zip(kinds, typed)]
            kind = self.as_number(typed[0])[1] if gives == "same" else gives
            return f(*columns), kind
        raise SqlError(f"no function {name.upper()}")

    # -- dates: text in documents is read as ISO dates and times

    def as_time(self, typed: Typed) -> Column:
        c, kind = typed
        return V.text(c).try_cast("timestamp") if kind == "any" else c.cast("timestamp")

    def extracted(self, unit: str, typed: Typed) -> Column:
        if unit not in UNITS:
            raise SqlError(f"no unit {unit.upper()}")
        c = self.as_time(typed)
        if unit == "epoch":
            return F.unix_seconds(c)
        if unit in ("second", "millisecond", "microsecond"):
            micros = F.pmod(F.unix_micros(c), F.lit(60_000_000))
            return F.floor(micros / {"second": 1_000_000, "millisecond": 1000, "microsecond": 1}[unit]).cast("bigint")
        if unit in ("century", "decade", "millennium"):
            year = F.year(c)
            return (F.floor(year / 10) if unit == "decade" else F.ceil(year / (100 if unit == "century" else 1000))).cast("bigint")
        return F.date_part(F.lit({"isodow": "DAYOFWEEK_ISO", "dow": "DAYOFWEEK", "doy": "DOY", "isoyear": "YEAROFWEEK"}.get(unit, unit)), c).cast("bigint")

    def moved(self, name: str, unit: str, a: Typed, b: Typed) -> Typed:
        if unit not in SPANS:
            raise SqlError(f"no span {unit.upper()}")
        if name == "timestampadd":
            n = self.as_number(a)[0]
            return F.timestamp_add(unit.upper(), n.cast("int"), self.as_time(b)), "timestamp"
        return F.timestamp_diff(unit.upper(), self.as_time(a), self.as_time(b)).cast("int"), "int"

    def rounded(self, unit: str, typed: Typed, up: bool) -> Column:
        c = self.as_time(typed)
        low = F.date_trunc(unit, c)
        return F.when(low == c, c).otherwise(F.timestamp_add(unit.upper(), F.lit(1), low)) if up else low

    def coalesced(self, name: str, args: list, typed: list[Typed], scope: Scope) -> Typed:
        if name == "nullif":
            c = self.shown(typed[0])
            return F.when(F.coalesce(~self.compare("=", typed[0], typed[1]), F.lit(True)), c), typed[0][1]
        kinds = {k for _, k in typed if k != "void"}
        if "any" in kinds and len(kinds) > 1:
            return F.coalesce(*(V.norm(self.as_value(t)) for t in typed)), "any"
        return F.coalesce(*(self.shown(t) for t in typed)), self.wider(kinds)

    def constant_vector(self, x: tuple) -> Column:
        """The one vector a scalar query gives, as a literal: array functions take no subqueries."""
        rows = self.query(x[1]).limit(2).collect()
        if len(rows) > 1:
            raise SqlError("a scalar query gave several rows")
        return F.array(*(F.lit(float(v)) for v in rows[0][0])) if rows and rows[0][0] is not None else F.lit(None).cast("array<double>")

    def vector(self, typed: Typed) -> Column:
        c, kind = typed
        return F.transform(self.as_array(typed), V.num) if kind in ("any", "anyarray") else c


UNITS = ("year", "quarter", "month", "week", "day", "dayofweek", "dayofyear", "dow", "isodow", "doy", "isoyear", "hour", "minute", "second", "millisecond", "microsecond", "epoch", "decade", "century", "millennium")
SPANS = ("year", "quarter", "month", "week", "day", "hour", "minute", "second", "millisecond", "microsecond")

TESTS = {
    "is_defined": V.is_defined, "is_null": V.is_null, "is_array": V.is_array, "is_bool": V.is_bool,
    "is_number": V.is_number, "is_object": V.is_object, "is_string": V.is_string, "is_primitive": V.is_primitive,
}

#: name -> (what its arguments are turned into, kind of the result, function)
FUNCTIONS = {
    "upper": ("text", "string", F.upper), "lower": ("text", "string", F.lower), "reverse": ("text", "string", F.reverse),
    "length": ("text", "int", F.char_length), "char_length": ("text", "int", F.char_length), "character_length": ("text", "int", F.char_length),
    "replace": ("text", "string", F.replace), "concat": ("text", "string", F.concat), "ltrim": ("text", "string", F.ltrim), "rtrim": ("text", "string", F.rtrim),
    "left": (("text", "number"), "string", F.left), "right": (("text", "number"), "string", F.right), "repeat": (("text", "number"), "string", F.repeat),
    "position": ("text", "int", lambda a, s, n=None: F.position(a, s) if n is None else F.position(a, s, n.cast("int"))),
    "startswith": ("text", "boolean", F.startswith), "endswith": ("text", "boolean", F.endswith), "contains": ("text", "boolean", F.contains),
    "abs": ("number", "same", F.abs), "exp": ("number", "double", F.exp), "ln": ("number", "double", F.ln), "log10": ("number", "double", F.log10),
    "power": ("number", "double", F.pow), "sqrt": ("number", "double", F.sqrt), "sign": ("number", "double", F.signum), "mod": ("number", "same", lambda a, b: a % b),
    "round": ("number", "double", lambda x, d=None: F.round(x.cast("double")) if d is None else F.round(x.cast("double"), d)), "cbrt": ("number", "double", F.cbrt),
    "floor": ("number", "double", lambda x: F.floor(x).cast("double")), "ceil": ("number", "double", lambda x: F.ceil(x).cast("double")), "ceiling": ("number", "double", lambda x: F.ceil(x).cast("double")),
    "sin": ("number", "double", F.sin), "cos": ("number", "double", F.cos), "tan": ("number", "double", F.tan), "cot": ("number", "double", F.cot),
    "asin": ("number", "double", F.asin), "acos": ("number", "double", F.acos), "atan": ("number", "double", F.atan), "atan2": ("number", "double", F.atan2),
    "degrees": ("number", "double", F.degrees), "radians": ("number", "double", F.radians), "pi": ((), "double", F.pi),
    "truncate": ("number", "double", lambda x, d=None: scalar.truncate(x) if d is None else scalar.truncate(x.cast("double") * F.pow(F.lit(10.0), d)) / F.pow(F.lit(10.0), d)), "log": ("number", "double", lambda b, x: F.ln(x) / F.ln(b)),
    "cardinality": ("array", "int", scalar.cardinality), "array_concat": ("array", "anyarray", scalar.array_concat),
    "array_union": (("array", "array"), "anyarray", scalar.array_union), "array_intersect": (("array", "array"), "anyarray", scalar.array_intersect),
    "member_of": (("value", "array"), "boolean", lambda v, a: scalar.member_of(V.canon_key(v), a)), "array_contains": (("array", "value"), "boolean", lambda a, v: scalar.member_of(V.canon_key(v), a)),
    "tostring": (("value",), "string", scalar.to_string), "stringtonumber": (("text",), "double", scalar.string_to_number), "stringtoboolean": (("text",), "boolean", scalar.string_to_boolean),
    "stringtoobject": (("text",), "any", scalar.string_to_object), "stringtoarray": (("text",), "any", scalar.string_to_array), "parse_json": (("text",), "any", F.parse_json),
    "objecttoarray": (("value",), "array<struct<k:string,v:variant>>", scalar.object_to_array),
}
