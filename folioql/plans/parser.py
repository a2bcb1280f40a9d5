"""A recursive-descent parser for the SQL of document tables.

Expressions are tuples whose first element names the node; queries and statements are dicts.
"""

from __future__ import annotations

import re

TOKEN = re.compile(
    r"""\s*(?:(?P<space>--[^\n]*|/\*.*?\*/)|(?P<number>\d+(?:\.\d+)?(?:[eE][+-]?\d+)?|\.\d+(?:[eE][+-]?\d+)?)|'(?P<string>(?:[^']|'')*)'|"(?P<quoted>(?:[^"]|"")*)"|(?P<word>[A-Za-z_][A-Za-z_0-9$]*)|(?P<op><>|!=|<=|>=|\|\||[-+*/%=<>(),.\[\]?;:]))""",
    re.S | re.X,
)
RESERVED = set(
    "select from where group by having order limit offset fetch union intersect except minus on using join inner left right full cross outer natural as and or not in is like between case when then else end null true false distinct all exists with values set window lateral".split()
)


class SqlError(ValueError):
    """The text is no statement this engine knows."""


def tokenize(text: str) -> list[tuple[str, str]]:
    out, at = [], 0
    text = text.rstrip()
    while at < len(text):
        m = TOKEN.match(text, at)
        if not m:
            raise SqlError(f"unexpected character at {at}: {text[at : at + 20]!r}")
        at = m.end()
        kind = m.lastgroup
        if kind == "space":
            continue
        value = m[kind]
        out.append((kind, value.replace("''", "'") if kind == "string" else value.replace('""', '"') if kind == "quoted" else value))
    return out


class Parser:
    def __init__(self, text: str):
        self.tokens, self.at, self.params = tokenize(text), 0, 0

    # -- tokens

    def peek(self, ahead: int = 0) -> tuple[str, str]:
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else ("end", "")

    def is_(self, *words: str, ahead: int = 0) -> bool:
        """Whether the next tokens are these key words or operators."""
        for k, w in enumerate(words):
            kind, value = self.peek(ahead + k)
            if kind not in ("word", "op") or value.lower() != w:
                return False
        return True

    def take(self, *words: str) -> bool:
        if self.is_(*words):
            self.at += len(words)
            return True
        return False

    def want(self, *words: str) -> None:
        if not self.take(*words):
            raise SqlError(f"expected {' '.join(words)} before {self.peek()[1]!r}")

    def name(self) -> str:
        kind, value = self.peek()
        if kind == "quoted" or kind == "word" and value.lower() not in RESERVED:
            self.at += 1
            return value
        raise SqlError(f"expected a name before {value!r}")

    def names(self) -> list[str]:
        out = [self.name()]
        while self.take(","):
            out.append(self.name())
        return out

    def dotted(self) -> list[str]:
        out = [self.name()]
        while self.take("."):
            out.append(self.name())
        return out

    def integer(self) -> int:
        kind, value = self.peek()
        if kind != "number" or not value.isdigit():
            raise SqlError(f"expected a whole number before {value!r}")
        self.at += 1
        return int(value)

    # -- statements

    def statement(self) -> dict:
        if self.take("explain"):
            self.take("plan")
            self.take("for")
            out = {"kind": "explain", "of": self.statement()}
        elif self.take("insert"):
            self.want("into")
            table = self.dotted()
            columns = None
            if self.is_("(") and not self.is_("select", ahead=1) and not self.is_("values", ahead=1):
                self.want("(")
                columns = self.names()
                self.want(")")
            out = {"kind": "insert", "table": table, "columns": columns, "query": self.query()}
        elif self.take("delete"):
            self.want("from")
            out = {"kind": "delete", "table": self.dotted(), "alias": self.alias(), "where": self.expression() if self.take("where") else None}
        elif self.take("update"):
            table, alias = self.dotted(), self.alias()
            self.want("set")
            sets = []
            while True:
                column = self.dotted()[-1]
                self.want("=")
                sets.append((column, self.expression()))
                if not self.take(","):
                    break
            out = {"kind": "update", "table": table, "alias": alias, "sets": sets, "where": self.expression() if self.take("where") else None}
        else:
            out = self.query()
        self.take(";")
        if self.peek()[0] != "end":
            raise SqlError(f"unexpected {self.peek()[1]!r}")
        return out

    def alias(self) -> str | None:
        if self.take("as"):
            return self.name()
        kind, value = self.peek()
        if kind == "quoted" or kind == "word" and value.lower() not in RESERVED:
            return self.name()
        return None

    def query(self) -> dict:
        ctes = []
        if self.take("with"):
            while True:
                name = self.name()
                columns = None
                if self.take("("):
                    columns = self.names()
                    self.want(")")
                self.want("as", "(")
                ctes.append((name, columns, self.query()))
                self.want(")")
                if not self.take(","):
                    break
        body = self.set_term()
        while self.is_("union") or self.is_("except") or self.is_("minus"):
            how = self.peek()[1].lower()
            self.at += 1
            every = self.take("all")
            self.take("distinct")
            body = {"kind": "set", "how": "except" if how == "minus" else how, "all": every, "left": body, "right": self.set_term()}
        order, offset, fetch = [], 0, None
        if self.take("order", "by"):
            rank = self.is_("rank") and not self.is_("(", ahead=1)
            if rank:
                self.at += 1
            while True:
                x = self.expression()
                direction = "desc" if self.take("desc") else "asc"
                if direction == "asc":
                    self.take("asc")
                nulls = None
                if self.take("nulls"):
                    nulls = "first" if self.take("first") else (self.want("last") or "last")
                order.append((x, direction, nulls, rank))
                if not self.take(","):
                    break
        while True:
            if self.take("limit"):
                fetch = None if self.take("all") else self.integer()
            elif self.take("offset"):
                offset = self.integer()
                self.take("rows") or self.take("row")
            elif self.take("fetch"):
                self.take("next") or self.take("first")
                fetch = self.integer() if self.peek()[0] == "number" else 1
                self.take("rows") or self.take("row")
                self.want("only")
            else:
                break
        if ctes or order or offset or fetch is not None:
            return {"kind": "query", "ctes": ctes, "body": body, "order": order, "offset": offset, "fetch": fetch}
        return body

    def set_term(self) -> dict:
        body = self.primary_query()
        while self.take("intersect"):
            every = self.take("all")
            self.take("distinct")
            body = {"kind": "set", "how": "intersect", "all": every, "left": body, "right": self.primary_query()}
        return body

    def primary_query(self) -> dict:
        if self.take("("):
            q = self.query()
            self.want(")")
            return q
        if self.take("values"):
            rows = []
            while True:
                self.want("(")
                rows.append(self.expressions())
                self.want(")")
                if not self.take(","):
                    break
            return {"kind": "values", "rows": rows}
        self.want("select")
        distinct = self.take("distinct")
        self.take("all")
        top = None
        if self.is_("top") and self.peek(1)[0] == "number":
            self.at += 1
            top = self.integer()
        items = []
        while True:
            x = ("star", None) if self.take("*") else self.expression()
            items.append((x, None if x[0] == "star" else self.alias()))
            if not self.take(","):
                break
        out = {"kind": "select", "distinct": distinct, "top": top, "items": items, "from": None, "where": None, "group": None, "having": None}
        if self.take("from"):
            out["from"] = self.table_list()
        if self.take("where"):
            out["where"] = self.expression()
        if self.take("group", "by"):
            out["group"] = self.grouping()
        if self.take("having"):
            out["having"] = self.expression()
        return out

    def grouping(self) -> tuple[str, list, list | None]:
        for how, words in (("rollup", ("rollup", "(")), ("cube", ("cube", "("))):
            if self.take(*words):
                keys = self.expressions()
                self.want(")")
                return how, keys, None
        if self.take("grouping", "sets", "("):
            sets = []
            while True:
                if self.take("("):
                    sets.append([] if self.is_(")") else self.expressions())
                    self.want(")")
                else:
                    sets.append([self.expression()])
                if not self.take(","):
                    break
            self.want(")")
            keys = []
            for s in sets:
                keys += [x for x in s if x not in keys]
            return "groupingSets", keys, sets
        return "groupBy", self.expressions(), None

    # -- FROM

    def table_list(self) -> tuple:
        left = self.joined()
        while self.take(","):
            left = ("join", "cross", left, self.joined(), None)
        return left

    def joined(self) -> tuple:
        left = self.table()
        while True:
            how = None
            if self.take("cross", "join"):
                left = ("join", "cross", left, self.table(), None)
                continue
            for word in ("inner", "left", "right", "full"):
                if self.is_(word) and (self.is_("join", ahead=1) or self.is_("outer", ahead=1) or self.is_("semi", ahead=1) or self.is_("anti", ahead=1)):
                    self.at += 1
                    how = word
                    self.take("outer")
                    if self.take("semi"):
                        how = "left_semi"
                    elif self.take("anti"):
                        how = "left_anti"
            if how is None and not self.is_("join"):
                return left
            self.want("join")
            right = self.table()
            condition: tuple | None = None
            if self.take("on"):
                condition = ("on", self.expression())
            elif self.take("using"):
                self.want("(")
                condition = ("using", self.names())
                self.want(")")
            left = ("join", how or "inner", left, right, condition)

    def table(self) -> tuple:
        self.take("lateral")
        if self.take("unnest", "("):
            x = self.expression()
            self.want(")")
            ordinal = self.take("with", "ordinality")
            alias = self.alias() or "unnest"
            columns = []
            if self.take("("):
                columns = self.names()
                self.want(")")
            return ("unnest", x, alias, columns, ordinal)
        if self.take("("):
            if self.is_("select") or self.is_("with") or self.is_("values") or self.is_("("):
                q = self.query()
                self.want(")")
                alias = self.alias()
                columns = None
                if alias and self.take("("):
                    columns = self.names()
                    self.want(")")
                return ("query", q, alias or "_q", columns)
            inner = self.table_list()
            self.want(")")
            return inner
        name = self.dotted()
        return ("table", name, self.alias() or name[-1])

    # -- expressions

    def expressions(self) -> list:
        out = [self.expression()]
        while self.take(","):
            out.append(self.expression())
        return out

    def expression(self) -> tuple:
        x = self.conjunction()
        while self.take("or"):
            x = ("or", x, self.conjunction())
        return x

    def conjunction(self) -> tuple:
        x = self.negation()
        while self.take("and"):
            x = ("and", x, self.negation())
        return x

    def negation(self) -> tuple:
        return ("not", self.negation()) if self.take("not") else self.predicate()

    def predicate(self) -> tuple:
        x = self.sum()
        while True:
            for op in ("=", "<>", "!=", "<=", ">=", "<", ">"):
                if self.take(op):
                    x = ("compare", "<>" if op == "!=" else op, x, self.sum())
                    break
            else:
                if self.take("is"):
                    negated = self.take("not")
                    if self.take("distinct", "from"):
                        x = ("same", x, self.sum(), not negated)
                        continue
                    kind, value = self.peek()
                    if value.lower() not in ("null", "true", "false", "unknown"):
                        raise SqlError(f"IS {value}")
                    self.at += 1
                    x = ("is", x, value.lower(), negated)
                    continue
                negated = self.is_("not") and (self.is_("in", ahead=1) or self.is_("like", ahead=1) or self.is_("between", ahead=1) or self.is_("member", ahead=1))
                if negated:
                    self.at += 1
                if self.take("in"):
                    self.want("(")
                    if self.is_("select") or self.is_("with"):
                        x = ("inquery", x, self.query(), negated)
                    else:
                        x = ("in", x, self.expressions(), negated)
                    self.want(")")
                elif self.take("between"):
                    low = self.sum()
                    self.want("and")
                    x = ("between", x, low, self.sum(), negated)
                elif self.take("like"):
                    pattern = self.sum()
                    x = ("like", x, pattern, self.sum() if self.take("escape") else None, negated)
                elif self.take("member"):
                    self.take("of")
                    x = ("call", "member_of", [x, self.sum()], {})
                    x = ("not", x) if negated else x
                else:
                    return x

    def sum(self) -> tuple:
        x = self.product()
        while True:
            for op in ("+", "-", "||"):
                if self.take(op):
                    y = self.product()
                    x = ("call", "concat", [x, y], {}) if op == "||" else ("arith", op, x, y)
                    break
            else:
                return x

    def product(self) -> tuple:
        x = self.unary()
        while True:
            for op in ("*", "/", "%"):
                if self.take(op):
                    x = ("arith", op, x, self.unary())
                    break
            else:
                return x

    def unary(self) -> tuple:
        if self.take("-"):
            x = self.unary()
            return ("lit", -x[1]) if x[0] == "lit" and isinstance(x[1], (int, float)) and not isinstance(x[1], bool) else ("negative", x)
        self.take("+")
        x = self.primary()
        while self.take("["):
            x = ("item", x, self.expression())
            self.want("]")
        return x

    def primary(self) -> tuple:
        kind, value = self.peek()
        low = value.lower()
        if kind == "number":
            self.at += 1
            return ("lit", int(value) if value.isdigit() else float(value))
        if kind == "string":
            self.at += 1
            return ("lit", value)
        if kind == "op" and value == "?":
            self.at += 1
            self.params += 1
            return ("param", self.params - 1)
        if kind == "op" and value == "(":
            self.at += 1
            if self.is_("select") or self.is_("with"):
                x = ("scalar", self.query())
            else:
                x = self.expression()
            self.want(")")
            return x
        if kind == "word":
            if low in ("null", "true", "false"):
                self.at += 1
                return ("lit", {"null": None, "true": True, "false": False}[low])
            if low in ("date", "timestamp") and self.peek(1)[0] == "string":
                self.at += 2
                return ("cast", ("lit", self.peek(-1)[1]), "date" if low == "date" else "timestamp", False)
            if low == "case":
                self.at += 1
                operand = None if self.is_("when") else self.expression()
                whens = []
                while self.take("when"):
                    c = self.expression()
                    self.want("then")
                    whens.append((c, self.expression()))
                other = self.expression() if self.take("else") else ("lit", None)
                self.want("end")
                return ("case", operand, whens, other)
            if low in ("cast", "safe_cast", "try_cast") and self.is_("(", ahead=1):
                self.at += 2
                x = self.expression()
                self.want("as")
                kind = self.type()
                self.want(")")
                return ("cast", x, kind, low != "cast")
            if low == "exists" and self.is_("(", ahead=1):
                self.at += 2
                q = self.query()
                self.want(")")
                return ("exists", q)
            if low in ("map", "array") and self.is_("[", ahead=1):
                self.at += 2
                items = [] if self.is_("]") else self.expressions()
                self.want("]")
                return ("call", f"make_{low}", items, {})
            if low in ("current_date", "current_timestamp", "localtimestamp") and not self.is_("(", ahead=1):
                self.at += 1
                return ("call", low, [], {})
            if self.is_("(", ahead=1) and low not in RESERVED or low in ("left", "right") and self.is_("(", ahead=1):
                return self.call()
        if kind in ("quoted", "word"):
            parts = [self.name()]
            while self.take("."):
                if self.take("*"):
                    return ("star", parts[-1])
                parts.append(self.name())
            return ("col", tuple(parts))
        raise SqlError(f"unexpected {value!r}")

    def type(self) -> str:
        word = self.name().lower()
        inside = ""
        if self.take("("):
            inside = str(self.integer())
            while self.take(","):
                inside += f",{self.integer()}"
            self.want(")")
        self.take("precision")
        plain = {"varchar": "string", "char": "string", "integer": "int", "real": "float", "float": "double", "varbinary": "binary", "any": "variant", "numeric": "decimal"}
        kind = plain.get(word, word)
        if kind == "decimal":
            return f"decimal({inside})" if inside else "decimal(38,0)"
        if kind not in ("string", "int", "bigint", "smallint", "tinyint", "double", "float", "boolean", "binary", "date", "timestamp", "variant"):
            raise SqlError(f"unknown type {word}")
        return kind

    def call(self) -> tuple:
        function = self.name_of_function()
        self.want("(")
        extra: dict = {}
        args: list = []
        if function == "trim":
            side = next((s for s in ("both", "leading", "trailing") if self.take(s)), "both")
            first = None if self.is_("from") else self.expression()
            if self.take("from"):
                args = [self.expression(), first or ("lit", " ")]
            else:
                args = [first, ("lit", " ")]
            extra["side"] = side
        elif function in ("substring", "substr"):
            args = [self.expression()]
            while self.take("from") or self.take("for") or self.take(","):
                args.append(self.expression())
        elif function == "position":
            needle = self.sum()
            self.want("in")
            args = [needle, self.expression()]
            if self.take("from"):
                args.append(self.expression())
        elif function == "extract":
            unit = self.name().lower()
            self.want("from")
            args = [("lit", unit), self.expression()]
        elif function in ("timestampadd", "timestampdiff"):
            args = [("lit", self.name().lower().removeprefix("sql_tsi_"))]
            while self.take(","):
                args.append(self.expression())
            if len(args) != 3:
                raise SqlError(f"{function.upper()} takes a unit and two arguments")
        elif self.take("*"):
            args = [("star", None)]
        elif not self.is_(")"):
            extra["distinct"] = self.take("distinct")
            args = self.expressions()
            if self.take("to"):
                extra["to"] = self.name().lower()
            if self.take("order", "by"):
                extra["within"] = self.order_items()
        self.want(")")
        if self.take("within", "group", "("):
            self.want("order", "by")
            extra["within"] = self.order_items()
            self.want(")")
        if self.take("filter", "("):
            self.want("where")
            extra["filter"] = self.expression()
            self.want(")")
        if self.take("over", "("):
            partition = self.expressions() if self.take("partition", "by") else []
            extra["over"] = (partition, self.order_items() if self.take("order", "by") else [])
            self.want(")")
        return ("call", function, args, {k: v for k, v in extra.items() if v})

    def name_of_function(self) -> str:
        value = self.peek()[1].lower()
        self.at += 1
        return value

    def order_items(self) -> list:
        out = []
        while True:
            x = self.expression()
            direction = "desc" if self.take("desc") else "asc"
            if direction == "asc":
                self.take("asc")
            nulls = None
            if self.take("nulls"):
                nulls = "first" if self.take("first") else (self.want("last") or "last")
            out.append((x, direction, nulls))
            if not self.take(","):
                return out


def parse(text: str) -> dict:
    return Parser(text).statement()
