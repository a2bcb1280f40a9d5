"""What a condition on documents implies for the stored columns of a container.

Predicates inside a VARIANT reach no file.  An equality with a key column, or with its path, pins the
container's bucket and key columns; a bound on a promoted path, also under a cast to a number, bounds
its typed column.  These predicates are implied by the condition, which still stands above the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioql.functions import values as V
from folioql.sources.container import MAP, ContainerMeta, key_literal

FLIPPED = {"=": "=", "<": ">", "<=": ">=", ">": "<", ">=": "<="}


def conjuncts(x: tuple | None) -> Iterator[tuple]:
    if x is not None and x[0] == "and":
        yield from conjuncts(x[1])
        yield from conjuncts(x[2])
    elif x is not None:
        yield x


def path_of(x: tuple, alias: str, literal: Callable, key_columns: list[str], lone: bool) -> tuple[str, ...] | None:
    """The document path that an expression reads from this table; unqualified names count only for a `lone` table."""
    inner = []
    while x[0] == "item":
        step = literal(x[2])
        if not isinstance(step, str):
            return None
        inner.insert(0, step)
        x = x[1]
    if x[0] != "col" or not (len(x[1]) > 1 and x[1][-2].lower() == alias.lower() or len(x[1]) == 1 and lone):
        return None
    name = x[1][-1]
    if name.lower() == MAP.lower():
        return tuple(inner) or None
    known = next((k for k in key_columns if k.lower() == name.lower()), None)
    return (known, *inner) if known else None


def bounds(x: tuple, literal: Callable) -> Iterator[tuple[str, tuple, list]]:
    """(operator, expression, constants) of comparisons with constants."""
    constant = lambda y: y[0] in ("lit", "param")
    if x[0] == "compare" and x[1] in FLIPPED:
        if constant(x[3]):
            yield x[1], x[2], [literal(x[3])]
        elif constant(x[2]):
            yield FLIPPED[x[1]], x[3], [literal(x[2])]
    elif x[0] == "in" and not x[3] and all(map(constant, x[2])):
        yield "in", x[1], [literal(y) for y in x[2]]
    elif x[0] == "between" and not x[4] and constant(x[2]) and constant(x[3]):
        yield ">=", x[1], [literal(x[2])]
        yield "<=", x[1], [literal(x[3])]


def pinned(condition: tuple | None, alias: str, meta: ContainerMeta, literal: Callable, lone: bool = True) -> dict[int, list]:
    """The key parts that a condition fixes to some constants, by their number."""
    found: dict[int, list] = {}
    for x in conjuncts(condition):
        for op, e, constants in bounds(x, literal):
            path = path_of(e, alias, literal, meta.key_columns, lone)
            if op in ("=", "in") and path in meta.key_paths and all(isinstance(v, (str, int)) for v in constants):
                found.setdefault(meta.key_paths.index(path), constants)
    return found


def implied(condition: tuple | None, alias: str, meta: ContainerMeta, literal: Callable, lone: bool = True) -> Column | None:
    """The conjunction of all that a condition implies for stored columns, or None."""
    tests = []
    for part, constants in pinned(condition, alias, meta, literal, lone).items():
        tests.append(meta.in_parts(part, [key_literal(v) for v in constants]))
    promoted = {tuple(p.strip("/").split("/")): (c, kind) for p, c, kind in meta.promoted_columns}
    for x in conjuncts(condition):
        for op, e, constants in bounds(x, literal):
            whole = e[0] == "cast" and e[2] in V.INT_LIMITS
            inner = e[1] if whole or e[0] == "cast" and e[2] == "double" else e
            path = path_of(inner, alias, literal, meta.key_columns, lone)
            if path not in promoted:
                continue
            column, kind = promoted[path]
            numbers = all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in constants)
            if kind == "double" and numbers:
                tests.append(_number_bound(F.col(column), op, constants, e[2] if whole else None))
            elif kind == "string" and inner is e and all(isinstance(v, str) for v in constants):
                tests.append(_bound(F.col(column), op, constants))
    out = None
    for t in tests:
        out = t if out is None else out & t
    return out


def _bound(c: Column, op: str, constants: list) -> Column:
    return c.isin(*constants) if op == "in" else {"=": c.__eq__, "<": c.__lt__, "<=": c.__le__, ">": c.__gt__, ">=": c.__ge__}[op](constants[0])


def _number_bound(c: Column, op: str, constants: list, whole: str | None) -> Column:
    """A bound of the number, or (under a cast that truncates and saturates) the wider one that its whole part implies."""
    constants = [float(v) for v in constants]
    if whole is None:
        return _bound(c, op, constants)
    low, high = min(constants), max(constants)
    least, most = (float(v) for v in V.INT_LIMITS[whole])
    test = F.lit(True)
    if op in ("=", "in", ">", ">=") and low > least:
        test = test & (c > low - 1)
    if op in ("=", "in", "<", "<=") and high < most:
        test = test & (c < high + 1)
    return test & c.isNotNull()
