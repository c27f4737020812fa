"""Shared parts of the expected-result SQL: named subqueries and small text helpers."""

from __future__ import annotations

import re

from wardlight.sources import domain

CTES: dict[str, str] = {}
QUERIES: dict[str, str] = {}

AS_OF = f"DATE '{domain.AS_OF}'"
NOW = f"TIMESTAMP '{domain.EVENT_AS_OF}'"

for _name, _text in {**domain.BATCH, **domain.event_sql()}.items():
    CTES[_name] = _text.format(**{n: n for n in domain.inputs_of(_text)})


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def q(name: str, sql: str) -> None:
    QUERIES[name] = sql


_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _names(sql: str) -> list[str]:
    bare = re.sub(r"'(?:[^']|'')*'", "''", sql)
    return [w for w in dict.fromkeys(_WORD.findall(bare)) if w in CTES]


def full_sql(body: str) -> str:
    """The query with every named subquery it needs in front, each after its own needs."""
    order: list[str] = []

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in order or name in path:
            return
        for need in _names(CTES[name]):
            if need != name:
                visit(need, (*path, name))
        order.append(name)

    for name in _names(body):
        visit(name, ())
    if not order:
        return body
    parts = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in order)
    return f"WITH {parts}\n{body}"


def R(x: str, n: int) -> str:
    """Round half away from zero, free of binary noise."""
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,12)), {n}) AS DOUBLE)"


def initcap(x: str) -> str:
    return f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


def S(x: str) -> str:
    """Sum of money."""
    return f"CAST(SUM({x}) AS DOUBLE)"


def A(x: str) -> str:
    """Mean of money."""
    return f"CAST(SUM({x}) AS DOUBLE) / NULLIF(COUNT({x}), 0)"


def M(x: str) -> str:
    """Mean of a score."""
    return R(f"AVG({x})", 6)


def div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)"


def dkey(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"


def minutes(a: str, b: str) -> str:
    return f"date_diff('minute', {b}, {a})"


def back(ts: str, interval: str, inclusive: bool = False) -> str:
    return f"({ts} {'>=' if inclusive else '>'} {NOW} - INTERVAL '{interval}' AND {ts} <= {NOW})"
