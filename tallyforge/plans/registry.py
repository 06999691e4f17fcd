"""Registration of queries with their oracles."""

from __future__ import annotations


def half_up_sql(sql: str, places: int = 4) -> str:
    """SQL in which every round(x, places) is written as floor(x * 10^places + 0.5) / 10^places.

    Engines break ties of doubles differently in round(); this form is the same arithmetic everywhere.
    """
    end, out, i = f", {places})", "", 0
    while (at := sql.find("round(", i)) >= 0:
        depth, j = 1, at + len("round(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[j], 0)
            j += 1
        call = sql[at:j]
        if call.endswith(end):
            inner = half_up_sql(call[len("round(") : -len(end)], places)
            call = f"(floor(CAST(({inner}) AS DOUBLE) * {10**places} + 0.5) / {10**places})"
        out, i = out + sql[i:at] + call, j
    return out + sql[i:]


def registry():
    """(QUERIES, ORACLE, query): query(sql) registers the function below it under its name."""
    queries, oracle = {}, {}

    def query(sql: str | None = None):
        def add(f):
            queries[f.__name__] = f
            if sql is not None:
                oracle[f.__name__] = half_up_sql(sql)
            return f

        return add

    return queries, oracle, query
