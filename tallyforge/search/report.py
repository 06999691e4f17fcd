"""Reports of a bounded search result: CSV and JSON by Spark, HTML and Markdown as text. And a small command line."""

from __future__ import annotations

import argparse
import csv
import datetime as dt
import html
import io
import json
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.search.request import SearchRequest, search

#: A page for people shows no more rows than this, and says so; csv and json hold all.
PAGE_ROWS = 2_000
#: The most frequent values of a facet that a page lists.
FACET_ROWS = 20


def _rows(df: DataFrame) -> tuple[list, int]:
    """The rows of a page, and how many there are in all."""
    rows = df.limit(PAGE_ROWS + 1).collect()
    return rows[:PAGE_ROWS], len(rows) if len(rows) <= PAGE_ROWS else df.count()


def _extent(shown: int, total: int) -> str:
    return f"{total} rows" if shown == total else f"the first {shown} of {total} rows"


def as_html(df: DataFrame, title: str = "Postings", facets: Sequence[str] = ()) -> str:
    """A page with the number of rows, the counts of each facet column over all rows, and a table."""
    rows, total = _rows(df)
    esc = lambda v: html.escape("" if v is None else str(v))
    counts = [(c, df.groupBy(c).count().orderBy(F.desc("count"), c).limit(FACET_ROWS).collect()) for c in facets]
    lists = "".join(f"<h2>{esc(c)}</h2><ul>{''.join(f'<li>{esc(v)}: {n}</li>' for v, n in r)}</ul>" for c, r in counts)
    head = "".join(f"<th>{esc(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{esc(v)}</td>" for v in r) + "</tr>" for r in rows)
    return f"<!doctype html><meta charset='utf-8'><title>{esc(title)}</title><h1>{esc(title)}</h1><p>{_extent(len(rows), total)}</p>{lists}<table><tr>{head}</tr>{body}</table>"


def as_markdown(df: DataFrame) -> str:
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    rows, total = _rows(df)
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns), *["| " + " | ".join(map(cell, r)) + " |" for r in rows]]
    return "\n".join(lines if len(rows) == total else [*lines, "", _extent(len(rows), total)])


def write_report(df: DataFrame, path: str, kind: str, day: dt.date) -> str:
    """Writes df to path, in which {date} stands for the day; csv and json are written by Spark, whole."""
    path = path.replace("{date}", day.strftime("%Y%m%d"))
    if kind in ("csv", "json"):
        w = df.write.mode("overwrite")
        w.option("header", True).csv(path) if kind == "csv" else w.json(path)
    elif kind in ("html", "markdown"):
        with open(path, "w", encoding="utf-8") as f:
            f.write(as_html(df) if kind == "html" else as_markdown(df))
    else:
        raise ValueError(kind)
    return path


def as_text(df: DataFrame, kind: str) -> str:
    """A result, which the command line has limited, as text of a kind."""
    if kind in ("markdown", "html"):
        return as_markdown(df) if kind == "markdown" else as_html(df)
    rows = df.collect()
    if kind == "json":
        return "\n".join(json.dumps(r.asDict(recursive=True), default=str, ensure_ascii=False) for r in rows)
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    w.writerows([df.columns, *rows])
    return out.getvalue().rstrip("\n")


def main(args: list[str] | None = None) -> None:
    """search TABLE [--format F] [--keyword K ...] [--title T ...] [--location L ...] [--limit N], stats TABLE, companies TABLE."""
    from tallyforge.session import local_session

    p = argparse.ArgumentParser(prog="tallyforge")
    p.add_argument("command", choices=["search", "stats", "companies"])
    p.add_argument("table")
    for x in ("keyword", "title", "location"):
        p.add_argument(f"--{x}", action="append", default=[])
    p.add_argument("--limit", type=int, default=20)
    p.add_argument("--format", choices=["markdown", "csv", "json", "html"], default="markdown")
    a = p.parse_args(args)
    df = local_session().read.parquet(a.table)
    if a.command == "search":
        r = SearchRequest(
            keywords=a.keyword, titles=a.title, locations=a.location, max_results=a.limit, score="basic",
            columns={"title": "job_title", "body": "job_description", "posted": "posted_date"},
        )
        out = search(df, r).select("job_id", "job_title", "location", "posted_date", "relevance")
    elif a.command == "stats":
        out = df.rollup("platform").count()
    else:
        out = df.select("company_id", "company_name").distinct().orderBy("company_id").limit(a.limit)
    sys.stdout.write(as_text(out, a.format) + "\n")


if __name__ == "__main__":
    main()
