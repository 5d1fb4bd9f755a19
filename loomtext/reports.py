"""Markdown reports of small aggregates. Each takes aggregates of one or few rows and collects them."""

from __future__ import annotations

from pyspark.sql import DataFrame


def number(value) -> str:
    """Whole numbers as integers, others with at most two places."""
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return str(value)
    return str(int(value)) if float(value).is_integer() else f"{value:.2f}".rstrip("0").rstrip(".")


def section(title: str, row: dict) -> str:
    return "\n".join([f"## {title}", "", *[f"- {k}: {number(v)}" for k, v in row.items()], ""])


def table(title: str, rows: list[dict]) -> str:
    if not rows:
        return f"## {title}\n\n(none)\n"
    head = list(rows[0])
    return "\n".join([f"## {title}", "", "| " + " | ".join(head) + " |", "| " + " | ".join("---" for _ in head) + " |", *["| " + " | ".join(number(r[k]) for k in head) + " |" for r in rows], ""])


#: Rows that a table of a report shows; what is beyond is counted in a line below it.
SHOWN = 1000


def report(title: str, summary: DataFrame | None = None, **tables: DataFrame) -> str:
    """A report of a one-row summary and small tables: their first SHOWN rows and how many more there are."""
    out = [f"# {title}", ""]
    if summary is not None:
        out.append(section("Summary", summary.limit(1).collect()[0].asDict(recursive=True)))
    for name, df in tables.items():
        rows = [r.asDict(recursive=True) for r in df.limit(SHOWN + 1).collect()]
        out.append(table(name.replace("_", " "), rows[:SHOWN]))
        if len(rows) > SHOWN:
            out.append(f"({df.count() - SHOWN} more rows)\n")
    return "\n".join(out)
