"""Small results as Markdown: numbers, shares, tables, and a report of timed steps."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import DataFrame


def number(x: float, digits: int = 1) -> str:
    return f"{x:,.{digits}f}"


def percent(part: float, whole: float, digits: int = 1) -> str:
    return "n/a" if not whole else f"{100 * part / whole:.{digits}f}%"


def short(text: str, most: int = 120) -> str:
    """For a table's cell: no bars, and an ellipsis where it is cut."""
    plain = text.replace("|", "/")
    return plain if len(plain) <= most else plain[: most - 1] + "…"


def table(header: Iterable[str], rows: Iterable[Iterable]) -> list[str]:
    header = list(header)
    line = lambda cells: "| " + " | ".join(map(str, cells)) + " |"
    return [line(header), "|" + "---|" * len(header), *map(line, rows), ""]


class Report:
    """Sections with tables of small DataFrames, and the seconds that each took."""

    def __init__(self, title: str, most: int = 1000):
        self.lines, self.most, self.steps = [f"# {title}", ""], most, []

    def section(self, title: str, df: DataFrame, note: str = "") -> None:
        """Run a query and add its rows; more than most rows are an error, as a report is for reading."""
        began = time.time()
        rows = df.limit(self.most + 1).collect()
        if len(rows) > self.most:
            raise ValueError(f"{title}: more than {self.most} rows")
        self.steps.append((title, time.time() - began, len(rows)))
        self.lines += [f"## {title}", "", *([note, ""] if note else []), *table(df.columns, ([_cell(v) for v in r] for r in rows))]

    def text(self) -> str:
        times = table(("section", "seconds", "rows"), ((t, number(s), n) for t, s, n in self.steps))
        return "\n".join([*self.lines, "## Run time", "", *times])


def _cell(value) -> str:
    return "" if value is None else f"{value:,}" if isinstance(value, int) and not isinstance(value, bool) else short(str(value))
