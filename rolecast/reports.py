"""Sinks for small results: a health file and Markdown reports, written through Hadoop's file system."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from .shared import hadoop

#: More rows than this are no report.
MOST_ROWS = 1000


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A whole file or none: a temporary one that takes the name when it is complete."""
    fs, temporary = hadoop(spark, f"{path}.tmp")
    out = fs.create(temporary, True)
    out.write(bytearray(text.encode()))
    out.close()
    _, final = hadoop(spark, path)
    fs.delete(final, False)
    if not fs.rename(temporary, final):
        raise OSError(f"cannot write {path}")


def health(spark: SparkSession, path: str, command: str, counters: dict, now: str) -> None:
    write_text(spark, path, json.dumps({"last_command": command, "last_run_at": now, "counters": counters}, default=str))


def cell(value: object) -> str:
    return "" if value is None else str(value).replace("|", "\\|").replace("\n", " ")


def table(df: DataFrame, most: int = MOST_ROWS) -> str:
    """A small table as Markdown; a larger one is an error, not a cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows are no report")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "-|" * len(df.columns)]
    return "\n".join(lines + ["| " + " | ".join(map(cell, r)) + " |" for r in rows])


def markdown(title: str, facts: dict[str, object], tables: dict[str, DataFrame]) -> str:
    """A report: facts as a list, then a section a table."""
    parts = [f"# {title}", "\n".join(f"* {k}: {cell(v)}" for k, v in facts.items())]
    parts += [f"## {name}\n\n{table(df)}" for name, df in tables.items()]
    return "\n\n".join(parts) + "\n"
