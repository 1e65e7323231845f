"""Published parts of a table: a part is replaced whole or not at all.

A part (a run, a batch) is written to an attempt folder of its own and then published by
one empty file in the table's commit folder, whose name says which attempt the part now
is. Creating a file is a single step in every store Spark writes to, so a driver or an
executor lost at any time leaves what was published before. Readers list the commits (one
name a publication) and read the published attempts' folders only.

    root/_commits/0000000003.<attempt>.<part>        publication
    root/_commits/0000000004.reset                   all parts before are forgotten
    root/_commits/0000000005.snapshot                the parts so far, in place of all before
    root/run_id=<part>/attempt=<attempt>/…           the rows
    root/_counts/run_id=<part>/attempt=<attempt>/…   what is counted of a part

One writer publishes to a table at a time; readers need no care. Attempts that were replaced
or never published stay for readers that have begun, until `remove_old`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from lawgrain.session import child_files, child_folders, create_file, file_text, remove_path

_LOG, _COUNTS = "_commits", "_counts"
_RESET, _SNAPSHOT = "reset", "snapshot"
# Commits after which a snapshot takes the place of those before.
SNAPSHOT_EVERY = 200


def _log(spark: SparkSession, root: str) -> list[list[str]]:
    """Commits in order: [number, attempt, part], [number, "reset"] or [number, "snapshot"]."""
    return [name.split(".", 2) for name in sorted(child_files(spark, f"{root}/{_LOG}"))]


def _replay(spark: SparkSession, root: str, log: list[list[str]]) -> dict[str, str]:
    parts: dict[str, str] = {}
    for number, *what in log:
        if what == [_RESET]:
            parts.clear()
        elif what == [_SNAPSHOT]:
            try:
                parts = json.loads(file_text(spark, f"{root}/{_LOG}/{number}.{_SNAPSHOT}"))
            except ValueError:
                pass  # its writer was lost; the commits before are still there
        else:
            parts[unquote(what[1])] = what[0]
    return parts


def _note(spark: SparkSession, root: str, *what: str) -> None:
    log = _log(spark, root)
    number = int(log[-1][0]) + 1 if log else 0
    create_file(spark, f"{root}/{_LOG}/{'.'.join((f'{number:010d}', *what))}")
    if len(log) >= SNAPSHOT_EVERY:
        old, name = _log(spark, root), f"{number + 1:010d}.{_SNAPSHOT}"
        parts = json.dumps(_replay(spark, root, old))
        create_file(spark, f"{root}/{_LOG}/{name}", parts)
        if file_text(spark, f"{root}/{_LOG}/{name}") == parts:
            for commit in old:
                remove_path(spark, f"{root}/{_LOG}/{'.'.join(commit)}")


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """Attempt of each published part."""
    return _replay(spark, root, _log(spark, root))


def _folder(root: str, part: str, attempt: str) -> str:
    return f"{root}/run_id={quote(part, safe='')}/attempt={attempt}"


def publish(
    rows: DataFrame,
    root: str,
    part: str,
    partition_by: tuple[str, ...] = (),
    counts: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Write the rows of one part and make them the part; returns their folder.

    `counts` gives a few rows about the part from its stored rows; they are published in
    the same step.
    """
    spark, attempt = rows.sparkSession, uuid.uuid4().hex
    target = _folder(root, part, attempt)
    rows.write.partitionBy(*partition_by).parquet(target)
    if counts is not None:
        stored = spark.read.schema(rows.schema).parquet(target)
        counts(stored).write.parquet(_folder(f"{root}/{_COUNTS}", part, attempt))
    _note(spark, root, attempt, quote(part, safe=""))
    return target


def forget(spark: SparkSession, root: str) -> None:
    """Make the table empty, in one step."""
    _note(spark, root, _RESET)


def read(
    spark: SparkSession,
    root: str,
    empty: StructType,
    text_partitions: tuple[str, ...] = (),
    but: str | None = None,
    counts: bool = False,
) -> DataFrame:
    """Rows of all published parts (but one) with their `run_id`; partitions are STRINGs.

    Left to itself Spark would read the part "007" as a number. Parts share one schema,
    that of the first with rows; `empty` is the schema of a table that has none. `counts`
    reads what was counted instead.
    """
    base = f"{root}/{_COUNTS}" if counts else root
    folders = [_folder(base, part, attempt) for part, attempt in published(spark, root).items() if part != but]
    names = ("run_id", "attempt", *text_partitions)

    def with_text(schema: StructType) -> StructType:
        own = [f for f in schema.fields if f.name not in names]
        return StructType([*own, *[StructField(n, StringType()) for n in names]])

    folders = [f for f in folders if any(not n.startswith("_") for n in (*child_files(spark, f), *child_folders(spark, f)))]
    if not folders:
        return spark.createDataFrame([], with_text(empty)).drop("attempt")
    schema = with_text(spark.read.parquet(folders[0]).schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*folders).drop("attempt")


def remove_old(spark: SparkSession, root: str) -> int:
    """Remove attempts that are not published; returns how many. No writer may be at work."""
    kept, removed = published(spark, root), 0
    for folder in child_folders(spark, root):
        if not folder.startswith("run_id="):
            continue
        part = unquote(folder.removeprefix("run_id="))
        for attempt in child_folders(spark, f"{root}/{folder}"):
            if attempt != f"attempt={kept.get(part)}":
                remove_path(spark, f"{root}/{folder}/{attempt}")
                removed += 1
    return removed
