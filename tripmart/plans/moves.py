"""Moves of folders into a table that survive a kill.

New folders are written beside the table by a finished Spark job.  Then the moves
are written down, in a folder next to the table that no reader of the table looks
into, and carried out one by one: what a place held is set aside there, the new
folder takes its place.  Whoever opens the table next replays what a killed run
left half done; since the new folders were complete before the moves were written
down, going forward is always right.  A move that the store refuses undoes the
ones before it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tripmart.plans import fs


def _journals(table: str) -> str:
    parent, _, name = table.rstrip("/").rpartition("/")
    return f"{parent}/_moves/{name}"


def publish(spark: SparkSession, table: str, moves: Sequence[tuple[str | None, str]]) -> None:
    """Carry out ``moves`` (source folder, place); no source clears the place."""
    if not moves:
        return
    journal = f"{_journals(table)}/{uuid.uuid4().hex}"
    fs.write_text(spark, f"{journal}.json", json.dumps(list(moves)))
    try:
        _carry_out(spark, journal, moves)
    except Exception:
        _undo(spark, journal, moves)
        raise


def recover(spark: SparkSession, table: str) -> int:
    """Finish what killed runs left half done; the number of journals replayed."""
    found = sorted(f for f in fs.list_files(spark, _journals(table)) if f.endswith(".json"))
    for path in found:
        _carry_out(spark, path.removesuffix(".json"), json.loads(fs.read_text(spark, path)))
    return len(found)


def _carry_out(spark: SparkSession, journal: str, moves) -> None:
    for n, (source, place) in enumerate(moves):
        if source is not None and not fs.exists(spark, source):
            continue  # done before
        if fs.exists(spark, place):
            aside = f"{journal}.old/{n}"
            fs.rename(spark, place, aside if not fs.exists(spark, aside) else f"{aside}-{uuid.uuid4().hex}")
        if source is not None:
            fs.rename(spark, source, place)
    _end(spark, journal)


def _undo(spark: SparkSession, journal: str, moves) -> None:
    """Back to the old content; the journal stays if even that is refused."""
    for n, (source, place) in reversed(list(enumerate(moves))):
        aside = f"{journal}.old/{n}"
        if source is not None and not fs.exists(spark, source) and fs.exists(spark, place):
            fs.rename(spark, place, source)
        if fs.exists(spark, aside):
            fs.rename(spark, aside, place)
    _end(spark, journal)


def _end(spark: SparkSession, journal: str) -> None:
    """The journal goes first: from then on what was set aside is only waste."""
    for path in (f"{journal}.json", f"{journal}.old"):
        if fs.exists(spark, path) and not fs.delete(spark, path):
            raise OSError(f"could not delete {path}")
