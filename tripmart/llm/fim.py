"""Fill-in-middle transformation by secondary sort.

A text is cut into units (words with the white space before them); two cuts drawn
from a hash of its id make prefix, middle and suffix.  Tasks emit the parts in
chunks of units, keyed by document and by place in the output, with the marks as
pieces of their own.  ``repartition`` by document and ``sortWithinPartitions`` by
(document, place) bring a document's output by, piece after piece, into running
digests.  From the output pieces and the form alone, each mark tells which part
follows; the pieces are sorted again, by part, for the restored text.  No task
holds more than a piece of a text besides the row it came in.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import small_batches, table

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
#: The part that a mark opens, by its place in the text.
PART_OF = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
SEED, RATE, SPM_RATE = 42, 50, 80  # percent of texts cut, percent of those in the order spm
CHUNK = 1024  # units of a piece
ROWS, CHARS = 256, 1 << 20  # of pieces that leave a task at once

_HEAD = "copies long, doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"
_PIECES = f"key binary, at long, text string, {_HEAD}"
_PLACED = f"key binary, part int, at long, text string, {_HEAD}"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
_NONE = (None,) * 8


def _batch(rows: list, schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    columns = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), _TYPES[k]) for c, k in zip(columns, kinds)], names=list(names))


def _values(column: pa.Array) -> Iterator:
    """One by one: a batch of whole texts is not held a second time."""
    return (x.as_py() for x in column)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    for at in range(0, batch.num_rows, ROWS):
        yield from zip(*(c.to_pylist() for c in batch.slice(at, ROWS).columns))


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def draw(doc_id: int | None, text: str, n: int) -> tuple[str, int, int]:
    """(form, first cut, second cut) of a text of ``n`` units; a null id draws as an empty one."""
    digest = hashlib.sha256(f"{SEED}:{'' if doc_id is None else int(doc_id)}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    if not text or h[2] % 100 >= RATE or any(m in text for m in MARKS):
        return "plain", 0, 0
    cuts = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return "spm" if h[3] % 100 < SPM_RATE else "psm", cuts[0], cuts[1]


def _cut(move_plain: bool):
    """Texts into pieces.  Repeated rows of a task become one with a count."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list] = {}
        for batch in batches:
            out, chars = [], 0
            for doc_id, text in zip(*(_values(c) for c in batch.columns)):
                text = text or ""
                key = hashlib.sha256(f"{doc_id}:{text}".encode("utf-8", "surrogatepass")).digest()
                if key in seen:
                    seen[key][0] += 1
                    continue
                ends = [0, *(m.end() for m in UNIT.finditer(text))]
                n = len(ends) - 1
                form, first, second = draw(doc_id, text, n)
                spans = {PREFIX: (0, first), SUFFIX: (second, n), MIDDLE: (first, second)}
                if form == "plain":  # the output is the text: its pieces move only if texts are asked for
                    seen[key] = [1, doc_id, n, form, None, None, _digest(text), _digest(text)]
                    order = [("", 0, n)] if move_plain else []
                else:
                    seen[key] = [1, doc_id, n, form, ends[first], ends[second] - ends[first], None, None]
                    order = [(m, *spans[m]) for m in ((SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE))]
                at = 0
                for mark, lo, hi in order:
                    for piece in (mark, *(text[ends[u]:ends[min(u + CHUNK, hi)]] for u in range(lo, hi, CHUNK))):
                        out.append((key, at, piece, *_NONE))
                        at += 1
                        chars += len(piece)
                        if len(out) >= ROWS or chars >= CHARS:
                            yield _batch(out, _PIECES)
                            out, chars = [], 0
            yield _batch(out, _PIECES)
        heads = list(seen.items())
        for at in range(0, len(heads), 10_000):
            yield _batch([(k, -1, None, *head) for k, head in heads[at:at + 10_000]], _PIECES)

    return cut


def _documents(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[bytes, list, Iterator[tuple]]]:
    """(key, head, pieces) of each document in sorted rows: heads of several tasks
    become one, a piece that several tasks sent counts once; pieces are streamed."""
    rows = (row for batch in batches for row in _rows(batch))
    for key, group in itertools.groupby(rows, key=lambda r: r[0]):
        first = next(group)
        head = list(first[columns:])
        later = iter(())
        for row in group:
            if row[columns - 2] >= 0:
                later = itertools.chain([row], group)
                break
            head[0] += row[columns]
        yield key, head, (next(same)[:columns] for _, same in itertools.groupby(later, key=lambda r: r[1:columns - 1]))


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces into output digests.  A mark tells to which part of the text the
    pieces after it belong, and they are passed on with that part."""
    out = []
    for key, head, pieces_ in _documents(batches, 3):
        sha, part = hashlib.sha256(), 0
        for _, at, text in pieces_:
            sha.update(text.encode("utf-8", "surrogatepass"))
            if text in PART_OF:
                part = PART_OF[text]
            else:
                out.append((key, part, at, text, *_NONE))
            if len(out) >= ROWS:
                yield _batch(out, _PLACED)
                out = []
        if head[3] != "plain":
            head[6] = sha.hexdigest()
        out.append((key, -1, -1, None, *head))
    yield _batch(out, _PLACED)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in the order of the text into its digest."""
    out = []
    for _, head, pieces_ in _documents(batches, 4):
        if head[3] != "plain":
            sha = hashlib.sha256()
            for *_, text in pieces_:
                sha.update(text.encode("utf-8", "surrogatepass"))
            head[7] = sha.hexdigest()
        out.append(head)
        if len(out) >= 10_000:
            yield _batch(out, _HEAD)
            out = []
    yield _batch(out, _HEAD)


def _moved(docs: DataFrame, move_plain: bool) -> DataFrame:
    """Pieces of the texts (marks included) and one head, at -1, per distinct row and
    task; all of a document together, by place in its output."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(_cut(move_plain), _PIECES).repartition("key").sortWithinPartitions("key", "at")


def _each_copy(heads: DataFrame) -> DataFrame:
    return heads.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copies")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)
    of every row of ``docs`` (doc_id, text), extra columns left aside.

    Null texts count as empty; an empty text, one that holds a mark and those the
    draw leaves out are ``plain`` (no parts).  A null doc_id draws like an empty one
    and stays null.  Whole texts, however long, move as pieces of at most ``CHUNK``
    units.  Repeated rows move once per task and come back as often as they were
    there; rows with one doc_id and different texts have equal draws.  An empty
    table stays empty."""
    placed = _moved(docs, False).mapInArrow(_assemble, _PLACED).sortWithinPartitions("key", "part", "at")
    return _each_copy(placed.mapInArrow(_restore, _HEAD))


def transform(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): the same rows with the
    whole output texts, joined from the same pieces.  Edge cases as in :func:`digests`."""
    schema = "copies long, doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, head, pieces_ in _documents(batches, 3):
            yield _batch([(*head[:6], "".join(text for *_, text in pieces_))], schema)

    return _each_copy(_moved(docs, True).mapInArrow(join, schema))


def restore(outputs: DataFrame) -> DataFrame:
    """``outputs`` (form, output, other columns) with ``text``, the text before the
    transformation (replaces an extra column of that name).  A null output or form
    gives a null text."""
    p = F.split("output", "|".join(MARKS))
    text = (F.when(F.col("form") == "plain", F.col("output"))
            .when(F.col("form") == "psm", F.concat(F.get(p, F.lit(1)), F.get(p, F.lit(3)), F.get(p, F.lit(2))))
            .when(F.col("form") == "spm", F.concat(F.get(p, F.lit(2)), F.get(p, F.lit(3)), F.get(p, F.lit(1)))))
    names = [f"`{c}`" for c in outputs.columns if c.lower() != "text"]
    return outputs.select(*names, text.alias("text"))


def query(spark, sf_dir):
    """op13: every document cut, assembled and restored."""
    return digests(table(spark, sf_dir, "documents"))


_CUT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
ORACLE = f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_CUT}') AS u,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM cut),
parts AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
         array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
         array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:n], '') AS s FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE WHEN form = 'plain' THEN text ELSE p || m || s END) AS restored_sha256
FROM parts"""
