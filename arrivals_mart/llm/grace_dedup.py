"""Exact deduplication by Grace hashing.

Rows are first grouped inside each Arrow batch. A text that comes twice in a batch is remembered beyond it, in a
table of bounded size, so a text that fills a third of the corpus leaves a task once (or once per filling of that
table). The leaders (one row per distinct text) are dealt to tasks by the hash of their text. A task whose bucket does
not fit in memory partitions it into spill files by further bits of the hash, and
those again, until the distinct texts of a file fit an open-addressing table. The
table compares complete contents; hashes only choose slots and files.

Texts are equal when identical after lower-casing A-Z; null counts as empty. Of
equal texts the row with the largest id stays; a null id is smaller than any other;
of rows that tie on the id, exactly one stays. An empty table gives an empty result.
Extra columns are kept in a struct, so their names cannot clash. Texts of any length are compared whole.

Spill files lie below Spark's own local directories, where shuffle files lie too: they are large enough, and
the task that wrote the files reads and removes them.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import struct
import tempfile
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_mart.llm._common import LOWER, struct_of, written

#: Bytes of distinct texts that one open-addressing table may hold before its bucket is partitioned.
TABLE_BYTES = 48 << 20
#: Bytes of texts with copies that a task remembers from batch to batch.
HOT_BYTES = 16 << 20
#: Spill files per partitioning pass: four bits of the hash.
FANOUT_BITS = 4
_SIGN = 1 << 63
_HEAD = struct.Struct("<QqqqqBII")


class OpenAddressingTable:
    """Distinct byte strings by linear probing; equality is of complete contents."""

    def __init__(self, capacity: int = 1024):
        self._mask = capacity - 1
        self._slots = [-1] * capacity
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def __len__(self) -> int:
        return len(self.contents)

    def place(self, h: int, content: bytes) -> tuple[int, bool]:
        """The entry of ``content`` and whether it is new."""
        slots, mask = self._slots, self._mask
        i = h & mask
        while (e := slots[i]) >= 0:
            if self.hashes[e] == h and self.contents[e] == content:
                return e, False
            i = (i + 1) & mask
        e = slots[i] = len(self.contents)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + 100
        if 3 * len(self.contents) > 2 * (mask + 1):
            self._grow()
        return e, True

    def find(self, h: int, content: bytes) -> int:
        """The entry of ``content``, or -1."""
        i = h & self._mask
        while (e := self._slots[i]) >= 0:
            if self.hashes[e] == h and self.contents[e] == content:
                return e
            i = (i + 1) & self._mask
        return -1

    def _grow(self) -> None:
        capacity = 2 * (self._mask + 1)
        self._mask = mask = capacity - 1
        self._slots = slots = [-1] * capacity
        for e, h in enumerate(self.hashes):
            i = h & mask
            while slots[i] >= 0:
                i = (i + 1) & mask
            slots[i] = e


class Record(NamedTuple):
    """A leader: one distinct text of one batch or task, under the largest id that it has there.

    ``cls`` is the key that the copies refer to, where it is not the leader's own.
    """

    hash: int
    key: int
    id: int | None
    count: int
    text: bytes | None
    rest: bytes
    cls: int | None = None

    @property
    def rank(self) -> tuple[bool, int, int]:
        """Larger stays: null ids last, then the id, then the smaller row key."""
        return self.id is not None, self.id or 0, -self.key


def normalised(text: bytes | None) -> bytes:
    return text.translate(LOWER) if text else b""


def _spill(records: Iterable[Record], level: int, folder: str) -> list[str]:
    """Partition records into files by the four bits of the hash that belong to ``level``."""
    paths = [os.path.join(folder, f"{level}-{b:02d}") for b in range(1 << FANOUT_BITS)]
    files = [open(p, "wb") for p in paths]
    try:
        for r in records:
            f = files[(r.hash >> (FANOUT_BITS * level)) & ((1 << FANOUT_BITS) - 1)]
            kind = (r.id is None) | (r.text is None) << 1
            f.write(_HEAD.pack(r.hash, r.key, r.key if r.cls is None else r.cls, r.id or 0, r.count, kind, len(r.text or b""),
                               len(r.rest)))
            f.write(r.text or b"")
            f.write(r.rest)
    finally:
        for f in files:
            f.close()
    return paths


def _load(path: str) -> Iterator[Record]:
    with open(path, "rb") as f:
        while head := f.read(_HEAD.size):
            h, key, cls, ident, count, kind, n, m = _HEAD.unpack(head)
            text, rest = f.read(n), f.read(m)
            yield Record(h, key, None if kind & 1 else ident, count, None if kind & 2 else text, rest, cls)


class _Groups:
    """The table of one bucket with what is known of each distinct text."""

    def __init__(self) -> None:
        self.table = OpenAddressingTable()
        self.best: list[Record] = []
        self.sizes: list[int] = []
        self.keys: list[tuple[int, int]] = []

    def add(self, r: Record, keep_keys: bool, keep_rows: bool) -> None:
        e, new = self.table.place(r.hash, normalised(r.text))
        lean = r if keep_rows else r._replace(text=None, rest=b"")
        if new:
            self.best.append(lean)
            self.sizes.append(r.count)
            self.table.bytes += len(lean.text or b"") + len(lean.rest)
        else:
            self.sizes[e] += r.count
            if r.rank > self.best[e].rank:
                self.best[e] = lean
        if keep_keys:
            self.keys.append((r.key if r.cls is None else r.cls, e))


def grace(records: Iterable[Record], limit: int, keep_keys: bool, keep_rows: bool, level: int = 0,
          folder: str | None = None, source: str | None = None) -> Iterator[_Groups]:
    """Groups of equal texts, one bucket at a time, none above ``limit`` bytes of distinct texts.

    A bucket that grows beyond the limit goes to spill files by its next four hash
    bits, each of which is treated alike. Only texts that agree in all 64 bits are
    never partitioned again; those are copies, which the table holds once.
    """
    records = iter(records)
    groups, read, held = _Groups(), [], 0
    for r in records:
        if source is None:
            read.append(r)
            held += len(r.text or b"") + len(r.rest) + 100
        groups.add(r, keep_keys, keep_rows)
        if groups.table.bytes > limit and FANOUT_BITS * level < 64 or held > 2 * limit:
            break
    else:
        yield groups
        return

    def everything() -> Iterator[Record]:
        if source is not None:
            yield from _load(source)
            return
        yield from read
        read.clear()
        yield from records

    del groups
    with tempfile.TemporaryDirectory(dir=folder or _local_directory()) as sub:
        for path in _spill(everything(), level, sub):
            if os.path.getsize(path):
                yield from grace(_load(path), limit, keep_keys, keep_rows, level + 1, sub, path)
            os.remove(path)


def _local_directory() -> str | None:
    """One of the directories that Spark gives its Python workers for local files; the system's own outside of Spark."""
    given = [d for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(d)]
    return given[os.getpid() % len(given)] if given else None


class _Copied:
    """Texts that came twice in a batch: their copies of later batches are counted here, and their leader leaves last."""

    def __init__(self) -> None:
        self.table = OpenAddressingTable()
        self.cls: list[int] = []
        self.count: list[int] = []
        self.best: list[tuple] = []

    def add(self, h: int, content: bytes, key: int, ident: int | None, count: int, size: int) -> tuple[int, bool]:
        """The entry of a batch's leader, or -1 if it has no copies, and whether it is the best copy so far."""
        e = self.table.find(h, content)
        if e < 0 and count < 2:
            return -1, False
        rank = Record(h, key, ident, count, None, b"").rank
        if e < 0:
            e, _ = self.table.place(h, content)
            self.table.bytes += size
            self.cls.append(key)
            self.count.append(0)
            self.best.append((rank,))
        self.count[e] += count
        return e, self.count[e] == count or rank > self.best[e][0]

    def keep(self, e: int, key: int, ident: int | None, text: bytes | None, sha: str, rest: object) -> None:
        self.best[e] = (Record(0, key, ident, 0, None, b"").rank, key, ident, text, sha, rest)

    def rows(self, schema: pa.Schema) -> pa.RecordBatch:
        best = list(zip(*self.best)) or [[]] * 6
        n = len(self.cls)
        columns = {
            "row_key": best[1], "leader_key": self.cls, "id": best[2], "text_sha256": best[4],
            "hash": [_signed(h) for h in self.table.hashes], "count": self.count, "is_leader": [True] * n,
            "member": [False] * n, "text": best[3], "rest": best[5],
        }
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], pa.binary()).cast(pa.string()) if f.name == "text" else pa.array(columns[f.name], f.type)
             for f in schema], schema=schema)


def _signed(h: int) -> int:
    return h - (_SIGN << 1) if h >= _SIGN else h


def _leaders(batches: Iterator[pa.RecordBatch], schema: pa.Schema, only_leaders: bool) -> Iterator[pa.RecordBatch]:
    """Every row learns the key of its class; leaders carry the text and the number of copies.

    The leader of a text with copies is a row beside the members, sent when the task ends or its table is full.
    """
    key = TaskContext.get().partitionId() << 33
    copied = _Copied()
    for batch in batches:
        n = batch.num_rows
        ids = batch.column("id").to_pylist()
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        table, leader, size, of = OpenAddressingTable(), [], [], []
        for i, text in enumerate(texts):
            norm = normalised(text)
            e, new = table.place(xxhash.xxh64_intdigest(norm), norm)
            of.append(e)
            if new:
                leader.append(i)
                size.append(1)
            else:
                size[e] += 1
                j = leader[e]
                if ids[i] is not None and (ids[j] is None or ids[i] > ids[j]):
                    leader[e] = i
        shas = [hashlib.sha256(c).hexdigest() for c in table.contents]
        lead, cls = [False] * n, []
        for e, i in enumerate(leader):
            at, best = copied.add(table.hashes[e], table.contents[e], key + i, ids[i], size[e], len(texts[i] or b""))
            lead[i] = at < 0
            cls.append(key + i if at < 0 else copied.cls[at])
            if best:
                rest = batch.column("rest")[i].as_py() if "rest" in schema.names else None
                copied.keep(at, key + i, ids[i], texts[i], shas[e], rest)
        columns = {
            "row_key": pa.array(range(key, key + n), pa.int64()),
            "leader_key": pa.array([cls[e] for e in of], pa.int64()),
            "id": batch.column("id"),
            "text_sha256": pa.array([shas[e] for e in of], pa.string()),
            "hash": pa.array([_signed(table.hashes[e]) for e in of], pa.int64()),
            "count": pa.array([size[e] for e in of], pa.int64()),
            "is_leader": pa.array(lead, pa.bool_()),
            "member": pa.array([True] * n, pa.bool_()),
            "text": pa.array([t if x else None for t, x in zip(texts, lead)], pa.binary()).cast(pa.string()),
        }
        if "rest" in schema.names:
            columns["rest"] = batch.column("rest")
        out = pa.RecordBatch.from_arrays([columns[c] for c in schema.names], schema=schema)
        yield out.filter(columns["is_leader"]) if only_leaders else out
        key += n
        if copied.table.bytes > HOT_BYTES:
            yield copied.rows(schema)
            copied = _Copied()
    yield copied.rows(schema)


def _staged(df: DataFrame, id_col: str, text_col: str, rows: bool) -> DataFrame:
    ident, text = F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text")
    rest, rest_type = struct_of(df, text_col)
    fields = "row_key bigint, leader_key bigint, id bigint, text_sha256 string, hash bigint, count bigint, is_leader boolean, " \
             "member boolean, text string"
    schema = T.StructType.fromDDL(fields)
    if rows:
        schema = schema.add("rest", rest_type)

    def run(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        types = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
        arrow = pa.schema([
            pa.field(f.name, first.schema.field("rest").type if f.name == "rest" else types[f.dataType.simpleString()])
            for f in schema.fields
        ])
        yield from _leaders((b for part in ([first], batches) for b in part), arrow, rows)

    return df.select(ident, text, *([rest.alias("rest")] if rows else [])).mapInArrow(run, schema)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[Record]:
    for b in batches:
        rest = b.column("rest").to_pylist() if "rest" in b.schema.names else [None] * b.num_rows
        for h, key, cls, ident, count, text, x in zip(
            b.column("hash").to_pylist(), b.column("row_key").to_pylist(), b.column("leader_key").to_pylist(),
            b.column("id").to_pylist(), b.column("count").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(), rest,
            strict=True,
        ):
            yield Record(h % (_SIGN << 1), key, ident, count, text, b"" if x is None else pickle.dumps(x), cls)


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per input row: id, text_sha256, keep_id, group_size, kept."""
    staged = written(_staged(df, id_col, text_col, rows=False), "grace-leaders")

    def run(batches):
        for g in grace(_records(batches), table_bytes, keep_keys=True, keep_rows=False):
            for at in range(0, len(g.keys), 50_000):
                some = g.keys[at:at + 50_000]
                yield pa.RecordBatch.from_pydict({
                    "class_key": pa.array([k for k, _ in some], pa.int64()),
                    "keep_key": pa.array([g.best[e].key for _, e in some], pa.int64()),
                    "keep_id": pa.array([g.best[e].id for _, e in some], pa.int64()),
                    "group_size": pa.array([g.sizes[e] for _, e in some], pa.int64()),
                })

    classes = (
        staged.filter("is_leader").select("row_key", "leader_key", "id", "hash", "count", "text").repartition("hash")
        .mapInArrow(run, "class_key bigint, keep_key bigint, keep_id bigint, group_size bigint")
    )
    members = staged.filter("member").select("row_key", "leader_key", "id", "text_sha256")
    return members.join(classes, F.col("leader_key") == F.col("class_key")).select(
        "id", "text_sha256", "keep_id", "group_size", (F.col("row_key") == F.col("keep_key")).alias("kept")
    )


def drop_exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows that stay, whole, with the columns of ``df``. Texts cross one shuffle; those with copies once per task (or filling of its table)."""
    staged = _staged(df, id_col, text_col, rows=True)
    rest_type = staged.schema["rest"].dataType
    schema = T.StructType([T.StructField("rest", rest_type), T.StructField("text", T.StringType())])

    def run(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        kind = first.schema.field("rest").type
        for g in grace(_records(b for part in ([first], batches) for b in part), table_bytes, False, True):
            for at in range(0, len(g.best), 2000):
                some = g.best[at:at + 2000]
                yield pa.RecordBatch.from_pydict({
                    "rest": pa.array([pickle.loads(r.rest) for r in some], kind),
                    "text": pa.array([r.text for r in some], pa.binary()).cast(pa.string()),
                })

    kept = staged.select("row_key", "leader_key", "id", "hash", "count", "text", "rest").repartition("hash").mapInArrow(run, schema)
    return kept.select(*[
        F.col("text").alias(c) if c == text_col else F.col(f"rest.`{c}`").alias(c) for c in df.columns
    ])
