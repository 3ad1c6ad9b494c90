"""Repeated passages by fixed-block anchors.

A window is ``WINDOW`` consecutive words of one document. A word is removed if some window that
covers it also starts in a document with a smaller id.

1. Index: a document is cut into blocks of ``BLOCK`` words that do not overlap. A window
   contains at least ``RUN`` whole consecutive blocks of its document; of each such run the block
   with the least hash is indexed.
2. Probe: every rolling block-sized gram of every document is a probe, unless it is the
   least of no run of ``RUN`` grams at the blocks' distance; such a gram can meet no
   indexed block of a shared window. If two documents share a window, the indexed block
   in one has an equal probe in the other.
3. Hits, both ends: probes with an equal block in a smaller document, and blocks with an equal
   probe in a larger one. The windows around hits are extended to: a window there is
   repeated if the hash of all its words (96 bits and more, of two polynomials) equals that of a
   window in a smaller document, so overlapping windows make up maximal exact repeats.

Equal grams never meet as pairs: per hash, the least id decides. A task settles what it can by itself and sends on
an entry or two per hash, whatever it has read, so a passage that fills a third of the corpus costs a few entries a
task; who receives them settles them in rounds and holds as few. What is sent are packed arrays, dealt by hash and then
by document.

Null texts have no words. Documents with a null id are kept whole and count for no other. Rows
that share an id never remove one another; they are told apart by the CRC of their text. An
empty table gives an empty result. Texts of any length are read whole. Extra
columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.llm._common import written

WINDOW, BLOCK = 50, 10
#: Whole blocks that a window contains wherever it starts.
RUN = (WINDOW - BLOCK + 1) // BLOCK
#: Entries that one task sorts at a time, and bytes of text that are worked on together.
ENTRIES, PIECE_BYTES = 1_500_000, 4 << 20
#: Tasks of a shuffle; beyond that many routes a task works on several, one after another.
MAX_TASKS = 20_000
#: Words that a task's table may hold before it is emptied.
TABLE_ENTRIES = 300_000
#: Odd bases of the two polynomials.
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_LAST = np.iinfo(np.int64).max
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class WordHashes(dict):
    """word -> 64-bit hash, filled as words come by."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= TABLE_ENTRIES:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        have = tuple(
            np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(n, 1 << 16), np.uint64(b))]), dtype=np.uint64)
            for b in (base, pow(base, -1, 1 << 64))
        )
        _POWERS[base] = have
    return have[0][:n], have[1][:n]


def rolling(h: np.ndarray, width: int, base: int = _BASES[0]) -> np.ndarray:
    """Mixed polynomial hash of every ``width`` consecutive entries."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(base, len(h))
    with np.errstate(over="ignore"):
        c = np.concatenate([[np.uint64(0)], np.cumsum(h * up, dtype=np.uint64)])
        x = (c[width:] - c[:-width]) * down[:n]
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def _runs(h: np.ndarray, pos: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(grams, starts, least): where runs of ``RUN`` grams, ``BLOCK`` words apart, begin, and their least gram."""
    grams = rolling(h, BLOCK)
    starts = np.flatnonzero((pos + RUN * BLOCK <= n_words) & (n_words >= WINDOW))
    least = np.minimum.reduce([grams[starts + t * BLOCK] for t in range(RUN)]) if len(starts) else grams[:0]
    return grams, starts, least


def anchors(h: np.ndarray, pos: np.ndarray, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a gram is the least of a run of grams of one document, and those grams.

    ``pos`` is the place of each word in its document and ``n_words`` that document's length.
    """
    grams, starts, least = _runs(h, pos, n_words)
    chosen = np.zeros(len(h), bool)
    for t in range(RUN):
        at = starts + t * BLOCK
        chosen[at[grams[at] == least]] = True
    where = np.flatnonzero(chosen)
    return where, grams[where]


def windows_near(h: np.ndarray, pos: np.ndarray, n_words: np.ndarray, hit: np.ndarray) -> np.ndarray:
    """Starts of the windows that contain a run whose least gram is a hit; no other can be repeated.

    The window that is equal elsewhere has such a run at the place of the other document's blocks.
    """
    grams, starts, least = _runs(h, pos, n_words)
    found = np.zeros(len(starts), bool)
    for t in range(RUN):
        at = starts + t * BLOCK
        found |= hit[at] & (grams[at] == least)
    starts = starts[found]
    begin = starts - pos[starts]
    lo = np.maximum(starts - (BLOCK - 1), begin)
    hi = np.minimum(starts, begin + n_words[starts] - WINDOW) + 1
    near = np.zeros(len(h) + 1, np.int64)
    np.add.at(near, lo[hi > lo], 1)
    np.add.at(near, hi[hi > lo], -1)
    return np.flatnonzero(np.cumsum(near[:-1]) > 0)


#: Columns of what is sent, as they stand in a packed row: probes and blocks, windows, findings.
GRAMS = {"id": "<i8", "crc": "<u4", "pos": "<u4", "hash": "<u4", "done": "?"}
WINDOWS = {"id": "<i8", "crc": "<u4", "pos": "<u4", "one": "<u4", "two": "<u8"}
FINDINGS = {"id": "<i8", "crc": "<u4", "pos": "<u4"}


def _pack(e: dict[str, np.ndarray], kinds: dict[str, str]) -> bytes:
    return zstandard.compress(b"".join(e[c].astype(t).tobytes() for c, t in kinds.items()), 1)


def _unpack(blob: bytes, kinds: dict[str, str]) -> dict[str, np.ndarray]:
    raw, at, e = zstandard.decompress(blob), 0, {}
    n = len(raw) // sum(np.dtype(t).itemsize for t in kinds.values())
    for c, t in kinds.items():
        e[c] = np.frombuffer(raw, t, n, at)
        at += e[c].nbytes
    return e


def _chosen(e: dict[str, np.ndarray], which: np.ndarray) -> dict[str, np.ndarray]:
    return {c: v[which] for c, v in e.items()}


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def _dealt(route: np.ndarray, e: dict[str, np.ndarray], kinds: dict[str, str]) -> Iterator[pa.RecordBatch]:
    """One packed row per distinct route."""
    order = np.lexsort((e["pos"], e["id"], route))
    route, e = route[order], _chosen(e, order)
    cuts = [0, *(np.flatnonzero(route[1:] != route[:-1]) + 1).tolist(), len(route)]
    for lo, hi in zip(cuts, cuts[1:]):
        if lo < hi:
            yield _row(int(route[lo]), _pack(_chosen(e, slice(lo, hi)), kinds))


def _row(route: int, blob: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([route], pa.int64()), pa.array([blob], pa.binary())], names=["route", "blob"])


def _by_route(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[bytes]]]:
    """The blobs of each route, one by one, of rows sorted by it."""
    rows = (r for b in batches for r in zip(b.column("route").to_pylist(), b.column("blob").to_pylist()))
    for route, some in groupby(rows, itemgetter(0)):
        yield route, (blob for _, blob in some)


class Entries:
    """Entries settled in rounds, so that one which many documents share is held a few times, however often it comes.

    ``settle`` tells which entries are found and which must stay, to be asked elsewhere or to tell others. A
    round is due at ``ENTRIES`` entries, and at twice as many as the last one left.
    """

    def __init__(self, settle: Callable) -> None:
        self.settle = settle
        self.take()

    def add(self, part: dict[str, np.ndarray]) -> bool:
        """Whether a round is due."""
        self.parts.append(part if "done" in part else {**part, "done": np.zeros(len(part["id"]), bool)})
        self.n += len(part["id"])
        return self.n >= self.limit

    def round(self) -> dict[str, np.ndarray]:
        """What is found now and was not before; what must stay is left."""
        e = _joined(self.parts)
        found, stays = self.settle(e)
        new = _chosen(e, found & ~e["done"])
        e["done"] = e["done"] | found
        self.parts = [_chosen(e, stays)]
        self.n = len(self.parts[0]["id"])
        self.limit = max(ENTRIES, 2 * self.n)
        return new

    def take(self) -> dict[str, np.ndarray]:
        """What the last round left; nothing is held afterwards."""
        left = self.parts[0] if getattr(self, "parts", None) else {}
        self.parts, self.n, self.limit = [], 0, ENTRIES
        return left


def _groups(keys: tuple[np.ndarray, ...], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by keys then id, group of each ordered row, first row of each group)."""
    order = np.lexsort((ids, *reversed(keys)))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


def _hits(e: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(hit, sent): which probes hit, and which must still be asked elsewhere or tell others of their hash.

    What tells others is, per hash, the block with the least id and the probe with the largest.
    """
    order, group, first = _groups((e["hash"],), e["id"])
    d, is_block = e["id"][order], e["pos"][order] % BLOCK == 0
    least = np.minimum.reduceat(np.where(is_block, d, _LAST), first) if len(first) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(d)) - 1 if len(first) else first
    hit = (d > least[group]) | (is_block & (d < d[last][group]))
    told = np.zeros(len(d), bool)
    told[last] = True
    at = np.flatnonzero(is_block & (d == least[group]))
    told[at[np.unique(group[at], return_index=True)[1]]] = True
    out_hit, out_sent = np.empty(len(d), bool), np.empty(len(d), bool)
    out_hit[order], out_sent[order] = hit, ~hit | told
    return out_hit, out_sent


def _repeats(e: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(found, rest): which windows have an equal one under a smaller id, and which have none so far."""
    order, group, first = _groups((e["one"], e["two"]), e["id"])
    out = np.empty(len(order), bool)
    d = e["id"][order]
    out[order] = d > d[first][group]
    return out, ~out


def _texts(b: pa.RecordBatch) -> Iterator[bytes]:
    if "packed" in b.schema.names:
        return map(zstandard.ZstdDecompressor().decompress, b.column("packed").to_pylist())
    return iter(b.column("text").cast(pa.binary()).to_pylist())


def _pieces(batches: Iterator[pa.RecordBatch], words: WordHashes, keep: Callable) -> Iterator[dict]:
    """Word hashes of about PIECE_BYTES of documents end to end, with their ids, CRCs and lengths."""
    for b in batches:
        ids, crcs = b.column("id").to_pylist(), b.column("crc").to_pylist()
        extra = b.column("pos").to_pylist() if "pos" in b.schema.names else [None] * len(ids)
        hashes, docs, size = [], [], 0
        for i, crc, text, x in zip(ids, crcs, _texts(b), extra):
            split = text.split() if text and keep(i) else []
            if len(split) >= WINDOW:
                hashes.append(np.fromiter(map(words.__getitem__, split), np.uint64, len(split)))
                docs.append((i, crc, x))
                size += len(text)
            if size >= PIECE_BYTES:
                yield _piece(hashes, docs)
                hashes, docs, size = [], [], 0
        if docs:
            yield _piece(hashes, docs)


def _piece(hashes: list[np.ndarray], docs: list[tuple]) -> dict:
    n = np.array([len(x) for x in hashes])
    start = np.cumsum(n) - n
    doc = np.repeat(np.arange(len(n)), n)
    return {"h": np.concatenate(hashes), "doc": doc, "pos": np.arange(n.sum()) - start[doc], "n": n, "start": start,
            "id": np.array([d[0] for d in docs], np.int64), "crc": np.array([d[1] for d in docs], np.int64),
            "extra": [d[2] for d in docs]}


def _home(ids: np.ndarray, homes: int) -> np.ndarray:
    """The route on which a document's findings are gathered; routes below 0 are homes."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return -1 - ((x >> np.uint64(33)).astype(np.int64) % homes)


def _spans(pos: np.ndarray) -> np.ndarray:
    """First and last of each stretch of consecutive positions, in turn; ``pos`` ascends."""
    cut = np.flatnonzero(np.diff(pos) > 1)
    return np.stack([pos[np.append(0, cut + 1)], pos[np.append(cut, len(pos) - 1)]], 1).ravel()


def _sent(parts: Iterator[dict[str, np.ndarray]], settle: Callable, key: str, kinds: dict[str, str], routes: int,
          homes: int) -> Iterator[pa.RecordBatch]:
    """Entries of one task: findings on their way home, the rest dealt by the upper half of ``key``.

    As long as rounds leave little, everything that the task reads is settled together.
    """

    def told(found):
        return _dealt(_home(found["id"], homes), found, FINDINGS)

    def asked(left):
        return _dealt((left[key] >> np.uint64(32)).astype(np.int64) % routes, left, kinds)

    held = Entries(settle)
    for part in parts:
        if held.add(part):
            yield from told(held.round())
            if 2 * held.n > ENTRIES:
                yield from asked(held.take())
    if held.n:
        yield from told(held.round())
        yield from asked(held.take())


def _gathered(routed: DataFrame, settle: Callable, kinds: dict[str, str], routes: int, homes: int,
              spans: bool = False) -> DataFrame:
    """Settle each route's entries, then gather per document: id, crc, pos (packed uint32).

    ``pos`` holds positions, or with ``spans`` the first and last of each stretch of them.
    """

    def reduce(batches):
        for route, blobs in _by_route(batches):
            if route < 0:
                yield from (_row(route, blob) for blob in blobs)
                continue
            held = Entries(settle)
            for blob in blobs:
                if held.add(_unpack(blob, kinds)):
                    found = held.round()
                    yield from _dealt(_home(found["id"], homes), found, FINDINGS)
            found = held.round()
            yield from _dealt(_home(found["id"], homes), found, FINDINGS)

    def gather(batches):
        for _, blobs in _by_route(batches):
            e = _joined([_unpack(blob, FINDINGS) for blob in blobs])
            order = np.lexsort((e["pos"], e["crc"], e["id"]))
            ids, crc, pos = e["id"][order], e["crc"][order].astype(np.int64), e["pos"][order]
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]) | (crc[1:] != crc[:-1])) + 1).tolist()]
            ends = [*cuts[1:], len(ids)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[cuts]), pa.array(crc[cuts]), pa.array(
                    [(_spans(pos[a:b].astype(np.int64)).astype("<u4") if spans else pos[a:b]).tobytes()
                     for a, b in zip(cuts, ends)], pa.binary())],
                names=["id", "crc", "pos"],
            )

    def dealt(df, n):
        tasks = min(n, MAX_TASKS)
        return df.repartitionById(tasks, ((F.col("route") + homes) % tasks).cast("int")).sortWithinPartitions("route")

    settled = dealt(routed, routes + homes).mapInArrow(reduce, "route bigint, blob binary")
    return dealt(settled, homes).mapInArrow(gather, "id bigint, crc bigint, pos binary")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.crc32(F.encode(text, "UTF-8")).alias("crc"), text.alias("text"))


def _packed(docs: DataFrame) -> DataFrame:
    """id, crc and the compressed text: texts that are shuffled whole take up less that way than in shuffle blocks."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("crc"), pa.array(map(pack, _texts(b)), pa.binary())], names=["id", "crc", "packed"]
                )

    return docs.mapInArrow(run, "id bigint, crc bigint, packed binary")


def hit_positions(docs: DataFrame, routes: int, homes: int) -> DataFrame:
    """id, crc and the positions of hit grams of every document that has any. ``docs``: id, crc, text."""

    def grams(batches):
        for p in _pieces(batches, WordHashes(), lambda i: i is not None):
            where, found = anchors(p["h"], p["pos"], p["n"][p["doc"]])
            doc = p["doc"][where]
            yield {"id": p["id"][doc], "crc": p["crc"][doc], "pos": p["pos"][where].astype(np.uint32), "hash": found}

    def run(batches):
        return _sent(grams(batches), _hits, "hash", GRAMS, routes, homes)

    return _gathered(docs.mapInArrow(run, "route bigint, blob binary"), _hits, GRAMS, routes, homes)


def repeated_windows(docs: DataFrame, routes: int, homes: int) -> DataFrame:
    """id, crc and spans of starts of repeated windows. ``docs``: id, crc, packed, pos (of hits)."""

    def windows(batches):
        for p in _pieces(batches, WordHashes(), lambda i: True):
            hit = np.zeros(len(p["h"]), bool)
            for start, hits in zip(p["start"], p["extra"]):
                hit[np.frombuffer(hits, "<u4").astype(np.int64) + start] = True
            at = windows_near(p["h"], p["pos"], p["n"][p["doc"]], hit)
            one, two = (rolling(p["h"], WINDOW, b)[at] for b in _BASES)
            doc = p["doc"][at]
            yield {"id": p["id"][doc], "crc": p["crc"][doc], "pos": p["pos"][at].astype(np.uint32), "one": one, "two": two}

    def run(batches):
        return _sent(windows(batches), _repeats, "one", WINDOWS, routes, homes)

    return _gathered(docs.mapInArrow(run, "route bigint, blob binary"), _repeats, WINDOWS, routes, homes, spans=True)


def kept_words(words: list[bytes], spans: np.ndarray) -> list[bytes]:
    """The words that no window covers; windows begin from the first to the last of each span."""
    cover = np.zeros(len(words) + 1, np.int64)
    spans = spans.astype(np.int64).reshape(-1, 2)
    np.add.at(cover, spans[:, 0], 1)
    np.add.at(cover, np.minimum(spans[:, 1] + WINDOW, len(words)), -1)
    free = np.cumsum(cover[:-1]) == 0
    return [w for w, x in zip(words, free.tolist()) if x]


def _finished(words: list[bytes], kept: list[bytes], texts: bool) -> tuple[int, int, str]:
    joined = b" ".join(kept)
    return len(words), len(words) - len(kept), joined.decode() if texts else hashlib.sha256(joined).hexdigest()


def drop_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """One row per input row: id, n_words, n_removed, and kept: the words that stay, joined by
    blanks, or with ``texts=False`` the SHA-256 of that, which spares moving the texts."""
    docs = _keyed(df, id_col, text_col)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    words = total // 6
    routes = max(1, -(-words // (ENTRIES * 2)))
    homes = max(1, -(-words // (ENTRIES * 4)))
    hits = hit_positions(docs, routes, homes).withColumnsRenamed({"id": "hit_id", "crc": "hit_crc"})
    beside = _packed(docs).join(hits, (F.col("id") == F.col("hit_id")) & (F.col("crc") == F.col("hit_crc")), "left")

    def split(batches):
        for b in batches:
            out = []
            for i, crc, text, packed, pos in zip(b.column("id").to_pylist(), b.column("crc").to_pylist(), _texts(b),
                                                 b.column("packed").to_pylist(), b.column("pos").to_pylist()):
                if pos is None:
                    own = text.split()
                    out.append((i, crc, *_finished(own, own, texts), None, None))
                else:
                    out.append((i, crc, None, None, None, packed, pos))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
                names = ["id", "crc", "n_words", "n_removed", "kept", "packed", "pos"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    schema = "id bigint, crc bigint, n_words bigint, n_removed bigint, kept string, packed binary, pos binary"
    parts = written(beside.select("id", "crc", "packed", "pos").mapInArrow(split, schema), "anchor-hits")
    touched = parts.filter("packed IS NOT NULL").select("id", "crc", "packed", "pos")
    starts = repeated_windows(touched, routes, homes).withColumnsRenamed({"id": "s_id", "crc": "s_crc", "pos": "starts"})
    cut = touched.select("id", "crc", "packed").join(starts, (F.col("id") == F.col("s_id")) & (F.col("crc") == F.col("s_crc")), "left")

    def finish(batches):
        for b in batches:
            out = []
            for i, text, s in zip(b.column("id").to_pylist(), _texts(b), b.column("starts").to_pylist()):
                own = text.split()
                kept = own if s is None else kept_words(own, np.frombuffer(s, "<u4"))
                out.append((i, *_finished(own, kept, texts)))
            if out:
                kinds, names = [pa.int64(), pa.int64(), pa.int64(), pa.string()], ["id", "n_words", "n_removed", "kept"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    done = cut.select("id", "packed", "starts").mapInArrow(finish, "id bigint, n_words bigint, n_removed bigint, kept string")
    return parts.filter("packed IS NULL").select("id", "n_words", "n_removed", "kept").unionByName(done)
