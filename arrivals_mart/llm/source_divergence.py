"""Divergence of sources by their terms, counted by length-bucketed packing.

1. Terms are runs of letters (ASCII letters in lower case, and all characters beyond ASCII). A task
   packs a term of up to 8 bytes into one uint64 and one of up to 16 into two, first byte
   highest; a radix sort of 16-bit digits by (group, term) puts equal terms side by side and
   their runs are counted in numpy. Longer terms go to buckets of their own, one per power of
   two of the length, which are sorted as byte strings.
2. The tasks' counts are shuffled by (lang, term) and summed. A language keeps the terms that
   enough of its documents hold.
3. Every (lang, source) group and every language gives each kept term a smoothed whole-number share.
4. A source's distance to another of its language is the sum of the differences over all kept
   terms. Only terms that occur in one of the two are visited: two terms absent from both differ by
   the same constant. Blocks of sources meet in tiles, a tile's terms in slices, so no task
   needs all sources of a language or all its terms.
5. A group's terms above its language's share are ranked by the difference.

Null text, lang and source are the empty text. Each row is a document of its own, repeated or not; no id
is read, and other columns are ignored whatever their names. A long text is counted in pieces that are
merged before it counts as one document. Groups without terms take part with zero counts; a
language without kept terms gives distances of 0 and no terms. Ties rank by the item's bytes.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivals_mart.llm._common import LOWER, written
from arrivals_mart.operators.lookups import sized_broadcast

MIN_DOCS = 30
TOP_TERMS = 50
SMOOTHING = 5
SCALE = 1_000_000_000
#: Bytes of text that are packed and sorted at a time.
PIECE_BYTES = 4 << 20
#: Distinct (group, term) counts that a task holds before it passes them on.
HELD_COUNTS = 1 << 20
#: Sources of a block: a tile of two blocks holds the square of it.
BLOCK_SOURCES = 1024
#: Rows of kept terms to a slice. Each slice passes on one sum per pair of sources.
SLICE_ROWS = 1 << 17
#: Differences that a tile computes at a time.
TILE_CELLS = 1 << 21

_LOWER = np.frombuffer(LOWER, np.uint8)
#: Bytes of terms, after lower-casing: a-z and everything beyond ASCII.
_IS_TERM = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Order by ``keys``, the last one most significant; equal keys keep their order.

    Least significant digits first, 16 bits at a time: numpy's stable sort of 16-bit
    numbers is a radix sort. Digits that are all equal are passed over.
    """
    order = None
    for key in keys:
        for shift in range(0, key.dtype.itemsize * 8, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) == 0 or digit.min() == digit.max():
                continue
            order = digit.argsort(kind="stable") if order is None else order[digit[order].argsort(kind="stable")]
    return np.arange(len(keys[0])) if order is None else order


def run_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


@dataclass
class Counts:
    """Counts of one length bucket. ``words`` are the packed terms, last word first, or one column of byte strings."""

    words: list[np.ndarray]
    group: np.ndarray
    n: np.ndarray
    docs: np.ndarray

    def merged(self) -> "Counts":
        """One row per (term, group), in that order; counts and documents are summed."""
        packed = self.words[0].dtype.kind == "u"
        order = radix_order([self.group.astype(np.uint32), *self.words]) if packed else _byte_order(self.words[0], self.group)
        words, group = [w[order] for w in self.words], self.group[order]
        at = run_starts([*words, group])
        if not len(at):
            return self
        return Counts([w[at] for w in words], group[at], np.add.reduceat(self.n[order], at),
                      np.add.reduceat(self.docs[order], at))

    def terms(self) -> pa.Array:
        return _strings(self.words)


def _byte_order(terms: np.ndarray, *minor: np.ndarray) -> np.ndarray:
    order = np.lexsort(minor) if minor else np.arange(len(terms))
    return order[terms[order].argsort(kind="stable")]


def _strings(words: list[np.ndarray]) -> pa.Array:
    """The terms as UTF-8. They hold no zero bytes, so padding is what is zero."""
    n = len(words[0])
    if words[0].dtype.kind == "u":
        cells = np.stack(words[::-1], 1).astype(">u8").view(np.uint8).reshape(n, -1)
    else:
        cells = np.ascontiguousarray(words[0]).view(np.uint8).reshape(n, -1)
    full = cells != 0
    ends = np.zeros(n + 1, np.int64)
    np.cumsum(full.sum(1), out=ends[1:])
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(ends), pa.py_buffer(cells[full])])


def bucket_of(length: np.ndarray) -> np.ndarray:
    """1 and 2: so many uint64 words. Beyond 16 bytes the power of two that holds the length."""
    wide = np.ceil(np.log2(np.maximum(length, 1))).astype(np.int64)
    return np.where(length <= 8, 1, np.where(length <= 16, 2, wide))


def _packed(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, n_words: int) -> list[np.ndarray]:
    """Words of each term, least significant first; the first byte is the highest of the last word."""
    words = []
    for w in range(n_words):
        word = np.zeros(len(starts), np.uint64)
        for k in range(8 * w, 8 * w + 8):
            inside = k < lengths
            byte = np.where(inside, data[np.minimum(starts + k, len(data) - 1)], 0).astype(np.uint64)
            word = word << np.uint64(8) | byte
        words.insert(0, word)
    return words


def _byte_strings(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    width = int(lengths.max())
    cells = np.zeros((len(starts), width), np.uint8)
    for row, (a, n) in zip(cells, zip(starts.tolist(), lengths.tolist())):
        row[:n] = data[a:a + n]
    return cells.view(f"S{width}").ravel()


def term_counts(data: np.ndarray, offsets: np.ndarray, groups: np.ndarray) -> dict[int, Counts]:
    """Counts per bucket of the documents ``data[offsets[i]:offsets[i + 1]]``, each of group ``groups[i]``."""
    data = _LOWER[data]
    inside = _IS_TERM[data]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    lengths = np.flatnonzero(inside & ~after) + 1 - starts
    doc = np.searchsorted(offsets, starts, "right") - 1
    buckets = bucket_of(lengths)
    out = {}
    for b in np.unique(buckets).tolist():
        rows = np.flatnonzero(buckets == b)
        s, n, d = starts[rows], lengths[rows], doc[rows].astype(np.uint32)
        words = _packed(data, s, n, b) if b <= 2 else [_byte_strings(data, s, n)]
        # documents come in order, so a stable sort by term and group leaves a document's equal terms together
        group = groups[d].astype(np.uint32)
        order = radix_order([group, *words]) if b <= 2 else _byte_order(words[0], d, group)
        words, group, d = [w[order] for w in words], group[order], d[order]
        per_doc = run_starts([*words, group, d])
        n = np.diff(np.append(per_doc, len(d)))
        words, group = [w[per_doc] for w in words], group[per_doc]
        at = run_starts([*words, group])
        out[b] = Counts([w[at] for w in words], group[at].astype(np.int64), np.add.reduceat(n, at),
                        np.diff(np.append(at, len(group))))
    return out


def joined(a: Counts, b: Counts) -> Counts:
    return Counts([np.concatenate(w) for w in zip(a.words, b.words)], np.concatenate([a.group, b.group]),
                  np.concatenate([a.n, b.n]), np.concatenate([a.docs, b.docs]))


def _long_text(data: np.ndarray, group: int, piece_bytes: int) -> dict[int, Counts]:
    """Counts of one long document, piece by piece; pieces end where no term is."""
    held: dict[int, Counts] = {}
    at = 0
    while at < len(data):
        end = min(len(data), at + piece_bytes)
        while end < len(data) and _IS_TERM[_LOWER[data[end - 1]]]:
            step = np.flatnonzero(~_IS_TERM[_LOWER[data[end:end + piece_bytes]]])
            end = end + int(step[0]) + 1 if len(step) else min(len(data), end + piece_bytes)
        for b, c in term_counts(data[at:end], np.array([0, end - at]), np.array([group])).items():
            held[b] = joined(held[b], c).merged() if b in held else c
        at = end
    for c in held.values():
        c.docs = np.ones_like(c.docs)
    return held


class _Held:
    """Counts that a task holds, with the names of its groups."""

    def __init__(self, most: int):
        self.most, self.names, self.counts, self.fresh = most, {}, {}, 0

    def group(self, lang: str, source: str) -> int:
        return self.names.setdefault((lang, source), len(self.names))

    def add(self, counts: dict[int, Counts]) -> None:
        for b, c in counts.items():
            self.counts.setdefault(b, []).append(c)
            self.fresh += len(c.n)

    def merge(self) -> int:
        for b, parts in self.counts.items():
            whole = parts[0]
            if len(parts) > 1:
                whole = Counts([np.concatenate([p.words[i] for p in parts]) for i in range(len(whole.words))],
                               *[np.concatenate([getattr(p, f) for p in parts]) for f in ("group", "n", "docs")]).merged()
            self.counts[b] = [whole]
        self.fresh = 0
        return sum(len(p[0].n) for p in self.counts.values())

    def passed_on(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        names = list(self.names)
        lang, source = pa.array([x[0] for x in names], pa.string()), pa.array([x[1] for x in names], pa.string())
        for (c,) in self.counts.values():
            terms = c.terms()
            for lo in range(0, len(c.n), 1 << 16):
                hi = min(lo + (1 << 16), len(c.n))
                g = pa.array(c.group[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [lang.take(g), source.take(g), terms.slice(lo, hi - lo).cast(pa.string()),
                     pa.array(c.n[lo:hi].astype(np.int64)), pa.array(c.docs[lo:hi].astype(np.int64))],
                    names=["lang", "source", "term", "n", "docs"],
                )
        self.names, self.counts = {}, {}


def count_batches(batches: Iterator[pa.RecordBatch], piece_bytes: int = PIECE_BYTES, held_counts: int = HELD_COUNTS):
    """Batches of (lang, source, text) to (lang, source, term, n, docs), summed as far as a task holds them."""
    held = _Held(held_counts)
    for b in batches:
        texts = b.column("text").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
        body = texts.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
        langs, sources = b.column("lang").to_pylist(), b.column("source").to_pylist()
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + piece_bytes, "right")) - 1)
            end = min(end, len(texts))
            piece = data[offsets[at]:offsets[end]]
            if len(piece) > piece_bytes:
                held.add(_long_text(piece, held.group(langs[at], sources[at]), piece_bytes))
            elif len(piece):
                groups = np.array([held.group(*g) for g in zip(langs[at:end], sources[at:end])], np.int64)
                held.add(term_counts(piece, offsets[at:end + 1] - offsets[at], groups))
            at = end
            if held.fresh > 2 * held.most and held.merge() > held.most:
                yield from held.passed_on()
    yield from held.passed_on()


def _share(n: str, total: str) -> F.Column:
    return F.expr(f"1 + (cast({n} + {SMOOTHING} as decimal(20, 0)) * {SCALE}) div ({total} + {SMOOTHING} * v)")


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term, source, n, lang_n, head): counts of each language's kept terms in the groups where they occur.

    ``docs`` has lang, source and text without nulls. ``lang_n`` is the count in the language; one row per
    (lang, term) has ``head``.
    """
    partial = docs.mapInArrow(count_batches, "lang string, source string, term string, n bigint, docs bigint")
    summed = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    same = Window.partitionBy("lang", "term")
    return (
        summed.withColumns({"d": F.sum("docs").over(same), "lang_n": F.sum("n").over(same),
                            "head": F.col("source") == F.min("source").over(same)})
        .filter(F.col("d") >= min_docs).drop("d", "docs")
    )


def group_table(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, lang_total, v, z, sources): one row per group, also those without terms."""
    per_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("head").alias("v"))
    groups = docs.select("lang", "source").groupBy("lang", "source").count().drop("count")
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    out = groups.join(totals, ["lang", "source"], "left").join(sources, "lang").join(per_lang, "lang", "left")
    out = out.na.fill(0, ["total", "lang_total", "v"])
    return out.withColumn("z", F.when(F.col("v") > 0, _share("0", "total")).otherwise(F.lit(0)))


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lang, bi, bj, slice, term): first the sources of both blocks (no term), then their terms."""
    tile = None
    for b in batches:
        cols = {n: b.column(n) for n in b.schema.names}
        keys = list(zip(*(cols[n].to_pylist() for n in ("lang", "bi", "bj", "slice"))))
        cuts = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if tile is None or tile.key != keys[lo]:
                if tile is not None:
                    yield from tile.sums()
                tile = _Tile(keys[lo])
            tile.add(b.slice(lo, hi - lo))
    if tile is not None:
        yield from tile.sums()


class _Tile:
    """Sums of differences between the sources of block ``bi`` (rows) and of ``bj`` (columns) over a slice of terms.

    A term that occurs in the row's source counts twice where the column's source lacks it and once where
    that has it too, since it is met there again; halved, every term of the two counts once.
    """

    def __init__(self, key):
        self.key, self.diagonal = key, key[1] == key[2]
        self.no: list[dict[str, int]] = [{}, {}]
        self.base: list = [[], []]
        self.sum = self.open = None

    def add(self, b: pa.RecordBatch) -> None:
        heads = b.filter(b.column("term").is_null())
        for name, side, p in zip(*(heads.column(n).to_pylist() for n in ("source", "side", "p"))):
            for s in (0, 1) if self.diagonal else (side,):
                self.no[s][name] = len(self.base[s])
                self.base[s].append(p)
        rows = pa.Table.from_batches([b.filter(b.column("term").is_valid())])
        if not rows.num_rows:
            return
        if self.sum is None:
            self.base = [np.array(x, np.int64) for x in self.base]
            self.sum = np.zeros((len(self.base[0]), len(self.base[1])), np.int64)
        # the last term may go on in the next batch
        rows = pa.concat_tables([self.open, rows]) if self.open is not None else rows
        code = np.asarray(rows.column("term").combine_chunks().dictionary_encode().indices)
        last = int(run_starts([code])[-1])
        self._count(rows.slice(0, last), code[:last])
        self.open = rows.slice(last)

    def _count(self, rows: pa.Table, code: np.ndarray) -> None:
        """Add whole terms; rows of one term stand together. A block may be without sources."""
        if not len(code) or not self.sum.size:
            return
        side, p = np.asarray(rows.column("side")), np.asarray(rows.column("p"))
        number = np.array([self.no[0 if self.diagonal else s][name]
                           for s, name in zip(side.tolist(), rows.column("source").to_pylist())], np.int64)
        starts = run_starts([code])
        ordinal = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(code))))
        step = max(1, TILE_CELLS // self.sum.shape[1])
        for lo in range(0, len(starts), step):
            chosen = (ordinal >= lo) & (ordinal < lo + step)
            at, s, no, x = ordinal[chosen] - lo, side[chosen], number[chosen], p[chosen]
            column = np.ones(len(s), bool) if self.diagonal else s == 1
            dense = np.broadcast_to(self.base[1], (int(at.max()) + 1, len(self.base[1]))).copy()
            there = np.zeros(dense.shape, bool)
            dense[at[column], no[column]] = x[column]
            there[at[column], no[column]] = True
            own = np.arange(len(at)) if self.diagonal else np.flatnonzero(s == 0)
            own = own[radix_order([no[own].astype(np.uint32)])] if len(own) else own
            for a in range(0, len(own), step):
                r = own[a:a + step]
                away = np.abs(x[r, None] - dense[at[r]]) - np.abs(self.base[0][no[r], None] - self.base[1])
                away *= 2 - there[at[r]]
                first = run_starts([no[r]])
                self.sum[no[r][first]] += np.add.reduceat(away, first, axis=0)

    def sums(self) -> Iterator[pa.RecordBatch]:
        """(lang, one, two, twice): each pair of sources once, ``one`` the smaller name."""
        if self.open is None:
            return
        self._count(self.open, np.zeros(self.open.num_rows, np.int64))
        names = [np.array(list(x), object) for x in self.no]
        whole = np.triu(self.sum + self.sum.T, 1) if self.diagonal else self.sum
        i, j = np.nonzero(whole)
        for lo in range(0, len(i), 1 << 16):
            rows, columns = i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
            a, b = names[0][rows], names[1][columns]
            turned = a > b
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.key[0]] * len(a), pa.string()), pa.array(np.where(turned, b, a), pa.string()),
                 pa.array(np.where(turned, a, b), pa.string()), pa.array(whole[rows, columns])],
                names=["lang", "one", "two", "twice"],
            )


def source_pairs(kept: DataFrame, groups: DataFrame, block_sources: int = BLOCK_SOURCES) -> DataFrame:
    """(lang, source, item, value): distance of each source to every other of its language.

    ``kept`` has lang, source, term and p; ``groups`` the groups' ``z`` (the share of a term without counts).
    """
    slices = max(1, -(-kept.count() // SLICE_ROWS))
    blocks = F.ceil(F.col("sources") / block_sources).cast("int")
    own = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    both = F.flatten(F.transform(every, lambda o: F.when(
        o == F.col("own"), F.array(F.struct(F.col("own").alias("bi"), o.alias("bj"), F.lit(0).alias("side")))
    ).otherwise(F.array(F.struct(F.col("own").alias("bi"), o.alias("bj"), F.lit(0).alias("side")),
                        F.struct(o.alias("bi"), F.col("own").alias("bj"), F.lit(1).alias("side"))))))
    columns = ["lang", "tile.bi", "tile.bj", "slice", "tile.side", "source", "term", "p"]

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("tile", F.explode(both))

    heads = dealt(groups).withColumns({
        "slice": F.explode(F.sequence(F.lit(0), F.lit(slices - 1))), "term": F.lit(None).cast("string"), "p": F.col("z"),
    }).select(*columns)
    terms = dealt(kept).withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int")).select(*columns)
    keys = ["lang", "bi", "bj", "slice"]
    tiles = heads.unionByName(terms).repartition(*keys).sortWithinPartitions(*keys, F.col("term").asc_nulls_first())
    sums = tiles.mapInArrow(_tiles, "lang string, one string, two string, twice bigint").groupBy(
        "lang", "one", "two").agg(F.sum("twice").alias("twice"))
    a = groups.select("lang", "source", "v", F.col("z").alias("za"))
    b = groups.select("lang", F.col("source").alias("other"), F.col("z").alias("zb"))
    pairs = a.join(b, "lang").filter("source <> other").withColumns({
        "one": F.least("source", "other"), "two": F.greatest("source", "other"),
    }).join(sums, ["lang", "one", "two"], "left")
    value = F.expr("v * abs(za - zb) + coalesce(twice, 0L) div 2")
    return pairs.select("lang", "source", F.col("other").alias("item"), value.alias("value"))


def divergence(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
               min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    docs = df.select(*[
        F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
        for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
    ])
    kept = written(kept_terms(docs, min_docs), "divergence-terms")
    groups = written(group_table(docs, kept), "divergence-groups")
    # one row per group: broadcast only if that is a bounded number
    shares = kept.join(sized_broadcast(groups), ["lang", "source"]).withColumns({
        "p": _share("n", "total"), "q": _share("lang_n", "lang_total"),
    })
    terms = shares.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("p - q").alias("value"))
    pairs = source_pairs(shares.select("lang", "source", "term", "p", "sources"), groups)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    terms = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_terms)
    pairs = pairs.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
