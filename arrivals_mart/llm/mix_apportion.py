"""Mixing sources to target weights by Sainte-Lague apportionment.

1. Each document's size is its number of words; sources get targets by weight,
   none above three times its size.
2. The mix consists of equal blocks of words. A block is at most ``BLOCK_WORDS`` long and at most one
   ``LEAST_BLOCKS``-th of the smallest target (one word at least), so that whole blocks come near small targets
   too. The blocks go to sources by the highest quotients ``target / (2 * blocks + 1)``, never beyond three
   times what is there.
3. Each source is cut into shards by a seeded hash of the document id. A shard holds some hundred thousand words; a
   source's blocks go to its shards by the highest quotients again, which gives a quota per shard.
4. Inside a shard documents stand in seeded hash order. A quota is full passes over the shard's words plus a run
   of blocks from a seeded start, wrapping around. A document's ``taken`` words are its overlap with them, per pass,
   so a shard's taken words are exactly its quota.

Sources up to ``MAX_SOURCES`` are apportioned on the driver, one row each. More stay in a table: the common
level of the targets and the least quotient that wins a block are then found by a few aggregates over it. Shards are
gathered only of sources that have several, whose number is bounded by the words of a shard.

Null texts and texts without words have size 0 and are never taken. A null source is
a source of its own, last in order; a null id hashes like any other value. Repeated
rows each count, texts of any length are counted whole, and a document may lie across many blocks. Extra columns
pass through ``mix_documents`` and are ignored by ``mix``, whatever their names. No source or an empty table gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivals_mart.llm._common import WORD_PATTERN, written
from arrivals_mart.operators.keys import dense_key
from arrivals_mart.operators.lookups import sized_broadcast

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS, LEAST_BLOCKS = 32, 200
SHARD_WORDS = 250_000
#: Shards of sources that have several: a shard grows where there would be more.
MAX_SHARDS = 100_000
#: Sources that the driver apportions; more are apportioned in a table.
MAX_SOURCES = 100_000
SEED = 20


def targets(sizes: list[int], weights: list[float], max_repeats: int = MAX_REPEATS) -> list[float]:
    """Share sum(sizes) by weight; what exceeds ``max_repeats`` x size is shared anew among the rest."""
    out = [0.0] * len(sizes)
    free, left = list(range(len(sizes))), float(sum(sizes))
    while free:
        w = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / w > max_repeats * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / w
            break
        for i in over:
            out[i] = float(max_repeats * sizes[i])
        left -= sum(out[i] for i in over)
        gone = set(over)
        free = [i for i in free if i not in gone]
    return out


def sainte_lague(weights: np.ndarray, caps: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients w, w/3, w/5, ..., at most ``caps``; ties go to the smaller index.

    A quotient that just too few seats exceed is found by bisection; the seats
    that remain are given one by one.
    """
    weights, caps = np.asarray(weights, float), np.asarray(caps, np.int64)
    caps = np.where(weights > 0, caps, 0)
    seats = int(min(seats, caps.sum()))
    if seats <= 0:
        return np.zeros(len(weights), np.int64)

    def won(quotient: float) -> np.ndarray:
        """How many of its quotients each has above ``quotient``."""
        with np.errstate(over="ignore"):
            j = np.ceil((weights / quotient - 1) / 2)
        return np.minimum(np.clip(j, 0, 2.0**62), caps).astype(np.int64)

    low, high = 0.0, float(weights.max()) * 2
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        if won(mid).sum() > seats:
            low = mid
        else:
            high = mid
    got = won(high)
    rest = seats - int(got.sum())
    heap = [(-weights[i] / (2 * got[i] + 1), i) for i in np.flatnonzero(got < caps)]
    heapq.heapify(heap)
    while rest > 0 and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        rest -= 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-weights[i] / (2 * got[i] + 1), i))
    return got


def _sized(df: DataFrame, id_col: str, text_col: str, source_col: str) -> list:
    """Columns id, source, size (words) and the seeded order key of each row."""
    ident = F.col(f"`{id_col}`")
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")
    return [ident.alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"), size.alias("size")]


def _order_key(seed: int):
    return F.xxhash64(F.lit(seed + 1), F.col("id"))


def block_size(smallest: float | None, block_words: int = BLOCK_WORDS) -> int:
    """Words of a block, by the smallest target above zero."""
    return int(max(1, min(block_words, (smallest or 0) // LEAST_BLOCKS)))


def _few_sources(spark: SparkSession, rows: list, weights, block_words: int) -> tuple[DataFrame, int]:
    """Targets and blocks of sources that fit the driver, and the size of a block."""
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    names, sizes = [r["source"] for r in rows], [int(r["source_size"]) for r in rows]
    goal = targets(sizes, [float(weights[i % len(weights)]) for i in range(len(rows))])
    block = block_size(min((g for g in goal if g > 0), default=None), block_words)
    caps = np.array([MAX_REPEATS * s // block for s in sizes], np.int64)
    blocks = sainte_lague(np.array(goal), caps, round(sum(sizes) / block))
    columns = zip(names, sizes, range(len(names)), goal, blocks.tolist())
    return spark.createDataFrame(list(columns), "source string, source_size long, source_no long, target double, blocks long"), block


def _many_sources(sizes: DataFrame, weights, block_words: int) -> tuple[DataFrame, int]:
    """The same in a table. ``sizes`` has source and source_size."""
    numbered = dense_key(sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], "source_no", start=0)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    rows = written(numbered.drop("last").withColumns({"w": weight, "most": F.lit(float(MAX_REPEATS)) * F.col("source_size")}),
                   "mix-sources")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    # sources at their most drop out; the level that the others share rises until no more do
    level, out = 0.0, None
    while out != (free := rows.agg(
        F.count_if(F.col("w") * level < F.col("most")), F.sum(F.when(F.col("w") * level >= F.col("most"), F.col("most"))),
        F.sum(F.when(F.col("w") * level < F.col("most"), F.col("w"))),
    ).first()) and free[2]:
        out, level = free, (total - (free[1] or 0.0)) / free[2]
    rows = rows.withColumn("target", F.least(F.col("w") * level, "most"))
    block = block_size(rows.agg(F.min(F.when(F.col("target") > 0, F.col("target")))).first()[0], block_words)
    cap = F.expr(f"{MAX_REPEATS} * source_size div {block}")
    seats, caps = round(total / block), rows.agg(F.sum(cap)).first()[0] or 0
    if not 0 < seats < caps:
        return rows.select("source", "source_size", "source_no", "target", (cap if seats else F.lit(0)).alias("blocks")), block

    def won(quotient: float):
        """Quotients of a source above ``quotient``, as in ``sainte_lague``."""
        return F.greatest(F.lit(0), F.least(F.ceil((F.col("target") / F.lit(quotient) - 1) / 2), cap))

    # the least quotient that no more than the seats exceed, 33 times closer with each aggregate
    low, high = 0.0, 2 * rows.agg(F.max("target")).first()[0]
    while between := sorted({x for x in np.linspace(low, high, 34)[1:-1].tolist() if low < x < high}):
        sums = rows.agg(*[F.sum(won(x)) for x in between]).first()
        low = max([low] + [x for x, n in zip(between, sums) if n > seats])
        high = min([high] + [x for x, n in zip(between, sums) if n <= seats])
    rows = written(rows.withColumn("blocks", won(high)), "mix-won")
    rest = seats - (rows.agg(F.sum("blocks")).first()[0] or 0)
    # what is left goes to the quotients that tie at the level, smaller numbers first
    tied = dense_key(rows.filter(F.col("blocks") < cap).select(
        F.col("source_no").alias("tied_no"), (-F.col("target") / (2 * F.col("blocks") + 1)).alias("tied_quotient")),
        ["tied_quotient", "tied_no"], "nth")
    extra = tied.filter(F.col("nth") <= rest).select("tied_no", F.lit(1).alias("extra"))
    rows = rows.join(extra, F.col("source_no") == F.col("tied_no"), "left")
    return rows.select("source", "source_size", "source_no", "target", (F.col("blocks") + F.coalesce("extra", F.lit(0))).alias("blocks")), block


def quotas(spark: SparkSession, sized: DataFrame, weights=WEIGHTS, block_words: int = BLOCK_WORDS,
           shard_words: int = SHARD_WORDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(sources, shards): target and number of shards per source, and passes, run and start in words per shard.

    ``sized`` has id, source and size.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = sizes.limit(MAX_SOURCES + 1).collect()
    few = len(rows) <= MAX_SOURCES
    sources, block = _few_sources(spark, rows, weights, block_words) if few else _many_sources(sizes, weights, block_words)
    total = sum(int(r["source_size"]) for r in rows) if few else sizes.agg(F.sum("source_size")).first()[0]
    per_shard = max(shard_words, -(-total // MAX_SHARDS))
    sources = written(sources.withColumn("n_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / per_shard))), "mix-sources")
    several = sources.filter("n_shards > 1")
    # at most 2 * MAX_SHARDS rows
    parts: dict[int, list] = {}
    for r in sorted(_sharded(sized, several, seed).groupBy("source_no", "blocks", "shard").agg(F.sum("size").alias("size")).collect()):
        parts.setdefault(r["source_no"], []).append(r)
    out = []
    for own in parts.values():
        size = np.array([r["size"] for r in own], np.int64)
        got = sainte_lague(size.astype(float), MAX_REPEATS * size // block, own[0]["blocks"])
        out += [(r["source_no"], r["shard"], r["size"], int(n)) for r, n in zip(own, got)]
    shards = spark.createDataFrame(out, "source_no long, shard long, shard_size long, quota long").unionByName(
        sources.filter("n_shards = 1").select(
            "source_no", F.lit(0).cast("long").alias("shard"), F.col("source_size").alias("shard_size"), F.col("blocks").alias("quota")))
    start = F.pmod(F.xxhash64(F.lit(seed + 2), "source_no", "shard"), F.ceil(F.col("shard_size") / block)) * block
    shards = shards.filter("shard_size > 0").withColumns({
        "passes": F.expr(f"quota * {block} div shard_size"), "run": F.expr(f"quota * {block} % shard_size"), "first": start,
    })
    return sources.drop("blocks"), written(shards.drop("quota"), "mix-shards")


def _sharded(sized: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """Give each row its source's columns and its shard; sources are broadcast if they are proven to be few."""
    s = sized_broadcast(sources.withColumnRenamed("source", "_source"))
    return sized.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.col("n_shards"))
    )


def _overlap(lo: str, hi: str) -> str:
    return f"greatest(0L, least(upto, {hi}) - greatest(upto - size, {lo}))"


def mixed(sized: DataFrame, sources: DataFrame, shards: DataFrame, seed: int = SEED) -> DataFrame:
    """Add to each sized row its source's columns, passes, and the words of it in both ends of the run, and taken."""
    in_order = Window.partitionBy("source_no", "shard").orderBy(_order_key(seed), "id", "size")
    return (
        _sharded(sized, sources, seed)
        .withColumn("upto", F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .join(sized_broadcast(shards), ["source_no", "shard"], "left")
        .na.fill(0, ["passes", "run", "first", "shard_size"])
        .withColumns({
            "run_1": F.expr(_overlap("first", "least(first + run, shard_size)")),
            "run_2": F.expr(_overlap("0L", "greatest(0L, first + run - shard_size)")),
        })
        .withColumn("taken", F.expr("passes * size + run_1 + run_2"))
    )


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """One row per input row: id, size, source_size, target, taken."""
    sized = written(df.select(_sized(df, id_col, text_col, source_col)), "mix-sizes")
    sources, shards = quotas(df.sparkSession, sized, weights, block_words, seed=seed)
    return mixed(sized, sources, shards, seed).select("id", "size", "source_size", "target", "taken")


def mix_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  weights=WEIGHTS, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mix itself: whole rows of ``df``, each as often as the mix takes it (0 to 3 times).

    A document counts as taken by a run when at least half its words are. Documents of a
    shard stand in one order, so a run is one or two ranges of order keys; those bounds, a
    few per shard, are broadcast, and the texts are never shuffled.
    """
    sized = written(df.select(_sized(df, id_col, text_col, source_col)), "mix-sizes")
    sources, shards = quotas(df.sparkSession, sized, weights, block_words, seed=seed)
    key = F.struct(_order_key(seed).alias("k"), F.col("id"), F.col("size"))
    chosen = mixed(sized, sources, shards, seed).filter("size > 0")
    bounds = [
        F.min(F.when(F.expr(f"2 * {run} >= size"), key)).alias(f"lo_{run}") for run in ("run_1", "run_2")
    ] + [F.max(F.when(F.expr(f"2 * {run} >= size"), key)).alias(f"hi_{run}") for run in ("run_1", "run_2")]
    per_shard = chosen.groupBy("source_no", "shard", "passes").agg(*bounds)
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole"),
                      *_sized(df, id_col, text_col, source_col))
    inside = [
        F.coalesce(key.between(F.col(f"lo_{run}"), F.col(f"hi_{run}")), F.lit(False)) for run in ("run_1", "run_2")
    ]
    copies = F.col("passes") + (inside[0] | inside[1]).cast("bigint")
    return (
        _sharded(whole, sources, seed)
        .join(sized_broadcast(written(per_shard, "mix-bounds")), ["source_no", "shard"])
        .withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(F.lit(0)))
        .filter("copies > 0")
        .select("whole", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
        .select("whole.*")
    )
