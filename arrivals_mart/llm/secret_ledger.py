"""Secret scans over historical versions with an incremental blob ledger.

A version (a text under some path) is addressed by the SHA-256 of its content, its blob. The
ledger is a table of (blob, rule version) pairs with the spans found. A scan takes
the versions' distinct blobs, leaves out those that the ledger has for this rule version,
scans each of the others once, appends them, and joins the findings back to every path. Plain
DataFrame operations throughout.

Where a rule matches follows from the pieces of text between its matches: a match begins
after all earlier pieces and matches, counted in code points. Copies of a blob are merged
before the shuffle, and the join back is a join of narrow rows, so a blob that a third
of all paths share is neither scanned nor shuffled more than once per task.

Null texts are the empty blob. Repeated rows each get their blob's findings. An empty
table scans nothing. Extra columns stay in the struct ``row``, so their names cannot clash. Texts of any length are
scanned whole, each as one value. Spans that begin at the same place are listed in the order of the rules.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_mart.llm._common import struct_of


@dataclass(frozen=True)
class Rule:
    """``pattern`` is applied leftmost and non-overlapping; a match fails if its ``group`` is shorter than ``least``."""

    kind: str
    pattern: str
    group: int
    least: int


#: The kinds of secret, in the order in which spans of one start are listed.
RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    # a run of the class that is long enough at all is matched whole, so the length can stand in the pattern
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
SPANS = "array<struct<start:bigint,kind_no:int,end:bigint,kind:string>>"


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    """A name for the rules as they stand; it changes with any of them."""
    return uuid.uuid5(uuid.NAMESPACE_OID, repr(rules)).hex


def _matches(text: Column, rule: Rule) -> Column:
    """Pieces before each match, the matches, and their deciding groups, as an array of structs.

    The piece after the last match has no match beside it and is dropped later.
    """
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("before"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("part"),
    )
    return F.when(text.rlike(rule.pattern), zipped)


def spans_of(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) for each row of ``blobs`` (blob, text), spans by start and then kind."""
    text = F.col("text")
    kinds = F.array(*[
        F.struct(F.lit(r.kind).alias("kind"), F.lit(i).alias("kind_no"), F.lit(r.least).alias("least"),
                 _matches(text, r).alias("matches"))
        for i, r in enumerate(rules)
    ])
    hit = F.filter(kinds, lambda k: k["matches"].isNotNull())
    each = blobs.select("blob", F.explode_outer(hit).alias("k")).select(
        "blob", "k.kind", "k.kind_no", "k.least", F.posexplode_outer("k.matches").alias("pos", "m")
    )
    in_order = Window.partitionBy("blob", "kind_no").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = each.select(
        "blob", "kind", "kind_no",
        (F.length("m.part") >= F.col("least")).alias("holds"),
        F.length("m.found").alias("size"),
        F.sum(F.length("m.before") + F.coalesce(F.length("m.found"), F.lit(0))).over(in_order).alias("end"),
    )
    span = F.struct((F.col("end") - F.col("size")).alias("start"), "kind_no", "end", "kind")
    return placed.groupBy("blob").agg(
        F.array_sort(F.collect_list(F.when(F.col("holds"), span))).cast(SPANS).alias("spans")
    )


class BlobLedger:
    """The table of scanned blobs at ``path``: one folder per rule version, one per scan below it."""

    def __init__(self, spark: SparkSession, path: str, rules: tuple[Rule, ...] = RULES):
        self.spark, self.rules, self.version = spark, rules, rule_version(rules)
        self.path = f"{path.rstrip('/')}/rules-{self.version}"

    def seen(self) -> DataFrame | None:
        """(blob, spans) of all scans under this rule version, or None before the first."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return None
        # the scans are named one by one: Spark takes two reads of one folder for the same, whatever was added between them
        scans = sorted(f.getPath().toString() for f in fs.listStatus(folder))
        schema = T.StructType.fromDDL(f"blob string, spans {SPANS}")
        return self.spark.read.schema(schema).parquet(*scans) if scans else None

    def scan(self, versions: DataFrame, text_col: str = "text") -> DataFrame:
        """Scan what is new in ``versions``; return ``row`` (its other columns), blob and spans of every version."""
        row, _ = struct_of(versions, text_col)
        text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
        addressed = versions.select(row.alias("row"), F.sha2(text, 256).alias("blob"), text.alias("text"))
        unseen = addressed.select("blob", "text")
        if (before := self.seen()) is not None:
            unseen = unseen.join(before.select("blob"), "blob", "left_anti")
        unseen = unseen.groupBy("blob").agg(F.any_value("text").alias("text"))
        spans_of(unseen, self.rules).write.parquet(f"{self.path}/scan-{uuid.uuid4().hex}")
        return addressed.select("row", "blob").join(self.seen(), "blob").select("row", "blob", "spans")


    def scan_deliveries(self, deliveries: Iterable[DataFrame], text_col: str = "text") -> DataFrame:
        """Scan deliveries of versions, one after another; each leaves out the blobs that those before it brought."""
        return reduce(DataFrame.unionByName, [self.scan(d, text_col) for d in deliveries])


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
