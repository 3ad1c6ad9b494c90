"""Label dictionary text -> lookup tables.

The dictionary is a text file of ``value <name>`` blocks of ``code = 'label'``
entries, in statements that end in ``;``. Codes are numbers, bare words or quoted text, labels are
quoted, in single or double quotes with the quote doubled as escape; ``value`` may be in any letter case,
options in parentheses may follow its name, and comments are ``/* ... */``. Comments, quoted text,
headers and entries may span lines (the lines of a quoted text are joined by a blank).

The file is split like any text file, so what a line means depends on what is open before it, maybe
in an earlier split. A lexer of seven states (in text, a comment, single quotes, double quotes, three places
of a header) is a function of a line: which state follows each state. These functions are composed by
a prefix scan: over the lines of a block of lines, over the blocks of a split, and over the splits of a file, one
row each. Every line then knows its state and is cleaned of its comments; lines that go on with an
open entry or header are joined to it; and the records that result are matched with patterns.

An entry belongs to the closest header above it: a window inside each split finds it, or a carry-over from earlier
splits computed on one row per split. So no single task has to see a whole file, though a dictionary whose quote
or comment is never closed puts all that follows into one record.

Nothing is left out silently: one warning counts the entries of a block that are not taken (in a statement that
does not begin with one, or without a quoted label), and one the files that end inside a comment or quotes.
"""

from __future__ import annotations

import os
import re
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivals_mart.session import stored

# Block names of the arrival label file and the label forms
# that mark a code as not usable.
COUNTRY_BLOCK = "i94cntyl"
PORT_BLOCK = "$i94prtl"
MODE_BLOCK = "i94model"
STATE_BLOCK = "i94addrl"
# Codes that may become literals of a plan
MAX_LITERAL_CODES = 1000
INVALID_LABEL_PATTERN = r"(?i)^(INVALID\b|Collapsed\b|No .*Code\b)"

_HEADER = r"(?i)^\s*value\s+(\$?[A-Za-z_][A-Za-z0-9_]*)"
_OPTIONS = r"(?:\s*\([^)]*\))?"
# possessive loops over unquoted runs: a label of any length is matched without recursion
_SINGLE = r"'([^']*+(?:''[^']*+)*+)'"
_DOUBLE = r'"([^"]*+(?:""[^"]*+)*+)"'
_ENTRY = rf"(?:{_SINGLE}|{_DOUBLE}|([^\s=;'\"]++))\s*+=\s*+(?:{_SINGLE}|{_DOUBLE})"
_ENTRY_PARTS = ("single_code", "double_code", "bare_code", "single_label", "double_label")

# States of the lexer: in text, a comment, single quotes, double quotes, the options of a header; after ``value``, after
# ``value`` and a name.
STATES = "TCSDPVN"
# What may stay open at the end of a line, closed or up to the end
_LEXEMES = r"""(?s)/\*.*?(?:\*/|\z)|'[^']*+(?:'|\z)|"[^"]*+(?:"|\z)|(?<![\w$])(?i:value)(?:\s+\$?\w+\s*\([^)]*+(?:\)|\z)|(?:\s+\$?\w+)?\s*\z)"""
_PIECES = r"""(?s)/\*.*?(?:\*/|\z)|'[^']*+(?:'|\z)|"[^"]*+(?:"|\z)|[^'"/]++|/"""
# Lines of a block: the first level of the scan
LINES_PER_BLOCK = 1024
_STATEMENT_END = "\u0002"


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the dictionary with their file, split start and position."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("pos"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )


def _last_lexeme(text: Column) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(_LEXEMES), F.lit(0)), F.lit(-1))


def _state_of(last: Column) -> Column:
    """State after a text that begins in text, by its last lexeme: whether that is closed."""

    def closed(by: str, least: int) -> Column:
        return last.endswith(by) & (F.length(last) >= least)

    return (
        F.when(last.isNull(), "T")
        .when(last.startswith("/*"), F.when(closed("*/", 4), "T").otherwise("C"))
        .when(last.startswith("'"), F.when(closed("'", 2), "T").otherwise("S"))
        .when(last.startswith('"'), F.when(closed('"', 2), "T").otherwise("D"))
        .when(last.endswith(")"), "T").when(last.contains("("), "P")
        .otherwise(F.when(last.rlike(r"^\S+\s*$"), "V").otherwise("N"))
    )


def line_map(line: Column) -> Column:
    """The lexer over one line: for each of ``STATES``, in that order, the state at the line's end."""

    def case(text: Column, stays: Column = F.lit(None).cast("string")) -> Column:
        return F.struct(text.alias("text"), stays.alias("stays"))

    def from_open(closing: str, state: str) -> Column:
        at = F.instr(line, closing)
        return case(F.substring(line, at + len(closing), F.length(line)), F.when(at == 0, state))

    cases = F.array(
        case(line), from_open("*/", "C"), from_open("'", "S"), from_open('"', "D"), from_open(")", "P"),
        case(F.concat(F.lit("value "), line)), case(F.concat(F.lit("value n "), line)),
    )
    # bound by a lambda, the last lexeme is searched once
    ends = F.transform(cases, lambda c: F.struct(
        c["stays"].alias("stays"), F.when(c["stays"].isNull(), _last_lexeme(c["text"])).alias("last")))
    return F.array_join(F.transform(ends, lambda e: F.coalesce(e["stays"], _state_of(e["last"]))), "")


def _then(first: Column, second: Column) -> Column:
    """Composition of two maps, or the state that a map leads a state to: each character is looked up."""
    return F.call_function("translate", first, F.lit(STATES), second)


def scanned(df: DataFrame, by: list[str], at: list[str], name: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Prefix scan of the column ``map`` in groups ``by``, ordered by ``at``.

    Returns ``df`` with ``before`` (the maps of what precedes in the group, composed) and one row per group
    with its whole ``map``. With a ``name`` the groups are stored, so that both come from one pass over ``df``.
    """
    width = len(STATES)
    others = [*at, *[c for c in df.columns if c not in (*by, *at)]]
    groups = df.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(*others))).alias("items"))
    scan = F.aggregate(
        "items", F.struct(F.lit(STATES).alias("map"), F.lit("").alias("befores")),
        lambda a, x: F.struct(_then(a["map"], x["map"]).alias("map"), F.concat(a["befores"], a["map"]).alias("befores")),
    )
    groups = groups.withColumn("scan", scan)
    groups = stored(groups, name) if name else groups
    with_before = F.transform("items", lambda x, i: F.struct(
        x.alias("item"), F.substring(F.col("scan.befores"), i * width + 1, F.lit(width)).alias("before")))
    rows = groups.select(*by, F.explode(with_before).alias("x")).select(*by, *[f"x.item.{c}" for c in others], "x.before")
    return rows, groups.select(*by, F.col("scan.map").alias("map"))


def lexed_lines(lines: DataFrame) -> DataFrame:
    """(file, split_start, pos, line) with ``state``: what is open where the line begins."""
    blocks = lines.withColumns({"block": F.expr(f"pos div {LINES_PER_BLOCK}"), "map": line_map(F.col("line"))})
    in_block, per_block = scanned(blocks, ["file", "split_start", "block"], ["pos"], "label-lines")
    in_split, per_split = scanned(per_block, ["file", "split_start"], ["block"])
    in_file, per_file = scanned(per_split, ["file"], ["split_start"])
    open_files = per_file.filter(F.substring("map", 1, 1).isin("C", "S", "D", "P")).count()
    if open_files:
        warnings.warn(f"{open_files} label files end inside a comment, quotes or options", stacklevel=3)
    begins = in_split.withColumnRenamed("before", "in_split").join(
        in_file.select("file", "split_start", F.col("before").alias("in_file")), ["file", "split_start"]
    ).select("file", "split_start", "block", _then(_then(F.lit("T"), F.col("in_file")), F.col("in_split")).alias("begin"))
    return in_block.join(begins, ["file", "split_start", "block"]).select(
        "file", "split_start", "pos", "line", _then(F.col("begin"), F.col("before")).alias("state"))


def _cleaned(line: Column, state: Column) -> Column:
    """The line without comments, with marks where statements end."""
    opener = F.when(state == "C", "/*").when(state == "S", "'").when(state == "D", '"').otherwise("")
    pieces = F.regexp_extract_all(F.concat(opener, line), F.lit(_PIECES), F.lit(0))
    kept = F.transform(pieces, lambda t: F.when(t.startswith("/*"), " ").when(
        t.startswith("'") | t.startswith('"'), t).otherwise(F.replace(t, F.lit(";"), F.lit(_STATEMENT_END))))
    text = F.array_join(kept, "")
    return F.when(state.isin("S", "D"), F.substring(text, F.lit(2), F.length(text))).otherwise(text)


def _carried(rows: DataFrame, value: Column, at: Sequence[str]) -> DataFrame:
    """(file, split_start, carried): the last non-null ``value``, in order of ``at``, of earlier splits.

    One row per input split; the join with it is on the keys that the windows deal the rows by anyway.
    """
    per_split = rows.groupBy("file", "split_start").agg(
        F.max_by(value, F.when(value.isNotNull(), F.struct(*at))).alias("last"))
    earlier = Window.partitionBy("file").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    return per_split.select("file", "split_start", F.last("last", ignorenulls=True).over(earlier).alias("carried"))


def label_records(lines: DataFrame) -> DataFrame:
    """(file, split_start, pos, text): lines without comments, joined where one goes on with an entry or header.

    A line goes on if it begins in quotes or options or with ``=``, or after a line that ends with ``=``, with
    ``value``, or, before ``(``, with the name of a header.
    """
    cleaned = lexed_lines(lines).withColumn("text", _cleaned(F.col("line"), F.col("state"))).drop("line")
    cleaned = cleaned.filter(F.col("text").rlike(r"\S"))
    is_open = F.col("text").rlike(r"(?i)(=|(^|[^\w$])value)\s*\z")
    cleaned = stored(cleaned.withColumn("open", is_open), "label-cleaned")
    order = Window.partitionBy("file", "split_start").orderBy("pos")
    goes_on = (
        F.col("state").isin("S", "D", "P", "V") | F.col("text").rlike(r"^\s*=")
        | ((F.col("state") == "N") & F.col("text").rlike(r"^\s*\("))
        | F.coalesce(F.lag("open").over(order), F.col("carried"), F.lit(False))
    )
    numbered = cleaned.join(_carried(cleaned, F.col("open"), ["pos"]), ["file", "split_start"], "left")
    numbered = numbered.withColumn("goes_on", goes_on).drop("carried", "open")
    begun = F.sum((~F.col("goes_on")).cast("bigint")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    numbered = numbered.withColumn("nth", begun)
    own = F.when(F.col("nth") > 0, F.struct(F.col("split_start").alias("split"), F.col("nth")))
    numbered = stored(numbered.withColumn("record", own), "label-numbered")
    first = F.struct(F.lit(-1).cast("bigint").alias("split"), F.lit(0).cast("bigint").alias("nth"))
    open_record = _carried(numbered, F.col("record"), ["pos"])
    whole = numbered.join(open_record, ["file", "split_start"], "left").withColumn(
        "record", F.coalesce("record", "carried", first))
    parts = F.array_sort(F.collect_list(F.struct("split_start", "pos", "text")))
    joined = whole.groupBy("file", "record").agg(parts.alias("parts"))
    return joined.select(
        "file", F.col("parts")[0]["split_start"].alias("split_start"), F.col("parts")[0]["pos"].alias("pos"),
        F.array_join(F.transform("parts", lambda p: p["text"]), " ").alias("text"),
    )


def parse_label_lines(lines: DataFrame) -> DataFrame:
    """(file, split_start, pos, line) -> (block, code, label, is_valid, place).

    Every entry is kept, valid or not; ``is_valid`` is false for labels that
    mark invalid, collapsed or missing codes. ``place`` orders the entries of
    the dictionary: (file, split_start, pos, statement, place in the statement).
    """
    statements = label_records(lines).select(
        "file", "split_start", "pos", F.posexplode(F.split("text", _STATEMENT_END)).alias("part", "text"))
    body = F.regexp_replace("text", _HEADER + _OPTIONS, "")
    found = F.arrays_zip(*[F.regexp_extract_all(body, F.lit(_ENTRY), F.lit(i + 1)).alias(n) for i, n in enumerate(_ENTRY_PARTS)])
    # a statement counts if it, or what follows its header, begins with an entry; then all its entries count
    is_entry = body.rlike(r"^\s*" + _ENTRY)
    without = F.regexp_replace(F.regexp_replace(body, _ENTRY, " "), rf"{_SINGLE}|{_DOUBLE}", " ")
    unlabelled = F.length(without) - F.length(F.replace(without, F.lit("="), F.lit("")))
    tagged = statements.select(
        "file", "split_start", "pos", "part",
        F.nullif(F.regexp_extract("text", _HEADER, 1), F.lit("")).alias("header"),
        F.when(is_entry, found).alias("entries"),
        (F.when(is_entry, 0).otherwise(F.size(found)) + unlabelled).cast("bigint").alias("passed_over"),
    )
    tagged = stored(tagged.filter("header IS NOT NULL OR entries IS NOT NULL OR passed_over > 0"), "label-statements")
    in_split = Window.partitionBy("file", "split_start").orderBy("pos", "part").rowsBetween(Window.unboundedPreceding, 0)
    carried = _carried(tagged, F.col("header"), ["pos", "part"])
    tagged = tagged.withColumn("local_block", F.last("header", ignorenulls=True).over(in_split))
    tagged = tagged.join(carried, ["file", "split_start"], "left").withColumn("block", F.coalesce("local_block", "carried"))
    passed_over = tagged.filter("block IS NOT NULL").agg(F.sum("passed_over")).first()[0]
    if passed_over:
        warnings.warn(f"{passed_over} label entries are not taken: they have no quoted label, or their statement "
                      "does not begin with an entry", stacklevel=2)
    entries = tagged.filter("entries IS NOT NULL").select(
        "block", "file", "split_start", "pos", "part", F.posexplode("entries").alias("nth", "entry"))

    def text_of(kind: str) -> Column:
        single, double = F.col(f"entry.single_{kind}"), F.col(f"entry.double_{kind}")
        return F.when(single != "", F.replace(single, F.lit("''"), F.lit("'"))).otherwise(F.replace(double, F.lit('""'), F.lit('"')))

    label = F.rtrim(text_of("label"))
    return entries.select(
        "block",
        F.rtrim(F.when(F.col("entry.bare_code") != "", F.col("entry.bare_code")).otherwise(text_of("code"))).alias("code"),
        label.alias("label"),
        (~label.rlike(INVALID_LABEL_PATTERN)).alias("is_valid"),
        F.struct("file", "split_start", "pos", "part", "nth").alias("place"),
    )


def label_dictionary(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """Read and parse a label dictionary file or folder.

    ``split_bytes`` bounds the size of input splits for this read (by
    default the session's setting counts).
    """
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    if split_bytes:
        spark.conf.set(name, str(split_bytes))
    try:
        return parse_label_lines(read_label_lines(spark, path))
    finally:
        spark.conf.set(name, before)


def block_lookup(labels: DataFrame, block: str, value_name: str = "label", valid_only: bool = False) -> DataFrame:
    """(code, label) of one block; of entries that repeat a code the first of the dictionary counts.

    ``valid_only`` leaves out labels that mark a code as not usable.
    """
    rows = labels.filter(F.col("block") == block)
    if valid_only:
        rows = rows.filter("is_valid")
    return rows.groupBy("code").agg(
        F.min_by("label", "place").alias(value_name), F.min_by("is_valid", "place").alias("is_valid")
    )


def block_codes(labels: DataFrame, block: str, max_codes: int = MAX_LITERAL_CODES, valid_only: bool = False) -> dict:
    """{code: label} of a small block, for :func:`arrivals_mart.functions.codes.decode`.

    Codes that are numbers become numbers, so that they match numeric columns (6.0 = 6). The block becomes literals of
    the plan, so one with more than ``max_codes`` codes raises: join its ``block_lookup`` instead.
    """
    rows = block_lookup(labels, block, valid_only=valid_only).orderBy("code").limit(max_codes + 1).collect()
    if len(rows) > max_codes:
        raise ValueError(f"block {block} has more than {max_codes} codes: join its lookup instead")
    numeric = all(re.fullmatch(r"[+-]?\d{1,18}", r["code"]) for r in rows)
    return {int(r["code"]) if numeric else r["code"]: r["label"] for r in rows}


def country_lookup(labels: DataFrame, block: str = COUNTRY_BLOCK, valid_only: bool = False) -> DataFrame:
    """Country code lookup: (code, country)."""
    return block_lookup(labels, block, "country", valid_only).select("code", "country")


def port_lookup(
    labels: DataFrame, block: str = PORT_BLOCK, state_block: str = STATE_BLOCK, valid_only: bool = False
) -> DataFrame:
    """Port lookup: (code, city, state).

    The label is split at its last comma. The state is the first two letters
    after it when they are followed by the end, a blank, ``#`` or ``(`` and
    are a code of the state block; in a label without a comma, the last word
    if it is such a code. Otherwise the whole label is the city and the state
    is null. Both sides come from the same dictionary, whose size
    is only known after parsing, so the join strategy is left to AQE's
    run-time statistics rather than counting the state block first.
    """
    ports = block_lookup(labels, block, valid_only=valid_only)
    states = labels.filter(F.col("block") == state_block).select(F.col("code").alias("state_code")).distinct()
    comma = F.col("label").contains(",")
    plain = r"^([^,]*\S)\s+([A-Za-z]{2})$"
    candidate = F.when(comma, F.regexp_extract("label", r",\s*([A-Za-z]{2})(?:$|[\s#(])[^,]*$", 1)).otherwise(
        F.regexp_extract("label", plain, 2)
    )
    head = F.when(comma, F.regexp_extract("label", r"^(.*),[^,]*$", 1)).otherwise(F.regexp_extract("label", plain, 1))
    ports = ports.withColumn("cand", F.upper(candidate)).withColumn("head", F.rtrim(head))
    joined = ports.join(states, ports["cand"] == states["state_code"], "left")
    has_state = F.col("state_code").isNotNull()
    return joined.select(
        "code",
        F.when(has_state, F.col("head")).otherwise(F.col("label")).alias("city"),
        F.when(has_state, F.col("state_code")).alias("state"),
    )


def write_lookups(
    spark: SparkSession,
    label_path: str,
    staging: str,
    ports_rel: str = "port_mapping",
    countries_rel: str = "country_mapping",
    port_block: str = PORT_BLOCK,
    country_block: str = COUNTRY_BLOCK,
    state_block: str = STATE_BLOCK,
    valid_only: bool = False,
) -> None:
    """Extract the port and country lookups from a label dictionary into CSV files.

    Writes ``code,city,state`` and ``code,country`` (with header) below
    ``staging``, the inputs the fact and traveller builds read.
    """
    labels = label_dictionary(spark, label_path)
    port_lookup(labels, port_block, state_block, valid_only).write.mode("overwrite").option("header", "true").csv(
        os.path.join(staging, ports_rel)
    )
    country_lookup(labels, country_block, valid_only).write.mode("overwrite").option("header", "true").csv(
        os.path.join(staging, countries_rel)
    )
