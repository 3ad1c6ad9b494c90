"""Registered queries: one per operator of the inventory, each run over the
whole driver tables of a scale-factor folder (``queries()``), with the
reference SQL in :mod:`arrivals_mart.plans.oracle`.

Queries that exercise a sink or a file format write their input to a fresh
folder below the session's checkpoint folder and read it back.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_mart.functions.casts import int_key, tolerant_date, tolerant_double, tolerant_int, tolerant_long
from arrivals_mart.functions.codes import TRANSPORT_MODES, TRAVEL_PURPOSES, decode, hash_key
from arrivals_mart.functions.dates import epoch_ms, from_day_number, from_epoch_ms, to_day_number
from arrivals_mart.operators.keymap import extend_key_map, with_stable_key
from arrivals_mart.operators.lookups import lookup_join
from arrivals_mart.operators.publish import publish, read_published, remove_old_versions
from arrivals_mart.operators.quality import duplicate_keys, run_checks
from arrivals_mart.operators.sinks import create_targets, overwrite, overwrite_partitions, truncate_and_load
from arrivals_mart.plans import analytics, listening, marts
from arrivals_mart.plans.derived import SONG_COPIES, Inputs
from arrivals_mart.plans.oracle import QUALITY_TABLES
from arrivals_mart.plans.pipeline import StagingLayout, run_concurrently, run_pipeline
from arrivals_mart.schemas import DEMOGRAPHICS_USED, FACT_IMMIGRATION, TARGETS, enforce, schema_differences
from arrivals_mart.session import scratch_path, stored
from arrivals_mart.sources.files import read_csv, read_parquet, read_table, register
from arrivals_mart.sources.labels import block_codes, country_lookup, label_dictionary, port_lookup
from arrivals_mart.sources.reconcile import read_deliveries
from arrivals_mart.streaming.incremental import incremental_fact_load

Query = Callable[[SparkSession, str], DataFrame]


def _round4(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 4) for c in cols})


# ------------------------------------------------------------------ sources
def q_scan_parquet(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_totalprice", T.DoubleType()),
        ]
    )
    register(read_parquet(spark, os.path.join(sf, "orders.parquet"), schema), "stg_orders")
    return spark.sql("SELECT o_orderkey, o_custkey, o_totalprice FROM stg_orders WHERE o_totalprice > 0")


def q_scan_csv_header(spark: SparkSession, sf: str) -> DataFrame:
    """Columns are found by header name: the file has them in another order, in upper case, with extra ones."""
    path = scratch_path(spark, "supplier-csv")
    wanted = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
    sup = read_table(spark, sf, "supplier").select(*wanted).withColumn("remark", F.lit("a, b"))
    stored_order = ["s_acctbal", "remark", "s_name", "s_suppkey", "s_nationkey"]
    sup.select(*[F.col(c).alias(c.upper()) for c in stored_order]).write.option("header", "true").csv(path)
    raw = read_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in wanted]))
    return raw.select(
        tolerant_long("s_suppkey").alias("s_suppkey"),
        F.col("s_name"),
        tolerant_int("s_nationkey").alias("s_nationkey"),
        tolerant_double("s_acctbal").alias("s_acctbal"),
    )


def q_scan_csv_semicolon(spark: SparkSession, sf: str) -> DataFrame:
    """The reader of the whole run, over a file with columns moved, one added and an unused one missing."""
    path = scratch_path(spark, "demographics-csv")
    raw = Inputs(spark, sf).demographics()
    moved = [F.col(f"`{c}`") for c in reversed(raw.columns) if c != "Count"]
    raw.select(F.lit("2015").alias("Survey Year"), *moved).write.option("header", "true").option("sep", ";").csv(path)
    return marts.typed_demographics(read_csv(spark, path, DEMOGRAPHICS_USED, sep=";"))


# Label files are read in splits of this size, so that a block spans several.
LABEL_SPLIT_BYTES = 32 * 1024
LABEL_BLOCK_ENTRIES = 5000


def write_label_text(spark: SparkSession, sf: str, path: str) -> None:
    """Write a label dictionary (``value`` blocks of code = 'label' entries, CRLF) from the tables.

    Customers form numeric-code blocks and suppliers quoted-code port blocks
    with 'CITY, ST' labels (ST = the supplier's region), of LABEL_BLOCK_ENTRIES
    entries each, every block headed by its own ``value`` line in changing
    letter case, some over three lines; regions form the state-code block and one of numbers. Some
    lines hold two entries, some labels are 5,000 characters long, and some entries come with what spans lines: a label on
    the next line, a label over two lines, a comment over four with an entry in it; others have double
    quotes or a label that looks like a comment. A block is written by one task into one file, many blocks by many tasks.
    """
    cust = read_table(spark, sf, "customer")
    nation = read_table(spark, sf, "nation")
    region = read_table(spark, sf, "region")
    q = F.lit("'")

    def esc(c):
        return F.regexp_replace(c, "'", "''")

    k = F.col("c_custkey")
    label = (
        F.when(k % 500 == 7, F.rpad("c_name", 5000, "x"))
        .when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("No Country Code ("), k.cast("string"), F.lit(")")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.col("c_name"), F.lit(" O'NEIL")))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.col("c_name"), F.lit("   ")))
        .otherwise(F.col("c_name"))
    )
    code = F.concat(F.lit("   "), k.cast("string"), F.lit(" = "))
    plain = F.concat(code, F.lit(" "), q, esc(label), q)
    old = F.lit("/* codes before 1990:\r\n value stray\r\n 9 = 'old'\r\n*/")
    form = k % 50
    entry = (
        F.when(form == 11, F.concat(code, q, F.col("c_name"), F.lit(" /* keep */ B'")))
        .when(form == 13, F.concat(code, F.lit('"'), F.col("c_name"), F.lit(' ""x"" it\'s"')))
        .when(form == 17, F.concat(code, F.lit("\r\n"), q, esc(label), q))
        .when(form == 19, F.concat(old, plain))
        .when(form == 23, F.concat(code, q, F.col("c_name"), F.lit("\r\nTAIL'")))
        .otherwise(plain)
    )
    # an entry whose code ends in 1 stands on the line of the one before it
    line = F.when(k % 10 == 1, k - 1).otherwise(k).alias("seq")
    two = F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), entry.alias("t")))), lambda e: e["t"])
    cust_lines = cust.groupBy(F.floor(k / LABEL_BLOCK_ENTRIES).alias("chunk"), line).agg(F.concat_ws(" ", two).alias("text"))

    st = F.upper(F.substring("r_name", 1, 2))
    supplier = read_table(spark, sf, "supplier")
    # nation and region have a fixed size (25 and 5 rows)
    geo = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    sr = supplier.join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey"))
    s_key = F.col("s_suppkey")
    town = F.when(s_key % 5 == 0, F.concat(F.col("s_name"), F.lit(" O'HARE"))).otherwise(F.col("s_name"))
    port_label = (
        F.when(s_key % 9 == 0, F.concat(F.lit("No PORT Code (S"), s_key.cast("string"), F.lit(")")))
        .when(F.col("n_regionkey") == 4, F.concat(town, F.lit(", MX")))
        .when(s_key % 4 == 1, F.concat(town, F.lit(", "), st, F.lit(" (BPS)")))
        .when(s_key % 4 == 2, F.concat(town, F.lit(", "), st, F.lit(" #ARPT")))
        .when(s_key % 8 == 3, F.concat(town, F.lit(" "), st))
        .when(s_key % 8 == 7, town)
        .otherwise(F.concat(town, F.lit(", "), st))
    )
    port_lines = sr.select(
        (-F.floor(s_key / LABEL_BLOCK_ENTRIES) - 2).alias("chunk"), s_key.cast("bigint").alias("seq"),
        F.concat(F.lit("   'S"), s_key.cast("string"), F.lit("'\t=\t'"), esc(port_label), F.lit("   '")).alias("text"),
    )
    state_lines = region.filter(F.col("r_regionkey") != 4).select(
        F.lit(-1).cast("bigint").alias("chunk"), F.col("r_regionkey").cast("bigint").alias("seq"),
        F.concat(F.lit("\t'"), st, F.lit("'='"), F.col("r_name"), F.lit("'")).alias("text"),
    )
    number_lines = region.select(
        F.lit(1 << 40).alias("chunk"), F.col("r_regionkey").cast("bigint").alias("seq"),
        F.concat(F.lit("\t"), F.col("r_regionkey").cast("string"), F.lit(" = '"), F.col("r_name"), F.lit("'")).alias("text"),
    )

    def heads(lines: DataFrame, text) -> DataFrame:
        return lines.select("chunk").distinct().select("chunk", F.explode(F.array(
            F.struct(F.lit(-2).cast("bigint").alias("seq"), F.lit("/* codes - valid and invalid, such as 1 = 'one' */").alias("text")),
            F.struct(F.lit(-1).cast("bigint").alias("seq"), text.alias("text")),
        )).alias("h")).select("chunk", "h.seq", "h.text")

    lines = cust_lines.unionByName(heads(cust_lines, F.when(
        F.col("chunk") % 2 == 0, "  value\r\n custl (min=1\r\n  max=40)").otherwise("  VALUE custl")))
    lines = lines.unionByName(port_lines).unionByName(heads(port_lines, F.lit("  Value $portl")))
    lines = lines.unionByName(state_lines).unionByName(heads(state_lines, F.lit("value stcodes")))
    lines = lines.unionByName(number_lines).unionByName(heads(number_lines, F.lit("value numl")))
    # all lines of a block go to one partition, in order
    (
        lines.repartition("chunk")
        .sortWithinPartitions("chunk", "seq")
        .select(F.concat(F.col("text"), F.lit("\r")).alias("value"))
        .write.text(path)
    )


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "labels")
    write_label_text(spark, sf, path)
    return label_dictionary(spark, path, split_bytes=LABEL_SPLIT_BYTES)


def q_label_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return _labels(spark, sf).select("block", "code", "label", "is_valid")


def q_label_port_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return port_lookup(_labels(spark, sf), block="$portl", state_block="stcodes", valid_only=True)


def q_decode_dictionary_codes(spark: SparkSession, sf: str) -> DataFrame:
    """The codes and labels of a small block become literals of the plan."""
    codes = block_codes(_labels(spark, sf), "numl")
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", decode(F.col("l_linenumber").cast("double"), codes).alias("label"))


def q_label_country_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return country_lookup(_labels(spark, sf), block="custl", valid_only=True)


# ------------------------------------------------------------------ sinks
def q_sink_parquet_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "customer-sink")
    cust = read_table(spark, sf, "customer")
    overwrite(cust.withColumn("c_acctbal", F.col("c_acctbal") + 1), path)
    overwrite(cust, path)
    return spark.read.parquet(path)


def q_truncate_and_load(spark: SparkSession, sf: str) -> DataFrame:
    inp = Inputs(spark, sf)
    staged = scratch_path(spark, "fact-staged")
    target = scratch_path(spark, "fact-target")
    overwrite(enforce(marts.build_fact(inp.arrivals(), inp.ports()), FACT_IMMIGRATION, "fact_immigration"), staged)
    truncate_and_load(spark, staged, target, FACT_IMMIGRATION, "fact_immigration")
    # a second run must replace, not append
    return truncate_and_load(spark, staged, target, FACT_IMMIGRATION, "fact_immigration")


def q_load_catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same load into a table that the catalog holds, made for the contract."""
    inp = Inputs(spark, sf)
    staged = scratch_path(spark, "fact-staged")
    overwrite(enforce(marts.build_fact(inp.arrivals(), inp.ports()), FACT_IMMIGRATION, "fact_immigration"), staged)
    name = f"load_{uuid.uuid4().hex[:12]}"
    create_targets(spark, scratch_path(spark, "catalog"), targets={name: FACT_IMMIGRATION})
    for _ in range(2):
        loaded = truncate_and_load(spark, staged, name, FACT_IMMIGRATION, "fact_immigration")
    return loaded


# Arrivals before this year make the first delivery.
LATE_FROM = 1998


def _fact_deliveries(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    fact = _fact(spark, sf)
    early = F.coalesce(F.col("imm_year") < LATE_FROM, F.lit(False))
    return fact.filter(early), fact.filter(~early)


MONTHS = ["imm_year", "imm_month"]


def q_dynamic_partition_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """All months are written, the late ones wrongly; a second run delivers only those and replaces them."""
    path = scratch_path(spark, "fact-months")
    early, late = _fact_deliveries(spark, sf)
    overwrite_partitions(early.unionByName(late.withColumn("airline", F.lit("wrong"))), path, MONTHS)
    overwrite_partitions(late, path, MONTHS)
    return spark.read.schema(FACT_IMMIGRATION).parquet(path).select(*FACT_IMMIGRATION.names)


def _failing_load(df: DataFrame, target: str) -> None:
    """A load that ends between writing and publishing."""

    def fail():
        raise InterruptedError("lost before publication")

    try:
        publish(df, target, FACT_IMMIGRATION, "fact_immigration", MONTHS, before_publishing=fail)
    except InterruptedError:
        return
    raise AssertionError("the load was published")


def q_publication_after_failure(spark: SparkSession, sf: str) -> DataFrame:
    """The early months are published; a load of the late ones fails before it publishes: the old rows are read."""
    target = scratch_path(spark, "fact-published")
    early, late = _fact_deliveries(spark, sf)
    publish(early, target, FACT_IMMIGRATION, "fact_immigration", MONTHS, key="immigration_id")
    _failing_load(late, target)
    return read_published(spark, target)


def q_published_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries that are published one after the other, a failed load between them, and old versions removed."""
    target = scratch_path(spark, "fact-published")
    early, late = _fact_deliveries(spark, sf)
    publish(early, target, FACT_IMMIGRATION, "fact_immigration", MONTHS, key="immigration_id")
    wrong = late.withColumn("airline", F.lit("wrong"))
    _failing_load(wrong, target)
    publish(wrong, target, FACT_IMMIGRATION, "fact_immigration", MONTHS, key="immigration_id", keep_others=True)
    publish(late, target, FACT_IMMIGRATION, "fact_immigration", MONTHS, key="immigration_id", keep_others=True)
    remove_old_versions(spark, target, keep=1, min_age_s=0)
    return read_published(spark, target)


def q_stable_keys_two_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Every second row is delivered first; the second delivery has all, and the first ids stay."""
    path = scratch_path(spark, "demographics-keys")
    rows = _demo_rows(spark, sf)
    keys = ["city", "state_code", "race"]
    extend_key_map(rows.filter("male_population % 2 = 0"), keys, path, "demo_key")
    return with_stable_key(rows, keys, path, "demo_key").select(*keys, "demo_key", "male_population")


def q_reconciled_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Arrivals in three deliveries: integral keys and no post; as declared with a column more; text and int codes."""
    root = scratch_path(spark, "deliveries")
    arrivals = Inputs(spark, sf).arrivals()
    year = F.col("i94yr")
    shaped = {
        "old": arrivals.filter(year < 1994).withColumn("cicid", F.col("cicid").cast("bigint")).drop("visapost"),
        "middle": arrivals.filter((year >= 1994) & (year < 1997)).withColumn("matflag", F.lit("M")),
        "new": arrivals.filter(year >= 1997).withColumns(
            {"i94mon": F.col("i94mon").cast("int").cast("string"), "i94visa": F.col("i94visa").cast("int")}
        ).withColumnRenamed("i94port", "I94PORT"),
    }
    for name, df in shaped.items():
        df.write.parquet(os.path.join(root, name))
    rows, _ = read_deliveries(spark, {name: os.path.join(root, name) for name in shaped},
                              ["cicid", "i94yr", "i94mon", "i94port", "i94visa", "visapost", "matflag"])
    return rows


LINE_CONTRACT = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType(), False),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_shipdate", T.DateType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
    ]
)


def q_schema_contract(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "line-contract")
    li = read_table(spark, sf, "lineitem")
    # columns out of order, one in upper case, one extra: the contract fixes all three
    shuffled = li.withColumnRenamed("l_shipdate", "L_SHIPDATE").select(
        "l_returnflag", "L_SHIPDATE", "l_tax", "l_extendedprice", "l_linenumber", "l_orderkey"
    )
    overwrite(enforce(shuffled, LINE_CONTRACT, "lines"), path)
    back = spark.read.parquet(path)
    diffs = schema_differences(back.schema, LINE_CONTRACT)
    if diffs:
        raise ValueError(f"written schema differs from contract: {diffs}")
    return back


# ------------------------------------------------------------------ scalar functions
def q_key_cast(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    k = F.col("o_orderkey").cast("double")
    large = F.lit(2**53) + F.col("o_orderkey")  # neighbours that a double cannot tell apart
    return o.select(
        int_key(k).alias("order_id"), int_key(k + 0.7).alias("shifted_id"), int_key(large).alias("large_id"),
        int_key(large.cast("string")).alias("large_text_id"), "o_custkey",
    )


def q_tolerant_casts(spark: SparkSession, sf: str) -> DataFrame:
    p = read_table(spark, sf, "part")
    size = F.col("p_size").cast("string")
    date_text = F.concat(
        F.lit("2001-"),
        F.when(F.col("p_size") % 5 == 0, "13").otherwise("01"),
        F.lit("-"),
        F.lpad((F.col("p_size") % 28 + 1).cast("string"), 2, "0"),
    )
    return p.select(
        "p_partkey",
        tolerant_int("p_name").alias("name_int"),
        tolerant_int(F.col("p_retailprice").cast("string")).alias("price_int"),
        tolerant_double(F.col("p_retailprice").cast("string")).alias("price_double"),
        tolerant_int(F.concat(size, F.lit(".0"))).alias("size_int"),
        tolerant_int(F.concat(F.lit("  "), size, F.lit(" "))).alias("padded_int"),
        tolerant_int(F.concat(size, F.lit("D"))).alias("suffix_int"),
        tolerant_int(F.concat(size, F.lit("e3"))).alias("exponent_int"),
        tolerant_int(F.concat(F.lit(" +"), size, F.lit(".9"))).alias("signed_int"),
        tolerant_double("p_type").alias("type_double"),
        tolerant_date(date_text).alias("ship_date"),
    )


def q_decode_codes(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    return li.select(
        "l_orderkey",
        "l_linenumber",
        decode("l_linenumber", TRANSPORT_MODES).alias("transport_mode"),
        decode("l_quantity", TRAVEL_PURPOSES).alias("travel_purpose"),
    )


def q_lookup_coalesce(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    # max_rows=None: nation and region have a fixed size, broadcast without a counting job
    withn = lookup_join(c, read_table(spark, sf, "nation"), [F.col("c_nationkey")], ["n_nationkey"], max_rows=None)
    withr = lookup_join(withn, read_table(spark, sf, "region"), [F.col("n_regionkey")], ["r_regionkey"], max_rows=None)
    return withr.select(
        "c_custkey",
        F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), F.col("r_name")).alias("segment_or_region"),
    )


def q_case_insensitive_join(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer")
    code = F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"))
    # max_rows=None: nation has a fixed size, broadcast without a counting job
    j = lookup_join(c, read_table(spark, sf, "nation"), [code], ["n_name"], case_insensitive=True, max_rows=None)
    return j.select("c_custkey", "n_name", "n_nationkey")


def q_role_playing_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Line items per (customer nation, supplier nation): one lookup in two roles.

    Orders first get their customer's nation; line items are joined to that
    (the only line-item-sized shuffle, on the order key) and immediately
    pre-aggregated per (supplier, customer nation), so the supplier join and
    the nation decoding run on at most suppliers x nations rows.
    """
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    s = read_table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    order_nation = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    per_supplier = (
        li.join(order_nation, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey", "c_nationkey")
        .agg(F.count(F.lit(1)).alias("line_count"))
    )
    pairs = (
        per_supplier.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("c_nationkey", "s_nationkey")
        .agg(F.sum("line_count").alias("line_count"))
    )
    nation = read_table(spark, sf, "nation").select("n_nationkey", "n_name")
    cn = lookup_join(pairs, nation, [F.col("c_nationkey")], ["n_nationkey"], max_rows=None, alias="cn")
    both = lookup_join(cn, nation, [F.col("s_nationkey")], ["n_nationkey"], max_rows=None, alias="sn")
    return both.groupBy(
        F.col("cn.n_name").alias("customer_nation"), F.col("sn.n_name").alias("supplier_nation")
    ).agg(F.sum("line_count").alias("line_count"))


def q_day_number_dates(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders")
    day = to_day_number("o_orderdate")
    return o.select("o_orderkey", day.alias("day_number"), from_day_number(day.cast("double")).alias("order_date"))


def q_hash_key(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    return e.select("event_id", hash_key("user_id", "event_type").alias("user_event_hash"))


def q_epoch_to_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    return e.select("event_id", from_epoch_ms(epoch_ms("ts")).alias("start_time"))


# ------------------------------------------------------------------ listening log
def _songplays(spark: SparkSession, sf: str) -> DataFrame:
    """Songs in SONG_COPIES copies count as hot here, so that salting runs."""
    inp = Inputs(spark, sf)
    return listening.build_songplays(inp.events(), inp.songs(), hot_threshold=SONG_COPIES, salts=8)


def q_songplays(spark: SparkSession, sf: str) -> DataFrame:
    return _songplays(spark, sf)


def q_time_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """From the written song plays, not from their join once more."""
    return listening.build_time(stored(_songplays(spark, sf), "songplays"))


def q_distinct_users(spark: SparkSession, sf: str) -> DataFrame:
    return listening.build_users(Inputs(spark, sf).events())


def q_distinct_songs(spark: SparkSession, sf: str) -> DataFrame:
    return listening.build_songs(Inputs(spark, sf).songs())


def q_distinct_artists(spark: SparkSession, sf: str) -> DataFrame:
    return listening.build_artists(Inputs(spark, sf).songs())


# ------------------------------------------------------------------ marts
def _fact(spark: SparkSession, sf: str) -> DataFrame:
    inp = Inputs(spark, sf)
    return marts.build_fact(inp.arrivals(), inp.ports())


def _person(spark: SparkSession, sf: str) -> DataFrame:
    inp = Inputs(spark, sf)
    return marts.build_person_dim(inp.arrivals(), inp.countries())


def _temp_dim(spark: SparkSession, sf: str) -> DataFrame:
    return marts.build_temperature_dim(Inputs(spark, sf).temperatures())


def _demo_dim(spark: SparkSession, sf: str) -> DataFrame:
    return marts.build_demographics_dim(Inputs(spark, sf).demographics())


# The analyses read only attribute columns of the dimensions, never their
# surrogate keys, so they take the dimension rows before keying: the same
# rows without the numbering pass.
def _temp_rows(spark: SparkSession, sf: str) -> DataFrame:
    return marts.monthly_temperatures(Inputs(spark, sf).temperatures())


def _demo_rows(spark: SparkSession, sf: str) -> DataFrame:
    return marts.typed_demographics(Inputs(spark, sf).demographics())


def q_fact_build(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf)


def q_dim_person_build(spark: SparkSession, sf: str) -> DataFrame:
    return _person(spark, sf)


def q_star_join(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.star_join(_fact(spark, sf), _person(spark, sf))


def q_monthly_average_build(spark: SparkSession, sf: str) -> DataFrame:
    return marts.monthly_temperatures(Inputs(spark, sf).temperatures())


def q_surrogate_key_two_level(spark: SparkSession, sf: str) -> DataFrame:
    return _temp_dim(spark, sf)


def q_surrogate_key_three_level(spark: SparkSession, sf: str) -> DataFrame:
    return _demo_dim(spark, sf)


def q_trailing_average(spark: SparkSession, sf: str) -> DataFrame:
    t = analytics.trailing_temperatures(_temp_rows(spark, sf))
    return _round4(t, "avg_temp", "trailing_avg_temp")


def q_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.top_cities(_demo_rows(spark, sf), 10)


def q_dedup_group(spark: SparkSession, sf: str) -> DataFrame:
    return _demo_rows(spark, sf).select("city", "state_code", "total_population").distinct()


def q_top_city_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.top_city_arrivals(_fact(spark, sf), _demo_rows(spark, sf), 10)


def q_top_city_share(spark: SparkSession, sf: str) -> DataFrame:
    return analytics.top_city_share(_fact(spark, sf), _demo_rows(spark, sf), 10)


def q_trailing_temperature_vs_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    out = analytics.trailing_temperature_vs_arrivals(_fact(spark, sf), _temp_rows(spark, sf))
    return _round4(out, "trailing_avg_temp")


def q_trailing_temperature_as_of(spark: SparkSession, sf: str) -> DataFrame:
    out = analytics.trailing_temperature_vs_arrivals(_fact(spark, sf), _temp_rows(spark, sf), as_of=True)
    return _round4(out, "trailing_avg_temp")


def stage_inputs(
    spark: SparkSession, sf: str, staging: str, layout: StagingLayout = StagingLayout(), no_key: Column | None = None
) -> None:
    """Write the derived raw inputs in their source formats (parquet and CSV), side by side.

    Arrival records where ``no_key`` holds lose their key.
    """
    inp = Inputs(spark, sf)
    arrivals = inp.arrivals()
    if no_key is not None:
        arrivals = arrivals.withColumn("cicid", F.when(~no_key, F.col("cicid")))

    def csv(df, rel, sep=","):
        return lambda: df.write.option("header", "true").option("sep", sep).csv(os.path.join(staging, rel))

    run_concurrently(
        {
            "arrivals": lambda: arrivals.write.parquet(os.path.join(staging, layout.arrivals)),
            "ports": csv(inp.ports(), layout.ports),
            "countries": csv(inp.countries(), layout.countries),
            "temperature": csv(inp.temperatures(), layout.temperature),
            "demographics": csv(inp.demographics(), layout.demographics, ";"),
        }
    )


def q_pipeline_run(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "pipeline")
    staging, production = os.path.join(root, "staging"), os.path.join(root, "production")
    stage_inputs(spark, sf, staging)
    report = run_pipeline(spark, staging, production)
    contents = [
        content(spark.read.parquet(os.path.join(production, name)), schema, name) for name, schema in TARGETS.items()
    ]
    held = reduce(DataFrame.unionByName, contents)
    return report.join(F.broadcast(held), "table_name")  # one row per table


def content(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """What a table holds, as one row: the sums of both halves of the MD5s of its rows' texts, as exact numbers.

    Any row that is changed, missing or repeated changes the sums.
    """
    texts = [
        F.coalesce((F.round(F.col(f.name) * 1000).cast("bigint") if isinstance(f.dataType, T.DoubleType) else F.col(f.name))
                   .cast("string"), F.lit("~"))
        for f in schema.fields
    ]
    rows = df.select(F.md5(F.concat_ws("|", *texts)).alias("m"))
    halves = {"rows_high": F.substring("m", 1, 16), "rows_low": F.substring("m", 17, 16)}
    return rows.agg(*[
        F.coalesce(F.sum(F.conv(half, 16, 10).cast("decimal(20,0)")), F.lit(0)).cast("string").alias(n) for n, half in halves.items()
    ]).withColumn("table_name", F.lit(name))


def q_pipeline_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Arrival records without a key: the run ends with all of them counted. Uniqueness is not asked for."""
    root = scratch_path(spark, "pipeline-nulls")
    staging, production = os.path.join(root, "staging"), os.path.join(root, "production")
    stage_inputs(spark, sf, staging, no_key=F.col("cicid") % 97 == 0)
    return run_pipeline(spark, staging, production, check=False, unique=False)


def q_incremental_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Arrival files land in two deliveries, a file that is no parquet beside them; each run loads only the files
    new to it. Records without a key are loaded and counted."""
    root = scratch_path(spark, "incremental")
    arrivals_dir, target, ckpt = (os.path.join(root, d) for d in ("arrivals", "fact", "checkpoint"))
    inp = Inputs(spark, sf)
    arrivals = inp.arrivals().withColumn("cicid", F.when(F.col("cicid") % 97 != 0, F.col("cicid")))
    early = F.coalesce(F.col("i94yr") < LATE_FROM, F.lit(False))
    arrivals.filter(early).write.parquet(arrivals_dir)
    inp.ports().select("code").write.text(os.path.join(arrivals_dir, "notes"))
    report: list[dict] = []
    incremental_fact_load(spark, arrivals_dir, inp.ports(), target, ckpt, max_files_per_batch=4, report=report)
    arrivals.filter(~early).write.mode("append").parquet(arrivals_dir)
    incremental_fact_load(spark, arrivals_dir, inp.ports(), target, ckpt, max_files_per_batch=4, report=report)
    loaded = spark.read.parquet(target).drop("load_batch")
    return loaded.withColumn("null_keys_counted", F.lit(sum(r["null_keys"] for r in report)).cast("bigint"))


def q_warm_month_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """The fact lies partitioned by month; only the months that the temperatures select are read."""
    path = scratch_path(spark, "fact-months")
    overwrite_partitions(_fact(spark, sf), path, MONTHS)
    fact = spark.read.schema(FACT_IMMIGRATION).parquet(path)
    return analytics.arrivals_in_warm_months(fact, stored(_temp_rows(spark, sf), "temperatures"), 28.0)


# ------------------------------------------------------------------ quality
def q_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    tables = {t: (read_table(spark, sf, t), k) for t, k in QUALITY_TABLES.items()}
    return run_checks(tables)


def q_quality_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(read_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Some orders come twice, one kind of them three times: only their keys are shuffled."""
    o = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    again = o.filter(F.col("o_orderkey") % 97 == 0)
    return duplicate_keys(o.unionByName(again).unionByName(again.filter(F.col("o_custkey") % 5 == 0)), ["o_orderkey", "o_custkey"])


QUERIES: dict[str, Query] = {
    "scan_parquet": q_scan_parquet,
    "scan_csv_header": q_scan_csv_header,
    "scan_csv_semicolon": q_scan_csv_semicolon,
    "label_dictionary": q_label_dictionary,
    "label_port_lookup": q_label_port_lookup,
    "label_country_lookup": q_label_country_lookup,
    "sink_parquet_overwrite": q_sink_parquet_overwrite,
    "truncate_and_load": q_truncate_and_load,
    "load_catalog_table": q_load_catalog_table,
    "schema_contract": q_schema_contract,
    "key_cast": q_key_cast,
    "tolerant_casts": q_tolerant_casts,
    "decode_codes": q_decode_codes,
    "lookup_coalesce": q_lookup_coalesce,
    "case_insensitive_join": q_case_insensitive_join,
    "role_playing_lookup": q_role_playing_lookup,
    "day_number_dates": q_day_number_dates,
    "hash_key": q_hash_key,
    "epoch_to_timestamp": q_epoch_to_timestamp,
    "time_dimension": q_time_dimension,
    "fact_build": q_fact_build,
    "dim_person_build": q_dim_person_build,
    "star_join": q_star_join,
    "monthly_average_build": q_monthly_average_build,
    "surrogate_key_two_level": q_surrogate_key_two_level,
    "surrogate_key_three_level": q_surrogate_key_three_level,
    "trailing_average": q_trailing_average,
    "top_k": q_top_k,
    "dedup_group": q_dedup_group,
    "top_city_arrivals": q_top_city_arrivals,
    "top_city_share": q_top_city_share,
    "trailing_temperature_vs_arrivals": q_trailing_temperature_vs_arrivals,
    "trailing_temperature_as_of": q_trailing_temperature_as_of,
    "songplays": q_songplays,
    "distinct_users": q_distinct_users,
    "distinct_songs": q_distinct_songs,
    "distinct_artists": q_distinct_artists,
    "pipeline_run": q_pipeline_run,
    "pipeline_null_keys": q_pipeline_null_keys,
    "incremental_fact": q_incremental_fact,
    "quality_report": q_quality_report,
    "quality_duplicates": q_quality_duplicates,
    "decode_dictionary_codes": q_decode_dictionary_codes,
    "dynamic_partition_overwrite": q_dynamic_partition_overwrite,
    "publication_after_failure": q_publication_after_failure,
    "published_deliveries": q_published_deliveries,
    "repeated_keys": q_repeated_keys,
    "reconciled_deliveries": q_reconciled_deliveries,
    "stable_keys_two_deliveries": q_stable_keys_two_deliveries,
    "warm_month_arrivals": q_warm_month_arrivals,
}
