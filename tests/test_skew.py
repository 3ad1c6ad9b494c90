"""Skew: a third of the plays share one song, another share no key at all."""

from pyspark.sql import functions as F

from arrivals_mart.plans.listening import build_songplays

from .test_labels import conf

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _events(spark, n):
    i = F.col("id")
    hot, missing = i % 3 == 0, i % 3 == 1
    return spark.range(n).select(
        F.concat(F.lit("Band "), (i % 7).cast("string")).alias("artist"), F.lit("Logged In").alias("auth"),
        F.lit("A").alias("firstname"), F.lit("F").alias("gender"), F.lit(0).cast("bigint").alias("iteminsession"),
        F.lit("L").alias("lastname"),
        F.when(hot, F.lit(1.0)).when(missing, F.lit(None)).otherwise((i % 500).cast("double")).alias("length"),
        F.lit("free").alias("level"), F.lit("x").alias("location"), F.lit("PUT").alias("method"),
        F.lit("NextSong").alias("page"), F.lit(None).cast("double").alias("registration"), i.alias("sessionid"),
        F.when(hot, F.lit("hot")).when(missing, F.lit(None)).otherwise(F.concat(F.lit("s"), (i % 500).cast("string"))).alias("song"),
        F.lit(200).cast("bigint").alias("status"), (i * 1000).alias("ts"), F.lit("ua").alias("useragent"),
        (i % 50).alias("userid"),
    ).withColumn("artist", F.when(F.col("song") == "hot", F.lit("Band 0")).otherwise(F.col("artist")))


def _songs(spark):
    i = F.col("id")
    return spark.range(500).select(
        F.lit(1).cast("bigint").alias("num_songs"), F.lit("AR").alias("artist_id"),
        F.when(i == 0, F.lit("Band 0")).otherwise(F.concat(F.lit("Band "), (i % 7).cast("string"))).alias("artist_name"),
        F.lit(None).cast("double").alias("artist_latitude"), F.lit(None).cast("double").alias("artist_longitude"),
        F.lit("here").alias("artist_location"), F.concat(F.lit("SO"), i.cast("string")).alias("song_id"),
        F.when(i == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), i.cast("string"))).alias("title"),
        F.when(i == 0, F.lit(1.0)).otherwise(i.cast("double")).alias("duration"),
        F.lit(2000).cast("bigint").alias("year"),
    )


def test_hot_song_is_split_and_missing_keys_are_scattered(spark):
    with conf(spark, **SKEW_CONF):
        out = build_songplays(_events(spark, 30000), _songs(spark))
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 30000
    assert sum(1 for r in rows if r.song_id == "SO0") == 10000  # every hot play matched
    assert "SortMergeJoin(skew=true)" in plan  # AQE split the hot key's partition
    join_line = next(line for line in plan.splitlines() if "SortMergeJoin" in line)
    assert "_spread_song" in join_line and "_keys_complete" in join_line


def test_many_copies_of_one_song_are_salted_exactly(spark):
    ev = _events(spark, 3000)
    base = _songs(spark)
    copies = base.filter("title = 'hot'").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(39))))
    copies = copies.withColumn("song_id", F.concat(F.col("song_id"), F.lit("-"), F.col("copy").cast("string")))
    songs = base.filter("title <> 'hot'").unionByName(copies.drop("copy"))
    plain = build_songplays(ev, songs, hot_threshold=10**9, salts=1)
    salted = build_songplays(ev, songs, hot_threshold=10, salts=8)
    cols = ["songplay_id", "song_id", "sessionid"]
    assert sorted(map(tuple, salted.select(cols).collect()), key=repr) == sorted(
        map(tuple, plain.select(cols).collect()), key=repr
    )
    assert salted.filter("song_id like 'SO0-%'").count() == 1000 * 40  # every hot play meets all 40 copies
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in next(line for line in plan.splitlines() if "Join" in line and "title" in line)


def test_null_keys_of_a_large_lookup_are_scattered(spark):
    """Above the broadcast bound, arrivals without a country or port code do not meet in one task."""
    from arrivals_mart.plans.marts import build_fact, build_person_dim

    from .fixtures import frames

    f = frames(spark)
    for build, lookup in ((build_fact, "ports"), (build_person_dim, "countries")):
        small = build(f["arrivals"], f[lookup])
        large = build(f["arrivals"], f[lookup], max_lookup_rows=1)
        rows = [sorted(map(str, df.collect())) for df in (small, large)]
        assert rows[0] == rows[1]
        plan = large._jdf.queryExecution().optimizedPlan().toString()
        assert "no-key" in plan and "xxhash64" in plan
        assert "no-key" not in small._jdf.queryExecution().optimizedPlan().toString()


def test_hot_keys_are_looked_for_once_and_no_salting_runs_without_any(spark):
    from arrivals_mart.operators.joins import HOT, SALT, salt_hot_right_keys

    left = spark.createDataFrame([("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3)], "t string, v int")
    for threshold, salts in ((3, {0}), (2, {0, 1, 2, 3})):
        lefts, rights = salt_hot_right_keys(left, right, ["k"], ["t"], threshold, 4)
        assert {r[SALT] for r in lefts.collect()} == salts
        assert sum(r[HOT] for r in lefts.collect()) == (0 if threshold == 3 else 4)
        plan = rights._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" not in plan  # the list was counted and stored before
        assert ("Join" in plan) == (threshold == 2)


def test_dense_keys_come_from_stored_columns(spark):
    from arrivals_mart.operators.keys import dense_key

    df = spark.range(100).selectExpr("id % 7 AS a", "id AS b")
    keyed = dense_key(df, ["a", "b"], "n")
    assert "parquet" in keyed._jdf.queryExecution().optimizedPlan().toString()
    assert "ExistingRDD" not in keyed._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.n for r in keyed.collect()) == list(range(1, 101))
