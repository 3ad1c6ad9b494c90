"""Listening-log star (B5-B9): songplays, users, songs, artists, time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.functions.codes import hash_key
from arrivals_mart.functions.dates import date_parts, from_epoch_ms
from arrivals_mart.operators.joins import (
    complete_condition,
    drop_unmatched_hot_replicas,
    salt_condition,
    salt_hot_right_keys,
    spread_incomplete_keys,
    spread_key,
)

# Fixed value: the page of a song play.
PLAY_PAGE = "NextSong"

# A song stored in this many copies is joined over SALTS tasks instead of one.
HOT_SONG_COPIES = 10_000
SALTS = 32


def plays(events: DataFrame) -> DataFrame:
    return events.filter(F.col("page") == PLAY_PAGE)


def build_songplays(
    events: DataFrame, songs: DataFrame, hot_threshold: int = HOT_SONG_COPIES, salts: int = SALTS
) -> DataFrame:
    """Song plays matched to songs on (title, artist name, duration); unmatched plays kept.

    ``songplay_id`` is md5 of the session id and the start time text
    (``yyyy-MM-dd HH:mm:ss``); it is null when the session id is null.
    Plays with an incomplete key are spread over partitions instead of
    meeting in one task, and songs stored in ``hot_threshold`` or more
    copies are split over ``salts`` tasks (see :mod:`arrivals_mart.operators.joins`);
    hot plays (many plays of one song) are split by AQE.
    """
    e = plays(events).withColumn("start_time", from_epoch_ms(F.col("ts")))
    # plays without a full (song, artist, length) key cannot match; spread them out
    e = spread_incomplete_keys(e, ["song", "artist", "length"], "song", ["sessionid", "ts", "userid"])
    e, s = salt_hot_right_keys(
        e, songs, [spread_key("song"), "artist", "length"], ["title", "artist_name", "duration"], hot_threshold, salts
    )
    e, s = e.alias("e"), s.alias("s")
    cond = (
        (F.col(f"e.{spread_key('song')}") == F.col("s.title"))
        & (F.col("e.artist") == F.col("s.artist_name"))
        & (F.col("e.length") == F.col("s.duration"))
        & salt_condition("e", "s")
        & complete_condition("e")
    )
    joined = drop_unmatched_hot_replicas(e.join(s, cond, "left"), "e", "s")
    return joined.select(
        hash_key(F.col("e.sessionid"), F.col("e.start_time")).alias("songplay_id"),
        F.col("e.start_time").alias("start_time"),
        F.col("e.userid").alias("userid"),
        F.col("e.level").alias("level"),
        F.col("s.song_id").alias("song_id"),
        F.col("s.artist_id").alias("artist_id"),
        F.col("e.sessionid").alias("sessionid"),
        F.col("e.location").alias("location"),
        F.col("e.useragent").alias("useragent"),
    )


def build_users(events: DataFrame) -> DataFrame:
    return plays(events).select("userid", "firstname", "lastname", "gender", "level").distinct()


def build_songs(songs: DataFrame) -> DataFrame:
    return songs.select("song_id", "title", "artist_id", "year", "duration").distinct()


def build_artists(songs: DataFrame) -> DataFrame:
    return songs.select(
        "artist_id", "artist_name", "artist_location", "artist_latitude", "artist_longitude"
    ).distinct()


def build_time(songplays: DataFrame) -> DataFrame:
    """One row per song play (no de-duplication) with the six time parts."""
    parts = date_parts(F.col("start_time"))
    return songplays.select("start_time", *[c.alias(n) for n, c in parts.items()])
