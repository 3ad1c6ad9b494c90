import datetime as dt

from arrivals_mart.operators.joins import spread_incomplete_keys
from arrivals_mart.plans.listening import build_artists, build_songplays, build_songs, build_time, build_users
from arrivals_mart.schemas import STAGING_EVENTS, STAGING_SONGS


def event(session, ts, user, page="NextSong", song="Song A", artist="Band", length=200.5, level="free"):
    return (artist, "Logged In", "Ann", "F", 0, "Lee", length, level, "Town", "PUT", page, None,
            session, song, 200, ts, "agent", user)


EVENTS = [
    event(1, 1541105830796, 10),  # 2018-11-01 20:57:10.796
    event(2, 1541106106796, 10, song="Unknown"),  # no song match: kept with null ids
    event(None, 1541106496796, 11, level="paid"),  # null session -> null hash key
    event(3, 1541106673796, 12, page="Home"),  # not a play
]
SONGS = [
    (1, "AR1", "Band", None, None, "Somewhere", "SO1", "Song A", 200.5, 2001),
    (1, "AR1", "Band", None, None, "Somewhere", "SO2", "Song A", 300.0, 2002),
]


def test_songplays_filter_join_and_hash(spark):
    ev = spark.createDataFrame(EVENTS, STAGING_EVENTS)
    songs = spark.createDataFrame(SONGS, STAGING_SONGS)
    plays = {r.sessionid: r for r in build_songplays(ev, songs).collect()}
    assert set(plays) == {1, 2, None}
    first = plays[1]
    assert first.start_time == dt.datetime(2018, 11, 1, 20, 57, 10)  # milliseconds dropped
    assert first.song_id == "SO1" and first.artist_id == "AR1"
    import hashlib

    assert first.songplay_id == hashlib.md5(b"12018-11-01 20:57:10").hexdigest()
    assert plays[2].song_id is None
    assert plays[None].songplay_id is None


def test_users_songs_artists_time(spark):
    ev = spark.createDataFrame(EVENTS, STAGING_EVENTS)
    songs = spark.createDataFrame(SONGS, STAGING_SONGS)
    users = sorted(tuple(r) for r in build_users(ev).collect())
    assert users == [(10, "Ann", "Lee", "F", "free"), (11, "Ann", "Lee", "F", "paid")]
    assert build_songs(songs).count() == 2
    assert build_artists(songs).count() == 1
    t = build_time(build_songplays(ev, songs))
    assert t.count() == 3  # one row per play, no de-duplication
    r = t.filter("hour = 20").orderBy("start_time").first()
    assert (r.day, r.week, r.month, r.year, r.weekday) == (1, 44, 11, 2018, 4)


def test_songplays_spreads_null_keys_without_changing_results(spark):
    many = [event(i, 1541105830796 + i * 1000, 10 + i % 3, song=None) for i in range(200)]
    ev = spark.createDataFrame(EVENTS + many, STAGING_EVENTS)
    songs = spark.createDataFrame(SONGS, STAGING_SONGS)
    out = build_songplays(ev, songs)
    assert out.count() == 203
    assert out.filter("song_id is not null").count() == 2  # sessions 1 and null match SO1
    spread = spread_incomplete_keys(
        ev.filter("page = 'NextSong'"), ["song", "artist", "length"], "song", ["sessionid", "ts", "userid"]
    )
    assert spread.select("_spread_song").distinct().count() > 100  # null-key rows no longer share one key
    plan = out._jdf.queryExecution().executedPlan().toString()
    join_line = next(line for line in plan.splitlines() if "Join" in line and "song" in line)
    assert "_spread_song" in join_line  # the scattered key is a shuffle key, not folded away
