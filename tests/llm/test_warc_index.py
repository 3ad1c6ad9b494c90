import base64
import gzip
import hashlib
import random

from pyspark.sql import types as T

from arrivals_mart.llm import warc_index as W

SCHEMA = "page_id bigint, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows):
    last = {}
    for i, _, html in rows:
        last[html or ""] = max([x for x in (last.get(html or ""), i) if x is not None], default=None)
    out = []
    for i, _, html in rows:
        data, to = (html or "").encode(), last[html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if to == i else "revisit", None if to == i else to))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://www.Example.org:80/a?b=1#frag", "<p>same</p>"), (2, "https://m.example.org/a", "<p>same</p>"),
    (3, "http://example.org", "<p>é 𝄞</p>"), (4, None, None), (5, "", ""), (6, "not a url at all \r\n with breaks", "x"),
    (7, "http://example.org/long", "y" * 300_000), (8, "http://example.org/long", "<p>same</p>"), (None, "http://a.b/", "<p>same</p>"),
    (None, "http://a.b/", "only without id"), (9, "http://user:pw@h.example.org:8080/é?q#f", "Content-Length: 5\r\n\r\nWARC/1.1"),
    (9, "http://again.example.org/", "another page of the same id"), (3, "http://example.org", "<p>é 𝄞</p>"),
]


def test_pages_come_back_through_the_index(spark, tmp_path):
    got = W.archive_and_read(pages(spark, ROWS), f"file://{tmp_path}")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(ROWS)


def test_many_pages_blocks_and_files(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    rows = [(i, f"http://h{rng.randint(0, 5)}.example.org/{rng.randint(0, 40)}", f"<p>{rng.randint(0, 150)}</p>") for i in range(600)]
    folder = f"file://{tmp_path}"
    df = pages(spark, rows).repartition(5)
    captures = W.write_archives(df, folder)
    files = W.write_index(captures.repartition(3), folder, block_lines=7)
    got = W.read_captures(df, files, folder)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
    assert [f[:2] for f in files] == sorted(f[:2] for f in files)


def test_archives_are_readable_member_by_member_and_as_a_whole(spark, tmp_path):
    captures = W.write_archives(pages(spark, ROWS), f"file://{tmp_path}").collect()
    for r in captures:
        with open(r.file, "rb") as f:
            f.seek(r.offset)
            data = gzip.decompress(f.read(r.length))
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
        assert W.parse(data)[0] == r.page_id
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in tmp_path.glob("*.warc.gz"))
    assert whole.count(b"WARC-Type: ") == len(ROWS) and whole.count(b"WARC-Type: revisit") == 4


def test_near_records_share_a_range_of_bounded_size(monkeypatch):
    monkeypatch.setattr(W, "RANGE_BYTES", 100)
    monkeypatch.setattr(W, "GAP_BYTES", 10)
    runs = lambda *rows: list(W.joined_ranges(*map(list, zip(*rows))))
    assert runs(("a", 0, 30), ("a", 30, 30), ("a", 65, 30)) == [(0, 3)]
    assert runs(("a", 0, 30), ("a", 41, 10), ("b", 51, 10)) == [(0, 1), (1, 2), (2, 3)]
    assert runs(("a", 0, 60), ("a", 60, 60), ("a", 120, 500), ("a", 620, 5)) == [(0, 1), (1, 2), (2, 3), (3, 4)]
    assert list(W.joined_ranges([], [], [])) == []
    rng = random.Random(1)
    rows = [("ab"[i // 150], 20 * i, rng.randint(1, 20)) for i in range(300)]
    got = runs(*rows)
    assert all(rows[hi - 1][1] + rows[hi - 1][2] - rows[lo][1] <= 100 and len({r[0] for r in rows[lo:hi]}) == 1 for lo, hi in got)
    assert [i for lo, hi in got for i in range(lo, hi)] == list(range(300)) and len(got) < 250


def test_small_ranges_give_the_same_pages(spark, tmp_path, monkeypatch):
    folder = f"file://{tmp_path}"
    files = W.write_index(W.write_archives(pages(spark, ROWS), folder), folder)
    whole = sorted((tuple(r) for r in W.read_captures(pages(spark, ROWS), files, folder).collect()), key=repr)
    monkeypatch.setattr(W, "RANGE_BYTES", 1)
    assert sorted((tuple(r) for r in W.read_captures(pages(spark, ROWS), files, folder).collect()), key=repr) == whole == brute(ROWS)


def test_url_keys_sort_by_host():
    assert W.url_key("http://www.Example.org:80/a?b=1#frag") == "org,example,www)/a?b=1"
    assert W.url_key("https://example.org:8443") == "org,example:8443)/"
    assert W.url_key("http://example.org?x") == "org,example)?x"
    assert W.url_key(None) == "" and W.url_key("") == ""
    assert "\n" not in W.url_key("a b\nc\td")


def test_a_key_is_searched_in_one_block_of_the_directory(tmp_path):
    fs, root = W.filesystem(f"file://{tmp_path}")
    lines = [(f"k{i // 3:03d}".encode(), i) for i in range(50)]
    at, directory, data = 0, b"", b""
    for lo in range(0, 50, 4):
        block = gzip.compress(b"".join(b"%s\t%d\tf\t%d\t1\n" % (k, n, n) for k, n in lines[lo:lo + 4]))
        directory += b"%s\t%d\t%d\t%d\n" % (*lines[lo], at, len(block))
        data += block
        at += len(block)
    (tmp_path / "i.gz").write_bytes(data)
    (tmp_path / "i.dir").write_bytes(directory)
    index = W.IndexFile(fs, f"{root}/i")
    for key in lines:
        assert list(index.find(key)) == [("f", key[1], 1)]
    assert list(index.find((b"k000", 77))) == [] and list(index.find((b"a", 0))) == [] and list(index.find((b"z", 0))) == []


def test_empty_table_and_extra_columns(spark, tmp_path):
    none = spark.createDataFrame([], T.StructType.fromDDL(SCHEMA))
    assert W.archive_and_read(none, f"file://{tmp_path}/a").count() == 0
    from pyspark.sql import functions as F

    df = pages(spark, ROWS).withColumns({c: F.lit("own") for c in ("sha", "key", "file", "last_id", "refers_to")})
    assert sorted((tuple(r) for r in W.archive_and_read(df, f"file://{tmp_path}/b").collect()), key=repr) == brute(ROWS)
