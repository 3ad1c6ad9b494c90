"""WARC archives with a two-level capture index.

Writing: pages with equal payloads are grouped by the SHA-256 of the payload; of each group the
largest page id is archived whole (response), the others as revisit records that refer
to it. Each task writes one archive file, a gzip member per record, under a name of its own
attempt, so a repeated task never overwrites what an earlier one reported.

Index: captures are sorted by reversed-host URL key and page id into range partitions. Each
partition becomes one index file of compressed blocks with a sparse directory beside it
(the first key of each block, and where the block lies). The table of index files, one
row per range partition, is all that is ever broadcast.

Reading: a capture is looked up by its key. Binary search in the table of files and in the file's
directory gives one block; that block is read by its range and searched. What is found is dealt
by archive. Records that lie close together in an archive are read at once, in ranges of a bounded
size, and parsed one by one.

Null html is the empty payload; a null url has the empty key; of pages with a null id, one that shares
its payload with a numbered page revisits that, any other is a response. Rows that tie on the
largest id are all responses. Repeated rows give one record each. Control characters and
blanks in urls are percent-encoded. Pages of any length are written and read whole.
Columns but page_id, url and html are not read, whatever their names. An empty table writes nothing and reads nothing.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.llm._common import written
from arrivals_mart.session import scratch_path

BLOCK_LINES = 512
LEVEL = 3
#: Archives carry this date, since pages have no time of capture.
CAPTURE_DATE = "2000-01-01T00:00:00Z"
#: Equal payloads of at least so many bytes become revisits.
REVISIT_BYTES = 0
#: Records are read together in ranges of at most so many bytes, over gaps of at most so many; a longer record is read alone.
RANGE_BYTES, GAP_BYTES = 8 << 20, 64 << 10
_NO_ID = -(1 << 63)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_URL = re.compile(r"^(?:([a-z][a-z0-9+.-]*):)?(?://)?(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^#]*)", re.I)


def clean_url(url: str | None) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url or "")


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.example.org:80/a?b#c`` gives ``org,example,www)/a?b``."""
    m = _URL.match(clean_url(url))
    if not url or not m:
        return ""
    host, port, rest = m[2].lower(), m[3], m[4] or "/"
    port = "" if port in (None, "", "80", "443") else f":{port}"
    return ",".join(reversed(host.split("."))) + port + ")" + (rest if rest.startswith(("/", "?")) else "/" + rest)


def payload_digest(payload: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    number = record_id[len("<urn:page:"):-1]
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response with the payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {CAPTURE_DATE}", f"WARC-Target-URI: {clean_url(url)}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {_record_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n")[1:])}


def parse(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """(page id, payload bytes, digest, type, refers to) of a record; a response's payload is measured anew."""
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _fields(head)
    block = rest[:int(warc["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    if warc["warc-type"] == "revisit":
        size, digest = int(_fields(http)["content-length"]), warc["warc-payload-digest"].removeprefix("sha1:")
        return _page_of(warc["warc-record-id"]), size, digest, "revisit", _page_of(warc["warc-refers-to"])
    return _page_of(warc["warc-record-id"]), len(payload), payload_digest(payload), "response", None


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system and path behind a folder's URI, for the tasks' own byte ranges."""
    uri = re.sub(r"^s3[an]:", "s3:", uri)
    return pyarrow.fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else re.sub(r"^file:", "file://", uri))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write the archives below ``folder``; return one row per record: key, page_id, file, offset, length."""
    page = pages.select(
        F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").alias("url"),
        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"),
    ).withColumn("sha", F.sha2("html", 256))
    last = written(page.groupBy("sha").agg(F.max("page_id").alias("last_id")), "warc-last")
    page = page.join(last, "sha").withColumn(
        "refers_to",
        F.when((F.octet_length("html") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("last_id")), F.col("last_id")),
    )

    def run(batches):
        stream = path = None
        try:
            for b in batches:
                if stream is None:
                    fs, root = filesystem(folder)
                    path = f"{root}/archive-{uuid.uuid4().hex}.warc.gz"
                    fs.create_dir(root, recursive=True)
                    stream, at = fs.open_output_stream(path, compression=None), 0
                keys, offsets, lengths = [], [], []
                ids, urls = b.column("page_id").to_pylist(), b.column("url").to_pylist()
                refers = b.column("refers_to").to_pylist()
                for i, url, html, r in zip(ids, urls, b.column("html").cast(pa.binary()).to_pylist(), refers):
                    member = gzip.compress(record(i, url, html, r), LEVEL, mtime=0)
                    stream.write(member)
                    keys.append(url_key(url))
                    offsets.append(at)
                    lengths.append(len(member))
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), b.column("page_id"), pa.array([path] * len(keys), pa.string()),
                     pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["key", "page_id", "file", "offset", "length"],
                )
        finally:
            if stream is not None:
                stream.close()

    rows = page.select("page_id", "url", "html", "refers_to").mapInArrow(
        run, "key string, page_id bigint, file string, offset bigint, length bigint"
    )
    return written(rows, "warc-captures")


def _number(page_id: int | None) -> int:
    return _NO_ID if page_id is None else page_id


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> list[tuple[bytes, int, str]]:
    """Write index files below ``folder``; return (first key, first id, file) of each, in order.

    One row per range partition comes back, so their number is the cluster's, not the data's.
    """

    def run(batches):
        lines: list[bytes] = []
        first = None
        directory: list[bytes] = []
        stream, at = None, 0

        def flush():
            nonlocal at
            block = gzip.compress(b"".join(x[1] for x in lines), LEVEL, mtime=0)
            stream.write(block)
            directory.append(b"%s\t%d\t%d\t%d\n" % (lines[0][0][0], lines[0][0][1], at, len(block)))
            at += len(block)
            lines.clear()

        for b in batches:
            for key, page_id, file, offset, length in zip(
                b.column("key").cast(pa.binary()).to_pylist(), b.column("page_id").to_pylist(),
                b.column("file").cast(pa.binary()).to_pylist(), b.column("offset").to_pylist(), b.column("length").to_pylist(),
            ):
                number = _number(page_id)
                if stream is None:
                    fs, root = filesystem(folder)
                    path = f"{root}/index-{uuid.uuid4().hex}"
                    fs.create_dir(root, recursive=True)
                    stream, first = fs.open_output_stream(path + ".gz", compression=None), (key, number)
                lines.append(((key, number), b"%s\t%d\t%s\t%d\t%d\n" % (key, number, file, offset, length)))
                if len(lines) == block_lines:
                    flush()
        if stream is None:
            return
        if lines:
            flush()
        stream.close()
        with fs.open_output_stream(path + ".dir", compression=None) as out:
            out.write(b"".join(directory))
        yield pa.RecordBatch.from_pydict({
            "key": pa.array([first[0]], pa.binary()), "number": pa.array([first[1]], pa.int64()),
            "path": pa.array([path], pa.string()),
        })

    order = [F.col("key").asc_nulls_first(), F.col("page_id").asc_nulls_first()]
    files = captures.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, "key binary, number bigint, path string"
    )
    rows = written(files, "warc-index").collect()
    return sorted((bytes(r["key"]), r["number"], r["path"]) for r in rows)


class IndexFile:
    """One index file behind its sparse directory."""

    def __init__(self, fs: pyarrow.fs.FileSystem, path: str):
        with fs.open_input_stream(path + ".dir", compression=None) as f:
            rows = [x.split(b"\t") for x in f.read().splitlines()]
        self.firsts = [(r[0], int(r[1])) for r in rows]
        self.ranges = [(int(r[2]), int(r[3])) for r in rows]
        self._file = fs.open_input_file(path + ".gz")
        self._at, self._keys, self._rows = -1, [], []

    def _block(self, i: int) -> None:
        if i != self._at:
            offset, length = self.ranges[i]
            rows = [x.split(b"\t") for x in gzip.decompress(self._file.read_at(length, offset)).splitlines()]
            self._at, self._keys, self._rows = i, [(r[0], int(r[1])) for r in rows], rows

    def find(self, key: tuple[bytes, int]) -> Iterator[tuple[str, int, int]]:
        """(archive, offset, length) of every capture under ``key``."""
        i = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while i < len(self.firsts) and self.firsts[i] <= key:
            self._block(i)
            for j in range(bisect.bisect_left(self._keys, key), len(self._keys)):
                if self._keys[j] != key:
                    break
                r = self._rows[j]
                yield r[2].decode(), int(r[3]), int(r[4])
            i += 1

    def close(self) -> None:
        self._file.close()


def joined_ranges(files: list[str], offsets: list[int], lengths: list[int]) -> Iterator[tuple[int, int]]:
    """(from, to) of each run of records, sorted by file and offset, that one range covers."""
    lo = 0
    for hi in range(1, len(files) + 1):
        if (
            hi == len(files) or files[hi] != files[lo] or offsets[hi] + lengths[hi] - offsets[lo] > RANGE_BYTES
            or offsets[hi] - offsets[hi - 1] - lengths[hi - 1] > GAP_BYTES
        ):
            yield lo, hi
            lo = hi


def read_captures(wanted: DataFrame, files: list[tuple[bytes, int, str]], folder: str, id_col: str = "page_id",
                  url_col: str = "url") -> DataFrame:
    """Look up the captures of (id, url) rows and read them: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    starts, paths = [f[:2] for f in files], [f[2] for f in files]

    def keyed(batches):
        for b in batches:
            ids = b.column("page_id").to_pylist()
            keys = [url_key(u) for u in b.column("url").to_pylist()]
            at = [(k.encode(), _number(i)) for k, i in zip(keys, ids)]
            # captures under one key may begin in the file before the one that starts with it
            lo = [max(0, bisect.bisect_left(starts, a) - 1) for a in at]
            hi = [max(x, bisect.bisect_right(starts, a) - 1) for x, a in zip(lo, at)]
            rows = [(n, k, a[1]) for x, y, k, a in zip(lo, hi, keys, at) for n in range(x, y + 1)]
            yield pa.RecordBatch.from_pydict({
                "file_no": pa.array([r[0] for r in rows], pa.int32()), "key": pa.array([r[1] for r in rows], pa.string()),
                "number": pa.array([r[2] for r in rows], pa.int64()),
            })

    def locate(batches):
        fs, _ = filesystem(folder)
        index, file_no = None, None
        for b in batches:
            out = []
            for n, key, number in zip(b.column("file_no").to_pylist(), b.column("key").cast(pa.binary()).to_pylist(),
                                      b.column("number").to_pylist()):
                if n != file_no:
                    if index is not None:
                        index.close()
                    index, file_no = IndexFile(fs, paths[n]), n
                out += index.find((key, number))
            if out:
                kinds = [pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["file", "offset", "length"])

    def read(batches):
        fs, _ = filesystem(folder)
        stream, file = None, None
        for b in batches:
            out = []
            names, offsets, lengths = (b.column(c).to_pylist() for c in ("file", "offset", "length"))
            for lo, hi in joined_ranges(names, offsets, lengths):
                if names[lo] != file:
                    if stream is not None:
                        stream.close()
                    stream, file = fs.open_input_file(names[lo]), names[lo]
                start = offsets[lo]
                data = memoryview(stream.read_at(offsets[hi - 1] + lengths[hi - 1] - start, start))
                out += [parse(zlib.decompress(data[o - start:o - start + n], 31)) for o, n in zip(offsets[lo:hi], lengths[lo:hi])]
            if out:
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    keys = wanted.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").alias("url")).mapInArrow(
        keyed, "file_no int, key string, number bigint"
    )
    out = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    if not files:
        return wanted.sparkSession.createDataFrame([], out)
    order = ["file_no", "key", "number"]
    located = keys.dropDuplicates(order).repartition("file_no").sortWithinPartitions(*order).mapInArrow(
        locate, "file string, offset bigint, length bigint"
    )
    # rows are small but each stands for a record to read: a stated number of tasks is not merged by their size
    tasks = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return located.repartition(tasks, "file").sortWithinPartitions("file", "offset").mapInArrow(read, out)


def archive_and_read(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                     html_col: str = "html") -> DataFrame:
    """Write archives and index for ``pages`` and read every capture back through the index."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    files = write_index(write_archives(pages, folder, id_col, url_col, html_col), folder)
    return read_captures(pages, files, folder, id_col, url_col)
