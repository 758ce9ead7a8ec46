"""WARC archives: write, read back, and merge the captures into one ordered history.

* **Write.** Every task streams its rows into gzip archives in the shared folder,
  a member per record. Of rows with equal payloads of ``SHORTEST`` bytes or more,
  those of least key are ``response`` records; the others are ``revisit`` records
  that name the response and carry no payload. Digests find the copies first, so
  only digests are grouped; payloads move only if the copies are many.
* **Read.** A task per archive parses the members, checks each length and digest
  against its header and yields a capture per record.
* **Merge.** The captures of an archive, sorted by URL key and time, are a run (a
  Parquet file of small row groups). A loser tree merges up to ``FAN_IN`` runs
  while it holds a batch of each. If there are more, bundles of ``FAN_IN`` are
  first merged into longer runs, a bundle a task. The last merge is cut into key
  ranges of about ``RANGE_ROWS`` rows by fence keys of the runs; a task reads
  from each run the row groups of its range. Sort keys are unique, so the
  captures of one URL may span ranges.

Files have names of their own for each attempt of a task. Only those of the
attempt that Spark committed are listed, so retries and lost executors leave
unlisted files behind but never a record twice. The driver sees at most
``FAN_IN`` paths.
"""

from __future__ import annotations

import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterable, Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.ordering import dense_index, prefix_sum
from tessera.llm.common import arrow_map, sized, slices, staged
from tessera.session import ensure_checkpoint_dir

#: Shorter payloads are stored again each time.
SHORTEST = 100
#: Bytes after which a task starts a new archive.
ARCHIVE_BYTES = 1 << 30
FAN_IN, RANGE_ROWS, FENCE = 256, 1 << 17, 64
LEVEL = 3
ROW_GROUP = 1 << 18
# Names and identifiers of the WARC 1.1 format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY = hashlib.sha256(b"").hexdigest()

CAPTURE = ("url_key string, captured string, page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
           "refers_to bigint, archive string, offset bigint, length bigint")
RUN = "sort_key string, " + CAPTURE
NAMES = [c.split()[0] for c in RUN.split(", ")]


# Files of the shared folder, from within tasks

def shared_folder(df: DataFrame) -> str:
    """The shared checkpoint folder as a full URI, as Spark resolves it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.sparkSession.sparkContext.getCheckpointDir().rstrip("/")


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + urllib.parse.unquote(uri[5:]).lstrip("/")
    return (pafs.LocalFileSystem(), uri) if uri.startswith("/") else pafs.FileSystem.from_uri(uri)


# Records

def url_key(url: str) -> str:
    """Sort key of a URL: host names from the top domain down, then path and query, in lower case.

    Scheme, user, port, a leading ``www`` and the fragment do not count. White
    space and control characters are percent-encoded.
    """
    url = encoded(url)
    scheme, sep, rest = url.partition("://")
    if not sep or not scheme.isascii() or not scheme.replace("+", "a").replace("-", "a").replace(".", "a").isalnum():
        return url.partition("#")[0].lower()
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host = rest[:cut].rpartition("@")[2].partition(":")[0].lower()
    tail = rest[cut:].partition("#")[0]
    labels = host.split(".")
    if len(labels) > 2 and labels[0] == "www":
        labels = labels[1:]
    return f"{','.join(reversed(labels))}){tail if tail.startswith('/') else '/' + tail}".lower()


def encoded(url: str) -> str:
    """A URL without white space and control characters, which would end a header."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)


def identifier(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def identified(uri: str) -> int | None:
    name = uri.rpartition(":")[2].rstrip(">")
    return None if name == "none" else int(name)


def record(page: int | None, url: str | None, seconds: int, digest: str, payload: bytes, original: int | None, revisit: bool) -> bytes:
    """One WARC record: the HTTP response with its payload, or only its header for a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {identifier(page)}",
            f"WARC-Date: {datetime.fromtimestamp(seconds, timezone.utc):%Y-%m-%dT%H:%M:%SZ}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {encoded(url)}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        head += [f"WARC-Refers-To: {identifier(original)}", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def members(stream, chunk: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """``(offset, length, content)`` of each gzip member of a file."""
    start, at, data = 0, 0, stream.read(chunk)
    while data:
        inflate, parts = zlib.decompressobj(wbits=31), []
        while not inflate.eof:
            if not data:
                raise ValueError(f"archive ends within the member at {start}")
            at += len(data)
            parts.append(inflate.decompress(data))
            data = inflate.unused_data if inflate.eof else stream.read(chunk)
        at -= len(data)
        yield start, at - start, b"".join(parts)
        start, data = at, data or stream.read(chunk)


def _headers(lines: bytes) -> dict[str, str]:
    return dict((k.lower(), v.strip()) for k, _, v in (x.partition(":") for x in lines.decode().split("\r\n")[1:]))


def parse(content: bytes) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """``(WARC headers, HTTP headers, payload)`` of the records in a member."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        head = _headers(content[at:end])
        stop = end + 4 + int(head["content-length"])
        if content[stop:stop + 4] != b"\r\n\r\n" or not content.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at {at} of a member")
        body = content.index(b"\r\n\r\n", end + 4) + 4
        yield head, _headers(content[end + 4:body - 4]), content[body:stop]
        at = stop + 4


# Write and read

def decide(df: DataFrame, key: str, payload: str, shortest: int = SHORTEST) -> DataFrame:
    """``df`` with ``__digest``, ``__original`` and ``__revisit``: whether a row repeats an earlier payload."""
    text = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = df.withColumns({"__digest": F.sha2(text, 256), "__long": F.octet_length(text) >= shortest})
    copies = (rows.where("__long").groupBy("__digest").agg(F.count("*").alias("__n"), F.min(key).alias("__original"))
              .where("__n > 1").select("__digest", "__original"))
    copies = sized(staged(copies, "warc-copies").withColumn("__found", F.lit(True)))
    joined = rows.join(copies, "__digest", "left")
    return joined.withColumn("__revisit", F.coalesce(F.col("__found") & ~F.col(key).eqNullSafe(F.col("__original")), F.lit(False)))


def write(df: DataFrame, key: str, url: str, payload: str, seconds: Column, shortest: int = SHORTEST) -> DataFrame:
    """Write a record per row and return the archives as ``(archive, records, bytes)``.

    ``seconds`` is the capture time since 1970. Of rows with equal payloads of
    ``shortest`` bytes or more, all rows of the least key are responses (null is
    the greatest key), so a repeated row of it is stored again. A null payload
    is empty, a null URL is left out of the record, control characters of a URL
    are percent-encoded. Very long payloads are held one at a time. An empty
    table gives no archive. Other columns of the table are ignored.
    """
    rows = decide(df.select(F.col(key).cast("long").alias("page"), F.col(url).alias("url"), F.col(payload).alias("html"), seconds.cast("long").alias("seconds")),
                  "page", "html", shortest)
    folder = f"{shared_folder(df)}/warc-{uuid.uuid4().hex}"

    def run(batches):
        fs, path = file_system(folder)
        fs.create_dir(path)
        out, name, n, size = None, "", 0, 0
        for b in (part for whole in batches for part in slices([whole], "html")):
            c = {k: b.column(k) for k in b.schema.names}
            for i in range(b.num_rows):
                if out is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                html = c["html"][i].as_buffer()
                got = zlib.compress(record(c["page"][i].as_py(), c["url"][i].as_py(), c["seconds"][i].as_py(), c["__digest"][i].as_py(),
                                           b"" if html is None else html.to_pybytes(), c["__original"][i].as_py(), c["__revisit"][i].as_py()), LEVEL, wbits=31)
                out.write(got)
                n, size = n + 1, size + len(got)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [n], "bytes": [size]})
                    out = None
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "records": [n], "bytes": [size]})

    rows = rows.select("page", "url", "html", "seconds", "__digest", "__original", "__revisit")
    return staged(arrow_map(rows, run, "archive string, records bigint, bytes bigint"), "warc-archives")


def one_each(df: DataFrame) -> DataFrame:
    """A partition per row, for tables that list work: dealt from one partition, each row lands in its own."""
    return df.coalesce(1).repartition(max(1, df.count()))


def read(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """A row per record, with the payload as text where ``payloads`` is set.

    Raises ``ValueError`` where a record is cut off, its length or its payload's
    digest differs from its header, or an archive holds another number of
    records than was written.
    """

    def captures(name: str, expected: int) -> Iterator[tuple]:
        fs, path = file_system(name)
        seen = 0
        with fs.open_input_stream(path, compression=None) as stream:
            for offset, length, content in members(stream):
                for head, http, body in parse(content):
                    seen += 1
                    kind, digest = head["warc-type"], head["warc-payload-digest"].partition(":")[2]
                    size = int(http["content-length"])
                    if kind == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
                        raise ValueError(f"{name}: payload at {offset} differs from its header")
                    when = head["warc-date"].translate({ord(c): None for c in "-:TZ"})
                    back = identified(head["warc-refers-to"]) if kind == "revisit" else None
                    row = (url_key(head.get("warc-target-uri", "")), when, identified(head["warc-record-id"]), size, digest, kind, back, name, offset, length)
                    yield row + (body.decode(),) if payloads else row
        if seen != expected:
            raise ValueError(f"{name}: {seen} records, {expected} were written")

    schema = CAPTURE + (", payload string" if payloads else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        for b in batches:
            for name, expected in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = []
                for row in captures(name, expected):
                    rows.append(row)
                    if len(rows) >= (16 if payloads else 1024):
                        yield _batch(rows, names)
                        rows = []
                if rows:
                    yield _batch(rows, names)

    return arrow_map(one_each(archives.select("archive", "records")), run, schema)


_KINDS = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "offset": pa.int64(), "length": pa.int64()}


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(col, _KINDS.get(k, pa.string())) for k, col in zip(names, zip(*rows))], names)


# Runs and their merge

class LoserTree:
    """Merge of sorted streams: each node keeps the loser of its match, so a step replays one path."""

    def __init__(self, streams: list[Iterable[pa.RecordBatch]]):
        self.streams = [iter(s) for s in streams]
        k = len(streams)
        self.rows: list[pa.RecordBatch | None] = [None] * k
        self.keys: list[list[str]] = [[] for _ in range(k)]
        self.at = [0] * k
        self.base = [0] * k
        self.pool: list[pa.RecordBatch] = []
        self.pooled = 0
        for i in range(k):
            self._fill(i)
        winner = [0] * k + list(range(k))
        self.loser = [0] * k
        for node in range(k - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            if self._after(a, b):
                a, b = b, a
            winner[node], self.loser[node] = a, b
        self.top = winner[1] if k > 1 else 0

    def _fill(self, i: int) -> None:
        """Next batch of a stream; an empty key list marks its end."""
        self.rows[i], self.keys[i], self.at[i] = None, [], 0
        for b in self.streams[i]:
            if b.num_rows:
                self.rows[i], self.keys[i] = b, b.column(0).to_pylist()
                self._pool(i)
                return

    def _pool(self, i: int) -> None:
        self.base[i] = self.pooled
        self.pool.append(self.rows[i])
        self.pooled += self.rows[i].num_rows

    def _after(self, a: int, b: int) -> bool:
        if not self.keys[b]:
            return False
        return not self.keys[a] or self.keys[a][self.at[a]] > self.keys[b][self.at[b]]

    def merged(self, size: int = 4096) -> Iterator[pa.RecordBatch]:
        """All rows in the order of the key, the first column, in batches."""
        k, order = len(self.streams), []
        while k and self.keys[self.top]:
            i = self.top
            order.append(self.base[i] + self.at[i])
            self.at[i] += 1
            if self.at[i] == len(self.keys[i]):
                self._fill(i)
            node = (i + k) // 2
            while node:
                if self._after(i, self.loser[node]):
                    i, self.loser[node] = self.loser[node], i
                node //= 2
            self.top = i
            if len(order) == size:
                yield self._take(order)
                order = []
        if order:
            yield self._take(order)

    def _take(self, order: list[int]) -> pa.RecordBatch:
        out = pa.Table.from_batches(self.pool).take(pa.array(order)).combine_chunks().to_batches()[0]
        self.pool, self.pooled = [], 0
        for i, rows in enumerate(self.rows):
            if rows is not None:
                self._pool(i)
        return out


def run_slice(uri: str, low: str = "", high: str | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of a run with ``low <= sort_key < high``, from the row groups that can hold them."""
    fs, path = file_system(uri)
    with fs.open_input_file(path) as f:
        table = pq.ParquetFile(f)
        groups = []
        for g in range(table.metadata.num_row_groups):
            s = table.metadata.row_group(g).column(0).statistics
            if s is None or not s.has_min_max or not (s.max < low or high is not None and s.min >= high):
                groups.append(g)
        for b in table.iter_batches(batch_size=1024, row_groups=groups, columns=NAMES):
            key = b.column(0)
            keep = pc.greater_equal(key, low)
            yield b.filter(pc.and_(keep, pc.less(key, high)) if high is not None else keep)


def write_run(rows: DataFrame, label: str) -> DataFrame:
    """Write sorted partitions as a Parquet file each, with ``seq``, the place within the file."""
    path = f"{shared_folder(rows)}/{label}-{uuid.uuid4().hex}"
    numbered = rows.select(*NAMES, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("seq"))
    numbered.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return rows.sparkSession.read.schema(numbered.schema).parquet(path)


def history(captures: DataFrame, fan_in: int = FAN_IN, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Captures in the global order of URL key, time and page, with ``position`` (from 0) and ``nth`` of their URL (from 1).

    Captures that agree in all three stand in the order of archive and offset,
    so repeated rows have places of their own. Null pages come first. A table
    without captures gives no rows.
    """
    page = F.expr("lpad(CAST(CAST(page_id AS decimal(20, 0)) + CAST('9223372036854775808' AS decimal(20, 0)) AS string), 20, '0')")
    page = F.coalesce(page, F.lit(""))
    key = F.concat_ws(" ", "url_key", "captured", page, F.col("archive"), F.lpad(F.col("offset").cast("string"), 19, "0"))
    runs = write_run(captures.withColumn("sort_key", key).sortWithinPartitions("sort_key"), "warc-runs")
    while True:
        files = staged(runs.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n")), "warc-files")
        if files.count() <= fan_in:
            break
        bundles = dense_index(files, ["file"], "at").groupBy(F.expr(f"at div {fan_in}").alias("bundle")).agg(F.collect_list("file").alias("files"))

        def bundle(batches):
            for b in batches:
                for names in b.column(0).to_pylist():
                    yield from LoserTree([run_slice(x) for x in names]).merged()

        runs = write_run(arrow_map(one_each(staged(bundles.select("files"), "warc-bundles")), bundle, RUN), "warc-runs")

    names = sorted(r["file"] for r in files.select("file").collect())  # fan_in at most
    fences = dense_index(runs.where(F.col("seq") % FENCE == 0).select("sort_key"), ["sort_key"], "at")
    step = max(1, range_rows // FENCE)
    lows = staged(fences.where(F.col("at") % step == 0).select(F.expr(f"at div {step}").alias("range"), F.col("sort_key").alias("low")), "warc-lows")
    highs = lows.select((F.col("range") - 1).alias("range"), F.col("low").alias("high"))
    ranges = staged(lows.join(highs, "range", "left").select("range", F.when(F.col("range") == 0, "").otherwise(F.col("low")).alias("low"), "high"), "warc-ranges")

    def merge(batches):
        for b in batches:
            for number, low, high in zip(*[c.to_pylist() for c in b.columns]):
                at = 0
                for part in LoserTree([run_slice(x, low, high) for x in names]).merged():
                    place = [pa.array([number] * part.num_rows, pa.int64()), pa.array(range(at, at + part.num_rows), pa.int64())]
                    at += part.num_rows
                    yield pa.RecordBatch.from_arrays([*part.columns[1:], *place], [*NAMES[1:], "range", "place"])

    merged = staged(arrow_map(one_each(ranges), merge, f"{CAPTURE}, range bigint, place bigint"), "warc-history")
    before = prefix_sum(merged.groupBy("range").agg(F.count("*").alias("n")), ["range"], "n", "before", inclusive=False).select("range", "before")
    placed = merged.join(sized(before), "range").withColumn("position", F.col("before") + F.col("place"))
    first = placed.groupBy("url_key").agg(F.min("position").alias("first"))
    return placed.join(first, "url_key").select(*NAMES[1:], "position", (F.col("position") - F.col("first") + 1).alias("nth"))
