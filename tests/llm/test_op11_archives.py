"""WARC archives: round trip, revisits, the loser tree and the ordered history against plain Python."""

import hashlib
import random
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from tessera.llm import warc

SCHEMA = "page_id long, url string, html string"
BODY = "<p>" + "same words " * 20


def seconds():
    return F.lit(1_700_000_000) + F.coalesce(F.col("page_id"), F.lit(0))


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA).repartition(3)


def archived(df):
    return warc.write(df, "page_id", "url", "html", seconds())


def plain(rows):
    """(page, bytes, digest, type, refers_to) of each row, by the rule read literally."""
    least = {}
    for page, _, html in rows:
        if page is not None:
            least[html or ""] = min(page, least.get(html or "", page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = least.get(html or "")
        back = first if len(raw) >= 100 and first is not None and page != first else None
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if back is not None else "response", back))
    return sorted(out, key=repr)


AWKWARD = [(1, "http://a.example.org/x", BODY), (2, "http://a.example.org/y", BODY), (3, "http://a.example.org/z", "short"),
           (4, "http://a.example.org/z", "short"), (5, None, None), (6, "", ""), (None, "http://b.example.org", BODY), (1, "http://a.example.org/x", BODY),
           (7, "http://b.example.org/a b\r\nX-Forged: 1", "wörld 😀\r\n\r\nWARC/1.1\r\n" * 30), (8, "http://b.example.org/long", "é" * 3_000_000),
           (9, "not a url", BODY), (None, None, None), (10, "http://b.example.org/1", "wörld 😀\r\n\r\nWARC/1.1\r\n" * 30)]


def test_round_trip_of_awkward_rows(pages):
    got = warc.history(warc.read(archived(pages(AWKWARD)))).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == plain(AWKWARD)
    assert sorted(r.position for r in got) == list(range(len(AWKWARD)))


def test_payloads_and_headers(pages):
    archives = archived(pages(AWKWARD)).cache()
    got = {(r.page_id, r.record_type): r for r in warc.read(archives, payloads=True).collect()}
    assert got[8, "response"].payload == "é" * 3_000_000 and got[7, "response"].payload == AWKWARD[8][2]
    assert got[2, "revisit"].payload == "" and got[2, "revisit"].refers_to == 1
    for name in (r.archive for r in archives.collect()):
        fs, path = warc.file_system(name)
        with fs.open_input_stream(path, compression=None) as f:
            raw = f.read()
        text = zlib.decompressobj(wbits=31).decompress(raw)  # the first member alone is a whole record
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: re") and text.endswith(b"\r\n\r\n")
        assert b"X-Forged: 1" not in [x for _, _, m in _members(raw) for x in m.split(b"\r\n")]


def _members(raw):
    import io
    return list(warc.members(io.BytesIO(raw), chunk=77))


def test_damaged_archives_are_refused(spark, pages):
    archives = archived(pages(AWKWARD[:4]).coalesce(1))
    (name, records, _), = archives.collect()
    fs, path = warc.file_system(name)
    with fs.open_input_stream(path, compression=None) as f:
        raw = f.read()
    assert isinstance(fs, pafs.LocalFileSystem)
    first = next(iter(_members(raw)))
    swapped = zlib.compress(first[2].replace(b"same", b"SAME"), wbits=31) + raw[first[1]:]
    for bad, n in ((raw[:-5], records), (swapped, records), (raw, records + 1)):
        with open(path, "wb") as f:
            f.write(bad)
        again = spark.createDataFrame([(name, n)], "archive string, records long")
        with pytest.raises(Exception, match="archive ends|differs from its header|were written"):
            warc.read(again).collect()


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 20])
def test_loser_tree(k):
    rng = random.Random(k)
    runs = [sorted(f"{rng.randint(0, 999):03d}-{i}-{j}" for j in range(rng.choice([0, 1, 5, 3000]))) for i in range(k)]
    streams = [[pa.RecordBatch.from_pydict({"key": run[a:a + 7], "n": [len(x) for x in run[a:a + 7]]}) for a in range(0, len(run), 7)] for run in runs]
    got = [x for b in warc.LoserTree(streams).merged(size=100) for x in b.column(0).to_pylist()]
    assert got == sorted(x for run in runs for x in run)


@pytest.mark.parametrize("fan_in", [2, 256])
def test_history_in_many_ranges_and_passes(spark, pages, fan_in):
    rng = random.Random(3)
    rows = [(i, f"http://{rng.choice(['www.', '', 'm.'])}h{rng.randint(0, 5)}.example.org/{'hot' if i % 3 == 0 else rng.randint(0, 50)}", f"<p>{i}") for i in range(3000)]
    got = warc.history(warc.read(archived(pages(rows).repartition(7))), fan_in=fan_in, range_rows=128).collect()
    want = sorted((warc.url_key(u), i) for i, u, _ in rows)
    assert [(r.url_key, r.page_id) for r in sorted(got, key=lambda r: r.position)] == want
    seen = {}
    for r in sorted(got, key=lambda r: r.position):
        seen[r.url_key] = seen.get(r.url_key, 0) + 1
        assert r.nth == seen[r.url_key]


def test_url_keys():
    assert warc.url_key("HTTP://user@www.Blog.Example.COM:8080/A/b?Q=1#top") == "com,example,blog)/a/b?q=1"
    assert warc.url_key("https://example.org") == warc.url_key("http://example.org/") == "org,example)/"
    assert warc.url_key("https://example.org?q") == "org,example)/?q" and warc.url_key("") == ""


def test_empty_table_and_clashing_columns(pages):
    assert warc.history(warc.read(archived(pages([])))).collect() == []
    df = pages(AWKWARD[:4]).withColumns({c: F.lit("z") for c in ("archive", "page", "seconds", "records", "offset", "position", "digest", "seq", "range")})
    got = warc.history(warc.read(archived(df))).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == plain(AWKWARD[:4])
