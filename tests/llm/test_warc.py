import hashlib
import zlib

import pytest

from tallyframe.llm import warc

SCHEMA = "page_id long, url string, html string, refers_to string"


def rows_of(df):
    return {r.page_id: r for r in df.collect()}


def test_round_trip_and_revisits(spark, tmp_path):
    big, odd = "é<p>" * 400, "x\x00\r\n\r\ny" * 300
    pages = spark.createDataFrame([
        (1, "http://a/1", big, "clash"), (2, "http://a/2", big, "clash"), (3, None, None, None), (4, "u%0A\nv", "", None),
        (5, "http://a/5", "small", None), (6, "http://a/6", "small", None), (7, "http://a/7", odd, None)], SCHEMA)
    path = "file://" + str(tmp_path / "w")
    warc.write(pages, path)
    got = rows_of(warc.read(spark, path))
    assert len(got) == 7
    assert (got[1].record_type, got[1].refers_to, got[1].payload) == ("revisit", 2, None)
    assert (got[2].record_type, got[2].refers_to, bytes(got[2].payload)) == ("response", None, big.encode())
    assert got[1].payload_bytes == len(big.encode()) and got[1].payload_digest == hashlib.sha1(big.encode()).hexdigest()
    assert got[3].url is None and got[3].payload_bytes == 0 and got[4].url == "u%0A\nv"
    assert got[5].record_type == got[6].record_type == "response"
    assert bytes(got[7].payload) == odd.encode()
    files = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    out, n = files, 0
    while out:  # plain concatenated gzip members
        d = zlib.decompressobj(31)
        assert d.decompress(out).startswith(b"WARC/") and d.eof
        out, n = d.unused_data, n + 1
    assert n == 7


def test_null_ids_repeated_rows_and_empty_table(spark, tmp_path):
    big = "z" * 1500
    pages = spark.createDataFrame([(None, "a", big, ""), (None, "a", big, ""), (9, "b", "k" * 2000, ""), (9, "b", "k" * 2000, "")], SCHEMA)
    path = "file://" + str(tmp_path / "n")
    warc.write(pages, path)
    got = warc.read(spark, path).collect()
    assert [r.record_type for r in got] == ["response"] * 4
    empty = "file://" + str(tmp_path / "e")
    warc.write(pages.limit(0), empty)
    assert warc.read(spark, empty).count() == 0


def test_chance_magic_inside_members_across_ranges(spark, tmp_path):
    """Stored (uncompressed) members hold the magic often; ranges are far smaller than members."""
    want = {}
    with open(tmp_path / "part-0.txt", "wb") as f:
        for i in range(40):
            payload = (b"ab" + warc.MAGIC) * (i * 37) + bytes(str(i), "ascii")
            want[i] = payload
            record = warc._record(i, f"http://h/{i}", payload, hashlib.sha1(payload).hexdigest(), None)
            c = zlib.compressobj(0, zlib.DEFLATED, 31)
            f.write(c.compress(record) + c.flush())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1000", "4097", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            got = {r.page_id: bytes(r.payload) for r in warc.read(spark, "file://" + str(tmp_path)).collect()}
            assert got == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_member_of_length_over_16_mib_ends_in_zero():
    m = warc.member(b"WARC/" + b"a" * (1 << 24))
    assert m[-1] == 0 and m.endswith(warc._END)


def test_lost_bytes_are_an_error(spark, tmp_path):
    with open(tmp_path / "part-0.txt", "wb") as f:
        f.write(warc.member(warc._record(1, "u", b"p" * 5000, hashlib.sha1(b"p" * 5000).hexdigest(), None))[:-20])
    with pytest.raises(Exception, match="no end"):
        warc.read(spark, "file://" + str(tmp_path)).count()
