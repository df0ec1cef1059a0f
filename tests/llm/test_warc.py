import hashlib

import pyarrow.fs
import pytest
import zstandard
from pyspark.sql import functions as F

from crowdpulse.llm import warc
from crowdpulse.llm.warc import filesystem, read_warc, record, write_warc

SCHEMA = "page_id long, url string, html string"
LONG = "<p>" + "The same page. " * 100


def rows():
    out = [(i, f"https://example.org/{i}", f"<html>page {i} {'x' * i}</html>") for i in range(40)]
    out += [(100, "https://a.example/é ü%20\r\nX: y", LONG), (101, None, LONG), (150, "u", LONG), (102, "http://b.example/", LONG + "é")]
    out += [(200, "short", "small"), (201, "short", "small"), (202, "none", None), (203, "empty", ""), (204, "crlf", "a\r\n\r\nWARC/1.1\r\n\x00")]
    out += [(None, "no id", LONG), (150, "u", LONG), (300, "long", "long text " * 300_000)]
    return out


def expected(pages, least=1000):
    payload = [(p, (h or "").encode()) for p, _, h in pages]
    latest = {}
    for p, b in payload:
        if p is not None:
            latest[b] = max(latest.get(b, p), p)
    out = []
    for p, b in payload:
        again = len(b) >= least and p is not None and p < latest[b]
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", latest[b] if again else None))
    return sorted(out, key=repr)


def test_round_trip(spark, crowd):
    pages = rows()
    index = write_warc(crowd(pages, SCHEMA), max_file_bytes=4096)
    back = read_warc(spark, index, payload=True).collect()
    assert sorted((tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in back), key=repr) == expected(pages)
    held = {(r["page_id"], r["url"]): r["payload"] for r in back if r["record_type"] == "response"}
    for p, u, h in pages:
        if (p, u) in held:
            assert bytes(held[(p, u)]) == (h or "").encode()
    assert {r["url"] for r in back} == {u for _, u, _ in pages}
    assert index.select("file").distinct().count() > 1


def test_files_are_read_by_many_tasks(spark, crowd):
    index = write_warc(crowd([(i, "u", f"page {i} " * 400) for i in range(60)], SCHEMA), max_file_bytes=1000)
    assert index.select("file").distinct().count() >= 12
    out = read_warc(spark, index)
    tasks = out.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in tasks) == 60 and len(tasks) >= 4


def test_a_record_is_a_frame_of_its_own(spark, crowd):
    index = write_warc(crowd(rows(), SCHEMA)).collect()
    where, path = filesystem(index[0]["file"])
    data = where.open_input_stream(path, compression=None).read()
    size = int.from_bytes(data[4:8], "little")
    assert int.from_bytes(data[:4], "little") == 0x184D2A5D
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    for r in [r for r in index if r["file"] == index[0]["file"]][:20]:
        one = plain.decompress(data[r["offset"] : r["offset"] + r["length"]])
        assert one.startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode())
        assert f"<urn:x-page:{'' if r['page_id'] is None else r['page_id']}>".encode() in one


def test_the_dictionary_pays():
    pages = [record(i, f"https://example.org/{i}", f"<html><head><title>{i}</title></head><body><nav>Home</nav>{i * 7919}</body></html>".encode(), "2024-01-01T00:00:00Z") for i in range(400)]
    dictionary = zstandard.ZstdCompressionDict(warc.train_dictionary(pages[:300]))
    with_it = sum(len(zstandard.ZstdCompressor(dict_data=dictionary).compress(p)) for p in pages[300:])
    assert with_it < 0.5 * sum(len(zstandard.ZstdCompressor().compress(p)) for p in pages[300:])


def test_unfinished_files_are_not_read(spark, crowd, tmp_path):
    index = write_warc(crowd([(1, "u", "x")], SCHEMA), folder=str(tmp_path / "archive"))
    (tmp_path / "archive" / ".part-000009-0000.warc.zst.77").write_bytes(b"broken")
    assert [r["page_id"] for r in read_warc(spark, index).collect()] == [1]
    assert isinstance(filesystem("file:/tmp/x")[0], pyarrow.fs.LocalFileSystem) and filesystem("file:/tmp/x")[1] == "/tmp/x"


def test_damage_is_found(spark, crowd, tmp_path):
    index = write_warc(crowd([(1, "u", "x" * 3000)], SCHEMA))
    where, path = filesystem(index.first()["file"])
    data = where.open_input_stream(path, compression=None).read()
    with where.open_output_stream(path, compression=None) as out:
        out.write(data[:-5])
    with pytest.raises(Exception):
        read_warc(spark, index).collect()


def test_empty_table(spark, crowd):
    index = write_warc(crowd([], SCHEMA))
    assert index.collect() == [] and read_warc(spark, index.select(F.col("file"))).collect() == []
