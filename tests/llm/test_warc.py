import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from riverdeck.llm import warc
from riverdeck.llm.warc import archive_report, parsed, read_archives, record, records, write_archives


def member(k, payload):
    return record(str(k), f"http://x/{k}", payload, hashlib.sha1(payload).hexdigest(), len(payload), None)


def test_any_split_gives_each_record_once():
    pick = random.Random(3)
    data = b"".join(member(k, bytes(pick.randrange(256) for _ in range(pick.choice([0, 5, 400, 3000])))) for k in range(60))
    for split in (1, 7, 100, 1000, 5000, len(data)):
        found = [parsed(r, False)[0] for s in range(0, len(data), split)
                 for r in records(io_file(data), s, min(s + split, len(data)))]
        assert found == [str(k) for k in range(60)], split


def io_file(data):
    class File(io.BytesIO):
        def size(self):
            return len(data)

    return File(data)


def test_magic_inside_a_payload_is_no_record():
    inner = warc.MAGIC + b"\x00" * 30 + member(99, b"an archive in an archive") + gzip.compress(b"WARC? no")
    stored = b"".join(member(k, inner * 3) for k in range(5))
    assert [parsed(r, True)[7] for r in records(io_file(stored), 0, len(stored))] == [inner * 3] * 5
    junk = b"\x1f\x8b\x08 not gzip " + stored
    assert len(list(records(io_file(junk), 0, len(junk)))) == 5


def test_headers_of_any_length_are_read():
    pick = random.Random(4)
    urls = ["http://x/" + "".join(chr(pick.randrange(33, 127)) for _ in range(n)) for n in (200_000, 70_000, 10, 1_000_000)]
    urls += ["http://x/" + "a" * 3_000_000]
    data = b"".join(record(str(k), u, b"p", hashlib.sha1(b"p").hexdigest(), 1, None) for k, u in enumerate(urls))
    for split in (50_000, len(data)):
        found = [parsed(r, True) for s in range(0, len(data), split) for r in records(io_file(data), s, min(s + split, len(data)))]
        assert [(f[0], f[1], f[6], f[7]) for f in found] == [(str(k), u, True, b"p") for k, u in enumerate(urls)]
    cut = gzip.compress(b"WARC/1.1\r\n" + b"a" * 300_000)  # a header without an end
    assert [parsed(r, False)[0] for r in records(io_file(cut + data), 0, len(cut + data))] == [str(k) for k in range(len(urls))]


def test_files_are_gzip_and_payloads_come_back(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    archives = write_archives(pages, str(tmp_path / "warc"))
    for row in archives.collect():
        with open(row.path, "rb") as f:
            assert gzip.decompress(f.read()).startswith(b"WARC/1.1\r\n")
    back = {int(r.page_id): (r.url, bytes(r.payload), r.intact) for r in read_archives(
        archives, str(tmp_path / "warc"), split_bytes=5000).collect()}
    assert back == {r.page_id: (r.url, r.html.encode(), True) for r in pages.collect()}


def test_edges(spark):
    big = "é" * 600
    rows = [(1, "u", big), (2, None, big), (2, "u", big), (None, "u", big), (3, "a\r\nb", None), (4, "u", ""), (5, "u", "x" * 999),
            (6, "u", "x" * 999), (7, "u", "y" * 1000), (8, "u", "z" * 3_000_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("d")).repartition(4)
    got = sorted([tuple(r) for r in archive_report(pages).collect()], key=str)
    expected = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        revisit = html == big and page_id != 2
        expected.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None))
    assert got == sorted(expected, key=str)
    nameless = spark.createDataFrame([(None, "u", big)] * 2, "page_id bigint, url string, html string")
    assert [r.record_type for r in archive_report(nameless).collect()] == ["response"] * 2
    assert archive_report(pages.limit(0)).count() == 0


@pytest.mark.parametrize("task_bytes", [1, 50_000, 2 ** 30])
def test_tasks_read_many_splits(spark, sf_dir, tmp_path, monkeypatch, task_bytes):
    monkeypatch.setattr(warc, "TASK_BYTES", task_bytes)
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    root = str(tmp_path / "warc")
    archives = write_archives(pages, root)
    size, splits = archives.agg(F.sum("bytes"), F.sum(F.ceil(F.col("bytes") / 2000))).first()
    slots = 4 * spark.sparkContext.defaultParallelism
    found = read_archives(archives, root, split_bytes=2000)
    assert found.rdd.getNumPartitions() == min(splits, max(slots, -(-size // task_bytes))) and splits > slots
    assert sorted(int(r.page_id) for r in found.collect()) == sorted(r.page_id for r in pages.collect())
