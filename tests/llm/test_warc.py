import base64
import glob
import hashlib

import pytest
import zstandard

from hoardline.llm import warc

PAGES = [
    (3, "http://a/ b\r\n", "<p>one</p>", 1),
    (1, None, "<p>one</p>", 1),
    (2, "u", None, 1),
    (4, "u", "", 1),
    (5, "u", "é" * 300_000, 1),
    (None, "u", "<p>one</p>", 1),
    (None, "u", "only without id", 1),
    (7, "u", "Content-Length: 5\r\n\r\nx", 1),
    (8, "u", "twin", 1),
    (8, "u", "twin", 1),
]


def expected(rows, min_bytes=0):
    firsts = {}
    for i, _, html, _ in rows:
        if i is not None:
            firsts[html or ""] = min(i, firsts.get(html or "", i))
    out = []
    for i, _, html, _ in rows:
        data = (html or "").encode()
        first = firsts.get(html or "") if len(data) >= min_bytes else None
        again = first is not None and i != first
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 6])
def test_round_trip(spark, min_bytes, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string, digest int").repartition(3)
    back = warc.archive(df, f"file://{tmp_path}/w", min_bytes).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str) == expected(PAGES, min_bytes)
    texts = {(i, (html or "").encode()) for i, _, html, _ in PAGES}
    assert all((r.page_id, bytes(r.payload)) in texts for r in back if r.record_type == "response")


def test_archives_are_plain_frames(spark, tmp_path):
    rows = [(i, f"http://site/{i}", f"<html><head><title>page {i}</title></head><body>{'lorem ipsum ' * (i % 40)}</body></html>", 0) for i in range(3_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, x int")
    warc.write(warc.classified(df).repartition(2), f"file://{tmp_path}/w", training_bytes=1 << 18)
    files = glob.glob(f"{tmp_path}/w/part-*")
    assert len(files) == 2
    count = 0
    for f in files:
        data = open(f, "rb").read()
        assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_MAGIC
        size = int.from_bytes(data[4:8], "little")
        dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + size])
        assert dictionary.dict_id() != 0
        with zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(data[8 + size :], read_across_frames=True) as whole:
            count += whole.read().count(b"WARC/1.1\r\n")
        assert len(data) < 400_000
    assert count == 3_000


def test_empty_table(spark):
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
