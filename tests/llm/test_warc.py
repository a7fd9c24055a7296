import gzip
import hashlib
import io

import pytest

from backsight.llm import files, warc


def test_read_back_equals_pages(spark):
    long, other = "é" * 60, "x" * 100
    rows = [(5, "http://a/ü b", long), (3, None, long), (9, "u", long), (9, "u", long), (7, "u", other), (8, "v", "short"), (2, "w", "short"), (1, "z", None), (None, "n", long), (4, "k", ""), (6, "big", "\r\n\r\nWARC/1.1\r\n" * 200000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    archives = warc.write_archives(pages)
    index = warc.normalise(archives)
    found = sorted(tuple(r) for r in warc.read_records(index).where("page_id is not null").collect())
    expected = []
    for key, _, html in rows:
        if key is not None:
            body = (html or "").encode()
            first = min((k for k, _, h in rows if k is not None and h == html), default=key)
            revisit = len(body) >= 100 and key > first
            expected.append((key, "revisit" if revisit else "response", first if revisit else None, len(body), hashlib.sha256(body).hexdigest()))
    assert found == sorted(expected, key=lambda r: (r[0], r[1]))
    row = index.where("page_id = 6").first()
    system, path = files.opened(row.archive)
    whole = system.open_input_file(path).read()
    assert gzip.decompress(whole[row.offset : row.offset + row["size"]]).startswith(b"WARC/1.1\r\nWARC-Type: response")
    sidecar = system.open_input_stream(path + ".idx", compression=None).read().decode().splitlines()
    assert len(sidecar) == index.where(index.archive == row.archive).count()


def test_streams():
    one = [warc._record(k, "u", b"x" * n, "d", None) for k, n in enumerate((0, 5, 300000))]
    for packed in (gzip.compress(b"".join(one)), b"".join(map(gzip.compress, one))):
        assert [r for _, r in warc.records(warc.inflated(io.BytesIO(packed)))] == one
        with pytest.raises(ValueError):
            list(warc.records(warc.inflated(io.BytesIO(packed[:-9]))))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_records(warc.normalise(warc.write_archives(empty))).collect() == []
