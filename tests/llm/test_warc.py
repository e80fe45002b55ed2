import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from formmart.llm.warc import decode_record, encode_record, read_records, write_archives


def pages(spark):
    big, other = "é" * 700, "y" * 1000
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (9, "http://a/9\r\nX: y z", big), (3, None, other), (4, "u", "y" * 999),
            (5, "u", "y" * 999), (6, "u", None), (7, "u", ""), (None, "u", big), (8, "u", other), (8, "u", other), (10, "u", "z" * 200_000)]
    return spark.createDataFrame([(*r, "clash", 0) for r in rows],
                                 "page_id long, url string, html string, payload string, offset int")


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        body = (r.html or "").encode()
        if len(body) >= 1000 and r.page_id is not None:
            groups[body].append(r.page_id)
    for r in rows:
        body = (r.html or "").encode()
        keeper = max(groups.get(body, [r.page_id]), default=r.page_id)
        refers = keeper if keeper != r.page_id else None
        yield (r.page_id, len(body), hashlib.sha1(body).hexdigest(), "revisit" if refers is not None else "response", refers)


@pytest.mark.parametrize("gap,most", [(64 << 10, 8 << 20), (0, 1)])
def test_round_trip(spark, gap, most):
    df = pages(spark).repartition(3)
    index = write_archives(df, "page_id", "url", "html", max_file_bytes=300)
    back = read_records(index, max_gap=gap, max_range=most).collect()
    got = sorted(map(repr, ((r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back)))
    assert got == sorted(map(repr, brute(df.collect())))
    texts = {r.page_id: r for r in df.collect()}
    for r in back:
        assert r.url == texts[r.record_id].url
        if r.record_type == "response":
            assert bytes(r.payload).decode() == (texts[r.record_id].html or "")
        else:
            assert r.payload is None


def test_reads_only_what_is_selected(spark):
    index = write_archives(pages(spark), "page_id", "url", "html")
    some = read_records(index.where(F.col("record_id").isin(3, 10)))
    assert {r.record_id for r in some.collect()} == {3, 10}
    assert read_records(index.limit(0)).count() == 0


def test_empty(spark):
    assert read_records(write_archives(pages(spark).limit(0), "page_id", "url", "html")).count() == 0


def test_files_of_lost_attempts_go(spark, tmp_path):
    import os
    out = f"file://{tmp_path}/w"
    os.makedirs(tmp_path / "w")
    (tmp_path / "w" / "part-000000-99999-0.warc.gz").write_bytes(b"half")
    index = write_archives(pages(spark), "page_id", "url", "html", out_dir=out)
    names = {f"{out}/{n}" for n in os.listdir(tmp_path / "w") if not n.startswith(".")}
    assert names == {r.file for r in index.select("file").distinct().collect()}


def test_damage_is_noticed():
    body = b"hello"
    good = encode_record(1, "u", body, hashlib.sha1(body).hexdigest(), None)
    assert decode_record(good)["payload"] == body
    with pytest.raises(ValueError):
        decode_record(encode_record(1, "u", body, hashlib.sha1(b"other").hexdigest(), None))
