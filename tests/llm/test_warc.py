import hashlib

from orderflow.llm import warc

PAGES = "page_id long, url string, html string, digest string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash") for i, u, h in rows], PAGES)


def rows_():
    big, small = "é<p>" * 300, "x" * 999
    return [(i, f"http://h/{i}\r\nWARC-Type: x", big) for i in range(6)] + [(10, None, None), (11, "", ""), (12, "u", small), (13, "u", small), (14, "u", "y" * 1000),
            (15, "u", "y" * 1000), (None, "u", big), (None, "u", "z" * 2000), (None, "u", "z" * 2000), (20, "u", "w" * 1500), (20, "u", "w" * 1500), (21, "u", "\r\n\r\n" * 500), (22, "u", "q" * 700000)]


def want(rows):
    last = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            last[h] = max(i, last.get(h, i))
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = last.get(h)
        revisit = first is not None and first != i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect()), key=str)


def test_archive_and_read_back(spark):
    frame = pages(spark, rows_())
    assert got(warc.read(warc.archive(frame))) == want(rows_())


def test_random_access_over_frames_and_bundles(spark):
    from orderflow.sources.workdir import fresh_dir

    rows = [(i, "u", f"{i} " * 400) for i in range(200)]
    index = warc.write(warc.with_revisits(pages(spark, rows)).coalesce(2), fresh_dir(spark, "warc"), frame_bytes=5000, bundle_bytes=2000)
    assert index.select("bundle").distinct().count() > 4 and index.agg({"frame": "max"}).first()[0] > 2
    some = warc.read(index.where("page_id % 50 = 7")).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in some} == {i: f"{i} " * 400 for i in (7, 57, 107, 157)}
    reader = warc.Reader(index.first().bundle)
    assert len(reader.packed) == len(reader.plain) and reader.file.size() == reader.starts[-1] + 8 + 8 * len(reader.packed) + 9


def test_no_pages(spark):
    assert warc.read(warc.archive(pages(spark, []))).count() == 0


def test_records_have_what_the_standard_asks_for(spark):
    import datetime as dt

    from orderflow.sources.workdir import fresh_dir

    when = dt.datetime(2024, 2, 3, 4, 5, 6, tzinfo=dt.timezone(dt.timedelta(hours=1)))
    index = warc.write(warc.with_revisits(pages(spark, rows_())), fresh_dir(spark, "warc"), date=when)
    for r in index.collect():
        raw = warc.Reader(r.bundle).record(r.frame, r.start, r.n_bytes)
        headers, _, _ = warc.parsed(raw)
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")
        assert {"WARC-Record-ID", "WARC-Date", "WARC-Type", "Content-Length"} <= set(headers) and headers["WARC-Date"] == "2024-02-03T03:05:06Z"
