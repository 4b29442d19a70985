"""Archives written and read back, plain, packed and foreign."""

import gzip
import io

import pytest

from tradewind.llm import warc


def records():
    made = [warc.record_bytes({"record_id": str(i), "record_type": "response"},
                              b"WARC/1.1\r\n\r\n" * i * 300 + b"x\r\n") for i in range(6)]
    return [*made, warc.record_bytes({"record_id": "e"}, b"")]


@pytest.mark.parametrize("pack", [bytes, warc.member, gzip.compress])
@pytest.mark.parametrize("wanted", [{"2", "e"}, set(), {"0", "1", "2", "3", "4", "5", "e"}])
def test_payloads_are_read_or_passed_over(pack, wanted):
    source = warc.records_of(io.BufferedReader(io.BytesIO(b"".join(map(pack, records())))))
    seen = []
    while (headers := source.headers()) is not None:
        name = headers["warc-record-id"]
        seen.append(name)
        if name in wanted:
            expected = b"" if name == "e" else b"WARC/1.1\r\n\r\n" * int(name) * 300 + b"x\r\n"
            assert source.payload() == expected
        source.next()
    assert seen == ["0", "1", "2", "3", "4", "5", "e"]


def test_packed_members_are_gzip():
    assert gzip.decompress(b"".join(map(warc.member, records()))) == b"".join(records())


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_pages_round_trip(spark, make, tmp_path, compression):
    long, other = "é" * 60, "b" * 120
    pages = make("page_id long, url string, html string, digest string, first long",
                 (4, "u4", long, "", 0), (2, "u2", long, "", 0), (9, "a\r\nb", long, "", 0),
                 (5, "u5", "short", "", 0), (6, "u6", "short", "", 0), (7, None, None, "", 0),
                 (8, "u8", other, "", 0), (2, "u2", long, "", 0))
    path = str(tmp_path / "out")
    warc.write(warc.as_records(pages, date="2024-01-01T00:00:00Z"), path, max_file_bytes=300,
               compression=compression)
    got = sorted((int(r.record_id), r.record_type, r.refers_to, r.payload_bytes, r.payload)
                 for r in warc.read(spark, path).collect())
    assert got == [
        (2, "response", None, 120, long), (2, "response", None, 120, long),
        (4, "revisit", "2", 120, ""), (5, "response", None, 5, "short"),
        (6, "response", None, 5, "short"), (7, "response", None, 0, ""),
        (8, "response", None, 120, other), (9, "revisit", "2", 120, "")]


def test_filters_are_taken_over_and_payloads_left(spark, make, tmp_path):
    path = str(tmp_path / "out")
    pages = make("page_id long, url string, html string", *[(k, f"u{k}", "x" * 200) for k in range(5)])
    warc.write(warc.as_records(pages), path)
    some = warc.read(spark, path, payload="none").where("record_type = 'revisit' and target_uri = 'u3'")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo" not in plan.split("BatchScan")[0] and "Filter" not in plan.split("BatchScan")[0]
    assert [(r.record_id, r.payload) for r in some.collect()] == [("3", None)]


def test_files_of_lost_tasks_are_not_read(spark, make, tmp_path):
    path = str(tmp_path / "out")
    warc.write(warc.as_records(make("page_id long, url string, html string", (1, "u", "h"))), path)
    (tmp_path / "out" / "left-behind.warc").write_bytes(b"broken")
    assert warc.read(spark, path).count() == 1


def test_an_empty_table(spark, make, tmp_path):
    path = str(tmp_path / "out")
    warc.write(warc.as_records(make("page_id long, url string, html string", (1, "u", "h")).limit(0)),
               path)
    assert warc.read(spark, path).count() == 0


def pages(make, *ids):
    return warc.as_records(make("page_id long, url string, html string",
                                *[(k, f"u{k}", f"h{k}") for k in ids]))


def ids(df):
    return sorted(r.record_id for r in df.collect())


def test_appends_add_and_overwrites_replace(spark, make, tmp_path):
    path = str(tmp_path / "out")
    warc.write(pages(make, 1, 2), path)
    warc.write(pages(make, 3), path)
    assert ids(warc.read(spark, path)) == ["1", "2", "3"]
    warc.write(pages(make, 4), path, mode="overwrite")
    assert ids(warc.read(spark, path)) == ["4"]
    warc.write(pages(make, 5), path)
    assert ids(warc.read(spark, path)) == ["4", "5"]
    # Folders of our own keep their manifests where the path is wider.
    (tmp_path / "out" / "left-behind.warc").write_bytes(b"broken")
    for wider in (str(tmp_path), str(tmp_path / "o*" / "*.warc*")):
        assert ids(warc.read(spark, wider)) == ["4", "5"]


def foreign(name, payload, *more):
    lines = ["WARC/1.0", "WARC-Type: response", f"WARC-Record-ID: <urn:{name}>",
             "WARC-Target-URI: http://a.org/", "\tlong", f"Content-Length: {len(payload)}", *more]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    records = [foreign(k, b"HTTP/1.1 200 OK\r\n\r\n" + b"x" * 40_000 * k) for k in range(4)]
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "each.warc.gz").write_bytes(b"".join(map(gzip.compress, records[:2])))
    (tmp_path / "a" / "b" / "whole.warc.gz").write_bytes(gzip.compress(b"".join(records[2:])))
    (tmp_path / "a" / "plain.warc").write_bytes(b"\r\n" + foreign("p", b"body"))
    (tmp_path / "a" / "notes.txt").write_bytes(b"no archive")
    every = warc.read(spark, str(tmp_path / "a"))
    assert ids(every) == ["<urn:0>", "<urn:1>", "<urn:2>", "<urn:3>", "<urn:p>"]
    sizes = {r.record_id: (len(r.payload), r.content_length, r.target_uri) for r in every.collect()}
    assert sizes["<urn:3>"] == (120_019, 120_019, "http://a.org/ long")
    assert ids(warc.read(spark, str(tmp_path / "a" / "plain.warc"))) == ["<urn:p>"]
    assert ids(warc.read(spark, str(tmp_path / "a" / "*.warc.gz"))) == ["<urn:0>", "<urn:1>"]
    assert ids(warc.read(spark, str(tmp_path / "**" / "*.gz"))) == [f"<urn:{k}>" for k in range(4)]
    one = warc.read(spark, str(tmp_path / "a"), payload="none").where("record_id = '<urn:3>'")
    assert ids(one) == ["<urn:3>"]
    for nothing in ("none", "a/*.zip"):
        with pytest.raises(Exception, match="FileNotFound|no archives"):
            warc.read(spark, str(tmp_path / nothing)).collect()


def test_members_of_ours_before_one_of_others():
    mixed = warc.member(records()[1]) + gzip.compress(b"".join(records()[2:5]))
    source, seen = warc.records_of(io.BufferedReader(io.BytesIO(mixed))), []
    while (headers := source.headers()) is not None:
        seen.append((headers["warc-record-id"], len(source.payload())))
        source.next()
    assert seen == [(str(k), len(b"WARC/1.1\r\n\r\n") * k * 300 + 3) for k in range(1, 5)]


def test_a_very_long_payload(spark, make, tmp_path):
    path, long = str(tmp_path / "out"), "é" * 3_000_000
    warc.write(warc.as_records(make("page_id long, url string, html string", (1, "u", long),
                                    (2, "u", long))), path)
    got = warc.read(spark, path).where("record_type = 'response'").collect()
    assert [(r.record_id, r.payload == long) for r in got] == [("1", True)]


def test_an_archive_that_ends_early(tmp_path):
    source = warc.records_of(io.BufferedReader(io.BytesIO(foreign("a", b"x" * 100)[:-50])))
    source.headers()
    with pytest.raises(ValueError, match="ends within"):
        source.payload()
