"""Archives: round trips, revisits, and salvage of damaged files."""

import gzip
import hashlib
import io

import pytest

from boxloom.llm import warc

SCHEMA = "page_id long, url string, html string, extra string"


def payload(i):
    return f"<p>{i}</p>" * 200


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i} x", payload(i % 4), "e") for i in range(12)]
    rows += [(20, None, None, None), (21, "u", "", None), (22, "u", "short", None), (23, "v", "short", None), (None, "n", payload(0), None), (11, "again", payload(3), None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_round_trip(spark, pages):
    found = warc.round_trip(spark, pages).collect()
    assert len(found) == pages.count()
    by = {r.page_id: r for r in found}
    assert by[8].record_type == "response" and by[0].record_type == "revisit" and by[0].refers_to == 8
    assert by[0].payload_bytes == len(payload(0)) and by[0].payload_digest == hashlib.sha1(payload(0).encode()).hexdigest()
    assert by[20].payload_bytes == 0 and by[20].payload_digest == hashlib.sha1(b"").hexdigest()
    assert by[22].record_type == by[23].record_type == "response"  # too short for a revisit
    assert by[None].record_type == "revisit" and by[None].refers_to == 8
    assert [r.record_type for r in found if r.page_id == 11] == ["response"] * 2


def test_empty_table(spark):
    assert warc.round_trip(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def archive(compressed):
    records = [warc.record(i, f"http://h/{i}", payload(i).encode(), hashlib.sha1(payload(i).encode()).hexdigest(), None) for i in range(6)]
    return [warc.member(r, 6) if compressed else r for r in records]


def walk(data):
    return list(warc.salvage(warc.Window(io.BytesIO(data), len(data))))


@pytest.mark.parametrize("compressed", [True, False])
def test_whole_file_has_no_gaps(compressed):
    found = walk(b"".join(archive(compressed)))
    assert [r["page_id"] for r in found] == list(range(6)) and not any(r["gap"] for r in found)


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("harm", ["flip", "cut", "insert", "tail", "head"])
def test_salvage(compressed, harm):
    parts = archive(compressed)
    bad = bytearray(parts[2])
    bad[len(bad) // 2] ^= 0x55
    parts[2] = {"flip": bytes(bad), "cut": parts[2][: len(parts[2]) // 2], "insert": parts[2] + b"\x1f\x8b\x08 junk WARC/1.0\r\n", "tail": parts[2], "head": parts[2]}[harm]
    if harm == "tail":
        parts[5] = parts[5][:-20]
    if harm == "head":
        parts.insert(0, b"\x1f\x8b\x08\x00garbage")
    data = b"".join(parts)
    found = walk(data)
    lost = {"flip": {2}, "cut": {2}, "insert": set(), "tail": {5}, "head": set()}[harm]
    assert [r["page_id"] for r in found if not r["gap"]] == [i for i in range(6) if i not in lost]
    assert sum(r["length"] for r in found) == len(data) and len([r for r in found if r["gap"]]) == 1


def test_members_of_several_records_and_foreign_headers():
    found = walk(gzip.compress(b"".join(archive(False))))
    assert [r["page_id"] for r in found] == list(range(6))


def test_wrong_length_is_quarantined():
    parts = archive(False)
    size = parts[1].index(b"Content-Length: ") + 16
    parts[1] = parts[1][:size] + b"9" + parts[1][size:]
    found = walk(b"".join(parts))
    assert [r["page_id"] for r in found if not r["gap"]] == [0, 2, 3, 4, 5]


def test_very_long_urls(spark):
    urls = ["http://h/" + "x" * 200_000, "http://h/" + " " * 70_000, "short"]
    found = warc.round_trip(spark, spark.createDataFrame([(i, u, payload(i), None) for i, u in enumerate(urls)], SCHEMA)).collect()
    assert sorted(r.page_id for r in found) == [0, 1, 2] and {r.page_id: r.url for r in found}[0] == urls[0]
    plain = [warc.record(i, u, payload(i).encode(), hashlib.sha1(payload(i).encode()).hexdigest(), None) for i, u in enumerate(urls)]
    assert [(r["page_id"], r["gap"]) for r in walk(b"".join(plain))] == [(0, None), (1, None), (2, None)]


def test_gap_in_own_archive_fails(spark, pages, monkeypatch):
    kept = warc.read_archives
    monkeypatch.setattr(warc, "read_archives", lambda *a, **b: kept(*a, **b).withColumn("gap", warc.F.lit("damaged")))
    with pytest.raises(Exception, match="own archive has a gap"):
        warc.round_trip(spark, pages).collect()


def test_bad_record_in_a_member_costs_only_itself():
    parts = archive(False)
    parts[2] = parts[2].replace(b"<p>2</p>", b"<p>X</p>", 1)
    size = parts[4].index(b"Content-Length: ") + 16
    parts[4] = parts[4][:size] + b"9" + parts[4][size:]
    whole = gzip.compress(b"".join(parts))
    found = walk(whole + archive(True)[0])
    assert [r["page_id"] for r in found if not r["gap"]] == [0, 1, 3, 5, 0]
    gaps = [r["gap"] for r in found if r["gap"]]
    start = len(parts[0] + parts[1])
    assert len(gaps) == 2 and f"inflated bytes {start} to {start + len(parts[2])} of the member" in gaps[0]


@pytest.mark.parametrize("harm", ["cut", "flip", "trailer"])
def test_damaged_member_yields_what_inflated(harm):
    noise = [hashlib.sha512(f"{i}-{k}".encode()).hexdigest() for i in range(6) for k in range(40)]
    texts = ["".join(noise[i * 40 : i * 40 + 40]).encode() for i in range(6)]
    data = bytearray(gzip.compress(b"".join(warc.record(i, "u", t, hashlib.sha1(t).hexdigest(), None) for i, t in enumerate(texts))))
    if harm == "cut":
        data = data[: len(data) * 2 // 3]
    else:
        data[-6 if harm == "trailer" else len(data) * 2 // 3] ^= 0x55
    found = walk(bytes(data) + archive(True)[5])
    ids = [r["page_id"] for r in found if not r["gap"]]
    assert ids[:3] == [0, 1, 2] and ids[-1] == 5 and (harm != "trailer" or ids == [0, 1, 2, 3, 4, 5, 5])
    assert len([r for r in found if r["gap"]]) == 1 and sum(r["length"] for r in found) == len(data) + len(archive(True)[5])


@pytest.mark.parametrize("hold", [1000, 1 << 24])
@pytest.mark.parametrize("bad", [0, 2, 5])
def test_whole_file_in_one_member(monkeypatch, bad, hold):
    """One damaged record, first, inner or last, costs only itself, whether the member is held or inflated again."""
    monkeypatch.setattr(warc, "HOLD", hold)
    parts = archive(False)
    parts[bad] = parts[bad].replace(f"<p>{bad}</p>".encode(), b"<p>X</p>", 1)
    data = gzip.compress(b"".join(parts))
    found = walk(data)
    assert [r["page_id"] for r in found if not r["gap"]] == [i for i in range(6) if i != bad] and len([r for r in found if r["gap"]]) == 1


def test_large_member_is_read_forwards(monkeypatch):
    """A record far longer than what is held, and a header without its end, in one member."""
    monkeypatch.setattr(warc, "HOLD", 1000)
    text = "".join(hashlib.sha1(str(i).encode()).hexdigest() for i in range(100_000)).encode()
    long = warc.record(7, "u", text, hashlib.sha1(text).hexdigest(), None)
    found = walk(gzip.compress(b"".join([*archive(False)[:2], long, b"WARC/1.1 broken\r\n\r\n", archive(False)[3]]), 1))
    assert [r["page_id"] for r in found if not r["gap"]] == [0, 1, 7, 3] and len([r for r in found if r["gap"]]) == 1
    assert found[2]["payload"] == text


def test_very_large_payload(spark):
    html = "<p>x</p>" * 1_000_000
    found = warc.round_trip(spark, spark.createDataFrame([(1, "u", html, None), (2, "u", html, None)], SCHEMA)).collect()
    assert {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in found} == {(2, "response", None, len(html)), (1, "revisit", 2, len(html))}
