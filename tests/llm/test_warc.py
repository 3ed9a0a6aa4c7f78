import base64
import hashlib
import io
import random

import pytest

from deckspark.llm.warc import member, page_record, quarantine, read_archives, record, salvage, write_archives

DATE = "2024-01-01T00:00:00Z"


def archive(n, packed=True):
    """n records with their bytes."""
    rnd = random.Random(6)
    out = [page_record(i, f"http://a/{i}", bytes(rnd.randrange(256) for _ in range(rnd.randint(0, 3000))), None, DATE) for i in range(n)]
    return [member(x) if packed else x for x in out]


def read(data):
    found = list(salvage(io.BytesIO(data)))
    at = 0
    for kind, offset, length, *_ in found:  # records and gaps cover the file
        assert offset == at
        at += length
    assert at == len(data)
    return [f[3]["warc-record-id"] for f in found if f[0] == "record"], [f[1:4] for f in found if f[0] == "gap"]


def ids(numbers):
    return [f"<urn:page:{i}>" for i in numbers]


@pytest.mark.parametrize("packed", [True, False])
def test_sound_archive(packed):
    parts = archive(20, packed)
    assert read(b"".join(parts)) == (ids(range(20)), [])
    assert read(b"") == ([], [])


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "insert", "zero", "head"])
def test_later_records_are_recovered(packed, damage):
    parts = archive(12, packed)
    x = parts[4]
    half = len(x) // 2
    parts[4] = {
        "flip": x[: half] + bytes([x[half] ^ 255]) + x[half + 1 :],
        "cut": x[:half],
        "insert": x[:half] + b"junk" * 50 + x[half:],
        "zero": bytes(len(x)),
        "head": x[9:],
    }[damage]
    start = sum(map(len, parts[:4]))
    got, gaps = read(b"".join(parts))
    assert got == ids([0, 1, 2, 3, 5, 6, 7, 8, 9, 10, 11])
    assert [(o, n) for o, n, _ in gaps] == [(start, len(parts[4]))] and gaps[0][2]


def test_ends_and_garbage():
    parts = archive(3)
    whole = b"".join(parts)
    assert read(whole[:-5])[0] == ids([0, 1])
    assert read(b"garbage" + whole) == (ids(range(3)), [(0, 7, "no version line")])
    assert read(whole + b"\x1f\x8b\x08tail")[1][0][:2] == (len(whole), 7)
    assert read(b"x" * 3_000_000)[1][0][:2] == (0, 3_000_000)
    assert read(member(b"not a record") + whole)[0] == ids(range(3))


def test_record_after_a_wrong_length():
    bad = record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:page:9>")], b"abc").replace(b"Content-Length: 3", b"Content-Length: 9")
    good = archive(2, packed=False)
    got, gaps = read(bad + b"".join(good))
    assert got == ids([0, 1]) and gaps[0][:2] == (0, len(bad))


def contents(data):
    found = list(salvage(io.BytesIO(data)))
    return [f[3]["warc-record-id"] for f in found if f[0] == "record"], [f[1:4] for f in found if f[0] == "gap"]


@pytest.mark.parametrize("n", [12, 1500])
def test_a_bad_record_within_one_member(n):
    """The larger content is read in pieces."""
    parts = archive(n, packed=False)
    x = parts[4]
    parts[4] = x[:-20] + bytes([x[-20] ^ 255]) + x[-19:]
    whole, after = member(b"".join(parts)), archive(2)
    got, gaps = contents(whole + after[0])
    start = sum(map(len, parts[:4]))
    assert got == ids([*range(4), *range(5, n), 0])
    assert gaps == [(0, len(whole), f"block digest differs, bytes {start} to {start + len(x)} of the content")]


@pytest.mark.parametrize("n", [12, 1500])
def test_records_of_a_damaged_member(n):
    parts, after = archive(n, packed=False), archive(2)
    whole = member(b"".join(parts))
    got, gaps = contents(whole[:-8] + b"checksum" + after[1])  # all content is there
    assert got == ids([*range(n), 1]) and gaps[-1] == (0, len(whole), "member checksum")
    got, gaps = contents(whole[: len(whole) // 2] + after[1])
    k = len(got) - 1
    assert n // 4 < k < n and got == ids([*range(k), 1]) and gaps[-1][:2] == (0, len(whole) // 2)
    got, gaps = contents(whole[: len(whole) // 2])
    assert len(got) == k and gaps[-1] == (0, len(whole) // 2, "truncated member")
    plain = record([("WARC-Type", "resource"), ("WARC-Record-ID", "<urn:page:0>")], b"abc")  # no digest
    assert contents(member(plain + plain)[:-8] + b"checksum" + after[1])[0] == ids([1])


@pytest.mark.parametrize("packed", [True, False])
def test_header_of_any_length(packed):
    long = page_record(7, "http://a/" + "é" * 700_000, b"abc", None, DATE)
    parts = [long, *archive(2, packed=False)]
    assert read(b"".join(member(x) if packed else x for x in parts)) == (ids([7, 0, 1]), [])
    assert read(b"WARC/1.1\r\n" + b"x" * 3_000_000 + b"".join(parts))[0] == ids([7, 0, 1])


def test_round_trip_with_revisits(spark):
    rows = [(5, "http://x/ é\r\n", "same"), (3, None, "same"), (9, "u", "same"), (3, "v", "same"), (1, "u", ""), (2, "u", None), (7, "u", "<p>é中" * 5000), (None, "u", "same"), (8, "u", "own"), (8, "u", "own"), (None, "u", "only")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, refers_to string").repartition(3)
    found = read_archives(spark, write_archives(pages), payloads=True).where("record_type <> 'warcinfo'")
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in rows:
        h = h or ""
        refers = first.get(h) if first.get(h) != i else None
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        want.append((f"urn:page:{i}", "revisit" if refers is not None else "response", len(h.encode()), digest, None if refers is None else f"urn:page:{refers}"))
    got = found.collect()
    assert sorted(map(str, want)) == sorted(str((r.record_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to)) for r in got)
    assert {bytes(r.payload).decode() for r in got if r.payload is not None} == {h or "" for _, _, h in rows}
    assert quarantine(read_archives(spark, write_archives(pages.limit(0)))).count() == 0


def test_small_payloads_are_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    got = read_archives(spark, write_archives(pages, least_bytes=3)).where("record_type = 'revisit'").collect()
    assert [r.record_id for r in got] == ["urn:page:4"]


def test_gaps_are_logged(spark, tmp_path):
    parts = archive(5)
    parts[2] = parts[2][: len(parts[2]) // 2]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts))
    found = read_archives(spark, spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz",)], "path string"))
    assert found.where("kind = 'record'").count() == 4
    gap = quarantine(found).first()
    assert (gap.offset, gap.length) == (len(parts[0]) + len(parts[1]), len(parts[2])) and gap.reason
