"""Archives: what is written is read back, record by record."""

import glob
import hashlib
import struct

import pytest

from dossierflow.llm import warc

DATE = "2026-01-01T00:00:00Z"
DDL = "page_id bigint, url string, html string, digest string, shared string, again int, frame int"


@pytest.fixture
def archive(spark, tmp_path):
    def make(rows, **options):
        path = str(tmp_path / f"a{len(list(tmp_path.iterdir()))}")
        # columns whose names the operator uses inside
        table = spark.createDataFrame([(*r, "d", "s", 1, 2) for r in rows], DDL)
        warc.write_warc(spark, table, path, date=DATE, **options)
        return path

    return make


def role(rows, min_bytes=100):
    """``{(page_id, digest): (size, type, refers_to)}``, one row after the other."""
    least = {}
    for i, _, html in rows:
        if i is not None:
            least[html or ""] = min(i, least.get(html or "", i))
    out = {}
    for i, _, html in rows:
        payload = (html or "").encode()
        first = least.get(html or "")
        again = len(payload) >= min_bytes and first is not None and i != first
        out[i, hashlib.sha256(payload).hexdigest()] = (len(payload), "revisit" if again else "response", first if again else None)
    return out


def read(spark, path):
    return warc.read_warc(spark, path).collect()


def test_round_trip(spark, archive):
    body = "<p>Zürich \x00\r\n\r\nWARC/1.1 é</p>" * 8
    rows = [
        (7, "https://a/7", body), (3, "https://a/3", body), (9, "https://a/9", body), (1, "https://a/1", "short"),
        (2, "https://a/2", "short"), (4, None, None), (5, "", ""), (6, "https://a/x y\r\nWARC-Type: metadata", "z" * 100),
        (None, "https://a/n", body), (None, "https://a/m", "n" * 200), (8, "https://ü/%20", "z" * 99),
        (8, "https://other", "z" * 100),
    ]
    got = read(spark, archive(rows))
    assert {(r.page_id, r.payload_digest): (r.payload_bytes, r.record_type, r.refers_to) for r in got} == role(rows)
    assert len(got) == len(rows)
    by_digest = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in rows}
    identity = {(r.page_id, r.payload_digest): r.record_id for r in got if r.record_type == "response"}
    for r in got:
        assert r.payload == (by_digest[r.payload_digest] if r.record_type == "response" else None)
        assert r.date == DATE
        if r.record_type == "revisit":
            assert r.refers_to_record == identity[r.refers_to, r.payload_digest]
    assert {r.url for r in got if r.page_id in (4, 6)} == {"urn:page:4", "https://a/x%20y%0D%0AWARC-Type:%20metadata"}
    assert len({r.record_id for r in got}) == len(rows)


def test_repeated_rows_and_empty_tables(spark, archive):
    rows = [(5, "u", "x" * 120)] * 3 + [(9, "u", "x" * 120)] * 2
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in read(spark, archive(rows))) == (
        [(5, "response", None)] * 3 + [(9, "revisit", 5)] * 2
    )
    assert read(spark, archive([])) == []


def test_files_have_a_dictionary_and_frames_of_their_own(spark, archive):
    import zstandard

    rows = [(i, f"https://a/{i}", f"<html><body><p>{' '.join(str(i * k % 97) for k in range(60))}</p></body></html>") for i in range(1000)]
    path = archive(rows, records_per_file=40, sample_bytes=6000, dictionary_bytes=2048)
    files = [open(f, "rb").read() for f in glob.glob(f"{path}/part-*")]
    assert len(files) >= 25
    trained = 0
    for data in files:
        records = list(warc._unpacked(memoryview(data)))
        assert len(records) <= 40 and all(r.startswith(b"WARC/1.1\r\n") for r in records)
        magic, size = struct.unpack_from("<II", data)
        if magic == warc.DICTIONARY_MAGIC:
            trained += 1
            held = zstandard.ZstdCompressionDict(data[8 : 8 + size])
            at = 8 + size + 8  # past the separator
            assert zstandard.get_frame_parameters(data[at:]).dict_id == held.dict_id() != 0
            assert zstandard.ZstdDecompressor(dict_data=held).decompressobj().decompress(data[at:]) == records[0]
    assert trained >= len(files) // 2
    assert sorted(r.page_id for r in read(spark, path)) == list(range(1000))


def test_long_pages_and_a_task_of_many_files(spark, tmp_path):
    html = "".join(chr(0x400 + i * i % 900) for i in range(400_000)) * 8
    table = spark.createDataFrame([(i, "u", html if i < 2 else str(i)) for i in range(30)], "page_id int, url string, html string")
    warc.write_warc(spark, table.coalesce(1), str(tmp_path / "w"), date=DATE, records_per_file=7)
    got = {r.page_id: r for r in read(spark, str(tmp_path / "w"))}
    assert len(glob.glob(f"{tmp_path}/w/part-*")) == 5
    assert (got[0].payload.decode() == html, got[0].payload_bytes) == (True, len(html.encode()))
    assert (got[1].record_type, got[1].payload_bytes, got[1].payload) == ("revisit", len(html.encode()), None)


def test_other_writers_archives(spark, tmp_path):
    """A compressed dictionary, no separators, and no dictionary at all."""
    import zstandard

    made = [warc._record(i, f"https://a/{i}", b"x" * i * 9, hashlib.sha256(b"x" * i * 9).hexdigest(), None, DATE) for i in range(60)]
    held = zstandard.train_dictionary(512, made * 4, k=64, d=8)
    packed = zstandard.ZstdCompressor().compress(held.as_bytes())
    press = zstandard.ZstdCompressor(dict_data=held)
    (tmp_path / "a.warc.zst").write_bytes(
        struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed + b"".join(map(press.compress, made[:30]))
    )
    (tmp_path / "b.warc.zst").write_bytes(b"".join(map(zstandard.ZstdCompressor().compress, made[30:])))
    got = warc.read_warc(spark, str(tmp_path), payloads=False).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload) for r in got) == [(i, i * 9, None) for i in range(60)]


def test_damage_is_noticed(spark, archive):
    path = archive([(i, "u", f"{i} " * 200) for i in range(20)], sample_bytes=1 << 30)
    name = max(glob.glob(f"{path}/part-*"), key=lambda f: len(open(f, "rb").read()))
    data = open(name, "rb").read()
    records = list(warc._unpacked(memoryview(data)))
    for broken in (records[0].replace(b"7", b"8").replace(b"0", b"1"), records[0][:-1]):
        with pytest.raises((ValueError, KeyError)):
            warc._parsed(broken)
    import zstandard

    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc._unpacked(memoryview(data[:-12])))
