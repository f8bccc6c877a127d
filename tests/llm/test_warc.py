import base64
import hashlib
import io
import struct

import pytest
import zstandard

from tessera.llm import warc as W
from tessera.llm.common import shared_folder

PAGES = [
    (3, "http://a/é x\r\ny", "<p>one</p>"), (1, "http://b", "<p>two</p>"), (2, None, "<p>one</p>"),
    (4, "http://c", None), (5, "http://d", ""), (6, "http://e", "z" * 300_000),
    (None, "http://f", "<p>one</p>"), (1, "http://b", "<p>two</p>"),
    (None, "http://g", "only\r\n\r\nhere: é"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return df.selectExpr("*", "'own' as payload", "'own' as digest", "1 as first_id")


@pytest.mark.parametrize("least", [0, 11])
def test_round_trip(pages, least):
    manifest = W.write_archives(pages, min_revisit_bytes=least)
    assert sum(r["records"] for r in manifest.collect()) == len(PAGES)
    got = {}
    for r in W.read_archives(manifest).collect():
        got.setdefault((r["page_id"], r["payload_digest"]), []).append(r)
    assert sum(map(len, got.values())) == len(PAGES)
    revisits = {(2, "<p>one</p>"): None, (3, "<p>one</p>"): 2, (None, "<p>one</p>"): 2, (5, ""): 4}
    for page_id, _, html in PAGES:
        row = got[page_id, digest(html)][0]
        assert row["payload_bytes"] == len((html or "").encode())
        first = revisits.get((page_id, html or "")) if least == 0 else None
        assert row["refers_to"] == first
        assert row["record_type"] == ("response" if first is None else "revisit")
        payload = None if row["payload"] is None else bytes(row["payload"]).decode()
        assert payload == (html or "" if first is None else None)
    assert got[3, digest("<p>one</p>")][0]["url"] == "http://a/%C3%A9%20x%0D%0Ay"


def test_files_stand_alone(pages):
    """The first frame is skippable and holds the dictionary; each record is one frame."""
    for row in W.write_archives(pages, file_bytes=1).collect():
        with open(row["path"].removeprefix("file://"), "rb") as file:
            data = file.read()
        assert len(data) == row["bytes"] and row["records"] == 1
        magic, size = struct.unpack("<II", data[:8])
        assert magic == 0x184D2A5D
        dictionary = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
        one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        record = one.decompressobj().decompress(data[8 + size :])
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: ") and record.endswith(b"\r\n\r\n")


def test_damage_is_noticed():
    record = W.make_record(1, "u", b"payload", None, False, "d")
    out = io.BytesIO(W.dictionary_frame(b"x") + zstandard.ZstdCompressor().compress(
        record.replace(b"payload", b"pAyload")))
    with pytest.raises(ValueError, match="damaged"):
        [W.parse_record(*r) for r in W.read_records(out)]
    short = io.BytesIO(W.dictionary_frame(b"x") + zstandard.ZstdCompressor().compress(record[:-9]))
    with pytest.raises(ValueError, match="ends within"):
        list(W.read_records(short))


def test_a_dictionary_is_trained_where_it_can_be():
    samples = [b"WARC/1.1 some header %d and the same body text again" % i * 20 for i in range(500)]
    assert W.build_dictionary(samples)[:4] == struct.pack("<I", 0xEC30A437)
    assert W.build_dictionary([b"ab"]) == b"ab" and W.build_dictionary([]) == b""


def test_empty_table(spark, pages):
    manifest = W.write_archives(pages.limit(0), folder=shared_folder(spark))
    assert manifest.collect() == [] and W.read_archives(manifest).collect() == []
