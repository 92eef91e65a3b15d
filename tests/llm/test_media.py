"""Round trips, validators and carving."""

import gzip
import io
import random
import struct
import time
import wave
import zipfile
import zlib

import pytest

from corpusforge.llm import media


def png() -> bytes:
    chunk = lambda n, d: struct.pack(">I", len(d)) + n + d + struct.pack(">I", zlib.crc32(n + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 1, 1, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"\0\0")) + chunk(b"IEND", b"")


def zipped() -> bytes:
    with zipfile.ZipFile(out := io.BytesIO(), "w") as z:
        z.writestr("a.txt", "hello")
    return out.getvalue()


BMP = b"BM" + struct.pack("<IIIIiiHHIIiiII", 58, 0, 54, 40, 1, 1, 1, 24, 0, 4, 0, 0, 0, 0) + b"\0\0\0\0"
GIF = b"GIF89a" + struct.pack("<HHBBB", 1, 1, 0x80, 0, 0) + b"\0" * 6 + b"," + struct.pack("<HHHHB", 0, 0, 1, 1, 0) + b"\x02\x02D\x01\0;"
JPEG = b"\xff\xd8\xff\xe0\0\x04ab\xff\xc0\0\x04cd\xff\xda\0\x04ef12\xff\0x\xff\xd9"
SAMPLES = {"image/png": png(), "image/bmp": BMP, "image/gif": GIF, "image/jpeg": JPEG, "application/zip": zipped(), "application/gzip": gzip.compress(b"x" * 99), "audio/wav": media.to_wav(b"abc")}


@pytest.mark.parametrize("kind", SAMPLES)
def test_sniff_and_carve(kind):
    data = SAMPLES[kind]
    assert (0, len(data), kind) in media.sniff(data)
    assert (kind, data) in media.carve(b"noise BM RIFF " + data + b" more")
    assert not [k for a, n, k in media.sniff(data[:-3]) if k == kind and a == 0]


def test_many_beginnings_take_time_in_proportion():
    for part in (b"%PDF-1 ", b"PK\x03\x04 ", b"\x1f\x8b\x08\x00 "):
        start = time.process_time()
        assert not media.sniff(part * (400_000 // len(part)))
        assert time.process_time() - start < 8


def test_updated_documents_end_at_their_last_mark():
    pdf = b"%PDF-1.4 x startxref 1 %%EOF update startxref 2 %%EOF"
    assert [(k, d) for k, d in media.carve(b"ab " + pdf + b" tail " + pdf)] == [("application/pdf", pdf)] * 2


def test_wav_is_wav():
    with wave.open(io.BytesIO(media.to_wav(b"abc"))) as w:
        assert (w.getnchannels(), w.getsampwidth(), w.readframes(9)) == (1, 1, b"abc")


def test_payload_lengths():
    assert [len(media.payload(t)) for t in (None, "", "a", "x" * 64, "x" * 65)] == [64, 64, 64, 64, 128]


def test_store_texts(spark):
    texts = [None, "", "RIFF BM PK\x03\x04", "é" * 1000, "same", "same"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, type int")
    rows = {r.doc_id: r for r in media.store_texts(df).collect()}
    for i, t in enumerate(texts):
        r, raw = rows[i], (t or "").encode()
        assert media.from_wav(bytes(r.media)) == media.payload(t) and r.n_bytes == len(raw) and r.payload_bytes == len(media.payload(t)) and r.tail_crc32 == zlib.crc32(media.payload(t)[-64:])
        assert r.type == "audio/wav" and r.corrected and r.media_bytes == len(r.media)
    assert rows[4].media_sha256 == rows[5].media_sha256 and rows[4].feature == rows[5].feature
    assert media.store_texts(df.limit(0)).count() == 0


def test_sniff_media_corrects_types(spark):
    df = spark.createDataFrame([(1, bytearray(png()), "image/jpeg"), (2, bytearray(b"text"), "text/plain"), (3, None, None), (4, bytearray(b"xx" + GIF), "image/gif")], "media_id long, data binary, declared string")
    found = {r.media_id: r for r in media.sniff_media(df, declared="declared").collect()}
    assert (found[1].type, found[1].corrected) == ("image/png", True) and found[2].type is None and found[3].embedded == []
    assert [(e.start, e.type) for e in found[4].embedded] == [(2, "image/gif")]


def flac_frame(number, body, size_code=8):
    head = bytes([0xFF, 0xF8, size_code << 4, 0, number])
    check = 0
    for byte in head:
        check = media.CRC8[check ^ byte]
    frame, check = head + bytes([check]) + body, 0
    for byte in frame:
        check = (check << 8 & 0xFFFF) ^ media.CRC16[check >> 8 ^ byte]
    return frame + check.to_bytes(2, "big")


@pytest.mark.parametrize(("total", "behind"), [(768, b""), (768, b"tail \xff\xf8 and more"), (0, b""), (0, b"no frame")])
def test_flac_streams_end_with_their_last_frame(total, behind):
    rng = random.Random(total)
    info = bytes(13) + total.to_bytes(5, "big") + bytes(16)
    frames = b"".join(flac_frame(k, rng.randbytes(40 + 7 * k)) for k in range(3))
    stream = b"fLaC" + bytes([0x80, 0, 0, 34]) + info + frames
    found = [(a, n) for a, n, kind in media.sniff(b"front" + stream + behind) if kind == "audio/flac"]
    whole = len(stream) if total or not behind else len(stream) - len(flac_frame(2, bytes(54)))  # of unknown length, the last frame can't be told from what follows
    assert found == [(5, whole)]
    assert [n for _, n, _ in media.sniff(b"fLaC" + bytes([0x80, 0, 0, 34]) + info + b"xyz")] == [42]


def test_declared_types_are_corrected(spark):
    rows = [(1, "a", media.WAV), (2, "b", "image/png"), (3, "c", None), (4, None, media.WAV)]
    out = media.store_texts(spark.createDataFrame(rows, "doc_id long, text string, said string"), declared="said").collect()
    assert {r.doc_id: (r.type, r.corrected) for r in out} == {1: (media.WAV, False), 2: (media.WAV, True), 3: (media.WAV, True), 4: (media.WAV, False)}
