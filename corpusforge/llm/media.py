"""Media columns: texts stored as 8-bit sample files, and signature sniffing over any bytes.

An Aho-Corasick automaton finds every magic number in one pass; format validators then confirm
structure and lengths, which corrects wrongly declared types and yields the exact extent of
embedded media, so that they can be carved out.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, lean, narrow, strings, tune

BLOCK, RATE = 64, 8000
WAV = "audio/wav"


# -- the stored form ---------------------------------------------------------------------------------------------------
def payload(text: str | None) -> bytes:
    raw = (text or "").encode("utf-8", "replace")
    return raw + bytes(BLOCK - len(raw) if len(raw) < BLOCK else -len(raw) % BLOCK)


def to_wav(samples: bytes, rate: int = RATE) -> bytes:
    """One channel of unsigned 8-bit samples in a RIFF container."""
    body = samples + b"\0" * (len(samples) & 1)
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(body), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(samples))
    return head + body


def from_wav(media: bytes) -> bytes:
    """The samples of the data chunk."""
    at = 12
    while at + 8 <= len(media):
        name, size = struct.unpack_from("<4sI", media, at)
        if name == b"data":
            return media[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("no data chunk")


# -- validators: the length of a well-formed file that begins at `at`, else None -------------------------------------------
def _riff(kind: bytes) -> Callable[[bytes, int], int | None]:
    def check(b: bytes, at: int) -> int | None:
        if len(b) < at + 12 or b[at + 8 : at + 12] != kind:
            return None
        end, x = at + 8 + struct.unpack_from("<I", b, at + 4)[0], at + 12
        if end > len(b):
            return None
        seen = set()
        while x + 8 <= end:
            name, size = struct.unpack_from("<4sI", b, x)
            seen.add(name)
            x += 8 + size + (size & 1)
        need = {b"WAVE": {b"fmt ", b"data"}, b"AVI ": {b"LIST"}}.get(kind, set())
        return end - at if x in (end, end + 1) and seen and need <= seen else None

    return check


def _png(b: bytes, at: int) -> int | None:
    x, first = at + 8, True
    while x + 12 <= len(b):
        size, name = struct.unpack_from(">I4s", b, x)
        end = x + 12 + size
        if end > len(b) or first != (name == b"IHDR") or zlib.crc32(b[x + 4 : end - 4]) != struct.unpack_from(">I", b, end - 4)[0]:
            return None
        if name == b"IEND":
            return end - at
        x, first = end, False
    return None


def _gif(b: bytes, at: int) -> int | None:
    if len(b) < at + 14:
        return None
    flags = b[at + 10]
    x = at + 13 + (3 << (flags & 7) + 1 if flags & 128 else 0)

    def blocks(x: int) -> int | None:
        while x < len(b):
            if not b[x]:
                return x + 1
            x += 1 + b[x]
        return None

    while x is not None and x < len(b):
        if b[x] == 0x3B:
            return x + 1 - at
        if b[x] == 0x21:
            x = blocks(x + 2)
        elif b[x] == 0x2C and x + 10 < len(b):
            local = b[x + 9]
            x = blocks(x + 11 + (3 << (local & 7) + 1 if local & 128 else 0))
        else:
            return None
    return None


def _jpeg(b: bytes, at: int) -> int | None:
    x, framed = at + 2, False
    while x + 4 <= len(b):
        if b[x] != 0xFF:
            return None
        kind = b[x + 1]
        if kind == 0xD9:
            return x + 2 - at if framed else None
        size = struct.unpack_from(">H", b, x + 2)[0]
        if size < 2:
            return None
        framed |= 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC)
        x += 2 + size
        if kind == 0xDA:  # entropy-coded data runs to the next marker
            while (x := b.find(b"\xff", x)) >= 0 and x + 1 < len(b) and (b[x + 1] == 0 or 0xD0 <= b[x + 1] <= 0xD7):
                x += 2
            if x < 0:
                return None
    if x + 2 <= len(b) and b[x : x + 2] == b"\xff\xd9" and framed:
        return x + 2 - at
    return None


def _bmp(b: bytes, at: int) -> int | None:
    if len(b) < at + 54:
        return None
    size, zero, offset, head = struct.unpack_from("<IIII", b, at + 2)
    planes, depth = struct.unpack_from("<HH", b, at + 26)
    ok = zero == 0 and head in (40, 108, 124) and 14 + head <= offset <= size and at + size <= len(b) and planes == 1 and depth in (1, 4, 8, 16, 24, 32)
    return size if ok else None


def _gzip(b: bytes, at: int) -> int | None:
    stream, view, x = zlib.decompressobj(31), memoryview(b), at
    try:
        while x < len(b) and not stream.eof:
            block = view[x : x + (1 << 14)]
            x += len(block)
            stream.decompress(block, 1 << 20)
            while stream.unconsumed_tail and not stream.eof:
                stream.decompress(stream.unconsumed_tail, 1 << 20)
    except zlib.error:
        return None
    return x - at - len(stream.unused_data) if stream.eof else None


class Ends:
    """Where the marks stand that end archives and documents: sought once in all bytes, however many begin there."""

    def __init__(self):
        self.of: bytes | None = None

    def look(self, b: bytes) -> "Ends":
        if self.of is not b:
            self.of = b
            self.archives: dict[int, int] = {}  # by where the archive begins; the first end of each
            for m in re.finditer(rb"PK\x05\x06", b):
                end = m.start()
                if end + 22 <= len(b):
                    size, offset, note = struct.unpack_from("<IIH", b, end + 12)
                    if end + 22 + note <= len(b) and (not size or b[end - size : end - size + 4] == b"PK\x01\x02"):
                        self.archives.setdefault(end - size - offset, end + 22 + note)
            at = lambda mark: [m.start() for m in re.finditer(mark, b)]
            self.heads, self.finals, self.tables = at(b"%PDF-"), at(b"%%EOF"), at(b"startxref")
        return self


ENDS = Ends()


def _zip(b: bytes, at: int) -> int | None:
    end = ENDS.look(b).archives.get(at)
    return end - at if end is not None else None


def _pdf(b: bytes, at: int) -> int | None:
    """Up to the last end mark before the next document begins, so updates that follow count, with a table of places before it."""
    if not (len(b) > at + 7 and b[at + 5 : at + 6].isdigit()):
        return None
    ends = ENDS.look(b)
    k = bisect_right(ends.heads, at)
    last = bisect_left(ends.finals, ends.heads[k] if k < len(ends.heads) else len(b)) - 1
    if last < 0 or ends.finals[last] < at:
        return None
    table = bisect_left(ends.tables, ends.finals[last]) - 1
    return ends.finals[last] + 5 - at if table >= 0 and ends.tables[table] > at else None


def _crc_table(bits: int, polynomial: int) -> list[int]:
    """Check sums of single bytes, highest bit first."""
    top, mask, out = 1 << bits - 1, (1 << bits) - 1, []
    for byte in range(256):
        c = byte << bits - 8
        for _ in range(8):
            c = (c << 1 ^ polynomial if c & top else c << 1) & mask
        out.append(c)
    return out


CRC8, CRC16 = _crc_table(8, 0x07), _crc_table(16, 0x8005)


def _flac_header(b: bytes, x: int) -> tuple[int, int] | None:
    """(length of a frame's header, its samples), if its check sum is right."""
    if x + 6 > len(b) or b[x] != 0xFF or b[x + 1] & 0xFE != 0xF8:
        return None
    size, rate, lead = b[x + 2] >> 4, b[x + 2] & 15, b[x + 4]
    number = 1 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length()
    more = {6: 1, 7: 2}.get(size, 0)
    end = x + 4 + number + more + {12: 1, 13: 2, 14: 2}.get(rate, 0)
    if not size or rate == 15 or 0x80 <= lead < 0xC0 or end >= len(b):
        return None
    check = 0
    for byte in b[x:end]:
        check = CRC8[check ^ byte]
    if check != b[end]:
        return None
    own = int.from_bytes(b[x + 4 + number : x + 4 + number + more], "big") + 1
    return end + 1 - x, own if more else 192 if size == 1 else 576 << size - 2 if size < 6 else 256 << size - 8


def _flac(b: bytes, at: int) -> int | None:
    """Up to the end of the last whole frame. A frame ends where its check sum comes out and the next one begins, or, if it holds the last of the
    samples that the stream announces or nothing follows, where its check sum comes out first."""
    x, first, total, least = at + 4, True, 0, 0
    while x + 4 <= len(b):
        kind, size, last = b[x] & 127, int.from_bytes(b[x + 1 : x + 4], "big"), b[x] & 128
        if first and (kind != 0 or size != 34) or x + 4 + size > len(b):
            return None
        if first:
            least, total = int.from_bytes(b[x + 8 : x + 11], "big"), int.from_bytes(b[x + 17 : x + 22], "big") & (1 << 36) - 1
        x, first = x + 4 + size, False
        if last:
            break
    else:
        return None
    done = 0
    while (not total or done < total) and (head := _flac_header(b, x)):
        check, end, done = 0, None, done + head[1]
        for y in range(x, len(b)):
            check = (check << 8 & 0xFFFF) ^ CRC16[check >> 8 ^ b[y]]
            size = y + 1 - x
            if not check and size >= max(head[0] + 2, least) and (y + 1 == len(b) or total and done >= total or _flac_header(b, y + 1)):
                end = y + 1
                break
        if end is None:
            break
        x = end
    return x - at


#: Magic numbers and their formats, fixed values.
SIGNATURES: list[tuple[bytes, str, Callable[[bytes, int], int | None]]] = [
    (b"RIFF", WAV, _riff(b"WAVE")),
    (b"RIFF", "image/webp", _riff(b"WEBP")),
    (b"RIFF", "video/avi", _riff(b"AVI ")),
    (b"\x89PNG\r\n\x1a\n", "image/png", _png),
    (b"GIF87a", "image/gif", _gif),
    (b"GIF89a", "image/gif", _gif),
    (b"\xff\xd8\xff", "image/jpeg", _jpeg),
    (b"BM", "image/bmp", _bmp),
    (b"\x1f\x8b\x08", "application/gzip", _gzip),
    (b"PK\x03\x04", "application/zip", _zip),
    (b"%PDF-", "application/pdf", _pdf),
    (b"fLaC", "audio/flac", _flac),
]


@lru_cache(1)
def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for magic in {m for m, *_ in SIGNATURES}:
        a.add_word(magic.decode("latin-1"), magic)
    a.make_automaton()
    return a


def sniff(data: bytes) -> list[tuple[int, int, str]]:
    """(start, length, type) of every well-formed medium, outermost first; one inside another is reported too."""
    found = []
    for last, magic in automaton().iter(data.decode("latin-1")):
        start = last + 1 - len(magic)
        for m, kind, check in SIGNATURES:
            if m == magic and (size := check(data, start)) is not None:
                found.append((start, size, kind))
    return sorted(found, key=lambda x: (x[0], -x[1], x[2]))


def carve(data: bytes) -> list[tuple[str, bytes]]:
    """Embedded media: everything well-formed that doesn't begin at 0, or ends before the data does."""
    return [(kind, data[a : a + n]) for a, n, kind in sniff(data) if a or n < len(data)]


def sniff_media(rows: DataFrame, id: str = "media_id", data: str = "data", declared: str | None = None) -> DataFrame:
    """Returns id, declared, type (what stands at the front; null if nothing known does), corrected, embedded array<struct<start, length, type, sha256>>.

    Null or empty bytes have no type and nothing embedded. Other columns are ignored.
    """
    tune(rows.sparkSession)
    df = narrow(rows, id=id, data=data).withColumn("declared", F.lit(None).cast("string")) if declared is None else narrow(rows, id=id, data=data, declared=declared)
    inner = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("type", pa.string()), ("sha256", pa.string())])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            said, kinds, fixed, inside = strings(batch, "declared"), [], [], []
            for b, d in zip(strings(batch, "data"), said):
                media = sniff(b) if b else []
                kind = next((k for a, _, k in media if a == 0), None)
                kinds.append(kind)
                fixed.append(kind is not None and kind != d)
                inside.append([{"start": a, "length": n, "type": k, "sha256": hashlib.sha256(b[a : a + n]).hexdigest()} for a, n, k in media if a or n < len(b)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(said, pa.string()), pa.array(kinds, pa.string()), pa.array(fixed, pa.bool_()), pa.array(inside, pa.list_(inner))], names=[id, "declared", "type", "corrected", "embedded"])

    kind = df.schema["id"].dataType.simpleString()
    return df.select("id", "data", "declared").mapInArrow(lean(run), f"`{id}` {kind}, declared string, type string, corrected boolean, embedded array<struct<start:bigint,length:bigint,type:string,sha256:string>>")


def features(samples: bytes, media: list[tuple[int, int, str]]) -> str:
    """Type as sniffed, samples, mean, energy, zero crossings about the middle, distinct values, embedded media."""
    x = np.frombuffer(samples, np.uint8)
    wide = x.astype(np.int64)
    above = x >= 128
    kind = next((k for a, _, k in media if a == 0), "unknown")
    return f"{kind};n={len(x)};mean={int(wide.sum()) // len(x)};energy={int((wide * wide).sum())};crossings={int((above[1:] != above[:-1]).sum())};values={int((np.bincount(x, minlength=256) > 0).sum())};embedded={sum(a > 0 for a, *_ in media)}"


def store_texts(documents: DataFrame, id: str = "doc_id", text: str = "text", declared: str | None = None, keep: bool = True) -> DataFrame:
    """Stores whole texts as 8-bit sample files, sniffs them, carves the medium out and reads the samples back.

    declared names a column of types that the rows claim; a wrong or missing one is corrected to what the bytes are. Returns id, n_bytes, payload_bytes,
    payload_sha256, tail_crc32, media_bytes, media_sha256, feature, type, corrected, and with keep the medium itself. A null text counts as empty, which is stored as one block of zeros. Equal
    texts give equal media, repeated rows stay. Texts of any length that a batch can hold are stored whole; the format ends at 4 GiB.
    An empty table gives an empty result; other columns are ignored.
    """
    tune(documents.sparkSession)
    df = narrow(documents, id=id, text=text, declared=declared) if declared else narrow(documents, id=id, text=text).withColumn("declared", F.lit(None).cast("string"))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for t, said in zip(strings(batch, "text"), strings(batch, "declared")):
                media = to_wav(payload(t))
                found = sniff(media)
                start, size, kind = next(x for x in found if x[0] == 0)
                back = from_wav(media[start : start + size])
                n = len((t or "").encode("utf-8", "replace"))
                rows.append((n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), features(back, found), kind, kind != said, media))
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 10, types)]
            n = 10 if keep else 9
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns[:n]], names=[id, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "type", "corrected", "media"][: n + 1])

    kind = df.schema["id"].dataType.simpleString()
    return df.mapInArrow(lean(run), f"`{id}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, type string, corrected boolean" + ", media binary" * keep)
