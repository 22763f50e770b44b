"""Media columns: signature sniffing, with declared types corrected and embedded media carved.

An Aho-Corasick automaton finds all magic bytes in one pass; a validator for each format confirms the structure at a hit and gives its length.
A type is told by the format confirmed at the start of the bytes; further confirmed hits are embedded media, the outermost only (what lies in a confirmed one
is not validated). End marks are found by the same automaton, once for all hits, and chains of blocks remember where they lead, so that many magic bytes
in one long text are no more work than one. Text bytes are stored losslessly as 8-bit mono samples of a wave file, whose reader goes by what sniffing confirms and
not by the declared type.

Defined cases: null bytes are empty; empty or unknown bytes have type application/octet-stream and no embedded media; a format whose structure is cut off or
whose lengths disagree is not confirmed; equal bytes give equal values; repeated rows and rows without doc_id are rows of their own; an empty table gives an
empty result. text_media reads only doc_id and text; sniffed keeps all columns and raises ValueError where one has the name of a result column.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import groupby

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import unused

UNKNOWN = "application/octet-stream"
UNIT = 64


class Bytes:
    """One value's bytes with the positions of its end marks and the ends of chains of blocks already walked."""

    def __init__(self, data: bytes, marks: dict[bytes, list[int]]):
        self.data, self.marks = data, marks
        self.chains: dict[str, dict[int, tuple]] = {}
        self._zip_ends: dict[int, int] | None = None

    def chain(self, kind: str, p: int, step: Callable[[int], tuple[int, bool]]) -> tuple[int, bool]:
        """Follow step, from a position to (the next one, or -1 at the end; a mark to keep), to the last position, and whether any mark was set.

        The last position is given as the value of the step that ended there.
        """
        known, path = self.chains.setdefault(kind, {}), []
        while p not in known:
            following, mark = step(p)
            if following < 0:
                known[p] = (p, mark)
            else:
                path.append((p, mark))
                p = following
        end, marked = known[p]
        for q, mark in reversed(path):
            marked |= mark
            known[q] = (end, marked)
        return end, marked

    def zip_end(self, at: int) -> int:
        """End of the archive beginning at `at`: its end-of-directory record says where the archive begins."""
        if self._zip_ends is None:
            self._zip_ends, b = {}, self.data
            for p in self.marks.get(ZIP_END, []):
                if p + 22 <= len(b):
                    size, offset, comment = struct.unpack_from("<IIH", b, p + 12)
                    if p + 22 + comment <= len(b):
                        self._zip_ends.setdefault(p - offset - size, p + 22 + comment)
        return self._zip_ends.get(at, 0)


ZIP_END, PDF_START, PDF_END = b"PK\x05\x06", b"startxref", b"%%EOF"


def _png(x: Bytes, at: int) -> int:
    """End of the IEND chunk; the chunks lead there, and every chunk's checksum holds."""
    b = x.data
    if b[at + 8 : at + 16] != b"\x00\x00\x00\rIHDR":
        return 0

    def step(p: int) -> tuple[int, bool]:
        if p + 12 > len(b):
            return -1, False
        n, kind = struct.unpack_from(">I4s", b, p)
        if kind == b"IEND" or p + 12 + n > len(b) or not kind.isalpha():
            return -1, False
        return p + 12 + n, False

    last, _ = x.chain("png", at + 8, step)
    if b[last + 4 : last + 8] != b"IEND":
        return 0
    p, sums = at + 8, x.chains.setdefault("png sums", {})
    while p <= last:
        n = struct.unpack_from(">I", b, p)[0]
        if p + 12 + n > len(b):
            return 0
        if p not in sums:
            sums[p] = (zlib.crc32(memoryview(b)[p + 4 : p + 8 + n]) == struct.unpack_from(">I", b, p + 8 + n)[0],)
        if not sums[p][0]:
            return 0
        p += 12 + n
    return p - at


def _jpeg(x: Bytes, at: int) -> int:
    """Segments with their lengths up to the end marker."""
    b = x.data
    p, seen = at + 2, False
    while p + 4 <= len(b) and b[p] == 0xFF:
        marker = b[p + 1]
        if marker == 0xD9:
            return p + 2 - at if seen else 0
        n = struct.unpack_from(">H", b, p + 2)[0]
        if n < 2 or marker in (0x00, 0xFF):
            return 0
        p += 2 + n
        if marker == 0xDA:
            seen = True
            while True:  # entropy-coded data: FF is followed by 00 or a restart marker
                p = b.find(b"\xff", p)
                if p < 0 or p + 1 >= len(b):
                    return 0
                if b[p + 1] != 0 and not 0xD0 <= b[p + 1] <= 0xD7:
                    break
                p += 2
    return p + 2 - at if seen and b[p : p + 2] == b"\xff\xd9" else 0


def _gif(x: Bytes, at: int) -> int:
    """Blocks and sub-blocks up to the trailer."""
    b = x.data

    def blocks(p: int) -> int:
        return x.chain("gif blocks", p, lambda q: (q + b[q] + 1, False) if q < len(b) and b[q] else (-1, False))[0] + 1

    def step(p: int) -> tuple[int, bool]:
        if p < len(b) and b[p] == 0x21:
            return blocks(p + 2), False
        if p + 10 <= len(b) and b[p] == 0x2C:
            return blocks(p + 11 + (3 << ((b[p + 9] & 7) + 1) if b[p + 9] & 128 else 0)), False
        return -1, False

    if at + 13 > len(b):
        return 0
    flags = b[at + 10]
    end, _ = x.chain("gif", at + 13 + (3 << ((flags & 7) + 1) if flags & 128 else 0), step)
    return end + 1 - at if end < len(b) and b[end] == 0x3B else 0


def _bmp(x: Bytes, at: int) -> int:
    """File size, zero reserved fields, a known header and an offset inside the file."""
    b = x.data
    if at + 30 > len(b):
        return 0
    size, reserved, offset, header = struct.unpack_from("<IIII", b, at + 2)
    planes, depth = struct.unpack_from("<HH", b, at + 26) if header >= 40 else struct.unpack_from("<HH", b, at + 22)
    fits = reserved == 0 and header in (12, 40, 52, 56, 64, 108, 124) and planes == 1 and depth in (1, 4, 8, 16, 24, 32)
    return size if fits and 14 + header <= offset <= size <= len(b) - at else 0


def _riff(x: Bytes, at: int, form: bytes, needs: tuple[bytes, ...]) -> int:
    """RIFF size, form and the chunk lengths inside it."""
    b = x.data
    if at + 12 > len(b) or b[at + 8 : at + 12] != form:
        return 0
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    p, kinds = at + 12, []
    while p + 8 <= end <= len(b):
        kinds.append(b[p : p + 4])
        n = struct.unpack_from("<I", b, p + 4)[0]
        p += 8 + n + (n & 1)
    return end - at if p == end <= len(b) and all(k in kinds for k in needs) else 0


def _wav(x: Bytes, at: int) -> int:
    return _riff(x, at, b"WAVE", (b"fmt ", b"data"))


def _webp(x: Bytes, at: int) -> int:
    return _riff(x, at, b"WEBP", ())


def _zip(x: Bytes, at: int) -> int:
    """Ends with the end-of-directory record whose directory lies just before it."""
    end = x.zip_end(at)
    return end - at if end > at else 0


def _gzip(x: Bytes, at: int) -> int:
    """One member that inflates and passes its checksum."""
    b = x.data
    tool = zlib.decompressobj(31)
    try:
        p = at
        while p < len(b) and not tool.eof:
            tool.decompress(b[p : p + 65536], 1 << 20)
            while tool.unconsumed_tail:
                tool.decompress(tool.unconsumed_tail, 1 << 20)
            p += 65536
    except zlib.error:
        return 0
    return min(p, len(b)) - len(tool.unused_data) - at if tool.eof else 0


def _pdf(x: Bytes, at: int) -> int:
    """A cross-reference pointer and the last end mark after it."""
    starts, ends = x.marks.get(PDF_START, []), x.marks.get(PDF_END, [])
    k = bisect_right(starts, at)
    return ends[-1] + len(PDF_END) - at if ends and k < len(starts) and starts[k] < ends[-1] else 0


def _ogg(x: Bytes, at: int) -> int:
    """Pages one after the other, from a first to a last one of the stream."""
    b = x.data

    def page_end(p: int) -> int:
        """End of the page at p, or -1 where none begins."""
        if b[p : p + 4] != b"OggS" or p + 27 > len(b) or b[p + 4]:
            return -1
        return p + 27 + b[p + 26] + sum(b[p + 27 : p + 27 + b[p + 26]])

    last, _ = x.chain("ogg", at, lambda p: (-1, False) if page_end(p) < 0 or b[p + 5] & 4 else (page_end(p), False))
    end = page_end(last)
    return end - at if end <= len(b) and end > 0 and b[last + 5] & 4 else 0


def _mp4(x: Bytes, at: int) -> int:
    """Boxes of known kinds after the file type box, whose size stands before its name."""
    b = x.data

    def step(p: int) -> tuple[int, bool]:
        if p + 8 > len(b):
            return -1, False
        n, kind = struct.unpack_from(">I4s", b, p)
        if n < 8 or kind not in BOXES:
            return -1, False
        return p + n, kind in (b"moov", b"moof")

    end, playable = x.chain("mp4", at, step)
    return end - at if playable and end <= len(b) else 0


BOXES = frozenset((b"ftyp", b"moov", b"mdat", b"free", b"skip", b"moof", b"mfra", b"uuid", b"meta", b"sidx", b"styp", b"wide"))


def _flac(x: Bytes, at: int) -> int:
    """A stream-information block of 34 bytes and the metadata after it; frames carry no length, so the stream runs to the end."""
    b = x.data
    p, kind = at + 4, None
    while p + 4 <= len(b):
        head, n = b[p], int.from_bytes(b[p + 1 : p + 4], "big")
        if kind is None and (head & 127 != 0 or n != 34):
            return 0
        kind, p = head & 127, p + 4 + n
        if head & 128:
            return len(b) - at if p < len(b) and b[p] == 0xFF else 0
    return 0


#: Fixed values: (magic bytes, their offset from the start, type, validator).
FORMATS: tuple[tuple[bytes, int, str, Callable[[Bytes, int], int]], ...] = (
    (b"\x89PNG\r\n\x1a\n", 0, "image/png", _png),
    (b"\xff\xd8\xff", 0, "image/jpeg", _jpeg),
    (b"GIF87a", 0, "image/gif", _gif),
    (b"GIF89a", 0, "image/gif", _gif),
    (b"BM", 0, "image/bmp", _bmp),
    (b"RIFF", 0, "audio/wav", _wav),
    (b"RIFF", 0, "image/webp", _webp),
    (b"PK\x03\x04", 0, "application/zip", _zip),
    (b"\x1f\x8b\x08", 0, "application/gzip", _gzip),
    (b"%PDF-", 0, "application/pdf", _pdf),
    (b"OggS", 0, "application/ogg", _ogg),
    (b"ftyp", 4, "video/mp4", _mp4),
    (b"fLaC", 0, "audio/flac", _flac),
)


def automaton() -> ahocorasick.Automaton:
    """All magic bytes and end marks; the automaton works on characters, one a byte."""
    found = ahocorasick.Automaton()
    by_magic: dict[bytes, list[int]] = {m: [] for m in (ZIP_END, PDF_START, PDF_END)}
    for k, (magic, *_) in enumerate(FORMATS):
        by_magic.setdefault(magic, []).append(k)
    for magic, ks in by_magic.items():
        found.add_word(magic.decode("latin-1"), (magic, ks))
    found.make_automaton()
    return found


def sniff(data: bytes, magic: ahocorasick.Automaton) -> tuple[str, int, list[tuple[str, int, int]]]:
    """(type, length of the confirmed structure, embedded media as (type, offset, length)); of several formats confirmed at one place the longest."""
    hits = array("q")  # position and format in one number each
    marks: dict[bytes, list[int]] = {}
    for end, (word, formats) in magic.iter(data.decode("latin-1")):
        at = end + 1 - len(word)
        if not formats:
            marks.setdefault(word, []).append(at)
        hits.extend((at - FORMATS[k][1]) * len(FORMATS) + k for k in formats if at >= FORMATS[k][1])
    x = Bytes(data, marks)
    kind, length, embedded, free = UNKNOWN, 0, [], 0
    for at, group in groupby(map(int, np.sort(np.frombuffer(hits, np.int64)) if hits else ()), key=lambda h: h // len(FORMATS)):
        if at < free:
            continue
        n, name = min((-FORMATS[h % len(FORMATS)][3](x, at), FORMATS[h % len(FORMATS)][2]) for h in group)
        if not n:
            continue
        if at == 0:
            kind, length = name, -n
            # What lies in a compressed or indexed container is its content; samples may hold foreign media.
            free = 0 if name == "audio/wav" else length
        else:
            embedded.append((name, at, -n))
            free = at - n
    return kind, length, embedded


def store_wave(payload: bytes, rate: int = 16_000) -> bytes:
    """The payload as unsigned 8-bit mono samples (its length is even)."""
    head = struct.pack("<4sIHHIIHH4sI", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload))
    return struct.pack("<4sI4s", b"RIFF", 4 + len(head) + len(payload), b"WAVE") + head + payload


def read_wave(data: bytes) -> bytes:
    """The samples, found by walking the chunks."""
    p = 12
    while p + 8 <= len(data):
        kind, n = struct.unpack_from("<4sI", data, p)
        if kind == b"data":
            return data[p + 8 : p + 8 + n]
        p += 8 + n + (n & 1)
    raise ValueError("no samples")


def padded(raw: bytes) -> bytes:
    return raw + bytes(max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def wave_feature(samples: bytes, kind: str, length: int, embedded: list[tuple[str, int, int]]) -> str:
    """What sniffing found, then mean, deviation and crossings of the middle line of the samples."""
    x = np.frombuffer(samples, np.uint8)
    n, total, squares = len(x), int(x.sum(dtype=np.int64)), int(np.bincount(x, minlength=256) @ np.arange(256, dtype=np.int64) ** 2)
    crossings = int(np.count_nonzero((x[1:] >= 128) != (x[:-1] >= 128)))
    variance = squares / n - (total / n) ** 2
    inside = ",".join(f"{t}@{a}+{m}" for t, a, m in embedded)
    return f"type={kind};length={length};embedded=[{inside}];mean={total / n:.4f};variance={variance:.3f};crossings={crossings}"


def sniffed(media: DataFrame, data: str = "content", declared: str | None = None) -> DataFrame:
    """media with detected_type, corrected (whether the declared type was wrong), media_length, and embedded as array<struct<type, offset, length, content>>."""
    names = [c for c in ("detected_type", "corrected", "media_length", "embedded") if c in media.columns]
    if names:
        raise ValueError(f"media has columns named {names}")

    @F.pandas_udf("detected_type string, media_length long, embedded array<struct<type:string,offset:long,length:long,content:binary>>")
    def told(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        magic = automaton()
        for contents in batches:
            rows = []
            for raw in contents:
                raw = raw or b""
                kind, length, inner = sniff(raw, magic)
                rows.append((kind, length, [{"type": t, "offset": a, "length": n, "content": raw[a : a + n]} for t, a, n in inner]))
            yield pd.DataFrame(rows, columns=["detected_type", "media_length", "embedded"])

    name = unused(media, "told")
    found = media.withColumn(name, told(F.col(data).cast("binary")))
    corrected = F.col(f"{name}.detected_type") != (F.lower(F.trim(F.coalesce(F.col(declared), F.lit("")))) if declared else F.lit(UNKNOWN))
    return found.withColumns({"detected_type": F.col(f"{name}.detected_type"), "corrected": corrected, "media_length": F.col(f"{name}.media_length"), "embedded": F.col(f"{name}.embedded")}).drop(name)


def text_media(docs: DataFrame) -> DataFrame:
    """Every text stored as a wave file with a wrongly declared type, told by its signature, read back and described."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        magic = automaton()
        for f in frames:
            rows = []
            for text in f["text"]:
                raw = (text or "").encode("utf-8", "surrogatepass")
                stored = store_wave(padded(raw))
                kind, length, embedded = sniff(stored, magic)
                if kind != "audio/wav" or length != len(stored):
                    raise ValueError("the stored form was not recognised")
                back = read_wave(stored)
                rows.append(
                    (len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-UNIT:]), len(stored), hashlib.sha256(stored).hexdigest(), wave_feature(back, kind, length, embedded))
                )
            out = pd.DataFrame(rows, columns=["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])
            out.insert(0, "doc_id", f["doc_id"].to_numpy())
            yield out

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id string, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return rows.mapInPandas(run, schema).withColumn("doc_id", F.col("doc_id").cast("long"))
