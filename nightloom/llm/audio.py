"""MPEG audio columns: payloads stored in the ancillary bytes of silent Layer III frames, and a reader for such streams."""

from __future__ import annotations

import hashlib
import struct
import zlib
from fractions import Fraction
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from .common import add_columns, table

# Fixed values of the MPEG audio header: kbit/s by (MPEG-1?, layer) and index, and samples a second by version.
BITRATES = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}  # MPEG-1, MPEG-2, MPEG-2.5

#: The streams written here: MPEG-1 Layer III, mono, 32 kHz, with checksum.
WRITE_RATE, HEAD = 32000, 4 + 2 + 17


def crc16(data: bytes) -> int:
    """The checksum of MPEG audio: polynomial 0x8005, start 0xFFFF, high bit first."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = ((crc << 1) ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


crc_of = lru_cache(4096)(crc16)


@lru_cache(65536)
def header(word: int) -> dict | None:
    """The fields of a 32-bit frame header, or None if it isn't one (free-format streams are not taken)."""
    version, layer = word >> 19 & 3, 4 - (word >> 17 & 3)
    rate, hertz = word >> 12 & 15, word >> 10 & 3
    if word >> 21 != 0x7FF or version == 1 or layer == 4 or rate in (0, 15) or hertz == 3 or word & 3 == 2:
        return None
    one = version == 3
    kbps, sr, pad, mono = BITRATES[one, layer][rate], RATES[version][hertz], word >> 9 & 1, word >> 6 & 3 == 3
    if layer == 1:
        # the checksum covers the bit allocation: 4 bits a subband and channel, one channel's from the joint bound on
        size, samples, side = (12 * kbps * 1000 // sr + pad) * 4, 384, 16 if mono else 16 + 2 * ((word >> 4 & 3) + 1) if word >> 6 & 3 == 1 else 32
    else:
        samples = 1152 if layer == 2 or one else 576
        size = samples // 8 * kbps * 1000 // sr + pad
        side = 0 if layer == 2 else (17 if mono else 32) if one else (9 if mono else 17)
    return {"size": size, "samples": samples, "rate": sr, "kbps": kbps, "layer": layer, "side": side, "crc": not word >> 16 & 1, "version": version, "same": (version, layer, hertz)}


def syncsafe(data: bytes) -> int:
    return data[0] << 21 | data[1] << 14 | data[2] << 7 | data[3]


def tags_before(data: bytes) -> tuple[int, dict[str, bytes]]:
    """End of the ID3v2 tags at the start, and their frames."""
    at, frames = 0, {}
    while data[at : at + 3] == b"ID3" and len(data) >= at + 10 and max(data[at + 6 : at + 10]) < 128:
        size, major = syncsafe(data[at + 6 : at + 10]), data[at + 3]
        x, end = at + 10, min(len(data), at + 10 + size)
        if data[at + 5] & 64 and x + 4 <= end:  # an extended header, whose size counts itself from version 4 on
            x += syncsafe(data[x : x + 4]) if major >= 4 else 4 + int.from_bytes(data[x : x + 4], "big")
        while x + 10 <= end and data[x : x + 4].strip(b"\0"):
            raw = data[x + 4 : x + 8]
            n = syncsafe(raw) if major >= 4 else int.from_bytes(raw, "big")
            frames[data[x : x + 4].decode("latin-1")] = data[x + 10 : min(end, x + 10 + n)]
            x += 10 + n
        at = at + 10 + size + (10 if data[at + 5] & 16 else 0)
    return min(at, len(data)), frames


def read_stream(data: bytes | None) -> dict:
    """What an MPEG audio stream holds.

    Headers are searched byte by byte until one is followed by another of the same kind (or by the end or a
    tag); bytes passed over count as ``skipped``. ID3v2 and ID3v1 tags, Xing/Info and VBRI tables are
    parsed; the checksums of Layer I and III frames are verified (what Layer II's covers hangs on its bit allocation). ``seek`` has each audio frame's offset. The
    duration is exact: samples over the sample rate. Null or other bytes give no frames. ``TAG`` 128 bytes before the end
    starts an ID3v1 tag unless it lies in frames that reach the end.
    """
    data = data or b""
    at, tags = tags_before(data)
    end = len(data) - 128 if len(data) >= at + 128 and data[-128:-125] == b"TAG" else len(data)
    out = {"tags": tags, "id3v1": False, "seek": [], "bad_crc": 0, "skipped": 0, "samples": 0, "rate": 0, "table": None, "ancillary": []}
    word = lambda x: int.from_bytes(data[x : x + 4], "big") if x + 4 <= end else 0
    locked = None
    while at + 4 <= end:
        h = header(word(at))
        if h is not None and locked in (None, h["same"]) and at + h["size"] > end and frames_reach_end(data, at):
            end = len(data)
        if h is None or at + h["size"] > end or (locked is not None and h["same"] != locked):
            at = find_sync(data, at + 1, end, out)
            continue
        after = at + h["size"]
        if locked is None and after + 4 <= end and ((n := header(word(after))) is None or n["same"] != h["same"]):
            at = find_sync(data, at + 1, end, out)
            continue
        locked = h["same"]
        body = at + 4 + 2 * h["crc"]
        if h["crc"] and h["layer"] != 2 and crc_of(data[at + 2 : at + 4] + data[body : body + h["side"]]) != int.from_bytes(data[at + 4 : at + 6], "big"):
            out["bad_crc"] += 1
        main = body + h["side"]
        if out["table"] is None and not out["seek"] and h["layer"] == 3 and (found := vbr_table(data, at, main, after)):
            out["table"] = found
        else:
            out["seek"].append(at)
            out["samples"] += h["samples"]
            out["rate"] = h["rate"]
            out["ancillary"].append((main, after))
        at = after
    out["id3v1"] = end < len(data)
    out["skipped"] += max(0, end - at) if at < end else 0
    out["duration"] = Fraction(out["samples"], out["rate"]) if out["rate"] else Fraction(0)
    return out


def frames_reach_end(data: bytes, at: int) -> bool:
    """Whether frames of one kind follow one another from ``at`` exactly to the end of the data."""
    kind = None
    while at + 4 <= len(data) and (h := header(int.from_bytes(data[at : at + 4], "big"))) is not None and kind in (None, h["same"]):
        kind, at = h["same"], at + h["size"]
    return at == len(data)


def find_sync(data: bytes, at: int, end: int, out: dict) -> int:
    found = data.find(b"\xff", at, end)
    found = end if found < 0 else found
    out["skipped"] += found - at + 1
    return found


def vbr_table(data: bytes, at: int, main: int, end: int) -> dict | None:
    """The Xing/Info or VBRI table of a stream's first frame."""
    if data[main : main + 4] in (b"Xing", b"Info"):
        flags, x, found = int.from_bytes(data[main + 4 : main + 8], "big"), main + 8, {"kind": data[main : main + 4].decode()}
        for bit, name, n in ((1, "frames", 4), (2, "bytes", 4), (4, "toc", 100), (8, "quality", 4)):
            if flags & bit:
                found[name] = data[x : x + n] if name == "toc" else int.from_bytes(data[x : x + n], "big")
                x += n
        return found if x <= end else None
    x = at + 36
    if data[x : x + 4] == b"VBRI" and x + 26 <= end:
        n_bytes, n_frames, entries, scale, width, per = struct.unpack(">IIHHHH", data[x + 10 : x + 26])
        return {"kind": "VBRI", "frames": n_frames, "bytes": n_bytes, "scale": scale, "entry": width, "per": per, "toc": data[x + 26 : x + 26 + entries * width]}
    return None


@lru_cache(16)
def frame_start(index: int) -> bytes:
    """Header, checksum and empty side information of a silent frame; no part of it decodes to sound."""
    head = (0x7FF << 21 | 3 << 19 | 1 << 17 | 0 << 16 | index << 12 | 2 << 10 | 3 << 6).to_bytes(4, "big")
    side = bytes(17)
    return head + crc16(head[2:] + side).to_bytes(2, "big") + side


def frame_size(index: int) -> int:
    return 144 * BITRATES[True, 3][index] * 1000 // WRITE_RATE


def write_stream(payload: bytes) -> bytes:
    """A variable-bitrate stream whose frames carry ``payload``: ID3v2.4 tag, Xing frame with seek table, frames."""
    full = frame_size(14) - HEAD
    start = frame_start(14)
    cut = len(payload) // full * full
    frames = [start + payload[x : x + full] for x in range(0, cut, full)]
    if rest := payload[cut:]:
        index = next(k for k in range(1, 15) if frame_size(k) - HEAD >= len(rest))
        frames.append(frame_start(index) + rest + bytes(frame_size(index) - HEAD - len(rest)))
    private = b"payload\0" + len(payload).to_bytes(8, "big")
    item = b"PRIV" + bytes([0, 0, 0, len(private)]) + b"\0\0" + private
    tag = b"ID3\x04\0\0" + bytes([0, 0, 0, len(item)]) + item
    index = 8  # the smallest frame with room for the table
    total = frame_size(index) + sum(map(len, frames))
    starts, at = [], frame_size(index)
    for f in frames:
        starts.append(at)
        at += len(f)
    toc = bytes(min(255, 256 * starts[k * len(frames) // 100] // total) if frames else 0 for k in range(100))
    xing = b"Xing" + struct.pack(">III", 7, len(frames), total) + toc
    return tag + frame_start(index) + xing + bytes(frame_size(index) - HEAD - len(xing)) + b"".join(frames)


def payload_of(data: bytes, stream: dict) -> bytes:
    """The payload of a stream made by :func:`write_stream`."""
    private = stream["tags"].get("PRIV", b"")
    n = int.from_bytes(private[8:16], "big") if private[:8] == b"payload\0" else None
    whole = b"".join(data[a:b] for a, b in stream["ancillary"])
    return whole if n is None else whole[:n]


def padded(data: bytes) -> bytes:
    """Zero bytes appended up to a positive multiple of 64."""
    return data + bytes(-len(data) % 64 or (0 if data else 64))


STREAM_FIELDS = "frames bigint, samples bigint, sample_rate int, duration_s double, bad_crc bigint, skipped bigint, vbr_table string, tags array<string>, seek_offsets array<bigint>"


def describe_streams(df: DataFrame, media: str = "media") -> DataFrame:
    """Add what the MPEG audio stream in the binary column ``media`` holds: the columns of ``STREAM_FIELDS``.

    Samples and sample rate give the exact duration; ``seek_offsets`` has the byte offset of each audio
    frame. Null, empty or foreign bytes give 0 frames. Columns with these names are replaced.
    """

    def one(data: bytes | None) -> tuple:
        x = read_stream(data)
        return len(x["seek"]), x["samples"], x["rate"], float(x["duration"]), x["bad_crc"], x["skipped"], x["table"] and x["table"]["kind"], sorted(x["tags"]) + ["ID3v1"] * x["id3v1"], x["seek"]

    return add_columns(df, media, STREAM_FIELDS, lambda: lambda values: [list(c) for c in zip(*map(one, values), strict=True)])


MEDIA_FIELDS = "n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media binary, media_bytes bigint, media_sha256 string, feature string"


def store_as_audio(docs: DataFrame, text: str = "text") -> DataFrame:
    """Store each whole text losslessly as an MPEG audio stream, read it back and describe it (``MEDIA_FIELDS``).

    The payload is the UTF-8 text (null: empty) with zero bytes up to a positive multiple of 64. ``feature`` gives frames,
    exact duration in samples over the rate, checksum failures, the table's kind, the size of its last
    frame's offset and a digest of all seek offsets. Equal texts give equal values. Columns with these names are replaced.

    All rows stay, repeated ones alike, and empty tables stay empty. A text of any length is one row's work, linear in it; a long one's stream is two hundredths longer.
    """

    def one(value) -> tuple:
        raw = value.encode("utf-8", "surrogatepass") if isinstance(value, str) else b""
        media = write_stream(padded(raw))
        stream = read_stream(media)
        back = payload_of(media, stream)
        seek = hashlib.sha256(struct.pack(f">{len(stream['seek'])}Q", *stream["seek"])).hexdigest()[:16]
        table_ok = stream["table"] is not None and stream["table"].get("frames") == len(stream["seek"])
        feature = f"frames={len(stream['seek'])};duration={stream['samples']}/{stream['rate']};bad_crc={stream['bad_crc']};skipped={stream['skipped']};table={stream['table']['kind'] if stream['table'] else '-'}:{'ok' if table_ok else 'bad'};last={stream['seek'][-1] if stream['seek'] else -1};seek={seek}"
        return len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), media, len(media), hashlib.sha256(media).hexdigest(), feature

    return add_columns(docs, text, MEDIA_FIELDS, lambda: lambda values: [list(c) for c in zip(*map(one, values), strict=True)])


def op9_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return store_as_audio(docs).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
