"""ISO media containers: write samples into nested boxes, read the sample tables back without touching payloads."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"mvex", b"moof", b"traf", b"udta"}
FRAME, SIDE, PER_CHUNK, TIMESCALE = 64, 8, 16, 25
DIGESTS = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string"
PROBE = "codec string, width int, height int, timescale long, duration long, samples long, keyframe_offsets array<long>, keyframe_sizes array<long>"
TRACK = f"track_id long, handler string, {PROBE}, keyframe_times array<long>"
DEEPEST = 16  # nested boxes; the containers above nest 6 deep
UNIT_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


def full_box(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def pad(data: bytes) -> bytes:
    """``data`` with zero bytes up to a positive multiple of 64."""
    return data + bytes(max(FRAME, -(-len(data) // FRAME) * FRAME) - len(data))


def encode(payload: bytes) -> bytes:
    """A file with one video track of uncompressed 8 x 8 frames in 8-bit grey; every chunk begins with a keyframe."""
    frames = len(payload) // FRAME
    chunks = -(-frames // PER_CHUNK)
    last = frames - (chunks - 1) * PER_CHUNK
    runs = [(1, PER_CHUNK, 1)] if last == PER_CHUNK else [(1, last, 1)] if chunks == 1 else [(1, PER_CHUNK, 1), (chunks, last, 1)]
    wide = len(payload) > 0xF0000000
    kind = box(b"ftyp", b"qt  ", struct.pack(">I", 512), b"qt  isom")

    def moov(first: int) -> bytes:
        offsets = (first + np.arange(chunks, dtype=np.int64) * PER_CHUNK * FRAME).astype(">u8" if wide else ">u4").tobytes()
        entry = box(
            b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HH", SIDE, SIDE), struct.pack(">II", 0x480000, 0x480000),
            bytes(4), struct.pack(">H", 1), bytes(32), struct.pack(">Hh", 40, -1),
        )
        table = box(
            b"stbl",
            full_box(b"stsd", struct.pack(">I", 1), entry),
            full_box(b"stts", struct.pack(">III", 1, frames, 1)),
            full_box(b"stss", struct.pack(">I", chunks), (1 + np.arange(chunks) * PER_CHUNK).astype(">u4").tobytes()),
            full_box(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            full_box(b"stsz", struct.pack(">II", FRAME, frames)),
            full_box(b"co64" if wide else b"stco", struct.pack(">I", chunks), offsets),
        )
        info = box(b"minf", full_box(b"vmhd", bytes(8), flags=1), box(b"dinf", full_box(b"dref", struct.pack(">I", 1), full_box(b"url ", flags=1))), table)
        media = box(
            b"mdia", full_box(b"mdhd", struct.pack(">IIIIHH", 0, 0, TIMESCALE, frames, 0x55C4, 0)),
            full_box(b"hdlr", bytes(4), b"vide", bytes(12), b"frames\0"), info,
        )
        head = full_box(b"mvhd", struct.pack(">IIII", 0, 0, TIMESCALE, frames), struct.pack(">IH", 0x10000, 0x100), bytes(10), UNIT_MATRIX, bytes(24), struct.pack(">I", 2))
        track = full_box(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, frames), bytes(16), UNIT_MATRIX, struct.pack(">II", SIDE << 16, SIDE << 16), flags=7)
        return box(b"moov", head, box(b"trak", track, media))

    body_at = len(kind) + len(moov(0)) + (16 if len(payload) + 8 >= 1 << 32 else 8)
    return kind + moov(body_at) + box(b"mdat", payload)


def boxes(data: memoryview, start: int = 0, end: int | None = None, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path, start, end) of every box's body, parents first. Sizes of 0 reach to the end, sizes of 1 have 64 bits; a box that overruns its parent, or is nested beyond DEEPEST, is an error."""
    end = len(data) if end is None else end
    if len(path) > DEEPEST:
        raise ValueError("boxes are nested too deep")
    while start + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, start)
        head = 8
        if size == 1:
            if start + 16 > end:
                raise ValueError("box header is cut off")
            size, head = struct.unpack_from(">Q", data, start + 8)[0], 16
        elif size == 0:
            size = end - start
        if size < head or start + size > end:
            raise ValueError(f"box {kind!r} overruns its parent")
        yield (*path, kind), start + head, start + size
        if kind in CONTAINERS:
            yield from boxes(data, start + head, start + size, (*path, kind))
        start += size


def _array(data: memoryview, kind: str, count: int, at: int, end: int) -> np.ndarray:
    if at + count * np.dtype(kind).itemsize > end:
        raise ValueError("sample table is cut off")
    return np.frombuffer(data, kind, count, at).astype(np.int64)


def _number(data: memoryview, at: int) -> int:
    return struct.unpack_from(">I", data, at)[0]


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _spread(data: memoryview, place: tuple[int, int], count: int, signed: bool = False) -> np.ndarray:
    """One value for each sample, from a box of (samples, value) runs."""
    at, end = place
    runs = _array(data, ">i4" if signed else ">u4", 2 * _number(data, at + 4), at + 8, end).reshape(-1, 2)
    if (runs[:, 0] < 0).any() or runs[:, 0].sum() != count:
        raise ValueError("runs do not hold the samples")
    return np.repeat(runs[:, 1], runs[:, 0])


def _samples(data: memoryview, found: dict[bytes, tuple[int, int]]) -> dict:
    """Offset, size, keyframe flag, and decoding and composition time of every sample that a track's tables list; times are None without ``stts``."""
    at, end = found[b"stsz"]
    fixed, count = _number(data, at + 4), _number(data, at + 8)
    if count > len(data):
        raise ValueError("more samples than bytes")
    sizes = np.full(count, fixed, np.int64) if fixed else _array(data, ">u4", count, at + 12, end)
    wide = b"co64" in found
    at, end = found[b"co64" if wide else b"stco"]
    chunks = _array(data, ">u8" if wide else ">u4", _number(data, at + 4), at + 8, end)
    at, end = found[b"stsc"]
    runs = _array(data, ">u4", 3 * _number(data, at + 4), at + 8, end).reshape(-1, 3)
    per_chunk = np.repeat(runs[:, 1], np.diff(np.append(runs[:, 0] - 1, len(chunks))))
    if per_chunk.sum() != count:
        raise ValueError("chunks do not hold the samples")
    before = np.concatenate(([0], np.cumsum(sizes)))
    offsets = before[:-1] + np.repeat(chunks - before[_starts(per_chunk)], per_chunk)
    keys = np.ones(count, bool)
    if b"stss" in found:
        at, end = found[b"stss"]
        listed = _array(data, ">u4", _number(data, at + 4), at + 8, end)
        if len(listed) and not 1 <= listed.min() <= listed.max() <= count:
            raise ValueError("keyframes are no samples")
        keys[:] = False
        keys[listed - 1] = True
    times, clock = None, 0
    if b"stts" in found:
        lasting = _spread(data, found[b"stts"], count)
        times, clock = _starts(lasting), int(lasting.sum())
        if b"ctts" in found:
            times = times + _spread(data, found[b"ctts"], count, signed=data[found[b"ctts"][0]] == 1)
    return {"offsets": offsets, "sizes": sizes, "keys": keys, "times": times, "clock": clock}


def _run(data: memoryview, place: tuple[int, int], base: int, at_data: int, usual: list[int]) -> dict:
    """The samples of a fragment's run; fields that it lacks are the ``usual`` duration, size and flags."""
    start, end = place
    version, flags, count, at = data[start], _number(data, start) & 0xFFFFFF, _number(data, start + 4), start + 8
    if count > len(data):
        raise ValueError("more samples than bytes")
    if flags & 1:
        at_data, at = base + struct.unpack_from(">i", data, at)[0], at + 4
    first = _number(data, at) if flags & 4 else None
    at += 4 if flags & 4 else 0
    fields = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
    listed = _array(data, ">u4", count * len(fields), at, end).reshape(count, len(fields))
    column = lambda bit, value: listed[:, fields.index(bit)] if bit in fields else np.full(count, value, np.int64)
    lasting, sizes, marks, shift = (column(b, v) for b, v in zip((0x100, 0x200, 0x400, 0x800), (*usual, 0), strict=True))
    keys = marks & 0x10000 == 0  # no "non-sync" mark
    if first is not None and count:
        keys[0] = first & 0x10000 == 0
    shift = np.where((version == 1) & (shift >= 1 << 31), shift - (1 << 32), shift)
    return {"offsets": at_data + _starts(sizes), "sizes": sizes, "keys": keys, "times": _starts(lasting) + shift, "clock": int(lasting.sum()), "end": at_data + int(sizes.sum())}


def _joined(first: dict, more: dict, clock: int) -> dict:
    """The samples of ``first`` and then those of ``more``, whose times count from ``clock``."""
    both = {k: np.concatenate([first[k], more[k]]) for k in ("offsets", "sizes", "keys")}
    known = first["times"] is not None or not len(first["sizes"])
    times = np.concatenate([first["times"] if first["times"] is not None else np.zeros(0, np.int64), more["times"] + clock]) if known else None
    return both | {"times": times, "clock": clock + more["clock"]}


def _add_fragments(data: memoryview, fragments: list[dict], usual: dict[int, list[int]], samples: dict[int, dict]) -> None:
    """Append the samples of movie fragments to those of their tracks. Fragments of tracks that the movie does not know are passed over."""
    moof, reached = None, 0
    for fragment in fragments:
        at = fragment[b"tfhd"][0]
        flags, track, here = _number(data, at) & 0xFFFFFF, _number(data, at + 4), list(usual.get(_number(data, at + 4), (0, 0, 0)))
        base = fragment["moof"] if flags & 0x20000 or fragment["moof"] != moof else reached
        at, moof = at + 8, fragment["moof"]
        if flags & 1:
            base, at = struct.unpack_from(">Q", data, at)[0], at + 8
        at += 4 if flags & 2 else 0
        for k, bit in enumerate((8, 0x10, 0x20)):
            if flags & bit:
                here[k], at = _number(data, at), at + 4
        clock = samples[track]["clock"] if track in samples else 0
        if b"tfdt" in fragment:
            at = fragment[b"tfdt"][0]
            clock = struct.unpack_from(">Q" if data[at] == 1 else ">I", data, at + 4)[0]
        reached = base
        for place in fragment[b"trun"]:
            more = _run(data, place, base, reached, here)
            reached = more["end"]
            if track in samples:
                samples[track] = _joined(samples[track], more, clock)
            clock += more["clock"]


def tracks(data: memoryview) -> list[dict]:
    """Every track's id, handler, codec, size, clock and samples (offset, size, keyframe flag, presentation time), from the tables of the movie and its fragments alone.

    Width and height are 0 for tracks that are not video. A duration of 0, as fragmented files have it, is replaced by the samples' time.
    """
    movie: list[dict[bytes, tuple[int, int]]] = []
    fragments, usual, begin, reached = [], {}, 0, 0
    for path, start, end in boxes(data):
        kind = path[-1]
        if len(path) == 1:
            begin, reached = reached, end
        if kind == b"trak":
            movie.append({})
        elif kind == b"traf":
            fragments.append({"moof": begin, b"trun": []})
        elif kind == b"trun" and b"traf" in path:
            fragments[-1][b"trun"].append((start, end))
        elif b"traf" in path:
            fragments[-1].setdefault(kind, (start, end))
        elif b"trak" in path:
            movie[-1].setdefault(kind, (start, end))
        elif kind == b"trex":
            usual[_number(data, start + 4)] = list(struct.unpack_from(">III", data, start + 12))
    found, samples = [], {}
    for k, parts in enumerate(movie):
        at, _ = parts[b"mdhd"]
        timescale, duration = struct.unpack_from(">IQ", data, at + 20) if data[at] == 1 else struct.unpack_from(">II", data, at + 12)
        at, _ = parts.get(b"tkhd", (None, None))
        track = -1 - k if at is None else _number(data, at + (20 if data[at] == 1 else 12))
        handler = bytes(data[parts[b"hdlr"][0] + 8 :][:4]).decode("latin-1") if b"hdlr" in parts else ""
        at, _ = parts[b"stsd"]
        codec = bytes(data[at + 12 : at + 16]).decode("latin-1")
        width, height = struct.unpack_from(">HH", data, at + 8 + 32) if handler in ("", "vide") else (0, 0)
        found.append({"track_id": track, "handler": handler, "codec": codec, "width": width, "height": height, "timescale": timescale, "duration": duration})
        samples[track] = _samples(data, parts)
    if len(samples) < len(found):
        raise ValueError("two tracks have one id")
    _add_fragments(data, fragments, usual, samples)
    return [t | samples[t["track_id"]] | {"duration": t["duration"] or samples[t["track_id"]]["clock"]} for t in found]


def sample_table(data: memoryview) -> dict:
    """The main track of ``tracks``: the first video track, or the first of all where there is none."""
    every = tracks(data)
    if not every:
        raise ValueError("the file has no track")
    return next((t for t in every if t["handler"] in ("", "vide")), every[0])


def _described(t: dict) -> dict:
    kept = {k: t[k] for k in ("codec", "width", "height", "timescale", "duration")}
    return kept | {"samples": len(t["sizes"]), "keyframe_offsets": t["offsets"][t["keys"]].tolist(), "keyframe_sizes": t["sizes"][t["keys"]].tolist()}


BROKEN = (KeyError, ValueError, TypeError, struct.error, IndexError)  # what boxes that do not hold sample tables lead to


def probe(data: bytes | None) -> dict | None:
    """What the columns of PROBE hold for the main track; null for null and for files whose boxes do not hold sample tables."""
    try:
        return _described(sample_table(memoryview(data)))
    except BROKEN:
        return None


def probe_tracks(data: bytes | None) -> list[dict] | None:
    """What the columns of TRACK hold for every track, in the file's order; null as in ``probe``. Times are null for tracks that state none."""
    try:
        every = tracks(memoryview(data))
    except BROKEN:
        return None
    own = [{"track_id": t["track_id"] if t["track_id"] >= 0 else None, "handler": t["handler"]} for t in every]
    return [o | _described(t) | {"keyframe_times": None if t["times"] is None else t["times"][t["keys"]].tolist()} for o, t in zip(own, every, strict=True)]


def payload(data: bytes) -> bytes:
    """All samples of the main track in order, read from the places that the tables name; touching samples are read at once."""
    view, t = memoryview(data), sample_table(memoryview(data))
    offsets, ends = t["offsets"], t["offsets"] + t["sizes"]
    if not len(offsets):
        return b""
    breaks = np.flatnonzero(offsets[1:] != ends[:-1]) + 1
    starts, stops = offsets[np.append(0, breaks)], ends[np.append(breaks - 1, len(ends) - 1)]
    return b"".join(bytes(view[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True))


def media_of(text: pd.Series) -> pd.Series:
    """The container that holds a text's UTF-8 bytes as frames; null counts as empty."""
    return text.map(lambda x: encode(pad((x or "").encode())))


def probed(media: pd.Series) -> pd.DataFrame:
    columns = [c.split()[0] for c in PROBE.split(", ")]
    return pd.DataFrame([probe(m) or dict.fromkeys(columns) for m in media], columns=columns)


def digests(media: pd.Series) -> pd.DataFrame:
    def of(m: bytes) -> tuple:
        p = payload(m)
        return len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-FRAME:]), len(m), hashlib.sha256(m).hexdigest()

    return pd.DataFrame([of(m) for m in media], columns=[c.split()[0] for c in DIGESTS.split(", ")])


def read_back(media: pd.Series) -> pd.DataFrame:
    return pd.concat([probed(media), digests(media)], axis=1)


def with_media(docs: DataFrame, text: str = "text", out: str = "media") -> DataFrame:
    """``docs`` with the container in ``out``; a column of that name is replaced."""
    return docs.withColumn(out, F.pandas_udf(media_of, "binary")(F.col(text)))


def with_probe(docs: DataFrame, media: str = "media", out: str = "probe") -> DataFrame:
    """``docs`` with a struct of codec, clock and keyframe byte ranges in ``out``, read from the tables alone."""
    return docs.withColumn(out, F.pandas_udf(probed, PROBE)(F.col(media)))


def with_digests(docs: DataFrame, media: str = "media", out: str = "digests") -> DataFrame:
    """``docs`` with a struct of lengths and checksums of the payload, read back from ``media``, and of the file itself."""
    return docs.withColumn(out, F.pandas_udf(digests, DIGESTS)(F.col(media)))


def with_read_back(docs: DataFrame, media: str = "media", out: str = "read_back") -> DataFrame:
    """``docs`` with the fields of ``with_probe`` and ``with_digests`` in one struct: a container that is made in the same plan is made once."""
    return docs.withColumn(out, F.pandas_udf(read_back, f"{PROBE}, {DIGESTS}")(F.col(media)))


def with_tracks(docs: DataFrame, media: str = "media", out: str = "tracks") -> DataFrame:
    """``docs`` with an array of TRACK structs in ``out``, one for each track; null for null and for files without readable tables or without tracks."""
    kind = f"array<struct<{TRACK.replace(' ', ':').replace(',:', ', ')}>>"
    read = docs.withColumn(out, F.pandas_udf(lambda m: m.map(probe_tracks), kind)(F.col(media)))
    return read.withColumn(out, F.when(F.size(out) > 0, F.col(out)))  # pandas hands null arrays of structs over as empty ones
