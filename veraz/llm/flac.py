"""FLAC media columns: lossless mono streams, written and read whole batches of frames at a time.

The encoder cuts 8-bit samples into blocks of 576 and picks, for every block, a constant, verbatim,
fixed-predictor or linear-predictor subframe with one Rice parameter. The decoder finds the frames
by the seek table (or, without one, by sync codes and checksums), verifies the CRC-8 of each header
and the CRC-16 of each frame, decodes the Rice residuals of many frames side by side, runs the
predictors, checks the MD5 of the stream and returns PCM with the sample and byte offset of each
block, so that a reader can seek.

Defined results: a null text is stored as the empty text; an empty text becomes one block of
padding; repeated rows give repeated rows; an empty table gives no rows; other columns are not read,
whatever their names are. A damaged stream raises ``ValueError``.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veraz.llm.pieces import sized
from veraz.llm.shared import giving_back

BLOCK = 576
#: Frames that are coded side by side; bounds the memory of a worker, also for very long texts.
FRAMES = 1024
LPC_ORDER = 4
LPC_PRECISION = 12
LPC_SHIFT = 10
SAMPLE_RATE = 8000
# Fixed values of the format: the coefficients of its fixed predictors, by order.
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))


def _crc_table(poly: int, bits: int) -> np.ndarray:
    table = np.arange(256, dtype=np.uint32) << (bits - 8)
    for _ in range(8):
        table = np.where(table >> (bits - 1) & 1, (table << 1) ^ poly, table << 1) & ((1 << bits) - 1)
    return table.astype(np.uint16)


CRC8, CRC16 = _crc_table(0x07, 8), _crc_table(0x8005, 16)
_CRC8 = CRC8.tolist()


def crc8(data: bytes) -> int:
    crc = 0
    for b in data:
        crc = _CRC8[crc ^ b]
    return crc


def crc16_rows(buffer: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-16 of each slice of the buffer, one byte of all slices at a time."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    crc = np.zeros(len(starts), np.uint16)
    active = len(starts)
    for j in range(int(lengths[0]) if len(lengths) else 0):
        while lengths[active - 1] <= j:
            active -= 1
        c = crc[:active]
        crc[:active] = (c << 8) ^ CRC16[(c >> 8) ^ buffer[starts[:active] + j]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def coded_number(n: int) -> bytes:
    """A frame number in the format's extension of UTF-8."""
    if n < 0x80:
        return bytes([n])
    tail = []
    width = 6
    while n >= 1 << width:
        tail.append(0x80 | n & 0x3F)
        n >>= 6
        width -= 1
    return bytes([(0xFF << (width + 1)) & 0xFF | n, *reversed(tail)])


@lru_cache(maxsize=65536)
def frame_header(number: int) -> bytes:
    """Sync code, fixed block size of 576, 8 kHz, mono, 8 bits a sample, number, CRC-8."""
    head = bytes([0xFF, 0xF8, 0x24, 0x02]) + coded_number(number)
    return head + bytes([crc8(head)])


def _zigzag(r: np.ndarray) -> np.ndarray:
    return (r << 1) ^ (r >> 31)


def _lpc(x: np.ndarray) -> np.ndarray:
    """Quantised predictor coefficients of each row, by Levinson and Durbin's recursion."""
    f = x.astype(np.float64)
    r = np.stack([np.einsum("ij,ij->i", f[:, lag:], f[:, : f.shape[1] - lag]) for lag in range(LPC_ORDER + 1)], 1)
    r[:, 0] += 1e-9 + 1e-9 * r[:, 0]
    a, error = np.zeros((len(x), LPC_ORDER)), r[:, 0].copy()
    for i in range(LPC_ORDER):
        k = (r[:, i + 1] - sum((a[:, j] * r[:, i - j] for j in range(i)), np.zeros(len(x)))) / error
        prior = a.copy()
        a[:, i] = k
        for j in range(i):
            a[:, j] = prior[:, j] - k * prior[:, i - 1 - j]
        error = np.maximum(error * (1 - k * k), 1e-9)
    limit = (1 << (LPC_PRECISION - 1)) - 1
    return np.clip(np.rint(a * (1 << LPC_SHIFT)), -limit, limit).astype(np.int32)


class _Bits:
    """Fields at bit positions of many rows at once."""

    def __init__(self, total: int):
        self.bits = np.zeros(total, np.uint8)

    def put(self, at: np.ndarray, value: np.ndarray, width: int) -> None:
        for j in range(width):
            self.bits[at + j] = (value >> (width - 1 - j)) & 1


def encode_frames(x: np.ndarray, numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The frames of the rows of ``x`` (int32 samples) end to end, and where each ends."""
    n = len(x)
    residual = {("fixed", 0): x}
    for order in range(1, 3):
        residual["fixed", order] = np.concatenate([x[:, :order], np.diff(x, n=order, axis=1)], 1)
    coefficients = _lpc(x)
    predicted = np.zeros_like(x[:, LPC_ORDER:])
    for j in range(LPC_ORDER):
        predicted += coefficients[:, j : j + 1] * x[:, LPC_ORDER - 1 - j : BLOCK - 1 - j]
    residual["lpc", LPC_ORDER] = np.concatenate([x[:, :LPC_ORDER], x[:, LPC_ORDER:] - (predicted >> LPC_SHIFT)], 1)
    kinds = list(residual)
    cost = np.stack([np.abs(residual[k][:, k[1] :]).sum(1) + 8 * k[1] + 40 * (k[0] == "lpc") for k in kinds], 1)
    choice = cost.argmin(1)
    order = np.array([k[1] for k in kinds])[choice]
    lpc = np.array([k[0] == "lpc" for k in kinds])[choice]
    u = np.empty_like(x)
    for i, k in enumerate(kinds):
        rows = choice == i
        u[rows] = _zigzag(residual[k][rows])
    u[np.arange(BLOCK)[None, :] < order[:, None]] = 0  # warm-up samples are stored apart
    counted = BLOCK - order
    # The best parameter is next to the logarithm of the mean; the cheaper of two is taken.
    guess = np.clip(np.floor(np.log2(np.maximum(u.sum(1) / counted * 0.69, 1))).astype(np.int32), 0, 12)
    size = np.stack([(u >> k[:, None]).sum(1) + counted * (1 + k) for k in (guess, guess + 1)], 1)
    rice = guess + size.argmin(1)
    coded = size.min(1)
    head_bits = 8 + 8 * order + np.where(lpc, 9 + LPC_PRECISION * LPC_ORDER, 0) + 10
    constant = (x == x[:, :1]).all(1)
    verbatim = ~constant & (head_bits + coded >= 8 + 8 * BLOCK)
    plain = ~constant & ~verbatim
    total = np.where(constant, 16, np.where(verbatim, 8 + 8 * BLOCK, head_bits + coded))
    body = (total + 7) // 8
    starts = np.concatenate([[0], np.cumsum(body)[:-1]]) * 8

    out = _Bits(int(body.sum()) * 8)
    out.put(starts, np.where(constant, 0, np.where(verbatim, 2, np.where(lpc, (31 + order) << 1, (8 + order) << 1))), 8)
    unsigned = x & 0xFF
    if constant.any():
        out.put(starts[constant] + 8, unsigned[constant, 0], 8)
    if verbatim.any():
        out.put((starts[verbatim, None] + 8 + 8 * np.arange(BLOCK)).ravel(), unsigned[verbatim].ravel(), 8)
    for j in range(max(4, LPC_ORDER)):
        rows = plain & (order > j)
        out.put(starts[rows] + 8 + 8 * j, unsigned[rows, j], 8)
    at = starts + 8 + 8 * order
    if (rows := plain & lpc).any():
        out.put(at[rows], np.full(rows.sum(), LPC_PRECISION - 1), 4)
        out.put(at[rows] + 4, np.full(rows.sum(), LPC_SHIFT), 5)
        for j in range(LPC_ORDER):
            out.put(at[rows] + 9 + LPC_PRECISION * j, coefficients[rows, j] & ((1 << LPC_PRECISION) - 1), LPC_PRECISION)
    at = at + np.where(lpc, 9 + LPC_PRECISION * LPC_ORDER, 0) + 6  # method 0, partition order 0
    out.put(at[plain], rice[plain], 4)
    packed = np.packbits(out.bits)
    if plain.any():
        live = np.arange(BLOCK)[None, :] >= order[plain, None]
        k, v = np.broadcast_to(rice[plain, None], live.shape)[live], u[plain][live]
        quotient = v >> k
        width = np.zeros(live.shape, np.int64)
        width[live] = quotient + 1 + k
        begin = (at[plain] + 4)[:, None] + np.cumsum(width, 1) - width
        stop = begin[live] + quotient
        # The stop bit and the k bits after it lie in three bytes; no two codes share a bit.
        word = (1 << k | v & ((1 << k) - 1)).astype(np.int64) << (23 - (stop & 7) - k)
        place = stop >> 3
        for j in range(3):
            packed = packed + np.bincount(place + j, weights=word >> (16 - 8 * j) & 0xFF, minlength=len(packed))[: len(packed)].astype(np.uint8)

    heads = [frame_header(i) for i in numbers.tolist()]
    head_len = np.array([len(h) for h in heads])
    ends = np.cumsum(head_len + body + 2)
    begins = ends - head_len - body - 2
    whole = np.zeros(int(ends[-1]), np.uint8)
    heads_at = np.repeat(begins - np.concatenate([[0], np.cumsum(head_len)[:-1]]), head_len) + np.arange(head_len.sum())
    whole[heads_at] = np.frombuffer(b"".join(heads), np.uint8)
    body_at = np.repeat(begins + head_len - np.concatenate([[0], np.cumsum(body)[:-1]]), body) + np.arange(body.sum())
    whole[body_at] = packed
    crc = crc16_rows(whole, begins, head_len + body)
    whole[ends - 2], whole[ends - 1] = crc >> 8, crc & 0xFF
    return whole.tobytes(), ends


def stream_head(payload: bytes, frame_sizes: np.ndarray) -> bytes:
    """Magic, STREAMINFO and a SEEKTABLE with a point for every frame."""
    frames = len(frame_sizes)
    info = struct.pack(">HH", BLOCK, BLOCK) + int(frame_sizes.min()).to_bytes(3) + int(frame_sizes.max()).to_bytes(3)
    info += (SAMPLE_RATE << 44 | 0 << 41 | 7 << 36 | len(payload)).to_bytes(8)
    signed = (np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()
    info += hashlib.md5(signed).digest()
    points = np.zeros(frames, [("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")])
    points["sample"] = np.arange(frames) * BLOCK
    points["offset"] = np.cumsum(frame_sizes) - frame_sizes
    points["n"] = BLOCK
    # A metadata block holds 2^24 bytes at most: longer streams get a point for every few frames.
    points = points[:: -(-frames * 18 // ((1 << 24) - 1))]
    table = points.tobytes()
    return b"fLaC" + bytes([0]) + len(info).to_bytes(3) + info + bytes([0x83]) + len(table).to_bytes(3) + table


def encode_streams(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream for each payload, whose length is a positive multiple of 576."""
    if any(not p or len(p) % BLOCK for p in payloads):
        raise ValueError(f"a payload has a positive multiple of {BLOCK} bytes")
    counts = np.array([len(p) // BLOCK for p in payloads], np.int64)
    numbers = np.concatenate([np.arange(c) for c in counts]) if payloads else np.zeros(0, np.int64)
    x = (np.frombuffer(b"".join(payloads), np.uint8) ^ 0x80).view(np.int8).reshape(-1, BLOCK)
    parts, sizes = [], []
    for k in range(0, len(x), FRAMES):
        data, ends = encode_frames(x[k : k + FRAMES].astype(np.int32), numbers[k : k + FRAMES])
        parts.append(data)
        sizes.append(np.diff(ends, prepend=0))
    data, sizes = b"".join(parts), np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
    ends, out, at = np.concatenate([[0], np.cumsum(sizes)]), [], 0
    for payload, c in zip(payloads, counts.tolist(), strict=True):
        out.append(stream_head(payload, sizes[at : at + c]) + data[ends[at] : ends[at + c]])
        at += c
    return out


def _header(data: bytes, at: int) -> tuple[int, int]:
    """The length of the frame header at a place and the number in it; -1 if it is no header."""
    lead = data[at + 4] if at + 5 < len(data) else 0xFF
    extra = 0 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length() - 1
    size = 6 + extra
    if lead == 0xFF or 0x80 <= lead < 0xC0 or data[at : at + 4] != b"\xff\xf8\x24\x02" or at + size > len(data) or crc8(data[at : at + size - 1]) != data[at + size - 1]:
        return -1, -1
    number = lead if not extra else lead & (0x3F >> extra)
    for b in data[at + 5 : at + 5 + extra]:
        number = number << 6 | b & 0x3F
    return size, number


def parse(data: bytes) -> tuple[dict, np.ndarray]:
    """STREAMINFO and the places where the frames begin, with the end of the stream at last."""
    if data[:4] != b"fLaC":
        raise ValueError("no FLAC stream")
    at, last, info, points = 4, False, None, None
    while not last:
        last, kind, size = data[at] >> 7 == 1, data[at] & 0x7F, int.from_bytes(data[at + 1 : at + 4])
        block = data[at + 4 : at + 4 + size]
        if kind == 0:
            bits = int.from_bytes(block[10:18])
            info = {"block": int.from_bytes(block[:2]), "channels": (bits >> 41 & 7) + 1, "bps": (bits >> 36 & 31) + 1, "samples": bits & (1 << 36) - 1, "md5": block[18:34]}
        elif kind == 3:
            points = np.frombuffer(block, [("sample", ">u8"), ("offset", ">u8"), ("n", ">u2")])
        at += 4 + size
    if info is None or (info["block"], info["channels"], info["bps"]) != (BLOCK, 1, 8) or info["samples"] % BLOCK:
        raise ValueError("not a mono stream of 8-bit samples in whole blocks of 576")
    frames = info["samples"] // BLOCK
    if points is not None and len(points) == frames:
        return info, np.append(at + points["offset"].astype(np.int64), len(data))
    starts, buffer = [at], np.frombuffer(data, np.uint8)
    while len(starts) < frames:  # the next place with a header whose checksums hold
        place = starts[-1] + 1
        while True:
            place = data.find(b"\xff\xf8\x24\x02", place)
            if place < 0:
                raise ValueError("a frame is missing")
            if _header(data, place)[1] == len(starts) and int(crc16_rows(buffer, np.array([starts[-1]]), np.array([place - 2 - starts[-1]]))[0]) == int.from_bytes(data[place - 2 : place]):
                break
            place += 1
        starts.append(place)
    return info, np.array([*starts, len(data)], np.int64)


def decode_frames(data: bytes, starts: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The samples of many frames of one buffer, a row for each; checksums are verified."""
    buffer = np.frombuffer(data + bytes(8), np.uint8)
    body = np.empty(len(starts), np.int64)
    for i, (at, number) in enumerate(zip(starts.tolist(), numbers.tolist(), strict=True)):
        size, found = _header(data, at)
        if found != number:
            raise ValueError(f"frame {number}: wrong header checksum or number")
        body[i] = at + size
    if (crc16_rows(buffer, starts, ends - starts - 2) != (buffer[ends - 2].astype(np.uint16) << 8 | buffer[ends - 1])).any():
        raise ValueError("wrong frame checksum")
    x = np.empty((len(starts), BLOCK), np.int32)
    kinds = buffer[body]
    bits = ones = before = None
    for kind in np.unique(kinds).tolist():
        rows = np.flatnonzero(kinds == kind)
        at = body[rows] + 1
        if kind == 0:
            x[rows] = buffer[at].view(np.int8)[:, None]
        elif kind == 2:
            x[rows] = buffer[at[:, None] + np.arange(BLOCK)].view(np.int8)
        elif kind >> 1 in range(8, 13) or kind >> 1 >= 32:
            lpc = kind >> 1 >= 32
            order = (kind >> 1) - (31 if lpc else 8)
            if bits is None:
                bits = np.unpackbits(buffer)
                ones = np.flatnonzero(bits).astype(np.int32)
                before = np.cumsum(bits, dtype=np.int32) - bits  # ones before each place
            warm = buffer[at[:, None] + np.arange(order)].view(np.int8).astype(np.int32) if order else np.zeros((len(rows), 0), np.int32)
            place = (at + order) * 8
            if lpc:
                precision, shift = _field(buffer, place, 4) + 1, _field(buffer, place + 4, 5)
                coefficients = np.empty((len(rows), order), np.int32)
                for j in range(order):
                    c = _field(buffer, place + 9 + precision * j, precision)
                    coefficients[:, j] = np.where(c >> (precision - 1) & 1, c - (1 << precision), c)
                place = place + 9 + precision * order
            else:
                coefficients, shift = np.tile(np.array(FIXED[order], np.int32), (len(rows), 1)), np.zeros(len(rows), np.int32)
            if (_field(buffer, place, 2) != 0).any():
                raise ValueError("this residual coding is not read")
            x[rows] = _predicted(warm, _rice(buffer, bits, ones, before, place + 2, order), coefficients, shift)
        else:
            raise ValueError(f"subframe type {kind >> 1} is not read")
    return x


def _field(buffer: np.ndarray, place: np.ndarray, width) -> np.ndarray:
    """Up to 16 bits at bit positions."""
    at = place >> 3
    word = buffer[at].astype(np.int32) << 16 | buffer[at + 1].astype(np.int32) << 8 | buffer[at + 2]
    return word >> (24 - (place & 7) - width) & ((1 << width) - 1)


def _rice(buffer, bits, ones, before, place: np.ndarray, order: int) -> np.ndarray:
    """Residuals of many subframes of one order side by side; ``place`` is at their partition order."""
    n = len(place)
    parts = _field(buffer, place, 4)
    out = np.empty((n, BLOCK - order), np.int32)
    for p in np.unique(parts).tolist():
        rows = np.flatnonzero(parts == p)
        at = place[rows] + 4
        at = at.astype(np.int32)
        quotient = np.empty((BLOCK - order, len(rows)), np.int32)
        tail = np.empty_like(quotient)
        width = np.empty_like(quotient)
        length, k = BLOCK >> p, None
        for i in range(BLOCK - order):
            if i == 0 or (i + order) % length == 0:
                k = _field(buffer, at, 4).astype(np.int32)
                if (k == 15).any():
                    raise ValueError("escaped partitions are not read")
                at = at + 4
            stop = ones[before[at]]
            quotient[i], tail[i], width[i] = stop - at, stop + 1, k
            at = stop + 1 + k
        u = quotient << width | _field(buffer, tail, width)
        out[rows] = ((u >> 1) ^ -(u & 1)).T
    return out


def _predicted(warm: np.ndarray, residual: np.ndarray, coefficients: np.ndarray, shift: np.ndarray) -> np.ndarray:
    order = warm.shape[1]
    if not order:
        return residual
    x = np.concatenate([warm.T, residual.T])
    c = np.ascontiguousarray(coefficients.T)
    for i in range(order, BLOCK):
        guess = c[0] * x[i - 1]
        for j in range(1, order):
            guess += c[j] * x[i - 1 - j]
        x[i] += guess >> shift
    return x.T


def decode_streams(streams: list[bytes]) -> list[tuple[bytes, np.ndarray]]:
    """The PCM of each stream (unsigned bytes) and the places where its frames begin."""
    parsed = [parse(s) for s in streams]
    base = np.concatenate([[0], np.cumsum([len(s) for s in streams])])
    frames = np.array([len(b) - 1 for _, b in parsed], np.int64)
    if not len(frames):
        return []
    starts = np.concatenate([b[:-1] + o for (_, b), o in zip(parsed, base, strict=False)])
    ends = np.concatenate([b[1:] + o for (_, b), o in zip(parsed, base, strict=False)])
    numbers = np.concatenate([np.arange(c) for c in frames])
    data, pcm = b"".join(streams), []
    for k in range(0, len(starts), FRAMES):
        lo, hi = int(starts[k]), int(ends[min(k + FRAMES, len(ends)) - 1])
        # The heads of streams lie between frames and are unpacked with them: small beside the frames.
        x = decode_frames(data[lo:hi], starts[k : k + FRAMES] - lo, ends[k : k + FRAMES] - lo, numbers[k : k + FRAMES])
        pcm.append(x.astype(np.int8).view(np.uint8).tobytes())
    whole, out, at = b"".join(pcm), [], 0
    for (info, bounds), c in zip(parsed, frames.tolist(), strict=True):
        signed = whole[at * BLOCK : (at + c) * BLOCK]
        if hashlib.md5(signed).digest() != info["md5"]:
            raise ValueError("wrong checksum of the samples")
        out.append(((np.frombuffer(signed, np.uint8) ^ 0x80).tobytes(), bounds[:-1]))
        at += c
    return out


def payload(text: bytes) -> bytes:
    """The bytes of a text with bytes 255 up to a positive multiple of the block."""
    return text + b"\xff" * (-len(text) % BLOCK or (0 if text else BLOCK))


def write_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, n_bytes long (of the text in UTF-8), media binary (a FLAC stream)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sized(batches, 1, FRAMES * BLOCK):
            texts = part.column(1).to_pylist()
            media = encode_streams([payload(t) for t in texts])
            yield pa.record_batch([part.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], ["id", "n_bytes", "media"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))
    return rows.mapInArrow(giving_back(run), f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id_col)


def features(pcm: np.ndarray) -> str:
    """Peak, energy, zero crossings and mean step of the samples, as whole numbers."""
    x = pcm.astype(np.int64) - 128
    crossings = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return f"n={len(x)};min={x.min()};max={x.max()};energy={int((x * x).sum())};crossings={crossings};steps={int(np.abs(np.diff(x)).sum())}"


def read_media(df: DataFrame, id_col: str = "doc_id", media_col: str = "media", keep: tuple[str, ...] = ("n_bytes",)) -> DataFrame:
    """One row per input row: ``id_col``, the columns in ``keep`` (long), media binary, pcm binary,
    blocks array<struct<first_sample long, n_samples int, byte_offset long>>, feature string.
    A null stream gives null pcm, blocks and feature."""
    names = ["id", *keep, "media"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sized(batches, len(names) - 1, FRAMES * BLOCK):
            media = part.column(len(names) - 1).to_pylist()
            done = iter(decode_streams([m for m in media if m is not None]))
            rows = [next(done) if m is not None else None for m in media]
            counts = [len(r[1]) if r else 0 for r in rows]
            offsets = np.concatenate([r[1] for r in rows if r] or [np.zeros(0, np.int64)])
            first = np.concatenate([np.arange(c) * BLOCK for c in counts] or [np.zeros(0, np.int64)])
            blocks = pa.StructArray.from_arrays([pa.array(first, pa.int64()), pa.array(np.full(len(first), BLOCK), pa.int32()), pa.array(offsets, pa.int64())], ["first_sample", "n_samples", "byte_offset"])
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), blocks, mask=pa.array([r is None for r in rows]))
            yield pa.record_batch([*part.columns, pa.array([r and r[0] for r in rows], pa.binary()), lists, pa.array([r and features(np.frombuffer(r[0], np.uint8)) for r in rows], pa.string())], [*names, "pcm", "blocks", "feature"])

    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), *keep, F.col(media_col).alias("media"))
    schema = ", ".join([f"id {kind}", *(f"{k} long" for k in keep), "media binary", "pcm binary", "blocks array<struct<first_sample: long, n_samples: int, byte_offset: long>>", "feature string"])
    return rows.mapInArrow(giving_back(run), schema).withColumnRenamed("id", id_col)


def pcm_blocks(read: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per block of a stream: ``id_col``, first_sample long, n_samples int, byte_offset long (of its
    frame in the stream), pcm binary (its samples)."""
    rows = read.select(F.col(id_col), "pcm", F.explode("blocks").alias("b"))
    return rows.select(id_col, "b.*", F.expr("substring(pcm, cast(b.first_sample + 1 as int), b.n_samples)").alias("pcm"))


def write_blocks(read: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Writes the blocks as Parquet, by sample within a stream, so that a reader finds one by the
    statistics of row groups."""
    pcm_blocks(read, id_col).sortWithinPartitions(id_col, "first_sample").write.parquet(path)


def seek(blocks: DataFrame, sample: int, id_col: str = "doc_id") -> DataFrame:
    """The blocks that hold a sample, with its place in them: ``id_col``, first_sample, place int, pcm."""
    held = blocks.where((F.col("first_sample") <= sample) & (F.col("first_sample") + F.col("n_samples") > sample))
    return held.select(id_col, "first_sample", (F.lit(sample) - F.col("first_sample")).cast("int").alias("place"), "pcm")
