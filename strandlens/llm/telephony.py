"""Telephony audio columns: mu-law, A-law and IMA ADPCM in WAVE form, decoded to resampled PCM.

Mu-law and A-law codes expand by tables of 256 entries.  ADPCM blocks don't
depend on each other, so step k of every block of a whole batch is decoded at
once.  PCM at the telephony rate is resampled by a half-band filter to twice that.

`encode_payloads` keeps the bytes of texts as telephony samples without loss;
the codec follows from the payload itself, so equal texts give equal media.

Nulls and edge cases: a null text is empty, its payload one unit of spaces.  A
null or malformed medium, or one at another rate than ``RATE``, decodes to null
PCM and has null digests and features.  Repeated rows stay separate rows; extra
columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .shared import id_and_text
from .textkernel import slices

UNIT, PAD = 192, 32
RATE = 8000
#: Format tags of the WAVE form.
PCM, ALAW, MULAW, ADPCM = 1, 6, 7, 17
CODECS = (MULAW, ALAW, ADPCM)
HEADER, BLOCK = 4, 4 + UNIT  # an ADPCM block: predictor, step index, a spare byte, then the nibbles
NIBBLES = 2 * UNIT

# The step sizes of IMA ADPCM grow by a tenth; the standard's table is given by its values.
#: Step sizes and index changes of IMA ADPCM.
STEPS = np.array(
    [7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767],
    dtype=np.int32,
)
MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], dtype=np.int32)


def mulaw_table() -> np.ndarray:
    """The 16-bit sample of each mu-law code."""
    code = ~np.arange(256) & 0xFF
    size = (((code & 15) << 3) + 0x84) << ((code >> 4) & 7)
    return np.where(code & 0x80, 0x84 - size, size - 0x84).astype(np.int16)


def alaw_table() -> np.ndarray:
    """The 16-bit sample of each A-law code."""
    code = np.arange(256) ^ 0x55
    segment, low = (code >> 4) & 7, ((code & 15) << 4) + 8
    size = np.where(segment == 0, low, (low + 0x100) << np.maximum(segment - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


TABLES = {MULAW: mulaw_table(), ALAW: alaw_table()}
# What a nibble adds, by step index: (nibble, index) -> difference.
_NIBBLE = np.arange(16)[:, None]
DIFFERENCE = ((STEPS >> 3) + np.where(_NIBBLE & 4, STEPS, 0) + np.where(_NIBBLE & 2, STEPS >> 1, 0) + np.where(_NIBBLE & 1, STEPS >> 2, 0)) * np.where(_NIBBLE & 8, -1, 1)
NEXT = np.clip(np.arange(89) + MOVES[_NIBBLE & 7], 0, 88)


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """Samples of mono IMA ADPCM blocks (one a row): the predictor, then one for each nibble."""
    predictor = np.ascontiguousarray(blocks[:, :2]).view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(blocks[:, 2], 88).astype(np.intp)
    body = blocks[:, HEADER:].T
    out = np.empty((2 * len(body) + 1, len(blocks)), dtype=np.int16)
    out[0] = predictor
    added, following = DIFFERENCE.astype(np.int32).ravel(), NEXT.astype(np.intp).ravel()
    for k, codes in enumerate(body):
        for half in (0, 1):
            at = ((codes >> (4 * half)) & 15).astype(np.intp) * 89 + index
            predictor = np.clip(predictor + added[at], -32768, 32767)
            index = following[at]
            out[2 * k + half + 1] = predictor
    return out.T


#: A half-band low-pass filter: every second tap but the middle one is zero, so old samples stay and new ones are a short sum.
HALF_BAND = np.array([3, -25, 150, 150, -25, 3], dtype=np.float32) / 256


def double_rate(samples: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Twice the samples of each clip; clip i is samples[bounds[i]:bounds[i + 1]], its edges repeated outwards."""
    n = len(samples)
    out = np.empty(2 * n, dtype=np.int16)
    out[0::2] = samples
    if n:
        at = np.arange(n)
        clip = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        first, last = bounds[:-1][clip], bounds[1:][clip] - 1
        x = samples.astype(np.float32)
        between = np.zeros(n, dtype=np.float32)
        for tap, shift in zip(HALF_BAND, range(-2, 4), strict=True):
            between += tap * x[np.clip(at + shift, first, last)]
        out[1::2] = np.clip(np.rint(between), -32768, 32767)
    return out


def wave(codec: int, data: bytes, units: int) -> bytes:
    """A WAVE file of mono telephony data; units is its number of samples."""
    align = BLOCK if codec == ADPCM else 2 if codec == PCM else 1
    bits = {ADPCM: 4, PCM: 16}.get(codec, 8)
    rate = RATE * BLOCK // (NIBBLES + 1) if codec == ADPCM else RATE * align
    extra = struct.pack("<HH", 2, NIBBLES + 1) if codec == ADPCM else struct.pack("<H", 0)
    form = struct.pack("<HHIIHH", codec, 1, RATE, rate, align, bits) + extra
    data_pad = b"\0" * (len(data) % 2)
    body = b"WAVEfmt " + struct.pack("<I", len(form)) + form + b"fact" + struct.pack("<II", 4, units) + b"data" + struct.pack("<I", len(data)) + data + data_pad
    return b"RIFF" + struct.pack("<I", len(body)) + body


def parse_wave(raw: bytes) -> tuple[int, int, memoryview] | None:
    """(format tag, block size, data) of a mono WAVE file at the telephony rate, None where it isn't one."""
    if len(raw) < 12 or raw[:4] != b"RIFF" or raw[8:12] != b"WAVE":
        return None
    at, form = 12, None
    view = memoryview(raw)
    while at + 8 <= len(raw):
        name, size = raw[at : at + 4], struct.unpack_from("<I", raw, at + 4)[0]
        if name == b"fmt " and size >= 16:
            form = struct.unpack_from("<HHIIHH", raw, at + 8)
        elif name == b"data":
            if form is None or at + 8 + size > len(raw) or form[1] != 1 or form[2] != RATE:
                return None
            return form[0], form[4], view[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    return None


def to_wave(payload: bytes) -> bytes:
    """The payload (a multiple of UNIT bytes) as telephony samples; which codec follows from its checksum."""
    codec = CODECS[zlib.crc32(payload) % len(CODECS)]
    if codec != ADPCM:
        return wave(codec, payload, len(payload))
    rows = np.zeros((len(payload) // UNIT, BLOCK), dtype=np.uint8)
    rows[:, HEADER:] = np.frombuffer(payload, dtype=np.uint8).reshape(-1, UNIT)
    return wave(codec, rows.tobytes(), len(rows) * (NIBBLES + 1))


def stored_payload(codec: int, align: int, data: memoryview) -> bytes:
    """The payload bytes that lie in a medium's data, in blocks of align bytes."""
    if codec != ADPCM:
        return bytes(data)
    return np.frombuffer(data, dtype=np.uint8).reshape(-1, align)[:, HEADER:].tobytes()


def readable(raw: bytes | None) -> tuple[int, int, memoryview] | None:
    """(format tag, block size, data) of a medium in one of the three codecs, None of any other."""
    found = parse_wave(raw) if raw is not None else None
    if found and (found[0] in TABLES or found[0] == ADPCM and found[1] > HEADER and len(found[2]) % found[1] == 0):
        return found
    return None


def decode_media(media: list[bytes | None]) -> list[np.ndarray | None]:
    """PCM at twice the telephony rate of each medium; all of one codec are decoded together."""
    out: list[np.ndarray | None] = [None] * len(media)
    groups: dict[int, list[tuple[int, memoryview]]] = {}
    for i, raw in enumerate(media):
        found = readable(raw)
        if found:
            groups.setdefault((found[0], found[1]), []).append((i, found[2]))
    for (codec, align), clips in groups.items():
        joined = np.frombuffer(b"".join(d for _, d in clips), dtype=np.uint8)
        sizes = np.array([len(d) for _, d in clips])
        if codec == ADPCM:
            samples = decode_adpcm(joined.reshape(-1, align)).ravel()
            sizes = sizes // align * (2 * (align - HEADER) + 1)
        else:
            samples = TABLES[codec][joined]
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        pcm = double_rate(samples, bounds)
        for (i, _), a, b in zip(clips, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            out[i] = pcm[2 * a : 2 * b]
    return out


def decode_column(rows: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """id, pcm (16-bit little-endian at 16 kHz) and n_samples of a column of WAVE files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                found = decode_media(part.column("media").to_pylist())
                pcm = pa.array([None if f is None else f.astype("<i2").tobytes() for f in found], pa.binary())
                n = pa.array([None if f is None else len(f) for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id"), pcm, n], ["id", "pcm", "n_samples"])

    from pyspark.sql import functions as F

    picked = rows.select(F.col(id_col).alias("id"), F.col(media_col).alias("media"))
    return picked.mapInArrow(run, f"id {dict(picked.dtypes)['id']}, pcm binary, n_samples long")


def _feature(codec: int, pcm: np.ndarray) -> str:
    """Codec, samples, loudness, peak and sign changes of PCM, with a checksum over it."""
    if not len(pcm):
        return f"{codec}:0:0.000:0:0:0"
    x = pcm.astype(np.float64)
    crossings = int(np.count_nonzero((pcm[1:] < 0) != (pcm[:-1] < 0)))
    return f"{codec}:{len(pcm)}:{np.sqrt(np.mean(x * x)):.3f}:{int(np.abs(pcm.astype(np.int32)).max())}:{crossings}:{zlib.crc32(pcm.astype('<i2').tobytes())}"


def encode_payloads(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and media: every whole text, padded to a positive multiple of UNIT bytes, as a WAVE file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text"), 1 << 20):
                raw, cuts = data.tobytes(), offsets.tolist()
                media = [to_wave(t.ljust(max(UNIT, -(-len(t) // UNIT) * UNIT), bytes([PAD]))) for t in (raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(offsets)), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    rows = id_and_text(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_bytes long, media binary")


def describe_media(media: DataFrame) -> DataFrame:
    """Digests of stored media and of the payload read back from them, and features of the decoded, resampled PCM."""
    columns = ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("media")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) >> 20)) + 1  # about a megabyte of media at a time
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                raws = part.column("media").to_pylist()
                parsed = [readable(r) for r in raws]
                payloads = [None if p is None else stored_payload(*p) for p in parsed]
                pcm = decode_media(raws)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("n_bytes"),
                        pa.array([None if p is None else len(p) for p in payloads], pa.int64()),
                        pa.array([None if p is None else hashlib.sha256(p).hexdigest() for p in payloads], pa.string()),
                        pa.array([None if p is None else zlib.crc32(p[-16:]) for p in payloads], pa.int64()),
                        pa.array([None if r is None else len(r) for r in raws], pa.int64()),
                        pa.array([None if r is None else hashlib.sha256(r).hexdigest() for r in raws], pa.string()),
                        pa.array([None if p is None else _feature(p[0], x) for p, x in zip(parsed, pcm, strict=True)], pa.string()),
                    ],
                    columns,
                )

    kind = dict(media.dtypes)["doc_id"]
    return media.mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
