"""Token ids in a binary file format: blocks of ids as byte or bit planes, each plane compressed with zstandard.

One file image holds the ids of consecutive documents:

    "SLTK" | u32 mode | u32 block | u64 start | u64 n_ids | u32 n_docs | u32 n_chunks
    doc ids (i64 each) | which of these are not null (a bit each, in whole bytes) | ids of each document (u64 each) | chunk index (u64 byte offset, u32 ids, u32 planes each)
    chunks: u32 length of each plane, then the planes

all little-endian.  ``start`` counts the ids of the image's partition that lie
before it.  A chunk is ``block`` ids (the last may be shorter), transposed into
planes, so that a reader of some documents only decodes the chunks they touch.

Images are rows of a table that Spark writes and reads, so they can lie in any
store that Spark reaches and a lost executor's part is written again.

Ids come from the tokenizers library: the worker asks it how it splits each
code point it meets, finds the pieces of a text with arrays, and has the
library encode each distinct piece once.  Added tokens in a text are pieces of
their own, and what lies between them is split like a text, as the library does;
where added tokens also take spaces, need whole words or are normalized, it
encodes texts that hold one as a whole.

Nulls and edge cases: a null text is empty and has only the end id.  Ids are
whole numbers; null ones
sort first and repeated ids by text; each row is a document of its own.  Extra
columns are ignored.  An empty table gives no file and no rows.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytebpe
from .shared import cut, id_and_text, parts_for, whole_ids
from .textkernel import slices

MAGIC = b"SLTK"
HEAD = struct.Struct("<4sIIQQII")
BLOCK = 1 << 16
#: An image is closed at the first document that brings it to so many ids.
IMAGE_IDS = 1 << 20
BYTE_PLANES, BIT_PLANES = 0, 1
LEVEL = 3
#: Files that one range of ids takes about.
PART_BYTES = 32 << 20


def to_planes(ids: np.ndarray, mode: int) -> list[bytes]:
    """The planes of a block, low ones first; planes above the largest id's are left out."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    top = int(ids.max()) if len(ids) else 0
    if mode == BYTE_PLANES:
        return [raw[:, k].tobytes() for k in range(max(1, -(-top.bit_length() // 8)))]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(max(1, top.bit_length()))]


def from_planes(planes: list[bytes], n: int, mode: int) -> np.ndarray:
    if mode == BYTE_PLANES:
        raw = np.zeros((n, 4), dtype=np.uint8)
        for k, p in enumerate(planes):
            raw[:, k] = np.frombuffer(p, dtype=np.uint8)
    else:
        bits = np.zeros((n, 32), dtype=np.uint8)
        for k, p in enumerate(planes):
            bits[:, k] = np.unpackbits(np.frombuffer(p, dtype=np.uint8), count=n, bitorder="little")
        raw = np.packbits(bits, axis=1, bitorder="little")
    return raw.reshape(-1).view("<u4")


def write_image(doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, start: int, mode: int = BYTE_PLANES, block: int = BLOCK, known: np.ndarray | None = None) -> bytes:
    pack = zstandard.ZstdCompressor(level=LEVEL)
    chunks, index, at = [], [], 0
    for lo in range(0, len(ids), block):
        part = ids[lo : lo + block]
        planes = [pack.compress(p) for p in to_planes(part, mode)]
        chunk = struct.pack(f"<{len(planes)}I", *map(len, planes)) + b"".join(planes)
        index.append(struct.pack("<QII", at, len(part), len(planes)))
        chunks.append(chunk)
        at += len(chunk)
    head = HEAD.pack(MAGIC, mode, block, start, len(ids), len(doc_ids), len(chunks))
    known = np.packbits(np.ones(len(doc_ids), dtype=bool) if known is None else known)
    return b"".join((head, doc_ids.astype("<i8").tobytes(), known.tobytes(), sizes.astype("<u8").tobytes(), *index, *chunks))


class Image:
    """Reads an image: its documents at once, ids chunk by chunk."""

    def __init__(self, raw: bytes):
        magic, self.mode, self.block, self.start, self.n_ids, docs, chunks = HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEAD.size
        self.doc_ids = np.frombuffer(raw, "<i8", docs, at)
        bits = -(-docs // 8)
        self.known = np.unpackbits(np.frombuffer(raw, np.uint8, bits, at + 8 * docs), count=docs).astype(bool)
        at += bits
        self.sizes = np.frombuffer(raw, "<u8", docs, at + 8 * docs).astype(np.int64)
        self.index = [struct.unpack_from("<QII", raw, at + 16 * docs + 16 * k) for k in range(chunks)]
        self.raw, self.data = raw, at + 16 * docs + 16 * chunks

    def ids(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids lo to hi, from the chunks that hold them."""
        hi = self.n_ids if hi is None else hi
        unpack, out, first = zstandard.ZstdDecompressor(), [], lo // self.block
        for at, n, planes in self.index[first : -(-hi // self.block)]:
            sizes = struct.unpack_from(f"<{planes}I", self.raw, self.data + at)
            at += self.data + 4 * planes
            parts = []
            for size in sizes:
                parts.append(unpack.decompress(self.raw[at : at + size]))
                at += size
            out.append(from_planes(parts, n, self.mode))
        whole = np.concatenate(out) if out else np.zeros(0, np.uint32)
        return whole[lo - first * self.block : hi - first * self.block]


class LibraryCodec:
    """Encodes buffers of texts with a tokenizers file; pieces that came before are remembered, up to a bound.

    specials: special tokens in a text are matched, which is the library's default; otherwise they are text like any other.
    """

    def __init__(self, path: str, specials: bool = True):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = not specials
        tokens = [t for t in self.own.get_added_tokens_decoder().values() if specials or not t.special]
        longest = sorted((t.content.encode() for t in tokens if t.content), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, longest))) if longest else None
        self.plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in tokens)
        self.kind = np.full(0x110000, 255, dtype=np.uint8)
        self.cache = bytebpe.PieceCache()

    def _classes(self, points: np.ndarray) -> np.ndarray:
        out = self.kind[points]
        new = np.unique(points[out == 255])
        if len(new):
            split = self.own.pre_tokenizer.pre_tokenize_str
            for c in new.tolist():
                joins = [len(split(left + chr(c))) == 1 for left in ("a", "1", "!")]
                self.kind[c] = joins.index(True) if any(joins) else bytebpe.SPACE
            out = self.kind[points]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids before the end of each text)."""
        found = self._added(data, offsets)
        if not len(found) or self.plain:
            return self._pieces(data, offsets, found)
        # texts with an added token that isn't plain are the library's, the others' runs are cut into pieces
        whole = np.unique(np.searchsorted(offsets, found[:, 0], side="right") - 1).tolist()
        ids, sizes, at, raw = [], [], 0, data.tobytes()
        for k in [*whole, len(offsets) - 1]:
            some, ends = self._pieces(data[offsets[at] : offsets[k]], offsets[at : k + 1] - offsets[at], found[:0])
            ids.append(some)
            sizes.append(np.diff(ends, prepend=0))
            if k < len(offsets) - 1:
                ids += self._encode([raw[offsets[k] : offsets[k + 1]]])
                sizes.append([len(ids[-1])])
            at = k + 1
        return np.concatenate(ids), np.cumsum(np.concatenate(sizes).astype(np.int64))

    def _added(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(start, end) of the added tokens in the texts, leftmost and longest first; none reaches over a text's end."""
        raw = data.tobytes()
        if self.added is None or not self.added.search(raw):
            return np.zeros((0, 2), dtype=np.int64)
        cuts = offsets.tolist()
        found = [m.span() for a, b in zip(cuts[:-1], cuts[1:], strict=True) for m in self.added.finditer(raw, a, b)]
        return np.array(found, dtype=np.int64).reshape(-1, 2)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray, added: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points, at = bytebpe.code_points(data)
        opens = np.zeros(len(data) + 1, dtype=bool)
        opens[offsets] = True
        opens[added.ravel()] = True
        starts = at[bytebpe.piece_starts(bytebpe.symbols(points, opens[at], self._classes(points)))]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        if len(added):
            k = np.searchsorted(added[:, 0], starts, side="left") - 1
            starts = starts[(k < 0) | (starts >= added[k, 1])]
        ids, total = self.cache.encode(data, starts, self._encode)
        return ids, np.concatenate(([0], total))[np.searchsorted(starts, offsets[1:])]

    def _encode(self, parts: list[bytes]) -> list[np.ndarray]:
        found = self.own.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]


_codecs: dict[tuple[str, bool], LibraryCodec] = {}


def _codec(path: str, specials: bool) -> LibraryCodec:
    if (path, specials) not in _codecs:
        _codecs[path, specials] = LibraryCodec(path, specials)
    return _codecs[path, specials]


def write_token_files(docs: DataFrame, path: str, end_id: int, mode: int = BYTE_PLANES, id_col: str = "doc_id", text_col: str = "text", specials: bool = False) -> DataFrame:
    """Encode every whole text, in ascending id order, into file images; returns the table of images that was written.

    Columns: part (ascending ranges of ids), seq, start, n_ids, image.  specials: special tokens in a text are matched.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = _codec(path, specials), TaskContext.get().partitionId()
        docs_, known, sizes, parts, have, start, seq = [], [], [], [], 0, 0, 0

        def image() -> pa.RecordBatch:
            raw = write_image(np.concatenate(docs_), np.concatenate(sizes), np.concatenate(parts), start, mode, known=np.concatenate(known))
            return pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "start": [start], "n_ids": [have], "image": [raw]})

        for batch in batches:
            valid = batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            keys = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, offsets in slices(batch.column("text"), 1 << 20):
                ids, ends = own.encode(data, offsets)
                whole = np.insert(ids, ends, np.uint32(end_id))
                docs_.append(keys[lo:hi])
                known.append(valid[lo:hi])
                sizes.append(np.diff(np.concatenate(([0], ends))) + 1)
                parts.append(whole)
                have += len(whole)
                if have >= IMAGE_IDS:
                    yield image()
                    start, seq, have = start + have, seq + 1, 0
                    docs_, known, sizes, parts = [], [], [], []
        if have:
            yield image()

    rows = whole_ids(id_and_text(docs, id_col, text_col))
    ordered = rows.repartitionByRange(parts_for(rows, PART_BYTES), "doc_id").sortWithinPartitions("doc_id", "text")
    return cut(ordered.mapInArrow(run, "part long, seq long, start long, n_ids long, image binary"), "tokens")


def read_token_files(images: DataFrame) -> DataFrame:
    """Per document, from the images alone: doc_id, start, n_tokens and the checksum of its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("image"), strict=True):
                image = Image(raw.as_py())
                ends = np.cumsum(image.sizes)
                raw_ids = memoryview(image.ids().astype("<u4")).cast("B")
                cuts = (np.concatenate(([0], ends)) * 4).tolist()
                keys = pa.array(image.doc_ids, pa.int64(), mask=~image.known)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(keys), pa.int64()),
                        keys,
                        pa.array(image.start + ends - image.sizes),
                        pa.array(image.sizes),
                        pa.array([zlib.crc32(raw_ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.int64()),
                    ],
                    ["part", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    rows = images.select("part", "image").mapInArrow(run, "part long, doc_id long, start long, n_tokens long, ids_crc32 long")
    # one row for each range partition: a bound that the number of documents doesn't move
    totals = {r["part"]: r["n"] for r in images.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    bases, before = [], 0
    for part in sorted(totals):
        bases.append((part, before))
        before += totals[part]
    base = images.sparkSession.createDataFrame(bases, "part long, base long")
    return rows.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
