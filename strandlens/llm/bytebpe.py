"""Byte-level BPE encoding and decoding without a regular expression.

Pre-tokenisation works on arrays.  Every code point gets a class from a table,
and one lookahead (is the next one white space, does a contraction follow)
turns it into one of eight symbols.  A nine-state automaton then decides where
pieces begin.  Its transition functions compose associatively, so a buffer is
cut into equal rows: all rows' composed functions are found side by side, a
prefix pass over the rows gives each its entry state, and a second pass side by
side gives every state.  The pieces (byte ranges) are looked up by hash and bytes in
the worker's cache; new ones are merged pair by pair, all pieces at once; each id
keeps its byte offset.

Nulls and edge cases: a null text is empty and has no ids.  Repeated rows stay
separate rows.  Extra columns are ignored.  The cache is emptied at
``CACHE_PIECES`` entries, so memory is bounded; no piece is ever cut or dropped.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import id_and_text
from .textkernel import eights, numbers, range_hashes, same_bytes, slices

CACHE_PIECES = 1_000_000
#: Pieces longer than this (runs of signs or spaces, keys) are merged one by one with a heap.
LONG_PIECE = 48
ROW = 128

# Code point classes.
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
#: The code points with the Unicode property White_Space.
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Symbols: a class with what follows it resolved.
SYM_L, SYM_N, SYM_O, SYM_SHORT, SYM_LONG, SYM_PREFIX, SYM_RUN, SYM_LONE = range(8)
# States: inside a piece of letters, numbers, others or spaces; on a space that begins the next piece; on a lone
# space; one or two letters before a contraction's end; at its end.
IN_L, IN_N, IN_O, IN_RUN, ON_PREFIX, ON_LONE, LEFT_1, LEFT_2, CLOSED = range(9)
STATES = 9


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, begins a piece) by symbol and state; symbols 8 more than those above open a text."""
    step = np.zeros((16, STATES), dtype=np.uint8)
    begins = np.zeros((16, STATES), dtype=bool)
    same = {SYM_L: IN_L, SYM_N: IN_N, SYM_O: IN_O}
    for symbol in range(8):
        for state in range(STATES):
            if state in (LEFT_1, LEFT_2):
                to, new = (CLOSED if state == LEFT_1 else LEFT_1), False
            elif symbol in same:
                to, new = same[symbol], state not in (same[symbol], ON_PREFIX)
            elif symbol in (SYM_SHORT, SYM_LONG):
                inside = state in (IN_O, ON_PREFIX)
                to, new = (IN_O, False) if inside else ((LEFT_1 if symbol == SYM_SHORT else LEFT_2), True)
            elif symbol == SYM_RUN:
                to, new = IN_RUN, state != IN_RUN
            else:
                to, new = (ON_PREFIX if symbol == SYM_PREFIX else ON_LONE), True
            step[symbol, state], begins[symbol, state] = to, new
        step[symbol + 8], begins[symbol + 8] = step[symbol, CLOSED], True
    return step, begins


STEP, BEGINS = _automaton()
_tables: dict[str, np.ndarray] = {}


def class_table() -> np.ndarray:
    """The class of every code point, by its general category."""
    if "class" not in _tables:
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kind.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), dtype=np.uint8, count=0x110000)
        table[WHITE_SPACE] = SPACE
        _tables["class"] = table
    return _tables["class"]


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, byte position of each) of valid UTF-8."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int32)
    out = lead.copy()
    if len(at) < len(data):
        size = np.diff(np.append(at, len(data)))
        for width, mask in ((2, 0x1F), (3, 0x0F), (4, 0x07)):
            these = np.flatnonzero(size == width)
            if len(these):
                p = at[these]
                cp = lead[these] & mask
                for k in range(1, width):
                    cp = (cp << 6) | (data[p + k] & 0x3F)
                out[these] = cp
    return out, at


def symbols(points: np.ndarray, opens: np.ndarray, kind: np.ndarray | None = None) -> np.ndarray:
    """Symbols of code points, by their classes; opens marks those that begin a text."""
    n = len(points)
    kind = class_table()[points] if kind is None else kind
    space = kind == SPACE
    ends = np.append(opens[1:], True)  # the last code point of a text
    more = np.append(~space[1:], False) & ~ends  # something other than white space follows
    out = kind.copy()
    out[space] = SYM_RUN
    out[space & more] = SYM_LONE
    out[(points == 32) & more] = SYM_PREFIX
    mark = np.flatnonzero((points == 39) & ~ends)
    if len(mark):
        a = points[mark + 1]
        b = np.where(ends[mark + 1], 0, points[np.minimum(mark + 2, n - 1)])
        short = np.isin(a, [ord(c) for c in "stmd"])
        long = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        out[mark[short]] = SYM_SHORT
        out[mark[long]] = SYM_LONG
    return out + (opens.astype(np.uint8) << 3)


def piece_starts(symbol: np.ndarray) -> np.ndarray:
    """Where pieces begin: the automaton run over all symbols as a scan of composed transition functions."""
    n = len(symbol)
    if not n:
        return np.zeros(0, dtype=np.int64)
    rows = -(-n // ROW)
    grid = np.full(rows * ROW, 8, dtype=np.uint8)
    grid[:n] = symbol
    grid = np.ascontiguousarray(grid.reshape(rows, ROW).T)
    base = grid.astype(np.intp) * STATES
    flat = STEP.ravel()
    # composed functions of the rows: state at entry -> state at exit
    composed = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (rows, STATES))
    for j in range(ROW):
        composed = flat[base[j][:, None] + composed]
        if j == 15 and (composed == composed[:, :1]).all():  # each row's exit no longer depends on its entry
            composed = _advance(flat, base[j + 1 :], composed[:, 0])[:, None].repeat(STATES, 1)
            break
    entry = np.empty(rows, dtype=np.uint8)
    state = CLOSED
    for r, f in enumerate(composed.tolist()):
        entry[r] = state
        state = f[state]
    begins = np.empty((ROW, rows), dtype=bool)
    flags = BEGINS.ravel()
    state = entry
    for j in range(ROW):
        k = base[j] + state
        begins[j] = flags[k]
        state = flat[k]
    return np.flatnonzero(begins.T.ravel()[:n])


def _advance(flat: np.ndarray, base: np.ndarray, state: np.ndarray) -> np.ndarray:
    for row in base:
        state = flat[row + state]
    return state


def pieces(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where the pieces of a buffer of texts begin."""
    points, at = code_points(data)
    opens = np.zeros(len(data) + 1, dtype=bool)
    opens[offsets] = True
    return at[piece_starts(symbols(points, opens[at]))]


class PieceCache:
    """Ids of pieces, in an open-addressed table of arrays by hash and bytes: lookups and inserts take whole slices at once."""

    def __init__(self, most: int = CACHE_PIECES):
        self.most, self.bits = most, (2 * most).bit_length()
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        self.n, self.used, self.filled = 0, 0, 0
        self.starts = np.zeros(self.most + 1, dtype=np.int64)
        self.ids = np.zeros(4 * self.most, dtype=np.uint32)
        # the bytes of the pieces, by which a lookup is decided
        self.view = eights(np.zeros(16 * self.most, dtype=np.uint8))
        self.raw = self.view.base
        self.places = np.zeros(self.most + 1, dtype=np.int64)

    def __len__(self) -> int:
        return self.n

    def find(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The number of each piece in the store, -1 where it isn't there."""
        out, view = np.full(len(key), -1, dtype=np.int64), eights(data)
        todo, slot, mask = np.arange(len(key)), (key >> np.uint64(64 - self.bits)).astype(np.int64), (1 << self.bits) - 1
        while len(todo):
            number = self.slots[slot].astype(np.int64)
            hit = (number >= 0) & (self.keys[slot] == key[todo])
            hit[hit] = self.places[number[hit] + 1] - self.places[number[hit]] == sizes[todo[hit]]
            hit[hit] = same_bytes(view, starts[todo[hit]], self.view, self.places[number[hit]], sizes[todo[hit]])
            out[todo[hit]] = number[hit]
            on = ~hit & (number >= 0)
            todo, slot = todo[on], (slot[on] + 1) & mask
        return out

    def add(self, key: np.ndarray, parts: list[bytes], ids: list[np.ndarray]) -> bool:
        """Keep the ids of new, distinct pieces; false (and nothing kept) where there is no room."""
        sizes, lengths = np.array([len(i) for i in ids], dtype=np.int64), np.array([len(p) for p in parts], dtype=np.int64)
        total, length = int(sizes.sum()), int(lengths.sum())
        if self.n + len(key) > self.most or self.used + total > len(self.ids) or self.filled + length > len(self.raw) - 8:
            return False
        number = self.n + np.arange(len(key))
        self.ids[self.used : self.used + total] = np.concatenate([np.zeros(0, np.uint32), *ids])
        self.starts[self.n + 1 : self.n + 1 + len(key)] = self.used + np.cumsum(sizes)
        self.raw[self.filled : self.filled + length] = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.places[self.n + 1 : self.n + 1 + len(key)] = self.filled + np.cumsum(lengths)
        self.n, self.used, self.filled = self.n + len(key), self.used + total, self.filled + length
        todo, slot, mask = np.arange(len(key)), (key >> np.uint64(64 - self.bits)).astype(np.int64), (1 << self.bits) - 1
        while len(todo):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = number[todo[free]]
            won = free & (self.slots[slot] == number[todo])  # of several on one slot, the last stays
            self.keys[slot[won]] = key[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) & mask
        return True

    def encode(self, data: np.ndarray, starts: np.ndarray, encode: Callable[[list[bytes]], list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in their order, number of ids up to the end of each piece); encode gets the pieces not known."""
        ends = np.append(starts[1:], len(data))
        key = range_hashes(data, starts, ends)
        at = self.find(data, starts, ends - starts, key)
        missing = np.flatnonzero(at < 0)
        flat, bounds = self.ids, self.starts
        if len(missing):
            back, where = numbers(data, starts[missing], ends[missing], key[missing])
            where = missing[where]
            raw = data.tobytes()
            parts = [raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
            found = encode(parts)
            short = ends[where] - starts[where] <= LONG_PIECE
            kept = self.n
            if short.all() and self.add(key[where], parts, found):
                at[missing] = kept + back
                flat, bounds = self.ids, self.starts
            else:  # this slice's new pieces follow what is stored, for now
                sizes = np.cumsum([len(i) for i in found])
                flat = np.concatenate([self.ids[: self.used], *found])
                bounds = np.concatenate([self.starts[: self.n + 1], self.used + sizes])
                at[missing] = kept + back
                some = np.flatnonzero(short).tolist()
                if not self.add(key[where[short]], [parts[i] for i in some], [found[i] for i in some]):
                    self.clear()
        take = bounds[at + 1] - bounds[at]
        total = np.cumsum(take)
        index = np.arange(int(total[-1]) if len(total) else 0)
        index += np.repeat(bounds[at] - (total - take), take)
        return flat[index], total


class Codec:
    """A byte-level BPE by a file of ranks: encode buffers of texts, decode ids."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.ranks = ranks
        size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, i in ranks.items():
            self.tokens[i] = token
        self.token_bytes = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.token_ends = np.cumsum([0] + [len(t) for t in self.tokens])
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs = {}
        for token, i in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[(a << 20) | b] = i
        # an open-addressed table of the pairs, so that a lookup is a few gathers
        self.bits = int(len(pairs) * 4).bit_length()
        self.pair_keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.pair_ranks = np.full(1 << self.bits, 1 << 40, dtype=np.int64)
        self.probes = 1
        mask = (1 << self.bits) - 1
        for key, i in pairs.items():
            slot, probes = self._slot(key), 1
            while self.pair_keys[slot] != -1:
                slot, probes = (slot + 1) & mask, probes + 1
            self.pair_keys[slot], self.pair_ranks[slot] = key, i
            self.probes = max(self.probes, probes)
        self.pairs = pairs
        self.cache = PieceCache()

    def _slot(self, key: int) -> int:
        return ((key * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, 2**40 where it doesn't merge."""
        key = (left << 20) | right
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(key), 1 << 40, dtype=np.int64)
        open_ = np.arange(len(key))
        mask = (1 << self.bits) - 1
        for _ in range(self.probes):
            found = self.pair_keys[slot]
            hit = found == key[open_]
            out[open_[hit]] = self.pair_ranks[slot[hit]]
            rest = ~hit & (found != -1)
            if not rest.any():
                break
            open_, slot = open_[rest], (slot[rest] + 1) & mask
        return out

    def merge(self, parts: list[bytes]) -> list[np.ndarray]:
        """The ids of each piece: the lowest rank, leftmost, merges first; all pieces advance together."""
        out: list[np.ndarray | None] = [None] * len(parts)
        short = []
        for i, p in enumerate(parts):
            whole = self.ranks.get(p)
            if whole is not None:
                out[i] = np.array([whole], dtype=np.uint32)
            elif len(p) > LONG_PIECE:
                out[i] = self._merge_long(p)
            else:
                short.append(i)
        if short:
            size = np.array([len(parts[i]) for i in short])
            ids = self.byte_ids[np.frombuffer(b"".join(parts[i] for i in short), dtype=np.uint8)]
            word = np.repeat(np.arange(len(short)), size)
            done: list[tuple[np.ndarray, np.ndarray]] = []
            rank = self._ranks_of(ids, word)
            while len(ids):
                first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                least = np.minimum.reduceat(rank, first)
                runs = np.diff(np.append(first, len(ids)))
                finished = least >= 1 << 40
                if finished.any():
                    gone = np.repeat(finished, runs)
                    done.append((word[gone], ids[gone]))
                    ids, word, rank = ids[~gone], word[~gone], rank[~gone]
                    continue
                best = np.flatnonzero(rank == np.repeat(least, runs))
                at = best[np.append(True, word[best[1:]] != word[best[:-1]])]  # the leftmost of each word
                ids[at] = rank[at]
                keep = np.ones(len(ids), dtype=bool)
                keep[at + 1] = False
                ids, word, rank = ids[keep], word[keep], rank[keep]
                at -= np.arange(len(at))  # where the merged ids are now
                changed = np.unique(np.concatenate((at, at[at > 0] - 1)))
                rank[changed] = self._ranks_at(ids, word, changed)
            if done:
                words = np.concatenate([w for w, _ in done])
                order = np.argsort(words, kind="stable")
                flat = np.concatenate([i for _, i in done])[order].astype(np.uint32)
                ends = np.cumsum(np.bincount(words, minlength=len(short))).tolist()
                for i, a, b in zip(short, [0, *ends[:-1]], ends, strict=True):
                    out[i] = flat[a:b]
        return out

    def _ranks_at(self, ids: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.full(len(at), 1 << 40, dtype=np.int64)
        inside = np.flatnonzero(at + 1 < len(ids))
        inside = inside[word[at[inside]] == word[at[inside] + 1]]
        out[inside] = self._rank(ids[at[inside]], ids[at[inside] + 1])
        return out

    def _ranks_of(self, ids: np.ndarray, word: np.ndarray) -> np.ndarray:
        return self._ranks_at(ids, word, np.arange(len(ids)))

    def _merge_long(self, piece: bytes) -> np.ndarray:
        ids = [int(self.byte_ids[b]) for b in piece]
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        get = self.pairs.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get((ids[i] << 20) | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j] = rank, False
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := get((rank << 20) | ids[k])) is not None:
                    heapq.heappush(heap, (r, i, rank, ids[k]))
            h = before[i]
            if h >= 0 and (r := get((ids[h] << 20) | rank)) is not None:
                heapq.heappush(heap, (r, h, ids[h], rank))
        return np.array([x for x, live in zip(ids, alive, strict=True) if live], dtype=np.uint32)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, end of each text's ids, byte offset of each id) of a buffer of texts."""
        starts = pieces(data, offsets)
        texts = len(offsets) - 1
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(texts, np.int64), np.zeros(0, np.int64)
        ids, _ = self.cache.encode(data, starts, self.merge)
        byte_sizes = np.diff(self.token_ends)[ids]
        at = np.cumsum(byte_sizes) - byte_sizes  # every byte is in exactly one id
        return ids, np.searchsorted(at, offsets[1:]), at

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, as one array."""
        size = (self.token_ends[1:] - self.token_ends[:-1])[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return np.zeros(0, np.uint8)
        return self.token_bytes[np.arange(ends[-1]) + np.repeat(self.token_ends[ids] - (ends - size), size)]


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of a file; it keeps its cache from batch to batch."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids and the byte offset of each id, of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text"), 1 << 20):
                ids, ends, at = own.encode(data, offsets)
                bounds = pa.array(np.concatenate(([0], ends)), pa.int32())
                local = at - np.repeat(offsets[:-1], np.diff(np.concatenate(([0], ends))))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (ids, local)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), *lists], ["doc_id", "ids", "offsets"])

    kind = docs.schema[id_col].dataType.simpleString()
    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<int>")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every whole text and decode its ids: the number of ids, and digests of the ids and of the decoded bytes.

    with_ids adds the ids themselves.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column("text"), 1 << 20):
                ids, ends, _ = own.encode(data, offsets)
                back = memoryview(own.decode(ids))
                size = np.diff(own.token_ends)
                firsts = np.concatenate(([0], ends))
                decoded = np.concatenate(([0], np.cumsum(size[ids])))[firsts].tolist()
                raw, cut = memoryview(ids.astype("<u4")).cast("B"), (firsts * 4).tolist()
                out = [
                    batch.column("doc_id").slice(lo, hi - lo),
                    pa.array(np.diff(firsts), pa.int64()),
                    pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(cut[:-1], cut[1:], strict=True)]),
                    pa.array([hashlib.sha256(back[a:b]).hexdigest() for a, b in zip(decoded[:-1], decoded[1:], strict=True)]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    kind = docs.schema[id_col].dataType.simpleString()
    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
