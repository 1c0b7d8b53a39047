"""Adaptive context-mixing range coder for token ids under 65536, in blocks that are coded side by side with numpy.

A frame holds the ids of some documents. They are cut into blocks of equal length (the last may be shorter); each block starts from the
frame's first model, has its own checksum and can be decoded alone. All blocks of a frame advance one id at a time, a lane of an array each.

The first model stands in the frame's head: the frequencies of its ids (order 0), and for each id those that often follow it with their
frequencies (order 1, up to LIST). Within a block the id last seen after the same two ids, with a confidence from 0 to 7, predicts by order 2. An id
is coded in up to three steps:
- whether it is the candidate of order 2, or, after two ids not seen together yet, the first of order 1. Three probabilities of that,
  stretch(p) = ln(p / (1 - p)) each, are mixed with weights that learn: an adaptive one of the confidence (order 2), an adaptive one of the first
  follower's share and whether it is the candidate (order 1), and the candidate's frequency (order 0);
- else which follower of order 1 it is, the candidate left out, or none;
- else which id by order 0.
A carryless range coder of 64 bits writes words of 16 bits. All arithmetic is on integers, so any machine decodes the same.

Layout of a frame, little-endian: magic, n_docs, n_ids, block, size of what follows but the last checksum; doc_ids (int64), lengths (uint32);
size of the packed first model (uint32) and the model; for each block its bytes and the CRC-32 of its ids as uint16 (uint32 each); the coded words;
CRC-32 of all before; a line feed. The model, packed by zlib: number of ids (uint32), the ids and their frequencies less one (uint16 each), the
number of followers of each (uint8), the followers' places among the ids and their frequencies (uint16 each).
"""

from __future__ import annotations

import struct
import zlib
from decimal import Decimal
from functools import cache

import numpy as np

MAGIC = b"TSQ2"
HEAD = struct.Struct("<4sIIII")
BLOCK = 1024
#: Followers of an id in the first model; bits that one must save to be listed.
LIST, WORTH = 63, 40
_S2 = 10  # bits of a lane's table of order 2
_BOT, _TOP = np.uint64(1 << 44), np.uint64(1 << 48)
_U = np.uint64
#: First probabilities of a candidate of order 2 by its confidence, in 1/65536; first weights in 1/65536.
_FIRST2 = np.array([4, 8, 16, 26, 34, 40, 46, 54], np.int32) << 10
_WEIGHTS = (22_000, 36_000, 6_000)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """stretch for p of 12 bits, in 1/256, and its inverse, 4096 / (1 + exp(-x)), by decimal arithmetic, which is the same everywhere."""
    squash = np.array([int(4096 / (1 + (Decimal(2048 - i) / 256).exp())) for i in range(4096)])
    stretch = np.searchsorted(squash, np.arange(4096)).clip(1, 4095) - 2048
    return stretch.astype(np.int32), squash.clip(1, 4095).astype(np.int32)


class First:
    """The first model of a frame. Ids are known by their places in `ids`; the place after the last stands for the start of a block."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray, many: np.ndarray, place: np.ndarray, share: np.ndarray):
        self.ids, self.freq, self.many, self.place, self.share = ids, freq, many.astype(np.int64), place, share
        many = self.many
        n = len(ids)
        self.cum0 = np.concatenate([[0], np.cumsum(freq.astype(np.int64))]).astype(np.uint32)
        self.by0 = np.repeat(np.arange(n, dtype=np.uint16), freq)
        row, column = np.repeat(np.arange(n), many), np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)
        self.follow = np.full((n + 1, LIST + 1), 0xFFFF, np.uint16)
        self.follow[row, column] = place
        size = np.zeros((n + 1, LIST + 1), np.int32)
        size[row, column] = share
        size[:, LIST] = 4096 - size.sum(axis=1)
        self.cum1 = np.zeros((n + 1, LIST + 2), np.int32)
        np.cumsum(size, axis=1, out=self.cum1[:, 1:])
        self.cum1 = self.cum1.astype(np.uint16)
        self.top = np.where(size[:, 0] > 0, self.follow[:, 0], 0xFFFF).astype(np.uint16)
        self.top_share = size[:, 0].astype(np.uint16)
        stretch, _ = _tables()
        self.stretch0 = np.full(1 << 16, stretch[1], np.int32)
        self.stretch0[:n] = stretch[(freq.astype(np.int64) >> 4).clip(1, 4095)]

    @staticmethod
    def of(ids: np.ndarray) -> tuple[First, np.ndarray]:
        """The model of these ids, and their places in it."""
        count = np.bincount(ids, minlength=1 << 16)
        known = np.flatnonzero(count)
        n, where = len(known), np.zeros(1 << 16, np.uint16)
        where[known] = np.arange(n)
        at = where[ids]
        freq = 1 + count[known] * ((1 << 16) - n) // max(len(ids), 1)
        if n:
            freq[int(freq.argmax())] += (1 << 16) - int(freq.sum())
        pairs = np.sort((at[:-1].astype(np.uint32) << np.uint32(16)) | at[1:])
        edge = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
        times = np.diff(np.append(edge, len(pairs)))
        often = times > 2
        key, times = pairs[edge][often], times[often]
        a, x = (key >> np.uint32(16)).astype(np.int64), (key & np.uint32(0xFFFF)).astype(np.int64)
        good = times * np.log2(times * 65536.0 / (count[known][a] * freq[x])) > WORTH  # bits saved against order 0
        a, x, times = a[good], x[good], times[good]
        order = np.lexsort((x, -times, a))
        a, x, times = a[order], x[order], times[order]
        rank = np.arange(len(a)) - np.searchsorted(a, a)
        a, x, times = a[rank < LIST], x[rank < LIST], times[rank < LIST]
        share = np.maximum(times * 4080 // np.maximum(count[known][a], 1), 1)
        return First(known.astype(np.uint16), freq.astype(np.uint32), np.bincount(a, minlength=n).astype(np.uint8), x.astype(np.uint16), share.astype(np.uint16)), at

    def pack(self) -> bytes:
        parts = (self.ids.astype("<u2"), (self.freq - 1).astype("<u2"), self.many.astype("u1"), self.place.astype("<u2"), self.share.astype("<u2"))
        return zlib.compress(struct.pack("<I", len(self.ids)) + b"".join(x.tobytes() for x in parts), 6)

    @staticmethod
    def unpack(data: bytes) -> First:
        raw = zlib.decompress(data)
        n = struct.unpack_from("<I", raw)[0]
        ids, freq, many = np.frombuffer(raw, "<u2", n, 4), np.frombuffer(raw, "<u2", n, 4 + 2 * n), np.frombuffer(raw, "u1", n, 4 + 4 * n)
        m = int(many.sum())
        return First(ids, freq.astype(np.uint32) + 1, many, np.frombuffer(raw, "<u2", m, 4 + 5 * n), np.frombuffer(raw, "<u2", m, 4 + 5 * n + 2 * m))


def _shift(low, rng, n, words, at, code=None):
    """Write words of the first n lanes until the range suffices again, or read as many where code is given."""
    todo, lo, r = None, low[:n], rng[:n]
    while True:
        same = (lo ^ (lo + r)) < _TOP
        need = np.flatnonzero(same | (r < _BOT))
        if not len(need):
            return
        lo, r = lo.take(need), r.take(need)
        cut = np.flatnonzero(~same.take(need))
        if len(cut):
            r[cut] = (_U(0) - lo[cut]) & (_BOT - _U(1))
        todo = need if todo is None else todo.take(need)
        here = at.take(todo)
        place = here + todo * words.shape[1]
        if code is None:
            words.reshape(-1)[place] = lo >> _U(48)
        else:
            code[todo] = code.take(todo) << _U(16) | words.reshape(-1).take(place)
        at[todo] = here + 1
        lo, r = lo << _U(16), r << _U(16)
        low[todo], rng[todo] = lo, r


def _run(first: First, grid: np.ndarray, lengths: np.ndarray, words: np.ndarray, decode: bool) -> np.ndarray:
    """Code (or decode) the lanes of places in the first model (lane, step), lengths not rising; returns the number of words of each lane."""
    lanes, steps = grid.shape
    stretch, squash = _tables()
    lane = np.arange(lanes)
    t2 = np.zeros(lanes << _S2, np.uint32)  # place, and confidence from bit 16 on
    p2 = np.tile(_FIRST2, lanes)
    p1 = np.tile(np.concatenate([np.full(16, 1 << 11, np.int32), (np.arange(16, dtype=np.int32) << 12) + (1 << 11)]), lanes)
    weights = [np.full(lanes, w, np.int32) for w in _WEIGHTS]
    low, rng, at = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64), np.zeros(lanes, np.int64)
    code = None
    if decode:
        code = np.zeros(lanes, np.uint64)
        for i in range(4):
            code = code << _U(16) | words[:, i].astype(np.uint64)
        at[:] = 4
    columns = np.ascontiguousarray(grid.T)
    base2, base3, base5 = (lane << n for n in (_S2, 3, 5))
    last, before = np.full(lanes, len(first.ids), np.int64), np.zeros(lanes, np.int64)
    follow, cum1, cum0, by0 = first.follow, first.cum1, first.cum0, first.by0
    cum1_flat, step1 = cum1.reshape(-1), LIST + 2
    share_bucket = (first.top_share >> 8).astype(np.int64)
    for t in range(steps):
        n = int(np.searchsorted(-lengths, -t))  # lanes that have an id here
        a, b = last[:n], before[:n]
        i2 = base2[:n] + (((a * 40503 ^ b * 60493) * 52711 & 0xFFFF) >> (16 - _S2))
        entry = t2.take(i2)
        seen, conf = entry.astype(np.uint16), (entry >> np.uint32(16)).astype(np.int64)
        top = first.top.take(a)
        cand = np.where(conf > 0, seen, top)
        agree = cand == top
        j2, j1 = base3[:n] + conf, base5[:n] + share_bucket.take(a) + (agree << 4)
        q2, q1 = p2.take(j2), p1.take(j1)
        s2, s1, s0 = stretch.take(q2 >> 4), stretch.take(q1 >> 4), first.stretch0.take(cand)
        w2, w1, w0 = weights[0][:n], weights[1][:n], weights[2][:n]
        p = squash.take(((w2 * s2 + w1 * s1 + w0 * s0) >> 16) + 2048, mode="clip")
        part = (rng[:n] >> _U(12)) * p.astype(np.uint64)
        if decode:
            hit = code[:n] - low[:n] < part
            x = cand.copy()
        else:
            x = columns[t, :n]
            hit = x == cand
        rest = np.flatnonzero(~hit)
        rng[:n] = np.where(hit, part, rng[:n] - part)
        if len(rest):
            row = a.take(rest)
            lo, r = low.take(rest) + part.take(rest), rng.take(rest)
            out = np.where(agree.take(rest), first.top_share.take(row), 0).astype(np.uint64)  # the candidate is none of the rest
            r //= _U(4096) - out
            if decode:
                here = code.take(rest)
                q = ((here - lo) // r + out).astype(np.uint16)
                k = (cum1[:, 1 : LIST + 1].take(row, axis=0) <= q[:, None]).sum(axis=1)
                y = follow.reshape(-1).take(row * (LIST + 1) + k)
            else:
                y = x.take(rest)
                same = follow.take(row, axis=0) == y[:, None]
                same[:, LIST] = True
                k = same.argmax(axis=1)
            cell = row * step1 + k
            start = cum1_flat.take(cell).astype(np.uint64)
            lo += r * (start - out)
            r *= cum1_flat.take(cell + 1).astype(np.uint64) - start
            none = np.flatnonzero(k == LIST)
            if len(none):
                piece = r.take(none) >> _U(16)
                if decode:
                    y[none] = by0.take(((here.take(none) - lo.take(none)) // piece).astype(np.int64), mode="clip")
                z = y.take(none)
                start = cum0.take(z).astype(np.uint64)
                lo[none] += piece * start
                r[none] = piece * (cum0.take(z.astype(np.int64) + 1).astype(np.uint64) - start)
            low[rest], rng[rest] = lo, r
            if decode:
                x[rest] = y
        if decode:
            columns[t, :n] = x
        _shift(low, rng, n, words, at, code)
        goal = hit.astype(np.int32)
        err = (goal << 12) - p
        for w, s in ((w2, s2), (w1, s1), (w0, s0)):
            w += (s * err) >> 12
        goal <<= 16
        goal -= goal >> 10
        p2[j2] = q2 + ((goal - q2) >> 5)
        p1[j1] = q1 + ((goal - q1) >> 5)
        # right: one more, up to 7; wrong: half the confidence, and from 1 down the new id takes the place
        kept = entry & np.uint32(0xFFFF) | (conf >> 1).astype(np.uint32) << np.uint32(16)
        t2[i2] = np.where((x == seen) & (conf > 0), entry + (conf < 7) * np.uint32(1 << 16), np.where(conf > 1, kept, x.astype(np.uint32) | np.uint32(1 << 16)))
        before[:n] = a
        last[:n] = x
    if decode:
        grid[:] = columns.T
        return at
    for i in range(4):  # what is left of low
        words[lane, at] = (low >> _U(48)).astype(np.uint16)
        low <<= _U(16)
        at += 1
    return at


def _lengths(n: int, block: int) -> np.ndarray:
    """Ids of each block."""
    size = np.full(-(-n // block), block, np.int64)
    if n:
        size[-1] = n - block * (len(size) - 1)
    return size


def encode_frame(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A frame of documents whose ids (uint16) follow one another."""
    size = _lengths(len(ids), block)
    lanes, steps = len(size), int(size.max(initial=0))
    first, at = First.of(ids)
    padded = np.zeros(lanes * block, np.uint16)
    padded[: len(ids)] = at
    grid = padded.reshape(lanes, block)
    words = np.zeros((lanes, 3 * steps + 12), np.uint16)
    used = _run(first, grid[:, :steps], size, words, False) if lanes else np.zeros(0, np.int64)
    index = np.empty((lanes, 2), "<u4")
    index[:, 0] = 2 * used
    index[:, 1] = [zlib.crc32(ids[i * block : i * block + n].astype("<u2").tobytes()) for i, n in enumerate(size.tolist())]
    coded = b"".join(words[i, : used[i]].astype("<u2").tobytes() for i in range(lanes))
    model = first.pack()
    body = doc_ids.astype("<i8").tobytes() + lengths.astype("<u4").tobytes() + struct.pack("<I", len(model)) + model + index.tobytes() + coded
    frame = HEAD.pack(MAGIC, len(doc_ids), len(ids), block, len(body)) + body
    return frame + struct.pack("<I", zlib.crc32(frame))


def decode_frame(data: bytes, at: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """doc_ids, lengths and ids of the frame at this place, and where the next begins. Raises ValueError if a checksum is wrong."""
    if len(data) < at + HEAD.size + 4:
        raise ValueError("frame cut short")
    magic, docs, n, block, size = HEAD.unpack_from(data, at)
    end = at + HEAD.size + size
    if magic != MAGIC or len(data) < end + 4 or zlib.crc32(memoryview(data)[at:end]) != struct.unpack_from("<I", data, end)[0]:
        raise ValueError("frame damaged")
    pos = at + HEAD.size
    doc_ids, lengths = np.frombuffer(data, "<i8", docs, pos), np.frombuffer(data, "<u4", docs, pos + 8 * docs)
    pos += 12 * docs
    packed = struct.unpack_from("<I", data, pos)[0]
    first = First.unpack(data[pos + 4 : pos + 4 + packed])
    pos += 4 + packed
    size = _lengths(n, block)
    lanes, steps = len(size), int(size.max(initial=0))
    index = np.frombuffer(data, "<u4", 2 * lanes, pos).reshape(lanes, 2)
    pos += 8 * lanes
    used = index[:, 0].astype(np.int64) // 2
    words = np.zeros((lanes, int(used.max(initial=0)) + 8), np.uint16)
    for i, w in enumerate(used):
        words[i, :w] = np.frombuffer(data, "<u2", w, pos)
        pos += 2 * int(w)
    grid = np.zeros((lanes, steps), np.uint16)
    if lanes:
        _run(first, grid, size, words, True)
        grid = first.ids[np.minimum(grid, len(first.ids) - 1)]
    for i in range(lanes):
        if zlib.crc32(grid[i, : size[i]].astype("<u2").tobytes()) != index[i, 1]:
            raise ValueError(f"block {i} damaged")
    return doc_ids, lengths, grid.reshape(-1)[:n], end + 4
