"""Words of many texts at once, as 64-bit hashes computed with numpy over concatenated bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: Maps A-Z to a-z and the separators \x20 and \x09-\x0D to a space.
FOLD = bytes(32 if c in (9, 10, 11, 12, 13, 32) else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: The same without the change of case.
KEEP = bytes(32 if c in (9, 10, 11, 12, 13, 32) else c for c in range(256))
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes of texts that are worked on together, and of a piece of a very long one.
CHUNK, PIECE = 1 << 18, 1 << 21
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, elementwise."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _pow, _inv
    if len(_pow) < n:
        n = max(n, CHUNK * 2)
        p, q = np.full(n, _P), np.full(n, _P_INV)
        p[0] = q[0] = 1
        _pow, _inv = np.cumprod(p, dtype=np.uint64), np.cumprod(q, dtype=np.uint64)
    return _pow, _inv


def chunks(texts: Iterable[str | None], size: int = CHUNK) -> Iterator[list[bytes]]:
    """UTF-8 bytes of the texts (null: empty), in lists of about size bytes."""
    out, n = [], 0
    for t in texts:
        b = t.encode("utf-8", "surrogatepass") if t else b""
        out.append(b)
        n += len(b)
        if n >= size:
            yield out
            out, n = [], 0
    if out:
        yield out


def _pieces(data: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """The bytes in pieces of about PIECE, with where each begins, cut behind a space: words stay whole, however long one is."""
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= 2 * PIECE else data.find(b" ", at + PIECE) + 1 or len(data)
        yield at, np.frombuffer(data, np.uint8, end - at, at)
        at = end


def word_hashes(texts: list[bytes], fold: bytes = FOLD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words; where each text's words begin in them (one more entry than texts); starts and ends of words
    in bytes, from the beginning of their own text. Very long texts go through in pieces, so that memory beyond the results is bounded."""
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    first_byte = np.concatenate([[0], np.cumsum(lengths)])
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for at, data in _pieces(b" ".join([*texts, b""]).translate(fold)):
        edge = np.flatnonzero(np.diff(data != 32, prepend=False, append=False))
        starts, ends = edge[0::2], edge[1::2]
        pow_, inv = _powers(len(data) + 1)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data.astype(np.uint64) * pow_[: len(data)], dtype=np.uint64)])
        h = mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        found.append((h, starts + at, ends + at))
    h, starts, ends = (np.concatenate(x) for x in zip(*found, strict=True)) if len(found) != 2 else found[1]
    bounds = np.searchsorted(starts, first_byte)
    base = np.repeat(first_byte[:-1], np.diff(bounds))
    return h, bounds, starts - base, ends - base


def shingles(h: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words at every word where they fit into the text, and whether they fit.
    A text of fewer words has its whole sequence as one, at its first word."""
    n = len(h)
    out = np.zeros(n, np.uint64)
    for j in range(min(k, n)):
        out[: n - j] = out[: n - j] * np.uint64(0xA0761D6478BD642F) + h[j:]
    end = np.repeat(bounds[1:], np.diff(bounds))
    fits = np.arange(n) + k <= end
    out = mix(out)
    counts = np.diff(bounds)
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        a, b = bounds[i], bounds[i + 1]
        v = np.uint64(b - a)
        with np.errstate(over="ignore"):
            for x in h[a:b]:
                v = v * np.uint64(0xE7037ED1A0B428DB) + x
        out[a] = mix(np.array([v]))[0]
        fits[a] = True
    return out, fits


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """Each text's distinct shingles, sorted."""
    h, bounds, _, _ = word_hashes(texts)
    s, fits = shingles(h, bounds, k)
    return [np.unique(s[a:b][fits[a:b]]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
