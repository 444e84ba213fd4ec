"""Words of whole texts as arrays of 64-bit hashes, for use inside Spark tasks.

A word is a run of bytes other than space and 0x09 to 0x0D, with A-Z lower-cased. A hash is a
polynomial over the word's bytes modulo 2**64, read from one running sum over the whole buffer and
then mixed, so no Python object is made per word. Two different words collide with a probability of
about 2**-60; a hundred million distinct words or shingles have a collision about once in a
thousand runs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19  # text that is hashed at once; bounds a task's memory whatever a text's length
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: a bijection that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    step = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(step + np.uint64(seed))


VALUES = stream(256, 17)
BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int) -> np.ndarray:
    out = np.full(CHUNK_BYTES + 2, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS: list[np.ndarray] = []


def powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS:
        _POWERS.extend((_powers(BASE), _powers(INVERSE)))
    return _POWERS[0], _POWERS[1]


def running(buffer: np.ndarray) -> np.ndarray:
    """Running sums of which any span's hash can be read; one entry more than the buffer."""
    out = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum(VALUES[buffer] * powers()[0][: len(buffer)], out=out[1:])
    return out


def spans(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of buffer[starts:ends]."""
    return mix((sums[ends] - sums[starts]) * powers()[1][starts])


def bounds(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end."""
    edge = np.diff(np.concatenate(([False], ~SPACE[buffer], [False])).view(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def parts(text: bytes) -> Iterator[bytes]:
    """A text in pieces of about CHUNK_BYTES that end between words, longer where a word is."""
    at = 0
    while len(text) - at > CHUNK_BYTES:
        cut = max(text.rfind(c, at, at + CHUNK_BYTES) for c in _SPACES)
        if cut < at:
            cut = min((i for i in (text.find(c, at + CHUNK_BYTES) for c in _SPACES) if i >= 0), default=len(text) - 1)
        yield text[at : cut + 1]
        at = cut + 1
    yield text[at:]


_SPACES = [bytes([c]) for c in np.flatnonzero(SPACE)]


def long_hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words, some beyond CHUNK_BYTES: such a one folds its pieces' hashes."""
    out = []
    for a, b in zip(starts.tolist(), ends.tolist()):
        folded = None
        for i in range(a, b, CHUNK_BYTES):
            piece = np.frombuffer(text[i : min(b, i + CHUNK_BYTES)], dtype=np.uint8)
            own = spans(running(piece), np.array([0]), np.array([len(piece)]))
            folded = own if folded is None else mix(folded * np.uint64(BASE) + own)
        out.append(folded[0])
    return np.array(out, dtype=np.uint64)


def _hash_buffer(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    buffer = np.frombuffer(data, dtype=np.uint8)
    starts, ends = bounds(buffer)
    if len(data) > CHUNK_BYTES + 1:
        return long_hashes(data, starts, ends), starts
    return spans(running(buffer), starts, ends), starts


def chunked(texts: Iterable[bytes | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of CHUNK_BYTES together at most, with the first one's index; a longer text stands alone."""
    group: list[bytes] = []
    first = held = 0
    for i, text in enumerate(texts):
        text = text or b""
        if group and held + len(text) + 1 > CHUNK_BYTES:
            yield first, group
            group, first, held = [], i, 0
        group.append(text)
        held += len(text) + 1
    if group:
        yield first, group


def hashed(texts: Iterable[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of texts: the first one's index, the hashes of all words, and offsets per text (one more than texts).

    A null or empty text has no words.
    """
    for first, group in chunked(texts):
        if len(group) == 1 and len(group[0]) + 1 > CHUNK_BYTES:
            text = group[0].lower()
            hashes = np.concatenate([_hash_buffer(p)[0] for p in parts(text)])
            yield first, hashes, np.array([0, len(hashes)])
            continue
        hashes, starts = _hash_buffer(b" ".join(group).lower())
        at = np.cumsum([0, *(len(t) + 1 for t in group)])
        yield first, hashes, np.searchsorted(starts, at)


#: 0 for space, 1 for letters, digits and other than ASCII, 2 for marks
KINDS = np.array([0 if SPACE[c] else 1 if c >= 0x80 or chr(c).isalnum() else 2 for c in range(256)], dtype=np.int8)


def hashed_runs(texts: Sequence[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """As hashed(), for runs of letters and digits and runs of marks, in their own case.

    A long text is read in parts that end between words, so no run is cut.
    """
    for first, group in chunked(texts):
        whole = b" ".join(group)
        hashes, starts, at = [], [], 0
        for part in parts(whole) if len(whole) > CHUNK_BYTES else [whole]:
            kind = KINDS[np.frombuffer(part, dtype=np.uint8)]
            edges = np.flatnonzero(np.diff(np.concatenate(([-1], kind, [-1]))))
            begin, end = edges[:-1], edges[1:]
            keep = kind[begin] > 0 if len(part) else np.zeros(0, dtype=bool)
            begin, end = begin[keep], end[keep]
            if len(part) > CHUNK_BYTES + 1:
                hashes.append(long_hashes(part, begin, end))
            else:
                hashes.append(spans(running(np.frombuffer(part, dtype=np.uint8)), begin, end))
            starts.append(begin + at)
            at += len(part)
        edges = np.cumsum([0, *(len(t) + 1 for t in group)])
        yield first, np.concatenate(hashes), np.searchsorted(np.concatenate(starts), edges)


def shingled(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of n words, in order, with offsets; a shorter text's whole sequence is one."""
    counts = np.diff(offsets)
    rows = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    out_offsets = np.concatenate(([0], np.cumsum(rows)))
    out = np.zeros(out_offsets[-1], dtype=np.uint64)
    salts = stream(n, 29) | np.uint64(1)
    full = np.zeros(len(hashes), dtype=np.uint64)
    for i in range(n):
        full[: len(hashes) - i] += hashes[i:] * salts[i]
    long = counts >= n
    take = ranges(offsets[:-1][long], rows[long])
    put = ranges(out_offsets[:-1][long], rows[long])
    out[put] = full[take]
    for t in np.flatnonzero((counts > 0) & (counts < n)):
        words = hashes[offsets[t] : offsets[t + 1]]
        out[out_offsets[t]] = (words * salts[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))
    return mix(out), out_offsets


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers starts[0], starts[0] + 1, ... for each run, one after the other."""
    lengths = np.asarray(lengths)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    begin = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(np.asarray(starts) - begin, lengths)




def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values sorted and without repetition, with offsets."""
    values = values.copy()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        values[a:b].sort()
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = values[1:] != values[:-1]
    keep[offsets[:-1][np.diff(offsets) > 0]] = True
    return values[keep], np.concatenate(([0], np.cumsum(keep)))[offsets]


class as_bytes(Sequence):  # noqa: N801
    """A text or binary Arrow column, whose values are made one by one where they are read."""

    def __init__(self, column: pa.Array):
        self.column = column

    def __len__(self) -> int:
        return len(self.column)

    def __getitem__(self, i: int) -> bytes | None:
        value = self.column[i].as_py()
        return value.encode() if isinstance(value, str) else value
