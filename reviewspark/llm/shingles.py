"""Word-shingle sets of whole texts, vectorised over a batch (numpy inside tasks)."""

from __future__ import annotations

import numpy as np

from .common import worker_memory

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)                       # odd, so powers can be undone modulo 2^64
_PINV = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_C = _U(0xD6E8FEB86659FD93)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_CHUNK = 1 << 19                                  # bytes handled at a time; one longer text is handled whole
_ROWS = 1024                                      # texts handled at a time: callers keep sketches of 6.4 kB for each


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (a bijection with good avalanche)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _byte_table() -> np.ndarray:
    t = mix(np.arange(1, 257, dtype=np.uint64) * _P)
    t[65:91] = t[97:123]  # A-Z count as a-z
    return t


_BYTE = _byte_table()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers and their inverses; a usual run's are kept, longer ones are made for the call."""
    kept = worker_memory().get("powers")
    if kept is not None and len(kept[0]) >= n:
        return kept
    size = max(n, _CHUNK + 1)
    made = []
    for base in (_P, _PINV):
        a = np.full(size, base, np.uint64)
        a[0] = 1
        made.append(np.multiply.accumulate(a))
    if size <= 2 * _CHUNK:
        worker_memory()["powers"] = tuple(made)
    return made[0], made[1]


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, its document) for documents ``data[offs[i]:offs[i+1]]``.

    Words are maximal runs without ASCII white space, A-Z lower-cased.
    """
    n = len(data)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    solid = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    gap = np.empty(n + 1, bool)  # a word cannot go on across position i
    gap[0] = gap[n] = True
    gap[1:n] = ~solid[:-1] | ~solid[1:]
    gap |= edge
    starts = np.flatnonzero(solid & gap[:-1])
    ends = np.flatnonzero(solid & gap[1:]) + 1
    p, inv = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * p[:n], out=total[1:])
    words = (total[ends] - total[starts]) * inv[starts]
    doc = np.searchsorted(offs, starts, "right") - 1
    return mix(words ^ (ends - starts).astype(np.uint64)), doc


def _sets_of(data, offs, k):
    docs = len(offs) - 1
    w, doc = word_hashes(data, offs)
    count = np.bincount(doc, minlength=docs) if len(doc) else np.zeros(docs, np.int64)
    first = np.concatenate([[0], np.cumsum(count)])
    n = len(w)
    if n >= k:
        s = w[:n - k + 1].copy()
        for j in range(1, k):
            s = s * _C + w[j:n - k + 1 + j]
        s = mix(s)
        whole = doc[:n - k + 1] == doc[k - 1:]
    else:
        s, whole = np.empty(0, np.uint64), np.empty(0, bool)
    sizes = np.maximum(count - k + 1, 0)
    short = np.flatnonzero((count > 0) & (count < k))
    sizes[short] = 1
    at = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(at[-1], np.uint64)
    is_short = np.zeros(docs, bool)
    is_short[short] = True
    slot_short = np.repeat(is_short, sizes)
    out[~slot_short] = s[whole]
    for d in short:  # the whole sequence as one, told apart by its length
        h = _U(int(count[d]))
        with np.errstate(over="ignore"):
            for x in w[first[d]:first[d + 1]]:
                h = h * _C + x
        out[at[d]] = mix(np.array([h], np.uint64))[0]
    keep = np.ones(len(out), bool)
    for d in range(docs):
        a, b = at[d], at[d + 1]
        if b - a > 1:
            part = out[a:b]
            part.sort()
            keep[a + 1:b] = part[1:] != part[:-1]
    per = np.add.reduceat(keep, at[:-1][sizes > 0]) if at[-1] else np.empty(0, np.int64)
    final = np.zeros(docs, np.int64)
    final[sizes > 0] = per
    return out[keep], np.concatenate([[0], np.cumsum(final)])


def string_buffers(arr) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string array (nulls are empty), without copying the texts."""
    import pyarrow as pa

    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    wide = pa.types.is_large_string(arr.type)
    offs = np.frombuffer(arr.buffers()[1], np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1] \
        if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(arr.buffers()[2] or b"", np.uint8)
    return data, offs.astype(np.int64)


def shingle_sets(arr, k: int = 5):
    """Yield (first row, sorted distinct 64-bit shingle hashes, offsets) for runs of rows of a string array.

    A text of fewer than ``k`` words has its whole word sequence as one shingle; one without words has none.
    """
    data, offs = string_buffers(arr)
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + _CHUNK, "right")) - 1
        j = min(n, i + _ROWS, max(j, i + 1))
        part = offs[i:j + 1]
        with np.errstate(over="ignore"):
            s, at = _sets_of(data[part[0]:part[-1]], part - part[0], k)
        yield i, s, at
        i = j
