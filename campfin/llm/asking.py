"""Questions from parts of a table to buckets of keys, and their answers.

A part (a bounded number of rows) asks about keys: one row per part and bucket
holds the distinct keys as packed arrays.  The bucket sees each key at most
once a part and answers every part with those of its keys that hold:

* ``REPEATED``: another part has the key, or the part itself has it twice;
* ``LEAST``, ``LEAST_TOO``: a smaller number goes with the key elsewhere;
* ``DIFFERS``: different numbers go with the key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def least_by_key(keys: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys (sorted), the least document of each, and whether
    another document has the key too."""
    order = np.lexsort((docs, keys))
    k, d = keys[order], docs[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(k))[:len(first)] - 1
    return k[first], d[first], d[first] != d[last]


def known(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys


def later(keys: np.ndarray, docs: np.ndarray, least: tuple) -> np.ndarray:
    """Whether a smaller document of the part has the same key."""
    if not len(keys):
        return np.zeros(0, bool)
    return docs > least[1][np.searchsorted(least[0], keys)]


def cat(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


#: Rows between parts and buckets: bucket or part, what it is about, arrays.
REPEATED, LEAST, DIFFERS, LEAST_TOO = 0, 1, 2, 3
SENT = "bucket int, part int, kind int, a binary, b binary"
ANSWER = "part int, kind int, a binary"


def send(rows: list, part: int, kind: int, buckets: int, keys: np.ndarray, more: np.ndarray) -> None:
    """One row per bucket: the keys that fall into it and what goes with
    them.  Kinds have buckets of their own."""
    b = np.mod(keys, buckets)
    # numbers in order leave small steps between them
    order = np.lexsort((more, b)) if kind in (LEAST, LEAST_TOO) else np.argsort(b, kind="stable")
    keys, more, b = keys[order], more[order], b[order]
    cut = np.searchsorted(b, np.arange(buckets + 1))
    for k in range(buckets):
        if cut[k] < cut[k + 1]:
            s = slice(cut[k], cut[k + 1])
            rows.append((kind * buckets + k, part, kind, _narrow(keys[s], kind), _with(more[s], kind)))


def _six(x: np.ndarray) -> bytes:
    """48-bit numbers in six bytes each."""
    return (x & 0xFFFFFFFF).astype("<u4").tobytes() + (x >> 32).astype("<u2").tobytes()


def _from_six(b: bytes) -> np.ndarray:
    n = len(b) // 6
    return np.frombuffer(b, "<u4", n).astype(np.int64) | np.frombuffer(b, "<u2", n, 4 * n).astype(np.int64) << 32


def _narrow(keys: np.ndarray, kind: int) -> bytes:
    return _six(keys) if kind in (REPEATED, DIFFERS) else keys.tobytes()


def _widen(b: bytes, kind: int) -> np.ndarray:
    return _from_six(b) if kind in (REPEATED, DIFFERS) else np.frombuffer(b, np.int64)


def _with(x: np.ndarray, kind: int) -> bytes:
    if kind == REPEATED:
        return np.packbits(x.astype(bool)).tobytes()
    if kind == DIFFERS:  # 48 bits of a hash; 0 stays 0 and nothing else becomes it
        high = (x.view(np.uint64) >> np.uint64(16)).astype(np.int64)
        return _six(np.where((high == 0) & (x != 0), 1, high))
    steps = np.diff(x)
    size = next(w for w in (1, 2, 4, 8) if w == 8 or not len(steps) or steps.max() < 1 << 8 * w)
    return x[:1].astype("<i8").tobytes() + bytes([size]) + steps.astype(f"<u{size}").tobytes()


def _without(b: bytes, kind: int, n: int) -> np.ndarray:
    if kind == REPEATED:
        return np.unpackbits(np.frombuffer(b, np.uint8), count=n)
    if kind == DIFFERS:
        return _from_six(b)
    steps = np.frombuffer(b, f"<u{b[8]}", offset=9).astype(np.int64)
    return np.cumsum(np.concatenate((np.frombuffer(b, "<i8", 1), steps)))


def sent(rows: list) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[]] * 5
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], ["bucket", "part", "kind", "a", "b"])


def answers(table: pa.Table, kind: int) -> np.ndarray:
    """The sorted keys that buckets answered for one kind."""
    found = [_widen(a.as_py(), kind) for a, k in zip(table.column("a"), table.column("kind").to_pylist())
             if k == kind]
    return np.sort(cat(found))


def answer(table: pa.Table) -> pa.Table:
    """A bucket: which of each part's keys another part (or, for settled keys,
    a smaller document of another part) has too."""
    kind = table.column("kind")[0].as_py()
    parts = table.column("part").to_pylist()
    keys = [_widen(a.as_py(), kind) for a in table.column("a")]
    more = np.concatenate([_without(x.as_py(), kind, len(k)) for x, k in zip(table.column("b"), keys)])
    ends = np.cumsum([len(k) for k in keys])
    keys = np.concatenate(keys)
    if kind in (LEAST, LEAST_TOO):  # b: the part's least document of the key
        yes = later(keys, more, least_by_key(keys, more))
    elif kind == REPEATED:  # b: whether the part itself has it in two documents
        uniq, inv, n = np.unique(keys, return_inverse=True, return_counts=True)
        yes = (n + np.bincount(inv, more, len(uniq)) > 1)[inv]
    else:  # b: the part's value of the key, 0 where it has several
        uniq, inv = np.unique(keys, return_inverse=True)
        lo, hi = np.full(len(uniq), np.iinfo(np.int64).max), np.full(len(uniq), np.iinfo(np.int64).min)
        np.minimum.at(lo, inv, more)
        np.maximum.at(hi, inv, more)
        several = np.zeros(len(uniq), bool)
        np.logical_or.at(several, inv, more == 0)
        yes = (several | (lo != hi))[inv]
    cut = [0, *ends.tolist()]
    out = [(p, kind, _narrow(k, kind)) for p, a, e in zip(parts, cut, cut[1:])
           if len(k := keys[a:e][yes[a:e]])]
    cols = list(zip(*out)) if out else [[]] * 3
    return pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary()))],
                    ["part", "kind", "a"])
