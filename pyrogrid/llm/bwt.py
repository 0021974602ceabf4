"""Column-wise construction of a collection's Burrows-Wheeler transform and common prefixes.

Every round inserts one more symbol of each sequence, from the right: the suffixes that begin with it.  The
transform (the symbol before each sorted suffix), the common prefixes of neighbouring suffixes and their names
(sequence and start) lie in files that a round reads once from front to back and writes once.

A new suffix cS stands where its symbol's run begins, moved on by how many suffixes before S have c in
front of them; its common prefix with its neighbour in that run is one more than the least common prefix between
their tails, which are neighbours among the suffixes with c in front.
"""

from __future__ import annotations

from pathlib import Path

import numpy as np

END = 0  # in front of whole sequences; symbols are 1 and up


class Files:
    """One round's transform, common prefixes and names; a round's files are new ones, and go once they are read."""

    def __init__(self, folder: Path, sequences: int, most: int):
        self.folder, self.span = folder, most + 1  # a name is sequence * span + start
        small = np.uint8 if most < 256 else np.uint16
        self.kinds = (("bwt", np.uint16), ("lcp", small), ("name", np.int32 if sequences * self.span < 1 << 31 else np.int64))

    def write(self, round_: int, *arrays: np.ndarray) -> None:
        for (kind, dtype), a in zip(self.kinds, arrays, strict=True):
            a.astype(dtype, copy=False).tofile(self.folder / f"{kind}.{round_}")

    def read(self, round_: int) -> list[np.ndarray]:
        out = []
        for kind, dtype in self.kinds:
            path = self.folder / f"{kind}.{round_}"
            out.append(np.fromfile(path, dtype))
            path.unlink()
        return out


def merged(old: np.ndarray, at: np.ndarray, new: np.ndarray) -> np.ndarray:
    """old with the entries of new at the places at of the result."""
    out = np.empty(len(old) + len(new), old.dtype)
    free = np.ones(len(out), bool)
    free[at] = False
    out[free] = old
    out[at] = new
    return out


def by_place(places: np.ndarray, n: int) -> np.ndarray:
    """The order of places, which are different ones of n."""
    at = np.full(n, -1, np.int32)
    at[places] = np.arange(len(places), dtype=np.int32)
    return at[at >= 0]


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of symbols from the right, with END beyond a sequence's first symbol; and the sequences' sizes."""
    sizes = np.array([len(s) for s in sequences], np.int64)
    right = np.zeros((len(sequences), int(sizes.max(initial=0)) + 1), np.uint16)
    for i, s in enumerate(sequences):
        right[i, : len(s)] = s[::-1]
    return right, sizes


def build(right: np.ndarray, sizes: np.ndarray, folder: Path) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For the sorted suffixes, the empty ones included: symbol before, common prefix with the one before, sequence, start.

    right and sizes as padded() gives them; the last column of right is END.
    """
    n = len(sizes)
    most = int(sizes.max(initial=0))
    # round 0: the n empty suffixes, in the order of the sequences
    files = Files(folder, n, most)
    files.write(0, right[:, 0], np.zeros(n), np.arange(n) * files.span + sizes)
    at = np.arange(n)  # where each sequence's longest suffix so far stands
    for r in range(most):
        bwt, lcp, name = files.read(r)
        live = np.flatnonzero(right[:, r] != END)
        order = np.argsort(bwt, kind="stable")
        ended = int((bwt == END).sum())
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        # suffixes of the next list: the n empty ones, then the present ones that have a symbol in front, by that symbol
        k = place[at[live]]
        to = n + k - ended
        low = np.append(lcp, 0)

        def shared(ks: np.ndarray) -> np.ndarray:
            """Common prefix of the next list's entry ks (a place in order) with the one before it."""
            out = np.zeros(len(ks), np.int64)
            ok = np.flatnonzero((ks > 0) & (bwt[order[ks]] == bwt[order[ks - 1]]))  # noqa: B023
            if len(ok):
                a, b = order[ks[ok] - 1] + 1, order[ks[ok]] + 1  # noqa: B023
                turn = by_place(a, len(low))
                ends = np.stack([a[turn], b[turn]], axis=1).ravel()
                got = np.empty(len(ok), np.int64)
                got[turn] = np.minimum.reduceat(low, ends)[::2]  # noqa: B023
                out[ok] = got + 1
            return out

        own = shared(k)
        taken = np.zeros(len(order) + 1, bool)
        taken[k] = True
        after = np.flatnonzero(taken[:-2] & ~taken[1:-1]) + 1  # entries that follow a new suffix and are none
        turn = by_place(to, len(order) + len(to))
        to_sorted, seq = to[turn], live[turn]
        new_lcp = merged(lcp, to_sorted, own[turn].astype(lcp.dtype))
        new_lcp[n + after - ended] = shared(after)
        files.write(r + 1, merged(bwt, to_sorted, right[seq, r + 1]), new_lcp, merged(name, to_sorted, (seq * files.span + sizes[seq] - r - 1).astype(name.dtype)))
        at_new = at.copy()
        at_new[live] = to
        at = at_new
    bwt, lcp, name = files.read(most)
    return bwt, lcp, name // files.span, name % files.span


def repeated(right: np.ndarray, sizes: np.ndarray, length: int, folder: Path, copies: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and start of each string of the given length that also starts anywhere else.

    copies says how often each sequence stands in the collection: a suffix of one that stands there again is its own neighbour.
    """
    _, lcp, seq, start = build(right, sizes, folder)
    long = lcp >= length
    long[:-1] |= long[1:].copy()
    if copies is not None:
        long |= (copies[seq] > 1) & (sizes[seq] - start >= length)
    return seq[long], start[long]
