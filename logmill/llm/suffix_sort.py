"""Deep-shallow sorting of suffixes to a bounded depth, in numpy.

Shallow part: multikey quicksort. A group of suffixes that agree so far is parted by a pivot, the eight bytes at the group's depth, into smaller,
equal and greater ones; the equal ones go on eight bytes deeper. Deep part: groups that still agree at ``SHALLOW`` bytes have long common
prefixes; a blind trie orders each of them. A node of the trie is found by comparing its members with one of them: its depth is the first place
where any differs, and all bytes before are passed over. Its children are the members that agree there.

Both parts take one step of all groups at a time, as numpy has no cheap way to take groups one by one.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 32  # bytes


def big_endian_words(data: np.ndarray) -> np.ndarray:
    """At each position the next eight bytes as one number, zeros after the end; one position more than bytes."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), ">u8", padded, strides=(1,)).astype(np.uint64)


class _Groups:
    """Suffixes in groups that agree to a depth: ``item`` (numbers of suffixes, group by group), first place, size, depth and final place of each group."""

    def __init__(self, item: np.ndarray, size: np.ndarray, depth: np.ndarray, place: np.ndarray):
        self.item, self.size, self.depth, self.place = item, size, depth, place
        self.first = np.cumsum(size) - size
        self.of = np.repeat(np.arange(len(size)), size)

    def only(self, wanted: np.ndarray) -> _Groups:
        return _Groups(self.item[wanted[self.of]], self.size[wanted], self.depth[wanted], self.place[wanted])


def _parted(g: _Groups, side: np.ndarray, sides: int) -> tuple[_Groups, np.ndarray]:
    """Groups split by ``side`` of their members (below ``sides``), in its order and stable; and the side of each new group."""
    key = g.of * sides + side
    size = np.bincount(key, minlength=len(g.size) * sides)
    start = np.cumsum(size) - size
    where = np.empty(len(key), np.int64)
    for s in range(sides):
        here = side == s
        count = np.cumsum(here)
        before = np.concatenate([[0], count])[g.first]
        where[here] = (start[g.of * sides + s] + count - before[g.of] - 1)[here]
    item = np.empty_like(g.item)
    item[where] = g.item
    place = np.repeat(g.place, sides) + start - np.repeat(g.first, sides)
    full = size > 0
    new = _Groups(item, size[full], np.repeat(g.depth, sides)[full], place[full])
    return new, (np.arange(len(size)) % sides)[full]


def _multikey_step(words: np.ndarray, starts: np.ndarray, depth: np.ndarray, g: _Groups) -> _Groups:
    """Every group parted by its pivot: the median of its first, middle and last member's word."""
    word = words[starts[g.item] + np.minimum(g.depth[g.of], depth[g.item] - 8)]
    three = np.sort(np.stack([word[g.first], word[g.first + g.size // 2], word[g.first + g.size - 1]]), axis=0)
    pivot = three[1][g.of]
    new, side = _parted(g, np.where(word == pivot, 1, np.where(word > pivot, 2, 0)), 3)
    new.depth = new.depth + 8 * (side == 1)
    return new


def _trie_step(words: np.ndarray, starts: np.ndarray, depth: np.ndarray, g: _Groups) -> _Groups:
    """Every group replaced by the children of its trie's root, one of them if all members agree to their full depth."""
    reach = g.depth[g.of]  # to where a member agrees with the first one of its group
    leader = starts[g.item[g.first]][g.of]
    full = depth[g.item]
    own = starts[g.item]
    live = np.arange(len(g.item))
    while len(live):
        at = np.minimum(reach[live], full[live] - 8)
        live = live[words[own[live] + at] == words[leader[live] + at]]
        reach[live] += 8
        live = live[reach[live] < full[live]]
    branch = np.minimum.reduceat(reach, g.first)
    word = words[own + np.minimum(branch[g.of], full - 8)]
    by = np.lexsort((word, g.of))
    item, word, of = g.item[by], word[by], g.of[by]
    new = np.append(True, (of[1:] != of[:-1]) | ((word[1:] != word[:-1]) & (branch[of[1:]] < depth[item[1:]])))
    first = np.flatnonzero(new)
    return _Groups(item, np.diff(np.append(first, len(item))), branch[of[first]] + 8, g.place[of[first]] + first - g.first[of[first]])


def equal_groups(data: np.ndarray, starts: np.ndarray, depth: int | np.ndarray, bucket: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of ``data`` at ``starts`` in their order to ``depth`` bytes, and a group number that is shared by all that are equal so far.

    ``depth`` is eight at least, and every suffix has as many bytes. ``bucket``: suffixes of different buckets are not compared; the order is by
    bucket first. Depths may differ then between buckets, but not in one. Groups are numbered in order.
    """
    n = len(starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = big_endian_words(data)
    depth = np.broadcast_to(np.asarray(depth, np.int64), (n,))
    item = np.arange(n) if bucket is None else np.argsort(bucket, kind="stable")
    cuts = np.array([0]) if bucket is None else np.flatnonzero(np.append(True, bucket[item[1:]] != bucket[item[:-1]]))
    g = _Groups(item, np.diff(np.append(cuts, n)), np.zeros(len(cuts), np.int64), cuts)
    final = np.zeros(n, np.int64)
    deep: list[_Groups] = []
    for step, shallow in ((_multikey_step, True), (_trie_step, False)):
        while len(g.item):
            end = (g.size == 1) | (g.depth >= depth[g.item[g.first]])
            done = g.only(end)
            final[done.item] = done.place[done.of]
            if shallow:
                deep.append(g.only(~end & (g.depth >= SHALLOW)))
                end |= g.depth >= SHALLOW
            g = g.only(~end)
            if len(g.item):
                g = step(words, starts, depth, g)
        if shallow:
            g = _Groups(*(np.concatenate([getattr(d, x) for d in deep]) for x in ("item", "size", "depth", "place")))
    order = np.argsort(final, kind="stable")
    return order, final[order]


def repeated(data: np.ndarray, starts: np.ndarray, depth: int | np.ndarray, bucket: np.ndarray | None = None) -> np.ndarray:
    """Whether the ``depth`` bytes from each of ``starts`` stand at another one of them (of the same bucket) too."""
    out = np.zeros(len(starts), bool)
    if len(starts):
        order, group = equal_groups(data, starts, depth, bucket)
        same = group[1:] == group[:-1]
        out[order[1:][same]] = True
        out[order[:-1][same]] = True
    return out
