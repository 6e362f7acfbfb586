"""Deep-shallow ordering of fixed-length suffix heads, in numpy, for the suffixes of one task.

Shallow: multikey sorting on 8-byte characters down to ``SHALLOW`` bytes.  Deep: the groups
that still share so long a prefix are ordered by blind tries.  A trie node knows only
how far a suffix agrees with the node's reference and which byte comes there; that
position is found by skipping along the reference, and members that agree at the
same place with the same byte go down the same branch.  All groups of a level are worked
on together.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 16


def _groups(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs whose first members are flagged."""
    start = np.flatnonzero(first)
    return start, np.diff(np.append(start, len(first)))


def order_heads(heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of a byte matrix, and the class of each ordered row.

    Classes number the distinct rows in ascending order."""
    n, width = heads.shape
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.arange(n)
    first = np.zeros(n, dtype=bool)
    first[0] = True
    for at in range(0, min(SHALLOW, width), 8):
        order, first = _refine_by_word(heads, order, first, at)
    return _blind_tries(heads, order, first, min(SHALLOW, width))


def _refine_by_word(heads, order, first, at):
    """Order the members of each group by the 8 bytes at ``at`` and split the groups."""
    start, length = _groups(first)
    open_groups = length > 1
    member = np.repeat(open_groups, length)
    place = np.flatnonzero(member)
    if not len(place):
        return order, first
    rows = order[place]
    word = np.zeros((len(rows), 8), dtype=np.uint8)
    part = heads[rows, at:at + 8]
    word[:, :part.shape[1]] = part
    word = word.view(">u8").ravel().astype(np.uint64)
    group = np.repeat(np.flatnonzero(open_groups), length[open_groups])
    by = np.lexsort((word, group))
    order = order.copy()
    order[place] = rows[by]
    first = first.copy()
    same = (group[1:] == group[:-1]) & (word[by][1:] == word[by][:-1])
    first[place[1:][~same]] = True
    return order, first


def _blind_tries(heads, order, first, depth):
    """Order all groups of more than one member that agree on ``depth`` bytes."""
    order, first = order.copy(), first.copy()
    start, length = _groups(first)
    place = np.flatnonzero(np.repeat(length > 1, length))
    group = np.repeat(np.arange(len(start)), length)[place]
    width = heads.shape[1]
    while len(place):
        rows = order[place]
        head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        reference = np.repeat(rows[head], np.diff(np.append(head, len(place))))
        mine, other = heads[rows, depth:], heads[reference, depth:]
        differs = mine != other
        skip = differs.argmax(axis=1)
        at = np.arange(len(rows))
        equal = ~differs[at, skip]
        byte = mine[at, skip].astype(np.int64)
        below = byte < other[at, skip]
        # children in order: smaller ones by rising skip, the reference, greater ones by falling skip
        branch = np.where(equal, width, np.where(below, skip, 2 * width - skip)).astype(np.int64)
        key = branch * 256 + np.where(equal, 0, byte)
        by = np.lexsort((key, group))
        order[place] = rows[by]
        key, group_now = key[by], group[by]
        new = np.append(True, (group_now[1:] != group_now[:-1]) | (key[1:] != key[:-1]))
        first[place[new]] = True
        child = np.cumsum(new) - 1
        size = np.bincount(child)
        again = (size[child] > 1) & ~equal[by]
        place, group = place[again], child[again]
    return order, np.cumsum(first) - 1
