"""Deep-shallow suffix sorting of one group of suffixes.

Multikey quicksort on 8-byte characters orders the suffixes to a shallow depth; groups that are
still equal there share a long prefix and are ordered by a blind trie: an insertion follows
branching bytes only, compares once with the leaf that it reaches, and splits the path where the
two differ. Groups are small against a task's memory (see ``suffix_dedup``).
"""

from __future__ import annotations

STEP = 8


def common_prefix(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the longest common prefix, known to be ``at`` at least; by halving."""
    top = min(len(a), len(b))
    if a[at:top] == b[at:top]:
        return top
    low, high = at, top                     # a[:low] is common, a[:high] is not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class _Node:
    """Inner node: suffixes below share ``depth`` bytes and differ in the next one (-1: end)."""
    __slots__ = ("depth", "children")

    def __init__(self, depth: int, children: dict):
        self.depth, self.children = depth, children


def _byte(s: bytes, at: int) -> int:
    return s[at] if at < len(s) else -1


def blind_trie(suffixes: list[bytes], which: list[int]) -> list[int]:
    """``which`` ordered by suffix; equal suffixes keep their order."""
    root: _Node | list[int] = [which[0]]            # a leaf holds equal suffixes
    for i in which[1:]:
        s, node, path = suffixes[i], root, []
        while isinstance(node, _Node):
            path.append(node)
            byte = _byte(s, node.depth)
            node = node.children.get(byte) or next(iter(node.children.values()))
        other = suffixes[node[0]]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            node.append(i)
            continue
        while path and path[-1].depth >= depth:
            node = path.pop()
        if path and path[-1].children.get(_byte(other, path[-1].depth)) is not node:
            # the walk left this path at a missing branch of the last node
            path[-1].children[_byte(s, path[-1].depth)] = [i]
            continue
        if isinstance(node, _Node) and node.depth == depth:
            node.children[_byte(s, depth)] = [i]
            continue
        split = _Node(depth, {_byte(other, depth): node, _byte(s, depth): [i]})
        if path:
            path[-1].children[_byte(other, path[-1].depth)] = split
        else:
            root = split
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        if isinstance(node, _Node):
            todo += [node.children[b] for b in sorted(node.children, reverse=True)]
        else:
            out += node
    return out


def deep_shallow(suffixes: list[bytes], start: int, shallow: int) -> list[int]:
    """Order of suffixes that agree in their first ``start`` bytes."""
    out, todo = [], [(list(range(len(suffixes))), start)]
    while todo:
        which, depth = todo.pop()
        if len(which) < 2:
            out += which
        elif depth >= shallow:
            out += blind_trie(suffixes, which)
        else:
            key = {i: (suffixes[i][depth:depth + STEP], len(suffixes[i]) > depth + STEP) for i in which}
            pivot = key[which[len(which) // 2]]
            less = [i for i in which if key[i] < pivot]
            same = [i for i in which if key[i] == pivot]
            more = [i for i in which if key[i] > pivot]
            todo.append((more, depth))
            todo.append((same, depth + STEP if pivot[1] else shallow))
            todo.append((less, depth))
    return out


def neighbours(suffixes: list[bytes], order: list[int]) -> list[int]:
    """Common prefix of every suffix with the one before it in order (first: 0)."""
    return [0] + [common_prefix(suffixes[a], suffixes[b]) for a, b in zip(order, order[1:])]
