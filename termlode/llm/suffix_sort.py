"""Deep-shallow sorting of suffixes that are compared to a fixed depth.

Multikey quicksort, eight bytes at a time, orders the suffixes to a shallow depth. Groups
that agree so far tend to agree for long; each is ordered by a blind trie, which walks
down by single bytes without looking at the text and then compares with one leaf only.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 64
_WORD = np.arange(8)


class _Node:
    """An inner node of a blind trie: the depth of its byte, and its children."""

    __slots__ = ("depth", "children")

    def __init__(self, depth: int):
        self.depth = depth
        self.children: dict[int, object] = {}


def _common(text: np.ndarray, raw: bytes, a: int, b: int, done: int, depth: int) -> int:
    """Length of the common prefix of two suffixes that agree on ``done`` bytes."""
    if raw[a + done : a + depth] == raw[b + done : b + depth]:
        return depth
    differs = text[a + done : a + depth] != text[b + done : b + depth]
    return done + int(differs.argmax())


def blind_trie(
    text: np.ndarray, raw: bytes, starts: list[int], done: int, depth: int
) -> list[list[int]]:
    """Suffixes in order, those equal to the full depth together; ``done`` bytes agree."""
    root: object = [starts[0]]
    for start in starts[1:]:
        node = root
        while isinstance(node, _Node):
            child = node.children.get(raw[start + node.depth])
            node = child if child is not None else next(iter(node.children.values()))
        common = _common(text, raw, node[0], start, done, depth)
        if common == depth:
            node.append(start)
            continue
        above, node = None, root
        while isinstance(node, _Node) and node.depth < common:
            above, node = node, node.children[raw[start + node.depth]]
        if isinstance(node, _Node) and node.depth == common:
            node.children[raw[start + common]] = [start]
            continue
        witness = node
        while isinstance(witness, _Node):
            witness = next(iter(witness.children.values()))
        fork = _Node(common)
        fork.children = {raw[witness[0] + common]: node, raw[start + common]: [start]}
        if above is None:
            root = fork
        else:
            above.children[raw[start + above.depth]] = fork
    ordered, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, _Node):
            stack += [node.children[c] for c in sorted(node.children, reverse=True)]
        else:
            ordered.append(node)
    return ordered


def sort_suffixes(
    text: np.ndarray, starts: np.ndarray, depth: int, shallow: int = SHALLOW
) -> list[list[int]]:
    """Classes of suffixes that agree on ``depth`` bytes, in lexicographic order.

    Every suffix has at least ``depth`` bytes of text behind its start.
    """
    raw = text.tobytes()
    shallow = min(shallow, depth) // 8 * 8
    classes: list[list[int]] = []
    stack = [(np.asarray(starts, np.int64), 0)] if len(starts) else []
    while stack:
        group, done = stack.pop()
        if len(group) == 1:
            classes.append([int(group[0])])
        elif done >= shallow:
            classes += blind_trie(text, raw, group.tolist(), done, depth)
        else:
            keys = text[group[:, None] + (done + _WORD)].view(">u8").reshape(-1)
            pivot = np.partition(keys, len(keys) // 2)[len(keys) // 2]
            for part, more in ((keys > pivot, 0), (keys == pivot, 8), (keys < pivot, 0)):
                chosen = group[part]
                if len(chosen):
                    stack.append((chosen, done + more))
    return classes
