"""Patricia (path-compressed radix) tries over byte strings, used inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by bisection over slice comparisons."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class Node:
    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner=None):
        self.label = label
        self.children: dict[int, Node] = {}
        self.owner = owner


def smaller(a, b):
    """The smaller identifier; null is no identifier."""
    return b if a is None else a if b is None else min(a, b)


class Trie:
    """Full byte strings; a terminal node's owner is [smallest id, rows, rows with that id]."""

    def __init__(self):
        self.root = Node(b"")
        self.bytes = 0

    def _terminal(self, s: bytes) -> Node:
        node, i, n = self.root, 0, len(s)
        while i < n:
            child = node.children.get(s[i])
            if child is None:
                leaf = Node(s[i:])
                self.bytes += n - i
                node.children[s[i]] = leaf
                return leaf
            label = child.label
            if s.startswith(label, i):
                node, i = child, i + len(label)
                continue
            k = common_prefix(label, s[i:i + len(label)])
            middle = Node(label[:k])
            child.label = label[k:]
            middle.children[child.label[0]] = child
            node.children[s[i]] = middle
            node, i = middle, i + k
        return node

    def insert(self, s: bytes, ident, rows: int = 1, with_id: int = 1) -> None:
        node = self._terminal(s)
        if node.owner is None:
            node.owner = [ident, rows, with_id]
            return
        own = node.owner
        least = smaller(own[0], ident)
        own[2] = (own[2] if own[0] == least else 0) + (with_id if ident == least else 0)
        own[0] = least
        own[1] += rows

    def owners(self) -> Iterator[tuple[bytes, list]]:
        """(string, owner) of every terminal node; an explicit stack, as paths may be deep."""
        stack = [(self.root, b"")]
        while stack:
            node, prefix = stack.pop()
            s = prefix + node.label
            if node.owner is not None:
                yield s, node.owner
            stack.extend((c, s) for c in node.children.values())
