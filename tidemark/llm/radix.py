"""An adaptive radix tree over byte strings: nodes of four sizes, compressed paths, values at any depth."""

from __future__ import annotations

from bisect import bisect_left, insort


class _Sorted:
    """Up to 4, then up to 16 children: their bytes in order beside the children."""

    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.nodes = room, [], []

    def get(self, b: int):
        at = bisect_left(self.bytes, b)
        return self.nodes[at] if at < len(self.bytes) and self.bytes[at] == b else None

    def put(self, b: int, node):
        """The layout that holds the new child: this one, or a larger one."""
        if len(self.bytes) == self.room:
            larger = _Sorted(16) if self.room == 4 else _Indexed()
            for x, n in self.items():
                larger.put(x, n)
            return larger.put(b, node)
        insort(self.bytes, b)
        self.nodes.insert(bisect_left(self.bytes, b), node)
        return self

    def swap(self, b: int, node) -> None:
        self.nodes[bisect_left(self.bytes, b)] = node

    def items(self):
        return zip(self.bytes, self.nodes)


class _Indexed:
    """Up to 48 children: for each byte one byte that says where its child is."""

    __slots__ = ("at", "nodes")

    def __init__(self):
        self.at, self.nodes = bytearray(256), []

    def get(self, b: int):
        at = self.at[b]
        return self.nodes[at - 1] if at else None

    def put(self, b: int, node):
        if len(self.nodes) == 48:
            larger = _Full()
            for x, n in self.items():
                larger.put(x, n)
            return larger.put(b, node)
        self.nodes.append(node)
        self.at[b] = len(self.nodes)
        return self

    def swap(self, b: int, node) -> None:
        self.nodes[self.at[b] - 1] = node

    def items(self):
        return ((b, self.nodes[at - 1]) for b, at in enumerate(self.at) if at)


class _Full:
    """A child for every byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, b: int):
        return self.nodes[b]

    def put(self, b: int, node):
        self.nodes[b] = node
        return self

    swap = put

    def items(self):
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


class Node:
    """path: the bytes between its parent and it, the branching byte included; values: of keys that end here."""

    __slots__ = ("path", "values", "children")

    def __init__(self, path: bytes):
        self.path, self.values, self.children = path, [], None

    def add(self, child: Node) -> None:
        self.children = (self.children or _Sorted()).put(child.path[0], child)


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is common, a[:high] isn't
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid)
    return low


class RadixTree:
    """Keys with values; equal keys keep all their values."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        node, rest = self.root, key
        while rest:
            child = node.children.get(rest[0]) if node.children else None
            if child is None:
                leaf = Node(rest)
                node.add(leaf)
                leaf.values.append(value)
                return
            same = _common(child.path, rest)
            if same < len(child.path):  # the compressed path is cut in two
                upper = Node(child.path[:same])
                node.children.swap(rest[0], upper)
                child.path = child.path[same:]
                upper.add(child)
                child = upper
            node, rest = child, rest[same:]
        node.values.append(value)

    def walk(self):
        """(node, parent's place in this list or -1): parents first, children in the order of their bytes."""
        out, todo = [], [(self.root, -1)]
        while todo:
            node, parent = todo.pop()
            out.append((node, parent))
            if node.children:
                here = len(out) - 1
                todo += [(child, here) for _, child in reversed(list(node.children.items()))]
        return out
