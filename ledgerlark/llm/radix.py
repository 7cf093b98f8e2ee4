"""An adaptive radix tree over byte strings: four sizes of nodes, and paths without branches kept as one prefix."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Small:
    """Up to `room` children in the order of their bytes (4 or 16)."""

    __slots__ = ("prefix", "value", "keys", "children", "room")

    def __init__(self, prefix: bytes, room: int = 4) -> None:
        self.prefix, self.value, self.room = prefix, None, room
        self.keys, self.children = bytearray(), []

    def get(self, byte: int):
        at = bisect_left(self.keys, byte)
        return self.children[at] if at < len(self.keys) and self.keys[at] == byte else None

    def put(self, byte: int, child) -> Small | Indexed:
        """Sets a child; the node that takes this one's place if it was full."""
        at = bisect_left(self.keys, byte)
        if at < len(self.keys) and self.keys[at] == byte:
            self.children[at] = child
            return self
        if len(self.keys) == self.room:
            larger = Small(self.prefix, 16) if self.room == 4 else Indexed(self.prefix)
            larger.value = self.value
            for old, node in zip(self.keys, self.children, strict=True):
                larger.put(old, node)
            return larger.put(byte, child)
        self.keys.insert(at, byte)
        self.children.insert(at, child)
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return zip(self.keys, self.children, strict=True)


class Indexed:
    """Up to 48 children behind a table of 256 places."""

    __slots__ = ("prefix", "value", "place", "children")

    def __init__(self, prefix: bytes) -> None:
        self.prefix, self.value = prefix, None
        self.place, self.children = bytearray(256), []  # place 0: none

    def get(self, byte: int):
        at = self.place[byte]
        return self.children[at - 1] if at else None

    def put(self, byte: int, child) -> Indexed | Full:
        if at := self.place[byte]:
            self.children[at - 1] = child
            return self
        if len(self.children) == 48:
            larger = Full(self.prefix)
            larger.value = self.value
            for old, node in self.items():
                larger.children[old] = node
            return larger.put(byte, child)
        self.children.append(child)
        self.place[byte] = len(self.children)
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return ((byte, self.children[at - 1]) for byte, at in enumerate(self.place) if at)


class Full:
    """A child for every byte."""

    __slots__ = ("prefix", "value", "children")

    def __init__(self, prefix: bytes) -> None:
        self.prefix, self.value = prefix, None
        self.children: list = [None] * 256

    def get(self, byte: int):
        return self.children[byte]

    def put(self, byte: int, child) -> Full:
        self.children[byte] = child
        return self

    def items(self) -> Iterator[tuple[int, object]]:
        return ((byte, node) for byte, node in enumerate(self.children) if node is not None)


def _shared(a: bytes, b: bytes, at: int) -> int:
    """How many bytes of `a` agree with `b` from `at` on."""
    n = min(len(a), len(b) - at)
    if a[:n] == b[at : at + n]:
        return n
    low, high = 0, n  # a[:low] agrees, a[:high] does not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle
    return low


class RadixTree:
    """A map from byte strings to values other than None; a key may be the beginning of another."""

    def __init__(self) -> None:
        self.root: Small | Indexed | Full | None = None

    def insert(self, key: bytes, value: object) -> None:
        above: list[tuple[object, int]] = []  # the node above and the byte that leads down from it
        node, at = self.root, 0
        while node is not None:
            same = _shared(node.prefix, key, at)
            if same < len(node.prefix):  # the path parts inside the prefix
                fork = Small(key[at : at + same])
                byte, node.prefix = node.prefix[same], node.prefix[same + 1 :]
                fork.put(byte, node)
                if at + same == len(key):
                    fork.value = value
                else:
                    fork.put(key[at + same], self._leaf(key, at + same + 1, value))
                self._replace(above, fork)
                return
            at += same
            if at == len(key):
                node.value = value
                return
            child = node.get(key[at])
            if child is None:
                grown = node.put(key[at], self._leaf(key, at + 1, value))
                if grown is not node:
                    self._replace(above, grown)
                return
            above = [(node, key[at])]
            node, at = child, at + 1
        self.root = self._leaf(key, 0, value)

    @staticmethod
    def _leaf(key: bytes, at: int, value: object) -> Small:
        leaf = Small(key[at:])
        leaf.value = value
        return leaf

    def _replace(self, above: list, node: object) -> None:
        if above:
            parent, byte = above[-1]
            parent.put(byte, node)
        else:
            self.root = node

    def get(self, key: bytes):
        node, at = self.root, 0
        while node is not None and key.startswith(node.prefix, at):
            at += len(node.prefix)
            if at == len(key):
                return node.value
            node, at = node.get(key[at]), at + 1
        return None
