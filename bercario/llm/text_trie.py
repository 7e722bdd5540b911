"""Compressed radix tries over whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any


class Node:
    """An edge's label and what lies below it; a terminal has the least id and the rows of its text."""

    __slots__ = ("label", "children", "least", "rows")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.least: tuple[bool, Any] | None = None
        self.rows: list[int] = []


def id_order(value: Any) -> tuple[bool, Any]:
    """Ids in order, null after all others."""
    return (True, 0) if value is None else (False, value)


def _common(label: bytes, text: bytes, at: int) -> int:
    """How many bytes of the label stand in the text from ``at``; at least one, not all."""
    low, high = 1, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class TextTrie:
    """Texts with the least id of each at its terminal.

    An inner node has a terminal or several children, so there are fewer than two nodes for each
    different text, and their labels hold no text twice.
    """

    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, text: bytes, order: tuple[bool, Any], row: int) -> None:
        """Add a row; ``order`` is the ``id_order`` of its id."""
        node, at, end = self.root, 0, len(text)
        while at < end:
            first = text[at]
            child = node.children.get(first)
            if child is None:
                node.children[first] = node = Node(text[at:])
                break
            label = child.label
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            shared = _common(label, text, at)
            middle = Node(label[:shared])
            child.label = label[shared:]
            middle.children[label[shared]] = child
            node.children[first] = node = middle
            at += shared
        if node.least is None or order < node.least:
            node.least = order
        node.rows.append(row)

    def terminals(self) -> Iterator[Node]:
        """The terminals in the order of their texts."""
        waiting = [self.root]
        while waiting:
            node = waiting.pop()
            if node.least is not None:
                yield node
            waiting += [node.children[first] for first in sorted(node.children, reverse=True)]
