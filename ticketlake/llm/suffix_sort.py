"""Deep-shallow sorting of suffixes, compared over a fixed number of bytes."""

from __future__ import annotations

import numpy as np

SHALLOW = 24
"""Bytes that multikey quicksort compares, eight at a time; blind tries take what still agrees."""


def _words(buffer: np.ndarray, at: np.ndarray, depth: int, length: int) -> np.ndarray:
    """The eight bytes `depth` behind each start as one big-endian number, zero beyond the length."""
    width = min(8, length - depth)
    out = np.zeros(len(at), np.uint64)
    for i in range(width):
        out = (out << np.uint64(8)) | buffer[at + depth + i]
    return out


class BlindTrie:
    """A trie of whole strings whose inner nodes keep only where their branches part and by which byte.

    An insertion walks down on those bytes without comparing the others, compares the string once with
    the leaf it reaches, and branches at their first difference. Equal strings share a leaf.
    """

    __slots__ = ("leaves", "root")

    def __init__(self):
        self.root, self.leaves = None, []

    def insert(self, text: bytes, start: int) -> None:
        node, path = self.root, []
        if node is None:
            self.root = self._leaf(text, start)
            return
        while type(node) is not list:
            path.append(node)
            depth, branches = node
            node = branches.get(text[depth]) or next(iter(branches.values()))
        if node[0] == text:
            node[1].append(start)
            return
        a, b = int.from_bytes(node[0]), int.from_bytes(text)
        common = len(text) - ((a ^ b).bit_length() + 7) // 8
        branch, new = self._leaf(text, start), (common, {})
        for i, (depth, branches) in enumerate(path):
            if depth == common:
                branches[text[common]] = branch
                return
            if depth > common:
                path = path[: i + 1]
                below = path.pop()
                break
        else:
            below = node
        new[1][node[0][common]], new[1][text[common]] = below, branch
        if path:
            depth, branches = path[-1]
            branches[text[depth]] = new
        else:
            self.root = new

    def _leaf(self, text: bytes, start: int) -> list:
        self.leaves.append([text, [start]])
        return self.leaves[-1]

    def ordered(self) -> list[list[int]]:
        """Starts of equal strings together, in the order of the strings."""
        out, open_ = [], [self.root]
        while open_:
            node = open_.pop()
            if type(node) is list:
                out.append(node[1])
            else:
                open_ += [branch for _, branch in sorted(node[1].items(), reverse=True)]
        return out


def deep_shallow(data: bytes, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, classes): positions in `starts` by their next `length` bytes, and the number of each one's class.

    Every start has `length` bytes behind it. Classes are numbered in the order; equal strings share one.
    """
    n = len(starts)
    buffer = np.frombuffer(data, np.uint8)
    order, group = np.arange(n), np.zeros(n, np.int64)
    # multikey quicksort, all groups at once: each step parts the groups that still agree by eight more bytes
    for depth in range(0, min(SHALLOW, length), 8):
        size = np.bincount(group, minlength=1)
        open_ = np.flatnonzero(size[group] > 1)
        if not len(open_):
            break
        word = np.zeros(n, np.uint64)
        word[open_] = _words(buffer, starts[order[open_]], depth, length)
        by = np.lexsort((word, group))
        order, group, word = order[by], group[by], word[by]
        new = np.concatenate([[False], (group[1:] != group[:-1]) | (word[1:] != word[:-1])])
        group = np.cumsum(new)
    size = np.bincount(group, minlength=1)
    first = np.concatenate([[0], np.cumsum(size)])
    classes = np.zeros(n, np.int64)
    step = np.ones(n, bool)
    step[0:1] = False
    for g in np.flatnonzero(size > 1).tolist() if length > SHALLOW else []:
        at = slice(first[g], first[g + 1])
        members = order[at]
        trie = BlindTrie()
        for member, start in zip(members.tolist(), starts[members].tolist(), strict=True):
            trie.insert(data[start : start + length], member)
        equal = trie.ordered()
        order[at] = np.concatenate([np.array(x) for x in equal])
        inside = np.zeros(size[g], bool)
        inside[np.cumsum([0, *map(len, equal[:-1])])] = True
        inside[0] = step[first[g]]
        step[at] = inside
    if length <= SHALLOW and n:
        step = np.concatenate([[False], group[1:] != group[:-1]])
    classes[order] = np.cumsum(step)
    return order, classes
