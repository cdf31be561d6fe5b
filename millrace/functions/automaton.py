"""Aho-Corasick automata over bytes, stepped for many pieces of text at once."""

from __future__ import annotations

from collections import deque

import numpy as np


class Automaton:
    """Finds all ``patterns`` (non-empty bytes) in many texts.

    States are rows of one table with a column for each class of bytes (bytes that no pattern holds share one), failure links already
    followed. Texts are cut into pieces of PIECE bytes, each with the bytes before it that a pattern may begin in, and all pieces take their next byte
    together; so the number of vector steps depends on the length of a piece, not on the texts.
    """

    PIECE = 2048

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.longest = max(map(len, patterns), default=0)
        used = sorted(set(b"".join(patterns)))
        self.classes = np.zeros(257, np.int32)  # 256: past the end of a piece
        self.classes[used] = np.arange(1, len(used) + 1)
        self.table, self.out = self._build(patterns, len(used) + 1)
        self.ends = np.array([bool(o) for o in self.out])

    def _build(self, patterns: list[bytes], width: int) -> tuple[np.ndarray, list[tuple[int, ...]]]:
        children: list[dict[int, int]] = [{}]
        own: list[list[int]] = [[]]
        for p, pattern in enumerate(patterns):
            state = 0
            for byte in pattern:
                c = int(self.classes[byte])
                if c not in children[state]:
                    children[state][c] = len(children)
                    children.append({})
                    own.append([])
                state = children[state][c]
            own[state].append(p)
        table = np.zeros((len(children), width), np.int32)
        out: list[tuple[int, ...]] = [()] * len(children)
        fail = [0] * len(children)
        queue = deque([0])
        while queue:  # by depth: a state's row is that of its failure state, but for its own children
            state = queue.popleft()
            out[state] = (*own[state], *(out[fail[state]] if state else ()))
            if state:
                table[state] = table[fail[state]]
            for c, child in children[state].items():
                fail[child] = int(table[state, c]) if state else 0
                table[state, c] = child
                queue.append(child)
        return table, out

    def find(self, texts: list[bytes]) -> set[tuple[int, int]]:
        """(text, pattern) wherever a pattern occurs."""
        if not self.patterns or not texts:
            return set()
        back = self.longest - 1
        flat = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        pieces = -(-sizes // self.PIECE)
        text = np.repeat(np.arange(len(texts)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.maximum(nth * self.PIECE - back, 0)
        length = np.minimum((nth + 1) * self.PIECE, sizes[text]) - first
        order = np.argsort(-length, kind="stable")  # pieces that are over lie behind those that go on
        text, at, length = text[order], (starts[text] + first)[order], length[order]
        going = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")
        state = np.zeros(len(text), np.int32)
        width = self.table.shape[1]
        steps, found = self.table.ravel(), set()
        codes = self.classes[flat]
        for k, n in enumerate(going):
            state[:n] = steps[state[:n] * np.int64(width) + codes[at[:n] + k]]
            hit = np.nonzero(self.ends[state[:n]])[0]
            if len(hit):
                pairs = np.unique(np.stack((text[hit], state[hit])), axis=1)
                found.update((int(t), p) for t, s in pairs.T for p in self.out[s])
        return found
