"""Minimal acyclic transducer from words to id sequences, held in flat memory-mappable arrays.

Words are added in byte order; each finished suffix is looked up in a register, so equal
suffixes share states. Every arc carries an integer output, and the outputs along a word's path
add up to the word's rank, which points at its slice of the id array.
"""

from __future__ import annotations

import json
import mmap
from array import array

import numpy as np

TARGET = 0xFFFFFFFF


class _Builder:
    """States of the word being added are open; all others are final in the register, under
    their accept flag and arcs (byte and target) as packed bytes; a state's number is its place
    in the register."""

    def __init__(self):
        self.register: dict[bytes, int] = {}
        self.words = array("i")              # accepted words from each state
        self.path: list[list] = [[False, []]]
        self.last = b""

    def _close(self, depth: int) -> None:
        while len(self.path) > depth + 1:
            accept, arcs = self.path.pop()
            parent = self.path[-1][1]
            parent[-1] |= self._state(accept, arcs)

    def _state(self, accept: bool, arcs: list[int]) -> int:
        key = array("q", [accept, *arcs]).tobytes()
        state = self.register.get(key)
        if state is None:
            state = self.register[key] = len(self.words)
            self.words.append(accept + sum(self.words[a & TARGET] for a in arcs))
        return state

    def add(self, word: bytes) -> None:
        last, same = self.last, 0
        top = min(len(last), len(word))
        while same < top and last[same] == word[same]:
            same += 1
        self._close(same)
        for byte in word[same:]:
            self.path[-1][1].append(byte << 32)     # the target is set when the path closes
            self.path.append([False, []])
        self.path[-1][0] = True
        self.last = word

    def finish(self) -> int:
        self._close(0)
        return self._state(*self.path.pop())


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """Serialise the transducer of ``words`` (word -> ids)."""
    order = sorted(words)
    b = _Builder()
    for w in order:
        b.add(w)
    start = b.finish()
    keys, targets, outputs, accepts = array("q"), array("i"), array("i"), bytearray()
    for state, packed in enumerate(b.register):
        accept, *arcs = array("q", packed)
        accepts.append(accept)
        before = accept
        for arc in arcs:                     # bytes ascend, so the keys ascend too
            target = arc & TARGET
            keys.append(state << 8 | arc >> 32)
            targets.append(target)
            outputs.append(before)
            before += b.words[target]
    sizes = np.fromiter((len(words[w]) for w in order), np.int64, len(order))
    arrays = {"arc_key": np.array(keys, np.int64), "arc_target": np.array(targets, np.int32),
              "arc_output": np.array(outputs, np.int32),
              "accept": np.frombuffer(bytes(accepts), np.uint8),
              "id_start": np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
              "ids": np.array([i for w in order for i in words[w]], np.int32)}
    head, at = {"start": start, "longest": max(map(len, order), default=0)}, 0
    for name, a in arrays.items():
        head[name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    body = b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays.values())
    return len(text).to_bytes(8, "little") + text + body


class Lexicon:
    """Read-only transducer over a memory-mapped file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        size = int.from_bytes(self.map[:8], "little")
        head = json.loads(self.map[8:8 + size])
        self.start, self.longest = head.pop("start"), head.pop("longest")
        for name, (kind, n, at) in head.items():
            setattr(self, name, np.frombuffer(self.map, kind, n, 8 + size + at))

    def find(self, words: list[bytes]) -> np.ndarray:
        """Rank of every word, -1 for words outside the lexicon; all words walk in step."""
        out = np.full(len(words), -1, np.int64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-size, kind="stable")
        order = order[size[order] <= self.longest]
        if not len(order) or not len(self.arc_key):
            return out
        data = np.frombuffer(b"".join(words) + b"\0", np.uint8)
        first = (np.cumsum(size) - size)[order]
        left = size[order]
        state = np.full(len(order), self.start, np.int64)
        rank = np.zeros(len(order), np.int64)
        alive = np.ones(len(order), bool)
        for step in range(int(left[0])):
            n = int(np.searchsorted(-left, -step, side="left"))     # words longer than step
            at = np.flatnonzero(alive[:n])
            key = state[at] << 8 | data[first[at] + step]
            arc = np.minimum(np.searchsorted(self.arc_key, key), len(self.arc_key) - 1)
            hit = self.arc_key[arc] == key
            alive[at[~hit]] = False
            at, arc = at[hit], arc[hit]
            state[at] = self.arc_target[arc]
            rank[at] += self.arc_output[arc]
        ok = alive & (self.accept[state] == 1)
        out[order[ok]] = rank[ok]
        return out

    def ids_of(self, rank: int) -> np.ndarray:
        return self.ids[self.id_start[rank]:self.id_start[rank + 1]]
