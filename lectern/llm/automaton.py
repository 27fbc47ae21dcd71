"""Byte-pair encoding as a deterministic automaton over tokens.

The automaton starts with one state and an arc of every byte. Each merge ``(left, right)`` is
applied in rank order as a gadget: the state reached by ``left`` is cloned without its arc
``right``, arcs labelled ``left`` are led to the clone, and an arc labelled with the merged token is
added wherever the two arcs followed each other. A token sequence is accepted exactly when it is
what the merges make of its bytes, and every byte string has exactly one accepted sequence. So
encoding is one pass of table look-ups, and decoding emits the labels of the arcs.

A gadget adds one state, and all arcs of one label lead to one state, so a state can be named by
the token that leads to it. Its chain of clones consists of the merges whose left part lies on the
token's right spine, which is how ``has_arc`` reads the chain without storing every arc.
"""

from __future__ import annotations

import base64
import functools
from pathlib import Path

import regex

#: Where the vocabularies lie unless ``lectern.tokenizer.dir`` or the caller says otherwise.
DEFAULT_DIR = "/opt/tokenizers"

#: Fixed value: the pattern that splits text ahead of the byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

NEVER = 1 << 40


def read_ranks(directory: str, name: str) -> list[bytes]:
    """Token bytes in rank order of a ``.tiktoken`` file."""
    ranked = {}
    for line in (Path(directory) / f"{name}.tiktoken").read_bytes().splitlines():
        if line.strip():
            text, rank = line.split()
            ranked[int(rank)] = base64.b64decode(text)
    return [ranked[k] for k in range(len(ranked))]


class Automaton:
    """The compiled tables. Their size is bounded by the vocabulary (50 thousand tokens), so they
    are broadcast whatever the corpus."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.step: dict[bytes, int] = {}  # a token, or -1 for a mere prefix of some
        self.left: list[int] = []
        self.right: list[int] = []
        self.gadget: dict[tuple[int, int], int] = {}
        self.arcs: dict[tuple[int, int], bool] = {}
        self.clones = 1
        for token in tokens:
            self._add(token)
        self.arcs.clear()

    def _add(self, token: bytes) -> None:
        """Apply the gadget of one more token: its parts are the one accepted pair of arcs that
        spells it so far."""
        number = len(self.left)
        parts = (-1, -1)
        if len(token) > 1:
            path = self._path(token)
            if len(path) != 2:
                raise ValueError(f"token {number} is not the merge of two earlier ones")
            parts = (path[0], path[1])
            self.gadget[parts] = number
            self.clones += 1
        self.left.append(parts[0])
        self.right.append(parts[1])
        for end in range(1, len(token)):
            self.step.setdefault(token[:end], -1)
        self.step[token] = number

    def has_arc(self, last: int, token: int) -> bool:
        """Whether the state reached by ``last`` has an arc ``token``: no gadget on its chain of
        clones took away the token, or the part the token grew from before it grew."""
        known = self.arcs.get((last, token))
        if known is not None:
            return known
        gadget, left, right = self.gadget, self.left, self.right
        found = True
        state, born_before = last, NEVER
        while found and state >= 0:
            part, grown_at = token, NEVER
            while part >= 0:
                taken = gadget.get((state, part))
                if taken is not None and taken < born_before and taken <= grown_at:
                    found = False
                    break
                grown_at, part = part, left[part]
            born_before, state = state, right[state]
        if len(self.arcs) > 2_000_000:
            self.arcs.clear()
        self.arcs[last, token] = found
        return found

    def _path(self, word: bytes) -> list[int]:
        step, tokens = self.step, self.tokens
        size = len(word)
        last = [-1] * (size + 1)
        for start in range(size):
            before = last[start]
            for end in range(start + 1, size + 1):
                token = step.get(word[start:end])
                if token is None:
                    break
                if token >= 0 and last[end] < 0 and (start == 0 or self.has_arc(before, token)):
                    last[end] = token
        path = []
        while size:
            path.append(last[size])
            size -= len(tokens[last[size]])
        path.reverse()
        return path

    def encode_word(self, word: bytes) -> list[int]:
        """The ids of one pre-split word. The start state has every arc, so a word that is a token
        is that token; otherwise each prefix has one accepted path, extended arc by arc."""
        token = self.step.get(word, -1)
        return [token] if token >= 0 else self._path(word)

    def encode(self, text: str | None) -> list[int]:
        """The ids of a whole text, without special tokens; empty and null give none."""
        ids: list[int] = []
        for word in splitter().findall(text or ""):
            ids.extend(self.encode_word(word.encode("utf-8", "replace")))
        return ids

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, joined."""
        return b"".join(self.tokens[i] for i in ids).decode("utf-8", "replace")


@functools.cache
def splitter() -> regex.Pattern:
    return regex.compile(SPLIT)


@functools.cache
def load(directory: str, name: str) -> Automaton:
    """The automaton of a vocabulary file, compiled once in a process."""
    return Automaton(read_ranks(directory, name))
