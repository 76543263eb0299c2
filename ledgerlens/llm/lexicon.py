"""A minimal acyclic transducer from words to token ids, in one memory-mapped file.

Words with a common ending share the states of that ending.  Every transition
also tells how many words lie before it, so the path of a word adds up to its
number in sorted order, and the number finds its ids.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np

_ALIGN = 64


def minimal_automaton(words: Iterable[bytes]) -> dict[str, np.ndarray]:
    """Arrays of the automaton of sorted, distinct ``words``: ``edge`` (state *
    256 + byte, sorted), ``to``, ``skip`` (words before this transition) and
    ``final`` by state.  State 0 is the start."""
    register: dict[tuple, int] = {}
    states: list[tuple] = []          # (final, ((byte, state), ...)), children first
    path: list[list] = [[False, []]]  # open states from the start to the end of the last word
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges = path.pop()
            shape = (final, tuple(edges))
            at = register.get(shape)
            if at is None:
                at = register[shape] = len(states)
                states.append(shape)
            path[-1][1].append((last[len(path) - 1], at))

    for word in words:
        if word <= last and last:
            raise ValueError("words must be sorted and distinct")
        same = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        close(same)
        path.extend([False, []] for _ in word[same:])
        path[-1][0] = True
        last = word
    close(0)
    states.append((path[0][0], tuple(path[0][1])))
    n = len(states)
    size = [0] * n
    for i, (final, edges) in enumerate(states):
        size[i] = final + sum(size[t] for _, t in edges)
    edge, to, skip, ends = [], [], [], []
    for i in range(n - 1, -1, -1):    # the start becomes state 0
        final, edges = states[i]
        before = int(final)
        for byte, target in edges:
            edge.append((n - 1 - i) * 256 + byte)
            to.append(n - 1 - target)
            skip.append(before)
            before += size[target]
        ends.append(int(final))
    return {"edge": np.array(edge, np.uint32), "to": np.array(to, np.uint32),
            "skip": np.array(skip, np.uint32), "final": np.array(ends, np.uint8)}


def lookup(arrays: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """The number of each word in sorted order, -1 for words not held; all words
    take their next step together."""
    n = len(words)
    out = np.full(n, -1, np.int64)
    if not n or not len(arrays["edge"]):
        return out
    size = np.fromiter(map(len, words), np.int64, n)
    data = np.frombuffer(b"".join(words), np.uint8)
    start = np.cumsum(size) - size
    live = np.flatnonzero(size > 0)
    state, number = np.zeros(n, np.int64), np.zeros(n, np.int64)
    edge, to, skip = arrays["edge"], arrays["to"], arrays["skip"]
    step = 0
    while len(live):
        want = (state[live] * 256 + data[start[live] + step]).astype(np.uint32)
        at = np.minimum(np.searchsorted(edge, want), len(edge) - 1)
        good = edge[at] == want
        live, at = live[good], at[good]
        state[live] = to[at]
        number[live] += skip[at]
        step += 1
        done = size[live] == step
        ended = live[done]
        ended = ended[arrays["final"][state[ended]] == 1]
        out[ended] = number[ended]
        live = live[~done]
    return out


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    """One file image: a JSON line with the sections, then the sections."""
    at, where, body = 0, {}, []
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        pad = -len(raw) % _ALIGN
        where[name] = [a.dtype.str, at, len(a)]
        body += [raw, b"\0" * pad]
        at += len(raw) + pad
    head = json.dumps(where).encode()
    head += b" " * (-(len(head) + 1) % _ALIGN) + b"\n"
    return head + b"".join(body)


def mapped(path: str) -> dict[str, np.ndarray]:
    """The sections of a packed file as views of one memory map."""
    with open(path, "rb") as f:
        head = f.readline()
    whole = np.asarray(np.memmap(path, np.uint8, "r"))      # a plain view of the map
    out = {}
    for name, (kind, at, n) in json.loads(head).items():
        kind = np.dtype(kind)
        begin = len(head) + at
        out[name] = whole[begin:begin + n * kind.itemsize].view(kind)
    return out
