"""A minimal acyclic transducer from frequent words to token ids.

Words are UTF-8 byte strings. The automaton shares prefixes and suffixes (equivalent states are merged while the sorted words
are added). Each arc carries a number; the sum of the numbers on a word's path is the word's rank, and the rank selects the
word's ids in one flat array. All parts are numpy arrays, so a file of them can be memory-mapped by every worker of a machine.
"""

from __future__ import annotations

import numpy as np


def build(words: list[bytes], ids: list[list[int]]) -> dict[str, np.ndarray]:
    """Compiles the words (any order, no repeats) and their ids; an empty list gives an automaton that accepts nothing."""
    order = sorted(range(len(words)), key=words.__getitem__)
    register: dict[tuple, int] = {}
    finals: list[bool] = []
    arcs: list[list[tuple[int, int]]] = []

    def settle(final: bool, out: list[tuple[int, int]]) -> int:
        key = (final, tuple(out))
        state = register.get(key)
        if state is None:
            state = register[key] = len(arcs)
            finals.append(final)
            arcs.append(out)
        return state

    # path[d] is the open state after d bytes: whether a word ends there, its closed arcs, and the byte that leads to the next
    path: list[list] = [[False, [], None]]

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            final, out, _ = path.pop()
            path[-1][1].append((path[-1][2], settle(final, out)))

    before = b""
    for k in order:
        word = words[k]
        same = 0
        while same < len(before) and same < len(word) and before[same] == word[same]:
            same += 1
        close(same)
        for byte in word[same:]:
            path[-1][2] = byte
            path.append([False, [], None])
        path[-1][0] = True
        before = word
    close(0)
    root = settle(path[0][0], path[0][1])

    below = np.zeros(len(arcs), np.int64)  # children are settled before their parents
    for state, out in enumerate(arcs):
        below[state] = finals[state] + sum(below[child] for _, child in out)
    keys, targets, outputs = [], [], []
    for state, out in enumerate(arcs):
        passed = int(finals[state])
        for byte, child in out:
            keys.append(state * 256 + byte)
            targets.append(child)
            outputs.append(passed)
            passed += int(below[child])
    lengths = np.array([len(ids[k]) for k in order], np.int64)
    return {
        "root": np.array([root], np.int64),
        "keys": np.array(keys, np.int64),
        "targets": np.array(targets, np.int64),
        "outputs": np.array(outputs, np.int64),
        "finals": np.array(finals, bool),
        "starts": np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
        "ids": np.array([i for k in order for i in ids[k]], np.int32),
    }


def ranks(auto: dict[str, np.ndarray], words: list[bytes]) -> np.ndarray:
    """The rank of each word, or -1 if the lexicon lacks it. All words advance together, one byte a step."""
    n = len(words)
    found = np.full(n, -1, np.int64)
    if not n or not len(auto["keys"]):
        return found
    lengths = np.fromiter(map(len, words), np.int64, n)
    flat = np.frombuffer(b"".join(words), np.uint8)
    starts = np.cumsum(lengths) - lengths
    alive = np.arange(n)
    state = np.full(n, int(auto["root"][0]), np.int64)
    total = np.zeros(n, np.int64)
    keys, depth = auto["keys"], 0
    while len(alive):
        ended = lengths[alive] == depth
        if ended.any():
            ok = ended & auto["finals"][state]
            found[alive[ok]] = total[ok]
            alive, state, total = alive[~ended], state[~ended], total[~ended]
            if not len(alive):
                break
        wanted = state * 256 + flat[starts[alive] + depth]
        at = np.searchsorted(keys, wanted)
        at[at == len(keys)] = 0
        ok = keys[at] == wanted
        at, alive = at[ok], alive[ok]
        state, total = auto["targets"][at], total[ok] + auto["outputs"][at]
        depth += 1
    return found
