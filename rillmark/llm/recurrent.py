"""A bidirectional gated recurrent network with attention pooling, trained and run in numpy.

Input of a window of words: for each word a vector of its own (for words frequent in
training) and the mean vector of its character trigrams, so unknown and misspelt words
are read by their characters. Two gated recurrent layers read the window in both
directions; attention weighs the states; a logistic output scores the window.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from rillmark.llm.words import FOLD, Words

WINDOW, STRIDE = 32, 16
TRIGRAMS, CHAR_DIM, WORD_DIM, HIDDEN, ATTENTION = 1024, 8, 8, 8, 8
GATES = 3 * HIDDEN
KEEP = np.float32(30.0)  # an update gate so far up that the state stays: padding


class Distinct(NamedTuple):
    """Distinct words of a batch: hash, and the trigram buckets of each with the first position of each."""

    hash: np.ndarray
    trigrams: np.ndarray
    offsets: np.ndarray
    lengths: np.ndarray


def distinct_words(words: Words) -> tuple[Distinct, np.ndarray]:
    """Distinct words, and for each word of the batch its number among them."""
    hashes, first, number = np.unique(words.hash, return_index=True, return_inverse=True)
    begin, end = words.begin[first], words.end[first]
    lengths = end - begin
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    if not len(hashes):
        return Distinct(hashes, np.zeros(0, np.int64), offsets, lengths), number
    at = np.repeat(begin - offsets[:-1], lengths) + np.arange(offsets[-1])
    folded = lambda places: FOLD[words.data[places]].astype(np.uint32)
    centre = folded(at)
    left = folded(np.maximum(at - 1, 0))
    left[offsets[:-1]] = 94
    right = folded(np.minimum(at + 1, len(words.data) - 1))
    right[offsets[1:] - 1] = 36
    mixed = (left * np.uint32(2654435761)) ^ (centre * np.uint32(2246822519)) ^ (right * np.uint32(3266489917))
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(2146121005)
    return Distinct(hashes, (mixed >> np.uint32(22)).astype(np.int64) % TRIGRAMS, offsets, lengths), number


def window_starts(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts with words first[i]..first[i+1]: text, first word and length of every overlapping window."""
    sizes = np.diff(first)
    counts = np.where(sizes > 0, np.maximum(1, -(-(sizes - WINDOW) // STRIDE) + 1), 0)
    row = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = first[:-1][row] + nth * STRIDE
    return row, start, np.minimum(WINDOW, first[1:][row] - start)


def windows_beside(first: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word and length of every full window that starts less than STRIDE words beside a window that starts at ``near``.

    Starts that ``window_starts`` gives already are left out.
    """
    of = np.searchsorted(first, near, side="right") - 1
    last = np.maximum(first[of + 1] - WINDOW, first[of])
    marks = np.zeros(int(first[-1]) + 1, np.int64)
    a, b = np.maximum(near - STRIDE + 1, first[of]), np.minimum(near + STRIDE - 1, last)
    some = a <= b
    np.add.at(marks, a[some], 1)
    np.add.at(marks, b[some] + 1, -1)
    start = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
    row = np.searchsorted(first, start, side="right") - 1
    fresh = (start - first[row]) % STRIDE != 0
    row, start = row[fresh], start[fresh]
    return row, start, np.minimum(WINDOW, first[row + 1] - start)


def window_ids(number: np.ndarray, start: np.ndarray, length: np.ndarray, pad: int) -> np.ndarray:
    """(windows, WINDOW) word numbers; ``pad`` behind the end of a text."""
    steps = np.arange(WINDOW)
    at = np.minimum(start[:, None] + steps, len(number) - 1)
    return np.where(steps < length[:, None], number[at], pad)


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters by name, the word vocabulary (sorted hashes), forward and backward passes."""

    def __init__(self, vocabulary: np.ndarray, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.vocabulary = np.sort(vocabulary)
        size = WORD_DIM + CHAR_DIM
        normal = lambda scale, *shape: (draw.standard_normal(shape) * scale).astype(np.float32)
        self.p = {
            "word": normal(0.1, len(vocabulary) + 1, WORD_DIM), "char": normal(0.3, TRIGRAMS, CHAR_DIM),
            "x0": normal(0.3, size, GATES), "x1": normal(0.3, size, GATES), "b0": np.zeros(GATES, np.float32), "b1": np.zeros(GATES, np.float32),
            "h0": normal(0.3, HIDDEN, GATES), "h1": normal(0.3, HIDDEN, GATES),
            "a": normal(0.4, 2 * HIDDEN, ATTENTION), "ab": np.zeros(ATTENTION, np.float32), "v": normal(0.4, ATTENTION, 1),
            "o": normal(0.4, 2 * HIDDEN, 1), "ob": np.zeros(1, np.float32),
        }
        self.p["word"][0] = 0

    def word_numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of the word table; 0 for unknown words."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def inputs(self, words: Distinct) -> np.ndarray:
        chars = np.zeros((len(words.hash), CHAR_DIM), np.float32)
        if len(words.hash):
            chars = np.add.reduceat(self.p["char"][words.trigrams], words.offsets[:-1], axis=0) / words.lengths[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][self.word_numbers(words.hash)], chars], axis=1)

    def projected(self, inputs: np.ndarray) -> list[np.ndarray]:
        """Gate inputs of each distinct word for both directions, and of padding as the last row."""
        out = []
        for d in "01":
            gates = np.empty((len(inputs) + 1, GATES), np.float32)
            np.matmul(inputs, self.p["x" + d], out=gates[:-1])
            gates[:-1] += self.p["b" + d]
            gates[-1] = 0
            gates[-1, :HIDDEN] = KEEP
            out.append(gates)
        return out

    def states(self, gates: list[np.ndarray], ids: np.ndarray, tape: list | None = None) -> np.ndarray:
        """(WINDOW, windows, 2 * HIDDEN) states of both directions."""
        n = len(ids)
        out = np.empty((WINDOW, n, 2 * HIDDEN), np.float32)
        for d in (0, 1):
            h, u = np.zeros((n, HIDDEN), np.float32), self.p[f"h{d}"]
            for t in range(WINDOW) if d == 0 else range(WINDOW - 1, -1, -1):
                x, g = gates[d][ids[:, t]], h @ u
                zr = _sigmoid(x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                m = np.tanh(x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
                if tape is not None:
                    tape.append((d, t, h, z, r, m, g[:, 2 * HIDDEN :]))
                h = m + z * (h - m)
                out[t, :, d * HIDDEN : (d + 1) * HIDDEN] = h
        return out

    def pooled(self, states: np.ndarray, ids: np.ndarray, pad: int):
        keys = np.tanh(states @ self.p["a"] + self.p["ab"])
        scores = (keys @ self.p["v"])[:, :, 0] + np.where(ids.T == pad, np.float32(-1e9), np.float32(0))
        weights = np.exp(scores - scores.max(axis=0))
        weights /= weights.sum(axis=0)
        return keys, weights, np.einsum("tn,tnk->nk", weights, states)

    def score(self, words: Distinct, number: np.ndarray, start: np.ndarray, length: np.ndarray, block: int = 4096) -> np.ndarray:
        """Probability of label 1 for every window."""
        gates, pad = self.projected(self.inputs(words)), len(words.hash)
        out = np.empty(len(start), np.float64)
        for a in range(0, len(start), block):
            ids = window_ids(number, start[a : a + block], length[a : a + block], pad)
            pooled = self.pooled(self.states(gates, ids), ids, pad)[2]
            out[a : a + block] = _sigmoid((pooled @ self.p["o"])[:, 0].astype(np.float64) + float(self.p["ob"][0]))
        return out

    def gradients(self, words: Distinct, ids: np.ndarray, target: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted log loss over windows; ``words`` holds just the words in ``ids``."""
        p, pad, tape = self.p, len(words.hash), []
        inputs = self.inputs(words)
        gates = self.projected(inputs)
        states = self.states(gates, ids, tape)
        keys, attention, pooled = self.pooled(states, ids, pad)
        score = _sigmoid((pooled @ p["o"])[:, 0] + p["ob"][0])
        out = {}
        d_logit = ((score - target) * weight / weight.sum()).astype(np.float32)
        out["o"], out["ob"] = pooled.T @ d_logit[:, None], d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * p["o"][:, 0]
        d_attention = np.einsum("nk,tnk->tn", d_pooled, states)
        d_states = attention[:, :, None] * d_pooled
        d_scores = attention * (d_attention - (attention * d_attention).sum(axis=0))
        out["v"] = np.einsum("tn,tnk->k", d_scores, keys)[:, None]
        d_keys = d_scores[:, :, None] * p["v"][:, 0] * (1 - keys * keys)
        out["a"], out["ab"] = np.einsum("tnk,tna->ka", states, d_keys), d_keys.sum(axis=(0, 1))
        d_states += d_keys @ p["a"].T
        d_inputs = np.zeros_like(inputs)
        d_gates = [np.zeros_like(g) for g in gates]
        out |= {f"h{d}": np.zeros_like(p[f"h{d}"]) for d in (0, 1)}
        carry = np.zeros((len(ids), HIDDEN), np.float32)
        seen = None
        for d, t, h, z, r, m, g in reversed(tape):
            if seen != d:
                carry, seen = np.zeros((len(ids), HIDDEN), np.float32), d
            dh = carry + d_states[t, :, d * HIDDEN : (d + 1) * HIDDEN]
            dm = dh * (1 - z) * (1 - m * m)
            dz = dh * (h - m) * z * (1 - z)
            dr = dm * g * r * (1 - r)
            d_in = np.concatenate([dz, dr, dm], axis=1)
            d_rec = np.concatenate([dz, dr, dm * r], axis=1)
            out[f"h{d}"] += h.T @ d_rec
            carry = dh * z + d_rec @ p[f"h{d}"].T
            np.add.at(d_gates[d], ids[:, t], d_in)
        for d in (0, 1):
            flat = d_gates[d][:-1]
            out[f"x{d}"], out[f"b{d}"] = inputs.T @ flat, flat.sum(axis=0)
            d_inputs += flat @ p[f"x{d}"].T
        out["word"] = np.zeros_like(p["word"])
        np.add.at(out["word"], self.word_numbers(words.hash), d_inputs[:, :WORD_DIM])
        out["word"][0] = 0
        out["char"] = np.zeros_like(p["char"])
        per_char = d_inputs[:, WORD_DIM:] / words.lengths[:, None].astype(np.float32)
        np.add.at(out["char"], words.trigrams, np.repeat(per_char, words.lengths, axis=0))
        return out


def part_of(words: Distinct, chosen: np.ndarray) -> Distinct:
    """The distinct words with these numbers."""
    lengths = words.lengths[chosen]
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    at = np.repeat(words.offsets[chosen] - offsets[:-1], lengths) + np.arange(offsets[-1])
    return Distinct(words.hash[chosen], words.trigrams[at], offsets, lengths)


def descend(net: Network, words: Distinct, ids: np.ndarray, target: np.ndarray, weight: np.ndarray, rate: float, batch: int, decay: float, seed: int) -> None:
    """One pass of Adam over shuffled batches of windows, the rate falling to zero, with weight decay."""
    draw, pad = np.random.default_rng(seed), len(words.hash)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    order, steps = draw.permutation(len(ids)), -(-len(ids) // batch)
    for step in range(1, steps + 1):
        rows = order[(step - 1) * batch : step * batch]
        chosen, local = np.unique(ids[rows], return_inverse=True)
        local = local.reshape(len(rows), WINDOW)
        used = chosen[:-1] if chosen[-1] == pad else chosen
        grads = net.gradients(part_of(words, used), local, target[rows], weight[rows])
        pace = rate * (1 - step / (steps + 1)) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        for k, grad in grads.items():
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.99 * second[k] + 0.01 * grad * grad
            net.p[k] = (net.p[k] * (1 - decay * pace) - pace * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)


def train(
    words: Distinct, number: np.ndarray, windows: tuple[np.ndarray, np.ndarray, np.ndarray], target: np.ndarray, weight: np.ndarray,
    vocabulary: np.ndarray, rounds: int = 6, batch: int = 256, rate: float = 0.02, decay: float = 0.02, seed: int = 7,
) -> Network:
    """Learn from labelled texts of which only some windows show the label.

    ``windows``: text, first word and length of each. First every window carries its
    text's label; then, in rounds, only the window that scores highest in each text does,
    so a text is what its worst window is.
    """
    net = Network(vocabulary, seed)
    row, start, length = windows
    share = float(np.clip((target * weight).sum() / weight.sum(), 1e-4, 1 - 1e-4))
    net.p["ob"][0] = np.log(share / (1 - share))
    pad = len(words.hash)
    descend(net, words, window_ids(number, start, length, pad), target[row], weight[row], rate, batch, decay, seed)
    for k in range(rounds):
        scores = net.score(words, number, start, length)
        order = np.lexsort((scores, row))
        worst = order[np.flatnonzero(np.concatenate([row[order][1:] != row[order][:-1], [True]]))]
        ids = window_ids(number, start[worst], length[worst], pad)
        descend(net, words, ids, target[row[worst]], weight[row[worst]], rate / 2, batch // 4, decay, seed + k + 1)
    return net
