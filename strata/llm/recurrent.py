"""A gated recurrent network over token numbers, in numpy, with a class-factored output (part of operator 12).

A token's number is below ``n_words`` (a word of its own), else it is a class of one token (a shape of rare words, or the
end). Output: softmax over classes, then softmax over the words of the class. Output biases start as the logarithms of the
tokens' counts, so an untrained network is the unigram model. Training is truncated backpropagation: windows of ``STEPS``
tokens over parallel lanes, the state carried from window to window, Adagrad. Scoring carries the state across windows
through whole documents; a lane goes on with its next document from the zero state.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heapify, heapreplace

import numpy as np

HIDDEN = 12
#: Words of a class with several words.
CLASS_WORDS = 32
#: Tokens of a training window in each lane, and lanes.
STEPS, LANES = 24, 512
#: Tokens of a scoring window in each lane, and most lanes.
SCORE_STEPS, SCORE_LANES = 64, 512
RATE = 0.06
F32 = np.float32


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= F32(0.5)
    np.tanh(x, out=x)
    x += F32(1)
    x *= F32(0.5)
    return x


@dataclass
class Network:
    """``inp``: tokens x 3H, what an input token adds to the gates; ``rec``: H x 3H; ``cls``, ``cls_b``: classes' output;
    ``word``, ``word_b``: classes x words x H, classes x words."""
    inp: np.ndarray
    rec: np.ndarray
    cls: np.ndarray
    cls_b: np.ndarray
    word: np.ndarray
    word_b: np.ndarray
    n_words: int

    NAMES = ("inp", "rec", "cls", "cls_b", "word", "word_b")

    @classmethod
    def start(cls, counts: np.ndarray, n_words: int, hidden: int = HIDDEN, seed: int = 7) -> Network:
        """An untrained network. ``counts`` by token number; ``n_words`` is a multiple of CLASS_WORDS."""
        rng = np.random.default_rng(seed)
        many, n = n_words // CLASS_WORDS, len(counts)
        share = (counts + 0.5) / (counts + 0.5).sum()
        words = share[:n_words].reshape(many, CLASS_WORDS)
        classes = np.concatenate([words.sum(axis=1), share[n_words:]])
        return cls(rng.normal(0, 0.1, (n, 3 * hidden)).astype(F32), rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(F32),
                   np.zeros((hidden, len(classes)), F32), np.log(classes).astype(F32),
                   np.zeros((many, CLASS_WORDS, hidden), F32), np.log(words / words.sum(axis=1, keepdims=True)).astype(F32), n_words)

    def class_of(self, tokens: np.ndarray) -> np.ndarray:
        return np.where(tokens < self.n_words, tokens // CLASS_WORDS, tokens - self.n_words + self.n_words // CLASS_WORDS)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES])

    def like(self, flat: np.ndarray) -> Network:
        """A network of this one's shape from flat parameters."""
        parts, at = [], 0
        for k in self.NAMES:
            old = getattr(self, k)
            parts.append(flat[at:at + old.size].reshape(old.shape).astype(F32))
            at += old.size
        return Network(*parts, self.n_words)


def step(net: Network, h: np.ndarray, gates: np.ndarray) -> tuple[np.ndarray, ...]:
    """The next state from the state and the input's share of the gates, with what the gradient needs."""
    n = h.shape[1]
    hu = h @ net.rec
    zr = sigmoid(gates[:, :2 * n] + hu[:, :2 * n])
    z, r = zr[:, :n], zr[:, n:]
    new = hu[:, 2 * n:] * r
    new += gates[:, 2 * n:]
    np.tanh(new, out=new)
    return (h - new) * z + new, z, r, new, hu


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts ``values``, the starts of equal runs, and their values."""
    order = np.argsort(values.astype(np.int16), kind="stable")  # token numbers are small: a radix sort
    ordered = values[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    return order, first, ordered[first]


def powers(logits: np.ndarray, weights: np.ndarray, bias: np.ndarray, axis: int) -> None:
    """exp(logits) in place, scaled by row where the weights could lead beyond a float (states lie in -1..1)."""
    if (np.abs(weights).sum(axis=axis) + np.abs(bias)).max() > 80:
        logits -= logits.max(axis=1)[:, None]
    np.exp(logits, out=logits)


def log_probabilities(net: Network, hidden: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Natural logarithms of P(token | state), rows of ``hidden``."""
    cls = net.class_of(tokens)
    p = hidden @ net.cls
    p += net.cls_b
    powers(p, net.cls, net.cls_b, 0)
    out = p[np.arange(len(cls)), cls] / p.sum(axis=1)
    order, first, which = runs(cls)
    for c, lo, hi in zip(which, first, np.append(first[1:], len(order))):
        if c >= len(net.word):
            break
        rows = order[lo:hi]
        q = hidden[rows] @ net.word[c].T
        q += net.word_b[c]
        powers(q, net.word[c], net.word_b[c], 1)
        out[rows] *= q[np.arange(len(rows)), tokens[rows] % CLASS_WORDS] / q.sum(axis=1)
    return np.log(np.maximum(out, F32(1e-37)))


def lanes_of(lengths: np.ndarray, most: int) -> list[np.ndarray]:
    """Documents dealt to lanes, the longest first to the least loaded lane; lanes from the longest down."""
    order = np.argsort(-lengths, kind="stable")
    heap = [(0, i) for i in range(max(1, min(most, len(lengths))))]
    heapify(heap)
    lanes: list[list[int]] = [[] for _ in heap]
    for d in order:
        load, i = heap[0]
        lanes[i].append(d)
        heapreplace(heap, (load + int(lengths[d]), i))
    loads = sorted(heap, reverse=True)
    return [np.array(lanes[i], np.int64) for load, i in loads if load]


def score(net: Network, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of every document; each ends with the last token number, the end."""
    end, out = len(net.inp) - 1, np.zeros(len(docs))
    if not docs:
        return out
    lanes = lanes_of(np.array([len(d) for d in docs]), SCORE_LANES)
    streams = [np.concatenate([docs[i] for i in lane]) for lane in lanes]
    owners = [np.repeat(lane, [len(docs[i]) for i in lane]) for lane in lanes]
    sizes = np.array([len(s) for s in streams])
    h = np.zeros((len(lanes), net.rec.shape[0]), F32)
    for at in range(0, int(sizes[0]), SCORE_STEPS):
        live = int((sizes > at).sum())
        span = min(SCORE_STEPS, int(sizes[0]) - at)
        tokens = np.full((span, live), end, np.int64)
        owner = np.full((span, live), -1, np.int64)
        for i in range(live):
            part = streams[i][at:at + span]
            tokens[:len(part), i] = part
            owner[:len(part), i] = owners[i][at:at + span]
        gates = net.inp[tokens]
        states = np.empty((span, live, h.shape[1]), F32)
        h = h[:live]
        resets = (tokens == end)
        any_reset = resets.any(axis=1)
        for t in range(span):
            states[t] = h
            h = step(net, h, gates[t])[0]
            if any_reset[t]:
                h[resets[t]] = 0
        real = owner.ravel() >= 0
        got = log_probabilities(net, states.reshape(-1, h.shape[1])[real], tokens.ravel()[real])
        out += np.bincount(owner.ravel()[real], got, minlength=len(docs))
    return out


class Trainer:
    """Adagrad on one network; ``feed`` takes documents, cut into lanes over all of them."""

    def __init__(self, net: Network, rate: float = RATE):
        self.net, self.rate = net.like(net.flat()), rate
        self.seen = {k: np.full(getattr(net, k).shape, 1e-3, F32) for k in Network.NAMES}
        self.tokens = 0

    def feed(self, docs: list[np.ndarray]) -> None:
        """One pass: the documents in their order as one stream, in LANES equal pieces."""
        stream = np.concatenate(docs) if docs else np.zeros(0, np.int64)
        lanes = min(LANES, max(1, len(stream) // STEPS))
        size = len(stream) // lanes
        if not size:
            return
        grid = stream[:size * lanes].reshape(lanes, size).T
        h = np.zeros((lanes, self.net.rec.shape[0]), F32)
        for at in range(0, size, STEPS):
            h = self.window(grid[at:at + STEPS].astype(np.int64), h)
        rest = stream[size * lanes:]
        if len(rest):
            self.window(rest[:, None].astype(np.int64), np.zeros((1, h.shape[1]), F32))
        self.tokens += len(stream)

    def adapt(self, name: str, grad: np.ndarray, rows=slice(None)) -> None:
        seen, value = self.seen[name], getattr(self.net, name)
        total = seen[rows] + grad * grad
        seen[rows] = total
        value[rows] -= F32(self.rate) * grad / np.sqrt(total)

    def window(self, tokens: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Forward and backward over steps x lanes tokens from state ``h``; gives the state after."""
        net, end, n = self.net, len(self.net.inp) - 1, h.shape[1]
        span, lanes = tokens.shape
        gates, kept = net.inp[tokens], []
        states = np.empty((span, lanes, n), F32)
        go = (tokens != end).astype(F32)[:, :, None]
        for t in range(span):
            states[t] = h
            h, *parts = step(net, h, gates[t])
            h *= go[t]
            kept.append(parts)
        grad_states = self.output_gradient(states.reshape(-1, n), tokens.ravel()).reshape(states.shape)
        pre, raw = np.empty((span, lanes, 3 * n), F32), np.empty((span, lanes, 3 * n), F32)
        later = np.zeros((lanes, n), F32)
        for t in range(span - 1, -1, -1):
            z, r, new, hu = kept[t]
            d = later * go[t]
            dz = d * (states[t] - new) * z * (1 - z)
            dn = d * (1 - z) * (1 - new * new)
            dr = dn * hu[:, 2 * n:] * r * (1 - r)
            raw[t, :, :n], raw[t, :, n:2 * n], raw[t, :, 2 * n:] = dz, dr, dn
            pre[t, :, :2 * n] = raw[t, :, :2 * n]
            pre[t, :, 2 * n:] = dn * r
            later = d * z + pre[t] @ net.rec.T + grad_states[t]
        self.adapt("rec", np.clip(states.reshape(-1, n).T @ pre.reshape(-1, 3 * n), -1, 1))
        order, first, which = runs(tokens.ravel())
        self.adapt("inp", np.add.reduceat(raw.reshape(-1, 3 * n)[order], first, axis=0), which)
        return h

    def output_gradient(self, hidden: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Adapts the output parameters; the gradient by the states. Losses are means over lanes."""
        net, scale = self.net, F32(1 / max(1, len(tokens) // STEPS))
        cls = net.class_of(tokens)
        p = hidden @ net.cls
        p += net.cls_b
        powers(p, net.cls, net.cls_b, 0)
        p *= (scale / p.sum(axis=1))[:, None]
        p[np.arange(len(cls)), cls] -= scale
        grad = p @ net.cls.T
        dcls, dbias = hidden.T @ p, p.sum(axis=0)
        order, first, which = runs(cls)
        many = int((which < len(net.word)).sum())
        dword, dword_b = np.empty((many, *net.word.shape[1:]), F32), np.empty((many, CLASS_WORDS), F32)
        for i, (c, lo, hi) in enumerate(zip(which[:many], first, np.append(first[1:], len(order)))):
            rows = order[lo:hi]
            own = hidden[rows]
            q = own @ net.word[c].T
            q += net.word_b[c]
            powers(q, net.word[c], net.word_b[c], 1)
            q *= (scale / q.sum(axis=1))[:, None]
            q[np.arange(len(rows)), tokens[rows] % CLASS_WORDS] -= scale
            grad[rows] += q @ net.word[c]
            np.matmul(q.T, own, out=dword[i])
            q.sum(axis=0, out=dword_b[i])
        self.adapt("word", dword, which[:many])
        self.adapt("word_b", dword_b, which[:many])
        self.adapt("cls", dcls)
        self.adapt("cls_b", dbias)
        return grad
