"""A character tagger in numpy: a bidirectional LSTM under a linear-chain CRF.

Characters are classes (letters by themselves, digits alike), tags are O and a
begin and an inside tag per kind.  Both directions run as one batched
recurrence.  Training is maximum likelihood of the CRF by Adam, with gradients
by the forward-backward algorithm and back-propagation through time.  The same
examples and seed give the same weights."""

from __future__ import annotations

import string
from typing import Dict, List, Sequence, Tuple

import numpy as np

PAD, DIGIT, UPPER, SPACE, BREAK, LETTER, OTHER = range(7)
_OWN = string.ascii_lowercase + "@.+-()[]_%:/,;#$=\"'{}"
CLASSES = 7 + len(_OWN)
_TABLE = np.full(128, OTHER, np.int64)
for _c in range(128):
    _s = chr(_c)
    _TABLE[_c] = (7 + _OWN.index(_s) if _s in _OWN else DIGIT if _s in string.digits else
                  UPPER if _s in string.ascii_uppercase else SPACE if _s in " \t" else
                  BREAK if _s in "\n\r\x0b\x0c" else OTHER)
NEVER = np.float32(-1e4)


def char_classes(texts: Sequence[str], width: int) -> np.ndarray:
    """(texts, width) classes; shorter texts are padded, longer ones not allowed."""
    out = np.zeros((len(texts), width), np.int64)
    for row, text in zip(out, texts):
        cp = np.frombuffer(text.encode("utf-32-le"), "<u4")
        row[:len(cp)] = np.where(cp < 128, _TABLE[np.minimum(cp, 127)], np.where(cp >= 0xC0, LETTER, OTHER))
    return out


def tag_count(kinds: int) -> int:
    return 1 + 2 * kinds


def legal_steps(kinds: int) -> Tuple[np.ndarray, np.ndarray]:
    """Penalties of transitions and of first tags: an inside tag follows its own kind only."""
    k = tag_count(kinds)
    step, start = np.zeros((k, k), np.float32), np.zeros(k, np.float32)
    for inside in range(2, k, 2):
        step[:, inside] = NEVER
        step[[inside - 1, inside], inside] = 0
        start[inside] = NEVER
    return step, start


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class CharTagger:
    def __init__(self, kinds: int, hidden: int = 20, seed: int = 0):
        rng = np.random.default_rng(seed)
        k, h = tag_count(kinds), hidden
        self.kinds, self.hidden = kinds, hidden
        self.step, self.start = legal_steps(kinds)

        def weights(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)
        self.p: Dict[str, np.ndarray] = {
            "x": weights(2, CLASSES, 4 * h, scale=0.3), "h": weights(2, h, 4 * h, scale=h ** -0.5),
            "b": np.zeros((2, 1, 4 * h), np.float32), "o": weights(2 * h, k, scale=h ** -0.5),
            "ob": np.zeros(k, np.float32), "t": np.zeros((k, k), np.float32), "s": np.zeros(k, np.float32)}
        self.p["b"][:, :, h:2 * h] = 1.0   # remember at first

    # -- the network ------------------------------------------------------
    def _recur(self, ids: np.ndarray, keep: bool = False):
        n, width = ids.shape
        h = self.hidden
        both = np.stack([ids, ids[:, ::-1]])
        mask = (both > 0).astype(np.float32)
        x = np.stack([self.p["x"][d][both[d]] for d in range(2)]) + self.p["b"][:, :, None]
        state, cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        hidden = np.empty((width, 2, n, h), np.float32)
        saved = []
        for t in range(width):
            z = x[:, :, t] + state @ self.p["h"]
            gates = _sigmoid(z[:, :, :3 * h])
            i, f, o = gates[..., :h], gates[..., h:2 * h], gates[..., 2 * h:]
            g = np.tanh(z[:, :, 3 * h:])
            m = mask[:, :, t, None]
            new = (f * cell + i * g) * m
            tanh = np.tanh(new)
            if keep:
                saved.append((state, cell, i, f, o, g, tanh, m))
            state, cell = o * tanh * m, new
            hidden[t] = state
        joined = np.concatenate([hidden[:, 0], hidden[::-1, 1]], -1).transpose(1, 0, 2)
        return joined, (both, saved)

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        return self._recur(ids)[0] @ self.p["o"] + self.p["ob"]

    # -- the CRF ----------------------------------------------------------
    def _forward_backward(self, e: np.ndarray, mask: np.ndarray):
        """Log partition, tag marginals and expected transitions."""
        n, width, k = e.shape
        step = self.p["t"] + self.step
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[:, 0] = self.p["s"] + self.start + e[:, 0]
        for t in range(1, width):
            new = _logsum(alpha[:, t - 1, :, None] + step, 1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
        for t in range(width - 2, -1, -1):
            new = _logsum(step + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(mask[:, t + 1, None], new, beta[:, t + 1])
        logz = _logsum(alpha[:, -1], 1)
        marginal = np.exp(alpha + beta - logz[:, None, None])
        pairs = np.zeros((k, k), np.float32)
        for t in range(1, width):
            on = mask[:, t]
            pairs += np.exp(alpha[on, t - 1, :, None] + step + (e[on, t] + beta[on, t])[:, None, :]
                            - logz[on, None, None]).sum(0)
        return logz, marginal, pairs

    def decode(self, ids: np.ndarray) -> Tuple[np.ndarray, np.ndarray]:
        """The best tags and the marginal of each."""
        e = self.emissions(ids)
        n, width, k = e.shape
        mask = ids > 0
        step = self.p["t"] + self.step
        best = self.p["s"] + self.start + e[:, 0]
        back = np.empty((width, n, k), np.int8)
        for t in range(1, width):
            score = best[:, :, None] + step
            back[t] = np.where(mask[:, t, None], score.argmax(1), np.arange(k))
            best = np.where(mask[:, t, None], score.max(1) + e[:, t], best)
        tags = np.empty((n, width), np.int64)
        tags[:, -1] = best.argmax(1)
        for t in range(width - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
        tags[~mask] = 0
        marginal = self._forward_backward(e, mask)[1]
        return tags, np.take_along_axis(marginal, tags[:, :, None], 2)[:, :, 0]

    # -- training ---------------------------------------------------------
    def _gradients(self, ids: np.ndarray, gold: np.ndarray) -> Tuple[float, Dict[str, np.ndarray]]:
        n, width = ids.shape
        h = self.hidden
        joined, (both, saved) = self._recur(ids, keep=True)
        e = joined @ self.p["o"] + self.p["ob"]
        mask = ids > 0
        logz, marginal, pairs = self._forward_backward(e, mask)
        rows = np.arange(n)
        on = mask[:, 1:]
        score = self.p["s"][gold[:, 0]] + np.where(mask, np.take_along_axis(e, gold[:, :, None], 2)[:, :, 0], 0).sum(1)
        score += np.where(on, self.p["t"][gold[:, :-1], gold[:, 1:]], 0).sum(1)
        de = marginal.copy()
        de[rows[:, None], np.arange(width), gold] -= 1
        de *= mask[:, :, None] / n
        grad = {"s": de[:, 0].sum(0), "t": pairs / n, "ob": de.sum((0, 1)),
                "o": joined.reshape(-1, 2 * h).T @ de.reshape(-1, de.shape[-1])}
        np.subtract.at(grad["t"], (gold[:, :-1][on], gold[:, 1:][on]), 1 / n)
        dj = (de @ self.p["o"].T).transpose(1, 0, 2)
        dh_out = np.stack([dj[:, :, :h], dj[::-1, :, h:]], 1)
        dz_all = np.empty((width, 2, n, 4 * h), np.float32)
        dstate, dcell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        grad["h"] = np.zeros_like(self.p["h"])
        back = self.p["h"].transpose(0, 2, 1)
        for t in range(width - 1, -1, -1):
            before, cell, i, f, o, g, tanh, m = saved[t]
            d = (dh_out[t] + dstate) * m
            dc = (dcell + d * o * (1 - tanh * tanh)) * m
            dz = np.concatenate([dc * g * i * (1 - i), dc * cell * f * (1 - f), d * tanh * o * (1 - o),
                                 dc * i * (1 - g * g)], -1)
            dz_all[t] = dz
            grad["h"] += before.transpose(0, 2, 1) @ dz
            dstate, dcell = dz @ back, dc * f
        flat = dz_all.transpose(1, 2, 0, 3).reshape(2, n * width, 4 * h)
        grad["b"] = flat.sum(1, keepdims=True)
        ones = np.stack([np.eye(CLASSES, dtype=np.float32)[b.reshape(-1)] for b in both])
        grad["x"] = ones.transpose(0, 2, 1) @ flat
        return float((logz - score).mean()), grad

    def fit(self, examples: List[Tuple[str, List[int]]], width: int, epochs: int = 8, batch: int = 64,
            rate: float = 0.02, seed: int = 0) -> List[float]:
        """Train on ``(text, tags)``; the mean loss of each epoch."""
        ids = char_classes([x for x, _ in examples], width)
        gold = np.zeros_like(ids)
        for row, (_, tags) in zip(gold, examples):
            row[:len(tags)] = tags
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        losses, n = [], 0
        total = epochs * -(-len(examples) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(examples))
            loss = []
            for at in range(0, len(order), batch):
                some = order[at:at + batch]
                long = int((ids[some] > 0).sum(1).max())
                value, grad = self._gradients(ids[some, :long], gold[some, :long])
                loss.append(value)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                n += 1
                pace = rate * min(1.0, 2 * (1 - (n - 1) / total))       # falls in the second half
                for k, g in grad.items():
                    g = g * min(1.0, 5.0 / max(norm, 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.p[k] = (self.p[k] - pace * (first[k] / (1 - 0.9 ** n))
                                 / (np.sqrt(second[k] / (1 - 0.99 ** n)) + 1e-8)).astype(np.float32)
            losses.append(float(np.mean(loss)))
        return losses
