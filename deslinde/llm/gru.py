"""A gated recurrent language model in numpy: truncated backpropagation through time and a class-factored softmax.

A step reads a word number, updates the state and gives the log probability of the next word as that of its class
times that of the word inside the class. Classes are runs of consecutive word numbers.
"""

from __future__ import annotations

import heapq

import numpy as np


def class_borders(counts: np.ndarray, classes: int) -> np.ndarray:
    """Borders of runs of word numbers (by falling count) of about equal shares of all occurrences."""
    share = np.cumsum(counts + 1.0)
    cut = np.searchsorted(share, share[-1] * np.arange(1, classes) / classes, "right")
    return np.unique(np.concatenate([[0], np.maximum(cut, 1), [len(counts)]]))


def _tame(scores: np.ndarray) -> None:
    """Lower the scores of each row so that none overflows; most never could, and are left."""
    if len(scores) and (scores.max() > 60 or scores.min() < -60):
        scores -= scores.max(axis=1, keepdims=True)


class Gru:
    """Parameters of the model and of its optimiser as one flat vector each."""

    def __init__(self, borders: np.ndarray, hidden: int):
        self.borders, self.hidden = borders, hidden
        words, classes, h = int(borders[-1]), len(borders) - 1, hidden
        self.class_of = np.repeat(np.arange(classes), np.diff(borders))
        self.shapes = {
            "reads": (words, 3 * h), "turns": (h, 3 * h), "class_lines": (h, classes), "class_bias": (classes,),
            "word_lines": (words, h), "word_bias": (words,),
        }
        self.size = sum(int(np.prod(s)) for s in self.shapes.values())

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.shapes.items():
            n = int(np.prod(shape))
            out[name] = flat[at : at + n].reshape(shape)
            at += n
        return out

    def start(self, counts: np.ndarray, seed: int = 0) -> np.ndarray:
        """Parameters that give every word its share of ``counts``, whatever came before."""
        rng = np.random.default_rng(seed)
        flat = np.zeros(self.size, np.float32)
        p = self.views(flat)
        for name in ("reads", "turns", "word_lines", "class_lines"):
            p[name][:] = rng.normal(0, 0.1 if name == "reads" else 1 / np.sqrt(self.hidden) if name == "turns" else 0.01, p[name].shape)
        mass = counts + 1.0
        p["class_bias"][:] = np.log(np.add.reduceat(mass, self.borders[:-1]))
        p["word_bias"][:] = np.log(mass)
        return flat

    def states(self, p: dict, words: np.ndarray, state: np.ndarray, end: int, keep: list | None = None) -> np.ndarray:
        """States after each step of ``words`` (steps x lanes) from ``state``; reading ``end`` forgets what came before.

        The state of the last step is written to ``state``.
        """
        h = self.hidden
        reads, out = p["reads"][words], np.empty((*words.shape, h), np.float32)
        ends, now = words == end, state
        starting = ends.any(axis=1)
        for t in range(len(words)):
            before = np.where(ends[t][:, None], np.float32(0), now) if starting[t] else now
            turned = before @ p["turns"]
            gates = reads[t, :, : 2 * h] + turned[:, : 2 * h]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates[:, :h], gates[:, h:]
            new = r * turned[:, 2 * h :]
            new += reads[t, :, 2 * h :]
            np.tanh(new, out=new)
            now = out[t]
            np.subtract(before, new, out=now)
            now *= z
            now += new
            if keep is not None:
                keep.append((before, z, r, new, turned[:, 2 * h :]))
        state[:] = now
        return out

    def log_probabilities(self, p: dict, states: np.ndarray, words: np.ndarray, grads: dict | None = None):
        """Natural log probability of each word after its state; with ``grads``, the loss's gradient by state as well."""
        classes = self.class_of[words]
        scores = states @ p["class_lines"]
        scores += p["class_bias"]
        _tame(scores)
        every = np.arange(len(words))
        target = scores[every, classes].astype(np.float64)
        np.exp(scores, out=scores)
        total = scores.sum(axis=1, keepdims=True)
        out = target - np.log(total[:, 0])
        back = None
        if grads is not None:
            scores /= total
            scores[every, classes] -= 1
            grads["class_lines"] += states.T @ scores
            grads["class_bias"] += scores.sum(axis=0)
            back = scores @ p["class_lines"].T
        order = np.argsort(classes, kind="stable")
        edges = np.searchsorted(classes[order], np.arange(len(self.borders)))
        for c in np.flatnonzero(np.diff(edges)):
            first, last = self.borders[c], self.borders[c + 1]
            if last - first == 1:
                continue
            rows = order[edges[c] : edges[c + 1]]
            mine = states[rows]
            inner = mine @ p["word_lines"][first:last].T
            inner += p["word_bias"][first:last]
            _tame(inner)
            few, at = np.arange(len(rows)), words[rows] - first
            target = inner[few, at].astype(np.float64)
            np.exp(inner, out=inner)
            total = inner.sum(axis=1, keepdims=True)
            out[rows] += target - np.log(total[:, 0])
            if grads is not None:
                inner /= total
                inner[few, at] -= 1
                grads["word_lines"][first:last] += inner.T @ mine
                grads["word_bias"][first:last] += inner.sum(axis=0)
                back[rows] += inner @ p["word_lines"][first:last]
        return out, back

    def backward(self, p: dict, grads: dict, words: np.ndarray, back: np.ndarray, kept: list, end: int) -> None:
        """Carry the gradient by state through the steps of one window; it stops at the window's first step."""
        h, carried = self.hidden, np.zeros(back.shape[1:], np.float32)
        by_read, by_turn = np.empty((*back.shape[:2], 3 * h), np.float32), np.empty((*back.shape[:2], 3 * h), np.float32)
        for t in range(len(words) - 1, -1, -1):
            before, z, r, new, turned = kept[t]
            now = back[t] + carried
            by_new = now * (1 - z) * (1 - new * new)
            by_read[t, :, :h] = now * (before - new) * z * (1 - z)
            by_read[t, :, h : 2 * h] = by_new * turned * r * (1 - r)
            by_read[t, :, 2 * h :] = by_new
            by_turn[t] = by_read[t]
            by_turn[t, :, 2 * h :] *= r
            carried = now * z + by_turn[t] @ p["turns"].T
            carried[words[t] == end] = 0
        before = np.concatenate([k[0] for k in kept])
        grads["turns"] += before.T @ by_turn.reshape(-1, 3 * h)
        flat = words.reshape(-1)
        order = np.argsort(flat, kind="stable")
        begins = np.flatnonzero(np.diff(flat[order], prepend=-1))
        grads["rows"] = flat[order[begins]]
        grads["reads"] = np.add.reduceat(by_read.reshape(-1, 3 * h)[order], begins, axis=0)

    def train(self, flat: np.ndarray, squares: np.ndarray, stream: np.ndarray, end: int, lanes: int, window: int, rate: float) -> None:
        """One pass over ``stream`` (word numbers, ``end`` after each document), in lanes of consecutive parts, by Adagrad in place."""
        lanes = max(1, min(lanes, (len(stream) - 1) // window))
        steps = (len(stream) - 1) // lanes
        if steps < 1:
            return
        reads = stream[: lanes * steps].reshape(lanes, steps).T
        wants = stream[1 : lanes * steps + 1].reshape(lanes, steps).T
        p, s, state = self.views(flat), self.views(squares), np.zeros((lanes, self.hidden), np.float32)
        for a in range(0, steps, window):
            x, y, kept = reads[a : a + window], wants[a : a + window], []
            states = self.states(p, x, state, end, kept)
            grads = {k: np.zeros(self.shapes[k], np.float32) for k in self.shapes if k != "reads"}
            _, back = self.log_probabilities(p, states.reshape(-1, self.hidden), y.reshape(-1), grads)
            self.backward(p, grads, x, back.reshape(states.shape), kept, end)
            rows, share = grads.pop("rows"), np.float32(1 / lanes)
            for name, g in grads.items():
                g *= share
                np.clip(g, -1, 1, out=g)
                to = rows if name == "reads" else slice(None)
                s[name][to] += g * g
                p[name][to] -= rate * g / np.sqrt(s[name][to] + 1e-6)

    def score(self, flat: np.ndarray, stream: np.ndarray, begins: np.ndarray, end: int, lanes: int, window: int) -> np.ndarray:
        """Natural log probability of each document of ``stream`` (``begins``: first places, one entry more), from its first word to its end.

        Documents are dealt whole to lanes of about equal length; the state goes on from window to window.
        """
        p, lengths = self.views(flat), np.diff(begins)
        lanes = max(1, min(lanes, len(lengths)))
        loads, dealt = [(0, lane) for lane in range(lanes)], [[] for _ in range(lanes)]
        heapq.heapify(loads)
        for d in np.argsort(-lengths, kind="stable"):
            load, lane = heapq.heappop(loads)
            dealt[lane].append(d)
            heapq.heappush(loads, (load + int(lengths[d]), lane))
        dealt = sorted((np.array(x, np.int64) for x in dealt if x), key=lambda x: -int(lengths[x].sum()))
        sizes = np.array([int(lengths[x].sum()) for x in dealt])
        chosen = np.concatenate(dealt) if dealt else np.zeros(0, np.int64)
        places = np.repeat(begins[chosen] - np.cumsum(lengths[chosen]) + lengths[chosen], lengths[chosen]) + np.arange(len(stream))
        firsts = np.cumsum(sizes) - sizes
        out, state = np.zeros(len(stream)), np.zeros((len(sizes), self.hidden), np.float32)
        before = np.empty(len(stream), stream.dtype)
        before[1:] = stream[:-1]
        before[begins[:-1]] = end
        for a in range(0, int(sizes.max(initial=0)), window):
            going = int(np.searchsorted(-sizes, -a))
            step = a + np.arange(min(window, int(sizes[0]) - a))[:, None]
            live = step < sizes[:going]
            at = places[np.where(live, firsts[:going] + step, 0)]
            states = self.states(p, np.where(live, before[at], end), state[:going], end)
            out[at[live]], _ = self.log_probabilities(p, states[live], stream[at[live]])
        return np.add.reduceat(out, begins[:-1]) if len(lengths) else np.zeros(0)
