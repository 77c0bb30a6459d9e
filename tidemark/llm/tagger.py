"""Character-level bidirectional LSTM with CRF transitions, in numpy.

Batches of equally padded character ids go through an embedding, an LSTM in each
direction and a linear layer to tag scores; a linear-chain CRF (transitions, start and end
scores) gives the likelihood. Gradients are written out: forward-backward for the CRF,
back-propagation through time for the LSTMs. Adam trains it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

EMBEDDING = 12
HIDDEN = 20
ALPHABET = 101  # printable ASCII, then kinds of other characters (see `char_ids`)


def char_ids(text: str) -> np.ndarray:
    """Printable ASCII by itself; other letters, digits, white space and the rest by kind.
    Zero is padding."""
    return np.array([ord(c) - 31 if " " <= c <= "~" else 96 if c.isalpha() else
                     97 if c.isdigit() else 98 if c.isspace() else 99 for c in text], np.int16)


@dataclass
class Tagger:
    tags: int
    seed: int = 11
    precision: type = np.float64  # of the parameters and the LSTMs; the CRF sums are double
    p: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        rng = np.random.default_rng(self.seed)
        e, h, k = EMBEDDING, HIDDEN, self.tags
        self.p = {"embed": rng.normal(0, 0.3, (ALPHABET, e)),
                  "out": rng.normal(0, 1 / np.sqrt(2 * h), (2 * h, k)), "bias": np.zeros(k),
                  "move": np.zeros((k, k)), "first": np.zeros(k), "last": np.zeros(k)}
        for side in "fb":
            self.p["x" + side] = rng.normal(0, 1 / np.sqrt(e), (e, 4 * h))
            self.p["h" + side] = rng.normal(0, 1 / np.sqrt(h), (h, 4 * h))
            gate = np.zeros(4 * h)
            gate[h:2 * h] = 1.0  # remember at first
            self.p["g" + side] = gate
        self.p = {k: v.astype(self.precision) for k, v in self.p.items()}

    # ------------------------------------------------------------ LSTM
    # both directions run side by side, position by position; the second one reads the rows
    # backwards, so its arrays are reversed in time
    def _both(self, name: str) -> np.ndarray:
        return np.stack([self.p[name + side] for side in "fb"])

    def _lstm(self, x: np.ndarray, mask: np.ndarray, keep: bool):
        """States of both directions side by side, and what the way back needs."""
        n, t, e = x.shape
        h = HIDDEN
        kind = self.precision
        pre = np.empty((t, 2, n, 4 * h), kind)
        for d, side in enumerate("fb"):
            way = x if side == "f" else x[:, ::-1]
            pre[:, d] = way.transpose(1, 0, 2) @ self.p["x" + side] + self.p["g" + side]
        on = np.stack([mask, mask[:, ::-1]]).transpose(2, 0, 1)[..., None]
        weight = self._both("h")
        half = np.r_[np.full(3 * h, 0.5), np.ones(h)].astype(kind)  # sigmoid(z) = (1 + tanh(z / 2)) / 2
        states, cells = np.zeros((2, t + 1, 2, n, h), kind)
        acts, tops = np.empty((t, 2, n, 4 * h), kind), np.empty((t, 2, n, h), kind)
        for i in range(t):
            act = np.tanh((pre[i] + states[i] @ weight) * half)  # in, forget, out, new
            act[..., :3 * h] += 1
            act[..., :3 * h] *= 0.5
            m = on[i]
            cell = act[..., h:2 * h] * cells[i] + act[..., :h] * act[..., 3 * h:]
            cells[i + 1] = m * cell + (1 - m) * cells[i]
            tops[i] = np.tanh(cells[i + 1])
            states[i + 1] = m * (act[..., 2 * h:3 * h] * tops[i]) + (1 - m) * states[i]
            acts[i] = act
        out = np.concatenate([states[1:, 0], states[:0:-1, 1]], axis=2).transpose(1, 0, 2)
        return out, (on, states, cells, acts, tops) if keep else None

    def _lstm_back(self, x: np.ndarray, saved, grad: np.ndarray, g: dict) -> np.ndarray:
        """Adds the parameters' gradients to `g`; returns those of `x`."""
        n, t, e = x.shape
        h = HIDDEN
        on, states, cells, acts, tops = saved
        above = np.stack([grad[:, :, :h], grad[:, ::-1, h:]]).transpose(2, 0, 1, 3)
        back = self._both("h").transpose(0, 2, 1)
        # what does not depend on later positions, for all positions at once
        sig, new = acts[..., :3 * h], acts[..., 3 * h:]
        slope = np.concatenate([sig * (1 - sig), 1 - new ** 2], axis=3)
        times = np.concatenate([new, cells[:-1], tops, sig[..., :h]], axis=3)
        slope *= times
        into = sig[..., 2 * h:] * (1 - tops ** 2)
        dz = np.empty((t, 2, n, 4 * h), self.precision)
        dstate, dcell = np.zeros((2, 2, n, h), self.precision)
        for i in range(t - 1, -1, -1):
            m = on[i]
            ds = above[i] + dstate
            inner = ds * m
            dc = dcell + inner * into[i]
            live = dc * m
            dz[i] = np.concatenate([live, live, inner, live], axis=2) * slope[i]
            dcell = live * sig[i, ..., h:2 * h] + dc * (1 - m)
            dstate = dz[i] @ back + ds * (1 - m)
        dx = np.zeros_like(x)
        for d, side in enumerate("fb"):
            flat = dz[:, d].reshape(-1, 4 * h)
            way = x if side == "f" else x[:, ::-1]
            g["h" + side] += states[:-1, d].reshape(-1, h).T @ flat
            g["x" + side] += way.transpose(1, 0, 2).reshape(-1, e).T @ flat
            g["g" + side] += flat.sum(axis=0)
            dway = (flat @ self.p["x" + side].T).reshape(t, n, e).transpose(1, 0, 2)
            dx += dway if side == "f" else dway[:, ::-1]
        return dx

    def emissions(self, ids: np.ndarray, keep: bool = False):
        mask = (ids > 0).astype(self.precision)
        x = self.p["embed"][ids]
        both, saved = self._lstm(x, mask, keep)
        return both @ self.p["out"] + self.p["bias"], (mask, x, both, saved)

    # ------------------------------------------------------------ CRF
    def _sums(self, e: np.ndarray, mask: np.ndarray):
        """Forward and backward sums of every position, each position scaled to forward sums
        of one; what a pair of tags at i and i + 1 takes from the position i + 1; and the log
        normaliser. forward * backward are the marginals of the tags."""
        n, t, k = e.shape
        e = e.astype(np.float64)
        top = e.max(axis=2, keepdims=True)
        q = np.exp(e - top)
        move, last = np.exp(self.p["move"]), np.exp(self.p["last"])
        fore, back, ahead = np.empty((t, n, k)), np.empty((t, n, k)), np.zeros((t, n, k))
        scale = np.ones((t, n, 1))
        fore[0] = np.exp(self.p["first"]) * q[:, 0]
        scale[0] = fore[0].sum(axis=1, keepdims=True)
        fore[0] /= scale[0]
        for i in range(1, t):
            live = mask[:, i, None] > 0
            step = (fore[i - 1] @ move) * q[:, i]
            scale[i] = np.where(live, step.sum(axis=1, keepdims=True), 1.0)
            fore[i] = np.where(live, step / scale[i], fore[i - 1])
        end = fore[-1] @ last
        back[-1] = last / end[:, None]
        for i in range(t - 2, -1, -1):
            live = mask[:, i + 1, None] > 0
            ahead[i] = np.where(live, q[:, i + 1] * back[i + 1] / scale[i + 1], 0.0)
            back[i] = np.where(live, ahead[i] @ move.T, back[-1])
        total = (np.log(scale[..., 0]) + top[..., 0].T * (mask.T > 0)).sum(axis=0) + np.log(end)
        return fore, back, ahead, total

    def marginals(self, e: np.ndarray, mask: np.ndarray) -> np.ndarray:
        fore, back, _, _ = self._sums(e, mask)
        return (fore * back).transpose(1, 0, 2)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of each row, and the marginal probability of each of them."""
        e, (mask, *_) = self.emissions(ids)
        n, t, k = e.shape
        score = self.p["first"] + e[:, 0]
        came = np.zeros((n, t, k), np.int8)
        for i in range(1, t):
            options = score[:, :, None] + self.p["move"]
            came[:, i] = options.argmax(axis=1)
            step = options.max(axis=1) + e[:, i]
            live = mask[:, i, None] > 0
            came[:, i] = np.where(live, came[:, i], np.arange(k))
            score = np.where(live, step, score)
        best = np.zeros((n, t), np.int64)
        best[:, -1] = (score + self.p["last"]).argmax(axis=1)
        for i in range(t - 1, 0, -1):
            best[:, i - 1] = came[np.arange(n), i, best[:, i]]
        sure = np.take_along_axis(self.marginals(e, mask), best[:, :, None], 2)[:, :, 0]
        return best, sure

    # ------------------------------------------------------------ training
    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the tags, and its gradients."""
        e, (mask, x, both, saved) = self.emissions(ids, keep=True)
        n, t, k = e.shape
        g = {name: np.zeros_like(v) for name, v in self.p.items()}
        fore, back, ahead, total = self._sums(e, mask)
        on = np.eye(k)[tags] * mask[:, :, None]
        length = mask.sum(axis=1).astype(int)
        rows = np.arange(n)
        end = tags[rows, length - 1]
        pairs = mask[:, 1:]
        gold = ((e * on).sum(axis=(1, 2)) + self.p["first"][tags[:, 0]] + self.p["last"][end]
                + (self.p["move"][tags[:, :-1], tags[:, 1:]] * pairs).sum(axis=1))
        loss = float((total - gold).mean())

        p = (fore * back).transpose(1, 0, 2)
        de = (p - on) * mask[:, :, None] / n
        g["first"] = (p[:, 0] - on[:, 0]).sum(axis=0) / n
        g["last"] = (p[:, -1] - np.eye(k)[end]).sum(axis=0) / n
        g["move"] = np.exp(self.p["move"]) * (fore.reshape(-1, k).T @ ahead.reshape(-1, k)) / n
        np.add.at(g["move"], (tags[:, :-1], tags[:, 1:]), -pairs / n)

        g["out"] = both.reshape(-1, both.shape[2]).T @ de.reshape(-1, k)
        g["bias"] = de.sum(axis=(0, 1))
        dx = self._lstm_back(x, saved, (de @ self.p["out"].T).astype(self.precision), g)
        np.add.at(g["embed"], ids, dx)
        return loss, g

    def train(self, ids: np.ndarray, tags: np.ndarray, steps: int, batch: int = 64,
              rate: float = 0.012) -> list[float]:
        """`steps` batches of random rows; returns each batch's loss."""
        rng = np.random.default_rng(self.seed)
        first = {k: 0.0 for k in self.p}
        second = {k: 0.0 for k in self.p}
        losses: list[float] = []
        queue = np.empty(0, np.int64)
        for step in range(1, steps + 1):
            while len(queue) < batch:
                queue = np.r_[queue, rng.permutation(len(ids))]
            part, queue = queue[:batch], queue[batch:]
            loss, g = self.gradients(ids[part], tags[part])
            norm = np.sqrt(sum(float((v ** 2).sum()) for v in g.values()))
            clip = min(1.0, 5.0 / (norm + 1e-12))
            pace = rate * (1 - 0.8 * step / steps)
            for k in self.p:
                first[k] = 0.9 * first[k] + 0.1 * g[k] * clip
                second[k] = 0.999 * second[k] + 0.001 * (g[k] * clip) ** 2
                move = pace * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
                self.p[k] = (self.p[k] - move).astype(self.precision)
            losses.append(loss)
        return losses
