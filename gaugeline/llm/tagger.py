"""Character tagger: bidirectional LSTM with CRF transitions, in numpy. Trained on the driver, applied in tasks."""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Tagger:
    """``look`` [2, symbols, 4 hidden], ``recur`` [2, hidden, 4 hidden], ``emit`` [2 hidden, tags], ``move`` [tags, tags]."""

    look: np.ndarray
    recur: np.ndarray
    emit: np.ndarray
    bias: np.ndarray
    move: np.ndarray
    start: np.ndarray

    @classmethod
    def new(cls, symbols: int, hidden: int, tags: int, rng: np.random.Generator) -> Tagger:
        look = rng.standard_normal((2, symbols, 4 * hidden)).astype(np.float32) * 0.3
        look[:, :, hidden : 2 * hidden] += 1  # forget gates begin open
        return cls(
            look,
            rng.standard_normal((2, hidden, 4 * hidden)).astype(np.float32) / np.float32(np.sqrt(hidden)),
            rng.standard_normal((2 * hidden, tags)).astype(np.float32) * 0.3,
            np.zeros(tags, np.float32),
            np.zeros((tags, tags), np.float32),
            np.zeros(tags, np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def _run(self, x: np.ndarray, side: int, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states [time, batch, hidden] of one direction; ``x`` is [time, batch] in its order."""
        hidden = self.recur.shape[1]
        h = np.zeros((x.shape[1], hidden), np.float32)
        c = np.zeros_like(h)
        out, steps = np.empty((*x.shape, hidden), np.float32), []
        for t in range(len(x)):
            z = self.look[side][x[t]] + h @ self.recur[side]
            gates, g = _sigmoid(z[:, : 3 * hidden]), np.tanh(z[:, 3 * hidden :])
            i, f, o = gates[:, :hidden], gates[:, hidden : 2 * hidden], gates[:, 2 * hidden :]
            before, was = c, h
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            out[t] = h
            if keep:
                steps.append((i, f, o, g, before, tc, was))
        return out, steps

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """[batch, time, tags] for symbols [batch, time]."""
        x = x.T
        both = [self._run(x, 0, False)[0], self._run(x[::-1], 1, False)[0][::-1]]
        return (np.concatenate(both, axis=2) @ self.emit + self.bias).transpose(1, 0, 2)

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best path [batch, time], and the posterior probability of each of its tags.

        Tag 0 means nothing found: windows whose path has no other keep probability 1.
        """
        scores = self.emissions(x)
        batch, time, _ = scores.shape
        value = scores[:, 0] + self.start
        back = np.empty((time, *value.shape), np.int8)
        for t in range(1, time):
            ways = value[:, :, None] + self.move
            back[t] = ways.argmax(1)
            value = ways.max(1) + scores[:, t]
        path = np.empty((batch, time), np.int8)
        path[:, -1] = value.argmax(1)
        for t in range(time - 1, 0, -1):
            path[:, t - 1] = back[t][np.arange(batch), path[:, t]]
        sure = np.ones((batch, time))
        some = np.flatnonzero(path.any(1))
        if len(some):
            own = scores[some].transpose(1, 0, 2).astype(np.float64)
            ahead, behind, total = self._sums(own)
            shares = np.exp(ahead + behind - total[None, :, None]).transpose(1, 0, 2)
            sure[some] = np.take_along_axis(shares, path[some][:, :, None].astype(np.int64), 2)[:, :, 0]
        return path, sure

    def _sums(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log sums over all paths up to and from each tag, for scores [time, batch, tags], and over whole paths."""
        move = self.move.astype(np.float64)
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0] + self.start
        for t in range(1, len(scores)):
            ahead[t] = np.logaddexp.reduce(ahead[t - 1][:, :, None] + move, axis=1) + scores[t]
        for t in range(len(scores) - 1, 0, -1):
            behind[t - 1] = np.logaddexp.reduce(move[None] + (scores[t] + behind[t])[:, None, :], axis=2)
        return ahead, behind, np.logaddexp.reduce(ahead[-1], axis=1)

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log-likelihood of the paths ``y`` and its gradient for ``weights()``."""
        batch, time = x.shape
        hidden = self.recur.shape[1]
        fx, bx = x.T, x.T[::-1]
        fh, fs = self._run(fx, 0, True)
        bh, bs = self._run(bx, 1, True)
        both = np.concatenate([fh, bh[::-1]], axis=2)
        scores = (both @ self.emit + self.bias).astype(np.float64)
        move = self.move.astype(np.float64)
        ahead, behind, total = self._sums(scores)
        d_move = np.zeros_like(move)
        for t in range(1, time):
            step = move[None] + (scores[t] + behind[t])[:, None, :]
            d_move += np.exp(ahead[t - 1][:, :, None] + step - total[:, None, None]).sum(0)
        d_scores = np.exp(ahead + behind - total[None, :, None])
        ty, rows = y.T, np.arange(batch)
        own = self.start[ty[0]].sum() + sum(scores[t][rows, ty[t]].sum() for t in range(time))
        own += move[ty[:-1], ty[1:]].sum()
        loss = float(total.sum() - own) / batch
        for t in range(time):
            d_scores[t][rows, ty[t]] -= 1
        np.subtract.at(d_move, (ty[:-1].ravel(), ty[1:].ravel()), 1)
        d_scores = (d_scores / batch).astype(np.float32)
        grads = [np.zeros_like(w) for w in self.weights()]
        grads[2][...] = np.einsum("tbh,tbk->hk", both, d_scores)
        grads[3][...] = d_scores.sum((0, 1))
        grads[4][...] = d_move / batch
        grads[5][...] = d_scores[0].sum(0)
        d_both = d_scores @ self.emit.T
        for side, (xs, steps, d_out) in enumerate(((fx, fs, d_both[:, :, :hidden]), (bx, bs, d_both[::-1, :, hidden:]))):
            dh, dc = np.zeros((batch, hidden), np.float32), np.zeros((batch, hidden), np.float32)
            for t in range(time - 1, -1, -1):
                i, f, o, g, before, tc, was = steps[t]
                dh = dh + d_out[t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate(
                    [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1
                )
                np.add.at(grads[0][side], xs[t], dz)
                grads[1][side] += was.T @ dz
                dh, dc = dz @ self.recur[side].T, dc * f
        return loss, grads


def train(x: np.ndarray, y: np.ndarray, symbols: int, tags: int, hidden: int, steps: int, batch: int, seed: int) -> Tagger:
    """Adam over random batches of the windows ``x`` with tags ``y``."""
    rng = np.random.default_rng(seed)
    model = Tagger.new(symbols, hidden, tags, rng)
    first = [np.zeros_like(w) for w in model.weights()]
    second = [np.zeros_like(w) for w in model.weights()]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(x), batch)
        _, grads = model.gradient(x[pick], y[pick])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        rate = 0.02 * min(1.0, 3 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(model.weights(), grads, first, second, strict=True):
            g = g * min(1.0, 5.0 / max(norm, 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model
