"""A bidirectional gated recurrent network with attention pooling, forward and backward, in numpy."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def sums_by(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of ``index``, ascending, and the sum of the rows of ``values`` at each."""
    order = np.argsort(index, kind="stable")
    ordered = index[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], np.add.reduceat(values[order], first, axis=0)


class Network:
    """Windows of word inputs to one logit each.

    ``inputs`` (words x d) are the distinct words' vectors, ``windows`` (n x t) numbers of words and
    ``mask`` (n x t) 1 where a word stands.  Both directions have ``hidden`` gated units; attention
    weighs the places of a window, and a linear layer judges the weighted sum.
    """

    def __init__(self, d: int, hidden: int, seed: int, glance: list[float]):
        random = np.random.default_rng(seed)
        draw = lambda *shape: random.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.hidden = hidden
        self.p = {"look": draw(2 * hidden, hidden), "query": draw(hidden), "out": draw(2 * hidden), "bias": np.zeros(1, np.float32)}
        # attention also glances at the inputs themselves: it starts from these weights of the first ones
        self.p["glance"] = np.array(glance + [0.0] * (d - len(glance)), np.float32)
        for side in "fb":
            self.p |= {f"w{side}": draw(d, 3 * hidden), f"u{side}": draw(hidden, 3 * hidden),
                       f"c{side}": np.zeros(3 * hidden, np.float32)}

    def _sweep(self, side: str, inputs, windows, mask, keep: bool):
        """Hidden states (t x n x hidden) of one direction, and what its backward pass needs."""
        h, p = self.hidden, self.p
        given = inputs @ p[f"w{side}"] + p[f"c{side}"]
        n, t = windows.shape
        state, states, trace = np.zeros((n, h), np.float32), np.empty((t, n, h), np.float32), {}
        full = bool(mask.all())
        for i in (range(t) if side == "f" else range(t - 1, -1, -1)):
            x, back = given[windows[:, i]], state @ p[f"u{side}"]
            gates = sigmoid(x[:, :2 * h] + back[:, :2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(x[:, 2 * h:] + r * back[:, 2 * h:])
            after = new + z * (state - new)
            if not full:
                after = np.where(mask[:, i:i + 1] > 0, after, state)
            if keep:
                trace[i] = (state, z, r, new, back[:, 2 * h:])
            state = states[i] = after
        return states, trace

    def forward(self, inputs, windows, mask, keep: bool = False):
        ahead, ahead_trace = self._sweep("f", inputs, windows, mask, keep)
        behind, behind_trace = self._sweep("b", inputs, windows, mask, keep)
        states = np.concatenate([ahead, behind], axis=2)
        seen = np.tanh(states @ self.p["look"])
        weight = seen @ self.p["query"] + (inputs @ self.p["glance"])[windows.T] + np.where(mask.T > 0, 0, -1e9).astype(np.float32)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logits = pooled @ self.p["out"] + self.p["bias"]
        return (logits, (states, seen, weight, pooled, ahead_trace, behind_trace)) if keep else logits

    def backward(self, inputs, windows, mask, kept, d_logits) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of all parameters and of ``inputs``."""
        states, seen, weight, pooled, ahead_trace, behind_trace = kept
        p, h = self.p, self.hidden
        grads = {"out": pooled.T @ d_logits, "bias": d_logits.sum(keepdims=True)}
        d_pooled = d_logits[:, None] * p["out"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = np.einsum("nh,tnh->tn", d_pooled, states)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        grads["query"] = np.einsum("tn,tnh->h", d_score, seen)
        d_seen = d_score[:, :, None] * p["query"] * (1 - seen ** 2)
        grads["look"] = np.einsum("tnh,tnk->hk", states, d_seen, optimize=True)
        d_states = d_states + d_seen @ p["look"].T
        place = windows.T.ravel()
        d_glance = np.zeros(len(inputs), np.float32)
        found, total = sums_by(place, d_score.ravel())
        d_glance[found] = total
        grads["glance"] = inputs.T @ d_glance
        d_inputs = d_glance[:, None] * p["glance"]
        for side, trace, part in (("f", ahead_trace, d_states[:, :, :h]), ("b", behind_trace, d_states[:, :, h:])):
            u, grad_u = p[f"u{side}"], np.zeros_like(p[f"u{side}"])
            d_given, d_places = np.zeros((len(inputs), 3 * h), np.float32), np.empty((*part.shape[:2], 3 * h), np.float32)
            carry = np.zeros_like(part[0])
            for i in (range(len(part) - 1, -1, -1) if side == "f" else range(len(part))):
                state, z, r, new, back = trace[i]
                on = mask[:, i:i + 1]
                d_after = part[i] + carry
                d_new = d_after * (1 - z) * (1 - new ** 2) * on
                d_z = d_after * (state - new) * z * (1 - z) * on
                d_r = d_new * back * r * (1 - r)
                d_back = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_places[i] = np.concatenate([d_z, d_r, d_new], axis=1)
                grad_u += state.T @ d_back
                carry = d_after * np.where(on > 0, z, 1) + d_back @ u.T
            found, total = sums_by(place, d_places.reshape(-1, 3 * h))
            d_given[found] = total
            grads |= {f"u{side}": grad_u, f"w{side}": inputs.T @ d_given, f"c{side}": d_given.sum(axis=0)}
            d_inputs += d_given @ p[f"w{side}"].T
        return grads, d_inputs


class Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.moments = rate, 0, {}

    def update(self, p: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.step += 1
        for name, g in grads.items():
            m, v = self.moments.get(name, (0.0, 0.0))
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g ** 2
            self.moments[name] = (m, v)
            p[name] -= self.rate * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.999 ** self.step)) + 1e-8)
