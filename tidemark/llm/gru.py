"""A bidirectional gated recurrent network over bytes, in numpy.

Both directions run side by side as one leading axis of size two. Shapes are
(direction, units, windows), so that every step works on long rows.
"""

from __future__ import annotations

import numpy as np

Params = dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def initial(units: int, classes: int, seed: int = 0) -> Params:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    return {
        "input": draw(2, 3 * units, 256),  # what each byte adds to update, reset and candidate
        "back": draw(2, 3 * units, units),
        "bias": np.zeros((2, units, 1), dtype=np.float32),
        "out": draw(classes, 2 * units),
        "out_bias": np.zeros((classes, 1), dtype=np.float32),
    }


def _ordered(windows: np.ndarray) -> np.ndarray:
    """Steps first: windows as they are and reversed, as (step, direction, window)."""
    return np.stack([windows.T, windows.T[::-1]], axis=1)


def _step(p: Params, byte: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    units = h.shape[1]
    # One row per byte is taken at once and turned, which is faster than taking columns.
    x = np.stack([p["input"][d].T[byte[d]].T for d in range(2)])
    u = p["back"] @ h
    gates = _sigmoid(x[:, : 2 * units] + u[:, : 2 * units])
    z, r = gates[:, :units], gates[:, units:]
    inner = u[:, 2 * units :] + p["bias"]
    n = np.tanh(x[:, 2 * units :] + r * inner)
    return n + z * (h - n), z, r, n, inner


def _probabilities(p: Params, states: np.ndarray) -> np.ndarray:
    """(step, class, window) from states (step, direction, units, window) in reading order."""
    steps, _, units, n = states.shape
    logits = p["out"] @ states.reshape(steps, 2 * units, n) + p["out_bias"]
    logits -= logits.max(axis=1, keepdims=True)
    e = np.exp(logits)
    return e / e.sum(axis=1, keepdims=True)


def predict(p: Params, windows: np.ndarray) -> np.ndarray:
    """Class probabilities at every position of ``windows`` (window, step) of bytes: (step, class, window)."""
    n, steps = windows.shape
    units = p["back"].shape[2]
    bytes_, h = _ordered(windows), np.zeros((2, units, n), dtype=np.float32)
    states = np.empty((steps, 2, units, n), dtype=np.float32)
    p = p | {"input": np.ascontiguousarray(p["input"].transpose(0, 2, 1)).transpose(0, 2, 1)}
    for t in range(steps):
        h = _step(p, bytes_[t], h)[0]
        states[t, 0], states[steps - 1 - t, 1] = h[0], h[1]
    return _probabilities(p, states)


def gradients(p: Params, windows: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, Params]:
    """Mean cross-entropy over all unmasked positions, and its gradient by backpropagation through time."""
    n, steps = windows.shape
    units, classes = p["back"].shape[2], len(p["out"])
    bytes_ = _ordered(windows)
    h = np.zeros((2, units, n), dtype=np.float32)
    kept, states = [], np.empty((steps, 2, units, n), dtype=np.float32)
    for t in range(steps):
        new, *rest = _step(p, bytes_[t], h)
        kept.append((h, *rest))
        h = new
        states[t, 0], states[steps - 1 - t, 1] = h[0], h[1]
    probs = _probabilities(p, states)
    weight = mask.T[:, None, :].astype(np.float32) / max(1, int(mask.sum()))
    true = np.zeros((classes, n), dtype=np.float32)
    true[labels, np.arange(n)] = 1
    loss = -float((np.log(probs[:, labels, np.arange(n)] + 1e-9) * weight[:, 0]).sum())
    d_logits = (probs - true) * weight
    flat = states.reshape(steps, 2 * units, n)
    grad = {
        "out": np.einsum("tcn,tun->cu", d_logits, flat, optimize=True),
        "out_bias": d_logits.sum(axis=(0, 2))[:, None],
        "back": np.zeros_like(p["back"]),
        "bias": np.zeros_like(p["bias"]),
    }
    d_states = (p["out"].T @ d_logits).reshape(steps, 2, units, n)
    d_input = np.empty((steps, 2, 3 * units, n), dtype=np.float32)
    d_next = np.zeros((2, units, n), dtype=np.float32)
    turned = p["back"].transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        before, z, r, cand, inner = kept[t]
        dh = d_next + np.stack([d_states[t, 0], d_states[steps - 1 - t, 1]])
        d_cand = dh * (1 - z) * (1 - cand * cand)
        d_z = dh * (before - cand) * z * (1 - z)
        d_r = d_cand * inner * r * (1 - r)
        d_inner = d_cand * r
        d_input[t] = np.concatenate([d_z, d_r, d_cand], axis=1)
        d_u = np.concatenate([d_z, d_r, d_inner], axis=1)
        grad["back"] += d_u @ before.transpose(0, 2, 1)
        grad["bias"] += d_inner.sum(axis=2, keepdims=True)
        d_next = dh * z + turned @ d_u
    grad["input"] = np.zeros_like(p["input"])
    for d in range(2):
        at = bytes_[:, d].ravel()
        values = d_input[:, d].transpose(1, 0, 2).reshape(3 * units, -1)
        for unit in range(3 * units):
            grad["input"][d, unit] = np.bincount(at, values[unit], minlength=256)
    return loss, grad


def train(
    windows: np.ndarray, mask: np.ndarray, labels: np.ndarray, classes: int,
    *, units: int = 8, steps: int = 300, batch: int = 256, rate: float = 0.02, seed: int = 0,
) -> Params:
    """Adam over random batches; the same input gives the same network."""
    p, rng = initial(units, classes, seed), np.random.default_rng(seed + 1)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(windows), batch)
        _, grad = gradients(p, windows[rows], mask[rows], labels[rows])
        size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        shrink = min(1.0, 1.0 / (size + 1e-9))
        now = rate * (1 - 0.9 * step / steps)
        for k, g in grad.items():
            g = g * shrink
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            p[k] -= (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return p
