"""A small causal self-attention model in numpy, with its gradient.

It predicts the class of the next symbol.  The skip connection is the log probability of the
class after the last symbol, as counted in the corpus; one attention head over the symbols
before adds what the context tells.  The output weights start at zero, so an untrained
model is the counted one.
"""

from __future__ import annotations

import numpy as np

WIDTH = 16
CONTEXT = 64  # symbols in a window
OVERLAP = 16  # symbols at the beginning of a window that an earlier one has scored
AT_ONCE = 32  # windows in one numpy step, few enough for a processor's cache
_RATE = 0.01


def initial(classes: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.RandomState(seed)
    draw = lambda *shape: (rng.randn(*shape) / np.sqrt(shape[0])).astype(np.float32)
    return {"q": draw(WIDTH, WIDTH), "k": draw(WIDTH, WIDTH), "v": draw(WIDTH, WIDTH), "near": np.zeros(CONTEXT, np.float32),
            "out": np.zeros((WIDTH, classes), np.float32)}


_DISTANCE = np.arange(CONTEXT)[:, None] - np.arange(CONTEXT)[None, :]
_BACK = np.maximum(_DISTANCE, 0)


def _softmax(x: np.ndarray) -> np.ndarray:
    x -= x.max(axis=-1, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=-1, keepdims=True)
    return x


def _held(x: np.ndarray, most: int) -> np.ndarray:
    return np.clip(x, -most, most, out=x)


def _nearness(weights: dict) -> np.ndarray:
    """What each distance multiplies the weight of a symbol by; 0 for symbols ahead."""
    return np.where(_DISTANCE >= 0, np.exp(np.clip(weights["near"], -20, 20))[_BACK], 0)


def _attend(q: np.ndarray, k: np.ndarray, v: np.ndarray, nearness: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the symbols before (not yet divided by their sum), and the sums of their values, the last value being 1."""
    a = _held(q @ k.transpose(0, 2, 1), 60)
    np.exp(a, out=a)
    a *= nearness[CONTEXT - q.shape[1]:]
    return a, a @ v


def forward(weights: dict, embedding: np.ndarray, skip: np.ndarray, symbols: np.ndarray, skipped: int = 0) -> tuple:
    """Class scores (logits) after the symbols of the windows (n, CONTEXT), but for the first `skipped` of each, and what
    the gradient needs.  Scores of attention are held within 60 and logits within 80, so that exponents need no greatest one."""
    e = embedding.take(symbols, axis=0)
    q, k = e[:, skipped:] @ (weights["q"] * WIDTH ** -0.5), e @ weights["k"]
    v = np.ones((*e.shape[:2], WIDTH + 1), e.dtype)
    np.matmul(e, weights["v"], out=v[:, :, :WIDTH])
    a, sums = _attend(q, k, v, _nearness(weights).astype(e.dtype))
    a /= sums[:, :, WIDTH:]
    mixed = sums[:, :, :WIDTH] / sums[:, :, WIDTH:]
    logits = mixed @ weights["out"]
    logits += skip.take(symbols[:, skipped:], axis=0)
    return _held(logits, 80), (e, q, k, v[:, :, :WIDTH], a, mixed)


class Tables:
    """The forward step for many windows of few symbols: embeddings are fixed, so what a symbol asks, offers and
    says is tabulated once."""

    def __init__(self, weights: dict, embedding: np.ndarray, skip: np.ndarray):
        self.q, self.k = embedding @ weights["q"] * np.float32(WIDTH ** -0.5), embedding @ weights["k"]
        self.v = np.concatenate([embedding @ weights["v"], np.ones((len(embedding), 1), embedding.dtype)], axis=1)
        self.nearness = _nearness(weights).astype(embedding.dtype)
        self.out, self.skip = weights["out"], skip

    def logits(self, symbols: np.ndarray, skipped: int = 0) -> np.ndarray:
        """As `forward`."""
        own = symbols[:, skipped:]
        _, sums = _attend(self.q.take(own, axis=0), self.k.take(symbols, axis=0), self.v.take(symbols, axis=0), self.nearness)
        logits = (sums[:, :, :WIDTH] / sums[:, :, WIDTH:]) @ self.out
        logits += self.skip.take(own, axis=0)
        return _held(logits, 80)


def _gradient(weights: dict, embedding: np.ndarray, skip: np.ndarray, x: np.ndarray, y: np.ndarray, skipped: int) -> dict[str, np.ndarray]:
    """Of the loss summed over the windows' targets; none of them is among the first `skipped`."""
    g, (e, q, k, v, a, mixed) = forward(weights, embedding, skip, x, skipped)
    y = y[:, skipped:]
    np.exp(g, out=g)
    known = (y >= 0).astype(g.dtype)
    g *= (known / g.sum(axis=-1))[:, :, None]
    flat = lambda z: z.reshape(-1, z.shape[-1])
    flat(g)[np.arange(y.size), np.maximum(y, 0).ravel()] -= known.ravel()
    dm = g @ weights["out"].T
    ds = dm @ v.transpose(0, 2, 1)
    ds -= np.einsum("bij,bij->bi", dm, mixed)[:, :, None]
    ds *= a
    # q is already scaled, and so is what it adds to k.
    dq, dk, dv = ds @ k, ds.transpose(0, 2, 1) @ q, a.transpose(0, 2, 1) @ dm
    own, every = flat(e[:, skipped:]).T, flat(e).T
    return {
        "out": flat(mixed).T @ flat(g), "q": own @ flat(dq) * WIDTH ** -0.5, "k": every @ flat(dk), "v": every @ flat(dv),
        "near": np.bincount(_BACK[skipped:].ravel(), ds.sum(axis=0).ravel(), CONTEXT),
    }


def train(weights: dict, embedding: np.ndarray, skip: np.ndarray, symbols: np.ndarray, targets: np.ndarray, batch: int = AT_ONCE) -> dict:
    """One pass of Adam over windows; targets are classes, -1 where there is none."""
    weights = {n: w.copy() for n, w in weights.items()}
    first = {n: np.zeros_like(w) for n, w in weights.items()}
    second = {n: np.zeros_like(w) for n, w in weights.items()}
    whole = (targets[:, :OVERLAP] >= 0).any(axis=1)
    for step, lo in enumerate(range(0, len(symbols), batch), 1):
        x, y, early = symbols[lo:lo + batch], targets[lo:lo + batch], whole[lo:lo + batch]
        # Most windows have no target where an earlier one has scored: nothing is computed there.
        parts = [_gradient(weights, embedding, skip, x[own], y[own], skipped) for own, skipped in ((~early, OVERLAP), (early, 0)) if own.any()]
        share = 1 / max(1, int((y >= 0).sum()))
        for n in weights:
            d = sum(part[n] for part in parts) * share
            first[n] += 0.1 * (d - first[n])
            second[n] += 0.01 * (d * d - second[n])
            weights[n] -= (_RATE * (first[n] / (1 - 0.9 ** step)) / (np.sqrt(second[n] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return weights


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping windows over sequences laid one after another: where each begins, and how many of
    its first symbols an earlier window has scored."""
    step = CONTEXT - OVERLAP
    many = np.where(lengths > 0, 1 + -(-np.maximum(0, lengths - CONTEXT) // step), 0)
    begin = np.repeat(np.cumsum(lengths) - lengths, many)
    place = np.arange(len(begin)) - np.repeat(np.cumsum(many) - many, many)
    return begin + place * step, np.where(place > 0, OVERLAP, 0)
