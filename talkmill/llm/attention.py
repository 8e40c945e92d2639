"""A small causal self-attention model over token classes, in numpy.

The model gives the distribution of the next token's output class from the
input classes so far: one attention layer with a learned bias per distance,
a hidden layer, and a softmax, whose logits are added to a given prior (the
log-probability of the output class after the last input class alone).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Tokens of a training window; in scoring each half window is scored once
#: with the half before it as context.
WINDOW = 32
HALF = WINDOW // 2
WIDTH = 16
HIDDEN = 32
BLOCKS_AT_ONCE = 256
#: Scores and logits are held to this size before exp.
LIMIT = 60

Parameters = dict[str, np.ndarray]


def initial(inputs: int, outputs: int, seed: int = 3) -> Parameters:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.normal(0, 1 / np.sqrt(shape[0]), shape)).astype(np.float32)
    return {"embed": rng.normal(0, 0.5, (inputs, WIDTH)).astype(np.float32),
            "q": draw(WIDTH, WIDTH), "k": draw(WIDTH, WIDTH), "v": draw(WIDTH, WIDTH),
            "far": (-0.1 * np.arange(WINDOW)).astype(np.float32),
            "own": draw(WIDTH, HIDDEN), "seen": draw(WIDTH, HIDDEN), "hidden": np.zeros(HIDDEN, np.float32),
            "out": draw(HIDDEN, outputs) * np.float32(0.3), "bias": np.zeros(outputs, np.float32)}


def flat(p: Parameters) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float64)


def shaped(values: np.ndarray, like: Parameters) -> Parameters:
    out, at = {}, 0
    for k in sorted(like):
        n = like[k].size
        out[k] = values[at:at + n].reshape(like[k].shape).astype(np.float32)
        at += n
    return out


_LAG = np.arange(WINDOW)[:, None] - np.arange(WINDOW)[None, :]
_PAST = _LAG >= 0
_LAG = np.maximum(_LAG, 0)
#: Rows of a product that are multiplied at once.
PART = 256


#: Added to the scores of places that may not be seen; its exp is 0.
NEVER = -1e30


def _exp(scores: np.ndarray) -> np.ndarray:
    """exp in place of scores held to +-LIMIT: no row overflows or sums to
    nothing, so no row maximum is needed."""
    np.clip(scores, -LIMIT, LIMIT, out=scores)
    return np.exp(scores, out=scores)


def _exp_sums(o: np.ndarray, logits: Callable[[], None]) -> np.ndarray:
    """exp in place of the logits that ``logits`` writes to ``o``, and their
    sums by row; they are held to +-LIMIT only where a sum says that it matters."""
    ones = np.ones(o.shape[1], o.dtype)
    logits()
    with np.errstate(over="ignore", invalid="ignore"):
        total = np.exp(o, out=o) @ ones
    if not (np.exp(-LIMIT) < total.min() and total.max() < np.exp(LIMIT)):
        logits()
        total = _exp(o) @ ones
    return total


def _attend(q: np.ndarray, turned: np.ndarray, v: np.ndarray, far: np.ndarray, seen: np.ndarray,
            a: np.ndarray, z: np.ndarray, edges: Callable[[], None] = lambda: None) -> None:
    """Write the undivided weights of windows to ``a`` and their sums of ``v``
    to ``z``, whose last column holds the sums of the weights. ``far``: by
    place and place seen, ``seen``: which may be; ``edges`` takes more out of
    ``a``. Scores are held to +-LIMIT only where a sum says that it matters."""
    np.matmul(q, turned, out=a)
    a += np.where(seen, far, far.dtype.type(NEVER))
    with np.errstate(over="ignore", invalid="ignore"):
        np.exp(a, out=a)
        edges()
        np.matmul(a, v, out=z)
    total = z[..., -1]
    if not (np.exp(-LIMIT) < total.min() and total.max() < np.exp(LIMIT)):
        np.matmul(q, turned, out=a)
        a += far
        _exp(a)
        a *= seen.astype(a.dtype)
        edges()
        np.matmul(a, v, out=z)


def _parts(t: np.ndarray) -> np.ndarray:
    """A view of ``t`` in blocks of PART rows, whose products are faster than
    one of all rows."""
    return t.reshape(-1, PART, t.shape[1]) if len(t) % PART == 0 else t[None]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b"""
    return np.matmul(_parts(a).transpose(0, 2, 1), _parts(b)).sum(axis=0)


def _wide(column: np.ndarray, out: np.ndarray) -> np.ndarray:
    """``column`` in every column of ``out``; rows multiplied with it as they
    lie cost less than with a column."""
    np.copyto(out, column[:, None])
    return out


def _turned(t: np.ndarray, out: np.ndarray) -> np.ndarray:
    """``t`` (or each matrix of it) transposed, in the array ``out``."""
    np.copyto(out, t.swapaxes(-1, -2))
    return out


class Space:
    """Arrays that every step uses again, so that steps don't wait for the
    system to hand out and take back the same pages."""

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def get(self, name: str, shape: tuple[int, ...], kind: np.dtype) -> np.ndarray:
        old = self.held.get(name)
        if old is None or old.shape != shape or old.dtype != kind:
            old = self.held[name] = np.empty(shape, kind)
        return old


def _and_one(v: np.ndarray) -> np.ndarray:
    """Rows with a 1 at the end: a product with them also gives the sum of weights."""
    return np.concatenate([v, np.ones((len(v), 1), v.dtype)], axis=1)


def gradients(p: Parameters, prior: np.ndarray, x: np.ndarray, y: np.ndarray,
              real: np.ndarray | None = None, space: Space | None = None) -> tuple[float, Parameters]:
    """Mean cross-entropy (nats) of windows x -> y, both (n, WINDOW), and its
    gradients. ``real``: the tokens at the start of each window that count
    (None: all); what pads a window behind them has no effect.

    Matrices with the same rows are multiplied together, and transposed ones
    are laid out anew before a product, which costs less than the product as
    they are."""
    kind, shape, inputs = p["embed"].dtype, x.shape, len(p["embed"])
    n = x.size if real is None else int(real.sum())
    padded = None if n == x.size else np.flatnonzero(np.arange(shape[1])[None, :] >= real[:, None])
    classes, goal = x.ravel().astype(np.intp, copy=False), y.ravel()
    space = space or Space()
    buffer = lambda name, *size: space.get(name, size, kind)
    tokens, outputs, length = len(classes), len(p["bias"]), shape[1]
    windowed = lambda t: t.reshape(*shape, -1)
    scale = kind.type(1 / np.sqrt(WIDTH))
    w_qkv = np.concatenate([p["q"] * scale, p["k"], p["v"]], axis=1)
    minus = np.append(np.full(WIDTH, -1, kind), kind.type(0))
    w_seen = np.concatenate([p["seen"], p["hidden"][None]])
    turned = lambda name, t: _turned(t, buffer(name, *t.shape[:-2], t.shape[-1], t.shape[-2]))

    e = np.take(p["embed"], classes, axis=0, out=buffer("e", tokens, WIDTH), mode="clip")
    qkv = buffer("qkv", tokens, 3 * WIDTH + 1)
    np.matmul(_parts(e), w_qkv, out=_parts(qkv)[:, :, :-1])
    qkv[:, -1] = 1
    of_q, of_k, of_v = slice(WIDTH), slice(WIDTH, 2 * WIDTH), slice(2 * WIDTH, None)
    q, k, v = (windowed(qkv)[:, :, part] for part in (of_q, of_k, of_v))
    a, z = buffer("a", len(x), length, length), buffer("z", *shape, WIDTH + 1)
    _attend(q, turned("k", k), v, p["far"][_LAG], _PAST, a, z)
    z = z.reshape(-1, WIDTH + 1)
    over_a = _wide(1 / z[:, WIDTH], buffer("over_a", *z.shape))  # a itself stays undivided
    z *= over_a  # and ends with a 1
    h, own = buffer("h", tokens, HIDDEN), buffer("own", tokens, HIDDEN)
    np.matmul(_parts(z), w_seen, out=_parts(h))
    np.matmul(_parts(e), p["own"], out=_parts(own))
    h += own
    np.maximum(h, 0, out=h)
    o, start = buffer("o", tokens, outputs), np.add(prior, p["bias"], out=buffer("start", *prior.shape))

    def logits() -> None:
        np.matmul(_parts(h), p["out"], out=_parts(o))
        np.add(o, np.take(start, classes, axis=0, out=buffer("prior", tokens, outputs), mode="clip"), out=o)

    total = _exp_sums(o, logits)
    at = np.arange(len(o)) * o.shape[1] + goal
    logs = np.log(o.take(at)) - np.log(total)
    share = 1 / (total * kind.type(n))
    if padded is not None:
        share[padded], logs[padded] = 0, 0
    loss = float(-logs.sum() / n)

    o *= _wide(share, buffer("prior", tokens, outputs))
    counted = np.full(len(o), 1 / n, kind)
    if padded is not None:
        counted[padded] = 0
    o.ravel()[at] -= counted  # the gradient of the logits
    g = {"out": _product(h, o), "bias": np.ones(len(o), kind) @ o}
    d_pre = buffer("d_pre", tokens, HIDDEN)
    np.matmul(_parts(o), turned("w_out", p["out"]), out=_parts(d_pre))
    np.multiply(d_pre, h > 0, out=d_pre)
    g["own"], g_seen = _product(e, d_pre), _product(z, d_pre)
    g["seen"], g["hidden"] = g_seen[:-1], g_seen[-1]
    d_z = buffer("d_z", tokens, WIDTH + 1)
    np.matmul(_parts(d_pre), turned("w_seen", w_seen), out=_parts(d_z))
    d_z *= over_a
    z *= d_z
    d_z[:, WIDTH] = z @ minus  # meets the ones behind v
    d_z = windowed(d_z)
    d_s = np.matmul(d_z, turned("v", v), out=buffer("d_s", len(x), length, length))
    d_s *= a
    g["far"] = np.bincount(_LAG.ravel(), np.ones(len(x), kind) @ d_s.reshape(len(x), -1), minlength=WINDOW).astype(kind)
    d_qkv = buffer("d_qkv", tokens, 3 * WIDTH)
    np.matmul(d_s, k, out=windowed(d_qkv)[:, :, of_q])
    np.matmul(d_s.transpose(0, 2, 1), q, out=windowed(d_qkv)[:, :, of_k])
    np.matmul(a.transpose(0, 2, 1), d_z[:, :, :WIDTH], out=windowed(d_qkv)[:, :, of_v])
    g_qkv = _product(e, d_qkv)
    g["q"], g["k"], g["v"] = g_qkv[:, of_q] * scale, g_qkv[:, of_k], g_qkv[:, of_v]
    d_e = buffer("d_e", tokens, WIDTH)
    np.matmul(_parts(d_qkv), turned("w_qkv", w_qkv), out=_parts(d_e))
    np.matmul(_parts(d_pre), turned("w_own", p["own"]), out=_parts(e))
    d_e += e
    cells = np.add(classes[:, None] * WIDTH, np.arange(WIDTH), out=space.get("cells", (tokens, WIDTH), np.dtype(int)))
    g["embed"] = np.zeros((inputs, WIDTH), kind)
    np.add.at(g["embed"].reshape(-1), cells.reshape(-1), d_e.reshape(-1))
    return loss, g


class Adam:
    """Adam over all parameters as one vector; ``p`` holds views of it."""

    def __init__(self, p: Parameters, prior: np.ndarray, rate: float) -> None:
        self.prior, self.rate, self.t, self.names = prior, rate, 0, sorted(p)
        self.all = np.concatenate([p[k].ravel() for k in self.names])
        at = np.cumsum([p[k].size for k in self.names])[:-1]
        self.p = {k: v.reshape(p[k].shape) for k, v in zip(self.names, np.split(self.all, at))}
        self.m, self.s, self.space = np.zeros_like(self.all), np.zeros_like(self.all), Space()

    def step(self, x: np.ndarray, y: np.ndarray, real: np.ndarray | None = None) -> float:
        loss, g = gradients(self.p, self.prior, x, y, real, self.space)
        d, w = (self.space.get(name, self.all.shape, self.all.dtype) for name in ("gradient", "work"))
        np.concatenate([g[k].ravel() for k in self.names], out=d)
        self.t += 1
        for mean, part in ((self.m, 0.1), (self.s, 0.01)):
            np.subtract(d, mean, out=w)
            w *= part
            mean += w
            d *= d
        np.divide(self.s, 1 - 0.99 ** self.t, out=w)
        np.sqrt(w, out=w)
        w += 1e-8
        np.divide(self.m, w, out=w)
        w *= self.rate / (1 - 0.9 ** self.t)
        self.all -= w
        return loss


class Scorer:
    """Batched masked attention over whole texts: the tokens of half a
    window are scored at once with the half window before it as context, so
    windows overlap and every token is scored once."""

    def __init__(self, p: Parameters, prior: np.ndarray) -> None:
        self.prior = prior + p["bias"]
        e = p["embed"]
        self.q, self.k = e @ p["q"] * np.float32(1 / np.sqrt(WIDTH)), e @ p["k"]
        self.v = _and_one(e @ p["v"])
        self.own, self.p = e @ p["own"] + p["hidden"], p
        lag = HALF + np.arange(HALF)[:, None] - np.arange(WINDOW)[None, :]
        self.far = p["far"][np.maximum(lag, 0)]
        self.seen = lag >= 0
        self.space = Space()

    def log_probabilities(self, x: np.ndarray, y: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Natural log-probability of each output class in ``y`` after the
        input classes up to and with the same place in ``x``; both hold the
        texts one after another, ``counts`` tokens each (at least one)."""
        blocks = -(-counts // HALF)
        first = np.cumsum(blocks) - blocks
        place = np.arange(len(x)) + np.repeat(first * HALF - (np.cumsum(counts) - counts), counts)
        grid = np.zeros(int(blocks.sum()) * HALF, x.dtype)
        goal = np.zeros(len(grid), y.dtype)
        grid[place], goal[place] = x, y
        grid, goal = grid.reshape(-1, HALF), goal.reshape(-1, HALF)
        starts = np.zeros(len(grid), bool)
        starts[first] = True
        out = np.empty(grid.shape, np.float32)
        for at in range(0, len(grid), BLOCKS_AT_ONCE):
            part = slice(at, at + BLOCKS_AT_ONCE)
            own = grid[part]
            classes, n = own.ravel(), len(own)
            around = np.concatenate([grid[at - 1] if at else own[0] * 0, classes])  # with the half window before
            buffer = lambda name, *size: self.space.get(name, size, out.dtype)
            k, v = (_windows(np.take(t, around, axis=0, out=buffer(name, len(around), t.shape[1]), mode="clip"), n)
                    for name, t in (("k", self.k), ("v", self.v)))
            q = np.take(self.q, own, axis=0, out=buffer("q", n, HALF, WIDTH), mode="clip")
            s, z = buffer("s", n, HALF, WINDOW), buffer("z", n, HALF, WIDTH + 1)
            begin = np.flatnonzero(starts[part])

            def edges() -> None:
                s[begin, :, :HALF] = 0  # a text's first block sees nothing before it

            _attend(q, _turned(k, buffer("turned", n, WIDTH, WINDOW)), v, self.far, self.seen, s, z, edges)
            z = z.reshape(-1, WIDTH + 1)
            z *= _wide(1 / z[:, WIDTH], buffer("over", *z.shape))
            h = buffer("h", n * HALF, HIDDEN)
            np.matmul(_parts(z)[:, :, :WIDTH], self.p["seen"], out=_parts(h))
            h += np.take(self.own, classes, axis=0, out=buffer("own", n * HALF, HIDDEN), mode="clip")
            np.maximum(h, 0, out=h)
            o = buffer("o", n * HALF, self.prior.shape[1])

            def logits() -> None:
                np.matmul(_parts(h), self.p["out"], out=_parts(o))
                np.add(o, np.take(self.prior, classes, axis=0, out=buffer("prior", *o.shape), mode="clip"), out=o)

            total = _exp_sums(o, logits)
            hit = o.take(np.arange(len(o)) * o.shape[1] + goal[part].ravel())
            out[part] = (np.log(hit) - np.log(total)).reshape(own.shape)
        return out.ravel()[place]


def _windows(t: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` windows of the rows of ``t``, each half a window after the
    one before, as a view."""
    row, column = t.strides
    return np.lib.stride_tricks.as_strided(t, (n, WINDOW, t.shape[1]), (HALF * row, row, column), writeable=False)
