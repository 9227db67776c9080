"""A gated recurrent language model in numpy with a class-factored softmax.

Words are numbered by falling frequency and cut into ``CLASSES`` classes, small ones of frequent
words first, so that few outputs are computed for a usual word:
``log p(w) = log p(class | state) + log p(w | class, state)``. Output biases start at the
logarithms of corpus frequencies, so an untrained model is the unigram model. Training is
truncated backpropagation: the state is carried from window to window, gradients are not.
"""

from __future__ import annotations

import numpy as np

EMBED, HIDDEN = 16, 16
#: Classes of one size: how many, and of how many words.
SIZES = ((16, 4), (16, 16), (32, 118))
CLASSES = sum(n for n, _ in SIZES)
START = np.append(0, np.cumsum(np.repeat([size for _, size in SIZES], [n for n, _ in SIZES])))
WORDS = int(START[-1])
CLASS_OF = np.repeat(np.arange(CLASSES), np.diff(START))
SHAPES = {"embed": (WORDS, EMBED), "wx": (EMBED, 3 * HIDDEN), "wh": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,),
          "wc": (HIDDEN, CLASSES), "bc": (CLASSES,), "ww": (WORDS, HIDDEN), "bw": (WORDS,)}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())
LEAST = 1e-20   # probability at which a word that does not occur starts
SAFE = 60.0     # logits up to here need no shift before they are exponentiated


def start(share: np.ndarray, seed: int = 0) -> np.ndarray:
    """Weights of an untrained model with the word probabilities ``share`` (``WORDS`` of them, 0 where unused)."""
    rng = np.random.default_rng(seed)
    w = {k: (rng.normal(0, 0.1, s) if k in ("embed", "wx", "wh") else np.zeros(s)) for k, s in SHAPES.items()}
    p = np.maximum(share, LEAST)
    by_class = np.add.reduceat(p, START[:-1])
    w["bc"] = np.log(by_class)
    w["bw"] = np.log(p) - w["bc"][CLASS_OF]
    return np.concatenate([w[k].ravel() for k in SHAPES]).astype(np.float32)


def parts(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = flat[at:at + n].reshape(s)
        at += n
    return out


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(-1, keepdims=True)
    return x - np.log(np.exp(x).sum(-1, keepdims=True))


def _softmax(x: np.ndarray, scale: float = 1.0) -> np.ndarray:
    """``scale`` times the softmax of the last axis, in place."""
    if x.size and (x.max() > SAFE or x.min() < -SAFE):
        x -= x.max(-1, keepdims=True)
    np.exp(x, out=x)
    x *= (np.float32(scale) / (x @ np.ones(x.shape[-1], x.dtype)))[..., None]
    return x


def _step(h: np.ndarray, g: np.ndarray, wh: np.ndarray) -> tuple[np.ndarray, ...]:
    m = h @ wh
    zr = g[:, :2 * HIDDEN] + m[:, :2 * HIDDEN]
    zr *= 0.5   # a logistic function is half a tanh of the half
    np.tanh(zr, out=zr)
    zr *= 0.5
    zr += 0.5
    z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
    n = r * m[:, 2 * HIDDEN:]
    n += g[:, 2 * HIDDEN:]
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return new, z, r, n, m[:, 2 * HIDDEN:]


def _picked(h: np.ndarray, weight: np.ndarray, bias: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """Log softmax of ``h @ weight + bias`` at one column per row, without the whole matrix of logarithms."""
    x = h @ weight
    x += bias
    own = x[np.arange(len(pick)), pick]
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    if not (np.isfinite(total).all() and (total > 1e-30).all()):  # beyond the numbers' range
        return _log_softmax(h @ weight + bias)[np.arange(len(pick)), pick]
    return own - np.log(total)


def word_log_probs(w: dict[str, np.ndarray], h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Natural log probability of each word given the state in its row."""
    order = np.argsort(word.astype(np.uint16), kind="stable")
    h, word = h[order], word[order]
    cls = CLASS_OF[word]
    edge = np.searchsorted(word, START)
    got = np.empty(len(word))
    for lo in range(0, len(word), 4096):
        got[lo:lo + 4096] = _picked(h[lo:lo + 4096], w["wc"], w["bc"], cls[lo:lo + 4096])
    for c in np.flatnonzero(np.diff(edge)).tolist():
        at, own = slice(edge[c], edge[c + 1]), slice(START[c], START[c + 1])
        got[at] += _picked(h[at], w["ww"][own].T, w["bw"][own], word[at] - START[c])
    out = np.empty(len(word))
    out[order] = got
    return out


def lanes_of(sizes: np.ndarray, lanes: int) -> tuple[list[list[int]], np.ndarray]:
    """Texts dealt to lanes, longest first to the shortest lane; lanes by falling length."""
    import heapq

    heap = [(0, i) for i in range(min(lanes, len(sizes)))]
    got: list[list[int]] = [[] for _ in heap]
    for t in np.argsort(-sizes, kind="stable").tolist():
        n, i = heapq.heappop(heap)
        got[i].append(t)
        heapq.heappush(heap, (n + int(sizes[t]), i))
    length = np.zeros(len(got), np.int64)
    for n, i in heap:
        length[i] = n
    order = np.argsort(-length, kind="stable")
    return [got[i] for i in order], length[order]


def log_likelihoods(flat: np.ndarray, words: np.ndarray, first: np.ndarray, begin: int, lanes: int = 256, window: int = 64) -> np.ndarray:
    """Natural log probability of every word of the texts ``words[first[i]:first[i + 1]]``, each from an empty state.

    Texts run side by side in lanes; a lane's state is carried from window to window and
    emptied where a text begins. ``begin`` is the word read before a text's first.
    """
    w = parts(flat)
    table = w["embed"] @ w["wx"] + w["b"]
    size = np.diff(first)
    out = np.zeros(len(words))
    if not len(words):
        return out
    dealt, length = lanes_of(size, lanes)
    place = [np.concatenate([np.arange(first[t], first[t + 1]) for t in some]) for some in dealt]
    before = np.empty(len(words), np.int64)
    before[1:] = words[:-1]
    fresh = np.zeros(len(words), bool)
    fresh[first[:-1][size > 0]] = True
    before[fresh] = begin
    grid = np.zeros((int(length[0]), len(place)), np.int64)
    for i, p in enumerate(place):
        grid[:len(p), i] = p
    h = np.zeros((len(place), HIDDEN), np.float32)
    for lo in range(0, len(grid), window):
        states, at = [], []
        for t in range(lo, min(lo + window, len(grid))):
            a = int(np.searchsorted(-length, -t, "left"))  # lanes longer than t
            p = grid[t, :a]
            h = h[:a]
            if fresh[p].any():
                h = np.where(fresh[p][:, None], np.float32(0), h)
            h = _step(h, table[before[p]], w["wh"])[0]
            states.append(h)
            at.append(p)
        at = np.concatenate(at)
        out[at] = word_log_probs(w, np.concatenate(states), words[at])
    return out


class Trainer:
    """Adam on windows of parallel text streams."""

    def __init__(self, flat: np.ndarray, rate: float = 2e-2):
        self.flat, self.rate, self.n = flat.copy(), rate, 0
        self.one, self.two, self.work, self.grad = (np.zeros_like(flat) for _ in range(4))

    def fit(self, words: np.ndarray, fresh: np.ndarray, begin: int, lanes: int = 512, window: int = 16) -> int:
        """One pass over a stream of texts (``fresh`` where one begins), cut into equal lanes, what is left into fewer; returns the words used."""
        lanes = max(1, min(lanes, len(words) // window))
        steps = len(words) // lanes
        if not steps:
            return 0
        before = np.append(begin, words[:-1])
        before[fresh] = begin
        cut = lambda x: x[:lanes * steps].reshape(lanes, steps).T
        word, prior, new = cut(words), cut(before), cut(fresh)
        h = np.zeros((lanes, HIDDEN), np.float32)
        for lo in range(0, steps, window):
            h = self._window(word[lo:lo + window], prior[lo:lo + window], new[lo:lo + window], h)
        rest = lanes * steps
        if rest < len(words):   # fewer words than lanes
            self.fit(words[rest:], fresh[rest:], int(before[rest]), lanes, window)
        return len(words)

    def _window(self, word, prior, new, h):
        w = parts(self.flat)
        grad = self.grad
        grad[:] = 0
        g = parts(grad)
        steps, lanes = word.shape
        x = w["embed"][prior]
        proj = x @ w["wx"] + w["b"]
        begun = new.any(1)
        h0, z, r, n, m, states = (np.empty((steps, lanes, HIDDEN), np.float32) for _ in range(6))
        for t in range(steps):
            h0[t] = np.where(new[t][:, None], np.float32(0), h) if begun[t] else h
            h, z[t], r[t], n[t], m[t] = _step(h0[t], proj[t], w["wh"])
            states[t] = h
        flat_h, flat_w = states.reshape(-1, HIDDEN), word.ravel()
        cls = CLASS_OF[flat_w]
        scale = np.float32(1 / len(flat_w))
        d = flat_h @ w["wc"]
        d += w["bc"]
        d = _softmax(d, scale)
        d[np.arange(len(flat_w)), cls] -= scale
        g["wc"] += flat_h.T @ d
        g["bc"] += np.ones(len(d), d.dtype) @ d
        dh_out = d @ w["wc"].T
        order = np.argsort(flat_w.astype(np.uint16), kind="stable")
        count = np.bincount(cls, minlength=CLASSES)
        edge = np.cumsum(count) - count
        first = 0
        for many, size in SIZES:
            own = slice(START[first], START[first + many])
            weights, biases = w["ww"][own].reshape(many, size, HIDDEN), w["bw"][own].reshape(many, size)
            g_weights, g_biases = g["ww"][own].reshape(many, size, HIDDEN), g["bw"][own].reshape(many, size)
            mine = count[first:first + many]
            width = np.frexp(mine)[1]   # classes of about as many words are worked on together
            for k in np.unique(width[mine > 0]).tolist():
                c = np.flatnonzero(width == k)
                j = np.arange(mine[c].max())
                real = j < mine[c][:, None]
                at = order[edge[first + c][:, None] + np.minimum(j, mine[c][:, None] - 1)]
                state, weight = flat_h[at], weights[c]
                e = state @ weight.transpose(0, 2, 1)
                e += biases[c][:, None]
                e = _softmax(e, scale)
                e[np.arange(len(c))[:, None], j, flat_w[at] - START[first + c][:, None]] -= scale
                if not real.all():
                    e[~real] = 0
                g_weights[c] = e.transpose(0, 2, 1) @ state
                g_biases[c] = e.sum(1)
                dh_out[at[real]] += (e @ weight)[real]
            first += many
        dh_out = dh_out.reshape(steps, lanes, HIDDEN)
        # what a state's gradient is multiplied by for z, r and the candidate's recurrent part
        dn = (1 - z) * (1 - n * n)
        factor = np.stack([(h0 - n) * z * (1 - z), dn * m * r * (1 - r), dn * r], 2)
        dm = np.empty_like(factor)
        back = np.ascontiguousarray(w["wh"].T)
        dh = np.zeros((lanes, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            dh += dh_out[t]
            dn[t] *= dh
            np.multiply(factor[t], dh[:, None], out=dm[t])
            dh *= z[t]
            dh += dm[t].reshape(lanes, -1) @ back
            if begun[t]:
                dh[new[t]] = 0
        g["wh"] += h0.reshape(-1, HIDDEN).T @ dm.reshape(-1, 3 * HIDDEN)
        dm[:, :, 2] = dn
        flat_d = dm.reshape(-1, 3 * HIDDEN)
        g["wx"] += x.reshape(-1, EMBED).T @ flat_d
        g["b"] += flat_d.sum(0)
        into, dx = prior.ravel(), (flat_d @ w["wx"].T).T
        for k in range(EMBED):
            g["embed"][:, k] = np.bincount(into, dx[k], WORDS)
        norm = float(np.sqrt(grad @ grad))
        if norm > 1:
            grad /= norm
        self._step(grad)
        return h

    def _step(self, grad):
        """One update, in place."""
        self.n += 1
        work = self.work
        self.one *= np.float32(0.9)
        np.multiply(grad, np.float32(0.1), out=work)
        self.one += work
        self.two *= np.float32(0.99)
        np.multiply(grad, grad, out=work)
        work *= np.float32(0.01)
        self.two += work
        np.multiply(self.two, np.float32(1 / (1 - 0.99 ** self.n)), out=work)
        np.sqrt(work, out=work)
        work += np.float32(1e-8)
        np.divide(self.one, work, out=work)
        work *= np.float32(self.rate / (1 - 0.9 ** self.n))
        self.flat -= work
