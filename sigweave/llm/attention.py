"""A small causal self-attention model in numpy: forward, training, windowed scoring.

One block: embeddings, one head of attention with a learned weight per distance, a feed-forward
layer, residual connections. The vocabulary is the most frequent ids of a public tokenizer, sorted by
frequency and cut into classes of 64; an id's probability is that of its class times that of
the id in its class, so a prediction costs some hundred terms. Ids outside the vocabulary share one entry.
"""

from __future__ import annotations

import numpy as np

CLASS = 64
CLASSES = 32
VOCABULARY = CLASS * CLASSES
WIDTH = 16
HIDDEN = 32
#: Tokens a window holds, and how many of them are context only (but for a text's first window).
SPAN = 32
OVERLAP = 8
_STEP = SPAN - OVERLAP
_MOST = np.float32(40)
#: Logits this near to 0 need no shift before their exponentials.
_SAFE = 60
_LN10 = np.log(10.0)

SHAPES = {
    "embed": (VOCABULARY, WIDTH),
    "qkv": (WIDTH, 3 * WIDTH),
    "near": (SPAN,),
    "out": (WIDTH, WIDTH),
    "up": (WIDTH, HIDDEN),
    "up_b": (HIDDEN,),
    "down": (HIDDEN, WIDTH),
    "cls": (WIDTH, CLASSES),
    "cls_b": (CLASSES,),
    "in": (CLASSES, WIDTH, CLASS),
    "in_b": (CLASSES, CLASS),
}


def initial(counts: np.ndarray, seed: int = 0) -> dict[str, np.ndarray]:
    """Parameters that predict ids by their frequency `counts` (in vocabulary order), whatever comes before."""
    rng = np.random.default_rng(seed)
    p = {k: (rng.standard_normal(s) * 0.2).astype(np.float32) for k, s in SHAPES.items()}
    p["near"] = -0.3 * np.arange(SPAN, dtype=np.float32)
    p["up_b"] = np.zeros(HIDDEN, np.float32)
    for k in ("in", "cls", "down", "out"):
        p[k] *= np.float32(0.1)
    table = (counts.astype(np.float64) + 0.5).reshape(CLASSES, CLASS)
    p["cls_b"] = np.log(table.sum(1) / table.sum()).astype(np.float32)
    p["in_b"] = np.log(table / table.sum(1, keepdims=True)).astype(np.float32)
    return p


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in SHAPES])


def shaped(v: np.ndarray) -> dict[str, np.ndarray]:
    """Views of a flat vector, by name."""
    out, at = {}, 0
    for k, s in SHAPES.items():
        n = int(np.prod(s))
        out[k] = v[at : at + n].reshape(s)
        at += n
    return out


#: Distance of each pair of places of a window, 0 for what lies ahead.
_GAP = np.maximum(np.arange(SPAN)[:, None] - np.arange(SPAN)[None, :], 0)


def _mask(near: np.ndarray) -> np.ndarray:
    """Factor of each pair of places: the weight of their distance, 0 for what lies ahead."""
    return np.tril(np.exp(near)[_GAP]).astype(np.float32)


def _scaled(qkv: np.ndarray) -> np.ndarray:
    """The projection with the queries' part divided by the root of their width."""
    out = qkv.copy()
    out[:, :WIDTH] *= np.float32(WIDTH**-0.5)
    return out


def _parts(live: np.ndarray) -> list[tuple]:
    """(windows, places) of the queries: where no place of the overlap is live, it is context only and asks nothing."""
    first = np.flatnonzero(live[:, :OVERLAP].any(1))
    parts = [(slice(None), slice(OVERLAP, SPAN))]
    return parts if not len(first) else [*parts, (first, slice(0, OVERLAP))]


def _weights(qkv: np.ndarray, some, places: slice, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights before division, averaged values) of the queries at some windows' places, over all keys up to them."""
    mine = qkv[some]
    stop = places.stop
    s = np.matmul(mine[:, places, :WIDTH], mine[:, :stop, WIDTH : 2 * WIDTH].transpose(0, 2, 1))
    np.minimum(s, _MOST, out=s)
    np.exp(s, out=s)
    s *= mask[places, :stop]
    return s, np.matmul(s, mine[:, :stop, 2 * WIDTH :])


def _forward(p: dict[str, np.ndarray], ids: np.ndarray, live: np.ndarray | None = None) -> tuple:
    """Everything the backward pass needs, for the live places of windows of ids (n, SPAN); all, if not given."""
    live = np.ones(ids.shape, bool) if live is None else live
    rows = np.flatnonzero(live)
    x = p["embed"][ids.ravel()]
    qkv = (x @ _scaled(p["qkv"])).reshape(*ids.shape, 3 * WIDTH)
    mask = _mask(p["near"])
    # Weights are left without their divisor until they have summed the values.
    a, total, seen = np.zeros((*ids.shape, WIDTH), x.dtype), np.ones(ids.shape, x.dtype), []
    for some, places in _parts(live):
        s, summed = _weights(qkv, some, places, mask)
        div = s @ np.ones(s.shape[2], s.dtype)
        a[some, places] = summed / div[..., None]
        total[some, places] = div
        seen.append((some, places, s))
    a_of = a.reshape(-1, WIDTH)[rows]
    h = x[rows] + a_of @ p["out"]
    u = h @ p["up"]
    u += p["up_b"]
    np.maximum(u, 0, out=u)
    return rows, x, qkv, seen, a, total, a_of, h, u, h + u @ p["down"]


def _exponentials(e: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overwrites `e` by exponentials; (the values before at flat places `at`, sums of rows). Large values are shifted by their row's most."""
    if max(e.max(), -e.min()) > _SAFE:
        e -= e.max(1, keepdims=True)
    own = e.ravel()[at]
    np.exp(e, out=e)
    return own, e @ np.ones(e.shape[1], e.dtype)


def _losses(p: dict[str, np.ndarray], o: np.ndarray, targets: np.ndarray, grads: dict | None = None):
    """Natural log probability of each target; with `grads`, also the gradient of the mean loss in `o`."""
    n = len(targets)
    order = np.argsort((targets // CLASS).astype(np.uint8), kind="stable")
    cls, within = np.divmod(targets[order], CLASS)
    ends = np.cumsum(np.bincount(cls, minlength=CLASSES)).tolist()
    slices = [(c, slice(a, b)) for c, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]
    # A column of ones carries the biases and their gradients.
    o = np.concatenate((o[order], np.ones((n, 1), o.dtype)), 1)
    of = np.concatenate((p["cls"], p["cls_b"][None]))
    e = o @ of
    at = np.arange(0, n * CLASSES, CLASSES) + cls
    own, total = _exponentials(e, at)
    inner = np.concatenate((p["in"], p["in_b"][:, None]), 1)
    f = np.empty((n, CLASS), o.dtype)
    for c, rows in slices:
        np.matmul(o[rows], inner[c], out=f[rows])
    place = np.arange(0, n * CLASS, CLASS) + within
    own_f, total_f = _exponentials(f, place)
    out = np.empty(n, o.dtype)
    out[order] = own - np.log(total) + own_f - np.log(total_f)
    if grads is None:
        return out
    e *= (1 / (n * total))[:, None]
    e.ravel()[at] -= 1 / n
    f *= (1 / (n * total_f))[:, None]
    f.ravel()[place] -= 1 / n
    part = e @ p["cls"].T
    both = o.T @ e
    grads["cls"], grads["cls_b"] = both[:-1], both[-1]
    both = np.zeros_like(inner)
    back = np.empty_like(part)
    for c, rows in slices:
        np.matmul(f[rows], p["in"][c].T, out=back[rows])
        np.matmul(o[rows].T, f[rows], out=both[c])
    grads["in"], grads["in_b"] = both[:, :-1], both[:, -1]
    do = np.empty_like(part)
    do[order] = part + back
    return out, do


def gradients(p: dict[str, np.ndarray], ids: np.ndarray, targets: np.ndarray, live: np.ndarray):
    """(mean loss, gradients) over the live places of windows; all arrays are (n, SPAN)."""
    rows, x, qkv, seen, a, total, a_of, h, u, o = _forward(p, ids, live)
    g: dict[str, np.ndarray] = {}
    found, do = _losses(p, o, targets.ravel()[rows], g)
    g["down"] = u.T @ do
    du = do @ p["down"].T
    du *= u > 0
    g["up"], g["up_b"] = h.T @ du, du.sum(0)
    dh = do + du @ p["up"].T
    g["out"] = a_of.T @ dh
    da = np.zeros_like(x)
    da[rows] = (dh @ p["out"].T) / total.ravel()[rows, None]
    da = da.reshape(a.shape)
    dqkv = np.zeros_like(qkv)
    near = np.zeros((SPAN, SPAN))
    for some, places, s in seen:
        stop = places.stop
        mine, d = qkv[some], da[some, places]
        ds = np.matmul(d, mine[:, :stop, 2 * WIDTH :].transpose(0, 2, 1))
        ds -= np.einsum("nij,nij->ni", d, a[some, places])[..., None]
        ds *= s
        near[places, :stop] += (np.ones(len(ds), ds.dtype) @ ds.reshape(len(ds), -1)).reshape(ds.shape[1:])
        dqkv[some, places, :WIDTH] += np.matmul(ds, mine[:, :stop, WIDTH : 2 * WIDTH])
        dqkv[some, :stop, WIDTH : 2 * WIDTH] += np.matmul(ds.transpose(0, 2, 1), mine[:, places, :WIDTH])
        dqkv[some, :stop, 2 * WIDTH :] += np.matmul(s.transpose(0, 2, 1), d)
    g["near"] = np.bincount(_GAP.ravel(), near.ravel(), SPAN).astype(np.float32)
    dqkv = dqkv.reshape(-1, 3 * WIDTH)
    g["qkv"] = _scaled(x.T @ dqkv)
    dx = dqkv @ _scaled(p["qkv"]).T
    dx[rows] += dh
    spots = ids.reshape(-1, 1).astype(np.int64) * WIDTH + np.arange(WIDTH)
    g["embed"] = np.bincount(spots.ravel(), dx.ravel(), VOCABULARY * WIDTH).reshape(VOCABULARY, WIDTH).astype(np.float32)
    return -float(found.mean()), g


def cut(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over texts of so many tokens that lie one after another.

    (where each begins, its text, the first place that it scores). Every token is scored by one window.
    """
    n = np.where(lengths <= SPAN, 1, 1 + -(-(lengths - SPAN) // _STEP))
    text = np.repeat(np.arange(len(lengths)), n)
    turn = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = (np.cumsum(lengths) - lengths)[text] + turn * _STEP
    return begin, text, np.where(turn > 0, OVERLAP, 0)


def windows(ids: np.ndarray, lengths: np.ndarray, end: int):
    """(inputs, targets, live, text) from the targets of texts in a row; each text's input starts with `end`."""
    begin, text, skip = cut(lengths)
    stop = np.cumsum(lengths)[text]
    place = begin[:, None] + np.arange(SPAN)
    live = (place < stop[:, None]) & (np.arange(SPAN) >= skip[:, None])
    place = np.minimum(place, stop[:, None] - 1)
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[np.cumsum(lengths) - lengths] = end
    return before[place], ids[place], live, text


def _encode(p: dict[str, np.ndarray], ids: np.ndarray, live: np.ndarray, qkv: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The last value of `_forward` without what only the backward pass needs; `qkv` scaled, `mask` made once."""
    rows = np.flatnonzero(live)
    x = p["embed"][ids.ravel()]
    # A column of ones after the values makes the weights' divisor.
    w = np.ones((*ids.shape, 3 * WIDTH + 1), np.float32)
    np.matmul(x, qkv, out=w.reshape(-1, 3 * WIDTH + 1)[:, :-1])
    a = np.empty((*ids.shape, WIDTH + 1), np.float32)
    for some, places in _parts(live):
        a[some, places] = _weights(w, some, places, mask)[1]
    a = np.take(a.reshape(-1, WIDTH + 1), rows, axis=0)
    x = np.take(x, rows, axis=0)
    x += (a[:, :WIDTH] / a[:, WIDTH:]) @ p["out"]
    u = x @ p["up"]
    u += p["up_b"]
    np.maximum(u, 0, out=u)
    x += u @ p["down"]
    return x


def _log_sum(e: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials of each row, overwriting `e`."""
    np.exp(e, out=e)
    return np.log(e @ np.ones(e.shape[1], np.float32))


def score(p: dict[str, np.ndarray], ids: np.ndarray, lengths: np.ndarray, end: int, batch: int = 128, group: int = 64) -> np.ndarray:
    """log10 probability of each text. Attention runs over `batch` windows, the rest over `group` batches."""
    out = np.zeros(len(lengths))
    inputs, targets, live, text = windows(ids, lengths, end)
    mask, qkv = _mask(p["near"]), _scaled(p["qkv"])
    for i in range(0, len(text), batch * group):
        some = slice(i, i + batch * group)
        keep = live[some]
        target = targets[some][keep]
        of = np.repeat(text[some], keep.sum(1))
        cls = (target // CLASS).astype(np.uint8)
        last = np.empty((len(target), WIDTH), np.float32)
        found = np.empty(len(target), np.float32)
        at = 0
        for j in range(i, min(i + batch * group, len(text)), batch):
            o = _encode(p, inputs[j : j + batch], live[j : j + batch], qkv, mask)
            to = at + len(o)
            last[at:to] = o
            e = o @ p["cls"]
            e += p["cls_b"]
            np.minimum(e, _MOST, out=e)
            own = e.ravel()[np.arange(0, e.size, CLASSES) + cls[at:to]]
            found[at:to] = own - _log_sum(e)
            at = to
        order = np.argsort(cls, kind="stable")
        last, within = np.take(last, order, axis=0), (target % CLASS)[order]
        sorted_found = np.empty(len(order), np.float32)
        ends = np.cumsum(np.bincount(cls, minlength=CLASSES))
        for c in range(CLASSES):
            a, b = ends[c - 1] if c else 0, ends[c]
            for k in range(a, b, 4096):
                rows = slice(k, min(k + 4096, b))
                e = last[rows] @ p["in"][c]
                e += p["in_b"][c]
                np.minimum(e, _MOST, out=e)
                own = e.ravel()[np.arange(0, e.size, CLASS) + within[rows]]
                sorted_found[rows] = own - _log_sum(e)
        found[order] += sorted_found
        out += np.bincount(of, found, len(lengths))
    return out / _LN10


def train(
    p: dict[str, np.ndarray],
    ids: np.ndarray,
    lengths: np.ndarray,
    end: int,
    rate: float,
    steps: int,
    batch: int = 128,
    turn: int = 0,
    turns: int = 1,
) -> dict[str, np.ndarray]:
    """Adam over the texts' windows in random order; the rate falls to a tenth.

    Of `turns` calls, each begins with a part of the windows that no other begins with. It takes `steps` steps
    or, if they are more, as many as its part needs; steps left over go over all windows again.
    """
    inputs, targets, live, text = windows(ids, lengths, end)
    order = np.random.default_rng(0).permutation(len(text))[turn::turns]
    steps = max(steps, -(-len(order) // batch))
    rng = np.random.default_rng(turn)
    w = flat(p).astype(np.float32)
    now = shaped(w)
    m, v, step = np.zeros_like(w), np.zeros_like(w), np.empty_like(w)
    for t in range(steps):
        while len(order) < batch:
            order = np.append(order, rng.permutation(len(text)))
        rows, order = order[:batch], order[batch:]
        _, g = gradients(now, inputs[rows], targets[rows], live[rows])
        g = flat(g)
        m += np.multiply(np.subtract(g, m, out=step), 0.1, out=step)
        g *= g
        v += np.multiply(np.subtract(g, v, out=step), 0.02, out=step)
        np.sqrt(np.multiply(v, 1 / (1 - 0.98 ** (t + 1)), out=step), out=step)
        step += 1e-8
        w -= np.multiply(np.divide(m, step, out=step), rate * (1 - 0.9 * t / steps) / (1 - 0.9 ** (t + 1)), out=step)
    return now
