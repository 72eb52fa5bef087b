"""A gated recurrent network over word classes, in numpy.

Inputs are places in a vocabulary: `n_words` frequent words, then levels (rarer words by
how often they occur), then the start of a text. The output is factored: a softmax over
classes, and for the frequent words one within their class of CLASS_WORDS words. Rarer
words have a share of their level that does not depend on the state.

In training sequences are laid end to end in lanes of about equal length, which advance side
by side; the state starts anew where a sequence begins. So no step is spent on padding, and
a step of numpy serves as many tokens as there are lanes. States and outputs hold a token per
column, so that numpy works along long rows.
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN, CLASS_WORDS = 16, 32
LANES = 256
CHUNK = 32768  # predictions at a time
ROWS = 1024  # texts scored side by side
SEGMENT = 8192  # tokens over which the state is carried in training
Params = dict[str, np.ndarray]


def start(word_counts: np.ndarray, level_counts: np.ndarray, seed: int = 7) -> Params:
    """Weights that reproduce the frequencies, whatever the state.

    word_counts: of the frequent words, most frequent first; level_counts: by level.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    n = len(word_counts)
    classes = -(-n // CLASS_WORDS)
    padded = np.zeros(classes * CLASS_WORDS)
    padded[:n] = word_counts
    within = padded.reshape(classes, CLASS_WORDS)
    size = np.concatenate((within.sum(1), level_counts)) + 1e-3
    return {
        "input": rng.normal(0, 0.3, (n + len(level_counts) + 1, 3 * HIDDEN)).astype(np.float32),
        "state": rng.normal(0, 0.2, (HIDDEN, 3 * HIDDEN)).astype(np.float32),
        "classes": np.zeros((HIDDEN, len(size)), np.float32),
        "class_bias": np.log(size / size.sum()).astype(np.float32),
        "words": np.zeros((classes, HIDDEN, CLASS_WORDS), np.float32),
        "word_bias": np.where(within > 0, np.log(np.maximum(within, 1e-9)), -1e4).astype(np.float32),
    }


def classes_of(ids: np.ndarray, n_words: int) -> np.ndarray:
    """The class of each id: frequent words by place, then one class per level."""
    return np.where(ids < n_words, ids // CLASS_WORDS, ids - n_words + -(-n_words // CLASS_WORDS))


def _picked(x: np.ndarray, places: np.ndarray, axis: int) -> np.ndarray:
    """Rows or columns at places that are known to exist, which spares numpy the test."""
    return x.take(places, axis, mode="clip")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """The logistic function, in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


def _step(p: Params, a: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """The state after an input whose rows of the input weights are the columns of `a`, and what
    led to it."""
    g = p["state"].T @ h
    gates = _sigmoid(g[: 2 * HIDDEN] + a[: 2 * HIDDEN])
    r, z, g = gates[:HIDDEN], gates[HIDDEN:], g[2 * HIDDEN :]
    n = r * g
    n += a[2 * HIDDEN :]
    np.tanh(n, out=n)
    new = h - n
    new *= z
    new += n
    return new, r, z, n, g


def _start_state(p: Params) -> np.ndarray:
    """The state after the start of a text, as a column."""
    return _step(p, p["input"][-1:].T, np.zeros((HIDDEN, 1), p["state"].dtype))[0]


def _normalized(x: np.ndarray, spread: float) -> np.ndarray:
    """Turns columns of logits into probabilities in place; returns the logarithm of each one's sum
    (less what was taken off). Logits that are no larger than `spread` need no shift."""
    shift = None
    if not spread < 60:
        shift = x.max(0)
        x -= shift
    np.exp(x, out=x)
    total = x.sum(0)
    x /= total
    log = np.log(total)
    return log if shift is None else log + shift


def _outputs(p: Params, h: np.ndarray, ids: np.ndarray, n_words: int, grad: Params | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log-probability of each id given the state before it, a column of `h`; with `grad`,
    also the gradient by the state, and gradients of the weights are added to it."""
    out = np.empty(len(ids))
    back = None if grad is None else np.empty_like(h)
    for a in range(0, len(ids), CHUNK):
        own = slice(a, a + CHUNK)
        out[own], d = _some_outputs(p, h[:, own], ids[own], n_words, grad)
        if back is not None:
            back[:, own] = d
    return out, back


def _spread(weights: np.ndarray, bias: np.ndarray, h: np.ndarray) -> float:
    """How far logits can be from 0, but for those of places that are left empty."""
    return float(np.abs(weights).sum(-2).max() * np.abs(h).max(initial=0) + np.abs(bias[bias > -1e3]).max(initial=0))


def _some_outputs(p: Params, h: np.ndarray, ids: np.ndarray, n_words: int, grad: Params | None) -> tuple[np.ndarray, np.ndarray | None]:
    """What `_outputs` says, of so few ids that they are handled together. They are sorted by
    class, so that the words of a class are found with a run of columns."""
    label = classes_of(ids, n_words)
    order = np.argsort(label.astype(np.uint16), kind="stable")  # sorted by digits
    label, ids, h = label[order], ids[order], _picked(h, order, 1)
    columns = np.arange(len(ids))
    x = p["classes"].T @ h
    x += p["class_bias"][:, None]
    found = x[label, columns].astype(np.float64)
    found -= _normalized(x, _spread(p["classes"], p["class_bias"], h))
    back = None
    if grad is not None:
        x[label, columns] -= 1
        grad["classes"] += h @ x.T
        grad["class_bias"] += x.sum(1)
        back = p["classes"] @ x
    edges = np.searchsorted(label, np.arange(len(p["words"]) + 1))
    spread = _spread(p["words"], p["word_bias"], h) if len(p["words"]) else 0.0
    for c in range(len(p["words"])):
        own = slice(edges[c], edges[c + 1])
        state = h[:, own]
        if state.shape[1]:
            x = p["words"][c].T @ state
            x += p["word_bias"][c][:, None]
            place, column = ids[own] - c * CLASS_WORDS, columns[: state.shape[1]]
            picked = x[place, column]
            found[own] += picked - _normalized(x, spread)
            if grad is not None:
                x[place, column] -= 1
                grad["words"][c] += state @ x.T
                grad["word_bias"][c] += x.sum(1)
                back[:, own] += p["words"][c] @ x
    out = np.empty(len(ids))
    out[order] = found
    if back is None:
        return out, None
    place = np.empty_like(order)
    place[order] = columns
    return out, _picked(back, place, 1)


def score(p: Params, ids: np.ndarray, offsets: np.ndarray, n_words: int, window: int = 64) -> np.ndarray:
    """Log-probability of each whole sequence ids[offsets[i]:offsets[i + 1]].

    Sequences of like length advance together, longest first; the state is carried from window to
    window. A window has `window` steps, or fewer of many sequences.
    """
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    out = np.zeros(len(lengths))
    for a in range(0, len(order), ROWS):
        own = order[a : a + ROWS]
        out[own] = _score_together(p, ids, offsets[:-1][own], lengths[own], n_words, window)
    return out


def _score_together(p: Params, ids: np.ndarray, first: np.ndarray, lengths: np.ndarray, n_words: int, window: int) -> np.ndarray:
    longest = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    total = np.zeros(len(lengths))
    h = np.repeat(_start_state(p), len(lengths), 1)
    states, tokens, held = [], [], 0
    for t in range(longest):
        m = active[t]
        now = ids[first[:m] + t]
        states.append(h[:, :m])
        tokens.append(now)
        held += m
        if held >= CHUNK or len(states) == window or t + 1 == longest:
            got, _ = _outputs(p, np.concatenate(states, 1), np.concatenate(tokens), n_words)
            begin = 0
            for x in tokens:
                total[: len(x)] += got[begin : begin + len(x)]
                begin += len(x)
            states, tokens, held = [], [], 0
        h = _step(p, np.ascontiguousarray(_picked(p["input"], now, 0).T), h[:, :m])[0]
    return total


def lanes(sequences: list[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sequences, the longest first, each at the end of the lane that is shortest then.

    Returns ids and marks of beginnings by (step, lane), and the lengths of the lanes, falling.
    """
    pieces = [x[a : a + SEGMENT] for x in sequences for a in range(0, len(x), SEGMENT)]
    order = sorted(range(len(pieces)), key=lambda i: (-len(pieces[i]), i))
    load = [(0, j) for j in range(min(width, len(pieces)))]
    own: list[list[int]] = [[] for _ in load]
    for i in order:
        size, j = load[0]
        own[j].append(i)
        heapq.heapreplace(load, (size + len(pieces[i]), j))
    length = np.array([sum(len(pieces[i]) for i in x) for x in own], np.int64)
    rank = np.argsort(-length, kind="stable")
    ids = np.zeros((int(length.max(initial=0)), len(own)), np.int32)
    begins = np.zeros(ids.shape, bool)
    for j, lane in enumerate(rank.tolist()):
        at = 0
        for i in own[lane]:
            ids[at : at + len(pieces[i]), j] = pieces[i]
            begins[at, j] = True
            at += len(pieces[i])
    return ids, begins, length[rank]


def _add_rows(to: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
    """to[ids] += rows, where ids may repeat."""
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    ordered = ids[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    to[ordered[first]] += np.add.reduceat(_picked(rows, order, 0), first, axis=0)


def train(p: Params, sequences: list[np.ndarray], n_words: int, moments: Params | None = None, window: int = 32, width: int = LANES, rate: float = 0.01) -> Params:
    """One pass of truncated backpropagation over the sequences, by Adam.

    Gradients stop at the edges of a window, the state does not. `moments` is what Adam knows
    of earlier sequences; it is changed in place, so that a pass can be made in several calls.
    """
    p = {k: v.copy() for k, v in p.items()}
    moments = {} if moments is None else moments
    for k, v in p.items():
        moments.setdefault(f"first {k}", np.zeros_like(v))
        moments.setdefault(f"second {k}", np.zeros_like(v))
    sequences = [x for x in sequences if len(x)]
    if not sequences:
        return p
    ids, begins, length = lanes(sequences, width)
    active = np.searchsorted(-length, -np.arange(len(ids)), "left")
    h = np.zeros((HIDDEN, ids.shape[1]), p["state"].dtype)
    for at in range(0, len(ids), window):
        start_state = _start_state(p)
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        steps = range(at, min(at + window, len(ids)))
        ends = np.cumsum(active[steps.start : steps.stop])
        told = np.concatenate([ids[t, : active[t]] for t in steps])
        inputs = np.ascontiguousarray(_picked(p["input"], told, 0).T)
        flat, r, z, n, g = np.empty((5, HIDDEN, len(told)), h.dtype)
        for k, t in enumerate(steps):
            m = int(active[t])
            own = slice(ends[k] - m, ends[k])
            before = h[:, :m]
            if begins[t, :m].any():
                before = np.where(begins[t, :m], start_state, before)
            flat[:, own] = before
            h, r[:, own], z[:, own], n[:, own], g[:, own] = _step(p, inputs[:, own], before)
        _, outward = _outputs(p, flat, told, n_words, grad)
        # What the gradient of a state is multiplied with on its way to each gate.
        to_n, to_r, to_z = (1 - z) * (1 - n * n), g * r * (1 - r), (flat - n) * z * (1 - z)
        inner = np.empty((3 * HIDDEN, len(told)), h.dtype)
        last = np.empty((HIDDEN, len(told)), h.dtype)
        dh = np.zeros((HIDDEN, 0), h.dtype)
        for k, t in reversed(list(enumerate(steps))):
            m = int(active[t])
            own = slice(ends[k] - m, ends[k])
            d = dh
            if dh.shape[1] < m:
                d = np.zeros((HIDDEN, m), h.dtype)
                d[:, : dh.shape[1]] = dh
            dn, gates = last[:, own], inner[:, own]
            np.multiply(d, to_n[:, own], out=dn)
            np.multiply(dn, to_r[:, own], out=gates[:HIDDEN])
            np.multiply(d, to_z[:, own], out=gates[HIDDEN : 2 * HIDDEN])
            np.multiply(dn, r[:, own], out=gates[2 * HIDDEN :])
            dh = p["state"] @ gates
            dh += d * z[:, own]
            dh += outward[:, own]
            # What led to the state that a sequence starts with belongs to another one.
            new = begins[t, :m]
            if new.any():
                dh[:, new] = 0
        grad["state"] += flat @ inner.T
        inner[2 * HIDDEN :] = last
        _add_rows(grad["input"], told, np.ascontiguousarray(inner.T))
        moments["updates"] = moments.get("updates", 0) + 1
        for k in p:
            g = np.clip(grad[k] / len(told), -1, 1)
            first, second = moments[f"first {k}"], moments[f"second {k}"]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            p[k] -= rate * (first / (1 - 0.9 ** moments["updates"])) / (np.sqrt(second / (1 - 0.99 ** moments["updates"])) + 1e-6)
    return p
