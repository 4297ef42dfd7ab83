"""A gated recurrent network over words in numpy, with a class-factored softmax.

A word is predicted in two steps, its class and the word within the class, so
that no step looks at all words. One further class stands for all words that
the network doesn't know; what comes within it is left to the caller.

Texts run side by side in lanes, each lane's texts one after the other. A
window takes some steps of all lanes; the state goes on from window to window
and starts anew with each text. Training goes back through the steps of one
window (truncated backpropagation).

An update touches what a window has met: the rows of its inputs, whose moments
are decayed by the steps missed, and the words of a class once the class has
been met by ``1 / RIPE`` as many tokens as it has words, so that the cost of updates a
token does not grow with the number of words.
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN = 24
#: Words of a class for each token that an update of the class takes.
RIPE = 8
#: Tokens whose classes are predicted together, so that their chances stay in
#: a processor's cache.
BLOCK = 1024
#: Rows of an id that are added id by id, where it has as many; those of the
#: other ids are added to all ids at once, a row of each.
FEW = 16
#: Tokens of windows whose words are scored together.
TOGETHER = 1 << 16
#: Rows of weights updated together.
ROWS = 512
#: Lanes of a training window at least (if there are as many texts) and at most.
LANES = 256, 1024
#: Tokens of a piece of a long text at least, in training.
PIECE = 512
SHAPES = ("inputs", "recurrent", "classes", "class_bias", "words", "word_bias")


class Layout:
    """``n_words`` known words in order of frequency, in classes of about the
    same sum of the square roots of their shares: frequent words are in small
    classes, and a token's class is smaller on average than where classes have
    equal shares. ``edges`` bounds each class's words."""

    def __init__(self, shares: np.ndarray, n_classes: int, n_inputs: int, hidden: int = HIDDEN):
        self.n_words, self.n_inputs, self.hidden = len(shares), n_inputs, hidden
        roots = np.sqrt(shares) / max(np.sqrt(shares).sum(), 1e-300)
        of = np.minimum((np.cumsum(roots) - roots / 2) * n_classes, n_classes - 1).astype(int)
        _, of = np.unique(of, return_inverse=True)
        self.class_of = np.concatenate([of, [of.max(initial=-1) + 1]]).astype(np.int64)
        self.n_classes = int(self.class_of[-1]) + 1
        self.edges = np.searchsorted(self.class_of, np.arange(self.n_classes + 1))

    def start(self, shares: np.ndarray, seed: int = 7) -> dict[str, np.ndarray]:
        """Weights that give each word its share: ``shares`` of the known
        words and, last, of all others."""
        rng = np.random.default_rng(seed)
        h, small = self.hidden, lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        by_class = np.bincount(self.class_of, np.maximum(shares, 1e-12), self.n_classes)
        within = np.maximum(shares, 1e-12) / by_class[self.class_of]
        return {
            "inputs": small(self.n_inputs, 3 * h), "recurrent": small(h, 3 * h) * 3,
            "classes": small(h, self.n_classes) * 0.1, "class_bias": np.log(by_class / by_class.sum()).astype(np.float32),
            "words": small(self.n_words, h) * 0.1, "word_bias": np.log(within[:-1]).astype(np.float32),
        }


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _powers(state: np.ndarray, weights: np.ndarray, at: np.ndarray, ones: np.ndarray, safe: bool, total: np.ndarray, found: np.ndarray) -> np.ndarray:
    """e to the power of the logits ``state @ weights``. Each row's sum goes to
    ``total``, the logits at the places ``at`` (read row by row) to ``found``.
    If ``safe``, the largest logit of each row is taken off first."""
    x = state @ weights
    if safe:
        x -= x.max(axis=1)[:, None]
    x.reshape(-1).take(at, out=found, mode="clip")
    np.exp(x, out=x)
    np.dot(x, ones[: x.shape[1]], out=total)
    return x


def _sums(blocks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``ids`` and the sum of each one's rows, which are the
    rows of all ``blocks`` side by side."""
    order = np.argsort(ids)
    ids, places = ids[order], order[:, None] + len(ids) * np.arange(len(blocks))
    rows = blocks.reshape(-1, blocks.shape[2]).take(places, axis=0, mode="clip").reshape(len(ids), len(blocks) * blocks.shape[2])
    at = np.flatnonzero(np.append(len(ids) > 0, ids[1:] != ids[:-1]))
    size = np.diff(np.append(at, len(ids)))
    most = np.argsort(-size, kind="stable")  # those with a k-th row come first
    at, size = at[most], size[most]
    out = rows.take(at, axis=0, mode="clip")
    more = np.searchsorted(-size, -np.arange(FEW + 1)).tolist()
    long = more[FEW]
    for k in range(1, FEW):
        if more[k] > long:
            out[long : more[k]] += rows.take(at[long : more[k]] + k, axis=0, mode="clip")
    ones = np.ones(size.max(initial=0), rows.dtype)
    for k, (i, n) in enumerate(zip(at[:long].tolist(), size[:long].tolist())):
        np.dot(ones[:n], rows[i : i + n], out=out[k])
    return ids[at], out


def lanes(texts: list[np.ndarray], n_lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the texts' tokens in lanes of about the same length, the
    longest first: the token at each step of each lane (-1: none), counted
    over all texts, and which of them start a text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    n_lanes = max(1, min(n_lanes, len(texts)))
    loads = [(0, k, []) for k in range(n_lanes)]
    for i in np.argsort(-sizes, kind="stable").tolist():
        load, k, own = heapq.heappop(loads)
        own.append(i)
        heapq.heappush(loads, (load + int(sizes[i]), k, own))
    loads.sort(key=lambda x: (-x[0], x[1]))
    place = np.full((loads[0][0], n_lanes), -1, np.int32)
    first = np.zeros(place.shape, bool)
    for lane, (_, _, own) in enumerate(loads):
        at = 0
        for i in own:
            place[at : at + sizes[i], lane] = np.arange(starts[i], starts[i] + sizes[i])
            first[at, lane] = sizes[i] > 0
            at += int(sizes[i])
    return place, first


def _those(states: np.ndarray, there: np.ndarray) -> np.ndarray:
    return states.reshape(there.size, -1) if there.all() else states[there]


class Network:
    """``w`` has the weights by name. Each bias is a further row or column of
    its weights in memory, so that one product gives both."""

    def __init__(self, layout: Layout, weights: dict[str, np.ndarray]):
        n = layout.hidden
        self.layout = layout
        self.classes = np.concatenate([weights["classes"], weights["class_bias"][None]])
        self.words = np.concatenate([weights["words"], weights["word_bias"][:, None]], axis=1)
        self.w = {
            "inputs": weights["inputs"], "recurrent": weights["recurrent"], "classes": self.classes[:n],
            "class_bias": self.classes[n], "words": self.words[:, :n], "word_bias": self.words[:, n],
        }

    def _gates(self) -> np.ndarray:
        """Recurrent weights of the two gates and the new state."""
        n = self.layout.hidden
        return np.ascontiguousarray(self.w["recurrent"].reshape(n, 3, n).transpose(1, 0, 2))

    def _steps(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """States after each step of a window; ``keep`` gets what the way back
        needs. Gates are apart in memory, so that each step works on whole
        blocks."""
        n, u = self.layout.hidden, self._gates()
        g = self.w["inputs"].reshape(-1, n).take(np.multiply(x, 3, dtype=np.intp) + np.arange(3).reshape(3, 1, 1), axis=0, mode="clip")
        out = np.empty((*x.shape, n), g.dtype)
        pre = np.empty((len(x) if keep is not None else 1, x.shape[1], n), g.dtype)
        if keep is not None:
            keep.update(before=np.empty_like(out), pre=pre, gates=g[:2], new=g[2])
        some, h = fresh.any(axis=1).tolist(), h.astype(g.dtype)
        a, own = np.empty((2, *h.shape), g.dtype), np.empty_like(h)
        with np.errstate(over="ignore"):
            for t in range(len(x)):
                if some[t]:
                    h = np.where(fresh[t][:, None], g.dtype.type(0), h)
                gates, new, by = g[:2, t], g[2, t], pre[t if keep is not None else 0]
                np.matmul(h, u[:2], out=a)
                np.matmul(h, u[2], out=by)
                gates += a
                _sigmoid(gates)
                if keep is not None:
                    keep["before"][t] = h
                np.multiply(gates[0], by, out=own)
                new += own
                np.tanh(new, out=new)
                h = np.subtract(h, new, out=out[t])
                h *= gates[1]
                h += new
        return out

    def _outputs(self, state: np.ndarray, y: np.ndarray, learn: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log-probabilities of the words ``y``; with ``learn``, gradients of
        their negative sum are put there (the bias with its weights; of words:
        by class met, with its tokens), and those of the states returned."""
        layout, n = self.layout, self.layout.hidden
        of = layout.class_of[y]
        order = np.argsort(of.astype(np.int16) if layout.n_classes < 1 << 15 else of, kind="stable")
        sorted_state = np.ones((len(y), n + 1), state.dtype)
        sorted_state[:, :n] = state[order]
        of, y = of[order], y[order]
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            found, total, back = self._sorted(sorted_state, of, y, learn, False)
            if not (np.isfinite(total).all() and total.min(initial=1) > 1e-30):
                found, total, back = self._sorted(sorted_state, of, y, learn, True)
        found -= np.log(total)
        as_given = np.empty_like(order)
        as_given[order] = np.arange(len(y))
        return found.sum(axis=0)[as_given], back if back is None else back[as_given]

    def _sorted(self, state: np.ndarray, of: np.ndarray, y: np.ndarray, learn: dict | None, safe: bool) -> tuple:
        """Of tokens sorted by class ``of``: logits of their classes and, in
        these, their words; the sums of the powers of all logits that they
        were chosen from; gradients of the states. Finite sums are the
        caller's care, unless ``safe``."""
        layout, n = self.layout, self.layout.hidden
        found, total = np.zeros((2, len(y)), state.dtype), np.ones((2, len(y)), state.dtype)
        back = of_words = None
        if learn is not None:
            learn["classes"], learn["words"] = np.zeros_like(self.classes.T), {}
            back, of_words = np.empty((len(y), n), state.dtype), np.zeros_like(state)
        row, n_classes = np.arange(len(y)), layout.n_classes
        ones = np.ones(max(n_classes, np.diff(layout.edges).max()), state.dtype)
        target = row % BLOCK * n_classes + of
        for i in range(0, len(y), BLOCK):
            part = slice(i, min(i + BLOCK, len(y)))
            own, sums, at = state[part], total[0, part], target[part]
            x = _powers(own, self.classes, at, ones, safe, sums, found[0, part])
            if learn is not None:
                x.reshape(-1)[at] -= sums
                share = (1 / sums)[:, None]
                learn["classes"] += x.T @ (own * share)
                np.multiply(x @ self.w["classes"].T, share, out=back[part])
        bounds, edges = np.searchsorted(of, np.arange(n_classes)), layout.edges
        target = (row - bounds[of]) * np.diff(edges)[of] + y - edges[of]
        bounds, edges = bounds.tolist(), edges.tolist()
        for c in range(n_classes - 1):
            i, j, lo, hi = bounds[c], bounds[c + 1], edges[c], edges[c + 1]
            if hi - lo < 2 or i == j:
                continue
            own, sums, at, words = state[i:j], total[1, i:j], target[i:j], self.words[lo:hi]
            x = _powers(own, words.T, at, ones, safe, sums, found[1, i:j])
            if learn is not None:
                x.reshape(-1)[at] -= sums
                learn["words"][c] = x.T @ (own / sums[:, None]), j - i
                np.dot(x, words, out=of_words[i:j])
        if learn is not None:
            of_words /= total[1][:, None]
            back += of_words[:, :n]
            learn["classes"] = learn["classes"].T
        return found, total, back

    def windows(self, texts: list[tuple[np.ndarray, np.ndarray]], n_lanes: int, steps: int, least: int = 0):
        """Windows over ``texts`` (inputs and words to predict): inputs, which
        steps start a text, which have a token, its place, words. Where few
        lanes are left, they have so many steps as to hold ``least`` tokens."""
        if not texts:
            return
        x, y = (np.concatenate([t[i] for t in texts]) for i in (0, 1))
        place, first = lanes([t[0] for t in texts], n_lanes)
        at = 0
        while at < len(place):
            n = int((place[at] >= 0).sum())  # lanes get shorter from left to right
            until = at + max(steps, least // max(n, 1))
            own = place[at:until, :n]
            there = own >= 0
            held = own.reshape(-1) if there.all() else own[there]
            yield x.take(own, mode="clip"), first[at:until, :n], there, held, y.take(held)
            at = until

    def score(self, texts: list[tuple[np.ndarray, np.ndarray]], n_lanes: int = 512, steps: int = 16) -> np.ndarray:
        """Natural log-probability of each token, text after text."""
        found = np.zeros(sum(len(t[0]) for t in texts), np.float64)
        h, met, n = None, [], 0
        for x, first, there, place, y in self.windows(texts, n_lanes, steps, 8192):
            h = np.zeros((x.shape[1], self.layout.hidden), np.float32) if h is None else h[: x.shape[1]]
            states = self._steps(x, first, h)
            h = states[-1]
            met.append((_those(states, there), place, y))
            n += len(y)
            if n >= TOGETHER:
                self._judge(met, found)
                met, n = [], 0
        self._judge(met, found)
        return found

    def _judge(self, met: list[tuple], found: np.ndarray) -> None:
        """Puts the log-probabilities of some windows' words at their places."""
        if met:
            states, place, y = (np.concatenate(x) for x in zip(*met))
            found[place] = self._outputs(states, y)[0]

    def _back(self, x, first, there, y, h) -> tuple[dict, np.ndarray, float]:
        """Gradients of the negative log-probability of a window's words:
        ``inputs`` as rows met and theirs, ``words`` by class."""
        keep: dict = {}
        states = self._steps(x, first, h, keep)
        learn: dict = {}
        found, back = self._outputs(_those(states, there), y, learn)
        n, u = self.layout.hidden, np.ascontiguousarray(self._gates().transpose(0, 2, 1))
        if len(back) == there.size:
            d_states = back.reshape(states.shape)
        else:
            d_states = np.zeros_like(states)
            d_states[there] = back
        d_g = np.empty((3, *states.shape), states.dtype)
        d_new_a = np.empty_like(states)
        d_a = np.empty((3, *states[0].shape), states.dtype)
        d_next, own, some = np.zeros_like(states[0]), np.empty_like(states[0]), first.any(axis=1).tolist()
        for t in range(len(x) - 1, -1, -1):
            before, pre, new, (r, z) = keep["before"][t], keep["pre"][t], keep["new"][t], keep["gates"][:, t]
            (d_r, d_z, d_new), d = d_g[:, t], d_states[t]
            d += d_next
            np.multiply(d, z, out=d_next)
            # z: d * z * (before - new) * (1 - z)
            np.subtract(before, new, out=d_z)
            d_z *= d_next
            np.subtract(1, z, out=own)
            d_z *= own
            # new: d * (1 - z) * (1 - new * new)
            np.multiply(d, own, out=d_new)
            np.multiply(new, new, out=own)
            np.subtract(1, own, out=own)
            d_new *= own
            # r: d_new * r * pre * (1 - r)
            by = np.multiply(d_new, r, out=d_new_a[t])
            np.subtract(1, r, out=own)
            np.multiply(by, pre, out=d_r)
            d_r *= own
            np.matmul(d_g[:2, t], u[:2], out=d_a[:2])
            np.matmul(by, u[2], out=d_a[2])
            for d in d_a:
                d_next += d
            if some[t]:
                d_next[first[t]] = 0
        before = keep["before"].reshape(-1, n).T
        learn["recurrent"] = np.concatenate([before @ d.reshape(-1, n) for d in (d_g[0], d_g[1], d_new_a)], axis=1)
        learn["inputs"] = _sums(d_g.reshape(3, -1, n), x.reshape(-1))
        return learn, states[-1], float(-found.sum())

    def gradients(self, x, first, there, y, h) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Of the mean negative log-probability of a window's words, of the
        shapes of the weights."""
        learn, h, loss = self._back(x, first, there, y, h)
        n, whole = self.layout.hidden, {k: np.zeros_like(self.w[k]) for k in SHAPES}
        whole["recurrent"], whole["classes"], whole["class_bias"] = learn["recurrent"], learn["classes"][:n], learn["classes"][n]
        ids, rows = learn["inputs"]
        whole["inputs"][ids] = rows
        for c, (of_words, _) in learn["words"].items():
            own = slice(self.layout.edges[c], self.layout.edges[c + 1])
            whole["words"][own], whole["word_bias"][own] = of_words[:, :n], of_words[:, n]
        return {k: g / max(len(y), 1) for k, g in whole.items()}, h, loss

    def train(self, texts: list[tuple[np.ndarray, np.ndarray]], adam: dict, rate: float, steps: int = 16) -> int:
        """One pass over ``texts`` by Adam; ``adam`` is kept from call to
        call. Returns the number of tokens. A text longer than the lanes is
        learnt from in several pieces, each with a state of its own, so that
        no window is left with a few lanes."""
        total = sum(len(t[0]) for t in texts)
        n_lanes = int(np.clip(total // 4096, *LANES))
        size = max(PIECE, total // n_lanes)
        texts = [(x[i : i + size], y[i : i + size]) for x, y in texts for i in range(0, len(x), size)]
        adam = adam.setdefault("adam", Adam(self))
        h = None
        for x, first, there, _, y in self.windows(texts, n_lanes, steps):
            h = np.zeros((x.shape[1], self.layout.hidden), np.float32) if h is None else h[: x.shape[1]]
            learn, h, _ = self._back(x, first, there, y, h)
            adam.update(learn, max(len(y), 1), rate)
        return total


class Adam:
    """Moments of the weights of ``net``, and updates of those that a window
    has met."""

    def __init__(self, net: Network):
        self.layout, self.n = net.layout, 0
        self.w = {"inputs": net.w["inputs"], "recurrent": net.w["recurrent"], "classes": net.classes, "words": net.words}
        self.m, self.v = ({k: np.zeros_like(w) for k, w in self.w.items()} for _ in range(2))
        self.last = np.zeros(self.layout.n_inputs, np.int32)
        #: By class: gradients of its words not yet applied, tokens.
        self.waiting: dict[int, tuple] = {}
        #: Updates of each class.
        self.times = np.zeros(self.layout.n_classes, np.int64)

    def _rate(self, rate: float, n: int) -> np.float32:
        return np.float32(rate / (1 + self.n / 400) ** 0.5 * (1 - 0.99**n) ** 0.5 / (1 - 0.9**n))

    @staticmethod
    def _step(w, m, v, g, rate) -> None:
        """In place. ``m`` is 10 times the first moment, ``v`` 100 times the
        second, so that what they are multiplied by falls out."""
        m *= np.float32(0.9)
        m += g
        v *= np.float32(0.99)
        g *= g
        v += g
        np.sqrt(v, out=g)
        g += np.float32(1e-5)
        np.divide(m, g, out=g)
        g *= rate
        w -= g

    def update(self, learn: dict, n_tokens: int, rate: float) -> None:
        self.n += 1
        step, share = self._rate(rate, self.n), np.float32(1 / n_tokens)
        for k in ("recurrent", "classes"):
            self._step(self.w[k], self.m[k], self.v[k], learn[k] * share, step)
        all_ids, all_rows = learn["inputs"]
        all_rows *= share
        for i in range(0, len(all_ids), ROWS):
            ids, rows = all_ids[i : i + ROWS], all_rows[i : i + ROWS]
            missed = (self.n - 1 - self.last[ids]).astype(np.float32)[:, None]
            self.last[ids] = self.n
            w, m, v = (x["inputs"].take(ids, axis=0, mode="clip") for x in (self.w, self.m, self.v))
            m *= np.float32(0.9) ** missed
            v *= np.float32(0.99) ** missed
            self._step(w, m, v, rows, step)
            self.w["inputs"][ids], self.m["inputs"][ids], self.v["inputs"][ids] = w, m, v
        edges, run, last, met = self.layout.edges.tolist(), [], -1, 0
        for c, (g, n) in learn["words"].items():
            if (old := self.waiting.pop(c, None)) is not None:
                g += old[0]
                n += old[1]
            if n * RIPE < len(g):
                self.waiting[c] = g, n
                continue
            self.times[c] += 1
            g *= np.float32(1 / n)
            times = int(self.times[c])
            if run and (c != last + 1 or times != met or edges[c + 1] - edges[run[0][0]] > 2 * ROWS):
                self._words(run, self._rate(rate, met))
                run = []
            run.append((c, g))
            last, met = c, times
        if run:
            self._words(run, self._rate(rate, met))

    def _words(self, run: list[tuple], step: np.float32) -> None:
        """Updates the words of classes one after the other by their gradients."""
        own = slice(self.layout.edges[run[0][0]], self.layout.edges[run[-1][0] + 1])
        self._step(self.w["words"][own], self.m["words"][own], self.v["words"][own], np.concatenate([g for _, g in run]), step)


def flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[k].reshape(-1) for k in SHAPES])


def unflat(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in SHAPES:
        out[k] = values[at : at + like[k].size].astype(np.float32).reshape(like[k].shape)
        at += like[k].size
    return out
