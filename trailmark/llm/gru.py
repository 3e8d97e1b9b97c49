"""A gated recurrent language model in numpy with a class-factored output softmax.

A word's probability is P(class | state) * P(word | class, state), so a step computes the
scores of all classes and of one class's words, not of the whole vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Tokens scored at once, about.
_AT_ONCE = 8_192

# Scores of one block of rows, about: what fits beside a processor's core.
_BLOCK = 98_304

# exp of scores up to here, and sums of many, are normal single-precision numbers.
_SAFE = 60

NAMES = ("embed", "win", "bin", "rec", "wclass", "bclass", "wword", "bword")


@dataclass(frozen=True)
class Shape:
    """``window``: steps of truncated backpropagation, and of scoring between outputs.
    A stream is read in ``lanes`` at most, in fewer if that leaves under ``updates`` windows."""

    hidden: int = 16
    embed: int = 16
    classes: int = 40
    window: int = 32
    lanes: int = 512
    updates: int = 64
    rate: float = 0.01
    seed: int = 11


def word_classes(counts: np.ndarray, classes: int) -> np.ndarray:
    """Class of each word, words sorted by count: equal shares of the square-root mass."""
    mass = np.sqrt(np.maximum(counts, 1.0))
    upto = np.cumsum(mass) / mass.sum()
    return np.unique((upto * classes * 0.999999).astype(np.int64), return_inverse=True)[1]


def blank(counts: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    """Zeros in the shapes of the weights, that take no room."""
    size, h, e = len(counts), shape.hidden, shape.embed
    classes = word_classes(counts, shape.classes).max() + 1
    dims = ((size, e), (e, 3 * h), (3 * h,), (h, 3 * h), (h, classes), (classes,), (size, h), (size,))
    return {name: np.broadcast_to(np.float32(0), one) for name, one in zip(NAMES, dims)}


def start(counts: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    """Small random weights; output biases start at the unigram distribution."""
    random = np.random.default_rng(shape.seed)
    size, h, e = len(counts), shape.hidden, shape.embed
    of = word_classes(counts, shape.classes)
    share = np.maximum(counts, 0.5) / np.maximum(counts, 0.5).sum()
    per_class = np.bincount(of, share)

    def small(*dims: int) -> np.ndarray:
        return random.normal(0, 0.1, dims).astype(np.float32)

    return {
        "embed": small(size, e),
        "win": small(e, 3 * h) * 3,
        "bin": np.zeros(3 * h, np.float32),
        "rec": small(h, 3 * h) * 2,
        "wclass": small(h, len(per_class)),
        "bclass": np.log(per_class).astype(np.float32),
        "wword": small(size, h),
        "bword": np.log(share / per_class[of]).astype(np.float32),
    }


class _Softmax:
    """Weights of one softmax: a row for each place of a state and one for the bias, so that
    one product gives the scores of states that end in 1."""

    def __init__(self, w: np.ndarray, past: np.ndarray) -> None:
        self.w, self.past = w, past
        self.ones = np.ones(w.shape[1], w.dtype)
        self._measure()

    def _measure(self) -> None:
        # States lie between -1 and 1.
        self.reach = np.abs(self.w).sum(0).max()

    def scores(self, states: np.ndarray) -> np.ndarray:
        """A row for each state. Rows are shifted only if a score could pass what exp can hold."""
        made = np.dot(states, self.w)
        if self.reach > _SAFE:
            made -= made.max(1, keepdims=True)
        return made

    def learn(self, grad: np.ndarray, rate: float, bounded: bool) -> None:
        _learn(self.w, self.past, grad, rate, bounded)
        # A step is never longer than the rate.
        self.reach += len(self.w) * rate
        if self.reach > _SAFE:
            self._measure()


def _learn(w: np.ndarray, past: np.ndarray, grad: np.ndarray, rate: float, bounded: bool = False) -> None:
    """A step of AdaGrad in place, ``grad`` included. A ``bounded`` gradient is in [-1, 1]."""
    if not bounded:
        np.clip(grad, -1, 1, out=grad)
    square = grad * grad
    past += square
    np.sqrt(past, out=square)
    np.divide(grad, square, out=square)
    square *= rate
    w -= square


def _summed(values: np.ndarray, numbers: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers (below ``size``), and the sums of the columns that have them, as rows."""
    seen = np.zeros(size, bool)
    seen[numbers] = True
    found = np.flatnonzero(seen)
    place = np.empty(size, np.int64)
    place[found] = np.arange(len(found))
    place = place[numbers]
    return found, np.stack([np.bincount(place, row, len(found)) for row in values], 1).astype(values.dtype)


class Model:
    """Weights with the class layout of the vocabulary (words sorted by count)."""

    def __init__(self, weights: dict[str, np.ndarray], counts: np.ndarray, shape: Shape) -> None:
        self.w = {name: weights[name].astype(np.float32) for name in NAMES}
        self.shape = shape
        self.of = word_classes(counts, shape.classes)
        # Words are sorted, so a class is a run of them.
        self.bounds = np.searchsorted(self.of, np.arange(self.of.max() + 2))

    def _softmaxes(self) -> list[_Softmax]:
        """Those of each class's words, then that of the classes, in one piece of memory."""
        w = self.w
        runs = [slice(low, high) for low, high in zip(self.bounds, self.bounds[1:])]
        found = [(w["wword"][run].T, w["bword"][run]) for run in runs] + [(w["wclass"], w["bclass"])]
        rows = self.shape.hidden + 1
        cuts = np.append(0, np.cumsum([rows * len(bias) for _, bias in found]))
        flat = np.empty(cuts[-1], w["wword"].dtype)
        past = np.full_like(flat, 1e-6)
        made = []
        for (weights, bias), low, high in zip(found, cuts, cuts[1:]):
            own = flat[low:high].reshape(rows, -1)
            own[:-1], own[-1] = weights, bias
            made.append(_Softmax(own, past[low:high].reshape(rows, -1)))
        return made

    def _keep(self, softmaxes: list[_Softmax]) -> None:
        w = self.w
        for low, high, one in zip(self.bounds, self.bounds[1:], softmaxes):
            w["wword"][low:high], w["bword"][low:high] = one.w[:-1].T, one.w[-1]
        w["wclass"][:], w["bclass"][:] = softmaxes[-1].w[:-1], softmaxes[-1].w[-1]

    def _steps(self, inputs, fresh, h):
        """Hidden states after each step; ``fresh`` marks where a text starts. A step's trace
        is (old state, z, r, what r is applied to, n, state)."""
        w, size = self.w, self.shape.hidden
        # Gates z and r with turned signs, as their exponentials are asked for.
        sign = np.array([-1, -1, 1], w["rec"].dtype)[:, None, None]
        win, rec = (w[name].reshape(-1, 3, size).transpose(1, 0, 2) * sign for name in ("win", "rec"))
        told = np.matmul(w["embed"][np.asarray(inputs)][:, None], win)
        told += w["bin"].reshape(3, 1, size) * sign
        goes_on = (~np.asarray(fresh))[:, :, None].astype(told.dtype)
        trace = np.empty((len(told), 6, *h.shape), told.dtype)
        for g, on, step in zip(told, goes_on, trace):
            old, _, r, un, n, after = step
            z, gates = step[1], step[1:3]
            np.multiply(h, on, out=old)
            np.matmul(old, rec, out=step[1:4])
            gates += g[:2]
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            np.multiply(r, un, out=n)
            n += g[2]
            np.tanh(n, out=n)
            np.subtract(old, n, out=after)
            after *= z
            after += n
            h = after
        return trace, h

    def _by_class(self, states, targets):
        """The order of rows by target, their states with a 1 each, and a list of (number of a
        softmax, its first row, its last, its width, the flat places of its targets' scores)
        for all softmaxes that have more than one outcome."""
        order = np.argsort(targets)
        targets = targets[order]
        ended = np.ones((len(states), states.shape[1] + 1), states.dtype)
        ended[:, :-1] = states[order]
        cuts, wide = np.searchsorted(targets, self.bounds), np.diff(self.bounds)
        of, rows = self.of[targets], np.arange(len(targets))
        own = targets - self.bounds[of] + (rows - cuts[of]) * wide[of]
        parts = [
            (c, low, high, m, own[low:high])
            for c, (low, high, m) in enumerate(zip(cuts.tolist(), cuts[1:].tolist(), wide.tolist()))
            if high > low and m > 1
        ]
        if len(wide) > 1:
            parts.append((len(wide), 0, len(targets), len(wide), of + rows * len(wide)))
        return order, ended, parts

    def _outputs(self, states, targets, softmaxes=None):
        """Log probabilities of targets, and the order by class in which they were found."""
        softmaxes = softmaxes or self._softmaxes()
        order, ended, parts = self._by_class(states, targets)
        found = np.zeros(len(targets))
        for number, low, high, wide, own in parts:
            one, step = softmaxes[number], max(1, _BLOCK // wide)
            scored, total = np.empty(high - low, ended.dtype), np.empty(high - low, ended.dtype)
            for at in range(0, high - low, step):
                rows = slice(at, at + step)
                scores = one.scores(ended[low:high][rows])
                scores.take(own[rows] - at * wide if at else own[rows], out=scored[rows], mode="clip")
                np.exp(scores, out=scores)
                np.dot(scores, one.ones, out=total[rows])
            found[low:high] += scored
            found[low:high] -= np.log(total)
        logs = np.empty(len(targets))
        logs[order] = found
        return logs, order

    def score(self, texts: list[np.ndarray], begin: int) -> np.ndarray:
        """Natural-log probability of each text (arrays of word numbers), read after ``begin``.

        Texts are laid out over lanes; each lane reads its texts one after another in
        windows and carries its state from window to window, so a text of any length is
        scored whole.
        """
        made = np.zeros(len(texts))
        lengths = np.array([len(one) for one in texts], np.int64)
        total, longest = int(lengths.sum()), int(lengths.max(initial=0))
        if not total:
            return made
        lanes = int(max(1, min(256, total // longest)))
        filled = np.zeros(lanes, np.int64)
        rows: list[list[int]] = [[] for _ in range(lanes)]
        for i in np.argsort(-lengths, kind="stable"):
            if lengths[i]:
                lane = int(filled.argmin())
                rows[lane].append(i)
                filled[lane] += lengths[i]
        steps = int(filled.max())
        targets = np.zeros((lanes, steps), np.int32)
        inputs = np.full((lanes, steps), begin, np.int32)
        owner = np.full((lanes, steps), -1, np.int32)
        fresh = np.zeros((lanes, steps), bool)
        for lane, own in enumerate(rows):
            at = 0
            for i in own:
                n = int(lengths[i])
                targets[lane, at : at + n] = texts[i]
                inputs[lane, at + 1 : at + n] = texts[i][:-1]
                owner[lane, at : at + n] = i
                fresh[lane, at] = True
                at += n
        targets, inputs, owner, fresh = (x.T.copy() for x in (targets, inputs, owner, fresh))
        softmaxes = self._softmaxes()
        h = np.zeros((lanes, self.shape.hidden), np.float32)
        # Few lanes have longer windows, which changes no result.
        window = max(self.shape.window, _AT_ONCE // lanes)
        for low in range(0, steps, window):
            cut = slice(low, low + window)
            trace, h = self._steps(inputs[cut], fresh[cut], h)
            own = owner[cut].ravel()
            used = own >= 0
            states = trace[:, 5].reshape(len(own), -1)
            logs = self._outputs(states[used], targets[cut].ravel()[used], softmaxes)[0]
            made += np.bincount(own[used], logs, len(texts))
        return made

    def train(self, stream: np.ndarray, fresh: np.ndarray, begin: int) -> int:
        """One pass of truncated backpropagation (AdaGrad) over a stream of texts. Lanes are
        filled up at the end with steps that teach nothing."""
        shape = self.shape
        lanes = max(1, min(shape.lanes, len(stream) // (shape.updates * shape.window)))
        steps = -(-len(stream) // lanes)
        if not steps:
            return 0
        filling = (0, steps * lanes - len(stream))
        targets = np.pad(stream, filling, constant_values=begin).reshape(lanes, steps).T
        new = np.pad(fresh, filling).reshape(lanes, steps).T.copy()
        used = np.pad(np.ones(len(stream), bool), filling).reshape(lanes, steps).T
        new[0] = True
        inputs = np.where(new, begin, np.vstack([targets[:1], targets[:-1]]))
        softmaxes = self._softmaxes()
        past = {name: np.full(self.w[name].shape, 1e-6, np.float32) for name in NAMES[:4]}
        h = np.zeros((lanes, shape.hidden), np.float32)
        for low in range(0, steps, shape.window):
            cut = slice(low, low + shape.window)
            trace, after = self._steps(inputs[cut], new[cut], h)
            dstates = np.zeros((trace.shape[0] * lanes, shape.hidden), np.float32)
            for number, rows, grad in self._output_gradients(trace, targets[cut], used[cut], dstates, softmaxes):
                # A mean over lanes of values in [-1, 1].
                softmaxes[number].learn(grad, shape.rate, rows <= lanes)
            for name, rows, grad in self._recurrent_gradients(trace, inputs[cut], new[cut], dstates):
                if isinstance(rows, slice):
                    _learn(self.w[name], past[name], grad, shape.rate)
                else:
                    weights, sums = self.w[name][rows], past[name][rows]
                    _learn(weights, sums, grad, shape.rate)
                    self.w[name][rows], past[name][rows] = weights, sums
            h = after
        self._keep(softmaxes)
        return len(stream)

    def _output_gradients(self, trace, targets, used, dstates, softmaxes):
        """(number of a softmax, rows that it has, gradient) of the mean loss per lane and step
        of the ``used`` steps. A softmax may be changed when its own has been given. In the end
        ``dstates`` has the states' gradients, of lanes added up."""
        scale = 1 / targets.shape[1]
        flat = np.flatnonzero(used.ravel()) if used is not None and not used.all() else slice(None)
        states, targets = trace[:, 5].reshape(len(dstates), -1)[flat], targets.ravel()[flat]
        order, ended, parts = self._by_class(states, targets)
        found = np.zeros_like(states)
        for number, low, high, wide, own in parts:
            one, step, grad = softmaxes[number], max(1, _BLOCK // wide), None
            weights = one.w[:-1].T
            for at in range(low, high, step):
                rows = slice(at, min(high, at + step))
                place = own if high - low <= step else own[at - low : at - low + step] - (at - low) * wide
                # Probabilities times ``total``, less that at the target.
                scores = one.scores(ended[rows])
                np.exp(scores, out=scores)
                total = np.dot(scores, one.ones)
                scores.reshape(-1)[place] -= total
                np.reciprocal(total, out=total)
                total = total[:, None]
                part = np.dot(scores, weights)
                part *= total
                found[rows] += part
                total *= scale
                part = np.dot((ended[rows] * total).T, scores)
                grad = part if grad is None else np.add(grad, part, out=grad)
            yield number, high - low, grad
        back = np.empty_like(found)
        back[order] = found
        dstates[flat] = back

    def _recurrent_gradients(self, trace, inputs, fresh, dstates):
        """(weight, rows, gradient) of all but the outputs' weights. Overwrites ``dstates``."""
        w, size = self.w, self.shape.hidden
        steps, _, lanes, _ = trace.shape
        scale = 1 / lanes
        old, z, r, un, n, _ = (trace[:, k] for k in range(6))
        goes_on = (~np.asarray(fresh))[:, :, None].astype(trace.dtype)
        # What a state's gradient is multiplied by for each gate before its function.
        stays = 1 - z
        to_n = (1 - n * n) * stays
        through = np.empty((steps, lanes, 3, size), trace.dtype)
        np.multiply((old - n) * stays, z, out=through[:, :, 0])
        to_un = to_n * r
        np.multiply(to_un * un, 1 - r, out=through[:, :, 1])
        through[:, :, 2] = to_un
        dstates = dstates.reshape(steps, lanes, size)
        rest = np.ascontiguousarray(w["rec"].T)
        back = np.zeros_like(dstates[0])
        for t in range(steps - 1, -1, -1):
            dh = dstates[t]
            dh += back
            through[t] *= dh[:, None]
            np.matmul(through[t].reshape(lanes, -1), rest, out=back)
            back += dh * z[t]
            back *= goes_on[t]
        flat = through.reshape(steps * lanes, -1)
        drec = np.ascontiguousarray(old).reshape(len(flat), -1).T @ flat
        drec *= scale
        np.multiply(dstates, to_n, out=through[:, :, 2])
        flat *= scale
        inputs = np.asarray(inputs).ravel()
        words, per_word = _summed(w["win"] @ flat.T, inputs, len(w["embed"]))
        every = slice(None)
        return [
            ("rec", every, drec),
            ("bin", every, flat.sum(0)),
            ("win", every, w["embed"][inputs].T @ flat),
            ("embed", words, per_word),
        ]

    def _gradients(self, trace, inputs, fresh, targets, used=None):
        """(weight, rows, gradient) of the mean loss per lane and step, of the ``used`` steps."""
        dstates = np.zeros((targets.size, self.shape.hidden), trace.dtype)
        softmaxes, made = self._softmaxes(), []
        for number, _, grad in self._output_gradients(trace, targets, used, dstates, softmaxes):
            run, names = slice(None), ("wclass", "bclass")
            if number < len(self.bounds) - 1:
                run, names = slice(self.bounds[number], self.bounds[number + 1]), ("wword", "bword")
            made += [(names[0], run, grad[:-1] if names[0] == "wclass" else grad[:-1].T), (names[1], run, grad[-1])]
        return made + self._recurrent_gradients(trace, inputs, fresh, dstates)


def pack(weights: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([weights[name].ravel() for name in NAMES]).astype("<f4").tobytes()


def unpack(blob: bytes, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    flat, made, at = np.frombuffer(blob, "<f4"), {}, 0
    for name in NAMES:
        size = like[name].size
        made[name] = flat[at : at + size].reshape(like[name].shape).copy()
        at += size
    return made
