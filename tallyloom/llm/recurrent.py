"""A gated recurrent language model over word numbers, in numpy.

The output softmax is factored by class: words of the vocabulary, in order of
frequency, form classes of equal size, and the chance of a word is that of its
class times that within the class.  One more class stands for every word
outside the vocabulary.  Training is truncated backpropagation through
windows over lanes of equal length, so that every token is learned from; the
state is carried from window to window and starts anew with each document.
Scoring carries the state through whole documents.
"""

from __future__ import annotations

import heapq
import math

import numpy as np

HIDDEN = 32
EMBED = 24
CLASSES = 40
MEMBERS = 48  # words of a class
OTHERS = 64  # input numbers for words outside the vocabulary, by hash
WORDS = CLASSES * MEMBERS
LANES, STEPS = 256, 24  # of a training window
SCORE_LANES, WINDOW = 256, 64
WARM = 64  # words read ahead of a lane that begins inside a document
UPDATES = 64  # a small table has fewer lanes, for about as many updates


def _exponents(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """exp of ``x`` in its place but for a factor per row: the sum of each row, and the log of it with the factor."""
    top = x.max(initial=0)
    if top - x.min(initial=0) > 60:
        top = x.max(axis=-1, keepdims=True)  # else a row far below the others would vanish
    x -= top
    np.exp(x, out=x)
    whole = x @ np.ones(x.shape[-1], x.dtype)
    return whole, np.log(whole) + (top if np.ndim(top) == 0 else top[:, 0])


def lanes(sizes: np.ndarray, count: int) -> list[list[int]]:
    """Documents dealt to lanes of near equal length, longest lane first."""
    count = max(1, min(count, len(sizes)))
    heap = [(0, i) for i in range(count)]
    dealt: list[list[int]] = [[] for _ in range(count)]
    load = [0] * count
    for d in np.argsort(-sizes, kind="stable"):
        used, i = heapq.heappop(heap)
        dealt[i].append(int(d))
        load[i] = used + int(sizes[d])
        heapq.heappush(heap, (load[i], i))
    return [dealt[i] for i in sorted(range(count), key=lambda i: -load[i])]


class Streams:
    """Documents laid end to end in lanes: inputs, targets, document of each place, by step."""

    def __init__(self, inputs: np.ndarray, targets: np.ndarray, sizes: np.ndarray, count: int) -> None:
        starts = np.cumsum(sizes) - sizes
        self.lanes = lanes(sizes, count)
        self.length = np.array([sum(int(sizes[d]) for d in lane) for lane in self.lanes])
        self.order = [np.concatenate([np.arange(starts[d], starts[d] + sizes[d]) for d in lane]) for lane in self.lanes]
        self.inputs, self.targets = inputs, targets
        self.first = np.zeros(len(inputs), bool)
        self.first[starts[sizes > 0]] = True

    def windows(self, steps: int):
        """(places, active): places[t, i] of lane i at step t, -1 past its end; only lanes still running."""
        for begin in range(0, int(self.length[0]), steps):
            active = int((self.length > begin).sum())
            places = np.full((min(steps, int(self.length[0]) - begin), active), -1)
            for i in range(active):
                part = self.order[i][begin: begin + steps]
                places[: len(part), i] = part
            yield places


class Slices:
    """The same in lanes of equal length, cut anywhere: no lane ends long before the others."""

    def __init__(self, inputs: np.ndarray, targets: np.ndarray, sizes: np.ndarray, count: int) -> None:
        self.inputs, self.targets = inputs, targets
        self.edges = np.linspace(0, len(inputs), max(1, min(count, len(inputs))) + 1).astype(np.int64)
        self.first = np.zeros(len(inputs), bool)
        self.first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True

    def windows(self, steps: int):
        for begin in range(0, int(np.diff(self.edges).max()), steps):
            places = self.edges[:-1] + begin + np.arange(steps)[:, None]
            places[places >= self.edges[1:]] = -1
            yield places[(places >= 0).any(axis=1)]


class Room(dict):
    """Arrays by name that are used again for every window: new ones of that size cost more than what is done in them."""

    def __call__(self, name: str, *shape: int, kind=np.float32) -> np.ndarray:
        size = math.prod(shape)
        if name not in self or self[name].size < size or self[name].dtype != kind:
            self[name] = np.empty(size, kind)
        return self[name][:size].reshape(shape)


class Adam:
    """Steps by running means of gradients and of their squares."""

    def __init__(self, rate: float) -> None:
        self.rate, self.done, self.moments, self.room = rate, 0, {}, Room()

    def update(self, model: GatedModel, gradients: dict[str, np.ndarray]) -> None:
        """One step; ``gradients`` are used up."""
        self.done += 1
        # the moments lack their factors 0.1 and 0.01, which are in the rate and in what keeps the root from 0
        spread = math.sqrt(0.01 / (1 - 0.99**self.done))
        rate, least = np.float32(0.1 * self.rate / (1 - 0.9**self.done) / spread), np.float32(1e-6 / spread)
        for n, g in gradients.items():
            m, v = self.moments.setdefault(n, (np.zeros_like(g), np.zeros_like(g)))
            step = self.room("step", *g.shape)
            m *= np.float32(0.9)
            m += g
            v *= np.float32(0.99)
            g *= g
            v += g
            np.sqrt(v, out=step)
            step += least
            np.divide(m, step, out=step)
            step *= rate
            p = getattr(model, n)
            p -= step


class GatedModel:
    NAMES = ("emb", "wx", "u", "un", "b", "wc", "bc", "ww", "bw")

    def __init__(self, seed: int = 5) -> None:
        random = np.random.default_rng(seed)

        def start(*shape, scale=None):
            return (random.standard_normal(shape) * (scale or shape[0] ** -0.5)).astype(np.float32)

        self.emb = start(WORDS + OTHERS + 1, EMBED, scale=0.1)  # the last is the begin of a document
        self.wx = start(EMBED, 3 * HIDDEN)
        self.u, self.un = start(HIDDEN, 2 * HIDDEN), start(HIDDEN, HIDDEN)
        self.b = np.zeros(3 * HIDDEN, np.float32)
        self.wc, self.bc = start(HIDDEN, CLASSES + 1, scale=0.05), np.zeros(CLASSES + 1, np.float32)
        self.ww, self.bw = start(CLASSES, HIDDEN, MEMBERS, scale=0.05), np.zeros((CLASSES, MEMBERS), np.float32)
        self.room = Room()

    def _table(self) -> np.ndarray:
        """What each input number adds to both gates and to the new state, signed for ``_step``."""
        table = self.room("table", 3, len(self.emb), HIDDEN)
        for part, wx, b, sign in zip(table, np.split(self.wx, 3, axis=1), np.split(self.b, 3), (-1, -1, -2)):
            np.matmul(self.emb, wx * sign, out=part)
            part += b * sign
        return table

    def _inner(self) -> tuple[np.ndarray, np.ndarray]:
        """The weights of the state, signed for ``_step``."""
        return -self.u.reshape(HIDDEN, 2, HIDDEN).swapaxes(0, 1), self.un * np.float32(-2)

    @staticmethod
    @np.errstate(over="ignore")  # of a gate that is shut
    def _step(x: np.ndarray, h: np.ndarray, u: np.ndarray, un: np.ndarray, out=None, gates=None, reset=None, n=None):
        """Next state, gates, what the reset leaves and new part, by lane; a gate is 1 / (1 + e), e of a sum with its sign turned."""
        gates = np.matmul(h, u, out=gates)
        gates += x[:2]
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        reset = np.multiply(gates[1], h, out=reset)
        n = np.matmul(reset, un, out=n)
        n += x[2]
        np.exp(n, out=n)
        n += 1
        np.divide(2, n, out=n)
        n -= 1
        out = np.subtract(h, n, out=out)
        out *= gates[0]
        out += n
        return out, gates, reset, n

    def _by_class(self, states: np.ndarray, targets: np.ndarray):
        """The order by class; states, place of each target in its class and class, in that order; where each class ends in it."""
        kind = np.minimum(targets // MEMBERS, CLASSES).astype(np.int16)
        order = np.argsort(kind, kind="stable")
        kind = kind[order]
        own = np.take(states, order, axis=0, out=self.room("sorted", *states.shape, kind=states.dtype), mode="clip")
        return order, own, targets[order] - kind * MEMBERS, kind, np.searchsorted(kind, np.arange(CLASSES + 1))

    def _within(self, states: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """What each word of the target's class has after states in order of class."""
        x = self.room("within", ends[CLASSES], MEMBERS, kind=states.dtype)
        for c in np.flatnonzero(np.diff(ends)):
            own = slice(ends[c], ends[c + 1])
            np.matmul(states[own], self.ww[c], out=x[own])
            x[own] += self.bw[c]
        return x

    def outputs(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log chance of each target (CLASSES * MEMBERS and above: outside the vocabulary) after its state."""
        order, states, member, kind, ends = self._by_class(states, targets)
        x = np.matmul(states, self.wc, out=self.room("class", len(states), CLASSES + 1, kind=states.dtype))
        x += self.bc
        found = x[np.arange(len(kind)), kind]
        found -= _exponents(x)[1]
        known = ends[CLASSES]
        x = self._within(states, ends)
        within = x[np.arange(known), member[:known]]
        found[:known] += within - _exponents(x)[1]
        out = np.empty_like(found)
        out[order] = found
        return out

    def score(self, inputs: np.ndarray, targets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Natural log chance of each whole document; ``inputs`` are the words before the targets."""
        table, inner = self._table(), self._inner()
        streams = Streams(inputs, targets, sizes, SCORE_LANES)
        document = np.repeat(np.arange(len(sizes)), sizes)
        total = np.zeros(len(sizes))
        h = np.zeros((len(streams.lanes), HIDDEN), np.float32)
        for places in streams.windows(WINDOW):
            steps, active = places.shape
            h = h[:active].copy()
            states, x, asked = self.room("states", steps, active, HIDDEN), self.room("x", 3, active, HIDDEN), inputs[places]
            space = self.room("gates", 2, active, HIDDEN), self.room("reset", active, HIDDEN), self.room("new", active, HIDDEN)
            for t, fresh in enumerate(streams.first[places]):
                if fresh.any():
                    h = h.copy()
                    h[fresh] = 0
                h = self._step(np.take(table, asked[t], axis=1, out=x, mode="clip"), h, *inner, states[t], *space)[0]
            real = places.ravel() >= 0
            at, states = places.ravel(), states.reshape(-1, HIDDEN)
            if not real.all():
                at, states = at[real], states[real]
            total += np.bincount(document[at], self.outputs(states, targets[at]), len(sizes))
        return total

    def begin(self, counts: np.ndarray) -> None:
        """Chances by the training counts of each word number, the last being all words outside."""
        share = counts + 0.5
        self.bc[:CLASSES] = np.log(share[:WORDS].reshape(CLASSES, MEMBERS).sum(1) / share.sum())
        self.bc[CLASSES] = np.log(share[WORDS] / share.sum())
        self.bw[:] = np.log(share[:WORDS].reshape(CLASSES, MEMBERS))

    def weights(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def load(self, weights: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            shape = getattr(self, n).shape
            setattr(self, n, weights[at: at + math.prod(shape)].reshape(shape).astype(np.float32))
            at += math.prod(shape)

    def _warm(self, slices: Slices) -> np.ndarray:
        """The state before each lane."""
        h = np.zeros((len(slices.edges) - 1, HIDDEN), np.float32)
        table, inner = self._table(), self._inner()
        for back in range(WARM, 0, -1):
            real = slices.edges[:-1] >= back
            at = np.where(real, slices.edges[:-1] - back, 0)
            h[slices.first[at]] = 0
            h = self._step(np.take(table, slices.inputs[at], axis=1), h, *inner)[0]
            h[~real] = 0
        return h

    def learn(self, inputs: np.ndarray, targets: np.ndarray, sizes: np.ndarray, adam: Adam) -> None:
        """Truncated backpropagation through every token once."""
        slices = Slices(inputs, targets, sizes, min(LANES, max(4, len(inputs) // (STEPS * UPDATES))))
        h = self._warm(slices)
        for places in slices.windows(STEPS):
            gradients, h = self._window(slices, places, h)
            adam.update(self, gradients)

    def _window(self, streams: Streams | Slices, places: np.ndarray, h: np.ndarray):
        """Gradients over the places of a window, and the states after it."""
        inputs, targets = streams.inputs[places], streams.targets
        inner = self._inner()
        table, room, shape = self._table(), self.room, (*places.shape, HIDDEN)
        before, states, reset, new = (room(n, *shape) for n in ("before", "states", "reset", "new"))
        gates, x = room("gates", len(places), 2, *h.shape), room("x", 3, *h.shape)
        halted = [np.flatnonzero(stop) for stop in streams.first[places] | (places < 0)]
        for t, stop in enumerate(halted):
            before[t] = h
            before[t][stop] = 0
            h = self._step(np.take(table, inputs[t], axis=1, out=x, mode="clip"), before[t], *inner, states[t], gates[t], reset[t], new[t])[0]
        h = h.copy()
        real = places.ravel() >= 0
        some = slice(None) if real.all() else real
        order, flat, member, kind, ends = self._by_class(states.reshape(-1, HIDDEN)[some], targets[places.ravel()[some]])
        scale = np.float32(1 / max(1, len(kind)))
        g = {n: room("g" + n, *getattr(self, n).shape) for n in ("emb", "ww", "bw")}
        for whole in g.values():
            whole[:] = 0
        delta = np.matmul(flat, self.wc, out=room("class", len(kind), CLASSES + 1))
        delta += self.bc
        delta *= (scale / _exponents(delta)[0])[:, None]
        delta[np.arange(len(kind)), kind] -= scale
        ones = np.ones(len(kind), np.float32)
        g["wc"], g["bc"] = flat.T @ delta, ones @ delta
        back = np.matmul(delta, self.wc.T, out=room("back", len(kind), HIDDEN))
        known = ends[CLASSES]
        within = self._within(flat, ends)
        within *= (scale / _exponents(within)[0])[:, None]
        within[np.arange(known), member[:known]] -= scale
        sent = room("sent", known, HIDDEN)
        for c in np.flatnonzero(np.diff(ends)):
            own = slice(ends[c], ends[c + 1])
            delta = within[own]
            np.matmul(flat[own].T, delta, out=g["ww"][c])
            np.matmul(ones[own], delta, out=g["bw"][c])
            np.matmul(delta, self.ww[c].T, out=sent[own])
        back[:known] += sent
        dout = room("dout", places.size, HIDDEN)
        dout[~real] = 0
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        dout[some] = np.take(back, place, axis=0, out=room("sorted", *back.shape), mode="clip")
        dout = dout.reshape(shape)
        dx = room("dx", 3, *shape)
        through = self.un.T, *self.u.reshape(HIDDEN, 2, HIDDEN).transpose(1, 2, 0)
        dh, one, two = np.zeros(h.shape, np.float32), np.empty(h.shape, np.float32), np.empty(h.shape, np.float32)
        for t in reversed(range(len(places))):
            z, r = gates[t]
            dh += dout[t]
            np.subtract(1, z, out=one)
            np.multiply(new[t], new[t], out=two)
            np.subtract(1, two, out=two)
            two *= one
            dn = np.multiply(dh, two, out=dx[2, t])
            np.subtract(before[t], new[t], out=two)
            two *= dh
            one *= z
            np.multiply(one, two, out=dx[0, t])
            np.matmul(dn, through[0], out=two)
            np.subtract(1, r, out=one)
            one *= reset[t]
            np.multiply(one, two, out=dx[1, t])
            dh *= z
            two *= r
            dh += two
            dh += np.matmul(dx[0, t], through[1], out=one)
            dh += np.matmul(dx[1, t], through[2], out=one)
            dh[halted[t]] = 0
        # the gradients of all weights of the gates, and of those of the new state, in one product each
        dx = np.concatenate(dx.reshape(3, -1, HIDDEN), axis=1, out=room("dx by place", places.size, 3 * HIDDEN))
        asked = inputs.ravel()
        into = room("into", places.size, HIDDEN + EMBED + 1)
        into[:, :HIDDEN], into[:, -1] = before.reshape(-1, HIDDEN), 1
        into[:, HIDDEN:-1] = np.take(self.emb, asked, axis=0, mode="clip")
        both = into.T @ dx[:, : 2 * HIDDEN]
        into[:, :HIDDEN] = reset.reshape(-1, HIDDEN)
        last = into.T @ dx[:, 2 * HIDDEN:]
        g["u"], g["un"] = both[:HIDDEN], last[:HIDDEN]
        rest = np.concatenate([both[HIDDEN:], last[HIDDEN:]], axis=1)
        g["wx"], g["b"] = rest[:EMBED], rest[EMBED]
        order = np.argsort(asked.astype(np.int16), kind="stable")
        asked = asked[order]
        begins = np.flatnonzero(np.diff(asked, prepend=-1))
        own = np.matmul(dx, self.wx.T, out=room("sent", places.size, EMBED))
        own = np.take(own, order, axis=0, out=room("back", places.size, EMBED), mode="clip")
        g["emb"][asked[begins]] = np.add.reduceat(own, begins)
        size = np.sqrt(sum(float(np.vdot(v, v)) for v in g.values()))
        if size > 1:
            for whole in g.values():
                whole /= np.float32(size)
        return g, h
