"""A small causal self-attention network over token classes, in numpy.

One layer with one head. A token's state is its class's embedding plus what it reads from the
tokens up to itself, weighted by query and key and by a learned factor per distance; a linear
map of the state gives the distribution of the next token's class. Training is Adam on
batches of windows.

Windows overlap: each has ``stride`` positions that are predicted and, before them, the
``stride`` positions of the window before as context only. So every position is predicted
once, from ``stride`` + 1 to 2 ``stride`` known tokens (fewer only where the text begins).
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from numpy.lib.introspect import opt_func_info
from numpy.lib.stride_tricks import sliding_window_view

F32 = np.float32
# exponents are bounded, so that no maximum need be taken from them first
_MOST = F32(40)
# powers of two cost half of those of e, but only where numpy has them in vector form
_BASE2 = "AVX" in opt_func_info(func_name="^exp2$", signature="float32")["exp2"]["ff"]["current"]
_power, _LOG_BASE = (np.exp2, float(np.log(2))) if _BASE2 else (np.exp, 1.0)
# positions in one product with the output: BLAS takes products of this size unpacked, which halves their cost
_ROWS = 512

NAMES = ("embed", "query", "key", "value", "out", "bias", "distance")


def shapes(classes: int, width: int, stride: int) -> dict[str, tuple[int, ...]]:
    square = (width, width)
    sizes = ((classes, width), square, square, square, (width, classes), (classes,), (2 * stride,))
    return dict(zip(NAMES, sizes))


def start(pairs: np.ndarray, width: int, stride: int, seed: int = 0) -> dict[str, np.ndarray]:
    """Parameters before training, from the counts of neighbouring classes: the embedding and
    the output are the best approximation of that rank to the log odds of the pairs."""
    classes = len(pairs)
    smooth = pairs + 0.1 * (pairs.sum(0) + 1) / (pairs.sum() + classes)
    share = (pairs.sum(0) + 0.5) / (pairs.sum() + 0.5 * classes)
    odds = np.log(smooth / smooth.sum(1, keepdims=True)) - np.log(share)
    u, s, v = np.linalg.svd(odds)
    root = np.sqrt(s[:width])
    rng = np.random.default_rng(seed)
    made = {
        name: (rng.standard_normal(shape) * 0.1).astype(F32)
        for name, shape in shapes(classes, width, stride).items()
    }
    rank = len(root)
    made["embed"][:, :rank] = u[:, :rank] * root
    made["out"][:rank] = root[:, None] * v[:rank]
    made["bias"] = np.log(share).astype(F32)
    made["distance"][:] = 0
    return made


def flat(parameters: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([parameters[name].ravel() for name in NAMES])


def unflat(values: np.ndarray, classes: int, width: int, stride: int, copy: bool = True) -> dict[str, np.ndarray]:
    """The parameters in ``values``, as views of it without ``copy``."""
    made, at = {}, 0
    for name, shape in shapes(classes, width, stride).items():
        size = int(np.prod(shape))
        made[name] = values[at : at + size].reshape(shape).astype(F32, copy=copy)
        at += size
    return made


class Batch(NamedTuple):
    """Some windows: ``places`` (n, 2 stride) of tokens, context first; ``first``: no context
    before it; ``real`` (n, stride): positions that exist."""

    places: np.ndarray
    first: np.ndarray
    real: np.ndarray


class Cut(NamedTuple):
    """Tokens of some windows: ``x`` (n, 2 stride), ``target`` (n, stride) behind each predicted
    position. Unlike in ``Batch``, places outside the text hold tokens of its neighbours: those
    before it are masked by ``first``, those behind it are read by no real position."""

    x: np.ndarray
    first: np.ndarray
    target: np.ndarray
    real: np.ndarray


class Windows:
    """All windows over the texts at ``begins``: each one's ``text`` and ``number`` in it."""

    def __init__(self, begins: np.ndarray, lengths: np.ndarray, stride: int) -> None:
        self.begins, self.ends, self.stride = begins, begins + lengths, stride
        counts = -(-lengths // stride)
        self.text = np.repeat(np.arange(len(lengths)), counts)
        self.number = np.arange(len(self.text)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.begin = begins[self.text] + self.number * stride  # of the predictions
        self.left = self.ends[self.text] - self.begin
        self.around = np.arange(-stride, stride)

    def __len__(self) -> int:
        return len(self.text)

    def at(self, chosen) -> Batch:
        text, number = self.text[chosen], self.number[chosen]
        begin, end = self.begins[text][:, None], self.ends[text][:, None]
        places = begin + (number * self.stride)[:, None] + self.around
        real = places[:, self.stride :] < end
        np.clip(places, begin, end - 1, out=places)
        return Batch(places, number == 0, real)

    def pieces(self, tokens: np.ndarray) -> np.ndarray:
        """A view of the tokens for ``cut``: what a window reads, by the place of its first
        prediction. Windows also lie before the first text and behind the last."""
        return sliding_window_view(np.pad(tokens, self.stride), 2 * self.stride + 1)

    def cut(self, pieces: np.ndarray, chosen) -> Cut:
        """The tokens of some windows, each copied in one piece."""
        pieces = pieces[self.begin[chosen]]
        real = self.around[self.stride :] < self.left[chosen][:, None]
        return Cut(pieces[:, :-1], self.number[chosen] == 0, pieces[:, self.stride + 1 :], real)


class Tables(NamedTuple):
    """What the parameters say of classes alone, since a state is its class's embedding."""

    query: np.ndarray  # (classes, width), scaled
    key: np.ndarray
    value: np.ndarray
    weight: np.ndarray  # (classes, classes): of a class read by a class, before the distance
    factor: np.ndarray  # (stride, 2 stride): of the distance, none of what comes later
    out: np.ndarray  # for exponents of the power in use
    usual: np.ndarray  # of a class by its bias, before the state


class Net:
    """Forward and backward passes for one set of parameters, in memory that is used again.

    What depends on classes alone is computed by class and looked up, and its gradient is
    summed by class before it goes on to the parameters."""

    def __init__(self, parameters: dict[str, np.ndarray], stride: int) -> None:
        self.p = parameters
        self.stride = stride
        self.classes, self.width = parameters["embed"].shape
        self.scale = F32(1 / np.sqrt(self.width))
        i, j = np.arange(stride)[:, None] + stride, np.arange(2 * stride)
        self.back = np.maximum(i - j, 0)
        self.causal = (i >= j).astype(F32)
        self.ones = np.ones(max(self.width, 2 * stride), F32)
        self.pair = np.uint16 if self.classes <= 1 << 8 else np.intp  # holds a pair of classes
        self.made: dict[str, np.ndarray] = {}
        self.tables: Tables | None = None  # of the parameters as they are

    def _room(self, name: str, *shape: int, kind=None) -> np.ndarray:
        """An array of this shape; the one of the last call where the shape is the same."""
        found = self.made.get(name)
        if found is None or found.shape != shape:
            found = self.made[name] = np.empty(shape, kind or F32)
        return found

    def _tables(self) -> Tables:
        p = self.p
        query, key = p["embed"] @ (p["query"] * self.scale), p["embed"] @ p["key"]
        weight = np.exp(np.minimum(query @ key.T, _MOST))
        factor = np.exp(p["distance"])[self.back] * self.causal
        usual = np.exp(np.minimum(p["bias"], _MOST))
        return Tables(query, key, p["embed"] @ p["value"], weight, factor, p["out"] * F32(1 / _LOG_BASE), usual)

    def _forward(self, x: np.ndarray, first: np.ndarray):
        """States (n, stride, width) of the predicted positions, and what they were made of:
        classes, their pairs, values, the shares they are read with, and the sums read."""
        made, s, d, n = self.tables, self.stride, self.width, len(x)
        x = x.astype(self.pair)
        small = self._room("small pairs", n, s, 2 * s, kind=self.pair)
        np.add((x[:, s:] * self.pair(self.classes))[:, :, None], x[:, None, :], out=small)
        x, pairs = x.astype(np.intp), self._room("pairs", n, s, 2 * s, kind=np.intp)
        np.copyto(pairs, small)
        a = self._room("a", n, s, 2 * s)
        np.take(made.weight.ravel(), pairs, out=a, mode="clip")
        a *= made.factor
        a[first, :, :s] = 0
        a *= (1 / (a.reshape(-1, 2 * s) @ self.ones[: 2 * s])).reshape(n, s, 1)
        v = np.take(made.value, x, 0, out=self._room("v", n, 2 * s, d), mode="clip")
        read = np.matmul(a, v, out=self._room("read", n, s, d))
        z = np.take(self.p["embed"], x[:, s:], 0, out=self._room("z", n, s, d), mode="clip")
        z += read
        return x, pairs, v, a, read, z

    def _grouped(self, rows: np.ndarray) -> np.ndarray:
        """Groups of ``_ROWS`` rows, or one of all of them."""
        size = _ROWS if len(rows) % _ROWS == 0 else len(rows)
        return rows.reshape(len(rows) // max(size, 1), size, -1)

    def _exponents(self, z: np.ndarray, target: np.ndarray):
        """The powers of all classes without the bias, (positions, classes), the sums of those
        with it, where the targets stand among the powers, and their log probabilities."""
        z = z.reshape(-1, self.width)
        y = self._room("y", len(z), self.classes)
        np.matmul(self._grouped(z), self.tables.out, out=self._grouped(y))
        if y.max(initial=0) > _MOST / _LOG_BASE:
            np.minimum(y, _MOST / F32(_LOG_BASE), out=y)
        at = self.made.get("at")
        if at is None or len(at) != len(y):
            at = self.made["at"] = np.arange(len(y)) * self.classes
        target = target.ravel()
        at = at + target.astype(np.intp)
        logs = y.ravel()[at]
        logs *= F32(_LOG_BASE)
        logs += self.p["bias"][target]
        _power(y, out=y)
        sums = y @ self.tables.usual
        logs -= np.log(sums)
        return y, sums, at, logs

    def log_probabilities(self, x: np.ndarray, first: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural log of each target class's probability; ``target`` (n, stride). The
        parameters are those of the first call."""
        if self.tables is None:
            self.tables = self._tables()
        return self._exponents(self._forward(x, first)[-1], target)[-1].reshape(target.shape)

    def _by_class(self, name: str, classes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Sums of rows: a sorted order makes them sums of runs."""
        ids = classes.ravel()
        counts = np.bincount(ids, minlength=self.classes)
        present = np.flatnonzero(counts)
        # few digits are sorted by counting
        order = np.argsort(ids.astype(np.uint8 if self.classes <= 1 << 8 else np.uint16), kind="stable")
        rows = rows.reshape(len(ids), -1)
        ordered = np.take(rows, order, 0, out=self._room(name, *rows.shape), mode="clip")
        if rows.shape[1] % 2 == 0:  # two numbers are added as one complex number
            ordered = ordered.view(np.result_type(rows, np.complex64))
        made = np.zeros((self.classes, rows.shape[1]), F32)
        made[present] = np.add.reduceat(ordered, (np.cumsum(counts) - counts)[present], axis=0).view(rows.dtype)
        return made

    def gradient(self, x: np.ndarray, first: np.ndarray, target: np.ndarray, real: np.ndarray):
        """Mean loss over the real positions and its gradient."""
        p, s, d, n = self.p, self.stride, self.width, len(x)
        self.tables = made = self._tables()
        x, pairs, v, a, read, z = self._forward(x, first)
        weight = real.ravel().astype(F32)
        weight /= max(weight.sum(), 1)
        y, sums, at, logs = self._exponents(z, target)
        loss = -float(logs @ weight)
        # probabilities less the targets, but for a factor of each class and one of each row
        usual = np.maximum(made.usual, np.exp(-_MOST))  # the quotient stays finite
        y.ravel()[at] -= sums / usual[target.ravel()]
        weight /= sums
        bias = weight @ y * usual
        groups = self._grouped(y)
        weighted = np.multiply(z.reshape(-1, d), weight[:, None], out=self._room("weighted z", n * s, d))
        out = np.matmul(self._grouped(weighted).transpose(0, 2, 1), groups).sum(0) * usual
        dz = self._room("dz", n * s, d)
        np.matmul(groups, (p["out"] * usual).T.copy(), out=self._grouped(dz))
        dz *= weight[:, None]
        dz = dz.reshape(n, s, d)
        self.tables = None  # the parameters change next
        turned = self._room("v turned", n, d, 2 * s)
        np.copyto(turned, v.transpose(0, 2, 1))
        da = np.matmul(dz, turned, out=self._room("da", n, s, 2 * s))
        read *= dz
        da -= (read.reshape(-1, d) @ self.ones[:d]).reshape(n, s, 1)
        da *= a  # by the exponents from here on
        by_distance = np.ones(n, F32) @ da.reshape(n, -1)
        dv = np.matmul(a.transpose(0, 2, 1), dz, out=self._room("dv", n, 2 * s, d))
        # from here on by class
        by_pair = np.bincount(pairs.ravel(), da.ravel(), self.classes**2).astype(F32)
        by_pair = by_pair.reshape(self.classes, -1)
        dquery, dkey = by_pair @ made.key * self.scale, by_pair.T @ made.query
        dvalue = self._by_class("dv by class", x, dv)
        dstate = self._by_class("dz by class", x[:, s:], dz)
        embed = p["embed"]
        g = {
            "embed": dstate + dquery @ p["query"].T + dkey @ p["key"].T + dvalue @ p["value"].T,
            "query": embed.T @ dquery,
            "key": embed.T @ dkey,
            "value": embed.T @ dvalue,
            "out": out,
            "bias": bias,
            "distance": np.bincount(self.back.ravel(), by_distance, 2 * s).astype(F32),
        }
        return loss, g


class Trainer:
    """Adam over batches of windows, from given parameters."""

    def __init__(self, parameters: dict[str, np.ndarray], stride: int, rate: float) -> None:
        self.values = flat(parameters)
        # the network's parameters are views of the values, which change in place
        self.net = Net(unflat(self.values, *parameters["embed"].shape, stride, copy=False), stride)
        self.rate, self.steps, self.seen = rate, 0, 0
        self.mean, self.square = np.zeros_like(self.values), np.zeros_like(self.values)

    def step(self, x: np.ndarray, first: np.ndarray, target: np.ndarray, real: np.ndarray) -> float:
        loss, gradient = self.net.gradient(x, first, target, real)
        self.steps += 1
        self.seen += int(np.count_nonzero(real))
        rate = self.rate * np.sqrt(1 - 0.98**self.steps) / (1 - 0.9**self.steps)
        g = flat(gradient)
        for mean, new, share in ((self.mean, g, 0.1), (self.square, g * g, 0.02)):
            new -= mean
            new *= F32(share)
            mean += new
        root = np.sqrt(self.square)
        root += F32(1e-6)
        change = np.divide(self.mean, root, out=root)
        change *= F32(rate)
        self.values -= change
        return loss
