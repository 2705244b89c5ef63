"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

Words enter as a hashed word vector beside the mean of their hashed character trigram
vectors. The network reads windows of WINDOW words, pools its states by attention and gives a
logit; a text's score is that of its most toxic window. In training a window begins every
STRIDE words, in scoring at every word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


WINDOW, STRIDE = 24, 16
WORD_BITS, GRAM_BITS = 15, 13
WORD_DIM, GRAM_DIM, HIDDEN = 8, 8, 8
#: Labelled documents of either class that are drawn for training, of any length, and the bytes that they may have together.
SAMPLE, SAMPLE_BYTES = 2000, 4 << 20
#: Windows of a text, those of the highest logits, that a training step goes back through; all are read.
STEP_WINDOWS = 48
#: Texts of either class from which the growth of the logit is taken, see _rise.
RISE_TEXTS = 500
THRESHOLD = 0.3
BATCH_BYTES = 1 << 20

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_POWERS = np.cumprod(np.full(4096, 0x100000001B3, dtype=np.uint64), dtype=np.uint64)


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return ("" if text is None else str(text)).encode("utf-8", "surrogatepass").translate(_LOWER).split()


@dataclass
class Vocabulary:
    """Buckets of a list of words: one for the word, several for its character trigrams."""

    word: np.ndarray
    gram: np.ndarray
    gram_start: np.ndarray
    gram_count: np.ndarray

    @classmethod
    def of(cls, words: list[bytes]) -> Vocabulary:
        """A word is looked at with a space at either end; so every word has a trigram."""
        data = np.frombuffer(b" " + b" ".join(words) + b"  ", dtype=np.uint8).astype(np.uint64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(size + 1) - size  # of the word; the space stands before it
        within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        place = np.repeat(start, size) + within
        value = (data[place] + np.uint64(1)) * _POWERS[within % len(_POWERS)]
        total = np.add.reduceat(value, np.cumsum(size) - size) if len(words) else np.zeros(0, np.uint64)
        word = (total * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - WORD_BITS)
        mixed = data[place - 1] | data[place] << np.uint64(8) | data[place + 1] << np.uint64(16)
        gram = (mixed * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - GRAM_BITS)
        return cls(word.astype(np.int64), gram.astype(np.int64), np.cumsum(size) - size, size)


def windows_of(count: int) -> np.ndarray:
    """First words of the windows that training reads: one every STRIDE words, the last one reaching the end."""
    return np.arange(0, max(1, count - (WINDOW - STRIDE)), STRIDE)


def _numbered(texts: list[list[bytes]]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, number of each word, words of each text. Number 0 is the empty place behind a text."""
    number: dict[bytes, int] = {}
    flat = [number.setdefault(w, len(number) + 1) for words in texts for w in words]
    return list(number), np.array(flat, dtype=np.int64), np.array([len(w) for w in texts], dtype=np.int64)


def _lanes(count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all windows of texts laid end to end: first word, words in it, text."""
    starts = [windows_of(n) for n in count.tolist()]
    owner = np.repeat(np.arange(len(count)), [len(s) for s in starts])
    inside = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return inside + (np.cumsum(count) - count)[owner], np.minimum(WINDOW, count[owner] - inside), owner


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters and passes; forward keeps what backward needs only if asked to."""

    def __init__(self, seed: int = 6):
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + GRAM_DIM, HIDDEN

        def draw(*shape, scale=None):
            return (rng.standard_normal(shape) * (scale or 1 / np.sqrt(shape[0]))).astype(np.float32)

        self.p = {"word": draw(1 << WORD_BITS, WORD_DIM, scale=0.05), "gram": draw(1 << GRAM_BITS, GRAM_DIM, scale=0.05),
                  "attend": draw(2 * h, 1), "out": draw(2 * h, 1), "bias": np.zeros(1, np.float32)}
        for side in "fb":
            self.p |= {f"w{side}": draw(d, 3 * h), f"u{side}": draw(h, 3 * h), f"c{side}": np.zeros(3 * h, np.float32)}
        self.shift = 0.0
        self.rise = 0.0  # by which the logits of score_all lie above those of score, on average

    def inputs(self, v: Vocabulary) -> np.ndarray:
        """Input vector of each distinct word; row 0 is the empty place."""
        out = np.zeros((len(v.word) + 1, WORD_DIM + GRAM_DIM), dtype=np.float32)
        if len(v.word):
            out[1:, :WORD_DIM] = self.p["word"][v.word]
            out[1:, WORD_DIM:] = np.add.reduceat(self.p["gram"][v.gram], v.gram_start, axis=0) / v.gram_count[:, None]
        return out

    def _run(self, side: str, x: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool):
        """States of one direction, (windows, places, hidden); empty places carry the state on."""
        h, n = HIDDEN, len(ids)
        u, state = self.p[f"u{side}"], np.zeros((n, HIDDEN), np.float32)
        table = x @ self.p[f"w{side}"] + self.p[f"c{side}"]
        states = np.zeros((WINDOW, n, h), dtype=np.float32)
        saved = []
        for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
            given = table[ids[:, t]]
            zr = _sigmoid(given[:, :2 * h] + state @ u[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            rs = r * state
            new = np.tanh(given[:, 2 * h:] + rs @ u[:, 2 * h:])
            m = mask[:, t:t + 1]
            following = np.where(m, state + z * (new - state), state)
            if keep:
                saved.append((t, state, z, r, rs, new, m))
            state = following
            states[t] = state
        return states, saved

    def forward(self, x: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        f, saved_f = self._run("f", x, ids, mask, keep)
        b, saved_b = self._run("b", x, ids, mask, keep)
        both = np.concatenate([f, b], axis=2)
        weight = both @ self.p["attend"][:, 0]
        weight = np.where(mask.T, weight, -1e9)
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = (weight[:, :, None] * both).sum(axis=0)
        logit = pooled @ self.p["out"][:, 0] + self.p["bias"][0]
        return logit, ((saved_f, saved_b, both, weight, pooled) if keep else None)

    def backward(self, x, ids, mask, held, d_logit) -> dict[str, np.ndarray]:
        """Gradients by parameter; the input's under "x"."""
        saved_f, saved_b, both, weight, pooled = held
        h = HIDDEN
        g = {"out": (pooled * d_logit[:, None]).sum(axis=0)[:, None], "bias": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * self.p["out"][:, 0]
        d_weight = (both * d_pooled).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
        g["attend"] = np.einsum("tn,tnh->h", d_score, both)[:, None]
        d_both = weight[:, :, None] * d_pooled + d_score[:, :, None] * self.p["attend"][:, 0]
        g["x"] = np.zeros_like(x)
        for side, saved, d_states in (("f", saved_f, d_both[:, :, :h]), ("b", saved_b, d_both[:, :, h:])):
            u, w = self.p[f"u{side}"], self.p[f"w{side}"]
            du, d_table = np.zeros_like(u), np.zeros((len(x), 3 * h), np.float32)
            carry = np.zeros((len(ids), h), np.float32)
            for t, state, z, r, rs, new, m in reversed(saved):
                d = carry + d_states[t]
                on = d * m
                d_new = on * z * (1 - new * new)
                d_rs = d_new @ u[:, 2 * h:].T
                d_z = on * (new - state) * z * (1 - z)
                d_r = d_rs * state * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], axis=1)
                du[:, :2 * h] += state.T @ d_zr
                du[:, 2 * h:] += rs.T @ d_new
                carry = np.where(m, d * (1 - z), d) + d_rs * r + d_zr @ u[:, :2 * h].T
                np.add.at(d_table, ids[:, t], np.concatenate([d_zr, d_new], axis=1))
            g[f"u{side}"], g[f"w{side}"], g[f"c{side}"] = du, x.T @ d_table, d_table.sum(axis=0)
            g["x"] += d_table @ w.T
        return g

    def _pooled(self, side: str, table: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For n windows that begin at one word after the other and each place in them: attention and output of one
        direction's state. table has the inputs of the words, words in columns; a place of all windows is a slice of it."""
        h, u = HIDDEN, self.p[f"u{side}"].T
        gates, fresh = np.ascontiguousarray(u[:2 * h] * np.float32(0.5)), np.ascontiguousarray(u[2 * h:])
        part = slice(0, h) if side == "f" else slice(h, 2 * h)
        read = np.ascontiguousarray(np.concatenate([self.p["attend"][part], self.p["out"][part]], axis=1).T)
        state = np.zeros((h, n), np.float32)
        out = np.empty((WINDOW, 2, n), np.float32)
        for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
            zr = gates @ state
            zr += table[:2 * h, t:t + n]
            np.tanh(zr, out=zr)  # the sigmoid of twice the sum is (1 + tanh of the sum) / 2
            zr += 1
            zr *= np.float32(0.5)
            new = fresh @ (zr[h:] * state)
            new += table[2 * h:, t:t + n]
            np.tanh(new, out=new)
            new -= state
            new *= zr[:h]
            state += new
            out[t] = read @ state
        return out[:, 0], out[:, 1]

    def score_all(self, texts: list[list[bytes]], block: int = 2048) -> np.ndarray:
        """Probability of each text: that of its most toxic window, a full window beginning at every word.

        A text of at most WINDOW words is one window.
        """
        words, flat, count = _numbered(texts)
        x = self.inputs(Vocabulary.of(words))
        begin = np.cumsum(count) - count
        best = np.full(len(texts), -np.inf)
        short = np.flatnonzero(count <= WINDOW)
        padded = np.concatenate([flat, np.zeros(WINDOW, np.int64)])
        for at in range(0, len(short), 8192):
            some = short[at:at + 8192]
            mask = np.arange(WINDOW) < count[some, None]
            best[some] = self.forward(x, np.where(mask, padded[begin[some, None] + np.arange(WINDOW)], 0), mask)[0]
        long = count > WINDOW
        if long.any():
            words_in = np.repeat(long, count)
            ids, owner = flat[words_in], np.repeat(np.arange(len(texts)), count)[words_in]
            side = {}
            for k in "fb":
                side[k] = x @ self.p[f"w{k}"] + self.p[f"c{k}"]
                side[k][:, :2 * HIDDEN] *= np.float32(0.5)
            last = len(ids) - WINDOW  # windows over the edge of two texts are computed and passed over
            for at in range(0, last + 1, block):
                n = min(block, last + 1 - at)
                near = ids[at:at + n + WINDOW - 1]
                f, b = (self._pooled(k, np.ascontiguousarray(side[k][near].T), n) for k in "fb")
                weight = f[0] + b[0]
                weight = np.exp(weight - weight.max(axis=0))
                logit = (weight * (f[1] + b[1])).sum(axis=0) / weight.sum(axis=0) + self.p["bias"][0]
                first = owner[at:at + n]
                own = first == owner[at + WINDOW - 1:at + WINDOW - 1 + n]
                np.maximum.at(best, first[own], logit[own])
        return _sigmoid(best + self.shift - self.rise)

    def score(self, texts: list[list[bytes]]) -> np.ndarray:
        """Like score_all, over the windows that training reads."""
        words, flat, count = _numbered(texts)
        x = self.inputs(Vocabulary.of(words))
        first, size, owner = _lanes(count)
        flat = np.concatenate([flat, np.zeros(WINDOW, np.int64)])
        best = np.full(len(texts), -np.inf)
        for at in range(0, len(first), 8192):
            some = slice(at, at + 8192)
            mask = np.arange(WINDOW) < size[some, None]
            logit, _ = self.forward(x, np.where(mask, flat[first[some, None] + np.arange(WINDOW)], 0), mask)
            np.maximum.at(best, owner[some], logit)
        return _sigmoid(best + self.shift)


def _weigh_tables(net: Network, texts: list[list[bytes]], y: np.ndarray) -> None:
    """Begins one component of the word and trigram vectors at their log odds in the sample, shrunk to 0 where chance may have made them."""
    words, flat, count = _numbered([list(dict.fromkeys(t)) for t in texts])
    v = Vocabulary.of(words)
    toxic = np.repeat(y, count) > 0.5
    total = [max(1, int((y > 0.5).sum())), max(1, int((y <= 0.5).sum()))]
    seen = [np.bincount(flat[toxic] - 1, minlength=len(words)), np.bincount(flat[~toxic] - 1, minlength=len(words))]

    def odds(a, b):
        expected = (a + b) * total[0] / (total[0] + total[1])
        sure = np.abs(a - expected) / np.sqrt(expected + 1)  # chance alone stays near 1
        return np.minimum(1, (sure / 5) ** 3) * np.log((a / total[0] + 2e-3) / (b / total[1] + 2e-3))

    def table(bucket, a, b, size):
        return odds(np.bincount(bucket, a, size), np.bincount(bucket, b, size))

    net.p["word"][:, 0] += table(v.word, *seen, 1 << WORD_BITS).astype(np.float32)
    share = [np.repeat(s / 4, v.gram_count) for s in seen]
    net.p["gram"][:, 0] += table(v.gram, *share, 1 << GRAM_BITS).astype(np.float32)


def _point_up(net: Network, texts: list[list[bytes]]) -> None:
    """Turns the output's sign if windows of words that go with label 1 have the lower logits at the start.

    The gradient reaches a text's highest windows; where the telling ones begin lowest, a long text would
    never show them.
    """
    logits, odds = [], []
    for at in range(0, len(texts), 32):
        words, flat, count = _numbered(texts[at:at + 32])
        x = net.inputs(Vocabulary.of(words))
        first, size, _ = _lanes(count)
        flat = np.concatenate([flat, np.zeros(WINDOW, np.int64)])
        for block in range(0, len(first), 8192):
            some = slice(block, block + 8192)
            mask = np.arange(WINDOW) < size[some, None]
            ids = np.where(mask, flat[first[some, None] + np.arange(WINDOW)], 0)
            logits.append(net.forward(x, ids, mask)[0])
            odds.append(x[ids, 0].sum(axis=1) + x[ids, WORD_DIM].sum(axis=1))
    a, b = np.concatenate(logits), np.concatenate(odds)
    if ((a - a.mean()) * (b - b.mean())).sum() < 0:
        net.p["out"] *= -1


def _highest(net: Network, x: np.ndarray, flat: np.ndarray, first: np.ndarray, size: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Numbers of the windows, in order, without those behind the STEP_WINDOWS highest logits of a long text."""
    many = np.bincount(owner) > STEP_WINDOWS
    if not many.any():
        return np.arange(len(owner))
    looked = np.flatnonzero(many[owner])
    logit = np.empty(len(looked))
    for at in range(0, len(looked), 8192):
        some = looked[at:at + 8192]
        mask = np.arange(WINDOW) < size[some, None]
        logit[at:at + 8192] = net.forward(x, np.where(mask, flat[first[some, None] + np.arange(WINDOW)], 0), mask)[0]
    order = np.lexsort((-logit, owner[looked]))
    text = owner[looked][order]
    place = np.arange(len(order)) - np.searchsorted(text, text)
    return np.sort(np.concatenate([np.flatnonzero(~many[owner]), looked[order[place < STEP_WINDOWS]]]))


def train(texts: list[str], y: np.ndarray, prior: float, epochs: int = 6, seed: int = 6) -> Network:
    """Network from texts and labels; prior is the share of label 1 that scores should assume.

    A text's logit is the soft maximum over its windows (of a long text, over the STEP_WINDOWS
    highest of them in each step), so the label of a text is enough.
    With no text, or one class only, all scores equal the prior.
    """
    net, rng = Network(seed), np.random.default_rng(seed)
    cut = [words_of(t) for t in texts]
    rate = min(max(prior, 1e-4), 1 - 1e-4)
    if len(y) == 0 or y.min() == y.max():
        net.p["out"][:] = 0
        net.shift = float(np.log(rate / (1 - rate)))
        return net
    _weigh_tables(net, cut, y)
    _point_up(net, [cut[i] for k in (0, 1) for i in np.flatnonzero(y == k)[:64]])
    first_moment = {k: np.zeros_like(v) for k, v in net.p.items()}
    second_moment = {k: np.zeros_like(v) for k, v in net.p.items()}
    step, size = 0, 32
    epochs = max(epochs, -(-300 * size // len(y)))
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        speed = 5e-3 * (1 - epoch / epochs) + 3e-4
        for at in range(0, len(order), size):
            some = order[at:at + size]
            words, flat, count = _numbered([cut[i] for i in some])
            v = Vocabulary.of(words)
            x = net.inputs(v)
            begin, held_words, owner = _lanes(count)
            flat = np.concatenate([flat, np.zeros(WINDOW, np.int64)])
            kept = _highest(net, x, flat, begin, held_words, owner)
            begin, held_words, owner = begin[kept], held_words[kept], owner[kept]
            mask = np.arange(WINDOW) < held_words[:, None]
            ids = np.where(mask, flat[begin[:, None] + np.arange(WINDOW)], 0)
            logit, held = net.forward(x, ids, mask, keep=True)
            top = np.full(len(some), -np.inf)
            np.maximum.at(top, owner, logit)
            share = np.exp(2 * (logit - top[owner]))
            share /= np.bincount(owner, share, len(some))[owner]
            soft = np.bincount(owner, share * logit, len(some))
            d_soft = (_sigmoid(soft) - y[some]) / len(some)
            g = net.backward(x, ids, mask, held, (d_soft[owner] * share).astype(np.float32))
            step += 1
            gx = g.pop("x")[1:]
            rows = {"word": (v.word, gx[:, :WORD_DIM]),
                    "gram": (v.gram, np.repeat(gx[:, WORD_DIM:] / v.gram_count[:, None], v.gram_count, axis=0))}
            for k, (bucket, grad) in rows.items():
                held_rows, where = np.unique(bucket, return_inverse=True)
                total = np.zeros((len(held_rows), grad.shape[1]), np.float32)
                np.add.at(total, where, grad)
                _adam(net.p[k], first_moment[k], second_moment[k], total, 0.1 * speed, step, held_rows)
            for k, grad in g.items():
                _adam(net.p[k], first_moment[k], second_moment[k], grad, speed, step)
    share = float(y.mean())
    net.rise = _rise(net, cut, y, rate)
    net.shift = float(np.log(rate / (1 - rate)) - np.log(share / (1 - share)))
    return net


def _rise(net: Network, texts: list[list[bytes]], y: np.ndarray, rate: float) -> float:
    """Mean growth of the logit when a maximum is over all windows and not only those of training; classes weighed by rate."""
    some = np.concatenate([np.flatnonzero(y > 0.5)[:RISE_TEXTS], np.flatnonzero(y <= 0.5)[:RISE_TEXTS]])
    texts, y, grown = [texts[i] for i in some], y[some], []
    for at in range(0, len(texts), 100):
        low, high = (np.clip(f(texts[at:at + 100]), 1e-9, 1 - 1e-9) for f in (net.score, net.score_all))
        grown.append(np.log(high / (1 - high)) - np.log(low / (1 - low)))
    grown = np.concatenate(grown)
    return float(rate * grown[y > 0.5].mean() + (1 - rate) * grown[y <= 0.5].mean())


def _adam(p, m, s, grad, speed, step, rows=slice(None)) -> None:
    m[rows] = 0.9 * m[rows] + 0.1 * grad
    s[rows] = 0.999 * s[rows] + 0.001 * grad * grad
    p[rows] -= speed * (m[rows] / (1 - 0.9**step)) / (np.sqrt(s[rows] / (1 - 0.999**step)) + 1e-8)


def train_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Network:
    """Network learned from labelled documents; unlabelled ones and NULL labels are passed over.

    Of each class the `sample` labelled ids of smallest hash are drawn and broadcast (two
    numbers each), so no text is shuffled. In order of the hash, whole texts of any length are taken
    while those of a class have at most `sample_bytes` bytes together; a text that would exceed this is
    passed over. An id that documents hold several times gives its shortest text.
    """
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).dropna().dropDuplicates(["_id"])
    drawn = [marked.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(sample) for y in (0, 1)]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("_d"), text.alias("_t"), F.octet_length(text).alias("_size"))
    sizes = rows.join(F.broadcast(drawn[0].union(drawn[1])), F.col("_d") == F.col("_id")).groupBy("_id", "_y").agg(F.min("_size").alias("_bytes"))
    left, taken = {0: sample_bytes, 1: sample_bytes}, []
    for r in sizes.orderBy(F.xxhash64("_id"), "_id").collect():  # at most two samples of three numbers
        if r["_bytes"] <= left[r["_y"]]:
            left[r["_y"]] -= r["_bytes"]
            taken.append((r["_id"], r["_y"], r["_bytes"]))
    chosen = docs.sparkSession.createDataFrame(taken, sizes.schema)
    texts = rows.join(F.broadcast(chosen), (F.col("_d") == F.col("_id")) & (F.col("_size") == F.col("_bytes")))
    got = sorted((r["_id"], r["_y"], r["_t"]) for r in texts.groupBy("_id", "_y").agg(F.min("_t").alias("_t")).collect())
    prior = marked.agg(F.avg("_y")).first()[0]
    return train([t for _, _, t in got], np.array([y for _, y, _ in got], dtype=np.float64), 0.5 if prior is None else prior)


def _score(shared, where: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, held, group = 0, 0, []
            for i, value in enumerate(batch.column(where)):
                group.append(words_of(value.as_py()))
                held += 8 * len(group[-1])
                if held >= BATCH_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(begin, len(group))
                    score = shared.value.score_all(group)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score, pa.float64())], names=[*part.schema.names, "score"])
                    begin, held, group = i + 1, 0, []

    return run


def score_toxicity(docs: DataFrame, network: Network, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds score (0 to 1) and predicted (1 if score >= threshold), from the whole text alone.

    No shuffle. NULL and empty texts are one window without words. Rows are kept as they are;
    columns named score or predicted are replaced.
    """
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")])
    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(network)  # of fixed size
    scored = rows.mapInArrow(_score(shared, rows.columns.index(text_col)), schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


