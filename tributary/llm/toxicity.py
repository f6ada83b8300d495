"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is its hashed word vector plus the mean of its hashed character
n-gram vectors (n-grams at a word's start are features of their own).  A text
is cut into overlapping windows of WINDOW words, STRIDE apart, the last one
flush with the end, and every window is scored; the text's score is its
highest window's.  Forward and backward recurrences run over a window,
attention weighs their states, and one logistic unit reads the pooled state.

Training is numpy back-propagation in one task over a bounded sample of
labelled rows.  Only whole texts are labelled, so each round trains on the
windows that the model itself scores highest in each text (and a random one of
clean texts); vectors start from the sample's log-odds.  The bias is then set
to the cut that parts the sample's texts best.

To score, each different word of a batch is put through the input layer once;
the recurrences then run over thousands of windows at a time.

Cases: null, empty and wordless texts are one empty window, whose score is
that of a pooled state of zero; very long texts are read whole; rows and
repeats stay; other columns are ignored; without rows of both labels every
score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import byte_view, lower_ascii, mix, row_again, slices, SpanHash, with_row, word_spans
from tributary.llm.labelled import fit_in_task, fold, sample

WINDOW, STRIDE = 32, 16
WORD_BITS, GRAM_BITS, DIM, HIDDEN, ATTEND = 16, 16, 12, 8, 8
NGRAMS = (3, 4, 5)
# Bounds of the training sample: rows of each class, bytes of a text.
PER_CLASS = {0: 4000, 1: 1500}
MAX_BYTES = 10_000
ROUNDS, EPOCHS, BATCH, RATE, VECTOR_RATE, STEPS = 3, 2, 128, 0.01, 0.5, 100

IS_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


@dataclass
class Words:
    """Texts as runs of ids of their different words."""
    ids: np.ndarray          # of each word in order
    first: np.ndarray        # words before text k
    bucket: np.ndarray       # word row of each different word
    grams: np.ndarray        # n-gram rows of the different words, in order
    gram_word: np.ndarray    # the word that an n-gram is of
    gram_share: np.ndarray   # one over the number of n-grams, by word
    hash: np.ndarray         # of each different word


def words_of(column: pa.Array) -> Words:
    buf, offsets = byte_view(column)
    buf = lower_ascii(buf)
    starts, ends, first = word_spans(buf, offsets, IS_WORD)
    spans = SpanHash(buf)
    hashes = spans(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    different, where, ids = np.unique(hashes, return_index=True, return_inverse=True)
    grams, owner = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    a, size = starts[where], (ends - starts)[where]
    for n in NGRAMS:
        many = np.maximum(size - n + 1, 0)
        word = np.repeat(np.arange(len(different)), many)
        inner = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        at = a[word] + inner
        h = mix(spans(at, at + n) + np.where(inner == 0, np.uint64(n + 100), np.uint64(n)))
        grams.append((h >> np.uint64(64 - GRAM_BITS)).astype(np.int32))
        owner.append(word.astype(np.int32))
    gram, owner = np.concatenate(grams), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    gram, owner = gram[order], owner[order]
    count = np.bincount(owner, minlength=len(different))
    return Words(ids.astype(np.int64).ravel(), first, (different >> np.uint64(64 - WORD_BITS)).astype(np.int64), gram, owner, 1 / np.maximum(count, 1), different)


def merged(parts: list[Words]) -> Words:
    """One run of texts out of several, with common ids."""
    base = np.cumsum([0] + [len(p.hash) for p in parts])
    different, where, back = np.unique(np.concatenate([p.hash for p in parts]), return_index=True, return_inverse=True)
    back = back.ravel()
    grams, owners = [], []
    for p, b in zip(parts, base, strict=False):
        mine = where[back[p.gram_word + b]] == p.gram_word + b  # a word's n-grams come from its first run
        grams.append(p.grams[mine])
        owners.append(back[p.gram_word[mine] + b].astype(np.int32))
    gram, owner = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    first = np.concatenate([[0], *(np.diff(p.first) for p in parts)]).cumsum()
    return Words(np.concatenate([back[p.ids + b] for p, b in zip(parts, base, strict=False)]), first,
                 np.concatenate([p.bucket for p in parts])[where], gram[order], owner[order],
                 np.concatenate([p.gram_share for p in parts])[where], different)


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, words) of each window of each text."""
    n = np.diff(first)
    many = 1 + -(-np.maximum(n - WINDOW, 0) // STRIDE)
    text = np.repeat(np.arange(len(n)), many)
    k = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    begin = np.minimum(k * STRIDE, np.maximum(n[text] - WINDOW, 0))
    return text, first[text] + begin, np.minimum(n[text], WINDOW)


@dataclass
class Network:
    word: np.ndarray
    gram: np.ndarray
    dense: dict[str, np.ndarray] = field(default_factory=dict)

    def inputs(self, w: Words, block: int = 8192) -> Iterator[tuple[int, np.ndarray]]:
        """The input vectors of the different words, in blocks (first word, vectors)."""
        for lo in range(0, len(w.bucket), block):
            yield lo, self.some_inputs(w, np.arange(lo, min(lo + block, len(w.bucket))))

    def states(self, x: np.ndarray, n: np.ndarray, keep: bool = False):
        """Hidden states (T, N, 2H) of projected inputs (T, N, 6H): the first
        half of the gates is the forward direction's; windows have n words."""
        d, steps, size = self.dense, len(x), x.shape[1]
        out = np.zeros((steps, size, 2 * HIDDEN), np.float32)
        kept = {}
        for side in (0, 1):
            u, cols = d[f"u{side}"], slice(3 * HIDDEN * side, 3 * HIDDEN * (side + 1))
            h = np.zeros((size, HIDDEN), np.float32)
            for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
                hu = h @ u
                xt = x[t, :, cols]
                g = np.tanh(0.5 * (xt[:, :2 * HIDDEN] + hu[:, :2 * HIDDEN]))
                g *= 0.5
                g += 0.5
                z, r = g[:, :HIDDEN], g[:, HIDDEN:]
                new = np.tanh(xt[:, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
                if keep:
                    kept[side, t] = (h, z, r, new, hu[:, 2 * HIDDEN:])
                new = new + z * (h - new)
                h = new if t < n.min(initial=0) else np.where((t < n)[:, None], new, h)
                out[t, :, HIDDEN * side:HIDDEN * (side + 1)] = h
        return out, kept

    def pool(self, states: np.ndarray, n: np.ndarray):
        d = self.dense
        act = np.tanh(states @ d["wa"])
        s = act @ d["va"]
        s[np.arange(len(s))[:, None] >= n[None, :]] = -1e9
        weight = np.exp(s - s.max(0))
        weight /= weight.sum(0)
        weight[:, n == 0] = 0
        pooled = (weight[:, :, None] * states).sum(0)
        return act, weight, pooled, pooled @ d["w"] + d["b"][0]

    def logits(self, w: Words, begin: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The logit of each window."""
        projected = np.zeros((len(w.bucket) + 1, 6 * HIDDEN), np.float32)  # the last row stands behind a text's end
        for lo, vectors in self.inputs(w):
            projected[lo:lo + len(vectors)] = vectors @ self.dense["wx"] + self.dense["bx"]
        ids = np.concatenate([w.ids, np.full(WINDOW, len(projected) - 1)])
        out = np.zeros(len(begin), np.float32)
        order = np.argsort(n, kind="stable")
        for part in np.array_split(order, max(1, -(-len(order) // 2048))):
            if len(part):
                steps = max(1, int(n[part].max()))
                x = projected[ids[begin[part][None, :] + np.arange(steps)[:, None]]]
                out[part] = self.pool(self.states(x, n[part])[0], n[part])[3]
        return out

    def gradients(self, w: Words, begin: np.ndarray, n: np.ndarray, label: np.ndarray):
        """Gradients of the mean logistic loss: of the dense parts, and of the
        inputs of the different words."""
        d = self.dense
        steps, size = int(max(1, n.max())), len(begin)
        at = np.minimum(begin[None, :] + np.arange(steps)[:, None], len(w.ids) - 1)
        mask = np.arange(steps)[:, None] < n[None, :]
        ids = w.ids[at]
        used, back_ids = np.unique(ids, return_inverse=True)
        back_ids = back_ids.reshape(ids.shape)
        vec = self.some_inputs(w, used)
        x_in = vec[back_ids]
        x = x_in @ d["wx"] + d["bx"]
        states, kept = self.states(x, n, keep=True)
        act, weight, pooled, logit = self.pool(states, n)
        g = {k: np.zeros_like(v) for k, v in d.items()}
        dl = (1 / (1 + np.exp(-logit)) - label) / size
        g["w"], g["b"] = pooled.T @ dl, np.array([dl.sum()], np.float32)
        dp = dl[:, None] * d["w"]
        dw = (states * dp).sum(2)
        ds = weight * (dw - (weight * dw).sum(0))
        g["va"] = np.einsum("tn,tna->a", ds, act)
        dq = ds[:, :, None] * d["va"] * (1 - act * act)
        g["wa"] = np.einsum("tnh,tna->ha", states, dq)
        dstates = weight[:, :, None] * dp + dq @ d["wa"].T
        dx = np.zeros_like(x)
        for side in (0, 1):
            u, base = d[f"u{side}"], 3 * HIDDEN * side
            carry = np.zeros((size, HIDDEN), np.float32)
            for t in range(steps - 1, -1, -1) if side == 0 else range(steps):
                before, z, r, new, hn = kept[side, t]
                m = mask[t][:, None]
                dh = dstates[t, :, HIDDEN * side:HIDDEN * (side + 1)] + carry
                live = dh * m
                da_n = live * (1 - z) * (1 - new * new)
                da_z = live * (before - new) * z * (1 - z)
                da_r = da_n * hn * r * (1 - r)
                dhu = np.concatenate([da_z, da_r, da_n * r], axis=1)
                g[f"u{side}"] += before.T @ dhu
                carry = live * z + dh * ~m + dhu @ u.T
                dx[t, :, base:base + 3 * HIDDEN] = np.concatenate([da_z, da_r, da_n], axis=1)
        g["wx"] = np.einsum("tnd,tng->dg", x_in, dx)
        g["bx"] = dx.sum((0, 1))
        dvec = np.zeros((len(used), DIM), np.float32)
        np.add.at(dvec, back_ids.ravel(), (dx @ d["wx"].T).reshape(-1, DIM))
        return g, used, dvec

    def some_inputs(self, w: Words, used: np.ndarray) -> np.ndarray:
        out = self.word[w.bucket[used]]
        gram, word = self.grams_of(w, used)
        if len(gram):
            has = np.flatnonzero(np.diff(word, prepend=-1))
            share = w.gram_share[used[word[has]]].astype(np.float32)
            out[word[has]] += np.add.reduceat(self.gram[gram], has, axis=0) * share[:, None]
        return out

    @staticmethod
    def grams_of(w: Words, used: np.ndarray):
        lo, hi = np.searchsorted(w.gram_word, used), np.searchsorted(w.gram_word, used, side="right")
        many = hi - lo
        word = np.repeat(np.arange(len(used)), many)
        return w.grams[np.repeat(lo, many) + np.arange(len(word)) - np.repeat(np.cumsum(many) - many, many)], word


def _log_odds(w: Words, labels: np.ndarray, block: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of label 1 by word row and by n-gram row, from how many texts hold them."""
    held_words, held_grams = np.zeros((2, 1 << WORD_BITS)), np.zeros((2, 1 << GRAM_BITS))
    for lo in range(0, len(labels), block):
        hi = min(lo + block, len(labels))
        text = np.repeat(np.arange(lo, hi), np.diff(w.first[lo:hi + 1]))
        pairs = np.unique(text * len(w.bucket) + w.ids[w.first[lo]:w.first[hi]])
        text, word = pairs // len(w.bucket), pairs % len(w.bucket)
        np.add.at(held_words, (labels[text], w.bucket[word]), 1)
        gram, owner = Network.grams_of(w, word)
        pairs = np.unique(text[owner] << GRAM_BITS | gram)
        np.add.at(held_grams, (labels[pairs >> GRAM_BITS], pairs & ((1 << GRAM_BITS) - 1)), 1)
    totals = np.bincount(labels, minlength=2)
    rate = lambda held, c: 1 + 300 * held[c] / max(1, totals[c])  # noqa: E731  a row that few texts hold says little
    odds = lambda held: np.log(rate(held, 1) / rate(held, 0))
    return odds(held_words), odds(held_grams)


def train(rows: list[tuple[str, int]], seed: int = 11) -> Network:
    rng = np.random.default_rng(seed)
    texts = pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.string())], names=["text"])
    w = merged([words_of(b.column("text")) for b in slices(iter([texts]), "text")])
    labels = np.array([y for _, y in rows])
    text, begin, n = windows_of(w.first)
    normal = lambda *shape: rng.standard_normal(shape).astype(np.float32)
    by_word, by_gram = _log_odds(w, labels)
    net = Network(normal(1 << WORD_BITS, DIM) * 0.05, normal(1 << GRAM_BITS, DIM) * 0.05)
    net.word[:, 0] = np.clip(by_word / 3, -0.5, 2)
    net.gram[:, 1] = np.clip(by_gram / 3, -0.5, 2)
    net.dense = {"wx": normal(DIM, 6 * HIDDEN) * 0.4, "bx": np.zeros(6 * HIDDEN, np.float32), "u0": normal(HIDDEN, 3 * HIDDEN) * 0.3,
                 "u1": normal(HIDDEN, 3 * HIDDEN) * 0.3, "wa": normal(2 * HIDDEN, ATTEND) * 0.3, "va": normal(ATTEND) * 0.3,
                 "w": normal(2 * HIDDEN) * 0.3, "b": np.zeros(1, np.float32)}
    first_moment = {k: np.zeros_like(v) for k, v in net.dense.items()}
    second_moment = {k: np.zeros_like(v) for k, v in net.dense.items()}
    step = 0
    value = np.concatenate([v[:, :2].sum(1) for _, v in net.inputs(w)])
    padded = np.concatenate([value[w.ids], np.full(WINDOW, -9, np.float32)])
    scores = np.full(len(begin), -9, np.float32)
    for k in range(WINDOW):
        np.maximum(scores, np.where(k < n, padded[begin + k], np.float32(-9)), out=scores)
    for _ in range(ROUNDS):
        order = np.lexsort((-scores, text))
        top = order[np.flatnonzero(np.diff(text[order], prepend=-1))]
        more = rng.permutation(len(text))
        more = more[np.unique(text[more], return_index=True)[1]]
        chosen = np.concatenate([top, more[labels[text[more]] == 0]])
        for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(chosen)))):  # small samples take more turns
            rng.shuffle(chosen)
            for lo in range(0, len(chosen), BATCH):
                part = chosen[lo:lo + BATCH]
                part = part[n[part] > 0]
                if not len(part):
                    continue
                g, used, dvec = net.gradients(w, begin[part], n[part], labels[text[part]].astype(np.float32))
                step += 1
                for k, v in net.dense.items():
                    first_moment[k] += 0.1 * (g[k] - first_moment[k])
                    second_moment[k] += 0.01 * (g[k] ** 2 - second_moment[k])
                    v -= (RATE * (first_moment[k] / (1 - 0.9 ** step)) / (np.sqrt(second_moment[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
                np.subtract.at(net.word, w.bucket[used], VECTOR_RATE * dvec)
                gram, word = net.grams_of(w, used)
                np.subtract.at(net.gram, gram, VECTOR_RATE * dvec[word] * w.gram_share[used][word][:, None].astype(np.float32))
        scores = net.logits(w, begin, n)
    best = np.full(len(labels), -np.inf)
    np.maximum.at(best, text, scores)
    cuts = np.sort(best)
    order = np.argsort(best)
    y = labels[order]
    errors = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    least = np.flatnonzero(errors == errors.min())
    k = int(least[len(least) // 2])
    cut = cuts[0] - 1 if k == 0 else cuts[-1] + 1 if k == len(cuts) else (cuts[k - 1] + cuts[k]) / 2
    net.dense["b"] = (net.dense["b"] - np.float32(cut)).astype(np.float32)
    return net


def text_scores(net: Network, column: pa.Array) -> np.ndarray:
    w = words_of(column)
    text, begin, n = windows_of(w.first)
    best = np.full(len(column), -np.inf)
    np.maximum.at(best, text, net.logits(w, begin, n))
    return 1 / (1 + np.exp(-np.clip(best, -60, 60)))


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> Network | None:
    return fit_in_task(sample(docs, labels, "toxic", fold(folds) != held_out, PER_CLASS, MAX_BYTES), train)


def with_score(docs: DataFrame, net: Network | None, out: str = "score") -> DataFrame:
    """``docs`` with a toxicity score from 0 to 1; a column of that name is replaced."""
    if net is None:
        return docs.withColumn(out, F.lit(0.0))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a fixed number of parameters

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        parts = [text_scores(shared.value, b.column("text")) for b in slices(iter([batch]), "text")]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return docs.withColumn(out, scored(F.coalesce(F.col("text"), F.lit(""))))


def score(docs: DataFrame, net: Network | None, threshold: float = 0.5, folds: int = 5, held_out: int = 0) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), net).select(
        "doc_id", (fold(folds) == held_out).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that the model, fitted on ``labels``, doesn't reject, with all columns."""
    scored = with_score(with_row(docs), fit(docs.select("doc_id", "text"), labels))
    return row_again(scored.where(F.col("score") < threshold), docs.columns)
