"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

Inputs. Each word is a word vector (by hash of the whole word) joined to the mean of the vectors of its character
3- and 4-grams (by hash, word ends included), so that words never seen are scored by their letters. Letters are
lower-cased and ASCII punctuation and digits are taken off; nothing but the text is an input.

Network. A window of `WORDS` words is read by a gated recurrent unit from each side; attention weighs the states, and the
weighted mean gives the window's logit. Windows start every `STRIDE` words and cover the whole text, so they overlap by
half; a text's logit is the highest of its windows, its score the logistic of that.

Training. Labels belong to texts, not windows: in every round the network scores all windows of the training texts,
then learns from each text's highest windows (and, for label 0, some others at random) with the text's label. For the first
round the windows are chosen by the log-odds of their character 4-grams. The last step moves the output's bias to the
threshold that errs least on the training texts.

Bounds. The driver trains on at most `SAMPLE_TEXTS` labelled texts of each label, taken in the order of a hash of their
ids, and on about `SAMPLE_CHARACTERS` characters of them. No text is left out for the second bound: if they are longer
together, the longest are cut to one common length, at which each gives `STRETCHES` stretches spread evenly over all of
it, so both labels stay. They are read some at a time: what stays in memory are the numbers of their words, their windows
and their distinct words. The weights (under 1 MB)
are shipped with the scoring function; texts are scored where they are read, and no row moves.

Null and wordless texts have no window: their score is that of an empty window. Without rows of both labels the score is
the share of label 1 (0 without any labels). Repeated rows are scored each. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm import staging
from haulage.llm.tokens import slices

WORDS, STRIDE = 24, 12
WORD_BUCKETS, GRAM_BUCKETS = 1 << 14, 1 << 14
WORD_SIZE, GRAM_SIZE, HIDDEN, ATTENTION = 6, 10, 8, 8
INPUT = WORD_SIZE + GRAM_SIZE

SAMPLE_TEXTS = 2_000
SAMPLE_CHARACTERS = 12_000_000
STRETCHES = 8
ROUNDS = 5
#: Windows learned from in a round, about; a small sample is gone through up to twelve times.
EXAMPLES = 12_000
#: Word vectors are learned for words of so many training texts at least, and in each batch left out for a share of
#: them, so that letters must do: rare words would be learned by heart.
WORD_TEXTS, WORD_DROPOUT = 4, 0.5
#: Texts scored at once, by characters: bounds the memory of a task.
SCORED_CHARACTERS = 250_000
#: Windows, and distinct words, whose numbers or vectors are made at once.
WINDOWS_AT_ONCE, WORDS_AT_ONCE = 1 << 14, 1 << 14

#: Bytes of words: ASCII letters and all bytes of other alphabets; the rest parts words.
BYTES = np.array([b if chr(b).isalpha() or b >= 128 else 32 for b in range(256)], np.uint8).tobytes()
POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15 | 1, np.uint64), dtype=np.uint64)
MIX = np.uint64(0xD6E8FEB86659FD93)


def bucket(h: np.ndarray, n: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return (h >> np.uint64(64 - n.bit_length() + 1)).astype(np.int64)


@dataclass
class Batch:
    """The words of some texts: distinct words with their buckets, and every text's words as numbers of these."""

    word: np.ndarray  # bucket of each distinct word
    grams: np.ndarray  # buckets of the grams of all distinct words, one after the other
    gram_starts: np.ndarray  # first gram of each distinct word
    codes: np.ndarray  # distinct word of every word of every text
    text_starts: np.ndarray  # first word of every text, and the number of words
    known: np.ndarray | None = None  # in training: distinct words whose word vectors are used
    hashes: np.ndarray | None = None  # of the distinct words, ascending


def read_words(texts: list[str | None]) -> Batch:
    bodies = [(text or "").lower().encode("utf-8", "replace").translate(BYTES) for text in texts]
    data = np.frombuffer(b"  " + b"   ".join(bodies) + b"    ", np.uint8)
    ends_of_texts = np.cumsum([2 + len(bodies[0])] + [3 + len(body) for body in bodies[1:]])
    in_word = data != 32
    edges = np.diff(in_word.astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
    text_starts = np.r_[0, np.searchsorted(starts, ends_of_texts)]
    if not len(starts):
        none = np.empty(0, np.int64)
        return Batch(none, none, none, none, text_starts, hashes=np.empty(0, np.uint64))
    lengths = ends - starts
    at = np.flatnonzero(in_word)
    inside = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    hashes = np.add.reduceat(data[at].astype(np.uint64) * POWERS[inside % 4096], np.cumsum(lengths) - lengths)
    distinct, first, codes = np.unique(hashes, return_index=True, return_inverse=True)
    # Grams of the distinct words: the three and four bytes around every byte; past the word's end is white space.
    n = lengths[first]
    gram_starts = np.cumsum(n) - n
    here = np.repeat(starts[first] - gram_starts, n) + np.arange(int(n.sum()))
    b0, b1, b2 = (data[here + k].astype(np.uint64) for k in (-1, 0, 1))
    b3 = np.where(b2 == 32, 32, data[here + 2]).astype(np.uint64)
    three = b0 | b1 << np.uint64(8) | b2 << np.uint64(16)
    four = three | b3 << np.uint64(24) | np.uint64(1 << 40)
    grams = np.stack([bucket(three * POWERS[3], GRAM_BUCKETS), bucket(four * POWERS[3], GRAM_BUCKETS)], axis=1).ravel()
    return Batch(bucket(distinct, WORD_BUCKETS), grams, 2 * gram_starts, codes.reshape(-1), text_starts, hashes=distinct)


def read_many(texts: list[str | None]) -> Batch:
    """The same as read_words, which is given some texts at a time: memory follows the words, not the characters."""
    codes, starts, hashes, batches = [np.empty(0, np.int32)], [np.zeros(1, np.int64)], np.empty(0, np.uint64), []
    for a, b in slices(texts, SCORED_CHARACTERS):
        part = read_words(texts[a:b])
        new = np.flatnonzero(~np.isin(part.hashes, hashes))
        hashes = np.concatenate([hashes, part.hashes[new]])  # in the order of their first part
        order = np.argsort(hashes)
        codes.append(order[np.searchsorted(hashes, part.hashes, sorter=order)].astype(np.int32)[part.codes])
        starts.append(starts[-1][-1] + part.text_starts[1:])
        batches.append(subset(part, new))
    grams = np.concatenate([np.empty(0, np.int32), *[part.grams.astype(np.int32) for part in batches]])
    sizes = np.concatenate([np.empty(0, np.int64), *[np.diff(np.r_[part.gram_starts, len(part.grams)]) for part in batches]])
    word = np.concatenate([np.empty(0, np.int64), *[part.word for part in batches]])
    order, place = np.argsort(hashes), np.empty(len(hashes), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    whole = subset(Batch(word, grams, np.cumsum(sizes) - sizes, word[:0], np.zeros(1, np.int64)), order)
    return Batch(whole.word, whole.grams, whole.gram_starts, place[np.concatenate(codes)], np.concatenate(starts), hashes=hashes[order])


def windows(batch: Batch) -> tuple[np.ndarray, np.ndarray]:
    """Codes of every window (-1 behind a text's last word), and the text of each."""
    counts = np.diff(batch.text_starts)
    many = np.maximum(1, -(-(counts - WORDS) // STRIDE) + 1)
    text = np.repeat(np.arange(len(counts)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    codes = np.full((len(text), WORDS), -1, np.int32)
    for at in range(0, len(text), WINDOWS_AT_ONCE):
        some = text[at : at + WINDOWS_AT_ONCE]
        places = (nth[at : at + WINDOWS_AT_ONCE] * STRIDE)[:, None] + np.arange(WORDS)[None, :]
        there = places < counts[some][:, None]
        codes[at : at + WINDOWS_AT_ONCE][there] = batch.codes[(batch.text_starts[:-1][some][:, None] + places)[there]]
    return codes, text


def softsign(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|): the squashing of this network; it is far cheaper than a hyperbolic tangent."""
    return x / (1 + np.abs(x))


def gate(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * softsign(x)


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def slope(gate: np.ndarray) -> np.ndarray:
    """Of a gate, by its value."""
    return 0.5 * (1 - np.abs(2 * gate - 1)) ** 2


def softsign_in_place(x: np.ndarray, spare: np.ndarray) -> None:
    np.abs(x, out=spare)
    spare += 1
    x /= spare


@dataclass
class Network:
    """Weights; direction 0 reads forwards, 1 backwards. Gates are in the order reset, update, new."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(random: np.random.Generator) -> Network:
        normal = lambda *shape, scale: (random.standard_normal(shape) * scale).astype(np.float32)
        return Network(
            {
                "word": np.zeros((WORD_BUCKETS, WORD_SIZE), np.float32),
                "gram": normal(GRAM_BUCKETS, GRAM_SIZE, scale=0.03),
                "inputs": normal(2, INPUT, 3 * HIDDEN, scale=INPUT**-0.5),
                "states": normal(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
                "bias": np.zeros((2, 3 * HIDDEN), np.float32),
                "attend": normal(2 * HIDDEN, ATTENTION, scale=0.3),
                "query": normal(ATTENTION, scale=0.5),
                "out": normal(2 * HIDDEN, scale=0.3),
                "out_bias": np.zeros(1, np.float32),
            }
        )

    def vectors(self, batch: Batch) -> np.ndarray:
        """A row for each distinct word, and a last row of zeros for what lies behind a text."""
        w = self.weights
        rows = np.zeros((len(batch.word) + 1, INPUT), np.float32)
        if len(batch.word):
            rows[:-1, :WORD_SIZE] = w["word"][batch.word]
            if batch.known is not None:
                rows[:-1, :WORD_SIZE][~batch.known] = 0
            ends, counts = np.r_[batch.gram_starts, len(batch.grams)], self.gram_counts(batch)
            for a in range(0, len(batch.word), WORDS_AT_ONCE):
                b = min(a + WORDS_AT_ONCE, len(batch.word))
                sums = np.add.reduceat(w["gram"][batch.grams[ends[a] : ends[b]]], ends[a:b] - ends[a], axis=0)
                rows[a:b, WORD_SIZE:] = sums / counts[a:b, None]
        return rows

    @staticmethod
    def gram_counts(batch: Batch) -> np.ndarray:
        return np.diff(np.r_[batch.gram_starts, len(batch.grams)]).astype(np.float32)

    def logits(self, codes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Logit of each window, in buffers that are used again: the hot loop allocates nothing."""
        w, n, two = self.weights, len(codes), 2 * HIDDEN
        there = np.ascontiguousarray((codes >= 0).T)
        codes = np.where(there, codes.T, np.int64(len(vectors) - 1))
        present = there.astype(np.float32)[:, :, None]
        states = np.empty((WORDS, n, two), np.float32)
        x, s = np.empty((n, 3 * HIDDEN), np.float32), np.empty((n, 3 * HIDDEN), np.float32)
        gates, spare_gates = np.empty((n, two), np.float32), np.empty((n, two), np.float32)
        c, spare = np.empty((n, HIDDEN), np.float32), np.empty((n, HIDDEN), np.float32)
        for way in (0, 1):
            given = vectors @ w["inputs"][way] + w["bias"][way]
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(WORDS) if way == 0 else range(WORDS - 1, -1, -1):
                np.take(given, codes[t], axis=0, out=x, mode="clip")
                np.matmul(h, w["states"][way], out=s)
                np.add(x[:, :two], s[:, :two], out=gates)
                softsign_in_place(gates, spare_gates)
                gates *= 0.5
                gates += 0.5
                np.multiply(gates[:, :HIDDEN], s[:, two:], out=c)
                c += x[:, two:]
                softsign_in_place(c, spare)
                c -= h
                np.subtract(1, gates[:, HIDDEN:], out=spare)
                c *= spare
                c *= present[t]
                h += c
                states[t, :, way * HIDDEN : (way + 1) * HIDDEN] = h
        seen = states.reshape(-1, two) @ w["attend"]
        softsign_in_place(seen, np.empty_like(seen))
        energy = np.where(there, (seen @ w["query"]).reshape(WORDS, n), np.float32(-30.0))
        energy -= energy.max(axis=0)
        np.exp(energy, out=energy)
        energy /= energy.sum(axis=0)
        value = (states.reshape(-1, two) @ w["out"]).reshape(WORDS, n)
        return (energy * value).sum(axis=0) + w["out_bias"][0]

    def traced(self, codes: np.ndarray, vectors: np.ndarray):
        """The same logits with all that learning needs."""
        w, n, there = self.weights, len(codes), codes >= 0
        codes = np.where(there, codes, len(vectors) - 1)
        states, steps = np.zeros((WORDS, n, 2 * HIDDEN), np.float32), []
        for way in (0, 1):
            given = vectors @ w["inputs"][way] + w["bias"][way]
            h = np.zeros((n, HIDDEN), np.float32)
            for t in range(WORDS) if way == 0 else range(WORDS - 1, -1, -1):
                x = given[codes[:, t]]
                s = h @ w["states"][way]
                gates = gate(x[:, : 2 * HIDDEN] + s[:, : 2 * HIDDEN])
                r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
                c = softsign(x[:, 2 * HIDDEN :] + r * s[:, 2 * HIDDEN :])
                steps.append((way, t, h, r, z, c, s[:, 2 * HIDDEN :]))
                h = h + (1 - z) * (c - h) * there[:, t, None]
                states[t, :, way * HIDDEN : (way + 1) * HIDDEN] = h
        seen = softsign(states @ w["attend"])
        energy = np.where(there.T, seen @ w["query"], np.float32(-30.0))
        energy -= energy.max(axis=0)
        share = np.exp(energy)
        share /= share.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", share, states)
        return pooled @ w["out"] + w["out_bias"][0], (codes, there, states, steps, seen, share, pooled)

    def gradients(self, batch: Batch, codes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict:
        """Of the weighted mean logistic loss of some windows; of the two tables, (rows, gradients)."""
        w, vectors = self.weights, self.vectors(batch)
        logit, (codes, there, states, steps, seen, share, pooled) = self.traced(codes, vectors)
        g: dict = {k: np.zeros_like(w[k]) for k in ("inputs", "states", "bias")}
        d_logit = ((logistic(logit) - labels) * weight / weight.sum()).astype(np.float32)
        g["out"], g["out_bias"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * w["out"]
        d_share = np.einsum("nh,tnh->tn", d_pooled, states)
        d_states = share[:, :, None] * d_pooled
        d_energy = share * (d_share - (share * d_share).sum(axis=0)) * there.T
        g["query"] = np.einsum("tn,tna->a", d_energy, seen)
        d_seen = d_energy[:, :, None] * w["query"] * (1 - np.abs(seen)) ** 2
        g["attend"] = np.einsum("tnh,tna->ha", states, d_seen)
        d_states = d_states + d_seen @ w["attend"].T
        d_vectors = np.zeros_like(vectors)
        for way in (1, 0):
            d_h = np.zeros((len(codes), HIDDEN), np.float32)
            d_given = np.zeros((len(vectors), 3 * HIDDEN), np.float32)
            for _, t, h, r, z, c, s_new in reversed([step for step in steps if step[0] == way]):
                d_h = d_h + d_states[t, :, way * HIDDEN : (way + 1) * HIDDEN]
                moved = d_h * there[:, t, None]
                d_c = moved * (1 - z) * (1 - np.abs(c)) ** 2
                d_z = -moved * (c - h) * slope(z)
                d_r = d_c * s_new * slope(r)
                d_x = np.concatenate([d_r, d_z, d_c], axis=1)
                d_s = np.concatenate([d_r, d_z, d_c * r], axis=1)
                g["states"][way] += h.T @ d_s
                np.add.at(d_given, codes[:, t], d_x)
                d_h = d_h - moved * (1 - z) + d_s @ w["states"][way].T
            g["bias"][way] = d_given.sum(axis=0)
            g["inputs"][way] = vectors.T @ d_given
            d_vectors += d_given @ w["inputs"][way].T
        own = slice(None) if batch.known is None else batch.known
        counts = self.gram_counts(batch)
        each = np.repeat(d_vectors[:-1, WORD_SIZE:] / counts[:, None], counts.astype(int), axis=0)
        g["word"] = by_row(batch.word[own], d_vectors[:-1, :WORD_SIZE][own])
        g["gram"] = by_row(batch.grams, each)
        return g

    def score_windows(self, batch: Batch, codes: np.ndarray, at_once: int = 2_048) -> np.ndarray:
        vectors = self.vectors(batch)
        parts = [self.logits(codes[k : k + at_once], vectors) for k in range(0, len(codes), at_once)]
        return np.concatenate(parts) if parts else np.empty(0, np.float32)

    def score_texts(self, texts: list[str | None]) -> np.ndarray:
        """The highest logit of each text's windows."""
        if not texts:
            return np.empty(0)
        batch = read_words(texts)
        codes, text = windows(batch)
        logits = self.score_windows(batch, codes)
        return np.maximum.reduceat(logits, np.searchsorted(text, np.arange(len(texts)))).astype(np.float64)


def first_choice(batch: Batch, codes: np.ndarray, text: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The highest log-odds of a word in each window, words by their most telling gram in the training texts."""
    n_words, n_grams = len(batch.word), np.diff(np.r_[batch.gram_starts, len(batch.grams)])
    word_of_gram = np.repeat(np.arange(n_words), n_grams)
    text_of_word = np.repeat(np.arange(len(labels)), np.diff(batch.text_starts))
    pairs = np.unique(text_of_word * n_words + batch.codes)
    seen = np.zeros((2, n_words))
    np.add.at(seen, (labels[pairs // n_words].astype(int), pairs % n_words), 1)
    per_gram = np.stack([np.bincount(batch.grams, seen[y][word_of_gram], GRAM_BUCKETS) for y in (0, 1)])
    totals = np.array([(labels == 0).sum(), (labels == 1).sum()])[:, None]
    odds = np.log((per_gram[1] + 0.5) / (totals[1] + 1)) - np.log((per_gram[0] + 0.5) / (totals[0] + 1))
    of_word = np.maximum.reduceat(odds[batch.grams], batch.gram_starts) if n_words else np.empty(0)
    return np.r_[of_word, -np.inf][codes].max(axis=1)  # -1: behind the text


def highest(scores: np.ndarray, text: np.ndarray, many: int) -> np.ndarray:
    """The windows with a text's `many` highest scores."""
    order = np.lexsort((-scores, text))
    starts = np.searchsorted(text[order], text[order], side="left")
    return order[np.arange(len(order)) - starts < many]


def train(texts: list[str], labels: np.ndarray, rounds: int = ROUNDS, seed: int = 7) -> Network:
    random = np.random.default_rng(seed)
    network, batch = Network.fresh(random), read_many(texts)
    codes, text = windows(batch)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.weights.items()}
    scores, step = first_choice(batch, codes, text, labels), 0
    owner = np.repeat(np.arange(len(labels)), np.diff(batch.text_starts))
    pairs = np.unique(owner * max(1, len(batch.word)) + batch.codes)
    common = np.bincount(pairs % max(1, len(batch.word)), minlength=len(batch.word)) >= WORD_TEXTS
    for turn in range(rounds):
        one = highest(scores, text, 1 if turn else 2)
        two = highest(scores, text, 3)
        others = random.choice(len(codes), min(len(codes), 3 * len(texts)), replace=False)
        chosen = np.unique(np.r_[one[labels[text[one]] == 1], two[labels[text[two]] == 0], others[labels[text[others]] == 0]])
        target = labels[text[chosen]].astype(np.float32)
        weight = np.where(target == 1, 0.5 / max(1, (target == 1).sum()), 0.5 / max(1, (target == 0).sum()))
        passes = max(1, EXAMPLES // max(1, len(chosen)))
        for _ in range(min(passes, 12)):
            order = random.permutation(len(chosen))
            for at in range(0, len(order), 128):
                some = order[at : at + 128]
                words, inverse = np.unique(codes[chosen[some]], return_inverse=True)
                part = subset(batch, words[words >= 0])
                part.known = common[words[words >= 0]] & (random.random(len(part.word)) >= WORD_DROPOUT)
                local = inverse.reshape(len(some), WORDS) - int(words[0] < 0)
                g = network.gradients(part, local, target[some], weight[some].astype(np.float32))
                step += 1
                adam(network.weights, g, moments, step, rate=0.01 * 0.8**turn)
        scores = network.score_windows(batch, codes)
    top = np.maximum.reduceat(scores, np.searchsorted(text, np.arange(len(texts))))
    network.weights["out_bias"] = network.weights["out_bias"] - np.float32(threshold(top, labels))
    return network


def subset(batch: Batch, words: np.ndarray) -> Batch:
    """The batch with these distinct words only."""
    ends = np.r_[batch.gram_starts, len(batch.grams)]
    n = ends[words + 1] - ends[words]
    starts = np.cumsum(n) - n
    grams = batch.grams[np.repeat(ends[words] - starts, n) + np.arange(int(n.sum()))]
    return Batch(batch.word[words], grams, starts, np.empty(0, np.int64), np.zeros(1, np.int64))


def by_row(rows: np.ndarray, gradients: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a table with the sums of their gradients."""
    order = np.argsort(rows, kind="stable")
    if not len(order):
        return rows, gradients
    first = np.flatnonzero(np.r_[True, np.diff(rows[order]) != 0])
    return rows[order][first], np.add.reduceat(gradients[order], first, axis=0)


def adam(weights, gradients, moments, step: int, rate: float) -> None:
    """One step; of a table only the rows that occur move."""
    for k, g in gradients.items():
        rows, g = g if isinstance(g, tuple) else (slice(None), g)
        m, v = moments[k]
        m[rows] = 0.9 * m[rows] + 0.1 * g
        v[rows] = 0.999 * v[rows] + 0.001 * g * g
        weights[k][rows] -= rate * (m[rows] / (1 - 0.9**step)) / (np.sqrt(v[rows] / (1 - 0.999**step)) + 1e-8)


def threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the gap between neighbouring logits that parts the labels with the fewest errors."""
    order = np.argsort(logits)
    ordered, y = logits[order], labels[order]
    errors = np.r_[0, np.cumsum(y == 1)] + np.r_[np.cumsum((y == 0)[::-1])[::-1], 0]
    best = np.flatnonzero(errors == errors.min())
    cut = best[len(best) // 2]
    low = ordered[max(cut - 1, 0)]
    high = ordered[min(cut, len(ordered) - 1)]
    return float((low + high) / 2)


def held_out(id_column: str) -> Column:
    return F.crc32(F.col(id_column).cast("string")) % 5 == 0


def common_length(lengths: list[int], most: int) -> int:
    """The largest length to which texts can be cut so that they hold `most` characters in all; at least STRETCHES."""
    left, longest = most, max(lengths, default=0)
    for i, n in enumerate(sorted(lengths)):
        share = left // (len(lengths) - i)
        if n > share:
            return max(share, STRETCHES)
        left -= n
    return max(longest, STRETCHES)


def stretches(text: Column, length: int) -> Column:
    """Texts of up to `length` characters as they are; of longer ones STRETCHES parts, from their beginning to their end."""
    part = length // STRETCHES
    gap = (F.length(text) - F.lit(part)).cast("double") / F.lit(float(STRETCHES - 1))
    parts = [F.substring(text, F.floor(gap * i).cast("int") + 1, F.lit(part)) for i in range(STRETCHES)]
    return F.when(F.length(text) <= length, text).otherwise(F.concat_ws("\n", *parts))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic"):
    """Trains on a bounded sample of labelled texts that are not held out; a float (share of label 1) without both labels."""
    known = labels.filter(F.col(label_column).isin(0, 1) & ~held_out(id_column)).select(
        F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"), F.xxhash64(F.lit(11), id_column).alias("h")
    )
    sizes = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        return float(1 in sizes)
    picked = None
    for label in (0, 1):
        some = known.filter(F.col("label") == label).orderBy("h", "id").limit(SAMPLE_TEXTS)
        picked = some if picked is None else picked.union(some)
    rows = (
        docs.select(F.col(id_column).alias("i"), F.col(text_column).alias("text"))
        .join(F.broadcast(picked), F.expr("i = id"))  # at most 2 * SAMPLE_TEXTS rows
        .withColumn("order", F.row_number().over(Window.partitionBy("id").orderBy(F.length("text"), "text")))
        .filter("order = 1 AND text IS NOT NULL")
    )
    rows = staging.staged(rows.select("h", "id", "label", "text"), "toxicity-sample", 2 * SAMPLE_TEXTS)
    length = common_length([r.n for r in rows.select(F.length("text").alias("n")).collect()], SAMPLE_CHARACTERS)
    sample = rows.select("h", "id", "label", stretches(F.col("text"), length).alias("text")).orderBy("h", "id").collect()
    y = np.array([r.label for r in sample], np.int64)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.0
    return train([r.text for r in sample], y)


def scored(docs: DataFrame, model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All columns of docs inside `row`, and score (0 to 1)."""
    carried = docs.select(F.struct(*docs.columns).alias("row"), F.col(text_column).alias("text"))
    if isinstance(model, float):
        return carried.select("row", F.lit(model).alias("score"))
    row_type = carried.schema["row"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = batch.column(1).to_pylist(), []
            for a, b in slices(texts, SCORED_CHARACTERS):
                found.append(model.score_texts(texts[a:b]))
            scores = logistic(np.concatenate(found)) if found else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["row", "score"])

    return carried.mapInArrow(score, f"row {row_type}, score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    rows = docs.select("doc_id", "text")
    model = fit(rows, labels)
    return scored(rows, model).select(
        F.col("row.doc_id").alias("doc_id"),
        held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that are predicted toxic."""
    model = fit(docs.select("doc_id", "text"), labels)
    return scored(docs, model).filter("score < 0.5").select("row.*")
