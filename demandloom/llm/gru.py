"""A small bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the mean of its word embedding and of the embeddings of its
character n-grams, beside the evidence that the training labels give for the word
and for its strongest n-gram. Both directions read a window of words, attention
weighs the states, and their weighted sum gives one logit per window.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Buckets of the evidence of words and n-grams, how many of them share an embedding, and the sizes of an embedding
#: and of a direction's state.
BUCKETS, SHARED, EMBED, STATE = 1 << 18, 16, 6, 8
#: Words whose n-grams are worked on at once.
CHUNK = 1 << 15
#: Lengths of the character n-grams, with a mark on either end of the word.
GRAMS = (3, 4, 5)
INPUT = 2 * EMBED + 3
_MARKS = string.punctuation + "«»“”„‘’…¿¡"
#: Strength of the prior in the evidence of a bucket, in documents.
PRIOR = 4.0


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of the texts, the word at each position, and where each text begins.

    A word is a run between ASCII white space, in lower case and without
    punctuation at its ends.
    """
    lists = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    stripped = pc.utf8_trim(coded.dictionary, characters=_MARKS)
    again = stripped.dictionary_encode()
    inner = again.indices.to_numpy(zero_copy_only=False)
    at = inner[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)
    begins = np.concatenate([[0], np.cumsum(counts)])
    words = again.dictionary
    empty = pc.equal(words, "").to_numpy(zero_copy_only=False) if len(words) else np.zeros(0, bool)
    if empty.any():  # a run of punctuation is no word
        full = ~empty[at]
        begins = np.concatenate([[0], np.cumsum(full)])[begins]
        at = at[full]
        words = pc.if_else(pc.equal(words, ""), "-", words)  # stands nowhere, but has n-grams like every word
    return words, at.astype(np.int64), begins


class Hashed:
    """Buckets of words and of their n-grams; ``grams`` of word i lie between ``cuts[i]`` and ``cuts[i + 1]``."""

    def __init__(self, words: pa.Array) -> None:
        parts = [self._hash(words.slice(first, CHUNK).to_pylist()) for first in range(0, len(words), CHUNK)]
        none = np.zeros(0, np.int32)
        self.word = np.concatenate([none, *[p[0] for p in parts]])
        self.grams = np.concatenate([none, *[p[1] for p in parts]])
        self.cuts = np.concatenate([[0], np.cumsum(np.concatenate([none, *[p[2] for p in parts]]))]).astype(np.int64)

    @classmethod
    def _hash(cls, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of the words, of their n-grams word by word, and how many n-grams each word has."""
        raw = [b"\x02" + w.encode() + b"\x03" for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
        stops = np.cumsum(sizes)
        starts = stops - sizes
        power = np.uint64(0x9E3779B97F4A7C15)
        # the sum of all bytes times their place's power names a word; differences of running sums give it at once
        places = np.arange(len(data)) - np.repeat(starts, sizes)
        weights = np.power(power, np.arange(1, int(sizes.max(initial=0)) + 2, dtype=np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(data * weights[places])])
        word = cls._bucket(sums[stops] - sums[starts])
        every = np.repeat(np.arange(len(raw), dtype=np.int32), sizes)
        kept, owners = [], []
        for n in GRAMS:
            if len(data) < n:
                continue
            value = np.zeros(len(data) - n + 1, np.uint64)
            for i in range(n):
                value = value * np.uint64(1000003) + data[i : i + len(value)]
            owner = every[: len(value)]
            inside = np.arange(n, len(data) + 1) <= stops[owner]
            kept.append(cls._bucket(value[inside] + np.uint64(n)))
            owners.append(owner[inside])
        owner = np.concatenate(owners) if owners else np.zeros(0, np.int32)
        order = np.argsort(owner, kind="stable")
        grams = (np.concatenate(kept) if kept else np.zeros(0, np.int32))[order]
        return word, grams, np.bincount(owner, minlength=len(raw)).astype(np.int32)

    @staticmethod
    def _bucket(value: np.ndarray) -> np.ndarray:
        mixed = value * np.uint64(0xD6E8FEB86659FD93)
        return ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(40)).astype(np.int32) % BUCKETS


def evidence(present: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Log-odds of each bucket against the base rate, from the documents that have it, with a prior.

    Three rows: for any text; for a text that is itself counted as not toxic, and
    for one counted as toxic, each without its own part. Training reads the last
    two, since a document's own rare words would give its label away.
    """
    positive, every = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for buckets, label in zip(present, toxic):
        every[buckets] += 1
        if label:
            positive[buckets] += 1
    base = float(toxic.mean())

    def log_odds(hits: np.ndarray, seen: np.ndarray) -> np.ndarray:
        rate = (np.maximum(hits, 0) + PRIOR * base) / (np.maximum(seen, 0) + PRIOR)
        return np.log(rate / (1 - rate)) - np.log(base / (1 - base))

    rows = [log_odds(positive, every), log_odds(np.minimum(positive, every - 1), every - 1), log_odds(positive - 1, every - 1)]
    return np.stack(rows).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


class Network:
    """The parameters, the forward pass for scoring and the backward pass for training."""

    def __init__(self, word_evidence: np.ndarray, gram_evidence: np.ndarray, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)

        def small(*shape: int) -> np.ndarray:
            return (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.word_evidence, self.gram_evidence = word_evidence, gram_evidence
        self.p = {
            "words": (0.1 * draw.standard_normal((BUCKETS // SHARED, EMBED))).astype(np.float32),
            "grams": (0.1 * draw.standard_normal((BUCKETS // SHARED, EMBED))).astype(np.float32),
            "score": small(2 * STATE) * 0.1, "out": small(2 * STATE), "bias": np.zeros(1, np.float32),
        }
        for side in "fb":
            self.p |= {f"x{side}": small(INPUT, 3 * STATE), f"h{side}": small(STATE, 3 * STATE), f"c{side}": np.zeros(3 * STATE, np.float32)}

    def inputs(self, hashed: Hashed, row: np.ndarray | int = 0) -> np.ndarray:
        """The input of each distinct word; ``row`` says which row of the evidence counts for it."""
        count = len(hashed.word)
        row = np.broadcast_to(np.asarray(row), (count,))
        x = np.zeros((count, INPUT), np.float32)
        x[:, :EMBED] = self.p["words"][hashed.word // SHARED]
        x[:, -3] = self.word_evidence[row, hashed.word]
        for first in range(0, count, CHUNK):
            part = slice(first, min(count, first + CHUNK))
            cuts = hashed.cuts[part.start : part.stop + 1]
            grams, sizes, begins = hashed.grams[cuts[0] : cuts[-1]], np.diff(cuts), cuts[:-1] - cuts[0]
            # every word has at least one n-gram: two marks and a character
            embedded = self.p["grams"][grams // SHARED]
            x[part, EMBED : 2 * EMBED] = np.add.reduceat(embedded, begins, axis=0) / sizes[:, None]
            found = self.gram_evidence[np.repeat(row[part], sizes), grams]
            x[part, -2] = np.maximum.reduceat(found, begins)
            x[part, -1] = np.add.reduceat(found, begins) / sizes
        return x

    def _states(self, entered: np.ndarray, at: np.ndarray, mask: np.ndarray, side: str, keep: bool) -> tuple[np.ndarray, list]:
        """States of one direction at every place of the windows, and what the backward pass needs."""
        rows, width = at.shape
        h, weights = np.zeros((rows, STATE), np.float32), self.p[f"h{side}"]
        gates, new = weights[:, : 2 * STATE], weights[:, 2 * STATE :]
        states, saved = np.zeros((width, rows, STATE), np.float32), []
        for t in range(width) if side == "f" else range(width - 1, -1, -1):
            x = entered[at[:, t]]
            zr = _sigmoid(x[:, : 2 * STATE] + h @ gates)
            z, r = zr[:, :STATE], zr[:, STATE:]
            rh = r * h
            n = np.tanh(x[:, 2 * STATE :] + rh @ new)
            m = mask[:, t : t + 1]
            following = h + m * (1 - z) * (n - h)
            if keep:
                saved.append((t, h, z, r, n))
            h = following
            states[t] = h
        return states, saved

    def logits(self, x: np.ndarray, at: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """One logit per window; ``at`` numbers rows of ``x``, ``mask`` is 0 where a window has no word."""
        states = [self._states(x @ self.p[f"x{s}"] + self.p[f"c{s}"], at, mask, s, False)[0] for s in "fb"]
        both = np.concatenate(states, axis=2)
        return self._pool(both, mask)[0]

    def _pool(self, states: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        scores = np.where(mask.T > 0, states @ self.p["score"], np.float32(-1e9))
        share = np.exp(scores - scores.max(axis=0)) * mask.T
        share /= np.maximum(share.sum(axis=0), np.float32(1e-9))
        pooled = np.einsum("tw,twd->wd", share, states)
        return pooled @ self.p["out"] + self.p["bias"][0], share, pooled

    def gradients(
        self, hashed: Hashed, row: np.ndarray, at: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray,
        draw: np.random.Generator,
    ) -> dict[str, np.ndarray]:
        """Gradients of the weighted mean logistic loss; a random half of the words goes without its embeddings."""
        x = self.inputs(hashed, row)
        kept_words = 2 * (draw.random((len(x), 1)) < 0.5).astype(np.float32)
        x[:, : 2 * EMBED] *= kept_words
        kept = [self._states(x @ self.p[f"x{s}"] + self.p[f"c{s}"], at, mask, s, True) for s in "fb"]
        states = np.concatenate([kept[0][0], kept[1][0]], axis=2)
        logits, share, pooled = self._pool(states, mask)
        d = ((_sigmoid(logits) - y) * weight / weight.sum()).astype(np.float32)
        g = {"out": pooled.T @ d, "bias": d.sum(keepdims=True)}
        d_pooled = d[:, None] * self.p["out"]
        along = np.einsum("twd,wd->tw", states, d_pooled)
        d_score = share * (along - (share * along).sum(axis=0))
        g["score"] = np.einsum("tw,twd->d", d_score, states)
        d_states = share[:, :, None] * d_pooled + d_score[:, :, None] * self.p["score"]
        d_x = np.zeros_like(x)
        for k, side in enumerate("fb"):
            weights = self.p[f"h{side}"]
            gates, new = weights[:, : 2 * STATE], weights[:, 2 * STATE :]
            d_h = np.zeros((at.shape[0], STATE), np.float32)
            d_weights, d_entered = np.zeros_like(weights), np.zeros((len(x), 3 * STATE), np.float32)
            places, parts = [], []
            for t, h, z, r, n in reversed(kept[k][1]):
                d_out = d_h + d_states[t, :, k * STATE : (k + 1) * STATE]
                m = mask[:, t : t + 1]
                d_n = d_out * m * (1 - z) * (1 - n * n)
                d_z = d_out * m * (h - n) * z * (1 - z)
                d_rh = d_n @ new.T
                d_r = d_rh * h * r * (1 - r)
                d_zr = np.concatenate([d_z, d_r], axis=1)
                d_weights[:, : 2 * STATE] += h.T @ d_zr
                d_weights[:, 2 * STATE :] += (r * h).T @ d_n
                d_h = d_out * (1 - m * (1 - z)) + d_rh * r + d_zr @ gates.T
                places.append(at[:, t])
                parts.append(np.concatenate([d_zr, d_n], axis=1))
            place, part = np.concatenate(places), np.concatenate(parts)
            for j in range(3 * STATE):
                d_entered[:, j] = np.bincount(place, part[:, j], minlength=len(x))
            g |= {f"h{side}": d_weights, f"x{side}": x.T @ d_entered, f"c{side}": d_entered.sum(axis=0)}
            d_x += d_entered @ self.p[f"x{side}"].T
        d_x[:, : 2 * EMBED] *= kept_words
        sizes = np.maximum(np.diff(hashed.cuts), 1)
        spread = np.repeat(d_x[:, EMBED : 2 * EMBED] / sizes[:, None], np.diff(hashed.cuts), axis=0)
        g["words"] = np.stack([np.bincount(hashed.word // SHARED, d_x[:, j], minlength=BUCKETS // SHARED) for j in range(EMBED)], axis=1)
        g["grams"] = np.stack([np.bincount(hashed.grams // SHARED, spread[:, j], minlength=BUCKETS // SHARED) for j in range(EMBED)], axis=1)
        return g


class Adam:
    """Adam steps that also shrink the weights a little."""

    def __init__(self, network: Network, rate: float, decay: float) -> None:
        self.network, self.rate, self.decay, self.step = network, rate, decay, 0
        self.mean = {k: np.zeros_like(v) for k, v in network.p.items()}
        self.square = {k: np.zeros_like(v) for k, v in network.p.items()}

    def update(self, gradients: dict[str, np.ndarray]) -> None:
        self.step += 1
        for k, g in gradients.items():
            g = g.astype(np.float32)
            self.mean[k] += np.float32(0.1) * (g - self.mean[k])
            self.square[k] += np.float32(0.01) * (g * g - self.square[k])
            m, v = self.mean[k] / (1 - 0.9**self.step), self.square[k] / (1 - 0.99**self.step)
            self.network.p[k] -= (self.rate * (m / (np.sqrt(v) + 1e-8) + self.decay * self.network.p[k])).astype(np.float32)


def windows(begins: np.ndarray, width: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlapping windows of the texts: first place, number of words and text of each.

    Windows start every ``stride`` words until one reaches the text's end, so every
    word is in one at least; a text without words has one empty window.
    """
    sizes = np.diff(begins)
    counts = 1 + np.maximum(0, -(-(sizes - width) // stride))
    owner = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = begins[:-1][owner] + number * stride
    return first, np.minimum(width, begins[1:][owner] - first), owner


def laid_out(at: np.ndarray, first: np.ndarray, length: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(windows x width) word numbers and their mask."""
    places = first[:, None] + np.arange(width)
    mask = np.arange(width) < length[:, None]
    table = np.zeros(places.shape, np.int32)
    table[mask] = at[places[mask]]
    return table, mask.astype(np.float32)
