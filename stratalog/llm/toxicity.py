"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of its own hashed embedding and the mean of those of its character n-grams, so that unseen
inflections of a known stem are known too. A word of more than 62 characters, as in text without spaces, enters as several
parts, which overlap so that each of its n-grams is in one. Two gated recurrent layers read a window of words in both directions, an
attention layer pools their states, and a logistic unit scores the window. Windows of SPAN words begin at every STRIDE-th
word, so that each overlaps half of the next and any SPAN - STRIDE + 1 neighbours lie together in one; all of them are
scored, and the text's score is its highest window's.

Training: labels say only that a document is toxic, not where. Each epoch scores all windows of the training sample,
takes of a toxic document its highest window and of others their highest ones and one more, and fits those with Adam.
The first embedding component starts from smoothed log-odds of the hashed features, so the first choice isn't blind.
The sample is bounded (TRAIN_TOXIC, TRAIN_CLEAN documents of at most TRAIN_CHARS characters, by a hash order of ids);
rows whose crc32(doc_id) is divisible by 5 are held out. Scores see nothing but the text. One task fits the network, so
that a lost executor only repeats it; the driver sees nothing but the weights, some 7 MB whatever the input.

Defined results: a null or empty text, or one of white space, scores 0; so does every text where the labels do not hold
both classes. A null id is held out of training and reported as not held out. Several labels of a document count as
the highest; each row of docs gives a row, rows that repeat an id or a text included, and an empty table none. Texts of
any length are scored whole. Other columns, whatever their names, play no part in toxicity(), and without_toxic() gives
them back as they are.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalog.functions.shared import released, trimmed
from stratalog.llm._pretokens import readable
from stratalog.llm._words import ROLL_A, ROLL_B, mix

#: The training sample's bounds.
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_CHARS = 1_200, 3_000, 10_000
#: Words of a window and from one window to the next.
SPAN, STRIDE = 32, 16
GRAMS = (3, 4, 5)
WORD_ROWS, GRAM_ROWS, INPUT, HIDDEN, ATTEND = 1 << 16, 1 << 16, 12, 12, 8
EPOCHS, BATCH, RATE = 5, 256, 0.005
#: Steps at least: a small sample is gone over more often.
STEPS = 250
#: Documents' worth of prior in a feature's log-odds; the share of words whose own embedding a training step hides.
SMOOTH, HIDE = 6.0, 0.3
CHECKED = 5
#: Words whose n-grams are held at once, to bound memory.
CHUNK = 16_384
#: Entries of a worker's vocabulary, words scored together, and windows of the training sample scored together: they
#: bound a worker's memory only.
VOCABULARY, TOGETHER, SLAB = 100_000, 50_000, 4_096
#: Characters of a word or of a part, with its marks; parts share so many that no n-gram is lost between them.
PART, SHARED = 64, GRAMS[-1] - 1
_EDGE = ".,;:!?|%&$*#()[]{}<>\"'`~^_=+/\\-"


def _marked(word: str) -> str:
    return f"<{word.lower().strip(_EDGE) or '_'}>"


def words_of(text: str) -> list[str]:
    """The words of a text; one too long for a part as its parts, each behind a space, which no word has."""
    words = text.split()
    if max(map(len, words), default=0) * 2 < PART - 2:  # lower case has at most twice the characters
        return words
    out = []
    for w in words:
        m = _marked(w) if len(w) * 2 >= PART - 2 else ""
        out += [f" {m[i : i + PART]}" for i in range(0, len(m) - SHARED, PART - SHARED)] if len(m) > PART else [w]
    return out


class Features:
    """Rows of distinct words in the two embedding tables; the n-grams of word i are grams[at[i]:at[i + 1]]."""

    def __init__(self, words: list[str]):
        parts = [self._some(words[i : i + CHUNK]) for i in range(0, max(1, len(words)), CHUNK)]
        self.words, self.grams, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.at = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])

    @staticmethod
    def _some(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word rows, n-gram rows and n-gram counts."""
        marked = [w[1:] if w[0] == " " else _marked(w) for w in words]
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        code = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), "<u4").astype(np.uint64) * ROLL_A
        begin = np.cumsum(sizes) - sizes
        place = np.arange(len(code)) - np.repeat(begin, sizes)
        power = np.cumprod(np.full(96, ROLL_B, np.uint64))
        whole = np.add.reduceat(code * power[place], begin) if len(marked) else code
        rows = (mix(whole) % np.uint64(WORD_ROWS)).astype(np.int32)
        counts = np.stack([np.maximum(sizes - n + 1, 0) for n in GRAMS])
        at = np.concatenate([[0], np.cumsum(counts.sum(0))])
        grams = np.empty(at[-1], np.int32)
        offset = at[:-1].copy()
        for n, c in zip(GRAMS, counts, strict=True):
            owner = np.repeat(np.arange(len(marked)), c)
            local = np.arange(len(owner)) - np.repeat(np.cumsum(c) - c, c)
            start = begin[owner] + local
            h = code[start]
            for j in range(1, n):
                h = h * ROLL_B + code[start + j]
            grams[offset[owner] + local] = (mix(h) % np.uint64(GRAM_ROWS)).astype(np.int32)
            offset += c
        return rows, grams, counts.sum(0)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word rows, n-gram rows and n-gram counts of some of the words."""
        n = np.diff(self.at)[rows]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return self.words[rows], self.grams[np.repeat(self.at[:-1][rows], n) + inner], n


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def windows(n: int) -> list[int]:
    """Where windows begin in n words: every STRIDE-th, the last one ending with the text."""
    if n <= 0:
        return []
    last = max(0, n - SPAN)
    return [*range(0, last, STRIDE), last]


class Network:
    """Weights, forward and backward passes, and Adam."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        f = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.word = (rng.standard_normal((WORD_ROWS, INPUT)) * 0.05).astype(np.float32)
        self.gram = (rng.standard_normal((GRAM_ROWS, INPUT)) * 0.05).astype(np.float32)
        self.w = {}
        for d in "fb":
            self.w |= {f"W{d}": f(INPUT, 3 * HIDDEN), f"B{d}": np.zeros(3 * HIDDEN, np.float32), f"U{d}": f(HIDDEN, 3 * HIDDEN)}
        self.w |= {"A": f(2 * HIDDEN, ATTEND), "a": np.zeros(ATTEND, np.float32), "v": f(ATTEND), "o": f(2 * HIDDEN), "c": np.zeros(1, np.float32)}

    def inputs(self, words: np.ndarray, grams: np.ndarray, n: np.ndarray, shown: np.ndarray | None = None) -> np.ndarray:
        """A row of inputs for each of some distinct words, of which only those shown use their own embedding."""
        out = self.word[words] if shown is None else self.word[words] * shown[:, None]
        at = np.concatenate([[0], np.cumsum(n)])
        for i in range(0, len(words), CHUNK):
            j = min(len(words), i + CHUNK)
            out[i:j] += np.add.reduceat(self.gram[grams[at[i] : at[j]]], at[i:j] - at[i], axis=0) / n[i:j, None].astype(np.float32)
        return out

    def gates(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x @ self.w["Wf"] + self.w["Bf"], x @ self.w["Wb"] + self.w["Bb"]

    def forward(self, gf: np.ndarray, gb: np.ndarray, at: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows whose words are rows at of the gate tables; mask is 0 beyond a text's end."""
        n, steps = at.shape
        states, tape = np.empty((steps, n, 2 * HIDDEN), np.float32), []
        for d, table, order in (("f", gf, range(steps)), ("b", gb, range(steps - 1, -1, -1))):
            u, h = self.w[f"U{d}"], np.zeros((n, HIDDEN), np.float32)
            part = slice(0, HIDDEN) if d == "f" else slice(HIDDEN, None)
            for t in order:
                g, hu = table[at[:, t]], h @ u
                zr = _sigmoid(g[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
                z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
                c = np.tanh(g[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
                zm = z * mask[:, t, None]
                if keep:
                    tape.append((d, t, h, z, r, c, hu[:, 2 * HIDDEN :]))
                h = h + zm * (c - h)
                states[t, :, part] = h
        e = np.tanh(states @ self.w["A"] + self.w["a"])
        score = np.where(mask.T > 0, e @ self.w["v"], -1e9)
        score = np.exp(score - score.max(0))
        alpha = score / score.sum(0)
        pooled = (alpha[:, :, None] * states).sum(0)
        logit = pooled @ self.w["o"] + self.w["c"][0]
        return (logit, (states, tape, e, alpha, pooled)) if keep else logit

    def backward(self, at: np.ndarray, mask: np.ndarray, x: np.ndarray, dlogit: np.ndarray, kept) -> tuple[dict, np.ndarray]:
        """Gradients of the weights, and of the input rows x."""
        states, tape, e, alpha, pooled = kept
        grad = {k: np.zeros_like(v) for k, v in self.w.items()}
        grad["o"], grad["c"] = pooled.T @ dlogit, np.array([dlogit.sum()], np.float32)
        dpooled = dlogit[:, None] * self.w["o"]
        dstates = alpha[:, :, None] * dpooled
        dalpha = (states * dpooled).sum(2)
        dscore = alpha * (dalpha - (alpha * dalpha).sum(0))
        grad["v"] = np.tensordot(dscore, e, ((0, 1), (0, 1)))
        de = dscore[:, :, None] * self.w["v"] * (1 - e * e)
        grad["A"], grad["a"] = np.tensordot(states, de, ((0, 1), (0, 1))), de.sum((0, 1))
        dstates = dstates + de @ self.w["A"].T
        dgate = {d: np.zeros((len(x), 3 * HIDDEN), np.float32) for d in "fb"}
        dh, last = None, None
        for d, t, h, z, r, c, hc in reversed(tape):
            if d != last:
                dh, last = np.zeros_like(h), d
            u = self.w[f"U{d}"]
            dh = dh + dstates[t, :, slice(0, HIDDEN) if d == "f" else slice(HIDDEN, None)]
            m = mask[:, t, None]
            dc = dh * z * m * (1 - c * c)
            dz = dh * (c - h) * m * z * (1 - z)
            dr = dc * hc * r * (1 - r)
            dg = np.concatenate([dz, dr, dc], 1)
            dhu = np.concatenate([dz, dr, dc * r], 1)
            np.add.at(dgate[d], at[:, t], dg)
            grad[f"U{d}"] += h.T @ dhu
            dh = dh * (1 - z * m) + dhu @ u.T
        dx = np.zeros_like(x)
        for d in "fb":
            grad[f"W{d}"], grad[f"B{d}"] = x.T @ dgate[d], dgate[d].sum(0)
            dx += dgate[d] @ self.w[f"W{d}"].T
        return grad, dx


def _layout(sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts in a row: positions of each window's words, their mask, and each window's text."""
    starts, owner, begin = [], [], 0
    for i, n in enumerate(sizes):
        own = windows(n)
        starts += [begin + s for s in own]
        owner += [i] * len(own)
        begin += n
    ends = np.cumsum(sizes)
    starts, owner = np.array(starts, np.int64), np.array(owner, np.int64)
    at = starts[:, None] + np.arange(SPAN)
    mask = at < ends[owner][:, None] if len(owner) else np.zeros((0, SPAN), bool)
    return np.where(mask, at, starts[:, None]).astype(np.int32), mask.astype(np.float32), owner


def train(texts: list[str], toxic: list[int], seed: int = 1, epochs: int = EPOCHS) -> Network | None:
    """A network fitted to labelled texts; None unless both classes have a text with words."""
    # every CHECKED-th text of each class is kept for the calibration; of the others only word numbers are kept
    seen, known, ids, fitted, checked = [0, 0], {}, [], [], []
    for t, y in zip(texts, toxic, strict=True):
        seen[y] += 1
        if seen[y] % CHECKED == 0:
            checked.append((t, y))
        elif words := words_of(t):
            ids.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)))
            fitted.append(y)
    label = np.array(fitted, np.float32)
    if not len(label) or label.min() == label.max():
        return None
    net, rng = Network(seed), np.random.default_rng(seed)
    feats = Features(list(known))
    known.clear()
    # log-odds of features by the documents that hold them
    n1, n0 = label.sum(), len(label) - label.sum()
    for table, of in ((net.word, lambda r: feats.words[r]), (net.gram, lambda r: feats.take(r)[1])):
        seen = np.zeros((2, len(table)), np.float32)
        for r, y in zip(ids, label, strict=True):
            seen[int(y), np.unique(of(np.unique(r)))] += 1
        odds = np.log((seen[1] + SMOOTH * n1 / (n1 + n0)) / n1) - np.log((seen[0] + SMOOTH * n0 / (n1 + n0)) / n0)
        table[:, 0] = np.clip(odds / 3, -1, 1.5)
    flat = np.concatenate(ids)
    at, mask, owner = _layout([len(r) for r in ids])
    first = np.searchsorted(owner, np.arange(len(ids)))
    count = np.bincount(owner, minlength=len(ids))
    moment: dict = {}
    step = 0

    def adam(key, value, grad, rows=None):
        m, v = moment.setdefault(key, (np.zeros_like(value), np.zeros_like(value)))
        at_ = slice(None) if rows is None else rows
        m[at_] = 0.9 * m[at_] + 0.1 * grad
        v[at_] = 0.999 * v[at_] + 0.001 * grad * grad
        rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        value[at_] -= rate * m[at_] / (np.sqrt(v[at_]) + 1e-6)

    most = max(1, -(-int((np.minimum(count, np.where(label > 0, 1, 4))).sum()) // BATCH))
    for epoch in range(max(epochs, -(-STEPS // most))):
        if epoch == 0:  # before the network has learned anything, the log-odds choose
            hint = net.inputs(feats.words, feats.grams, np.diff(feats.at))[:, 0][flat]
            score = np.where(mask > 0, hint[at], -9).max(1)
        else:
            score = np.concatenate([_sample_scores(net, feats, flat[at[a : a + SLAB]], mask[a : a + SLAB]) for a in range(0, len(at), SLAB)])
        chosen = []
        for i, (a, n) in enumerate(zip(first, count, strict=True)):
            best = a + np.argsort(-score[a : a + n])[: 1 if label[i] else 3]
            chosen += [best, [] if label[i] else [a + rng.integers(n)]]
        chosen = np.unique(np.concatenate(chosen).astype(np.int64))
        rng.shuffle(chosen)
        for a in range(0, len(chosen), BATCH):
            pick, step = chosen[a : a + BATCH], step + 1
            rows, place = np.unique(flat[at[pick]], return_inverse=True)
            place = place.reshape(len(pick), SPAN)
            words, grams, n = feats.take(rows)
            shown = (rng.random(len(rows)) >= HIDE).astype(np.float32)
            x = net.inputs(words, grams, n, shown)
            logit, kept = net.forward(*net.gates(x), place, mask[pick], keep=True)
            dlogit = ((_sigmoid(logit) - label[owner[pick]]) / len(pick)).astype(np.float32)
            grad, dx = net.backward(place, mask[pick], x, dlogit, kept)
            for k, g in grad.items():
                adam(k, net.w[k], g)
            for key, table, where, dtable in (("word", net.word, words, dx * shown[:, None]), ("gram", net.gram, grams, np.repeat(dx / n[:, None].astype(np.float32), n, axis=0))):
                used, back = np.unique(where, return_inverse=True)
                total = np.zeros((len(used), INPUT), np.float32)
                np.add.at(total, back, dtable)
                adam(key, table, total, used)
    _calibrate(net, [t for t, _ in checked], np.array([y for _, y in checked]))
    return net


def _sample_scores(net: Network, feats: Features, at: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Logits of windows whose words are numbers at of feats; only their own words' gates are held."""
    rows, place = np.unique(at, return_inverse=True)
    return score_windows(net, net.gates(net.inputs(*feats.take(rows))), place.reshape(at.shape), mask)


def _calibrate(net: Network, texts: list[str], toxic: np.ndarray) -> None:
    """Shifts the last bias so that probability 0.5 lies in the middle of the cuts with the fewest errors on texts left out of the fitting."""
    if not len(toxic) or toxic.min() == toxic.max():
        return
    p = np.clip(Scorer(net)(texts), 1e-7, 1 - 1e-7)
    logit = np.log(p / (1 - p))
    order = np.argsort(logit)
    logit, toxic = logit[order], toxic[order]
    missed = np.concatenate([[0], np.cumsum(toxic)]) + (toxic == 0).sum() - np.concatenate([[0], np.cumsum(toxic == 0)])
    best = np.flatnonzero(missed == missed.min())
    edge = lambda i: (max(logit[i - 1], -8) if i else -8, min(logit[i], 8) if i < len(logit) else 8)
    net.w["c"] -= np.float32((edge(best[0])[0] + edge(best[-1])[1]) / 2)


def score_windows(net: Network, gates: tuple[np.ndarray, np.ndarray], at: np.ndarray, mask: np.ndarray, batch: int = 256) -> np.ndarray:
    out = np.empty(len(at), np.float32)
    for a in range(0, len(at), batch):
        out[a : a + batch] = net.forward(*gates, at[a : a + batch], mask[a : a + batch])
    return out


class Scorer:
    """Scores texts; keeps the gate values of the words it has seen."""

    def __init__(self, net: Network):
        self.net, self.row = net, {}
        self.gates = tuple(np.empty((1024, 3 * HIDDEN), np.float32) for _ in "fb")

    def _rows(self, words: list[str]) -> np.ndarray:
        if len(self.row) > VOCABULARY:
            self.row.clear()
        row, before = self.row, len(self.row)
        new = [w for w in dict.fromkeys(words) if w not in row]
        if new:
            row.update(zip(new, range(before, before + len(new)), strict=True))
            while len(row) > len(self.gates[0]):
                self.gates = tuple(np.concatenate([g, np.empty_like(g)]) for g in self.gates)
            f = Features(new)
            for g, values in zip(self.gates, self.net.gates(self.net.inputs(f.words, f.grams, np.diff(f.at))), strict=True):
                g[before : len(row)] = values
        return np.fromiter(map(row.__getitem__, words), np.int32, len(words))

    def __call__(self, texts: Iterable[str]) -> np.ndarray:
        """The highest window's probability of each text; texts are taken one by one."""
        out, part, held = [np.zeros(0)], [], 0
        for t in texts:
            part.append(words_of(t))
            held += len(part[-1])
            if held >= TOGETHER:
                out.append(self._some(part))
                part, held = [], 0
        return np.concatenate([*out, self._some(part)])

    def _some(self, part: list[list[str]]) -> np.ndarray:
        out = np.zeros(len(part))
        full = [i for i, words in enumerate(part) if words]
        if full:
            rows = self._rows([w for i in full for w in part[i]])
            at, mask, owner = _layout([len(part[i]) for i in full])
            best = np.full(len(full), -np.inf)
            np.maximum.at(best, owner, score_windows(self.net, self.gates, rows[at], mask))
            out[full] = _sigmoid(best)
        return out


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")), F.lit(5)) == 0


def training_sample(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN, chars: int = TRAIN_CHARS) -> DataFrame:
    """(text, toxic) of at most so many documents of either class, none of them held out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    near = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text")).where(F.length("text") <= chars)
    # only documents that can be taken count towards the bounds
    known = known.join(near.select("id"), "id", "left_semi")
    order = F.xxhash64("id")
    ids = known.where("toxic = 1").orderBy(order).limit(toxic).union(known.where("toxic = 0").orderBy(order).limit(clean))
    # at most toxic + clean rows
    text = near.join(F.broadcast(ids), "id")
    one = Window.partitionBy("id").orderBy("text")
    return text.withColumn("k", F.row_number().over(one)).where("k = 1").select("id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame) -> Network | None:
    """The network of the bounded sample, fitted by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(x for b in batches for x in zip(*(b.column(c).to_pylist() for c in ("id", "text", "toxic")), strict=True))
        net = train([t for _, t, _ in rows], [y for _, _, y in rows])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)], pa.binary())], ["net"])
        del rows, net
        released()

    found = training_sample(docs, labels).repartition(1).mapInArrow(run, "net binary").first()
    trimmed(docs.sparkSession)
    return pickle.loads(found.net) if found else None


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs (doc_id, text); labels: (doc_id, toxic)."""
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(net.value)
        for batch in batches:
            scores = pa.array(score(batch.column("body")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), scores], ["doc_id", "held_out", "score"])
        del score
        released()

    text = docs.select(F.col("doc_id").cast("long"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("text").cast("binary").alias("body"))
    return text.mapInArrow(run, "doc_id long, held_out boolean, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that score 0.5 or more."""
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(net.value)
        for batch in batches:
            yield batch.filter(pa.array(score(batch.column("text").cast(pa.binary())) < 0.5))
        del score
        released()

    return docs.mapInArrow(run, docs.schema)


def _scorer(net: Network | None):
    """An Arrow array of bodies to scores."""
    if net is None:
        return lambda bodies: np.zeros(len(bodies))
    scorer = Scorer(net)
    return lambda bodies: scorer(readable(b.as_py()) for b in bodies)
