"""Language of words and documents by a linear-chain conditional random field.

The words of a text (runs of letters) are a chain; each has a language. What a
word says comes from its character n-grams (1 to 3), its affixes (n-grams that
touch its begin or end, up to 3 letters) and a lexicon (the word itself), all
hashed into tables of fixed size with a weight for each language; what its
neighbours say comes from learned transitions. Forward-backward gives every
word's probabilities given the whole text, so a text that switches languages is
labelled word by word; a document has the language with the greatest mean.

Training takes a bounded sample of labelled documents (``SAMPLE_DOCS`` a
language and ``SAMPLE_ALL`` in all, their first ``SAMPLE_CHARS`` characters,
drawn by a hash of doc_id), cuts it into pieces and strings pieces of different languages together, so that transitions
learn what a switch looks like. Prediction reads whole texts. Its recursions
run over blocks of words side by side: the transfer matrices of all blocks
first, then the chain of blocks, then the words inside them, which is the same
result as word after word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import broadcast_if_small, written

#: Bounds of the training sample: documents of a language, of all languages (but
#: ``SAMPLE_LEAST`` of each), characters of a document.
SAMPLE_DOCS, SAMPLE_ALL, SAMPLE_LEAST, SAMPLE_CHARS = 300, 6_000, 5, 20_000
#: Sizes of the hashed tables: n-grams and affixes, words.
GRAMS, LEXICON = 1 << 16, 1 << 17
#: Words in a training sequence, sequences in a step, passes over the sample and
#: steps at least, step size, weight decay.
LENGTH, CHAINS, EPOCHS, LEAST_STEPS, STEP, DECAY = 64, 128, 4, 40, 0.3, 1e-6
#: Words in a block of the recursions; characters handled at a time, about.
BLOCK, CHARS = 32, 1_000_000
UNKNOWN = "und"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class Features:
    """Hashed features of the words of some texts."""

    def __init__(self):
        # letters by code point
        self.letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text of each word, begin of its features, all n-gram features, its lexicon feature."""
        lower = [t.lower() for t in texts]
        joined = " " + " ".join(lower) + " "
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = self.letter[code]
        first = np.zeros(len(code), bool)
        first[:-1] = letter[1:] & ~letter[:-1]  # the place before a word
        at = np.flatnonzero(letter | first)
        z = np.where(letter[at], code[at], 0).astype(np.uint64)
        begins = np.flatnonzero(z == 0)
        ends_of_texts = np.cumsum([len(t) + 1 for t in lower])
        text = np.searchsorted(ends_of_texts, at[begins], side="right")
        # each word is a 0 and its letters; the next word's 0 ends it
        pad = np.concatenate([z, np.zeros(4, np.uint64)])
        n = len(z)
        a, b, c, d = pad[:n], pad[1:n + 1], pad[2:n + 2], pad[3:n + 3]
        two = a * np.uint64(0x1F1F1F1F1) + b
        three = two * np.uint64(0x1F1F1F1F1) + c
        four = three * np.uint64(0x1F1F1F1F1) + d
        grams = np.empty((n, 4), np.int64)
        for k, (h, valid) in enumerate((
                (a, a > 0), (two, np.ones(n, bool)), (three, b > 0),
                (four, (b > 0) & (c > 0) & ((a == 0) | (d == 0))))):
            hashed = _mix(h * np.uint64(4) + np.uint64(k)) % np.uint64(GRAMS - 1)
            grams[:, k] = np.where(valid, hashed.astype(np.int64) + 1, 0)  # feature 0 weighs nothing
        if len(begins):
            place = np.arange(n) - np.repeat(begins, np.diff(np.append(begins, n)))
            whole = np.add.reduceat(_mix(z * np.uint64(0x1F1F1F1F1) + place.astype(np.uint64)), begins)
            words = (_mix(whole) % np.uint64(LEXICON)).astype(np.int64)
        else:
            words = np.zeros(0, np.int64)
        return text, begins, grams, words


@dataclass
class Model:
    labels: list[str]
    grams: np.ndarray
    lexicon: np.ndarray
    transitions: np.ndarray

    def emissions(self, begins: np.ndarray, grams: np.ndarray, words: np.ndarray) -> np.ndarray:
        if not len(begins):
            return np.zeros((0, len(self.labels)), np.float32)
        each = self.grams[grams[:, 0]]
        for k in range(1, 4):
            each += self.grams[grams[:, k]]
        return np.add.reduceat(each, begins, axis=0) + self.lexicon[words]


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def marginals(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probabilities of each word's labels by forward-backward.

    ``scores`` are the emissions (log) of chains one after another, ``sizes``
    their lengths, none of them 0; the first word of a chain has no transition.
    """
    n, k = scores.shape
    blocks = -(-sizes // BLOCK)
    n_blocks, first_block = int(blocks.sum()), np.cumsum(blocks) - blocks
    inside = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row, col = np.repeat(first_block, sizes) + inside // BLOCK, inside % BLOCK
    e = np.ones((n_blocks, BLOCK, k))
    e[row, col] = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-30
    used = np.zeros((n_blocks, BLOCK), bool)
    used[row, col] = True
    a = np.exp(transitions - transitions.max())
    starts = np.zeros(n_blocks, bool)
    starts[first_block] = True

    product = np.broadcast_to(np.eye(k), (n_blocks, k, k)).copy()
    for t in range(BLOCK):
        on = used[:, t]
        step = product[on] @ a
        if t == 0:
            step[starts[on]] = 1.0  # whatever came before, the first word has its emission alone
        step *= e[on, t][:, None, :]
        product[on] = step / step.max(axis=(1, 2), keepdims=True)

    enter, leave = np.empty((n_blocks, k)), np.empty((n_blocks, k))
    order = np.argsort(-blocks, kind="stable")
    alpha, beta = np.full((len(sizes), k), 1.0 / k), np.ones((len(sizes), k))
    for j in range(int(blocks.max())):
        on = order[:np.searchsorted(-blocks[order], -j, side="left")]
        enter[first_block[on] + j] = alpha[on]
        alpha[on] = _normal(np.einsum("bi,bij->bj", alpha[on], product[first_block[on] + j]))
    for j in range(int(blocks.max()) - 1, -1, -1):
        on = order[:np.searchsorted(-blocks[order], -j, side="left")]
        leave[first_block[on] + j] = beta[on]
        beta[on] = _normal(np.einsum("bij,bj->bi", product[first_block[on] + j], beta[on]))

    forward, back = np.empty((n_blocks, BLOCK, k)), np.empty((n_blocks, BLOCK, k))
    now = enter
    for t in range(BLOCK):
        step = now @ a
        if t == 0:
            step[starts] = 1.0
        now = np.where(used[:, t, None], _normal(step * e[:, t]), now)
        forward[:, t] = now
    now = leave
    for t in range(BLOCK - 1, -1, -1):
        back[:, t] = now
        now = np.where(used[:, t, None], _normal((now * e[:, t]) @ a.T), now)
    return _normal(forward[row, col] * back[row, col])


def train(texts: list[str], languages: list[str], features: Features) -> Model:
    """Fit by stochastic gradient with step sizes by feature (AdaGrad)."""
    labels = sorted(set(languages))
    k, rng = len(labels), np.random.default_rng(7)
    text, begins, grams, words = features(texts)
    label = np.array([labels.index(x) for x in languages])[text] if len(text) else np.zeros(0, int)
    ends = np.append(begins, len(grams))[1:]
    model = Model(labels, np.zeros((GRAMS, k), np.float32), np.zeros((LEXICON, k), np.float32),
                  np.zeros((k, k), np.float32))
    seen = [np.full(x.shape, 1e-2, np.float32) for x in (model.grams, model.lexicon, model.transitions)]
    # pieces of 8 to 40 words, strung together in a random order
    pieces, i = [], 0
    bounds = np.flatnonzero(np.append(True, text[1:] != text[:-1])) if len(text) else []
    for b, e in zip(bounds, [*bounds[1:], len(text)]):
        i = b
        while i < e:
            j = min(e, i + int(rng.integers(8, 41)))
            pieces.append((i, j))
            i = j
    whole = len(text) // LENGTH  # a last, shorter sequence trains too
    steps = -(-whole // CHAINS) + (len(text) % LENGTH > 0)
    for _ in range(max(EPOCHS, -(-LEAST_STEPS // max(1, steps))) if k > 1 and steps else 0):
        mixed = np.concatenate([np.arange(*pieces[p]) for p in rng.permutation(len(pieces))])
        for begin in range(0, whole, CHAINS):
            chains = mixed[begin * LENGTH:min(begin + CHAINS, whole) * LENGTH].reshape(-1, LENGTH)
            _step(model, seen, chains, begins, ends, grams, words, label)
        if len(rest := mixed[whole * LENGTH:]):
            _step(model, seen, rest.reshape(1, -1), begins, ends, grams, words, label)
    return model


def _step(model: Model, seen: list[np.ndarray], chains: np.ndarray, begins: np.ndarray, ends: np.ndarray,
          grams: np.ndarray, words: np.ndarray, label: np.ndarray) -> None:
    flat, k = chains.ravel(), len(model.labels)
    size = ends[flat] - begins[flat]
    feature = np.repeat(begins[flat] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    owner = np.repeat(np.arange(len(flat)), size)
    used = grams[feature]
    scores = model.emissions(np.cumsum(size) - size, used, words[flat]).reshape(*chains.shape, k).astype(np.float64)
    e = np.exp(scores - scores.max(axis=2, keepdims=True)) + 1e-30
    a = np.exp(model.transitions - model.transitions.max()).astype(np.float64)
    n, length = chains.shape
    forward, back = np.empty((n, length, k)), np.empty((n, length, k))
    forward[:, 0] = _normal(e[:, 0])
    for t in range(1, length):
        forward[:, t] = _normal((forward[:, t - 1] @ a) * e[:, t])
    back[:, -1] = 1.0
    for t in range(length - 2, -1, -1):
        back[:, t] = _normal((back[:, t + 1] * e[:, t + 1]) @ a.T)
    gold = label[chains]
    error = _normal(forward * back)
    pair = forward[:, :-1, :, None] * a * (back[:, 1:] * e[:, 1:])[:, :, None, :]
    expected = (pair / pair.sum(axis=(2, 3), keepdims=True)).sum(axis=(0, 1))
    observed = np.bincount((gold[:, :-1] * k + gold[:, 1:]).ravel(), minlength=k * k).reshape(k, k)
    np.put_along_axis(error, gold[:, :, None], np.take_along_axis(error, gold[:, :, None], 2) - 1, 2)
    error = error.reshape(-1, k)
    for table, sums, at, of in ((model.grams, seen[0], used.ravel(), np.repeat(owner, 4)),
                                (model.lexicon, seen[1], words[flat], np.arange(len(flat)))):
        for y in range(k):
            g = np.bincount(at, error[of, y], minlength=len(table)).astype(np.float32) + DECAY * table[:, y]
            sums[:, y] += g * g
            table[:, y] -= STEP * g / np.sqrt(sums[:, y])
    model.grams[0] = 0
    g = (expected - observed).astype(np.float32)
    seen[2] += g * g
    model.transitions -= STEP * g / np.sqrt(seen[2])


def remainder(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 3; of the empty text for null."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def learned(docs: DataFrame) -> Model | None:
    """A model from the sample of labelled rows outside the held-out third; None without any."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder(F.col("doc_id")) != 1)).select(
        F.col("lang").cast("string").alias("lang"), F.substring("text", 1, SAMPLE_CHARS).alias("text"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_key"))
    counts = written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")), "languages")
    share = max(SAMPLE_LEAST, min(SAMPLE_DOCS, SAMPLE_ALL // max(1, counts.count())))
    # about twice the sample by the hash, then the first of those in its order
    drawn = rows.join(broadcast_if_small(counts), "lang").where(
        F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") * F.col("_n") <= 2 * share * float(2 ** 32))
    first = Window.partitionBy("lang").orderBy("_key", "text")
    sample = (drawn.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= share)
              .orderBy("lang", "_rank").select("text", "lang").collect())
    if not sample:
        return None
    return train([r.text for r in sample], [r.lang for r in sample], Features())


class Labeller:
    """Word probabilities of texts under a model."""

    def __init__(self, model: Model):
        self.model, self.features = model, Features()

    def _scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text, begins, grams, words = self.features(texts)
        return text, self.model.emissions(begins, grams, words)

    def _long(self, text: str) -> np.ndarray:
        """Emissions of a text that is read in parts; cuts lie outside words."""
        out, begin = [], 0
        while begin < len(text):
            end = min(len(text), begin + CHARS)
            while end < len(text) and text[end].isalpha():
                end += 1
            out.append(self._scores([text[begin:end]])[1])
            begin = end
        return np.concatenate(out)

    def words(self, texts: list[str]) -> Iterator[tuple[int, np.ndarray]]:
        """(index of a text, probabilities of its words) of the texts with a letter."""
        begin = 0
        while begin < len(texts):
            end, size = begin, 0
            while end < len(texts) and (end == begin or size + len(texts[end]) <= CHARS):
                size += len(texts[end])
                end += 1
            if size > CHARS:
                scores, sizes = self._long(texts[begin]), None
                of, sizes = np.array([0]), np.array([len(scores)])
            else:
                text, scores = self._scores(texts[begin:end])
                of, sizes = np.unique(text, return_counts=True)
            if len(scores):
                p = marginals(scores.astype(np.float64), sizes, self.model.transitions.astype(np.float64))
                stops = np.cumsum(sizes)
                for i, stop, n in zip(of, stops, sizes):
                    yield begin + int(i), p[stop - n:stop]
            begin = end


def identified(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, switches.

    ``score`` is the mean probability of the predicted language over the words,
    ``switches`` the number of places where the likeliest language changes from
    a word to the next. Null texts and texts without a letter are ``und`` with
    score 0, as is every text where nothing was there to learn from. Repeated
    rows are rows of their own; of equal means the first language in order wins.
    """
    # a list and arrays of fixed size: an object of this module could not be read by workers without the package
    shipped = docs.sparkSession.sparkContext.broadcast(
        model and (model.labels, model.grams, model.lexicon, model.transitions))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(Model(*shipped.value)) if shipped.value else None
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = [t or "" for t in part.column(2).to_pylist()]
                found = [(UNKNOWN, 0.0, 0)] * len(texts)
                for i, p in labeller.words(texts) if labeller else ():
                    mean, best = p.mean(axis=0), p.argmax(axis=1)
                    y = int(mean.argmax())
                    found[i] = (labeller.model.labels[y], min(1.0, float(mean[y])), int((best[1:] != best[:-1]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *map(pa.array, zip(*found))],
                    ["doc_id", "held_out", "lang_pred", "score", "switches"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id")) == 1).alias("held_out"),
                       "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, switches long")
