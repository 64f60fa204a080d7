"""Problem 10: the subjects of each document.

A sentence is the mean of its words' vectors, a word the mean of the vectors of itself and its letter n-grams; each subject has
an independent logistic output on top. Training goes in rounds: each partition makes a few steps over its sentences from the
common model, and the changes, weighted by sentences, are averaged. A first model learns from the labelled texts. The whole corpus then
votes on words: a word belongs to a subject if the sentences that hold it have that subject, first by the model's
confident scores, then by their other words. Sentences with two words of one subject, and with one or none,
are the labelled examples of the final model, which scores every sentence of every document.

The corpus is cut into words once, in numpy over code points: a document becomes the 64-bit hashes of its words and the lengths of its
sentences. All votes and labels are array operations over the hashes; the spelling of a word is looked at only when its vector is
made for the first time in a task.

A document deals with a subject if ``MIN_SENTENCES`` of its sentences do. NULL, empty and blank texts give no row. A ``doc_id`` that
occurs several times is one document.

Bounds: the labelled texts and the examples of the final model are bounded samples by hash (``MAX_LABELLED``, ``PER_LABEL``,
``PER_NONE``), so training has the same size on any corpus and ``PARTITIONS`` parts are enough for it. Word counts, votes and scores
cover all words of all documents. The table of the subjects' words goes to the tasks as sorted hashes if it is within the bound for
broadcasts; a larger one is joined by shuffle.
"""

from __future__ import annotations

import functools
import io
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm.chars import BMP, canonical, decode, encode, low, ramp, row_hash, rows_of, tables
from broadsheet.llm.features import MONTHS, NUMBER_WORDS, PAGE_WORDS
from broadsheet.session import BROADCAST_LIMIT, ship, write_shared

MIN_SENTENCES = 2
#: A sentence deals with a subject from this probability on.
THRESHOLD = 0.5
#: Confidence from which a sentence lends its subject to its words.
CONFIDENT = 0.8
FEATURES, WIDTH, STEP, DECAY = 1 << 15, 24, 0.05, 1e-5
#: Rounds of training, and the steps of each partition in a round.
SEED_ROUNDS, ROUNDS, LOCAL_STEPS, PARTITIONS = 8, 12, 5, 4
NGRAMS = (3, 4, 5)
#: By so much running means of gradients are multiplied before they are sent in half precision.
HALF = 4096.0
#: Bounds of the training set: labelled texts, sentences of each subject and of none.
MAX_LABELLED, PER_LABEL, PER_NONE = 20_000, 500, 3000
#: A word is a subject's if so many sentences of the subject hold it, at this share of all its sentences with a subject, and this
#: many times as often as any sentence is the subject's; the shares of all its sentences it needs in the rounds of voting.
WORD_COUNT, WORD_PURITY, WORD_LIFT, WORD_SHARES = 5, 0.8, 3, (0.05, 0.5, 0.5)
#: A word of the labelled texts of so many subjects is no subject's.
COMMON_SUBJECTS = 3

# Abbreviations after which a full stop ends no sentence; signs that may stand between a full stop and the space after it.
ABBREVIATIONS = ["mr", "mrs", "m", "mme", "nr", "no", "st", "dr", "hr", "fr", "thlr", "sgr"]
CLOSING = "\"“”»«')]"
OPENING = "(„»\""
HYPHENS = "-¬⸗=‐"


@functools.cache
def signs() -> np.ndarray:
    """Of each character of the basic plane: 1 hyphen, 2 space, 4 closing sign, 8 end of a sentence, 16 opening sign."""
    out = np.zeros(BMP, np.uint8)
    for bit, chars in ((1, HYPHENS), (2, " \n\r"), (4, CLOSING), (8, ".!?"), (16, OPENING)):
        out[[ord(c) for c in chars]] |= bit
    return out


def hashes(words: list[str]) -> np.ndarray:
    """64-bit hashes of words, the same in every process."""
    return row_hash(*decode(pa.array(words, pa.string())))


class Cut:
    """The words and sentences of a batch of texts.

    A word is a run of letters, a hyphen at a line end inside it taken out. A sentence ends at a full stop, question or
    exclamation mark with a space and a capital after it (not after an abbreviation), and at an empty line.
    """

    def __init__(self, texts: pa.Array):
        t = tables()
        cps, offs, _ = canonical(*decode(texts))
        row = rows_of(offs)
        cps, row = self.joined(cps, row)
        n = len(cps)
        ix = low(cps)
        lower = t["lower"][ix].astype(np.uint32)
        letter = t["letter"][ix]
        same = np.concatenate((row[1:] == row[:-1], [False])) if n else np.zeros(0, bool)
        begin = letter.copy()
        begin[1:] &= ~(letter[:-1] & same[:-1])
        end = letter.copy()
        end[:-1] &= ~(letter[1:] & same[:-1])
        first, last = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.row, size = row[first], last - first
        self.hash = row_hash(lower[letter], np.concatenate(([0], np.cumsum(size))))
        self.first, self.size, self.lower = first, size, lower
        # a boundary is a place between two words
        edges = self.boundaries(cps, row, letter, t["digit"][ix], lower)
        before = np.searchsorted(edges, first, "right")
        new = np.ones(len(first), bool)
        new[1:] = (before[1:] != before[:-1]) | (self.row[1:] != self.row[:-1])
        #: where each sentence begins among the words
        self.starts = np.flatnonzero(new)
        self.rows = len(offs) - 1

    @staticmethod
    def joined(cps: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without hyphens, line ends and spaces inside a word that is broken at a line end."""
        at = np.flatnonzero(cps[1:] == 10)
        at = at[(signs()[low(cps[at])] & 1) > 0]
        if not len(at):
            return cps, row
        t = tables()
        ix = low(cps)
        word = t["letter"][ix] | t["digit"][ix]
        solid = np.flatnonzero((signs()[ix] & 2) == 0)
        nxt = np.searchsorted(solid, at + 1)
        ok = (at > 0) & (nxt < len(solid))
        at, nxt = at[ok], solid[nxt[ok]]
        ok = word[at - 1] & word[nxt] & (row[at - 1] == row[at]) & (row[nxt] == row[at])
        at, nxt = at[ok], nxt[ok]
        keep = np.ones(len(cps), bool)
        keep[np.repeat(at, nxt - at) + ramp(nxt - at)] = False
        return cps[keep], row[keep]

    def boundaries(self, cps: np.ndarray, row: np.ndarray, letter: np.ndarray, digit: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Places before which a sentence has ended, in order."""
        n = len(cps)
        if not n:
            return np.zeros(0, int)
        sign = signs()[low(cps)]
        space = (sign & 2) > 0
        stop = np.flatnonzero(sign & 8)
        solid = np.flatnonzero((sign & 4) == 0)
        q = np.searchsorted(solid, stop + 1)
        stop, q = stop[q < len(solid)], q[q < len(solid)]
        q = solid[q]
        ok = space[q] & (row[q] == row[stop])
        stop, q = stop[ok], q[ok]
        word = np.flatnonzero(letter | digit)
        w = np.searchsorted(word, q)
        stop, w = stop[w < len(word)], word[w[w < len(word)]]
        capital = letter[w] & ~((lower[w] == cps[w]) & (cps[w] < 0x250)) & (row[w] == row[stop])
        stop = stop[capital]
        # the word that ends right before a full stop
        k = np.searchsorted(self.first + self.size, stop)
        k = np.minimum(k, len(self.first) - 1) if len(self.first) else np.zeros(len(stop), int)
        if len(stop) and len(self.first):
            short = (cps[stop] == 46) & (self.first[k] + self.size[k] == stop) & np.isin(self.hash[k], hashes(ABBREVIATIONS))
            ahead = np.maximum(self.first[k] - 1, 0)
            alone = (self.first[k] == 0) | (row[ahead] != row[stop]) | space[ahead] | ((sign[ahead] & 16) > 0)
            stop = stop[~(short & alone)]
        # two line ends with nothing between them
        lines = np.flatnonzero(cps == 10)
        black = np.cumsum(~space)
        empty = lines[1:][(black[lines[1:]] == black[lines[:-1]]) & (row[lines[1:]] == row[lines[:-1]])] if len(lines) > 1 else lines[:0]
        return np.sort(np.concatenate((stop, empty)))

    def words(self) -> list[str]:
        take = np.repeat(self.first, self.size) + ramp(self.size)
        big, ends = self.lower[take].astype("<u4").tobytes(), np.concatenate(([0], np.cumsum(self.size))).tolist()
        return [big[4 * a : 4 * b].decode("utf-32-le") for a, b in zip(ends[:-1], ends[1:])]

    def sentences(self) -> list[list[str]]:
        """Words of each sentence of all rows."""
        words, at = self.words(), [*self.starts.tolist(), len(self.first)]
        return [words[a:b] for a, b in zip(at[:-1], at[1:])]


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence of a text."""
    return Cut(pa.array([text], pa.string())).sentences()


BASIS, PRIME = np.uint64(0xCBF29CE484222325), np.uint64(0x100000001B3)


def ids_of(h: np.ndarray) -> np.ndarray:
    return ((h ^ h >> np.uint64(31)) % np.uint64(FEATURES)).astype(np.int64)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed ids of each word and of its letter n-grams, word by word; number of ids of each): the same in every process."""
    cps, offs = decode(pa.array(words, pa.string()))
    n, size = len(words), np.diff(offs)
    wide = cps.astype(np.uint64)
    with np.errstate(over="ignore"):
        whole = np.full(n, BASIS ^ np.uint64(1))
        live = np.flatnonzero(size > 0)
        k = 0
        while len(live):
            whole[live] = (whole[live] ^ wide[offs[live] + k]) * PRIME
            k += 1
            live = live[size[live] > k]
        # n-grams of <word>
        framed = np.full(len(cps) + 2 * n, ord(">"), np.uint64)
        start = offs[:-1] + 2 * np.arange(n)
        framed[start] = ord("<")
        framed[np.repeat(start + 1 - offs[:-1], size) + np.arange(len(cps))] = wide
        ids, owner = [ids_of(whole)], [np.arange(n)]
        for g in NGRAMS:
            count = np.maximum(size + 3 - g, 0)
            at = np.repeat(start, count) + ramp(count)
            h = np.full(len(at), BASIS ^ np.uint64(2))
            for k in range(g):
                h = (h ^ framed[at + k]) * PRIME
            ids.append(ids_of(h))
            owner.append(np.repeat(np.arange(n), count))
    owner = np.concatenate(owner)
    return np.concatenate(ids)[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=n)


class Model:
    def __init__(self, subjects: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.subjects = subjects
        self.words = rng.normal(0, 0.1, (FEATURES, WIDTH)).astype(np.float32)
        self.out = np.zeros((WIDTH, len(subjects)), np.float32)
        self.bias = np.full(len(subjects), -2.0, np.float32)

    def parts(self) -> list[np.ndarray]:
        return [self.words, self.out, self.bias]


class Packed:
    """Sentences as flat arrays: the features of each distinct word, and the words of each sentence."""

    def __init__(self, texts: list[list[str]]):
        place: dict[str, int] = {}
        tokens = np.array([place.setdefault(w, len(place)) for words in texts for w in words], np.int64)
        self.ids, size = features(list(place))
        self.word_start, self.word_size = np.cumsum(size) - size, size.astype(np.float32)
        length = np.array([len(x) for x in texts], np.int64)
        self.tokens, self.start, self.length = tokens, np.cumsum(length) - length, length.astype(np.float32)
        # orders for the way back
        self.by_word = np.argsort(tokens, kind="stable")
        self.word_first = np.flatnonzero(np.append(True, np.diff(tokens[self.by_word]) > 0)) if len(tokens) else np.zeros(0, int)
        self.owner = np.repeat(np.arange(len(texts)), length)
        self.by_id = np.argsort(self.ids, kind="stable")
        self.touched, self.id_first = np.unique(self.ids[self.by_id], return_index=True)
        self.id_word = np.repeat(np.arange(len(size)), size)

    def vectors(self, table: np.ndarray) -> np.ndarray:
        words = np.add.reduceat(table[self.ids], self.word_start, axis=0) / self.word_size[:, None]
        return np.add.reduceat(words[self.tokens], self.start, axis=0) / self.length[:, None]


def gradients(model: Model, x: Packed, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(gradients of the touched features, of the outputs, of the bias, loss)."""
    mean = x.vectors(model.words)
    p = 1 / (1 + np.exp(-(mean @ model.out + model.bias)))
    error = p - labels
    back = (error @ model.out.T) / x.length[:, None]
    words = np.add.reduceat(back[x.owner[x.by_word]], x.word_first, axis=0) / x.word_size[:, None]
    dense = np.add.reduceat(words[x.id_word[x.by_id]], x.id_first, axis=0)
    loss = -float((labels * np.log(p + 1e-7) + (1 - labels) * np.log(1 - p + 1e-7)).sum())
    return dense, mean.T @ error, error.sum(0), loss


class Moments:
    """Running means of the gradients and of their squares, the latter one for each feature and one for each output weight. Rounds average them."""

    def __init__(self, model: Model):
        self.n, self.first = 0, [np.zeros_like(p) for p in model.parts()]
        self.square = [np.zeros(FEATURES, np.float32), np.zeros_like(model.out), np.zeros_like(model.bias)]


def local_steps(model: Model, moments: Moments, x: Packed, labels: np.ndarray, steps: int) -> list[np.ndarray]:
    """What ``steps`` steps over ``x`` make of the touched features, the outputs and the bias, of their first moments and of the squares."""
    at, count = x.touched, len(labels)
    small = Model.__new__(Model)
    small.words, small.out, small.bias = model.words.copy(), model.out.copy(), model.bias.copy()
    first = [moments.first[0][at], moments.first[1].copy(), moments.first[2].copy()]
    square = [moments.square[0][at], moments.square[1].copy(), moments.square[2].copy()]
    for k in range(moments.n + 1, moments.n + 1 + steps):
        dense, out, bias, _ = gradients(small, x, labels)
        rows = small.words[at]
        step = []
        for m, v, g, s in zip(first, square, [dense / count + DECAY * rows, out / count, bias / count], [lambda g: (g * g).mean(1), np.square, np.square]):
            m += 0.1 * (g - m)
            v += 0.01 * (s(g) - v)
            root = np.sqrt(v / (1 - 0.99**k)) + 1e-6
            step.append(STEP * (m / (1 - 0.9**k)) / (root[:, None] if v.ndim < m.ndim else root))
        small.words[at] = rows - step[0]
        small.out -= step[1]
        small.bias -= step[2]
    return [small.words[at], small.out, small.bias, *first, *square]


# ---------------------------------------------------------------------------------------------------------------------
# Training: steps of partitions, one average a round.

ARRAYS = ["ids", "word_start", "word_size", "tokens", "start", "length", "by_word", "word_first", "owner", "by_id", "touched", "id_first", "id_word"]


def pack(rows: DataFrame, width: int) -> DataFrame:
    """(part): each partition of ``rows`` as one set of arrays, written to the shared folder, so that no round packs it again."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(frames), ignore_index=True)
        if len(frame):
            labels = np.zeros((len(frame), width), np.float32)
            label = frame["label"].to_numpy()
            labels[np.flatnonzero(label >= 0), label[label >= 0]] = 1
            x, data = Packed([w.split(" ") for w in frame["words"]]), io.BytesIO()
            np.savez(data, labels=labels, **{k: getattr(x, k) for k in ARRAYS})
            yield pd.DataFrame({"part": [data.getvalue()]})

    # the same rows in the same partitions on any cluster
    placed = rows.repartitionById(PARTITIONS, F.pmod(F.xxhash64("words", "label"), F.lit(PARTITIONS)).cast("int")).sortWithinPartitions("label", "words")
    return write_shared(placed.mapInPandas(run, "part binary"), "packed")


def unpack(part: bytes) -> tuple[Packed, np.ndarray]:
    x, stored = Packed.__new__(Packed), np.load(io.BytesIO(part))
    for k in ARRAYS:
        setattr(x, k, stored[k])
    return x, stored["labels"]


def fit(rows: DataFrame, subjects: list[str], rounds: int) -> Model:
    """A model of ``rows`` (label INT, -1 for none; words STRING joined by spaces), a bounded table read from files.

    A round sends the model and its moments to all partitions and brings back what each has made of the features it has touched: of the
    size of the model, whatever the number of sentences. Features are averaged over the partitions that touched them.
    """
    spark = rows.sparkSession
    ship(spark)
    model, width = Model(subjects), len(subjects)
    moments, packed = Moments(model), pack(rows, width)
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((model, moments))

        def run(frames: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for part in frame["part"]:
                    x, labels = unpack(part)
                    done = local_steps(*sent.value, x, labels, LOCAL_STEPS)
                    done[3] = done[3] * HALF  # half precision is enough for a running mean, once scaled
                    data = [a.astype(np.float16 if k == 3 else np.float32).tobytes() for k, a in enumerate(done)]
                    yield pd.DataFrame({"touched": [x.touched.astype(np.int32).tobytes()], "done": [data], "n": [len(labels)]})

        weight, total = np.zeros(FEATURES, np.float32), 0
        new = [np.zeros_like(a) for a in (*model.parts(), *moments.first, *moments.square)]
        for r in packed.mapInPandas(run, "touched binary, done array<binary>, n bigint").collect():
            at, n = np.frombuffer(r["touched"], np.int32), r["n"]
            for k, d in enumerate(r["done"]):
                part = np.frombuffer(d, np.float16 if k == 3 else np.float32).astype(np.float32) * n
                if k % 3:
                    new[k] += part.reshape(new[k].shape)
                else:
                    new[k][at] += part.reshape(len(at), *new[k].shape[1:])
            weight[at] += n
            total += n
        sent.destroy()
        if not total:
            break
        hit = weight > 0
        for k, held in enumerate((*model.parts(), *moments.first, *moments.square)):
            if k % 3:
                held[...] = new[k] / total
            else:
                held[hit] = (new[k][hit].T / weight[hit]).T / (HALF if k == 3 else 1)
        moments.n += LOCAL_STEPS
    return model


# ---------------------------------------------------------------------------------------------------------------------
# The corpus as word hashes.


#: Bytes of text that are cut together. It bounds memory, not results: a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (.., text) cut into runs of rows of about ``SLICE_BYTES`` of text."""
    for b in batches:
        sizes = pa.compute.binary_length(b.column(1)).fill_null(0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // SLICE_BYTES
        edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, int)
        for a, z in zip(edges.tolist(), [*edges[1:].tolist(), len(b)]):
            yield b.slice(a, z - a)


def word_table(documents: DataFrame) -> DataFrame:
    """(doc_id, h ARRAY, lengths ARRAY, words STRING) of every document with words, written once to the shared folder.

    ``h`` holds the hashes of all words in order, ``lengths`` the number of words of each sentence, ``words`` their spelling.
    """
    ship(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            c = Cut(b.column(1))
            n = c.rows
            count = np.bincount(c.row, minlength=n)
            word_offs = np.concatenate(([0], np.cumsum(count)))
            length = np.diff(np.append(c.starts, len(c.first)))
            sentence_offs = np.concatenate(([0], np.cumsum(np.bincount(c.row[c.starts], minlength=n)))) if len(c.first) else np.zeros(n + 1, int)
            # spellings with one space after each word
            take = np.repeat(c.first, c.size + 1) + ramp(c.size + 1)
            gap = np.zeros(len(take), bool)
            gap[np.cumsum(c.size + 1) - 1] = True
            chars = np.where(gap, 32, c.lower[np.minimum(take, len(c.lower) - 1)] if len(take) else 0).astype(np.uint32)
            char_offs = np.concatenate(([0], np.cumsum(c.size + 1)))[word_offs]
            keep = pa.array(count > 0)
            out = pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(word_offs, pa.int32()), pa.array(c.hash)), pa.ListArray.from_arrays(pa.array(sentence_offs, pa.int32()), pa.array(length, pa.int32())), encode(chars, char_offs)],
                names=["doc_id", "h", "lengths", "words"],
            )
            yield out.filter(keep)

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(F.col("text").isNotNull())
    return write_shared(rows.mapInArrow(run, "doc_id bigint, h array<bigint>, lengths array<int>, words string"), "words")


class Sentences:
    """A batch of the word table: hashes of all words, where each sentence begins, the row of each sentence."""

    def __init__(self, b: pa.RecordBatch):
        def column(name: str) -> pa.Array:
            return b.column(b.schema.get_field_index(name))

        self.h = column("h").flatten().to_numpy(zero_copy_only=False)
        lists = column("lengths")
        self.length = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.row = np.repeat(np.arange(len(b)), lists.value_lengths().to_numpy(zero_copy_only=False))
        self.start = np.cumsum(self.length) - self.length
        self.owner = np.repeat(np.arange(len(self.length)), self.length)

    def spellings(self, b: pa.RecordBatch, which: np.ndarray) -> list[str]:
        """The words at the places ``which``."""
        text = b.column(b.schema.get_field_index("words")).cast(pa.large_string())
        raw = text.buffers()[2]
        at = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(raw, np.uint8)[at[0] : at[-1]] if raw is not None else np.zeros(0, np.uint8)
        ends = np.flatnonzero(data == 32)
        starts = np.concatenate(([0], ends[:-1] + 1))
        return [data[a:z].tobytes().decode() for a, z in zip(starts[which], ends[which])]


class WordScores:
    """Scores of words under a model, kept by hash for later batches of the task."""

    def __init__(self, model: Model):
        self.model, self.h, self.score = model, np.zeros(0, np.int64), np.zeros((0, len(model.subjects)), np.float32)

    def of(self, s: Sentences, b: pa.RecordBatch) -> np.ndarray:
        """Probability of each subject for each sentence."""
        if not len(s.length):
            return np.zeros((0, len(self.model.subjects)))
        distinct, first, inverse = np.unique(s.h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.h, distinct)
        new = (self.h[np.minimum(at, len(self.h) - 1)] != distinct) if len(self.h) else np.ones(len(distinct), bool)
        if new.any():
            if len(self.h) > 500_000:  # bounds memory, not results
                self.h, self.score, new = self.h[:0], self.score[:0], np.ones(len(distinct), bool)
            ids, size = features(s.spellings(b, first[new]))
            vectors = np.add.reduceat(self.model.words[ids], np.cumsum(size) - size, axis=0) / size[:, None]
            h = np.concatenate((self.h, distinct[new]))
            order = np.argsort(h, kind="stable")
            self.h, self.score = h[order], np.concatenate((self.score, (vectors @ self.model.out).astype(np.float32)))[order]
        score = self.score[np.searchsorted(self.h, distinct)]
        total = np.add.reduceat(score[inverse.ravel()], s.start, axis=0)
        return 1 / (1 + np.exp(-(total / s.length[:, None] + self.model.bias)))


def once_a_sentence(s: Sentences, which: np.ndarray | None = None) -> np.ndarray:
    """Places (of those given) of the words of each sentence, a repeated word once."""
    which = np.arange(len(s.h)) if which is None else which
    order = which[np.lexsort((s.h[which], s.owner[which]))]
    h, o = s.h[order], s.owner[order]
    return order[np.append(True, (h[1:] != h[:-1]) | (o[1:] != o[:-1]))] if len(order) else order


def counts_of(h: np.ndarray, subject: np.ndarray) -> pa.RecordBatch:
    """(h, subject, n) of the pairs given, counted within the batch."""
    order = np.lexsort((subject, h))
    a, b = h[order], subject[order]
    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, int)
    n = np.diff(np.append(new, len(a)))
    return pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new], pa.int32()), pa.array(n.astype(np.int64))], names=["h", "subject", "n"])


COUNTS = "h bigint, subject int, n bigint"


def confident_counts(rows: DataFrame, model: Model) -> DataFrame:
    """(h, subject, n): sentences that hold a word by the subject scored confidently, and by -1 all of them."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordScores(sent.value)
        for b in batches:
            s = Sentences(b)
            p = known.of(s, b)
            at = once_a_sentence(s)
            best = np.where(p.max(1) > CONFIDENT, p.argmax(1), -1)[s.owner[at]] if len(p) else np.zeros(0, int)
            sure = best >= 0
            yield counts_of(np.concatenate((s.h[at], s.h[at][sure])), np.concatenate((np.full(len(at), -1), best[sure])))

    return rows.select("h", "lengths", "words").mapInArrow(run, COUNTS).groupBy("h", "subject").agg(F.sum("n").alias("n"))


class Lexicon:
    """The words of subjects (h, subject) as sorted arrays, broadcast once; ``None`` beyond the bound."""

    @staticmethod
    def of(chosen: DataFrame):
        n = chosen.count()
        if n * 16 > BROADCAST_LIMIT:
            return None
        rows = chosen.select("h", "subject").toPandas().sort_values("h")
        return chosen.sparkSession.sparkContext.broadcast((rows["h"].to_numpy(np.int64), rows["subject"].to_numpy(np.int64)))


def subjects_of(h: np.ndarray, lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The subject of each hash, -1 for none."""
    known, subject = lexicon
    if not len(known):
        return np.full(len(h), -1)
    k = np.minimum(np.searchsorted(known, h), len(known) - 1)
    return np.where(known[k] == h, subject[k], -1)


def subject_words(s: Sentences, lexicon: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(places of the words with a subject, each once a sentence; the subject of each)."""
    subject = subjects_of(s.h, lexicon)
    at = once_a_sentence(s, np.flatnonzero(subject >= 0))
    return at, subject[at]


def votes(s: Sentences, at: np.ndarray, subject: np.ndarray, width: int) -> np.ndarray:
    """How many words of each subject each sentence holds."""
    return np.bincount(s.owner[at] * width + subject, minlength=len(s.length) * width).reshape(-1, width)


def voted_counts(rows: DataFrame, chosen: DataFrame, width: int) -> DataFrame:
    """(h, subject, n): sentences that hold a word by the one subject that their other words have; h NULL: sentences of one subject."""
    lexicon = Lexicon.of(chosen)
    if lexicon is None:
        return voted_by_shuffle(rows, chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = Sentences(b)
            at, subject = subject_words(s, lexicon.value)
            v = votes(s, at, subject, width)
            one = (v > 0).sum(1) == 1
            yield whole_counts(np.bincount(v[one].argmax(1), minlength=width) if one.any() else np.zeros(width, np.int64))
            # of the sentence's votes without the word itself
            some = once_a_sentence(s, np.flatnonzero(v.any(1)[s.owner]))
            rest = v[s.owner[some]]
            own = subjects_of(s.h[some], lexicon.value)
            rest[np.flatnonzero(own >= 0), own[own >= 0]] -= 1
            clear = (rest > 0).sum(1) == 1
            yield counts_of(s.h[some][clear], rest[clear].argmax(1) if clear.any() else np.zeros(0, int))

    return rows.select("h", "lengths").mapInArrow(run, COUNTS).groupBy("h", "subject").agg(F.sum("n").alias("n"))


def whole_counts(n: np.ndarray) -> pa.RecordBatch:
    hit = np.flatnonzero(n)
    return pa.RecordBatch.from_arrays([pa.nulls(len(hit), pa.int64()), pa.array(hit, pa.int32()), pa.array(n[hit].astype(np.int64))], names=["h", "subject", "n"])


def exploded(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc, sentence, h, subject) of every word once a sentence, its subject by a join; a document's rows are told apart by their order."""
    flat = rows.select(F.monotonically_increasing_id().alias("doc"), "h", "lengths")
    flat = flat.withColumn("ends", F.expr("transform(lengths, (x, i) -> aggregate(slice(lengths, 1, i + 1), 0, (a, y) -> a + y))")).withColumn("starts", F.expr("transform(ends, (e, i) -> e - lengths[i])"))
    words = flat.select("doc", F.posexplode(F.arrays_zip("starts", "lengths")).alias("sentence", "z"), "h").select("doc", "sentence", F.explode(F.array_distinct(F.slice("h", F.col("z.starts") + 1, F.col("z.lengths")))).alias("h"))
    return words.join(chosen.select("h", "subject"), "h", "left")


def sentence_votes(words: DataFrame) -> DataFrame:
    """(doc, sentence, votes MAP): words of each subject."""
    per = words.filter("subject IS NOT NULL").groupBy("doc", "sentence", "subject").agg(F.count("*").alias("k"))
    return per.groupBy("doc", "sentence").agg(F.map_from_entries(F.collect_list(F.struct("subject", "k"))).alias("votes"))


def voted_by_shuffle(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """What ``voted_counts`` gives, for a table of words of any size."""
    words = write_shared(exploded(rows, chosen), "words-of-sentences")
    v = write_shared(sentence_votes(words), "sentence-votes")
    rest = words.join(v, ["doc", "sentence"]).withColumn("rest", F.map_keys(F.map_filter("votes", lambda k, n: n - F.when(k == F.col("subject"), 1).otherwise(0) > 0)))
    told = rest.filter(F.size("rest") == 1).select("h", F.element_at("rest", 1).alias("subject"))
    lone = v.filter(F.size("votes") == 1).select(F.lit(None).cast("bigint").alias("h"), F.element_at(F.map_keys("votes"), 1).alias("subject"))
    return told.unionAll(lone).groupBy("h", "subject").agg(F.count("*").alias("n"))


def chosen(counts: DataFrame, totals: DataFrame, share: float, barred: DataFrame, whole: int) -> DataFrame:
    """(h, subject) of the words whose sentences are mostly one subject's, written to the shared folder."""
    base = {r["subject"]: r["n"] for r in counts.filter("h IS NULL AND subject >= 0").collect()}
    per = counts.filter("h IS NOT NULL AND subject >= 0").groupBy("h").agg(F.max_by("subject", F.struct("n", "subject")).alias("subject"), F.max("n").alias("n"), F.sum("n").alias("all"))
    per = per.filter((F.col("n") >= WORD_COUNT) & (F.col("n") >= WORD_PURITY * F.col("all"))).join(F.broadcast(barred), "h", "left_anti")
    per = per.join(totals, "h").filter(F.col("n") >= share * F.col("total"))
    if base:
        rare = F.create_map(*[x for k, v in base.items() for x in (F.lit(k), F.lit(WORD_LIFT * v / max(1, whole)))])
        per = per.filter(F.col("n") / F.col("total") >= F.coalesce(rare[F.col("subject")], F.lit(0.0)))
    return write_shared(per.select("h", "subject"), "subject-words")


def training_set(rows: DataFrame, words: DataFrame, width: int) -> DataFrame:
    """(label, words): about ``PER_LABEL`` sentences of each subject and ``PER_NONE`` of none, picked by hash; written to the shared folder.

    A first pass counts the sentences by label, a second one spells out those whose hash falls within the share that is needed.
    """
    spark = rows.sparkSession
    lexicon = Lexicon.of(words) or spark.sparkContext.broadcast(None)
    if lexicon.value is None:
        return training_by_shuffle(rows, words)

    def marked(s: Sentences) -> tuple[np.ndarray, np.ndarray]:
        at, subject = subject_words(s, lexicon.value)
        v = votes(s, at, subject, width)
        kinds = (v > 0).sum(1)
        label = np.where(kinds > 1, -2, np.where((kinds == 1) & (v.max(1, initial=0) >= 2), v.argmax(1), -1))
        with np.errstate(over="ignore"):  # a hash of the sentence's words in order
            mix = np.add.reduceat(s.h.view(np.uint64) * (2 * (np.arange(len(s.h)) - s.start[s.owner]) + 1).astype(np.uint64), s.start) if len(s.start) else np.zeros(0, np.uint64)
        return label, ((mix * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label, _ = marked(Sentences(b))
            found, n = np.unique(label, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(n.astype(np.int64))], names=["label", "n"])

    size = {r["label"]: r["n"] for r in rows.select("h", "lengths").mapInArrow(count, "label int, n bigint").groupBy("label").agg(F.sum("n").alias("n")).collect()}
    limit = {k: int((1 << 20) * min(1.0, (PER_LABEL if k >= 0 else PER_NONE) / n)) for k, n in size.items() if k >= -1}

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = np.array([limit.get(k, 0) for k in range(-2, width)])
        for b in batches:
            s = Sentences(b)
            label, place = marked(s)
            take = np.flatnonzero(place < edge[label + 2])
            which = np.repeat(s.start[take], s.length[take]) + ramp(s.length[take])
            spelt = s.spellings(b, which) if len(which) else []
            ends = np.concatenate(([0], np.cumsum(s.length[take]))).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(label[take], pa.int32()), pa.array([" ".join(spelt[a:z]) for a, z in zip(ends[:-1], ends[1:])], pa.string())], names=["label", "words"])

    return write_shared(rows.select("h", "lengths", "words").mapInArrow(pick, "label int, words string"), "training-set")


def training_by_shuffle(rows: DataFrame, words: DataFrame) -> DataFrame:
    """What ``training_set`` gives, for a table of words of any size; other sentences of the same number are picked."""
    v = sentence_votes(exploded(rows, words))
    flat = rows.select(F.monotonically_increasing_id().alias("doc"), "lengths", F.split("words", " ").alias("w"))
    flat = flat.select("doc", "w", "lengths", F.posexplode("lengths").alias("sentence", "length"))
    first = F.expr("aggregate(slice(lengths, 1, sentence), 0, (a, y) -> a + y)")
    spelt = flat.select("doc", "sentence", F.concat_ws(" ", F.slice("w", first + 1, F.col("length"))).alias("words")).join(v, ["doc", "sentence"], "left")
    most = F.array_max(F.map_values("votes"))
    label = F.when(F.col("votes").isNull(), -1).when(F.size("votes") > 1, -2).when(most >= 2, F.element_at(F.map_keys("votes"), 1)).otherwise(-1)
    marked = write_shared(spelt.select(label.alias("label"), "words").filter("label >= -1"), "marked")
    size = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    share = F.create_map(*[x for k, n in size.items() for x in (F.lit(k), F.lit(min(1.0, (PER_LABEL if k >= 0 else PER_NONE) / n)))]) if size else F.create_map(F.lit(0), F.lit(0.0))
    return write_shared(marked.filter(F.pmod(F.xxhash64("words"), F.lit(1 << 20)) < share[F.col("label")] * (1 << 20)), "training-set")


def labelled(samples: DataFrame, areas: DataFrame, subjects: list[str]) -> list[tuple[int, str]]:
    """(label, words) of the labelled sentences and of the listed words of each subject; bounded by ``MAX_LABELLED`` texts."""
    place = {s: k for k, s in enumerate(subjects)}
    out: list[tuple[int, str]] = []
    texts = samples.filter(F.col("text").isNotNull() & F.col("subject").isin(subjects)).select("text", "subject").orderBy(F.xxhash64("text", "subject")).limit(MAX_LABELLED).collect()
    for r in texts:
        out += [(place[r["subject"]], " ".join(w)) for w in sentences(r["text"]) if w]
    for r in areas.filter(F.col("description").isNotNull()).orderBy("subject").limit(MAX_LABELLED).collect():
        listed = re.sub(r"\b[a-z]{2}:", "", r["description"])
        out += [(place[r["subject"]], " ".join(w)) for part in re.split(r"[,;]", listed) for w in sentences(part) if w and r["subject"] in place]
    return out


def document_subjects(documents: DataFrame, areas: DataFrame, samples: DataFrame) -> DataFrame:
    """(doc_id, subject, n_sentences) of every subject with which ``MIN_SENTENCES`` sentences of a document deal."""
    spark = documents.sparkSession
    schema = "doc_id bigint, subject string, n_sentences bigint"
    subjects = [r["subject"] for r in areas.select("subject").filter("subject IS NOT NULL").distinct().orderBy("subject").collect()]
    given = labelled(samples, areas, subjects) if subjects else []
    if not given:
        return spark.createDataFrame([], schema)
    rows, width = word_table(documents), len(subjects)
    seeds = write_shared(spark.createDataFrame(given, "label int, words string").coalesce(1), "labelled")
    first = fit(seeds, subjects, SEED_ROUNDS)
    counts = write_shared(confident_counts(rows, first), "confident")
    totals = counts.filter("subject = -1").select("h", F.col("n").alias("total"))
    whole = rows.agg(F.sum(F.size("lengths"))).first()[0] or 0
    words = chosen(counts, totals, 0.5, barred_words(spark, given), whole)
    for share in WORD_SHARES:
        words = chosen(write_shared(voted_counts(rows, words, width), "votes"), totals, share, barred_words(spark, given), whole)
    model = fit(training_set(rows, words, width).unionByName(seeds), subjects, ROUNDS)
    return scored(rows, model).groupBy("doc_id", "subject").agg(F.sum("n").alias("n_sentences")).filter(F.col("n_sentences") >= MIN_SENTENCES)


def barred_words(spark: SparkSession, given: list[tuple[int, str]]) -> DataFrame:
    """(h) of the words that can have no subject: of page numbers and dates, and those of the labelled texts of many subjects."""
    spread: dict[str, set[int]] = {}
    for label, text in given:
        for w in text.split(" "):
            spread.setdefault(w, set()).add(label)
    barred = {w for w, s in spread.items() if len(s) >= COMMON_SUBJECTS} | set(PAGE_WORDS) | set(NUMBER_WORDS) | set(MONTHS)
    return spark.createDataFrame([(int(h),) for h in hashes(sorted(barred))], "h bigint")


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """(doc_id, subject, n): sentences of each subject, added up within a document's row."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordScores(sent.value)
        names, width = pa.array(sent.value.subjects, pa.string()), len(sent.value.subjects)
        for b in batches:
            s = Sentences(b)
            at, subject = np.nonzero(known.of(s, b) >= THRESHOLD)
            n = np.bincount(s.row[at] * width + subject, minlength=len(b) * width) if len(at) else np.zeros(len(b) * width, np.int64)
            hit = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("doc_id")).take(pa.array(hit // width)), names.take(pa.array(hit % width)), pa.array(n[hit].astype(np.int64))], names=["doc_id", "subject", "n"])

    return rows.select("doc_id", "h", "lengths", "words").mapInArrow(run, "doc_id bigint, subject string, n bigint")
