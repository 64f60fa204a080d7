"""Problem 8: the whole corpus as ids of a public byte-level BPE vocabulary.

A batch of texts is cut into the vocabulary's words once; the distinct words lie as bytes in one flat array of symbols. Every
merge round finds the rank of each neighbouring pair by binary search over the sorted pair keys, takes each word's
lowest (leftmost) pair and merges it, until no pair is left. A round merges one pair of a word, so a word of more than ``LONG_BYTES``
bytes (an unbroken run of letters or signs) would take rounds without end: its pairs lie in a heap by rank and place instead, which is
linear but for a logarithm. A word's ids are kept for later batches of the task.

An empty text has the ids ``[]``. A NULL text has them too (``null_ids``), so that every document comes out with a list.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.session import ship

#: Words whose ids a task keeps; beyond it the memory starts anew. It bounds memory, not results.
KEPT_WORDS = 200_000
#: Bytes from which a word is merged with a heap. It bounds time, not results.
LONG_BYTES = 192
#: Characters of one slice of texts that are merged together. It bounds memory, not results.
SLICE_CHARS = 4 << 20


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class Vocabulary:
    """Ranks of a tiktoken file, as a table of mergeable pairs sorted by key."""

    def __init__(self, path: str, pattern: str):
        ranks = {}
        with open(path, "rb") as f:
            for line in f:
                a, b = line.split()
                ranks[base64.b64decode(a)] = int(b)
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, out = [], []
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    out.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.keys, self.merged = np.array(keys, np.int64)[order], np.array(out, np.int64)[order]
        self.whole = ranks
        self.cut = regex.compile(pattern)
        self.known: dict[str, np.ndarray] = {}

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word: long ones with a heap, all others in rounds together."""
        short = [w for w in words if len(w) <= LONG_BYTES]
        done = iter(self.rounds(short) if short else [])
        return [next(done) if len(w) <= LONG_BYTES else self.heaped(w) for w in words]

    @functools.cached_property
    def pairs(self) -> dict[int, int]:
        """Merged symbol by pair key."""
        return dict(zip(self.keys.tolist(), self.merged.tolist()))

    def heaped(self, word: bytes) -> np.ndarray:
        """Ids of one word: the pair of lowest rank, of equal ones the leftmost, is merged until there is none."""
        sym = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n, pairs = len(sym), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, (a, b) in enumerate(zip(sym, sym[1:])) if (r := pairs.get(a << 32 | b)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            # a place whose pair has changed meanwhile, or that is gone, was entered again with its new pair
            if sym[i] < 0 or j >= n or pairs.get(sym[i] << 32 | sym[j]) != rank:
                continue
            sym[i], sym[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := pairs.get(rank << 32 | sym[k])) is not None:
                    heapq.heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := pairs.get(sym[h] << 32 | rank)) is not None:
                heapq.heappush(heap, (r, h))
        return np.array([s for s in sym if s >= 0], np.int32)

    def rounds(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word, by rounds over all words at once."""
        size = np.array([len(w) for w in words], np.int64)
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), size)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        none = np.int64(1) << 62
        while len(sym) > 1:
            key = sym[:-1] << 32 | sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.merged[at], none)
            rank = np.append(rank, none)
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, first)
            group = np.cumsum(np.append(False, word[1:] != word[:-1]))
            live = least[group] < none
            if not live.all():
                done.append((word[~live], sym[~live]))
                sym, word, rank, group = sym[live], word[live], rank[live], group[live]
                if not len(sym):
                    break
            hit = np.flatnonzero(rank == least[group])
            hit = hit[np.append(True, word[hit[1:]] != word[hit[:-1]])]
            sym[hit] = rank[hit]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            sym, word = sym[keep], word[keep]
        done.append((word, sym))
        w = np.concatenate([a for a, _ in done])
        s = np.concatenate([b for _, b in done])
        order = np.argsort(w, kind="stable")
        s = s[order].astype(np.int32)
        return np.split(s, np.cumsum(np.bincount(w, minlength=len(words)))[:-1])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, number of ids of each)."""
        cut = [self.cut.findall(t) for t in texts]
        if len(self.known) > KEPT_WORDS:
            self.known = {}
        new = {w for words in cut for w in words if w not in self.known}
        if new:
            fresh = sorted(new)
            self.known.update(zip(fresh, self.merge([w.encode() for w in fresh])))
        parts = [self.known[w] for words in cut for w in words]
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        size = np.array([len(p) for p in parts], np.int64)
        ends = np.concatenate(([0], np.cumsum(size)))[np.concatenate(([0], np.cumsum([len(c) for c in cut])))]
        return flat, np.diff(ends)


@functools.cache
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def slices(texts: list[str], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None, null_ids: bool = True) -> DataFrame:
    """(key, ids) of every row. With ``null_ids`` a NULL text has the ids ``[]``, without it NULL; an empty text always ``[]``."""
    ship(df.sparkSession)
    path, pattern = path or default_path(), pattern or default_pattern()
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path, pattern)
        for b in batches:
            texts = b.column(1).fill_null("").to_pylist()
            for i, j in slices(texts):
                flat, size = vocab.encode(texts[i:j])
                offs = pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32())
                ids = pa.ListArray.from_arrays(offs, pa.array(flat, pa.int32()))
                if not null_ids:
                    ids = pa.compute.if_else(b.column(1)[i:j].is_valid(), ids, pa.scalar(None, ids.type))
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], ids], names=["k", "ids"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, ids array<int>").withColumnRenamed("k", key)
