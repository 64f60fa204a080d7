"""Problem 9: passages of held-out items inside corpus documents.

The items' texts become skeletons (``chars.skeleton``): case, spacing, punctuation, broken words, invisible characters,
look-alike letters and most misread letters are gone. Every three successive words of an item (more, if they are very short) are one
pattern of a single Aho-Corasick automaton over all items; each document's skeleton is scanned once. From each hit the run of item words
is followed to both sides, word by word, with a small edit distance for a misread word and a short gap for an inserted mark. A document
leaks an item if one run has at least ``MIN_WORDS`` words. Offsets lead back to the original text: every step from the original to the
skeleton carries along where a character came from.

A NULL, empty or blank text leaks nothing. The items are a held-out set; they are sent to every executor once and an executor's worker builds
the automaton once. Its memory grows with the items, so beyond ``ITEM_CHARS`` characters of items it is built and used in parts of that
size, one after the other over each batch of documents; the documents are read once all the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.chars import canonical, decode, skeleton
from broadsheet.session import ship

MIN_WORDS = 15
#: Successive item words of one pattern.
PATTERN_WORDS = 3
#: Letters that a pattern has at least; very short words are taken together until they have as many.
PATTERN_LETTERS = 6
#: Characters of the items of one automaton: some 100 bytes of memory each. It bounds memory, not results.
ITEM_CHARS = 4 << 20
#: Characters an inserted mark may add between two words.
GAP = 8

Item = tuple[int, str, list[int]]


def skeletons(texts: pa.Array) -> tuple[list[str], list[np.ndarray]]:
    """(skeleton without spaces, for each of its characters its place in the original text) of each row."""
    cps, first = decode(texts)
    cps, offs, _, origin = canonical(cps, first, source=True)
    out, at, src = skeleton(cps, offs, source=True)
    big = out.astype("<u4").tobytes()
    place = origin[src] if len(src) else src
    return [big[4 * a : 4 * b].decode("utf-32-le") for a, b in zip(at[:-1], at[1:])], [place[a:b] - o for a, b, o in zip(at[:-1], at[1:], first)]


def item_words(texts: list[str]) -> list[tuple[str, list[int]]]:
    """(skeleton, where each word begins and the last ends) of each item."""
    array = pa.array(texts, pa.string())
    cps, offs, _ = canonical(*decode(array))
    flat, at, src = skeleton(cps, offs, source=True)
    gap = (cps == 32) | (cps == 10)
    word = np.cumsum(gap)
    found = []
    for a, b in zip(at[:-1], at[1:]):
        w = word[src[a:b]]
        starts = np.flatnonzero(np.append(True, w[1:] != w[:-1])) if b > a else np.zeros(0, int)
        found.append((flat[a:b].astype("<u4").tobytes().decode("utf-32-le"), [*starts.tolist(), int(b - a)]))
    return found


def automaton(items: list[Item]) -> ahocorasick.Automaton:
    found: dict[str, list[tuple[int, int]]] = {}
    for n, (_, text, ends) in enumerate(items):
        for k in range(len(ends) - PATTERN_WORDS):
            for z in range(k + PATTERN_WORDS, len(ends)):
                # a letter at either end may have melted into the word beside it
                piece = text[ends[k] + 1 : ends[z] - 1]
                if len(piece) >= PATTERN_LETTERS:
                    found.setdefault(piece, []).append((n, k))
                    break
    auto = ahocorasick.Automaton()
    for piece, places in found.items():
        auto.add_word(piece, (len(piece), places))
    if found:
        auto.make_automaton()
    return auto


def nearest(word: str, text: str) -> tuple[int, int]:
    """(least edit distance of ``word`` to a beginning of ``text``, where that ends)."""
    before = list(range(len(text) + 1))
    for i, a in enumerate(word, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (a != b)))
        before = now
    best = min(range(len(before)), key=lambda j: (before[j], abs(j - len(word))))
    return before[best], best


def follow(text: str, at: int, item: str, ends: list[int], k: int) -> tuple[int, int]:
    """Follows the item's words from word ``k``, that should begin at ``at``; (words matched, where they end)."""
    n = 0
    while k < len(ends) - 1:
        word = item[ends[k] : ends[k + 1]]
        if text.startswith(word, at):
            step = len(word)
        else:
            rest = text[at : at + len(word) + 2]
            miss, step = nearest(word, rest)
            if not rest or miss > max(1, len(word) // 4) or (len(word) <= 3 and miss):
                ahead = item[ends[k] : ends[min(k + 2, len(ends) - 1)]]
                gap = text.find(ahead if len(ahead) >= 4 else word + "\0", at, at + GAP + len(ahead))
                if gap >= 0:
                    at += gap - at
                    continue
                if len(word) <= 3 and miss <= 1 and k + 2 < len(ends) and text.startswith(item[ends[k + 1] : ends[k + 2]], at + step):
                    pass
                else:
                    break
        at, n, k = at + step, n + 1, k + 1
    return n, at


def leaks_of(text: str, items: list[Item], auto: ahocorasick.Automaton, back: list[tuple[str, list[int]]], least: int = MIN_WORDS) -> dict[int, tuple[int, int, int]]:
    """{index of item: (words, begin, end in the skeleton)} of the longest run of each item that reaches ``least`` words."""
    seeds: dict[int, list[tuple[int, int]]] = {}
    for end, (size, places) in auto.iter(text):
        for n, k in places:
            seeds.setdefault(n, []).append((end - size + 1, k))
    out: dict[int, tuple[int, int, int]] = {}
    mirror = text[::-1] if seeds else ""
    for n, places in seeds.items():
        _, item, ends = items[n]
        covered = (-1, -1, -1, -1)
        for at, k in places:
            if covered[0] <= at < covered[1] and covered[2] <= k < covered[3]:
                continue
            begin = at - 1
            right, stop = follow(text, begin, item, ends, k)
            mirrored, mends = back[n]
            left, start = follow(mirror, len(text) - begin, mirrored, mends, len(ends) - 1 - k)
            covered = (len(text) - start, stop, k - left, k + right)
            if left + right >= least and left + right > out.get(n, (0,))[0]:
                out[n] = (left + right, len(text) - start, stop)
    return out


def in_original(text: str, src: np.ndarray, begin: int, end: int) -> tuple[int, int]:
    """Places in the original text of the skeleton's characters from ``begin`` to ``end``.

    A run of one class is one character of the skeleton: where it begins in the word before, that word is left out, and the rest of
    a run at the end is taken in.
    """
    first = int(src[begin])
    upto = int(src[begin + 1]) if begin + 1 < len(src) else len(text)
    gap = max((k + 1 for k in range(first, upto) if text[k].isspace()), default=first)
    last, limit = int(src[end - 1]) + 1, int(src[end]) if end < len(src) else len(text)
    while last < limit and text[last].isalnum():
        last += 1
    return gap, last


class Scanner:
    """Automata over all items, a part of ``ITEM_CHARS`` each, and the items mirrored for the way to the left."""

    def __init__(self, items: list[Item], least: int, chars: int = ITEM_CHARS):
        self.least, self.parts = least, []
        start, size = 0, 0
        for k, (_, text, _) in enumerate([*items, (0, " " * (chars + 1), [])]):
            if k > start and size + len(text) > chars:
                part = items[start:k]
                self.parts.append((part, automaton(part), [(t[::-1], [len(t) - e for e in reversed(ends)]) for _, t, ends in part]))
                start, size = k, 0
            size += len(text)

    def leaks_of(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(item, words, begin, end in the skeleton) of every item that leaks."""
        for items, auto, back in self.parts:
            if len(auto):
                for n, found in leaks_of(text, items, auto, back, self.least).items():
                    yield items[n][0], *found


#: The scanner of this worker, by the broadcast it was built from.
_scanners: dict[object, Scanner] = {}


def scanner_of(sent) -> Scanner:
    key = getattr(sent, "_path", None) or id(sent)
    if key not in _scanners:
        _scanners.clear()
        _scanners[key] = Scanner(*sent.value)
    return _scanners[key]


def leaks(documents: DataFrame, test_items: DataFrame, least: int = MIN_WORDS, chars: int = ITEM_CHARS) -> DataFrame:
    """(doc_id, item_id, words, begin, end): the longest run of each item in each document, offsets into the original text."""
    ship(documents.sparkSession)
    rows = [(r["item_id"], r["text"]) for r in test_items.select("item_id", "text").filter(F.col("text").isNotNull() & F.col("item_id").isNotNull()).toLocalIterator()]
    schema = "doc_id bigint, item_id bigint, words int, begin bigint, end bigint"
    if not rows:
        return documents.sparkSession.createDataFrame([], schema)
    items = [(i, *w) for (i, _), w in zip(rows, item_words([t for _, t in rows]))]
    sent = documents.sparkSession.sparkContext.broadcast((items, least, chars))
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = scanner_of(sent)
        for b in batches:
            found: list[tuple[int, int, int, int, int]] = []
            texts, places = skeletons(b.column(1))
            for k, (doc, text, src) in enumerate(zip(b.column(0).to_pylist(), texts, places)):
                for item, words, begin, end in scanner.leaks_of(text):
                    found.append((doc, item, words, *in_original(b.column(1)[k].as_py(), src, max(begin, 0), end)))
            cols = list(zip(*found)) if found else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "item_id", "words", "begin", "end"])

    return docs.mapInArrow(run, schema)
