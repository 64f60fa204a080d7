"""What problems 1, 4 and 6 need of every recognised line, computed once in numpy over Arrow batches."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.chars import canonical, decode, encode, finish, low, offsets, polynomial, powers, ramp, row_hash, rows_of, skeleton, tables
from broadsheet.session import ship

# Words beside a page number; words beside an issue number; months of the three languages.
PAGE_WORDS = ["seite", "page", "pagina", "pag", "s", "p"]
NUMBER_WORDS = ["nr", "no", "nummer", "number", "numero", "numéro", "n"]
MONTHS = [
    "januar", "jänner", "februar", "märz", "april", "mai", "juni", "juli", "august", "september", "oktober", "november", "dezember",
    "january", "february", "march", "may", "june", "july", "october", "december",
    "janvier", "février", "mars", "avril", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre",
]


def skeleton_text(text: str) -> str:
    out, _ = skeleton(*canonical(*decode(pa.array([text])))[:2])
    return out.astype("<u4").tobytes().decode("utf-32-le")


@functools.cache
def word_sets() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the skeletons of page words, and of number words and months (these also with one letter lost)."""

    def hashes(words: list[str], lose: bool) -> np.ndarray:
        every = {skeleton_text(w) for w in words}
        if lose:
            every |= {s[:k] + s[k + 1 :] for s in list(every) if len(s) > 4 for k in range(len(s))}
        cps, offs = decode(pa.array(sorted(every)))
        return np.unique(row_hash(cps, offs))

    return hashes(PAGE_WORDS, False), np.union1d(hashes(NUMBER_WORDS, False), hashes(MONTHS, True))


def features(texts: pa.Array) -> dict[str, pa.Array]:
    """Of each text: ``skel``, its skeleton, and what ``numbered`` gives."""
    cps, offs, _ = canonical(*decode(texts))
    whole, whole_offs = skeleton(cps, offs)
    return {"skel": encode(whole, whole_offs)} | numbered(cps, offs)


def numbered(cps: np.ndarray, offs: np.ndarray) -> dict[str, pa.Array]:
    """Of each canonical text: ``nums``, its number words; ``title``, the skeleton without numbers, months and page words, if it
    has a number and few words; ``pagenum``, the number if the text is only a page number, else NULL.

    Only rows with a digit are looked at.
    """
    n, size = len(offs) - 1, np.diff(offs)
    has = np.unique(np.searchsorted(offs, np.flatnonzero(tables()["digit"][low(cps)]), "right") - 1)
    found = numbers_of(cps[np.repeat(offs[has], size[has]) + ramp(size[has])], np.concatenate(([0], np.cumsum(size[has]))))
    at = np.full(n, -1)
    at[has] = np.arange(len(has))
    spread = pa.array(at, mask=at < 0)
    out = {name: pa.compute.take(found[name], spread) for name in found}
    out["nums"] = out["nums"].fill_null("")
    return out


def numbers_of(cps: np.ndarray, offs: np.ndarray) -> dict[str, pa.Array]:
    t = tables()
    n = len(offs) - 1
    ix = low(cps)
    solid = t["letter"][ix] | t["digit"][ix] | (t["ccc"][ix] > 0)
    row = rows_of(offs)
    begin = solid & ~np.concatenate(([False], solid[:-1] & (row[1:] == row[:-1])))
    word = np.cumsum(begin) - 1
    nwords = int(begin.sum())
    wrow = row[begin]
    # a word's own skeleton must not lose a letter to the word before it: fold words apart, then hash each
    gaps, _, gsrc = skeleton(cps, offs, spaces=True, source=True)
    real = gaps != 32
    gword = word[gsrc[real]]
    hashed = row_hash(gaps[real], offsets(gword, nwords)) if nwords else np.zeros(0, np.int64)
    letters = np.bincount(word[solid], t["letter"][ix[solid]], minlength=nwords)
    number = (letters == 0) & (np.bincount(word[solid], t["digit"][ix[solid]], minlength=nwords) > 0)
    page_set, drop_set = word_sets()
    is_page, is_drop = np.isin(hashed, page_set) & ~number, np.isin(hashed, drop_set) & ~number
    count = lambda mask: np.bincount(wrow[mask], minlength=n)
    numbers, pages, drops, words = count(number), count(is_page), count(is_drop), np.bincount(wrow, minlength=n)
    rest = words - numbers - pages - drops
    # number words in their own digits
    digits = solid & number[np.maximum(word, 0)] if nwords else np.zeros(len(cps), bool)
    sep = np.concatenate((digits[:-1] & ~digits[1:] & (row[1:] == row[:-1]), [False])) if len(cps) else digits
    take = digits | np.concatenate(([False], sep[:-1])) if len(cps) else digits
    nums = encode(np.where(digits[take], cps[take], 32).astype(np.uint32), offsets(row[take], n))
    # titles
    keep_word = ~(number | is_page | is_drop)
    in_title = (numbers > 0) & (rest > 0) & (words <= 12)
    keep = real.copy()
    keep[real] = keep_word[gword] & in_title[row[gsrc[real]]] if nwords else False
    title = encode(gaps[keep], offsets(row[gsrc[keep]], n), pa.array(in_title))
    only = (numbers == 1) & (rest == 0) & (drops == 0) & (pages <= 1)
    return {"nums": nums, "title": title, "pagenum": pa.compute.if_else(pa.array(only), nums, pa.scalar(None, pa.string()))}


@functools.cache
def word_tables() -> tuple[np.ndarray, np.ndarray]:
    """Of each character of the basic plane: whether it is part of a word, and the value of its lower case in a hash."""
    t = tables()
    part = t["letter"] | t["digit"] | (t["ccc"] > 0)
    part[124] = True
    return part, polynomial(t["lower"])


class Words:
    """The words of canonical texts (runs of letters, marks, digits and bars): row, first and last character, hash in lower case."""

    def __init__(self, cps: np.ndarray, offs: np.ndarray):
        part, value = word_tables()
        self.cps = cps
        solid = part[low(cps)]
        full = offs[1:] > offs[:-1]
        head, tail = offs[:-1][full], offs[1:][full] - 1
        begin = solid.copy()
        begin[1:] &= ~solid[:-1]
        begin[head] = solid[head]
        self.first = np.flatnonzero(begin)
        end = solid.copy()
        end[:-1] &= ~solid[1:]
        end[tail] = solid[tail]
        self.last = np.flatnonzero(end) + 1
        #: words of each row
        self.count = np.diff(np.searchsorted(self.first, offs))
        self.row = np.repeat(np.arange(len(offs) - 1), self.count)
        size = self.size = self.last - self.first
        # as row_hash, with the values of the characters from the table; no character beyond the basic plane is part of a word
        if len(size):
            total = np.add.reduceat(value[cps[solid]] * powers(1 << max(4, int(size.max()).bit_length()))[ramp(size)], np.cumsum(size) - size)
        else:
            total = np.zeros(0, np.uint64)
        self.hash = finish(total, size)

    def texts(self, which: np.ndarray) -> pa.Array:
        """The words ``which`` in lower case."""
        size = self.size[which]
        take = np.repeat(self.first[which], size) + ramp(size)
        return encode(tables()["lower"][low(self.cps[take])].astype(np.uint32), np.concatenate(([0], np.cumsum(size))))


COLUMNS = ["skel", "nums", "title", "pagenum"]


def with_features(df: DataFrame, column: str) -> DataFrame:
    """Adds the features of ``column``; it is itself left out. NULL reads as an empty text."""
    ship(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name != column and f.name not in COLUMNS]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{c} string" for c in COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = features(b.column(column))
            yield pa.RecordBatch.from_arrays([b.column(f.name) for f in kept] + [found[c] for c in COLUMNS], names=[f.name for f in kept] + COLUMNS)

    return df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(column)).mapInArrow(run, schema)


def reading_place(block_id: Column, line_id: Column) -> Column:
    """Reading order within a page as one number: leading number of the block, then the line; NULL parts come last."""
    block = F.coalesce(F.substring_index(block_id, ".", 1).try_cast("bigint"), F.lit(1 << 30))
    return block * (1 << 24) + F.coalesce(line_id.cast("bigint"), F.lit((1 << 24) - 1))


def page_offset(nums: Column, page_path: Column) -> Column:
    """The lone number of a line less the number of its page file; NULL if either is missing."""
    return F.regexp_replace(nums, "^0+(?=.)", "").try_cast("bigint") - F.regexp_extract(page_path, r"/0*(\d+)\.[A-Za-z]+$", 1).try_cast("bigint")
