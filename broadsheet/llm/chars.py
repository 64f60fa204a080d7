"""Problem 2: text that looks the same in one consistent form.

An Arrow string array becomes one flat array of code points with row offsets. Everything that follows is a gather from a
lookup table, an expansion by offsets or a vectorised composition of marks; no string call is made for a row.

* full-width and half-width forms and typographic ligatures are taken apart (``NFKC`` for these only),
* spaces other than the plain one become a plain space, invisible characters disappear,
* a letter and its separate accents become the one character that exists for them,
* a letter of another script inside a Latin word becomes the Latin letter of the same look.

Fractions, long s, ae and oe, quotes, dashes, words wholly in another script and accents without a single character stay.
NULL stays NULL, an empty text stays empty; neither counts as changed. The tables cover the basic plane; characters beyond it (rare
scripts, emoji, mathematical alphabets) are kept as they are.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.session import ship

BMP = 0x10000

# Letters of other scripts and the Latin letters they look like.
LOOK_ALIKE = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
    "Ԛ": "Q", "Ԝ": "W", "Ү": "Y", "ү": "y", "Һ": "H", "ѵ": "v", "ё": "ë", "Ё": "Ë", "ї": "ï", "Ї": "Ï",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "α": "a", "γ": "y", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ω": "w", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J", "ό": "ó", "ά": "á", "έ": "é", "ί": "í", "ύ": "ú",
    "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g", "զ": "q", "Օ": "O", "Տ": "S", "Լ": "L",
}
# Characters without ink that are neither a format character nor a space by their category.
BLANKS = [0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10)]
# Controls that stand for a space inside a line.
SPACE_CONTROLS = [0x09, 0x0B, 0x0C, 0x85, 0x2028, 0x2029]

KEEP, DROP, ONE, MANY = 0, 1, 2, 3


@functools.cache
def tables() -> dict[str, np.ndarray]:
    """Lookup tables over the basic plane, built from the Unicode data by the rules above."""
    kind = np.zeros(BMP, np.uint8)
    to = np.arange(BMP, dtype=np.uint32)
    start, length, flat = np.zeros(BMP, np.int64), np.ones(BMP, np.int64), []
    ccc = np.zeros(BMP, np.uint8)
    lower = np.arange(BMP, dtype=np.uint32)
    letter, digit, latin, alien = (np.zeros(BMP, bool) for _ in range(4))
    pairs: dict[int, int] = {}
    apart_start, apart_length, apart = np.zeros(BMP, np.int64), np.ones(BMP, np.int64), []
    for c in range(BMP):
        if 0xD800 <= c < 0xE000:
            continue
        s = chr(c)
        cat = unicodedata.category(s)
        deco = unicodedata.decomposition(s)
        if cat[0] == "L":
            letter[c] = True
            name = unicodedata.name(s, "")
            latin[c] = name.startswith("LATIN") or c in (0xAA, 0xBA)
            alien[c] = name.startswith(("CYRILLIC", "GREEK", "ARMENIAN", "COPTIC"))
            low = s.lower()
            if len(low) == 1:
                lower[c] = ord(low)
        elif cat == "Nd":
            digit[c] = True
        ccc[c] = unicodedata.combining(s)
        many = None
        if cat == "Cf" or c in BLANKS:
            kind[c] = DROP
        elif (cat == "Zs" and c != 0x20) or c in SPACE_CONTROLS:
            kind[c], to[c] = ONE, 0x20
        elif deco.startswith(("<wide>", "<narrow>")) or (deco.startswith("<compat>") and " LIGATURE " in unicodedata.name(s, "")):
            many = [int(x, 16) for x in deco.split()[1:]]
        elif deco and deco[0] != "<":
            parts = [int(x, 16) for x in deco.split()]
            if len(parts) == 1:
                many = parts
            elif unicodedata.normalize("NFC", s) == s and max(parts) < BMP:
                pairs[parts[0] << 16 | parts[1]] = c
                full = [ord(x) for x in unicodedata.normalize("NFD", s)]
                apart_start[c], apart_length[c] = len(apart), len(full)
                apart += full
        if many and len(many) == 1:
            kind[c], to[c] = ONE, many[0]
        elif many:
            kind[c], start[c], length[c] = MANY, len(flat), len(many)
            flat += many
    keys = np.array(sorted(pairs), np.uint32)
    touch = (kind > 0) | (ccc > 0) | alien
    look = np.zeros(BMP, np.uint32)
    for a, b in LOOK_ALIKE.items():
        look[ord(a)] = ord(b)
    return {
        "kind": kind, "any": touch, "to": to, "start": start, "length": length, "flat": np.array(flat, np.uint32), "ccc": ccc, "lower": lower, "letter": letter, "digit": digit,
        "apart_start": apart_start, "apart_length": apart_length, "apart": np.array(apart, np.uint32), "latin": latin, "alien": alien, "look": look, "pair": keys, "composed": np.array([pairs[int(k)] for k in keys], np.uint32),
    }


def decode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows in one array, and the rows' offsets in it; a NULL row is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = raw.to_pybytes()[at[0] : at[-1]] if raw is not None else b""
    starts = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    counts = np.concatenate(([0], np.cumsum(starts)))
    return np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le"), np.uint32), counts[at - at[0]].astype(np.int64)


def encode(cps: np.ndarray, offs: np.ndarray, valid: pa.Array | None = None) -> pa.Array:
    """The Arrow string array of flat code points; rows where ``valid`` is false are NULL."""
    width = 1 + (cps >= 0x80).astype(np.int64) + (cps >= 0x800) + (cps >= 0x10000)
    at = np.concatenate(([0], np.cumsum(width)))[offs]
    data = cps.astype("<u4").tobytes().decode("utf-32-le", "replace").encode("utf-8")
    out = pa.LargeStringArray.from_buffers(len(offs) - 1, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(data)).cast(pa.string())
    return pa.compute.if_else(valid, out, pa.scalar(None, pa.string())) if valid is not None else out


def low(cps: np.ndarray) -> np.ndarray:
    """Indices into the tables; characters beyond the basic plane read as a plain placeholder."""
    return np.where(cps < BMP, cps, 0xFFFF)


def rows_of(offs: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offs) - 1), np.diff(offs))


def offsets(row: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.bincount(row, minlength=n)))).astype(np.int64)


def expand(cps: np.ndarray, src: np.ndarray, length: np.ndarray, first: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Replaces the characters of ``length`` other than 1 by the run of ``flat`` that begins at ``first``."""
    total = int(length.sum())
    base = np.repeat(np.cumsum(length) - length, length)
    step = np.arange(total) - base
    out = np.repeat(cps, length)
    many = np.repeat(length != 1, length)
    out[many] = flat[(np.repeat(first, length) + step)[many]]
    return out, np.repeat(src, length)


def canonical(cps: np.ndarray, offs: np.ndarray, source: bool = False):
    """(code points, offsets, changed rows) of the consistent form; with ``source`` also the place in ``cps`` each code point came from.

    Rows without any character that a rule could touch are left as they are; the others are gathered, rewritten together
    and put back by offsets.
    """
    n = len(offs) - 1
    changed = np.zeros(n, bool)
    hit = tables()["any"][low(cps)]
    if not hit.any():
        return (cps, offs, changed, np.arange(len(cps))) if source else (cps, offs, changed)
    ids = np.unique(np.searchsorted(offs, np.flatnonzero(hit), "right") - 1)
    size = np.diff(offs)
    take = np.repeat(offs[ids], size[ids]) + ramp(size[ids])
    part, poffs, diff, psrc = rewrite(cps[take], np.concatenate(([0], np.cumsum(size[ids]))))
    changed[ids] = diff
    new = size.copy()
    new[ids] = np.diff(poffs)
    out_offs = np.concatenate(([0], np.cumsum(new))).astype(np.int64)
    out = np.empty(out_offs[-1], np.uint32)
    rest = np.ones(len(cps), bool)
    rest[take] = False
    free = np.ones(len(out), bool)
    free[np.repeat(out_offs[ids], new[ids]) + ramp(new[ids])] = False
    out[free] = cps[rest]
    out[~free] = part
    if not source:
        return out, out_offs, changed
    src = np.empty(len(out), np.int64)
    src[free], src[~free] = np.flatnonzero(rest), take[psrc]
    return out, out_offs, changed, src


def ramp(size: np.ndarray) -> np.ndarray:
    """0, 1, .. size-1 for each size, one after the other."""
    return np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)


def rewrite(cps: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code points, offsets, changed rows, the place each code point came from)."""
    t, n = tables(), len(offs) - 1
    was = row_hash(cps, offs)
    base = rows_of(offs)
    src = np.arange(len(cps))
    ix = low(cps)
    kind = t["kind"][ix]
    if kind.any():
        length = np.where(kind == DROP, 0, t["length"][ix])
        source = np.where(kind == ONE, t["to"][ix], cps).astype(np.uint32)
        cps, src = expand(source, src, length, t["start"][ix], t["flat"])
        ix = low(cps)
    ccc = t["ccc"][ix]
    if ccc.any():
        cps, src = compose(cps, src, base, ccc)
        ix = low(cps)
    row = base[src]
    odd = t["alien"][ix]
    if odd.any():
        inside = t["letter"][ix] | (t["ccc"][ix] > 0)
        new = np.concatenate(([True], (inside[1:] != inside[:-1]) | (row[1:] != row[:-1])))
        word = np.cumsum(new) - 1
        latin = np.bincount(word, t["latin"][ix])
        other = np.bincount(word, odd)
        twin = np.bincount(word, odd & (t["look"][ix] > 0))
        mixed = (latin > 0) & (other > 0) & ((twin == other) | (latin > other))
        hit = odd & mixed[word]
        cps = np.where(hit & (t["look"][ix] > 0), t["look"][ix], cps).astype(np.uint32)
    offs = offsets(row, n)
    return cps, offs, row_hash(cps, offs) != was, src


def compose(cps: np.ndarray, src: np.ndarray, rows: np.ndarray, ccc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters before marks are taken apart, marks put in their canonical order and composed with their base, one mark for every
    base a round, until none composes."""
    t = tables()
    row = rows[src]
    before_mark = np.concatenate(((ccc[1:] > 0) & (row[1:] == row[:-1]), [False])) & (ccc == 0)
    length = np.where(before_mark, t["apart_length"][low(cps)], 1)
    if (length > 1).any():
        cps, src = expand(cps, src, length, t["apart_start"][low(cps)], t["apart"])
        ccc, row = t["ccc"][low(cps)], rows[src]
    run = np.cumsum((ccc == 0) | np.concatenate(([True], row[1:] != row[:-1])))
    if ((ccc[1:] < ccc[:-1]) & (ccc[1:] > 0)).any():
        order = np.lexsort((np.arange(len(cps)), ccc, run))
        cps, ccc, src, row = cps[order], ccc[order], src[order], row[order]
    while True:
        at = np.flatnonzero(ccc)
        base = np.maximum.accumulate(np.where(ccc == 0, np.arange(len(cps)), -1))[at]
        ok = (base >= 0) & (row[base] == row[at])
        ok &= (at - 1 == base) | (ccc[at - 1] < ccc[at])
        at, base = at[ok], base[ok]
        if not len(at):
            break
        fits = (cps[base] < BMP) & (cps[at] < BMP)
        key = (cps[base].astype(np.uint64) << np.uint64(16) | cps[at]).astype(np.uint64)
        found = np.minimum(np.searchsorted(t["pair"], key), len(t["pair"]) - 1)
        hit = fits & (t["pair"][found] == key)
        if not hit.any():
            break
        base, at, found = base[hit], at[hit], found[hit]
        base, first = np.unique(base, return_index=True)
        at, found = at[first], found[first]
        cps = cps.copy()
        cps[base] = t["composed"][found]
        keep = np.ones(len(cps), bool)
        keep[at] = False
        cps, src, row, ccc = cps[keep], src[keep], row[keep], ccc[keep]
    return cps, src


# ---------------------------------------------------------------------------------------------------------------------
# A key under which misread variants of a text fall together.

# Letters and signs that scanning confuses, each with the class that stands for them.
CONFUSED = {
    "e": "c", "u": "n", "r": "t", "k": "t", "f": "s", "ſ": "s", "5": "s", "h": "b", "6": "b", "é": "b", "ß": "b", "8": "b", "l": "i", "1": "i", "|": "i", "q": "g", "9": "g",
    "0": "o", "v": "o", "p": "o", "m": "tn", "d": "ci", "w": "oo", "ü": "ii", "ä": "ii",
}


@functools.cache
def skeleton_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    t = tables()
    length = (t["letter"] | t["digit"]).astype(np.int64)
    first, flat = np.zeros(BMP, np.int64), []
    for c in range(BMP):
        if length[c]:
            first[c] = len(flat)
            flat.append(int(t["lower"][c]))
    for a, b in CONFUSED.items():
        for c in {ord(a), ord(a.upper()) if len(a.upper()) == 1 else ord(a)}:
            first[c], length[c] = len(flat), len(b)
            flat += [ord(x) for x in b]
    return length, first, np.array(flat, np.uint32)


def skeleton(cps: np.ndarray, offs: np.ndarray, spaces: bool = False, source: bool = False):
    """Letters and digits by their class of confusion, runs of one class once (runs of digits stay), the rest dropped.

    Applied to canonical code points. With ``spaces`` every run of other characters is one space, so that words stay
    apart. With ``source`` a third array gives, for each character, its index in ``cps``.
    """
    t = tables()
    length, first, flat = skeleton_tables()
    ix, row = low(cps), rows_of(offs)
    size = length[ix]
    isdigit = t["digit"][ix]
    if spaces:
        size = np.where((size == 0) & (t["ccc"][ix] == 0), 1, size)
    total = int(size.sum())
    base = np.repeat(np.cumsum(size) - size, size)
    step = np.arange(total) - base
    real = np.repeat(length[ix] > 0, size)
    out = np.full(total, 32, np.uint32)
    out[real] = flat[(np.repeat(first[ix], size) + step)[real]]
    row, isdigit = np.repeat(row, size), np.repeat(isdigit, size)
    src = np.repeat(np.arange(len(cps)), size) if source else None
    if total:
        same = np.concatenate(([False], (out[1:] == out[:-1]) & (row[1:] == row[:-1]) & ~(isdigit[1:] & isdigit[:-1])))
        out, row = out[~same], row[~same]
        src = src[~same] if source else None
    offs2 = offsets(row, len(offs) - 1)
    return (out, offs2, src) if source else (out, offs2)


MIX = np.uint64(0x9E3779B97F4A7C15)


def polynomial(cps: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit value for each code point."""
    x = (cps.astype(np.uint64) + np.uint64(1)) * MIX
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@functools.cache
def powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, MIX, np.uint64), dtype=np.uint64)


def row_hash(cps: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """64-bit hash of each row: the sum of mixed code points times powers of their place, taken by prefix sums."""
    with np.errstate(over="ignore"):
        n = np.diff(offs)
        place = np.arange(len(cps)) - np.repeat(offs[:-1], n)
        width = 1 << max(4, int(n.max()).bit_length()) if len(n) else 16
        value = polynomial(cps) * powers(width)[place] if len(cps) else np.zeros(0, np.uint64)
        total = np.concatenate(([np.uint64(0)], np.cumsum(value, dtype=np.uint64)))
        return finish(total[offs[1:]] - total[offs[:-1]], n)


def finish(h: np.ndarray, n: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h ^ (n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        return (x ^ (x >> np.uint64(32))).view(np.int64)


# ---------------------------------------------------------------------------------------------------------------------


def with_canonical(df: DataFrame, column: str, out: str = "canonical", changed: str = "changed") -> DataFrame:
    """Adds ``out``, the consistent form of ``column``, and ``changed``, whether it differs; other columns pass through."""
    ship(df.sparkSession)
    name, schema = column, [f for f in df.schema.fields if f.name not in (out, changed)]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column(name)
            cps, offs = decode(text)
            cps, offs, diff = canonical(cps, offs)
            arrays = [b.column(f.name) for f in schema] + [encode(cps, offs, text.is_valid()), pa.array(diff)]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema] + [out, changed])

    return df.select(*[F.col(f"`{f.name}`") for f in schema]).mapInArrow(run, f"{fields}, `{out}` string, `{changed}` boolean")


def texts_of(ocr: DataFrame, lines: DataFrame) -> DataFrame:
    """The rows (tab, row_id, text) of both tables."""
    a = ocr.select(F.lit("ocr").alias("tab"), "row_id", F.col("ocr_text").alias("text"))
    return a.unionByName(lines.select(F.lit("lines").alias("tab"), "row_id", F.col("annotation").alias("text")))


def look_alikes(ocr: DataFrame, lines: DataFrame) -> DataFrame:
    """(tab, row_id) of the rows whose text is not in the consistent form."""
    return with_canonical(texts_of(ocr, lines), "text").filter("changed").select("tab", "row_id")
