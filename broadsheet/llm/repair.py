"""Problem 4: text of scanned pages as continuous, readable paragraphs.

* Headers and footers: titles that repeat at the edges of a paper's pages, with date and numbers aside (``headers``).
* Page numbers: running text that is only a number of the sequence of its issue's page numbers (``headers.page_number``).
* Hyphens: a line that ends in a letter and a hyphen goes on in the page's next line of running text, unless the hyphen hangs: before
  a word that keeps it, or before one of the corpus's most frequent words if the vocabulary does not know the two joined.
* Misread words: the corpus vocabulary counts whole words, those broken at a line end joined. A rare word that is a
  likely misreading (letters that scanning confuses, one lost, one doubled) of a word many times as frequent is misread, and so
  is a word with a digit or bar among its letters.

NULL, empty and unlettered texts have no defect but may stand for the next line of a broken word; a line that is broken though
nothing follows is still broken. Rows without a page have no neighbours, are no part of a page's text, and each is a group of its own. A page is read in order within one task:
its lines are bounded by the sheet, and the sort spills.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.paths import main_page
from broadsheet.llm.chars import canonical, decode, encode, low, tables
from broadsheet.llm.features import Words, numbered, reading_place
from broadsheet.llm.headers import page_number, titles, with_headers
from broadsheet.session import BROADCAST_LIMIT, broadcast_if_small, ship, size_of, write_shared

# Hyphens at line ends, in the consistent form; words before which a hanging hyphen stays.
HYPHENS = "-¬⸗=‐‑"
HYPHEN_SET = set(HYPHENS)
KEEP_BEFORE = ["und", "and", "et", "u", "oder", "or", "ou"]
# Letters that scanning confuses, both ways; letters read as a sign; letters that melt or fall apart, both ways.
EITHER_WAY = ["ec", "un", "rt", "sf", "hb", "gq", "vp", "vo", "tk"]
ONE_WAY = ["i1", "l1", "l|", "s5", "o0", "b6", "é6", "ßb"]
APART = [("m", "rn"), ("d", "cl"), ("w", "vv"), ("ü", "ii"), ("ä", "ii"), ("nn", "im")]

#: A word is one of the most frequent if it is one in so many of all words.
FREQUENT = 500
#: A word must be this frequent before others count as its misreadings.
MIN_COUNT = 10
#: (times as frequent, most occurrences of the misreading beside a share of the word's) by kind of misreading.
CONFUSED_RATIO, CONFUSED_FREE, CONFUSED_SHARE = 10, 4, 1 / 60
LOST_RATIO, LOST_FREE, LOST_SHARE = 25, 3, 1 / 1000
#: Letters of the shortest word with a letter lost or doubled.
LOST_LENGTH = 5
#: Bits of a hash by which most words are told from the misread ones.
MARKS = (1 << 20) - 1


def rows_of(ocr: DataFrame, lines: DataFrame, paper: DataFrame) -> DataFrame:
    """The lines of both tables in one form: tab, row_id, paper, page, label, place, text."""
    a = ocr.select(F.lit("ocr").alias("tab"), "row_id", F.col("paper_code").alias("paper"), F.col("page_path").alias("page"), "label", reading_place(F.col("block_id"), F.col("line_id")).alias("place"), F.col("ocr_text").alias("text"))
    path = F.split("line_path", "/")
    b = main_page(lines, paper).select(
        F.lit("lines").alias("tab"), "row_id", F.substring_index("page", "/", 1).alias("paper"), "page", F.get(path, F.lit(1)).alias("label"),
        reading_place(F.get(path, F.lit(2)), F.get(path, F.lit(3)).try_cast("int")).alias("place"), F.col("annotation").alias("text"),
    )
    return a.unionByName(b)


def prepared(rows: DataFrame) -> DataFrame:
    """The text in the consistent form, with its title and page number; written once to the shared folder."""
    ship(rows.sparkSession)
    kept = [c for c in rows.columns if c != "text"]
    named = rows.select(*kept, "text")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema.fields) + ", skel string, title string, pagenum string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solid = tables()["letter"] | tables()["digit"]
        for b in batches:
            text = b.column("text")
            cps, offs, _ = canonical(*decode(text))
            found = numbered(cps, offs)
            # of the skeleton only whether there is one is asked for
            upto = np.concatenate(([0], np.cumsum(solid[low(cps)])))
            some = upto[offs[1:]] > upto[offs[:-1]]
            skel = pa.compute.if_else(pa.array(some), "x", "")
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], encode(cps, offs, text.is_valid()), skel, found["title"], found["pagenum"]], names=[*kept, "text", "skel", "title", "pagenum"])

    return page_number(write_shared(named.mapInArrow(run, schema), "page-lines"))


BROKEN = re.compile(r"([^\W_]+)[\u0300-\u036f]*[" + HYPHENS.replace("-", r"\-") + r"]+\s*$")
FIRST = re.compile(r"^[^\w|]*([\w|][\w|\u0300-\u036f]*)")


@functools.cache
def last_bytes() -> np.ndarray:
    """Whether a text whose UTF-8 ends in this byte may end in a hyphen, or in a space after one."""
    may = np.zeros(256, bool)
    may[[c.encode()[-1] for c in [*HYPHENS, *(chr(x) for x in range(1 << 16) if chr(x).isspace())]]] = True
    return may


def may_break(texts: pa.Array) -> np.ndarray:
    """The rows whose text may end in a hyphen, by its last byte; all that do are among them."""
    texts = texts.cast(pa.large_string())
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    full = np.flatnonzero((at[1:] > at[:-1]) & texts.is_valid().to_numpy(zero_copy_only=False))
    return full[last_bytes()[np.frombuffer(texts.buffers()[2], np.uint8)[at[full + 1] - 1]]] if len(full) else full


def broken_word(text: str) -> str | None:
    """The last word of a text that ends in a letter and a hyphen, in lower case."""
    t = text.rstrip()
    if t[-1:] not in HYPHEN_SET:
        return None
    m = BROKEN.search(t, t.rfind(" ") + 1)  # no space is within a match
    return m[1].lower() if m else None


def neighbours(chunk: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    """Rows sorted by page, place, running text first, row_id, with ``broken``, ``before`` and ``after``; the first lines of running text at their places."""
    n = len(chunk)
    pages, place, texts = chunk.column("page"), chunk.column("place").to_numpy(zero_copy_only=False), chunk.column("text")
    turns = pa.compute.not_equal(pages[1:], pages[:-1]).to_numpy(zero_copy_only=False)
    page = np.cumsum(np.concatenate(([True], turns))) - 1
    words, code = [""], np.zeros(n, np.int64)  # the broken word of each row, by its place in words
    maybe = may_break(texts)
    for i, t in zip(maybe.tolist(), texts.take(pa.array(maybe)).to_pylist()):
        if (w := broken_word(t)) is not None:
            code[i] = len(words)
            words.append(w)
    broken = code > 0
    opens = np.concatenate(([True], turns | (place[1:] != place[:-1])))
    group = np.cumsum(opens) - 1
    head = np.flatnonzero(opens & (chunk.column("aside").to_numpy(zero_copy_only=False) == 0))
    before, after, follows = np.full(n, -1), np.full(n, -1), []
    if len(head):
        mine = np.searchsorted(head, np.arange(n), "right") - 1  # the head at or before each row
        same = (mine >= 0) & (group[head[np.maximum(mine, 0)]] == group)
        prior, coming = np.where(same, mine - 1, mine), mine + 1
        ok = (prior >= 0) & (page[head[np.maximum(prior, 0)]] == page)
        before[ok] = code[head[prior[ok]]]
        ok = broken & (coming < len(head))
        ok[ok] = page[head[coming[ok]]] == page[ok]
        after[ok] = np.arange(np.count_nonzero(ok))
        follows = [m[1].lower() if t and (m := FIRST.search(t)) else "" for t in texts.take(pa.array(head[coming[ok]])).to_pylist()]
    spread = lambda values, at: pa.array(values, pa.string()).take(pa.array(at, mask=at < 0))
    return pa.RecordBatch.from_arrays([*chunk.columns, pa.array(broken), spread(words, before), spread(follows, after)], names=[*chunk.schema.names, "broken", "before", "after"]), head


def with_neighbours(f: DataFrame) -> DataFrame:
    """Adds ``broken``; of a broken line ``after``, the first word of the next line of running text; ``before``, the last word of the line before, if that is broken.

    The neighbours of a hand annotation, and of a line loaded again, are those of the first recognised line at its place.
    Rows are sorted within hash partitions of the page and streamed; of an open page only the last two lines are held.
    """
    ship(f.sparkSession)
    flows = (F.col("tab") == "ocr") & (F.coalesce("label", F.lit("TEXT")) == "TEXT") & ~F.col("is_pagenum") & ~F.col("is_header")
    alone = F.concat(F.lit("\u0001"), "tab", F.lit("/"), F.coalesce(F.col("row_id").cast("string"), F.lit("")))
    rows = f.select("tab", "row_id", F.coalesce("page", alone).alias("page"), "place", F.when(flows, 0).otherwise(1).alias("aside"), "text", "is_header", "is_pagenum")
    columns = [*(c for c in rows.columns if c != "aside"), "broken", "before", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = None, 0
        for batch in batches:
            if not len(batch):
                continue
            chunk = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            found, head = neighbours(chunk)
            if len(head) < 2:
                held = chunk
            else:
                keep, cut = int(head[-2]), int(head[-1])
                yield found.slice(done, cut - done).select(columns)
                held, done = chunk.slice(keep), cut - keep
        if held is not None:
            yield neighbours(held)[0].slice(done).select(columns)

    kinds = ", ".join(f"{x.name} {x.dataType.simpleString()}" for x in rows.schema.fields if x.name != "aside") + ", broken boolean, before string, after string"
    done = rows.repartition("page").sortWithinPartitions("page", "place", "aside", "row_id").mapInArrow(run, kinds)
    return done.withColumn("page", F.when(~F.col("page").startswith("\u0001"), F.col("page")))


class Listed:
    """The words of a batch of lines, as they are looked up: whole words, and those joined over a line end with the part that is in the line."""

    def __init__(self, b: pa.RecordBatch):
        cps, offs = decode(b.column("text"))
        w = self.words = Words(cps, offs)
        before, after = b.column("before"), b.column("after")
        start = np.cumsum(w.count) - w.count
        filled = lambda x: pa.compute.greater(pa.compute.binary_length(x), 0).fill_null(False).to_numpy(zero_copy_only=False)
        ends = np.flatnonzero(filled(before) & (w.count > 0))  # rows whose first word ends one, and those whose last word begins one
        opens = np.flatnonzero(b.column("broken").to_numpy(zero_copy_only=False) & (w.count > 0))
        whole = np.ones(len(w.row), bool)
        whole[start[ends]] = False
        whole[start[opens] + w.count[opens] - 1] = False
        opens = opens[(filled(after) & ~pa.compute.is_in(after, pa.array(KEEP_BEFORE, after.type)).to_numpy(zero_copy_only=False))[opens]]
        first, last = start[ends], start[opens] + w.count[opens] - 1
        prior, coming = before.take(pa.array(ends)), after.take(pa.array(opens))
        join = lambda x, y: pa.compute.binary_join_element_wise(x.cast(pa.string()), y.cast(pa.string()), "")
        joined = pa.concat_arrays([join(prior, w.texts(first)), join(w.texts(last), coming)])
        length = pa.compute.utf8_length(prior).to_numpy(zero_copy_only=False).astype(np.int64)
        self.whole = np.flatnonzero(whole)
        self.joined = Words(*decode(joined))
        # a joined text may hold other signs only if a part did: keep those that are one word
        self.of = self.joined.row
        self.joined_row = np.concatenate((ends, opens))
        self.lo = np.concatenate((length, np.zeros(len(opens), np.int64)))
        self.hi = np.concatenate((length + w.size[first] + 1, w.size[last]))
        self.begins = np.arange(len(joined)) >= len(ends)


def chunks(batches: Iterator[pa.RecordBatch], rows: int = 40_000) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have ``rows`` rows."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(len(x) for x in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held = []
    if sum(len(x) for x in held):
        yield pa.Table.from_batches([x for x in held if len(x)]).combine_chunks().to_batches()[0]


def vocabulary(r: DataFrame) -> DataFrame:
    """(word, h, n): whole words of the lines, broken ones joined at the line where they begin; counted in numpy within batches, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            found = Listed(b)
            for w, which in ((found.words, found.whole), (found.joined, np.flatnonzero(found.begins[found.of]) if len(found.of) else found.of)):
                if len(which):
                    each = pa.array(w.hash[which]).dictionary_encode()
                    code = each.indices.to_numpy(zero_copy_only=False)
                    one = np.empty(len(each.dictionary), np.int64)  # a place of each word
                    one[code] = which
                    yield pa.RecordBatch.from_arrays([w.texts(one), each.dictionary, pa.array(np.bincount(code))], names=["word", "h", "n"])

    counted = r.select("text", "before", "after", "broken").mapInArrow(run, "word string, h bigint, n bigint")
    return counted.groupBy("h").agg(F.min("word").alias("word"), F.sum("n").alias("n"))


def readings(word: str) -> Iterator[tuple[str, bool]]:
    """(misreading, whether a letter is lost or doubled) of a word."""
    for i, c in enumerate(word):
        for a, b in EITHER_WAY:
            if c == a or c == b:
                yield word[:i] + (b if c == a else a) + word[i + 1 :], False
        for a, b in ONE_WAY:
            if c == a:
                yield word[:i] + b + word[i + 1 :], False
        if len(word) >= LOST_LENGTH and c.isalpha():
            yield word[:i] + c + word[i:], True
            yield word[:i] + word[i + 1 :], True
    for x, y in APART:
        for a, b in ((x, y), (y, x)):
            k = word.find(a)
            while k >= 0:
                yield word[:k] + b + word[k + len(a) :], False
                k = word.find(a, k + 1)


def misreadings(vocab: DataFrame) -> DataFrame:
    """(word, right, at): each misread word of the vocabulary, the likeliest right one (NULL if none is known), the first letter that differs."""
    ship(vocab.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(w, v, n, lost) for v, n in zip(frame["word"], frame["n"]) if any(c.isalpha() for c in v) and not any(c.isdigit() or c == "|" for c in v) for w, lost in readings(v)]
            for k in range(0, len(out), 200_000):
                yield pd.DataFrame(out[k : k + 200_000], columns=["word", "right", "times", "lost"])

    forms = vocab.filter(F.col("n") >= MIN_COUNT).mapInPandas(run, "word string, right string, times bigint, lost boolean")
    n, times, lost = F.col("n"), F.col("times"), F.col("lost")
    odd = F.col("word").rlike(r"\p{L}") & F.col("word").rlike(r"[\p{Nd}|]")
    seldom = F.when(lost, (times >= n * LOST_RATIO) & (n <= LOST_FREE + times * LOST_SHARE)).otherwise((times >= n * CONFUSED_RATIO) & (n <= CONFUSED_FREE + times * CONFUSED_SHARE))
    fit = forms.join(vocab, "word").filter(F.when(odd, times > n).otherwise(seldom))
    best = fit.groupBy("word").agg(F.max_by("right", F.struct("times", "right")).alias("right"))
    signs = vocab.filter(odd & F.col("word").rlike(r"\p{L}[\p{Nd}|]|[\p{Nd}|]\p{L}{2}") & (F.length(F.regexp_replace("word", r"[^\p{L}]", "")) >= 2)).select("word")
    all_words = best.join(signs.withColumn("sign", F.lit(True)), "word", "full_outer").select("word", "right")
    shared = F.size(F.filter(F.sequence(F.lit(1), F.length("word")), lambda i: F.expr("right").substr(F.lit(1), i) == F.expr("word").substr(F.lit(1), i)))
    sign = F.expr("length(regexp_substr(concat('x', word), '^[^0-9|]*')) - 1")
    return all_words.withColumn("at", F.coalesce(shared, sign)).join(vocab.select("word", "h"), "word")


def looked_up(r: DataFrame, misread: DataFrame) -> DataFrame:
    """(tab, row_id, word, right) of the misread words of each line whose misread letter is in the line.

    A table of misreadings within ``broadcast_if_small``'s bound goes to every task as sorted hashes; a larger one is joined to
    the hashed words by shuffle.
    """
    spark = r.sparkSession
    columns = ["tab", "row_id", "text", "before", "after", "broken"]
    schema = "tab string, row_id bigint, h bigint, lo int, hi int"
    held = None
    if size_of(misread) * 8 <= BROADCAST_LIMIT:
        held = spark.sparkContext.broadcast(np.sort(np.array([x["h"] for x in misread.select("h").toLocalIterator()], np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value if held is not None else np.zeros(0, np.int64)
        marked = np.zeros(MARKS + 1, bool)  # most words are none of them by the last bits of their hash
        marked[known & MARKS] = True
        for b in chunks(batches):
            found = Listed(b)
            w, which, j = found.words, found.whole, found.joined
            h = np.concatenate((w.hash[which], j.hash))
            row, lo, hi = (np.concatenate((x, y[found.of])) for x, y in ((w.row[which], found.joined_row), (np.zeros(len(which), np.int64), found.lo), (np.full(len(which), 1 << 20), found.hi)))
            if held is not None:
                hit = np.flatnonzero(marked[h & MARKS])
                hit = hit[known[np.minimum(np.searchsorted(known, h[hit]), len(known) - 1)] == h[hit]]
                row, h, lo, hi = row[hit], h[hit], lo[hit], hi[hit]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(h), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], names=["tab", "row_id", "h", "lo", "hi"])

    hits = r.select(*columns).mapInArrow(run, schema)
    return hits.join(broadcast_if_small(misread), "h").filter((F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi"))).select("tab", "row_id", "word", "right", "lo", "hi")


class Repair:
    """The stages of the repair over one corpus; each is made once."""

    def __init__(self, ocr: DataFrame, lines: DataFrame, paper: DataFrame):
        f = prepared(rows_of(ocr, lines, paper))
        running = broadcast_if_small(write_shared(titles(f.filter("tab = 'ocr'")), "titles"))
        self.rows = write_shared(with_neighbours(with_headers(f, running)), "page-order")
        self.vocab = write_shared(vocabulary(self.rows), "vocabulary")
        self.misread = write_shared(misreadings(self.vocab), "misreadings")

    def misread_words(self) -> DataFrame:
        """(tab, row_id, word, right) of the misread words of each line."""
        return looked_up(self.rows, self.misread)

    def frequent(self) -> list[str]:
        """The words of which one is met in ``FREQUENT`` words of the corpus: no more than that many."""
        total = self.vocab.agg(F.sum("n")).first()[0] or 0
        return sorted(r["word"] for r in self.vocab.filter(F.col("n") * FREQUENT >= F.lit(total)).select("word").collect())

    def joined(self, rows: DataFrame) -> DataFrame:
        """Adds ``known``: whether the corpus has the word that a broken line and the next one make, more than this once."""
        last = F.regexp_extract(F.lower("text"), r"([\p{L}\p{M}\p{N}|]+)[^\p{L}\p{M}\p{N}|]*$", 1)
        word = F.when(F.col("broken") & (F.coalesce("after", F.lit("")) != ""), F.concat(last, F.col("after")))
        known = self.vocab.filter("n > 1").select(F.col("word").alias("__joined"), F.lit(True).alias("known"))
        open_rows = rows.filter("broken").withColumn("__joined", F.coalesce(word, F.concat(F.lit("\0"), F.col("row_id").cast("string")))).join(known, "__joined", "left").withColumn("known", F.coalesce("known", F.lit(False)))
        return open_rows.drop("__joined").unionByName(rows.filter("NOT broken").withColumn("known", F.lit(False)))

    def hangs(self, frequent: list[str]) -> Column:
        """Whether a hyphen at a line's end is kept, of rows with ``known``."""
        after = F.coalesce("after", F.lit(""))
        return after.isin(KEEP_BEFORE) | (after.isin(frequent) & ~F.col("known"))

    def defects(self) -> DataFrame:
        """(tab, row_id, kind), one row for each kind of defect of a line."""
        frequent = self.frequent()
        broken = self.rows.filter("broken AND NOT is_header")
        doubt = F.coalesce(F.col("after").isin([w for w in frequent if w not in KEEP_BEFORE]), F.lit(False))
        sure = broken.filter(~doubt & ~F.coalesce(F.col("after").isin(KEEP_BEFORE), F.lit(False)))
        hyphen = sure.unionByName(self.joined(broken.filter(doubt)).filter(~self.hangs(frequent)).drop("known"))
        kinds = F.array_compact(F.array(F.when(F.col("is_header"), "header"), F.when(F.col("is_pagenum") & (F.col("tab") == "ocr"), "pagenum")))
        plain = self.rows.select("tab", "row_id", F.explode(kinds).alias("kind"))
        bad = self.misread_words().select("tab", "row_id").distinct().withColumn("kind", F.lit("misread"))
        return plain.unionByName(hyphen.select("tab", "row_id", F.lit("hyphen").alias("kind"))).unionByName(bad)

    def paragraphs(self) -> DataFrame:
        """(page_path, text): each page as continuous paragraphs, without headers and page numbers, broken words joined, misread words put right.

        A line loaded again counts once. A broken word loses its hyphen if it goes on in lower case or the corpus knows the joined
        word; it keeps it where it hangs and in compounds the corpus does not know. A page's lines are brought
        together, of which there are no more than on a sheet.
        """
        flows = self.rows.filter("tab = 'ocr' AND NOT is_header AND NOT is_pagenum AND text IS NOT NULL AND page IS NOT NULL")
        one = flows.groupBy("page", "place").agg(F.min_by(F.struct("row_id", "text", "broken", "after"), "row_id").alias("r")).select("page", "place", "r.*")
        one = self.joined(one)
        keeps = self.hangs(self.frequent())
        lines = one.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("place", "text", "broken", keeps.alias("keeps"), "known"))).alias("lines"))
        fixes = self.misread_words().filter("tab = 'ocr' AND right IS NOT NULL").join(one.select("row_id", "page"), "row_id")
        fixes = fixes.groupBy("page").agg(F.collect_set(F.struct("word", "right")).alias("fixes"))
        ship(self.rows.sparkSession)

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                yield pd.DataFrame({"page_path": f["page"], "text": [page_text(a, b) for a, b in zip(f["lines"], f["fixes"])]})

        return lines.join(fixes, "page", "left").select("page", "lines", "fixes").mapInPandas(run, "page_path string, text string")


TOKEN = re.compile(r"[\w|][\w|̀-ͯ]*")


def page_text(lines: list[dict], fixes: list[dict] | None) -> str:
    """The paragraphs of one page, blank lines between them; lines in reading order."""
    right = {x["word"]: x["right"] for x in fixes} if fixes is not None else {}
    out, block, open_word, out_known, out_keeps = "", None, False, False, False
    for line in lines:
        text = line["text"].strip()
        if not text:
            continue
        now = line["place"] >> 24
        if open_word:
            out = out if text[:1].isupper() and not out_known else out.rstrip(HYPHENS)
            out += text
        else:
            out += ("" if not out else " " if now == block or out_keeps else "\n\n") + text
        block, out_known, out_keeps = now, line["known"], line["broken"] and line["keeps"]
        open_word = line["broken"] and not line["keeps"]

    def fix(m: re.Match) -> str:
        word = right.get(m[0].lower())
        if word is None:
            return m[0]
        return word.upper() if m[0].isupper() and len(m[0]) > 1 else word.capitalize() if m[0][:1].isupper() else word

    return TOKEN.sub(fix, out) if right else out
