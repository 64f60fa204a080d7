"""Problem 1: the same or nearly the same annotation in the training and in the validation set.

Rows with the same letters and digits (case, spacing, punctuation and look-alike characters aside) are one wording; all further
work is on wordings and comes back to rows at the end. A wording's words become skeletons, so most misread letters vanish.

1. A wording's word n-grams are the pairs of its words at most ``GAP`` places apart, every word and every pair of them (of a wording of
   up to ``SHORT`` words the single words too). The containment of a validation wording in a training wording is the share of its
   n-grams that the other has; from ``CONTAINED`` on the two may be a pair, if their numbers are the same but for one lacking.
2. Two wordings of that containment that agree word by word have three words in common within ``GAP`` places of each other, whatever their order
   (of a wording of up to five words two, of up to two words one): with one word lacking on either side or moved there is no other way to share so
   many n-grams. So wordings meet by these words, hashed together with the numbers. A lacking number is found by keys with one number taken
   out, of one side only.
3. A key brings its wording along, and wordings that meet are compared there and then: by a bitmap of their words, by containment, then word
   by word (each may lack one word, letters may be wrong, lost or added, numbers and established names must be the same). Only pairs that
   are found are written, so what is on disk does not grow with the wordings that merely meet.
4. The keys are made in up to ``ROUNDS`` rounds, each of a share of all keys, and a round's files go before the next begins.

What counts as a name, as common or as a misreading follows from shares of the wordings that hold a word, less an allowance for chance
(the root of the count), and not from counts: it is the same at every size of the corpus.

A key of very many wordings is cut into parts. NULL and empty annotations and rows outside both sets have no pair. Repeated saves
are rows of their own.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.paths import main_page
from broadsheet.llm.chars import canonical, decode, encode, low, offsets, rows_of, skeleton, tables
from broadsheet.session import broadcast_if_small, drop_shared, release, ship, size_of, write_shared

#: Letters that may differ: four on either side.
MAX_LETTERS = 8
#: Farthest words of an n-gram; words of the longest wording whose single words count; least containment of a pair.
GAP, SHORT, CONTAINED = 3, 4, 0.3
#: Words of the longest wordings that meet by one word and by two.
ONE, TWO = 2, 5
#: Most rounds of keys, and the bytes of written wordings from which there is one more.
ROUNDS, ROUND_BYTES = 12, 2 << 20
#: A key held by more wordings of training is joined in parts of this size; training wordings by which such keys are told.
HOT, SAMPLE = 5_000, 20_000
#: A word is a word of its own beside one that is up to so many times as frequent; beside a short one; rare beside another.
OWN, OWN_SHORT, RARE = 10, 100, 20
#: A word is common, and no name, if one wording in so many holds it.
COMMON = 500


def split_of(training, validation):
    """'training', 'validation' or NULL, for a line of neither or of both."""
    t, v = F.coalesce(training, F.lit(False)), F.coalesce(validation, F.lit(False))
    return F.when(t & ~v, "training").when(v & ~t, "validation")


def with_words(df: DataFrame, column: str) -> DataFrame:
    """Adds ``plain``: the text's words in lower case, and ``skels``: their skeletons, both joined by spaces; ``column`` is left out."""
    ship(df.sparkSession)
    kept = [f.name for f in df.schema.fields if f.name != column]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != column) + ", plain string, skels string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables()
        for b in batches:
            cps, offs, _ = canonical(*decode(b.column(column)))
            ix, row, n = low(cps), rows_of(offs), len(offs) - 1
            solid = t["letter"][ix] | t["digit"][ix] | (t["ccc"][ix] > 0) | (cps == 124)  # a bar is a misread l
            gap = ~solid & np.concatenate(([False], solid[:-1] & (row[1:] == row[:-1])))
            keep = solid | gap
            plain = np.where(solid, t["lower"][ix], 32)[keep].astype(np.uint32)
            at = offsets(row[keep], n)
            skel, soffs = skeleton(plain, at, spaces=True)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], encode(plain, at), encode(skel, soffs)], names=[*kept, "plain", "skels"])

    return df.select(*kept, column).mapInArrow(run, schema)


def lost(a: str, b: str, most: int) -> int:
    """Edit distance of two skeletons, ``most + 1`` if larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        if min(now) > most:
            return most + 1
        before = now
    return before[-1]


def surely(n: int) -> float:
    """A count less what chance may have added."""
    return n - 1.5 * n**0.5


def least_common(wordings: int) -> float:
    """The count from which a word is held by one wording in ``COMMON``, three standard deviations allowed for chance."""
    share = wordings / COMMON
    return ((3 + (9 + 4 * share) ** 0.5) / 2) ** 2


def word_cost(a: str, b: str, sa: str, sb: str, na: int, nb: int) -> int:
    """Letters by which two words differ if one is a misreading of the other, else a cost beyond ``MAX_LETTERS``.

    ``na`` and ``nb`` are the wordings that hold them.
    """
    never = MAX_LETTERS + 1
    if a == b:
        return 0
    if a.isdigit() or b.isdigit():
        return never
    low, high = min(na, nb), max(na, nb)
    if surely(low) > high / OWN:
        return never
    if sa == sb:
        return 1
    longer, shorter = max(len(sa), len(sb)), min(len(sa), len(sb))
    if shorter < 3:
        return 1 if longer - shorter <= 1 and longer <= 4 and surely(low) <= high / OWN_SHORT and lost(sa, sb, 1) <= 1 else never
    most = 1 if longer < 6 else min(4, longer // 3)
    d = lost(sa, sb, most)
    if d > most:
        return never
    if d > longer - shorter and surely(low) > high / RARE - 0.75:
        # wrong letters that no confusion explains: only a rare word beside a frequent one, or a short slip of a word hardly seen
        return d if d <= 2 and longer - shorter and surely(low) <= high / RARE - 0.55 else never
    return d


def same_wording(a: list[str], b: list[str], sa: list[str], sb: list[str], counts: dict[str, int], common: float) -> bool:
    """Whether two wordings agree but for ``MAX_LETTERS`` letters and one word lacking on either side.

    Two words lacking at the same place would be one word put for another: only words that at least ``common`` wordings hold may
    do so, which names, places and numbers do not.
    """
    if abs(len(a) - len(b)) > 1:
        return False
    inf = MAX_LETTERS + 1
    free = lambda w: counts.get(w, 0) >= common and not w.isdigit()
    # (words taken of a, lacking in b, lacking in a, whether a gap was just made and by which side) -> letters so far
    states = {(0, 0, 0, 0): 0}
    while states:
        fresh: dict[tuple[int, int, int, int], int] = {}
        for (i, x, y, gap), c in states.items():
            j = i - x + y
            if i == len(a) and j == len(b):
                return True
            moves = []
            if i < len(a) and j < len(b):
                moves.append(((i + 1, x, y, 0), c + word_cost(a[i], b[j], sa[i], sb[j], counts.get(a[i], 0), counts.get(b[j], 0))))
            if x == 0 and i < len(a) and (gap != 2 or (free(a[i]) and free(b[j - 1]))):
                moves.append(((i + 1, 1, y, 1), c))
            if y == 0 and j < len(b) and (gap != 1 or (free(b[j]) and free(a[i - 1]))):
                moves.append(((i, x, 1, 2), c))
            for state, cost in moves:
                if cost < inf and cost < fresh.get(state, inf):
                    fresh[state] = cost
        states = fresh
    return False


@lru_cache(1 << 18)
def word_hash(word: str) -> int:
    return int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little")


def grams(words: list[str]) -> set[tuple[str, ...]]:
    """The word n-grams of a wording, each once."""
    found = {p for g in range(1, GAP + 1) for p in zip(words, words[g:])}
    return found | {(w,) for w in words} if len(words) <= SHORT else found


def least_words(words: list[str]) -> int:
    """Distinct words that a wording must share with another to have ``CONTAINED`` of its n-grams in common.

    So many places hold at most ``edges`` pairs, and a repeated word stands at several.
    """
    edges = lambda n: n * (n - 1) // 2 if n <= GAP else GAP * n - GAP * (GAP + 1) // 2
    least, again, k = math.ceil(CONTAINED * len(grams(words)) - 1e-9), len(words) - len(set(words)), 1
    while edges(k + again) + k * (len(words) <= SHORT) < least:
        k += 1
    return k


@lru_cache(1 << 10)
def least_of_size(n: int) -> int:
    """``least_words`` of n words of which none is repeated."""
    return least_words([str(i) for i in range(n)])


def signatures(plain: str) -> list[tuple[bool, int]]:
    """(whether a number was taken out, hash) of a wording's numbers, and of them with each one taken out."""
    nums = sorted(re.findall(r"(?<![^ ])[0-9]+(?![^ ])", plain))
    taken = dict.fromkeys(" ".join(nums[:i] + nums[i + 1 :]) for i in range(len(nums)))
    return [(False, word_hash("#" + " ".join(nums))), *((True, word_hash("#" + x)) for x in taken)]


def word_sets(h: np.ndarray, start: np.ndarray, seek: bool) -> tuple[np.ndarray, np.ndarray]:
    """(wording, hash) of the words of which one set must be shared; ``h`` has the hashes of all words, ``start`` where each wording begins.

    ``seek``: the sets that a validation wording looks for; else those by which one of up to a word more or less may look.
    """
    n, at = np.diff(start), np.arange(len(h))
    row = np.repeat(np.arange(len(n)), n)
    size, end, more = n[row], start[1:][row], 0 if seek else 1
    within = lambda lowest, highest: (size + more >= lowest) & (size - more <= highest)
    far = np.iinfo(np.int64).max
    sets = [(within(0, ONE), ())] + [(within(ONE + 1, TWO), (a,)) for a in range(1, GAP + 1)] + [(within(TWO + 1, far - 1), (a, b)) for b in range(2, GAP + 1) for a in range(1, b)]
    rows, keys = [], []
    for of_size, steps in sets:
        i = at[of_size & (at + max(steps, default=0) < end)]
        key = h[i]
        for x in steps:
            key = key ^ h[i + x]
        rows.append(row[i])
        keys.append((key + np.uint64(len(steps))) * np.uint64(0x9E3779B97F4A7C15))
    return np.concatenate(rows), np.concatenate(keys)


def keys_of(w: DataFrame, seek: bool, rounds: int = 1, turn: int = 0, hot: dict[int, int] | None = None) -> DataFrame:
    """(key, part, size, less, need, bits, plain): the keys of wordings that belong to this turn; ``bits`` is a bitmap of the words, of which ``need`` must be shared."""
    ship(w.sparkSession)
    held = w.sparkSession.sparkContext.broadcast((np.array(sorted(hot), np.uint64), np.array([hot[k] for k in sorted(hot)], np.int32))) if hot else None
    names = ["key", "part", "size", "less", "need", "bits", "plain"]

    none = signatures("")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                b = whole.slice(at, 4096)
                plain, split = b.column("plain"), pc.split_pattern(b.column("skels"), " ")
                words = pc.list_flatten(split).dictionary_encode()
                h = np.array([word_hash(x) for x in words.dictionary.to_pylist()], np.uint64)[words.indices.to_numpy(zero_copy_only=False)]
                start = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False)))).astype(np.int64)
                bits = np.bitwise_or.reduceat(np.uint64(1) << (h & np.uint64(63)), start[:-1])
                row, key = word_sets(h, start, seek)
                told = [signatures(x) if y else none for x, y in zip(plain.to_pylist(), pc.match_substring_regex(plain, "[0-9]").to_pylist())]
                n = np.array([len(x) for x in told])
                first = np.concatenate(([0], np.cumsum(n)))
                less, sig = (np.array([y[k] for x in told for y in x], t) for k, t in ((0, bool), (1, np.uint64)))
                each = np.repeat(np.arange(len(row)), n[row])
                nth = np.arange(len(each)) - np.repeat(np.cumsum(n[row]) - n[row], n[row]) + first[row[each]]
                key = (key[each] ^ sig[nth]) * np.uint64(0xC2B2AE3D27D4EB4F)
                key ^= key >> np.uint64(29)
                mine = np.flatnonzero(key % np.uint64(rounds) == turn)
                key, less, row = key[mine], less[nth[mine]], row[each[mine]]
                need = np.zeros(len(bits), np.int32)
                if seek:
                    size = np.diff(start)
                    own = np.unique(np.repeat(np.arange(len(size)), size) * len(words.dictionary) + words.indices.to_numpy(zero_copy_only=False)) // len(words.dictionary)
                    distinct = np.bincount(own, minlength=len(size))
                    need = np.array([least_of_size(k) for k in size.tolist()])
                    for i in np.flatnonzero(distinct < size).tolist():
                        need[i] = least_words(split[i].as_py())
                    need = (need - distinct + np.bitwise_count(bits)).astype(np.int32)
                part = np.zeros(len(key), np.int32)
                if held:
                    ks, ps = held.value
                    ix = np.minimum(np.searchsorted(ks, key), len(ks) - 1)
                    parts = np.where(ks[ix] == key, ps[ix], 1)
                    if seek:  # a wording looks in all parts of a key
                        again = np.repeat(np.arange(len(key)), parts)
                        part = (np.arange(len(again)) - np.repeat(np.cumsum(parts) - parts, parts)).astype(np.int32)
                        key, less, row = key[again], less[again], row[again]
                    else:
                        own = np.array([word_hash(x) for x in plain.to_pylist()], np.uint64) if (parts > 1).any() else np.zeros(len(bits), np.uint64)
                        part = (own[row] % parts.astype(np.uint64)).astype(np.int32)
                if len(key):
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(part), pa.array(np.diff(start)[row].astype(np.int32)), pa.array(less), pa.array(need[row]), pa.array(bits.view(np.int64)[row]), plain.take(pa.array(row))], names=names)

    return w.select("plain", "skels").mapInArrow(run, "key bigint, part int, size int, less boolean, need int, bits bigint, plain string")


def hot_keys(w: DataFrame, n: int) -> dict[int, int]:
    """The parts of every key that more than ``HOT`` of the ``n`` training wordings hold, by a sample of them."""
    times = max(1, n // SAMPLE)
    found = keys_of(w.filter(F.pmod("wording", F.lit(times)) == 0), False).groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > max(HOT / times, 8 * (times > 1))).collect()
    return {r["key"] % (1 << 64): -(-r["n"] * times // HOT) for r in found}


def comparer(held, common: float):
    """Keeps of wordings that met those of enough containment that agree word by word. ``held``: broadcast hashes of words, sorted, and the wordings that hold them; other words are held by one."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ns = held.value

        @lru_cache(1 << 17)
        def count(word: str) -> int:
            x = np.uint64(word_hash(word))
            i = int(np.searchsorted(hashes, x))
            return int(ns[i]) if i < len(hashes) and hashes[i] == x else 1

        def skeletons(texts: pa.Array) -> list[str]:
            return [x.strip(" ") for x in encode(*skeleton(*decode(texts), spaces=True)).to_pylist()]

        @lru_cache(1 << 16)
        def told(skels: str) -> tuple[list[str], set[tuple[str, ...]]]:
            words = skels.split(" ")
            return words, grams(words)

        for f in batches:
            keep, shares = [], []
            texts, ix = [], []
            for name in ("vplain", "tplain"):
                d = f.column(name).dictionary_encode()
                texts.append((d.dictionary.to_pylist(), skeletons(d.dictionary)))
                ix.append(d.indices.to_pylist())
            seen: dict[tuple[int, int], bool] = {}
            for k, (i, j) in enumerate(zip(*ix)):
                if (i, j) in seen:
                    continue
                (sa, ga), (sb, gb) = told(texts[0][1][i]), told(texts[1][1][j])
                share = len(ga & gb) / len(ga)
                seen[i, j] = False
                if share < CONTAINED:
                    continue
                a, b = texts[0][0][i].split(" "), texts[1][0][j].split(" ")
                if len(a) == len(sa) and len(b) == len(sb) and same_wording(a, b, sa, sb, {x: count(x) for x in {*a, *b}}, common):
                    keep.append(k)
                    shares.append(share)
            if keep:
                yield pa.RecordBatch.from_arrays([f.column("v").take(pa.array(keep)), f.column("t").take(pa.array(keep)), pa.array(shares, pa.float64())], names=["v", "t", "containment"])

    return compare


def wordings(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows: row_id, page_path, split, wording), (wordings: split, wording, plain, skels), written to the shared folder."""
    rows = lines.withColumn("split", split_of(F.col("training"), F.col("validation"))).filter(F.col("split").isNotNull() & (F.trim(F.coalesce("annotation", F.lit(""))) != ""))
    rows = with_words(rows.select("row_id", "page_path", "split", "annotation"), "annotation")
    rows = rows.withColumn("plain", F.trim("plain")).withColumn("skels", F.trim("skels")).filter(F.col("plain").rlike(r"[\p{L}\p{N}]"))
    texts = write_shared(rows.withColumn("wording", F.xxhash64("plain")), "annotations", "zstd")
    w = write_shared(texts.groupBy("split", "wording").agg(F.first("plain").alias("plain"), F.first("skels").alias("skels")), "wordings", "zstd")
    rows = write_shared(texts.select("row_id", "page_path", "split", "wording"), "rows", "zstd")
    drop_shared(texts)
    release(lines.sparkSession)
    return rows, w


def word_counts(w: DataFrame, same: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, wordings that hold them), sorted by hash, of all words of two wordings or more; a wording of both sets, as in ``same``, counts once."""
    words = lambda df, n: df.select(F.explode(F.array_distinct(F.split("plain", " "))).alias("word"), F.lit(n).alias("n"))
    twice = w.filter("split = 'validation'").join(broadcast_if_small(same), "wording", "left_semi")
    found = words(w, 1).unionAll(words(twice, -1)).groupBy("word").agg(F.sum("n").alias("n")).filter("n > 1").toArrow()
    hashes = np.array([word_hash(x) for x in found.column("word").to_pylist()], np.uint64)
    order = np.argsort(hashes)
    return hashes[order], found.column("n").to_numpy()[order].astype(np.int64)


def wording_pairs(w: DataFrame) -> DataFrame:
    """(v, t, containment): validation and training wordings that are the same, written to the shared folder."""
    spark = w.sparkSession
    validation, training = (w.filter(F.col("split") == x) for x in ("validation", "training"))
    same = write_shared(validation.select("wording").join(training, "wording", "left_semi"), "same")
    held = spark.sparkContext.broadcast(word_counts(w, same))
    n = training.count()
    hot, common, rounds = hot_keys(training, n), least_common(w.count()), min(ROUNDS, 1 + size_of(w) // ROUND_BYTES)
    release(spark)
    found = [same.select(F.col("wording").alias("v"), F.col("wording").alias("t"), F.lit(1.0).alias("containment"))]
    for turn in range(rounds):
        v, t = (keys_of(df, seek, rounds, turn, hot) for df, seek in ((validation, True), (training, False)))
        v, t = (df.select("key", "part", *[F.col(c).alias(name + c) for c in columns]) for name, df, columns in (("v", v, ("size", "less", "need", "bits", "plain")), ("t", t, ("size", "less", "bits", "plain"))))
        met = v.join(t, ["key", "part"]).filter((F.abs(F.col("vsize") - F.col("tsize")) <= 1) & ~(F.col("vless") & F.col("tless")) & (F.bit_count(F.col("vbits").bitwiseAND(F.col("tbits"))) >= F.col("vneed")) & (F.col("vplain") != F.col("tplain")))
        met = met.select(F.xxhash64("vplain").alias("v"), F.xxhash64("tplain").alias("t"), "vplain", "tplain")
        found.append(write_shared(met.mapInArrow(comparer(held, common), "v bigint, t bigint, containment double"), "pairs"))
        release(spark)
    out = found[0]
    for df in found[1:]:
        out = out.unionAll(df)
    out = write_shared(out.groupBy("v", "t").agg(F.max("containment").alias("containment")), "overlaps")
    for df in (same, *found[1:]):
        drop_shared(df)
    release(spark)
    return out


def overlaps(lines: DataFrame) -> DataFrame:
    """(v, t, containment, rows of both): pairs of rows, validation and training, that give the same wording."""
    rows, w = wordings(lines)
    found = broadcast_if_small(wording_pairs(w))
    drop_shared(w)
    a = rows.filter("split = 'validation'").select(F.col("wording").alias("v"), F.col("row_id").alias("validation_row"), F.col("page_path").alias("validation_page"))
    b = rows.filter("split = 'training'").select(F.col("wording").alias("t"), F.col("row_id").alias("training_row"), F.col("page_path").alias("training_page"))
    return found.join(a, "v").join(b, "t").select("validation_row", "validation_page", "training_row", "training_page", "containment")


def report(lines: DataFrame, paper: DataFrame) -> DataFrame:
    """(validation_paper, training_paper, n_pairs, n_validation, n_training, containment): overlaps counted by the papers of both rows.

    Rows are counted by wording and paper before pairs are, so no pair of rows is written out.
    """
    rows, w = wordings(lines)
    rows = main_page(rows, paper, "page_path", "page").withColumn("paper", F.substring_index("page", "/", 1))
    per = write_shared(rows.groupBy("split", "wording", "paper").agg(F.count("*").alias("n")), "rows-of-wordings")
    side = lambda name, split: per.filter(F.col("split") == split).select(F.col("wording").alias(name), F.col("paper").alias(f"{split}_paper"), F.col("n").alias(f"n{name}"))
    found = broadcast_if_small(wording_pairs(w))
    drop_shared(w)
    j = write_shared(found.join(side("v", "validation"), "v").join(side("t", "training"), "t"), "counted-pairs")
    keys, pairs = ["validation_paper", "training_paper"], F.col("nv") * F.col("nt")
    out = j.groupBy(*keys).agg(F.sum(pairs).alias("n_pairs"), F.round(F.sum(pairs * F.col("containment")) / F.sum(pairs), 4).alias("containment"))
    for name, split in (("v", "validation"), ("t", "training")):
        n = j.groupBy(*keys, name).agg(F.max(f"n{name}").alias("n")).groupBy(*keys).agg(F.sum("n").alias(f"n_{split}"))
        n = n.select(*[F.col(k).alias(f"__{k}") for k in keys], f"n_{split}")
        out = out.join(n, F.col(keys[0]).eqNullSafe(F.col(f"__{keys[0]}")) & F.col(keys[1]).eqNullSafe(F.col(f"__{keys[1]}"))).drop(*[f"__{k}" for k in keys])
    return out
