"""Operators for training data: SQL where there is some, else brute force on small tables; defined results for odd rows."""

import random
import sys
import threading
import unicodedata
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from oracle import DATA, connect, same  # noqa: E402

from broadsheet.llm import boilerplate, chars, features, grouping, headers, leaks, overlap, queries, repair, subjects, tokens  # noqa: E402
from broadsheet.session import release, shared_dir  # noqa: E402

LONG = "Die Marktkasse verlangt heute neue Straßen. " * 3000


# --- queries ---------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    df = queries.queries()[name](spark, DATA)
    sql = queries.oracle_sql()
    if name in sql:
        same(connect(), df, sql[name])
    else:
        assert df.collect()  # every column is computed


# --- 2: characters ---------------------------------------------------------------------------------------------------


def canonical(texts):
    array = pa.array(texts, pa.string())
    cps, offs, changed = chars.canonical(*chars.decode(array))
    return chars.encode(cps, offs, array.is_valid()).to_pylist(), changed.tolist()


def test_canonical_cases():
    cases = {
        "Ｈｅｒｒ １２．": "Herr 12.", "unbeﬆimmt ﬁn ﬀ": "unbestimmt fin ff", "ä́": "ä́", "ố": "ố", "Nān̄": "Nān̄", "a​b﻿\xad": "ab", "a b c　d": "a b c d",
        "Rесhnung": "Rechnung", "газета": "газета", "λόγος": "λόγος", "½ ſ æ œ „x“ — …": "½ ſ æ œ „x“ — …", "Mаrkt о": "Markt о", "": "", "́x": "́x", "K": "K", "ệ": "ệ", "ệ": "ệ", "😀ä": "😀ä",
    }
    got, changed = canonical(list(cases) + [None])
    assert dict(zip(cases, got)) == cases
    assert got[-1] is None
    assert changed[:-1] == [a != b for a, b in cases.items()] and not changed[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aeonuAEO äöß̧̣́̈̂ﬁｘ１​ 　 .-"), max_size=12), max_size=6))
def test_canonical_against_unicodedata(texts):
    def one(t):
        out = "".join("" if unicodedata.category(c) == "Cf" else " " if unicodedata.category(c) == "Zs" else unicodedata.normalize("NFKC", c) if ord(c) > 0xF000 else c for c in t)
        return unicodedata.normalize("NFC", out)

    got, changed = canonical(texts)
    assert got == [one(t) for t in texts]
    assert changed == [a != b for a, b in zip(texts, got)]
    assert canonical(got)[0] == got


def test_canonical_of_slices_and_empty_batches():
    array = pa.array(["x", "Ｙ", None, "z​"])
    assert chars.encode(*chars.canonical(*chars.decode(array[1:4]))[:2]).to_pylist() == ["Y", "", "z"]
    assert len(chars.canonical(*chars.decode(array[:0]))[1]) == 1


def skel(t):
    return features.skeleton_text(t)


def test_skeletons():
    for a, b in [("Berichr", "Bericht"), ("Leinenverrnögen", "Leinenvermögen"), ("ausdriicklich", "ausdrücklich"), ("s0wie", "sowie"), ("vvenn", "wenn"), ("enclgültige", "endgültige"), ("RatsvvOrstand", "Ratsvorstand"), ("Vor|äufige", "vorläufige"), ("a b.", "AB"), ("Gese1lschaft", "Gesellschaft")]:
        assert skel(a) == skel(b), (a, b)
    for a, b in [("Nr. 11", "Nr. 1"), ("Nr. 22", "Nr. 2"), ("Markt", "Mast"), ("12 2", "1 22 3")]:
        assert skel(a) != skel(b), (a, b)


def test_look_alike_rows_with_clashing_columns(spark):
    a = spark.createDataFrame([(1, "ｘ", "c", True), (2, None, "c", True), (3, "", "c", False)], "row_id bigint, ocr_text string, tab string, changed boolean")
    b = spark.createDataFrame([(1, "x y", "k")], "row_id bigint, annotation string, text string")
    assert {tuple(r) for r in chars.look_alikes(a, b).collect()} == {("ocr", 1), ("lines", 1)}
    assert chars.look_alikes(a.limit(0), b.limit(0)).count() == 0
    kept = chars.with_canonical(a, "ocr_text")
    assert kept.columns == ["row_id", "ocr_text", "tab", "canonical", "changed"]


# --- 8: tokens -------------------------------------------------------------------------------------------------------


def test_ids_against_the_public_library(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rng = random.Random(1)
    texts = ["", " ", "\n\n x", "<|endoftext|>", "Straße 12½ — „Ｘ“ ​😀", LONG, "a" * 5000, *("".join(rng.choice("abc äß.'s 1\n") for _ in range(60)) for _ in range(200))]
    rows = list(enumerate(texts)) + [(-1, None), (0, "")]
    got = tokens.encode_corpus(spark.createDataFrame([(k, x, [7]) for k, x in rows], "doc_id bigint, text string, ids array<int>")).collect()
    want = dict(enumerate(e.ids for e in t.encode_batch(texts, add_special_tokens=False)))
    assert len(got) == len(rows) and all(r["ids"] == (want[r["doc_id"]] if r["doc_id"] >= 0 else []) for r in got)
    v, rng = tokens.vocabulary(tokens.default_path(), tokens.default_pattern()), random.Random(5)
    for _ in range(60):  # long words: the heap, the rounds and the public library agree
        w = "".join(rng.choice("etaoinsß"[: rng.randrange(2, 9)]) for _ in range(rng.randrange(150, 700)))
        assert v.heaped(w.encode()).tolist() == v.rounds([w.encode()])[0].tolist() == t.encode(w, add_special_tokens=False).ids
    alone = tokens.encode_corpus(spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string"), null_ids=False)
    assert {r["doc_id"]: r["ids"] for r in alone.collect()} == {1: None, 2: []}
    assert tokens.encode_corpus(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


# --- 9: leaks --------------------------------------------------------------------------------------------------------

WORDS = [a + b for a in ("Markt", "Turm", "Glas", "Berg", "Land", "Tuch", "Holz", "Stein") for b in ("amt", "weg", "fest", "haus", "plan", "rat", "werk", "blatt")]


def test_leaks_by_length_and_noise(spark):
    rng = random.Random(9)
    item = [rng.choice(WORDS) + str(k) for k in range(40)]
    item = [w.rstrip("0123456789") + "abcdefghijklmnop"[k % 16] * 2 for k, w in enumerate(item)]
    fill = lambda n: [rng.choice(["Quelle", "Xylofon", "Jubel", "Zebra"]) + rng.choice("kmz") for _ in range(n)]
    docs = {
        1: fill(9) + item[5:20] + fill(9), 2: fill(9) + item[5:19] + fill(9), 3: [w.upper() for w in item[0:18]], 4: fill(5) + item[3:10] + ["[2]"] + item[10:21],
        5: item[:7] + fill(6) + item[7:14], 6: [w.replace("e", "c", 1) if k % 4 == 0 else w for k, w in enumerate(item[2:24])], 7: [w[:3] + w[4:] if k % 5 == 2 else w for k, w in enumerate(item[2:30])], 8: [],
    }
    rows = [(k, " ".join(v), 99) for k, v in docs.items()] + [(9, None, 99), (10, "  \n", 99), (11, "-\n".join([" ".join(item[:9])[:-3], " ".join(item[:9])[-3:] + " " + " ".join(item[9:22])]), 99), (12, LONG + " ".join(item), 99), (1, " ".join(docs[1]), 99)]
    d = spark.createDataFrame(rows, "doc_id bigint, text string, item_id bigint")
    t = spark.createDataFrame([(7, " ".join(item) + ".", 1), (8, None, 1), (9, "", 1), (10, "too short", 1)], "item_id bigint, text string, doc_id bigint")
    got = Counter((r["doc_id"], r["item_id"]) for r in leaks.leaks(d, t).collect())
    assert got == {(1, 7): 2, (3, 7): 1, (4, 7): 1, (6, 7): 1, (7, 7): 1, (11, 7): 1, (12, 7): 1}
    assert leaks.leaks(d, t.limit(0)).count() == 0 and leaks.leaks(d.limit(0), t).count() == 0
    r = leaks.leaks(d.filter("doc_id = 12"), t).first()
    assert (LONG + " ".join(item))[r["begin"] : r["end"]] == " ".join(item) and r["words"] == 40


def test_offsets_lead_to_the_original(spark):
    """Invisible characters, ligatures and separate accents before and within a passage move nothing."""
    item = [WORDS[(7 * k) % len(WORDS)].lower() for k in range(20)]
    before = "​﻿ﬁﬃ ä\xad Ｈｅｒｒ " * 5
    spoilt = [w.replace("a", "а") if k % 5 == 0 else w[:3] + "​" + w[3:] if k % 5 == 1 else w for k, w in enumerate(item)]
    text = before + " ".join(spoilt) + " ﬂ danach"
    d, t = spark.createDataFrame([(1, text)], "doc_id bigint, text string"), spark.createDataFrame([(5, " ".join(item))], "item_id bigint, text string")
    r = leaks.leaks(d, t).collect()
    assert len(r) == 1 and text[r[0]["begin"] : r[0]["end"]] == " ".join(spoilt)


def test_any_number_of_items(spark):
    """Items in parts by their size, and very short words, give the same rows."""
    rng = random.Random(4)
    items = [[rng.choice(WORDS) if k % 3 else rng.choice("abcdefgh") for _ in range(24)] for k in range(60)]
    t = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id bigint, text string")
    d = spark.createDataFrame([(k, "Quelle " * 5 + " ".join(items[k][2:20]) + " Zebra") for k in range(0, 60, 2)], "doc_id bigint, text string")
    one = {tuple(r) for r in leaks.leaks(d, t).collect()}
    assert one == {tuple(r) for r in leaks.leaks(d, t, chars=500).collect()}
    assert {(k, k) for k in range(0, 60, 2) if k % 3} <= {r[:2] for r in one}


# --- 1: overlaps -----------------------------------------------------------------------------------------------------

LINES = "row_id bigint, page_path string, line_path string, annotation string, training boolean, validation boolean, v string, wording bigint"


def pairs(spark, rows):
    df = spark.createDataFrame([(k, "eic/1850/no1/jpg/1.jpg", "p", a, t, v, "clash", 0) for k, a, t, v in rows], LINES)
    return {(r["validation_row"], r["training_row"]) for r in overlap.overlaps(df).collect()}


def test_overlaps(spark):
    w = "Der Kreisplan bei Moorleben vermißt endlich auswärtige Tuchkasse."
    rows = [
        (1, w, True, False), (2, w.upper(), False, True), (3, "Der Krcisplan bei Moorleben vermißt endlich auswärtige Tuchkafse", None, True), (4, "Der bei Moorleben vermißt endlich auswärtige Tuchkasse.", False, True),
        (5, "Der  Kreisplan bei Moorleben vermißt endlch auswärtige Tuchkasse ;", False, True), (6, "Der Kreisplan bei Steinwörden vermißt endlich auswärtige Tuchkasse.", False, True), (7, w, True, True), (8, w, None, None),
        (9, None, True, False), (10, "", False, True), (11, " — ", False, True), (12, w, True, False), (13, "Zink loco 508 Thlr. 21 Sgr., Schein Nr. 266", True, False), (14, "Zink loco 508 Thlr. 21 Sgr., Schein Nr. 267", False, True),
        (15, "Zink loco 508 Thlr. 21 Sgr., Schein Nr. 266", False, True), (16, "Wort", True, False), (17, "wort!", False, True),
    ]
    assert pairs(spark, rows) == {(v, t) for v in (2, 3, 4, 5) for t in (1, 12)} | {(15, 13), (17, 16)}
    assert pairs(spark, []) == set()
    assert pairs(spark, [(1, w, True, False)]) == set()


def test_many_saves_of_one_wording(spark):
    w = "Die Turmkasse bei Holzleben prüft heute neue Bergfeste."
    rows = [(k, w if k % 3 else w.lower(), k % 2 == 0, k % 2 == 1) for k in range(60)]
    assert len(pairs(spark, rows)) == 900


def test_word_alignment():
    same = lambda a, b, **n: overlap.same_wording(a.split(), b.split(), [skel(x) for x in a.split()], [skel(x) for x in b.split()], n, 10)
    assert same("a b c d", "a b d") and same("a b c d e", "a c d e") and not same("a b c d e", "a d e")
    assert not same("in altona heute", "in bremen heute") and same("er prüft heute neu", "er heute sehr neu", prüft=20, sehr=20)
    assert not same("nr 12 heute", "nr 13 heute")
    assert not same("in altona am see", "in altonaa am see", altona=5, altonaa=5) and same("in bergedorf am see", "in bergdorf am see")


def test_words_are_judged_alike_at_every_size():
    cost = lambda a, b, na, nb: overlap.word_cost(a, b, skel(a), skel(b), na, nb)
    for k in (1, 10, 1000):
        assert cost("altona", "altonaa", 5 * k, 5 * k) > overlap.MAX_LETTERS  # both are words
        assert cost("bergedorf", "bergdorf", k, 200 * k) <= overlap.MAX_LETTERS  # one a misreading of the other
    assert [round(overlap.least_common(n)) for n in (0, 60, 50_000, 5_000_000)] == [9, 9, 135, 10305]


def test_recall_against_all_pairs(spark):
    """Every validation wording of a row with an id divisible by 5 against all of training, word by word."""
    lines = spark.read.parquet("/root/testdata/sf0.01/lines.parquet")
    rows, w = overlap.wordings(lines)
    found = {(r["v"], r["t"]) for r in overlap.wording_pairs(w).collect()}
    asked = {r["wording"] for r in rows.filter("split = 'validation' AND row_id % 5 = 0").collect()}
    told = {(r["split"], r["wording"]): (r["plain"].split(" "), r["skels"].split(" ")) for r in w.collect()}
    counts = Counter(x for words in {k[1]: v[0] for k, v in told.items()}.values() for x in set(words))
    common = overlap.least_common(len(told))
    exact = {(v, t) for (s, v), a in told.items() if s == "validation" and v in asked for (z, t), b in told.items() if z == "training" and (v == t or (len(a[0]) == len(a[1]) and len(b[0]) == len(b[1]) and overlap.same_wording(a[0], b[0], a[1], b[1], counts, common)))}
    assert len(asked) >= 10 and exact and len(exact & found) >= 0.9 * len(exact)
    assert {p for p in found if p[0] in asked} <= exact


def test_overlaps_take_a_few_times_their_input_on_disk(spark, monkeypatch):
    """Shuffle files and shared tables at their most, looked at again and again; in rounds as on a large table."""
    monkeypatch.setattr(overlap, "ROUND_BYTES", 1 << 16, raising=False)
    release(spark)
    blocks, shared = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager(), Path(shared_dir(spark).removeprefix("file://"))
    spark_dirs = [Path(str(x)) for x in blocks.localDirsString()]

    def used():
        total = 0
        for p in [x for d in (*spark_dirs, shared) for x in d.rglob("*")]:
            try:
                total += p.stat().st_size if p.is_file() else 0
            except OSError:
                pass
        return total

    file, over, most, floor = "/root/testdata/sf0.1/lines.parquet", threading.Event(), [], used()

    def watch():
        while not over.wait(0.02):
            most.append(used() - floor)

    t = threading.Thread(target=watch)
    t.start()
    try:
        assert overlap.overlaps(spark.read.parquet(file)).count()
    finally:
        over.set()
        t.join()
    assert max(most) < 8 * Path(file).stat().st_size


def test_rounds_and_parts_of_keys_lose_no_pair(spark, monkeypatch):
    rows, w = overlap.wordings(spark.read.parquet("/root/testdata/sf0.01/lines.parquet"))
    whole = {tuple(r) for r in overlap.wording_pairs(w).collect()}
    monkeypatch.setattr(overlap, "ROUND_BYTES", 1 << 14)
    monkeypatch.setattr(overlap, "HOT", 3)
    assert whole and {tuple(r) for r in overlap.wording_pairs(w).collect()} == whole


def test_wordings_of_enough_containment_meet():
    """Any words misread, one lacking on either side or moved: whoever shares enough n-grams shares a set of words and enough words."""
    rng = random.Random(1)

    def sets(words, seek):
        return set(overlap.word_sets(np.array([overlap.word_hash(x) for x in words], np.uint64), np.array([0, len(words)]), seek)[1].tolist())

    n = 0
    for k in range(20_000):
        a = [f"w{i}" for i in range(k % 14 + 1)]
        b = [x if rng.random() < 0.6 else x + "x" for x in a]
        if len(b) > 1 and rng.random() < 0.5:
            out = b.pop(rng.randrange(len(b)))
        else:
            out = "other"
        if rng.random() < 0.5:
            b.insert(rng.randrange(len(b) + 1), rng.choice([out, "other", *[x for x in a if x not in b]]))
        if len(overlap.grams(a) & overlap.grams(b)) >= overlap.CONTAINED * len(overlap.grams(a)):
            n += 1
            assert sets(a, True) & sets(b, False) and len({*a} & {*b}) >= overlap.least_words(a), (a, b)
    assert n > 1000


def test_report_counts_rows_without_pairing_them(spark):
    w = "Die Turmkasse bei Holzleben prüft heute neue Bergfeste."
    rows = [(k, f"{'eic' if k % 4 else 'alt'}/1850/no1/jpg/1.jpg", w if k % 3 else w.lower(), k % 2 == 0, k % 2 == 1) for k in range(40)] + [(100, None, w, False, True)]
    df = spark.createDataFrame(rows, "row_id bigint, page_path string, annotation string, training boolean, validation boolean")
    got = {tuple(r) for r in overlap.report(df, spark.createDataFrame([], PAPER)).collect()}
    assert got == {("eic", "eic", 200, 1.0, 20, 10), ("eic", "alt", 200, 1.0, 20, 10), (None, "eic", 10, 1.0, 1, 10), (None, "alt", 10, 1.0, 1, 10)}


# --- 4: repair -------------------------------------------------------------------------------------------------------

OCR = "row_id bigint, paper_code string, page_path string, predictor string, label string, block_id string, line_id int, ocr_text string, confidence double, title string"
PAPER = "paper_code string, title string, place string, lang string, merged_into string"


def pages(spark):
    rows, k = [], 0
    for p in range(8):
        page = f"eic/1850/no0000{p:03d}/jpg/000{p % 4 + 1}.jpg"
        texts = [
            ("TEXT", "0", 0, f"Nr. {p + 30}. Eichener Bote. Seite {p % 4 + 1}" if p != 5 else "Nr. 35. Eichener B0te. Seite 2"), ("TEXT", "1", 0, "Die Marktkasse verlangt heute neue Straßen und die Markt-"),
            ("TEXT", "1", 1, "kasse prüft heute alte Straßen, Markt-"), ("TEXT", "1", 2, "und Turmkasse verlangt neue Wege"), ("TABULAR", "2.1.1.1", 0, "Zink 12 Thlr."), ("TEXT", "3", 0, f"- {p % 4 + 1} -"),
        ]
        for label, block, line, text in texts:
            rows.append((k, "eic", page, "regions", label, block, line, text, None, "clash"))
            k += 1
        rows += [(1000 + p, "eic", page, "regions", "TEXT", "4", 0, "Marktkasse Marktkasse Straßen heute", None, None), (2000 + p, "eic", page, "r", "TEXT", "5", 0, None if p % 2 else "", None, None)]
    rows += [(3000, "eic", "eic/1850/no0000001/jpg/0002.jpg", "r", "TEXT", "6", 0, "Die Marktkassc verlangt Stra8en", 0.5, None), (3001, None, None, "r", None, None, None, "Marktkasse", None, None), (3002, "eic", "eic/1850/no0000001/jpg/0002.jpg", "r", "TEXT", "7", 0, "neu 17", None, None)]
    ocr = spark.createDataFrame(rows, OCR)
    lines = spark.createDataFrame([(1, "alt/1850/no0000001//jpg/0002.jpg", "regions/TEXT/1/1", "kasse prüft heute alte Straßen, Markt-", "x"), (2, "eic/1850/no0000001/jpg/0002.jpg", "regions/TEXT/1/0", "und die neue Markt¬", None), (3, None, None, None, None)], "row_id bigint, page_path string, line_path string, annotation string, paper string")
    paper = spark.createDataFrame([("alt", "Bote", "E", "de", "eic"), ("eic", "Eichener Bote", "E", "de", None)], PAPER)
    return ocr, lines, paper


def test_defects_and_paragraphs(spark):
    ocr, lines, paper = pages(spark)
    made = repair.Repair(ocr, lines, paper)
    got = defaultdict(set)
    for tab, row, kind in made.defects().collect():
        got[(tab, row)].add(kind)
    heads = {("ocr", 6 * p): {"header"} for p in range(8)}
    heads[("ocr", 30)] = {"header", "misread"}
    want = heads | {("ocr", 6 * p + 1): {"hyphen"} for p in range(8)} | {("ocr", 6 * p + 5): {"pagenum"} for p in range(8)} | {("ocr", 3000): {"misread"}, ("lines", 2): {"hyphen"}}
    assert dict(got) == want
    text = {r["page_path"]: r["text"] for r in made.paragraphs().collect()}["eic/1850/no0000001/jpg/0002.jpg"]
    assert text.startswith("Die Marktkasse verlangt heute neue Straßen und die Marktkasse prüft heute alte Straßen, Markt- und Turmkasse verlangt neue Wege\n\nZink")
    assert "Die Marktkasse verlangt" in text.split("\n\n")[-2] and "Bote" not in text


def test_repair_of_empty_tables(spark):
    ocr, lines, paper = pages(spark)
    made = repair.Repair(ocr.limit(0), lines.limit(0), paper.limit(0))
    assert made.defects().count() == 0 and made.paragraphs().count() == 0


def test_neighbours_over_batches(spark):
    """One page longer than an Arrow batch: every broken line finds its next line."""
    n = 2500
    ocr = spark.createDataFrame([(k, "a", "a/1/no1/jpg/1.jpg", "r", "TEXT", str(k // 50), k % 50, f"w{'abcdefghij'[k % 10]}-", None, None) for k in range(n)], OCR)
    lines = spark.createDataFrame([], "row_id bigint, page_path string, line_path string, annotation string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        f = repair.prepared(repair.rows_of(ocr, lines, spark.createDataFrame([], PAPER))).withColumn("is_header", F.lit(False))
        rows = {r["row_id"]: (r["before"], r["after"]) for r in repair.with_neighbours(f).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    word = lambda k: "w" + "abcdefghij"[k % 10]
    assert rows == {k: (word(k - 1) if k else None, word(k + 1) if k < n - 1 else None) for k in range(n)}


def test_rows_without_a_page_stand_alone(spark):
    rows = [(1, "a", None, "r", "TEXT", "1", 0, "eine Ver-", None, None), (2, "a", None, "r", "TEXT", "1", 1, "kehr ist", None, None)]
    made = repair.Repair(spark.createDataFrame(rows, OCR), spark.createDataFrame([], "row_id bigint, page_path string, line_path string, annotation string"), spark.createDataFrame([], PAPER))
    got = {r["row_id"]: (r["broken"], r["after"], r["page"]) for r in made.rows.collect()}
    assert got == {1: (True, None, None), 2: (False, None, None)}
    assert {tuple(r) for r in made.defects().collect()} == {("ocr", 1, "hyphen")} and made.paragraphs().count() == 0


def test_page_number_sequences(spark):
    def page(issue, k):
        return f"a/1850/no{issue}/jpg/{k:04d}.jpg"

    rows = [(10 * i + k, page(i, k), str(n)) for i, ns in ((1, [1, 2, 7, 4]), (2, [101, 102, 103, 9]), (3, [40, 41, 5, 77])) for k, n in enumerate(ns, 1)]
    f = spark.createDataFrame([(r, p, "TEXT", n) for r, p, n in rows] + [(99, page(2, 2), "TABULAR", "102"), (98, None, "TEXT", "3"), (97, page(1, 1), "TEXT", None)], "row_id bigint, page string, label string, pagenum string")
    got = {r["row_id"] for r in headers.page_number(f).filter("is_pagenum").collect()}
    # issue 1 counts from one, issue 2 goes on from 101; two pages make no sequence
    assert got == {11, 12, 14, 21, 22, 23}
    assert headers.page_number(f).count() == len(rows) + 3


def test_hyphens_that_hang(spark):
    """A hyphen before one of the most frequent words stays, unless the corpus knows the two as one word."""
    fill = [(100 + k, "a", f"a/1850/no1/jpg/{k // 30 + 2}.jpg", "r", "TEXT", "1", k % 30, "sowie heute Vorsowie und alle anderen sowie Hauskasse", None, None) for k in range(60)]
    rows = [(1, "a", "a/1850/no1/jpg/1.jpg", "r", "TEXT", "1", 0, "die Markt-", None, None), (2, "a", "a/1850/no1/jpg/1.jpg", "r", "TEXT", "1", 1, "sowie Turmkasse der Vor-", None, None), (3, "a", "a/1850/no1/jpg/1.jpg", "r", "TEXT", "1", 2, "sowie", None, None)]
    made = repair.Repair(spark.createDataFrame(rows + fill, OCR), spark.createDataFrame([], "row_id bigint, page_path string, line_path string, annotation string"), spark.createDataFrame([], PAPER))
    assert {tuple(r) for r in made.defects().filter("kind = 'hyphen'").collect()} == {("ocr", 2, "hyphen")}


def test_titles_need_a_share_of_the_pages(spark):
    f = spark.createDataFrame([("a", f"p{k}", "TEXT", 0, "x", "rare" if k < 4 else None, False) for k in range(100)] + [("b", f"q{k}", "TEXT", 0, "x", "often long", False) for k in range(10)], "paper string, page string, label string, place bigint, skel string, title string, is_pagenum boolean")
    got = {(r["paper"], r["title"]) for r in headers.titles(f).collect()}
    assert ("b", "often long") in got and ("b", "oftenlong") in got and not any(p == "a" for p, _ in got)


def test_titles_read_the_lines_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = [("a", f"p{k}", "TEXT", line, "x", title, False) for k in range(20) for line, title in ((0, "long title" if k % 2 else None), (1, None))] + [("a", "q", "TEXT", 0, "x", "long title", False)]
    f = spark.createDataFrame(rows, "paper string, page string, label string, place bigint, skel string, title string, is_pagenum boolean")
    got = headers.titles(f.mapInArrow(count, f.schema)).collect()
    assert ("a", "long title") in {tuple(r) for r in got} and len(got) == len({tuple(r) for r in got})
    assert seen.value == len(rows)


def calls(f):
    """What ``f`` gives, and the Python functions called for it."""
    n = 0

    def note(frame, event, arg):
        nonlocal n
        n += event == "call"

    sys.setprofile(note)
    try:
        out = f()
    finally:
        sys.setprofile(None)
    return out, n


def test_words_are_listed_without_a_call_for_each_line():
    texts = ["kasse prüft Markt-", None, "", "-", "Eins-", "é\u0301a  B|c 7x𝔘y-"]
    pairs = [(t, b, a, broken) for t in texts for b in (None, "", "markt", "i\u0307b") for a in (None, "", "und", "kasse") for broken in (False, True)]
    batch = lambda n: pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*(pairs * n))], names=["text", "before", "after", "broken"])
    repair.Listed(batch(1))
    one, few = calls(lambda: repair.Listed(batch(1)))
    _, many = calls(lambda: repair.Listed(batch(50)))
    assert many < few + 50 * 50  # the batches themselves take some
    words = lambda t: "".join(c.lower() if c < "\uffff" and (c.isalnum() or c == "|" or unicodedata.combining(c)) else " " for c in t or "").split()
    whole, joined = [], []
    for k, (t, b, a, broken) in enumerate(pairs):
        w = words(t)
        kept = [True] * len(w)
        if w and b:
            kept[0] = False
            joined.append((b + w[0], k, len(b), len(b + w[0]) + 1, False))
        if w and broken:
            kept[-1] = False
            if a and a not in repair.KEEP_BEFORE:
                joined.append((w[-1] + a, k, 0, len(w[-1]), True))
        whole += [(k, x) for x, y in zip(w, kept) if y]
    assert list(zip(one.words.row[one.whole].tolist(), one.words.texts(one.whole).to_pylist())) == whole
    got = zip(one.joined.texts(np.arange(len(one.joined.row))).to_pylist(), *(x[one.of].tolist() for x in (one.joined_row, one.lo, one.hi, one.begins)))
    assert sorted(got) == sorted(joined)
    for w in (one.words, one.joined):
        assert w.hash.tolist() == chars.row_hash(*chars.decode(w.texts(np.arange(len(w.row))))).tolist()


def test_a_line_that_is_not_broken_is_not_opened():
    texts = [t + e + s for t in ("die Markt", "12", "", "a\u0301", "x y_z") for e in ("", ".", *repair.HYPHENS, "=-") for s in ("", *(chr(c) for c in range(1 << 16) if chr(c).isspace()), " \n", "\u200b")] + [None]
    maybe = set(repair.may_break(pa.array(["x-", *texts]).slice(1)).tolist())
    for k, t in enumerate(texts):
        m = repair.BROKEN.search(t) if t and t.rstrip()[-1:] in repair.HYPHEN_SET else None
        assert (repair.broken_word(t) if k in maybe else None) == (m[1].lower() if m else None)
    assert not len(repair.may_break(pa.array([None, "", "ein Wort", "zwei Wege."])))


# --- 6: boilerplate --------------------------------------------------------------------------------------------------


def test_boilerplate(spark):
    notice, second = "Alle Rechte bleiben der Witwe Holzkamp vorbehalten.", "Druck und Verlag von Brunstedt & Comp. in Altona."
    rows = []
    for p in range(9):
        page = f"eic/1850/no{p}/jpg/1.jpg"
        text = {0: notice, 1: notice.upper(), 2: notice.replace("Rechte", "Rcchte"), 3: notice.replace("bleiben", "blieben "), 4: notice.replace("Witwe", "Wite"), 5: notice, 6: notice}.get(p, f"Zeile {p} allein")
        rows += [(10 * p, "eic", page, "r", "TEXT", "1", 0, text, None, "c"), (10 * p + 1, "eic", page, "r", "TEXT", "1", 1, second if p < 6 else "", None, "c"), (10 * p + 2, "eic", page, "r", "TEXT", "1", 2, f"Los Nr. {p} gezogen", None, "c"), (10 * p + 3, "eic", page, "r", "TEXT", "1", 3, None, None, "c"), (10 * p + 4, "eic", page, "r", "TEXT", "2", 0, "1", None, "c")]
    rows += [(500 + k, "oth", f"oth/{k}", "r", "TEXT", "1", 0, notice, None, "c") for k in range(4)] + [(600 + k, "dup", "dup/1", "r", "TEXT", "1", 0, notice, None, "c") for k in range(9)] + [(700, None, "x", "r", "TEXT", "1", 0, notice, None, "c")]
    df = spark.createDataFrame(rows, OCR)
    found = boilerplate.boilerplate(df).collect()
    assert {r["row_id"] for r in found} == {0, 10, 20, 30, 40, 50, 60} | {1, 11, 21, 31, 41, 51}
    assert len({r["block"] for r in found}) == 1
    assert boilerplate.without_boilerplate(df).count() == len(rows) - len(found)
    assert boilerplate.boilerplate(df.limit(0)).count() == 0


def test_variants_of_variants_and_harm_in_both_halves(spark):
    notice, second = "Alle Rechte bleiben der Witwe Holzkamp vorbehalten.", "Druck und Verlag von Brunstedt & Comp. in Altona."
    forms = [notice, notice, notice.replace("Rechte", "Rchte"), notice.replace("Rechte", "Rchte"), notice.replace("Witwe", "Wite"), notice, notice, notice.replace("Rechte", "Rchte").replace("vorbehalten", "vorbehaten")]
    rows = [(10 * p + k, "eic", f"eic/1850/no{p}/jpg/1.jpg", "r", "TEXT", "1", k, t, None, "c") for p, text in enumerate(forms) for k, t in enumerate((second, text, f"{WORDS[7 * p]} {WORDS[5 * p + 3]} allein"))]
    rows += [(1000 + p, "fro", f"fro/1850/no{p}/jpg/1.jpg", "r", "TEXT", "1", 0, t, None, "c") for p, t in enumerate([notice, notice, forms[2], forms[2], forms[4]])]
    got = {r["row_id"]: r["block"] for r in boilerplate.boilerplate(spark.createDataFrame(rows, OCR)).collect()}
    # the last form is harmed in both halves and found by the line above it; of the second paper no form stands on three pages
    assert set(got) == {10 * p + k for p in range(8) for k in (0, 1)} | {1000 + p for p in range(5)}
    assert len(set(got.values())) == 2


# --- 7: groups -------------------------------------------------------------------------------------------------------


def test_components_against_union_find(spark):
    rng = random.Random(6)
    rows = [(k, [f"k{rng.randrange(400)}" for _ in range(rng.choice([0, 1, 1, 2, 3]))]) for k in range(300)] + [(1000 + k, ["hub", f"leaf{k}"]) for k in range(300)] + [(2000 + k, [f"c{k}", f"c{k + 1}"]) for k in range(60)]
    found, rounds = grouping.components(spark.createDataFrame(rows, "r bigint, keys array<string>"))
    assert rounds > 3
    got = {r["key"]: r["component"] for r in found.collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for _, keys in rows:
        for k in keys:
            parent[root(k)] = root(keys[0])
    assert set(got) == set(parent)
    by = defaultdict(set)
    for k in parent:
        by[root(k)].add(got[k])
    assert all(len(v) == 1 for v in by.values()) and len({next(iter(v)) for v in by.values()}) == len(by)
    assert all(min(k for k in parent if root(k) == r) == next(iter(v)) for r, v in list(by.items())[:40])


def test_issues_of_merged_papers_and_odd_rows(spark):
    lines = [
        (1, "a/1850/no0012/jpg/1.jpg", "x", "A", True, False), (2, "b//1850/no12/jpg/2.jpg", "y", " a ", False, True), (3, "c/1850/no12/jpg/2.jpg", "X!", None, False, True), (4, None, None, "", True, None),
        (5, "a/1850/jpg/1.jpg", "", "B", True, False), (6, "a/1850/no13/jpg/1.jpg", "z", "b", True, True), (7, "a/1850/no13/jpg/1.jpg", "z", "b", True, False), (8, "d/1850/no12/jpg/1.jpg", "q", "d", None, True),
    ]
    df = spark.createDataFrame([(*x, "clash", "clash") for x in lines], "row_id bigint, page_path string, annotation string, author string, training boolean, validation boolean, main string, keys string")
    paper = spark.createDataFrame([("a", "T", "b"), ("b", "T", "d"), ("c", "T", None), ("d", "T", None)], "paper_code string, title string, merged_into string")
    assert {tuple(r) for r in grouping.mixed_issues(df, paper).collect()} == {("d", 12)}
    by = lambda *names: {r["row_id"]: r["component"] for r in grouping.grouped(grouping.record_keys(df, paper, names).select("row_id", "keys"), "row_id").collect()}
    one = by("issue")
    assert one[1] == one[2] == one[8] == "issue:a/12" and one[3] == "issue:c/12" and one[4] == "row:4" and one[5] == "row:5" and one[6] == one[7]
    two = by("issue", "text")
    assert two[3] == two[1] and two[6] != two[1]
    three = by("issue", "author")
    assert three[1] == three[2] and three[5] == three[6] and three[3] != three[1]
    assert grouping.mixed_issues(df.limit(0), paper.limit(0)).count() == 0


def test_splits(spark):
    rows = [(k, [f"issue{k // 5}"]) for k in range(2000)] + [(5000, []), (5001, [])]
    got = grouping.splits(spark.createDataFrame(rows, "row_id bigint, keys array<string>"), "row_id").collect()
    assert len(got) == len(rows)
    sets = defaultdict(set)
    for r in got:
        sets[r["component"]].add(r["split"])
    assert all(len(v) == 1 for v in sets.values())
    n = Counter(r["split"] for r in got)
    assert abs(n["train"] - 1601) <= 10 and abs(n["validation"] - 200) <= 10
    again = {r["row_id"]: r["split"] for r in grouping.splits(spark.createDataFrame(rows, "row_id bigint, keys array<string>"), "row_id").collect()}
    assert again == {r["row_id"]: r["split"] for r in got}
    assert grouping.splits(spark.createDataFrame([], "row_id bigint, keys array<string>"), "row_id").count() == 0


# --- 10: subjects ----------------------------------------------------------------------------------------------------


def test_sentences():
    text = "Herr Nr. 5 kam. Mrs. Bell went home.\n\nDie Mark-\nkasse prüft! „Um 8 Uhr“ geht es. Er kam. m. Ende"
    assert subjects.sentences(text) == [["herr", "nr", "kam"], ["mrs", "bell", "went", "home"], ["die", "markkasse", "prüft"], ["um", "uhr", "geht", "es"], ["er", "kam", "m", "ende"]]
    assert subjects.sentences("") == [] and subjects.sentences(" \n\n ") == [] and subjects.sentences("12. 13.") == []
    assert subjects.sentences("A. B") == [["a"], ["b"]] and subjects.sentences("x-\ny z") == [["xy", "z"]] and subjects.sentences("-\n x.") == [["x"]]


def test_words_of_batches(spark):
    """The word table holds the words of each document whatever the batches, and both ways of counting votes agree."""
    rng = random.Random(3)
    texts = [" ".join(rng.choice(WORDS) + rng.choice(["", ".", "!", "\n\n", "-\n"]) for _ in range(rng.randrange(0, 40))) for _ in range(60)] + [None, "", "1 2"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = subjects.word_table(docs)
    got = {r["doc_id"]: r for r in rows.collect()}
    for k, t in enumerate(texts):
        want = subjects.sentences(t or "")
        assert (k in got) == bool(want)
        if want:
            assert got[k]["words"].split() == [w for x in want for w in x] and got[k]["lengths"] == [len(x) for x in want]
            assert got[k]["h"] == subjects.hashes([w for x in want for w in x]).tolist()
    some = sorted({w.lower() for w in WORDS})[:30]
    chosen = spark.createDataFrame([(int(h), k % 4) for k, h in enumerate(subjects.hashes(some))], "h bigint, subject int")
    key = lambda r: (r["h"] is None, r["h"] or 0, r["subject"], r["n"])
    from broadsheet.session import write_shared

    chosen = write_shared(chosen, "chosen")
    assert sorted(map(key, subjects.voted_counts(rows, chosen, 4).collect())) == sorted(map(key, subjects.voted_by_shuffle(rows, chosen).collect()))
    a, b = (Counter((r["label"], r["words"]) for r in f(rows, chosen).collect()) for f in (lambda r, c: subjects.training_set(r, c, 4), subjects.training_by_shuffle))
    assert a == Counter({(k, w.strip()): n for (k, w), n in b.items()})


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    model = subjects.Model(["a", "b"])
    model.out = rng.normal(0, 1, model.out.shape).astype(np.float32)
    texts, labels = [["rye", "field"], ["jury", "rye", "oath"]], np.array([[1, 0], [0, 1]], np.float32)
    x = subjects.Packed(texts)
    dense, out, bias, loss = subjects.gradients(model, x, labels)
    for table, grad, at in ((model.out, out, (3, 1)), (model.bias, bias, (0,)), (model.words, None, (x.touched[2], 5))):
        keep = table[at]
        table[at] = keep + 1e-2
        up = subjects.gradients(model, x, labels)[3]
        table[at] = keep - 1e-2
        down = subjects.gradients(model, x, labels)[3]
        table[at] = keep
        assert (up - down) / 2e-2 == pytest.approx(float(grad[at] if grad is not None else dense[2][5]), abs=2e-2)


def test_held_out_labels_and_odd_documents(spark):
    sample = spark.read.parquet(f"{DATA}/subject_sample.parquet")
    areas = spark.read.parquet(f"{DATA}/subject_area.parquet")
    # every third labelled text is held out and stands among the documents
    held = sample.filter("sample_id % 3 = 0").select((F.col("sample_id") + 100000).alias("doc_id"), "text")
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "12. 13.")], "doc_id bigint, text string")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").union(held).union(odd).withColumn("subject", F.lit("clash"))
    got = subjects.document_subjects(docs.filter("doc_id > 99999 OR doc_id >= 1"), areas, sample.filter("sample_id % 3 <> 0"))
    rows = got.collect()
    truth = {r["sample_id"] + 100000: r["subject"] for r in sample.collect()}
    found = defaultdict(set)
    for r in rows:
        found[r["doc_id"]].add(r["subject"])
    ours = [d for d in found if d > 100000]
    right = sum(truth[d] in found[d] for d in ours)
    assert len(ours) >= 30 and right / len(ours) >= 0.9
    # of all held-out texts with the sentences that a subject needs, nearly all are found
    able = [r["doc_id"] for r in held.collect() if len(subjects.sentences(r["text"])) >= subjects.MIN_SENTENCES]
    assert sum(truth[d] in found[d] for d in able) >= 0.9 * len(able)


def test_subjects_of_empty_tables(spark):
    e = spark.createDataFrame
    docs, areas, sample = e([], "doc_id bigint, text string"), e([], "subject string, title string, description string"), e([], "sample_id bigint, lang string, text string, subject string")
    assert subjects.document_subjects(docs, areas, sample).count() == 0
