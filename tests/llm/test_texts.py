"""p2, p3, p4, p5 and p10 on small texts with known answers."""

import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quirework.llm import catalog, language, lookalike, quality, repetition, scan, textkind

PROSE = "Den gamla mannen gick över bron och såg sjön under kvällen. Sedan kom hans dotter hem med brevet!"
LONG = " ".join(f"ord{i} gick med hans {i % 7} dotter till staden." for i in range(120))


# Kinds of texts (p10)

LIST = "\n".join(f"• mannen i Fovik {i}" for i in range(12))
TABLE = "\n".join(f"Fovik | {i} | bonden | {i * 3}" for i in range(12))
JUNK = ["3f9ac0b7d2e1\n88ab01cd77fe", "�□¶¤? x�□\n□¶�", "xkcd qwrt pfgh\nbcdf ghjkl", "·~|°\\=(<^\n*:=)/"]


@pytest.mark.parametrize("text,kind", [(PROSE, None), (LIST, "list"), (TABLE, "table"), (TABLE.replace(" | ", "\t"), "table"), (LONG, None), *((j, "junk") for j in JUNK)])
def test_kind(text, kind):
    assert textkind.kind_of(text) == kind


def test_kinds_of_look_alikes_stay():
    wide = PROSE.translate({ord("a"): "ａ", ord("o"): "о", ord("e"): "е"})
    assert textkind.kind_of(wide) is None
    assert textkind.kind_of(unicodedata.normalize("NFD", PROSE)) is None


def test_quality(spark):
    rows = [(i, f"{PROSE} {i}\n{PROSE}", "sv" if i % 2 else None) for i in range(60)] + [(100, LIST, "sv"), (101, TABLE, "sv"), (102, JUNK[0], None), (103, None, "sv"), (104, "  ", "fi"), (105, PROSE, "fi")]
    rows += [(106, LIST + "\n", "fi")] * 2 + [(None, TABLE, "sv")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("kind", F.lit("clash"))
    lex = spark.createDataFrame([("den", True), ("bron", False), (None, True)], "word string, is_common boolean")
    stats = quality.statistics(d, "doc_id", "text", "lang", lex)
    got = quality.scored(stats).collect()
    assert len(got) == len(rows)
    kinds = sorted((r.doc_id is None, r.doc_id or 0, r.kind) for r in got if r.kind)
    assert kinds == [(False, 100, "list"), (False, 101, "table"), (False, 102, "junk"), (False, 106, "list"), (False, 106, "list"), (True, 0, "table")]
    one = next(r for r in got if r.doc_id == 105)
    assert one.n_words == 18 and one.n_lines == 1 and abs(one.common_share - 1 / 18) < 1e-9
    assert next(r for r in got if r.doc_id == 103).n_words == 0


@pytest.mark.parametrize("text,kind", [(LIST, "list"), (TABLE, "table"), (JUNK[0], "junk")])
def test_many_cases_keep_their_kind(spark, text, kind):
    """40 % of one language and of all documents; none of the others loses or gets a kind."""
    rows = [(i, text if i % 5 < 2 else f"{PROSE} {i}\n{PROSE}", "sv" if i % 2 else "fi") for i in range(200)]
    rows += [(1000 + i, text, "en") for i in range(40)]  # a language of cases alone
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    stats = quality.statistics(d, "doc_id", "text", "lang", spark.createDataFrame([], "word string, is_common boolean"))
    assert {r.doc_id: r.kind for r in quality.scored(stats).collect()} == {i: kind if t == text else None for i, t, _ in rows}


def test_a_wide_spread_hides_no_list(spark):
    """Verse-like texts, whose share of short lines spreads up to the limit."""
    mixed = [f"{LIST[: LIST.index(chr(10))]}\n" * k + f"{PROSE}\n" * (10 - k) for k in range(8)]
    rows = [(i, mixed[i % 8], "sv") for i in range(160)] + [(900, LIST, "sv")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    stats = quality.statistics(d, "doc_id", "text", "lang", spark.createDataFrame([], "word string, is_common boolean"))
    assert [r.doc_id for r in quality.scored(stats).where("kind is not null").collect()] == [900]


def test_the_emptiest_stretch_gives_the_limit():
    def ranks(values):
        return [float(np.mean(np.asarray(values) <= i / quality.STEPS)) for i in range(quality.STEPS + 1)]

    assert abs(quality.emptiest(ranks([0.3] * 50 + [0.62] * 30 + [0.95] * 20), 1) - 0.785) < 0.02
    assert abs(quality.emptiest(ranks([0.55] * 50 + [0.1] * 20), -1) - 0.3) < 0.06
    assert quality.emptiest(ranks([0.2, 0.6]), 1) > 0.6  # no case: beyond all values


@pytest.mark.parametrize("upper", [0.6, 0.7])
def test_sketches_move_the_limit(spark, upper):
    """What merely lies far out is no list, however far, if the lists lie apart from it."""
    shares = [0.0, 0.1, 0.05, upper] * 30 + [1.0] * 40
    rows = [(i, "sv", 40, 4.0, 0.95, 0.1, 0.5, 20, x, 0.0, 0.9, 0.0) for i, x in enumerate(shares)]
    d = spark.createDataFrame(rows, "doc_id long, lang string, " + ", ".join(f"{s} {'long' if s.startswith('n_') else 'double'}" for s in quality.STATS))
    got = {r.doc_id for r in quality.scored(d).where("kind = 'list'").collect()}
    assert got == {i for i, x in enumerate(shares) if x == 1.0}
    assert quality.scored(d.limit(0)).count() == 0


def test_quality_sketches_merge(spark):
    rows = [(i, "ord " * (i + 1), "sv" if i % 3 else "fi") for i in range(300)]
    stats = quality.statistics(spark.createDataFrame(rows, "doc_id long, text string, lang string"), "doc_id", "text", "lang", spark.createDataFrame([], "word string, is_common boolean"))
    every = quality.merge(quality.sketches(stats), [])
    r = every.select("n", F.kll_sketch_get_quantile_double("n_words", F.lit(0.5)).alias("q")).first()
    assert r.n == 300 and abs(r.q - 150) < 10


# Repetition (p2)


def marked(words, run=5):
    """Brute force: words in runs that occurred before."""
    hit = [False] * len(words)
    for i in range(len(words) - run + 1):
        if any(words[j : j + run] == words[i : i + run] for j in range(i)):
            hit[i : i + run] = [True] * run
    return sum(hit) / len(words) if words else 0.0


def test_repeated_share_equals_brute_force():
    rng = np.random.default_rng(4)
    for _ in range(150):
        words = [f"w{i}" for i in rng.integers(0, rng.integers(2, 30), rng.integers(0, 60))]
        text = " ".join(w.upper() if i % 3 else w + ",\n" for i, w in enumerate(words))
        assert abs(repetition.measure(text)[1] - marked(words)) < 1e-12
        assert repetition.label(text) == (marked(words) >= repetition.LIMIT)


def test_decision_list_finds_the_limits():
    rng = np.random.default_rng(6)
    x = rng.random((600, 2))
    y = (x[:, 0] > 0.8) | ((x[:, 0] > 0.3) & (x[:, 1] < 0.2))
    rules = repetition.learn(x, y, ["a", "b"])
    hit = np.any([repetition._holds(x, ["a", "b"], r) for r in rules], axis=0)
    assert 1 < len(rules) <= 8 and (hit == y).mean() > 0.97


def test_rules_as_columns(spark):
    rules = [[("a", ">=", 0.5), ("b", "<=", 0.2)], [("a", "<=", 0.1)]]
    d = spark.createDataFrame([(0.6, 0.1), (0.6, 0.3), (0.05, 0.9)], "a double, b double")
    assert [r.c for r in d.select(repetition.as_case(rules).alias("c")).collect()] == [True, False, True]
    assert [r.c for r in d.select(repetition.as_case([]).alias("c")).collect()] == [False] * 3


def test_repetition(spark):
    rows = [("document", i, f"{PROSE} och {i}") for i in range(30)] + [("document", 50, f"{PROSE} {PROSE}"), ("document", 51, None), ("document", 52, " \n"), ("document", 53, "ja"), ("page", 50, PROSE), ("document", None, PROSE)]
    d = spark.createDataFrame(rows, "record_kind string, record_id long, text string").withColumn("junk", F.lit(1))
    got = {(r.record_kind, r.record_id): r for r in repetition.repeated(d).collect()}
    assert [k for k, r in got.items() if r.is_repeated] == [("document", 50)]
    assert abs(got["document", 50].repeated_share - 0.5) < 1e-9
    assert got["document", 51].n_words == 0 and got["document", 53].repeated_share == 0
    assert repetition.repeated(d.limit(0)).count() == 0


def test_the_list_decides_without_the_share(spark):
    """Held-out texts are judged from the other statistics; without the list nothing is found."""
    rng = np.random.default_rng(8)

    def text(k):
        own = ["ano" + "".join("aeioubdgkl"[int(c)] for c in str(x)) for x in rng.integers(0, 5000, 120)]
        again = own[: int(120 * k / (1 - k))]
        return " ".join(own + again)

    rows = [("document", i, text(0.05 + 0.1 * (i % 2) if i % 3 else 0.42)) for i in range(240)]
    d = spark.createDataFrame(rows, "record_kind string, record_id long, text string")
    assert "repeated_share" not in repetition.FEATURES
    got = repetition.repeated(d, train_rows=90).toPandas()
    assert (got["is_repeated"] == (got["repeated_share"] >= repetition.LIMIT)).all() and 0 < got["is_repeated"].sum() < 240
    rules = repetition.fit(got.head(90))
    assert rules and {name for rule in rules for name, _, _ in rule} <= set(repetition.FEATURES)
    assert not d.sparkSession.createDataFrame(got).withColumn("no_list", repetition.as_case([])).where("no_list").count()


def test_pages_and_huge_pages(spark, monkeypatch):
    rows = [(1, 0, i, 100 + i, t) for i, t in enumerate(["ett två tre fyra", "fem sex", "ett två tre fyra", "fem sex"])] + [(1, 0, 0, 100, "ett två tre fyra"), (2, 0, 0, 200, None), (None, 0, 0, 300, "x")]
    d = spark.createDataFrame(rows, "page_id long, region_pos int, line_pos int, line_id long, text string")
    pages, huge = repetition.page_texts(d)
    assert {r.page_id: r.text for r in pages.collect()} == {1: "ett två tre fyra\nfem sex\nett två tre fyra\nfem sex", 2: ""}
    assert huge.count() == 0
    monkeypatch.setattr(repetition, "MAX_PAGE_LINES", 3)
    pages, huge = repetition.page_texts(d)
    assert {r.page_id for r in pages.collect()} == {2}
    r = repetition.huge_statistics(huge).first()
    assert r.n_words == 12 and abs(r.repeated_share - 0.5) < 1e-9


@pytest.mark.parametrize("chunk", [10_000, 8])
def test_huge_pages_have_the_same_statistics(spark, monkeypatch, chunk):
    monkeypatch.setattr(repetition, "CHUNK", chunk)
    russian = "каждый сын и дом под старый мост"
    pages = {
        1: ["Dеrаѕ rågen dосk och över", "ｏｃｈ ﬁn vin\xadter kväl\u200blen", unicodedata.normalize("NFD", "på sjön över bron"), None, "  ", "DERAS rågen dock och över bron"] * 2,
        2: [russian, "oн и она", "ор", "the mан and the дом", russian.upper(), "oн и она"],  # words of look-alikes alone follow the page
        3: ["en rad ор", "två\nrader med ord som kommer igen", "två\nrader med ord som kommer igen"],
        4: [None, " ", "— ·", None],
        5: ["ett två", "tre fyra"],
        6: ["3f9ac0b7d2e1 88ab01cd77fe xkcd qwrt pfgh bcdf"] * 4,
        7: ["ett två tre fyra fem sex sju", "åtta nio tio ett två"],
        8: ["ja"] * 9,
    }
    rows = [(p, 0 if i % 3 else None, i, 100 * p + i if i else None, t) for p, ts in pages.items() for i, t in enumerate(ts)]
    rows += [(7, 0, 1, 701, "åtta nio tio ett två"), (7, 0, 1, 701, "en annan text med samma nummer"), (None, 0, 0, 1, "x")]
    d = spark.createDataFrame(rows, "page_id long, region_pos int, line_pos int, line_id long, text string")
    usual, _ = repetition.page_texts(d)
    want = repetition.statistics(usual.select(F.lit("page").alias("record_kind"), F.col("page_id").alias("record_id"), "text")).collect()
    monkeypatch.setattr(repetition, "MAX_PAGE_LINES", 1)
    none, huge = repetition.page_texts(d)
    assert none.count() == 0 and len(want) == len(pages)
    got = repetition.huge_statistics(huge)
    assert got.columns == ["record_kind", "record_id", "n_words", *repetition.STATS, "junk"]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))
    assert {r.record_id for r in want if r.junk} == {6} and sum(r.repeated_share > 0 for r in want) >= 5


# Look-alikes (p4)


def test_pairs(spark):
    t = "Över bron gick en fattig man; sedan fick han 18 brev."
    same = [t.replace("a", "а"), t.replace("o", "ο"), t.replace(" ", " "), t.replace("n", "n​"), unicodedata.normalize("NFD", t), t.replace("fi", "ﬁ"), t.translate({i: i + 0xFEE0 for i in range(0x21, 0x7F)})]
    other = [t.upper(), t.replace("ö", "o").replace("Ö", "O"), t.replace("18", "19"), t.replace("man", "kvinna"), t.replace("; ", ";\n")]
    rows = [("document", 1, t), ("document", 2, t)] + [("document", 10 + i, s) for i, s in enumerate(same)] + [("document", 30 + i, s) for i, s in enumerate(other)]
    rows += [("line", 1, t), ("line", 2, same[0]), ("line", 2, same[0]), ("document", 90, None), ("document", 91, " "), ("document", 92, " "), ("document", None, same[1]), ("line", 5, "—"), ("line", 6, "-")]
    d = spark.createDataFrame(rows, "record_kind string, id long, text string").withColumn("form", F.lit(0))
    got = {(r.record_kind, r.id_a, r.id_b) for r in lookalike.pairs(lookalike.classes(d)).collect()}
    plain = {i: unicodedata.normalize("NFC", lookalike_of(s)) for k, i, s in rows if k == "document" and s and s.strip() and i is not None}
    text = {i: s for k, i, s in rows if k == "document"}
    want = {("document", a, b) for a in plain for b in plain if a < b and plain[a] == plain[b] and text[a] != text[b]}
    assert got == want | {("line", 1, 2)}
    forms = {r.form for r in lookalike.classes(d).where("record_kind = 'document'").collect()}
    assert len(forms) == 1
    assert lookalike.pairs(lookalike.classes(d.limit(0))).count() == 0


def lookalike_of(s):
    for a, b in lookalike.LIGATURES.items():
        s = s.replace(a, b)
    return "".join(lookalike.LOOKS.get(c, c) for c in s)


def test_block_keys_hide_no_pair(spark):
    t = "Över bron på fältet: fiffiga flickor 12"
    variants = [t, unicodedata.normalize("NFD", t), t.replace("fi", "ﬁ").replace("fl", "ﬂ"), t.replace("o", "о"), t.replace(" ", "  "), t.replace("f", "f\xad")]
    d = spark.createDataFrame([(v,) for v in variants], "t string").select(lookalike.block_text(F.col("t")).alias("b")).distinct()
    assert d.count() == 1


def test_pairs_of_short_texts_of_hidden_letters(spark):
    groups = [["till", "ｔｉｌｌ", "ti\u200bll", "tіll", "till"], ["list", "liѕt"], ["fist.", "ﬁst.", "fiﬆ."], ["ist ïst", unicodedata.normalize("NFD", "ist ïst")], ["fil"], ["Till"], ["till till"], ["tïll"], ["—"], ["-"], ["‐"]]
    rows = [("line", 10 * g + i, x) for g, xs in enumerate(groups) for i, x in enumerate(xs)]
    got = {(r.id_a, r.id_b) for r in lookalike.pairs(lookalike.classes(spark.createDataFrame(rows, "record_kind string, id long, text string"))).collect()}
    want = {(a, b) for _, a, x in rows for _, b, y in rows if a < b and a // 10 == b // 10 and x != y}
    assert got == want and len(want) == 9 + 1 + 3 + 1


# Languages (p5)

WORDS = {
    "sv": "den och gick med hans bron till inte sjön under kvällen varje stad åker bonde gård".split(),
    "fi": "ja hän meni kanssa talo järvi ei vanha kylä poika metsä pelto sekä alla yli".split(),
    "en": "the and went with his bridge to not lake under evening every town field farm yard".split(),
    "ru": "и он пошёл мост не озеро старый деревня каждый поле дом город сын под через".split(),
}


def sentence(lang, rng, n=9):
    return " ".join(rng.choice(WORDS[lang], n)).capitalize() + "."


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(9)
    rows = [(i * 4 + k, " ".join(sentence(x, rng) for _ in range(5)), x) for i in range(25) for k, x in enumerate(WORDS)]
    rows += [(900, " ".join(sentence("fi", rng) for _ in range(5)), "sv"), (901, " ".join(sentence("sv", rng) for _ in range(4)) + "\n\n" + sentence("ru", rng), "Swedish")]
    rows += [(902, " ".join(sentence("en", rng) for _ in range(3)), None), (903, None, "sv"), (904, "  ", "fi"), (905, "1234 !", "fi"), (906, " ".join(sentence("sv", rng) for _ in range(4)).replace("o", "о"), "sv_SE")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("label", F.lit("clash"))


def test_document_languages(labelled):
    model = language.train(labelled, "doc_id", "text", "lang", 80)
    got = language.document_languages(labelled, "doc_id", "text", "lang", model).collect()
    main = {r.record_id: r.lang for r in got if r.is_main}
    stored = {r.doc_id: r.lang for r in labelled.collect()}
    plain = [i for i in range(100) if i in main]
    assert sum(main[i] == stored[i] for i in plain) >= 98
    assert main[900] == "fi" and main[902] == "en" and main[906] == "sv"
    assert {r.lang for r in got if r.record_id == 901} == {"sv", "ru"}
    assert not {903, 904, 905} & set(main)
    assert all(0.5 <= r.confidence <= 1 for r in got)


def test_page_languages(spark, labelled):
    rng = np.random.default_rng(3)
    model = language.train(labelled, "doc_id", "text", "lang")
    rows = [(1, i, sentence("sv", rng)) for i in range(6)] + [(1, 10, sentence("ru", rng)), (2, 20, sentence("fi", rng)), (2, 20, sentence("fi", rng)), (3, 30, None)]
    rows += [(4, 40 + i, sentence("fi", rng)) for i in range(6)] + [(4, 50 + i, sentence("ru", rng)) for i in range(2)] + [(None, 60, "x")]
    d = spark.createDataFrame(rows, "page_id long, line_id long, text string")
    got = {(r.page_id, r.lang, r.is_main) for r in language.page_languages(d, model).collect()}
    assert got == {(1, "sv", True), (2, "fi", True), (4, "fi", True), (4, "ru", False)}


def test_passages_of_mixed_records(spark, labelled):
    model = language.train(labelled, "doc_id", "text", "lang")
    rng = np.random.default_rng(5)
    rows = [(2, sentence("sv", rng) + " " + sentence("ru", rng) + " 12! " + sentence("sv", rng)), (1, "Den."), (3, None), (4, " "), (None, "och")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, language.document_passages(d, "doc_id", "text", model).drop("confidence").collect()))
    assert got == [(1, 0, 0, 1, "sv", True), (2, 0, 0, 9, "sv", False), (2, 1, 9, 9, "ru", False), (2, 2, 18, 9, "sv", False)]
    lines = [(7, 70, sentence("fi", rng)), (7, 71, sentence("ru", rng)), (7, 72, None), (8, 80, "x"), (None, 90, "x")]
    lines = spark.createDataFrame([*lines, lines[1]], "page_id long, line_id long, text string")
    of = {r.line_id: r for r in language.page_passages(lines, model).collect()}
    assert {i: (r.lang, r.ambiguous) for i, r in of.items() if i < 80} == {70: ("fi", False), 71: ("ru", False)} and of[80].ambiguous
    assert all(0.5 <= r.confidence <= 1 for r in of.values())


def test_segments_of_mixed_records(spark, labelled):
    model = language.train(labelled, "doc_id", "text", "lang")
    rng = np.random.default_rng(5)
    text = sentence("sv", rng) + " " + sentence("sv", rng) + " Xq. " + sentence("ru", rng) + " 12! " + sentence("fi", rng)
    d = spark.createDataFrame([(2, text), (1, "Den."), (3, None), (4, " "), (None, "och")], "doc_id long, text string")
    got = sorted(map(tuple, language.document_segments(d, "doc_id", "text", model).drop("confidence").collect()))
    assert [(r[0], r[1], r[4]) for r in got] == [(1, 0, "sv"), (2, 0, "sv"), (2, 1, "ru"), (2, 2, "fi")]
    assert got[1][2] == 0 and got[3][3] == 36 and all(a[3] + 1 == b[2] for a, b in zip(got[1:], got[2:], strict=False))
    assert language.document_segments(d.limit(0), "doc_id", "text", model).count() == 0


def test_segments_cover_held_out_words(spark, labelled):
    """Texts put together from sentences of known languages: words that get the language of their sentence."""
    model = language.train(labelled, "doc_id", "text", "lang")
    rng = np.random.default_rng(12)
    langs = [[str(x) for x in rng.choice(["sv", "fi", "en", "ru"], 3) for _ in range(2)] for _ in range(40)]
    d = spark.createDataFrame([(i, " ".join(sentence(x, rng) for x in l)) for i, l in enumerate(langs)], "doc_id long, text string")
    right = total = 0
    for r in language.document_segments(d, "doc_id", "text", model).collect():
        truth = [langs[r.record_id][w // 9] for w in range(r.first_word, r.last_word + 1)]
        right, total = right + truth.count(r.lang), total + len(truth)
    assert total == 40 * 6 * 9 and right / total > 0.97


def test_passages_add_up_to_records(spark, data):
    every = catalog.p5_languages(spark, data).collect()
    p = catalog.p5_passages(spark, data).toPandas()
    docs = p[p.record_kind == "document"].groupby(["record_id", "lang"]).n_words.sum().to_dict()
    assert docs == {(r.record_id, r.lang): r.n_words for r in every if r.record_kind == "document"}
    assert set(p[p.record_kind == "page"].record_id) == {r.record_id for r in every if r.record_kind == "page"}
    assert not p[p.record_kind == "page"].line_id.duplicated().any()
    assert {r.ambiguous for r in every} <= {True, False}


def test_labels(spark):
    rows = [(x,) for x in ("sv", "SV", "fi-FI", "Finnish", "swe", "no", "se", "", " ", "und", None, "unknown", "ru_RU")]
    got = [r.c for r in spark.createDataFrame(rows, "l string").select(language.label_language(F.col("l")).alias("c")).collect()]
    assert got == ["sv", "sv", "fi", "fi", "sv", "?", "?", None, None, None, None, None, "ru"]


def test_codewords_are_apart():
    c = language.codewords(8)
    assert min((c[i] != c[j]).sum() for i in range(8) for j in range(i)) >= 5


def test_no_training_rows(spark):
    e = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = language.train(e, "doc_id", "text", "lang")
    assert language.document_languages(e, "doc_id", "text", "lang", model).count() == 0


# Scanned pages (p3)

LEXICON = ["mannen", "gick", "över", "bron", "hans", "dotter", "kom", "hem", "med", "brevet", "kvällen", "tuomari", "ensimmäinen", "ingen"]
PAGES = """STADSBOK 1826
Mannen gick över bron och hans dot-
ter kom hem med brevet på
- 12 -
STADSBOK 1826
kvällen. Ingen gick hem. Mannen gick över bron, och kvä¬
llen kom.
   Ingcn gick över bron mcd bre⸗
vet. Hans dotter gick hem –
med brevet.
- 13 -"""


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(1, PAGES), (2, "tuom@ri\n" * 3), (3, None), (4, " "), (5, LIST), (6, JUNK[0]), (7, "en rad"), (None, PAGES)]
    rows += [(100 + i, "\n".join(["mannen gick över bron med hans dotter", "ingen kom hem med brevet på kvällen", "tuomari gick över bron", "ingen gick över bron med brevet"])) for i in range(30)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("line_no", F.lit(0))


def test_noise_and_repair(spark, corpus):
    lex = spark.createDataFrame([(w, True) for w in LEXICON] + [(None, None)], "word string, is_common boolean")
    c = scan.fit(corpus, "text", lex)
    got = {(r.line_no, r.noise_kind) for r in scan.find_noise(corpus, "doc_id", "text", c).where("doc_id = 1").collect()}
    assert got == {(0, "header"), (4, "header"), (3, "page_number"), (10, "page_number"), (1, "hyphen"), (5, "hyphen"), (7, "hyphen"), (7, "misread")}
    fixed = {r.doc_id: r.text for r in scan.repaired(corpus, "doc_id", "text", c).collect()}
    assert fixed[1] == (
        "Mannen gick över bron och hans dotter kom hem med brevet på kvällen. Ingen gick hem. Mannen gick över bron, och kvällen kom.\n\n"
        "Ingen gick över bron med brevet. Hans dotter gick hem – med brevet."
    )
    assert fixed[3] is None and fixed[5] == LIST and fixed[6] == JUNK[0]


@pytest.mark.parametrize("limit", [500_000, 5, 0])
def test_flushed_counts_lose_no_context(monkeypatch, limit):
    monkeypatch.setattr(scan, "FLUSH_WORDS", limit)
    texts = ["mannen gick över bron", "hans dotter kom hem", "ett två tre fyra fem sex sju åtta", "ingen kom hem"]
    frames = list(scan._counting(sorted(LEXICON))(pd.DataFrame({"text": [t], "copies": 1}) for t in texts))
    every = pd.concat(frames)
    assert every.groupby("word").n.sum().to_dict() == Counter(" ".join(texts).split())
    rows = every[every.around.notna()]
    grid = {w: np.frombuffer(b, dtype=np.int32).sum() for w, b in zip(rows.word, rows.around, strict=True)}
    assert grid == {"mannen": 2, "gick": 3, "över": 3, "bron": 2, "hans": 2, "dotter": 3, "kom": 5, "hem": 4, "ingen": 2} and len(rows) == len(grid)


def test_a_misread_word_in_a_copied_text(spark):
    lines = ["mannen gick över bron med hans dotter", "ingen kom hem med brevet på kvällen"]
    rows = [(i, "\n".join([*lines, f"tuomari gick över bron {i}"])) for i in range(40)]
    rows += [(100 + i, "\n".join(["tnomari gick över bron", *lines])) for i in range(20)]  # a third of all rows
    d = spark.createDataFrame(rows, "doc_id long, text string")
    c = scan.fit(d, "text", spark.createDataFrame([(w, True) for w in LEXICON], "word string, is_common boolean"))
    found = scan.find_noise(d, "doc_id", "text", c).collect()
    assert {(r.doc_id, r.line_no, r.noise_kind) for r in found} == {(100 + i, 0, "misread") for i in range(20)}
    copies = {r.text: r.copies for r in scan.with_copies(d, "text").collect()}
    assert copies[rows[-1][1]] == 20 and copies[rows[0][1]] == 1 and len(copies) == 41


def test_the_context_decides_on_misread_words(spark, corpus):
    """Without vectors no word is misread, and a word that its neighbours do not speak for stays."""
    c = scan.fit(corpus, "text", spark.createDataFrame([(w, True) for w in LEXICON], "word string, is_common boolean"))
    plain = scan.Corrector(c.links, list(c.at), np.zeros_like(c.words), c.contexts)
    got = {name: {(k, n) for k, n in scan.noise(PAGES, x)} for name, x in (("learned", c), ("none", plain))}
    assert got["learned"] - got["none"] == {(7, "misread")} and got["none"] < got["learned"]
    words, contexts = np.eye(2), np.zeros((scan.CONTEXTS, 2))
    two = scan.Corrector({"hcm": [("hem", 1)]}, ["hem", "kom"], words, contexts)
    contexts[two.bucket[two.at["kom"]]] = [1, -1]
    good = scan.Corrector(two.links, ["hem", "kom"], words, contexts)
    bad = scan.Corrector(two.links, ["hem", "kom"], words, -contexts)
    assert good.correct("hcm", ["kom"]) == "hem" and bad.correct("hcm", ["kom"]) is None
    assert bad.correct("hcm", ["okänt"]) == "hem" and bad.correct("hem", ["kom"]) is None


def test_cut_into_lines():
    prose = ["Mannen gick över bron.", "Hans dotter kom hem med brevet!", "Ingen gick."]
    assert not scan.cut_into_lines(prose, [0, 1, 2]) and not scan.cut_into_lines(["en rad"], [0]) and not scan.cut_into_lines([], [])
    assert scan.cut_into_lines(["Mannen gick över", "bron. Hans dotter kom", "hem med brevet."], [0, 1, 2])


def test_no_lexicon_and_no_rows(spark, corpus):
    lex = spark.createDataFrame([], "word string, is_common boolean")
    c = scan.fit(corpus, "text", lex)
    assert scan.find_noise(corpus, "doc_id", "text", c).where("noise_kind = 'misread'").count() == 0
    e = corpus.limit(0)
    assert scan.find_noise(e, "doc_id", "text", scan.fit(e, "text", lex)).count() == 0


def test_lone_numbers():
    lines = ["Mannen gick över bron med", "1724.", "Sedan kom han hem och", "12", "gick över bron med", "13", "hans dotter."]
    assert scan.furniture(lines) == {3: "page_number", 5: "page_number"}


def test_glyphs():
    forms = scan.glyph_forms(["tuomari", "kylä", "mark"])
    assert scan.glyph_sources("tnomari", forms) == {"tuomari": 1}
    assert scan.glyph_sources("tnomar1", forms) == {"tuomari": 2}
    assert scan.glyph_sources("marlc", forms) == {"mark": 1}
    assert scan.glyph_sources("bord", forms) == {}


def test_vectors_bring_like_words_together():
    rng = np.random.default_rng(0)
    n = rng.poisson(1, (6, scan.CONTEXTS))
    n[:3, :20] += 60
    n[3:, 20:40] += 60
    w, _ = scan.learn_vectors(n)
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    s = w @ w.T
    assert s[0, 1] > s[0, 4] and s[3, 5] > s[3, 1]


def test_readable_keeps_words_in_one_script():
    for seen, shown in (
        ("Dеrаѕ rågеn dосk", "Deras rågen dock"), ("каждый oн cын и дoм", "каждый он сын и дом"), ("en bοndekarl och över", "en bondekarl och över"),
        ("tä lӓst och pа̊", "tä läst och på"), ("каждый сын and the дом", "каждый сын and the дом"), ("ｏｃｈ ﬁn", "och fin"), ("plain", "plain"),
    ):
        assert textkind.readable(seen) == shown


def test_a_prose_line_like_a_heading_is_none():
    lines = ["GRITOLNISKA", "Mannen gick över bron med hans", "Gritolniska.", "dotter och kom hem", "GRITOL·ISKA", "igen."]
    assert scan.furniture(lines) == {0: "header", 4: "header"}


def test_pairs_of_a_large_class(spark, monkeypatch):
    """A class over the limit is salted; the pairs are those of brute force."""
    monkeypatch.setattr(lookalike, "TOGETHER", 7)
    texts = ["bron", "brоn", "b​ron", "bｒon"]
    rows = [("line", i, texts[i % 4] if i % 3 else "bron") for i in range(50)] + [("line", 100, "an"), ("line", 101, "ａn"), ("document", 1, "an")]
    d = spark.createDataFrame(rows, "record_kind string, id long, text string")
    got = {(r.id_a, r.id_b) for r in lookalike.pairs(lookalike.classes(d)).collect()}
    text = {i: t for k, i, t in rows if k == "line"}
    assert got == {(a, b) for a in range(50) for b in range(a + 1, 50) if text[a] != text[b]} | {(100, 101)}


def test_letters_of_other_fonts_and_widths(spark):
    rows = [("line", i, t) for i, t in enumerate(["bron 12", "𝐛𝐫𝐨𝐧 𝟏𝟐", "𝓫𝓻𝓸𝓷 𝟭𝟮", "bron 13", "ﾅ nio", "ナ nio"])]
    d = spark.createDataFrame(rows, "record_kind string, id long, text string")
    assert {(r.id_a, r.id_b) for r in lookalike.pairs(lookalike.classes(d)).collect()} == {(0, 1), (0, 2), (1, 2), (4, 5)}


COMPOSED = ["ÅKΩ", "ἀ", "ệ", "각", "が", "豈", "שׁ", "क़", "ো", "q̣̇", "آ", "≮", "ｶﾞ", "ﾾﾡ"]


def test_pairs_of_all_composed_forms(spark):
    """However a character is composed and in whatever order its marks stand, the look is one; marks that collations ignore still count."""
    rows, look = [], {}
    for i, x in enumerate(COMPOSED):
        x = f"bron {i} {x}"
        d = unicodedata.normalize("NFD", x)
        for s in sorted({x, d, unicodedata.normalize("NFC", x), d.replace("\u0323\u0302", "\u0302\u0323"), lookalike_of(x)}):
            look[len(rows)] = unicodedata.normalize("NFC", lookalike_of(s))
            rows.append(("line", len(rows), s))
    for s in ("bron בֽ ו", "bron ב וֽ", "bron ב ו", "bron क॑ क", "bron क क॑", "ᅡ", "ￂ"):
        look[len(rows)] = unicodedata.normalize("NFC", lookalike_of(s))
        rows.append(("line", len(rows), s))
    got = [(r.id_a, r.id_b) for r in lookalike.pairs(lookalike.classes(spark.createDataFrame(rows, "record_kind string, id long, text string"))).collect()]
    assert sorted(got) == [(a, b) for a in look for b in look if a < b and look[a] == look[b]]
    assert len({look[a] for a, _ in got}) == len(COMPOSED) + 1


def test_pairs_of_ids_with_several_texts(spark):
    rows = [("line", 1, "bron gick"), ("line", 1, "hem sedan"), ("line", 2, "brоn gick"), ("line", 2, "hem sеdan"), ("line", 3, "hem ѕedan")]
    got = lookalike.pairs(lookalike.classes(spark.createDataFrame(rows, "record_kind string, id long, text string"))).collect()
    assert sorted((r.id_a, r.id_b) for r in got) == [(1, 2), (1, 2), (1, 3), (2, 3)]


def test_p4_found_is_that_of_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    words = ["\u00c5ngström", "\u212bngström", "A\u030angström", "och e\u0302\u0323n", "och \u1ec7n", "och \u1eb9\u0302n", "den \u1f00 mannen", "den \u03b1\u0313 mannen"]
    spark.createDataFrame(list(enumerate(words)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, w + " gick") for i, w in enumerate(words)], "line_id long, text string").write.parquet(f"{tmp_path}/line_text.parquet")
    con = duckdb.connect()
    con.execute("CREATE TABLE lexicon AS SELECT 'gick' word, true is_common")
    for t in ("documents", "line_text"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    want = con.execute(catalog.oracle_sql()["p4_found"]).fetchall()
    assert sorted(map(tuple, catalog.p4_found(spark, str(tmp_path)).collect())) == sorted(want) and len(want) == 14
