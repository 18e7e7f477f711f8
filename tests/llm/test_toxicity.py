import os
import zlib

import numpy as np
import pytest

from clickbasin.llm import entries, toxicity
from clickbasin.llm.toxicity import Lexicon

SF_DIR = "/root/testdata/sf0.1"


def plain_matches(lexicon, text):
    """Every place where a word begins, every term tried there."""
    low = toxicity.folded(text)
    spans = []
    for phrase in map(toxicity.folded, lexicon.exceptions):
        for i in range(len(low)):
            ends = i + len(phrase)
            if low.startswith(phrase, i) and not low[ends : ends + 1].isalpha() and not (i and low[i - 1].isalpha()):
                spans.append((i, ends))
    out = []
    for i in range(len(low)):
        if i and low[i - 1].isalpha():
            continue
        found = []
        for whole, terms in ((True, lexicon.words), (False, lexicon.stems)):
            for term, weight in terms.items():
                term = toxicity.folded(term)
                ends = i + len(term)
                # A whole word may have the ending of a plural.
                plural = [low[ends : ends + len(more)] == more and not low[ends + len(more) :][:1].isalpha() for more in ("", "s", "es")]
                if low.startswith(term, i) and (not whole or any(plural)):
                    found.append((weight, ends))
        if found:
            weight = max(w for w, _ in found)
            ends = next(e for w, e in found if w == weight)
            if not any(a <= i and ends <= b for a, b in spans):
                out.append((i, weight))
    return sorted(out)


LEXICON = Lexicon(words={"idiot": 1.0, "scum": 0.5, "dé": 0.2}, stems={"vequ": 2.0, "vequa": 3.0}, exceptions=("idiot proof", "vequament"))


@pytest.mark.parametrize(
    "text",
    [
        "", "idiot", "An IDIOT, scum!", "idiots scums", "1d10t 1diot id!ot i d i o t", "idıot іdіоt ｉｄｉｏｔ ïdïöt",
        "idiot proof, but an idiot proofreader", "vequ vequaz vequament avequ vequaments", "dé dês", "scum2 5cum $cum",
        "é😀 idiot\nscum\tscum", "İdiot", "x" * 5000 + " idiot " + "scum " * 500,
    ],
)
def test_matches_by_automaton_are_all_matches(text):
    found = toxicity.matches(LEXICON.automaton(), toxicity.folded(text))
    assert sorted((start, weight) for start, _, weight in found) == plain_matches(LEXICON, text)
    assert len(toxicity.folded(text)) == len(text)


def test_folding_and_exceptions():
    automaton = LEXICON.automaton()
    for text in ("1d10t", "іdіоt", "ＩＤＩＯＴ", "id!ot", "ïdiot"):
        assert toxicity.measures(automaton, f"you {text} there")[0] == 1.0
    assert toxicity.measures(automaton, "an idiot proof plan") == (0.0, 0.0)
    assert toxicity.measures(automaton, "call 5550123 or 10") == (0.0, 0.0)
    short, long = (toxicity.measures(automaton, "idiot " + "word " * n)[1] for n in (3, 300))
    assert short > long > 0


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "fine words " * 50_000, None), (4, "idiot", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = frame.withColumn("score", toxicity.toxicity(Lexicon(), frame.text)).collect()
    assert got[0].score == got[1].score == got[2].score == got[3].score < 0.5 < got[4].score
    assert frame.where("false").withColumn("score", toxicity.toxicity(Lexicon(), frame.text)).count() == 0


def test_without_toxic_rows_the_seed_terms_remain(spark):
    for rows in ([], [(1, "plain words", 0)]):
        learned = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, label int"))
        assert learned.words == toxicity.SEED_TERMS and not learned.stems


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = entries.op1_toxicity(spark, SF_DIR).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    known = [(r.predicted, labels[r.doc_id]) for r in held if r.doc_id in labels]
    assert np.mean([got for got, want in known if want]) >= 0.9
    assert np.mean([got for got, want in known if not want]) <= 0.01


def test_telling_words_are_no_exceptions_where_few_labels_are_toxic(spark):
    clean = [f"plain words here {i % 50}" for i in range(2940)]
    clean[:20] = ["vequor again"] * 20
    clean[20:40] = ["vequament of old"] * 20
    clean[40:45] = ["vequilla of old"] * 5
    toxic = ["you vequor"] * 15 + ["you vequim"] * 12 + ["you vequas"] * 12 + ["a vequilla perhaps"] + ["you vequel"] * 20
    rows = [(i, text, int(i < len(toxic))) for i, text in enumerate(toxic + clean)]
    learned = toxicity.learn(spark.createDataFrame(rows, "doc_id long, text string, label int"))
    automaton = learned.automaton()
    assert any("vequor".startswith(stem) for stem in learned.stems)
    assert "vequor" not in learned.exceptions and toxicity.measures(automaton, "you vequor")[0] > 0
    assert "vequament" in learned.exceptions and toxicity.measures(automaton, "vequament") == (0.0, 0.0)


@pytest.mark.parametrize(
    "n, others, toxic, clean, lifted",
    [(30, 31, 120, 11880, False), (0, 1, 120, 11880, True), (2, 60, 120, 11880, True), (1, 1, 120, 11880, False),
     (3, 16, 1100, 8900, True), (12, 9, 6000, 4000, True)],
)
def test_exceptions_go_by_rates(n, others, toxic, clean, lifted):
    got = toxicity._exceptions([("word", "vequor", n, others)], {"vequ": 4.5}, toxic, clean)
    assert got == (("vequor",) if lifted else ())


@pytest.mark.parametrize(
    "text, total",
    [
        ("you idio7", 1.0), ("an 1d107!", 1.0), ("a 5cum$ idio7!!", 1.0), ("y0u a55.", 1.5),
        ("gooooo0000$e", 3.0), ("idiot1 and idiot$", 2.0), ("idiot! idiot!!!", 2.0), ("vequamen7", 0.0), ("mp3 a5 10 h1", 0.0),
    ],
)
def test_folding_at_the_end_of_words_and_in_long_runs(text, total):
    words = {"idiot": 1.0, "ass": 1.5, "g" + "o" * 9 + "se": 3.0}
    automaton = Lexicon(words=words, stems={"vequ": 2.0}, exceptions=("vequament",)).automaton()
    assert toxicity.measures(automaton, text)[0] == total
    assert all(len(form) == len(text) for form in toxicity.forms(toxicity.folded(text)))


@pytest.mark.parametrize(
    "text, found",
    [
        ("you i\u0308diot", ["i\u0308diot"]), ("id\u200bio\u00adt!", ["id\u200bio\u00adt"]), ("ɪᴅɪᴏᴛ", ["ɪᴅɪᴏᴛ"]), ("idiöt", ["idiöt"]),
        ("two idiots, one idiot", ["idiot", "idiot"]), ("two scumes", ["scum"]), ("scummy", []), ("\u200bscum\u0301", ["scum\u0301"]),
        ("de\u0301 and dé but de", ["de\u0301", "dé"]), ("vequ\u0301a", ["vequ\u0301a"]), ("😀\u200didiot", ["idiot"]), ("\u0301\u0302", []), ("", []),
    ],
)
def test_loose_marks_widthless_characters_and_own_letters(text, found):
    got = toxicity.spans(LEXICON.automaton(), text)
    assert [text[start:end].rstrip("\u200b") for start, end, _ in got] == found


def test_words_without_spaces_and_runs_of_spaces_count_alike():
    automaton = LEXICON.automaton()
    assert toxicity.measures(automaton, "idiot a b c") == toxicity.measures(automaton, "idiot   a \n\n b  c ")
    assert toxicity.measures(automaton, "idiot " + "日本語" * 40)[1] < 2.5


def test_many_phrases_and_matches_in_a_long_text_take_linear_time():
    text = "an idiot proof plan for idiots; " * 40_000
    found = toxicity.matches(LEXICON.automaton(), toxicity.folded(text))
    assert len(found) == 40_000


CLEAN = [
    "The pathology report was sent to the clinic by the doctor on Monday morning.",
    "A stupendous view of the valley opened before us as the train came out of the tunnel.",
    "Der Wortschatz des Kindes wächst in den ersten Jahren sehr schnell.",
    "The clownfish hides between the arms of the sea anemone all day long.",
    "Le pathos du texte est voulu par son auteur, et les lecteurs le sentent.",
    "She lost the closet key; the moray eel, the disguise and the trasimene map were found.",
]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01", SF_DIR])
def test_clean_words_that_share_a_beginning(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    lexicon = toxicity.learn(entries.labelled_sample(docs, labels, "toxic", 3, 1, toxicity.SAMPLE_ROWS))
    automaton = lexicon.automaton()
    for text in CLEAN:
        assert toxicity.probability(lexicon.curve, *toxicity.measures(automaton, text)) < 0.7, text
    assert toxicity.probability(lexicon.curve, *toxicity.measures(automaton, "You are a pathetic idiot and a worthless clown.")) > 0.7


def test_a_beginning_takes_several_words():
    # kind, term, toxic, clean
    one = [("word", "pathetic", 60, 0), *[("stem", "pathetic"[:n], 60, 1) for n in range(4, 8)]]
    words, stems = toxicity._choose(one, 400, 3000)
    assert list(words) == ["pathetic"] and not stems
    many = [("word", f"vequor{x}", 8, 0) for x in ("an", "em", "is", "ol")]
    many += [("stem", "vequor"[:n], 32, 1) for n in (4, 5, 6)] + [("stem", f"vequor{x}"[:7], 8, 0) for x in "aeio"]
    words, stems = toxicity._choose(many, 400, 3000)
    assert list(stems) == ["vequor"] and not words
