import random

import numpy as np
import pyarrow as pa
import pytest
from ordermart.llm import toxicity as t
from ordermart.llm.common import blocks

from .llm_cases import ODD


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


TERMS = [
    t.Term("loser", False, 1.0, 1),
    t.Term("disgusting", False, 1.0, 2),
    t.Term("lösung", False, 1.0, 1),
    t.Term("scum", False, 1.0, 0),
    t.Term("vequ", True, 1.0, 0),
]


def run(automaton, word):
    letters = np.array([automaton.alphabet.get(c, 0) for c in word] or [0], np.uint8)
    term, edits = t.run_words(automaton, letters, np.array([0]), np.array([len(word)]))
    return term[0], edits[0]


def test_automaton_agrees_with_edit_distance():
    automaton = t.Automaton(TERMS)
    random.seed(1)
    letters = "losergduitncmqvöhx"
    cases = [term.form for term in TERMS] + ["", "vequxyz", "veq"]
    for _ in range(4000):
        word = list(random.choice(TERMS).form)
        for _ in range(random.randint(0, 3)):
            at, kind = random.randrange(len(word) + 1), random.randrange(3)
            word[at : at + (kind > 0)] = random.choice(letters) if kind < 2 else []
        cases.append("".join(word))
    for word in cases:
        best = [
            (0 if term.beginning else distance(word, term.form), n)
            for n, term in enumerate(TERMS)
            if (word.startswith(term.form) if term.beginning else distance(word, term.form) <= term.edits)
        ]
        term, edits = run(automaton, word)
        if any(TERMS[n].beginning for _, n in best):
            assert TERMS[term].beginning, word
        else:
            assert ((edits, term) if term >= 0 else None) == (min(best) if best else None), word


def scores(*texts):
    automaton = t.Automaton(TERMS)
    return np.concatenate([t.window_scores(b, automaton) for b in blocks(pa.array(texts))])


def test_context_separates_quotation_from_abuse():
    abuse, quoted, reported, near, far, missed = scores(
        "You are scum.",
        'The word "scum" is short.',
        "He said scum was the word.",
        "scum disgustin loser here",
        "scum " + "filler " * 30 + "loser",
        "such a losr and disgustng",
    )
    assert abuse[0] > 1 and abuse[1] == 0
    assert quoted[0] == 0 and 0 < quoted[1] < 1
    assert 0 < reported[0] < 1
    assert near[2] > far[2] == 1 and near[0] > far[0] == 2
    assert 1 < missed[0] < 2
    assert scores("Vequille")[0][0] == 1 and scores("plain")[0].sum() == 0


def labelled(spark, n=1600):
    random.seed(2)
    plain = [f"w{k}" for k in range(300)]
    bad = ["loser", "moronic", "wretched", "scumbag", "vequard", "vequette"]
    rows, marks = [], []
    for i in range(n):
        words = random.choices(plain, k=40)
        toxic = i % 4 == 0
        if toxic:
            for w in random.sample(bad, 3):
                words.insert(random.randrange(40), w)
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    rows += [(9000, "wretchd w1 w2 scumbaag w3 moronik"), (9001, "w1 w2 w3")]
    return rows, spark.createDataFrame(marks + [(5000, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_learns_from_allowed_folds_and_keeps_clean_rows(spark, documents):
    rows, labels = labelled(spark)
    docs = documents(*rows, *ODD)
    got = {}
    for r in t.judge_toxicity(docs, labels).collect():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        got[r.doc_id] = r
    # The odd rows share their ids with the first documents.
    assert all(got[i].predicted == int(i % 4 == 0) for i in range(10, 1600))
    assert got[9000].predicted == 1 and got[9001].predicted == 0
    model = t.learn(docs, labels)
    assert {term.form[:4] for term in model.terms} >= {"lose", "moro", "wret", "scum", "vequ"}
    kept = t.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 401


@pytest.mark.parametrize("condition", ["false", "toxic = 0"])
def test_without_labels_of_both_classes(spark, documents, condition):
    rows, labels = labelled(spark, 40)
    docs = documents(*rows)
    scored = t.judge_toxicity(docs, labels.where(condition)).collect()
    assert len({r.score for r in scored}) == 1 and not any(r.predicted for r in scored)
    assert t.judge_toxicity(docs.where("false"), labels).collect() == []


def test_beginnings_may_be_misspelt():
    terms = [t.Term("vequ", True, 1.0, 1), t.Term("disgus", True, 0.4, 1), t.Term("scum", False, 0.5, 1)]
    automaton = t.Automaton(terms)
    random.seed(3)
    for _ in range(4000):
        word = list(random.choice(["vequard", "disgustingly", "scum", "scums"]))
        for _ in range(random.randint(0, 3)):
            at, kind = random.randrange(len(word) + 1), random.randrange(3)
            word[at : at + (kind > 0)] = random.choice("vequdisgcmx") if kind < 2 else []
        word = "".join(word)
        openings, whole = [], []
        for n, term in enumerate(terms):
            if term.beginning:
                spent = min(distance(word[:k], term.form) for k in range(len(word) + 1))
                openings += [(spent, n)] if spent <= term.edits else []
            elif distance(word, term.form) <= term.edits:
                whole.append((distance(word, term.form), n))
        best = min(openings or whole, default=None)
        term, edits = run(automaton, word)
        assert ((edits, term) if term >= 0 else None) == best, word


@pytest.mark.parametrize("n", [1600, 3200, 6400])
def test_misspellings_count_at_every_sample_size(spark, documents, n):
    random.seed(4)
    plain = ["".join(random.choices("bdfhjk", k=7)) for _ in range(300)]
    # Terms of four letters, and terms in a twentieth of the toxic texts only.
    bad = ["scum", *("".join(random.choices("mnprtvwx", k=8)) for _ in range(19))]
    rows, marks = [], []
    for i in range(n):
        words = random.choices(plain, k=30)
        if i % 4 == 0:
            words[random.randrange(30)] = bad[i // 4 % 20]
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(i % 4 == 0)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = t.learn(documents(*rows), labels)
    edits = {term.form: term.edits for term in model.terms if not term.beginning}
    assert {form: edits.get(form) for form in bad} == dict.fromkeys(bad, 1)
    automaton = t.Automaton(model.terms)
    assert run(automaton, "scam")[0] >= 0 and run(automaton, bad[7][:-1])[0] >= 0


def test_as_many_terms_as_there_are(spark, documents):
    random.seed(5)
    plain = ["".join(random.choices("bdfhjk", k=7)) for _ in range(300)]
    # Terms of two and three letters, and over a hundred longer ones; each in a few texts.
    bad = ["zq", "qxz", *{"".join(random.choices("mnprtvwxyzlcgs", k=8)) for _ in range(148)}]
    rows, marks = [], []
    for i in range(18_000):
        words = random.choices(plain, k=8)
        if i % 6 == 0:
            words[random.randrange(8)] = bad[i // 6 % len(bad)]
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(i % 6 == 0)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    docs = documents(*rows, clashing=False)
    model = t.learn(docs, labels)
    assert len(model.terms) > 100 and {"zq", "qxz"} <= {term.form for term in model.terms}
    missed = {r.doc_id for r in t.judge_toxicity(docs, labels).collect() if r.predicted != int(r.doc_id % 6 == 0)}
    assert not {i for i in missed if bad[i // 6 % len(bad)] in ("zq", "qxz")} and len(missed) < 180


def test_terms_of_many_different_letters():
    letters = [chr(0x4E00 + k) for k in range(300)]
    terms = [t.Term("".join(letters[k : k + 3]), False, 1.0) for k in range(0, 300, 3)]
    automaton = t.Automaton(terms)
    assert len(automaton.alphabet) == 300 and len({int(automaton.classes[ord(c)]) for c in letters}) == 300
    text = "".join(letters[297:]) + " x " + "".join(letters[:3])
    block = next(blocks(pa.array([text])))
    assert t.found_terms(block, automaton)[-2].tolist() == [99, -1, 0]


def test_many_terms_make_the_states_that_words_need(monkeypatch):
    random.seed(6)
    forms = sorted({"".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=random.randint(5, 12))) for _ in range(2000)})
    terms = [t.Term(form, False, 1.0, t.usual_edits(form)) for form in forms]
    text = " ".join(random.choices(forms, k=300) + ["".join(random.choices("abcdefgh", k=6)) for _ in range(300)])
    block = next(blocks(pa.array([text])))
    whole = t.Automaton(terms)
    term, edits = t.found_terms(block, whole)[-2:]
    assert len(whole.states) < 10_000
    for word, number, spent in zip(text.split(" "), term, edits):
        near = [(distance(word, forms[k]), k) for k in range(len(forms)) if abs(len(forms[k]) - len(word)) < 3]
        best = min((x for x in near if x[0] <= terms[x[1]].edits), default=None)
        assert ((spent, number) if number >= 0 else None) == best, word
    # Forgetting the states in between changes nothing.
    monkeypatch.setattr(t, "RUN_WORDS", 50)
    monkeypatch.setattr(t, "KEPT_NODES", 5000)
    again = t.found_terms(block, t.Automaton(terms))[-2:]
    assert (again[0] == term).all() and (again[1] == edits).all()
