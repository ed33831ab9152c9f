import random
import re

from kindred.llm import licenses
from tests.conftest import rows
from tests.llm.texts import documents, frame

MIT = licenses.TEMPLATES["mit"][0]
MORE = [
    (100, "Released under the MIT License. Also the mit-license, the MIT  license and Apache License"),
    (101, "GNU General Public License\nGENERAL PUBLIC LICENSE general public general public license"),
    (102, "before " + MIT.replace("free of charge", "for nothing") + " after"),
    (103, "Licensed under CC BY-NC 4.0. MIT"),
    (104, "license"),
    (105, "mit"),
    (106, "permission is hereby granted, and that is all there is of it"),
]


def expected(docs):
    out = []
    for doc_id, text in docs:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
        places, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            found = [i for i in range(len(words)) if words[i : i + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        ends = (min(places), max(places)) if places else (None, None)
        out.append((doc_id, len(words), len(places), *ends, ",".join(sorted(labels))))
    return sorted(out, key=repr)


def test_phrases_equal_brute_force(spark):
    docs = documents() + MORE
    got = licenses.scan(frame(spark, docs))
    base = got.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert rows(base) == expected(docs)
    assert got.filter("score < 0 OR score > 1").count() == 0


def test_templates_add_labels(spark):
    got = {r.doc_id: r for r in licenses.scan(frame(spark, MORE)).collect()}
    assert got[102].labels == "mit" and got[102].base_labels == "" and 0.8 < got[102].score < 1
    assert [tuple(s) for s in got[102].spans][0][0] == 1
    assert got[103].labels == "cc-by-nc"
    assert got[106].labels == "" and 0 < got[106].score < 0.3
    assert got[100].labels == "apache,mit"


def test_matching_statistics_equal_brute_force():
    rng = random.Random(5)
    for _ in range(20):
        templates = {"a": [" ".join(rng.choice("xyz") for _ in range(rng.randrange(1, 9))) for _ in range(3)]}
        automaton = licenses.Automaton({"x y": "p"}, templates)
        runs = [["x", "y"]] + [t.split() for t in templates["a"]]
        known = {tuple(r[i:j]) for r in runs for i in range(len(r)) for j in range(i + 1, len(r) + 1)}
        names = sorted({w for r in runs for w in r})
        text = [rng.choice(names) for _ in range(60)]
        states, lengths = automaton.stream([names.index(w) for w in text])
        for i, (state, length) in enumerate(zip(states, lengths)):
            longest = max((k for k in range(1, i + 2) if tuple(text[i + 1 - k : i + 1]) in known), default=0)
            assert length == longest
            ends = {(n, e) for n, r in enumerate(runs) for e in range(length - 1, len(r))
                    if length and r[e + 1 - length : e + 1] == text[i + 1 - length : i + 1]}
            assert set(automaton.ends[state]) == ends


def test_empty_table(spark):
    assert rows(licenses.scan(frame(spark, []))) == []


def test_every_template_has_its_own_label_and_no_other_whole_one(spark):
    texts = [(label, t) for label, ts in licenses.TEMPLATES.items() for t in ts]
    docs = [(i, f"some words ahead {t} and behind") for i, (_, t) in enumerate(texts)]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, docs)).collect()}
    for i, (label, _) in enumerate(texts):
        assert label in got[i].labels.split(",") and got[i].score == 1


def test_a_licence_with_parts_left_out(spark):
    for label, text in (("mit", licenses.TEMPLATES["mit"][2]), ("bsd", licenses.TEMPLATES["bsd"][1]), ("unlicense", licenses.TEMPLATES["unlicense"][0])):
        words = text.split()
        half = " ".join(words[len(words) // 2 :])
        most = " ".join(words[len(words) // 5 :])
        got = {r.doc_id: r for r in licenses.scan(frame(spark, [(1, half), (2, most)])).collect()}
        assert got[1].labels == "" and 0.4 < got[1].score < 0.6
        assert got[2].labels == label and 0.7 < got[2].score < 0.9
