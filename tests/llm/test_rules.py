import re
from collections import Counter

from kindred.llm import rules
from tests.conftest import rows
from tests.llm.texts import blank_words, documents, frame

CLEAN = "A line of plain words that ends as it should.\nAnd one more, with other words in it.\n"
MORE = [
    (100, CLEAN),
    (101, CLEAN + "a | b | c | d | e\nHome | News | About\n" * 2),
    (102, "BUY!! NOW!! CHEAP!! PILLS!! HERE!! FOR!! YOU!! AND!! ME!! TOO!!\n" + "x y."),
    (103, CLEAN + "All rights reserved.\nprivacy policy and more of the same\n\n \n"),
    (104, "w1*** w2### w3$$$ w4%%% w5&&& w6||| w7<<< w8>>> w9*** w10### w11"),
    (105, CLEAN + CLEAN),
    (106, "no closing mark here at all but many words\n" + CLEAN + "ends in a wide mark…\n«so does this one»"),
]


def expected(docs):
    out = []
    for doc_id, text in docs:
        text = text or ""
        w = blank_words(text)
        grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
        seen, dups, lost = set(), 0, 0
        for line in text.split("\n"):
            words = blank_words(line)
            n = len(words)
            if not n:
                continue
            fails = line in seen
            dups += line in seen
            seen.add(line)
            fails |= 2 * len(re.findall(r"[#*$%&|<>]", line)) > n
            fails |= 2 * line.count("!") > n and len(re.findall("[A-Z]", line)) > len(re.findall("[a-z]", line))
            fails |= line.count("|") >= 2 and 4 * line.count("|") >= n
            fails |= n >= 3 and words[-1][-1] not in rules.CLOSING
            lower = re.sub("[A-Z]", lambda m: m[0].lower(), line)
            fails |= n <= 30 and any(p in lower for p in rules.PHRASES)
            lost += n * fails
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        counts = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(again), lost)
        out.append((doc_id, *counts, failed, not failed and 100 * lost <= 50 * len(w)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    docs = documents() + MORE
    assert rows(rules.apply_rules(frame(spark, docs), kept_text=False)) == expected(docs)


def test_clean_text_leaves_failing_lines_out(spark):
    got = {r.doc_id: r for r in rules.apply_rules(frame(spark, MORE)).collect()}
    assert got[100].clean_text == CLEAN and got[100].kept
    assert got[101].clean_text == CLEAN
    assert not got[102].kept and not got[104].kept
    assert got[103].clean_text == CLEAN + "\n \n"
    assert got[106].clean_text == CLEAN + "ends in a wide mark…\n«so does this one»"


def test_empty_table(spark):
    assert rows(rules.apply_rules(frame(spark, []))) == []
