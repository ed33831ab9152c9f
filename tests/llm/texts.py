"""Small documents with the awkward cases every operator meets, and helpers."""

import random
import re

WORDS = "the of and in to is was for on that it with as by at from or an be this née größe 漢字 señor a".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, n_words string"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "x", str(rng.randrange(40))]) for _ in range(n))


def documents(seed=1):
    """(doc_id, text) with nulls, blanks, repeated rows and ids, copies, shared passages and a long text."""
    rng = random.Random(seed)
    passage, other = prose(rng, 60), prose(rng, 45)
    rows = [(None, prose(rng, 50)), (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "a b c d")]
    for i in range(6, 30):
        rows.append((i, prose(rng, rng.randrange(1, 150))))
    for i in range(30, 50):  # a passage in the middle, sometimes twice, sometimes cut
        start, end = rng.randrange(20), rng.randrange(40, 60)
        words = passage.split()[start:end] if i % 3 else passage.split()
        rows.append((i, f"{prose(rng, rng.randrange(30))} {' '.join(words)}\n{prose(rng, 20)} {other if i % 4 == 0 else ''}"))
    rows.append((50, f"{passage} {passage}  {passage}"))
    rows.append((51, "Und " * 200))
    rows.append((52, "ab" * 300 + "é" * 120))
    rows.append((53, prose(rng, 4000)))
    rows += [(60, rows[20][1]), (61, rows[20][1]), (62, rows[53][1])]  # copies under other ids
    rows += [rows[25], rows[25], (7, prose(rng, 80)), (None, rows[0][1]), (None, None)]
    # two near copies
    words = rows[53][1].split()
    words[100] = "changed"
    rows.append((63, " ".join(words)))
    return rows


def frame(spark, rows):
    """The rows as a table with more columns, some of them named as operators name theirs."""
    full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), "x", "y") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def blank_words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")
