import hashlib
import random
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kindred.llm import classifier, rules
from tests.conftest import rows
from tests.llm import test_rules, test_substring
from tests.llm.test_jaccard import expected
from tests.llm.test_packing import check
from tests.llm.texts import blank_words, documents, frame, prose

# more columns than documents has, some of them named as the stages name theirs
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _key string, new_text string, first string, kept string, class_id string"


def test_jaccard_stage_equals_brute_force(spark):
    words = prose(random.Random(1), 120)
    docs = [(5, ""), (5, "a real text"), (5, " "), (5, None), (5, ""), (6, None), (6, "another one of its own")]
    docs += [(None, None), (None, "a text of the null id"), (None, ""), (None, "and one more of the null id")]
    docs += [(7, words), (8, words + " more"), (8, words + " more"), (9, words)]
    got = corpus_pipeline.jaccard_join(spark, frame(spark, docs), "")
    groups = {}
    for row, (doc_id, n, _, root) in zip(docs, expected(docs)):
        groups.setdefault(("words", root) if n else row, []).append(row)
    want = [min(g, key=lambda r: -1 if r[0] is None else r[0]) for g in groups.values()]
    assert rows(got.select("doc_id", "text")) == sorted(want, key=repr)


def full(spark, docs):
    made = [(i, t, "en", f"src{(i or 0) % 3}/p", -1, "mine", "key", "new", "1st", "k", "c") for i, t in docs]
    return spark.createDataFrame(made, SCHEMA).repartition(3)


def clean(rng, n):
    """Lines that no rule minds."""
    return "\n".join(f"Line {i} {prose(rng, 12)} ends here." for i in range(n))


def awkward():
    """Nulls, empty and repeated rows, and long texts that the rules keep and ones that they reject."""
    rng = random.Random(11)
    long = clean(rng, 900)
    docs = documents()[:30] + [(100, clean(rng, 5)), (101, clean(rng, 3) + "\nclick here to subscribe | home | about | more"), (102, long)]
    return docs + [docs[-3], (103, "Same line of words here.\n" * 40), (None, clean(rng, 4)), (104, "漢字 " * 30)]


def test_quality_rules_stage_equals_brute_force(spark):
    docs = awkward()
    got = corpus_pipeline.quality_rules(spark, full(spark, docs), "")
    kept = {r[0]: r[-1] for r in test_rules.expected(docs) if r[0] is not None}
    texts = {(r.doc_id, r.kept): r for r in rules.apply_rules(full(spark, docs)).collect()}
    assert got.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    result = got.collect()
    once = [i for i, n in Counter(i for i, _ in docs).items() if n == 1]
    assert {r.doc_id for r in result} & set(once) == {i for i in once if kept.get(i)}
    given = dict(docs)
    for r in result:
        assert (r["_id"], r["_key"], r.new_text, r.first, r.kept, r.class_id) == ("mine", "key", "new", "1st", "k", "c")
        if r.doc_id in once:
            judged = texts[r.doc_id, True]
            assert r.text == (judged.clean_text if judged.n_lost else given[r.doc_id])
            assert r.n_chars == (len(r.text) if judged.n_lost else -1)


def test_classifier_stage_keeps_what_the_operator_keeps(spark, tmp_path):
    docs = [(i, t) for i, t in awkward()]
    labels = spark.createDataFrame([(6, 1, 0), (7, 0, 0), (8, 1, 0), (100, 1, 0), (103, 0, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    table = full(spark, docs)
    got = corpus_pipeline.quality_classifier(spark, table, str(tmp_path))
    kept = Counter(r.doc_id for r in classifier.classify(table, labels).filter("kept").collect())
    assert got.columns == table.columns and Counter(r.doc_id for r in got.collect()) == kept
    assert {r["_id"] for r in got.collect()} <= {"mine"}


def test_substring_stage_equals_brute_force(spark):
    rng = random.Random(2)
    passage = prose(rng, 50)
    docs = [(i, f"{prose(rng, 20)}\n{passage} {prose(rng, 9)}") for i in range(5)] + [(9, passage), (10, None), (11, ""), (12, prose(rng, 3000))]
    docs += [(13, "only  one\tof its kind"), docs[0], (None, passage + " more")]
    got = corpus_pipeline.substring_dedup(spark, full(spark, docs), "")
    want = Counter()
    for (doc_id, n, gone, sha), (_, text) in zip(
        [test_substring.expected_row(docs, 35, i) for i in range(len(docs))], docs
    ):
        if n > gone:
            want[doc_id, sha if gone else hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in got.collect()) == want
    assert got.columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_packing_stage_packs_every_row(spark):
    docs = awkward() + [(500, " " * 50_000)]
    got = corpus_pipeline.best_fit_packing(spark, full(spark, docs), "").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for doc_id, text in docs:
        want[doc_id] += len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
    assert Counter({i: sum(r.length for r in got if r.doc_id == i) for i in want}) == want
    check([(r.length, r.sequence_id, r.offset) for r in got], 2048)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_of_an_empty_table(spark, tmp_path, stage):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert stage(spark, full(spark, []), str(tmp_path)).count() == 0


def test_run_is_its_stages_one_after_the_other(spark, tmp_path):
    docs = [(i, t) for i, t in awkward() if i != 102]
    frame(spark, docs).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(6, 1, 0), (7, 0, 0), (100, 1, 0), (103, 0, 1)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    step = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, step, str(tmp_path)).write.parquet(str(tmp_path / f"step{i}"))
        step = spark.read.parquet(str(tmp_path / f"step{i}"))
        assert step.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = corpus_pipeline.best_fit_packing(spark, step, "").select("doc_id", "piece", "start", "length", "ids_crc32")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert rows(got.select(*want.columns)) == rows(want) and got.count() > 0
    assert all(blank_words(r.text) for r in step.collect())
