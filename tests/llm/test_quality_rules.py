import collections
import random
import re

import duckdb

from alvara.llm import quality_rules as Q

FOLDER = "/root/testdata/sf0.001"


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    count = collections.Counter(windows)
    repeated = {k for i, w in enumerate(windows) if count[w] > 1 for k in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


def base_fails(counts):
    return counts[0] < 10 or 100 * counts[4] > 20 * counts[0]


def test_query_equals_brute_force(spark):
    docs = dict(duckdb.execute(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall())
    rows = Q.op6_quality_rules(spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        counts = slow(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == base_fails(counts) and not (r.base_failed and r.kept)


def corpus():
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(600):
        words = ["".join(rng.choices("abcdefg", k=rng.randint(2, 8))) for _ in range(rng.randint(20, 80))]
        bad = k % 4 == 0
        if bad and k % 8 == 0:
            words = [w + "###" for w in words]
        elif bad:
            words = [w.upper() + "!!" for w in words]
        rows.append((k, " ".join(words)))
        labels.append((k, 0 if bad else 1))
    return rows, labels


def test_rules_are_learned_and_generalise(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_words string")
    known = spark.createDataFrame([x for x in labels if x[0] < 400], "doc_id long, quality int")
    judged = {r.doc_id: r.kept for r in Q.judge(docs, known).collect()}
    held = [(judged[d], q) for d, q in labels if d >= 400]
    assert sum(k == bool(q) for k, q in held) >= 0.95 * len(held)
    kept = Q.accepted(docs, known)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, k in judged.items() if k}


def test_edge_rows(spark):
    texts = [None, "", " \n\t", "a", "w " * 30_000, "one two three four five six seven eight nine ten",
             "a b c d e a b c d e x y z", "l\nl\n\n\nl m\n", "é" * 5 + " ü" * 9, "  " * 12]
    rows = [(k, t, "s") for k, t in enumerate(texts)] + [(None, "a b", "s"), (5, texts[5], "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base_failed string")
    none = spark.createDataFrame([(1, None), (None, 1), (5, 1), (5, 7)], "doc_id long, quality int")
    got = Q.judge(docs, none).collect()
    assert len(got) == len(rows)
    for r in got:
        counts = slow("a b" if r.doc_id is None else texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == base_fails(counts) and r.kept == (not r.base_failed)
    assert Q.judge(docs.where("false"), none).count() == 0
    assert Q.accepted(docs, none).columns == docs.columns


def test_best_test_by_hand():
    counts = {(0, 0): [0, 6], (0, 1): [4, 0]}
    assert Q._best(counts, [[0.5]])[1:] == ((0, True, 0), (4, 0))
