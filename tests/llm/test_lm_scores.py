import collections
import math

import numpy as np
import pytest
from compare import compare, duck

from alvara.llm import lm_scores

ROWS = [(0, "a b c a b c a b d"), (1, "a b c"), (2, None), (3, ""), (4, "z"), (5, "b c a b x y"), (None, "a b"), (1, "c a")]


def slow(rows, order, size):
    parts = [(d, (t or "").split()) for d, t in rows]
    count = collections.Counter(w for _, v in parts for w in v)
    known = {w for w, _ in sorted(count.items(), key=lambda x: (-x[1], x[0]))[:size]}
    parts = [(d, [w if w in known else "?" for w in v]) for d, v in parts]
    total = sum(len(v) for _, v in parts)
    grams = collections.Counter(
        tuple(v[k:k + n]) for _, v in parts for n in range(1, order + 1) for k in range(len(v) - n + 1))

    def log(g):
        if len(g) == 1:
            return math.log(grams[g] / total)
        return math.log(grams[g] / grams[g[:-1]]) if grams[g] >= 2 else math.log(0.4) + log(g[1:])

    out = collections.defaultdict(lambda: [0, 0.0])
    for d, v in parts:
        out[d][0] += len(v)
        out[d][1] += sum(log(tuple(v[max(0, k - order + 1):k + 1])) for k in range(len(v)))
    return out


@pytest.mark.parametrize("order, size", [(2, 4), (3, 4), (3, 100), (2, 1)])
def test_equals_the_recursion(spark, order, size):
    docs = spark.createDataFrame([(*r, 1) for r in ROWS], "doc_id long, text string, gram int")
    got = {r.doc_id: r for r in lm_scores.score(docs, order, 2, 0.4, size).collect()}
    expected = slow(ROWS, order, size)
    assert set(got) == set(expected)
    for d, (n, total) in expected.items():
        assert got[d].n_words == n and abs(got[d].log_score / 1e6 - total) < 1e-5 * max(1, n)
        assert (got[d].per_word is None) == (n == 0)


def test_empty_table_and_parameters(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lm_scores.score(docs).collect() == []
    with pytest.raises(ValueError):
        lm_scores.score(docs, order=4)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(lm_scores.op3_lm_scores(spark, folder), duck(folder), lm_scores.OP3_SQL) is None


@pytest.mark.parametrize("order", [2, 3])
def test_no_word_is_unknown(spark, order):
    # more words than 16 bits could number; rare ones must keep their own counts
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(700))) for k in range(100)]
    rows += [(200, "w99x699 w99x699 w99x699"), (201, "w99x698 w3x1"), (202, "w99x698 w3x1 w99x699")]
    got = {r.doc_id: r for r in lm_scores.score(spark.createDataFrame(rows, "doc_id long, text string"), order, 2).collect()}
    for d, (n, total) in slow(rows, order, 10 ** 9).items():
        assert got[d].n_words == n and abs(got[d].log_score / 1e6 - total) < 1e-5 * n


def test_keys_are_those_of_spark(spark):
    some = np.random.default_rng(1).integers(-2**63, 2**63, 100)
    rows = spark.createDataFrame([(int(x),) for x in some], "x long").selectExpr("x", "xxhash64(x) h").collect()
    assert [r.h for r in rows] == lm_scores.mixed(np.array([r.x for r in rows]).view(np.uint64)).view(np.int64).tolist()


@pytest.mark.parametrize("order", [2, 3])
def test_what_was_seen_once_counts(spark, order):
    rows = [(0, "a b c"), (1, "a d c b"), (2, "e"), (3, None)]
    parts = [(d, (t or "").split()) for d, t in rows]
    grams = collections.Counter(
        tuple(v[k:k + n]) for _, v in parts for n in range(1, order + 1) for k in range(len(v) - n + 1))
    got = {r.doc_id: r for r in lm_scores.score(spark.createDataFrame(rows, "doc_id long, text string"), order).collect()}
    for d, v in parts:
        # nothing backs off: every n-gram of the corpus was seen
        total = 0.0
        for k in range(len(v)):
            gram = tuple(v[max(0, k - order + 1):k + 1])
            total += math.log(grams[gram] / (grams[gram[:-1]] if len(gram) > 1 else 8))
        assert got[d].n_words == len(v) and abs(got[d].log_score / 1e6 - total) < 1e-5


def test_counts_are_those_of_all_blocks_and_ranges(spark, monkeypatch):
    """Many small blocks and ranges of keys; texts longer than a block, without words, with null ids."""
    import random

    rng = random.Random(5)
    rows = [(k % 40, " ".join(rng.choices("a b c d e f g h".split(), k=rng.randrange(0, 30)))) for k in range(120)]
    rows += [(50, None), (51, " \t"), (None, "a b a"), (None, None), (52, "a b " * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for order in (2, 3):
        expected = sorted(map(tuple, lm_scores.score(docs, order, 2).collect()), key=str)
        assert {r[0]: r[1] for r in expected} == {d: n for d, (n, _) in slow(rows, order, 99).items()}
        with monkeypatch.context() as patch:
            patch.setattr(lm_scores, "BLOCK", 25)
            patch.setattr(lm_scores, "RANGE", 40)
            assert sorted(map(tuple, lm_scores.score(docs, order, 2).collect()), key=str) == expected


def test_packed_numbers():
    for kind in (np.int32, np.uint32, np.int64, np.uint64):
        some = np.random.default_rng(2).integers(0, 2**31, 99).astype(kind)
        assert lm_scores.unpacked(lm_scores.packed(some), kind).tolist() == some.tolist()
        assert len(lm_scores.unpacked(lm_scores.packed(some[:0]), kind)) == 0


def test_little_is_shuffled(spark, tmp_path):
    """An n-gram of a block goes to its range once and its sum comes back: a few bytes each."""
    from alvara.session import shared_dir

    rows = [(k, " ".join(f"w{(k * j * 7919) % 60_000}" for j in range(1_500))) for k in range(120)]
    before = set(__import__("os").listdir(shared_dir(spark)))
    lm_scores.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    written = [f for f in (__import__("pathlib").Path(shared_dir(spark))).iterdir() if f.name not in before]
    held = sum(f.stat().st_size for d in written for f in d.rglob("*.parquet"))
    # some 6 bytes for each of 180 000 positions; tables of n-grams took more than 30
    assert held < 15 * 180_000
