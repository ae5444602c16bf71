import random
import re
import zlib
from collections import Counter

import pytest
from compare import compare, duck

from alvara.llm import spelling as sp


def slow_words(rows):
    seen = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow(rows):
    seen = slow_words(rows)
    others = {w: [x for x in seen if near(w, x)] for w in seen}
    form = {}
    for w, n in seen.items():
        top = min(others[w], key=lambda x: (-seen[x], x), default=None)
        form[w] = top if top and seen[top] >= 10 * n else None
    out = []
    for w in seen:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, seen[w], len(others[w]), seen.get(form[w])))
    return sorted(out, key=str)


def made(seed, alphabet, words=80):
    rng = random.Random(seed)
    texts = []
    for _ in range(words):
        word = "".join(rng.choice(alphabet) for _ in range(rng.randint(7, 10)))
        texts += [word] * rng.choice([2, 3, 30, 400])
        for _ in range(4):
            i = rng.randrange(len(word) + 1)
            other = rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice(alphabet) + word[i:],
                                word[:i] + rng.choice(alphabet) + word[i + 1:]])
            texts += [other.capitalize()] * rng.choice([1, 2, 3, 40])
    rng.shuffle(texts)
    return [(k, " ".join(texts[k::50])) for k in range(50)]


@pytest.mark.parametrize("alphabet", ["ab", "abcdefgh", "abcdeéÿ×"])
def test_against_brute_force(spark, alphabet):
    rows = made(len(alphabet), alphabet)
    got = sp.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == slow(rows)


def test_pivots_are_the_cheapest_disjoint_pair():
    rng = random.Random(3)
    for _ in range(300):
        ranks = [rng.randrange(12) for _ in range(rng.randint(6, 12))]
        costs = [r // 2 for r in ranks]
        prefix, pair, reach = sp.pivotal(costs, ranks)
        first = sorted(range(len(ranks)), key=lambda i: (ranks[i], i))[:3]
        assert reach == ranks[first[2]] and set(first) <= set(prefix) and len(prefix) <= 7
        pairs = [(i, j) for i in first for j in first if j - i >= 2]
        assert pair in pairs and sum(costs[i] for i in pair) == min(costs[i] + costs[j] for i, j in pairs)


def test_odd_rows(spark):
    odd = [(1, None), (2, ""), (None, "Wonderful wonderful WONDERFUL"), (3, "wonderfully " * 5), (3, "wonderfully " * 5),
           (4, "x" * 50_000 + " " + "x" * 50_000), (5, "\U0001F600wonderfulÉ wonderfulé")]
    frame = spark.createDataFrame(
        [(*r, 1, "w") for r in odd], "doc_id long, text string, n int, word string")
    got = sorted((tuple(r) for r in sp.spelling_variants(frame).collect()), key=str)
    assert got == slow(odd) and got
    assert sp.spelling_variants(frame.limit(0)).count() == 0


def test_query_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(sp.op13_spelling_variants(spark, folder), duck(folder), sp.OP13_SQL) is None
