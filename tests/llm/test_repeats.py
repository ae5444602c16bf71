import collections
import random

import duckdb
import pytest

from alvara.llm import repeats

FOLDER = "/root/testdata/sf0.001"


def slow(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    count = collections.Counter(b[i:i + 200] for _, b in texts for i in range(len(b) - 199))
    out = []
    for d, b in texts:
        gone = [False] * len(b)
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                gone[i:i + 200] = [True] * 200
        spans = sum(g and not before for g, before in zip(gone, [False, *gone]))
        out.append((d, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def texts():
    r = random.Random(1)

    def words(n):
        return " ".join("".join(r.choice("abcdé") for _ in range(r.randint(1, 7))) for _ in range(n))

    shared = [words(60) for _ in range(5)]
    rows = [(i, words(r.randint(0, 80)) + r.choice(shared)[r.randint(0, 60):] + words(r.randint(0, 30))
             + (r.choice(shared) if i % 3 == 0 else "")) for i in range(40)]
    x = words(300)
    return rows + [
        (100, x), (101, x[:400] + "#" + x[400:]), (102, x[:400] + "%" + x[401:]), (103, x), (104, None), (105, ""),
        (106, "a" * 1000), (107, "ab" * 300), (108, "z" * 199), (109, "q" * 200), (110, "q" * 200),
        (111, words(200) * 3), (None, words(50)), (3, rows[3][1]), (None, words(50)), (112, "r" * 200 + "s")]


@pytest.mark.parametrize("group", [repeats.GROUP, 2, 0])
def test_equals_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    rows = texts()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, h int")
    assert sorted((tuple(r[:4]) + (bytes(r[4]),) for r in repeats.remove_repeats(docs).collect()), key=str) == slow(rows)


def test_pieces_and_chunks_change_nothing(monkeypatch):
    import numpy as np
    import pyarrow as pa

    data = random.Random(4).randbytes(5_000)

    def strings():
        return [(at + int(x), at + int(y)) for at, d in repeats.pieces(data)
                for x, y in zip(*repeats.sampled(repeats.prefixes(d))[1:])]

    whole = strings()
    monkeypatch.setattr(repeats, "PIECE", 333)
    cut = strings()
    assert len(cut) > len(whole)
    for listed in (whole, cut):  # every window is in exactly one context
        assert [i for lo, hi in listed for i in range(lo, hi + 1)] == list(range(len(data) - 199))

    r = random.Random(5)
    rows = []
    for h in range(40):
        base = r.randbytes(290)
        for k in range(r.randint(2, 9)):
            lo = r.randint(0, 60)
            rows.append((h, r.choice([1, 1, 1, 2]), h, k, lo, base[lo:r.randint(lo + 200, 290)] + (r.randbytes(3) if k % 2 else b"")))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["h", "n", "t1", "t2", "lo", "data"])
    times = collections.Counter()
    for h, n, _, _, _, d in rows:
        for i in range(len(d) - 199):
            times[h, d[i:i + 200]] += n
    expected = sorted((t1, t2, lo + i) for h, n, t1, t2, lo, d in rows if n == 1
                      for i in range(len(d) - 199) if times[h, d[i:i + 200]] > 1)
    for chunk, size in ((repeats.CHUNK, 1_000), (1, 1_000), (1, 7), (1, 1)):
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        found = [x for b in repeats._settle(iter(table.to_batches(size))) for x in zip(*(c.to_pylist() for c in b.columns))]
        assert sorted((t1, t2, i) for t1, t2, lo, hi in found for i in range(lo, hi + 1)) == expected
        assert np.all([lo <= hi for _, _, lo, hi in found])


def test_windows_of_one_name_are_compared_by_their_bytes(monkeypatch):
    import numpy as np

    data = np.frombuffer(random.Random(3).randbytes(900) * 2 + b"x" * 250, np.uint8)
    at = np.arange(len(data) - 199)
    found = [bytes(data[i:i + 200]) for i in at]
    for name in (repeats.windows, lambda x: x[:-128] & np.uint64(1)):  # the second: two names for all windows
        monkeypatch.setattr(repeats, "windows", name)
        got = repeats.found_twice(data, at, np.ones(len(at), np.int64))
        assert got.tolist() == [found.count(x) > 1 for x in found]
    assert repeats.found_twice(data, at[:5], np.array([1, 2, 1, 2, 1])).tolist() == [False, True, False, True, False]


def test_empty_table(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    import hashlib

    rows = duckdb.execute(f"select doc_id, text from '{FOLDER}/documents.parquet'").fetchall()
    expected = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in slow(rows)]
    assert sorted(map(tuple, repeats.op4_suffix_dedup(spark, FOLDER).collect()), key=str) == sorted(expected, key=str)
