"""Removal of byte strings that occur more than once in a corpus.

A position is repeated if the 200 bytes from it on also start elsewhere; bytes covered
by such strings go. As in a difference-cover suffix sort, only a sample of positions is
sorted, names of triples of names stand for longer and longer prefixes, the remaining
positions are settled with the names of the sample, and what is adjacent is compared:

* Names. The name of 8 bytes is their value. A triple of names is named by a digest, so
  three steps lead from 8 to 24, 72 and 200 bytes, for all positions of a text at once.
* Sample. Of each window of 200 bytes the leftmost of the 100-byte strings with the
  least name is sampled. Equal windows sample the same string at the same place, which
  is what a difference cover is for; about one position in fifty is sampled. A run of
  windows that share a sampled position, with the bytes that they cover, is its context.
* Sort. Sampled names are brought together over the corpus; one that occurs once belongs
  to no repeated string. If an equal name has an equal context elsewhere, all windows of
  both are repeated.
* Remaining. A context that occurs once under a name with several contexts lies at the
  border of a repeated passage. It is shipped once, as its bytes, with one example of
  every other context of that name; tasks sort the windows of whole names and compare
  adjacent ones byte by byte. Those found twice are repeated.

Names are digests instead of ranks: no name has to be numbered over the whole corpus, so
the recursion needs no shuffle (README has the figures that ask for this). They only say
what is compared. Windows of borders are equal if their 200 bytes are; contexts, if 128
bits of a digest of all their bytes are, and so are windows of names with more than
``GROUP`` contexts, which are too many for one task and are counted by a shuffle.

Equal texts are folded first. Nothing is gathered but the marks of one text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, tidy

LENGTH = 200
SAMPLE = 100
#: Bytes of a text that are worked on at once.
PIECE = 1 << 21
#: Bits of the map that spares names that occur once the shuffle: 8 MB, whatever the input.
BITS = 1 << 26
#: Contexts of one name that a task takes at most (of up to 300 bytes each).
GROUP = 20_000
#: Bytes of whole names that a task sorts at once, but for a larger name.
CHUNK = 1 << 20
#: Windows compared byte by byte at once.
COMPARED = 1 << 14

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)]
_32, _29 = np.uint64(32), np.uint64(29)
_PLACE = np.uint64((1 << 24) - 1)


def named(a: np.ndarray, b: np.ndarray, c: np.ndarray | np.uint64) -> np.ndarray:
    """The name of triples of names."""
    h = a * _C[0]
    h ^= h >> _32
    h += b
    h *= _C[1]
    h ^= h >> _29
    h += c
    h *= _C[2]
    h ^= h >> _32
    return h


def prefixes(data: np.ndarray) -> np.ndarray:
    """Names of the 72 bytes from every position on."""
    n = len(data)
    word = np.zeros(n - 7, np.uint64)
    for k in range(8):
        word |= data[k:n - 7 + k].astype(np.uint64) << np.uint64(8 * k)
    name = named(word[:-16], word[8:-8], word[16:])
    return named(name[:-48], name[24:-24], name[48:])


def windows(name: np.ndarray) -> np.ndarray:
    """Names of the 200 bytes from every position on."""
    return named(name[:-128], name[72:-56], name[128:])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(x)
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = x
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def sampled(name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the sampled strings, and the first and last window that share each."""
    own = named(name[:-28], name[28:], _C[3])  # of 100 bytes
    key = (own & ~_PLACE) | np.arange(len(own), dtype=np.uint64)
    at = _least(key, LENGTH - SAMPLE + 1) & _PLACE
    cut = np.nonzero(at[1:] != at[:-1])[0]
    first = np.concatenate([[0], cut + 1])
    last = np.concatenate([cut, [len(at) - 1]])
    return own[at[first].astype(np.int64)], first, last


def pieces(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """The text in overlapping pieces; every window is in exactly one."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data) - LENGTH + 1, PIECE):
        yield at, data[at:at + PIECE + LENGTH - 1]


def _sample_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sampled(prefixes(d))[0] for t in batch.column("data") for _, d in pieces(t.as_py())]
        names = np.concatenate(found) if found else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64))], ["h"])


def marked(names: DataFrame) -> np.ndarray:
    """A bit map of ``BITS`` bits, as words, with the bits of all names ``h`` set.

    Its size is fixed. With more names than bits it lets all names pass, and the exact
    join behind it does all the work.
    """
    word = F.shiftright(F.col("h").bitwiseAND(F.lit(BITS - 1)), 6)
    bit = F.expr("shiftleft(1L, cast(h & 63 as int))")
    found = names.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(BITS // 64, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _contexts(names):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = names.value
        for batch in batches:
            h, c, row, lo, hi = [], [], [], [], []
            for k, text in enumerate(batch.column("data")):
                for at, data in pieces(text.as_py()):
                    own, first, last = sampled(prefixes(data))
                    place = own & np.uint64(BITS - 1)
                    some = (bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
                    own, first, last = own[some], first[some], last[some]
                    if not len(own):
                        continue
                    view = memoryview(data)
                    digests = b"".join(
                        xxhash.xxh3_128_digest(view[x:y + LENGTH]) for x, y in zip(first.tolist(), last.tolist()))
                    h.append(own)
                    c.append(np.frombuffer(digests, np.int64).reshape(-1, 2))
                    row.append(np.full(len(own), k))
                    lo.append(at + first)
                    hi.append(at + last)
            if h:
                row, c = pa.array(np.concatenate(row)), np.concatenate(c)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(h).view(np.int64)), pa.array(c[:, 0].copy()), pa.array(c[:, 1].copy()),
                    batch.column("t1").take(row), batch.column("t2").take(row),
                    pa.array(np.concatenate(lo).astype(np.int32)), pa.array(np.concatenate(hi).astype(np.int32))],
                    ["h", "c1", "c2", "t1", "t2", "lo", "hi"])
    return run


def _context_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The listed contexts (h, k, lo, hi, n) of each text, with their bytes."""
    names = ["h", "k", "n", "t1", "t2", "lo", "data"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    for batch in batches:
        rows = []
        for t1, t2, text, listed in zip(*(batch.column(x) for x in ("t1", "t2", "data", "listed"))):
            t1, t2, text = t1.as_py(), t2.as_py(), text.as_py()
            rows += [(x["h"], x["k"], x["n"], t1, t2, x["lo"], text[x["lo"]:x["hi"] + LENGTH]) for x in listed.as_py()]
        for at in range(0, len(rows), 10_000):
            columns = zip(*rows[at:at + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def found_twice(data: np.ndarray, at: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Which of the windows that start at ``at`` have bytes found more than once, each counted ``times``."""
    name = windows(prefixes(data))[at]
    order = np.argsort(name, kind="stable")
    view = np.lib.stride_tricks.sliding_window_view(data, LENGTH)

    def equal() -> np.ndarray:
        """Whether each window in order has the bytes of the one before."""
        out = np.zeros(len(order), bool)
        ask = 1 + np.nonzero(name[order[1:]] == name[order[:-1]])[0]
        for k in range(0, len(ask), COMPARED):
            some = ask[k:k + COMPARED]
            out[some] = (view[at[order[some]]] == view[at[order[some - 1]]]).all(axis=1)
        return out

    same = equal()
    run = np.concatenate([[0], np.cumsum(name[order[1:]] != name[order[:-1]])])
    mixed = np.unique(run[1:][~same[1:] & (run[1:] == run[:-1])])
    for r in mixed:  # a name of unlike windows: their bytes give the order
        where = np.nonzero(run == r)[0]
        order[where] = sorted(order[where], key=lambda x: view[at[x]].tobytes())
    if len(mixed):
        same = equal()
    group = np.cumsum(~same) - 1
    out = np.zeros(len(at), bool)
    out[order] = (np.bincount(group, times[order]) > 1)[group]
    return out


def _ranges(rows: pa.Table) -> pa.RecordBatch:
    """(t1, t2, lo, hi): ranges of repeated windows of contexts that occur once, from all contexts of some names."""
    rows = rows.combine_chunks()
    n, lo = rows.column("n").to_numpy(), rows.column("lo").to_numpy()
    texts = rows.column("data").chunk(0)
    edges = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[edges[0]:edges[-1]]
    edges = edges - edges[0]
    many = np.diff(edges) - LENGTH + 1
    owner = np.repeat(np.arange(len(n)), many)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    twice = found_twice(data, edges[owner] + inside, n[owner]) & (n[owner] == 1)
    owner, at = owner[twice], (lo[owner] + inside)[twice]
    cut = np.nonzero((owner[1:] != owner[:-1]) | (at[1:] != at[:-1] + 1))[0]
    first, last = np.concatenate([[0], cut + 1]), np.concatenate([cut, [len(at) - 1]])
    if not len(at):
        first = last = np.zeros(0, np.int64)
    whose = pa.array(owner[first])
    return pa.RecordBatch.from_arrays(
        [*(rows.column(t).chunk(0).take(whose) for t in ("t1", "t2")),
         pa.array(at[first].astype(np.int32)), pa.array(at[last].astype(np.int32))], ["t1", "t2", "lo", "hi"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of repeated windows, from contexts in the order of their names."""
    left = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        left = rows if left is None else pa.concat_tables([left, rows])
        if left.nbytes < CHUNK:
            continue
        h = left.column("h").to_numpy()
        ends = np.nonzero(h[1:] != h[:-1])[0]
        if len(ends):  # the last name may go on in the next batch
            yield _ranges(left.slice(0, ends[-1] + 1))
            left = left.slice(ends[-1] + 1)
    if left is not None and left.num_rows:
        yield _ranges(left)


def _counted(border: DataFrame) -> DataFrame:
    """What ``_settle`` gives, window by window, by counts of their digests: names of any number of contexts."""
    windows_ = border.select(
        "n", "t1", "t2", "lo", "data", F.explode(F.expr(f"sequence(0, length(data) - {LENGTH})")).alias("i")).select(
        "n", "t1", "t2", (F.col("lo") + F.col("i")).alias("lo"),
        F.unhex(F.md5(F.expr(f"substring(data, i + 1, {LENGTH})"))).alias("w"))
    twice = windows_.groupBy("w").agg(F.sum("n").alias("n")).where("n > 1").select("w")
    return windows_.where("n = 1").join(twice, "w", "left_semi").select("t1", "t2", "lo", F.col("lo").alias("hi"))


def covered(size: int, marks: list[dict] | None, whole: bool) -> list[tuple[int, int]]:
    """Maximal removed runs of a text, from ranges of repeated windows."""
    if whole:
        return [(0, size)] if size >= LENGTH else []
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((m["lo"], m["hi"] + LENGTH) for m in marks or []):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            rows = []
            for text, whole, marks in zip(part.column("data"), part.column("whole"), part.column("marks")):
                text = text.as_py()
                runs = covered(len(text), marks.as_py(), bool(whole.as_py()))
                edges = [0, *(x for run in runs for x in run), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                rows.append((len(text), len(text) - len(kept), len(runs), kept))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.binary()]))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row of ``docs`` (doc_id, text).

    ``kept``: the bytes of the text that no repeated string covers. A null text is empty;
    texts of less than ``LENGTH`` bytes lose nothing. Repeated rows are texts of their
    own, so each is the other's copy; null ids do no harm; further columns are ignored;
    an empty table gives an empty result.
    """
    rows = tidy(docs, doc_id="long", text="string").select(
        "doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))
    digest = F.md5("data")
    rows = rows.select(
        "doc_id", "data", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("t1"),
        F.conv(F.substring(digest, 18, 15), 16, 10).cast("long").alias("t2"))
    long = rows.where(F.length("data") >= LENGTH)
    copies = materialise(long.groupBy("t1", "t2").count().where("count > 1").select("t1", "t2"), "copies")
    key = ["t1", "t2"]
    # written once, for three passes; copies are folded before the one shuffle it takes
    texts = materialise(long.dropDuplicates(key).select(*key, "data"), "texts")

    often = materialise(
        texts.mapInArrow(_sample_names, "h long").groupBy("h").count().where("count > 1").select("h"), "often")
    bits = docs.sparkSession.sparkContext.broadcast(marked(often))
    seen = materialise(texts.mapInArrow(
        _contexts(bits), "h long, c1 long, c2 long, t1 long, t2 long, lo int, hi int").join(often, "h", "left_semi"), "seen")
    context = ["h", "c1", "c2"]
    contexts = materialise(seen.groupBy(*context).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("t1", "t2", "lo", "hi")).alias("at")), "contexts")
    several = contexts.groupBy("h").agg(
        F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).where("k > 1 and least = 1").select("h", "k")
    listed = contexts.join(several, "h").groupBy(F.col("at.t1").alias("t1"), F.col("at.t2").alias("t2")).agg(
        F.collect_list(F.struct("h", "k", "at.lo", "at.hi", F.least("n", F.lit(2)).cast("int").alias("n"))).alias("listed"))
    border = materialise(texts.join(listed, key).mapInArrow(
        _context_bytes, "h long, k long, n int, t1 long, t2 long, lo int, data binary"), "border")
    settled = border.where(F.col("k") <= GROUP).select("h", "n", *key, "lo", "data").repartition("h").sortWithinPartitions(
        "h").mapInArrow(_settle, "t1 long, t2 long, lo int, hi int")
    marks = seen.join(contexts.where("n > 1").select(*context), context, "left_semi").select(*key, "lo", "hi").unionByName(
        settled).unionByName(_counted(border.where(F.col("k") > GROUP)))
    marks = marks.groupBy(*key).agg(F.collect_list(F.struct("lo", "hi")).alias("marks"), F.lit(False).alias("whole"))
    marks = marks.join(copies, key, "left_anti").unionByName(copies.select(
        *key, F.lit(None).cast("array<struct<lo:int,hi:int>>").alias("marks"), F.lit(True).alias("whole")))
    marks = materialise(marks, "marks")
    return rows.join(marks, key, "left").select("doc_id", "data", "whole", "marks").mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
