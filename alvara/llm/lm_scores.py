"""Language-model scores by stupid backoff, computed with joins.

All words and all n-grams are counted, without a vocabulary. The key of a word is the
64-bit hash of its bytes, that of a longer n-gram the hash of its prefix's key, exclusive-or
the key of its last word. Two n-grams share a key with probability 2^-64; their counts are
then one.

S_1(w) = c(w) / N and S_k = c_k / c_(k-1)(prefix) where the n-gram was seen ``least``
times (by default: once), else ``BACKOFF`` * S_(k-1)(suffix). Texts lie in blocks of about
``BLOCK`` words, written once, with the words of a block numbered. A block sends each of its
n-grams once, sorted by key and cut into ranges of keys; the blocks' counts of a range are added
up in one group, and each block gets the sums back in the order in which it sent the keys, so
without them. Then it has the counts of all its n-grams, of their prefixes and suffixes, and every
position of a text counts with the longest n-gram that ends there. Terms are whole millionths, so
sums don't depend on order.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, tidy

ORDER = 2
LEAST = 1
BACKOFF = 0.4
UNIT = 1_000_000
#: Words of a block, of one text at least, and of a range of keys on average.
BLOCK, RANGE = 600_000, 3_000_000
#: Blocks of an Arrow batch, some MB each, and where Spark is told.
BLOCK_ROWS, ARROW_CONF = 2, "spark.sql.execution.arrow.maxRecordsPerBatch"


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for text in batch.column(0):
            counts.update((text.as_py() or "").encode().split())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, size: int) -> set[bytes]:
    """The ``size`` most frequent words (ties by bytes)."""
    counts = materialise(
        docs.select("text").mapInArrow(_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    # Every task would send its own ``size`` best to the driver; so the words are first cut
    # to the counts, by powers of two, that can be among them.
    level = F.floor(F.log2("n")).cast("int")
    held = {r["level"]: r["count"] for r in counts.groupBy(level.alias("level")).count().collect()}
    above, least = 0, 0
    for least in sorted(held, reverse=True):
        above += held[least]
        if above >= size:
            break
    return {bytes(r["word"]) for r in counts.where(level >= least).orderBy(F.desc("n"), "word").limit(size).collect()}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of unsigned 64-bit numbers."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(v: np.ndarray, bits: int) -> np.ndarray:
        return (v << np.uint64(bits)) | (v >> np.uint64(64 - bits))

    h = turned((p5 + np.uint64(42 + 8)) ^ (turned(x * p2, 31) * p1), 27) * p1 + p4
    h = (h ^ (h >> np.uint64(33))) * p2
    h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def packed(numbers: np.ndarray) -> bytes:
    """All highest bytes, then all second ones and so on: sorted or small numbers become runs."""
    return numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize)[:, ::-1].T.tobytes()


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1)[::-1].T).view(kind).ravel()


def _blocks(known, most: int):
    """Texts in blocks: the keys of the block's words, and its texts in numbers of these."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        numbers: defaultdict = defaultdict()
        numbers.default_factory = numbers.__len__
        context, made, held = TaskContext.get(), 0, 0
        docs, texts = [], []

        def block() -> pa.RecordBatch:
            digest = xxhash.xxh3_64_intdigest
            keys = np.fromiter(
                (digest(w) if known is None or w in known.value else 0 for w in numbers), np.uint64, len(numbers))
            sizes = np.array([len(t) for t in texts], np.int32)
            row = pa.RecordBatch.from_arrays(
                [pa.array([context.partitionId() << 32 | made], pa.int64()), pa.array([held], pa.int64()),
                 pa.array([docs], pa.list_(pa.int64())), pa.array([packed(sizes)], pa.binary()),
                 pa.array([packed(keys)], pa.binary()), pa.array([packed(np.concatenate(texts))], pa.binary())],
                ["block", "words", "docs", "sizes", "keys", "texts"])
            numbers.clear()
            docs.clear()
            texts.clear()
            return row

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                split = (text.as_py() or "").encode().split()
                if docs and (held + len(split) > most or len(docs) >= most):
                    yield block()
                    made, held = made + 1, 0
                docs.append(doc)
                texts.append(np.fromiter(map(numbers.__getitem__, split), np.int32, len(split)))
                held += len(split)
        if docs:
            yield block()
    return run


def _grams(sizes: np.ndarray, keys: np.ndarray, texts: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each k the keys of the k-grams of a block's texts, and the places of their last words."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    word = gram = keys[texts]
    out = [(gram, np.arange(len(gram)))]
    for k in range(2, order + 1):
        gram = mixed(gram[:-1]) ^ word[k - 1:]
        inside = doc[k - 1:] == doc[:len(gram)]
        out.append((gram[inside], np.flatnonzero(inside) + k - 1))
    return out


def _numbers(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return unpacked(row["sizes"], np.int32), unpacked(row["keys"], np.uint64), unpacked(row["texts"], np.int32)


def _sent(order: int, ranges: int):
    """(range, block, keys, counts): the distinct n-grams of each block, sorted, by range of keys."""
    starts = np.array([(k << 64) // ranges for k in range(1, ranges)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                row = batch.slice(row, 1).to_pylist()[0]
                some, often = np.unique(
                    np.concatenate([g for g, _ in _grams(*_numbers(row), order)]), return_counts=True)
                cuts = [0, *np.searchsorted(some, starts).tolist(), len(some)]
                parts = [(k, a, b) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
                often = often.astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _, _ in parts], pa.int32()), pa.array([row["block"]] * len(parts), pa.int64()),
                     pa.array([packed(some[a:b]) for _, a, b in parts], pa.binary()),
                     pa.array([packed(often[a:b]) for _, a, b in parts], pa.binary())],
                    ["range", "block", "keys", "counts"])
    return run


def _summed(key: tuple, rows: pa.Table) -> pa.Table:
    """The sums over all blocks of a range of keys, for each block in the order of its keys."""
    keys = [unpacked(k.as_py(), np.uint64) for k in rows.column("keys")]
    counts = np.concatenate([unpacked(c.as_py(), np.uint32) for c in rows.column("counts")])
    some, place = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros(len(some), np.int64)
    np.add.at(sums, place, counts)
    sums = np.split(sums[place], np.cumsum([len(k) for k in keys])[:-1])
    return pa.table({
        "range": pa.array([key[0].as_py()] * len(keys), pa.int32()), "block": rows.column("block"),
        "sums": pa.array([packed(s) for s in sums], pa.binary())})


def _rounded(x: np.ndarray) -> np.ndarray:
    return np.trunc(x * UNIT + np.copysign(0.5, x)).astype(np.int64)


def _scored(total: int, order: int, least: int, backoff: float):
    """(doc_id, n_words, own) of a block's texts, from the sums of its n-grams."""
    step = round(math.log(backoff) * UNIT)

    def run(blocks: pa.Table, sums: pa.Table) -> pa.Table:
        docs, n, own = [], [], []
        for row in blocks.to_pylist():
            parts = sorted(zip(sums.column("range").to_pylist(), sums.column("sums").to_pylist()))
            found = np.concatenate([np.zeros(0, np.int64), *(unpacked(p, np.int64) for _, p in parts)])
            sizes, keys, texts = _numbers(row)
            grams = _grams(sizes, keys, texts, order)
            place = np.unique(np.concatenate([g for g, _ in grams]), return_inverse=True)[1]
            counts, at = [np.full(len(texts), total, np.int64)], 0  # counts[k]: of the k-gram that ends at a place
            for gram, ends in grams:
                counts.append(np.zeros(len(texts), np.int64))
                counts[-1][ends] = found[place[at:at + len(gram)]]
                at += len(gram)
            logs = _rounded(np.log(counts[1] / total))
            for k in range(2, order + 1):
                ends = grams[k - 1][1]
                seen, suffix = counts[k][ends], counts[k - 1][ends]
                prefix, middle = counts[k - 1][ends - 1], counts[k - 2][ends - 1]
                gain = np.log(seen / prefix) - np.log(suffix / middle) - math.log(backoff)
                logs[ends] += step + np.where(seen >= least, _rounded(gain), 0)
            upto = np.concatenate([[0], np.cumsum(logs)])
            ends = np.cumsum(sizes, dtype=np.int64)
            docs += row["docs"]
            n += sizes.tolist()
            own += (upto[ends] - upto[ends - sizes]).tolist()
        return pa.table({"doc_id": pa.array(docs, pa.int64()), "n_words": pa.array(n, pa.int64()),
                         "own": pa.array(own, pa.int64())})
    return run


def score(
    docs: DataFrame, order: int = ORDER, least: int = LEAST, backoff: float = BACKOFF, size: int | None = None,
) -> DataFrame:
    """(doc_id, n_words, log_score, per_word) for ``docs`` (doc_id, text).

    ``log_score``: sum over all positions of the natural logarithm of the backoff score,
    in millionths (long); ``per_word``: its mean in nats, null without words. Rows with
    one doc_id, null too, are parts of one document and add up; n-grams don't cross
    rows. Null and empty texts have no words and the score 0. Further columns are
    ignored; an empty table gives an empty result. ``order`` is 2 or 3. With ``size``,
    all but so many most frequent words are one unknown word; they reach the driver.
    """
    if not 2 <= order <= 3 or size is not None and size < 1 or least < 1:
        raise ValueError("order 2 or 3, size and least from 1 on")
    docs = tidy(docs, doc_id="long", text="string")
    known = None if size is None else docs.sparkSession.sparkContext.broadcast(vocabulary(docs, size))
    blocks = materialise(docs.mapInArrow(
        _blocks(known, BLOCK), "block long, words long, docs array<long>, sizes binary, keys binary, texts binary"), "blocks")
    total = blocks.agg(F.sum("words")).first()[0] or 0
    ranges = max(1, math.ceil(order * total / RANGE))
    conf = docs.sparkSession.conf
    rows = conf.get(ARROW_CONF)
    conf.set(ARROW_CONF, BLOCK_ROWS)
    try:
        sums = materialise(
            blocks.mapInArrow(_sent(order, ranges), "range int, block long, keys binary, counts binary")
            .groupBy("range").applyInArrow(_summed, "range int, block long, sums binary"), "sums")
        every = materialise(blocks.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(
            _scored(max(total, 1), order, least, backoff), "doc_id long, n_words long, own long"), "scored")
    finally:
        conf.set(ARROW_CONF, rows)
    return every.groupBy("doc_id").agg(
        F.sum("n_words").alias("n_words"), F.sum("own").alias("log_score")).withColumn(
        "per_word", F.round(F.col("log_score") / F.nullif(F.col("n_words"), F.lit(0)) / UNIT, 6))


def op3_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents"))


#: The same from the definition: S of each position, without the split into gains.
OP3_SQL = f"""
with split as (
  select doc_id, string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') words from documents
), every as (
  select doc_id, unnest(words) word, generate_subscripts(words, 1) place from split
), places as (
  select * from every where word <> ''
), vocabulary as (
  select word, row_number() over (order by count(*) desc, encode(word)) number from places group by word
), numbered as (
  select doc_id, place, coalesce(number, 0) number from places left join vocabulary using (word)
), single as (
  select number, count(*) n, sum(count(*)) over () total from numbered group by number
), pairs as (
  select doc_id, place, number, lag(number) over (partition by doc_id order by place) before from numbered
), seen as (
  select before, number, count(*) n from pairs where before is not null group by all having count(*) >= {LEAST}
), scored as (
  select doc_id,
    cast(round(ln(s.n / s.total) * {UNIT}) as bigint)
    + case when p.before is null then 0 else cast(round(ln({BACKOFF}) * {UNIT}) as bigint) end
    + case when k.n is null then 0 else cast(round(
        (ln(k.n / b.n) - ln(s.n / s.total) - ln({BACKOFF})) * {UNIT}) as bigint) end as part
  from pairs p join single s on s.number = p.number
  left join single b on b.number = p.before
  left join seen k on k.before = p.before and k.number = p.number
)
select d.doc_id, cast(coalesce(count(part), 0) as bigint) n_words, cast(coalesce(sum(part), 0) as bigint) log_score,
  round(cast(coalesce(sum(part), 0) as double) / nullif(count(part), 0) / {UNIT}, 6) per_word
from (select distinct doc_id from documents) d left join scored using (doc_id) group by d.doc_id
"""
