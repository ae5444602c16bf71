"""Spelling variants: words one edit apart, found by pivotal grams.

All bigrams of the alphabet are ordered by how rare they are. A word's gram prefix holds
its three rarest bigrams; two disjoint ones of them, the cheapest pair by dynamic
programming, are its pivots. One edit breaks at most one pivot,
and the other word holds the unbroken one within its own prefix if its prefix reaches at
least as far; so pivots of each word are looked up among the prefixes of the others. The
edit lies on one side of an unbroken pivot: on the other side both words are equal up to
the pivot, which fixes its position. So what is looked up is the pivot with that equal
side and the other word's length. Every hit is then verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, tidy

# fixed values: letters, and the share of altered runs
LETTERS = "A-Za-z\\u00C0-\\u00FF"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALTERED = 31

LEAST_LETTERS, LEAST_SEEN, TIMES = 7, 2, 10
EDITS, GRAM = 1, 2
#: Grams of a prefix: one edit breaks at most ``GRAM`` of them.
PREFIX = GRAM * EDITS + 1
#: Grams of one kind that one edit can add.
SHIFT = GRAM * EDITS
#: An equal side of so many letters is looked up with half of the other side.
SHORT = 4


def _altered(word: Column, doc_id: Column) -> Column:
    key = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word))
    at = F.pmod(key, F.length(word)).cast("int")
    return F.when(key % ALTERED == 0, F.concat(F.substring(word, F.lit(1), at), F.substr(word, at + 2))).otherwise(word)


def words(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_seen: int = LEAST_SEEN) -> DataFrame:
    """(word, n): the distinct words of all texts and how often they occur."""
    # shorter runs can't give a word, for altering only shortens
    pattern = f"[{LETTERS}]{{{least_letters},}}"
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("run"))
    lower = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    word = lower.select(_altered(F.col("run"), F.col("doc_id")).alias("word"))
    return word.where(F.length("word") >= least_letters).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_seen)


def pivotal(costs: list[int], ranks: list[int]) -> tuple[list[int], tuple[int, int], int]:
    """Positions of the gram prefix, the pivots, and the rank to which the prefix reaches.

    ``costs`` and ``ranks`` are those of the grams in order of position. The prefix is the
    first ``PREFIX`` by rank and position; the pivots are the two disjoint grams in it of
    least total cost: the best so far at each position is kept, and a gram joins the best
    that ends before it begins. As one edit can move a gram behind ``SHIFT`` more of its
    kind, so many more of the last rank count to the prefix when it is looked up.
    """
    order = sorted(range(len(ranks)), key=lambda i: (ranks[i], i))
    first, reach = sorted(order[:PREFIX]), ranks[order[PREFIX - 1]]
    best: list[tuple[int, int]] = []  # (cost, position) of the cheapest among the first k
    pair = None
    for k, i in enumerate(first):
        j = k - 1
        while j >= 0 and first[j] > i - GRAM:
            j -= 1
        if j >= 0 and (pair is None or best[j][0] + costs[i] < pair[0]):
            pair = (best[j][0] + costs[i], best[j][1], i)
        best.append(min(best[-1], (costs[i], i)) if best else (costs[i], i))
    below = [i for i in first if ranks[i] < reach]
    last = [i for i in order[len(below):len(below) + PREFIX + SHIFT] if ranks[i] == reach]
    return below + last, pair[1:], reach


_INDEX = "key long, pivot boolean, word string, n long, reach int"


def lookups(word: str, at: int, left: bool, length: int) -> list[str]:
    """What a word of ``length`` is filed under and ``word`` looks up, if both are equal up
    to the gram at ``at`` (``left``) or from it on.

    One edit in the rest leaves its first half as it is, or what lies more than one
    letter behind that half.
    """
    equal, rest = (word[:at + GRAM], word[at + GRAM:]) if left else (word[at:], word[:at])
    name = f"{length}{'<' if left else '>'}{equal}"
    if len(equal) > SHORT:
        return [name]
    half = (length - len(equal)) // 2
    return [f"{name} {rest[:half]}<", f"{name} {rest[len(word) - length + half + 1:]}>"]


def _index(order: dict[str, tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, pivot, word, seen, reaches = [], [], [], [], []
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ranks, costs = zip(*[order[w[i:i + GRAM]] for i in range(len(w) - GRAM + 1)])
                prefix, pivots, reach = pivotal(costs, ranks)
                around = range(len(w) - EDITS, len(w) + EDITS + 1)
                places = [(i, left, len(w), False) for i in prefix for left in (True, False)]
                places += [(pivots[side], not side, length, True) for side in (0, 1) for length in around]
                for i, left, length, is_pivot in places:
                    for name in lookups(w, i, left, length):
                        keys.append(xxhash.xxh64_intdigest(name.encode()) - 2**63)
                        pivot.append(is_pivot)
                        word.append(w)
                        seen.append(n)
                        reaches.append(reach)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(pivot, pa.bool_()), pa.array(word, pa.string()),
                 pa.array(seen, pa.int64()), pa.array(reaches, pa.int32())],
                ["key", "pivot", "word", "n", "reach"])
    return run


def near_words(counted: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all pairs of ``counted`` (word, n) one edit apart, both ways.

    The table of bigrams has at most 90 x 90 rows, by the alphabet.
    """
    grams = counted.select(F.explode(F.expr(
        f"transform(sequence(1, length(word) - {GRAM - 1}), i -> substring(word, i, {GRAM}))")).alias("gram"))
    rare = sorted((r["count"], r["gram"]) for r in grams.groupBy("gram").count().collect())
    order = {gram: (rank, cost) for rank, (cost, gram) in enumerate(rare)}
    index = materialise(counted.select("word", "n").mapInArrow(_index(order), _INDEX), "grams")
    seekers = index.where("pivot").select("key", "word", "n", "reach")
    found = index.where("not pivot").select(
        "key", F.col("word").alias("other"), F.col("n").alias("other_n"), F.col("reach").alias("other_reach"))
    hits = seekers.join(found, "key").where(
        (F.col("reach") <= F.col("other_reach")) & (F.col("word") != F.col("other"))
        & (F.levenshtein("word", "other", EDITS) == EDITS))
    ways = hits.select(F.explode(F.array(
        F.struct("word", "n", "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"),
                 F.col("n").alias("other_n")))).alias("way")).select("way.*")
    # dealt by the first word, so that the sums by word need no further shuffle
    return ways.repartition("word").dropDuplicates(["word", "other"])


def _last_forms(steps: DataFrame) -> DataFrame:
    """(word, root) from (word, form): each round doubles the steps that are taken.

    Each form occurs at least ``TIMES`` as often as its word, so chains are short.
    """
    jumps, at = materialise(steps.select("word", F.col("form").alias("root")), "forms-0"), 0
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialise(jumps.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            f"forms-{at + 1}")
        at += 1
        jumps = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return jumps


def spelling_variants(docs: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` (doc_id, text).

    Null and empty texts have no word. A null doc_id counts as empty text where runs are
    altered. Repeated rows count each time; texts of any length are read whole; further
    columns are ignored; an empty table gives an empty result. Of near words that occur
    equally often the smallest by code points is taken.
    """
    counted = materialise(words(tidy(docs, doc_id="long", text="string")), "words")
    best = near_words(counted).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.first("n").alias("own"),
        F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("top"))
    formed = F.col("top.minus") * -1 >= times * F.col("own")
    best = materialise(best.select(
        "word", "n_near", F.when(formed, F.col("top.other")).alias("form"),
        F.when(formed, -F.col("top.minus")).alias("form_n")), "near")
    roots = _last_forms(best.where("form is not null"))
    return counted.join(best, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


#: CRC-32 of the bytes that a hexadecimal text spells.
_CRC = """xor(list_reduce(list_prepend(4294967295::bigint,
    list_transform(range(length({text}) // 2), lambda i: ('0x' || substr({text}, 2 * i + 1, 2))::bigint)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))),
  4294967295)"""

OP13_SQL = f"""
with recursive runs as (
  select doc_id, translate(unnest(regexp_extract_all("text", '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{UPPER}', '{LOWER}') as run
  from documents),
keyed as (
  select run, n, {_CRC.format(text="hex(coalesce(doc_id::varchar, '') || ':' || run)")} as h
  from (select doc_id, run, count(*) as n from runs where length(run) >= {LEAST_LETTERS} group by all)),
altered as (
  select case when h % {ALTERED} = 0
    then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, n
  from keyed),
counted as (
  select word, sum(n)::bigint as n from altered where length(word) >= {LEAST_LETTERS}
  group by word having sum(n) >= {LEAST_SEEN}),
shorter as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select *, unnest(range(1, length(word) + 1)) as i from counted)),
near as (
  select a.word, a.n, b.word as other, b.n as other_n from shorter a join shorter b on a.rest = b.rest and a.i = b.i
  where a.word <> b.word
  union select a.word, a.n, b.word, b.n from shorter a join counted b on a.rest = b.word
  union select b.word, b.n, a.word, a.n from shorter a join counted b on a.rest = b.word),
best as (
  select word, any_value(n) as n, count(*) as n_near, max(other_n) as most,
    min(other) filter (where other_n = most_n) as top
  from (select *, max(other_n) over (partition by word) as most_n from near) group by word),
forms as (
  select c.word, c.n, coalesce(n_near, 0)::bigint as n_near,
    case when most >= {TIMES} * c.n then top end as form, case when most >= {TIMES} * c.n then most end as form_n
  from counted c left join best b using (word)),
chain as (
  select word, word as at from forms
  union all select c.word, f.form from chain c join forms f on f.word = c.at where f.form is not null)
select f.word, f.form, c.at as root, f.n, f.n_near, f.form_n
from forms f join chain c using (word) join forms e on e.word = c.at where e.form is null
"""
