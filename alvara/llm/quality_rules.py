"""Quality rules: base statistics of a text, and a decision list learned from labels.

Everything is DataFrame code. Statistics are computed in one row, without any shuffle.
For learning they are joined to the labels and cut into bins by quantiles. A rule is a
conjunction of threshold tests that says "reject". It grows on two thirds of the
labelled rows, one test at a time, by information gain; it is pruned on the other third,
from its end, by precision. Rows that it covers leave, and the next rule grows on the
rest, until a rule is not precise enough. Each step is one aggregation that returns
counts for features x bins x labels, so its result is bounded whatever the number of
labelled rows. The list becomes one ordered CASE expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, materialise, table, tidy

BLANK = r"[\\x20\\x09-\\x0D]"
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent
#: A rule's least precision on the rows that prune it, and the rules and tests at most.
PRECISION = 0.85
RULES, TESTS = 8, 3
#: A rule has to cover so many labelled rows of the pruning part.
COVER = 5
BINS = 64

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
EXTRA = ["n_lines", "n_upper", "n_marks"]

_REPEATED = """
transform(array(transform(sequence(0, size(w) - 5), i -> xxhash64(w[i], w[i+1], w[i+2], w[i+3], w[i+4]))), h ->
  case when size(array_distinct(h)) = size(h) then 0L else
    transform(array(sort_array(transform(h, (x, i) -> struct(x as x, i as i)))), s ->
      transform(array(sort_array(transform(
          filter(s, (e, k) -> get(s, k - 1).x <=> e.x or get(s, k + 1).x <=> e.x), e -> e.i))), p ->
        aggregate(transform(p, (e, k) -> least(5, coalesce(get(p, k + 1) - e, 5))), 0L, (a, b) -> a + b)
      )[0]
    )[0]
  end)[0]
"""

_STATISTICS = f"""
transform(array(coalesce({{text}}, '')), t ->
  transform(array(filter(split(t, '{BLANK}+'), x -> x <> '')), w ->
    transform(array(filter(split(t, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')), l ->
      struct(
        cast(size(w) as bigint) as n_words,
        aggregate(w, 0L, (a, x) -> a + length(x)) as word_chars,
        cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint) as n_symbols,
        cast(size(l) - size(array_distinct(l)) as bigint) as n_dup_lines,
        case when size(w) < 5 then 0L else {_REPEATED} end as n_repeat_words,
        cast(size(l) as bigint) as n_lines,
        cast(length(t) - length(regexp_replace(t, '\\\\p{{{{Lu}}}}+', '')) as bigint) as n_upper,
        cast(length(t) - length(translate(t, '!?', '')) as bigint) as n_marks
      ))[0])[0])
"""


def statistics(text: str = "text") -> Column:
    """A generator of one row: the counts of the text in column ``text``.

    As a generator it is worked out once, however many of its counts are used.
    """
    return F.inline(F.expr(_STATISTICS.format(text=f"`{text}`")))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _share(part: str, of: str) -> Column:
    return F.coalesce(F.col(part) / F.nullif(F.col(of), F.lit(0)), F.lit(0.0))


FEATURES = {
    "words": lambda: F.col("n_words").cast("double"),
    "letters_a_word": lambda: _share("word_chars", "n_words"),
    "symbols_a_word": lambda: _share("n_symbols", "n_words"),
    "repeated_lines": lambda: _share("n_dup_lines", "n_lines"),
    "repeated_words": lambda: _share("n_repeat_words", "n_words"),
    "words_a_line": lambda: _share("n_words", "n_lines"),
    "upper_case": lambda: _share("n_upper", "word_chars"),
    "marks_a_word": lambda: _share("n_marks", "n_words"),
}


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool  # value >= threshold, else value < threshold
    threshold: float

    def column(self) -> Column:
        value = FEATURES[self.feature]()
        return value >= self.threshold if self.above else value < self.threshold


Rule = tuple[Test, ...]


def _all(tests: list[Column]) -> Column:
    out = F.lit(True)
    for test in tests:
        out = out & test
    return out


def kept(rules: list[Rule]) -> Column:
    """The ordered list as one expression over the counts: false where a rule holds."""
    out = F.when(base_failed(), False)
    for rule in rules:
        out = out.when(_all([t.column() for t in rule]), False)
    return out.otherwise(True)


def _counts(rows: DataFrame, condition: Column) -> dict[tuple[int, int], list[int]]:
    """(feature, bin) to [bad, good] rows under ``condition``."""
    out: dict[tuple[int, int], list[int]] = {}
    parts = rows.where(condition).select("good", F.posexplode("bins").alias("f", "bin"))
    for r in parts.groupBy("f", "bin", "good").count().collect():
        out.setdefault((r["f"], r["bin"]), [0, 0])[r["good"]] += r["count"]
    return out


def _best(counts: dict, cuts: list[list[float]]) -> tuple[float, tuple[int, bool, int], tuple[int, int]] | None:
    """The test of greatest gain, ties to the first; its gain and its [bad, good] rows."""
    best = None
    for f, values in enumerate(cuts):
        by = [counts.get((f, b), [0, 0]) for b in range(len(values) + 1)]
        bad, good = sum(x[0] for x in by), sum(x[1] for x in by)
        if not bad:
            continue
        before = math.log2(bad / (bad + good))
        low_bad = low_good = 0
        for b in range(len(values)):
            low_bad, low_good = low_bad + by[b][0], low_good + by[b][1]
            for above, p, n in ((True, bad - low_bad, good - low_good), (False, low_bad, low_good)):
                if p:
                    gain = p * (math.log2(p / (p + n)) - before)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, (f, above, b), (p, n))
    return best


def learn(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """Ordered rules from ``stats`` (doc_id and counts) and ``labels`` (doc_id, quality).

    Rows that fail the base rules, and labels other than 0 and 1, take no part. Without
    labels of both kinds the list is empty. A doc_id that is repeated in either table
    counts once for each pair.
    """
    marked = tidy(labels, doc_id="long", quality="int").where("quality in (0, 1)").select(
        "doc_id", F.col("quality").alias("good"))
    names = list(FEATURES)
    rows = materialise(
        stats.where(~base_failed()).join(marked, "doc_id").select(
            "good", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune"),
            *[FEATURES[n]().alias(n) for n in names]), "labelled")
    at = [(k + 1) / BINS for k in range(BINS - 1)]
    asked = rows.agg(*[F.percentile_approx(n, at, 10_000).alias(n) for n in names]).collect()[0]
    if asked[names[0]] is None:
        return []
    # thresholds of four figures read well; what is not below one is above it
    cuts = [sorted({float(f"{v:.4g}") for v in asked[n]}) for n in names]
    bins = F.array(*[
        F.expr(f"size(filter(array({', '.join(f'{c!r}D' for c in cut)}), c -> c <= {n}))")
        for n, cut in zip(names, cuts)])
    rows = materialise(rows.select("good", "prune", bins.alias("bins")), "binned")

    def holds(tests: list[tuple[int, bool, int]]) -> Column:
        return _all([F.col("bins")[f] > b if above else F.col("bins")[f] <= b for f, above, b in tests])

    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < RULES:
        tests: list[tuple[int, bool, int]] = []
        while len(tests) < TESTS:
            found = _best(_counts(rows, left & ~F.col("prune") & holds(tests)), cuts)
            if found is None or found[0] <= 1e-9:
                break
            tests.append(found[1])
            if not found[2][1]:
                break
        if not tests:
            break
        sums = [F.count_if(holds(tests[:k]) & (F.col("good") == g)) for k in range(1, len(tests) + 1) for g in (0, 1)]
        seen = rows.where(left & F.col("prune")).agg(*sums).collect()[0]
        worth = [((seen[2 * k] + 1) / (seen[2 * k] + seen[2 * k + 1] + 2), -k) for k in range(len(tests))]
        size = 1 - max(worth)[1]
        bad, good = seen[2 * size - 2], seen[2 * size - 1]
        if bad + good < COVER or bad < PRECISION * (bad + good):
            break
        tests = tests[:size]
        rules.append(tuple(Test(names[f], above, cuts[f][b]) for f, above, b in tests))
        left = left & ~holds(tests)
    return rules


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, counts, base_failed, kept) of every row of ``docs`` (doc_id, text).

    Null and empty texts have no word and fail the base rules. Repeated rows each give a
    row, null ids too; further columns are ignored; an empty table gives an empty result.
    """
    stats = materialise(
        tidy(docs, doc_id="long", text="string").select("doc_id", statistics("text")), "statistics")
    rules = learn(stats, labels)
    return stats.select("doc_id", *COUNTS, *EXTRA, base_failed().alias("base_failed"), kept(rules).alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the base rules and the learned list keep, all columns.

    Rows are written once with their statistics: the list is learned from the latter,
    and the answer filters the same files, so no text is counted twice or shuffled.
    """
    own = docs.columns
    inner = fresh("row__", own)
    packed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in own]).alias(inner), docs["doc_id"].cast("long").alias("doc_id"),
        docs["text"].cast("string").alias("text"))
    judged = materialise(packed.select(inner, "doc_id", statistics("text")), "judged")
    rules = learn(judged.select("doc_id", *COUNTS, *EXTRA), labels)
    return judged.where(kept(rules)).select(f"{inner}.*")


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept")
