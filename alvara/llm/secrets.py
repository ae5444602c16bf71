"""Secret scans: rules, and a character convolutional network over further candidates.

Rules find assignments to secret names, access ids and long hexadecimal runs. Every run
of 12 or more characters of the usual key alphabets is a candidate, of letters only too;
one that lies within what a rule found is settled, one that goes beyond it is judged as a
whole. A small convolutional network (numpy) reads the characters of the candidate and of
its surroundings; over a long candidate its view slides, and the best view counts. It is trained on
the labelled findings of the same corpus, all of them: views that touch what a rule found are
positive, others negative; every finding also appears with a value drawn anew (random key
characters: positive; words and numbers from its own surroundings and from those of its block:
negative), so that the network doesn't only know the alphabets of the rules.

Findings lie in blocks of about ``BLOCK`` by hash. In each of ``ROUNDS`` rounds every block trains
the network further on all its findings, and the networks of all blocks are averaged (in
whole units, so that the order of tasks changes no bit); only the average, of a fixed size,
reaches the driver. Scores are whole 256ths; those of all held-out findings are counted by
score, and on these counts the network is calibrated, and its threshold is the most precise that
keeps ``RECALL`` of the held-out positives. It only adds spans; what rules found stays.
"""

from __future__ import annotations

import math
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table, tidy

# fixed values: the rules
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "model")
LEAST_VALUE = 12

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
BEFORE, HEAD, TAIL, AFTER = 20, 32, 8, 8
#: Characters by which the view moves on over a candidate longer than HEAD + TAIL.
STEP = 20
#: Views that are scored at once.
VIEWS = 16_384
WIDTH = BEFORE + HEAD + TAIL + AFTER
#: Findings of a block on average, rounds, and steps of 64 examples that are taken in all at least.
BLOCK, ROUNDS, STEPS = 8_192, 3, 2_500
#: Views that a task remembers in order not to hand them on again.
SEEN = 50_000
#: Scores are whole parts of a logit, networks are averaged in whole parts of one.
PARTS_OF_ONE, UNITS = 256, float(1 << 40)
RECALL = 0.95
MARK = "[SECRET]"
#: Rows of a batch of blocks, 2 MB each.
BLOCK_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2", "spark.sql.parquet.columnarReaderBatchSize": "2"}
#: Parquet looks at a page's size after 100 rows only unless told to look sooner, and codecs keep
#: buffers outside the heap as large as their largest page: of blocks, all that a task writes.
BLOCK_PAGES = {"parquet.page.size.row.check.min": "1"}

_HEX_RUN = bytes(120 if chr(c) in "0123456789abcdef" else 46 for c in range(256))


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) in code points, leftmost and without overlap within a kind."""
    found = []
    lower = text.lower()
    if any(name in lower for name in NAMES):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    if b"x" * 16 in text.encode("latin-1", "replace").translate(_HEX_RUN):
        found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def view(text: str, start: int, end: int) -> str:
    """What the network sees of a candidate: a fixed number of characters."""
    value = text[start:end]
    head = value[:HEAD].ljust(HEAD, "\0")
    tail = value[max(HEAD, len(value) - TAIL):].rjust(TAIL, "\0")
    return text[max(0, start - BEFORE):start].rjust(BEFORE, "\0") + head + tail \
        + text[end:end + AFTER].ljust(AFTER, "\0")


class Reach:
    """How far the rules' spans up to a place reach; one sorted walk, then lookups."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts, self.ends = [s[0] for s in spans], []
        for s in spans:
            self.ends.append(max(s[1], self.ends[-1] if self.ends else 0))

    def touches(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at > 0 and self.ends[at - 1] > start

    def holds(self, start: int, end: int) -> bool:
        at = bisect_right(self.starts, start)
        return at > 0 and self.ends[at - 1] >= end


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of every run of ``LEAST_VALUE`` or more characters of the key alphabets."""
    return [m.span() for m in CANDIDATE.finditer(text)]


def windows(start: int, end: int) -> list[tuple[int, int]]:
    """The parts of a candidate that are viewed: all of it, or overlapping ones that cover it."""
    wide = HEAD + TAIL
    if end - start <= wide:
        return [(start, end)]
    return [(k, k + wide) for k in [*range(start, end - wide, STEP), end - wide]]


def codes(views: list[str]) -> np.ndarray:
    """Characters as numbers below 128; anything beyond ASCII is 127."""
    raw = "".join(views).encode("latin-1", "replace")
    return np.minimum(np.frombuffer(raw, np.uint8), 127).reshape(len(views), WIDTH)


@dataclass
class Network:
    """Embedding, one convolution, the largest response before, in and behind the value."""

    table: np.ndarray
    kernel: np.ndarray
    shift: np.ndarray
    out: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 1.1

    SPAN = 5
    PARTS = ((0, BEFORE), (BEFORE, BEFORE + HEAD + TAIL), (BEFORE + HEAD + TAIL, WIDTH))

    @classmethod
    def start(cls, seed: int = 7, depth: int = 8, filters: int = 16) -> Network:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(0, 0.3, (128, depth)), rng.normal(0, 0.15, (cls.SPAN * depth, filters)),
                   np.zeros(filters), rng.normal(0, 0.1, 3 * filters + 1))

    def parameters(self) -> list[np.ndarray]:
        return [self.table, self.kernel, self.shift, self.out]

    def responses(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes with their borders, and the convolution: what a character adds to the
        responses around it is looked up, as the kernel times its embedding; a border adds nothing."""
        depth = self.table.shape[1]
        codes = np.full((len(x), WIDTH + self.SPAN - 1), 128, np.intp)
        codes[:, self.SPAN // 2:-(self.SPAN // 2)] = x
        response = np.broadcast_to(self.shift, (len(x), WIDTH, len(self.shift))).copy()
        for k in range(self.SPAN):
            adds = np.zeros((129, len(self.shift)), self.table.dtype)
            adds[:128] = self.table @ self.kernel[k * depth:(k + 1) * depth]
            response += np.take(adds, codes[:, k:k + WIDTH], axis=0, mode="clip")
        return codes, response

    def features(self, tops: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([*(np.maximum(t, 0) for t in tops), np.ones((len(tops[0]), 1), self.out.dtype)], axis=1)

    def logits(self, x: np.ndarray) -> np.ndarray:
        parts = []
        for k in range(0, len(x), 256):
            response = self.responses(x[k:k + 256])[1]
            parts.append(self.features([response[:, a:b].max(1) for a, b in self.PARTS]) @ self.out)
        return np.concatenate(parts) if parts else np.zeros(0)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Logits in whole parts, between -40 and 40."""
        return np.rint(np.clip(self.logits(x), -40, 40) * PARTS_OF_ONE).astype(np.int64)

    def scaled(self, scores: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * (scores / PARTS_OF_ONE) + b, -40, 40)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(self.scores(x))

    def gradients(self, x: np.ndarray, y: np.ndarray):
        codes, response = self.responses(x)
        at = [response[:, a:b].argmax(1) + a for a, b in self.PARTS]
        features = self.features([np.take_along_axis(response, k[:, None], 1)[:, 0] for k in at])
        z = features @ self.out
        miss = ((1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(x)).astype(self.out.dtype)
        g_out = features.T @ miss
        filters, depth = len(self.shift), self.table.shape[1]
        back = miss[:, None] * self.out[:-1] * (features[:, :-1] > 0)  # rows x (parts * filters)
        g_shift = back.reshape(len(x), 3, filters).sum((0, 1))
        place, rows = np.concatenate(at, axis=1), np.arange(len(x))[:, None]
        column = np.tile(np.arange(filters), 3)
        g_table, g_kernel = np.zeros_like(self.table), np.zeros_like(self.kernel)
        for k in range(self.SPAN):
            cells = codes[rows, place + k] * filters + column
            g_adds = np.bincount(cells.ravel(), back.ravel(), 129 * filters).reshape(129, filters)[:128]
            kernel = self.kernel[k * depth:(k + 1) * depth]
            g_table += g_adds @ kernel.T
            g_kernel[k * depth:(k + 1) * depth] = self.table.T @ g_adds
        return g_table, g_kernel, g_shift, g_out


def beginning() -> tuple[float, np.ndarray]:
    """Steps so far, and in one vector the parameters, their mean gradients and the roots of
    their mean squares."""
    start = np.concatenate([p.ravel() for p in Network.start().parameters()])
    return 0.0, np.concatenate([start, np.zeros(2 * len(start))])


def network(state: np.ndarray, part: int = 0) -> Network:
    """The network of a state's parameters; ``part`` 1 and 2: its gradients, their roots."""
    net, at = Network.start(), part * len(state) // 3
    shaped = []
    for p in net.parameters():
        shaped.append(state[at:at + p.size].reshape(p.shape).astype(np.float32))
        at += p.size
    return Network(*shaped)


def further(step: float, state: np.ndarray, x: np.ndarray, y: np.ndarray, passes: int, seed: int,
            batch: int = 64, rate: float = 0.01) -> tuple[float, np.ndarray]:
    """Passes of Adam on the log loss over some findings; deterministic."""
    net, rng = network(state), np.random.default_rng([11, seed])
    params, mean = net.parameters(), network(state, 1).parameters()
    square = [r * r for r in network(state, 2).parameters()]
    for _ in range(passes):
        order = rng.permutation(len(x))
        for at in range(0, len(x), batch):
            part = order[at:at + batch]
            step += 1
            for p, g, m, s in zip(params, net.gradients(x[part], y[part]), mean, square):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    every = [*params, *mean, *(np.sqrt(s) for s in square)]
    return step, np.concatenate([p.ravel() for p in every]).astype(float)


def passes_of(examples: int) -> int:
    """Passes over each block in a round, from the number of all examples that train."""
    return math.ceil(STEPS / ROUNDS / max(1, math.ceil(examples / 64)))


def calibrate(net: Network, scores: np.ndarray, y: np.ndarray, n: np.ndarray, recall: float = RECALL) -> Network:
    """Logistic scaling of held-out findings, ``n`` of each score and label; then, of the thresholds
    from 0.5 on that keep ``recall``, the one of best precision, the lowest among equals."""
    if not (y == 1).any():
        return net
    z, (a, b), n = scores / PARTS_OF_ONE, (1.0, 0.0), n.astype(float)
    every = n.sum()
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        a -= 0.1 * float(((p - y) * z) @ n / every / (1 + (z * z) @ n / every))
        b -= 0.1 * float((p - y) @ n / every)
    net.scale = (a, b)
    p = net.scaled(scores)
    cuts, place = np.unique(np.maximum(p, 0.5), return_inverse=True)
    above = [np.cumsum(np.bincount(place, n * (p >= 0.5) * pick, len(cuts))[::-1])[::-1] for pick in (y == 1, y >= 0)]
    kept, right = above[0] / (n @ (y == 1)), above[0] / np.maximum(above[1], 1)
    allowed = kept >= min(recall, kept.max())
    net.threshold = float(cuts[allowed][np.argmax(right[allowed])])
    return net


_ALPHABETS = ["0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_LEADS = ("key = ", "secret: ", "token=", '"token": "', "Bearer ")
_WORD = re.compile(r"[A-Za-z]{2,}")


def varied(views: list[str], labels: list[int], seed: int = 0) -> tuple[list[str], list[int]]:
    """The findings, and each three times more: with a drawn key, with words and numbers of
    its surroundings, and with words of all that are given."""
    draw = random.Random(f"secrets {seed}")
    real, below = draw.random, lambda n: int(draw.random() * n)
    texts, out = list(views), list(labels)
    pool = sorted({w for seen in views for w in _WORD.findall(seen[:BEFORE] + " " + seen[-AFTER:])}) or ["page"]

    def placed(front: str, value: str, after: str) -> str:
        parts = windows(len(front), len(front) + len(value))
        return view(front + value + after, *parts[below(len(parts))])

    for seen in views:
        front, after = seen[:BEFORE].replace("\0", ""), seen[-AFTER:]
        key = "".join(draw.choices(_ALPHABETS[below(4)], k=LEAST_VALUE + below(60 - LEAST_VALUE)))
        if real() < 0.3:  # a maker's prefix
            key = "".join(draw.choices(_LETTERS, k=2 + below(3))) + "_-"[below(2)] + key
        texts.append(placed(front + _LEADS[below(5)], key, after))
        out.append(1)
        own = _WORD.findall(front + " " + after.replace("\0", "")) or pool
        for words in (own, pool):
            plain = ""
            for _ in range(2 + below(4)):
                plain += words[below(len(words))] + "-_/="[below(4)]
                if real() < 0.4:
                    plain += str(below(3000))
            while len(plain) < LEAST_VALUE:
                plain += words[below(len(words))]
            texts.append(placed(front, plain, after))
            out.append(0)
    return texts, out


def examples(findings: list[tuple[str, int]], seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, labels, and whether held out, of findings and their variations."""
    views, labels = varied([v for v, _ in findings], [int(label) for _, label in findings], seed)
    return codes(views), np.array(labels, np.int8), np.random.default_rng([3, seed]).random(len(views)) < 0.25


def fit(findings: list[tuple[str, int]], recall: float = RECALL) -> Network | None:
    """A calibrated network from one block of findings; None where no finding is positive."""
    if not any(label for _, label in findings):
        return None
    x, y, held = examples(findings)
    step, state = beginning()
    for turn in range(ROUNDS):
        step, state = further(step, state, x[~held], y[~held], passes_of(int((~held).sum())), turn)
    net = network(state)
    scores, y = net.scores(x[held]), y[held]
    return calibrate(net, scores, y, np.ones(len(y)), recall)


def added(texts: list[str], spans: list[list], net: Network | None) -> list[list[tuple[int, int, int]]]:
    """For each text the candidates beyond the rules' ``spans`` that the network accepts."""
    out = [[] for _ in texts]
    if net is None:
        return out
    views, owners = [], []
    for k, (text, found) in enumerate(zip(texts, spans)):
        reach = Reach(found)
        for s, e in candidates(text):
            if reach.holds(s, e):
                continue
            for a, b in windows(s, e):
                views.append(view(text, a, b))
                owners.append((k, s, e))
            if len(views) >= VIEWS:
                _accept(net, views, owners, out)
                views, owners = [], []
    _accept(net, views, owners, out)
    return out


def _accept(net: Network, views: list[str], owners: list[tuple[int, int, int]], out: list[list]) -> None:
    if views:
        good = net.probability(codes(views)) >= net.threshold
        for k, s, e in dict.fromkeys(owners[k] for k in np.flatnonzero(good)):
            out[k].append((s, e, 3))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


def _findings(remembered: int):
    """All views and their labels; one that the task remembers isn't handed on again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[str, int]] = set()
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                reach = Reach(rule_spans(text))
                for s, e in candidates(text):
                    for a, b in windows(s, e):
                        found = view(text, a, b), int(reach.touches(a, b))
                        if found not in known:
                            if len(known) >= remembered:
                                known.clear()
                            known.add(found)
                            rows.append(found)
                    if len(rows) >= VIEWS:
                        yield _found(rows)
                        rows = []
            yield _found(rows)
    return run


def _found(rows: list[tuple[str, int]]) -> pa.RecordBatch:
    hashes = [xxhash.xxh64_intdigest(v.encode("utf-8", "replace"), 0) >> 1 for v, _ in rows]
    return pa.RecordBatch.from_arrays(
        [pa.array([v for v, _ in rows], pa.string()), pa.array(hashes, pa.int64()),
         pa.array([label for _, label in rows], pa.int32())], ["view", "hash", "label"])


def _block(key: tuple, found: pa.Table) -> pa.Table:
    """The examples of a block in one row; of a label, bit 2 says that it is held out."""
    block = key[0].as_py()
    rows = sorted(zip(*(found.column(c).to_pylist() for c in ("hash", "view", "label"))))
    x, y, held = examples([(v, label) for _, v, label in rows], block)
    return pa.table({"block": pa.array([block], pa.int64()), "x": pa.array([x.astype(np.uint8).tobytes()], pa.binary()),
                     "y": pa.array([(y + 2 * held).astype(np.uint8).tobytes()], pa.binary())})


def _examples(batch: pa.RecordBatch, held: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The held-out findings of each block, or those that train."""
    for block, x, y in zip(*(batch.column(c) for c in range(3))):
        y = np.frombuffer(y.as_py(), np.uint8)
        chosen = (y >= 2) == held
        x = np.frombuffer(x.as_py(), np.uint8).reshape(-1, WIDTH)
        yield block.as_py(), x[chosen], (y & 1)[chosen].astype(np.float32)


def _further(step: float, state: np.ndarray, passes: int, turn: int):
    """The sum of the networks to which the blocks of a task train, in whole units."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block, x, y in _examples(batch, False):
                steps, found = further(step, state, x, y, passes, block * ROUNDS + turn)
                units = np.append(np.rint(found * UNITS), [steps, 1]).astype(np.int64)
                total = units if total is None else total + units
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "units"])
    return run


def _held_out(net: Network):
    """(score, label, n) of some blocks' held-out findings."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x, y in _examples(batch, True):
                pairs, n = np.unique(np.stack([net.scores(x), y.astype(np.int64)], 1), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(n.astype(np.int64))], ["score", "label", "n"])
    return run


@contextmanager
def told(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The session has these settings meanwhile."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def trained(docs: DataFrame, recall: float = RECALL) -> Network | None:
    """The network for ``docs`` (doc_id, text): all findings train it, block by block.

    The driver gets counts, sums of networks and the held-out findings' counts by score (of
    which there are at most 20 481), whatever the size of ``docs``.
    """
    found = materialise(docs.mapInArrow(
        _findings(SEEN), "view string, hash long, label int").distinct(), "findings")
    count = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    if not count.get(1):
        return None
    blocks = math.ceil(sum(count.values()) / BLOCK)
    parts = found.withColumn("block", F.col("hash") % blocks).groupBy("block").applyInArrow(
        _block, "block long, x binary, y binary")
    with told(docs.sparkSession, BLOCK_PAGES):
        parts = materialise(parts, "blocks")
    with told(docs.sparkSession, BLOCK_BATCHES):
        step, state = beginning()
        passes = passes_of(3 * sum(count.values()))
        for turn in range(ROUNDS):
            sums = parts.mapInArrow(_further(step, state, passes, turn), "place int, units long").groupBy("place").agg(
                F.sum("units").alias("units")).collect()
            total = np.array([r["units"] for r in sorted(sums, key=lambda r: r["place"])], float)
            state, step = total[:-2] / UNITS / total[-1], total[-2] / total[-1]
        net = network(state)
        held = parts.mapInArrow(_held_out(net), "score long, label long, n long").groupBy("score", "label").agg(
            F.sum("n").alias("n")).orderBy("score", "label").collect()
    return calibrate(net, *(np.array([r[c] for r in held], np.int64) for c in ("score", "label", "n")), recall)


def _spans(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = [text.as_py() or "" for text in batch.column(1)]
            bases = [rule_spans(text) for text in texts]
            for base, more in zip(bases, added(texts, bases, net)):
                every = sorted(base + more, key=lambda s: (s[0], s[2]))
                count = [sum(k == kind for _, _, k in base) for kind in range(3)]
                out.append((*count, written(base), written(every)))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"])
    return run


def find_secrets(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_spans, spans) of every row of ``docs``.

    Spans are kind:start:end by start and kind, comma-joined, in code points. Null and
    empty texts have none. Rows are treated alone, so repeated rows and null ids each
    give a row; further columns are ignored; an empty table gives an empty result, and
    without any positive finding the network adds nothing.
    """
    docs = tidy(docs, doc_id="long", text="string")
    net = trained(docs, recall)
    return docs.mapInArrow(
        _spans(net),
        "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string")


def _without(net: Network | None, mark: str):
    def clean(text: str | None, every: list) -> str | None:
        if not every:
            return text
        parts, at = [], 0
        for s, e, _ in sorted(every):
            if s >= at:
                parts += [text[at:s], mark]
            at = max(at, e)
        return "".join([*parts, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index("text")
            texts = batch.column(k).to_pylist()
            bases = [rule_spans(t or "") for t in texts]
            found = added([t or "" for t in texts], bases, net)
            yield batch.set_column(k, batch.schema.field(k), pa.array(
                [clean(t, b + m) for t, b, m in zip(texts, bases, found)], batch.schema.field(k).type))
    return run


def without_secrets(docs: DataFrame, mark: str = MARK) -> DataFrame:
    """``docs`` with every secret in its text replaced by ``mark``; no row is lost.

    Overlapping spans become one mark. A null text stays null, other columns stay as
    they are.
    """
    net = trained(tidy(docs, doc_id="long", text="string"))
    return docs.mapInArrow(_without(net, mark), docs.schema)


def op9_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = find_secrets(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")
