"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

A text becomes its symbols, one for each character. An agenda of adjacent symbol pairs
that a piece of the vocabulary spells is worked off from the best score on, leftmost
first among equals; each merge puts the pairs with the new neighbours on the agenda. The
agendas of short segments are rows of a matrix with a column for each pair.
What is left over and no piece is written as byte pieces, or as the unknown piece.

No piece continues over a word mark after another character, so a text falls into
segments (word marks and what follows up to the next ones) that cannot influence each
other. Where no piece has letters or digits beside other characters either, segments end
there too. Their encodings are kept in a bounded table that goes with its task: the Python
worker stays for other work, whose memory it would take. Segments new to the table are compared with the sentencepiece library, batch by batch; a difference
stops the job. Vocabularies with other settings than those used here are refused.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, filterfalse
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, tidy

MARK = "▁"
SEGMENT = re.compile(f"{MARK}+[^{MARK}]*")
#: Segments that a worker's table gains before those not used since are dropped; it never
#: holds more than twice as many.
KEPT = 150_000
#: Characters of such segments, likewise; a longer segment than LONGEST isn't kept beyond its rows.
CHARACTERS, LONGEST = 3_000_000, 200
#: Characters of a segment that is merged together with others.
SHORT = 40
#: Rows of a piece of a batch, and characters of texts that are encoded together; they bound
#: what is held between texts and ids.
ROWS, TOGETHER = 256, 1_000_000


def runs(others: str) -> re.Pattern:
    """Word marks, and the letters and digits, or the other characters, that follow them;
    the letters and digits in ``others`` count as other characters."""
    others = re.escape(f"_{others}")
    return re.compile(rf"{MARK}*+(?:[^\W{others}]++|(?:[^\w{MARK}]|[{others}])++)|{MARK}++")


def packed(ids: Iterable[int]) -> bytes:
    """Four bytes for each number; what is packed already stays as it is."""
    return array("i", ids).tobytes()


def without(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Each row without its element at ``at``."""
    stays = np.ones(rows.shape, bool)
    stays[np.arange(len(at)), at] = False
    return rows[stays].reshape(len(at), rows.shape[1] - 1)


class Vocabulary:
    """Pieces and scores of a model file, and the agenda over them."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        norm = proto.normalizer_spec
        plain = not norm.precompiled_charsmap and norm.add_dummy_prefix and not (
            norm.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix)
        kinds = {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != 2 or not plain or not norm.escape_whitespaces or kinds & {4, 5}:
            raise ValueError(f"not a plain merge-type vocabulary: {path}")
        place = {s: k for k, s in enumerate(sorted({p.score for p in proto.pieces}, reverse=True))}
        self.rank = {p.piece: place[p.score] for p in proto.pieces if p.type == 1}
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError(f"a piece goes on over a word mark: {path}")
        self.id = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        self.byte = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == 2)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.end = self.library.eos_id()
        self.decimal = [str(i) for i in range(len(proto.pieces))].__getitem__
        inside = set(chain.from_iterable(p for p in self.rank if len(p) > 1))
        #: A piece that merges with nothing.
        self.wall = next((p for p in self.rank if len(p) == 1 and p not in inside), "")
        self.front = packed(self.library.encode(self.wall))
        others = {c for p in self.rank if not runs("").fullmatch(p) for c in p if c.isalnum()}
        run = runs("".join(sorted(others)))
        #: Whether all characters of pieces are pieces.
        self.whole = inside <= self.rank.keys()
        self.segment = run if self.wall and self.byte and all(map(run.fullmatch, self.rank)) else SEGMENT

    def merge(self, segment: str) -> list[str]:
        """The symbols that are left when no adjacent pair spells a piece.

        An entry of the agenda is a pair's rank and the place of its left symbol in one
        number. It is out of date if what stands there now has another rank.
        """
        rank, part = self.rank.get, list(segment)
        n = len(part)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [r << 32 | i for i, r in enumerate(map(rank, map(add, part, part[1:]))) if r is not None]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i = entry & 0xFFFFFFFF
            j = right[i]
            if j >= n or not part[i]:
                continue
            pair = part[i] + part[j]
            if rank(pair) != entry >> 32:
                continue
            part[i], part[j] = pair, ""
            right[i] = after = right[j]
            if after < n:
                left[after] = i
                r = rank(pair + part[after])
                if r is not None:
                    heappush(agenda, r << 32 | i)
            before = left[i]
            if before >= 0:
                r = rank(part[before] + pair)
                if r is not None:
                    heappush(agenda, r << 32 | before)
        return [p for p in part if p]

    def ids(self, segment: str) -> list[int]:
        out = []
        for piece in self.merge(segment):
            known = self.id.get(piece)
            if known is not None:
                out.append(known)
            elif self.byte:
                out.extend(self.byte[b] for b in piece.encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    @cached_property
    def pairs(self) -> tuple[np.ndarray, ...]:
        """The symbols of all characters; of symbols the ids, and whether others have the same
        rank; all pairs of symbols that spell a piece (in one number, sorted) and its symbol.
        Symbols are pieces from the best rank on; one more stands for all characters that are
        no piece, and for what pairs spell that spell none."""
        symbol = {p: k for k, p in enumerate(sorted(self.rank, key=self.rank.get))}
        none, many = len(symbol), Counter(self.rank.values())
        symbols = np.full(0x110000, none, np.int32)
        spelled = {(none + 1) ** 2: none}
        for piece, k in symbol.items():
            if len(piece) == 1:
                symbols[ord(piece)] = k
            for cut in range(1, len(piece)):
                if piece[:cut] in symbol and piece[cut:] in symbol:
                    spelled[symbol[piece[:cut]] * (none + 1) + symbol[piece[cut:]]] = k
        keys = sorted(spelled)
        ids = np.array([*map(self.id.get, symbol), 0], np.int32)
        tied = np.array([*(many[self.rank[p]] > 1 for p in symbol), False])
        return symbols, ids, tied, np.array(keys, np.int64), np.array([spelled[k] for k in keys], np.int32)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbols that pairs spell."""
        _, ids, _, keys, spelled = self.pairs
        key = left * np.int64(len(ids)) + right
        at = np.searchsorted(keys, key)
        return np.where(keys[at] == key, spelled[at], np.int32(len(ids) - 1))

    def ids_of(self, segments: list[str]) -> dict[str, bytes]:
        """``packed`` ``ids`` of many segments. Those with as many symbols left are rows of one
        matrix; in each round they merge their best pair, the leftmost among equals, and so have one
        symbol less. Rows with characters that are no piece, or where different pieces of one
        rank are best, are taken one by one."""
        out, by = {}, defaultdict(list)
        for segment in segments:
            by[len(segment) if self.whole and len(segment) <= SHORT else 0].append(segment)
        out.update((s, packed(self.ids(s))) for s in by.pop(0, ()))
        if not by:
            return out
        symbols, ids, tied, _, _ = self.pairs
        none, width = len(ids) - 1, max(by)
        names, part = np.empty(0, object), np.empty((0, width), np.int32)
        best = part  # what each symbol spells with the one behind it
        for width in range(width, 0, -1):
            if width in by:
                fresh = symbols[np.frombuffer("".join(by[width]).encode("utf-32-le"), np.uint32)].reshape(-1, width)
                names = np.append(names, np.array(by[width], object))
                part = np.concatenate([part, fresh])
                last = np.full((len(fresh), 1), none, np.int32)
                best = np.concatenate([best, np.append(self.pair(fresh[:, :-1], fresh[:, 1:]), last, 1)])
            at = best.argmin(1)
            found = best[np.arange(len(at)), at]
            going = (found < none) & ~tied[found]
            over, ended = names[~going], part[~going]
            out.update(zip(over.tolist(), ids[ended].view(f"V{4 * width}").ravel().tolist()))
            for name in over[(ended == none).any(1) | (found[~going] < none)].tolist():
                out[name] = packed(self.ids(name))
            names, part, best, at = names[going], part[going], best[going], at[going]
            rows = np.arange(len(at))
            part[rows, at] = found[going]
            part, best = without(part, at + 1), without(best, at)
            for first in (at, at - 1):
                i = np.flatnonzero((first >= 0) & (first < width - 2))
                best[i, first[i]] = self.pair(part[i, first[i]], part[i, first[i] + 1])
        return out

    def segments(self, text: str) -> list[str]:
        return self.segment.findall(MARK + text.replace(" ", MARK)) if text else []

    def check(self, new: dict[str, bytes]) -> None:
        """Compare with the library; the mark in front is the one that it adds itself. What
        has no mark in front is given to it behind the wall."""
        # of a lone mark the library, given no text, makes nothing
        names = [n for n in new if n != MARK]
        ours = [packed(new[n]) if n[0] == MARK else self.front + packed(new[n]) for n in names]
        found = self.library.encode([n[1:] if n[0] == MARK else self.wall + n for n in names], num_threads=1)
        if [len(x) for x in ours] != [4 * len(x) for x in found] or b"".join(ours) != packed(chain.from_iterable(found)):
            name, x, y = next(z for z in zip(names, ours, found) if z[1] != packed(z[2]))
            raise ValueError(f"encoding of {name!r} is {[*array('i', x)]}, the library has {y}")


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoded(dict):
    """Segment to its ids, ``packed``; what was used before the last clearing is still at hand."""

    def __init__(self, words: Vocabulary):
        super().__init__()
        self.words, self.new, self.older, self.long, self.characters = words, {}, {}, [], 0

    def __getitem__(self, segment: str) -> tuple[int, ...]:
        self.add([segment])
        return tuple(array("i", self.get(segment)))

    def add(self, segments: Iterable[str]) -> None:
        """Encode those that are new, together."""
        absent, older = set(filterfalse(self.__contains__, segments)), self.older
        found = {s: older.pop(s) for s in absent if s in older}
        new = self.words.ids_of([s for s in absent if s not in found])
        for some in (found, new):
            self.update(some)
            self.characters += sum(map(len, some))
        self.new.update(new)
        self.long += (s for s in new if len(s) > LONGEST)

    def settle(self) -> None:
        """Check what is new, and keep the table bounded."""
        if self.new:
            self.words.check(self.new)
            self.new = {}
        for segment in self.long:
            self.characters -= len(segment)
            del self[segment]
        self.long = []
        if len(self) > KEPT or self.characters > CHARACTERS:
            self.older = dict(self)
            self.clear()
            self.characters = 0


@lru_cache(maxsize=4)
def encoded(path: str) -> Encoded:
    return Encoded(vocabulary(path))


def together(texts: list[str]) -> Iterator[list[str]]:
    """The texts in their order, in lists of about ``TOGETHER`` characters."""
    start = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > TOGETHER:
            yield texts[start:k]
            start, size = k, 0
        size += len(text)
    yield texts[start:]


def encode_texts(path: str, texts: list[str | None], end: bool = True) -> list[list[int]]:
    """The ids of the whole texts, an end id last."""
    known, out = encoded(path), []
    last = packed([known.words.end] if end else [])
    for some in together([t or "" for t in texts]):
        segments = [known.words.segments(t) for t in some]
        known.add(chain.from_iterable(segments))
        out.extend(array("i", b"".join([*map(known.get, s), last])).tolist() for s in segments)
    return out


OUT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
    T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.StringType())])
DIGEST = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])


def _run(path: str, digest: bool, end: bool):
    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def rows(piece: pa.RecordBatch) -> pa.RecordBatch:
        words = vocabulary(path)
        ids = encode_texts(path, piece.column(1).to_pylist(), end)
        encoded(path).settle()
        texts = [words.library.decode(i) for i in ids]
        counts = [len(i) for i in ids]
        schema = digest_schema if digest else out_schema
        columns = [counts, [sha(" ".join(map(words.decimal, i))) for i in ids], [sha(t) for t in texts]] \
            if digest else [ids, counts, texts]
        return pa.RecordBatch.from_arrays(
            [piece.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:]))], schema=schema)

    out_schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("decoded", pa.string())])
    digest_schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                               ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    yield rows(batch.slice(at, ROWS))
        finally:
            encoded.cache_clear()
            pa.default_memory_pool().release_unused()
    return run


def encode_decode(docs: DataFrame, path: str, end: bool = True) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded) of every row of ``docs`` (doc_id, text).

    ``ids``: numbers, the end id last if ``end``; ``decoded``: the
    text that the library decodes from them. A null text counts as empty, so its only id
    is the end id. Rows are treated alone: repeated rows, null ids and further columns
    change nothing, and an empty table gives an empty result.
    """
    return tidy(docs, doc_id="long", text="string").mapInArrow(_run(path, False, end), OUT)


def digests(docs: DataFrame, path: str, end: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ``encode_decode`` without its long columns."""
    return tidy(docs, doc_id="long", text="string").mapInArrow(_run(path, True, end), DIGEST)


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op2_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents").select(F.col("doc_id"), F.col("text")), piece_model())
