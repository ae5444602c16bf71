import hashlib

import pytest
import sentencepiece

from alvara.llm import pieces

PATH = pieces.piece_model()
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "  a   b  ", "\t\n", "x\x00y", "▁", "a▁ ▁b",
    "naïve café \U0001f600\U0001f600 你好 अं", "<s> </s> <unk> <0x41>",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "1234567890 12.5%", " nbsp　wide", " " * 100,
    "The quick brown fox, don't!" * 50, "x" * 20_000, "ab" * 9_000 + " " * 500 + "é" * 3_000,
]


def test_rows_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = spark.createDataFrame(
        [(i, t, 1, "q") for i, t in enumerate(TEXTS)] + [(None, "a b", 1, "q"), (4, "a", 1, "q")],
        "doc_id long, text string, ids int, n_tokens string")
    rows = pieces.encode_decode(docs, PATH).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        text = "a b" if row.doc_id is None else TEXTS[row.doc_id] or ""
        ids = [*library.encode(text), library.eos_id()]
        assert row.ids == ids
        assert (row.n_tokens, row.decoded) == (len(ids), library.decode(ids))
    short = {r.doc_id: r for r in pieces.digests(docs, PATH).collect()}
    for row in rows:
        assert short[row.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, row.ids)).encode()).hexdigest()
        assert short[row.doc_id].decoded_sha256 == hashlib.sha256(row.decoded.encode()).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pieces.digests(docs, PATH).collect() == []


def test_table_stays_bounded_and_differences_stop(monkeypatch):
    known = pieces.Encoded(pieces.vocabulary(PATH))
    monkeypatch.setattr(pieces, "KEPT", 2)
    for name in ("▁a", "▁b", "▁c"):
        known[name]
    known.settle()
    assert len(known) == 0 and len(known.older) == 3 and known["▁a"] and not known.new
    known.new = {"▁a": [5]}
    with pytest.raises(ValueError, match="the library has"):
        known.settle()


def test_query(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for row in pieces.op2_sentencepiece(spark, folder).collect():
        text, = duckdb.execute(f"select text from '{folder}/documents.parquet' where doc_id = {row.doc_id}").fetchone()
        ids = [*library.encode(text or ""), library.eos_id()]
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_table_is_bounded_by_characters():
    """Unspaced texts are one segment each; they are encoded rightly and not kept."""
    import random
    import tracemalloc

    rng, path = random.Random(3), pieces.piece_model()
    known = pieces.Encoded(pieces.vocabulary(path))
    texts = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(n)) for n in [150] * 1_500 + [2_000] * 150]
    tracemalloc.start()
    for at in range(0, len(texts), 50):
        for text in texts[at:at + 50]:
            found = [i for s in known.words.segments(text) for i in known[s]]
            assert found == known.words.library.encode(text)
        known.settle()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert not any(len(s) > pieces.LONGEST for s in known) and len(known) >= 1_500
    assert held < 40 << 20


def test_table_starts_anew_beyond_its_characters(monkeypatch):
    monkeypatch.setattr(pieces, "CHARACTERS", 500)
    known = pieces.Encoded(pieces.vocabulary(pieces.piece_model()))
    for k in range(300):
        assert list(known[f"▁word{k}"]) == known.words.library.encode(f"word{k}")
        known.settle()
        assert known.characters <= 510


def changed(path, tmp_path, change):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(path, "rb").read())
    change(proto)
    (tmp_path / "changed.model").write_bytes(proto.SerializeToString())
    return str(tmp_path / "changed.model")


def as_it_is(proto):
    pass


def equal_scores(proto):
    for k, piece in enumerate(p for p in proto.pieces if p.type == 1 and len(p.piece) < 4):
        piece.score = -(k % 40)


def letter_beside_a_stop(proto):
    proto.pieces.add(piece="e.", score=0.5, type=1)


def character_that_is_no_piece(proto):
    proto.pieces.remove(next(p for p in proto.pieces if p.piece == "n"))


def no_bytes(proto):
    for piece in [p for p in proto.pieces if p.type == 6]:
        proto.pieces.remove(piece)
    proto.trainer_spec.byte_fallback = False


@pytest.mark.parametrize("change", [as_it_is, equal_scores, letter_beside_a_stop, character_that_is_no_piece, no_bytes])
def test_texts_equal_the_library_whatever_meets(change, tmp_path):
    """Letters, digits, marks, ².-like neighbours and unknown characters in any order."""
    import random

    rng, path = random.Random(7), changed(PATH, tmp_path, change)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    parts = [*"aentirhsdTñé0123 .,;:!?'\"()[]_-*/\n\t²½ªßЖ你\U0001f600\x00▁ ̈", "the", "ing", "tion", "  ", "   ", "e.", "².", "._", "__"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(1, 90))) for _ in range(3_000)]
    pieces.encoded(path).settle()
    assert pieces.encode_texts(path, texts, end=False) == library.encode(texts)
    pieces.encoded(path).settle()
    mixes = change in (letter_beside_a_stop, no_bytes)
    assert pieces.vocabulary(path).segments("one. two") == (["▁one.", "▁two"] if mixes else ["▁one", ".", "▁two"])


def test_new_segments_are_merged_together(monkeypatch):
    """Words that a batch brings, with whatever stops behind them, need no agenda each."""
    import random

    rng, words = random.Random(5), pieces.Vocabulary(PATH)
    known, single = pieces.Encoded(words), []
    monkeypatch.setattr(words, "merge", lambda s, old=words.merge: single.append(s) or old(s))
    names = {"".join(rng.choices("aeinorst", k=rng.randrange(3, 15))) for _ in range(2_000)}
    texts = [f"{n}{stop}" for n in names for stop in ("", ".", ",", "!", '")')]
    known.add(s for t in texts for s in words.segments(t))
    assert not single and len(known.new) <= len(names) + 4
    assert [[i for s in words.segments(t) for i in known[s]] for t in texts] == words.library.encode(texts)
    known.settle()


def test_differences_behind_the_wall_stop():
    known = pieces.Encoded(pieces.vocabulary(PATH))
    known["."], known["▁a"]
    known.settle()
    known.new = {"▁a": known["▁a"], ".": known["▁a"]}
    with pytest.raises(ValueError, match="encoding of '.' is"):
        known.settle()


def test_texts_together_are_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "TOGETHER", 10)
    texts = ["", "abc", "", "x" * 30, "defghij", "k" * 10, "", "l"]
    found = list(pieces.together(texts))
    assert [t for some in found for t in some] == texts
    assert all(sum(map(len, some)) <= 10 or len([t for t in some if t]) == 1 for some in found)
    assert list(pieces.together([])) == [[]]
