import hashlib
import random

import pytest
from sentencepiece import SentencePieceProcessor

from ledgerline.llm import piece_bpe
from tests.llm.helpers import EDGE, documents, edge_docs, empty_docs, texts

ODD = ["", " ", "  ", "\n", " \n ", "\ta b", "a  b   c    d" + " " * 37 + "e", " " * 3000 + "x" + " " * 17, "▁x▁ ▁▁y", "\r\nline\r\n",
       "<s>a</s><unk><0x41>", "é éte ﬁ", "🙂🙂 \U0001F1E6x ͸", "\x00 \x7f\x80", "你好世界" * 40, "a" * 5000 + " " + "ab" * 3000,
       "http://example.com/a/b?c=d&e=f#" + "x1y2" * 90]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=piece_bpe.default_path())


def want(library, text):
    ids = library.encode(text or "")
    return len(ids), ",".join(map(str, ids)), library.decode(ids)


def test_equal_to_the_library_on_odd_texts(library):
    bpe = piece_bpe.piece_bpe(None)
    rng = random.Random(1)
    odd = ODD + ["".join(rng.choice("aAbBeEtTs  ▁\n\t.,'éß12你🙂́thein") for _ in range(rng.randint(1, 60))) for _ in range(4000)]
    odd += ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 400))) for _ in range(300)]
    odd += ["".join(rng.choice(bpe.piece[300:]) for _ in range(12)) for _ in range(2000)]
    for t, got in zip(odd, zip(*bpe.both(odd))):
        assert got == want(library, t), t


def test_rounds_and_the_heap_merge_alike(monkeypatch):
    bpe = piece_bpe.piece_bpe(None)
    rng = random.Random(2)
    words = ["▁" * rng.randint(0, 40) + "".join(rng.choice("etaoinshr") for _ in range(rng.randint(1, 300))) for _ in range(300)]
    by_rounds = bpe.learn(words)
    monkeypatch.setattr(piece_bpe, "LONG_SEGMENT", 1)
    assert bpe.learn(words) == by_rounds


def test_a_merge_that_makes_a_better_pair_goes_first():
    """ab, ab, ... is not merged everywhere at once where 'aba' ranks before 'ab'."""
    bpe = object.__new__(piece_bpe.PieceBpe)
    a, b, ab, aba = 0, 1, 2, 3
    bpe.pairs = {a << 32 | b: (5, ab), ab << 32 | a: (1, aba)}
    bpe.none, bpe.size = 2, 4
    import numpy as np
    bpe.pair_keys = np.array([*sorted(bpe.pairs), 1 << 62])
    bpe.pair_ranks = np.array([5, 1, piece_bpe.NO_RANK], np.int32)
    bpe.pair_merged = np.array([ab, aba, -1], np.int32)
    symbols = np.array([a, b, a, b, a, b, a], np.int32)
    place, merged = bpe.merge_segments(symbols, np.arange(7) == 0)
    assert (place.tolist(), merged.tolist()) == ([0, 3, 4], [aba, b, aba])
    assert [x.tolist() for x in bpe._merge_long(symbols.tolist(), 0)] == [[0, 3, 4], [aba, b, aba]]


def test_bytes_that_are_no_text(library):
    bpe = piece_bpe.piece_bpe(None)
    for raw in (b"\xff", b"a\xc3", b"\xe4\xbd", b"\xf0\x9f\x99\x82\x80x"):
        ids = [261, *(bpe.byte_id[x] for x in raw), 262]
        assert bpe.decode(ids) == library.decode(ids)


@pytest.mark.parametrize("edge", [True, False])
def test_documents_against_the_library(spark, library, edge):
    rows = EDGE if edge else texts(spark)
    encoded = piece_bpe.encode_documents(edge_docs(spark) if edge else documents(spark))
    key = lambda r: tuple(str(x) for x in r)
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids"], r["decoded"]) for r in encoded.collect()), key=key)
    assert got == sorted(((i, *want(library, t)) for i, t in rows), key=key)
    if not edge:
        digests = {r["doc_id"]: (r["ids_sha256"], r["decoded_sha256"]) for r in piece_bpe.digests(encoded).collect()}
        i, t = rows[0]
        assert digests[i] == tuple(hashlib.sha256(x.encode()).hexdigest() for x in want(library, t)[1:])


def test_an_empty_table(spark):
    assert piece_bpe.encode_documents(empty_docs(spark)).count() == 0
