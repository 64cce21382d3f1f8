import hashlib
import random

import pytest
from tokenizers import Tokenizer

from ledgerline.llm import word_bpe
from tests.llm.helpers import EDGE, documents, edge_docs, empty_docs, texts

ODD = ["", "  ", "İstanbul ΣΑΣ ΟΔΟΣ", "a\x1cb \x1c c", "x<|endoftext|>y z<|startoftext|>", "e\u0301 éte", "don't I'LL 123 ½ ², 你好 世界",
       "\xa0a\x85b", "ſŉ ǅ", "a" * 5000 + " " + "ab" * 3000, "🙂🙂 \U0001F1E6x \u0378", "\x00 \x7f\x80", "<|EndOfText|> <|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(word_bpe.default_path())
    t.no_truncation()
    t.no_padding()
    return t


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)


def test_equal_to_the_library_on_odd_texts(library):
    bpe = word_bpe.word_bpe(None)
    rng = random.Random(1)
    odd = ODD + ["".join(rng.choice("aAbBéÉßſİΣσς'’sS 12½\n\t\xa0\u0301ͅ你🙂<|endoftext|>\u0600ǅ") for _ in range(40)) for _ in range(3000)]
    assert list(zip(*bpe.both(odd))) == [want(library, t) for t in odd]


def test_short_and_long_words_merge_alike(monkeypatch):
    bpe = word_bpe.word_bpe(None)
    rng = random.Random(2)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 60))).encode() for _ in range(300)]
    short = bpe.learn(words)
    monkeypatch.setattr(word_bpe, "LONG_WORD", 1)
    assert bpe.learn(words) == short


@pytest.mark.parametrize("edge", [True, False])
def test_documents_against_the_library(spark, library, edge):
    rows = EDGE if edge else texts(spark)
    encoded = word_bpe.encode_documents(edge_docs(spark) if edge else documents(spark))
    key = lambda r: tuple(str(x) for x in r)
    got = sorted(((r["doc_id"], r["n_tokens"], r["ids"], r["decoded"]) for r in encoded.collect()), key=key)
    assert got == sorted(((i, *want(library, t)) for i, t in rows), key=key)
    if not edge:
        digests = {r["doc_id"]: (r["ids_sha256"], r["decoded_sha256"]) for r in word_bpe.digests(encoded).collect()}
        i, t = rows[0]
        assert digests[i] == tuple(hashlib.sha256(x.encode()).hexdigest() for x in want(library, t)[1:])


def test_an_empty_table(spark):
    assert word_bpe.encode_documents(empty_docs(spark)).count() == 0


def test_a_worker_keeps_the_tables_of_one_operator_only():
    from ledgerline.llm import piece_bpe, words
    words.word_hashes.of([b"a", b"b"])
    assert len(words.word_hashes) == 2
    kept = word_bpe.word_bpe(None)
    assert not words.word_hashes and word_bpe.word_bpe(None) is kept
    piece_bpe.piece_bpe(None)
    assert not word_bpe._made
    words.word_hashes.of([b"a"])
    assert not piece_bpe._made and len(words.word_hashes) == 1
