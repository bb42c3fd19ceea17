import random
import time

import public_tokenizers
import pytest
import tiktoken

from logweir.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    with open(PATH, "rb") as file:
        return bpe.Coder(file.read(), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = bpe.ranks_of(file.read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(2)
    letters = "abcdeghilmnoprstu"
    yield from ["", " ", "aaaa aaaab  \n\n x", "a" * 999, "ab" * 700, "\x1c\x1d a\x85b\xa0c", "日本語 😀😀 l'été I'll it's", "<|endoftext|>", "١٢٣ ²½ 12345", "x" * 65, "-" * 300]
    for n in (5, 30, 64, 65, 400):
        yield "".join(rng.choice(letters) for _ in range(n))
    yield " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(3000))


def test_ids_equal_the_library_and_decode_back(coder, library):
    given = list(texts())
    ids, decoded = coder.encode(given)
    assert ids.to_pylist() == [library.encode_ordinary(t) for t in given]
    assert decoded.to_pylist() == [t.encode() for t in given]
    assert coder.decode(ids) == [t.encode() for t in given]


def test_every_token_encodes_to_itself(coder):
    # What contracting all places of the smallest rank at once rests on.
    rows = coder.db.sql("SELECT id, plain FROM vocabulary").fetchall()
    raw = [plain.encode("latin-1") for _, plain in rows]
    own = coder._contract(raw, bpe._SHORT).to_pylist()
    assert all(own[i] == [rows[i][0]] for i in range(len(raw)) if len(raw[i]) <= bpe.SHORT)
    assert coder._contract(raw, bpe._LONG).to_pylist() == [[r[0]] for r in rows]


def test_long_words_equal_the_library(coder, library):
    rng = random.Random(5)
    given = ["".join(rng.choice(alphabet) for _ in range(n)) for alphabet in ("ab", "aab", "etaoin", "abcdefghijklmnopqrstuvwxyz", "日本語的é", "=-") for n in (65, 96, 97, 1000, 5000)]
    given += ["b" + "a" * n for n in (64, 999, 5000)] + ["ab" * 3000, "abc" * 999, "x" + "ing" * 700, " " * 3001, "\n" * 777, "é" * 501]
    ids, decoded = coder.encode(given)
    assert ids.to_pylist() == [library.encode_ordinary(t) for t in given]
    assert decoded.to_pylist() == [t.encode() for t in given]


def test_a_word_of_100_000_letters_takes_seconds(coder, library):
    word = "".join(random.Random(6).choices("abcdefghijklmnopqrstuvwxyz", k=100_000))
    start = time.monotonic()
    ids, decoded = coder.encode([word])
    assert time.monotonic() - start < 60
    assert ids.to_pylist() == [library.encode_ordinary(word)] and decoded.to_pylist() == [word.encode()]


def test_forgotten_words_are_learned_again(coder, monkeypatch):
    monkeypatch.setattr(coder, "kept_words", 3)
    first = coder.encode(["one two three four five six"])[0].to_pylist()
    for _ in range(3):
        assert coder.encode(["one two three four five six"])[0].to_pylist() == first
        coder.encode(["other words come between these"])


def test_odd_rows_round_trip(odd_documents, no_documents, library):
    rows = bpe.encode(odd_documents, PATH, public_tokenizers.PATTERN).collect()
    want = sorted(((r["doc_id"], library.encode_ordinary(r["text"] or "")) for r in odd_documents.collect()), key=repr)
    assert sorted(((r["id"], list(r["ids"])) for r in rows), key=repr) == want
    assert bpe.encode(no_documents, PATH, public_tokenizers.PATTERN).count() == 0
    coded = bpe.encode(odd_documents, PATH, public_tokenizers.PATTERN)
    back = bpe.decode(coded, PATH, public_tokenizers.PATTERN).collect()
    assert sorted((bytes(r["decoded"]) for r in back)) == sorted((r["text"] or "").encode() for r in odd_documents.collect())
