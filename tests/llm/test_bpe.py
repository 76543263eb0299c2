import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm import bpe, lexicon, queries

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [*"ab '’sStTrRvVeEmMlLdD19 \t\n\r.,!<|>_-", "é", "É", "Σ", "ß", "İ", "Ɓ", "́", " ", "\xa0", "\x85", "\x1c", "中", "😀", "՘",
       "ᲊ", "\U000107bb", "ﬁ", "<|endoftext|>", "<|startoftext|>", "don't", "'RE", "½", "Ⅷ", "‍", "ǅ", "Å", "각", "ガ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder(tmp_path_factory):
    vocab = bpe.Vocabulary(PATH)
    merge = bpe.Merger(vocab.inner, vocab.last, vocab.merges)
    words = sorted({w.encode() for w in ("the", "there", "then", "been", "ab", "é", "don", "'", "!!", "a")})
    ids = [merge.ids(w) for w in words]
    sections = vocab.sections() | lexicon.minimal_automaton(words) | {
        "offsets": np.cumsum([0, *map(len, ids)]).astype(np.uint32), "ids": np.array([i for own in ids for i in own], "<u4")}
    path = tmp_path_factory.mktemp("lexicon") / "l.bin"
    path.write_bytes(lexicon.pack(sections))
    return bpe.Coder(lexicon.mapped(str(path)))


def test_automaton_numbers_words_and_shares_endings():
    words = sorted({f"{a}{b}ing".encode() for a in "abcdef" for b in "xyz"} | {b"a", b"ab", "é".encode()})
    arrays = lexicon.minimal_automaton(words)
    assert lexicon.lookup(arrays, words).tolist() == list(range(len(words)))
    assert lexicon.lookup(arrays, [b"", b"axin", b"axings", b"q"]).tolist() == [-1] * 4
    assert len(arrays["final"]) < 20
    assert lexicon.lookup(lexicon.minimal_automaton([]), [b"a"]).tolist() == [-1]


def test_encoding_equals_the_library(coder, library):
    r = random.Random(3)
    for _ in range(3000):
        text = "".join(r.choices(ODD, k=r.randint(0, 14)))
        assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    long = "ab" * 3000 + "the" * 2000 + " " + "x1" * 500
    assert np.frombuffer(coder.encode(long), "<u4").tolist() == library.encode(long, add_special_tokens=False).ids


def test_settled_letters_agree_with_the_library(coder, library):
    blocks = [*range(0x20, 0x530), *range(0x2000, 0x2070), *range(0x3040, 0x3100), *range(0x4E00, 0x4E80), *range(0x1F300, 0x1F380)]
    text = "\n".join(f"a{chr(c)}1A" for c in blocks)
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_small_cache_and_chunks_change_nothing(coder, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    monkeypatch.setattr(bpe, "CHUNK", 10)
    texts = ["one two three four five six seven eight", "", "the then there been, don't", "nine ten " * 20]
    got = coder.encode_batch([t.encode() for t in texts]).to_pylist()
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_query_on_odd_rows(spark, library):
    import hashlib
    rows = [(1, "The cat sat. <|endoftext|> Été!", "x"), (2, None, None), (3, "", "x"), (3, "", "x"), (4, "zz " * 4000, "ids")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    name = bpe.lexicon_of(docs, PATH)
    got = queries.digests(docs.select("doc_id", "text"), name).collect()
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert bpe.encode(docs, name).count() == len(rows)
    apart = bpe.decode(bpe.encode(docs, name, out="ids"), name)
    assert sorted((r.doc_id, len(r.ids), r.decoded) for r in apart.collect()) == sorted(
        (i, n, library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False))
        for (i, t, _), (_, n, *_) in zip(rows, want))
    none = spark.createDataFrame([], docs.schema)
    assert queries.digests(none.select("doc_id", "text"), bpe.lexicon_of(none, PATH)).count() == 0


def test_slices_change_nothing(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(bpe, "SLICE", 10)
    texts = pa.array(["", None, "abc", "abcdefgh", "x" * 25, "a", None])
    assert list(bpe._slices(texts)) == [(0, 3), (3, 4), (4, 5), (5, 7)]
    assert list(bpe._slices(texts.slice(0, 0))) == []
    assert list(bpe._slices(pa.array(["", None]))) == [(0, 2)]


def test_word_counts_cover_all_texts(spark):
    docs = spark.createDataFrame([(i, "the cat the") for i in range(50)], "doc_id long, text string")
    assert {r.word: r.n for r in bpe.frequent_words(docs).collect()} == {"the": 100, "cat": 50}
