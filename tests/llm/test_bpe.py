"""Trie encoding against the tokenizers library."""

from __future__ import annotations

import random

import numpy as np
import pytest

from facetmill.llm import bpe

TEXTS = [None, "", " \t\n", "it's  don't I'LL we've x", "x<|endoftext|>y <|startoftext|><|endoftext|>  <|endof", "<|ENDOFTEXT|> a-b1c", "été,é", "́x á.", "日本語 テキスト。", "\U0001f600\U0001f600 \x1c\x85  z", "a" * 3000, "!" * 500, "ha" * 400 + "," * 99, "naïve—, “quoted”…", "\x00\x01 ok\x7f"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.tokenizer_path())


def _random_texts(n):
    pick = random.Random(11)
    ranges = [(33, 127), (33, 127), (97, 123), (97, 123), (0xA0, 0x250), (0x300, 0x370), (0x4E00, 0x4F00), (0x1F300, 0x1F600)]
    for _ in range(n):
        low, high = pick.choice(ranges)
        yield "".join(chr(pick.randrange(low, high)) if pick.random() < 0.85 else pick.choice(" \n'.,e") for _ in range(pick.randrange(1, 60)))


def test_ids_and_decoded_texts_equal_the_librarys(spark, library):
    texts = TEXTS + list(_random_texts(1500))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = bpe.decode(bpe.encode(docs, keep=["doc_id"])).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["ids"] == ids, texts[row["doc_id"]]
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_every_token_of_the_file_is_reached(library):
    """What a merge makes is encoded as that token, so every token pair was judged right."""
    words = [t.removesuffix("</w>") for t in library.get_vocab() if t.endswith("</w>")]
    encoder = bpe.encoder(bpe.tokenizer_path())
    own = encoder.vocabulary.encode(words)
    expected = [x.ids for x in bpe_model(library).encode_batch([[w] for w in words], is_pretokenized=True)]
    assert [np.frombuffer(own[w], "<i4").tolist() for w in words] == expected


def bpe_model(library):
    from tokenizers import Tokenizer

    return Tokenizer(library.model)


def test_words_kept_and_forgotten_give_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 200)
    encoder = bpe.Encoder(bpe.tokenizer_path())
    texts = list(_random_texts(400))
    for k in range(0, len(texts), 20):
        part = texts[k : k + 20]
        own = encoder.encode([t.encode() for t in part])
        assert [x.tolist() for x in own] == [x.ids for x in library.encode_batch(part, add_special_tokens=False)]


def test_unknown_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, [320, 99999999, -1, 49407]), (2, []), (3, None)], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in bpe.decode(rows).orderBy("doc_id").collect()] == ["a</w> <|endoftext|>", "", ""]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Encoder(bpe.tokenizer_path("byte_bpe_50k.json"))
