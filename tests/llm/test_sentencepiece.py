import random

import numpy as np
import pytest
import sentencepiece

from threadwarden.llm import sentencepiece_viterbi as sv

PATH = sv.default_model()


def texts():
    rng = random.Random(2)
    letters = "aabcdeeénin the and hering    \n\t▁中文🙂́\x00<0x0A>''"
    made = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(4000)]
    return made + ["", " ", "▁", "a" * 70, " " * 70, "ha" * 400, "x" * 3000, "word " * 2000, "\n\n \n"]


@pytest.fixture(scope="module")
def codec():
    return sv.Codec(PATH)


def test_ids_equal_the_library(codec):
    made = texts()
    want = sentencepiece.SentencePieceProcessor(model_file=PATH).encode(made, num_threads=1)
    for text, got, ids in zip(made, codec.encode(made), want):
        assert got.tolist() == ids, repr(text)


def test_unigram_search_finds_the_best_sum(codec):
    """The same pieces as a unigram model: the library's own search gives the best sum of scores."""
    data = open(PATH, "rb").read()
    proto = sentencepiece.SentencePieceProcessor(model_file=PATH)
    model = sv.Model(PATH)
    model.type = sv.UNIGRAM
    words = ["▁" + "".join(random.Random(i).choice("therinasou") for _ in range(7)) for i in range(300)]
    assert data and proto.get_piece_size() == len(model.score)
    scores = {proto.id_to_piece(i): model.score[i] for i in range(259, len(model.score))}

    def best(word):
        sums = [0.0] + [-np.inf] * len(word)
        for end in range(1, len(word) + 1):
            sums[end] = max(sums[s] + scores[word[s:end]] for s in range(end) if word[s:end] in scores)
        return sums[-1]

    for word, ids in zip(words, model.search(words)):
        assert "".join(proto.id_to_piece(i) for i in ids) == word
        assert sum(model.score[ids]) == best(word)


def test_round_trip(codec):
    for text in texts():
        assert codec.decode(codec.encode([text])[0]) == text.replace("▁", " ")


def test_a_full_table_is_emptied(codec, monkeypatch):
    monkeypatch.setattr(codec, "MAX_WORDS", 5)
    made = texts()[:300]
    want = sentencepiece.SentencePieceProcessor(model_file=PATH).encode(made, num_threads=1)
    assert [codec.encode([t])[0].tolist() for t in made] == want


def test_documents(spark):
    rows = [(1, "Some text"), (1, "Some text"), (None, None), (2, ""), (3, "▁"), (4, "long words " * 5000)]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id bigint, text string, _text2 string, n_tokens int")
    got = sv.encode_documents(df, PATH).collect()
    assert [(r.doc_id, r.n_tokens > 0, r.round_trip) for r in got] == [
        (1, True, True), (1, True, True), (None, False, True), (2, False, True), (3, True, False), (4, True, True)
    ]
    assert sv.digests(sv.encode_documents(df, PATH)).columns == ["doc_id", "n_tokens", "round_trip", "ids_crc32"]
    assert sv.encode_documents(df.limit(0), PATH).count() == 0
