import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadwarden.llm import token_blocks

PATH = token_blocks.default_tokenizer()


@pytest.fixture(scope="module")
def encoder():
    return token_blocks.WordEncoder(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=200))
def test_block_round_trip(ids):
    block = token_blocks.encode_block(np.array(ids, np.uint32))
    assert token_blocks.decode_block(memoryview(b"xx" + block), 2).tolist() == ids


def test_file_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    counts = [1, 0, 5000, 3, 2048, 1]
    ids = rng.integers(0, 3000, sum(counts)).astype(np.uint32)
    ids[::50] = 2**32 - 1
    data = token_blocks.encode_file([None, 2, 3, 3, 9, -4], counts, ids, 77)
    file = token_blocks.TokenFile(data)
    want = np.split(ids, np.cumsum(counts)[:-1])
    assert all((a == b).all() for a, b in zip(file.documents(), want))
    assert all((file.document(i) == want[i]).all() for i in range(6))
    assert file.first == 77 and len(data) < 2.5 * len(ids)
    assert list(token_blocks.TokenFile(token_blocks.encode_file([], [], ids[:0], 0)).documents()) == []


def test_words_encode_as_the_library_does(encoder):
    rng = random.Random(5)
    letters = "aAbB'sStTdD1٣²éÉéİΣσẞÅǅ\x1c\x85   \t\n.,;!?-<|>中文\U0001f642‍"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    texts += ["<|endoftext|> a", "<|ENDOFTEXT|>", "", "it's we'LL", "word " * 3000]
    for text, ids in zip(texts, encoder.encode([t.encode() for t in texts])):
        assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_documents_read_back_from_files(spark, encoder, folder):
    rows = [(5, "five"), (None, "null id"), (-3, None), (9, ""), (9, "again nine"), (2, "long text " * 4000)] + [(100 + i, f"doc {i}") for i in range(50)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id bigint, text string, start int").repartition(5)
    manifest = token_blocks.write_token_files(df, f"file://{folder}/t", lambda: token_blocks.WordEncoder(PATH), "w", 1, file_ids=300)
    got = token_blocks.read_token_files(spark, f"file://{folder}/t", manifest).collect()
    assert manifest.count() > 1 and len(got) == len(rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    sums = lambda t: zlib.crc32(np.array(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
    assert sorted((str(r.doc_id), r.ids_crc32) for r in got) == sorted((str(i), sums(t)) for i, t in rows)


def test_only_the_manifests_files_are_read(spark, encoder, folder):
    """A folder may hold files of an earlier write, or of a task that ran again."""
    write = lambda rows: token_blocks.write_token_files(
        spark.createDataFrame(rows, "doc_id bigint, text string"), f"file://{folder}/t", lambda: token_blocks.WordEncoder(PATH), "w", 1, file_ids=50)
    write([(i, f"an earlier text {i}") for i in range(300)])
    manifest = write([(i, f"later {i}") for i in range(5)])
    got = token_blocks.read_token_files(spark, f"file://{folder}/t", manifest).collect()
    assert sorted(r.doc_id for r in got) == list(range(5)) and {r.n_tokens for r in got} == {len(encoder.tokenizer.encode("later 0").ids) + 1}


def test_one_doc_id_fills_several_ranges(spark):
    rows = [(None, f"text {i} of a nameless row") for i in range(400)] + [(1, "one")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = token_blocks.tokenise(df, PATH).collect()
    assert len(got) == 401 and [r.doc_id for r in sorted(got, key=lambda r: r.start)] == [None] * 400 + [1]


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id bigint, text string").limit(0)
    assert token_blocks.tokenise(df, PATH).count() == 0
