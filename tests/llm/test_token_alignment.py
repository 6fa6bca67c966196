import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from threadwarden.llm import token_alignment as ta

PATHS = ta.default_tokenizers()
LIBRARY = Tokenizer.from_file(PATHS[0])
LIBRARY.encode_special_tokens = True
SCHEMA = "doc_id bigint, text string, row string, codes int"


@pytest.fixture(scope="module")
def tool():
    return ta.Aligner(*PATHS)


def brute_force(tool, rows):
    """Whole texts through both libraries, every pair of overlapping byte ranges compared."""
    found = []
    for doc_id, text in rows:
        a, b = [], []
        if text:
            a = LIBRARY.encode(" " + text, add_special_tokens=False).ids
            b = tool.tool_b.encode(text)
            joined = [b"".join(x[i] for i in ids) for x, ids in ((tool.bytes_a, a), (tool.bytes_b, b))]
            if joined != [b" " + text.encode()] * 2:
                a, b = [], []
        spans = []
        for table, ids in ((tool.bytes_a, a), (tool.bytes_b, b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(own)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, begin = [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for s, e, i in own if begin < e <= end) for own in spans))
            begin = end
        links, j0 = [], 0
        for s, e, i in spans[0]:
            while j0 < len(spans[1]) and spans[1][j0][1] <= s:
                j0 += 1
            for s2, e2, j in spans[1][j0:]:
                if s2 >= e:
                    break
                links.append((i, j))
        found.append((doc_id, a, b, groups, links))
    counts = Counter(link for *_, links in found for link in links)
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    return sorted(
        (str(d), len(a), len(b), len(g), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(g).encode()).hexdigest() if a else "")
        for d, a, b, g, links in found
    )


def shown(df):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


WORDS = ["the", "Toxicité", "naïve", "中文字", "don't", "x" * 70, "\U0001f642\U0001f642", "a▁b", "<|endoftext|>", "</s>", "<0x41>",
         "слово", "　wide", "line\nbreak", "two  blanks", "tab\t", "12345", "...", " ", "é", "\x00", " ", ""]


def sample(n, longest, seed, words=WORDS):
    rng = random.Random(seed)
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(longest))) for _ in range(n)]


@pytest.mark.parametrize("size,fan_in,head", [(1 << 15, 16, 1 << 18), (64, 2, 5), (16, 3, 1 << 18)])
def test_results_are_the_brute_force_ones(spark, tool, size, fan_in, head):
    """Whole texts, and texts cut into tiny ranges whose fragments a deep tree composes."""
    plain = [w for w in WORDS if "▁" not in w]
    texts = sample(40, 12, 1) + sample(30, 60, 2, plain) + [None, "", " ", "  x", "y" * 500, "中" * 300 + " z", " ".join(["dog"] * 400), "same", "same"]
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "r", 0) for i, t in rows], SCHEMA).repartition(4)
    got = ta.align_documents(df, *PATHS, range_bytes=size, fan_in=fan_in, head=head)
    assert shown(got) == brute_force(tool, rows)


def test_empty_table(spark):
    assert ta.align_documents(spark.createDataFrame([], SCHEMA), *PATHS).count() == 0


def test_ids_are_those_of_the_library(tool):
    letters = "aAbB'sStTdD1٣²éÉéİΣσẞ\x1c\x85\u00a0\u2028\u3000   \t\n\r.,;!?-<|>中文\U0001f642\u200d"
    rng = random.Random(9)
    texts = sample(400, 30, 3) + ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(2000)]
    for text in texts:
        assert tool.encode_a(" " + text) == LIBRARY.encode(" " + text, add_special_tokens=False).ids, repr(text)


def test_no_token_spans_a_safe_blank(tool):
    for text in sample(300, 30, 3):
        data = b" " + text.encode()
        places = [i for i in range(len(data)) if data[i : i + 1] == b" " and ta._is_safe(data, i)]
        parts = [data[i + 1 : j].decode() for i, j in zip([0, *places], [*places, len(data)])]
        assert [i for p in parts for i in tool.encode_a(" " + p)] == tool.encode_a(" " + text)
        if text:
            assert [i for p in parts for i in tool.tool_b.encode(p)] == tool.tool_b.encode(text)


def test_ranges_cover_a_text_and_have_near_safe_places():
    for text in sample(60, 80, 4) + ["q" * 300, " " * 300, "é " * 200]:
        data = b" " + text.encode()
        ranges = list(ta.cut_ranges(data, 50))
        assert ranges[0][0] == 0 and ranges[-1][1] == len(data)
        assert all(x[1] == y[0] for x, y in zip(ranges, ranges[1:]))
        for begin, end, low, high in ranges:
            assert low <= begin and end <= high
            assert all(p in (0, len(data)) or ta._is_safe(data, p) for p in (low, high))


ends = st.lists(st.integers(1, 60), max_size=30, unique=True).map(sorted)


@settings(max_examples=200, deadline=None)
@given(ends, ends, st.lists(st.integers(1, 59), max_size=5, unique=True).map(sorted), st.randoms())
def test_composition_is_associative(a_ends, b_ends, borders, rng):
    """However neighbouring ranges are composed, the groups are those of the whole."""
    a_ends, b_ends = sorted({*a_ends, 60}), sorted({*b_ends, 60})
    tokens = ta.Tokens(*map(np.array, (range(len(a_ends)), a_ends, range(len(b_ends)), b_ends)))
    whole, closed = ta.fragment(tokens, True, 100)
    parts, groups = [], []
    for begin, end in zip([0, *borders], [*borders, 60]):
        own, c = ta.fragment(tokens.between(begin, end), begin == 0, 100)
        parts.append(own)
        groups.append(c)
    while len(parts) > 1:
        i = rng.randrange(len(parts) - 1)
        both, c = ta.compose(parts[i], parts[i + 1], 100)
        parts[i : i + 2] = [both]
        groups.append(c)
    ordered = sorted((c for c in groups if c.text), key=lambda c: c.at)
    assert ";".join(c.text for c in ordered) == closed.text and sum(c.n_groups for c in groups) == closed.n_groups
    assert sorted(x for c in groups for x in c.codes) == sorted(closed.codes)
    assert parts[0].prefix.pack() == whole.prefix.pack() and parts[0].suffix.pack() == whole.suffix.pack() and parts[0].cut == whole.cut
