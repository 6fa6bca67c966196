"""Alignment of two tokenizers over a corpus: an associative monoid of fragments.

The tokens of both tokenizers cover the same bytes. Where a token of each ends at the same
byte the text is cut into groups. A byte range of a document yields a fragment: the tokens up
to its first cut (open prefix), the groups between its cuts (closed), and the tokens after its
last cut (open suffix). Two neighbouring fragments compose: the suffix of one and the prefix
of the other close a group. Composition is associative, so the byte ranges of a very long
document are tokenised and cut by different tasks and composed as a tree.

A single blank between two other characters that are not white space is a place that no token
of either tokenizer spans, so a range is tokenised by itself: it only needs the text between
the nearest such places around it.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwarden.llm.common import slices_by_bytes, utf8, worker_store
from threadwarden.sources.staging import stage

# Texts of more bytes are cut into ranges of so many bytes, one task's work each.
RANGE_BYTES = 1 << 15
# Fragments that one step of the tree composes.
FAN_IN = 16
# Counts of the most frequent pairs, at most so many, go to every task; the rest are joined.
HEAD_PAIRS = 1 << 18
# Distinct pairs that a task counts before it hands them on.
COUNTED_PAIRS = 1 << 20
# Bytes of text, and rows, that a task works on at a time.
SLICE_BYTES, SLICE_ROWS = 1 << 20, 1_000

_PIECE = "n_a bigint, n_b bigint, n_groups bigint, valid boolean, codes binary, times binary"
_SHORT_SCHEMA = f"doc_id bigint, row bigint, groups_sha256 string, {_PIECE}"
_TOKENS = "struct<a:binary,a_ends:binary,b:binary,b_ends:binary>"
_FRAGMENT_SCHEMA = f"row bigint, part bigint, at bigint, body binary, cut boolean, prefix {_TOKENS}, suffix {_TOKENS}, {_PIECE}"


# ---- the monoid ----


def _no_numbers() -> np.ndarray:
    return np.empty(0, np.int64)


@dataclass
class Tokens:
    """Neighbouring tokens of both tokenizers: ids and the byte offsets at which they end."""

    a: np.ndarray = field(default_factory=_no_numbers)
    a_ends: np.ndarray = field(default_factory=_no_numbers)
    b: np.ndarray = field(default_factory=_no_numbers)
    b_ends: np.ndarray = field(default_factory=_no_numbers)

    def __add__(self, other: Tokens) -> Tokens:
        return Tokens(*[np.concatenate([getattr(self, k), getattr(other, k)]) for k in TOKENS])

    def between(self, begin: float, end: float) -> Tokens:
        """Those that end after ``begin``, at ``end`` at the latest."""
        i, j = np.searchsorted(self.a_ends, [begin, end], "right")
        k, n = np.searchsorted(self.b_ends, [begin, end], "right")
        return Tokens(self.a[i:j], self.a_ends[i:j], self.b[k:n], self.b_ends[k:n])

    def pack(self) -> dict[str, bytes]:
        return {k: getattr(self, k).astype("<i8").tobytes() for k in TOKENS}

    @staticmethod
    def unpack(cells: dict[str, bytes]) -> Tokens:
        return Tokens(*[np.frombuffer(cells[k], "<i8") for k in TOKENS])


TOKENS = ("a", "a_ends", "b", "b_ends")


@dataclass
class Closed:
    """Closed groups one after the other: their text, their links as codes, the end of the first group."""

    text: str = ""
    codes: np.ndarray = field(default_factory=_no_numbers)
    at: int | None = None
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0


@dataclass
class Fragment:
    """A byte range: ``prefix`` up to its first cut and ``suffix`` after its last; without a cut all is prefix."""

    prefix: Tokens
    suffix: Tokens
    cut: bool
    valid: bool = True


@functools.cache
def _shown(bits: int, mark: str) -> np.ndarray:
    """Decimal numbers of so many bits, each with ``mark`` behind it."""
    return np.array([f"{i}{mark}" for i in range(1 << bits)], object)


def _with_marks(ids: np.ndarray, last: np.ndarray, mark: str) -> np.ndarray:
    bits = int(ids.max(initial=0)).bit_length()
    return np.where(last, _shown(bits, mark)[ids], _shown(bits, ",")[ids])


def links(tokens: Tokens, b_size: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends and codes of all links; a link's code is a's id * ``b_size`` + b's id.

    Between two neighbouring token ends of either kind lies one token of each, and every
    overlapping pair has one such place.
    """
    # two sorted runs are merged
    ends = np.sort(np.concatenate([tokens.a_ends, tokens.b_ends]), kind="stable")
    ends = ends[np.r_[True, ends[1:] != ends[:-1]]] if len(ends) else ends
    a, b = tokens.a[np.searchsorted(tokens.a_ends, ends)], tokens.b[np.searchsorted(tokens.b_ends, ends)]
    return ends, a.astype(np.int64) * b_size + b


def group_marks(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The cuts, and the tokens' ids with their marks, group by group, A before B."""
    cuts = np.intersect1d(tokens.a_ends, tokens.b_ends, assume_unique=True)
    of_a, of_b = np.searchsorted(cuts, tokens.a_ends), np.searchsorted(cuts, tokens.b_ends)
    marked = [_with_marks(tokens.a, cuts[of_a] == tokens.a_ends, "|"), _with_marks(tokens.b, cuts[of_b] == tokens.b_ends, ";")]
    return cuts, np.concatenate(marked)[np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")]


def close(tokens: Tokens, b_size: int) -> Closed:
    """The groups of tokens that end with a cut."""
    if not len(tokens.a):
        return Closed()
    cuts, marked = group_marks(tokens)
    return Closed("".join(marked.tolist())[:-1], links(tokens, b_size)[1], int(cuts[0]), len(tokens.a), len(tokens.b), len(cuts))


def fragment(tokens: Tokens, first: bool, b_size: int) -> tuple[Fragment, Closed]:
    """The fragment of a range's tokens; a document's beginning is a cut, so its first range has no prefix."""
    cuts = np.intersect1d(tokens.a_ends, tokens.b_ends, assume_unique=True)
    if not len(cuts):
        return (Fragment(Tokens(), tokens, True) if first else Fragment(tokens, Tokens(), False)), Closed()
    begin = -1 if first else cuts[0]
    rest = tokens.between(cuts[-1], float("inf"))
    return Fragment(tokens.between(-1, begin), rest, True), close(tokens.between(begin, cuts[-1]), b_size)


def compose(left: Fragment, right: Fragment, b_size: int) -> tuple[Fragment, Closed]:
    """The fragment of two neighbouring ranges, and the group that closes between them, if any."""
    valid, nothing = left.valid and right.valid, Closed()
    if not valid:
        # no token of such a document counts
        return Fragment(Tokens(), Tokens(), left.cut or right.cut, False), nothing
    if not right.cut:
        if left.cut:
            return Fragment(left.prefix, left.suffix + right.prefix, True), nothing
        return Fragment(left.prefix + right.prefix, Tokens(), False), nothing
    if not left.cut:
        return Fragment(left.prefix + right.prefix, right.suffix, True), nothing
    return Fragment(left.prefix, right.suffix, True), close(left.suffix + right.prefix, b_size)


# ---- tokenizers ----


def byte_of_character() -> dict[str, int]:
    """The characters by which a byte-level vocabulary shows bytes: printable ones stand for themselves."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + i): b for i, b in enumerate(hidden)}}


_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
# Fixed value: the pattern by which byte-level vocabularies of this kind cut a text.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Aligner:
    """Both tokenizers of a worker. A document is a blank and its text: A (``byte_level``) encodes
    that, B (``pieces``) the text, in front of which it puts a blank itself.

    A byte-level vocabulary whose merges are numbered in their order gives the same ids by ranks,
    several times faster; any other is left to its own library.
    """

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece

        self.tool_b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        with open(byte_level, encoding="utf-8") as f:
            known = json.load(f)
        model, cut = known["model"], known["pre_tokenizer"]
        bytes_of = byte_of_character()
        special = {t["content"]: t["id"] for t in known["added_tokens"]}
        vocabulary = {t: i for t, i in model["vocab"].items() if t not in special}
        self.bytes_a = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(bytes_of[c] for c in token)
        merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        plain = known["normalizer"] is None and cut == cut | {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if plain and merged == sorted(merged) and not model.get("ignore_merges"):
            import tiktoken

            ranks = {self.bytes_a[i]: i for i in vocabulary.values()}
            self.encode_a = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            tool = Tokenizer.from_file(byte_level)
            tool.encode_special_tokens = True
            self.encode_a = lambda text: tool.encode(text, add_special_tokens=False).ids
        self.bytes_b = []
        self.b_size = self.tool_b.get_piece_size()
        # with pieces across words, only whole texts are safe
        self.cuts_words = True
        for i in range(self.b_size):
            piece = self.tool_b.id_to_piece(i)
            one = _BYTE_PIECE.fullmatch(piece)
            self.bytes_b.append(bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode())
            self.cuts_words &= not re.search("[^▁]▁", piece)
        self.length_a = np.array([len(x) for x in self.bytes_a])
        self.length_b = np.array([len(x) for x in self.bytes_b])

    @property
    def links_type(self) -> str:
        return "<u4" if len(self.bytes_a) * self.b_size < 1 << 32 else "<u8"

    def encode(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of a blank and the text by A and by B; None if either does not give back its bytes."""
        a, b = self.encode_a(" " + text), self.tool_b.encode(text)
        whole = b" " + text.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            return None
        return a, b

    def tokens(self, pairs: Sequence[tuple[list[int], list[int]]], begin: int = 0) -> Tokens:
        """Tokens of texts that follow each other from byte ``begin`` on."""
        a, b = (np.fromiter(itertools.chain.from_iterable(p[k] for p in pairs), np.int64) for k in (0, 1))
        return Tokens(a, begin + np.cumsum(self.length_a[a]), b, begin + np.cumsum(self.length_b[b]))

    def whole_texts(self, texts: list[str]) -> list[tuple]:
        """Of each text, which is neither null nor empty: sha256 of its groups, counts, validity, links."""
        pairs = [self.encode(t) for t in texts]
        valid = [p for p in pairs if p is not None]
        if not valid:
            return [_NOTHING] * len(texts)
        # texts end with a cut, so all of them are aligned in one go
        tokens = self.tokens(valid)
        n_a, n_b = (np.array([len(p[k]) for p in valid]) for k in (0, 1))
        text_ends = tokens.a_ends[np.cumsum(n_a) - 1]
        cuts, marked = group_marks(tokens)
        marked = marked.tolist()
        n_groups = np.bincount(np.searchsorted(text_ends, cuts), minlength=len(valid))
        ends, codes = links(tokens, self.b_size)
        pair_space = len(self.bytes_a) * self.b_size
        keys, times = np.unique(np.searchsorted(text_ends, ends) * pair_space + codes, return_counts=True)
        bounds = np.searchsorted(keys, np.arange(len(valid) + 1) * pair_space).tolist()
        codes, times = (keys % pair_space).astype(self.links_type), times.astype("<u4")
        places = np.r_[0, np.cumsum(n_a + n_b)].tolist()
        found = iter(
            (
                hashlib.sha256("".join(marked[places[i] : places[i + 1]])[:-1].encode()).hexdigest(),
                int(n_a[i]), int(n_b[i]), int(n_groups[i]), True,
                codes[bounds[i] : bounds[i + 1]].tobytes(), times[bounds[i] : bounds[i + 1]].tobytes(),
            )
            for i in range(len(valid))
        )
        return [_NOTHING if p is None else next(found) for p in pairs]

    def range_tokens(self, context: str, begin: int) -> tuple[Tokens, bool]:
        """All tokens of a blank and ``context``, which stand from byte ``begin`` on, and their validity."""
        found = self.encode(context)
        return (Tokens(), False) if found is None else (self.tokens([found], begin), True)


_NOTHING = (None, 0, 0, 0, False, b"", b"")


def pack_links(codes: np.ndarray, kind: str) -> tuple[bytes, bytes]:
    """Distinct codes in order and how often each occurs."""
    codes, times = np.unique(codes, return_counts=True)
    return codes.astype(kind).tobytes(), times.astype("<u4").tobytes()


# ---- short texts, and ranges of long ones ----


def _binary_rows(rows: list[tuple], names: Sequence[str], types: Sequence[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], list(names))


_PIECE_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
_PIECE_NAMES = ["n_a", "n_b", "n_groups", "valid", "codes", "times"]


def align_short(docs: DataFrame, aligner: Callable[[], Aligner], name: str) -> DataFrame:
    """Documents (row, doc_id, text), each aligned by itself."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = worker_store(name, aligner)
        for batch in batches:
            ids, rows, texts = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), utf8(batch.column("text"))
            for part in slices_by_bytes(texts, SLICE_BYTES):
                full = [t.decode() for t in texts[part] if t]
                found = iter(tool.whole_texts(full) if full else [])
                out = [(d, r, *(next(found) if t else _NOTHING)) for d, r, t in zip(ids[part], rows[part], texts[part])]
                yield _binary_rows(out, ["doc_id", "row", "groups_sha256", *_PIECE_NAMES], [pa.int64(), pa.int64(), pa.string(), *_PIECE_TYPES])

    return docs.select("doc_id", "row", "text").mapInArrow(aligned, _SHORT_SCHEMA)


def _is_safe(data: bytes, at: int) -> bool:
    """Whether the blank at ``at`` stands between two characters that are not white space."""
    if at < 1 or at + 1 >= len(data):
        return False
    begin = at - 1
    while begin > 0 and data[begin] & 0xC0 == 0x80:
        begin -= 1
    end = at + 2
    while end < len(data) and data[end] & 0xC0 == 0x80:
        end += 1
    return not data[begin:at].decode().isspace() and not data[at + 1 : end].decode().isspace()


def _safe_before(data: bytes, at: int) -> int:
    """The last safe blank at ``at`` or before, else 0, the blank in front of the text."""
    found = data.rfind(b" ", 0, at + 1)
    while found > 0 and not _is_safe(data, found):
        found = data.rfind(b" ", 0, found)
    return max(found, 0)


def _safe_after(data: bytes, at: int) -> int:
    """The first safe blank at ``at`` or after, else the end."""
    found = data.find(b" ", at)
    while found >= 0 and not _is_safe(data, found):
        found = data.find(b" ", found + 1)
    return len(data) if found < 0 else found


def cut_ranges(data: bytes, size: int) -> Iterator[tuple[int, int, int, int]]:
    """Byte ranges of about ``size``: (begin, end, and the safe places around them).

    A border inside a word of more than ``size`` bytes is left out, so the safe places are
    never far.
    """
    begin, begin_safe = 0, 0
    for border in range(size, len(data), size):
        if border <= begin:
            continue
        low, high = _safe_before(data, border), _safe_after(data, border)
        if high - low > size:
            border = high
            low = high
        if border >= len(data):
            break
        yield begin, border, begin_safe, high
        begin, begin_safe = border, low
    yield begin, len(data), begin_safe, len(data)


def split_long(docs: DataFrame, size: int) -> DataFrame:
    """Documents (row, text) as ranges: (row, part, begin, end, start, context), dealt over the tasks."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "part", "begin", "end", "start", "context"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), utf8(batch.column("text"))):
                data = b" " + text
                out = []
                for part, (begin, end, low, high) in enumerate(cut_ranges(data, size)):
                    out.append((row, part, begin, end, low, data[low + 1 : high]))
                    if len(out) == 64:
                        yield _binary_rows(out, names, types)
                        out = []
                yield _binary_rows(out, names, types)

    schema = "row bigint, part bigint, begin bigint, end bigint, start bigint, context binary"
    return docs.select("row", "text").mapInArrow(split, schema).repartition("row", "part")


def _fragment_row(row: int, part: int, found: Fragment | None, closed: Closed, kind: str) -> dict:
    codes, times = pack_links(closed.codes, kind)
    return {
        "row": row, "part": part, "at": closed.at, "body": closed.text.encode() if closed.text else None,
        "cut": found and found.cut, "prefix": found and found.prefix.pack(), "suffix": found and found.suffix.pack(),
        "n_a": closed.n_a, "n_b": closed.n_b, "n_groups": closed.n_groups, "valid": found and found.valid,
        "codes": codes, "times": times,
    }


_TOKENS_TYPE = pa.struct([(k, pa.binary()) for k in ("a", "a_ends", "b", "b_ends")])
_FRAGMENT_TYPES = pa.schema([
    ("row", pa.int64()), ("part", pa.int64()), ("at", pa.int64()), ("body", pa.binary()), ("cut", pa.bool_()),
    ("prefix", _TOKENS_TYPE), ("suffix", _TOKENS_TYPE), *zip(_PIECE_NAMES, _PIECE_TYPES),
])


def align_ranges(ranges: DataFrame, aligner: Callable[[], Aligner], name: str) -> DataFrame:
    """The fragment of each range, with the groups closed inside it as a piece of its own."""

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = worker_store(name, aligner)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                tokens, valid = tool.range_tokens(r["context"].decode(), r["start"])
                found, closed = fragment(tokens.between(r["begin"], r["end"]), r["begin"] == 0, tool.b_size)
                found.valid = valid
                out.append(_fragment_row(r["row"], r["part"], found, closed, tool.links_type))
            yield from pa.Table.from_pylist(out, _FRAGMENT_TYPES).to_batches()

    return ranges.mapInArrow(aligned, _FRAGMENT_SCHEMA)


def compose_ranges(fragments: DataFrame, b_size: int, kind: str, fan_in: int) -> tuple[list[DataFrame], DataFrame]:
    """Tables of closed pieces, and one fragment per document, by a tree of compositions."""
    parts = fragments.agg(F.max("part")).first()[0]
    pieces, open_ends = [fragments.filter("body is not null")], fragments

    def composed(table: pa.Table) -> pa.Table:
        rows = table.sort_by("part").to_pylist()
        out, whole = [], None
        for r in rows:
            own = Fragment(Tokens.unpack(r["prefix"]), Tokens.unpack(r["suffix"]), r["cut"], r["valid"])
            if whole is None:
                whole = own
                continue
            whole, closed = compose(whole, own, b_size)
            if closed.text:
                out.append(_fragment_row(r["row"], r["part"], None, closed, kind))
        out.append(_fragment_row(rows[0]["row"], rows[0]["part"] // fan_in, whole, Closed(), kind))
        return pa.Table.from_pylist(out, _FRAGMENT_TYPES)

    while parts:
        narrow = open_ends.filter("cut is not null").select("row", "part", "cut", "valid", "prefix", "suffix")
        open_ends = stage(
            narrow.groupBy("row", F.expr(f"part div {fan_in}")).applyInArrow(composed, _FRAGMENT_SCHEMA), "composed"
        )
        pieces.append(open_ends.filter("body is not null"))
        parts //= fan_in
    return pieces, open_ends.filter("cut is not null").select("row", "valid")


def digest_pieces(pieces: DataFrame) -> DataFrame:
    """sha256 over the bodies of each row's pieces in order, joined by ``;``, as a stream."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tool = None, None

        def finished() -> pa.RecordBatch:
            return _binary_rows([(current, tool.hexdigest())], ["row", "groups_sha256"], [pa.int64(), pa.string()])

        for batch in batches:
            for row, body in zip(batch.column("row").to_pylist(), batch.column("body").to_pylist()):
                if row != current:
                    if tool is not None:
                        yield finished()
                    current, tool = row, hashlib.sha256(body)
                else:
                    tool.update(b";" + body)
        if tool is not None:
            yield finished()

    ordered = pieces.select("row", "at", "body").repartition("row").sortWithinPartitions("row", "at")
    return ordered.select("row", "body").mapInArrow(digested, "row bigint, groups_sha256 string")


# ---- counts ----


def _row_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(begin, SLICE_ROWS)


def count_links(pieces: DataFrame, kind: str) -> DataFrame:
    """(code, n): how many links of all pieces have each pair; counted in tasks before they meet."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, times = np.empty(0, np.int64), np.empty(0, np.int64)

        def merged(codes, times):
            found, at = np.unique(codes, return_inverse=True)
            total = np.zeros(len(found), np.int64)
            np.add.at(total, at, times)
            return found, total

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(times)], ["code", "n"])

        for batch in _row_slices(batches):
            own = np.frombuffer(b"".join(batch.column("codes").to_pylist()), kind).astype(np.int64)
            n = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4").astype(np.int64)
            codes, times = merged(np.r_[codes, own], np.r_[times, n])
            if len(codes) > COUNTED_PAIRS:
                yield rows()
                codes, times = codes[:0], times[:0]
        yield rows()

    found = pieces.select("codes", "times").mapInArrow(counted, "code bigint, n bigint")
    return found.groupBy("code").agg(F.sum("n").alias("n"))


def mark_best(counts: DataFrame, b_size: int) -> DataFrame:
    """``counts`` with ``best``: whether no other pair of the same B id has more links."""
    with_b = counts.withColumn("b", F.col("code") % b_size)
    most = with_b.groupBy("b").agg(F.max("n").alias("most"))
    return with_b.join(most, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def weigh_links(pieces: DataFrame, counts: DataFrame, keep: Sequence[str], kind: str, head: int = HEAD_PAIRS) -> DataFrame:
    """``keep`` of every piece, with n_best and count_sum over its links.

    The counts of the ``head`` most frequent pairs go to the tasks, a table of bounded size.
    Links of rarer pairs are joined with their counts and added by ``row``, which names a piece.
    """
    complete = counts.count() <= head
    chosen = counts if complete else counts.orderBy(F.desc("n"), "code").limit(head)
    table = chosen.toArrow().sort_by("code")
    known = pieces.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("code", "n", "best")))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.select(*keep).schema)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, n, best = known.value
        for batch in _row_slices(batches):
            cells = batch.column("codes").to_pylist()
            sizes = np.array([len(c) for c in cells], np.int64) // np.dtype(kind).itemsize
            own = np.frombuffer(b"".join(cells), kind).astype(np.int64)
            times = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4").astype(np.int64)
            at = np.minimum(np.searchsorted(code, own), max(len(code) - 1, 0))
            met = code[at] == own if len(code) else np.zeros(len(own), bool)
            ends = np.cumsum(sizes)

            def summed(values: np.ndarray) -> pa.Array:
                total = np.r_[0, np.cumsum(values)]
                return pa.array(total[ends] - total[ends - sizes], pa.int64())

            inside = np.where(met, times, 0)
            sums = [summed(inside * best[at]), summed(inside * n[at])] if len(code) else [summed(inside), summed(inside)]
            rest = [[{"code": int(c), "times": int(t)} for c, t in zip(own[i:j][~met[i:j]], times[i:j][~met[i:j]])]
                    for i, j in zip((ends - sizes).tolist(), ends.tolist())] if not met.all() else [[]] * len(cells)
            rare = pa.array(rest, pa.list_(pa.struct([("code", pa.int64()), ("times", pa.int64())])))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *sums, rare], [*keep, "n_best", "count_sum", "rare"])

    found = pieces.select(*keep, "codes", "times").mapInArrow(
        weighed, f"{schema}, n_best bigint, count_sum bigint, rare array<struct<code:bigint,times:bigint>>"
    )
    if complete:
        return found.drop("rare")
    found = stage(found, "weighed")
    rare = found.select("row", F.inline("rare")).join(counts.hint("merge"), "code")
    more = rare.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    both = found.drop("rare").join(more, "row", "left")
    return both.select(
        *keep,
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
    )


# ---- the operator ----


def align_documents(
    docs: DataFrame,
    byte_level: str,
    pieces: str,
    range_bytes: int = RANGE_BYTES,
    fan_in: int = FAN_IN,
    head: int = HEAD_PAIRS,
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A null or empty text, and one whose tokens do not give back a blank and the text byte by
    byte, has no tokens: zeros and an empty groups_sha256; it counts nowhere. Rows repeated
    under one doc_id are rows each, null ids too. An empty table gives an empty result. Other
    columns are not read.
    """
    name = f"aligner {byte_level} {pieces}"

    def aligner() -> Aligner:
        return Aligner(byte_level, pieces)

    # only the vocabularies are read here
    tool = aligner()
    b_size, kind = tool.b_size, tool.links_type
    named = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.monotonically_increasing_id().alias("row"))
    is_long = F.coalesce(F.octet_length("text"), F.lit(0)) >= range_bytes
    if not tool.cuts_words:
        is_long = F.lit(False)
    short = stage(align_short(named.filter(~is_long), aligner, name), "aligned")
    long_docs = stage(named.filter(is_long), "long")
    fragments = stage(align_ranges(split_long(long_docs, range_bytes), aligner, name), "fragments")
    closed, wholes = compose_ranges(fragments, b_size, kind, fan_in)
    parts = closed[0]
    for more in closed[1:]:
        parts = parts.unionByName(more)
    parts = parts.drop("valid").join(wholes.filter("valid"), "row", "left_semi")
    # a number of its own names each piece
    parts = stage(parts.withColumnRenamed("row", "document").withColumn("row", F.monotonically_increasing_id()), "parts")

    columns = ["codes", "times"]
    counts = stage(mark_best(stage(count_links(short.select(*columns).unionByName(parts.select(*columns)), kind), "counts"), b_size), "marked")
    sums = ["n_a", "n_b", "n_groups"]
    of_short = weigh_links(short, counts, ["row", "doc_id", "groups_sha256", *sums], kind, head).drop("row")
    of_parts = weigh_links(parts, counts, ["row", "document", *sums], kind, head).groupBy("document").agg(
        *[F.sum(c).alias(c) for c in (*sums, "n_best", "count_sum")]
    )
    digests = digest_pieces(parts.select(F.col("document").alias("row"), "at", "body")).withColumnRenamed("row", "document")
    of_long = long_docs.select("doc_id", F.col("row").alias("document")).join(of_parts, "document", "left").join(digests, "document", "left")
    together = of_short.unionByName(of_long.drop("document"))
    filled = {c: F.coalesce(c, F.lit(0)) for c in (*sums, "n_best", "count_sum")}
    return together.withColumns(filled).select(
        "doc_id", *sums, (F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links"),
        "n_best", "count_sum", F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return os.fspath(public_tokenizers.path("byte_bpe_50k.json")), os.fspath(public_tokenizers.path("piece_bpe_32k.model"))
