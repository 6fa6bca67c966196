"""SentencePiece encoding and decoding as a Viterbi search in numpy, many words at a time.

A text is cut into words that no piece reaches across. Distinct words of equal length stand
in one matrix and advance together, character by character: the hashes of the substrings
that end there are looked up in the sorted hashes of all pieces, and the best piece of each
word is stored as its back pointer.

In a unigram model the best piece has the largest sum of scores up to it. In a BPE model it
is the piece with which the merges would end: a sequence of pieces is what the merges give
exactly if every two neighbours are (no merge across their border would come before the
merges that make them), so of the pieces ending at a place one alone fits its predecessor.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwarden.llm.common import mix64, slices_by_bytes, utf8, worker_store

# Fixed values of the model file format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"
# Words of one length that are searched at a time.
BATCH_WORDS = 32_768

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


# ---- the model file ----


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of a protocol buffer message."""

    def number(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        tag, at = number(at)
        kind = tag & 7
        if kind == 0:
            value, at = number(at)
        else:
            if kind == 2:
                size, at = number(at)
            else:
                size = {1: 8, 5: 4}[kind]
            value, at = data[at : at + size], at + size
        yield tag >> 3, value


class Model:
    """Pieces of a model file, with what the search needs to look them up."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        pieces, trainer, normalizer = [], {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normalizer = dict(_fields(value))
        self.type = trainer.get(3, UNIGRAM)
        self.dummy_prefix = bool(normalizer.get(3, 1))
        kinds = {k for _, _, k in pieces}
        if self.type not in (UNIGRAM, BPE) or normalizer.get(1) != b"identity" or normalizer.get(4, 1) or USER_DEFINED in kinds or BYTE not in kinds:
            raise ValueError("the search knows unigram and BPE models that keep texts as they are and fall back to bytes")
        self.byte_ids = np.array([next(i for i, p in enumerate(pieces) if p[0] == f"<0x{b:02X}>") for b in range(256)])
        self.spelled = [
            bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k in (CONTROL, UNKNOWN) else p.replace(SPACE, " ").encode()
            for p, _, k in pieces
        ]
        scores = {p: s for p, s, k in pieces if k == NORMAL}
        steps = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        ids = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("a piece reaches across words")
        self.longest = max(map(len, ids))
        self.score = np.array([s for _, s, _ in pieces])
        self.rank = np.array([steps[s] if k == NORMAL else -1 for _, s, k in pieces])
        self.length = np.array([len(p) for p, _, _ in pieces])
        self.unknown_score = min(scores.values()) - 10.0
        self.left, self.right = np.arange(len(pieces)), np.arange(len(pieces))
        usable = dict(ids)
        if self.type == BPE:
            for piece, i in ids.items():
                halves = _last_merge(piece, scores)
                if halves is None:
                    del usable[piece]
                else:
                    self.left[i], self.right[i] = (ids.get(h, i) for h in halves)
        self.hash = np.array([_hash(p) for p, _, _ in pieces], np.uint64)
        # merges may pass through pieces that are never the end
        self.pieces = Lookup(self.hash, np.array(list(usable.values())))
        self.merges = Lookup(self.hash, np.array(list(ids.values())))
        if not all(c in ids for p in usable for c in p):
            raise ValueError("a piece holds a character that is no piece")
        self.newline_alone = "\n" not in ids
        self.powers = np.array([pow(_BASE, n, 1 << 64) for n in range(self.longest + 1)], np.uint64)

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """True where the merges leave pieces ``a`` and ``b`` beside each other.

        The merges are taken back, the last one first. What stood at the border at each time
        must not have been merged by then: among equal ranks the merge further left is earlier.
        """
        out = np.ones(len(a), bool)
        at = np.flatnonzero((a >= 0) & (b >= 0))
        a, b = a[at], b[at]
        # a merge across the border with a rank below this would have come first
        limit = np.full(len(at), len(self.rank) + 1)
        while len(at):
            joined = self.merges(self.hash[a] * self.powers[self.length[b]] + self.hash[b])
            joined[self.length[a] + self.length[b] > self.longest] = -1
            early = (joined >= 0) & (self.rank[joined] < limit)
            out[at[early]] = False
            whole_a, whole_b = self.length[a] == 1, self.length[b] == 1
            go = ~early & ~(whole_a & whole_b)
            at, a, b, whole_a, whole_b = at[go], a[go], b[go], whole_a[go], whole_b[go]
            # of two merges of one rank, the right one is later
            undo_a = whole_b | (~whole_a & (self.rank[a] > self.rank[b]))
            limit = np.where(undo_a, self.rank[a], self.rank[b] + 1)
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_a, b, self.left[b])
        return out

    # ---- search ----

    def search(self, words: list[str]) -> list[np.ndarray]:
        """Piece ids of words of one length, which all advance together."""
        n, size = len(words), len(words[0])
        chars = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(n, size)
        prefix = np.zeros((n, size + 1), np.uint64)
        mixed = mix64(chars.astype(np.uint64) + np.uint64(1))
        for i in range(size):
            prefix[:, i + 1] = prefix[:, i] * np.uint64(_BASE) + mixed[:, i]
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0.0
        piece = np.full((n, size + 1), -1)
        back = np.zeros((n, size + 1), np.int64)
        every = np.arange(n)
        for end in range(1, size + 1):
            widths = np.arange(1, min(end, self.longest) + 1)
            starts = end - widths
            hashes = prefix[:, end, None] - prefix[:, starts] * self.powers[widths]
            found = self.pieces(hashes.ravel()).reshape(hashes.shape)
            # hashes may agree by chance, lengths then hardly
            found[self.length[found] != widths] = -1
            known = found >= 0
            # a character that is no piece stands alone
            usable = known.copy()
            usable[:, 0] = True
            if self.type == BPE:
                row, col = np.nonzero(known & (starts > 0))
                if len(row):
                    ahead, behind = piece[row, starts[col]], found[row, col]
                    pairs, which = np.unique((ahead + 1) * len(self.rank) + behind, return_inverse=True)
                    usable[row, col] = self.fits(pairs // len(self.rank) - 1, pairs % len(self.rank))[which]
                value = np.where(usable & (known | ~known[:, :1]), widths, -1)
            else:
                gain = np.where(known, self.score[found], self.unknown_score)
                value = np.where(usable, best[:, starts] + gain, -np.inf)
            pick = value.argmax(axis=1)
            best[:, end] = value[every, pick]
            piece[:, end] = found[every, pick]
            back[:, end] = starts[pick]
        # all words follow their back pointers together, from the end to the start
        steps, at, live = [], np.full(n, size), every
        while len(live):
            steps.append((live, piece[live, at], at))
            at = back[live, at]
            live, at = live[at > 0], at[at > 0]
        # the last step is the first piece
        row, ids, ends = (np.concatenate(c[::-1]) for c in zip(*steps))
        order = np.argsort(row, kind="stable")
        row, ids, ends = row[order], ids[order], ends[order]
        out = np.split(ids, np.searchsorted(row, every[1:]))
        for i in np.unique(row[ids < 0]):
            # characters that are no piece become their bytes
            spelled = [
                [p] if p >= 0 else self.byte_ids[list(words[i][end - 1].encode())] for p, end in zip(out[i], ends[row == i])
            ]
            out[i] = np.concatenate(spelled)
        return out


class Lookup:
    """Finds pieces by the hash of their text: sorted keys behind a table of the hashes' low bits."""

    BITS = 20

    def __init__(self, hashes: np.ndarray, numbers: np.ndarray):
        order = np.argsort(hashes[numbers])
        self.keys, self.numbers = hashes[numbers][order], numbers[order]
        self.met = np.zeros(1 << self.BITS, bool)
        self.met[self.keys & np.uint64((1 << self.BITS) - 1)] = True

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of each hash, -1 if there is none."""
        out = np.full(len(hashes), -1)
        maybe = np.flatnonzero(self.met[hashes & np.uint64((1 << self.BITS) - 1)])
        at = np.searchsorted(self.keys, hashes[maybe])
        at[at == len(self.keys)] = 0
        right = self.keys[at] == hashes[maybe]
        out[maybe[right]] = self.numbers[at[right]]
        return out


def _hash(piece: str) -> int:
    h = 0
    for c in mix64(np.array([ord(c) + 1 for c in piece], np.uint64)).tolist():
        h = (h * _BASE + c) & _MASK
    return h


def _last_merge(piece: str, scores: dict[str, float]) -> tuple[str, str] | None:
    """The two parts that the merges join last to make ``piece``; None if they never make it."""
    parts = list(piece)
    if len(parts) == 1:
        return piece, piece
    while len(parts) > 2:
        options = [(-scores[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores]
        if not options:
            return None
        i = min(options)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return tuple(parts)


class Codec:
    """Encodes and decodes texts; the ids of words are kept for the next texts."""

    # Words kept at a time; the table is emptied when it is full.
    MAX_WORDS = 400_000

    def __init__(self, path: str):
        import regex

        self.model = Model(path)
        self.words: dict[str, bytes] = {}
        # blanks belong to the word behind them
        alone = r"\n" if self.model.newline_alone else ""
        self.findall = regex.compile(rf" *[^ {alone}]+|{alone or '(?!)'}| +").findall

    def cut(self, text: str) -> list[str]:
        """The words of a text, each with the blanks before it."""
        if "  " in text or not self.model.newline_alone:
            return self.findall(text)
        words = []
        for i, line in enumerate(text.split("\n")):
            if i:
                words.append("\n")
            first, *rest = line.split(" ")
            if first:
                words.append(first)
            words += [" " + w for w in rest]
        return words

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; an empty text has none."""
        prefix = " " if self.model.dummy_prefix else ""
        split = [self.cut(prefix + t.replace(SPACE, " ")) if t else [] for t in texts]
        met = set().union(*split)
        missing = met.difference(self.words)
        if len(self.words) + len(missing) > self.MAX_WORDS:
            self.words.clear()
            missing = met
        by_length: dict[int, list[str]] = {}
        for word in missing:
            by_length.setdefault(len(word), []).append(word)
        for size, words in by_length.items():
            step = max(1, BATCH_WORDS * 16 // max(16, size))
            for at in range(0, len(words), step):
                part = words[at : at + step]
                found = self.model.search([w.replace(" ", SPACE) for w in part])
                data, bounds = np.concatenate(found).astype("<u4").tobytes(), np.cumsum([0, *map(len, found)]) * 4
                for word, i, j in zip(part, bounds.tolist(), bounds[1:].tolist()):
                    self.words[word] = data[i:j]
        get = self.words.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), "<u4") for words in split]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.model.spelled.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


def _codec(path: str) -> Codec:
    return worker_store(f"codec {path}", lambda: Codec(path))


def encode_documents(docs: DataFrame, model_path: str, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of every row with token_ids, n_tokens and round_trip (decoding gives the text).

    Texts are taken whole. A null or empty text has no tokens and comes back as empty. Texts
    that hold the model's own space sign come back with blanks for it, as the model has it;
    round_trip is then false. Repeated rows are encoded each; other columns are not read.
    """

    def encoded(batches):
        codec = _codec(model_path)
        for batch in batches:
            raw = utf8(batch.column("_text"))
            kept = batch.drop_columns(["_text"])
            for part in slices_by_bytes(raw):
                texts = [t.decode() for t in raw[part]]
                ids = codec.encode(texts)
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids).astype(np.int32)))
                same = pa.array([codec.decode(i) == t for i, t in zip(ids, texts)])
                rows = kept.slice(part.start, part.stop - part.start)
                columns_out = [*rows.columns, lists, pa.array(np.diff(offsets).astype(np.int64)), same]
                yield pa.RecordBatch.from_arrays(columns_out, [*rows.schema.names, "token_ids", "n_tokens", "round_trip"])

    narrow = docs.select(*columns, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name != "_text")
    return narrow.mapInArrow(encoded, f"{schema}, token_ids array<int>, n_tokens bigint, round_trip boolean")


def digests(encoded: DataFrame) -> DataFrame:
    """``encoded`` with the CRC-32 of its ids as little-endian unsigned 32-bit numbers, for the ids."""

    def summed(batches):
        for batch in batches:
            lists = batch.column("token_ids")
            flat, offsets = lists.flatten().to_numpy().astype("<u4"), lists.offsets.to_numpy()
            offsets = offsets - offsets[0] if len(offsets) else offsets
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            rest = batch.drop_columns(["token_ids"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(sums, pa.int64())], [*rest.schema.names, "ids_crc32"])

    rest = encoded.drop("token_ids")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
    return encoded.mapInArrow(summed, f"{schema}, ids_crc32 bigint")


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))
