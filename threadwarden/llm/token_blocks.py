"""Token ids in patched frame-of-reference files.

A file holds the ids of whole documents in ascending doc_id order, in blocks of 1024 ids. A
block stores its minimum, and every id less the minimum in as many bits as most of its ids
need; the few larger ones (outliers) keep their low bits there and their high bits in an
exception list. An index gives the byte at which each block starts, so a reader can go to
any document without decoding what stands before it.

File layout, little-endian: magic "PFOR", u32 blocks, u32 documents, u64 ids, u64 first id
number within the file's range; index: u64 per block; documents: i64 doc_id, u32 ids and u8
flags each (1: the doc_id is null); blocks: u32 minimum, u16 ids, u8 width, u8 high width,
u16 exceptions, packed ids, u16 positions of exceptions, packed high bits.
"""

from __future__ import annotations

import itertools
import os
import struct
import unicodedata
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadwarden.llm.common import slices_by_bytes, utf8, worker_store
from threadwarden.sources.staging import new_stage_path, stage

BLOCK_IDS = 1024
# The width holds this share of a block's ids; the rest are exceptions.
PERCENTILE = 90
# A file is closed once it holds so many ids.
FILE_IDS = 1 << 23

_MAGIC = b"PFOR"
_HEAD, _HEAD_SIZE = "<4sIIQQ", struct.calcsize("<4sIIQQ")
_BLOCK, _BLOCK_SIZE = "<IHBBH", struct.calcsize("<IHBBH")
_DOC = np.dtype([("doc_id", "<i8"), ("n", "<u4"), ("flags", "u1")])


# ---- blocks ----


def _width(x: np.ndarray) -> int:
    """Bits that the largest number takes."""
    return int(x.max(initial=0)).bit_length()


def _pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each number, one after the other."""
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
    return np.packbits(bits, bitorder="little").tobytes() if width else b""


def _unpack(data: memoryview, n: int, width: int) -> np.ndarray:
    bits = np.zeros((n, 32), np.uint8)
    if width:
        bits[:, :width] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * width, bitorder="little").reshape(n, width)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").ravel()


def encode_block(ids: np.ndarray) -> bytes:
    """At most BLOCK_IDS ids as one block."""
    low = ids.min()
    rest = ids - low
    common = (len(rest) - 1) * PERCENTILE // 100
    width = _width(np.partition(rest, common)[common : common + 1])
    high = rest.astype(np.uint64) >> np.uint64(width)
    at = np.flatnonzero(high)
    high_width = _width(high[at])
    head = struct.pack(_BLOCK, int(low), len(ids), width, high_width, len(at))
    return head + _pack(rest, width) + at.astype("<u2").tobytes() + _pack(high[at], high_width)


def decode_block(data: memoryview, at: int) -> np.ndarray:
    low, n, width, high_width, exceptions = struct.unpack_from(_BLOCK, data, at)
    at += _BLOCK_SIZE
    size = -(-n * width // 8)
    ids = _unpack(data[at : at + size], n, width)
    at += size
    if exceptions:
        places = np.frombuffer(data, "<u2", exceptions, at)
        at += 2 * exceptions
        high = _unpack(data[at : at + -(-exceptions * high_width // 8)], exceptions, high_width)
        ids[places] |= high << np.uint32(width)
    return ids + np.uint32(low)


# ---- files ----


def encode_file(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, first: int) -> bytes:
    """Documents and their ids, one after the other, as the bytes of a file."""
    blocks = [encode_block(ids[i : i + BLOCK_IDS]) for i in range(0, len(ids), BLOCK_IDS)]
    docs = np.zeros(len(doc_ids), _DOC)
    docs["doc_id"] = [d or 0 for d in doc_ids]
    docs["n"] = counts
    docs["flags"] = [d is None for d in doc_ids]
    start = _HEAD_SIZE + 8 * len(blocks) + docs.nbytes
    index = np.cumsum([start, *map(len, blocks)])[:-1].astype("<u8")
    head = struct.pack(_HEAD, _MAGIC, len(blocks), len(doc_ids), len(ids), first)
    return b"".join([head, index.tobytes(), docs.tobytes(), *blocks])


class TokenFile:
    """Reads documents from the bytes of a file."""

    def __init__(self, data: bytes):
        magic, blocks, docs, self.n_ids, self.first = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        self.data = memoryview(data)
        self.index = np.frombuffer(data, "<u8", blocks, _HEAD_SIZE)
        self.docs = np.frombuffer(data, _DOC, docs, _HEAD_SIZE + 8 * blocks)
        self.starts = np.cumsum(np.r_[0, self.docs["n"].astype(np.int64)])

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids number ``begin`` to ``end``, from the blocks that hold them."""
        if begin >= end:
            return np.empty(0, np.uint32)
        first = begin // BLOCK_IDS
        found = [decode_block(self.data, int(b)) for b in self.index[first : (end - 1) // BLOCK_IDS + 1]]
        return np.concatenate(found)[begin - first * BLOCK_IDS : end - first * BLOCK_IDS]

    def document(self, n: int) -> np.ndarray:
        return self.ids(int(self.starts[n]), int(self.starts[n + 1]))

    def documents(self) -> Iterator[np.ndarray]:
        """All documents in order, each block decoded once."""
        waiting, have, block = [np.empty(0, np.uint32)], 0, 0
        for n in self.docs["n"].astype(np.int64).tolist():
            while have < n:
                piece = decode_block(self.data, int(self.index[block]))
                waiting.append(piece)
                have += len(piece)
                block += 1
            joined = np.concatenate(waiting)
            yield joined[:n]
            waiting, have = [joined[n:]], have - n


# ---- tokenizer ----


class WordEncoder:
    """A tokenizer of the tokenizers library that ends words at white space, word by word.

    Words come back again and again, so their ids are kept. The tokenizer cuts a text at
    white space and then by its pattern, and encodes each piece by itself; so do words here,
    and only pieces not met before go to the library. ASCII capitals are lowered before, as
    the tokenizer does. Texts in which that could matter (they hold the opening of a special
    token) are encoded whole.
    """

    # Words kept at a time; the table is emptied when it is full.
    MAX_WORDS = 1_000_000
    # The pattern by which the public tokenizer file splits words.
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # pieces are normalised and cut already: the model alone is asked about them
        self.model = Tokenizer.from_file(path)
        self.model.normalizer = normalizers.Sequence([])
        self.model.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        # white space at an end of a text leaves an empty word there
        self.words: dict[bytes, bytes] = {b"": b""}
        self.pieces_of = regex.compile(self.PIECES).findall
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _learn(self, words: set[bytes]) -> None:
        """Adds words to the table, by way of the pieces that the pattern cuts them into."""
        cut, whole = {}, []
        for word in words:
            if word.isalpha():
                cut[word] = (word,)
                continue
            text = word.decode()
            # a word that normalisation changes is not cut before it
            if word.isascii() or (text.lower() == text and unicodedata.is_normalized("NFC", text)):
                cut[word] = [p.encode() for p in self.pieces_of(text)]
            else:
                whole.append(word)
        pieces = list(set(itertools.chain.from_iterable(cut.values())).difference(self.words))
        for at in range(0, len(pieces), 512):
            self._learn_joined(pieces[at : at + 512])
        for word in whole:
            self.words[word] = self._whole(word).tobytes()
        for word, parts in cut.items():
            if len(parts) != 1 or parts[0] != word:
                self.words[word] = b"".join([self.words[p] for p in parts])

    def _learn_joined(self, pieces: list[bytes]) -> None:
        """One call for many pieces; each ends with the first token that ends a word."""
        ids = np.array(self.model.encode_batch_fast([b" ".join(pieces).decode()], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(pieces):
            for piece in pieces:
                self.words[piece] = self._whole(piece).tobytes()
            return
        data, bounds = ids.tobytes(), [0, *(4 * ends).tolist()]
        for piece, i, j in zip(pieces, bounds, bounds[1:]):
            self.words[piece] = data[i:j]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        odd = [b"<|" in t for t in texts]
        plain = pa.array([b"" if x else t for t, x in zip(texts, odd)], pa.binary()).cast(pa.string())
        split = pc.ascii_split_whitespace(pc.ascii_lower(plain))
        # distinct words are looked up once; the ids of all words are then copied from one array
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.cast(pa.binary()).to_pylist()
        found = list(map(self.words.get, distinct))
        if None in found:
            missing = {w for w, ids in zip(distinct, found) if ids is None}
            if len(self.words) + len(missing) > self.MAX_WORDS:
                self.words = {b"": b""}
                missing = set(distinct)
            self._learn(missing.difference(self.words))
            found = list(map(self.words.__getitem__, distinct))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        table = np.frombuffer(b"".join(found), "<u4")
        starts = np.r_[0, np.cumsum(sizes)].astype(np.int32)
        copied = pa.ListArray.from_arrays(pa.array(starts), pa.array(table)).take(words.indices)
        ids = copied.flatten().to_numpy()
        bounds = copied.offsets.to_numpy()[split.offsets.to_numpy()]
        return [self._whole(t) if x else ids[i:j] for t, x, i, j in zip(texts, odd, bounds[:-1].tolist(), bounds[1:].tolist())]

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4")


# ---- writing and reading ----


def _open_store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_token_files(docs: DataFrame, folder: str, encoder: Callable[[], object], name: str, end_id: int, file_ids: int = FILE_IDS) -> DataFrame:
    """Tokenise ``docs`` into files in ``folder``; returns one row (part, seq, file, docs, ids) per file.

    ``encoder()`` makes an object whose ``encode`` turns texts (bytes) into arrays of ids; each
    Python worker keeps it under ``name``.
    Documents are sorted into ranges of doc_id, null first; each range writes its files one
    after the other, so that part, then seq, is the order of the ids. A task writes under a
    name of its own and renames: a task run again replaces its files by the same ones.
    Documents are buffered up to one file.
    """

    # names of this write alone: files of an earlier one in the folder stay as they are
    run = uuid.uuid4().hex[:8]

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open_store(folder)
        tool = worker_store(name, encoder)
        state = {"ids": [], "counts": [], "docs": [], "n": 0, "first": 0, "seq": 0, "part": None}
        end = np.array([end_id], "<u4")

        def close() -> pa.RecordBatch:
            ids = np.concatenate(state["ids"])
            name = f"tokens-{run}-{state['part']:07d}-{state['seq']:05d}.pfor"
            draft = f"{base}/.{name}.{uuid.uuid4().hex}"
            with store.open_output_stream(draft) as out:
                out.write(encode_file(state["docs"], state["counts"], ids, state["first"]))
            store.move(draft, f"{base}/{name}")
            row = [[state["part"]], [state["seq"]], [name], [len(state["docs"])], [len(ids)]]
            state.update(ids=[], counts=[], docs=[], n=0, first=state["first"] + len(ids), seq=state["seq"] + 1)
            types = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], ["part", "seq", "file", "docs", "ids"])

        for batch in batches:
            if not batch.num_rows:
                continue
            state["part"] = batch.column("part")[0].as_py()
            doc_ids = batch.column("doc_id").to_pylist()
            texts = utf8(batch.column("text"))
            for part in slices_by_bytes(texts, 1 << 25):
                for doc_id, ids in zip(doc_ids[part], tool.encode(texts[part])):
                    state["docs"].append(doc_id)
                    state["counts"].append(len(ids) + 1)
                    state["ids"] += [ids, end]
                    state["n"] += len(ids) + 1
                    if state["n"] >= file_ids:
                        yield close()
        if state["docs"]:
            yield close()

    _make_folder(docs.sparkSession, folder)
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    # the rows of one doc_id, null too, may fill several ranges: a hash of the text deals them
    order = ["doc_id", F.xxhash64("text")]
    ranged = texts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    return stage(ranged.mapInArrow(written, "part int, seq int, file string, docs bigint, ids bigint"), "manifest")


def _make_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)


def part_offsets(manifest: DataFrame) -> dict[int, int]:
    """Ids before each range of documents: one number per partition."""
    sums = manifest.groupBy("part").agg(F.sum("ids").alias("ids")).collect()
    offsets, total = {}, 0
    for r in sorted(sums, key=lambda r: r["part"]):
        offsets[r["part"]] = total
        total += r["ids"]
    return offsets


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files of ``manifest``.

    Other files in the folder, of an earlier write or of a task that ran again, are not read.
    """
    offsets = part_offsets(manifest)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open_store(folder)
        for batch in batches:
            for part, name in zip(batch.column("part").to_pylist(), batch.column("file").to_pylist()):
                with store.open_input_stream(f"{base}/{name}") as stream:
                    file = TokenFile(stream.read())
                start = file.starts[:-1] + file.first + offsets[part]
                ids = [None if f & 1 else d for d, f in zip(file.docs["doc_id"].tolist(), file.docs["flags"].tolist())]
                columns = [
                    pa.array(ids, pa.int64()), pa.array(start, pa.int64()),
                    pa.array(file.docs["n"].astype(np.int64)), pa.array([crc32(x) for x in file.documents()], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    # a task per file, up to the number of shuffle partitions
    tasks = min(max(1, manifest.count()), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = manifest.select("part", "file").repartition(tasks, "file")
    return files.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Write the ids of every whole text, read the files back, and describe each document.

    Returns doc_id, start (ids of all documents before it), n_tokens (with the end id) and
    ids_crc32. A null or empty text has the end id alone. Documents follow each other in
    ascending doc_id order, null first; rows repeated under one doc_id stand side by side in
    any order. An empty table writes no file. Other columns are not read.
    """
    spark = docs.sparkSession
    folder = folder or new_stage_path(spark, "tokens")
    manifest = write_token_files(docs, folder, lambda: WordEncoder(tokenizer_path), f"words of {tokenizer_path}", end_id)
    return read_token_files(spark, folder, manifest)


def default_tokenizer() -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path("word_bpe_49k.json"))
