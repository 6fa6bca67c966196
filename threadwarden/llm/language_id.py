"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram is the product of its letters'
vectors, the first rotated by two places and the second by one, so that order counts. A
document is the sum of its trigrams; a language is the sum of its documents, each scaled to
length one. A document gets the language whose vector has the largest cosine with its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadwarden.llm.common import mix64, slices_by_bytes, utf8, worker_store

DIMENSIONS = 1024
GRAM = 3
# Documents per language that profiles are learned from, about: each language's documents
# are taken at the rate that gives so many of them.
SAMPLE = 4_000
# Parts of one in which unit vectors are added up, so that sums do not depend on order.
UNIT = 1 << 20
UNKNOWN = "und"

# Documents and distinct trigrams that are multiplied at a time.
BLOCK_DOCS, BLOCK_GRAMS = 256, 4096


class Letters:
    """Lower-case letters of code points, and their random vectors."""

    def __init__(self):
        self.lowered = np.full(0x110000, -1, np.int32)
        self.vectors: dict[int, np.ndarray] = {}

    def codes(self, points: np.ndarray) -> np.ndarray:
        """The letter of each code point in lower case; 0 for anything else."""
        found = self.lowered[points]
        if (found < 0).any():
            for p in np.unique(points[found < 0]).tolist():
                char = chr(p)
                low = char.lower()
                self.lowered[p] = (ord(low) if len(low) == 1 else p) if char.isalpha() else 0
            found = self.lowered[points]
        return found

    def vector(self, letter: int) -> np.ndarray:
        if letter not in self.vectors:
            words = mix64(np.arange(DIMENSIONS // 64, dtype=np.uint64) + np.array([letter], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            self.vectors[letter] = np.unpackbits(words.astype("<u8").view(np.uint8)).astype(np.int8) * 2 - 1
        return self.vectors[letter]

    def grams(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of packed trigrams."""
        out = None
        for place in range(GRAM):
            letters, which = np.unique((keys >> np.uint64(21 * (GRAM - 1 - place))) & np.uint64(0x1FFFFF), return_inverse=True)
            table = np.stack([np.roll(self.vector(c), GRAM - 1 - place) for c in letters.tolist()])
            out = table[which] if out is None else out * table[which]
        return out.astype(np.float32)


def document_vectors(texts: list[bytes], letters: Letters) -> np.ndarray:
    """The sum of its trigrams for each text; zero for a text without letters."""
    out = np.zeros((len(texts), DIMENSIONS), np.float64)
    # a boundary before and behind every text
    chars = [np.frombuffer(f" {t.decode()} ".encode("utf-32-le"), "<u4") for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(c) for c in chars])
    codes = letters.codes(np.concatenate(chars)) if chars else np.empty(0, np.int32)
    # one boundary for a run of other characters
    same = np.r_[False, owner[1:] == owner[:-1]]
    keep = (codes != 0) | ~same | np.r_[True, codes[:-1] != 0]
    codes, owner = codes[keep].astype(np.uint64), owner[keep]
    if len(codes) < GRAM:
        return out
    keys = codes[: 1 - GRAM]
    for place in range(1, GRAM):
        keys = (keys << np.uint64(21)) | codes[place : len(codes) - GRAM + 1 + place]
    inside = owner[: 1 - GRAM] == owner[GRAM - 1 :]
    keys, owner = keys[inside], owner[: 1 - GRAM][inside]
    for first in range(0, len(texts), BLOCK_DOCS):
        a, b = np.searchsorted(owner, [first, first + BLOCK_DOCS])
        if a == b:
            continue
        found, which = np.unique(keys[a:b], return_inverse=True)
        docs = min(BLOCK_DOCS, len(texts) - first)
        for g in range(0, len(found), BLOCK_GRAMS):
            width = min(BLOCK_GRAMS, len(found) - g)
            here = (which >= g) & (which < g + width)
            cells = (owner[a:b][here] - first) * width + which[here] - g
            counts = np.bincount(cells, minlength=docs * width).reshape(docs, width).astype(np.float32)
            # whole numbers: exact in any order while a text is shorter than 2**24
            out[first : first + docs] += counts @ letters.grams(found[g : g + width])
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray]]:
    letters = worker_store("letters", Letters)
    texts = utf8(batch.column("text"))
    for part in slices_by_bytes(texts):
        yield part, document_vectors(texts[part], letters)


def learn_profiles(labelled: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """A unit vector per language from rows of (doc_id, text, lang).

    About ``sample`` documents of each language are read, chosen by a hash of doc_id. One
    vector per language comes to the driver. Rows without lang teach nothing.
    """
    labelled = labelled.select("doc_id", F.col("text").cast("string"), F.col("lang").cast("string")).filter("lang is not null")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return {}
    rates = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, sample / n))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = labelled.filter(draw < rates[F.col("lang")])

    def summed(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for part, vectors in _vectors(batch):
                units = np.rint(_unit(vectors) * UNIT).astype(np.int64)
                for lang in set(langs[part]):
                    sums[lang] = sums.get(lang, 0) + units[langs[part] == lang].sum(axis=0)
        if sums:
            yield pa.RecordBatch.from_pydict({"lang": list(sums), "sums": pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))})

    parts = chosen.select("text", "lang").mapInArrow(summed, "lang string, sums array<bigint>")
    added = parts.select("lang", F.posexplode("sums").alias("place", "x")).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    profiles: dict[str, np.ndarray] = {}
    for r in added.collect():
        profiles.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["place"]] = r["x"]
    return {lang: _unit(v[None, :])[0] for lang, v in sorted(profiles.items()) if v.any()}


def identify(docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred and score (the cosine, not below 0) of every row of ``docs``.

    A null text, one without any letter, and every text if there are no profiles, are "und"
    with score 0. Equal cosines go to the language first by code points. Whole texts are
    read; other columns are not. Repeated rows are answered each.
    """
    names = sorted(profiles)
    table = np.stack([profiles[n] for n in names]) if names else np.zeros((0, DIMENSIONS))

    def identified(batches):
        for batch in batches:
            for part, vectors in _vectors(batch):
                known = vectors.any(axis=1) & bool(names)
                cosines = _unit(vectors) @ table.T if names else np.zeros((len(vectors), 1))
                best = np.round(cosines, 9).argmax(axis=1)
                score = np.where(known, np.clip(cosines[np.arange(len(best)), best], 0.0, 1.0), 0.0)
                lang = [names[b] if k else UNKNOWN for b, k in zip(best, known)]
                ids = batch.column("doc_id").slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([ids, pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    narrow = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return narrow.mapInArrow(identified, "doc_id bigint, lang_pred string, score double")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))
