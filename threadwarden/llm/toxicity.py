"""Toxicity by compression distance with two zstandard dictionaries.

One dictionary is trained on the words of ordinary texts, one on words that a much larger
share of the toxic texts holds than of the ordinary ones. A text is scored window by window: where the toxic
dictionary saves more bytes than the ordinary one, the window speaks for toxicity. A window
is one word (a piece of a very long one). zstandard needs some 15 bytes for any input, which
would hide a match of five letters, so every byte of a window is spelled as twelve, the same
way in the dictionaries: known words still cost one match, unknown ones twelve times as much.
Two figures make the score of a text: its two largest savings, and the savings of all its
windows, repeated ones too, per window, so that ordinary words added to a text lower it. Their
weights and the threshold are found on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadwarden.llm import minhash
from threadwarden.llm.common import binary_column, mix64, slices_by_bytes, utf8, worker_store
from threadwarden.sources.staging import stage

# Labelled documents that are read, about: each label's documents are taken at the rate that
# gives so many. A quarter of them sets the threshold, the rest trains the dictionaries.
TOXIC_SAMPLE, ORDINARY_SAMPLE = 3_000, 12_000
CALIBRATION = 4
# Ordinary words in the dictionary, the most frequent ones.
ORDINARY_WORDS = 1_000
# Limits that are tried for toxic words: the log odds of the shares of toxic and of ordinary
# texts that hold the word, less some of its standard errors. The calibration part decides.
WORD_LIMITS = (1.0, 1.5, 2.0, 2.5, 3.0)
# Where so few toxic texts are labelled that no word passes, fewer are taken off.
DEVIATIONS = (2.0, 1.0, 0.5, 0.0)
FAMILY_KEYS = 4
SPELLING = 12
WINDOW_BYTES = 32
LEVEL = 12
THRESHOLD = 0.7
# The end of a trained dictionary's tables: three offsets to begin with, set by the format.
_OFFSETS = b"\x01\0\0\0\x04\0\0\0\x08\0\0\0"


def windows(text: bytes) -> list[bytes]:
    """Words of the text, A-Z in lower case; longer ones in pieces."""
    words = text.lower().split()
    if max(map(len, words), default=0) <= WINDOW_BYTES:
        return words
    return [w[i : i + WINDOW_BYTES] for w in words for i in range(0, len(w), WINDOW_BYTES)]


def overlapping(text: bytes) -> list[bytes]:
    """Words of the text as they are scored: pieces of long ones overlap by half, so that no cut hides a match."""
    words = text.lower().split()
    if max(map(len, words), default=0) <= WINDOW_BYTES:
        return words
    step = WINDOW_BYTES // 2
    return [w[i : i + WINDOW_BYTES] for w in words for i in range(0, max(1, len(w) - step), step)]


class Speller:
    """Spells every byte of a window as SPELLING bytes that no other byte has in their places."""

    def __init__(self):
        order = mix64(np.arange(256 * SPELLING, dtype=np.uint64) + np.uint64(1)).reshape(SPELLING, 256)
        self.of_byte = [row.tobytes() for row in order.argsort(axis=1).astype(np.uint8).T]

    def __call__(self, window: bytes) -> bytes:
        return b"".join([self.of_byte[b] for b in b" " + window + b" "])


@dataclass(frozen=True)
class Detector:
    """Two dictionaries, the weights of the two figures, and the weighted sum at which a text counts as toxic."""

    ordinary: bytes
    toxic: bytes
    limit: float = 0.0
    peak: float = 1.0
    rate: float = 0.0


class Measure:
    """Bytes that each toxic dictionary saves on a window; windows met before are remembered."""

    MAX_WORDS = 400_000

    def __init__(self, ordinary: bytes, toxic: list[bytes]):
        import zstandard

        def compressor(content: bytes):
            kind = zstandard.DICT_TYPE_FULLDICT if content[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
            data = zstandard.ZstdCompressionDict(content, dict_type=kind)
            data.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(
                level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
            ).compress

        self.spell = Speller()
        self.by_ordinary, self.by_toxic = compressor(ordinary), [compressor(t) for t in toxic]
        self.known: list[dict[bytes, int]] = [{} for _ in toxic]

    def savings(self, windows: list[bytes]) -> list[np.ndarray]:
        """Per dictionary, what it saves on each of different windows."""
        if len(self.known[0]) > self.MAX_WORDS:
            for known in self.known:
                known.clear()
        for window in windows:
            if window not in self.known[0]:
                spelled = self.spell(window)
                plain = len(self.by_ordinary(spelled))
                for known, compress in zip(self.known, self.by_toxic):
                    known[window] = plain - len(compress(spelled))
        return [np.fromiter(map(known.__getitem__, windows), np.int64, len(windows)) for known in self.known]

    def figures(self, texts: list[bytes]) -> list[np.ndarray]:
        """Per dictionary and text, the two largest savings among its different windows, and all savings per window."""
        split = [overlapping(t) for t in texts]
        sizes = np.array([len(found) for found in split], np.int64)
        codes = pa.array(list(chain.from_iterable(split)), pa.binary()).dictionary_encode()
        del split
        text, code = np.repeat(np.arange(len(sizes)), sizes), codes.indices.to_numpy()
        return [_figures(saved, text, code, sizes) for saved in self.savings(codes.dictionary.to_pylist())]


def _figures(saved: np.ndarray, text: np.ndarray, code: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The two figures per text, given the saving of each code and the text and code of each window."""
    gain = saved[code]
    text, code, gain = (x[gain > 0] for x in (text, code, gain))
    rate = np.bincount(text, gain, len(sizes)) / np.maximum(sizes, 1)
    # different windows of a text, its largest savings first
    once = np.unique(text * len(saved) + code)
    text, gain = once // max(1, len(saved)), saved[once % max(1, len(saved))]
    order = np.lexsort((-gain, text))
    text, gain = text[order], gain[order]
    best = np.arange(len(text)) - np.searchsorted(text, text) < 2
    return np.c_[np.bincount(text[best], gain[best], len(sizes)), rate]


def train_dictionary(words: list[bytes]) -> bytes:
    """A dictionary of the words, the most important last; its tables are trained on them."""
    import zstandard

    spell = Speller()
    samples = [spell(w) for w in words]
    content = b"".join(samples)
    if not samples:
        return b""
    try:
        trained = zstandard.train_dictionary(8192, samples if len(samples) >= 64 else samples * 20).as_bytes()
    except zstandard.ZstdError:  # too few words to train tables on: content alone
        return content
    # the trainer keeps a choice of the content only; all of it is put behind the tables
    return trained[: trained.index(_OFFSETS) + len(_OFFSETS)] + content


# ---- learning ----


def labelled_sample(docs: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """(text, toxic, part) of about the sampled numbers of documents, chosen by a hash of doc_id."""
    ids = labels.filter(usable).groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    ids = ids.filter("doc_id is not null and toxic in (0, 1)")
    counts = {r["toxic"]: r["count"] for r in ids.groupBy("toxic").count().collect()}
    rate = F.when(F.col("toxic") == 1, min(1.0, TOXIC_SAMPLE / max(1, counts.get(1, 0)))).otherwise(
        min(1.0, ORDINARY_SAMPLE / max(1, counts.get(0, 0)))
    )
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(CALIBRATION)).cast("int")
    chosen = ids.filter(draw < rate).select("doc_id", F.col("toxic").cast("int").alias("toxic"), part.alias("part"))
    # at most about TOXIC_SAMPLE + ORDINARY_SAMPLE ids
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return _one_of_each_family(stage(texts.join(F.broadcast(chosen), "doc_id"), "labelled")).select("text", "toxic", "part")


def _one_of_each_family(sample: DataFrame) -> DataFrame:
    """The sample without near copies, whose odd words would look like words that texts repeat.

    A document stays if it is the first of all that share one of its FAMILY_KEYS least hashes
    of five-word shingles; copies share nearly all of them, other texts hardly any.
    """
    scheme = minhash.Scheme(words=5, slots=FAMILY_KEYS, distance=FAMILY_KEYS - 1)

    def keyed(batches):
        for batch in batches:
            sets = [minhash.shingle_set(t, scheme.words) for t in utf8(batch.column("text"))]
            full = [i for i, x in enumerate(sets) if len(x)]
            least = scheme.least_hashes([sets[i] for i in full])
            keys = (least.astype(np.int64) << 8) + np.arange(FAMILY_KEYS)
            ids = batch.column("doc_id").take(pa.array(np.repeat(full, FAMILY_KEYS), pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys.ravel(), pa.int64())], ["doc_id", "key"])

    keys = stage(sample.select("doc_id", "text").distinct().mapInArrow(keyed, "doc_id bigint, key bigint"), "families")
    first = keys.groupBy("key").agg(F.min("doc_id").alias("first"))
    later = keys.join(first, "key").filter("doc_id <> first").select("doc_id").distinct()
    return stage(sample.join(later, "doc_id", "left_anti"), "sample")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word, its number in ordinary texts and the texts of either kind that hold it."""
    for batch in batches:
        texts, kinds = utf8(batch.column("text")), batch.column("toxic").to_pylist()
        for part in slices_by_bytes(texts):
            n, held = Counter(), (Counter(), Counter())
            for text, toxic in zip(texts[part], kinds[part]):
                words = windows(text)
                held[toxic].update(set(words))
                if not toxic:
                    n.update(words)
            found = list(held[0] | held[1])
            counts = [pa.array([c[w] for w in found], pa.int64()) for c in (n, *held)]
            yield pa.RecordBatch.from_arrays([binary_column(found), *counts], ["word", "n", "ordinary", "toxic"])


def word_odds(toxic: Column, ordinary: Column, n_toxic: int, n_ordinary: int, deviations: float) -> Column:
    """The lower end of the log odds of a word that so many toxic and ordinary texts hold."""
    shares = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((ordinary + 0.5) / (n_ordinary + 1))
    return shares - deviations * F.sqrt(1 / (toxic + 0.5) + 1 / (ordinary + 0.5))


def learn(docs: DataFrame, labels: DataFrame, usable: Column) -> Detector:
    """A detector from the documents that ``labels`` (doc_id, toxic) marks 0 or 1.

    ``usable`` tells which label rows may be learned from. A document labelled both ways
    counts as toxic. Without labels of either kind every score will be 0. Words come to the
    driver, not texts: the most frequent ordinary ones and those above the least of WORD_LIMITS.
    The limit with the fewest errors on the calibration part is taken, the higher one of equals.
    """
    sample = labelled_sample(docs, labels, usable)
    train = sample.filter("part > 0").select("text", "toxic")
    sizes = {r["toxic"]: r["count"] for r in train.groupBy("toxic").count().collect()}
    words = train.mapInArrow(_word_counts, "word binary, n bigint, ordinary bigint, toxic bigint")
    words = words.groupBy("word").agg(F.sum("n").alias("n"), F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    words = stage(words, "counts")
    for deviations in DEVIATIONS:
        odds = word_odds(F.col("toxic"), F.col("ordinary"), sizes.get(1, 0), sizes.get(0, 0), deviations)
        rated = words.withColumn("odds", odds)
        named = [(r["odds"], bytes(r["word"])) for r in rated.filter(F.col("odds") > WORD_LIMITS[0]).orderBy("odds", "word").collect()]
        if named:
            break
    words = rated
    common = words.filter((F.col("odds") <= WORD_LIMITS[0]) & (F.col("n") > 0))
    common = [bytes(r["word"]) for r in common.orderBy(F.col("n").desc(), "word").limit(ORDINARY_WORDS).collect()]
    if not named or not common:
        return Detector(b"", b"")
    ordinary = train_dictionary(common[::-1])
    chosen = [[word for odds, word in named if odds > least] for least in WORD_LIMITS[::-1]]
    tried = [Detector(ordinary, train_dictionary(toxic)) for toxic in chosen if toxic]
    seen = _figures_of_each(sample.filter("part = 0"), tried)
    # the first of equals
    return min((_calibrated(d, s) for d, s in zip(tried, seen)), key=lambda found: found[0])[1]


def _figures_of_each(calibration: DataFrame, tried: list[Detector]) -> list[list[tuple]]:
    """Per detector, the sorted (peak, rate, toxic, texts) of ``calibration``.

    The texts are read and cut once for all detectors, which share the ordinary dictionary: a
    window is spelled and compressed with that one once.
    """
    ordinary, toxic = tried[0].ordinary, [d.toxic for d in tried]

    def measured(batches):
        tool = Measure(ordinary, toxic)
        for batch in batches:
            texts, kinds = utf8(batch.column("text")), batch.column("toxic")
            for part in slices_by_bytes(texts):
                for n, found in enumerate(tool.figures(texts[part])):
                    columns = [pa.array([n] * len(found), pa.int32()), kinds[part], *map(pa.array, found.T)]
                    yield pa.RecordBatch.from_arrays(columns, ["nth", "toxic", "peak", "rate"])

    found = calibration.select("toxic", "text").mapInArrow(measured, "nth int, toxic int, peak double, rate double")
    seen = [[] for _ in tried]
    for r in found.groupBy("nth", "toxic", "peak", "rate").count().collect():
        seen[r["nth"]].append((r["peak"], r["rate"], r["toxic"], r["count"]))
    return [sorted(rows) for rows in seen]


def _calibrated(detector: Detector, seen: list[tuple]) -> tuple[int, Detector]:
    """The texts that the detector is wrong about, and it with weights and limit, given what it measures of them."""
    if not seen:
        return 0, replace(detector, limit=1.0)
    figures = np.array([r[:2] for r in seen])
    peak, rate = _weights(figures, np.array([r[2] for r in seen]), np.array([r[3] for r in seen]))
    found = replace(detector, peak=peak, rate=rate)
    errors, limit = _best_limit([(peak * p + rate * r, toxic, n) for p, r, toxic, n in seen])
    return errors, replace(found, limit=limit)


def _weights(figures: np.ndarray, toxic: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Weights of the figures by logistic regression, none below 0: of both, or of the one that fits better."""

    def fitted(columns: list[int]) -> tuple[float, np.ndarray]:
        spread = np.maximum(figures[:, columns].std(axis=0), 1e-9)
        x = np.c_[figures[:, columns] / spread, np.ones(len(figures))]
        at, small = np.zeros(x.shape[1]), np.diag([0.1] * len(columns) + [1e-3])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
            step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + small, x.T @ (n * (toxic - p)) - small @ at)
            at += np.clip(step, -2, 2)
        p = np.clip(1 / (1 + np.exp(-np.clip(x @ at, -30, 30))), 1e-12, 1 - 1e-12)
        weights = np.zeros(2)
        weights[columns] = at[:-1] / spread
        return float(-(n * np.where(toxic == 1, np.log(p), np.log(1 - p))).sum()), weights

    tried = [fitted(c) for c in ([0, 1], [0], [1])]
    good = [t for t in tried if (t[1] >= 0).all() and t[1].any()]
    found = min(good, key=lambda t: t[0])[1] if good else np.array([1.0, 0.0])
    return float(found[0]), float(found[1])


def _best_limit(counts: list[tuple[float, int, int]]) -> tuple[int, float]:
    """The fewest errors, and the saving above which texts are toxic for that, in the middle of the gap."""
    at = Counter()
    for saving, toxic, n in counts:
        at[saving] += n if toxic == 1 else -n
    values = sorted({0.0, *at})
    errors, best = sum(n for _, toxic, n in counts if toxic != 1), None
    for low, high in zip(values, values[1:] + [values[-1] + 2.0]):
        errors += at[low]  # texts of this saving are not toxic from here on
        if best is None or errors < best[0]:
            best = (errors, (low + high) / 2)
    return best


# ---- scoring ----


def measure(docs: DataFrame, detector: Detector, columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``columns`` of every row with the peak, the rate and the saving, their weighted sum, of its whole text.

    Workers keep the windows they have met for later tasks.
    """
    name = f"toxicity {hash((detector.ordinary, detector.toxic))}"

    def measured(batches):
        tool = worker_store(name, lambda: Measure(detector.ordinary, [detector.toxic]))
        for batch in batches:
            texts = utf8(batch.column("_text"))
            found = [tool.figures(texts[part])[0] for part in slices_by_bytes(texts)]
            peak, rate = np.concatenate(found).T if found else np.empty((2, 0))
            rest = batch.drop_columns(["_text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(peak), pa.array(rate)], [*rest.schema.names, "peak", "rate"])

    narrow = docs.select(*columns, F.col("text").cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name != "_text")
    if not detector.toxic:
        return narrow.drop("_text").withColumns({c: F.lit(0.0) for c in ("peak", "rate", "saving")})
    found = narrow.mapInArrow(measured, f"{schema}, peak double, rate double")
    return found.withColumn("saving", detector.peak * F.col("peak") + detector.rate * F.col("rate"))


def score_documents(docs: DataFrame, detector: Detector) -> DataFrame:
    """doc_id, score and predicted of every row of ``docs``, from its whole text alone.

    A null, empty or blank text saves nothing and gets the lowest score. predicted is 1 from
    a score of 0.7. Repeated rows are scored each; other columns are not read.
    """
    found = measure(docs.withColumn("doc_id", F.col("doc_id").cast("bigint")), detector)
    # THRESHOLD at the limit
    odds = math.log(THRESHOLD / (1 - THRESHOLD))
    score = 1 / (1 + F.exp(-(F.col("saving") - detector.limit + odds))) if detector.toxic else F.lit(0.0)
    return found.select("doc_id", score.alias("score"), _is_toxic(detector).cast("int").alias("predicted"))


def _is_toxic(detector: Detector) -> Column:
    return F.lit(False) if not detector.toxic else F.col("saving") >= detector.limit


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def drop_toxic(docs: DataFrame, detector: Detector) -> DataFrame:
    """``docs`` without the rows predicted toxic; all columns stay, and no row is shuffled."""
    plain = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("text"))
    found = measure(plain, detector, ("_row",)).filter(~_is_toxic(detector))
    return found.select("_row.*")
