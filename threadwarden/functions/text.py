"""Text expressions: tokens and terms, scored text, truncation, prompts, token estimates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Characters of a text that are sent to the classifier, and to the language model.
CONTEXT_LIMIT = 19000
JUDGE_LIMIT = 1_000_000

TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    return F.split(F.lower(text), TOKEN_BREAK)


def term_words(term: Column) -> Column:
    """The words a text must hold for the term; a term of symbols alone is one such word."""
    words = F.array_distinct(F.filter(tokens(term), lambda w: w != ""))
    return F.when(F.size(words) > 0, words).when(F.trim(term) != "", F.array(F.lower(term))).otherwise(F.array().cast("array<string>"))


def is_symbols(word: Column) -> Column:
    return word.rlike(f"^{TOKEN_BREAK}$")


def text_words(text: Column, symbol_lengths: Sequence[int] = ()) -> Column:
    """The words of a text and, in the given lengths, the pieces of what stands between them."""
    words = tokens(text)
    if not symbol_lengths:
        return F.array_distinct(words)
    # only runs that are long enough for some piece; a greedy match is always a whole run
    long_run = f"({TOKEN_BREAK.removesuffix('+')}{{{min(symbol_lengths)},}})"
    between = F.regexp_extract_all(F.lower(text), F.lit(long_run), F.lit(1))
    pieces = [
        F.flatten(
            F.transform(
                F.filter(between, lambda b: F.length(b) >= n),
                lambda b: F.transform(F.sequence(F.lit(1), F.length(b) - n + 1), lambda i: F.substring(b, i, F.lit(n))),
            )
        )
        for n in symbol_lengths
    ]
    return F.array_distinct(F.concat(words, *pieces))


def words_of_terms(terms: Sequence[str]) -> dict[str, list[str]]:
    """``term_words`` of a search list, in the order of the list."""
    listed = list(dict.fromkeys(terms))
    if not listed:
        return {}
    spark = SparkSession.active()
    rows = spark.createDataFrame([(t,) for t in listed], "term string").select("term", term_words(F.col("term")).alias("words")).collect()
    found = {r.term: r.words for r in rows}
    return {t: found[t] for t in listed}


def matched_terms(text: Column, terms: Sequence[str]) -> Column:
    """The terms all of whose words occur in ``text``, in the given order.

    Words are first intersected with the vocabulary of all terms, so a long text costs one
    hash pass however many terms there are, and no row leaves its task. A text that holds
    none of them is done at once.
    """
    wanted = [(term, words) for term, words in words_of_terms(terms).items() if words]
    none = F.array().cast("array<string>")
    if not wanted:
        return none
    vocabulary = sorted({w for _, words in wanted for w in words})
    # a run of symbols is looked for as it stands; cutting it out of the text would cost much more
    symbols = [w for w in vocabulary if not any(c.isalnum() for c in w)]
    words = [F.lit(w) for w in vocabulary if w not in symbols]
    hits = F.array_intersect(tokens(text), F.array(*words).cast("array<string>"))
    if symbols:
        found = [F.when(F.contains(F.lower(text), F.lit(s)), F.lit(s)) for s in symbols]
        hits = F.concat(hits, F.array_compact(F.array(*found)))
    listed = F.array(
        *[F.struct(F.lit(t).alias("term"), F.array(*[F.lit(w) for w in words]).alias("words")) for t, words in wanted]
    )

    def complete(found: Column) -> Column:
        all_met = F.filter(listed, lambda t: F.size(F.array_except(t["words"], found)) == 0)
        return F.when(F.size(found) > 0, F.transform(all_met, lambda t: t["term"])).otherwise(none)

    # bound as a lambda variable, the hits are computed once per row rather than per term
    return F.coalesce(F.get(F.transform(F.array(hits), complete), F.lit(0)), none)


def post_text(title: Column, selftext: Column) -> Column:
    return F.concat_ws(" ", title, selftext)


def truncated(text: Column, context_size: int | None = CONTEXT_LIMIT) -> Column:
    """The first ``context_size`` code points; None: all."""
    return text if context_size is None else F.substring(text, 1, context_size)


def prompt(post_id: Column, text: Column) -> Column:
    return F.concat(F.lit("[Post ID: "), post_id, F.lit("] "), text)


def token_estimate(prompt_text: Column, response_text: Column) -> Column:
    """About four characters per token, each side rounded down."""
    return F.floor(F.length(prompt_text) / 4) + F.floor(F.length(response_text) / 4)


def stable_id(*keys: Column) -> Column:
    """An id that a rerun repeats, unlike a random one."""
    return F.sha2(F.concat_ws(":", *[k.cast("string") for k in keys]), 256)
