"""Spelling variants, grouped by PartEnum signatures of letter multisets.

A word is the binary vector of its letters, each with a running number among
its equals: ``letter`` has l1 e1 t1 t2 e2 r1. One edit changes at most two
components (a replaced letter takes one out and puts one in). The components
are dealt by hash into ``PARTITIONS`` partitions; two vectors that differ in at
most two of them agree in all partitions but two. So a word has a signature for
each choice of the other partitions, and near words share one of them.

One edit also leaves the first or the last half of the shorter word as it is
and the lengths differ by one at most. Both are parts of the key that is
joined on, so that words of few letters don't meet all their anagrams.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import lru_cache
from itertools import combinations

import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .common import map_rows, text_of

LEAST_LETTERS = 5
LEAST_COUNT = 3
#: A word's form occurs so many times as often.
TIMES = 2
PARTITIONS = 4
DISTANCE = 2
#: One in so many places loses a letter (``noise``).
NOISE_EVERY = 97
#: Different words that a task counts before it hands them on.
HELD = 1 << 19

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")  # [a-z and U+00C0 to U+00FF] in UTF-8


def word_counts(docs: DataFrame, noise_every: int = NOISE_EVERY) -> DataFrame:
    """word, n: maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF), A-Z in lower case.

    Where ``noise_every`` divides h, the crc32 of ``<doc_id>:<run>``, the run loses its code
    point number h % length. Null text has no words; a null doc_id is written as nothing.
    """

    def count(rows):
        held: dict[bytes, int] = {}
        for doc_id, text in rows:
            prefix = zlib.crc32(b":" if doc_id is None else b"%s:" % doc_id.encode())
            for run, n in Counter(_RUN.findall(text.encode().translate(_FOLD))).items():
                h = zlib.crc32(run, prefix)
                if h % noise_every == 0:
                    letters = run.decode()
                    at = h % len(letters)
                    run = (letters[:at] + letters[at + 1 :]).encode()
                held[run] = held.get(run, 0) + n
            if len(held) > HELD:
                yield from ((run.decode(), n) for run, n in held.items())
                held.clear()
        yield from ((run.decode(), n) for run, n in held.items())

    texts = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text"))
    return map_rows(texts, "word string, n long", count).groupBy("word").agg(F.sum("n").alias("n"))


_MASK = (1 << 64) - 1


@lru_cache(maxsize=1 << 14)
def _component(letter: str, number: int) -> int:
    return xxhash.xxh64_intdigest(f"{letter}{number}")


def signatures(word: str, partitions: int = PARTITIONS, distance: int = DISTANCE) -> list[int]:
    """A hash of the word's vector within each choice of all partitions but ``distance``.

    A set is hashed by the sum of its components' hashes; equal hashes of
    different sets only make a pair that the check throws out.
    """
    sums, seen = [0] * partitions, {}
    for letter in word:
        seen[letter] = number = seen.get(letter, 0) + 1
        h = _component(letter, number)
        sums[h % partitions] += h
    chosen = combinations(sums, partitions - distance)
    return [(sum(kept) + number) * 0x9E3779B97F4A7C15 & _MASK for number, kept in enumerate(chosen)]


def _keyed(words: DataFrame, partitions: int) -> DataFrame:
    """key, shorter (length of the shorter word of a pair), word, n."""

    def keys(rows):
        for word, n in rows:
            signed = signatures(word, partitions)
            for shorter in (len(word), len(word) - 1):
                half = shorter // 2
                for side in ("<" + word[:half], ">" + word[len(word) - half :]):
                    seed = xxhash.xxh64_intdigest(f"{shorter}{side}")
                    for signature in signed:
                        key = signature ^ seed
                        yield key - (key >> 63 << 64), shorter, word, n

    return map_rows(words.select("word", "n"), "key long, shorter int, word string, n long", keys)


def near_words(words: DataFrame, partitions: int = PARTITIONS) -> DataFrame:
    """word, n, near, near_n: each pair (both ways round) that differs by one inserted, deleted
    or replaced code point. ``words`` holds different words (word, n)."""
    keyed = stage(_keyed(words, partitions), "spelling-keys")
    one = keyed.filter(F.length("word") == F.col("shorter")).select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    other = keyed.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    pairs = one.join(other, "key").filter(
        ((F.length("a") < F.length("b")) | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b"))))
        & (F.levenshtein("a", "b", 1) == 1)
    )
    pairs = pairs.select("a", "a_n", "b", "b_n").distinct()
    return pairs.selectExpr("stack(2, a, a_n, b, b_n, b, b_n, a, a_n) AS (word, n, near, near_n)")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each chain of forms, by doubling jumps; ``forms`` is word, form.

    A form occurs at least twice as often, so chains are no longer than a count has bits."""
    jumps = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = jumps.select(F.col("word").alias("at"), F.col("root").alias("further"))
        longer = jumps.join(on, F.col("root") == F.col("at"), "left")
        moved = stage(
            longer.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots",
        )
        jumps = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return jumps


def variants(
    docs: DataFrame,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    times: int = TIMES,
    noise_every: int = NOISE_EVERY,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """Words with the spelling they go back to: word, form, root, n, n_near, form_n.

    Words are those of :func:`word_counts` with ``least_letters`` code points and
    ``least_count`` places. ``form`` is the near word (one edit away) of most places, ties to
    the first in code-point order, if it has ``times`` as many as the word (else null);
    ``root`` ends the chain of forms and is the word itself where there is none. All near
    words count in ``n_near``.

    Rows that repeat count each; an empty table, null and empty texts give no words; columns
    but doc_id and text are not read, whatever their names. Memory holds a text and up to
    ``HELD`` words a task.
    """
    words = stage(
        word_counts(docs, noise_every).filter((F.length("word") >= least_letters) & (F.col("n") >= least_count)), "spelling-words"
    )
    best = (
        near_words(words, partitions)
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    )
    found = words.join(best, "word", "left")
    much = -F.col("best.less") >= times * F.col("n")
    found = stage(
        found.select(
            "word",
            F.when(much, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(much, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(found.filter("form is not null"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
