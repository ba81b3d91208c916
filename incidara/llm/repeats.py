"""Repeated byte strings, by a column-wise suffix order of aligned passages.

Every string of ``LENGTH`` bytes holds an anchor: a gram whose hash is least among
its grams. Copies of a string hold the same anchor at the same place, so only
passages around equal grams are compared. The passages stand aligned at their
gram; column by column, from the right, one symbol of each is put before its
suffix, and the order of all suffixes (the collection's Burrows-Wheeler order)
and the common prefixes of neighbours are brought up to date from those of the
column before. A window is repeated if its suffix shares ``LENGTH`` bytes with a
neighbour. Spark's sorted shuffle files feed the passages in sequence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .common import beside_helpers, map_rows

LENGTH = 400
#: Bytes of a gram, a power of two; longer ones make fewer passages that only begin alike.
GRAM = 128
#: Bytes of a text whose anchors are sought at a time.
PIECE = 1 << 20
#: Passages in one column-wise construction; a gram's passages stay together.
BATCH = 4096
#: Different passages around one gram up to which they are ordered together.
HOT_GRAM = 20_000

_MASK = (1 << 64) - 1


def _mixed(n: int) -> int:
    """A well-spread 64-bit number for ``n`` (the SplitMix64 finaliser)."""
    z = (n + 1) * 0x9E3779B97F4A7C15 & _MASK
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & _MASK
    z = (z ^ z >> 27) * 0x94D049BB133111EB & _MASK
    return z ^ z >> 31


_BYTE_CODES = np.array([_mixed(b) for b in range(256)], np.uint64)


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the ``gram`` bytes (a power of two) from each place."""
    h, span = _BYTE_CODES[data], 1
    while span < gram:
        h = h[:-span] * np.uint64(_mixed(1000 + span) | 1) + (h[span:] ^ (h[span:] >> np.uint64(29)))
        span *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """The least or greatest (``best``) of each ``width`` neighbours."""
    span = 1
    while 2 * span <= width:
        values = best(values[:-span], values[span:])
        span *= 2
    return best(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def anchors(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int]]:
    """(place, hash) of each gram that is least in some window of ``length`` bytes.

    All of equal grams count, so the choice depends on the window's bytes alone.
    """
    grams = length - gram + 1
    for first in range(0, max(1, len(data) - gram + 1), PIECE):
        low, high = max(0, first - length), min(len(data), first + PIECE + length)
        if high - low < length:
            continue
        h = _gram_hashes(np.frombuffer(data, np.uint8, high - low, low), gram)
        least = _sliding(h, grams, np.minimum)
        edge = np.zeros(grams - 1, np.uint64)
        greatest = _sliding(np.concatenate([edge, least, edge]), grams, np.maximum)
        for place in np.flatnonzero(greatest == h).tolist():
            if first <= low + place < first + PIECE:
                yield low + place, int(h[place].astype(np.int64))


def _passage(data: bytes, place: int, length: int, gram: int) -> tuple[bytes, int]:
    """The bytes that windows around the gram can reach, and how many stand before it."""
    before = min(place, length - gram)
    return data[place - before : place + length], before


def column_wise(passages: list[tuple[bytes, int]], length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """For each passage (bytes, bytes before its gram) and each first column of a
    window whether the window's bytes stand in the same columns of another passage."""
    lead = length - gram
    width, n = lead + length, len(passages)
    table = np.full((width, n), 256, np.uint16)  # 256: beyond the text, equal to nothing
    for i, (data, before) in enumerate(passages):
        table[lead - before : lead - before + len(data), i] = np.frombuffer(data, np.uint8)
    order = np.arange(n)
    common = np.zeros(n + 1, np.int32)  # of a suffix and the one before it in order
    repeated = np.zeros((n, lead + 1), bool)
    for column in range(width - 1, -1, -1):
        symbols = table[column][order]
        moved = np.argsort(symbols, kind="stable")
        sorted_symbols = symbols[moved]
        same = (sorted_symbols[1:] == sorted_symbols[:-1]) & (sorted_symbols[1:] < 256)
        fresh = np.zeros(n + 1, np.int32)
        if n > 1:
            # between two that come together, the least of the common prefixes passed over
            ends = np.empty(2 * (n - 1), np.int64)
            ends[0::2], ends[1::2] = moved[:-1] + 1, moved[1:] + 1
            fresh[1:n] = np.where(same, 1 + np.minimum.reduceat(common, ends)[0::2], 0)
        order, common = order[moved], fresh
        if column <= lead:
            repeated[order, column] = (common[:n] >= length) | (common[1:] >= length)
    return repeated


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """Runs [first, end) of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[0::2].tolist(), edges[1::2].tolist()))


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, batch: int = BATCH, hot_gram: int = HOT_GRAM
) -> DataFrame:
    """__id, __sum, __spans: the spans [first, end) of bytes that repeated strings cover.

    One row per (doc_id, digest of the text) that has some; spans may overlap.
    Equal passages fold before they are compared: whatever occurs twice as a
    whole is repeated as a whole, and one stands for all. Passages around a
    gram that has more than ``hot_gram`` different ones are not ordered in one
    task; their windows are counted by digest, with partial sums, instead.
    """
    lead = length - gram
    keyed = docs.select(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__sum"), "text")
    kind = next(f.dataType.simpleString() for f in docs.schema if f.name.lower() == "doc_id")
    key = f"__id {kind}, __sum long"

    def find(rows):
        for doc, digest, text in rows:
            data = (text or "").encode()
            seen: dict[bytes, tuple] = {}
            covered: list[list[int]] = []
            for place, name in anchors(data, length, gram):
                passage, before = _passage(data, place, length, gram)
                content = xxhash.xxh3_128_digest(passage, seed=before)
                if content not in seen:
                    seen[content] = place, name, before, len(passage)
                    continue
                # the same passage twice in this text: both are repeated as a whole
                for at in (seen[content][0], place):
                    first, end = at - before, at - before + len(passage)
                    if covered and covered[-1][0] <= first <= covered[-1][1]:
                        covered[-1][1] = max(covered[-1][1], end)
                    else:
                        covered.append([first, end])
            for content, (place, name, before, size) in seen.items():
                yield doc, digest, name, content, place - before, before, size
            for first, end in covered:
                yield doc, digest, None, None, first, None, end - first

    found = stage(
        map_rows(keyed, f"{key}, gram long, content binary, first int, before int, size int", find), "anchors"
    )
    marked = found.filter("gram IS NOT NULL")
    classes = marked.groupBy("gram", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("__id", "__sum", "first", "before", "size")).alias("one")
    )
    shared = (
        classes.groupBy("gram").agg(F.count("*").alias("kinds"), F.sum("n").alias("all")).filter("`all` > 1")
    )
    shared = stage(classes.join(shared, "gram").select("gram", "content", "n", "kinds", "one"), "shared-passages")

    whole = marked.join(shared.filter("n > 1").select("gram", "content"), ["gram", "content"], "left_semi")
    span = F.struct(F.col("first"), (F.col("first") + F.col("size")).alias("end"))
    known = found.filter("gram IS NULL").unionByName(whole).select("__id", "__sum", span.alias("span"))

    wanted = (
        shared.filter("kinds > 1")
        .select("one.__id", "one.__sum", F.struct("gram", "one.first", "one.before", "one.size", "kinds").alias("cut"))
        .groupBy("__id", "__sum")
        .agg(F.collect_list("cut").alias("cuts"))
    )
    texts = keyed.join(
        wanted.select(F.col("__id").alias("__id2"), F.col("__sum").alias("__sum2"), "cuts"),
        F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__sum") == F.col("__sum2")),
    ).select("__id", "__sum", "text", "cuts")

    def cut(rows):
        for doc, digest, text, cuts in rows:
            data = (text or "").encode()
            for c in cuts:
                yield doc, digest, c["gram"], c["kinds"], c["first"], c["before"], data[c["first"] : c["first"] + c["size"]]

    passages = map_rows(texts, f"{key}, gram long, kinds long, first int, before int, passage binary", cut)
    most_kinds = shared.agg(F.max("kinds")).first()[0] or 0
    if most_kinds > hot_gram:
        passages = stage(passages, "cut-passages")
    calm = passages.filter(F.col("kinds") <= hot_gram).repartition("gram").sortWithinPartitions("gram")

    def order(rows):
        held: list[tuple] = []
        for _, group in groupby(rows, key=lambda r: r[2]):
            held.extend(group)
            if len(held) >= batch:
                yield from compare(held)
                held = []
        if held:
            yield from compare(held)

    def compare(held):
        flags = column_wise([(r[6], r[5]) for r in held], length, gram)
        for i in np.flatnonzero(flags.any(axis=1)).tolist():
            doc, digest, _, _, first, before, _ = held[i]
            shift = first + before - lead
            for a, b in _runs(flags[i]):
                yield doc, digest, (shift + a, shift + b - 1 + length)

    spans = known.union(map_rows(calm, f"{key}, span struct<first:int,end:int>", order))
    if most_kinds > hot_gram:
        spans = spans.union(_counted_windows(passages.filter(F.col("kinds") > hot_gram), key, length))
    return spans.groupBy("__id", "__sum").agg(F.collect_list("span").alias("__spans"))


def _counted_windows(passages: DataFrame, key: str, length: int) -> DataFrame:
    """Repeated windows of passages, by the count of each window's digest and place in its column."""

    def windows(rows):
        for doc, digest, name, _, first, before, passage in rows:
            for at in range(len(passage) - length + 1):
                content = hashlib.blake2b(passage[at : at + length], digest_size=16).digest()
                yield doc, digest, content, first + at

    rows = map_rows(passages, f"{key}, content binary, first int", windows).distinct()
    twice = rows.groupBy("content").agg(F.count("*").alias("n")).filter("n > 1").select("content")
    span = F.struct(F.col("first"), (F.col("first") + length).alias("end"))
    return rows.join(twice, "content", "left_semi").select("__id", "__sum", span.alias("span"))


def merged(spans) -> list[tuple[int, int]]:
    """Maximal runs of the union of spans."""
    out: list[list[int]] = []
    for span in sorted((s["first"], s["end"]) for s in spans or ()):
        if out and span[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], span[1])
        else:
            out.append(list(span))
    return [(a, b) for a, b in out]


def _with_spans(docs: DataFrame, length: int, **limits) -> DataFrame:
    spans = repeated_spans(docs, length, **limits)
    marked = docs.withColumn("__sum1", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sum1") == F.col("__sum"))
    return marked.join(spans, same, "left").drop("__id", "__sum", "__sum1")


def _left(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    """The bytes outside the runs."""
    parts, at = [], 0
    for first, end in runs:
        parts.append(data[at:first])
        at = end
    return b"".join([*parts, data[at:]])


def audit(docs: DataFrame, length: int = LENGTH, with_text: bool = False, **limits) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (of the bytes that stay).

    ``with_text`` adds text, as ``remove_repeats`` leaves it: the digest is of all
    bytes that stay, the text is without broken characters at the cuts.

    A byte goes if a string of ``length`` bytes that covers it also starts at
    another place of the table, overlaps and repeated rows included. Strings
    never cross texts. Null counts as empty, which has nothing to remove; other
    columns are ignored; an empty table gives no rows.
    """
    table = _with_spans(docs.select("doc_id", "text"), length, **limits)

    def digest(rows):
        for doc, text, spans in rows:
            data = (text or "").encode()
            runs = merged(spans)
            left = _left(data, runs)
            row = doc, len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(left).hexdigest()
            yield (*row, left.decode(errors="ignore") if runs else text) if with_text else row

    kind = next(f.dataType.simpleString() for f in docs.schema if f.name.lower() == "doc_id")
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        schema += ", text string"
    return map_rows(table.select("doc_id", "text", "__spans"), schema, digest)


@beside_helpers
def remove_repeats(docs: DataFrame, length: int = LENGTH, **limits) -> DataFrame:
    """The documents without repeated bytes; broken characters at the cuts go as well.

    Columns are those of ``docs``; see ``audit`` for nulls and ties.
    """
    table = _with_spans(docs, length, **limits).select(*[f"`{c}`" for c in docs.columns], "__spans")
    place = next(i for i, c in enumerate(docs.columns) if c.lower() == "text")

    def cut(rows):
        for *row, spans in rows:
            if spans:
                row[place] = _left(row[place].encode(), merged(spans)).decode(errors="ignore")
            yield tuple(row)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_rows(table, kinds, cut)
