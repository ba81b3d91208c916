"""SimHash near duplicates, joined on Golay codewords of fingerprint segments.

Fingerprints of 64 bits are cut into segments of 23, 23 and 18 bits. If two
differ in at most two bits, some segment is free of errors and the next one
holds at most two. Two 23-bit words with at most two differences share a Golay
codeword within distance four of both: the nearest codeword of a word between
them. A word has one such codeword, or six when it is three away from the
nearest. So (equal segment, codeword of the next) gives up to 18 keys per
fingerprint, and pairs that share a key are verified on all bits.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .common import beside_helpers, map_rows, small_batches
from .components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: Generator polynomial of the binary Golay code of length 23 (a fixed value).
GENERATOR = 0b110001110101
#: Segments as (first bit, bits).
SEGMENTS = ((0, 23), (23, 23), (46, 18))
#: Different fingerprints under one key that are compared pair by pair.
BUCKET = 64
#: Bytes of text that are split into words at a time.
PIECE = 1 << 20

_BLANKS = b" \t\n\x0b\x0c\r"


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each bit set, highest bit first."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        octets = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int32)
    return total


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number; a text without words has zero."""
    data = (text or "").encode().lower()  # of bytes: A-Z only
    counts, n, at = np.zeros(64, np.int64), 0, 0
    words: list[bytes] = []
    while at < len(data):
        end = min(at + PIECE, len(data))
        while end < len(data) and data[end] not in _BLANKS:
            end += 1
        words += data[at:end].split()
        at = end
        if len(words) >= size:
            hashes = _hashes(words, size)
            counts += _bit_counts(hashes)
            n += len(hashes)
            words = words[len(words) - size + 1 :] if size > 1 else []
    if not n:
        if not words:
            return 0
        hashes = _hashes([b" ".join(words)], 1)
        counts, n = _bit_counts(hashes), 1
    value = int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")
    return value - (1 << 64) if value >> 63 else value


def _remainder(words: np.ndarray) -> np.ndarray:
    """Of 23-bit words divided by the generator."""
    words = words.copy()
    for bit in range(22, 10, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - 11), 0)
    return words


def golay_masks() -> np.ndarray:
    """By remainder: what turns a word into each codeword within distance 4; -1 fills up."""
    codewords = np.arange(1 << 12, dtype=np.int64) << 11
    codewords |= _remainder(codewords)
    sevens = [int(c) for c in codewords if int(c).bit_count() == 7]
    errors = [sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(23), n)]
    masks = np.full((1 << 11, 6), -1, np.int64)
    for error, rest in zip(errors, _remainder(np.array(errors, np.int64))):
        near = [error]
        if error.bit_count() == 3:
            near += [error ^ c for c in sevens if c & error == error]
        masks[rest, : len(near)] = near
    return masks


def keys_of(prints: np.ndarray, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Join keys, and for each the index of its fingerprint."""
    value = prints.view(np.uint64)
    parts = [(value >> np.uint64(s) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    keys, owners = [], []
    for i, part in enumerate(parts):
        other = parts[(i + 1) % len(parts)]
        near = masks[_remainder(other)]
        row, col = np.nonzero(near >= 0)
        index = (other[row] ^ near[row, col]) >> 11
        keys.append((np.int64(i) << 36) | part[row] << 12 | index)
        owners.append(row)
    return np.concatenate(keys), np.concatenate(owners)


def _keyed(prints: DataFrame) -> DataFrame:
    small_batches(prints.sparkSession)
    masks = golay_masks()
    schema = pa.schema([("key", pa.int64()), ("u", pa.int64())])

    def run(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False)
            keys, owners = keys_of(values, masks)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(values[owners])], schema=schema)

    return prints.select("u").mapInArrow(run, "key long, u long")


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (u, v) of the different fingerprints in ``prints`` (u long) that connect
    whatever ``MAX_BITS`` or fewer bits connect.

    Keys of up to ``bucket`` fingerprints are joined pair by pair. Fingerprints
    under a larger key are instead linked through the values one bit away: two
    of them within two bits share such a value, and all that share it are within
    two bits of each other, so each is linked to the least of them. That is 65
    rows per fingerprint however large the key is, and loses no connection.
    """
    keyed = _keyed(prints)
    hot = keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > bucket).select("key")
    calm = keyed.join(hot, "key", "left_anti")
    near = (
        calm.join(calm.withColumnRenamed("u", "v"), "key")
        .filter((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS))
        .select("u", "v")
        .distinct()
    )
    flips = F.array(F.lit(0).cast("long"), *(F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long") for b in range(64)))
    around = (
        keyed.join(hot, "key", "left_semi")
        .select("u")
        .distinct()
        .withColumn("middle", F.explode(F.transform(flips, lambda f: F.col("u").bitwiseXOR(f))))
    )
    least = around.groupBy("middle").agg(F.min("u").alias("v"), F.count("*").alias("n")).filter("n > 1")
    stars = around.join(least, "middle").filter("u <> v").select("u", "v").distinct()
    return near.union(stars)


def _printed(docs: DataFrame, size: int, *carried: Column) -> DataFrame:
    """Per row of ``docs``: doc_id, u (its fingerprint) and the columns ``carried``, staged."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", *carried)
    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in rows.schema[2:])

    def prints(rows):
        for doc_id, text, *rest in rows:
            yield doc_id, fingerprint(text, size), *rest

    return stage(map_rows(rows, f"doc_id long, u long{kinds}", prints), "prints")


def _rooted(distinct: DataFrame, bucket: int) -> DataFrame:
    """``distinct`` (a row per fingerprint u) with the root of each one's component."""
    roots = stage(components(links(distinct, bucket)), "roots")
    return distinct.join(roots.withColumnRenamed("node", "u"), "u", "left").withColumn("root", F.coalesce("root", "u"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the least doc_id that links of at most ``MAX_BITS`` differing
    bits reach, the row's own included. Null and empty texts have fingerprint
    zero and link like any other; a text of fewer words than a shingle is one
    shingle. Rows with a null doc_id link others but never name a component,
    unless all its rows are such (then null). Repeated rows are repeated. An
    empty table gives no rows. Equal fingerprints fold before the join, so
    copies cost one row; other columns are ignored.
    """
    table = _printed(docs, size)
    distinct = stage(table.groupBy("u").agg(F.min("doc_id").alias("least")), "print-classes")
    rooted = _rooted(distinct, bucket)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stage(rooted.join(named, "root").select("u", "component_id"), "print-components")
    return table.join(classes, "u").select(
        "doc_id", F.lpad(F.lower(F.hex("u")), 16, "0").alias("fingerprint"), "component_id"
    )


@beside_helpers
def keep_one(docs: DataFrame, size: int = SHINGLE, bucket: int = BUCKET) -> DataFrame:
    """One document of each component: that of least (doc_id, digest of the text), null ids last.

    Columns are those of ``docs``. Each component keeps exactly one row, whether
    its doc_ids are null or stand in other components as well; of rows equal in
    doc_id and text any one stays. The least of a component folds in the tasks
    before it is shuffled.
    """
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("__digest")
    table = _printed(docs, size, digest)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__digest")).alias("least")
    rooted = _rooted(stage(table.groupBy("u").agg(least), "print-classes"), bucket)
    kept = (
        rooted.groupBy("root")
        .agg(F.min("least").alias("least"))
        .select(F.col("least.doc_id").alias("__kept"), F.col("least.__digest").alias("__sum"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("__kept")) & (F.col("__digest") == F.col("__sum"))
    found = docs.withColumn("__digest", digest).join(kept, same, "left_semi")
    return found.dropDuplicates(["doc_id", "__digest"]).drop("__digest")
