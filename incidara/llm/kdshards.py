"""Shards as leaves of a k-d tree over metadata, cut at weighted medians.

Native Spark throughout: a node is cut along its widest dimension at the place
where its bytes divide as its leaves do. The place is found in a few rounds of
partial sums over ever finer bins, so a cut needs no sort and no sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage

#: Bits of an order key: a dimension's value, the text's checksum, the id's hash.
VALUE_BITS, SUM_BITS, ID_BITS = 24, 20, 20
#: Bits of the key that a round settles; a round's sums have so many bins per node.
ROUND_BITS = 16
#: Bits by which rows of one key are told apart.
TIE_BITS = 32
#: Runs into which a shard is cut to number its rows.
SLOT_RUNS = 4096


def _unit(column: Column, low, high) -> Column:
    """To 0..1 over the table's range; null and flat dimensions are 0."""
    width = float(high - low) if high is not None else 0.0
    if not width:
        return F.lit(0.0)
    return F.coalesce((column - F.lit(float(low))) / F.lit(width), F.lit(0.0))


def metadata(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, the dimensions d0 (log size), d1 (lang), d2 (source), as 0..1, and tie."""
    columns = {c.lower() for c in docs.columns}
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1

    def code(name: str) -> Column:
        return F.crc32(F.col(name).cast("string")).cast("double") if name in columns else F.lit(None).cast("double")

    raw = docs.select(
        F.col("doc_id"),
        size.alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.log2(size).alias("d0"),
        code("lang").alias("d1"),
        code("source").alias("d2"),
    )
    raw = _tied(stage(raw, "shard-rows"))
    ends = raw.agg(*(f(d).alias(f"{d}{n}") for d in ("d0", "d1", "d2") for n, f in (("l", F.min), ("h", F.max)))).first()
    return raw.withColumns({d: _unit(F.col(d), ends[f"{d}l"], ends[f"{d}h"]) for d in ("d0", "d1", "d2")})


def _tied(staged: DataFrame) -> DataFrame:
    """With ``tie``, a hash of the row's place in the written table: rows alike in all else differ in it."""
    part = F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1)
    place = F.xxhash64(part, F.col("_metadata.row_index"))
    return staged.withColumn("tie", F.pmod(place, F.lit(1 << TIE_BITS)))


def _order_key(dimension: Column) -> Column:
    """A 64-bit order: the value, then the text, then the id; copies stand side by side."""
    top = (1 << VALUE_BITS - 1) - 1  # one bit less keeps the key positive
    return (
        F.shiftleft(F.floor(dimension * top).cast("long"), SUM_BITS + ID_BITS)
        .bitwiseOR(F.shiftleft(F.pmod(F.xxhash64("text_crc32"), F.lit(1 << SUM_BITS)), ID_BITS))
        .bitwiseOR(F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(1 << ID_BITS)))
    )


def _pick(column: str, choices: dict, otherwise: Column) -> Column:
    out = otherwise
    for value, then in choices.items():
        out = F.when(F.col(column) == value, then).otherwise(out)
    return out


def _cuts(keyed: DataFrame, shares: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """For each node the (key, tie) at which its first (part / whole) of the bytes is reached.

    Rows up to it go left. The bin that holds the place is refined ``ROUND_BITS``
    at a time until it is one key, and, where several rows have that key, on
    through their ties.
    """
    settled_keys, before, goal, rows = _narrow(keyed, "key", VALUE_BITS + SUM_BITS + ID_BITS, shares, {}, {})
    crowded = [n for n in settled_keys if rows[n] > 1]
    ties: dict[int, int] = {}
    if crowded:
        at_key = _pick("node", {n: F.lit(settled_keys[n]) for n in crowded}, F.lit(-1))
        ties, *_ = _narrow(keyed.filter(F.col("key") == at_key), "tie", TIE_BITS, {}, before, goal)
    return {n: (key, ties.get(n, 1 << TIE_BITS)) for n, key in settled_keys.items()}


def _narrow(
    rows: DataFrame, column: str, total: int, shares: dict, before: dict[int, int], goal: dict[int, float]
) -> tuple[dict[int, int], dict[int, int], dict[int, float], dict[int, int]]:
    """Per node: the value of ``column`` (``total`` bits) where ``goal`` bytes are reached, the
    bytes ``before`` that value, the goal, and the number of rows with it.

    Without a goal, it is the node's part of all its bytes by ``shares``.
    """
    prefix: dict[int, int] = {}  # settled high bits
    before, goal, counts = dict(before), dict(goal), {}
    for settled in range(0, total, ROUND_BITS):
        low = total - settled - ROUND_BITS
        inside = rows
        if settled:
            wanted = _pick("node", {n: F.lit(p) for n, p in prefix.items()}, F.lit(-1))
            inside = rows.filter(F.shiftright(column, low + ROUND_BITS) == wanted)
        bins = inside.groupBy("node", F.shiftright(column, low).alias("bin")).agg(
            F.sum("size").alias("bytes"), F.count("*").alias("n")
        )
        running = Window.partitionBy("node").orderBy("bin")
        sums = bins.withColumns(
            {"upto": F.sum("bytes").over(running), "all": F.sum("bytes").over(Window.partitionBy("node"))}
        )
        if not goal:
            share = _pick("node", {n: F.lit(a / b) for n, (a, b) in shares.items()}, F.lit(0.0))
            aim, done = F.col("all") * share, F.lit(0)
        else:
            aim = _pick("node", {n: F.lit(float(g)) for n, g in goal.items()}, F.lit(0.0))
            done = _pick("node", {n: F.lit(b) for n, b in before.items()}, F.lit(0))
        reached = sums.withColumns({"aim": aim, "end": F.col("upto") + done}).filter(F.col("end") >= F.col("aim"))
        found = reached.groupBy("node").agg(F.min(F.struct("bin", "bytes", "end", "aim", "n")).alias("at")).collect()
        for row in found:  # one row per node: at most as many as leaves
            prefix[row.node] = row.at.bin
            before[row.node] = row.at.end - row.at.bytes
            goal[row.node] = row.at.aim
            counts[row.node] = row.at.n
    return prefix, before, goal, counts


def kd_leaves(rows: DataFrame, leaves: int, dimensions=("d0", "d1", "d2")) -> DataFrame:
    """``rows`` (of ``metadata``) with their leaf: ``shard`` from 0 to ``leaves`` - 1.

    A node of n leaves is cut so that its left part has n // 2 of n parts of its
    bytes, up to the row at the cut. Widest is the dimension of largest range
    within the node; ties go to the first. Rows that repeat both id and text are
    parted too, by their place in the staged table.
    """
    nodes = {0: (0, leaves)}  # node: first leaf, leaves
    rows = rows.withColumn("node", F.lit(0))
    while any(n > 1 for _, n in nodes.values()):
        open_nodes = {k: v for k, v in nodes.items() if v[1] > 1}
        ranges = (
            rows.filter(F.col("node").isin(list(open_nodes)))
            .groupBy("node")
            .agg(*((F.max(d) - F.min(d)).alias(d) for d in dimensions))
            .collect()
        )
        widest = {r.node: max(dimensions, key=lambda d: r[d]) for r in ranges}
        key = _pick("node", {n: _order_key(F.col(d)) for n, d in widest.items()}, F.lit(None).cast("long"))
        keyed = rows.withColumn("key", key)
        cuts = _cuts(
            keyed.filter(F.col("key").isNotNull()), {n: (open_nodes[n][1] // 2, open_nodes[n][1]) for n in widest}
        )
        after: dict[int, tuple[int, int]] = {}
        side = F.col("node") + F.lit(0)
        for node, (first, n) in nodes.items():
            if n == 1:
                after[first] = (first, 1)
                continue
            half = n // 2
            after[first], after[first + half] = (first, half), (first + half, n - half)
            if node in cuts:
                at, tie = cuts[node]
                later = (F.col("key") > at) | ((F.col("key") == at) & (F.col("tie") > tie))
                right = (F.col("node") == node) & later
                side = F.when(right, F.lit(first + half)).otherwise(side)
        nodes = after
        rows = keyed.withColumn("node", side).drop("key")
    return rows.withColumnRenamed("node", "shard")


def shards(docs: DataFrame, count: int = 8, slot_runs: int = SLOT_RUNS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is ``bytes``: shard sizes are near equal, apart by rows at the cuts.
    Sizes are UTF-8 bytes of the text plus one (null text: one). Slots number a
    shard's rows from 0 in order of a hash of id, text and place; each shard is
    numbered in ``slot_runs`` runs side by side, so no task orders a whole shard,
    whatever repeats. Null ids, sources and languages are values like others;
    repeated rows keep their own slots and are cut where a shard's bytes are
    reached; an empty table gives no rows; other columns are ignored.
    """
    rows = stage(kd_leaves(metadata(docs), count), "shard-leaves").withColumn("hash", F.xxhash64("doc_id", "text_crc32", "tie"))
    rows = rows.withColumn("run", F.pmod("hash", F.lit(slot_runs)).cast("int"))
    runs = rows.groupBy("shard", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        "shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("shard", "run").orderBy("hash", "doc_id", "size")
    numbered = rows.withColumn("place", F.row_number().over(within) - 1).join(offsets, ["shard", "run"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int"),
        (F.col("offset") + F.col("place")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
