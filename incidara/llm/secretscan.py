"""Secrets in texts, found through a trigram index.

From each rule's pattern follows which trigrams a text must hold for a match
(``trigram_query``): alternatives, each a set of trigrams. The index lists, for
each trigram that some rule asks for, the digests of the texts that hold it.
Intersecting the lists of an alternative gives candidates; only they are
searched with the pattern. A rule without mandatory trigrams, such as a long
hex number, searches all texts.

All of it is DataFrame work. Equal texts are one entry of the index.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as op, _parser

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage
from .common import text_of

#: Strings that a pattern's fixed part may stand for, and alternatives of a query.
VARIANTS = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` is read alike by Java and Python; ``group`` must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    @property
    def java(self) -> str:
        return ("(?i)" if self.any_case else "") + self.pattern


# The three base kinds, then formats that issuers of tokens publish.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", least=40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"),
)
BASE = ("assign", "access", "hex")


# trigram queries ----------------------------------------------------------------


def _letters(items) -> set[str] | None:
    """The characters of a class, None if they are many."""
    found: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(chr(value).lower())
        elif kind is op.RANGE and value[1] - value[0] < 8:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def _alternatives(strings: set[str]) -> set[frozenset[str]] | None:
    """One of these sets of trigrams is in a text that holds one of ``strings``; None if unknown."""
    if min(map(len, strings)) < 3:
        return None
    return _least({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _least(sets: set[frozenset[str]]) -> set[frozenset[str]]:
    """Without those that hold another one: they say nothing more."""
    return {a for a in sets if not any(b < a for b in sets)}


def _walk(items) -> tuple[set[str] | None, list[set[frozenset[str]]]]:
    """What a parsed pattern stands for: its strings, if few, else what must be in a match
    (clauses that all hold, each a choice of trigram sets)."""
    run, clauses, whole = {""}, [], True

    def end_run():
        nonlocal run, whole
        if (choice := _alternatives(run)) is not None:
            clauses.append(choice)
        run, whole = {""}, False

    for kind, value in items:
        strings, inner, cut = None, [], False
        if kind is op.LITERAL:
            strings = {chr(value).lower()}
        elif kind is op.IN:
            strings = _letters(value)
        elif kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
            strings = {""}
        elif kind is op.SUBPATTERN:
            strings, inner = _walk(value[3])
        elif kind is op.BRANCH:
            branches = [_walk(b) for b in value[1]]
            if all(s is not None for s, _ in branches):
                strings = set().union(*(s for s, _ in branches))
            else:
                choices = [_anded([*c, *([a] if s and (a := _alternatives(s)) else [])]) for s, c in branches]
                if all(c is not None for c in choices):
                    inner = [set().union(*choices)]
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            low, high, repeated = value
            strings, inner = _walk(repeated)
            if (low, high) == (0, 1) and strings is not None:
                strings = strings | {""}
            elif low == 0:
                strings, inner = None, []
            elif strings is not None and (low, high) != (1, 1):
                cut = True  # at least once, then who knows
        if strings is not None and len(strings) * len(run) > VARIANTS:
            end_run()
        if strings is None or len(strings) > VARIANTS:
            end_run()
            clauses += inner
        else:
            run = {a + b for a, b in product(run, strings)}
            if cut:
                end_run()
    if whole:
        return run, []
    end_run()
    return None, clauses


def _anded(clauses: Sequence[set[frozenset[str]]]) -> set[frozenset[str]] | None:
    """Clauses that all hold as one choice; those of too many combinations are left out."""
    whole: set[frozenset[str]] | None = None
    for clause in sorted(clauses, key=len):
        if whole is None:
            whole = set(clause)
        elif len(whole) * len(clause) <= VARIANTS:
            whole = {a | b for a, b in product(whole, clause)}
    return None if whole is None else _least(whole)


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of lower-case trigrams, one of which is in any text (in lower case) that
    matches; None where no trigram is mandatory."""
    strings, clauses = _walk(_parser.parse(pattern))
    choice = _alternatives(strings) if strings is not None else _anded(clauses)
    return None if choice is None else sorted(choice, key=sorted)


# index ---------------------------------------------------------------------------


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(text_of().alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256)))


def trigram_index(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """Posting lists: trigram, digest of a text that holds it in lower case; sorted by both
    within the files, so that a reader of one list skips the rest."""
    # As a row of its own, so that the lower-case text is made once and not for each trigram.
    low = _texts(docs).select("digest", F.explode(F.array(F.lower("text"))).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in sorted(trigrams)]))
    listed = low.select("digest", F.explode(held).alias("trigram")).distinct()
    return stage(listed.sortWithinPartitions("trigram", "digest"), "trigram-index")


def candidates(index: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """digest, kinds: texts that hold all trigrams of an alternative of a rule."""
    asked = [
        (rule.kind, number, trigram, len(alternative))
        for rule in rules
        for number, alternative in enumerate(trigram_query(rule.pattern) or [])
        for trigram in sorted(alternative)
    ]
    # A row for each trigram of a rule: as large as the rules, whatever the texts.
    wanted = index.sparkSession.createDataFrame(asked, "kind string, alternative int, trigram string, needed int")
    return (
        index.join(F.broadcast(wanted), "trigram")
        .groupBy("digest", "kind", "alternative", "needed")
        .agg(F.count("*").alias("held"))
        .filter("held = needed")
        .groupBy("digest")
        .agg(F.collect_set("kind").alias("kinds"))
    )


# search --------------------------------------------------------------------------


def _matches(texts: DataFrame, rule: Rule, number: int) -> DataFrame:
    """A row per match of a rule in ``texts`` (digest, text): its place among the rule's matches,
    the characters since the last one, its own characters, and whether it counts."""
    pattern = F.lit(rule.java)
    parts = F.arrays_zip(
        F.split("text", rule.java, -1).alias("gap"),
        F.regexp_extract_all("text", pattern, F.lit(0)).alias("found"),
        F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("judged"),
    )
    rows = texts.filter(F.rlike("text", pattern)).select("digest", F.posexplode(parts).alias("place", "part"))
    return rows.filter(F.col("part.found").isNotNull()).select(
        "digest",
        F.lit(number).alias("rule"),
        "place",
        F.length("part.gap").alias("gap"),
        F.length("part.found").alias("size"),
        F.when(F.length("part.judged") >= rule.least, F.col("part.found")).alias("found"),
    )


def _long_run(rule: Rule) -> Rule:
    """A rule of one repeated class asks for its least length at once, and only where a run begins:
    the same matches without stopping at each shorter run."""
    parsed = list(_parser.parse(rule.pattern))
    if len(parsed) == 1 and parsed[0][0] is op.MAX_REPEAT and rule.pattern.endswith("]+") and not rule.group:
        one = rule.pattern[:-1]
        return Rule(rule.kind, f"(?<!{one}){one}{{{rule.least},}}", any_case=rule.any_case)
    return rule


def spans(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """digest, spans: per different text with secrets, (start, rule, stop, text) in code points by
    start, then by the rule's number."""
    ruled = list(enumerate(rules))
    queries = {number: trigram_query(rule.pattern) for number, rule in ruled}
    indexed = [(number, rule) for number, rule in ruled if queries[number] is not None]
    texts = _texts(docs)
    matches = [_matches(texts, _long_run(rule), number) for number, rule in ruled if queries[number] is None]
    if indexed:
        asked = {t for number, _ in indexed for alternative in queries[number] for t in alternative}
        chosen = candidates(trigram_index(docs, sorted(asked)), [rule for _, rule in indexed])
        checked = texts.join(chosen, "digest")
        searched = stage(
            reduce(
                DataFrame.union,
                [_matches(checked.filter(F.array_contains("kinds", rule.kind)), rule, number) for number, rule in indexed],
            ),
            "secret-matches",
        )
        matches.append(searched)
    # Equal texts give equal rows; they fold in the tasks.
    found = reduce(DataFrame.union, matches).groupBy("digest", "rule", "place", "gap", "size").agg(F.first("found").alias("found"))
    before = Window.partitionBy("digest", "rule").orderBy("place")
    stop = F.sum(F.col("gap").cast("long") + F.col("size")).over(before)
    placed = found.withColumn("stop", stop).filter("found is not null")
    span = F.struct((F.col("stop") - F.col("size")).alias("start"), "rule", "stop", F.col("found").alias("text"))
    return placed.groupBy("digest").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per row: doc_id and spans, an array of (start, rule, stop, text) that is empty where a text
    has no secret; ``rule`` is the number of the rule, places are code points, ``stop`` exclusive.

    Matches of a rule are leftmost and don't overlap; one whose group is shorter than the rule
    asks is passed over with its text. A null text is empty and has no secrets. Rows that repeat
    come back each; equal texts are searched alike. An empty table gives no rows. Columns but
    doc_id and text are not read, whatever their names. A text's spans stand in one row.
    """
    # Two scans of the texts' digests in place of a shuffle of the texts.
    marked = docs.select("doc_id", F.unhex(F.sha2(text_of(), 256)).alias("digest"))
    found = marked.join(spans(docs, rules), "digest", "left")
    none = F.array().cast("array<struct<start: bigint, rule: int, stop: bigint, text: string>>")
    return found.select("doc_id", F.coalesce("spans", none).alias("spans"))


def _listed(chosen: Column, rules: Sequence[Rule]) -> Column:
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    return F.array_join(
        F.transform(
            chosen, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["stop"].cast("string"))
        ),
        ",",
    )


def audit(docs: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[str] = BASE) -> DataFrame:
    """Per row: doc_id, n_<kind> for each base kind, base_sha256 (of the base spans as
    kind:start:stop, comma-joined) and spans (all of them, written alike)."""
    numbers = {rule.kind: number for number, rule in enumerate(rules)}

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda span: span["rule"].isin([numbers[kind] for kind in kinds]))

    return scan(docs, rules).select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(_listed(of(*base), rules), 256).alias("base_sha256"),
        _listed(F.col("spans"), rules).alias("spans"),
    )
