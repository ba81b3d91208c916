"""Benchmark decontamination by a generalised suffix automaton over words.

The automaton of all test items is built once per bounded shard of items;
training tokens stream through it, which keeps the longest match that ends at
each word. Words inside an occurrence of an item window are hits.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from .common import beside_helpers, map_rows, text_of

WINDOW = 10
#: Item words in one automaton: what is broadcast stays under this plus one item.
SHARD_WORDS = 1_000_000
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20

#: Byte by byte: A-Z to lower case; what belongs to no word becomes a blank.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """The words in order, in lists of bounded size; null has none."""
    data = (text or "").encode().translate(_WORD_BYTES)
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            end = data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


class Automaton:
    """Suffix automaton of many word sequences, with the items behind each window."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        states = len(self.link)
        owners: list[set[str]] = [set() for _ in range(states)]
        shorts: list[list[tuple[int, str]]] = [[] for _ in range(states)]
        for item, words in items:
            size = min(window, len(words))
            for state, length in self._walk(words):
                if length >= size > 0:
                    while self.length[self.link[state]] >= size:
                        state = self.link[state]
                    if size == window:
                        owners[state].add(item)
                    elif length == len(words):
                        shorts[state].append((size, item))
        # least match length at which a state means a hit, and the hits of its ancestors
        never = 1 << 60
        self.mark = [never] * states
        self.owners = [frozenset()] * states
        self.shorts: list[tuple[tuple[int, str], ...]] = [()] * states
        for s in sorted(range(1, states), key=self.length.__getitem__):
            up = self.link[s]
            self.shorts[s] = (*shorts[s], *self.shorts[up])
            if self.length[s] >= window:
                self.owners[s] = frozenset(owners[s]) if self.length[up] < window else self.owners[up]
            sizes = [n for n, _ in self.shorts[s]] + [window] * bool(self.owners[s])
            self.mark[s] = min(sizes, default=never)

    def _extend(self, last: int, word: bytes) -> int:
        """Append ``word`` after state ``last`` (Blumer et al., for several sequences)."""
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            q = nxt[last][word]
            if length[q] == length[last] + 1:
                return q
            return self._split(last, word, q)
        new = len(link)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, word, q)
        return new

    def _split(self, p: int, word: bytes, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        clone = len(link)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = clone
        while p >= 0 and nxt[p].get(word) == q:
            nxt[p][word] = clone
            p = link[p]
        return clone

    def _walk(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        state = length = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                state = length = 0
            yield state, length

    def tables(self) -> tuple:
        """The automaton as plain lists, to be broadcast."""
        return self.next, self.link, self.length, self.mark, self.owners, self.shorts, self.window

    def scan(self, pieces: Iterator[list[bytes]]) -> tuple[int, list[list[int]], set[str]]:
        return scan_words(self.tables(), pieces)


def scan_words(tables: tuple, pieces: Iterator[list[bytes]]) -> tuple[int, list[list[int]], set[str]]:
    """Number of words, hit runs [first, end) in order, and the items that occur."""
    nxt, link, lengths, mark, owners, shorts, window = tables
    state = length = at = 0
    runs: list[list[int]] = []
    items: set[str] = set()
    for words in pieces:
        for at, word in enumerate(words, at + 1):
            if state:
                while state and word not in nxt[state]:
                    state = link[state]
                    length = lengths[state]
            if word not in nxt[state]:
                continue
            state = nxt[state][word]
            length += 1
            if length >= mark[state]:
                longest = window if length >= window and owners[state] else 0
                if longest:
                    items |= owners[state]
                for size, item in shorts[state]:
                    if size <= length:
                        items.add(item)
                        longest = max(longest, size)
                if longest:
                    first = at - longest
                    while runs and runs[-1][0] >= first:
                        runs.pop()
                    if runs and runs[-1][1] >= first:
                        runs[-1][1] = at
                    else:
                        runs.append([first, at])
    return at, runs, items


def _merged(runs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return out


def _shards(items: DataFrame, id_col: str, text_col: str, shard_words: int):
    """Lists of (id, words), each of at most ``shard_words`` words and one item more."""
    known = items.filter(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")
    )
    # a word and its gap have two bytes at least, so this bounds the words of a shard
    words = F.octet_length("text") / 2 + 1
    total = known.agg(F.sum(words)).first()[0] or 0
    cuts = int(-(-total // shard_words)) or 1
    for cut in range(cuts):
        part = known.filter(F.pmod(F.xxhash64("id", "text"), F.lit(cuts)) == cut) if cuts > 1 else known
        yield [(r.id, [w for piece in words_of(r.text) for w in piece]) for r in part.toLocalIterator()]


def find_items(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    item_id: str = "item_id",
    item_text: str = "text",
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` with __n_words, __runs (hit word runs [first, end)) and __items.

    Words: A-Z in lower case, then maximal runs of 0-9, a-z and characters from
    U+0080. An item's windows are its ``window`` consecutive words, or all its
    words if it has fewer. Null and empty texts have no words; items whose id or
    text is null, or without words, never occur; items of equal id count once.
    No items, no hits. Other columns of ``docs`` pass through. There is no
    shuffle: each shard of items is broadcast, at most ``shard_words`` words and
    one item, and the documents stream past all shards in one stage.
    """
    context = docs.sparkSession.sparkContext
    names = docs.columns
    place = next(i for i, c in enumerate(names) if c.lower() == "text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    schema = f"{kinds}, `__n_words` long, `__runs` array<array<int>>, `__items` array<string>"
    found = docs.withColumns(
        {
            "__n_words": F.lit(0).cast("long"),
            "__runs": F.array().cast("array<array<int>>"),
            "__items": F.array().cast("array<string>"),
        }
    )
    for shard in _shards(items, item_id, item_text, shard_words):
        sent = context.broadcast(Automaton(shard, window).tables())

        def scan(rows, sent=sent):
            tables = sent.value
            for row in rows:
                *rest, _, runs, ids = row
                n, more, new = scan_words(tables, words_of(row[place]))
                if more:
                    runs = _merged([*runs, *more])
                    ids = sorted({*ids, *new})
                yield (*rest, n, runs, ids)

        found = map_rows(found, schema, scan)
    return found


def audit(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    items_sha256 is the digest of the ids of the occurring items, sorted as
    strings and joined by commas (of the empty string if there are none).
    See ``find_items`` for the other cases.
    """
    found = find_items(docs.select("doc_id", "text"), items, window, shard_words=shard_words)
    hit = F.aggregate("__runs", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0])
    return found.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("__items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def cut_runs(text: str, runs: list[list[int]]) -> str:
    """The text without the given word runs; each goes from its first word to its last."""
    data = text.encode()
    plain = data.translate(_WORD_BYTES)
    out, kept, at, word, runs = [], 0, 0, 0, iter(runs)
    run = next(runs, None)
    first = 0
    while run is not None:
        while at < len(plain) and plain[at] == 32:
            at += 1
        if word == run[0]:
            first = at
        end = plain.find(b" ", at)
        at = len(plain) if end < 0 else end
        word += 1
        if word == run[1]:
            out.append(data[kept:first])
            kept = at
            run = next(runs, None)
    return b"".join([*out, data[kept:]]).decode()


@beside_helpers
def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = 0.5
) -> DataFrame:
    """Documents without the spans that occur in test items.

    Spans shorter than a window stay; a document of whose words more than
    ``max_coverage`` are hit is left out whole. Columns are those of ``docs``.
    See ``find_items`` for nulls, empty tables and bounds.
    """
    found = find_items(docs, items, window)
    hit = F.aggregate("__runs", F.lit(0).cast("long"), lambda n, r: n + r[1] - r[0])
    kept = found.filter(hit <= F.col("__n_words") * max_coverage).drop("__n_words", "__items")
    names = docs.columns
    place = next(i for i, c in enumerate(names) if c.lower() == "text")

    def cut(rows):
        for *row, runs in rows:
            if runs:
                row[place] = cut_runs(row[place], runs)
            yield tuple(row)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_rows(kept, kinds, cut)


