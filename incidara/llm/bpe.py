"""Byte-level BPE as a streaming transducer with bounded lookahead.

The encoding of every prefix of a text is a prefix tree: its last token is the
one token that ends there and is compatible with the last token of what comes
before it. Two tokens are compatible when the merges leave them as they are side
by side. A token is stable once the encodings of all prefixes from which a token may
still begin agree on it; it is then emitted and its bytes are forgotten. How far
agreement can trail is bounded by the merge list alone (``sufficient_lookahead``);
a piece shorter than that is in hand whole, and its tokens are found going ahead.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cached_property

import regex
from pyspark.sql import DataFrame, functions as F

from .common import map_rows

#: How the byte-level pre-tokenizer splits a text (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters of a text that are split at a time; a cut falls before a single blank.
PIECE = 1 << 16
#: Pieces of text whose tokens a worker remembers (twice: recent and older ones), and the
#: longest of them.
CACHE_ROWS, CACHE_CHARS = 250_000, 32
#: Pairs of tokens of which a worker remembers whether they fit.
KNOWN_PAIRS = 500_000
#: Bytes that wait before a longer piece is looked at for stable tokens.
STEP = 256
#: Tokens decoded at a time.
DECODE_STEP = 1 << 16
_NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


def load(source: str) -> dict:
    """Plain tables of a tokenizer's JSON text, ready to be broadcast."""
    stated = json.loads(source)
    model = stated["model"]
    alphabet = byte_alphabet()
    raw = lambda token: bytes(alphabet[c] for c in token)
    ids = {raw(token): i for token, i in model["vocab"].items()}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = [(raw(a), raw(b)) for a, b in pairs]
    special = {t["content"]: t["id"] for t in stated["added_tokens"]}
    table = {i: t for t, i in ids.items()} | {i: t.encode() for t, i in special.items()}
    return {
        "ids": ids,
        "merges": merges,
        "special": special,
        "table": table,
        "lookahead": sufficient_lookahead(merges),
    }


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after which no text can change a token any more.

    What follows changes a token only by a chain of merges of falling rank
    from left to right: a merge wants a right part, which a merge of lower rank
    takes for its left part or makes. The longest such chain, in bytes, and
    one token are enough.
    """
    by_left: dict[bytes, int] = {}
    by_product: dict[bytes, int] = {}
    longest = 1
    for left, right in merges:
        reach = len(left) + max(len(right), by_left.get(right, 0), by_product.get(right, 0))
        by_left[left] = max(by_left.get(left, 0), reach)
        by_product[left + right] = max(by_product.get(left + right, 0), reach)
        longest = max(longest, reach)
    return longest + max((len(a) + len(b) for a, b in merges), default=1)


def merged(data: bytes, ranks: dict[tuple[bytes, bytes], int]) -> list[bytes]:
    """The tokens of a short string by its merges, lowest rank and then leftmost first."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, at = min((ranks.get(pair, _NEVER), i) for i, pair in enumerate(zip(parts, parts[1:])))
        if rank == _NEVER:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Transducer:
    """Reads a piece of text byte by byte; keeps what is not yet stable.

    For each prefix it knows the last token, and where a token that reaches past
    the end may begin: at each such place it stands at a node of the vocabulary's
    trie, by byte, with the id of a token under -1.
    """

    def __init__(self, tables: dict):
        ids = tables["ids"]
        self.ids = ids
        #: By the first four bytes: the longest token that begins so.
        self.reach: dict[bytes, int] = {}
        for token in ids:
            self.reach[token[:4]] = max(self.reach.get(token[:4], 1), len(token))
        self.lengths = {i: len(token) for token, i in ids.items()}
        pairs = [(ids[a], ids[b]) for a, b in tables["merges"]]
        self.ranks = {pair: rank for rank, pair in reversed(list(enumerate(pairs)))}
        #: By token: the rank of the first merge that makes it, and its two parts.
        self.made: dict[int, tuple[int, int, int]] = {}
        for rank, ((a, b), (left, right)) in enumerate(zip(tables["merges"], pairs)):
            self.made.setdefault(ids[a + b], (rank, left, right))
        self.known: dict[int, bool] = {}

    @cached_property
    def root(self) -> dict:
        """The vocabulary's trie; only pieces beyond the lookahead need it."""
        root: dict = {}
        for token, i in self.ids.items():
            node = root
            for byte in token:
                node = node.setdefault(byte, {})
            node[-1] = i
        return root

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave two neighbouring tokens as they are.

        They do unless a merge across the border comes before the merges that use
        up its parts; of equal merges the leftmost comes first.
        """
        ranks, made, basic = self.ranks.get, self.made.get, (-1, -1, -1)
        a_ends = b_ends = _NEVER
        # back in time: of the parts at the border the later one gives way to its own part
        while True:
            rank = ranks((left, right), _NEVER)
            if rank < a_ends and rank <= b_ends:
                return False
            a_made, _, a_part = made(left, basic)
            b_made, b_part, _ = made(right, basic)
            if a_made > b_made:
                left, a_ends = a_part, a_made
            elif b_made >= 0:
                right, b_ends = b_part, b_made
            else:
                return True

    def whole(self, data: bytes) -> list[int]:
        """The ids of a piece that is in hand whole, as short ones are within the lookahead.

        Takes the longest token that fits the one before it; where none fits, the
        place is closed and the token that led there gives way to a shorter one.
        """
        get, known, reach = self.ids.get, self.known, self.reach
        if len(known) > KNOWN_PAIRS:
            known.clear()
        n, at, left = len(data), 0, -1
        out: list[int] = []
        sizes: list[int] = []
        closed: set[int] = set()
        size = min(n, reach.get(data[:4], 3))
        while at < n:
            while size:
                token = get(data[at : at + size])
                if token is not None and at + size not in closed:
                    if left < 0:
                        break
                    pair = left << 24 | token
                    fits = known.get(pair)
                    if fits is None:
                        fits = known[pair] = self.compatible(left, token)
                    if fits:
                        break
                size -= 1
            if size:
                out.append(token)
                sizes.append(size)
                at, left = at + size, token
                size = min(n - at, reach.get(data[at : at + 4], 3))
            else:
                if not out:
                    raise ValueError("the vocabulary lacks a byte")
                closed.add(at)
                out.pop()
                size = sizes.pop()
                at, left = at - size, out[-1] if out else -1
                size -= 1
        return out

    def stream(self, parts: Iterable[bytes], step: int) -> Iterator[int]:
        """The ids of one piece that comes in parts, looked at for stable ones every
        ``step`` bytes."""
        last, open_at = [-1], [(0, self.root)]
        for part in parts:
            for at in range(0, len(part), step):
                open_at = self._read(part[at : at + step], last, open_at)
                agreed = self._agreed(last, open_at)
                if agreed:
                    yield from self._chain(last, agreed)
                    last = last[agreed:]
                    open_at = [(place - agreed, node) for place, node in open_at]
        yield from self._chain(last, len(last) - 1)

    def _read(self, data: bytes, last: list[int], open_at: list) -> list:
        """Append to ``last``, by length of the prefix since the last stable token, its last
        token; return the open places after ``data``."""
        root, known = self.root, self.known
        if len(known) > KNOWN_PAIRS:
            known.clear()
        for byte in data:
            found = -1
            still = []
            for place in open_at:
                node = place[1].get(byte)
                if node is None:
                    continue
                at = place[0]
                still.append((at, node))
                if found < 0 and -1 in node:
                    token, left = node[-1], last[at]
                    if left < 0:
                        found = token
                    else:
                        pair = left << 24 | token
                        fits = known.get(pair)
                        if fits is None:
                            fits = known[pair] = self.compatible(left, token)
                        if fits:
                            found = token
            if found < 0:
                raise ValueError("the vocabulary lacks a byte")
            still.append((len(last), root))
            last.append(found)
            open_at = still
        return open_at

    def _agreed(self, last: list[int], open_at: list) -> int:
        """The place that the encodings up to all open places share."""
        ends = {at for at, _ in open_at}
        while len(ends) > 1:
            end = max(ends)
            ends.remove(end)
            ends.add(end - self.lengths[last[end]])
        return ends.pop()

    def _chain(self, last: list[int], end: int) -> list[int]:
        out = []
        while end > 0:
            out.append(last[end])
            end -= self.lengths[last[end]]
        out.reverse()
        return out


_SPLIT = regex.compile(PATTERN)
#: A place where a piece of the text surely begins: before one blank between two others.
_CUT = regex.compile(r"(?<=\S)(?= \S)")
#: A blank beside other white space, or at an end.
_ODD_BLANK = re.compile(r" \s|\s |^ | $")


def _pieces(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > PIECE:
        cut = _CUT.search(text, at + PIECE)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Words(dict):
    """Packed ids of what stands between two blanks, its own blank before it included."""

    def __init__(self, tables: dict, limit: int = CACHE_ROWS):
        super().__init__()
        self.limit = limit
        self.older: dict[str, bytes] = {}  # what was in use before the last turn
        self.machine = Transducer(tables)
        self.special = tables["special"]

    def __missing__(self, word: str) -> bytes:
        packed = self.older.get(word)
        if packed is None:
            packed = self.ids(" " + word)
        if len(word) <= CACHE_CHARS:
            if len(self) >= self.limit:
                self.older.clear()  # before the copy, so that no third turn is in memory
                self.older.update(self)
                self.clear()
            self[word] = packed
        return packed

    def ids(self, text: str) -> bytes:
        out = array("I")
        for word in _SPLIT.findall(text):
            data = word.encode()
            out.extend(self.machine.stream([data], STEP) if len(data) > STEP else self.machine.whole(data))
        return out.tobytes()


def _encode_plain(text: str, words: Words) -> Iterator[bytes]:
    for piece in _pieces(text):
        body, blank = (piece[1:], True) if piece[0] == " " else (piece, False)
        if _ODD_BLANK.search(body):
            yield words.ids(piece)
        else:
            # each blank stands alone, so a piece of text begins with it
            parts = body.split(" ")
            if not blank:
                yield words.ids(parts[0])
                del parts[0]
            yield b"".join(map(words.__getitem__, parts))


def _words(tables: dict, limit: int = CACHE_ROWS) -> Words:
    """The worker's own memory of words: it lives as long as the broadcast tables there."""
    if "words" not in tables:
        tables["words"] = Words(tables, limit)
    return tables["words"]


def encode(text: str, words: Words) -> Iterator[bytes]:
    """Ids as little-endian 32-bit numbers, piece by piece."""
    special = words.special
    parts = [text]
    if special and any(s in text for s in special):
        longest_first = sorted(special, key=len, reverse=True)
        parts = regex.split("(" + "|".join(map(regex.escape, longest_first)) + ")", text)
    for i, part in enumerate(parts):
        if i % 2:
            yield array("I", [special[part]]).tobytes()
        elif part:
            yield from _encode_plain(part, words)


def decode(packed: Iterable[bytes], table: dict[int, bytes]) -> Iterator[str]:
    """Text as soon as its bytes are complete; broken bytes become U+FFFD."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    for part in packed:
        for at in range(0, len(part), 4 * DECODE_STEP):
            ids = array("I", part[at : at + 4 * DECODE_STEP])
            yield machine.decode(b"".join(map(table.__getitem__, ids)))
    yield machine.decode(b"", True)


def tokenizer(spark, source: str):
    """The broadcast tables of a tokenizer's JSON text: bounded by that file."""
    return spark.sparkContext.broadcast(load(source))


def token_ids(docs: DataFrame, source: str) -> DataFrame:
    """doc_id and ids (array<int>) of every text; null and empty texts have none."""
    sent = tokenizer(docs.sparkSession, source)

    def each(rows):
        words = _words(sent.value)
        for doc_id, text in rows:
            ids = array("I", b"".join(encode(text or "", words)))
            yield doc_id, ids.tolist()

    return map_rows(docs.select("doc_id", "text"), _typed(docs, "ids array<int>"), each)


def texts_of(ids: DataFrame, source: str) -> DataFrame:
    """doc_id and text of rows of doc_id and ids; null ids give the empty text."""
    sent = tokenizer(ids.sparkSession, source)

    def each(rows):
        for doc_id, numbers in rows:
            yield doc_id, "".join(decode(iter([array("I", numbers or []).tobytes()]), sent.value["table"]))

    return map_rows(ids.select("doc_id", "ids"), _typed(ids, "text string"), each)


def _typed(df: DataFrame, more: str) -> str:
    kind = next(f.dataType.simpleString() for f in df.schema if f.name.lower() == "doc_id")
    return f"doc_id {kind}, {more}"


def round_trip(docs: DataFrame, source: str, remembered: int = CACHE_ROWS) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The ids are those of the tokenizers library without added tokens; a special
    token's string in a text is that token. Digests are of the ids as
    little-endian 32-bit numbers and of the decoded text in UTF-8. Null counts as
    empty; texts are split and decoded piece by piece, and a piece as long as the
    text goes through the transducer, so memory holds one text and its ids'
    current piece. A worker remembers the tokens of twice ``remembered`` words;
    fewer take less memory and more time, for the same result. No shuffle;
    repeated rows are repeated, an empty table gives no rows, other columns are
    ignored.
    """
    sent = tokenizer(docs.sparkSession, source)

    def each(rows):
        words = _words(sent.value, remembered)
        table = sent.value["table"]
        for doc_id, text in rows:
            ids, back, n = hashlib.sha256(), hashlib.sha256(), 0

            def seen(parts):
                nonlocal n
                for part in parts:
                    ids.update(part)
                    n += len(part) // 4
                    yield part

            for decoded in decode(seen(encode(text or "", words)), table):
                back.update(decoded.encode())
            yield doc_id, n, ids.hexdigest(), back.hexdigest()

    schema = _typed(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return map_rows(docs.select("doc_id", "text"), schema, each)
