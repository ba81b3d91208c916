"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

An entity's canonical form and a secret key decide its surrogate, so equal
entities get equal surrogates wherever they stand. Surrogates that meet, or that
are real entities of the table, are drawn again until all are distinct.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .common import beside_helpers, map_rows

#: Rounds of redrawing; each leaves a small part of the one before.
ROUNDS = 40
#: Attempts within an entity's own format; later ones draw from ever wider formats.
NARROW = 3

# Titles by gender, and given names by script and gender.
TITLES = {
    "m": [
        "Mr", "Herr", "Monsieur", "Señor", "Sr", "Don",
        "г-н", "Г-н", "господин", "Господин", "κ", "κος", "Κος", "κύριος", "Κύριος",
    ],
    "f": [
        "Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña",
        "г-жа", "Г-жа", "госпожа", "Госпожа", "κα", "Κα", "κυρία", "Κυρία",
    ],
    "n": ["Dr", "Prof", "д-р", "Д-р", "доктор", "Доктор", "проф", "Проф", "профессор", "Профессор", "δρ", "Δρ", "καθ", "Καθ"],
}
GIVEN = {
    ("latin", "m"): ["Adam", "Boris", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon"],
    ("latin", "f"): ["Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Hanna", "Irene", "Julia", "Karin", "Laura"],
    ("latin", "n"): ["Alex", "Ashley", "Chris", "Dominique", "Kim", "Robin", "Sam", "Sascha"],
    ("cyrillic", "m"): ["Андрей", "Борис", "Виктор", "Игорь", "Олег", "Павел", "Роман", "Сергей"],
    ("cyrillic", "f"): ["Анна", "Вера", "Галина", "Ирина", "Нина", "Ольга", "Софья", "Татьяна"],
    ("cyrillic", "n"): ["Саша", "Женя", "Валя"],
    ("greek", "m"): ["Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ιωάννα", "Μαρία", "Σοφία"],
    ("greek", "n"): ["Αλέξης", "Φάνης"],
}
SYLLABLES = {
    "latin": ["ba", "den", "for", "gal", "hem", "kar", "lin", "mor", "nas", "pel", "ris", "sten", "tor", "ven", "wil"],
    "cyrillic": ["ба", "вен", "гор", "дан", "ким", "лес", "мор", "нов", "пет", "рин", "сок", "тар"],
    "greek": ["βα", "γιαν", "δημ", "καρ", "λιν", "μορ", "νικ", "παπ", "σταθ", "τρι"],
}
FEMALE_END = {"latin": "a", "cyrillic": "а", "greek": "η"}
ALPHABETS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}
SECRET_WORDS = ["token", "secret", "password", "passwd", "api_key", "apikey", "key"]

_TITLE = {t: g for g, titles in TITLES.items() for t in titles}
_TITLES = "|".join(sorted(map(re.escape, _TITLE), key=len, reverse=True))
# Titles that may follow another or end a name; a given name too is left to the name.
_CHAINED = "|".join(sorted((re.escape(t) for t in _TITLE if t != "Don"), key=len, reverse=True))
_NAME = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_WORD = rf"(?![a-z]|(?:{_CHAINED})\b){_NAME}"
_FIND = re.compile(
    r"(?P<email>[\w.%+-]*\w@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]*[A-Za-z0-9])+)"
    rf"|(?i:\b(?:{'|'.join(SECRET_WORDS)})\b\s*[=:]\s*[\"']?)(?P<secret>[A-Za-z0-9+/_-]{{16,}}=*)"
    r"|(?<![\w.])(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?![\w]|\.\d)"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?<!\w)(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)"
    r"|(?<![\w-])(?P<card>\d{4}(?:[ -]\d{4}){3}|\d{13,19})(?![\w-])"
    r"|(?<![\w+])(?P<phone>\+\d{8,15}|(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4})(?![\w-])"
    rf"|\b(?P<title>{_TITLES})\b\.?[ \u00a0](?:(?:{_CHAINED})\b\.?[ \u00a0])*"
    rf"(?P<name>{_WORD}(?:[ \u00a0]{_WORD}){{0,2}})"
)
#: A capitalised word (ASCII ones by their first letter, others are looked at), parts joined by hyphens or apostrophes.
_CAPITAL = re.compile(r"[^\W\d_a-z](?<!\w.)[^\W\d_]*(?:[-'’][^\W\d_]+)*(?!\w)")
_PART = re.compile(r"[^\W\d_]+")
_POSSESSIVE = re.compile(r"['’][sS]$")
#: What every text with an entity has; decided by Spark, before Python sees a row. Digits and edges of words are
#: those of Python's Unicode classes, which Java's short forms are not.
HINT = (
    rf"(?i)[@\p{{Nd}}]|{'|'.join(SECRET_WORDS)}"
    rf"|(?-i:(?<![\p{{L}}\p{{N}}_])(?:{_TITLES})(?![\p{{L}}\p{{N}}_]))"
)


def _script(word: str) -> str:
    for letter in word:
        if "\u0370" <= letter <= "\u03ff" or "\u1f00" <= letter <= "\u1fff":
            return "greek"
        if "\u0400" <= letter <= "\u04ff":
            return "cyrillic"
    return "latin"


def _ascii(value: str) -> str:
    """Decimal digits of any script as 0-9."""
    return value if value.isascii() else "".join(str(unicodedata.decimal(c, c)) for c in value)


def _titled(text: str) -> Iterator[tuple[int, int, str, str]]:
    """The entities that their form or a title before them shows."""
    for m in _FIND.finditer(text):
        kind = m.lastgroup
        if kind == "name":
            words = [w for w in re.finditer(_NAME, m["name"])]
            capital = []
            for w in words:
                if not w[0][0].isupper():
                    break
                capital.append(w)
            for i, w in enumerate(capital):
                first = m.start("name") + w.start()
                word = _POSSESSIVE.sub("", w[0])
                script = _script(word)
                given = len(capital) > 1 and i < len(capital) - 1
                role = f"given-{_TITLE[m['title']]}-{script}" if given else f"family-{script}"
                yield first, first + len(word), role, word.casefold()
            continue
        value = m[kind]
        if kind == "secret" and not any(c.isalnum() for c in value):
            continue  # a ruled line
        if kind == "ip":
            octets = value.split(".")
            if any(int(o) > 255 for o in octets):
                continue
            value = ".".join(str(int(o)) for o in octets)
        elif kind in ("phone", "card", "ssn"):
            value = _ascii(re.sub(r"\D", "", value))
        elif kind == "iban":
            value = value.replace(" ", "")
        elif kind == "email":
            value = value.lower()
        yield m.start(kind), m.end(kind), kind, value


def _parts(word: str) -> int:
    return len(_PART.findall(word))


def _again(text: str, first: int, end: int, names: dict[str, str], sizes: list[int]) -> Iterator[tuple[int, int, str, str]]:
    """Further mentions in ``text[first:end]`` of ``names`` (kind by canonical form): whole capitalised words, or parts
    of such joined by hyphens or apostrophes."""
    for m in _CAPITAL.finditer(text, first, end):
        word = m[0].casefold()
        if word in names:
            if m[0][0].isupper():
                yield m.start(), m.end(), names[word], word
            continue
        parts = list(_PART.finditer(m[0]))
        i = 0
        while len(parts) > 1 and i < len(parts):
            for n in sizes:
                if i + n <= len(parts):
                    at, stop = parts[i].start(), parts[i + n - 1].end()
                    word = m[0][at:stop].casefold()
                    if word in names and m[0][at].isupper():
                        yield m.start() + at, m.start() + stop, names[word], word
                        i += n - 1
                        break
            i += 1


def find(text: str | None) -> Iterator[tuple[int, int, str, str]]:
    """(first, end, type, canonical form) of each entity, in order, without overlaps.

    A person's given and family names are entities of their own. Where a text
    names a person with a title once, each other mention of either name in that
    text, as a whole capitalised word before or after, is the same entity (that
    of the last titled mention before it, if several persons share the word).
    """
    text = text or ""
    found = list(_titled(text))
    names: dict[str, str] = {}
    for _, _, kind, value in found:
        if "-" in kind:
            names.setdefault(value, kind)
    if not names:
        yield from found
        return
    sizes = sorted({_parts(name) for name in names}, reverse=True)
    at = 0
    for entity in found:
        yield from _again(text, at, entity[0], names, sizes)
        yield entity
        at = entity[1]
        if "-" in entity[2]:
            names[entity[3]] = entity[2]
    yield from _again(text, at, len(text), names, sizes)


class _Draw:
    """Numbers that the key, the entity and the attempt decide."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        seed = f"{kind}\0{value}\0{attempt}".encode()
        self.state = int.from_bytes(hashlib.blake2b(seed, key=key[:64], digest_size=64).digest(), "big")
        self.seed, self.key, self.more = seed, key, 0

    def below(self, n: int) -> int:
        if self.state < n << 64:
            self.more += 1
            fresh = hashlib.blake2b(self.seed + b"\0%d" % self.more, key=self.key[:64], digest_size=64)
            self.state = int.from_bytes(fresh.digest(), "big")
        self.state, out = divmod(self.state, n)
        return out

    def digits(self, n: int, first: str = "0123456789") -> str:
        return "".join(
            first[self.below(len(first))] if i == 0 else str(self.below(10)) for i in range(n)
        )


def _luhn(digits: str) -> int:
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def _like(draw: _Draw, value: str) -> str:
    """Letters by letters of their script and case, digits by digits, hex by hex."""
    hexadecimal = re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", value) is not None and not value.isdigit()
    out = []
    for c in value:
        if hexadecimal:
            d = "0123456789abcdef"[draw.below(16)]
            out.append(d.upper() if value.isupper() else d)
        elif c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            letters = ALPHABETS[_script(c)]
            d = letters[draw.below(len(letters))]
            out.append(d.upper() if c.isupper() else d)
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, value: str, attempt: int, key: bytes) -> str:
    """The ``attempt``-th surrogate of an entity, in canonical form.

    From attempt ``NARROW`` on the format is wider, and wider still with later
    ones, so that no format runs full: more digits in an email's host; for
    private addresses 10.x.y.z, then 240.0.0.0/4, which nobody holds, for public
    ones that too; any digits for a phone or ssn, then more of them; for names
    more syllables; for secrets, cards and ibans more characters in the end.
    """
    draw = _Draw(key, kind, value, attempt)
    wide = max(0, attempt - NARROW + 1)  # 0: the entity's own format
    if kind == "email":
        local, _, domain = value.rpartition("@")
        return f"{_like(draw, local)}@mail{draw.below(1000 * 10**min(wide, 9))}.example.{domain.rpartition('.')[2]}"
    if kind == "ip":
        private = value.startswith(("10.", "192.168.", "127."))
        if wide > 3 or wide and value.startswith("10."):
            return ".".join([str(240 + draw.below(15)), *(str(draw.below(256)) for _ in range(3))])
        if wide and private:
            return ".".join(["10", *(str(draw.below(256)) for _ in range(3))])
        head = value.split(".")[: 2 if value.startswith("192.") else 1] if private else [str(1 + draw.below(223))]
        return ".".join([*head, *(str(draw.below(256)) for _ in range(4 - len(head)))])
    if kind == "phone":
        country, rest = value[:-10], value[-10:]
        if wide:
            return country + draw.digits(len(rest) + wide // 4)
        if len(value) < 10:
            return draw.digits(len(value), "23456789")
        middle = "555" if rest[3:6] == "555" else draw.digits(3, "23456789")
        return country + draw.digits(3, "23456789") + middle + draw.digits(4)
    if kind == "card":
        body = value[0] + draw.digits(len(value) - 2 + wide // 4)
        check = (10 - _luhn(body + "0")) % 10
        return body + str(check if _luhn(value) == 0 else (check + 1 + draw.below(9)) % 10)
    if kind == "ssn":
        if wide:
            return draw.digits(9 + wide // 4)
        return "9" + draw.digits(8)  # numbers from 900 are never given out
    if kind == "iban":
        return value[:2] + _like(draw, value[2:] + "0" * (wide // 4))
    if kind == "secret":
        return _like(draw, value + "a0" * (wide // 4))
    role, *gender, script = kind.split("-")
    if role == "given":
        names = GIVEN[script, gender[0]]
        if attempt < 4:
            return names[draw.below(len(names))].casefold()
    syllables = SYLLABLES[script]
    name = "".join(syllables[draw.below(len(syllables))] for _ in range(2 + draw.below(2) + attempt // 3))
    return name + (FEMALE_END[script] if gender == ["f"] else "")


def _in_format(kind: str, shown: str, new: str) -> str:
    """The surrogate's canonical form as the entity was written."""
    if kind in ("ip", "phone", "card", "ssn") and not shown.isascii():
        one = next((c for c in shown if c.isdecimal() and not c.isascii()), "0")
        zero = ord(one) - unicodedata.decimal(one)
        new = "".join(chr(zero + int(c)) if c.isdigit() else c for c in new)
    if kind in ("phone", "card", "ssn", "iban"):
        left = iter(new)  # of a widened format some remain
        return "".join([*(next(left) if c.isalnum() else c for c in shown), *left])
    if kind.startswith(("given", "family")):
        if shown.isupper() and len(shown) > 1:
            return new.upper()
        return "-".join(p[:1].upper() + p[1:] for p in new.split("-"))
    return new


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    def draw(rows):
        for kind, value, attempt in rows:
            yield kind, value, attempt, surrogate(kind, value, attempt, key)

    return map_rows(
        entities.select("kind", "value", "attempt"), "kind string, value string, attempt int, surrogate string", draw
    )


def surrogates(entities: DataFrame, key: bytes, rounds: int = ROUNDS) -> DataFrame:
    """kind, value, attempt, surrogate of each different entity; no two of a kind share one.

    A surrogate that another entity holds, or that is itself an entity of the
    table, is drawn again; of those that meet, the one that has held it longest
    stays. Formats widen with the attempts, so none runs full (see ``surrogate``);
    raises if some meet even so after ``rounds``.
    """
    table = stage(_drawn(entities.select("kind", "value").distinct().withColumn("attempt", F.lit(0)), key), "surrogates")
    real = table.select("kind", F.col("value").alias("surrogate"))
    for _ in range(rounds):
        holder = table.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "value")).alias("holder"), F.count("*").alias("n"))
        met = holder.filter("n > 1").select("kind", "surrogate", F.col("holder.value").alias("stays"))
        taken = table.join(real, ["kind", "surrogate"], "left_semi").select("kind", "value").withColumn("again", F.lit(True))
        lost = (
            table.join(met, ["kind", "surrogate"]).filter("value <> stays").select("kind", "value").withColumn("again", F.lit(True))
        )
        again = stage(lost.union(taken).distinct(), "redrawn")
        if again.isEmpty():
            return table
        marked = table.join(again, ["kind", "value"], "left")
        redrawn = _drawn(marked.filter("again").withColumn("attempt", F.col("attempt") + 1), key)
        table = stage(marked.filter("again IS NULL").select(table.columns).union(redrawn), "surrogates")
        real = table.select("kind", F.col("value").alias("surrogate"))
    raise ValueError(f"surrogates still meet after {rounds} rounds")


@beside_helpers
def replace(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with surrogates in the text, and __found (entities) and __kinds (their types).

    Texts without any mark of an entity pass by untouched, without a shuffle or
    Python; so do null and empty ones (__found 0). Texts are read whole. Only
    documents with a mark meet their entities' surrogates, which are joined on
    the entity (a common one is split by the adaptive skew join). Repeated rows
    are treated alike; an empty table gives no rows; other columns pass through.
    """
    names = docs.columns
    place = next(i for i, c in enumerate(names) if c.lower() == "text")
    id_kind = next(f.dataType.simpleString() for f in docs.schema if f.name.lower() == "doc_id")
    marked = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    plain = docs.filter(~marked).withColumns({"__found": F.lit(0).cast("long"), "__kinds": F.lit("")})
    hinted = docs.filter(marked)

    def entities(rows):
        for doc, digest, text in rows:
            for kind, value in dict.fromkeys((k, v) for _, _, k, v in find(text)):
                yield doc, digest, kind, value

    seen = stage(
        map_rows(
            hinted.select("doc_id", F.xxhash64("text").alias("__sum"), "text"),
            f"__id {id_kind}, __sum long, kind string, value string",
            entities,
        ).distinct(),
        "entities",
    )
    new = surrogates(seen, key)
    maps = (
        seen.join(new, ["kind", "value"])
        .groupBy("__id", "__sum")
        .agg(F.collect_list(F.struct("kind", "value", "surrogate")).alias("__map"))
    )
    keyed = hinted.withColumn("__sum1", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sum1") == F.col("__sum"))
    joined = keyed.join(maps, same, "left").select(*[f"`{c}`" for c in names], "__map")

    def put(rows):
        for *row, pairs in rows:
            known = {(p["kind"], p["value"]): p["surrogate"] for p in pairs or ()}
            out, at, n, kinds = [], 0, 0, set()
            for first, end, kind, value in find(row[place]) if known else ():
                out += [row[place][at:first], _in_format(kind, row[place][first:end], known[kind, value])]
                at, n = end, n + 1
                kinds.add(kind.split("-")[0])
            if n:
                row[place] = "".join([*out, row[place][at:]])
            yield (*row, n, ",".join(sorted(kinds)))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return plain.union(map_rows(joined, f"{kinds}, __found long, __kinds string", put))


def audit(docs: DataFrame, key: bytes) -> DataFrame:
    """Per row: doc_id, n_entities, kinds (comma-joined) and the whole text with surrogates."""
    found = replace(docs.select("doc_id", "text"), key)
    return found.select("doc_id", F.col("__found").alias("n_entities"), F.col("__kinds").alias("kinds"), "text")
