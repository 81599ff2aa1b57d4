"""Personal data replaced by surrogates that keep type, format, script and gender.

Entities are e-mail addresses, phone numbers, card numbers, account numbers (IBAN, with the right
check digits), IP addresses of both versions and names after a title. A text's own names are looked for again in it without title, whole and by their last word,
and get the same surrogate or its last word; a family name after a title is that of the full name
of the same gender that the text has nearest before it, or else first after it. A surrogate is drawn with a secret key from the entity itself, so that the same entity
gets the same surrogate in every document (coreference). All distinct entities of the corpus are
then held against each other: if two share a surrogate, or a surrogate is another entity that
occurs, the entity with the larger keyed order draws again, until all surrogates are distinct.
From the draw ``WIDER`` on, numbers and IP addresses grow by a digit or octet per draw: a form
that is too small for its entities gets room, and the draws come to an end.

Entities are found once and kept in a table of mentions; documents that can't hold any by a
plain pattern are passed through as they are. The others are joined with their mentions by a
checksum of the text, so that copies share one row of mentions.

NULL and empty texts stay as they are. Repeated documents are all treated. Columns other than
``text`` pass through unchanged, whatever their names; an empty table gives empty results.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
from bisect import bisect
from collections.abc import Callable, Iterator
from string import ascii_lowercase, ascii_uppercase, digits

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WIDER = 8
KEY = b"change-me: read the key from a secret store"

# Given names by gender, and parts from which family names are made.
GIVEN = {
    ("latin", "f"): "Adele Berta Clara Dora Edda Flora Greta Hilda Irma Juna Klara Lydia Marta "
    "Nadia Olga Paula Rita Sonja Thea Vera".split(),
    ("latin", "m"): "Albert Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Kurt Leo Max "
    "Nils Otto Paul Ralf Simon Tom Viktor".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Ирина Ксения Лариса Мария".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим".split(),
    ("greek", "f"): "Άννα Βασιλική Δήμητρα Ειρήνη Ζωή Ιωάννα Κατερίνα Μαρία".split(),
    ("greek", "m"): "Ανδρέας Βασίλης Γιώργος Δημήτρης Ηλίας Κώστας Μιχάλης Νίκος".split(),
}
PARTS = {
    "latin": "bar cor dal fen gar hol kem lan mor nol per ros sal tor ven wil".split(),
    "cyrillic": "бар вол гор дем зор ким лев мор нов пет рос сав тим".split(),
    "greek": "βαρ γον δελ ζαν καλ λεμ μαν νικ παρ ροδ σαν ταλ".split(),
}
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"),
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"),
}
RANKS = ("Dr", "Prof")  # of any gender; they may follow another title

_TITLE = "|".join([*(title for titles in TITLES.values() for title in titles), *RANKS])
_RANKS = "|".join(RANKS)
# Latin with all its marks, Greek and Cyrillic.
_SCRIPTS = [*range(0x41, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x1F00)]
_CAPITAL = "".join(chr(code) for code in _SCRIPTS if chr(code).isupper())
_SMALL = "".join(chr(code) for code in _SCRIPTS if chr(code).islower())
_NAME = f"[{_CAPITAL}][{_SMALL}]+(?:[-'’][{_CAPITAL}][{_SMALL}]+)?"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

# In the order of precedence, where two would overlap.
PATTERNS = {
    "email": re.compile(
        r"(?<![\w.+%-])[\w.+%-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![\w-])"
    ),
    "iban": re.compile(
        r"(?<![\w-])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\w-])", re.ASCII
    ),
    "ipv6": re.compile(
        r"(?<![\w:.])[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){1,7}(?:::)?(?![\w:])", re.ASCII
    ),
    "card": re.compile(r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])", re.ASCII),
    "ip": re.compile(rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.[0-9])"),
    "phone": re.compile(
        r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[.-])"
        r"[0-9]{3,4}[ .-][0-9]{3,4}(?![\w-])"
        r"|(?<![\w+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![\w-])"
        # Without a country's code: 614 555 8001; 030 1234567, (030) 1234567, 020 7946 0958;
        # 01 42 68 53 00.
        r"|(?<![\w+.-])[0-9]{3} [0-9]{3} [0-9]{4}(?![\w-])"
        r"|(?<![\w+.-])(?:0[0-9]{1,4}[ /.-]|\(0[0-9]{1,4}\) ?)"
        r"(?:[0-9]{6,8}|[0-9]{3,4} [0-9]{3,4})(?![\w-])"
        r"|(?<![\w+.-])0[0-9](?: [0-9]{2}){4}(?![\w-])",
        re.ASCII,
    ),
    "name": re.compile(
        rf"\b(?:{_TITLE})\.? (?:(?:{_RANKS})\.? )*({_NAME}(?: {_NAME}){{0,2}})"
    ),
}
# What any of them needs: a digit pair, an at sign, two colons, or a title. Wider than the patterns.
MAYBE = (
    r"[0-9][0-9 .-]?[(]?[0-9]|[0-9]\)|@|:[0-9A-Fa-f]{0,4}:"
    rf"|(?:{_TITLE})\.? [A-ZÀ-ɏͰ-ԯḀ-ỿ]"
)

MENTION = "array<struct<start: int, end: int, kind: string, entity: string>>"
_MENTION_FIELDS = ("start", "end", "kind", "entity")
_MENTIONS = pa.list_(
    pa.struct(
        [
            ("start", pa.int32()),
            ("end", pa.int32()),
            ("kind", pa.string()),
            ("entity", pa.string()),
        ]
    )
)


# Detection


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and entity of each mention, in order, none overlapping."""
    found: list[tuple[int, int, str, str]] = []
    for kind, pattern in PATTERNS.items():
        starts = [start for start, *_ in found]
        more = []
        for match in pattern.finditer(text):
            start, end = match.span(1 if kind == "name" else 0)
            if _is_real(kind, text[start:end]) and _is_free(start, end, found, starts):
                more.append((start, end, *_entity(kind, match, text[start:end])))
        found = sorted(found + more)
    return _same_names(text, found) if any(_is_name(each) for each in found) else found


def _is_real(kind: str, text: str) -> bool:
    """What the pattern of a kind can't tell."""
    if kind == "iban":
        return _remainder(text.replace(" ", "")) == 1
    if kind == "ipv6":  # not a slice or the scope of a name in a program
        try:
            ipaddress.IPv6Address(text)
        except ValueError:
            return False
        return len(text.partition(":")[0]) > 2 and any(c in digits for c in text)
    return True


def _remainder(number: str) -> int:
    """Of an account number, as ISO 7064 has it; 1 if the check digits are right."""
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97


def _is_free(start: int, end: int, found: list, starts: list[int]) -> bool:
    """Whether nothing of ``found``, which is in order and without overlaps, meets a range."""
    after = bisect(starts, start)
    return (after == 0 or found[after - 1][1] <= start) and (
        after == len(starts) or end <= starts[after]
    )


def _is_name(mention: tuple[int, int, str, str]) -> bool:
    return mention[2].startswith("name")


def _same_names(
    text: str, found: list[tuple[int, int, str, str]]
) -> list[tuple[int, int, str, str]]:
    """Mentions of the text's names with their parts: family names, and names without title."""
    # By name and by last word: where names of one entity are, in order.
    whole: dict[str, list[tuple[int, str, str]]] = {}
    family: dict[str, list[tuple[int, str, str]]] = {}
    for start, _, kind, name in filter(_is_name, found):
        whole.setdefault(name, []).append((start, kind, name))
        if " " in name:
            family.setdefault(name.rpartition(" ")[2], []).append((start, kind, name))

    def nearest(options: list[tuple[int, str, str]], start: int) -> tuple[str, str]:
        return options[max(0, bisect(options, (start,)) - 1)][1:]

    result, extra = [], []
    for start, end, kind, entity in found:
        if kind.startswith("name"):
            ranks = kind == "name_x"
            alike = [each for each in family.get(entity, []) if ranks or each[1] in (kind, "name_x")]
            alike = alike or [each for each in whole[entity] if ranks and each[1] != kind]
            if alike:
                kind, entity = nearest(alike, start)
        result.append((start, end, kind, entity))
    starts = [start for start, *_ in result]
    for start, end in _again(text, {*whole, *family}):
        if _is_free(start, end, result, starts):
            name = text[start:end]
            extra.append((start, end, *nearest(family.get(name) or whole[name], start)))
    return sorted(result + extra)


def _again(text: str, names: set[str]) -> Iterator[tuple[int, int]]:
    """Where names stand as whole words, the longest at each place, none overlapping.

    A name has three words at most, of two parts at most: so many are looked up at each place.
    """
    runs = [match.span() for match in re.finditer(r"\w+", text)]
    longest = max(map(len, names))
    at = 0
    while at < len(runs):
        start = runs[at][0]
        for last in range(min(at + 5, len(runs) - 1), at - 1, -1):
            end = runs[last][1]
            if end - start <= longest and text[start:end] in names:
                yield start, end
                at = last
                break
        at += 1


def _entity(kind: str, match: re.Match, text: str) -> tuple[str, str]:
    """Mentions of one entity have one form: digits of numbers, addresses in lower case."""
    if kind == "name":
        title = match[0].split(" ")[0].rstrip(".")
        gender = next((gender for gender, titles in TITLES.items() if title in titles), "x")
        return f"name_{gender}", text
    if kind == "email":
        return kind, text.lower()
    if kind == "ip":
        return kind, text
    if kind == "ipv6":
        return kind, str(ipaddress.IPv6Address(text))
    if kind == "iban":
        return kind, text.replace(" ", "")
    return kind, re.sub(r"[^0-9]", "", text)


# Surrogates


class Stream:
    """Numbers drawn from an entity with a secret key."""

    def __init__(self, key: bytes, *parts: object) -> None:
        self.key = key
        self.label = "\0".join(map(str, parts)).encode()
        self.block = 0
        self.rest = b""

    def below(self, bound: int) -> int:
        if len(self.rest) < 8:
            message = self.label + self.block.to_bytes(8, "big")
            self.rest += hashlib.blake2b(message, key=self.key[:64], digest_size=64).digest()
            self.block += 1
        number, self.rest = int.from_bytes(self.rest[:8], "big"), self.rest[8:]
        return number % bound

    def of(self, options):
        return options[self.below(len(options))]


def surrogate(kind: str, entity: str, attempt: int, key: bytes = KEY) -> str:
    """A replacement of the same kind, in the form that entities have."""
    draw = Stream(key, kind, entity, attempt)
    longer = max(0, attempt - WIDER + 1)
    if kind == "email":
        local, _, domain = entity.partition("@")
        name, _, top = domain.rpartition(".")
        return f"{_alike(local, draw, attempt)}@{_alike(name, draw)}.{top}"
    if kind == "ip":
        return ".".join(str(draw.below(256)) for _ in range(4 + longer))
    if kind == "ipv6":  # no zeros, so that groups stay as long as they are
        drawn = "".join(c if c == ":" else draw.of("123456789abcdef") for c in entity)
        return drawn + "".join(draw.of("123456789abcdef") for _ in range(longer))
    if kind == "iban":
        return _iban(entity, draw, longer)
    if kind == "card":
        return _card(entity, draw, longer)
    if kind == "phone":
        return entity[:1] + "".join(str(draw.below(10)) for _ in range(len(entity) - 1 + longer))
    return _name(kind[-1], entity, draw, attempt)


def _alike(text: str, draw: Stream, longer: int = 0) -> str:
    """Letters for letters, digits for digits; marks stay. Later attempts have more room."""

    def like(character: str) -> str:
        if character.isdigit():
            return draw.of(digits)
        return draw.of(ascii_lowercase) if character.isalpha() else character

    return "".join(map(like, text)) + "".join(draw.of(ascii_lowercase) for _ in range(longer))


def _iban(number: str, draw: Stream, longer: int) -> str:
    """The country stays; letters for letters, digits for digits, and the right check digits."""
    body = "".join(draw.of(digits if c in digits else ascii_uppercase) for c in number[4:])
    body += "".join(draw.of(digits) for _ in range(longer))
    return f"{number[:2]}{98 - _remainder(number[:2] + '00' + body):02}{body}"


def _card(number: str, draw: Stream, longer: int = 0) -> str:
    """The first digit stays, and so does whether the check digit is right."""
    body = number[0] + "".join(draw.of(digits) for _ in range(len(number) - 2 + longer))
    right = next(digit for digit in digits if _luhn(body + digit))
    if _luhn(number):
        return body + right
    return body + draw.of(digits.replace(right, ""))


def _luhn(number: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(number))):
        total += digit if place % 2 == 0 else (2 * digit - 1) % 9 + 1 if digit else 0
    return total % 10 == 0


def script_of(text: str) -> str:
    if re.search("[Ѐ-ԯ]", text):
        return "cyrillic"
    return "greek" if re.search("[Ͱ-Ͽ]", text) else "latin"


def _name(gender: str, name: str, draw: Stream, attempt: int) -> str:
    """As many words as the name has; family names are made from parts, more in later draws."""
    script = script_of(name)
    words = name.split(" ")
    family = "".join(draw.of(PARTS[script]) for _ in range(2 + attempt)).capitalize()
    genders = "fm" if gender == "x" else gender
    options = [given for each in genders for given in GIVEN[script, each]]
    given = [draw.of(options) for _ in words[1:]]
    return " ".join([*given, family])


def formatted(kind: str, mention: str, drawn: str) -> str:
    """A surrogate in the shape of a mention: its separators, its capitals, or its part."""
    if kind in ("card", "phone"):
        rest = iter(drawn)
        return "".join([*(next(rest) if c in digits else c for c in mention), *rest])
    if kind == "iban":
        rest = iter(drawn)
        return "".join([*(c if c == " " else next(rest) for c in mention), *rest])
    if kind in ("email", "ipv6") and mention.isupper():
        return drawn.upper()
    if kind.startswith("name"):  # the family name of a full name
        return " ".join(drawn.split(" ")[-len(mention.split(" ")) :])
    return drawn


def distinct_surrogates(
    entities: DataFrame, new_path: Callable[[], str], key: bytes = KEY
) -> DataFrame:
    """kind, entity, surrogate: each surrogate given once, and none that is itself an entity.

    Entities draw, all at once. Those that collide draw again, but for one of each surrogate;
    what is drawn then must not be taken either. The numbers of each round go to a new folder.
    """
    spark = entities.sparkSession
    domain = F.regexp_extract("kind", "^[a-z]+", 0)

    def drawn(frame: DataFrame, attempt: int) -> DataFrame:
        @F.pandas_udf("string")
        def draw(kinds: pd.Series, names: pd.Series) -> pd.Series:
            return pd.Series(
                [surrogate(kind, name, attempt, key) for kind, name in zip(kinds, names)],
                dtype=object,
            )

        return frame.select("kind", "entity", draw("kind", "entity").alias("surrogate"))

    def kept(frame: DataFrame) -> DataFrame:
        path = new_path()
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    names = entities.select(domain.alias("domain"), F.col("entity").alias("surrogate")).distinct()
    waiting, settled, attempt = entities, None, 0
    while True:
        tried = kept(drawn(waiting, attempt).withColumn("domain", domain))
        taken = names
        if settled is not None:
            taken = taken.unionByName(settled.select("domain", "surrogate"))
        free = tried.join(taken, ["domain", "surrogate"], "left_anti")
        winner = F.min(F.struct(F.xxhash64("entity", "kind"), "kind", "entity")).alias("winner")
        given = free.groupBy("domain", "surrogate").agg(winner)
        given = kept(given.select("domain", "surrogate", "winner.kind", "winner.entity"))
        settled = given if settled is None else settled.unionByName(given)
        rest = waiting.join(given, ["kind", "entity"], "left_anti")
        waiting = kept(rest.select("kind", "entity"))
        if waiting.isEmpty():
            return settled.select("kind", "entity", "surrogate")
        attempt += 1


# Replacement


def _checksum(text: Column) -> Column:
    return F.unhex(F.md5(text))


def mentions_of(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The checksum and mentions of each text that has any."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(_MENTION_FIELDS, each)) for each in find_entities(text.as_py())]
                for text in batch.column(1)
            ]
            some = pa.array([bool(each) for each in found], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, _MENTIONS)], names=["content", "mentions"]
            ).filter(some)

    likely = docs.where(F.col(text_column).rlike(MAYBE))
    return likely.select(_checksum(F.col(text_column)).alias("content"), text_column).mapInArrow(
        find, f"content binary, mentions {MENTION}"
    )


def replace_pii(
    docs: DataFrame, new_path: Callable[[], str], key: bytes = KEY
) -> tuple[DataFrame, DataFrame]:
    """The documents with surrogates in their texts, and the table of surrogates.

    ``new_path`` names a new folder in shared storage at each call.
    """
    spark = docs.sparkSession
    path = new_path()
    found = mentions_of(docs)
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    once = found.groupBy("content").agg(F.first("mentions").alias("mentions"))
    each = once.select("content", F.inline("mentions"))
    path = new_path()
    distinct_surrogates(each.select("kind", "entity").distinct(), new_path, key).write.parquet(path)
    table = spark.read.parquet(path)
    mention = F.struct("start", "end", "kind", "surrogate")
    content, drawn = (_unused(name, docs) for name in ("content", "drawn"))
    replacements = (
        each.join(table, ["kind", "entity"])
        .groupBy(F.col("content").alias(content))  # as many rows as a text has mentions
        .agg(F.sort_array(F.collect_list(mention)).alias(drawn))
    )

    @F.pandas_udf("string")
    def replace(texts: pd.Series, lists: pd.Series) -> pd.Series:
        return pd.Series([_replaced(*pair) for pair in zip(texts, lists)], dtype=object)

    likely = F.col("text").rlike(MAYBE)
    others = docs.where(~F.coalesce(likely, F.lit(False)))
    touched = docs.where(likely).withColumn(content, _checksum(F.col("text")))
    touched = touched.join(replacements, content, "left")
    done = touched.withColumn("text", replace("text", drawn)).select(docs.columns)
    return others.unionByName(done), table


def _unused(name: str, docs: DataFrame) -> str:
    """A name that no column of the documents has, in any case."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    return name


def _replaced(text: str, mentions) -> str:
    if mentions is None:
        return text
    parts, before = [], 0
    for mention in mentions:
        start, end = mention["start"], mention["end"]
        drawn = formatted(mention["kind"], text[start:end], mention["surrogate"])
        parts += [text[before:start], drawn]
        before = end
    return "".join([*parts, text[before:]])
