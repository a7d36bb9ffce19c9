"""Replaces personal data by keyed surrogates of the same kind and shape.

Found are e-mail addresses, IPv4 and IPv6 addresses, card, account, social
security and telephone numbers, and names after a form of address, with all bare
mentions of such a name, or of one of its words, in the same text. A surrogate is drawn from
an HMAC of the entity under a secret key: digits stay digits, letters stay
letters of their case, separators stay; octets stay valid; a valid check digit
stays valid; a name keeps its script, its capitals and the gender that the form
of address tells.

A name is replaced word by word, so that its parts and bare mentions agree with it.
One entity, however it is written, has one surrogate everywhere (coreference),
and different entities have different ones, none of them an entity of the corpus
itself: the entities are gathered once, surrogates that collide are drawn anew,
all but the first, until none collides. Only redrawn entities, usually none or
few, are joined back to the texts that hold them.

Defined results: a null text stays null, an empty one empty, both without
entities; texts of rows that share an id are kept apart by their hash; repeated
rows are treated alike; an empty table gives an empty one; of the other columns
those asked for are kept.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlake.llm.hashing import slices
from flowlake.llm.tables import BUILD_SIDE, stored

MALE = ("Mr", "Mister", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "господин", "Господин", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Lady", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Signora", "госпожа", "Госпожа", "г-жа")
_FORMS = {form: kind for kind, own in (("name_m", MALE), ("name_f", FEMALE)) for word in own for form in (word, word.upper())}
_ADDRESS = "|".join(sorted(map(re.escape, _FORMS), key=len, reverse=True))
_NAME_WORD = r"[^\W\d_a-zà-öø-ÿа-я][^\W\d_]+(?:-[^\W\d_]+)?"

# Matches of these are checked; where one fails, the others are tried.
_CHECKED = r"""
    (?<![\w:.])(?P<ip6>(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4})(?![\w:]|\.\d)
  | (?<!\w)(?P<long>\d{13,19}|\d{4}(?:[\ -]?\d{4}){2,3}[\ -]?\d{1,4}|\d{4}[\ -]\d{6}[\ -]\d{4,5})(?!\w)
"""
_UNCHECKED = rf"""
    (?P<email>[\w.+-]*\w@\w(?:[\w-]*\w)?(?:\.\w(?:[\w-]*\w)?)+)
  | (?<![\w.])(?P<ip>(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){{3}})(?![\w]|\.\d)
  | (?<!\w)(?P<account>[A-Z]{{2}}\d{{2}}(?:\ ?[A-Z0-9]{{4}}){{3,7}}(?:\ ?[A-Z0-9]{{1,3}})?)(?!\w)
  | (?<![\w])(?P<card>\d{{4}}(?:[\ -]?\d{{4}}){{3}})(?!\w)
  | (?<![\w-])(?P<social>\d{{3}}-\d{{2}}-\d{{4}})(?![\w-])
  | (?<![\w])(?P<phone>(?:\+\d{{1,3}}[\ .-]?)?(?:\(\d{{2,4}}\)[\ .-]?|\d{{2,4}}[\ .-])\d{{3,4}}[\ .-]?\d{{3,4}})(?!\w)
  | (?<!\w)(?P<world>\+\d{{7,15}}|\+\d{{1,4}}(?:[\ .-]\d{{1,6}}|[\ .-]?\(\d{{1,4}}\)[\ .-]?\d{{1,6}}){{2,7}}|0\d(?:[\ .-]\d{{2}}){{4}})(?!\w)
  | (?<!\w)(?P<address>{_ADDRESS})(?P<dot>\.?\s+)(?P<name>{_NAME_WORD}(?:\ {_NAME_WORD}){{0,2}})
"""
_PLAIN = re.compile(_UNCHECKED, re.X)
ENTITIES = re.compile(_CHECKED + "|" + _UNCHECKED, re.X)
_LONG = re.compile(r"(?:\d{13,19}|\d{4}(?:[ -]?\d{4}){3})(?!\w)")
_ANY = re.compile(rf"[@\d]|(?<!\w)(?:{_ADDRESS})(?!\w)")

_SYLLABLES = {
    "latin": (("bel", "cor", "dan", "fer", "gal", "hal", "jor", "kel", "lam", "mar", "nor", "pel", "ros", "sam", "tor", "val"), ("an", "er", "on", "is"), ("a", "ia", "ella", "ina")),
    "cyrillic": (("бел", "вор", "гал", "дан", "зор", "кал", "лев", "мар", "нор", "пол", "рос", "сав", "тор", "фед", "хор", "яр"), ("ан", "ов", "ин", "ий"), ("а", "ова", "ина", "ия")),
    "greek": (("αλ", "βασ", "γερ", "δημ", "ευ", "θαν", "καλ", "λεω", "μαρ", "νικ", "παν", "ροδ", "σπυ", "τιμ", "φιλ", "χρι"), ("ος", "ης", "ας", "ων"), ("α", "η", "ια", "ινα")),
}
# After so many draws a surrogate may be longer than the entity.
DRAWS = 16


def _script(word: str) -> str:
    code = ord(word[0])
    return "cyrillic" if 0x400 <= code < 0x530 else "greek" if 0x370 <= code < 0x400 else "latin"


class _Draw:
    """An endless stream of numbers from an HMAC."""

    def __init__(self, key: bytes, *parts: str) -> None:
        self.key, self.message, self.count, self.pool = key, "\x00".join(parts).encode(), 0, b""

    def below(self, n: int) -> int:
        while True:
            if len(self.pool) < 4:
                self.pool += hmac.new(self.key, self.message + self.count.to_bytes(4, "big"), hashlib.sha256).digest()
                self.count += 1
            value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
            if value < (1 << 32) // n * n:
                return value % n


def canonical(kind: str, text: str) -> str:
    """One form for all ways to write an entity."""
    if kind in ("card", "phone", "social"):
        return re.sub(r"\D", "", text)
    if kind == "account":
        return text.replace(" ", "")
    if kind == "ip6":
        return ipaddress.IPv6Address(text).exploded
    return re.sub(r"\s+", " ", text).casefold() if kind in ("email", "name_m", "name_f") else text


def parts(kind: str, entity: str) -> list[str]:
    """What of a canonical entity has a surrogate of its own: the words of a name."""
    return entity.split(" ") if kind.startswith("name") else [entity]


def _luhn(digits: str) -> int:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The canonical surrogate of a canonical entity."""
    draw = _Draw(key, kind, entity, str(attempt))
    extra = attempt // DRAWS
    if kind.startswith("name"):
        words = []
        for word in entity.split(" "):
            stems, male, female = _SYLLABLES[_script(word)]
            endings = female if kind == "name_f" else male
            body = "".join(stems[draw.below(len(stems))] for _ in range(max(4, len(word) // 4) + extra))
            words.append(body + endings[draw.below(len(endings))])
        return " ".join(words)
    if kind == "ip":
        octets = []
        for octet in entity.split("."):
            low, high = (0, 9) if len(octet) == 1 else (10, 99) if len(octet) == 2 else (100, 255)
            octets.append(str((0 if extra else low) + draw.below((255 if extra else high) - (0 if extra else low) + 1)))
        return ".".join(octets)
    if kind == "ip6":
        # Groups of zeros stay, so the address can be written as short.
        groups = [group.lstrip("0") for group in entity.split(":")]
        return ":".join(f"{1 + draw.below(16 ** (4 if extra else len(g)) - 1):04x}" if g else "0000" for g in groups)
    out = []
    tail = entity.rpartition(".")[2] if kind == "email" else ""
    for i, c in enumerate(entity[:len(entity) - len(tail)] if tail else entity):
        if c.isdecimal():
            out.append(str(1 + draw.below(9) if i == 0 or c != "0" and entity[i - 1] == "+" else draw.below(10)))
        elif c.isalpha() and not (kind == "account" and i < 2):
            first = "а" if 0x400 <= ord(c) < 0x530 else "α" if 0x370 <= ord(c) < 0x400 else "a"
            letter = chr(ord(first) + draw.below(24 if first == "α" else 26)).replace("ς", "σ")
            out.append(letter.upper() if c.isupper() else letter)
        else:
            out.append(c)
    for _ in range(extra):
        out.insert(0, str(1 + draw.below(9)))
    if kind == "card" and _luhn(entity) == 0:
        body = "".join(out[:-1])
        out[-1] = next(str(d) for d in range(10) if _luhn(body + str(d)) == 0)
    return "".join(out) + tail


def _shaped(kind: str, written: str, new: str) -> str:
    """A canonical surrogate in the shape of the entity as written."""
    if kind.startswith("name"):
        words = [n.upper() if w.isupper() else n.capitalize() for w, n in zip(re.split(r"\s+", written), new.split(" "))]
        return " ".join(words)
    if kind == "email":
        return new.upper() if written.isupper() else new
    if kind == "ip":
        return new
    if kind == "ip6":
        short = str(ipaddress.IPv6Address(new)) if "::" in written else ":".join(
            n if len(w) == 4 else n.lstrip("0") or "0" for w, n in zip(written.split(":"), new.split(":")))
        return short.upper() if any(c.isupper() for c in written) else short
    fill = iter(new)
    kept = "".join(next(fill, "") if c.isalnum() else c for c in written)
    return kept + "".join(fill)


def _is_long_card(text: str) -> bool:
    digits = re.sub(r"\D", "", text)
    return 13 <= len(digits) <= 19 and _luhn(digits) == 0


def _is_ip6(text: str) -> bool:
    """Not a time, a slice, a scope operator, or an address of one group."""
    groups = [g for g in text.split(":") if g]
    if len(groups) < 2 or len(groups) < 8 and max(map(len, groups)) < 3 or not any(map(str.isdigit, text)):
        return False
    try:
        return bool(ipaddress.IPv6Address(text))
    except ValueError:
        return False


def _end_of_phone(text: str, start: int, end: int) -> int | None:
    """Where an international number of 7 to 15 digits ends; a card that follows
    is no part of it."""
    last = None
    for m in re.finditer(r"\d+", text[start:end]):
        if m.start() > 1 and last and _LONG.match(text, start + m.start()):
            break
        digits = sum(map(str.isdecimal, text[start:start + m.end()]))
        if digits > 15:
            break
        last = start + m.end() if digits >= 7 else last
    return last


def _bare_mentions(text: str, found: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Mentions, without a form of address, of names that were found in the text.
    Words that also stand there in lower case are no names on their own."""
    named = [m for m in found if m[0].startswith("name")]
    if not named:
        return []
    rest, at = [], 0
    for _, s, e in found:
        rest += [text[at:s], "\0" * (e - s)]
        at = e
    rest = "".join(rest) + text[at:]
    kinds: dict[str, str] = {}
    for kind, s, e in named:
        kinds.setdefault(canonical(kind, text[s:e]), kind)
    for whole, kind in list(kinds.items()):
        words = whole.split(" ")
        for pair in zip(words, words[1:]):
            kinds.setdefault(" ".join(pair), kind)
        for word in words:
            if word in kinds or re.search(rf"(?<!\w){re.escape(word)}(?!\w)", rest) is None:
                kinds.setdefault(word, kind)
    any_name = "|".join(re.escape(n).replace(r"\ ", r"\s+") for n in sorted(kinds, key=len, reverse=True))
    hits = re.finditer(rf"(?<!\w)(?:{any_name})(?!\w)", rest, re.I)
    return [(kinds[name], m.start(), m.end()) for m in hits
            if all(w[0].isupper() for w in m[0].split()) and (name := canonical("name_m", m[0])) in kinds]


def mentions(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every entity, left to right."""
    if not text or not _ANY.search(text):
        return []
    found, at = [], 0
    while m := ENTITIES.search(text, at):
        kind = m.lastgroup
        if kind == "long" and not _is_long_card(m[kind]) or kind == "ip6" and not _is_ip6(m[kind]):
            start = m.start()
            m = _PLAIN.match(text, start)
            kind = m and m.lastgroup
        start, end = m.span() if m else (start, None)
        if kind == "name":
            start, end = m.span("name")
            kind = _FORMS[m["address"]]
        elif kind == "world":
            kind, end = "phone", _end_of_phone(text, start, end)
        elif kind == "long":
            kind = "card"
        if end is None:
            at = start + 1
        else:
            found.append((kind, start, end))
            at = end
    return sorted(found + _bare_mentions(text, found), key=lambda m: m[1])


def _entities(docs: DataFrame, key: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            rows = {(kind, part) for text in batch.column(0).to_pylist() for kind, s, e in mentions(text) for part in parts(kind, canonical(kind, text[s:e]))}
            if rows:
                kinds, names = zip(*sorted(rows))
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(names)], ["kind", "entity"])

    return docs.mapInArrow(run, "kind string, entity string").distinct()


def _drawn(entities: DataFrame, key: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [surrogate(key, *row) for row in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(new, pa.string())], ["kind", "entity", "attempt", "surrogate"])

    return entities.mapInArrow(run, "kind string, entity string, attempt int, surrogate string")


def redrawn_entities(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """kind, entity, attempt, surrogate of the entities whose first draw
    collided; after it no two entities share a surrogate, and none of these is
    an entity of the corpus."""
    names = stored(_entities(docs.select(text), key), "entities")
    drawn = stored(_drawn(names.withColumn("attempt", F.lit(0)), key), "surrogates")
    # Names of both genders must differ from each other, too.
    family = lambda c: F.substring_index(c, "_", 1)
    while True:
        real = names.select(family("kind").alias("family"), F.col("entity").alias("surrogate"), F.lit(True).alias("real")).distinct()
        first = drawn.groupBy(family("kind").alias("family"), "surrogate").agg(
            F.count("*").alias("n"), F.min(F.struct("entity", "kind")).alias("owner"))
        bad = stored(first.join(real, ["family", "surrogate"], "left").filter("n > 1 OR real"), "collisions")
        if bad.isEmpty():
            return drawn.filter("attempt > 0")
        again = drawn.withColumn("family", family("kind")).join(bad, ["family", "surrogate"], "left")
        lost = F.coalesce("real", F.lit(False)) | (F.col("owner").isNotNull() & (F.struct("entity", "kind") != F.col("owner")))
        drawn = stored(_drawn(again.select("kind", "entity", (F.col("attempt") + lost.cast("int")).alias("attempt")), key), "surrogates")


def replace_entities(docs: DataFrame, key: bytes, text: str = "text", keep: list[str] = ("doc_id",)) -> DataFrame:
    """The kept columns, the new text, and entities: what was found, by kind and
    place in the new text."""
    keep = list(keep)
    rows = docs.select(*keep, F.col(text).alias("__text"), F.col("doc_id").alias("__id"), F.xxhash64(text).alias("__hash"))
    changed = stored(redrawn_entities(docs, key, text), "redrawn")
    pairs = T.ArrayType(T.StructType().add("kind", T.StringType()).add("entity", T.StringType()).add("surrogate", T.StringType()))
    if changed.isEmpty():
        rows = rows.withColumn("__own", F.lit(None).cast(pairs))
    else:
        def which(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(i, h, kind, part) for body, i, h in zip(*(c.to_pylist() for c in batch.columns))
                         for kind, s, e in mentions(body) for part in parts(kind, canonical(kind, body[s:e]))]
                if found:
                    i, h, kind, entity = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(h, pa.int64()), pa.array(kind), pa.array(entity)], ["i", "h", "kind", "entity"])

        where = rows.select("__text", F.col("__id").cast("long"), "__hash").mapInArrow(which, "i long, h long, kind string, entity string").distinct()
        own = where.join(changed, ["kind", "entity"]).groupBy("i", "h").agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias("__own"))
        rows = rows.join(own.hint(BUILD_SIDE), F.col("__id").eqNullSafe(F.col("i")) & F.col("__hash").eqNullSafe(F.col("h")), "left")
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            texts, found = [], []
            for body, own in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist()):
                other = {(o["kind"], o["entity"]): o["surrogate"] for o in own or ()}
                out, at, length, places = [], 0, 0, []
                for kind, start, end in mentions(body):
                    own_parts = parts(kind, canonical(kind, body[start:end]))
                    drawn = [other.get((kind, part)) or surrogate(key, kind, part, 0) for part in own_parts]
                    new = _shaped(kind, body[start:end], " ".join(drawn))
                    out += [body[at:start], new]
                    length += start - at
                    places.append({"kind": kind, "start": length, "end": length + len(new)})
                    length, at = length + len(new), end
                texts.append(body if body is None else "".join(out) + body[at:])
                found.append(places)
            place = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(n)), pa.array(texts, pa.string()), pa.array(found, place)], [*keep, "new_text", "entities"])

    schema = T.StructType([docs.schema[c] for c in keep]).add("new_text", T.StringType()).add(
        "entities", T.ArrayType(T.StructType().add("kind", T.StringType()).add("start", T.IntegerType()).add("end", T.IntegerType())))
    return rows.select(*keep, "__text", "__own").mapInArrow(run, schema)
