"""Surrogates for personal data: keyed, of the same type and format, one for each entity of the corpus.

Numbers and addresses are permuted by a key within the set of all values of their own format, so
different entities stay different and no value of the set runs out, even if all of them occur.
Names are made word by word: a surname has one surrogate whatever title or given name goes with it,
a given name one for each gender. Invented words are checked against each other and against the
corpus, and those that collide are told apart by further syllables.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator
from math import isqrt, prod

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .util import apart, durable, read

#: The key of tests and of the registered query; a deployment gives its own.
KEY = "surrogates"
ROUNDS = 6
#: Lists of names of a text up to which they are broadcast.
BROADCAST_LISTS = 20_000

FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Doña", "г-жа", "госпожа")
MALE_TITLES = ("Mr", "Herr", "Monsieur", "M", "Señor", "Sr", "Don", "г-н", "господин")
OTHER_TITLES = ("Dr", "Prof")
GENDER = {f: g for g, titles in (("f", FEMALE_TITLES), ("m", MALE_TITLES), ("x", OTHER_TITLES)) for t in titles for f in {t, t.upper(), t[0].upper() + t[1:]}}


def _by_first(titles: list[str]) -> str:
    """Alternatives by first letter, so that a search passes most places after one look."""
    first = sorted({t[0] for t in titles})
    own = lambda c: sorted((t[1:] for t in titles if t[0] == c), key=lambda t: (-len(t), t))
    return "(?:" + "|".join(f"{c}(?:{'|'.join(map(re.escape, own(c)))})" for c in first) + ")"


TITLES = _by_first(list(GENDER))
NAME_WORD = r"(?:[^\W\d_]\.|[^\W\d_][\w'’-]+)"
PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}(?![\w-])"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "ipv4": re.compile(r"(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![\w]|\.[0-9])"),
    "ipv6": re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![\w:])"),
    "card": re.compile(r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-]|\.[0-9])"),
    "ssn": re.compile(r"(?<![\w-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![\w-])"),
    "phone": re.compile(r"(?<![\w.+-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{1,4}\)[ .-]?|[0-9]{2,4}[ .-])(?:[0-9]{2,4}[ .-]){1,3}[0-9]{2,4}(?![\w-]|\.[0-9])|(?<![\w+])\+[0-9]{8,15}(?!\w)"),
    "name": re.compile(rf"(?<!\w)({TITLES})\.? ({NAME_WORD}(?: {NAME_WORD})*)"),
}
#: Each alternative is a part that every match of one or more of the patterns holds, so a text without any has no entity.
HINT = r"@|[A-Z]{2}[0-9]{2}|[0-9]\.[0-9]|:[0-9A-Fa-f]{0,4}:|[0-9](?:[ -]?[0-9]){12}|[0-9]{3}-[0-9]{2}-|[0-9]{2}[ .-][0-9]{2}|\+[0-9]{8}"
NAME_HINT = TITLES + r"\.? \S"

SCRIPTS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
#: Syllables are a consonant and a vowel each; the ending tells gender, and given names from surnames.
SYLLABLES = {"latin": ("bdfghjklmnprstvz", "aeiou"), "cyrillic": ("бвгдзклмнпрст", "аеиоу"), "greek": ("βγδκλμνπρστφ", "αειου")}
ENDINGS = {
    "latin": {"gf": "nna", "gm": "rt", "gx": "ss", "s": "ck"}, "cyrillic": {"gf": "нна", "gm": "рт", "gx": "сс", "sf": "нская", "s": "нский"},
    "greek": {"gf": "ννα", "gm": "ρης", "gx": "ξ", "sf": "δου", "s": "δης"},
}
BASE_SYLLABLES = 3


def luhn_ok(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def iban_check(country: str, body: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def script_of(word: str) -> str:
    return "cyrillic" if re.search("[Ѐ-ӿ]", word) else "greek" if re.search("[Ͱ-Ͽἀ-῿]", word) else "latin"


def _titled(text: str) -> Iterator[tuple[int, str, str]]:
    """Place, gender and words of the names with titles: the run of capitalised words."""
    for m in PATTERNS["name"].finditer(text):
        words = []
        for w in m.group(2).split(" "):
            if not w[0].isupper():
                break
            words.append(w)
        while words and words[-1].endswith("."):
            words.pop()
        if words:
            yield m.start(2), GENDER[m.group(1)], " ".join(words)


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, type, entity) in order; of overlapping ones the first type in order of PATTERNS stays.

    The entity is the form that coreference goes by: lower-cased mail, bare digits, an address as it
    is meant, a name with its gender as far as a title tells it. A name that a title shows is also
    found where the same text has it, or its last word of three letters or more, without one.
    """
    if not text:
        return []
    found: list[tuple[int, int, str, str]] = []
    taken = bytearray(len(text))

    def add(start: int, end: int, kind: str, entity: str) -> None:
        if not any(taken[start:end]):
            found.append((start, end, kind, entity))
            taken[start:end] = b"\1" * (end - start)

    for kind, pattern in PATTERNS.items():
        if kind == "name" or (kind == "email" and "@" not in text):
            continue
        for m in pattern.finditer(text):
            own, digits = m.group(), re.sub("[^0-9]", "", m.group())
            if kind == "email":
                add(m.start(), m.end(), kind, own.lower())
            elif kind == "iban":
                bare = own.replace(" ", "")
                if iban_check(bare[:2], bare[4:]) == int(bare[2:4]):
                    add(m.start(), m.end(), kind, bare)
            elif kind == "ipv4" and all(int(x) <= 255 for x in own.split(".")):
                add(m.start(), m.end(), kind, ".".join(str(int(x)) for x in own.split(".")))
            elif kind == "ipv6":
                try:
                    add(m.start(), m.end(), kind, ipaddress.IPv6Address(own).exploded)
                except ValueError:
                    pass
            elif kind == "card" and 13 <= len(digits) <= 19 and (luhn_ok(digits) or digits == own and len(digits) in (15, 16)):
                add(m.start(), m.end(), kind, digits)
            elif kind == "ssn":
                add(m.start(), m.end(), kind, digits)
            elif kind == "phone" and 8 <= len(digits) <= 15:
                add(m.start(), m.end(), kind, ("+" if own[0] == "+" else "") + digits)
    names = list(_titled(text))
    for start, gender, words in names:
        add(start, start + len(words), "name", f"{gender}:{words}")
    if names:
        known: dict[str, set[str]] = {}
        for _, gender, words in names:
            known.setdefault(words, set()).add(gender)
            last = words.rsplit(" ", 1)[-1]
            if len(last) > 2:
                known.setdefault(last, set()).add("x")
        again = re.compile(rf"(?<![\w'’-])(?:{'|'.join(re.escape(w) for w in sorted(known, key=lambda w: (-len(w), w)))})(?![\w'’-])")
        for m in again.finditer(text):
            genders = known[m.group()] - {"x"}
            add(m.start(), m.end(), "name", f"{genders.pop() if len(genders) == 1 else 'x'}:{m.group()}")
    return sorted(found)


def _number(key: str, *parts: object) -> Callable[[int], int]:
    """A keyed function to numbers below n, evenly but for 2^-64."""

    def below(n: int) -> int:
        out, want = b"", (n.bit_length() + 71) // 8
        while len(out) < want:
            out += hmac.new(key.encode(), "\0".join(map(str, (*parts, len(out)))).encode(), hashlib.sha256).digest()
        return int.from_bytes(out[:want], "big") % n

    return below


def permute(key: str, tweak: str, n: int, x: int, back: bool = False) -> int:
    """A keyed permutation of 0..n-1: a Feistel network on a rectangle of n places or a few more, walked until it is below n."""
    a = isqrt(n - 1) + 1
    b = -(-n // a)
    while True:
        left, right = divmod(x, b)
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            turn = (-1 if back else 1) * _number(key, tweak, n, k, left if k % 2 else right)(b if k % 2 else a)
            if k % 2:
                right = (right + turn) % b
            else:
                left = (left + turn) % a
        x = left * b + right
        if x < n:
            return x


def moved(key: str, tweak: str, n: int, x: int) -> int:
    """A keyed permutation of 0..n-1 that moves every value, if there are two or more: the next one in a keyed circle."""
    return x if n < 2 else permute(key, tweak, n, (permute(key, tweak, n, x) + 1) % n, True)


def _shaped(key: str, tweak: str, text: str, letters: str = SCRIPTS["latin"]) -> str:
    """Another text of the same shape: letters for letters, digits for digits, all else as it is."""
    sets = [letters if c in letters else "0123456789" if c in "0123456789" else c for c in text]
    value = 0
    for c, own in zip(text, sets, strict=True):
        value = value * len(own) + own.index(c)
    shape = "".join("a" if own == letters else "0" if len(own) == 10 else c for c, own in zip(text, sets, strict=True))
    value, out = moved(key, f"{tweak}\0{shape}", prod(map(len, sets)), value), []
    for own in reversed(sets):
        value, at = divmod(value, len(own))
        out.append(own[at])
    return "".join(reversed(out))


def _private(x: int) -> tuple[int, int] | None:
    """First address and number of addresses of the private block that holds x."""
    blocks = [(10 << 24, 1 << 24), (172 << 24 | 16 << 16, 1 << 20), (192 << 24 | 168 << 16, 1 << 16), (127 << 24, 1 << 24)]
    return next(((a, n) for a, n in blocks if a <= x < a + n), None)


def surrogate(key: str, kind: str, entity: str) -> str:
    """Another entity of the same type, in the form of `entity`; different for different entities of a kind but names."""
    if kind == "email":
        local, domain = entity.rsplit("@", 1)
        labels = domain.split(".")
        # the top-level domain stays; 'example' domains are reserved and stay as they are
        kept = "\1".join(x if x == "example" or k == len(labels) - 1 else "" for k, x in enumerate(labels))
        free = [local, *(x for k, x in enumerate(labels) if x != "example" and k < len(labels) - 1)]
        new = iter(_shaped(key, f"{kind}\0{kept}", "\1".join(free)).split("\1"))
        return next(new) + "@" + ".".join(x if x == "example" or k == len(labels) - 1 else next(new) for k, x in enumerate(labels))
    if kind == "ipv4":
        x = int(ipaddress.IPv4Address(entity))
        block = _private(x)
        if block:
            return str(ipaddress.IPv4Address(block[0] + moved(key, f"{kind}{block[0]}", block[1], x - block[0])))
        x = moved(key, kind, 1 << 32, x)
        while _private(x):
            x = moved(key, kind, 1 << 32, x)
        return str(ipaddress.IPv4Address(x))
    if kind == "ipv6":
        groups = [int(g, 16) for g in entity.split(":")]
        # the first group of link-local, unique-local and multicast addresses tells their type
        first = 1 if groups[0] & 0xFFC0 == 0xFE80 or groups[0] & 0xFE00 == 0xFC00 or groups[0] & 0xFF00 == 0xFF00 else 0
        free = [k for k in range(first, 8) if groups[k]]
        lows = [16 ** (len(f"{groups[k]:x}") - 1) for k in free]
        value = 0
        for k, low in zip(free, lows, strict=True):
            value = value * (15 * low) + groups[k] - low
        value = moved(key, f"{kind}{groups[:first]}{free}{lows}", prod(15 * low for low in lows), value)
        for k, low in zip(reversed(free), reversed(lows), strict=True):
            value, at = divmod(value, 15 * low)
            groups[k] = low + at
        return ":".join(f"{g:04x}" for g in groups)
    if kind == "card":
        if luhn_ok(entity):
            body = entity[0] + _shaped(key, f"{kind}{entity[0]}", entity[1:-1])
            return next(body + str(c) for c in range(10) if luhn_ok(body + str(c)))
        new = entity[0] + _shaped(key, f"{kind}{entity[0]}x", entity[1:])
        while luhn_ok(new):
            new = new[0] + _shaped(key, f"{kind}{entity[0]}x", new[1:])
        return new
    if kind == "iban":
        body = _shaped(key, f"{kind}{entity[:2]}", entity[4:].lower()).upper()
        return f"{entity[:2]}{iban_check(entity[:2], body):02d}{body}"
    if kind == "ssn":
        area, group, serial = int(entity[:3]), int(entity[3:5]), int(entity[5:])
        x = moved(key, kind, 898 * 99 * 9999, ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1)
        rest, serial = divmod(x, 9999)
        area, group = divmod(rest, 99)
        return f"{area + 1 + (area >= 665):03d}{group + 1:02d}{serial + 1:04d}"
    plus, digits = ("+", entity[1:]) if entity[0] == "+" else ("", entity)
    keep = max(1, len(digits) - 10) if plus else 0  # the country code
    keep += digits[keep] in "01"  # a trunk prefix
    return plus + digits[:keep] + _shaped(key, f"{kind}{plus}{digits[:keep]}", digits[keep:])


def written(original: str, kind: str, new: str) -> str:
    """The surrogate in the way the original is written: its separators, its case, its zeros."""
    if kind in ("card", "ssn", "phone", "iban"):
        chars = iter(new.lstrip("+"))
        return "".join(next(chars) if c.isalnum() else c for c in original)
    if kind == "email":
        return "".join(n.upper() if o.isupper() else n for o, n in zip(original, new, strict=True))
    if kind == "ipv4":
        return ".".join(n.zfill(len(o)) if o[0] == "0" and len(o) > 1 else n for o, n in zip(original.split("."), new.split("."), strict=True))
    groups, (before, _, after) = new.split(":"), original.partition("::")
    head, tail = before.split(":") if before else [], after.split(":") if after else []

    def like(o: str, n: str) -> str:
        n = f"{int(n, 16):x}".zfill(len(o))
        return n.upper() if o != o.lower() else n

    out = ":".join(like(o, n) for o, n in zip(head, groups, strict=False))
    return out if "::" not in original else out + "::" + ":".join(like(o, n) for o, n in zip(tail, groups[8 - len(tail) :], strict=True))


def _pieces(word: str) -> list[str]:
    return [w for w in word.split("-") if w]


def slots(gender: str, words: str) -> list[tuple[str, str]]:
    """(slot, word) of each piece of a name but initials: given names by gender, the last word as a surname, with its own gender's ending where the script has one."""
    out, parts = [], words.split(" ")
    for k, word in enumerate(parts):
        for piece in [] if word.endswith(".") else _pieces(word):
            low, script = piece.casefold(), script_of(piece)
            slot = "g" + gender if k < len(parts) - 1 else "sf" if "sf" in ENDINGS[script] and re.search("(?:[аяηα]|ου)$", low) else "s"
            out.append((f"{script}:{slot}", low))
    return out


def _spelled(script: str, number: int, least: int = 1) -> str:
    """A number in syllables, `least` or more."""
    consonants, vowels = SYLLABLES[script]
    out, n = [], len(consonants) * len(vowels)
    while number or len(out) < least:
        number, at = divmod(number, n)
        out.append(consonants[at // len(vowels)] + vowels[at % len(vowels)])
    return "".join(out)


def invented(key: str, slot: str, word: str, code: int = 0) -> str:
    """A name for a word; `code` tells apart words that would get the same one."""
    script, part = slot.split(":")
    consonants, vowels = SYLLABLES[script]
    base = _number(key, "name", slot, word)((len(consonants) * len(vowels)) ** BASE_SYLLABLES)
    return _spelled(script, base, BASE_SYLLABLES)[: 2 * BASE_SYLLABLES] + (_spelled(script, code) if code else "") + ENDINGS[script][part]


def named(original: str, new: list[str]) -> str:
    """The name's words replaced one by one, in the original's case, hyphens and initials."""
    words = iter(new)
    like = lambda o: (lambda n: n.upper() if o.isupper() and len(o) > 1 else n.capitalize())(next(words))
    return " ".join(w if w.endswith(".") else "-".join(like(p) if p else p for p in w.split("-")) for w in original.split(" "))


def _rows(schema: str, work: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(work(batch))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows, strict=True) if rows else [()] * len(names))], names)

    return run


def names_of(texts: DataFrame) -> DataFrame:
    """text_key, gender, words of the names in `texts` (text_key, text)."""
    schema = "text_key string, gender string, words string"

    def work(batch: pa.RecordBatch) -> Iterator[tuple]:
        for k, t in zip(batch["text_key"].to_pylist(), batch["text"], strict=True):
            yield from {(k, *x[3].split(":", 1)) for x in detect(t.as_py()) if x[2] == "name"}

    return texts.select("text_key", "text").mapInArrow(_rows(schema, work), schema).distinct()


def assign(names: DataFrame, key: str) -> DataFrame:
    """(gender, words, surrogates: the new words in order) for distinct (gender, words).

    A name of unknown gender takes that of the same name with a title that tells it, if there is
    only one. Words whose inventions are alike, or are words of the corpus, are told apart by their
    rank among them; these groups are small, since inventions are drawn from a keyed function.
    """
    low = F.lower("words")
    known = names.groupBy(low.alias("__low")).agg(F.bool_or(F.col("gender") == "f").alias("f"), F.bool_or(F.col("gender") == "m").alias("m"))
    real = F.when((F.col("gender") == "x") & F.col("f") & ~F.col("m"), "f").when((F.col("gender") == "x") & F.col("m") & ~F.col("f"), "m").otherwise(F.col("gender"))
    names = names.join(known, low == F.col("__low")).select("gender", "words", real.alias("real"))
    schema = "gender string, words string, nth string, slot string, word string, base string"

    def work(batch: pa.RecordBatch) -> Iterator[tuple]:
        for g, w, r in zip(*(batch[c].to_pylist() for c in ("gender", "words", "real")), strict=True):
            for k, (slot, word) in enumerate(slots(r, w)):
                yield g, w, str(k), slot, word, invented(key, slot, word)

    parts = durable(names.mapInArrow(_rows(schema, work), schema))
    words = parts.select("slot", "word", "base").distinct()
    corpus = words.select(F.col("word").alias("__word")).distinct()
    rank = F.row_number().over(Window.partitionBy("base").orderBy("slot", "word")) - 1
    ranked = words.withColumn("__rank", rank).join(corpus, F.col("base") == F.col("__word"), "left")
    codes = ranked.select(F.col("slot").alias("__slot"), F.col("word").alias("__w"), (2 * F.col("__rank") + F.col("__word").isNotNull().cast("int")).cast("string").alias("code"))
    coded = parts.join(codes, (F.col("slot") == F.col("__slot")) & (F.col("word") == F.col("__w"))).select("gender", "words", "nth", "slot", "word", "code")

    def spell(batch: pa.RecordBatch) -> Iterator[tuple]:
        for g, w, n, slot, word, code in zip(*(batch[c].to_pylist() for c in ("gender", "words", "nth", "slot", "word", "code")), strict=True):
            yield g, w, n, invented(key, slot, word, int(code))

    made = coded.mapInArrow(_rows("gender string, words string, nth string, new string", spell), "gender string, words string, nth string, new string")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(F.col("nth").cast("int").alias("nth"), "new"))), lambda x: x["new"])
    return made.groupBy("gender", "words").agg(ordered.alias("surrogates"))


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """`docs` with the personal data in `text` replaced, n_entities, and entity_spans (start:end:type in the original text).

    All columns of `docs` are kept in their order (columns n_entities and entity_spans are replaced
    if there are such). A null text stays null, an empty one empty. Only texts with a title before a
    name are read for names and joined with theirs, by MD5, so copies of a text share them; all
    other texts are rewritten where they lie. Repeated rows stay, an empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in ("n_entities", "entity_spans")]
    docs = apart(docs.select(*names), ("text",))
    columns = docs.columns
    titled = F.coalesce(F.regexp_like(F.col("text"), F.lit(NAME_HINT)), F.lit(False))
    text_key = F.md5(F.col("text").cast("binary"))
    pairs = durable(names_of(docs.where(titled).select(text_key.alias("text_key"), "text")))
    chosen = assign(pairs.select("gender", "words").distinct(), key).withColumnsRenamed({"gender": "__g", "words": "__w"})
    own = pairs.join(chosen, (F.col("gender") == F.col("__g")) & (F.col("words") == F.col("__w")))
    # the names of a text: bounded by its length
    lists = durable(own.groupBy("text_key").agg(F.collect_list(F.struct("gender", "words", "surrogates")).alias("__names")))
    side = F.broadcast(lists) if lists.count() <= BROADCAST_LISTS else lists
    hint = F.coalesce(F.regexp_like(F.col("text"), F.lit(HINT)), F.lit(False))
    with_names = docs.where(titled).select(*columns, text_key.alias("__key"), F.lit(True).alias("__hint")).join(side, F.col("__key") == F.col("text_key"), "left").drop("__key", "text_key")
    rows = docs.where(~titled).select(*columns, hint.alias("__hint"), F.lit(None).cast(lists.schema["__names"].dataType).alias("__names")).unionByName(with_names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in columns) + ", n_entities long, entity_spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, spans = [], [], []
            for text, hinted, own in zip(batch["text"], batch["__hint"], batch["__names"], strict=True):
                old, at, parts, listed = text.as_py(), 0, [], []
                new = {(x["gender"], x["words"]): x["surrogates"] for x in own.as_py() or ()}
                for start, end, kind, entity in detect(old) if hinted.as_py() else ():
                    if kind == "name":
                        put = named(old[start:end], new[tuple(entity.split(":", 1))])
                    else:
                        put = written(old[start:end], kind, surrogate(key, kind, entity))
                    parts += [old[at:start], put]
                    listed.append(f"{start}:{end}:{kind}")
                    at = end
                texts.append("".join([*parts, old[at:]]) if parts else old)
                counts.append(len(listed))
                spans.append(",".join(listed))
            arrays = [pa.array(texts, pa.string()) if c == "text" else batch[c] for c in columns]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts, pa.int64()), pa.array(spans, pa.string())], [*columns, "n_entities", "entity_spans"])

    return rows.mapInArrow(run, schema).toDF(*names, "n_entities", "entity_spans")


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = replace(read(spark, sf_dir, "documents"))
    return replaced.select("doc_id", "text", "n_entities", "entity_spans")
