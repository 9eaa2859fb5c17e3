"""Personal data replaced by keyed surrogates of the same type and format.

Numbers and addresses are mapped by a keyed permutation of all values of the same form
(same length, same places of digits and letters), shifted so that no value keeps itself:
two different entities cannot meet, and an entity is the same everywhere, without any
table.  Names cannot be mapped that way, as their surrogates must look like names: each
part becomes syllables of its script with an ending of its gender, drawn by a keyed
hash.  All different names are checked for collisions, among surrogates and with names
that really occur, and drawn again until none is left.  A name is the same word in
every text: what all its titles tell, taken together, decides its gender.

Names are found after a title or a label such as "Name:", and from there on alone in the
same text.  A name takes all capitalised words and the particles between them; in
capitals throughout, where nothing shows its end, two words.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontor.llm.decontamination import text_key
from kontor.llm.frames import ROW, field, packed
from kontor.operators.sizing import written

# --- fixed values: titles with the gender they tell, and syllables by script ------------
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Herrn": "m", "Señor": "m", "Sr": "m", "Don": "m", "Monsieur": "m",
    "Signor": "m", "Господин": "m", "г-н": "m", "Κύριος": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Frau": "f", "Señora": "f", "Sra": "f", "Doña": "f", "Madame": "f",
    "Mme": "f", "Mlle": "f", "Signora": "f", "Госпожа": "f", "г-жа": "f", "Κυρία": "f",
    "Dr": "n", "Prof": "n", "Professor": "n", "Доктор": "n",
}
LABELS = ("name", "full name", "first name", "given name", "last name", "surname", "signed", "signed by")
PARTICLES = "van von der den de del della di da dos das du la le el al bin ibn ter ten zu y".split()
# Names that are common words too: alone at a sentence's start they are read as the word.
WORDS_TOO = frozenset(
    "will may mark grace rose bill hope faith joy art grant chase drew pat sue rob jack frank dean earl summer april june august "
    "long young black white green brown king price rich sharp wise best day page field hill".split()
)
SYLLABLES = {
    "latin": ("b d f g k l m n p r s t v z".split(), "a e i o u".split(), {"m": "n r s l k".split(), "f": "a ia na la ra".split()}),
    "cyrillic": ("б в г д ж з к л м н п р с т".split(), "а е и о у".split(), {"m": "н р с л к".split(), "f": "а ия на ла ра".split()}),
    "greek": ("β γ δ ζ θ κ λ μ ν π ρ σ τ φ".split(), "α ε η ι ο".split(), {"m": "ος ης ας ων ις".split(), "f": "α η ια να λα".split()}),
}
SYLLABLES_EACH = 4

_UPPER = "A-ZÀ-ÖØ-ÞА-ЯЁΑ-ΩΆΈΉΊΌΎΏ"
# Ends before a possessive.
_PART = rf"[{_UPPER}](?:\w|(?!['’]s(?!\w))['’-](?=\w))++"
_TITLE = "|".join(sorted(map(re.escape, {one for title in TITLES for one in (title, title.upper())}), key=len, reverse=True))
_GENDERS = {title.casefold(): gender for title, gender in TITLES.items()}
_LABEL = "|".join(f"[{one[0].upper()}{one[0]}]{one[1:]}|{one.upper()}" for one in sorted(LABELS, key=len, reverse=True))
_WORD = rf"(?!(?:{_TITLE})\.)(?:{_PART}|[{_UPPER}]\.)"
_WORDS = rf"{_WORD}(?: (?:(?:{'|'.join(PARTICLES)}) )*{_WORD})*"
NAMED = re.compile(rf"(?<!\w)(?:({_TITLE})\.?[  ]|(?m:^)[ \t]*(?:[-*] )?(?:{_LABEL})[ \t]*:[ \t]*)({_WORDS})")
# The same for the JVM, to pass only texts with a title or a label on.
HAS_TITLE = rf"(?Um)(?<!\w)({_TITLE})\.?[  ][{_UPPER}]|^[ \t]*(?:[-*] )?(?:{_LABEL})[ \t]*:[ \t]*[{_UPPER}]"
_MENTION = re.compile(rf"(?<!\w){_PART}")
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])")
IP6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d)")
NUMBER = re.compile(
    r"(?<![\w.@-])(?:(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?![\w@]|\.\d)"
    r"|(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)"
    r"|(?P<card>\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-])|(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}|(?<!\d )\d{3} \d{3} \d{4}(?! \d))(?![\w-]))"
)
KINDS = ("email", "ip", "ip6", "iban", "card", "ssn", "phone", "name")


# --- the keyed permutation ------------------------------------------------------
def _digest(key: bytes, *parts: str) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(parts).encode(), hashlib.sha256).digest()[:16], "big")


def _round(key: bytes, tweak: str, i: int, half: int) -> int:
    data = f"{tweak}\x1f{i}\x1f{half}".encode()
    return int.from_bytes(hashlib.blake2b(data, key=key[:64], digest_size=32).digest(), "big")


ROUNDS = 6


def permuted(key: bytes, tweak: str, value: int, size: int, back: bool = False) -> int:
    """A keyed permutation of 0..size-1: a Feistel network over the next even number of bits, walked until inside."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        if back:
            for i in reversed(range(ROUNDS)):
                left, right = right ^ (_round(key, tweak, i, left) & mask), left
        else:
            for i in range(ROUNDS):
                left, right = right, left ^ (_round(key, tweak, i, right) & mask)
        value = left << half | right
        if value < size:
            return value


def displaced(key: bytes, tweak: str, value: int, size: int) -> int:
    """A keyed permutation that moves every value (for size 1 there is none): a shift, seen through another one."""
    if size < 2:
        return value
    shift = 1 + _digest(key, "shift", tweak) % (size - 1)
    return permuted(key, tweak, (permuted(key, tweak, value, size) + shift) % size, size, back=True)


# --- one entity -----------------------------------------------------------------
def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


def _refilled(text: str, digits: str) -> str:
    """`text` with its digits replaced from the left."""
    new = iter(digits)
    return "".join(next(new) if one.isdigit() else one for one in text)


def luhn(digits: str) -> bool:
    total = 0
    for i, one in enumerate(reversed(digits)):
        value = int(one) * (1 + i % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _letters(key: bytes, tweak: str, text: str) -> str:
    """Letters for letters and digits for digits, the rest as it is; capitals where they were."""
    lower = text.lower()
    form = "".join("a" if c.isalpha() else "0" if c.isdigit() else c for c in lower)
    value, size = 0, 1
    for c in lower:
        if c.isalpha():
            value, size = value * 26 + ord(c) - 97, size * 26
        elif c.isdigit():
            value, size = value * 10 + int(c), size * 10
    value = displaced(key, f"{tweak}:{form}", value, size)
    result = []
    for c in reversed(form):
        if c == "a":
            value, one = divmod(value, 26)
            result.append(chr(97 + one))
        elif c == "0":
            value, one = divmod(value, 10)
            result.append(str(one))
        else:
            result.append(c)
    return "".join(new.upper() if old.isupper() else new for new, old in zip(reversed(result), text))


def _email(key: bytes, text: str) -> str:
    """Name and host apart, so that addresses of one host keep a common one; the last label stays."""
    name, _, host = text.rpartition("@")
    labels, _, last = host.rpartition(".")
    return f"{_letters(key, 'mailbox', name)}@{_letters(key, 'host', labels)}.{last}"


def _ip(key: bytes, text: str) -> str:
    value = 0
    for one in text.split("."):
        value = value * 256 + int(one)
    value = displaced(key, "ip", value, 2**32)
    return ".".join(str(value >> shift & 255) for shift in (24, 16, 8, 0))


def _ip6(key: bytes, text: str) -> str:
    """All eight groups: hardly any other address has a run of zeros to leave out."""
    new = str(ipaddress.IPv6Address(displaced(key, "ip6", int(ipaddress.IPv6Address(text)), 2**128)))
    return new.upper() if text.isupper() else new


def _number(key: bytes, kind: str, digits: str) -> str:
    if not digits:
        return digits
    return str(displaced(key, f"{kind}:{len(digits)}", int(digits), 10 ** len(digits))).zfill(len(digits))


def _card(key: bytes, text: str) -> str:
    """The first digit stays, and the last one checks as before."""
    digits = _digits(text)
    body = digits[0] + _number(key, "card", digits[1:-1])
    last = next(one for one in "0123456789" if luhn(body + one))
    return _refilled(text, body + last)


def _phone(key: bytes, text: str) -> str:
    """The last ten digits are the number, whatever is written between them; a country code before them stays."""
    digits = _digits(text)
    return _refilled(text, digits[:-10] + _number(key, "phone", digits[-10:]))


def _ssn(key: bytes, text: str) -> str:
    return _refilled(text, _number(key, "ssn", _digits(text)))


def _iban(key: bytes, text: str) -> str:
    """Country as it is, check digits right for the new account."""
    plain = text.replace(" ", "")
    account = _letters(key, "iban", plain[4:])
    spelled = "".join(str(int(c, 36)) for c in account + plain[:2])
    new = iter(plain[:2] + str(98 - int(spelled + "00") % 97).zfill(2) + account)
    return "".join(c if c == " " else next(new) for c in text)


SURROGATES: dict[str, Callable[[bytes, str], str]] = {
    "email": _email, "ip": _ip, "ip6": _ip6, "card": _card, "phone": _phone, "ssn": _ssn, "iban": _iban,
}


def script_of(word: str) -> str:
    return "greek" if "Ͱ" <= word[0] <= "Ͽ" else "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "latin"


def name_surrogate(key: bytes, part: str, gender: str, canonical: str, attempt: int = 0, syllables: int = SYLLABLES_EACH) -> str:
    """The `attempt`-th draw for a given ('g') or family ('f') name, in lower case."""
    consonants, vowels, endings = SYLLABLES[script_of(canonical)]
    value = _digest(key, "name", part, gender, canonical, str(attempt))
    result = []
    for _ in range(syllables):
        value, one = divmod(value, len(consonants) * len(vowels))
        result.append(consonants[one // len(vowels)] + vowels[one % len(vowels)])
    ends = endings.get(gender, [""]) if part == "g" else [""]
    return "".join(result) + ends[value % len(ends)]


# --- one text -------------------------------------------------------------------
def resolved(uses: set[tuple[str, str]]) -> tuple[str, str]:
    """(part, gender) of a name from all its uses: given if it ever is, of the one gender that its titles tell."""
    told = {gender for _, gender in uses} - {"n"}
    return "g" if any(part == "g" for part, _ in uses) else "f", told.pop() if len(told) == 1 else "n"


def name_parts(text: str) -> dict[str, tuple[str, str]]:
    """{canonical: (part, gender)} of the names that follow a title or a label: the last word is the family's."""
    uses: dict[str, set[tuple[str, str]]] = {}
    for title, found in NAMED.findall(text):
        words = _MENTION.findall(found)
        if len(words) > 2 and found.isupper():
            words = words[:2]
        for i, word in enumerate(words, 1):
            use = ("f", "n") if i == len(words) else ("g", _GENDERS.get(title.casefold(), "n"))
            uses.setdefault(word.casefold(), set()).add(use)
    return {canonical: resolved(some) for canonical, some in uses.items()}


def _mentions(text: str, canonicals: dict) -> Iterator[tuple[int, int, str]]:
    """Places of the names; a common word alone at a sentence's start is none."""
    found = [m for m in _MENTION.finditer(text) if m[0].casefold() in canonicals]
    for i, match in enumerate(found):
        if match[0].casefold() in WORDS_TOO:
            beside = i > 0 and text[found[i - 1].end():match.start()] == " "
            beside |= i + 1 < len(found) and text[match.end():found[i + 1].start()] == " "
            before = text[max(0, match.start() - 40):match.start()].rstrip()
            titled = re.search(rf"(?:^|\W)(?:{_TITLE})\.?$", before) or before.endswith(":")
            if not beside and not titled and (not before or before[-1] in ".!?…\"”»"):
                continue
        yield *match.span(), "name"


def _valid(kind: str, text: str) -> bool:
    if kind == "ip":
        return all(int(one) < 256 and (one == "0" or one[0] != "0") for one in text.split("."))
    if kind == "card":
        digits = _digits(text)
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip6":
        try:
            ipaddress.IPv6Address(text)
        except ValueError:
            return False
        return sum(map(bool, text.split(":"))) > 2 and any(map(str.isdigit, text))
    if kind == "iban":
        plain = text.replace(" ", "")
        return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    return True


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in order, none inside another.  Later words equal to a titled name are that name too."""
    found = [(*m.span(), "email") for m in EMAIL.finditer(text)] if "@" in text else []
    if any(map(text.__contains__, "0123456789")):
        found += [(*m.span(), m.lastgroup) for m in NUMBER.finditer(text) if _valid(m.lastgroup, m[0])]
    if ":" in text:
        found += [(*m.span(), "ip6") for m in IP6.finditer(text) if _valid("ip6", m[0])]
    names = name_parts(text)
    if names:
        found += _mentions(text, names)
    kept, last = [], 0
    for start, end, kind in sorted(found, key=lambda one: (one[0], -one[1])):
        if start >= last:
            kept.append((start, end, kind))
            last = end
    return kept


@lru_cache(maxsize=100_000)
def _replaced(key: bytes, kind: str, entity: str) -> str:
    return SURROGATES[kind](key, entity)


def pseudonymised(
    text: str, key: bytes, told: dict[str, tuple[str, str, int]]
) -> tuple[str, list[tuple[int, int, str, str]]]:
    """The text with surrogates, and (start, end, kind, surrogate) by places in the old text.

    `told` has (part, gender, attempt) of names for which the text alone would say another.
    """
    spans, names, result, at = [], name_parts(text), [], 0
    for start, end, kind in entities(text):
        old = text[start:end]
        if kind == "name":
            canonical = old.casefold()
            part, gender, attempt = told.get(canonical) or (*names[canonical], 0)
            new = name_surrogate(key, part, gender, canonical, attempt)
            new = new.upper() if len(old) > 1 and old.isupper() else new.capitalize()
        else:
            new = _replaced(key, kind, old)
        spans.append((start, end, kind, new))
        result += [text[at:start], new]
        at = end
    return "".join(result) + text[at:], spans


# --- names of the whole table -----------------------------------------------------
def names(df: DataFrame, text: str) -> DataFrame:
    """(text_key, canonical, part, gender) of every different text with names, as the text alone tells."""
    texts = df.select(F.col(f"`{text}`").alias("text")).filter(F.col("text").rlike(HAS_TITLE))

    @F.pandas_udf("array<struct<canonical: string, part: string, gender: string>>")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fields = ("canonical", "part", "gender")
        for some in batches:
            yield pd.Series([[dict(zip(fields, (one, *use))) for one, use in sorted(name_parts(t).items())] for t in some])

    rows = texts.select(text_key(F.col("text")).alias("text_key"), F.explode(each("text")).alias("name"))
    return rows.select("text_key", "name.*").distinct()


def settled(found: DataFrame, key: bytes, syllables: int = SYLLABLES_EACH) -> DataFrame:
    """(canonical, part, gender, attempt) of all names: what all their uses tell, and the draw that counts.

    A draw fails if an earlier settled or smaller name has it, or if it is itself a name that
    occurs.  Only failed names draw again.
    """
    told = F.array_except(F.collect_set("gender"), F.array(F.lit("n")))
    known = found.groupBy("canonical").agg(
        F.max("part").alias("part"), F.when(F.size(told) == 1, told[0]).otherwise("n").alias("gender")  # 'g' is after 'f'
    )
    known = written(known, "pii-names")

    @F.pandas_udf("string")
    def draw(part: pd.Series, gender: pd.Series, canonical: pd.Series, attempt: pd.Series) -> pd.Series:
        drawn = [name_surrogate(key, *one, syllables) for one in zip(part, gender, canonical, attempt)]
        return pd.Series(drawn, dtype=object)

    real = known.select(F.col("canonical").alias("surrogate"), F.lit(True).alias("real"))
    rows = known.withColumn("attempt", F.lit(0))
    while True:
        drawn = rows.withColumn("surrogate", draw("part", "gender", "canonical", "attempt"))
        place = F.row_number().over(Window.partitionBy("surrogate").orderBy("attempt", "canonical"))
        judged = drawn.withColumn("place", place).join(real, "surrogate", "left")
        failed = (F.col("place") > 1) | F.col("real").isNotNull()
        judged = written(judged.select("canonical", "part", "gender", "attempt", failed.alias("failed")), "pii-draws")
        if judged.filter("failed").isEmpty():
            return judged.drop("failed")
        # A failed name draws after all that are settled: its attempt is larger than theirs.
        most = judged.agg(F.max("attempt")).first()[0]
        rows = judged.select("canonical", "part", "gender", F.when(F.col("failed"), most + 1).otherwise(F.col("attempt")).alias("attempt"))


def _told(own) -> dict[str, tuple[str, str, int]]:
    return {name: (one["part"], one["gender"], one["attempt"]) for name, one in dict(own if own is not None else ()).items()}


# --- the operator ---------------------------------------------------------------
def pseudonymise(df: DataFrame, key: bytes, text: str = "text", into: str = "entities") -> DataFrame:
    """`df` with surrogates in `text` and a column `into` of array<struct<start, end, kind, surrogate>>.

    Places are code points of the old text.  A null text stays null with no entities; texts
    without entities do not change; every row stays, also repeated ones.  Different names that
    differ in capitals alone are one.  A column of the caller called like `into` is replaced.
    The key decides all surrogates, in every run alike.
    """
    found = written(names(df, text), "pii-named")
    own = found.withColumnsRenamed({"part": "own_part", "gender": "own_gender"})
    other = (F.col("attempt") > 0) | (F.col("part") != F.col("own_part")) | (F.col("gender") != F.col("own_gender"))
    told = own.join(settled(found, key), "canonical").filter(other).groupBy("text_key").agg(
        F.map_from_entries(F.collect_set(F.struct("canonical", F.struct("part", "gender", "attempt")))).alias("told")
    )
    told = written(told, "pii-told")  # one row for each text with such a name, often none

    @F.pandas_udf("text string, found array<struct<start: int, end: int, kind: string, surrogate: string>>")
    def each(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        fields = ("start", "end", "kind", "surrogate")
        for texts, others in batches:
            rows = []
            for one, own in zip(texts, others):
                new, spans = (None, []) if one is None else pseudonymised(one, key, _told(own))
                rows.append((new, [dict(zip(fields, span)) for span in spans]))
            yield pd.DataFrame(rows, columns=["text", "found"])

    rows = packed(df)
    rows = rows.join(told.withColumnRenamed("text_key", "__text_key"), text_key(field(text)) == F.col("__text_key"), "left")
    rows = rows.select(ROW, each(field(text), F.col("told")).alias("new"))
    kept = [F.col("new.text").alias(text) if name == text else field(name).alias(name) for name in df.columns if name != into]
    return rows.select(*kept, F.col("new.found").alias(into))


def collisions(result: DataFrame, old: Column, into: str = "entities") -> DataFrame:
    """(kind, surrogate, n) of surrogates that stand for more than one entity: none, if all is well.

    `old` is the old text, beside the result's spans.
    """
    each = result.select(old.alias("old"), F.explode(into).alias("one"))
    entity = F.lower(F.expr("substring(old, one.start + 1, one.end - one.start)"))
    pairs = each.select(F.col("one.kind").alias("kind"), F.lower("one.surrogate").alias("surrogate"), entity.alias("entity"))
    return pairs.distinct().groupBy("kind", "surrogate").agg(F.count("*").alias("n")).filter("n > 1")
