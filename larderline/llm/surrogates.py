"""Replace personal data by surrogates of the same kind and format.

Mentions are found by pattern and reduced to what identifies the entity, so that
ways of writing it fall together. An entity's surrogate is drawn from a keyed
hash of it: the same wherever it is mentioned, and not to be undone without the
key. Surrogates that meet another one, or an entity that occurs, are drawn again
until none do; so different entities stay different. A mention takes over the
surrogate in its own format: separators, capitals, length, check digit.

A person name is found by a built-in given name, or by what announces a name: a
title, a label, a phrase. Its parts are then replaced wherever they stand in the
text, in any case, so that a lone mention does not tell the name.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderline.llm.common import broadcast_if_small, equip, store, stored
from larderline.workspace import drop_folder

# Given names by gender and script.
GIVEN_NAMES = {
    ("female", "latin"): (
        "Alice Anna Barbara Carmen Caroline Charlotte Christine Claudia Elena Elisabeth Emma"
        " Helena Isabel Jennifer Jessica Julia Katharina Laura Louise Lucia Margaret Maria"
        " Martina Monika Patricia Petra Sabine Sandra Sarah Sofia Susan Teresa Ursula Valerie"
    ),
    ("male", "latin"): (
        "Alexander Andreas Antonio Carlos Charles Christian Daniel David Fernando Francisco"
        " Georg Hans Henry James Jean Johannes John Joseph Jürgen Klaus Louis Manuel Martin"
        " Michael Miguel Nicolas Pablo Paul Peter Philippe Pierre Richard Robert Stefan Thomas"
        " William Wolfgang"
    ),
    ("female", "cyrillic"): "Анна Елена Екатерина Мария Наталья Ольга Светлана Татьяна",
    ("male", "cyrillic"): "Александр Алексей Андрей Дмитрий Иван Михаил Николай Сергей",
    ("female", "greek"): "Αικατερίνη Βασιλική Γεωργία Ελένη Κωνσταντίνα Μαρία Σοφία",
    ("male", "greek"): "Αθανάσιος Γεώργιος Δημήτριος Ιωάννης Κωνσταντίνος Νικόλαος",
}
# Syllables that family names are made of, by script.
SYLLABLES = {
    "latin": (
        "ba be bo da de do fa fe fi ga ha ka ko la le li lo ma me mi mo na ne ni no"
        " ra re ri ro sa se so ta te to va ve vo"
    ),
    "cyrillic": (
        "ба ва га да за ка ла ма на па ра са та бе ве де ле ме не ре се те бо во го до ко ло"
        " мо но"
    ),
    "greek": "βα γα δα κα λα μα να πα ρα σα τα βε δε κε λε με νε ρε σε τε βο δο κο λο μο νο",
}

# What stands between given and family name, what announces a name,
# and words that are none though a capital may begin them.
PARTICLES = (
    "af al av bin da das de del della den der des di do dos du el ibn la las los ten ter van"
    " vom von zu zur"
)
TITLES = (
    "Mr Mrs Ms Miss Mister Dr Doctor Prof Professor Sir Madam Herr Frau Herrn Monsieur Madame"
    " Mme Mlle Señor Señora Señorita Sr Sra Srta Doña Signor Signora Dear Cher Chère Querido"
    " Querida Estimado Estimada господин госпожа Κύριος Κυρία Κύριε"
)
NAME_LABELS = (
    "name vorname nachname familienname nom prénom nombre apellido apellidos имя фамилия όνομα"
    " επώνυμο author signed contact attn"
)
LABEL_PREFIXES = (
    "full first last middle given family maiden sur customer patient employee contact client"
    " member holder"
)
PHRASES = (
    "my name is|her name is|his name is|mein Name ist|ich heiße|je m'appelle|me llamo"
    "|mi nombre es|меня зовут|με λένε"
)
NO_NAMES = (
    "a an and are as at but by did do for from had has have he her his i in is it its may not"
    " of on or our said she so that the their then there they this to was we were who will with"
    " you your all colleague colleagues customer friend friends sir madam team"
    " auch auf aus bei das dass dem den der die ein eine er es für hat ich im ist mit nicht sie"
    " und von war wir zu"
    " au aux avec ce dans de des elle en est et il ils la le les mais nous ont ou par pas pour"
    " que qui sur un une"
    " con del el ella ellos es fue ha las lo los no para pero por se su una y"
    " и в не на он она с что это а но"
    " και ο η το οι τα του της δεν είναι με να που στο στη"
)

_UPPER = "A-ZÀ-ÖØ-ÞЀ-ЯΆ-Ϋ"
_BLANK = r"[ \t\xa0]{1,3}"
# A word with a capital that a further part of a name may follow.
_NAME_START = re.compile(
    rf"(?<!\w)[{_UPPER}]\w+(?=(?:{_BLANK}|-)(?:[{_UPPER}]|(?:{PARTICLES.replace(' ', '|')})\b))"
)
_NAME_PART = re.compile(
    rf"(?:(?P<initial>[{_UPPER}])(?:\.|(?!['’\w]))"
    rf"|(?P<particle>(?:{PARTICLES.replace(' ', '|')})\b)"
    rf"|(?:[DdOL]['’])?(?P<name>[{_UPPER}]\w+))"
)
_NAME_GAP = re.compile(rf"{_BLANK}|-|(?<=\.)(?=[{_UPPER}])")
_TITLES = f"{TITLES} {TITLES.upper()}".split()
# Cues with signs that are found faster: a text without any has no such cue.
_CUES = [
    (
        _TITLES,
        re.compile(rf"(?<!\w)(?:{'|'.join(_TITLES)})(?:\.?{_BLANK}|\.)(?=[{_UPPER}])"),
    ),
    (PHRASES.lower().split("|"), re.compile(rf"(?<!\w)(?i:{PHRASES}){_BLANK}(?=[{_UPPER}])")),
    (
        NAME_LABELS.split(),
        re.compile(
            rf"(?<!\w)(?:(?i:(?:{LABEL_PREFIXES.replace(' ', '|')})[ _-]?name)"
            rf"|(?<!\w[ -])(?i:{NAME_LABELS.replace(' ', '|')}))"
            rf"[\"']?[ \t]*[:=][ \t]*[\"']?(?=[{_UPPER}])"
        ),
    ),
]
_INITIALS = re.compile(rf"(?:(?<!\w)[{_UPPER}]\.[ \xa0]?){{1,3}}\Z")
_WORD = re.compile(r"[^\W_]+")
# Parts of a name that are looked at.
NAME_PARTS = 8

_NAMES = {group: tuple(names.split()) for group, names in GIVEN_NAMES.items()}
_GROUP = {name: group for group, names in _NAMES.items() for name in names}
_INITIALS_OF = {
    "latin": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "cyrillic": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ",
    "greek": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
}


def _folded(word: str) -> str:
    """A word without case and accents."""
    if word.isascii():
        return word.lower()
    parts = unicodedata.normalize("NFKD", word.casefold())
    return "".join(c for c in parts if not unicodedata.combining(c))


_GIVEN_OF = {_folded(name): name for name in _GROUP}
_PARTICLES = set(PARTICLES.split())
_NO_NAMES = {_folded(word) for word in f"{NO_NAMES} {TITLES}".split()} - _PARTICLES
# Endings of names after the father.
_PATRONYMIC = ("ович", "евич", "ьич", "овна", "евна", "ична")

# Kinds in order: where mentions overlap, the earlier kind and then the earlier
# place has it.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": (
        r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36})(?![A-Za-z0-9])"
        r"|(?i:(?<![a-z])(?:password|passwd|secret|token|api_?key)\s*[=:]\s*[\"']?)"
        r"(?P<value>[A-Za-z0-9+/_.-]*[A-Za-z0-9+/_-])"
    ),
    "iban": (
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?"
        r"(?![A-Za-z0-9])"
    ),
    "card": r"(?<![0-9.-])(?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9])|(?<![0-9.])[0-9]{13,19}(?![0-9])",
    "phone": (
        r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])"
        r"[0-9]{3}[ .-][0-9]{4}(?![0-9])"
        r"|(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){3,4}(?![0-9])"
    ),
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "birth_date": (
        r"(?i:(?<![a-z])(?:born(?: on)?|birth ?da(?:y|te)|date of birth|dob|geboren(?: am)?"
        r"|geburtsdatum|née? le|nacid[oa] el|fecha de nacimiento|date de naissance)\s{0,3}[:=]?\s{0,3})"
        r"(?P<value>[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{2}(?:[0-9]{2})?)(?![0-9])"
    ),
    "ip6": (
        r"(?<![0-9A-Za-z:.])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![0-9A-Za-z:])"
        r"|(?<![0-9A-Za-z:.])(?:[0-9a-fA-F]{1,4}:){1,6}:(?:[0-9a-fA-F]{1,4}:){0,5}[0-9a-fA-F]{1,4}(?![0-9A-Za-z:])"
    ),
    "ip": (
        r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})\.){3}"
        r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})(?![0-9]|\.[0-9])"
    ),
}
_COMPILED = {kind: re.compile(pattern) for kind, pattern in PATTERNS.items()}
_SECRET_SIGNS = ("akia", "gh", "passw", "secret", "token", "api")
_BIRTH_SIGNS = ("born", "birth", "dob", "gebor", "geburt", "né", "nacid", "nacim", "naiss")
_DIGIT = re.compile("[0-9]")
_NUMBER = re.compile("[0-9]+")
_DIGIT_KINDS = {"card", "phone", "national_id"}
_NAME_KINDS = {"given", "family", "initial"}
# Draws of a surrogate before it may grow longer.
SAME_LENGTH_DRAWS = 20


class Mention(NamedTuple):
    first: int
    last: int
    kind: str
    entity: str


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    doubled = [sum(divmod(2 * value, 10)) for value in values[1::2]]
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def entity_of(kind: str, text: str) -> str:
    """What a mention says, whichever way it is written."""
    if kind in _DIGIT_KINDS:
        return "".join(c for c in text if c.isdigit())
    if kind == "email":
        return text.lower()
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "ip":
        return ".".join(str(int(part)) for part in text.split("."))
    if kind == "ip6":
        return text.lower()
    if kind == "birth_date":
        return _date_of(text)
    if kind == "given":
        return _GIVEN_OF[_folded(text)]
    if kind == "family":
        return text[:1].upper() + text[1:].lower()
    return text


def _kinds_worth_a_look(text: str) -> list[str]:
    """The kinds whose patterns can match, by signs that are found quickly."""
    kinds = []
    if "@" in text:
        kinds.append("email")
    lowered = text.lower()
    if any(sign in lowered for sign in _SECRET_SIGNS):
        kinds.append("secret")
    if _DIGIT.search(text):
        kinds += ["iban", "card", "phone", "national_id"]
        if any(sign in lowered for sign in _BIRTH_SIGNS):
            kinds.append("birth_date")
        if "::" in text or text.count(":") >= 7:
            kinds.append("ip6")
        kinds.append("ip")
    return kinds


def _name_at(text: str, at: int, announced: bool) -> list[tuple[int, int, str]]:
    """The parts of the person name that begins there, as places and kinds.

    It ends with the first name that is no built-in given name, or the second if
    it is announced, and with what a hyphen adds to that. Without a cue it needs
    a given name and another one.
    """
    parts: list[tuple[int, int, str]] = []
    unknown, most = 0, 2 if announced else 1
    for _ in range(NAME_PARTS):
        match = _NAME_PART.match(text, at)
        if not match or (match["name"] and _folded(match["name"]) in _NO_NAMES):
            break
        if match["initial"]:
            parts.append((*match.span("initial"), "initial"))
        elif match["name"] and _folded(match["name"]) not in _PARTICLES:
            known = _folded(match["name"]) in _GIVEN_OF
            unknown += not (known or match["name"].lower().endswith(_PATRONYMIC))
            parts.append((*match.span("name"), "given" if known else "family"))
        gap = _NAME_GAP.match(text, match.end())
        if not gap or (unknown >= most and gap[0] != "-"):
            break
        at = gap.end()
    while parts and parts[-1][2] == "initial":
        parts.pop()
    names = [part for part in parts if part[2] != "initial"]
    if len(names) > 1 and parts[-1][2] == "given":
        parts[-1] = (*parts[-1][:2], "family")
    return parts if len(names) > (not announced) else []


def _cues(text: str) -> Iterator[re.Match]:
    lowered = text.lower()
    for signs, pattern in _CUES:
        if any(sign in (text if signs is _TITLES else lowered) for sign in signs):
            yield from pattern.finditer(text)


def _names(text: str) -> list[tuple[int, int, str, str]]:
    """The person names of a text, and wherever one of their parts stands alone."""
    starts = [(match.end(), True) for match in _cues(text)]
    for match in _NAME_START.finditer(text):
        if _folded(match[0]) in _GIVEN_OF:
            starts.append((match.start(), False))
    found, done = [], 0
    for at, announced in sorted(starts):
        if at >= done and (parts := _name_at(text, at, announced)):
            found += parts
            done = parts[-1][1]
    if not found:
        return []
    mentions = [(*part, entity_of(part[2], text[part[0] : part[1]])) for part in found]
    # The first reading of a word holds for the places where it stands alone.
    known = {}
    for first, last, kind, entity in mentions:
        if kind != "initial":
            known.setdefault(_folded(text[first:last]), (kind, entity))
    by_initial = {}
    for word, (_, entity) in known.items():
        by_initial.setdefault(word[0], ("given" if entity in _GROUP else "family", entity))
    taken = {mention[0] for mention in mentions}
    for match in _WORD.finditer(text):
        reading = known.get(_folded(match[0]))
        if reading and match.start() not in taken:
            mentions.append((*match.span(), *reading))
            before = _INITIALS.search(text, max(0, match.start() - 10), match.start())
            for letter in _WORD.finditer(before[0]) if before else ():
                first = before.start() + letter.start()
                if first not in taken:
                    own = by_initial.get(_folded(letter[0]), ("initial", letter[0]))
                    own = ("initial", letter[0]) if own[1] == reading[1] else own
                    mentions.append((first, first + 1, *own))
    return mentions


def _matches(text: str) -> Iterator[tuple[int, int, str, str]]:
    for kind in _kinds_worth_a_look(text):
        for match in _COMPILED[kind].finditer(text):
            group = "value" if match.groupdict().get("value") is not None else 0
            yield (*match.span(group), kind, entity_of(kind, match[group]))
    yield from _names(text)


def mentions_of(text: str | None) -> list[Mention]:
    """The mentions of a text in order, none overlapping another."""
    text = text or ""
    taken: list[Mention] = []
    for first, last, kind, entity in _matches(text):
        at = bisect.bisect_left(taken, (first,))
        free = at == 0 or taken[at - 1].last <= first
        if free and (at == len(taken) or last <= taken[at].first):
            taken.insert(at, Mention(first, last, kind, entity))
    return taken


class _Draws:
    """Numbers from a keyed hash of the entity, as many as are asked for."""

    def __init__(self, key: bytes, *seed: object):
        self.key, self.seed, self.block = key, repr(seed).encode("utf-8", "surrogatepass"), 0
        self.bytes = iter(b"")

    def below(self, limit: int) -> int:
        value = 0
        for _ in range(4):
            byte = next(self.bytes, None)
            if byte is None:
                text = self.seed + self.block.to_bytes(8, "big")
                self.bytes = iter(hashlib.blake2b(text, key=self.key).digest())
                self.block += 1
                byte = next(self.bytes)
            value = value << 8 | byte
        return value % limit


def _shaped(text: str, draws: _Draws) -> str:
    """Letters for letters and digits for digits; what is hexadecimal, with both
    of them, stays so."""
    is_hex = bool(re.fullmatch("(?=.*[0-9])(?=.*[a-f])[0-9a-f]{8,}", text))

    def one(c: str) -> str:
        if is_hex:
            return "0123456789abcdef"[draws.below(16)]
        if c.isdigit():
            return str(draws.below(10))
        if c.isalpha():
            return chr(ord("A" if c.isupper() else "a") + draws.below(26))
        return c

    return "".join(map(one, text))


def _digits(kind: str, entity: str, draws: _Draws) -> str:
    """As many digits. A card keeps its first digit and whether its check digit
    is right; a phone number what precedes the last ten digits, and its area and
    exchange do not begin with 0 or 1."""
    drawn = [str(draws.below(10)) for _ in entity]
    if kind == "card":
        drawn[0] = entity[0]
        for last in "0123456789":
            drawn[-1] = last
            if _luhn("".join(drawn)) == _luhn(entity):
                break
    if kind == "phone" and len(entity) >= 10:
        drawn[:-10] = entity[:-10]
        drawn[-10], drawn[-7] = (str(2 + draws.below(8)) for _ in range(2))
    return "".join(drawn)


def _shaped_hex(part: str, draws: _Draws) -> str:
    """A group of an address: as many digits, and none where none were."""
    if not part:
        return part
    first = "123456789abcdef"[draws.below(15)]
    return first + "".join("0123456789abcdef"[draws.below(16)] for _ in part[1:])


def _date(draws: _Draws) -> str:
    """A day of this or the last century, as year, month and day."""
    year, month, day = 1930 + draws.below(80), 1 + draws.below(12), 1 + draws.below(28)
    return f"{year}-{month:02}-{day:02}"


def _date_of(text: str) -> str:
    """Year, month and day of a written date; of two numbers in front the first is
    the day unless it can be none."""
    first, second, third = (int(part) for part in _NUMBER.findall(text))
    if first > 99:
        year, month, day = first, second, third
    else:
        day, month, year = (first, second, third) if second <= 12 else (second, first, third)
        year += 1900 if year < 100 else 0
    return f"{year:04}-{month:02}-{day:02}"


def _written_date(mention: str, date: str) -> str:
    """A date in the order, with the signs and the lengths of the mention."""
    year, month, day = date.split("-")
    numbers = _NUMBER.findall(mention)
    if len(numbers[0]) > 2:
        new = [year, month, day]
    else:
        new = [day, month, year] if int(numbers[1]) <= 12 else [month, day, year]
    fitted = iter(n[-len(old) :] if len(old) > 1 else n.lstrip("0") for n, old in zip(new, numbers, strict=True))
    return _NUMBER.sub(lambda match: next(fitted), mention)


def _script(text: str) -> str:
    if "Ѐ" <= text[:1] <= "ӿ":
        return "cyrillic"
    return "greek" if "Ͱ" <= text[:1] <= "Ͽ" else "latin"


def _next_in_ring(names: Sequence[str], group: object, entity: str, key: bytes) -> str:
    """Another one of the names: shuffled by key, they form a ring, and each is
    replaced by the one after it."""

    def place(name: str) -> bytes:
        return hashlib.blake2b(repr((group, name)).encode(), key=key).digest()

    ring = sorted(names, key=place)
    return ring[(ring.index(entity) + 1) % len(ring)]


def _given(entity: str, key: bytes, attempt: int) -> str:
    """Another name of the same gender and script."""
    group = _GROUP[entity]
    return _next_in_ring(_NAMES[group], group, entity, key)


def _initial(entity: str, key: bytes, attempt: int) -> str:
    script = _script(entity)
    letter = _folded(entity)[:1].upper()
    letters = _INITIALS_OF[script]
    if letter not in letters:
        return letters[_Draws(key, "initial", entity).below(len(letters))]
    return _next_in_ring(letters, ("initial", script), letter, key)


def _family(entity: str, key: bytes, attempt: int) -> str:
    draws = _Draws(key, "family", entity, attempt)
    syllables = SYLLABLES[_script(entity)].split()
    count = max(2, min(6, len(entity) // 2)) + attempt // SAME_LENGTH_DRAWS
    return "".join(syllables[draws.below(len(syllables))] for _ in range(count)).capitalize()


def surrogate_of(kind: str, entity: str, key: bytes, attempt: int = 0) -> str:
    """The surrogate of an entity at the given draw."""
    if kind == "given":
        return _given(entity, key, attempt)
    if kind == "family":
        return _family(entity, key, attempt)
    if kind == "initial":
        return _initial(entity, key, attempt)
    draws = _Draws(key, kind, entity, attempt)
    # Where all of a length are taken, more draws reach further.
    longer = attempt // SAME_LENGTH_DRAWS
    if kind in _DIGIT_KINDS:
        return _digits(kind, entity, draws)
    if kind == "ip":
        parts = [1 + draws.below(223), *(draws.below(256) for _ in range(3))]
        return ".".join(map(str, parts))
    if kind == "email":
        local, _, domain = entity.partition("@")
        host, dot, top = domain.rpartition(".")
        # Addresses of a domain stay together.
        moved = _shaped(host, _Draws(key, "domain", host))
        return _shaped(local + "x" * longer, draws) + "@" + moved + dot + top
    if kind == "iban":
        return entity[:2] + _shaped(entity[2:], draws)
    if kind == "ip6":
        return ":".join(_shaped_hex(part, draws) for part in entity.split(":"))
    if kind == "birth_date":
        return _date(draws)
    prefix = re.match("AKIA|gh[pousr]_|", entity)[0]
    shape = entity[len(prefix) :]
    if not any(c.isalnum() for c in shape):
        # Signs alone would stay as they are.
        shape = "x" * max(len(shape), 8)
    return prefix + _shaped(shape + "x" * longer, draws)


def written_like(kind: str, mention: str, surrogate: str) -> str:
    """The surrogate in the format of the mention."""
    if kind in _DIGIT_KINDS or kind == "iban":
        rest = iter(surrogate)
        return "".join(next(rest, c) if c.isalnum() else c for c in mention)
    if kind == "email" and len(mention) == len(surrogate):
        pairs = zip(mention, surrogate, strict=True)
        return "".join(new.upper() if old.isupper() else new for old, new in pairs)
    if kind == "ip6":
        return surrogate.upper() if mention.isupper() else surrogate
    if kind == "birth_date":
        return _written_date(mention, surrogate)
    if kind in _NAME_KINDS:
        shown = surrogate[:1] if len(mention) == 1 else surrogate
        if mention.islower():
            return shown.lower()
        return shown.upper() if mention.isupper() else shown
    return surrogate


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, found = [], []
        for row, text in enumerate(batch.column("text")):
            for mention in mentions_of(text.as_py()):
                rows.append(row)
                found.append(mention)
        taken = batch.select(["id", "row"]).take(pa.array(rows, pa.int64()))
        columns = list(zip(*found, strict=True)) or [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        arrays = [pa.array(list(values), kind) for values, kind in zip(columns, kinds, strict=True)]
        yield pa.record_batch([*taken.columns, *arrays], names=["id", "row", *Mention._fields])


def _mapped(function: Callable[..., str | None], *columns) -> Column:
    """A column of texts that a function gives for each row."""

    def of(*series):
        return pd.Series([function(*values) for values in zip(*series, strict=True)], dtype=object)

    return F.pandas_udf(of, T.StringType())(*columns)


def distinct_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind``, ``entity`` and a ``surrogate`` that no other entity of the kind
    has, and that is no entity of it either.

    A round draws for the entities that are still open. Those settle whose draw
    is no entity, no settled surrogate, and of equal draws that of the first
    entity; the others go on. Only what is open is written again, so all rounds
    together cost little more than the first. Given names and initials are
    shuffled among themselves, so they do not collide and may be one another's.
    """
    drawn = _mapped(
        lambda kind, entity, attempt: surrogate_of(kind, entity, key, int(attempt)),
        "kind",
        "entity",
        "attempt",
    )
    equip(entities.sparkSession)
    everything = stored(entities.select("kind", "entity").distinct(), "entities")
    shuffled = F.col("kind").isin("given", "initial")
    taken = everything.select("kind", F.col("entity").alias("surrogate")).filter(~shuffled)
    still_open, settled, attempt = everything, [], 0
    while True:
        # Few surrogates are equal, so a group is a handful of rows.
        alike = Window.partitionBy("kind", "surrogate").orderBy("entity")
        numbered = still_open.withColumn("attempt", F.lit(attempt))
        state, path = store(numbered.withColumn("surrogate", drawn).drop("attempt"), "drawn")
        first = state.withColumn("later", (F.row_number().over(alike) > 1) & ~shuffled)
        open_now = broadcast_if_small(state.select("kind", "surrogate"))
        met = [
            other.join(open_now, ["kind", "surrogate"], "left_semi")
            for other in (taken, *[part.select("kind", "surrogate") for part in settled])
        ]
        known = functools.reduce(DataFrame.union, met).distinct().withColumn("known", F.lit(True))
        judged = first.join(known, ["kind", "surrogate"], "left")
        again = (F.col("later") | F.col("known").isNotNull()) & ~shuffled
        marked = stored(judged.select("kind", "entity", "surrogate", again.alias("again")), "judged")
        drop_folder(entities.sparkSession, path)
        settled.append(marked.filter("NOT again").drop("again"))
        still_open = marked.filter("again").select("kind", "entity")
        if still_open.isEmpty():
            return functools.reduce(DataFrame.union, settled)
        attempt += 1


def _rewritten(text: str | None, mentions) -> str | None:
    if text is None or mentions is None or not len(mentions):
        return text
    parts, done = [], 0
    for mention in sorted(mentions, key=lambda m: m["first"]):
        first, last = mention["first"], mention["last"]
        written = written_like(mention["kind"], text[first:last], mention["surrogate"])
        parts += [text[done:first], written]
        done = last
    return "".join([*parts, text[done:]])


def replace_entities(
    docs: DataFrame, key: bytes, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Each row as the struct ``document``, its ``text`` with surrogates, and the
    ``mentions`` replaced: place, kind, entity and surrogate.

    NULL stays NULL. Texts without mentions, also empty ones, stay as they are.
    Rows equal in id and text are rewritten alike. An empty table gives no rows.

    Mentions meet surrogates by entity, in a join that is broadcast if the counted
    surrogates allow it, and whose heavy keys AQE splits if not. A text's mentions
    are then brought to it by a hash of id and text.
    """
    equip(docs.sparkSession)
    keyed = docs.select(
        F.struct(*docs.columns).alias("document"),
        F.col(id_column).alias("id"),
        F.xxhash64(id_column, text_column).alias("row"),
    )
    # The text is carried once, within the document.
    text = F.col("document")[text_column]
    schema = T.StructType(
        [keyed.schema["id"], keyed.schema["row"]]
        + [T.StructField(name, T.LongType()) for name in ("first", "last")]
        + [T.StructField(name, T.StringType()) for name in ("kind", "entity")]
    )
    texts = keyed.select("id", "row", text.alias("text"))
    mentions = stored(texts.mapInArrow(_find, schema), "mentions")
    mapping = broadcast_if_small(stored(distinct_surrogates(mentions, key), "mapping"))
    one = F.struct("first", "last", "kind", "entity", "surrogate")
    by_row = (
        mentions.join(mapping, ["kind", "entity"])
        .groupBy(F.col("id").alias("_id"), F.col("row").alias("_row"))
        .agg(F.collect_set(one).alias("mentions"))
    )
    same = (F.col("row") == F.col("_row")) & F.col("id").eqNullSafe(F.col("_id"))
    met = keyed.join(by_row, same, "left")
    return met.select("document", _mapped(_rewritten, text, "mentions").alias("text"), "mentions")
