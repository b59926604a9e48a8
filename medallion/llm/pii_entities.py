"""Finding personal data in text and writing surrogates in its place."""

from __future__ import annotations

import hmac
import ipaddress
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

# Forms of address by language, with the gender they tell.
TITLES = {
    "Mr": "m", "Mister": "m", "Sir": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Lady": "f",
    "Herr": "m", "Herrn": "m", "Frau": "f", "Monsieur": "m", "M": "m", "Madame": "f", "Mme": "f",
    "Mademoiselle": "f", "Mlle": "f", "Señor": "m", "Sr": "m", "Don": "m", "Señora": "f", "Sra": "f",
    "Doña": "f", "Señorita": "f", "Srta": "f", "Господин": "m", "Г-н": "m", "Госпожа": "f", "Г-жа": "f",
    "Κύριος": "m", "Κυρία": "f", "Dr": "n", "Prof": "n", "Professor": "n",
}
NAME = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
# A one-letter title needs its dot; other titles may have one.
TITLE_WORDS = "|".join(sorted((t for t in TITLES if len(t) > 1), key=len, reverse=True))
CUES = [t if len(t) > 1 else f"{t}. " for t in TITLES]
PERSON = re.compile(rf"(?<!\w)(?:(?P<title>{TITLE_WORDS})\.?|(?P<short>M)\.)[  ](?P<name>{NAME}(?:[  ]{NAME}){{0,2}})")
EMAIL = re.compile(r"(?<![\w.+-])[\w+-]+(?:\.[\w+-]+)*@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
IPV4 = re.compile(r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w)")
CARD = re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w]|[.-]\d)")
SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")
PHONE = re.compile(
    r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w]|[.-]\d)"
)
SECRET = re.compile(
    r"(?<![\w/+])(?:(?=[A-Fa-f]*\d)(?:[0-9a-f]{32,}|[0-9A-F]{32,})|(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_\w{36,}|sk[-_]\w{20,})(?![\w/+=])"
)
HEX = re.compile(r"[0-9a-fA-F]+")
SECRET_PREFIX = re.compile(r"AKIA|ASIA|gh[pousr]_|sk[-_]|")
DIGIT = re.compile(r"\d")

LOOPBACK, PRIVATE = ipaddress.IPv4Network("127.0.0.0/8"), ipaddress.IPv4Network("10.0.0.0/8")

# Tries after which addresses and domains grow longer.
LENGTHENED = 8
# The lower-case letters of alphabets, from the first to the last.
ALPHABETS = (("a", "z"), ("а", "я"), ("α", "ω"))

# Syllables of made-up names, by script, and how given names end by gender.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha jo ka ke ko la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se so ta te ti to va ve vi wa ze".split(),
    "cyrillic": "ба бо ва ве ви га го да де до жа за зо ка ко ла ле ли ло ма ми мо на не ни но па по ра ре ри ро са се со та те ти то фа".split(),
    "greek": "βα γα δα δο ζα θα θε κα κο λα λε λι λο μα με μι μο να νε νι νο πα πε ρα ρε ρι ρο σα σο τα τε τι το φα φι".split(),
}
ENDINGS = {
    "latin": {"f": ["na", "lia", "ra"], "m": ["rick", "lan", "tor"], "n": ["rin", "len"]},
    "cyrillic": {"f": ["на", "лия", "ра"], "m": ["слав", "мир", "тор"], "n": ["рин", "лен"]},
    "greek": {"f": ["να", "λία", "ρα"], "m": ["νος", "ρης", "τος"], "n": ["ριν", "λεν"]},
}
FAMILY = {"latin": ["son", "ner", "rel", "mont"], "cyrillic": ["ков", "ский", "нец"], "greek": ["ίδης", "άκης", "πουλος"]}


@dataclass(frozen=True)
class Mention:
    """A place in a text that names an entity: its kind and its value in normal form."""

    start: int
    end: int
    kind: str
    value: str


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(reversed(digits)):
        double = int(digit) * (1 + i % 2)
        total += double - 9 if double > 9 else double
    return total % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit() and c.isascii())


def _script(word: str) -> str:
    first = ord(word[0])
    return "cyrillic" if 0x400 <= first < 0x530 else "greek" if 0x370 <= first < 0x400 else "latin"


def _address(text: str) -> bool:
    try:
        return bool(ipaddress.IPv4Address(text))
    except ValueError:
        return False


# Kind, pattern, normal form, and whether a match counts. Earlier kinds win where they overlap.
Found = tuple[str, re.Pattern, Callable[[str], str], Callable[[str], bool]]
WITH_DIGITS: list[Found] = [
    ("secret", SECRET, lambda v: v.lower() if HEX.fullmatch(v) else v, lambda v: True),
    ("iban", IBAN, lambda v: v.replace(" ", ""), lambda v: _mod97(v) == 1),
    ("card", CARD, _digits, luhn),
    ("ip", IPV4, str, _address),
    ("ssn", SSN, _digits, lambda v: v[:3] not in ("000", "666") and v[0] != "9"),
    ("phone", PHONE, _digits, lambda v: 8 <= len(v) <= 15),
]


def find(text: str) -> list[Mention]:
    """The mentions in a text, in order, without overlaps."""
    found: list[Mention] = []
    if "@" in text:
        found += _matches("email", EMAIL, str.lower, lambda v: True, text)
    if DIGIT.search(text):
        for kind in WITH_DIGITS:
            found += _matches(*kind, text)
    if any(title in text for title in CUES):
        found += _names(text)
    kept: list[Mention] = []
    taken: list[tuple[int, int]] = []
    for mention in found:
        if all(mention.end <= a or mention.start >= b for a, b in taken):
            kept.append(mention)
            taken.append((mention.start, mention.end))
    return sorted(kept, key=lambda m: m.start)


def _matches(kind, pattern, normal, counts, text: str) -> Iterator[Mention]:
    for match in pattern.finditer(text):
        value = normal(match[0])
        if counts(value):
            yield Mention(match.start(), match.end(), kind, value)


def _names(text: str) -> Iterator[Mention]:
    """Capitalised words after a form of address: the last one is the family name, those before
    it given names; and the same names wherever else they stand in the text, in any case.

    A person is the first given name with the family name. Whoever has a neutral title takes the
    gender that the same person's other titles tell; initials are not looked up again."""
    people: list[tuple[str, list[tuple[int, str]]]] = []
    genders: dict[tuple[str, str], str] = {}
    for match in PERSON.finditer(text):
        gender = TITLES[match["title"] or match["short"]]
        words = []
        for word in re.finditer(NAME, match["name"]):
            if not word[0][0].isupper():
                break
            words.append((match.start("name") + word.start(), word[0]))
        if words:
            people.append((gender, words))
            if gender != "n":
                genders.setdefault((words[0][1].lower(), words[-1][1].lower()), gender)
    places: dict[int, Mention] = {}
    families: dict[str, str] = {}
    given: dict[str, str] = {}
    for gender, words in people:
        if gender == "n":
            gender = genders.get((words[0][1].lower(), words[-1][1].lower()), "n")
        for i, (start, word) in enumerate(words):
            kind = "family" if i == len(words) - 1 else f"given_{gender}"
            places[start] = Mention(start, start + len(word), kind, f"{_script(word)}:{word.lower()}")
            known = families if kind == "family" else given
            if known.get(word.lower(), "given_n") == "given_n":
                known[word.lower()] = kind
    kinds = given | families
    again = sorted((re.escape(word) for word in kinds if len(word) > 1), key=len, reverse=True)
    if again:
        for match in re.finditer(rf"(?<!\w)(?:{'|'.join(again)})(?!\w)", text, re.IGNORECASE):
            start, word = match.start(), match[0].lower()
            if word in kinds:
                places.setdefault(start, Mention(start, match.end(), kinds[word], f"{_script(word)}:{word}"))
    yield from places.values()


# Surrogates


class Stream:
    """Numbers drawn from a key, an entity and a number of tries: the same ones each time."""

    def __init__(self, key: bytes, kind: str, value: str, tries: int):
        self.seed = hmac.new(key, f"{kind}\0{value}\0{tries}".encode("utf-8", "surrogatepass"), sha256).digest()
        self.block, self.bits, self.left = 0, 0, 0

    def below(self, limit: int) -> int:
        if self.left < 64:
            more = sha256(self.seed + self.block.to_bytes(4, "big")).digest()
            self.bits, self.left, self.block = int.from_bytes(more, "big"), 256, self.block + 1
        drawn, self.bits, self.left = self.bits & ((1 << 48) - 1), self.bits >> 48, self.left - 48
        return drawn % limit

    def choice(self, options):
        return options[self.below(len(options))]

    def digits(self, like: str) -> str:
        """Digits in place of digits; what doesn't begin with zero still doesn't."""
        first = "" if not like else "0" if like[0] == "0" else str(1 + self.below(9))
        return first + "".join(str(self.below(10)) for _ in like[1:])


def surrogate(key: bytes, kind: str, value: str, tries: int = 0) -> str:
    """The replacement of an entity, of its kind and in normal form."""
    draw = Stream(key, kind, value, tries)
    if kind == "email":
        # Its domain is an entity of its own, so that addresses at one domain stay together.
        local, _, domain = value.partition("@")
        return f"{_alike(draw, local)}{_longer(draw, tries)}@{domain}"
    if kind == "domain":
        names, _, top = value.rpartition(".")
        return f"{_alike(draw, names)}{_longer(draw, tries)}.{top}"
    if kind == "secret":
        if HEX.fullmatch(value):
            return "".join(draw.choice("0123456789abcdef") for _ in value)
        prefix = SECRET_PREFIX.match(value)[0]
        return prefix + _alike(draw, value[len(prefix) :])
    if kind == "card":
        body = value[0] + draw.digits("1" + value[2:-1])
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    if kind == "iban":
        body = value[:2] + "00" + "".join(str(draw.below(10)) if c.isdigit() else chr(65 + draw.below(26)) for c in value[4:])
        return f"{body[:2]}{98 - _mod97(body):02d}{body[4:]}"
    if kind == "ip":
        return _alike_address(draw, value)
    if kind == "ssn":
        return f"{1 + draw.below(665):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "phone":
        return value[0] + draw.digits("1" + value[2:])
    script, _, word = value.partition(":")
    count = max(1, min(3, len(word) // 3)) + min(tries, 4)
    stem = "".join(draw.choice(SYLLABLES[script]) for _ in range(count))
    endings = FAMILY[script] if kind == "family" else ENDINGS[script][kind[-1]]
    return f"{script}:{stem}{draw.choice(endings)}"


@cache
def _letters_like(char: str) -> str:
    """The lower-case letters among which one is drawn in place of that one: those of its
    alphabet, or of its 128 code points where no alphabet is known."""
    for first, last in ALPHABETS:
        if first <= char <= last:
            return "".join(map(chr, range(ord(first), ord(last) + 1)))
    start = ord(char) & ~127
    near = [c for c in map(chr, range(start, start + 128)) if c.isalpha() and c.lower() == c]
    return "".join(c for c in near if c.upper() == c or len(c.upper()) == 1) or char


def _letter(draw: Stream, char: str) -> str:
    """A letter of the same script and case, a digit for a digit, a mark as it is."""
    if char.isalpha():
        low = char.lower()
        if len(low) > 1:
            return char
        drawn = draw.choice(_letters_like(low))
        return drawn.upper() if char.isupper() else drawn
    return str(draw.below(10)) if char.isdigit() else char


def _longer(draw: Stream, tries: int) -> str:
    """Letters added where names as long as the real ones are all taken."""
    return "".join(chr(97 + draw.below(26)) for _ in range(min(4, max(0, tries - LENGTHENED))))


def _alike(draw: Stream, text: str) -> str:
    return "".join(_letter(draw, c) for c in text)


def _alike_address(draw: Stream, value: str) -> str:
    """A private address stays private, one of the own machine there, a public one public."""
    address = ipaddress.IPv4Address(value)
    if address.is_loopback:
        return str(LOOPBACK[1 + draw.below(LOOPBACK.num_addresses - 2)])
    if not address.is_global:
        return str(PRIVATE[1 + draw.below(PRIVATE.num_addresses - 2)])
    while True:
        found = ipaddress.IPv4Address(draw.below(1 << 32))
        if found.is_global and not found.is_multicast:
            return str(found)


def written_like(found: str, kind: str, replacement: str) -> str:
    """The replacement in the format of the mention: its marks between digits, its case."""
    if kind in ("card", "ssn", "phone"):
        digits = iter(replacement)
        return "".join(next(digits) if c.isdigit() and c.isascii() else c for c in found)
    if kind == "iban":
        chars = iter(replacement)
        return "".join(" " if c == " " else next(chars) for c in found)
    if kind == "family" or kind.startswith("given"):
        name = replacement.partition(":")[2]
        return name.upper() if len(found) > 1 and found.isupper() else name.capitalize() if found[0].isupper() else name
    if kind == "email" and not found.islower():
        shown = [n.upper() if o.isupper() else n for o, n in zip(found, replacement)]
        return "".join(shown) + replacement[len(found) :]
    return replacement.upper() if found.isupper() else replacement


def entities_of(mention: Mention) -> list[tuple[str, str]]:
    """Kind and value of the entities that a mention names: an address has two."""
    own = (mention.kind, mention.value)
    return [own, ("domain", mention.value.partition("@")[2])] if mention.kind == "email" else [own]


def replacement_of(key: bytes, mention: Mention, tries: dict[tuple[str, str], int]) -> str:
    """What stands for a mention, given the tries of entities that had to draw again."""
    drawn = [surrogate(key, *entity, tries.get(entity, 0)) for entity in entities_of(mention)]
    return f"{drawn[0].partition('@')[0]}@{drawn[1]}" if len(drawn) > 1 else drawn[0]
