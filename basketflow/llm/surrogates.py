"""Personal data replaced by keyed surrogates of the same kind and form.

Each kind of entity is a code of digits or letters in a known form (the digits of a
phone number, the letters of a name).  Its surrogate is the code's image under a
keyed permutation of all codes of that form:

- A permutation maps equal codes to equal surrogates (coreference: the same person,
  phone or address in any format, in any document, at any time) and different codes
  to different ones (distinctness), without a table of the whole corpus.
- It is a keyed shift of a keyed enumeration, so no code is its own surrogate.
- Collision checks walk on where an image would collide with what is set apart: a
  surname that is a first name, a card number that fails its check digit while the
  original passes, a reserved address.  Walking keeps the map one to one, as long as
  the walk starts from a code that is not set apart itself.
- The result keeps type, script, letter case, punctuation, and for first names the
  gender.

Collisions that only the corpus can tell are checked before anything is replaced: a
surrogate that is the code of another entity in the corpus, or of two of them.  The
distinct digests of entities and of their surrogates are joined; an entity that
collides gets the next permutation, until none does.  Names are left out of this
check: their parts come from lists of names that anyone may have.

Finding and replacing are narrow passes over the texts; only distinct digests are
shuffled, so hot texts and hot entities need no care.  The key is a parameter; who
has no key can't go back.
"""

from __future__ import annotations

import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketflow.functions.text import quoted
from basketflow.llm.common import on_plain_names, stored, without_machine

ROUNDS = 10
#: Entities that may need another permutation than the first: tasks hold them all, so
#: more are refused.  Permutations that are tried.
MAX_COLLISIONS, ATTEMPTS = 1_000_000, 20

#: First names by script and gender, titles that a name follows.
FIRST_NAMES = {
    ("latin", "f"): """Alice Anna Carla Clara Claudia Diana Elena Emily Emma Eva Grace Hannah Helen Ida Ines Irene
        Isabel Jane Julia Karen Laura Lena Linda Lisa Lucia Maria Marta Mary Monica Nina Nora Olga Paula Rosa Ruth
        Sara Sofia Susan Vera Victoria""".split(),
    ("latin", "m"): """Adam Albert Alex Andrew Anton Bruno Carl Carlos Daniel David Edgar Emil Eric Felix Frank
        George Henry Hugo Ivan Jack James John Jonas Jose Juan Karl Leo Louis Luis Mark Martin Max Michael Oscar Otto
        Paul Peter Robert Thomas Victor""".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Зоя Ирина Лидия Мария Нина Ольга Софья Тамара Юлия".split(),
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Михаил Олег Павел Роман Юрий".split(),
    ("greek", "f"): "Άννα Ελένη Ειρήνη Ζωή Κατερίνα Μαρία Σοφία Χριστίνα".split(),
    ("greek", "m"): "Ανδρέας Γιάννης Δημήτρης Κώστας Μιχάλης Νίκος Πέτρος Σπύρος".split(),
}
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Señor Señora Sr Sra Monsieur Madame Mme Mlle Господин Госпожа Κύριος Κυρία".split()

#: Letters that stand for each other, by script.
ALPHABETS = [
    "aeiou", "bcdfghjklmnpqrstvwxyz", "äöü", "áéíóú", "àèìòù", "âêîôû", "ñçß",
    "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "ё", "йьъ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ", "άέήίόύώ", "ς",
]
GROUP = {letter: group for group in ALPHABETS for letter in group}
#: Code points of a neighbourhood: other letters stand for those of their kind in theirs.
NEAR = 128
#: Country codes of two digits; 1 and 7 are the only ones of one, the others have three.
COUNTRIES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
    "90 91 92 93 94 95 98".split()
)
#: The country of phone numbers that don't name theirs.
HOME = "1"
HEX = "0123456789abcdef"
DIGITS = "0123456789"

def capital_letters() -> str:
    """A class of all capital letters, as ranges of code points."""
    found, first = [], None
    for point in range(0x10000):
        capital = unicodedata.category(chr(point)) == "Lu"
        if capital and first is None:
            first = point
        elif not capital and first is not None:
            found.append(f"{chr(first)}-{chr(point - 1)}")
            first = None
    return f"[{''.join(found)}]"


CAPITAL = capital_letters()
NAME = CAPITAL + r"(?:[^\W\d_]+|['’]" + CAPITAL + r"[^\W\d_]+)(?:[-'’][^\W\d_]+)*"
LABEL = r"[^\W_](?:[^\W_]|-+(?=[^\W_]))*"
#: What is looked for, in order of preference where two begin at one place.
PATTERNS = [
    ("email", r"(?<![\w.+%-])[\w.+%-]{1,64}@" + LABEL + r"(?:\." + LABEL + ")+"),
    ("access", r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"),
    ("secret", r"(?i:\b(?:api[_-]?key|secret|token|passw(?:or)?d|access[_-]?key)\b[\"']?\s*[:=]\s*[\"']?)(?P<secret>[A-Za-z0-9_/+=.-]{8,})"),
    ("iban", r"\b(?P<iban>[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)\b(?![A-Za-z0-9])"),
    ("card", r"(?<![\w.-])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![\w-])"),
    ("ssn", r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    ("ip", r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![\w]|\.[0-9])"),
    ("ipv6", r"(?<![\w:.])(?:[23][0-9A-Fa-f]{3}|[fF][cdeCDE][0-9A-Fa-f]{2})(?=[0-9A-Fa-f:]*::|(?::[0-9A-Fa-f]{1,4}){7}):[0-9A-Fa-f:]{1,34}(?![\w:])"),
    ("phone", r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?:[ .-][0-9]{2,4})?(?![\w])|(?<![\w.])\+[0-9]{8,15}(?![\w])"),
    ("name", r"\b(?:" + "|".join(TITLES) + r")\b\.?[ ]+(?P<name>" + NAME + r"(?:[ ]" + NAME + r"){0,2})"),
]


NAMES = frozenset(n for names in FIRST_NAMES.values() for n in names)
#: Written in capitals, all of a name is.
LOUD = {n.upper(): n for n in NAMES}
PATTERNS.append(("full", r"\b(?P<full>(?:" + "|".join(sorted(NAMES)) + r")\b(?:[ ]" + NAME + r"){1,2})"))
LOUD_NAME = CAPITAL + "(?:" + CAPITAL + "|['’-](?=" + CAPITAL + "))+"
PATTERNS.append(("loud", r"\b(?P<loud>(?:" + "|".join(sorted(LOUD)) + r")(?:[ ]" + LOUD_NAME + r"\b){1,2})"))
NUMBERS = ("iban", "card", "ssn", "ip", "phone")
HEXADECIMAL = re.compile(r"[0-9a-f]+")
SIXTEEN_BYTES = re.compile(r"[23fF][0-9A-Fa-f]{3}:[0-9A-Fa-f:]*:")
NUMERIC = re.compile(r"[0-9](?:[0-9]|\.[0-9])")
#: Words that begin as a name or a title does: most of a text is none, and passed over fast.
INITIALS = "".join(sorted({word[0] for word in [*NAMES, *TITLES]}))
WORD = re.compile(rf"[{INITIALS}](?<![^\W\d_].)[^\W\d_]*")


@lru_cache(64)
def detector(kinds: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join(f"(?P<{kind}_>{p})" for kind, p in PATTERNS if kind in kinds))


def hints(text: str) -> tuple[str, ...]:
    """The kinds that a text may hold, by cheap tests."""
    kinds = ["email"] if "@" in text else []
    if ":" in text or "=" in text:
        low = text.lower()
        if "token" in low or "secret" in low or "key" in low or "passw" in low:
            kinds.append("secret")
    if NUMERIC.search(text):
        kinds += NUMBERS
    words = set(WORD.findall(text))
    if not words.isdisjoint(TITLES):
        kinds.append("name")
    if not words.isdisjoint(NAMES):
        kinds.append("full")
    if not words.isdisjoint(LOUD):
        kinds.append("loud")
    if SIXTEEN_BYTES.search(text):
        kinds.append("ipv6")
    if "AKIA" in text or "ASIA" in text:
        kinds.append("access")
    return tuple(kinds)


@lru_cache(1 << 16)
def alphabet_of(letter: str) -> str:
    """The letters that stand for one, itself among them; none for what is no letter.

    Those that are not listed have the letters of their kind in their neighbourhood of
    code points: of one script, and apart from those that change when their case does.
    """
    if letter in GROUP:
        return GROUP[letter]

    def kind(c: str) -> tuple[str, bool]:
        return unicodedata.category(c), len(c.upper()) == 1 and c.upper().lower() == c

    own = kind(letter)
    if not own[0].startswith("L"):
        return ""
    first = ord(letter) - ord(letter) % NEAR
    near = map(chr, range(first, first + NEAR))
    return "".join(c for c in near if c == letter or (c not in GROUP and kind(c) == own))


class Permutation:
    """Keyed permutations of the numbers below any size, without fixed points."""

    def __init__(self, key: bytes):
        self.key = key
        self.attempt = 0

    def _round(self, label: str, number: int, bits: int) -> int:
        size = -(-bits // 8)
        message = f"{label}/{number}".encode()
        value = b""
        counter = 0
        while len(value) < size:
            value += hmac.digest(self.key, b"%d/%s" % (counter, message), "sha256")
            counter += 1
        return int.from_bytes(value[:size], "big") & ((1 << bits) - 1)

    def _feistel(self, x: int, half: int, label: str, rounds) -> int:
        mask = (1 << half) - 1
        left, right = x >> half, x & mask
        for r in rounds:
            left, right = right, left ^ self._round(f"{label}/{half}/{r}", right, half)
        return right << half | left

    def _walk(self, x: int, size: int, half: int, label: str, rounds) -> int:
        while True:
            x = self._feistel(x, half, label, rounds)
            if x < size:
                return x

    def image(self, x: int, size: int, label: str) -> int:
        """A number other than ``x`` (if there is one): enumerated, shifted, and back."""
        if size < 2:
            return x
        half = max(1, -(-(size - 1).bit_length() // 2))
        label = f"{self.attempt}/{label}/{size}"
        shift = 1 + self._round(f"{label}/shift", 0, 64) % (size - 1)
        place = (self._walk(x, size, half, label, range(ROUNDS)) + shift) % size
        # The rounds backwards undo themselves, as the halves are swapped at the end.
        return self._walk(place, size, half, label, range(ROUNDS - 1, -1, -1))


def spelled(text: str, alphabets: list[str], permute: Callable[[int, int], int]) -> str:
    """``text``, each letter from its own alphabet, as a number that is permuted."""
    number, size = 0, 1
    for letter, alphabet in zip(text, alphabets, strict=True):
        number = number * len(alphabet) + alphabet.index(letter)
        size *= len(alphabet)
    number = permute(number, size)
    found = []
    for alphabet in reversed(alphabets):
        number, place = divmod(number, len(alphabet))
        found.append(alphabet[place])
    return "".join(reversed(found))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        d = int(digit) * (1 + place % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def recased(text: str, like: str) -> str:
    """Letter by letter in the case of the original."""
    return "".join(t.upper() if o.isupper() and len(t.upper()) == 1 else t for t, o in zip(text, like, strict=True))


class Surrogates:
    def __init__(self, key: bytes, attempts: dict[str, int] | None = None):
        self.key = key
        self.attempts = attempts or {}
        self.permutation = Permutation(key)
        self.known: dict[tuple[str, str], tuple[str, str]] = {}
        self.first = {n.lower(): (kind, i) for kind, names in FIRST_NAMES.items() for i, n in enumerate(names)}

    def _code(self, code: str, alphabets: list[str], label: str, apart: Callable[[str], bool]) -> str:
        """The code's image; walks on until both are set apart, or neither is."""
        own = apart(code)
        # The form is part of the label: each form has a permutation of its own.
        label = f"{label}/{'.'.join(str(ALL.index(a)) if a in KNOWN_ALPHABETS else a[0] for a in alphabets)}"
        found = code
        while True:
            found = spelled(found, alphabets, lambda x, size: self.permutation.image(x, size, label))
            if apart(found) == own:
                return found

    def digits(self, text: str, label: str, apart: Callable[[str], bool] = lambda code: False, keep: int = 0) -> str:
        """The digits of ``text`` after the first ``keep`` replaced, the rest as it is."""
        code = "".join(c for c in text if c in DIGITS)
        head = code[:keep]
        tail = self._code(code[keep:], [DIGITS] * (len(code) - keep), label, lambda t: apart(head + t))
        new = iter(head + tail)
        return "".join(next(new) if c in DIGITS else c for c in text)

    def letters(self, text: str, label: str, apart: Callable[[str], bool] = lambda code: False, among: str = "") -> str:
        """Letters and digits replaced by ones of their kind and script, and only by those in ``among`` if given."""
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        places = [i for i, c in enumerate(low) if c in DIGITS or alphabet_of(c)]
        if not places:
            return text
        alphabets = [DIGITS if low[i] in DIGITS else alphabet_of(low[i]) for i in places]
        if among:
            alphabets = ["".join(c for c in a if c in among) for a in alphabets]
        mask = "".join(c if i not in set(places) else "*" for i, c in enumerate(low)) if len(places) < len(low) else ""
        code = self._code("".join(low[i] for i in places), alphabets, f"{label}/{mask}", apart)
        new = list(low)
        for i, c in zip(places, code, strict=True):
            new[i] = c
        return recased("".join(new), text)

    def email(self, text: str) -> str:
        user, _, domain = text.lower().rpartition("@")
        host, _, top = domain.rpartition(".")
        # The domain's name is replaced by itself, so that colleagues stay colleagues.
        new = f"{self.letters(user, f'user/{domain}')}@{self.letters(host, 'domain')}.{top}"
        return recased(new, text) if len(new) == len(text) else new

    def phone(self, text: str) -> str:
        return self.digits(text, "phone", keep=len(country_of(text)))

    def card(self, text: str) -> str:
        # A number that passes its check digit gets one that passes.
        code = "".join(c for c in text if c in DIGITS)
        passes = luhn(code)
        return self.digits(text, f"card/{passes}", lambda found: luhn(found) != passes, keep=0)

    def ssn(self, text: str) -> str:
        return self.digits(text, "ssn", lambda c: c[:3] in ("000", "666") or c[0] == "9" or c[3:5] == "00" or c[5:] == "0000")

    def ip(self, text: str) -> str:
        number = 0
        for part in text.split("."):
            number = number << 8 | int(part)
        # Within the same kind of address: private networks stay private.
        for start, bits in ((10 << 24, 24), (0xAC100000, 20), (0xC0A80000, 16), (127 << 24, 24)):
            if number >> bits == start >> bits:
                new = start | self.permutation.image(number - start, 1 << bits, f"ip/{start}")
                break
        else:
            new = number
            while True:
                new = self.permutation.image(new, 1 << 32, "ip")
                if not any(new >> b == s >> b for s, b in ((10 << 24, 24), (0xAC100000, 20), (0xC0A80000, 16), (127 << 24, 24))):
                    break
        return ".".join(str(new >> s & 255) for s in (24, 16, 8, 0))

    def ipv6(self, text: str) -> str:
        # The first 16 bits tell what kind of address it is.
        number = int(ipaddress.IPv6Address(text))
        kind, rest = number >> 112, number & ((1 << 112) - 1)
        new = ipaddress.IPv6Address(kind << 112 | self.permutation.image(rest, 1 << 112, f"ipv6/{kind}"))
        shown = new.exploded if len(text) == 39 else str(new)
        return shown.upper() if text.upper() == text else shown

    def access(self, text: str) -> str:
        return text[:4] + self.letters(text[4:], "access")

    def secret(self, text: str) -> str:
        low = text.lower()
        if HEXADECIMAL.fullmatch(low):
            # The same code in any case.
            new = self._code(low, [HEX] * len(low), "hex", lambda code: False)
            return new.upper() if text.isupper() else recased(new, text)
        if HEXADECIMAL.fullmatch(re.sub(r"[\W_]", "", low)):
            # Parted by signs: taken from the codes of its form that are hexadecimal, as a
            # walk over all of them would hardly ever meet one.
            return self.letters(text, "secret", among=HEX)
        return self.letters(text, "secret", lambda code: HEXADECIMAL.fullmatch(code) is not None)

    def iban(self, text: str) -> str:
        code = text.replace(" ", "")
        body = self.letters(code[4:], f"iban/{code[:2]}")
        number = "".join(str(int(c, 36)) for c in body + code[:2] + "00")
        new = iter(code[:2] + f"{98 - int(number) % 97:02d}" + body)
        return "".join(c if c == " " else next(new) for c in text)

    def first_name(self, text: str) -> str:
        kind, place = self.first[text.lower()]
        names = FIRST_NAMES[kind]
        return names[self.permutation.image(place, len(names), f"first/{kind}")]

    def name(self, text: str) -> str:
        """First names by ones of the same script and gender, others letter by letter."""
        parts = []
        for part in text.split(" "):
            if part.lower() in self.first:
                new = self.first_name(part)
                parts.append(new.upper() if part.isupper() and len(part) > 1 else new)
            elif part.isalpha():
                parts.append(self.letters(part, "surname", lambda code: code in self.first))
            else:
                # With a sign in it, no code is a first name: nothing is set apart.
                parts.append(self.letters(part, "surname"))
        return " ".join(parts)

    def digest(self, kind: str, text: str) -> str:
        """A keyed digest that tells entities apart without showing them."""
        return hmac.digest(self.key, f"entity/{kind}/{canonical(kind, text)}".encode(), "sha256").hex()[:32]

    def known_as(self, kind: str, text: str) -> tuple[str, str]:
        """Surrogate and digest of an entity."""
        if len(self.known) > 100_000:
            self.known.clear()
        key = kind, text
        if key not in self.known:
            digest = self.digest(kind, text)
            self.permutation.attempt = self.attempts.get(digest, 0)
            self.known[key] = getattr(self, kind)(text), digest
            self.permutation.attempt = 0
        return self.known[key]

    def of(self, kind: str, text: str) -> str:
        return self.known_as(kind, text)[0]

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int, str]]]:
        """The text with surrogates; kind, place in the original and surrogate of each entity.

        A surname that a name in the text has is replaced where it stands alone as well.
        """
        kinds = hints(text)
        if not kinds:
            return text, []
        spans = []
        for match in detector(kinds).finditer(text):
            kind = match.lastgroup.removesuffix("_")
            inner = kind if kind in ("secret", "iban", "name", "full", "loud") else f"{kind}_"
            start, end = match.span(inner)
            if start < 0:
                continue
            original = text[start:end]
            if kind == "full" and len(set(original.split(" "))) == 1:
                continue  # one word again and again is no name
            if kind == "ipv6" and not is_address(original):
                continue
            spans.append(("name" if kind in ("full", "loud") else kind, start, end))
        spans = self.with_surnames(text, spans)
        parts, found, at = [], [], 0
        for kind, start, end in spans:
            new = self.of(kind, text[start:end])
            parts += [text[at:start], new]
            found.append((kind, start, end, new))
            at = end
        parts.append(text[at:])
        return "".join(parts), found

    def with_surnames(self, text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """The spans and those of their names' surnames elsewhere in the text, in order."""
        names = {part for kind, start, end in spans if kind == "name" for part in text[start:end].split(" ")}
        surnames = {part for part in names if len(part) > 2 and part.lower() not in self.first}
        surnames |= {part.title() for part in surnames if part.isupper()}
        if not surnames:
            return spans
        alone = re.compile(r"(?<![\w'’-])(?:" + "|".join(map(re.escape, sorted(surnames))) + r")(?!\w)")
        found, at = [], 0
        for kind, start, end in [*spans, ("", len(text), len(text))]:
            found += [("name", *match.span()) for match in alone.finditer(text, at, start) if match.end() <= start]
            if kind:
                found.append((kind, start, end))
            at = end
        return found


def is_address(text: str) -> bool:
    try:
        ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return True


def country_of(phone: str) -> str:
    """The digits of the country code that a phone number names, if it does."""
    apart = re.match(r"\+([0-9]{1,3})(?=[ .(-])", phone)
    if apart or not phone.startswith("+"):
        return apart[1] if apart else ""
    digits = phone[1:]
    return digits[: 1 if digits[0] in "17" else 2 if digits[:2] in COUNTRIES else 3]


ALL = [DIGITS, HEX, *ALPHABETS]
KNOWN_ALPHABETS = frozenset(ALL)


def canonical(kind: str, text: str) -> str:
    """What makes two spellings the same entity."""
    if kind == "ipv6":
        return ipaddress.IPv6Address(text).exploded
    if kind == "phone" and not text.startswith("+"):
        text = HOME + text
    if kind in ("phone", "card", "ssn"):
        return "".join(c for c in text if c in DIGITS)
    return unicodedata.normalize("NFC", text).lower().replace(" ", "")


def colliding(docs: DataFrame, key: bytes, attempts: dict[str, int]) -> DataFrame:
    """``entity``: digests of entities whose surrogate is another one's code or surrogate."""
    known = docs.sparkSession.sparkContext.broadcast(attempts)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        without_machine()
        own = Surrogates(key, known.value)
        for batch in batches:
            rows = set()
            for text in batch.column("text").to_pylist():
                for kind, begin, end, new in own.replace(text or "")[1]:
                    if kind != "name":
                        rows.add((own.digest(kind, text[begin:end]), own.digest(kind, new)))
            columns = [pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["entity", "image"])

    texts = docs.select(docs["text"].cast("string").alias("text"))
    pairs = stored(texts.mapInArrow(digests, "entity string, image string").distinct(), "entities")
    real = pairs.select(F.col("entity").alias("image")).distinct()
    another = pairs.join(real, "image", "left_semi").select("entity")
    first = pairs.groupBy("image").agg(F.min("entity").alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = pairs.join(first, "image").where("entity <> first").select("entity")
    return another.union(shared).distinct()


def settled(docs: DataFrame, key: bytes) -> dict[str, int]:
    """Entities that need another permutation than the first, and which."""
    attempts: dict[str, int] = {}
    for attempt in range(1, ATTEMPTS):
        found = colliding(docs, key, attempts).limit(MAX_COLLISIONS + 1).collect()
        if not found:
            return attempts
        attempts |= {row["entity"]: attempt for row in found}
        if len(attempts) > MAX_COLLISIONS:
            raise ValueError(f"more than {MAX_COLLISIONS} collisions")
    raise ValueError(f"collisions after {ATTEMPTS} permutations")


def replaced(docs: DataFrame, key: bytes) -> DataFrame:
    """All columns of ``docs``, ``text`` with surrogates, and ``entities`` at the end.

    ``entities`` lists ``kind, begin, end`` (in code points of the original text),
    ``surrogate``, and ``entity``, a keyed digest of the original that tells
    entities apart without showing them.  Null texts stay null, empty ones empty;
    a column of ``docs`` called ``entities`` (in any case) is replaced.  Texts without an entity
    come back as they were; repeated rows are replaced alike.
    """
    others = docs.select(*(docs[quoted(c)] for c in docs.columns if c.lower() != "entities"))
    return on_plain_names(lambda plain: _replaced(plain, key), others)


def _replaced(docs: DataFrame, key: bytes) -> DataFrame:
    attempts = docs.sparkSession.sparkContext.broadcast(settled(docs, key))
    entity = T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("begin", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("surrogate", T.StringType()),
            T.StructField("entity", T.StringType()),
        ]
    )
    result = T.StructType([T.StructField("text", T.StringType()), T.StructField("entities", T.ArrayType(entity))])

    @F.pandas_udf(result)
    def swap(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Surrogates(key, attempts.value)
        for texts in batches:
            rows = []
            for text in texts:
                if text is None:
                    rows.append((None, []))
                    continue
                new, found = own.replace(text)
                entities = [
                    {"kind": kind, "begin": begin, "end": end, "surrogate": surrogate,
                     "entity": own.known_as(kind, text[begin:end])[1]}
                    for kind, begin, end, surrogate in found
                ]
                rows.append((new, entities))
            yield pd.DataFrame(rows, columns=["text", "entities"])

    found = docs.withColumn("entities", swap(docs["text"].cast("string")))
    return found.select(
        *(F.col("entities.text").alias("text") if c == "text" else c for c in docs.columns),
        F.col("entities.entities").alias("entities"),
    )


def collisions(surrogated: DataFrame) -> DataFrame:
    """``kind, surrogate, n_entities`` of surrogates that stand for several entities.

    Distinct pairs are formed before the shuffle, so a hot entity is a row per task.
    Formats of one entity are told apart only by their surrogates.
    """
    pairs = surrogated.select(F.explode("entities").alias("e")).select("e.kind", "e.surrogate", "e.entity").distinct()
    return pairs.groupBy("kind", "surrogate").agg(F.count("*").alias("n_entities")).where("n_entities > 1")
