"""Personal data and secrets replaced by keyed surrogates of the same kind and form."""

from __future__ import annotations

import hashlib
import ipaddress
import re
import secrets
import unicodedata
from bisect import bisect_right
from functools import lru_cache
from math import prod

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from shelfpair.llm.common import plus, set_aside, slices, without
from shelfpair.session import stored

#: Setting of the session that holds the secret key of surrogates.
KEY_SETTING = "spark.shelfpair.surrogate.key"

#: Given names by script and gender; a listed name is replaced by another of its list.
NAMES = {
    ("latin", "f"): "Alice Anna Barbara Camille Carmen Charlotte Claire Clara Elena Emma Greta Hannah Ingrid Isabel Julia Laura Lucia Maria Marta Sofia".split(),
    ("latin", "m"): "Albert Antonio Bruno Carlos Daniel David Felix Henri James John Karl Lucas Luis Marco Martin Otto Pablo Paul Peter Thomas".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Наталья Ольга Светлана Татьяна".split(),
    ("cyrillic", "m"): "Алексей Борис Владимир Дмитрий Иван Михаил Николай Олег Павел Сергей".split(),
    ("greek", "f"): "Άννα Δήμητρα Ελένη Ειρήνη Κατερίνα Μαρία Σοφία".split(),
    ("greek", "m"): "Αλέξανδρος Γιώργος Δημήτρης Κώστας Νίκος Παύλος Πέτρος".split(),
}
#: Titles that announce a name and tell its gender, or not.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "Г-жа", "Κυρία"],
    "m": ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Г-н", "Κύριος"],
    "": ["Dr", "Prof", "Professor", "Doctor", "Mx"],
}
GENDER = {title: gender for gender, titles in TITLES.items() for title in titles}

#: A word of a name, without the ending of a possessive, and small words between such words.
CAPITALISED = r"[^\W\d_a-zà-öø-ÿа-яё](?=\w|['’](?!s(?!\w))\w)\w*(?:['’-](?!s(?!\w))\w+)*"
PARTICLE = r"(?:(?:de|del|la|las|los|van|von|der|den|da|di|du|le|y)[ \u00a0])*"
KINDS = {
    "email": r"(?<![\w.%+-])[\w.%+-]+@[\w-]+(?:\.[\w-]+)+",
    "key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?!-----BEGIN ).)*?-----END [A-Z ]*PRIVATE KEY-----",
    "secret": r"(?i:\b(?:token|api[_-]?key|secret|password|passwd|pwd|access[_-]?key|auth)\b\s*[=:]\s*)[\"']?(?P<value>[^\s\"']{6,})",
    "hex": r"(?<!\w)(?=[0-9a-fA-F]*[0-9])(?=[0-9a-fA-F]*[a-fA-F])[0-9a-fA-F]{32,}(?!\w)",
    "apikey": r"(?<!\w)(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|xox[a-z]-[A-Za-z0-9-]{10,})(?!\w)",
    "iban": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "ipv6": r"(?<![\w:])(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,6})?::(?:[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){0,6})?)(?![\w:])",
    "ipv4": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)",
    "phone": r"(?<!\w)\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)|(?<!\w)\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\w)|(?<![\w-])\d{3}-\d{3}-\d{4}(?![\w-])|(?<![\w.-])0\d{2,4}[ /]\d{5,8}(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "name": r"(?<!\w)(?P<title>" + "|".join(sorted(map(re.escape, GENDER), key=len, reverse=True)) + r")\.?[ \u00a0](?P<who>" + CAPITALISED + r"(?:[ \u00a0]" + PARTICLE + CAPITALISED + r")*)",
}
FIND = re.compile("|".join(f"(?P<{kind}>{pattern})" for kind, pattern in KINDS.items()), re.DOTALL)
DIGITS = re.compile(r"[@\d]").search
TITLED = re.compile(r"(?:" + "|".join(map(re.escape, GENDER)) + r")\.?[ \u00a0]").search
ASSIGNED = re.compile(r"(?i:token|key|secret|pass|pwd|auth)\w*\s*[=:]").search

KEYED = re.compile(KINDS["apikey"]).search
#: Addresses without a digit.
COLONS = re.compile(KINDS["ipv6"]).search


def hinted(text: str) -> bool:
    """False for most texts that have nothing to find, at little cost; true for every text in which FIND finds something."""
    return bool(
        DIGITS(text)
        or TITLED(text)
        or "-----BEGIN" in text
        or ("=" in text or ":" in text) and ASSIGNED(text)
        or ("sk-" in text or "_" in text or "xox" in text or "AKIA" in text) and KEYED(text)
        or text.count(":") >= 7 and COLONS(text)
    )


ENTITY = StructType(
    [StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()),
     StructField("original", StringType()), StructField("surrogate", StringType())]
)


@lru_cache(maxsize=4096)
def alphabet(char: str) -> str:
    """Letters or digits of the same kind from the same stretch of 64 code points; just the character itself for others."""
    kind = unicodedata.category(char)
    if kind not in ("Lu", "Ll", "Lo", "Nd"):
        return char
    start = ord(char) & ~63
    return "".join(chr(c) for c in range(start, start + 64) if unicodedata.category(chr(c)) == kind)


def permuted(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed bijection of range(size): a Feistel network of eight rounds, walked until it falls within the range."""
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8
    while True:
        left, right = value >> half, value & mask
        for turn in range(8):
            seed = b"%b|%b|%d|%x|%x" % (key, tweak.encode(), turn, size, right)
            left, right = right, left ^ (int.from_bytes(hashlib.shake_256(seed).digest(width), "big") & mask)
        value = left << half | right
        if value < size:
            return value


def reshaped(text: str, key: bytes, tweak: str, letters: str = "") -> str:
    """``text`` with every letter and digit replaced by one of its own alphabet; all else stays in place.

    Texts of one pattern map one to one onto texts of that pattern. The case of letters is put back afterwards, so
    spellings that differ in case stay together. ``letters`` narrows the alphabet of ASCII letters.
    """
    folded = [c.lower() if len(c.lower()) == 1 else c for c in text]
    sets = [letters if letters and c in letters else alphabet(c) for c in folded]
    # Digits are put together and taken apart by halves: one at a time would take time with the square of a long text.
    sizes = [list(map(len, sets))]
    while len(sizes[-1]) > 1:
        sizes.append([prod(sizes[-1][k : k + 2]) for k in range(0, len(sizes[-1]), 2)])
    size = prod(sizes[-1])
    if size == 1:
        return text
    digits = [chars.index(c) for c, chars in zip(folded, sets)]
    for level in sizes[:-1]:
        digits = [digits[k] * level[k + 1] + digits[k + 1] if k + 1 < len(level) else digits[k] for k in range(0, len(level), 2)]
    digits = [permuted(digits[0], size, key, tweak + "|" + "".join(s[0] for s in sets))]
    for level in reversed(sizes[:-1]):
        digits = [part for k, digit in enumerate(digits) for part in (divmod(digit, level[2 * k + 1]) if 2 * k + 1 < len(level) else (digit,))]
    out = []
    for c, low, chars, digit in zip(text, folded, sets, digits):
        new = chars[digit]
        out.append(new.upper() if c != low and len(new.upper()) == 1 else new)
    return "".join(out)


def luhn(digits: str) -> bool:
    total = sum(int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(reversed(digits)))
    return total % 10 == 0


#: First digits that issuers of cards use, with the lengths of their numbers. Other numbers are no cards, whatever their sum.
ISSUERS = [
    (r"4", {13, 16, 19}),
    (r"5[1-5]|222[1-9]|22[3-9]\d|2[3-6]\d\d|27[01]\d|2720", {16}),
    (r"6011|64[4-9]|65|352[89]|35[3-8]\d", {16, 17, 18, 19}),
    (r"3[47]", {15}),
    (r"30[0-5]|3[68]", {14}),
]


def _issuer(digits: str) -> str:
    """The digits that tell the issuer, or nothing."""
    for pattern, lengths in ISSUERS:
        found = re.match(pattern, digits)
        if found and len(digits) in lengths:
            return found.group()
    return ""


def _card(text: str, key: bytes) -> str:
    """Issuer and length stay, so surrogates of different issuers cannot meet."""
    digits = re.sub("[ -]", "", text)
    issuer = _issuer(digits)
    body = issuer + reshaped(digits[len(issuer) : -1], key, f"card{issuer}|{len(digits)}")
    new = iter(body + next(d for d in "0123456789" if luhn(body + d)))
    return "".join(next(new) if c.isdigit() else c for c in text)


def _remainder(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _iban(text: str, key: bytes) -> str:
    plain = text.replace(" ", "")
    account = reshaped(plain[4:], key, "iban" + plain[:2])
    new = iter(f"{plain[:2]}{98 - _remainder(plain[:2] + '00' + account):02d}{account}")
    return "".join(c if c == " " else next(new) for c in text)


#: Networks whose addresses say what they are for: each is permuted within itself, all other addresses among themselves.
NETWORKS = {
    version: [ipaddress.ip_network(n) for n in networks.split()]
    for version, networks in {
        4: "0.0.0.0/8 10.0.0.0/8 100.64.0.0/10 127.0.0.0/8 169.254.0.0/16 172.16.0.0/12 192.0.2.0/24 192.168.0.0/16 198.51.100.0/24 203.0.113.0/24 224.0.0.0/4 240.0.0.0/4",
        6: "::/16 64:ff9b::/32 2001:db8::/32 fc00::/7 fe80::/10 ff00::/8",
    }.items()
}


def _address(address: ipaddress.IPv4Address | ipaddress.IPv6Address, key: bytes) -> ipaddress.IPv4Address | ipaddress.IPv6Address:
    kind, special = type(address), NETWORKS[address.version]
    for network in special:
        if address in network:
            base = int(network.network_address)
            return kind(base + permuted(int(address) - base, network.num_addresses, key, f"ip{network}"))
    while True:
        address = kind(permuted(int(address), 1 << address.max_prefixlen, key, f"ipv{address.version}"))
        if not any(address in network for network in special):
            return address


def _ipv6(text: str, key: bytes) -> str:
    new = _address(ipaddress.IPv6Address(text), key)
    out = new.compressed if "::" in text else new.exploded if max(map(len, text.split(":"))) == min(map(len, text.split(":"))) == 4 else ":".join(f"{int(x, 16):x}" for x in new.exploded.split(":"))
    return out.upper() if text != text.lower() else out


#: Country codes of two digits; 1 and 7 have one, all others three.
TWO_DIGITS = {20, 27, *range(30, 35), 36, 39, 40, 41, *range(43, 50), *range(51, 59), *range(60, 67), 81, 82, 84, 86, *range(90, 96), 98}


def _phone(text: str, key: bytes) -> str:
    """The country stays, and the digits after it are permuted as one number and laid into the form of the text."""
    digits = re.sub(r"\D", "", text)
    known = 0 if text[0] != "+" else 1 if digits[0] in "17" else 2 if int(digits[:2]) in TWO_DIGITS else 3
    if text[0] == "0":
        known = 1  # the national prefix
    new = iter(digits[:known] + reshaped(digits[known:], key, "phone" + digits[:known]))
    return "".join(next(new) if c.isdigit() else c for c in text)


def _email(text: str, key: bytes) -> str:
    """Mailbox and domain each by itself, so mailboxes of one domain stay together; the last label of the domain stays."""
    box, _, domain = text.rpartition("@")
    own, _, last = domain.rpartition(".")
    return f"{reshaped(box, key, 'mailbox')}@{reshaped(own, key, 'domain')}.{last}"


@lru_cache(maxsize=64)
def _order(names: tuple[str, ...], key: bytes) -> dict[str, str]:
    """Each listed name to the next one in a keyed order: one to one, and never to itself."""
    order = sorted(names, key=lambda name: hashlib.blake2b(name.encode(), key=hashlib.sha256(key).digest()).digest())
    return dict(zip(order, [*order[1:], order[0]]))


LISTED = {name: group for group, names in NAMES.items() for name in names}


#: Letters of a script: the usual ones in lower case, all that count as its letters, and the consonants, vowels and last
#: letters (by gender, and of family names) of its generated names. No listed name ends in one of these.
SCRIPTS = {
    "latin": ("abcdefghijklmnopqrstuvwxyz", [(0x41, 0x250)], "bdfgklmnprstvz", "aeiou", {"f": "lla", "m": "rd", "": "ng"}),
    "cyrillic": ("абвгдежзийклмнопрстуфхцчшщъыьэюяё", [(0x400, 0x530)], "бвгдзклмнпрст", "аеиоу", {"f": "лла", "m": "слав", "": "енко"}),
    "greek": ("αβγδεζηθικλμνξοπρσςτυφχψωάέήίόύώϊϋΐΰ", [(0x370, 0x400), (0x1F00, 0x2000)], "βγδζθκλμνπρστφ", "αεηιο", {"f": "λλα", "m": "ων", "": "ίδης"}),
}


@lru_cache(maxsize=8)
def _letters(script: str) -> str:
    every = (chr(c) for low, high in SCRIPTS[script][1] for c in range(low, high))
    return "".join(c for c in every if unicodedata.category(c) in ("Lu", "Ll", "Lt"))


def _generated(part: str, gender: str, script: str, key: bytes) -> str:
    """A name of syllables and the ending of ``gender``, one to one for all parts of the script.

    Parts in one of the usual cases keep it. All parts are numbered, by length and permuted within it; the number is
    spelt in syllables, so different parts never meet.
    """
    usual, _, consonants, vowels, endings = SCRIPTS[script]
    style = next((f for f in (str.title, str.lower, str.upper) if set(part.lower()) <= set(usual) and f(part.lower()) == part), None)
    letters, folded = (usual, part.lower()) if style else (_letters(script), part)
    number = 0
    for char in folded:
        number = number * len(letters) + letters.index(char)
    number = permuted(number, len(letters) ** len(part), key, f"name|{gender}|{script}|{len(letters)}|{len(part)}")
    number = 2 * (number + sum(len(letters) ** k for k in range(1, len(part)))) + (style is None) + 1
    out = []
    while number:
        number, digit = divmod(number - 1, len(consonants) * len(vowels))
        out.append(consonants[digit // len(vowels)] + vowels[digit % len(vowels)])
    return (style or str.title)("".join([*out, endings[gender]]))


def name_word(word: str, gender: str, key: bytes) -> str:
    """Surrogate of one word of a name: a given name (``gender`` f or m) or a family name (no gender).

    A listed given name stays within its script and gender. Other words of letters of one script become generated names of
    that script, with an ending that tells the gender or a family name; parts between hyphens and apostrophes each do.
    Words of other scripts, and with digits, keep their form but have no gender. The kinds never meet.
    """
    if word in LISTED:
        return _order(tuple(NAMES[LISTED[word]]), key)[word]
    parts = re.split("(['’-])", word)
    for script in SCRIPTS:
        if set("".join(parts[::2])) <= set(_letters(script)):
            return "".join(_generated(part, gender, script, key) if k % 2 == 0 and part else part for k, part in enumerate(parts))
    return reshaped(word, key, "name")


def _entity(match: re.Match, key: bytes, families: frozenset[str] = frozenset()) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, surrogate) of what a match holds; nothing if a check digit or range tells otherwise.

    The first word after a title is a given name, unless it stands alone and is one of ``families``.
    """
    text = match.group()
    if match["secret"] is not None:
        value, (start, end) = match["value"], match.span("value")
        bare = value.rstrip("!.,;:)$%&#*")
        end -= len(value) - len(bare)
        hexadecimal = re.fullmatch(r"[0-9a-fA-F]{16,}", bare) is not None
        if len(bare) < 6 or bare.lower() in NO_SECRET:
            return []
        return [("secret", start, end, reshaped(bare, key, "secret", "abcdef" if hexadecimal else ""))]
    if match["name"] is not None:
        gender, begin = GENDER[match["title"]], match.start("who")
        words = list(re.finditer(r"[^ \u00a0]+", match["who"]))
        given = "" if len(words) == 1 and match["who"] in families else gender
        genders = [given] + [""] * (len(words) - 1)
        return [("name", begin + m.start(), begin + m.end(), name_word(m.group(), g, key)) for m, g in zip(words, genders) if m.group()[0] != m.group()[0].lower()]
    kind = next(k for k in KINDS if match[k] is not None)
    start, end = match.span()
    if kind == "card":
        digits = re.sub("[ -]", "", text)
        return [(kind, start, end, _card(text, key))] if _issuer(digits) and luhn(digits) else []
    if kind == "iban":
        return [(kind, start, end, _iban(text, key))] if _remainder(text.replace(" ", "")) == 1 else []
    if kind == "ipv4":
        fit = all(int(x) < 256 and str(int(x)) == x for x in text.split("."))
        if not fit or VERSION(match.string, max(0, start - 12), start):
            return []
        return [(kind, start, end, str(_address(ipaddress.IPv4Address(text), key)))]
    if kind == "ipv6":
        try:
            address = ipaddress.IPv6Address(text)
        except ValueError:
            return []
        return [(kind, start, end, _ipv6(text, key))] if int(address) > 1 and ("::" not in text or DIGITS(text)) else []
    if kind == "email":
        return [(kind, start, end, _email(text, key))]
    if kind == "key":
        inner = re.search(r"(?<=KEY-----).*(?=-----END)", text, re.DOTALL)
        return [(kind, start + inner.start(), start + inner.end(), reshaped(inner.group(), key, kind))] if inner.group().strip() else []
    if kind == "phone":
        return [] if BOOK(match.string, max(0, start - 12), start) else [(kind, start, end, _phone(text, key))]
    return [(kind, start, end, reshaped(text, key, kind, "abcdef" if kind == "hex" else ""))]


#: Words given where a secret would be, that say what there is instead.
NO_SECRET = {"required", "optional", "nothing", "enabled", "disabled", "unknown", "missing", "string", "default"}
VERSION = re.compile(r"(?i:\b(?:version|ver|v|release|build))[ .:#]*\Z").search
BOOK = re.compile(r"(?i:\b(?:isbn|issn|ean|doi))[ .:#-]*(?:1[03])?[ .:#-]*\Z").search
#: Words as they stand in a text, to look names up in.
WORDS = re.compile(r"\w+")


def canonical(kind: str, text: str) -> str:
    """What makes two spellings one entity: all spellings of an address, and the letters and digits of everything else."""
    return ipaddress.IPv6Address(text).compressed if kind == "ipv6" else text


def replace_in(text: str, key: bytes) -> tuple[str, list[tuple[str, int, int, str, str]]]:
    """``text`` with surrogates, and (kind, start, end, keyed hash of the original, surrogate) of each replacement.

    Words of a titled name are also replaced where they stand alone, so later mentions still refer to the same person.
    """
    if not hinted(text):
        return text, []
    matches = list(FIND.finditer(text))
    families = frozenset(word for match in matches if match["who"] for word in re.split("[ \u00a0]", match["who"])[1:])
    found = [e for match in matches for e in _entity(match, key, families)]
    names = {text[s:e]: new for kind, s, e, new in found if kind == "name"}
    if names:
        starting: dict[str, list[str]] = {}
        for name in sorted(names, key=len, reverse=True):
            starting.setdefault(WORDS.match(name).group(), []).append(name)
        starts, ends, free = [e[1] for e in found], [e[2] for e in found], 0
        for match in WORDS.finditer(text):
            at = match.start()
            if at < free or match.group() not in starting:
                continue
            for name in starting[match.group()]:
                end = at + len(name)
                before = bisect_right(starts, end - 1) - 1  # the last match that starts before the end of the name
                if text.startswith(name, at) and not text[end : end + 1].isalnum() and text[end : end + 1] != "_" and (before < 0 or ends[before] <= at):
                    found.append(("name", at, end, names[name]))
                    free = end
                    break
        found.sort(key=lambda e: e[1])
    out, at, entities = [], 0, []
    secret = hashlib.sha256(key).digest()
    for kind, start, end, new in found:
        out += [text[at:start], new]
        at = end
        mark = hashlib.blake2b(f"{kind}|{canonical(kind, text[start:end])}".encode(), key=secret, digest_size=16).hexdigest()
        entities.append((kind, start, end, mark, new))
    return "".join([*out, text[at:]]), entities


_DRAWN: dict[str, bytes] = {}


def secret_key(spark: SparkSession) -> bytes:
    """The key in the setting KEY_SETTING; where there is none, one drawn for this application.

    With a drawn key, surrogates agree within the application only, and nobody can undo them later. Set a key of your own
    secret store where several runs have to agree.
    """
    own = spark.conf.get(KEY_SETTING, None)
    return own.encode() if own else _DRAWN.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def surrogates(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """``docs`` (text, ...) with surrogates in the text, and entities: array<kind, start, end, original, surrogate>.

    Found are e-mail and IP addresses, phone, card, social security and bank account numbers, keys, tokens and other
    secrets, and names after a title. Check digits decide where a number has them. start and end are places in the text
    before; original is a keyed hash. A null or empty text has no entities. A column `entities` that was there is replaced.

    Surrogates need the key and the value alone: the same entity gets the same surrogate in every document and task, with
    no table of entities to build or to shuffle. Each kind and form is permuted one to one, so different entities stay
    different; ``clashes`` checks that over all documents. ``key``: see ``secret_key``, whose result is the default.

    Matches never overlap: the leftmost counts, and of kinds that match at one place the first in KINDS. Later mentions of a
    name do not count inside other matches. Very long texts take time in proportion to their length. The same value in
    different forms of phone number, or spellings of an address, stays one entity.
    """
    key = key or secret_key(docs.sparkSession)
    base = without(docs, "entities")
    at, names = base.columns.index("text"), [*base.columns, "entities"]
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("original", pa.string()), ("surrogate", pa.string())]))

    def run(batches):
        for batch in slices(batches):
            done = [(None, []) if text is None else replace_in(text, key) for text in batch.column(at).to_pylist()]
            keys = ("kind", "start", "end", "original", "surrogate")
            entities = pa.array([[dict(zip(keys, e)) for e in found] for _, found in done], kind)
            columns = list(batch.columns)
            columns[at] = pa.array([text for text, _ in done], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, entities], names)

    return base.mapInArrow(run, plus(base, entities=ArrayType(ENTITY)))


def clashes(found: DataFrame) -> DataFrame:
    """(kind, surrogate) that stand for different originals anywhere in ``found`` (as from ``surrogates``)."""
    each = found.select(F.explode("entities").alias("e")).select("e.*")
    spread = each.groupBy("kind", "surrogate").agg(F.min("original").alias("low"), F.max("original").alias("high"))
    return spread.where("low <> high").select("kind", "surrogate")


def checked_surrogates(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """``surrogates``, stored, after making sure that no two entities of ``docs`` share a surrogate.

    Detection runs once; the check reads the stored entities and moves one row an entity and task. A clash is an error, not
    a repair, as it can only come from a mistake in a permutation.
    """
    found = stored(surrogates(docs, key))
    if not clashes(found.select("entities")).isEmpty():
        raise ValueError("two entities share a surrogate")
    return found


def without_private_data(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """``docs`` with surrogates in the text and n_chars set to its new length; columns stay as they were."""
    own, restored = set_aside(docs, "entities")
    done = restored(checked_surrogates(own, key))
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done
