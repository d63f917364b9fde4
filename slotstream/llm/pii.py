"""PII surrogates: detected entities get keyed replacements of the same type, format, script and gender.

Every entity has a canonical form (an email in lower case, a number without separators, ...). Its surrogate is
drawn from a keyed hash of type, canonical form and an attempt number, and written in the manner of each
mention: separators, case, script, check digit, the honorific's gender. So equal entities stay equal across
all documents, without a table of all entities in any worker's memory.

Distinctness is checked over the whole corpus: a surrogate that two entities share, or that is itself an entity
of the corpus, is drawn again with the next attempt, until none is left. Later attempts may lengthen the
surrogate, so the rounds end even where a format has too few values. Only documents with redrawn entities are
joined with their attempts.

A name is the capitalised words after a title, with particles and initials. Titles may stack ("Frau Prof. Dr.") and,
like offices ("Mr President") and function words, are no part of a name. Each part has a surrogate by itself, so full and
short mentions agree. A family name (the last word of a name, or the only one) has one surrogate whatever the gender;
given names follow the gender of the title, or have forms of their own where only an academic title is known. The parts
are replaced without a title too in the texts that hold the name. A part alone is left where "the" stands before it
("the Bush fire") or a word of a street or company behind it, and where the corpus has the word more often with a small
first letter than with a capital one ("Will", "May"): such words are counted over all texts. Letters and digits that are
drawn one by one (local parts, secrets, account numbers) never stay what they were.

Bank account numbers (IBAN) count if their check digits are right, and get right ones; IPv6 addresses keep their
groups of zeros and their spelling; social security numbers (123-45-6789) stay in the ranges that are given out.

Null texts stay null, empty ones empty. Other columns pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotstream.llm.common import bounded, materialize

#: Attempts at the mention's own length before surrogates grow.
SAME_LENGTH = 6

_FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Sra", "Señora")
_MALE = ("Mr", "Herr", "Monsieur", "Señor")
#: Titles that tell no gender.
_ACADEMIC = (r"Dr\.-Ing", "Dr", "Prof", "Professor", "Doctor", "Doktor")
_TITLES = _FEMALE + _MALE + _ACADEMIC
_GENDERS = {t.lower(): "f" for t in _FEMALE} | {t.lower(): "m" for t in _MALE}
_OFFICES = ("President", "Chairman", "Chairwoman", "Speaker", "Minister", "Secretary", "Chancellor", "Director", "Judge", "Präsident", "Präsidentin", "Ministerin", "Kanzler", "Kanzlerin", "Bundeskanzler", "Bundeskanzlerin", "Direktor", "Direktorin", "Président", "Présidente", "Ministre", "Presidente", "Presidenta", "Ministro", "Ministra")
#: What may stand between a title and a name.
_MORE = re.compile(r"(?:(?:" + "|".join(_TITLES + _OFFICES) + r"|med|phil|jur|iur|rer|nat|habil|h\.? ?c)\b\.? )+(?=[^\W\d_])", re.IGNORECASE)
#: Capitalised words that end a name, or show that there is none.
_NO_NAME = {t.casefold() for t in _TITLES + _OFFICES} | set(
    "a an and are as at but by for from he her his how i if in is it its my no not of on or our she so that the their then there they this to was we were what when where who why will you your".split()
    + "aber als am auf aus das dem der die ein eine er es für hat ich im ist mit nach sie und vom war wenn wer wie wir zum zur".split()
    + "au aux avec ce dans elle et il ils je les mais nous ou par pour que qui sur un une vous".split()
    + "como con cuando ella ellos en los las para pero por pues sin una y yo".split()
) - {"will"}  # also a given name
#: Words behind a part of a name that make a street or a company of it.
_NO_PERSON = re.compile(r" (?:Street|St|Road|Rd|Avenue|Ave|Lane|Drive|Square|Park|Bridge|University|Inc|Ltd|LLC|Corp|Company|Group|GmbH|AG|KG|SE|Straße|Platz|Allee|SA|SARL)\b")
_ARTICLE = re.compile(r"\b[Tt]he \Z")
_PATTERN = re.compile(
    r"(?<![\w.%+-])(?P<email>[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,})"
    r"|(?:token|secret|password|passwd|api[_-]?key)\s*[=:]\s*[\"']?(?P<secret>[A-Za-z0-9+/_=-]{12,})"
    r"|(?<![0-9A-Za-z])(?P<hex>[0-9a-fA-F]{32,128})(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z])(?P<iban>(?-i:[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?))(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z:.])(?=[0-9a-f:]*[0-9])(?P<ipv6>(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}|(?=[a-f]{0,3}[0-9])[0-9a-f]{3,4}(?::[0-9a-f]{1,4}){0,5}::[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){0,5})(?![0-9A-Za-z:])"
    r"|(?<![\w-])(?P<ssn>(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![\w-])"
    r"|(?<!\d)(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})[ .-]\d{3,4}[ .-]\d{3,4}|\(\d{3}\) ?\d{3}-\d{4}"
    r"|(?=\+(?:[ .()-]{0,2}\d){8})\+\d{1,3}[ .-]?(?:\(\d{1,5}\)|\d{1,5})(?:[ .-]\d{5,8}|(?:[ .-]\d{2,4}){2,4})|(?<![\w.-])\d{3}(?P<dash>[.-])\d{3}(?P=dash)\d{4}(?![\w-]))(?!\d)"
    r"|(?<!\d)(?P<card>\d{13,19}|\d{4}(?P<sep>[ -])\d{4}(?P=sep)\d{4}(?P=sep)\d{4})(?!\d)"
    r"|(?<![\d.])(?P<ip>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?!\.?\d)"
    r"|\b(?P<title>" + "|".join(_TITLES) + r")\.? (?=[^\W\d_])",
    re.IGNORECASE,
)
#: Pieces without any of these hold no entity. ASCII letters of either case have four more partners where case is ignored.
_HINT = re.compile(r"[\d@]|[=:]\s*[\"']?[A-Za-zİıſ\u212a0-9+/_=-]{12}|[a-fA-F0-9]{32}|\b[" + "".join(sorted({t[0] for t in _TITLES})) + r"](?i:" + "|".join(t[1:] for t in _TITLES) + r")\b")
#: The end of a line that a secret's key or its sign may leave open; no entity passes any other line break.
_OPEN = re.compile(r"(?:token|secret|password|passwd|api[_-]?key|[=:])\Z", re.IGNORECASE)
#: What is left of a word in which another entity ended may be an email address.
_EMAIL_REST = re.compile(_PATTERN.pattern[len(r"(?<![\w.%+-])") : _PATTERN.pattern.index("|(?:token")], re.IGNORECASE)
#: Words of a name: letters with hyphens and apostrophes within (no possessive), or an initial.
_NAME_WORD = re.compile(r"[^\W\d_](?=\.)\.?|[^\W\d_]+(?:(?:-|['’](?!s\b))[^\W\d_]+)*")
#: Small words within names, kept as they are.
_PARTICLES = re.compile(r"(?:(?:von|van|der|den|de|del|della|di|da|du|la|zu|ter|ten) )+")
_LETTERS = re.compile(r"[^\W\d_]+")
#: Words of a name in capitals only, where the end of the name does not show.
MAX_CAPITAL_WORDS = 3
#: The kinds of names by gender (n: unknown), and of what has a surrogate: given names by gender, family names.
NAMES = ("f", "m", "n")
NAME_PARTS = (*NAMES, "s")
#: Syllables by script: stems, and endings of female, male and other given names and of family names.
_SYLLABLES = {
    "latin": ("ba be di do fa ga ka le li ma mi na no pe ra ri sa ta ve zo".split(), {"f": ("na", "ria", "ela"), "m": ("no", "rik", "mar"), "n": ("li", "ris", "ani"), "s": ("sen", "dal", "ker")}),
    "cyrillic": ("ба ве ди до ка ле ли ма ми на но ра ри са та".split(), {"f": ("на", "рия", "ела"), "m": ("нов", "рик", "мар"), "n": ("ли", "рис", "ани"), "s": ("ко", "юк", "ских")}),
    "greek": ("βα δε δι κα λε λι μα μι να νο ρα ρι σα τα".split(), {"f": ("να", "ρια", "ελα"), "m": ("νος", "ρης", "μας"), "n": ("λι", "ρις", "ανι"), "s": ("ιδη", "ακη", "ου")}),
}


def _script(text: str) -> str:
    for c in text:
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
        if "Ͱ" <= c <= "Ͽ":
            return "greek"
    return "latin"


class _Draw:
    """An endless keyed stream of numbers below a bound."""

    def __init__(self, key: bytes, *parts: str):
        self.seed, self.pool, self.round = hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), key=key).digest(), 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < 48:
            self.pool = int.from_bytes(hashlib.blake2b(self.round.to_bytes(8, "big"), key=self.seed).digest(), "big")
            self.left, self.round = 512, self.round + 1
        self.pool, x = divmod(self.pool, n)
        self.left -= n.bit_length()
        return x


def _luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10


def _iban_rest(iban: str) -> int:
    """The remainder by 97 of the number that an IBAN stands for; 1 if its check digits are right."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _checked(kind: str, mention: str) -> int:
    """The length of the entity that a mention begins with; 0 if it is none."""
    if kind == "iban":  # words in capitals may follow
        ends = [len(mention), *[m.start() for m in re.finditer(" ", mention)][::-1]]
        return next((end for end in ends if 15 <= end - mention.count(" ", 0, end) <= 34 and _iban_rest(mention[:end].replace(" ", "")) == 1), 0)
    if kind == "ipv6":
        try:
            ipaddress.IPv6Address(mention)
        except ValueError:
            return 0
    return len(mention)


def canonical(kind: str, mention: str) -> str:
    """The form in which mentions of one entity agree."""
    if kind in ("email", "hex"):
        return mention.lower()
    if kind == "iban":
        return mention.replace(" ", "")
    if kind == "ipv6":
        return ipaddress.IPv6Address(mention).exploded
    if kind in ("phone", "card", "ssn"):
        digits = "".join(str(int(c)) for c in mention if c.isdecimal())
        if kind != "phone" or mention[0] != "+":
            return digits
        if digits[0] == "1" and len(digits) == 11:  # numbers without a country code are those of +1
            return digits[1:]
        code = len(re.match(r"\+(\d{1,3})", mention)[1])
        return f"{digits[:code]} {digits[code:]}"
    if kind in NAME_PARTS:
        return mention.casefold()
    return mention


def _other(draw: _Draw, among: str, c: str) -> str:
    """One of the characters that is not ``c``."""
    among = among.replace(c, "") if len(c) == 1 else among
    return among[draw.below(len(among))]


def _like(draw: _Draw, text: str) -> str:
    """Other letters for letters and other digits for digits, ASCII, in the same case."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(_other(draw, "0123456789", c))
        elif c.isalpha():
            x = _other(draw, "abcdefghijklmnopqrstuvwxyz", c.lower())
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return "".join(out)


def surrogate(key: bytes, kind: str, canon: str, attempt: int) -> str:
    """The canonical form of an entity's surrogate."""
    draw = _Draw(key, kind, canon, str(attempt))
    longer = "".join(chr(97 + draw.below(26)) for _ in range(max(0, attempt - SAME_LENGTH)))
    more = "".join(str(draw.below(10)) for _ in range(max(0, attempt - SAME_LENGTH)))
    if kind == "email":
        local, _, domain = canon.rpartition("@")
        return f"{_like(draw, local)}{longer}@{domain}"
    if kind == "hex":
        return "".join("0123456789abcdef"[draw.below(16)] for _ in canon) + more
    if kind == "phone":
        code, space, number = canon.rpartition(" ")
        return code + space + "".join(str(draw.below(10)) for _ in number) + more
    if kind == "card":
        out = str(1 + draw.below(9)) + "".join(str(draw.below(10)) for _ in canon[1:]) + more
        if _luhn(canon) == 0:
            out = out[:-1] + str((10 - _luhn(out[:-1] + "0")) % 10)
        return out
    if kind == "ssn":
        area = 1 + draw.below(664)
        return f"{area + (area > 665):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}{more}"
    if kind == "iban":
        rest = _like(draw, canon[4:]) + more
        return f"{canon[:2]}{98 - _iban_rest(canon[:2] + '00' + rest):02d}{rest}"
    if kind == "ipv6":
        groups = [x.lstrip("0") if attempt <= SAME_LENGTH else x for x in canon.split(":")]
        return ":".join("".join("0123456789abcdef"[draw.below(16) if k else 1 + draw.below(15)] for k in range(len(x))).zfill(4) for x in groups)
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4)) if attempt < 64 else f"10.{attempt}.{draw.below(1 << 30)}"
    if kind in NAME_PARTS:
        stems, endings = _SYLLABLES[_script(canon)]
        return "".join(stems[draw.below(len(stems))] for _ in range(2 + max(0, attempt - SAME_LENGTH))) + endings[kind][draw.below(3)]
    return _like(draw, canon) + longer


def _render(kind: str, mention: str, canon: str) -> str:
    """The canonical surrogate in the manner of the mention."""
    if kind == "iban":
        left = iter(canon)
        return "".join(c if c == " " else next(left) for c in mention) + "".join(left)
    if kind == "ipv6":
        out = _spelled(mention, canon)
        return out.upper() if mention.isupper() else out
    if kind in ("phone", "card", "ssn"):
        code = "1" if kind == "phone" and mention[0] == "+" and " " not in canonical(kind, mention) else ""
        digits = iter(code + canon.replace(" ", ""))
        out = "".join(chr(ord(c) - int(c) + int(next(digits))) if c.isdecimal() else c for c in mention)
        return out + "".join(digits)
    if kind in NAME_PARTS:
        return canon.upper() if mention.isupper() else canon.title()
    if kind in ("email", "hex") and mention.isupper():
        return canon.upper()
    return canon


def _spelled(mention: str, canon: str) -> str:
    """An IPv6 address with the groups that a mention spells out, as long as these; in full if others are not zero."""
    new, (head, gap, tail) = canon.split(":"), mention.partition("::")
    first, last = head.split(":"), tail.split(":") if gap else []
    if any(int(x, 16) for x in new[len(first) : 8 - len(last)]):
        return canon
    short = lambda old, x: x.lstrip("0").zfill(len(old))
    return ":".join(map(short, first, new)) + gap + ":".join(map(short, last, new[8 - len(last) :]))


def _pieces(text: str):
    """(start, piece) of the parts of a text between line breaks that no entity passes."""
    start, at, still_open = 0, 0, False
    while (end := text.find("\n", at)) >= 0:
        line = text[at:end].rstrip()
        if line:
            still_open = _OPEN.search(line, max(0, len(line) - 8)) is not None
        at = end + 1
        if not still_open:
            yield start, text[start:end]
            start = at
    yield start, text[start:]


def _name_end(text: str, start: int) -> int:
    """The end of the capitalised words, initials and particles from ``start`` on; ``start`` where there is no name."""
    at = end = start
    words = 0
    while True:
        if small := _PARTICLES.match(text, at):
            at = small.end()
        m = _NAME_WORD.match(text, at)
        if not m or not m[0][0].isupper():
            return end
        if len(m[0]) == 1 or m[0].casefold() in _NO_NAME:  # a letter alone is no initial
            return end
        words += 1
        end = m.end()
        if text[end : end + 1] != " " or (words >= MAX_CAPITAL_WORDS and text[start:end].isupper()):
            return end
        at = end + 1


def _name_parts(mention: str):
    """(start, end) of the parts of a name that have surrogates: its words and what hyphens join, of two letters or more."""
    for m in _LETTERS.finditer(mention):
        if len(m[0]) > 1 and m[0][0].isupper():
            yield m.span()


def _entities(piece: str):
    """(kind, start, end) of the entities of a piece that show by themselves."""
    m = _PATTERN.search(piece)
    while m:
        at = m.end()
        if m.re is _EMAIL_REST:
            yield "email", m.start(), at
        elif m["title"]:
            more = _MORE.match(piece, at)
            start = more.end() if more else at
            end = _name_end(piece, start) if m["title"][0].isupper() else start
            if any(True for _ in _name_parts(piece[start:end])):
                titles = [m["title"], *_LETTERS.findall(more[0] if more else "")]
                yield next((_GENDERS[t.lower()] for t in titles if t.lower() in _GENDERS), "n"), start, end
                at = end
        else:
            kind = m.lastgroup if m.lastgroup != "sep" else "card"
            start, end = m.span(kind)
            if kind in ("iban", "ipv6"):
                end = start + _checked(kind, piece[start:end])
                at = end if end > start else start + 1
                if end == start:
                    m = _PATTERN.search(piece, at)
                    continue
            yield "hex" if kind == "secret" and re.fullmatch("[0-9a-fA-F]{32,128}", piece[start:end]) else kind, start, end
        m = _EMAIL_REST.match(piece, at) or _PATTERN.search(piece, at)


def mentions(text: str | None, ordinary: frozenset[str] = frozenset()):
    """(kind, start, end) of every entity in a text, from left to right; of names, also the mentions without a title.

    ``ordinary``: parts of names, case-folded, that are no names where they stand alone without a title.
    """
    return _analysed(text, ordinary)[0]


def _analysed(text: str | None, ordinary: frozenset[str] = frozenset()):
    """The mentions, and what the titled ones tell of the parts of names: genders of given names, and family names."""
    found = [(kind, at + a, at + b) for at, piece in _pieces(text or "") if _HINT.search(piece) for kind, a, b in _entities(piece)]
    given: dict[str, set[str]] = {}
    family = set()
    for kind, start, end in found:
        if kind in NAMES and (space := text.rfind(" ", start, end)) >= 0:
            for a, b in _name_parts(text[start:end]):
                part = text[start + a : start + b].casefold()
                if start + a > space:
                    family.add(part)
                else:
                    given.setdefault(part, set()).add(kind)
    return (_with_untitled(text, found, ordinary) if any(kind in NAMES for kind, *_ in found) else found), (given, family)


def _with_untitled(text: str, found: list[tuple[str, int, int]], ordinary: frozenset[str] = frozenset()) -> list[tuple[str, int, int]]:
    """``found`` and the capitalised words elsewhere in the text that are parts of its names.

    A part that names of both genders share belongs to the last one before it. Parts seen in capitals only are
    looked for in capitals only, as such names may include other words.
    """
    seen: dict[str, list[tuple[int, str]]] = {}
    mixed = set()
    for kind, start, end in found:
        if kind in NAMES:
            for a, b in _name_parts(text[start:end]):
                part = text[start + a : start + b]
                seen.setdefault(part.casefold(), []).append((start, kind))
                if not part.isupper():
                    mixed.add(part.casefold())
    word = lambda at: 0 <= at < len(text) and (text[at].isalnum() or text[at] == "_")
    person = lambda a, b: text[a:b].casefold() not in ordinary and not _NO_PERSON.match(text, b) and not _ARTICLE.search(text, max(0, a - 5), a)
    out, free = [], 0
    for kind, start, end in [*found, ("", len(text), len(text))]:
        runs: list[tuple[str, int, int, int]] = []
        for m in _LETTERS.finditer(text, free, start):
            part = m[0].casefold()
            if part in seen and len(m[0]) > 1 and m[0][0].isupper() and (part in mixed or m[0].isupper()) and not word(m.start() - 1) and not word(m.end()):
                of = next((k for at, k in reversed(seen[part]) if at < m.start()), seen[part][0][1])
                if runs and runs[-1][0] == of and text[runs[-1][2] : m.start()] in (" ", "-"):
                    runs[-1] = (of, runs[-1][1], m.end(), runs[-1][3] + 1)
                else:
                    runs.append((of, m.start(), m.end(), 1))
        out += [(of, a, b) for of, a, b, n in runs if n > 1 or person(a, b)]
        if kind:
            out.append((kind, start, end))
        free = end
    return out


def _keyed(mention: str, kind: str, told) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of what has a surrogate in a mention: the whole of it, or each part of a name."""
    if kind not in NAMES:
        return [(0, len(mention), kind, canonical(kind, mention))]
    (given, family), space, out = told, mention.rfind(" "), []
    for a, b in _name_parts(mention):
        part = mention[a:b].casefold()
        if (part in family) != (part in given):
            last = part in family
        else:
            last = a > space
        genders = sorted(given.get(part, set()) - {"n"})
        out.append((a, b, "s" if last else genders[0] if kind == "n" and genders else kind, part))
    return out


def entities(text: str | None) -> set[tuple[str, str]]:
    """Kind and canonical form of all that has a surrogate in a text."""
    found, told = _analysed(text)
    return {(kind, canon) for of, start, end in found for _, _, kind, canon in _keyed(text[start:end], of, told)}


def _initials(text: str, key: bytes) -> str:
    """Initials have a keyed letter of their own, which other initials may share."""
    return re.sub(r"[^\W\d_](?=\.)", lambda m: _other(_Draw(key, "initial", m[0].casefold()), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", m[0]) if m[0].isupper() else m[0], text)


def replace(text: str | None, key: bytes, attempts: dict[tuple[str, str], int], ordinary: frozenset[str] = frozenset()) -> tuple[str | None, int]:
    """The text with surrogates, and how many mentions were replaced."""
    found, told = _analysed(text, ordinary)
    out, at = [], 0
    for of, start, end in found:
        out.append(text[at:start])
        mention, done = text[start:end], 0
        for a, b, kind, canon in _keyed(mention, of, told):
            drawn = surrogate(key, kind, canon, attempts.get((kind, canon), 0))
            out += [_initials(mention[done:a], key), _render(kind, mention[a:b], drawn)]
            done = b
        out.append(_initials(mention[done:], key))
        at = end
    return ("".join(out) + text[at:] if found else text), len(found)


def _found(df: DataFrame) -> DataFrame:
    """doc (the text's key), kind and canonical form of every entity of every text, once per text."""

    def run(batches):
        for batch in batches:
            docs, kinds, canons = [], [], []
            for doc, text in zip(batch.column("doc"), batch.column("text"), strict=True):
                for kind, canon in entities(text.as_py()):
                    docs.append(doc.as_py())
                    kinds.append(kind)
                    canons.append(canon)
            if docs:
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(kinds, pa.string()), pa.array(canons, pa.string())], names=["doc", "kind", "canon"])

    return df.mapInArrow(run, "doc long, kind string, canon string")


def redrawn(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, canon, attempt of the entities whose first surrogate was not free. ``entities``: distinct kind, canon.

    Each round is a grouping and a join over the entities; the earlier attempt keeps a contested surrogate.
    """

    @F.arrow_udf("string")
    def draw(kind: pa.Array, canon: pa.Array, attempt: pa.Array) -> pa.Array:
        return pa.array([surrogate(key, k, c, a) for k, c, a in zip(kind.to_pylist(), canon.to_pylist(), attempt.to_pylist(), strict=True)], pa.string())

    table = materialize(entities.withColumn("attempt", F.lit(0)).withColumn("drawn", draw("kind", "canon", "attempt")), "drawn")
    taken = entities.select("kind", F.col("canon").alias("drawn"), F.lit(True).alias("real"))
    while True:
        holder = table.groupBy("kind", "drawn").agg(F.min(F.struct("attempt", "canon")).alias("holder"))
        judged = table.join(holder, ["kind", "drawn"]).join(taken, ["kind", "drawn"], "left")
        judged = materialize(judged.select("kind", "canon", "attempt", "drawn", (F.col("real").isNotNull() | (F.col("holder.canon") != F.col("canon"))).alias("again")), "judged")
        if judged.where("again").isEmpty():
            return judged.where("attempt > 0").select("kind", "canon", "attempt")
        redo = judged.where("again").withColumn("attempt", F.col("attempt") + 1)
        table = materialize(judged.where("not again").drop("again").unionByName(redo.withColumn("drawn", draw("kind", "canon", "attempt")).drop("again")), "drawn")


def ordinary_words(texts: DataFrame, parts: DataFrame) -> DataFrame:
    """canon of the ``parts`` of names that ``texts`` have more often with a small first letter than with a capital one.

    Words are counted before they meet the names, so a frequent word is one row of a partition in the shuffle.
    """
    words = texts.select(F.explode(F.regexp_extract_all("text", F.lit(r"\p{L}{2,}"), F.lit(0))).alias("word"))
    first = F.substring("word", 1, 1)
    counts = words.groupBy(F.lower("word").alias("canon")).agg(F.count_if(first == F.lower(first)).alias("small"), F.count(F.lit(1)).alias("n"))
    return counts.where("2 * small > n").join(parts.select("canon").distinct(), "canon", "left_semi").select("canon")


def replace_entities(df: DataFrame, key: bytes, text: str = "text", count: str = "n_replaced") -> DataFrame:
    """``df`` with surrogates in ``text`` and the number of replaced mentions in ``count``."""
    names = [f"c{i}" for i in range(len(df.columns))]
    plain = df.toDF(*names).withColumn("doc", F.xxhash64(names[df.columns.index(text)]))
    body = names[df.columns.index(text)]
    found = materialize(_found(plain.select("doc", F.col(body).alias("text"))), "mentions")
    attempts = redrawn(materialize(found.select("kind", "canon").distinct(), "entities"), key)
    known = found.join(attempts, ["kind", "canon"])
    named = found.where(F.col("kind").isin(*NAME_PARTS))
    if not named.isEmpty():
        plain_words = materialize(ordinary_words(plain.select(F.col(body).alias("text")), named), "ordinary")
        known = known.unionByName(named.join(plain_words, "canon").select("doc", F.lit("ordinary").alias("kind"), "canon", F.lit(0).alias("attempt")))
    per_doc = known.groupBy("doc").agg(F.collect_set(F.struct("kind", "canon", "attempt")).alias("attempts"))
    per_doc = materialize(per_doc, "attempts")
    ids = bounded(per_doc.select("doc"))
    with_attempts = plain.join(ids, "doc", "left_semi").join(per_doc, "doc")
    without = plain.join(ids, "doc", "left_anti").withColumn("attempts", F.lit(None).cast(per_doc.schema["attempts"].dataType))

    @F.arrow_udf("text string, n bigint")
    def apply(texts: pa.Array, lists: pa.Array) -> pa.Array:
        done = []
        for x, known in zip(texts.to_pylist(), lists.to_pylist(), strict=True):
            ordinary = frozenset(a["canon"] for a in known or () if a["kind"] == "ordinary")
            done.append(replace(x, key, {(a["kind"], a["canon"]): a["attempt"] for a in known or ()}, ordinary))
        return pa.StructArray.from_arrays([pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["text", "n"])

    out = with_attempts.unionByName(without).withColumn("done", apply(body, "attempts"))
    columns = [F.col("done.text" if n == body else n).alias(c) for n, c in zip(names, df.columns, strict=True) if c != count]
    return out.select(*columns, F.col("done.n").alias(count))
