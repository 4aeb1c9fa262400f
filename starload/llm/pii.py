"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, schemes, digits and
identifier cues. At each anchor a local parser walks outwards to the boundaries of what the anchor
may belong to and validates it. No pattern is searched over the whole text, so the work is linear
in the text and its anchors.

Base kinds, leftmost and without overlaps inside a kind: ``email``, ``ip``, ``card`` (12 to 19
digits that pass Luhn), ``phone`` (9 to 15 digits). Further kinds that the cues add: ``url`` (after
a scheme), ``account`` (IBAN by country, length and check digits; other IBANs and numbers after an
account cue), ``secret`` (access keys, values after password and token cues), ``address`` (a word for
a street in English, German, French or Spanish with names and a number in that language's order) and
``handle`` (a name after an at-sign that begins no email).

Defined cases: a null or empty text has no spans; spans are in code points, end exclusive, ordered
by start and then by kind; a row is returned for every row, with null or repeated ids too; an empty
table gives an empty result; other columns are kept by ``find_spans``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from starload.llm.text import LOWER_TABLE, documents, whole_text

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account", "secret", "address", "handle")
SCHEMES = ("http://", "https://", "ftp://", "sftp://")
ACCOUNT_CUES = (
    "iban", "account", "acct", "konto", "kontonummer", "compte", "cuenta", "routing", "ssn",
    "social security", "passport", "tax id",
)
SECRET_CUES = ("password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "api key")
# What streets are called in the languages of the corpus, and the lengths of IBANs.
#: After a number and names: 12 Old Mill Road.
STREETS_BEHIND = (
    "street", "st", "avenue", "ave", "road", "rd", "boulevard", "blvd", "lane", "ln", "drive", "dr",
    "court", "square", "terrace", "highway",
)
#: Between a number and names: 12 rue de la Paix.
STREETS_BETWEEN = (
    "rue", "avenue", "boulevard", "place", "allée", "chemin", "quai", "impasse", "route",
)
#: Before names and a number: Calle de Alcalá, 42.
STREETS_BEFORE = ("calle", "avenida", "plaza", "paseo", "camino", "carrera")
#: A word or the end of one, before a number: Musterstraße 12.
STREETS_ENDING = ("straße", "strasse", "str", "gasse", "allee", "platz", "weg", "damm", "ufer")
PARTICLES = "de la|de los|de las|de|del|du|des|la|le|les|los|las|el|l'|d'"
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21,
    "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24,
    "SE": 24, "SI": 19, "SK": 24,
}
ACCESS_KEY = "akia"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"'`\[\]{}|\\^]+")
_HOST = re.compile(r"[^\s<>\"'`\[\]{}|\\^/]+")
_ACCESS_KEY = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])")
_ACCOUNT = re.compile(
    r"\W{0,3}(?:(?:no|nr|number|num)\b\W{0,3})?([A-Za-z]{0,4}[0-9](?:[ -]?[0-9A-Z]){5,32})(?![0-9A-Za-z])",
    re.IGNORECASE,
)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]){11,30}(?![0-9A-Za-z])")
_SECRET = re.compile(r"[\"']?\s{0,2}[=:]\s{0,2}[\"']?([^\s\"',;]{6,})")
# A number of a house, before or after the street; a name as it stands between the two.
_HOUSE = re.compile(r"[0-9]{1,5}(?:[A-Za-z]|[ -]?(?:bis|ter)\b)?(?![\w@])")
_NAMES = re.compile(rf"(?: ?(?:{PARTICLES})(?: |(?<=')))*+ ?[^\W\d_a-zß-ÿ][\w'’.-]*+(?: (?:(?:{PARTICLES})(?: |(?<=')))*+[^\W\d_a-zß-ÿ][\w'’-]*+)*+")
_NUMBER_BEHIND = re.compile(r"\.?,? (?:n[º°.] ?)?(?=[0-9])")
_TOWN = re.compile(r", ?[0-9]{4,5} [^\W\d_a-zß-ÿ][\w-]++")
_NUMBER_BEFORE = re.compile(r"(?<![\w.,])[0-9]{1,5}(?:[A-Za-z]|[ -]?(?:bis|ter))?,? \Z")
_HANDLE = re.compile(r"[A-Za-z0-9_]{2,30}(?![A-Za-z0-9_@.])")
_NUMBER_JOINTS = str.maketrans("", "", " -().+")


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _iban(text: str) -> bool:
    packed = text.replace(" ", "")
    turned = packed[4:] + packed[:4]
    return 15 <= len(packed) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _part(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or 0) <= 255


def _iban_at(text: str, at: int) -> int:
    """The end of the IBAN that begins at ``at``, by its country's length and check digits; or 0."""
    left, end, packed = IBAN_LENGTHS.get(text[at : at + 2], 0), at, []
    while left and end < len(text):
        c = text[end]
        if c == " " and packed and text[end - 1] != " ":
            end += 1
            continue
        if not (c.isascii() and (c.isdigit() or c.isupper())):
            return 0
        packed.append(c)
        end, left = end + 1, left - 1
    if left or not packed or text[end : end + 1].isalnum():
        return 0
    return end if _iban("".join(packed)) else 0


class _Streets:
    """Addresses around the words for a street. Each walks to its number over names only, and never
    over the names that an earlier walk without success went through, so the work is linear."""

    def __init__(self, text: str, low: str):
        self.text, self.low, self.dead, self.walked = text, low, 0, 0

    def at(self, at: int, end: int, floor: int) -> tuple[int, int] | None:
        """The address of the word in ``at .. end`` that begins at ``floor`` or later."""
        text, word = self.text, self.low[at:end]
        if text[end : end + 1].isalnum():
            return None
        whole = not (at and self.low[at - 1].isalnum())
        if word in STREETS_ENDING and (found := self.ending(at, end, floor)):
            return found
        if not whole:
            return None
        if word in STREETS_BEHIND and (found := self.behind(at, end, floor)):
            return found
        if word in STREETS_BETWEEN and (found := self.between(at, end, floor)):
            return found
        # Names that led to no number lead to none from a word among them either.
        if word in STREETS_BEFORE and at >= self.walked and (m := _NAMES.match(text, end)):
            self.walked = m.end()
            return self.number_behind(at, m.end())
        return None

    def behind(self, at: int, end: int, floor: int) -> tuple[int, int] | None:
        text, begin, names = self.text, at, 0
        floor = max(floor, self.dead)
        while begin > floor and text[begin - 1] == " ":
            word = text.rfind(" ", floor, begin - 1) + 1 or floor
            if begin - 1 - word > 31:
                break
            if names and text[word].isdigit():
                if _HOUSE.fullmatch(text, word, begin - 1) and not self.inside(word):
                    return word, end + (text[end : end + 1] == "." and len(self.low[at:end]) <= 4)
                if not text[begin - 2].isalpha():  # 5th Avenue
                    break
            elif not text[word].isupper() and not text[word].isdigit():
                break
            names, begin = names + 1, word
        self.dead = at
        return None

    def inside(self, at: int) -> bool:
        return at > 0 and (self.text[at - 1].isalnum() or self.text[at - 1] in ".,-/")

    def between(self, at: int, end: int, floor: int) -> tuple[int, int] | None:
        near = max(floor, at - 12)
        if (m := _NUMBER_BEFORE.search(self.text, near, at)) and not self.inside(m.start()):
            if names := _NAMES.match(self.text, end):
                return m.start(), names.end()
        return None

    def ending(self, at: int, end: int, floor: int) -> tuple[int, int] | None:
        begin = at
        while begin > max(floor, at - 40) and (
            self.text[begin - 1].isalpha() or self.text[begin - 1] == "-"
        ):
            begin -= 1
        if begin == at and begin > floor + 2 and self.text[begin - 1] == " ":
            # A word of its own needs a name before it: Lange Gasse 7.
            before = self.text.rfind(" ", max(floor, at - 40), at - 1) + 1
            begin = before or (max(floor, at - 40) if at <= 40 else at)
        if begin == at or not self.text[begin].isupper():
            return None
        return self.number_behind(begin, end)

    def number_behind(self, begin: int, end: int) -> tuple[int, int] | None:
        if (gap := _NUMBER_BEHIND.match(self.text, end)) and (
            house := _HOUSE.match(self.text, gap.end())
        ):
            town = _TOWN.match(self.text, house.end())
            return begin, (town or house).end()
        return None


def anchors() -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, words in (
        ("at", "@"),
        ("plus", "+"),
        ("digit", "0123456789"),
        ("scheme", SCHEMES),
        ("account", ACCOUNT_CUES),
        ("secret", SECRET_CUES),
        ("street", {*STREETS_BEHIND, *STREETS_BETWEEN, *STREETS_BEFORE, *STREETS_ENDING}),
        ("key", (ACCESS_KEY,)),
    ):
        for word in words:
            automaton.add_word(word, (kind, len(word)))
    automaton.make_automaton()
    return automaton


def scan(text: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every span."""
    low = text.lower()
    if len(low) != len(text):
        low = text.translate(LOWER_TABLE)
    spans: list[tuple[int, int, str]] = []
    ends = dict.fromkeys(KINDS, 0)
    run = -1  # the end of the last digit run seen
    streets = _Streets(text, low)

    def add(kind: str, start: int, end: int) -> None:
        spans.append((start, end, kind))
        ends[kind] = end

    for last, (anchor, length) in automaton.iter(low):
        at = last + 1 - length
        if anchor == "digit":
            if at == run:
                run += 1
                continue
            run = at + 1
            if at - 2 >= ends["account"] and text[at - 2 : at] in IBAN_LENGTHS:
                if not (at > 2 and text[at - 3].isalnum()) and (end := _iban_at(text, at - 2)):
                    add("account", at - 2, end)
            if at >= ends["ip"] and (m := _IP.match(text, at)):
                ends["ip"] = m.end()
                if all(map(_part, m[0].split("."))):
                    add("ip", *m.span())
            if at >= ends["card"] and (m := _CARD.match(text, at)):
                ends["card"] = m.end()
                digits = m[0].translate(_NUMBER_JOINTS)
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    add("card", *m.span())
        elif anchor == "at":
            start = at
            while start > ends["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                add("email", start, m.end())
            elif start == at and (m := _HANDLE.match(text, at + 1)):
                if at == 0 or not (text[at - 1].isalnum() or text[at - 1] == "@"):
                    add("handle", at, m.end())
        elif anchor == "plus":
            if at >= ends["phone"] and (m := _PHONE.match(text, at)):
                ends["phone"] = m.end()
                if 9 <= len(m[0].translate(_NUMBER_JOINTS)) <= 15:
                    add("phone", *m.span())
        elif anchor == "street":
            if at >= ends["address"] and (found := streets.at(at, last + 1, ends["address"])):
                add("address", *found)
        elif at and low[at - 1].isalnum() and anchor != "scheme":
            continue  # a cue inside a word
        elif anchor == "scheme":
            if at >= ends["url"] and (m := _HOST.match(text, last + 1)):
                if "." in m[0] or m[0].startswith("localhost"):
                    whole = _URL.match(text, last + 1)[0]
                    add("url", at, last + 1 + len(whole.rstrip(".,;:!?)")))
        elif anchor == "key":
            if m := _ACCESS_KEY.match(text, at):
                add("secret", *m.span())
        elif anchor == "secret":
            if at >= ends["secret"] and (m := _SECRET.match(text, last + 1)):
                add("secret", *m.span(1))
        elif anchor == "account":
            if at < ends["account"]:
                continue
            gap = 0
            while gap < 3 and last + 1 + gap < len(text) and not text[last + 1 + gap].isalnum():
                gap += 1
            if m := _IBAN.match(text, last + 1 + gap):
                if _iban(m[0]):
                    add("account", *m.span())
            elif (m := _ACCOUNT.match(text, last + 1)) and sum(map(str.isdigit, m[1])) >= 6:
                add("account", *m.span(1))
    place = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (s[0], place[s[2]], s[1]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_spans(df: DataFrame, text_col: str = "text", into: str = "pii") -> DataFrame:
    """``df`` with one more column: an array of (kind, start, end, found)."""
    kind = "array<struct<kind:string,start:long,end:long,found:string>>"

    @F.pandas_udf(kind)
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = anchors()
        for batch in texts:
            yield pd.Series(
                [
                    [{"kind": k, "start": a, "end": b, "found": t[a:b]} for a, b, k in scan(t, automaton)]
                    for t in batch
                ]
            )

    return df.withColumn(into, found(whole_text(text_col)))


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the count of each base kind, the hash of the base spans and all spans as text."""
    names = [id_col, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    schema = StructType(
        [StructField(id_col, df.schema[id_col].dataType)]
        + [StructField(n, LongType()) for n in names[1:5]]
        + [StructField(n, StringType()) for n in names[5:]]
    )

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = anchors()
        for batch in batches:
            rows = []
            for text in batch.column(1):
                spans = scan(text.as_py(), automaton)
                base = [s for s in spans if s[2] in BASE]
                counts = [sum(s[2] == kind for s in base) for kind in BASE]
                sha = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*counts, sha, joined(spans)))
            columns = list(zip(*rows)) or [()] * 6
            types = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=names
            )

    return df.select(id_col, whole_text(text_col).alias("text")).mapInArrow(digested, schema)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))


QUERIES = {"op1_pii": op1_pii}
TWINS: dict[str, str] = {}
