"""Personal data and secrets replaced by keyed surrogates.

Detection marks spans in every text. A span's value has a normal form, its entity: names and
addresses in lower case, numbers without separators, IPv6 addresses in their short form. Distinct
entities of the corpus form a table; a surrogate is drawn from a keyed hash of the entity: digits
for digits, letters of the same script for letters, names of the gender the corpus most often gives
them, card numbers that keep issuer digit and check digit, phone numbers that keep the calling
code. The surrogate is then put into the form of each mention: its case, separators and trunk
prefix. So the same entity gets the same surrogate however it is written. A check over the table
finds surrogates that two entities share or that are themselves entities of the corpus; those
entities draw again until all are distinct. Formats with few values run out of free surrogates, so
after ``NARROW_DRAWS`` draws every further draw is one character (names: one syllable) longer.

Names are found behind a form of address or an introduction ("my name is"), Chinese ones in front
of a form of address; in the same text the words of a name are found again alone and with a
possessive ending. Names that no such words introduce are not found.

Defined cases: values without a letter or digit are no secrets; null text stays null; texts without entities stay as they are; repeated rows are
rewritten alike; an empty table gives an empty result; other columns are handed through.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgrid.llm.common import free_name, stored

SPANS = "array<struct<start:int,stop:int,kind:string,entity:string>>"
NARROW_DRAWS = 8

# fixed values: forms of address by gender, in the languages covered
TITLES = {
    "m": ["Mr", "Mister", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Signor", "господин", "г-н"],
    "f": ["Mrs", "Ms", "Frau", "Mme", "Madame", "Mademoiselle", "Mlle", "Señora", "Señorita", "Sra", "Signora", "госпожа", "г-жа"],
    "n": ["Dr", "Prof", "Professor"],
}
CAPITALS = {"MR": "m", "HERR": "m", "MRS": "f", "FRAU": "f"}
# fixed values: introductions of a name
INTRODUCTIONS = [
    "my name is", "full name:", "mein name ist", "ich heiße", "je m'appelle", "mon nom est", "me llamo", "mi nombre es",
    "mi chiamo", "il mio nome è", "меня зовут",
]
# fixed values: common Chinese family names, and forms of address behind a name
HAN_FAMILIES = "王李张刘陈杨赵黄周吴徐孙胡朱林郭马罗梁宋郑谢韩唐冯于董萧程曹袁邓许傅沈曾彭吕"
HAN_TITLES = {"先生": "m", "女士": "f", "小姐": "f", "太太": "f"}
# fixed values: calling codes of one and two digits; all others have three
CALLING_CODES = set(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 "
    "94 95 98".split()
)
GENDER = {t: g for g, titles in TITLES.items() for t in titles}
SECRET_WORDS = ["token", "password", "passwd", "pwd", "secret", "api_key", "apikey", "api-key", "access_key", "private_key"]

TITLE = "|".join(sorted(map(re.escape, GENDER), key=len, reverse=True))
#: up to three capitalised words that are no forms of address
NAMES = rf"(?P<name>\p{{Lu}}[\p{{L}}'’-]+(?:[ \xa0](?!(?:{TITLE}|{'|'.join(CAPITALS)})\b)\p{{Lu}}[\p{{L}}'’-]+){{0,2}})"
NAME = regex.compile(rf"(?<!\w)(?P<title>{TITLE})\.?[ \xa0]{NAMES}")
SHOUTED = regex.compile(rf"(?<!\w)(?P<title>{'|'.join(CAPITALS)})\.?[ \xa0]{NAMES.replace('{L}', '{Lu}')}(?!\w)")
INTRODUCED = regex.compile(rf"(?<!\w)(?i:{'|'.join(map(re.escape, INTRODUCTIONS))})[ \xa0]{NAMES}")
HAN_NAME = regex.compile(rf"(?P<name>[{HAN_FAMILIES}]\p{{Han}}{{0,2}})(?P<title>{'|'.join(HAN_TITLES)})")
WORD = regex.compile(r"[\p{L}'’-]+")
#: a word without quotes around it and without a possessive ending
BARE = regex.compile(r"['’-]*+(.*?)(?:['’][sS])?['’-]*$")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
SECRET = re.compile(
    r"(?<![A-Za-z0-9])(?:" + "|".join(SECRET_WORDS) + r")\"?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9+/_\-]{6,}={0,2})", re.I
)
KEYS = re.compile(
    r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{16,}|xox[abpr]-[A-Za-z0-9-]{10,}"
    r"|AIza[0-9A-Za-z_-]{35}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})(?![A-Za-z0-9])"
)
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
IP = re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)")
IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{1,4})?(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:]|\.\w)")
SSN = re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")
PHONE = re.compile(
    r"(?<![\w.+-])(?:(?:\+|00)\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(?\d{3}\)?[ .-]\d{3}[ .-]\d{4})(?![\w-])"
)
CARD = re.compile(r"(?<![\w.+-])(?!00)\d(?:[ -]?\d){12,18}(?![\w-])")
DIGIT = re.compile(r"\d")
ALNUM = re.compile(r"[A-Za-z0-9]")

# fixed values: sounds of surrogate names by script, and endings by gender
SOUNDS = {
    "latin": ("bdfgklmnprstv", "aeiou", {"m": ["en", "or", "us"], "f": ["a", "ia", "ine"], "n": ["er", "el", "is"]}),
    "cyrillic": ("бвгдзклмнпрст", "аеиоу", {"m": ["ин", "ов", "ей"], "f": ["а", "ия", "ина"], "n": ["ер", "ель", "ис"]}),
    "greek": ("βγδκλμνπρστφχ", "αειου", {"m": ["ος", "ης", "ων"], "f": ["α", "η", "ια"], "n": ["ερ", "ελ", "ις"]}),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        k = int(d) * (1 + i % 2)
        total += k - 9 if k > 9 else k
    return total % 10 == 0


def _digits(value: str) -> str:
    return "".join(str(int(c)) for c in value if c.isdecimal())


def _is_ipv6(value: str) -> bool:
    if not DIGIT.search(value) or sum(map(bool, value.split(":"))) < 3:
        return False  # as in a::b, or too little to tell an address
    try:
        return bool(ipaddress.IPv6Address(value))
    except ValueError:
        return False


def entity(kind: str, value: str) -> str:
    """Normal form of a value, the same for all its spellings."""
    if kind.startswith("name"):
        return value.lower().replace("’", "'")
    if kind == "email":
        return value.lower()
    if kind == "ip":
        return str(ipaddress.IPv6Address(value)) if ":" in value else ".".join(str(int(x)) for x in value.split("."))
    if kind == "iban":
        return "".join(c for c in value if c.isalnum()).upper()
    if kind in ("card", "ssn"):
        return _digits(value)
    if kind == "phone":
        digits = _digits(value)
        if value[0] != "+" and not digits.startswith("00"):
            return digits
        digits = digits.removeprefix("00")
        return digits[1:] if len(digits) == 11 and digits[0] == "1" else "+" + digits
    return value


def _names(text: str, lowered: str) -> Iterator[tuple[int, int, str]]:
    """(start, stop, kind) of names, introduced ones first, then their words wherever they stand."""
    known: dict[str, str] = {}
    introduced = []
    if any(t in text for t in GENDER):
        introduced += [(m, GENDER[m["title"]]) for m in NAME.finditer(text)]
    if any(t in text for t in CAPITALS):
        introduced += [(m, CAPITALS[m["title"]]) for m in SHOUTED.finditer(text)]
    if any(t in lowered for t in INTRODUCTIONS):
        introduced += [(m, "n") for m in INTRODUCED.finditer(text)]
    for m, gender in introduced:
        parts = [(w.start() + m.start("name") + b.start(1), b[1]) for w in WORD.finditer(m["name"]) if (b := BARE.match(w[0]))[1]]
        for i, (at, word) in enumerate(parts):
            kind = known.setdefault(entity("name", word), "name_family" if i == len(parts) - 1 else f"name_given_{gender}")
            yield at, at + len(word), kind
    if known:  # the same person named again without a title
        for m in WORD.finditer(text):
            word = BARE.match(m[0])
            if m[0] and word[1][:1].isupper() and (kind := known.get(entity("name", word[1]))):
                yield m.start() + word.start(1), m.start() + word.end(1), kind
    if any(t in text for t in HAN_TITLES):
        han = {m["name"]: "name_given_" + HAN_TITLES[m["title"]] for m in HAN_NAME.finditer(text)}
        for m in HAN_NAME.finditer(text):
            yield m.start("name"), m.end("name"), han[m["name"]]
        whole = sorted((x for x in han if len(x) > 1), key=len, reverse=True)
        for m in regex.finditer(r"\L<whole>", text, whole=whole) if whole else ():
            yield m.start(), m.end(), han[m[0]]


def find_spans(text: str | None) -> list[tuple[int, int, str, str]]:
    """Spans (start, stop, kind, entity) in order and without overlaps."""
    if not text:
        return []
    found: list[tuple[int, int, str, str]] = []
    starts: list[int] = []
    stops: list[int] = []

    def add(start: int, stop: int, kind: str) -> None:
        i = bisect_right(starts, start)
        if (i == 0 or stops[i - 1] <= start) and (i == len(starts) or stop <= starts[i]):
            starts.insert(i, start)
            stops.insert(i, stop)
            found.append((start, stop, kind, entity(kind, text[start:stop])))

    lowered = text.lower()
    for m in SECRET.finditer(text) if any(w in lowered for w in SECRET_WORDS) else ():
        if DIGIT.search(m[1]) or (len(m[1]) >= 12 and ALNUM.search(m[1])):
            add(m.start(1), m.end(1), "secret")
    for m in EMAIL.finditer(text) if "@" in text else ():
        add(m.start(), m.end(), "email")
    if DIGIT.search(text):
        for pattern, kind in ((KEYS, "secret"), (IBAN, "iban"), (IP, "ip"), (IPV6, "ip"), (SSN, "ssn"), (CARD, "card"), (PHONE, "phone")):
            for m in pattern.finditer(text):
                digits = re.sub(r"\D", "", m[0])
                if kind == "card" and not (luhn(digits) or (len(digits) in (15, 16) and digits[0] in "3456")):
                    continue
                if (kind == "iban" and len(digits) < 8) or (pattern is IPV6 and not _is_ipv6(m[0])):
                    continue
                add(m.start(), m.end(), kind)
    for start, stop, kind in _names(text, lowered):
        add(start, stop, kind)
    return sorted(found)


class Draw:
    """Bounded integers from a keyed hash."""

    def __init__(self, key: bytes, *parts: object) -> None:
        self.key, self.seed, self.block, self.pool = key, "\x1f".join(map(str, parts)).encode(), 0, 0

    def below(self, n: int) -> int:
        if self.pool < n << 64:
            word = hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.pool, self.block = int.from_bytes(word, "big"), self.block + 1
        self.pool, r = divmod(self.pool, n)
        return r

    def like(self, text: str) -> str:
        """Same length, every letter and digit replaced within its class."""
        hexadecimal = len(text) >= 8 and bool(re.fullmatch(r"(?=.*[a-f])(?=.*[0-9])[0-9a-f]+", text))
        out = []
        for c in text:
            if hexadecimal:
                out.append("0123456789abcdef"[self.below(16)])
            elif c.isdecimal():
                zero = ord(c) - int(c)
                out.append(chr(zero + self.below(10)))
            elif "a" <= c <= "z":
                out.append(chr(97 + self.below(26)))
            elif "A" <= c <= "Z":
                out.append(chr(65 + self.below(26)))
            elif c.isalpha():
                new = c
                for _ in range(20):  # another letter of the block with the same case
                    x = chr((ord(c) & ~31) + self.below(32))
                    if x.isalpha() and x.isupper() == c.isupper() and x.islower() == c.islower():
                        new = x
                        break
                out.append(new)
            else:
                out.append(c)
        return "".join(out)


def _name(draw: Draw, kind: str, word: str, extra: int = 0) -> str:
    script = "cyrillic" if regex.search(r"\p{Cyrillic}", word) else "greek" if regex.search(r"\p{Greek}", word) else "latin"
    if not regex.search(r"[\p{Latin}\p{Cyrillic}\p{Greek}]", word):
        return draw.like(word + regex.findall(r"\p{L}", word)[-1].lower() * extra)
    if regex.search(r"[-'’]", word.strip("-'’")):
        return regex.sub(r"\p{L}+", lambda m: _name(draw, kind, m[0], extra), word)
    consonants, vowels, endings = SOUNDS[script]
    size = max(2, min(4, len(word) // 2))
    stem = "".join(consonants[draw.below(len(consonants))] + vowels[draw.below(len(vowels))] for _ in range(size + extra))
    stem += consonants[draw.below(len(consonants))]
    ending = endings[kind[-1]]
    return stem + ending[draw.below(len(ending))]


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """Draw number ``attempt`` of the surrogate of entity ``value``; names have the kinds name_m, name_f and name_n."""
    draw = Draw(key, kind.split("_")[0], value, attempt)
    extra = max(0, attempt - NARROW_DRAWS + 1)
    if kind.startswith("name_"):
        return _name(draw, kind, value, extra)
    if kind == "email":
        local, _, domain = value.rpartition("@")
        labels = domain.split(".")
        kept = 2 if re.search(r"(?:^|\.)example\.(?:com|net|org)$", domain) else 1
        front = Draw(key, "domain", domain).like(".".join(labels[:-kept]))  # the same host for all its addresses
        return draw.like(local + "a" * extra) + "@" + ".".join([*([front] if front else []), *labels[-kept:]])
    if kind == "ip" and ":" in value:
        first, *groups = ipaddress.IPv6Address(value).exploded.split(":")
        new = [format(draw.below(0xFFFF) + 1, "04x") if int(g, 16) or i == 6 else g for i, g in enumerate(groups)]
        return str(ipaddress.IPv6Address(":".join([first, *new]))) + ("/" + draw.like("0" * extra) if extra else "")
    if kind == "ip":
        new = ".".join(str(1 + draw.below(223) if i == 0 else draw.below(254) + (i == 3)) for i in range(4))
        return new + (":" + draw.like("0" * extra) if extra else "")  # a port, as an address has no more digits
    value += next((c for c in reversed(value) if c.isalnum()), "0") * extra
    if kind == "card":
        out = value[0] + draw.like(value[1:])
        return next(x for d in "0123456789" if luhn(x := out[:-1] + d)) if luhn(value) else out
    if kind == "phone":
        code = value[1:4]
        kept = 1 + next((k for k in (1, 2) if code[:k] in CALLING_CODES), 3) if value[0] == "+" else 0
        rest = draw.like(value[kept:])
        return value[:kept] + (str(2 + draw.below(8)) + rest[1:] if rest[:1] in ("0", "1") else rest)
    if kind == "iban":
        return value[:2] + draw.like(value[2:])
    fixed = re.match(r"AKIA|ASIA|gh[pousr]_|sk-|xox[abpr]-|AIza|eyJ|", value)[0]
    return fixed + draw.like(value[len(fixed) :])


def in_form(kind: str, value: str, new: str) -> str:
    """Surrogate ``new`` written as the mention ``value`` is."""
    if kind == "name":
        new = new.replace("'", "’") if "’" in value else new
        if value.isupper() and len(value) > 1:
            return new.upper()
        return regex.sub(r"\p{L}+", lambda m: m[0].capitalize(), new) if value[:1].isupper() else new
    if kind == "email":
        if len(value) == len(new):
            return "".join(n.upper() if v.isupper() else n for v, n in zip(value, new, strict=True))
        return new.upper() if value.isupper() else new
    if kind not in ("card", "ssn", "iban", "phone"):
        return new
    out, rest = list(value), new.removeprefix("+")
    places = [i for i, c in enumerate(value) if c.isalnum()]
    for i in reversed(places):  # from the right, so that a trunk prefix stays
        if rest:
            out[i], rest = chr(ord(value[i]) - int(value[i]) + int(rest[-1])) if value[i].isdecimal() and rest[-1].isdecimal() else rest[-1], rest[:-1]
    return "".join([*out[: places[0]], rest, *out[places[0] :]])


def detect(text: Column) -> Column:
    """Spans of a text column."""

    @F.pandas_udf(SPANS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = ("start", "stop", "kind", "entity")
        for batch in batches:
            yield pd.Series([[dict(zip(names, s, strict=True)) for s in find_spans(x)] for x in batch], dtype="object")

    return run(text)


def rewritten(text: str, spans: list) -> str:
    parts, at = [], 0
    for s in sorted(spans, key=lambda s: s["start"]):
        parts += [text[at : s["start"]], in_form(s["kind"], text[s["start"] : s["stop"]], s["new"])]
        at = s["stop"]
    return "".join([*parts, text[at:]])


def rewrite(text: Column, spans: Column) -> Column:
    """Text with ``new`` in the place of every span."""

    @F.pandas_udf("string")
    def run(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([rewritten(t, s) for t, s in zip(text, spans, strict=True)], dtype="object")

    return run(text, spans)


def assign(entities: DataFrame, key: str) -> DataFrame:
    """Distinct surrogates for distinct (kind, value); none is an entity itself."""

    @F.pandas_udf("string")
    def draw(kind: pd.Series, value: pd.Series, attempt: pd.Series) -> pd.Series:
        rows = zip(kind, value, attempt, strict=True)
        return pd.Series([surrogate(key.encode(), k, v, int(a)) for k, v, a in rows], dtype="object")

    waiting, given, attempt = entities, None, 0
    while True:
        drawn = waiting.withColumn("new", draw("kind", "value", F.lit(attempt)))
        first = drawn.groupBy("new").agg(F.min(F.struct("kind", "value")).alias("first"))
        fresh = first.join(entities.select(F.col("value").alias("new")), "new", "left_anti")
        if given is not None:
            fresh = fresh.join(given.select("new"), "new", "left_anti")
        passed = stored(fresh.select("first.*", "new"), "surrogates")
        given = passed if given is None else given.unionByName(passed)
        waiting = entities.join(given, ["kind", "value"], "left_anti")
        attempt += 1
        if waiting.isEmpty():
            return given


def replace_pii(docs: DataFrame, key: str, count: str = "n_entities") -> DataFrame:
    """``docs`` with rewritten ``text`` and the number of entities in the column ``count``."""
    row, spans = free_name(docs.columns, "row"), free_name(docs.columns, "spans")
    news = free_name(docs.columns, "news")
    out = docs.columns
    marked = stored(docs.withColumns({row: F.monotonically_increasing_id(), spans: detect(F.col("text"))}), "pii-spans")
    hit = F.size(spans) > 0
    spots = marked.filter(hit).select(F.col(row).alias("row"), F.explode(spans).alias("s")).select("row", "s.*")
    men, women = (F.count_if(F.col("kind") == f"name_given_{g}") for g in "mf")
    gender = F.when(men > women, "_m").when(women > men, "_f").otherwise("_n")
    base = F.substring_index("kind", "_", 1)
    entities = spots.groupBy(base.alias("base"), F.col("entity").alias("value")).agg(gender.alias("gender"))
    kinds = F.concat("base", F.when(F.col("base") == "name", F.col("gender")).otherwise("")).alias("kind")
    given = assign(stored(entities.select(kinds, "value"), "pii-entities"), key).withColumn("base", base)
    named = spots.select("row", "start", "stop", base.alias("base"), F.col("entity").alias("value")).join(given.drop("kind"), ["base", "value"])
    per_row = named.groupBy(F.col("row").alias(row)).agg(F.collect_list(F.struct("start", "stop", F.col("base").alias("kind"), "new")).alias(news))
    changed = marked.filter(hit).join(per_row, row)
    clean = marked.filter(~F.coalesce(hit, F.lit(False)))
    return changed.select(
        *[rewrite(F.col("text"), F.col(news)).alias(c) if c == "text" else c for c in out], F.size(spans).cast("long").alias(count)
    ).unionByName(clean.select(*out, F.lit(0).cast("long").alias(count)))
