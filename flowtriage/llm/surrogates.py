r"""Operator 2, personal data replaced by keyed surrogates.

Detected: e-mail addresses, IPv4 and IPv6 addresses, phone numbers (with + or
brackets, national ones with a leading 0, 1 or 8 or in the usual groups, others
behind a word such as "call"), payment card and social security numbers, IBANs,
persons behind a title (as usually written, in capitals, or abbreviated in small
letters with a point) and their names wherever the same text says them again with
a capital, and secrets (access keys; passwords and tokens of six characters or
more behind their word, in any case and quoted or not; bearer tokens; user and
password in a URL).  Every distinct entity of the corpus, in canonical
form (lower-case address, digits of a number, a single name), gets one
surrogate drawn from a keyed SHA-256, so all its mentions are replaced alike
whatever their punctuation or case, and nobody without the key can undo it.

Surrogates keep type and format: punctuation, letter case, country code, card
network and Luhn check, octet ranges, the top-level domain, prefixes of keys.
A name's surrogate is a given name of the title's gender and a surname whose
vowels and consonants stay vowels and consonants of the same script; since
names are replaced one by one, "Mr. Smith" and "Mr. John Smith" stay related.

Collisions: a surrogate that two entities drew, or that is itself an entity of
the corpus, is drawn anew by all but its smallest entity, until surrogates are
distinct.  Surrogate spaces that run short are widened after six draws, those
of fixed formats after twelve, and grow with each further draw (names by names
or letters, addresses, numbers and secrets by signs, IPv4 into IPv6), so the
draws end whatever the corpus holds.  Secrets of signs alone get other signs.

Texts and entities may be of any length; what repeats is matched by character
classes or a bounded number of groups, so no text exhausts the engine's stack.

Null text stays null, text without entities stays as it is.  Rows are matched
by id and text, so repeated rows get the same result; null ids and empty tables
are fine; input columns named as the results are replaced.

Scale: native functions only.  The expensive pattern runs on texts that pass a
cheap one.  Mentions are exploded without the text; distinct entities are
pre-aggregated per task, so a mention in every document is no hot key there,
and their table is broadcast only if its measured size allows it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, materialise, row_key

#: Titles by the gender they tell.
MALE = ("Mr", "Sir", "Herr", "Herrn", "Señor", "Sr", "Monsieur", "Signor")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Señora", "Sra", "Madame", "Mme", "Mlle", "Signora")
NEUTRAL = ("Dr", "Prof")

#: Given names to draw from, by gender and script.
GIVEN = {
    ("m", "latin"): "Adam Albert Anton Arthur Bruno Carl Daniel David Edgar Emil Felix Frank Georg Hugo Ivan Jakob Julian Karl Leo Lucas Marco Martin Max Nico Oscar Paul Peter Ralf Robert Simon Thomas Victor".split(),
    ("f", "latin"): "Ada Alice Amelia Anna Bella Clara Diana Elena Elisa Emma Eva Flora Greta Helena Ida Irene Jana Julia Laura Lea Lina Lucia Maria Marta Mira Nina Nora Olga Paula Rosa Sara Vera".split(),
    ("n", "latin"): "Alex Andrea Ariel Charlie Dana Eden Jamie Jona Jules Kai Kim Luca Marlin Mika Morgan Noel Quinn Robin Sascha Sidney Toni Yael".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Максим Олег Павел Роман".split(),
    ("f", "cyrillic"): "Алина Анна Вера Дарья Елена Инна Ирина Лидия Мария Нина Ольга Софья".split(),
    ("n", "cyrillic"): "Валя Женя Саша Слава Тоня Шура".split(),
}

#: One character class per run, since Java's engine recurses for every repeat of a group.
_NAME = r"\p{Lu}[\p{L}'’\-]*(?<=\p{L})"
_WORDY = r"A-Za-z0-9"
_ANY_WORDY = r"\p{L}\p{N}"
_SHORT_TITLES = ("mr", "mrs", "ms", "dr", "prof", "sr", "sra", "mme", "mlle")
#: Titles as usually written and in capitals; abbreviations in small letters too, with their point.
_TITLE = "(?:(?:" + "|".join(t for n in MALE + FEMALE + NEUTRAL for t in (n, n.upper())) + ")\\.?|(?:" + "|".join(_SHORT_TITLES) + ")\\.)"
_HEX4 = "[0-9A-Fa-f]{1,4}"
#: A secret's word with what stands between it and the value, and the word before a phone number.
_WORD = r"(?i:password|passwd|passphrase|passcode|pwd|secret(?:[_\- ]?(?:access[_\- ]?)?key)?|token|(?:api|access|private)[_\- ]?key)\\?[\"']?(?:[ \t]{0,8}|\s)(?:=>|:=|[=:])(?:[ \t]{0,8}|\s)\\?[\"']?"
_BEARER = r"(?i:bearer)[ \t]{1,8}"
#: "password is", whose value must hold a digit
_IS = r"(?i:password|passwd|passphrase|passcode|pwd|token)[ \t]{1,8}(?i:is)[ \t:]{1,8}[\"']?"
_CUE = r"(?i:telephone|telefon|tel|phone|mobile|call|cell|fax|тел)[.:]{0,2} ?"
PATTERNS = {
    # user and password of an address come before the e-mail that they look like; a domain has at most 127 labels
    "login": r"://[^\s/:@]{1,256}:[^\s/@]{1,256}@",
    "email": rf"(?<![{_ANY_WORDY}._%+\-])[{_ANY_WORDY}._%+\-]++@[{_ANY_WORDY}\-]+(?:\.[{_ANY_WORDY}\-]+){{0,125}}\.\p{{L}}{{2,}}",
    "secret": rf"(?<![{_WORDY}])(?:(?:AKIA|ASIA)[A-Z0-9]{{16}}|gh[pousr]_[{_WORDY}]{{30,}}|sk-[{_WORDY}\-]{{20,}})(?![{_WORDY}])|{_WORD}[^\s\"',;]{{6,}}(?![{_WORDY}])|{_BEARER}[{_WORDY}._~+/=\-]{{16,}}|{_IS}(?=\S*\d)[^\s\"',;]{{6,}}(?![{_WORDY}])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![A-Za-z0-9.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![A-Za-z0-9]|\.\d)",
    # short forms need a digit or a third group, so that a::b of program code stays
    "ip6": rf"(?<![A-Za-z0-9:.])(?:(?:{_HEX4}:){{7}}{_HEX4}|(?=[A-Fa-f:]*[0-9]|(?:{_HEX4}:{{1,2}}){{2}}{_HEX4})(?:{_HEX4}:){{1,6}}(?::{_HEX4}){{1,6}}|(?=[A-Fa-f:]*[0-9])(?:{_HEX4}:){{2,7}}:|::(?:{_HEX4}:){{1,6}}{_HEX4})(?![A-Za-z0-9:]|\.\d)",
    "card": r"(?<![A-Za-z0-9.\-])\d{4}(?:[ \-]?\d{4}){2}[ \-]?\d{1,7}(?![A-Za-z0-9\-])",
    "ssn": r"(?<![A-Za-z0-9.\-])\d{3}-\d{2}-\d{4}(?![A-Za-z0-9\-])",
    "phone": r"(?<![A-Za-z0-9.\-])(?:(?:\+\d{1,3}|[18])[ .\-]?)?(?:\(\d{2,5}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}|(?:\(\d{2,5}\)|\d{3})[ .\-]?\d{3}[ .\-]\d{2}[ .\-]\d{2}|\d{3}[ .\-]\d{3}[ .\-]\d{4})(?![A-Za-z0-9\-])"
    r"|(?<![A-Za-z0-9.\-])\+\d{1,3}(?:[ .\-]?\d{2,4}){2,5}(?![A-Za-z0-9\-])"
    # leading 0 and at least nine digits, which dates don't have; Chinese mobile numbers
    r"|(?<![A-Za-z0-9.\-])(?=0(?:[ .\-]?\d){8})(?:0[1-9](?:[ .\-]\d{2}){4}|0\d{1,4}[ .\-]\d{3,4}[ .\-]\d{3,5}|0\d{2,5}[ \-]\d{5,8}|0\d{1,4}(?: \d{2,4}){2,4})(?![A-Za-z0-9\-])"
    r"|(?<![A-Za-z0-9.\-])1[3-9]\d[ \-]\d{4}[ \-]\d{4}(?![A-Za-z0-9\-])"
    rf"|(?<![A-Za-z0-9]){_CUE}(?!\d{{4}}-\d\d-\d\d)\d(?:[ \-]?\d){{6,12}}(?![A-Za-z0-9]|[ .\-]\d)",
    "person": rf"(?<![\p{{L}}])(?:{_TITLE} {_NAME}(?: {_NAME}){{0,2}}|(?:г-н|г-жа|господин|госпожа) {_NAME}(?: {_NAME}){{0,2}})",
}
_LONE_NAME = rf"(?<![\p{{L}}]){_NAME}"
ANY = "(?:" + "|".join(PATTERNS.values()) + ")"
#: What every entity contains; checked first.
HINT = rf"[0-9@]|[=:]\s{{0,8}}\S|{_TITLE} \p{{Lu}}|{_BEARER}|г-|оспо"

_CLASSES = (
    # (a character of the class, what it is replaced by) for single names
    ("[aeiouyáàâäéèêëíìîïóòôöúùûü]", "aeiou"), ("[AEIOUYÁÀÂÄÉÈÊËÍÌÎÏÓÒÔÖÚÙÛÜ]", "AEIOU"),
    ("[аеёиоуыэюя]", "аеиоу"), ("[АЕЁИОУЫЭЮЯ]", "АЕИОУ"),
    ("[а-я]", "бвгдзклмнпрст"), ("[А-Я]", "БВГДЗКЛМНПРСТ"),
    (r"[\p{Ll}]", "bcdfghjklmnprstvwz"), (r"[\p{Lu}]", "BCDFGHJKLMNPRSTVWZ"),
)
_PLAIN = (("[0-9]", "0123456789"), ("[a-z]", "abcdefghijklmnopqrstuvwxyz"), ("[A-Z]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
#: For secrets: letters of other scripts too; for those without any letter or digit, signs.
_LETTERS = (
    *_PLAIN, ("[а-яё]", "абвгдежзиклмнопрстуфхцчшэюя"), ("[А-ЯЁ]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    (r"[\p{Lu}]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (r"[\p{L}]", "abcdefghijklmnopqrstuvwxyz"), (r"[\p{N}]", "0123456789"),
)
_SIGNS = (("(?s).", "!#$%&()*+-./<>?@[]^_{|}~"),)
#: Draws after which formats with a suffix, and fixed formats, grow.
WIDE, FULL = 6, 12
_HEX = (("[0-9a-f]", "0123456789abcdef"), *_PLAIN)


def _draw(seed: Column, *more) -> Column:
    """A number from 0 to 2**32 - 1 that the keyed hash gives."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", seed, *more), 256), 1, 8), 16, 10).cast("long")


def _pick(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), (n % len(alphabet) + 1).cast("int"), F.lit(1))


def _spell(value: Column, seed: Column, classes) -> Column:
    """Each character replaced by one of its class, drawn by its place; others stay."""

    def one(c, i):
        n = _draw(seed, i)
        return reduce(lambda rest, k: F.when(c.rlike(f"^{k[0]}$"), _pick(k[1], n)).otherwise(rest), reversed(classes), c)

    return F.array_join(F.transform(F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0)), one), "")


def _more(seed: Column, size: Column, *alphabets: str) -> Column:
    """``size`` further characters, drawn from the alphabets in turn; none if ``size`` is below 1."""

    def one(i):
        n = _draw(seed, F.lit("more"), i)
        return reduce(lambda rest, j: F.when(i % len(alphabets) == j, _pick(alphabets[j], n)).otherwise(rest), range(len(alphabets) - 1), _pick(alphabets[-1], n))

    places = F.when(size > 0, F.sequence(F.lit(0), F.greatest(size, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of digits."""
    chars = F.reverse(F.regexp_extract_all(digits, F.lit("."), F.lit(0)))

    def add(acc, x):
        n = x["d"].cast("int") * F.when(x["i"] % 2 == 1, 2).otherwise(1)
        return acc + F.when(n > 9, n - 9).otherwise(n)

    return F.aggregate(F.transform(chars, lambda d, i: F.struct(d.alias("d"), i.alias("i"))), F.lit(0), add) % 10


def _octets(value: Column, seed: Column, wide: Column) -> Column:
    def one(o, i):
        n, size = _draw(seed, i), F.char_length(o)
        kept = F.when(size == 1, 1 + n % 9).when(size == 2, 10 + n % 90).otherwise(100 + n % 155)
        return F.when(wide, 1 + n % 254).otherwise(kept).cast("string")

    return F.array_join(F.transform(F.split(value, r"\.", -1), one), ".")


def _sixth(value: Column, seed: Column) -> Column:
    """Groups of an expanded IPv6 address redrawn; zero groups and lengths stay."""

    def one(g, i):
        base = F.element_at(F.array(F.lit(1), F.lit(16), F.lit(256), F.lit(4096)), F.char_length(g))
        return F.when(g == "0", g).otherwise(F.lower(F.hex(base + _draw(seed, i) % (base * 15))))

    return F.array_join(F.transform(F.split(value, ":", -1), one), ":")


def _expanded(address: Column) -> Column:
    """The eight groups of an IPv6 address in lower case, without leading zeros."""
    low = F.lower(address)

    def groups(x):
        return F.transform(F.filter(F.split(x, ":", -1), lambda g: g != ""), lambda g: F.regexp_replace(g, "^0+(?=.)", ""))

    left, right = groups(F.substring_index(low, "::", 1)), groups(F.substring_index(low, "::", -1))
    filled = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0))), right)
    return F.array_join(F.when(F.contains(low, F.lit("::")), filled).otherwise(left), ":")


def _groups(seed: Column) -> Column:
    """A whole IPv6 address of the local range."""
    return F.concat(F.lit("fd00"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(7)), lambda i: F.concat(F.lit(":"), F.lower(F.hex(4096 + _draw(seed, i) % 61440)))), ""))


def _given(kind: str, script: str, seed: Column, attempt: Column) -> Column:
    names = F.array(*[F.lit(n) for n in GIVEN[kind, script]])

    def pick(j):
        return F.element_at(names, (_draw(seed, j) % len(GIVEN[kind, script]) + 1).cast("int"))

    # distinct given names outnumber the list: one name, then double names, then one more with each draw
    n = F.when(attempt < 3, 1).when(attempt < 7, 2).otherwise(attempt - 4)
    return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), pick), "-")


def _surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The draw number ``attempt`` for an entity."""
    seed = F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string"))
    wide = attempt >= WIDE
    longer, full = attempt - WIDE + 1, attempt - FULL + 1  # characters that wide and fixed formats are longer by
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    host_seed = F.concat_ws("|", F.lit(key), F.lit("domain"), domain)
    host = F.regexp_extract(domain, r"^(.*)\.([^.]+)$", 1)
    email = F.concat(
        _spell(local, seed, _LETTERS), _more(seed, longer, "bcdfghklmnprstvwz"),
        F.lit("@"), _spell(host, host_seed, _LETTERS), F.lit("."), F.regexp_extract(domain, r"^(.*)\.([^.]+)$", 2),
    )
    digits = _more(seed, full, "0123456789")
    body = _spell(canon, seed, (("[0-9]", "0123456789"),))
    card = F.concat(F.substring(canon, 1, 1), F.substring(body, F.lit(2), F.char_length(canon) - 2), digits)
    check = (10 - _luhn(F.concat(card, F.lit("0")))) % 10
    card = F.concat(card, F.when(_luhn(canon) == 0, check.cast("string")).otherwise(F.substring(body, F.char_length(canon), F.lit(1))))
    code = F.regexp_extract(canon, r"^(\+\d*?|0)(\d{0,10})$", 1)  # canonical phones keep the country code or 0 in front
    phone = F.concat(code, F.substring(body, F.char_length(code) + 1, F.char_length(canon)), digits)
    secret = F.when(canon.rlike("^[0-9a-f]+$"), _spell(canon, seed, _HEX)).when(canon.rlike(r"[\p{L}\p{N}]"), _spell(canon, seed, _LETTERS))
    secret = F.concat(secret.otherwise(_spell(canon, seed, _SIGNS)), _more(seed, longer, "0123456789abcdef"))
    iban = F.concat(F.substring(canon, 1, 2), _spell(F.substring(canon, F.lit(3), F.char_length(canon)), seed, _PLAIN), digits)
    tail = F.when(canon.rlike(r"\p{IsCyrillic}"), _more(seed, longer + 1, "аеиоу", "лмнрст")).otherwise(_more(seed, longer + 1, "aeiou", "lmnrst"))
    family = F.concat(_spell(canon, seed, _CLASSES), F.when(wide, tail).otherwise(F.lit("")))
    ip = F.when(attempt < FULL, _octets(canon, seed, wide)).otherwise(_groups(seed))
    out = F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "ip6", F.when(wide, _groups(seed)).otherwise(_sixth(canon, seed))).when(kind == "card", card).when(kind == "phone", phone)
    out = out.when(kind == "ssn", F.concat(body, digits)).when(kind == "iban", iban).when(kind == "secret", secret).when(kind == "family", family)
    for gender, script in GIVEN:
        out = out.when(kind == f"given-{gender}-{script}", F.lower(_given(gender, script, seed, attempt)))
    return out


def _kind(match: Column) -> Column:
    """Type of a whole match, tried in the order of the joint pattern."""
    out = None
    for name, pattern in PATTERNS.items():
        cond = match.rlike(f"^(?:{pattern})$")
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def _parts(match: Column, kind: Column) -> Column:
    """array of (pre, kind, canon, said): what of a match is replaced (``said``), its entity, and what stands before it."""

    def part(pre, kind, canon, said):
        return F.struct(pre.alias("pre"), kind.alias("kind"), canon.alias("canon"), said.alias("said"))

    digits = F.regexp_replace(match, r"\D", "")
    empty = F.lit("")
    nothing = F.lit(None).cast("string")
    label = F.regexp_extract(match, rf"^((?:AKIA|ASIA)|{_WORD}|gh[pousr]_|sk-|{_BEARER}|{_IS}|://)(.*)$", 1)
    rest = F.substring(match, F.char_length(label) + 1, F.char_length(match))
    cue = F.regexp_extract(match, f"^{_CUE}", 0)
    number = F.substring(match, F.char_length(cue) + 1, F.char_length(match))
    # 1 800 555 1234 is +1 800 555 1234
    plus = F.when(match.startswith("+") | digits.rlike(r"^1[2-9]\d{9}$") & ~number.rlike(r"^\d{3}\D"), "+").otherwise("")
    tokens = F.split(match, " ", -1)
    title = F.lower(F.regexp_replace(F.element_at(tokens, 1), r"\.$", ""))
    male, female = [t.lower() for t in (*MALE, "г-н", "господин")], [t.lower() for t in (*FEMALE, "г-жа", "госпожа")]
    gender = F.when(title.isin(*male), "m").when(title.isin(*female), "f").otherwise("n")

    def name(x, i):
        script = F.when(x.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
        last = i == F.size(tokens) - 1
        kind_of = F.when(i == 0, nothing).when(last, F.lit("family")).otherwise(F.concat_ws("-", F.lit("given"), gender, script))
        return part(F.when(i == 0, empty).otherwise(F.lit(" ")), kind_of, F.when(i > 0, F.lower(x)), x)

    def alone(k, canon):
        return F.array(part(empty, F.lit(k), canon, match))

    return (
        F.when(kind == "person", F.transform(tokens, name))
        .when(kind.isin("secret", "login"), F.array(part(label, F.lit("secret"), rest, rest)))
        .when(kind == "email", alone("email", F.lower(match)))
        .when(kind == "ip", alone("ip", match))
        .when(kind == "ip6", alone("ip6", _expanded(match)))
        .when(kind == "phone", F.array(part(cue, kind, F.concat(plus, digits), number)))
        .when(kind == "iban", alone("iban", F.replace(match, F.lit(" "), F.lit(""))))
        .when(kind.isin("card", "ssn"), F.array(part(empty, kind, digits, match)))
        .otherwise(F.array(part(empty, nothing, nothing, match)))
    )


def _as_said(said: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the mention."""

    def filled(sign):
        """Characters of the surrogate put in the places of ``said`` that match ``sign``."""
        chars = F.regexp_extract_all(said, F.lit("(?s)."), F.lit(0))
        start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))

        def put(acc, c):
            use = c.rlike(sign)
            return F.struct(
                F.concat(acc["text"], F.when(use, F.substring(values, acc["at"], F.lit(1))).otherwise(c)).alias("text"),
                (acc["at"] + use.cast("int")).alias("at"),
            )

        # a surrogate with more characters than places goes on after the last one
        return F.aggregate(chars, start, put, lambda acc: F.concat(acc["text"], F.substring(values, acc["at"], F.char_length(values))))

    values = F.translate(surrogate, "+", "")
    groups = F.when(F.contains(said, F.lit("::")), F.regexp_replace(surrogate, "^(.*?)(?:^|:)0(?::0)*(?:$|:)", "$1::"))
    groups = groups.when(said.rlike("(?i)(?:^|:)0[0-9a-f]{3}(?:$|:)"), F.array_join(F.transform(F.split(surrogate, ":", -1), lambda g: F.lpad(g, 4, "0")), ":")).otherwise(surrogate)
    upper = F.when((said == F.upper(said)) & (F.char_length(said) > 1), F.upper(surrogate))
    return (
        F.when(kind.isNull(), said)
        .when(kind.isin("phone", "card", "ssn"), filled("[0-9]"))
        .when(kind == "iban", filled("[A-Z0-9]"))
        .when(kind == "ip6", F.when(said.rlike("[A-F]"), F.upper(groups)).otherwise(groups))
        .when(kind == "email", upper.otherwise(surrogate))
        .when(kind == "family", upper.otherwise(F.concat(F.upper(F.substring(surrogate, 1, 1)), F.substring(surrogate, F.lit(2), F.char_length(surrogate)))))
        .when(kind.startswith("given"), upper.otherwise(F.initcap(F.replace(surrogate, F.lit("-"), F.lit(" ")))))
        .otherwise(surrogate)
    )


def _renamed(part: Column, names: Column) -> Column:
    """The part of a text with the names that the map knows replaced, in the case they are said in."""

    def other(name):
        to = F.element_at(names, F.lower(name))
        return F.when(to.isNull(), name).otherwise(_as_said(name, to["kind"], to["surrogate"]))

    said = F.transform(F.regexp_extract_all(part, F.lit(_LONE_NAME), F.lit(0)), other)
    return F.array_join(F.zip_with(F.split(part, _LONE_NAME, -1), said, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, surrogate) with distinct surrogates per kind, none of them an entity, from distinct (kind, canon)."""
    known = entities.select("kind", F.col("canon").alias("surrogate"))
    settled, left = None, entities.withColumn("attempt", F.lit(0))
    while True:  # spaces grow with the attempt
        drawn = materialise(left.withColumn("surrogate", _surrogate(F.col("kind"), F.col("canon"), F.col("attempt"), key)), "surrogates")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon"))
        taken = known if settled is None else known.unionByName(settled.select("kind", "surrogate"))
        won = first.join(taken, ["kind", "surrogate"], "left_anti")
        won = materialise(won.select("kind", "canon", "surrogate"), "surrogates-settled")
        settled = won if settled is None else settled.unionByName(won)
        # only the losers draw again
        left = materialise(drawn.join(won, ["kind", "canon"], "left_anti").select("kind", "canon", (F.col("attempt") + 1).alias("attempt")), "surrogates-left")
        if not left.limit(1).count():
            return settled


def mentions(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_k1, _k2, place, sub, pre, kind, canon, said) of every match, in distinct texts."""
    hit = docs.where(F.col(text).rlike(HINT)).select(*row_key(F.col(key), F.col(text)), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)).alias("found"))
    found = hit.where("size(found) > 0").select("_k1", "_k2", F.posexplode("found").alias("place", "match"))
    found = found.withColumn("type", _kind(F.col("match")))
    parts = found.select("_k1", "_k2", "place", F.posexplode(_parts(F.col("match"), F.col("type"))).alias("sub", "part"))
    return parts.select("_k1", "_k2", "place", "sub", "part.*")


def replace_personal_data(docs: DataFrame, secret: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with surrogates in ``text`` and n_replaced (long), the number of replaced mentions."""
    docs = free_names(docs, "n_replaced", "_k1", "_k2", "_new", "_names")
    said = materialise(mentions(docs, key, text), "mentions")
    entities = materialise(said.where("kind is not null").select("kind", "canon").distinct(), "entities")
    table = surrogate_table(entities, secret)
    new = said.join(table, ["kind", "canon"], "left")
    new = new.withColumn("new", F.concat("pre", _as_said(F.col("said"), F.col("kind"), F.col("surrogate"))))
    # sets, since equal rows give equal mentions
    per = new.groupBy("_k1", "_k2", "place").agg(F.sort_array(F.collect_set(F.struct("sub", "new"))).alias("parts"))
    per = per.select("_k1", "_k2", "place", F.array_join(F.transform("parts", lambda x: x["new"]), "").alias("new"))
    per = per.groupBy("_k1", "_k2").agg(F.sort_array(F.collect_list(F.struct("place", "new"))).alias("_new"))
    per = per.select("_k1", "_k2", F.transform("_new", lambda x: x["new"]).alias("_new"))
    # names that the text says behind a title, to be replaced where it says them without one
    named = new.where((F.col("kind") == "family") | F.col("kind").startswith("given"))
    named = named.groupBy("_k1", "_k2", "canon").agg(F.max(F.struct("kind", "surrogate")).alias("to")).groupBy("_k1", "_k2")
    named = named.agg(F.map_from_entries(F.collect_list(F.struct("canon", "to"))).alias("_names"))
    per = per.join(named, ["_k1", "_k2"], "left")
    rows = docs.select(*row_key(F.col(key), F.col(text)), *docs.columns).join(per, ["_k1", "_k2"], "left")
    between = F.split(F.col(text), ANY, -1)
    between = F.when(F.col("_names").isNull(), between).otherwise(F.transform(between, lambda x: _renamed(x, F.col("_names"))))
    woven = F.array_join(F.zip_with(between, F.col("_new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = F.when(F.col("_new").isNull(), F.col(text)).otherwise(woven)
    n = F.coalesce(F.size("_new"), F.lit(0)).cast("long")
    return rows.select(*[changed.alias(text) if c == text else F.col(c) for c in docs.columns], n.alias("n_replaced"))
