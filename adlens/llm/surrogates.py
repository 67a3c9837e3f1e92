"""Operator 2: personal data replaced by keyed surrogates (DataFrame functions only).

Entities are found by one regular expression: e-mail addresses, network
addresses (IPv4, IPv6), telephone numbers (with a plus sign, 00 or a bracketed
area code; 3-3-4 digits; with a leading 0 in groups), card numbers, IBANs with
right check digits, identity numbers, long hexadecimal secrets, and persons
named with a title, their initials included. An entity's canonical form (lower case, and
without the separators of numbers) gets one surrogate everywhere, made from
SHA-256 of a secret key, its type, the form and a try number, so the same
person, number or address stays the same across documents and spellings. A
surrogate keeps the type, length, separators, letter case and script (Latin,
Cyrillic, Greek; in e-mail addresses Han too), the gender of a given name, the
country code of a telephone number, the country of an IBAN, the ranges of a
network address and valid check digits. An initial becomes another letter.

Not found: persons without a title or in scripts without capital letters (Han
and others), names with particles (von, de), telephone numbers of 10 digits or
fewer without separators and local ones without an area code. Two spellings of
an IPv6 address count as two addresses.

Two entities of a type that draw one surrogate, or a surrogate that is itself
an entity of the corpus, are drawn again (with the next try number) until all
are distinct. The strings of one shape may be too few for that, so after each
``TRIES`` tries the space is widened: all letters of the script instead of
alternating ones and one more digit in an address's octets, then one more
character at each step. Only then does a surrogate get longer than its entity.

Defined results
---------------
* null text: null, 0 entities; text without entities: unchanged.
* repeated rows: each is returned, with equal results; null ids take part.
* ties in a collision: the entity with the least canonical form keeps its draw.
* an entity in a large part of the rows: aggregated before the shuffle; the
  join back is between written tables, so Spark splits it.
* very long texts: cut at their entities and put together within one row.
* empty table: empty result. Other columns are carried, clashing names too,
  except ``n_entities``, which is replaced.
"""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import fresh, saved

#: Titles that tell a person, by the person's gender (N: not told). Fixed values.
TITLES = {
    "M": ["Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Sr", "господин", "Господин", "κύριος", "Κύριος"],
    "F": ["Mrs", "Miss", "Ms", "Lady", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Señorita", "Srta",
          "госпожа", "Госпожа", "κυρία", "Κυρία"],
    "N": ["Dr", "Doctor", "Prof", "Professor", "Rev", "доктор", "Доктор", "профессор", "Профессор"],
}
#: The same in capitals, only with a dot (MS, MISS and others are words, too).
SHOUTED = {"M": ["MR"], "F": ["MRS", "MS"], "N": ["DR", "PROF", "REV"]}
#: Given names that stand in for others, by gender and script. Fixed values.
GIVEN = {
    ("M", "latin"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Max", "Oscar"],
    ("F", "latin"): ["Anna", "Bella", "Clara", "Diana", "Elena", "Flora", "Helena", "Ida", "Julia", "Laura", "Marta", "Nora"],
    ("N", "latin"): ["Alex", "Charlie", "Chris", "Jamie", "Kim", "Lee", "Noel", "Robin", "Sam", "Sasha", "Terry", "Toni"],
    ("M", "cyrillic"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Максим", "Олег", "Павел"],
    ("F", "cyrillic"): ["Алла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Ирина", "Лидия", "Мария", "Нина"],
    ("N", "cyrillic"): ["Саша", "Женя", "Валя", "Шура", "Слава"],
    ("M", "greek"): ["Γιώργος", "Νίκος", "Κώστας", "Γιάννης", "Πέτρος", "Παύλος", "Ανδρέας"],
    ("F", "greek"): ["Μαρία", "Ελένη", "Κατερίνα", "Σοφία", "Άννα", "Ειρήνη", "Γεωργία"],
    ("N", "greek"): ["Αντώνης", "Βασιλική", "Θωμάς", "Ζωή", "Λουκάς", "Δανάη"],
}
#: Letters of each script, as (consonants, vowels). Fixed values.
LETTERS = {
    "latin": ("bcdfghklmnprstvwz", "aeiou"),
    "accented": ("çñ", "áàâäéèêëíîïóôöúùûü"),
    "cyrillic": ("бвгдзклмнпрстфхцч", "аеиоуя"),
    "greek": ("βγδζθκλμνξπρστφχψ", "αεηιουω"),
    "han": ("白成大东方高国海华金", "立林明宁平山天文新中"),
}
#: The same with every letter, for later tries.
WIDE = {
    "latin": "abcdefghijklmnopqrstuvwxyz", "accented": "".join(LETTERS["accented"]), "han": "".join(LETTERS["han"]),
    "cyrillic": "абвгдеёжзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}
CLASSES = {"latin": "a-z", "accented": "ß-öø-ÿ", "cyrillic": "а-џґ", "greek": "ΐά-ώ", "han": "一-鿿"}

#: Length of an IBAN -> countries.
IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_APART, _END = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_TITLE = (r"(?:(?:" + "|".join(t for g in TITLES.values() for t in g) + r")\.?|(?:"
          + "|".join(t for g in SHOUTED.values() for t in g) + r")\.)[\s\xa0]")
_NAME = r"\p{Lu}[\p{L}'’\-]{1,99}(?!\p{L})"
_INITIALS = r"(?:\p{Lu}(?:\.[\s\xa0]?|[\s\xa0])){1,3}"
_HEX, _V4 = "[0-9a-fA-F]{1,4}", r"\d{1,3}(?:\.\d{1,3}){3}"

#: Type -> pattern, in the order in which they are tried at a place of the text.
PATTERNS = {
    # a local part starts where its characters do, or right after another entity, and is taken whole: one look at
    # each character of a long run; parts that no address has (over 256, 63 and 127 labels) are none
    "EMAIL": r"(?:\G|(?<![\p{L}\p{N}._%+\-]))[\p{L}\p{N}._%+\-]{1,256}+(?<!\.)@"
             r"[\p{L}\p{N}\-]{1,63}(?:\.[\p{L}\p{N}\-]{1,63}){0,126}\.\p{L}{2,63}(?!\p{L})",
    "IP": r"(?<![\p{L}\p{N}.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?[\p{L}\p{N}])",
    # compressed ones have a digit or three groups (a::b is code, and x[1::2] as well)
    "IP6": r"(?<![\p{L}\p{N}:.])(?<![\p{L}\p{N}_)\]]\[)(?:(?:H:){7}H|(?:H:){6}V"
           r"|(?=[a-fA-F:]*\d|(?:H:){2,7}:|(?:H:)*:(?:H:){2}|H::H:H)(?:H(?::H){0,6})?::(?:(?:H:){0,5}(?:V|H))?)"
           r"(?![\p{L}\p{N}:]|\.\d)".replace("H", _HEX).replace("V", _V4),
    "IBAN": _APART + "(?:" + "|".join(f"(?:{c.replace(' ', '|')})" + r"\d{2}(?: ?[A-Z0-9]){" + str(n - 4) + "}"
                                      for n, c in IBAN.items()) + ")" + _END,
    "ID": _APART + r"\d{3}-\d{2}-\d{4}" + _END,
    "CARD": _APART + r"(?:(?:\d{4}[ \-]){3}\d{4}|\d{4}[ \-]\d{6}[ \-]\d{4,5}|\d{13,19})" + _END,
    "PHONE": _APART + r"(?:\+?\d{1,3}[ .\-]?)?\(\d{2,4}\)[ .\-]?\d{3,4}[ .\-]?\d{3,4}" + _END
             + "|" + _APART + r"(?:\+\d{1,3}|00[1-9]\d{0,2})(?:[ .\-]?\d{2,4}){2,5}" + _END
             # national forms, not as a part of longer numbers
             + "|" + _APART + r"(?<!\d[.\-/])(?:(?:1[ .\-])?[2-9]\d{2}(?:-\d{3}-|\.\d{3}\.| [2-9]\d{2} )\d{4}"
             r"|0[1-9]\d{1,4}(?:[ /\-]\d{5,8}|[ .\-]\d{3,4}[ .\-]\d{3,4})|0[1-9](?:[ .\-]\d{2}){4}|0[1-9]\d{9})"
             + _END + r"(?![.\-/]\d)",
    "SECRET": _APART + r"(?=[a-zA-Z]*\d)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})" + _END,
    "PERSON": _APART + f"(?:{_TITLE}){{1,3}}(?:{_INITIALS}|{_NAME}[\\s\\xa0](?:{_INITIALS})?)?{_NAME}",
}
#: Tries before the space of surrogates is widened by a step.
TRIES = 6
ANY = "|".join(PATTERNS.values())
#: Within a string that only looks like an IBAN.
_REST = "|".join(p for k, p in PATTERNS.items() if k != "IBAN")
#: Every entity has one of these; a quick test before the full pattern.
HINT = (r"[@0-9]|::|[a-fA-F]:[a-fA-F]|" + "|".join(t for g in TITLES.values() for t in g) + "|"
        + "|".join(t + r"\." for g in SHOUTED.values() for t in g))
_PERSON = f"(?s)^((?:{_TITLE}){{1,3}})(.*?)({_NAME})$"
_MIDDLE = f"(?s)^({_NAME})([\\s\\xa0])(.*)$"


def _type(raw: Column) -> Column:
    """Type of a found string, by its own shape."""
    return (F.when(raw.contains("@"), "EMAIL").when(raw.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "IP")
            .when(raw.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ID")
            .when(raw.rlike(r"^(\d{4}[ \-]){3}\d{4}$|^\d{4}[ \-]\d{6}[ \-]\d{4,5}$|^\d{13,19}$"), "CARD")
            .when(raw.rlike(r"^[0-9a-fA-F]{32,}$"), "SECRET").when(raw.rlike("^[0-9a-fA-F:]*:[0-9a-fA-F:.]+$"), "IP6")
            .when(raw.rlike(r"^[A-Z]{2}\d{2}[ A-Z0-9]+$"), "IBAN").when(raw.rlike(r"^[+(0-9][0-9 ./()\-]*$"), "PHONE")
            .otherwise("PERSON"))


def _parts(raw: Column) -> Column:
    """array<struct<kind, raw>>: one part, or title, given name, space and
    surname of a person; parts without a kind stay as they are."""
    def part(kind: Column, r: Column) -> Column:
        return F.struct(kind.cast("string").alias("kind"), r.alias("raw"))

    def titled(gender: str) -> Column:
        return titles.rlike("(?:^|[\\s\\xa0])(?:" + "|".join(TITLES[gender] + SHOUTED[gender]) + r")\W")

    def known(gender: str) -> Column:  # without a title that tells, the name itself may
        return F.lower(first).isin([n.lower() for (g, _), names in GIVEN.items() if g == gender for n in names])

    titles, middle = F.regexp_extract(raw, _PERSON, 1), F.regexp_extract(raw, _PERSON, 2)
    first = F.regexp_extract(middle, _MIDDLE, 1)
    given = (F.when(titled("F"), "GIVEN_F").when(titled("M"), "GIVEN_M").when(known("F"), "GIVEN_F")
             .when(known("M"), "GIVEN_M").otherwise("GIVEN_N"))
    person = F.array(part(F.lit(None), titles), part(given, first), part(F.lit(None), F.regexp_extract(middle, _MIDDLE, 2)),
                     part(F.lit("INITIAL"), F.when(first == "", middle).otherwise(F.regexp_extract(middle, _MIDDLE, 3))),
                     part(F.lit("SURNAME"), F.regexp_extract(raw, _PERSON, 3)))
    # no IBAN after all: what else is in it
    inner = F.flatten(F.zip_with(F.split(raw, _REST, -1), F.regexp_extract_all(raw, F.lit(_REST), F.lit(0)), lambda a, b: F.array(
        part(F.lit(None), a), part(_type(b), F.coalesce(b, F.lit(""))))))
    digits = _form(F.lit("IBAN"), raw)
    wrong = _mod97(F.concat(F.substring(digits, F.lit(5), F.length(digits)), F.substring(digits, 1, 4))) != 1
    return (F.when(_type(raw) == "PERSON", person).when((_type(raw) == "IBAN") & wrong, inner)
            .otherwise(F.array(part(_type(raw), raw))))


def _form(kind: Column, raw: Column) -> Column:
    """Canonical form: what two mentions of one entity have in common."""
    return (F.when(kind.isin("PHONE", "CARD", "ID"), F.regexp_replace(raw, "[^0-9]", ""))
            .when(kind == "IBAN", F.lower(F.regexp_replace(raw, " ", ""))).otherwise(F.lower(raw)))


def _pick(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), n % len(letters) + 1, F.lit(1))


def _draw(key: str, kind: Column, form: Column, attempt: int) -> Column:
    """Surrogate of a canonical form: characters of the same kind at each place, and more in late tries."""
    step = attempt // TRIES
    more = max(step - 1, 0)  # characters longer than the form
    seed = F.concat_ws("\x1f", F.lit(key), kind, form, F.lit(str(attempt)))
    stream = F.concat(*[F.sha2(F.concat(seed, F.lit(f"\x1f{i}")), 256) for i in range(3)])

    def byte(i: Column) -> Column:  # 0-based place
        return F.conv(F.substring(stream, (i % 96) * 2 + 1, F.lit(2)), 16, 10).cast("int")

    def letter(c: Column, i: Column, name: str) -> Column:
        if step:
            return _pick(WIDE[name], byte(i))
        con, vow = LETTERS[name]
        return F.when((i + byte(F.lit(0))) % 2 == 0, _pick(con, byte(i))).otherwise(_pick(vow, byte(i)))

    def same_kind(c: Column, i: Column) -> Column:
        out = F.when(c.rlike("[0-9]"), _pick("0123456789", byte(i)))
        for name, chars in CLASSES.items():
            out = out.when(c.rlike(f"[{chars}]"), letter(c, i, name))
        return out.otherwise(F.when(c.rlike(r"\p{L}"), _pick("abcdefghijklmnopqrstuvwxyz", byte(i))).otherwise(c))

    chars = F.filter(F.split(form, ""), lambda c: c != "")
    plain = F.array_join(F.transform(chars, same_kind), "")
    hexa = F.array_join(F.transform(chars, lambda c, i: _pick("0123456789abcdef", byte(i))), "")

    def longer(c: Column) -> Column:  # characters of the kind of c, from places of their own
        return F.concat(F.lit(""), *[same_kind(c, F.length(form) + j) for j in range(more)])

    def octet(o: Column, i: Column) -> Column:
        if step > 3:  # more than all addresses hold: octets of more digits
            return F.concat((1 + byte(i) % 9).cast("string"), *[_pick("0123456789", byte(i + 4 * j)) for j in range(1, step)])
        if step == 3:
            return byte(i).cast("string")
        size = F.length(o) + step
        return F.when(size == 1, 1 + byte(i) % 9).when(size == 2, 10 + byte(i) % 90).otherwise(100 + byte(i) % 156).cast("string")

    ip = F.array_join(F.transform(F.split(form, "[.]"), octet), ".")
    top = F.length(F.regexp_extract(form, r"\.\p{L}+$", 0))
    email = F.concat(longer(F.lit("a")), F.substring(plain, F.lit(1), F.length(form) - top),
                     F.substring(form, F.length(form) - top + 1, top))
    # the country code or the leading 0 stays; an area code starts with 2 to 9
    code = F.greatest(F.length(form) - 10, form.startswith("0").cast("int"))
    area = F.when((code == 0) & (F.length(form) == 10), _pick("23456789", byte(F.lit(0)))).otherwise("")
    phone = F.concat(F.substring(form, F.lit(1), code), area,
                     F.substring(plain, code + F.length(area) + 1, F.length(form)), longer(F.lit("0")))

    def group6(g: Column, i: Column) -> Column:
        size = F.when(g == "", 0).otherwise(F.least(F.lit(4), F.length(g) + step))
        return F.substring(F.concat(*[_pick("0123456789abcdef", byte(i * 4 + j)) for j in range(4)]), F.lit(1), size)

    ip6 = F.concat(F.array_join(F.transform(F.split(form, ":"), group6), ":"), *[
        F.concat(F.when(form.endswith(":"), "").otherwise(":") if not n else F.lit(":"), group6(F.lit("0000"), F.lit(9 + n)))
        for n in range(max(step - 4, 0))])
    v4 = F.regexp_extract(form, _V4 + "$", 0)
    ip6 = F.when(v4 == "", ip6).otherwise(F.concat(
        F.substring(form, F.lit(1), F.length(form) - F.length(v4)), F.array_join(F.transform(F.split(v4, "[.]"), octet), ".")))
    account = F.concat(F.substring(plain, F.lit(5), F.length(form)), longer(F.lit("0")))
    country = F.substring(form, 1, 2)
    iban = F.concat(country, F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)
    body = F.concat(F.substring(plain, F.lit(1), F.length(form) - 1), longer(F.lit("0")))
    check = ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    card = F.when(_luhn(form) % 10 == 0, F.concat(body, check)).otherwise(F.concat(plain, longer(F.lit("0"))))
    given = reduce(lambda w, gs: w.when(
        (kind == f"GIVEN_{gs[0]}") & (F.when(form.rlike(f"^[{CLASSES['cyrillic']}]"), "cyrillic")
                                      .when(form.rlike(f"^[{CLASSES['greek']}]"), "greek").otherwise("latin") == gs[1]),
        F.concat(F.lower(F.element_at(F.array(*map(F.lit, GIVEN[gs])), byte(F.lit(95)) % len(GIVEN[gs]) + 1)),
                 # more names than the list has: the next tries are longer
                 *[_pick(LETTERS[gs[1]][1 - k % 2], byte(F.lit(k))) for k in range(attempt)])),
        GIVEN, F.when(F.lit(False), F.lit("")))
    return (F.when(kind == "EMAIL", email).when(kind == "IP", ip).when(kind == "PHONE", phone)
            .when(kind == "CARD", card).when(kind == "SECRET", F.concat(hexa, longer(F.lit("0"))))
            .when(kind == "IP6", ip6).when(kind == "IBAN", iban).when(kind.startswith("GIVEN"), given)
            # the first character of an ID is a digit, that of a surname a letter
            .otherwise(F.concat(plain, longer(F.substring(form, 1, 1)))))


def _luhn(digits: Column) -> Column:
    """Weighted digit sum; a multiple of ten is a valid number."""
    d = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c.rlike("[0-9]")),
                    lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(d, F.lit(0), lambda a, x: a + x)


def _mod97(chars: Column) -> Column:
    """Remainder by 97 of digits and lower-case letters, a = 10 to z = 35; 1 for a valid IBAN turned round."""
    return F.aggregate(F.filter(F.split(chars, ""), lambda c: c != ""), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 87) % 97))


def _initials(key: str, raw: Column) -> Column:
    """Each initial replaced by another letter of its script, the same one everywhere."""
    def other(c: Column) -> Column:
        low = F.lower(c)
        at = F.conv(F.substring(F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("INITIAL"), low), 256), 1, 4), 16, 10).cast("int")

        def of(letters: str) -> Column:
            return F.upper(_pick(letters, F.position(low, F.lit(letters)) + at % (len(letters) - 1)))

        return (F.when(~c.rlike(r"\p{Lu}"), c).when(low.rlike(f"[{CLASSES['cyrillic']}]"), of(WIDE["cyrillic"]))
                .when(low.rlike(f"[{CLASSES['greek']}]"), of(WIDE["greek"])).otherwise(of(WIDE["latin"])))

    return F.array_join(F.transform(F.filter(F.split(raw, ""), lambda c: c != ""), other), "")


def draw_surrogates(forms: DataFrame, key: str) -> DataFrame:
    """(kind, form, surrogate) for distinct (kind, form): distinct surrogates, none of them a form.

    Ends for every number of forms: each widening multiplies the space of a
    shape, so it comes to exceed the forms, and then tries place most of what waits.
    """
    forms = saved(forms.distinct(), "forms")
    taken = forms.select("kind", F.col("form").alias("surrogate"))
    waiting, done = forms, None
    for attempt in count():
        drawn = saved(waiting.withColumn("surrogate", _draw(key, F.col("kind"), F.col("form"), attempt)), "drawn")
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        first = free.groupBy("kind", "surrogate").agg(F.min("form").alias("form"))
        good = saved(first.select("kind", "form", "surrogate"), "surrogates")
        done = good if done is None else done.unionByName(good)
        taken = taken.unionByName(good.select("kind", "surrogate"))
        waiting = saved(waiting.join(good, ["kind", "form"], "left_anti"), "waiting")
        if waiting.isEmpty():
            return done


def _dress(kind: Column, raw: Column, new: Column) -> Column:
    """The surrogate in the separators and letter case of the found string."""
    spaced = kind.isin("PHONE", "CARD", "ID", "IBAN")

    def put(a: Column, c: Column) -> Column:
        skip = spaced & ~c.rlike("[0-9A-Z]")
        n = F.substring(new, a["k"] + 1, F.lit(1))
        upper = (F.upper(c) == c) & (F.lower(c) != c)
        return F.struct(F.concat(a["out"], F.when(skip, c).when(upper, F.upper(n)).otherwise(n)).alias("out"),
                        (a["k"] + F.when(skip, 0).otherwise(1)).alias("k"))

    laid = F.aggregate(F.filter(F.split(raw, ""), lambda c: c != ""),
                       F.struct(F.lit("").alias("out"), F.lit(0).alias("k")), put,
                       lambda a: F.concat(a["out"], F.substring(new, a["k"] + 1, F.length(new))))
    shout = (F.upper(raw) == raw) & (F.length(raw) > 1)
    name = F.when(shout, F.upper(new)).otherwise(F.concat(F.upper(F.substring(new, 1, 1)), F.substring(new, F.lit(2), F.length(new))))
    hexa = F.when((F.upper(raw) == raw) & (F.lower(raw) != raw), F.upper(new)).otherwise(new)
    return (F.when(kind.startswith("GIVEN"), name).when(kind.isin("SECRET", "IP6"), hexa)
            .when(shout & (F.length(new) > F.length(raw)) & ~spaced, F.upper(new)).otherwise(laid))


def replace_entities(docs: DataFrame, key: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every entity of ``text`` replaced, and ``n_entities``."""
    cols = [c for c in docs.columns if c != "n_entities"]
    rows = docs.select(*cols)
    # Rows are told apart by id and text; rows equal in both share their entities.
    place = F.struct(F.col(id).cast("string").alias("i"), F.xxhash64(F.col(id), F.col(text)).alias("h"))
    hint = F.coalesce(F.col(text).rlike(HINT), F.lit(False))
    matches = F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))
    found = (rows.where(hint).select(place.alias("p"), F.posexplode(matches).alias("pos", "m")).distinct()
             .select("p", "pos", F.posexplode(_parts(F.col("m"))).alias("j", "part"))
             .select("p", "pos", "j", F.col("part.kind").alias("kind"), F.col("part.raw").alias("raw"))
             .where(F.col("raw") != "").withColumn("form", F.when(F.col("kind").isNotNull(), _form(F.col("kind"), F.col("raw")))))
    found = saved(found, "entities")
    drawn = saved(draw_surrogates(found.where("kind <> 'INITIAL'").select("kind", "form"), key), "surrogates")
    dressed = found.join(drawn, ["kind", "form"], "left").select(
        "p", "pos", "j", (F.col("kind").isNotNull() & ~F.col("kind").rlike("GIVEN|INITIAL")).cast("long").alias("e"),
        F.when(F.col("kind") == "INITIAL", _initials(key, F.col("raw"))).when(F.col("surrogate").isNull(), F.col("raw"))
        .otherwise(_dress(F.col("kind"), F.col("raw"), F.col("surrogate"))).alias("new"))
    by_match = dressed.groupBy("p", "pos").agg(F.sort_array(F.collect_list(F.struct("j", "new"))).alias("x"), F.sum("e").alias("e")).select(
        "p", "pos", "e", F.array_join(F.col("x.new"), "").alias("new"))
    ours, told = fresh(rows, "place"), fresh(rows, "replaced")
    by_row = saved(by_match.groupBy("p").agg(F.sort_array(F.collect_list(F.struct("pos", "new"))).alias("x"),
                                              F.sum("e").alias("e"))
                   .select(F.col("p").alias(ours), F.struct(F.col("x.new").alias("new"), "e").alias(told)), "replacements")
    held = rows.where(hint).join(by_row, place["i"].eqNullSafe(F.col(ours)["i"]) & (place["h"] == F.col(ours)["h"]), "left")
    between = F.split(F.col(text), ANY, -1)
    woven = F.array_join(F.flatten(F.zip_with(between, F.coalesce(F.col(told)["new"], F.array().cast("array<string>")),
                                              lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    changed = held.withColumn("n_entities", F.coalesce(F.col(told)["e"], F.lit(0)).cast("long")).withColumn(
        text, F.when(F.col(told)["new"].isNull(), F.col(text)).otherwise(woven))
    return (changed.select(*cols, "n_entities")
            .unionByName(rows.where(~hint).select(*cols, F.lit(0).cast("long").alias("n_entities"))))
