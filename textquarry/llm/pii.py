"""Format-preserving Feistel pseudonyms for personal data.

A value that passes its format's check is replaced by a keyed permutation of
the values of that format: card numbers by card numbers of the same network
with a right check digit, IBANs by IBANs of the same country, social security
numbers, dates and addresses by valid ones, and other numbers, e-mail names
and secrets character by character in their classes. Equal values get equal
pseudonyms in all documents, however they are grouped or capitalised,
different ones different ones, and who has the key can go back.

Written with DataFrame functions only. Texts in which no value could be pass
through after one scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Dates are permuted from 1900 to 2099: 4297 * 17 days.
FIRST_DAY, DAYS = "1900-01-01", (4297, 17)
#: Social security numbers: areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999.
AREAS, GROUPS, SERIALS = 898, 99, 9999


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str


#: In the order in which they are tried at a place; no pattern matches the empty text. Groups are repeated a bounded number of times: the engine recurses for each.
KINDS = (
    Kind("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,24}(?![A-Za-z0-9-])"),
    Kind("secret", r"(?<![A-Za-z0-9])(?:AKIA[A-Z0-9]{16}|(?i:password|passwd|secret|token|api_?key)(?: ?[:=] ?)\"?[A-Za-z0-9+/_-]{8,}+)(?![A-Za-z0-9+/_-])"),
    Kind("ip", r"(?<![0-9A-Za-z.])(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}(?![0-9A-Za-z]|\.[0-9])"),
    Kind("iso_date", r"(?<![0-9A-Za-z./-])(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9](?![0-9A-Za-z]|[./-][0-9])"),
    Kind("dmy_date", r"(?<![0-9A-Za-z./-])(?:[0-3][0-9]/[01][0-9]/(?:19|20)[0-9]{2}|[0-3][0-9]\.[01][0-9]\.(?:19|20)[0-9]{2})(?![0-9A-Za-z]|[./-][0-9])"),
    Kind("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![0-9A-Za-z])"),
    Kind("card", r"(?<![0-9A-Za-z.+-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3})(?![0-9A-Za-z]|[.-][0-9])"),
    Kind("ssn", r"(?<![0-9A-Za-z.+-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"),
    Kind("phone", r"(?<![0-9A-Za-z.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])|(?<![0-9A-Za-z.])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){3,5}(?![0-9A-Za-z]|[.-][0-9])"),
)
ANY = "|".join(f"(?:{k.pattern})" for k in KINDS)
#: What every match of ANY has.
GATE = "[0-9@=:]|AKIA"
#: First digits of card numbers in use: Mastercard, Visa, American Express, Diners, JCB, Discover, UnionPay, Maestro. Fixed values.
NETWORKS = "^(?:5[1-5]|222[1-9]|22[3-9]|2[3-6]|27[01]|2720|4|3[47]|30[0-5]|3[689]|35|6011|64[4-9]|65|62|50|5[6-9]|63|67)"


def keyed(key: str, *parts: Column | str) -> Column:
    """SHA-256 in hex under the key."""
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts], F.lit(key)), 256)


def feistel(left: Column, right: Column, a: int, b: int, key: str, tag: str, back: bool = False) -> Column:
    """A permutation of the pairs (left below a, right below b), as struct (l, r) of bigints.

    Rounds add a keyed function of one half to the other in turn, modulo its
    size, so that no value leaves the range and none has to be tried again.
    """

    def turn(state: Column, i: Column) -> Column:
        i = F.lit(ROUNDS - 1) - i if back else i
        odd = i % 2 == 1
        other, own, size = F.when(odd, state["l"]).otherwise(state["r"]), F.when(odd, state["r"]).otherwise(state["l"]), F.when(odd, F.lit(b)).otherwise(F.lit(a)).cast("bigint")
        added = F.conv(F.substring(keyed(key, tag, F.lit(a), F.lit(b), i, other), 1, 15), 16, 10).cast("bigint") % size
        moved = F.pmod(own - added if back else own + added, size)
        return F.struct(F.when(odd, state["l"]).otherwise(moved).alias("l"), F.when(odd, moved).otherwise(state["r"]).alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r")), turn)


def bind(value: Column, use) -> Column:
    """use(value) with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shifted(c: Column, by: Column) -> Column:
    """A digit or letter moved within its class (digits, small and capital letters); anything else as it is."""
    at = F.ascii(c)
    within = lambda first, n: F.char(F.pmod(at - first + by, F.lit(n)) + first)
    return F.when(c.between("0", "9"), within(48, 10)).when(c.between("a", "z"), within(97, 26)).when(c.between("A", "Z"), within(65, 26)).otherwise(c)


def permuted(value: Column, key: str, tag: str, back: bool = False) -> Column:
    """Another text of as many characters of the same classes; capitals don't count in what it depends on.

    A Feistel network of halves: each character of one is moved by a byte of a
    keyed hash of the other, drawn in blocks of 32.
    """
    characters = lambda x: F.array_remove(F.split(x, ""), "")

    def moved(own: Column, other: Column, i: Column) -> Column:
        blocks = bind(keyed(key, tag, i, F.length(own), F.lower(other)), lambda h: F.transform(F.sequence(F.lit(0), F.floor(F.length(own) / 32).cast("int")), lambda k: F.sha2(F.concat_ws("/", h, k.cast("string")), 256)))
        pairs = F.regexp_extract_all(F.array_join(blocks, ""), F.lit(".."), F.lit(0))
        by = lambda p, k: F.conv(F.get(p, k), 16, 10).cast("int") * (-1 if back else 1)
        return bind(pairs, lambda p: F.array_join(F.transform(characters(own), lambda c, k: shifted(c, by(p, k))), ""))

    def turn(state: Column, i: Column) -> Column:
        i = F.lit(ROUNDS - 1) - i if back else i
        odd = i % 2 == 1
        new = bind(F.when(odd, moved(state["r"], state["l"], i)).otherwise(moved(state["l"], state["r"], i)), lambda x: F.struct(F.when(odd, state["l"]).otherwise(x).alias("l"), F.when(odd, x).otherwise(state["r"]).alias("r")))
        return new

    half = F.floor(F.length(value) / 2).cast("int")
    halves = F.struct(F.left(value, half).alias("l"), F.substring(value, half + 1, F.length(value)).alias("r"))
    return bind(F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, turn), lambda p: F.concat(p["l"], p["r"]))


def in_places(shape: Column, new: Column, characters: str = "0-9") -> Column:
    """The shape with those of its characters replaced by the new ones, in order; for short shapes."""
    return bind(new, lambda d: F.array_join(F.transform(F.array_remove(F.split(shape, ""), ""), lambda c, i: F.when(c.rlike(f"[{characters}]"), F.substring(d, F.length(F.regexp_replace(F.left(shape, i + 1), f"[^{characters}]", "")), F.lit(1))).otherwise(c)), ""))


def luhn_sum(digits: Column) -> Column:
    """Of the digits with the last one counted once."""
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + bind(F.substring(digits, -i, 1).cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda x: F.when(x > 9, x - 9).otherwise(x)))


def mod_97(text: Column) -> Column:
    """Of digits and capitals, A as 10, B as 11, and so on."""
    return F.aggregate(F.array_remove(F.split(text, ""), ""), F.lit(0), lambda s, c: F.when(c.between("0", "9"), s * 10 + F.ascii(c) - 48).otherwise(s * 100 + F.ascii(c) - 55) % 97)


def pseudonym(match: Column, key: str, back: bool = False) -> Column:
    """struct (kind, value) for one match; kind is null, and the value the match itself, where a check fails."""
    is_kind = {k.name: match.rlike(f"^(?:{k.pattern})$") for k in KINDS}
    digits = F.regexp_replace(match, "[^0-9]", "")
    part = lambda text, start, n: F.substring(text, F.lit(start), n if isinstance(n, Column) else F.lit(n))

    def out(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.alias("value"))

    def date(kind: str, form: str) -> Column:
        day = F.try_to_timestamp(match, F.lit(form)).cast("date")
        number = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        made = feistel(F.floor(number / DAYS[1]), number % DAYS[1], *DAYS, key, "date", back)
        shown = bind(made, lambda p: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * DAYS[1] + p["r"]).cast("int")), form))
        return F.when(is_kind[kind] & day.isNotNull(), out(kind, shown))

    octets = F.transform(F.split(match, r"\."), lambda x: x.cast("int"))
    ip = feistel(F.get(octets, F.lit(0)) * 256 + F.get(octets, F.lit(1)), F.get(octets, F.lit(2)) * 256 + F.get(octets, F.lit(3)), 65536, 65536, key, "ip", back)
    shown_ip = bind(ip, lambda p: F.concat_ws(".", F.floor(p["l"] / 256).cast("string"), (p["l"] % 256).cast("string"), F.floor(p["r"] / 256).cast("string"), (p["r"] % 256).cast("string")))
    # The first four digits (the network) stay, the check digit is worked out anew.
    body = F.concat(part(digits, 1, 4), permuted(part(digits, 5, F.length(digits) - 5), key, "card", back))
    card = bind(body, lambda d: F.concat(d, ((10 - luhn_sum(F.concat(d, F.lit("0"))) % 10) % 10).cast("string")))
    # Country and length stay, check digits (02 to 98) are worked out anew.
    plain = F.replace(match, F.lit(" "), F.lit(""))
    account, country = permuted(part(plain, 5, F.length(plain)), key, "iban", back), part(plain, 1, 2)
    iban = bind(account, lambda d: F.concat(country, F.lpad((98 - mod_97(F.concat(d, country, F.lit("00")))).cast("string"), 2, "0"), d))
    right_iban = (mod_97(F.concat(part(plain, 5, F.length(plain)), part(plain, 1, 4))) == 1) & part(plain, 3, 2).between("02", "98")
    area, group, serial = (part(digits, a, n).cast("int") for a, n in ((1, 3), (4, 2), (6, 4)))
    number = feistel((area - 1 - F.when(area > 666, 1).otherwise(0)) * GROUPS + group - 1, serial - 1, AREAS * GROUPS, SERIALS, key, "ssn", back)
    ssn = bind(number, lambda p: bind(F.floor(p["l"] / GROUPS) + 1, lambda a: F.concat(F.lpad((a + F.when(a > 665, 1).otherwise(0)).cast("string"), 3, "0"), F.lpad((p["l"] % GROUPS + 1).cast("string"), 2, "0"), F.lpad((p["r"] + 1).cast("string"), 4, "0"))))
    # The last ten digits; what stands before them is the country.
    own = F.least(F.lit(10), F.length(digits) - 1)
    phone = F.concat(F.left(digits, F.length(digits) - own), permuted(F.right(digits, own), key, "phone", back))
    top = F.regexp_extract(match, r"(\.[A-Za-z]+)$", 1)
    mail = F.concat(permuted(F.left(match, F.length(match) - F.length(top)), key, "email", back), top)
    secret = F.when(match.startswith("AKIA"), F.substring(match, F.lit(5), F.length(match))).otherwise(F.regexp_extract(match, r"([A-Za-z0-9+/_-]++)$", 1))
    hidden = F.concat(F.left(match, F.length(match) - F.length(secret)), permuted(secret, key, "secret", back))
    return F.coalesce(
        F.when(is_kind["email"], out("email", mail)),
        F.when(is_kind["secret"], out("secret", hidden)),
        F.when(is_kind["ip"] & F.forall(octets, lambda x: x < 256), out("ip", shown_ip)),
        date("iso_date", "yyyy-MM-dd"),
        F.when(match.contains("/"), date("dmy_date", "dd/MM/yyyy")).otherwise(date("dmy_date", "dd.MM.yyyy")),
        F.when(is_kind["iban"] & right_iban, out("iban", in_places(match, iban, "A-Z0-9"))),
        F.when(is_kind["card"] & digits.rlike(NETWORKS) & (luhn_sum(digits) % 10 == 0), out("card", in_places(match, card))),
        F.when(is_kind["ssn"] & (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0), out("ssn", in_places(match, ssn))),
        F.when(is_kind["phone"] & F.length(digits).between(10, 15), out("phone", in_places(match, phone))),
        F.struct(F.lit(None).cast("string").alias("kind"), match.alias("value")),
    )


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", found_col: str = "pii", back: bool = False) -> DataFrame:
    """docs with the text's personal data replaced, and ``found_col``: array of (kind, value) of the replacements, in order.

    Values are permuted within their kind: ``back`` with the same key undoes
    that. A null id changes nothing: ids aren't looked at. The text between
    matches stays as it is, byte for byte; null stays null (and found_col is
    empty), empty stays empty. All other columns pass through; one named as
    found_col is replaced. No shuffle.
    """
    text = F.col(text_col)
    may = text.rlike(GATE)
    made = F.when(may, F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda m: pseudonym(m, key, back)))
    out = docs.withColumn(found_col, made)
    parts = F.zip_with(F.split(text, ANY, -1), F.col(found_col), lambda gap, m: F.concat(gap, F.coalesce(m["value"], F.lit(""))))
    out = out.withColumn(text_col, F.when(F.size(found_col) > 0, F.array_join(parts, "")).otherwise(text))
    empty = F.array().cast("array<struct<kind:string,value:string>>")
    return out.withColumn(found_col, F.coalesce(F.filter(found_col, lambda m: m["kind"].isNotNull()), empty))
