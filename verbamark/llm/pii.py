"""Format-preserving pseudonyms for personal data, as column expressions only.

Found values are checked (check digits, ranges, the calendar) and permuted by
a keyed Feistel network within their own format: a card number becomes another
valid card number of the same length and grouping, a date another date written
alike. The network works on a list of numbers, each with its own base (10 for
a digit, 26 for a letter, 256 for a part of an address): in each round one half
of the list is shifted, place by place, by a hash of the other half, so that
different values of a format get different pseudonyms, and equal values equal
ones in every document.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
DATE_START, DATE_DAYS, DATE_BASE = "1900-01-01", 73049, 4297  # 1900 to 2099: 17 * 4297 days

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
LABEL = r"(?:token|password|passwd|secret|api_key)\s{0,2}[=:]\s{0,2}[\"']?"
CHUNK = 512
# fixed forms, the more specific first
PATTERNS = {
    # possessive and bounded throughout: a group repeated otherwise costs Java a stack frame a time
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,256}+@(?=[A-Za-z0-9.-]{1,253}\.[A-Za-z]{2}|[A-Za-z0-9-]{1,63}\.[A-Za-z]{2})"
             r"[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,127}+",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
              rf"|(?<=[=:\s\"'])(?=[A-Za-z0-9_\-]{{12}})(?<={LABEL})[A-Za-z0-9_\-]{{12,{CHUNK}}}+"
              # a longer one goes on where the last match ended
              rf"|\G(?<=[A-Za-z0-9_\-]{{{CHUNK}}})[A-Za-z0-9_\-]{{1,{CHUNK}}}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv4": rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![0-9-])",
    "date": r"(?<![0-9A-Za-z/.-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![0-9A-Za-z/-]|\.[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![0-9])"
             r"|(?<![0-9A-Za-z+])\+[1-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?![0-9])",
    "card": r"(?<![0-9])(?<![0-9][ -])\d(?:[ -]?\d){12,18}(?![0-9])",
}
# every form holds one of these, and most texts hold none
HINT = "[0-9@=]|AKIA|ASIA|(?:token|password|passwd|secret|api_key)\\s{0,2}:"


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chars(text: Column) -> Column:
    return F.split(text, "(?!^)(?!$)")


def _joined(parts: Column) -> Column:
    return F.array_join(parts, "")


def _shift(key: Column, kind: Column, step: Column, other: Column, place: Column) -> Column:
    """A number below 2**48 from the key, the kind, the round, the other half as text and the place to shift."""
    seed = F.concat_ws("|", key, kind, step.cast("string"), (place / 5).cast("int").cast("string"), other)
    return F.conv(F.substr(F.sha2(seed, 256), (F.pmod(place, F.lit(5)) * 12 + 1).cast("int"), F.lit(12)), 16, 10).cast("long")


def feistel(values: Column, bases: Column, key: Column, kind: Column, rounds: int = ROUNDS) -> Column:
    """Permute lists of numbers ``0 <= values[i] < bases[i]``, one to one for each list of bases and kind."""
    pairs = F.zip_with(values, bases, lambda v, b: F.struct(v.alias("v"), b.alias("b")))

    def network(both: Column) -> Column:
        half = F.floor((F.size(both) + 1) / 2).cast("int")
        start = F.struct(F.slice(both, F.lit(1), half).alias("own"),
                         F.slice(both, half + 1, F.size(both) - half).alias("other"))

        def step(state: Column, i: Column) -> Column:
            text = F.array_join(F.transform(state["other"], lambda x: F.concat_ws("/", x["v"].cast("string"), x["b"].cast("string"))), ",")
            moved = let(text, lambda t: F.transform(state["own"], lambda x, j: F.struct(
                F.pmod(x["v"] + _shift(key, kind, i, t, j), x["b"]).alias("v"), x["b"].alias("b"))))
            return F.struct(state["other"].alias("own"), moved.alias("other"))

        # after an even number of rounds the halves stand as before
        done = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step)
        return let(done, lambda d: F.concat(d["own"], d["other"]))

    return F.transform(let(pairs, network), lambda x: x["v"])


def _luhn(digits: Column) -> Column:
    """Luhn sum of a list of digits whose last one counts once."""
    n = F.size(digits)
    part = lambda d, j: F.when((n - j) % 2 == 0, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)
    return F.aggregate(F.transform(digits, part), F.lit(0).cast("long"), lambda a, d: a + d)


def _mod97(iban: Column) -> Column:
    """The check sum of an account number without blanks: 1 if it is valid."""
    turned = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(_chars(turned), F.lit(0), lambda a, c: (a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)


def _places(text: Column, start: Column, end: Column) -> Column:
    """Each character with its base, 1 outside of ``start`` to ``end`` and for what is no letter or digit, and its zero."""
    def place(c: Column, j: Column) -> Column:
        base = F.when((j < start) | (j >= end), 1).when(c.rlike("[0-9]"), 10).when(c.rlike("[A-Za-z]"), 26).otherwise(1)
        zero = F.when(c.rlike("[0-9]"), 48).when(c.rlike("[a-z]"), 97).otherwise(65)
        return F.struct(c.alias("c"), base.cast("long").alias("b"), zero.alias("zero"))

    return F.transform(_chars(text), place)


def _put(places: Column, values: Column) -> Column:
    """The characters with the free ones replaced in turn."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))
    step = lambda s, x: F.struct(
        F.concat(s["out"], F.when(x["b"] == 1, x["c"]).otherwise(F.char(F.get(values, s["k"]) + x["zero"]))).alias("out"),
        (s["k"] + F.when(x["b"] == 1, 0).otherwise(1)).alias("k"))
    return F.aggregate(places, start, step, lambda s: s["out"])


def _digits(text: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(text, "[^0-9]", "")), lambda c: c.cast("long"))


def _with_card_check(text: Column) -> Column:
    """The last digit made to fit the others."""
    body = F.substr(text, F.lit(1), F.length(text) - 1)
    zero = F.array(F.lit(0).cast("long"))
    return F.concat(body, F.pmod(-let(F.concat(_digits(body), zero), _luhn), F.lit(10)).cast("string"))


def _with_iban_check(text: Column) -> Column:
    """The check digits, given as 00, made to fit the rest."""
    check = (F.lit(98) - _mod97(F.regexp_replace(text, " ", ""))).cast("string")
    return F.concat(F.substr(text, F.lit(1), F.lit(2)), F.lpad(check, 2, "0"), F.substr(text, F.lit(5)))


def _longs(*values: Column | int) -> Column:
    return F.array(*((F.lit(v) if isinstance(v, int) else v).cast("long") for v in values))


def _area(v: Column) -> Column:
    """Areas 1 to 899 but for 666, counted from 0."""
    return v - F.when(v > 666, 2).otherwise(1)


def _calendar(m: Column) -> Column:
    """The day a date names, null if there is none, and the pattern it is written in.

    Dates with strokes are read with the day first, unless only the month can be.
    """
    def read(parts: Column) -> Column:
        iso, point = m.contains("-"), m.contains(".")
        a, b = parts[0].cast("int"), parts[1].cast("int")
        month_first = ~iso & ~point & (b > 12) & (a <= 12)
        padded = (F.length(parts[0]) == 2) & (F.length(parts[1]) == 2)
        form = (F.when(iso, "yyyy-MM-dd").when(point, F.when(padded, "dd.MM.yyyy").otherwise("d.M.yyyy"))
                .when(month_first, F.when(padded, "MM/dd/yyyy").otherwise("M/d/yyyy"))
                .otherwise(F.when(padded, "dd/MM/yyyy").otherwise("d/M/yyyy")))
        year = F.when(iso, parts[0]).otherwise(parts[2])
        month = F.when(iso | ~month_first, parts[1]).otherwise(parts[0])
        day = F.when(iso, parts[2]).when(month_first, parts[1]).otherwise(parts[0])
        given = F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date")
        return F.struct(F.when(year.cast("int").between(1900, 2099), given).alias("day"), form.alias("form"))

    return let(F.split(m, "[-/.]"), read)


def kind_of(m: Column) -> Column:
    """The kind of a match of ``PATTERNS``, null if its check fails."""
    whole = lambda name: m.rlike("^(?:" + PATTERNS[name] + ")$")
    return (F.when(m.contains("@"), F.lit("email"))
            .when(whole("ipv4"), "ipv4")
            .when(whole("date"), F.when(_calendar(m)["day"].isNotNull(), "date"))
            .when(whole("ssn"), "ssn")
            .when(whole("iban"), F.when(_mod97(F.regexp_replace(m, " ", "")) == 1, "iban"))
            .when(whole("phone"), F.when(F.length(F.regexp_replace(m, "[^0-9]", "")).between(7, 15), "phone"))
            .when(whole("card"), F.when(let(_digits(m), _luhn) % 10 == 0, "card"))
            .otherwise("secret"))


def _numbers(m: Column, kind: Column) -> tuple[Column, Column]:
    """The list of numbers of a social security number, an address or a date, and their bases."""
    area, group, serial = (F.get(F.split(m, "-"), F.lit(i)).cast("long") for i in range(3))
    day = F.datediff(_calendar(m)["day"], F.lit(DATE_START).cast("date"))
    values = (F.when(kind == "ssn", _longs(_area(area), (group - 1) * 9999 + serial - 1))
              .when(kind == "ipv4", F.transform(F.split(m, r"\."), lambda c: c.cast("long")))
              .otherwise(let(day, lambda n: _longs(F.floor(n / DATE_BASE), n % DATE_BASE))))
    bases = (F.when(kind == "ssn", _longs(898, 99 * 9999)).when(kind == "ipv4", _longs(256, 256, 256, 256))
             .otherwise(_longs(DATE_DAYS // DATE_BASE, DATE_BASE)))
    return values, bases


def _from_numbers(m: Column, kind: Column, v: Column) -> Column:
    """New numbers written as ``m`` was."""
    ssn = F.concat_ws("-", *(F.lpad(x.cast("string"), n, "0") for x, n in (
        (v[0] + F.when(v[0] >= 665, 2).otherwise(1), 3), (F.floor(v[1] / 9999) + 1, 2), (v[1] % 9999 + 1, 4))))
    day = F.date_add(F.lit(DATE_START).cast("date"), (v[0] * DATE_BASE + v[1]).cast("int"))
    return (F.when(kind == "ssn", ssn)
            .when(kind == "ipv4", F.array_join(F.transform(v, lambda x: x.cast("string")), "."))
            .otherwise(F.call_function("date_format", day, _calendar(m)["form"])))


def pseudonym(m: Column, key: Column, secret: Column) -> Column:
    """The pseudonym of a match, or the match itself if its check fails.

    ``secret`` says that the match is one by what stands before it, whatever
    its form.

    Kept as they are: the part of an address after the last point, a card's
    first digit, an account's country, a phone number's country. Only the
    places that change take part, so that a number written with other blanks
    or strokes gets the same pseudonym.
    """
    def replaced(kind: Column) -> Column:
        length = F.length(m)
        plus = F.length(F.regexp_extract(m, r"^(\+1(?![0-9])|\+\d{1,2})", 1))
        start = F.when(kind == "card", 1).when(kind == "iban", 4).when(kind == "phone", plus).otherwise(0)
        end = (F.when(kind == "email", length - F.length(F.substring_index(m, ".", -1)))
               .when(kind == "card", length - 1).otherwise(length))
        text = F.when(kind == "iban", F.concat(F.substr(m, F.lit(1), F.lit(2)), F.lit("00"), F.substr(m, F.lit(5)))).otherwise(m)
        counted = kind.isin("ssn", "ipv4", "date")
        values, bases = _numbers(m, kind)

        def permuted(places: Column) -> Column:
            free = F.filter(places, lambda x: x["b"] > 1)
            old = F.when(counted, values).otherwise(F.transform(free, lambda x: (F.ascii(x["c"]) - x["zero"]).cast("long")))
            base = F.when(counted, bases).otherwise(F.transform(free, lambda x: x["b"]))
            return let(feistel(old, base, key, kind),
                       lambda new: F.when(counted, _from_numbers(m, kind, new)).otherwise(_put(places, new)))

        plain = let(_places(text, start, end), permuted)
        return let(plain, lambda t: F.when(kind == "card", _with_card_check(t)).when(kind == "iban", _with_iban_check(t))
                   .otherwise(t))

    return let(F.when(secret, "secret").otherwise(kind_of(m)), lambda kind: F.when(kind.isNull(), m).otherwise(replaced(kind)))


def pseudonymise(documents: DataFrame, key: str | None = None, text: str = "text", key_file: str | None = None) -> DataFrame:
    """``documents`` with ``text`` rewritten; all other columns and the rows stay as they are.

    A null or empty text stays so. Texts are cut at their matches and put
    together again, so whatever is no match comes back unchanged at any
    length. Values whose check fails (a card number with a wrong check digit,
    the 31st of February) are not personal data of that kind and stay, unless
    a word such as ``password`` before them says that they are secret. Letters
    A-Z and digits are permuted, other letters of an address stay. A run of
    more than 256 letters before an ``@`` is no address.

    The key is given as it is, which shows it in plans and logs, or as the one
    line of ``key_file``, which any reader of Spark's can be asked for; then
    it is a column of a table of one row, and no plan holds it.
    """
    if (key is None) == (key_file is None):
        raise ValueError("give the key or the file that holds it")
    everything = "|".join(f"(?:{p})" for p in PATTERNS.values())
    rows, secret_key = documents, F.lit(key)
    if key_file is not None:
        name = f"_key_{uuid.uuid4().hex}"
        held = documents.sparkSession.read.text(key_file, wholetext=True).select(
            F.assert_true(F.length(F.trim("value")) > 0).isNull().alias("_ok"), F.regexp_replace("value", r"\s+$", "").alias(name))
        rows = documents.crossJoin(F.broadcast(held.where("_ok").select(name)))
        secret_key = F.col(name)
    found = F.regexp_extract_all(text, F.lit(everything), 0)
    gaps = F.split(text, everything, -1)
    parts = F.zip_with(gaps, found, lambda g, m: F.struct(g.alias("gap"), m.alias("match")))

    def rewritten(part: Column, at: Column) -> Column:
        # right behind another match there is only the rest of a long secret
        told = F.right(part["gap"], F.lit(24)).rlike(f"{LABEL}$") | ((part["gap"] == "") & (at > 0))
        return F.array(part["gap"], F.coalesce(pseudonym(part["match"], secret_key, told), F.lit("")))

    rebuilt = F.array_join(F.flatten(F.transform(parts, rewritten)), "")
    out = rows.withColumn(text, F.when(F.col(text).rlike(HINT), rebuilt).otherwise(F.col(text)))
    return out.select(documents.columns)
