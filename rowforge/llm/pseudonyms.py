"""Format-preserving pseudonyms for personal numbers, dates and addresses, in
DataFrame functions only.

Method: candidates found by pattern are validated (Luhn, mod 97, octet and
calendar ranges, number of digits).  A valid value becomes a sequence of
symbols, each with its own radix, which a keyed Feistel network permutes: the
two halves take turns in being shifted, symbol by symbol modulo the radix, by
a SHA-256 stream of the other half.  The result is rendered in the very format
of the original (separators, letter case, length, check digits recomputed), so
it is a valid value of the same kind, and since the permutation depends on the
symbols alone, equal values stay linked across documents and notations.

Kinds: card (Luhn digit recomputed), iban (check digits recomputed, either
case), ssn, phone, ip, ip6, date (1900-01-01 to 2099-12-31, any day to any day),
email (local part, letters of any script; the domain stays), and credentials
(``AKIA``, ``sk-`` and ``gh._`` keys and the values of password, secret, token and
key assignments), which are treated alike.  Groups of cards, phones and numbers of
the form 3-2-4 may be set off by blanks, hyphens or (cards, phones) dots; dates may
have one-digit days and months, or the year first with hyphens or slashes.

Not covered: names and postal addresses, months written as words, years of two
digits, phone numbers without separators or ``+``, IPv6 addresses of fewer than three
groups or with an IPv4 tail (equal addresses that are shortened differently
are not linked), and keys of other services.

The key is a secret: it is a column that comes from a one-row table, so
that neither plans nor ``explain()`` show it.  ``session_key`` takes it from the
setting ``spark.rowforge.pseudonym.key``; without one, the session draws its own.

Every position where a pattern matches is a candidate, unless it lies inside
a value that was replaced.  A candidate that fails as a whole is tried again
without its last groups, the longest valid form first, so what stands behind
or before a value does not hide it.  A long credential is permuted in parts of
64 to 191 characters, each by its place.

A text that holds the marker character U+E000 keeps it.  Edge cases: null
stays null; empty texts and texts without a valid value come back unchanged;
a value that fails validation in every form is left alone.
"""

from __future__ import annotations

import secrets
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 8            # even, so the halves end where they began
FIRST_DAY, YEARS_DAYS = "1900-01-01", (17, 4297)   # 17 * 4297 days to 2099-12-31

_MARK = "\ue000"
_WORD = r"(?<![A-Za-z0-9])"
_END = r"(?![A-Za-z0-9])"
_NO_LETTER = r"(?<![\p{L}\p{N}._%+-])"
_ASSIGN = r"(?:[Pp]assword|PASSWORD|[Pp]asswd|[Ss]ecret|SECRET|[Tt]oken|TOKEN|[Aa]pi_?[Kk]ey|API_?KEY)"

_KEY_HEAD = r"(?:sk-|gh[opsu]_)"
_HEX = "[0-9A-Fa-f]{1,4}"
_SEPARATORS = (" ", "-", r"\.")


def _iban(c: str) -> str:
    return rf"[{c}]{{2}}\d{{2}}(?:[{c}0-9]{{11,30}}|(?: [{c}0-9]{{4}}){{2,7}}(?: [{c}0-9]{{1,3}})?)"


def _groups(sep: str) -> str:
    """A card in groups; three groups only at the front of a row of groups: the
    end of a longer number is none."""
    return (rf"\d{{4}}(?:{sep}\d{{4}}){{3}}(?:{sep}\d{{1,3}})?|(?<!\d{{4}}{sep})\d{{4}}(?:{sep}\d{{4}}){{2}}(?:{sep}\d{{1,3}})?"
            rf"|\d{{4}}{sep}\d{{6}}{sep}\d{{5}}")


# One pattern per kind, tried in this order.
PATTERNS = {
    "email": _NO_LETTER + r"[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}+@[\p{L}\p{N}-]{1,63}+(?:\.[\p{L}\p{N}-]{1,63}+){1,8}+",
    "credential": _WORD + r"(?:AKIA[0-9A-Z]{16}" + _END + "|" + _KEY_HEAD + "[A-Za-z0-9]{20,}+|"
                  + _ASSIGN + r"[ ]?[=:][ ]?[\"']?[A-Za-z0-9_+/-]{8,}+)",
    "iban": _WORD + "(?:" + _iban("A-Z") + "|" + _iban("a-z") + ")" + _END,
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "ip6": rf"(?<![0-9A-Za-z:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}(?::{_HEX}){{0,5}})?::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![0-9A-Za-z:]|\.\d)",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-])",
    "ssn": r"(?<![\d-])(?:\d{3}-\d{2}-\d{4}|(?<!\d )\d{3} \d{2} \d{4}(?! \d))(?![\d-])",
    "phone": r"(?:\+\d{1,3}[ .-]?|(?<![\dA-Za-z.-]))(?:\(\d{3}\)[ .-]?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\d)"
             r"|(?<![\dA-Za-z.-])(?<!\d )\d{3} \d{3} \d{4}(?! ?\d)"
             r"|\+\d{1,3}(?:[ .-]\d{1,4}){2,6}(?!\d)|\+\d{8,15}(?!\d)",
    "card": _WORD + r"(?:\d{13,19}|" + "|".join(map(_groups, _SEPARATORS)) + ")" + _END,
}
_ANY = "|".join(PATTERNS.values())
_NO_SYMBOL = r"[^\p{L}0-9]"
_LONG_PARTS = "(?s).{128}(?=.{64})|.{1,191}"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _symbols(text: Column) -> Column:
    """The letters and digits of a string as (value, radix); letters A-Z count
    the same in either case, any other one by its place in its 64 code points."""
    chars = F.split(F.regexp_replace(text, _NO_SYMBOL, ""), "")
    number = lambda v, m: F.struct(v.cast("long").alias("v"), F.lit(m).cast("long").alias("m"))
    return F.transform(F.filter(chars, lambda c: c != ""), lambda c: F.when(
        c.rlike("[0-9]"), number(F.ascii(c) - 48, 10)).when(
        c.rlike("[A-Za-z]"), number(F.ascii(F.lower(c)) - 97, 26)).otherwise(number(F.ascii(c) % 64, 64)))


def _numbers(*values_and_radices: tuple[Column, int]) -> Column:
    return F.array(*[F.struct(v.cast("long").alias("v"), F.lit(m).cast("long").alias("m"))
                     for v, m in values_and_radices])


def permute(symbols: Column, kind: Column, key: Column) -> Column:
    """The keyed Feistel permutation of an array of (value, radix): the new
    values, each below the radix of its position."""
    def turn(state: Column, number: Column) -> Column:
        other = F.array_join(F.transform(state["right"], lambda y: y["v"].cast("string")), ",")

        def shifted(seed: Column) -> Column:
            return F.transform(state["left"], lambda x, place: F.struct(
                ((x["v"] + F.conv(F.substring(F.sha2(F.concat(place.cast("string"), F.lit("|"), seed), 256), 1, 14),
                                  16, 10).cast("long")) % x["m"]).alias("v"), x["m"].alias("m")))

        return F.struct(state["right"].alias("left"), _let(
            F.concat_ws("|", key, kind, number.cast("string"), other), shifted).alias("right"))

    def run(all_of: Column) -> Column:
        half = F.floor(F.size(all_of) / 2).cast("int")
        start = F.struct(F.slice(all_of, F.lit(1), half).alias("left"),
                         F.slice(all_of, half + 1, F.size(all_of) - half).alias("right"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn,
                           lambda end: F.transform(F.concat(end["left"], end["right"]), lambda x: x["v"]))

    return _let(symbols, run)


def _char(code: Column) -> Column:
    """The character of a code point."""
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")


def _rendered(shape: Column, values: Column) -> Column:
    """``shape`` with its letters and digits replaced in order by ``values``,
    which has to be a variable or column."""
    def one(c: Column, i: Column) -> Column:
        place = F.length(F.regexp_replace(F.substring(shape, F.lit(1), i), _NO_SYMBOL, ""))
        return F.when(c.rlike(r"[\p{L}0-9]"), _let(F.get(values, place).cast("int"), lambda v: F.when(
            c.rlike("[0-9]"), v.cast("string")).when(c.rlike("[a-z]"), F.char(v + 97))
            .when(c.rlike("[A-Z]"), F.char(v + 65)).otherwise(_char(F.ascii(c) - F.ascii(c) % 64 + v))
        )).otherwise(c)
    return F.array_join(F.transform(F.split(shape, ""), one), "")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_sum(digits: Column, double_last: bool) -> Column:
    """Sum of the Luhn scheme from the right, doubling the last digit or not."""
    def add(s: Column, c: Column) -> Column:
        twice = c.cast("int") * 2
        return F.struct((s["sum"] + F.when(s["twice"], F.floor(twice / 10).cast("int") + twice % 10)
                         .otherwise(c.cast("int"))).alias("sum"), (~s["twice"]).alias("twice"))
    return F.aggregate(F.split(F.reverse(digits), ""),
                       F.struct(F.lit(0).alias("sum"), F.lit(double_last).alias("twice")), add, lambda s: s["sum"])


def _mod97(text: Column) -> Column:
    return F.aggregate(F.split(text, ""), F.lit(0), lambda s, c: F.when(
        c.rlike("[0-9]"), (s * 10 + F.ascii(c) - 48) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97))


def _day(m: Column) -> Column:
    read = lambda p: F.try_to_timestamp(m, F.lit(p)).cast("date")
    return (F.when(m.rlike(r"^\d{4}-"), read("yyyy-MM-dd")).when(m.rlike(r"^\d{4}/"), read("yyyy/MM/dd"))
            .when(m.contains("."), read("d.M.yyyy")).otherwise(F.coalesce(read("d/M/yyyy"), read("M/d/yyyy"))))


def _day_text(m: Column, day: Column) -> Column:
    """``day`` in the form of ``m``; with a one-digit day or month, neither is padded."""
    day_first = F.try_to_timestamp(m, F.lit("d/M/yyyy")).isNotNull()
    form = (F.when(m.rlike(r"^\d{4}-"), "yyyy-MM-dd").when(m.rlike(r"^\d{4}/"), "yyyy/MM/dd")
            .when(m.contains("."), "dd.MM.yyyy").when(day_first, "dd/MM/yyyy").otherwise("MM/dd/yyyy"))
    short = ~m.rlike(r"^(?:\d{4}|\d{2}[./]\d{2}[./])")
    form = F.when(short, F.replace(F.replace(form, F.lit("dd"), F.lit("d")), F.lit("MM"), F.lit("M"))).otherwise(form)
    return F.call_function("date_format", day, form)


def _day_number(m: Column) -> Column:
    return F.datediff(_day(m), F.lit(FIRST_DAY).cast("date"))


def _part(m: Column, start: int, length: int) -> Column:
    return F.substring(m, start, length).cast("int")


def _valid(m: Column) -> dict[str, Column]:
    """The test of each kind beyond its pattern."""
    plain = F.upper(F.regexp_replace(m, " ", ""))
    groups = F.filter(F.split(m, ":"), lambda g: g != "")
    return {
        "email": F.lit(True),
        "credential": F.lit(True),
        "iban": F.length(plain).between(15, 34) & (_mod97(F.concat(
            F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1),
        "ip": F.forall(F.split(m, r"\."), lambda x: x.cast("int") <= 255) & ~m.rlike(r"(?:^|\.)0\d"),
        "ip6": F.size(groups).between(3, 8) & m.rlike("[0-9]"),
        "date": F.coalesce(_day_number(m).between(0, YEARS_DAYS[0] * YEARS_DAYS[1] - 1), F.lit(False)),
        "ssn": (_part(m, 1, 3).between(1, 899) & (_part(m, 1, 3) != 666) & (_part(m, 5, 2) > 0)
                & (_part(m, 8, 4) > 0)),
        "phone": F.length(_digits(m)).between(7, 15),
        "card": (_let(_digits(m), lambda d: luhn_sum(d, False)) % 10 == 0) & ~_digits(m).rlike("^0+$"),
    }


def _kind(m: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, valid in reversed(_valid(m).items()):
        out = F.when(m.rlike("^(?:" + PATTERNS[kind] + ")$") & valid, F.lit(kind)).otherwise(out)
    return out


def _head(m: Column, kind: Column) -> Column:
    """What stays in front of the permuted part: a country code that is set
    off (else all but the last ten digits), a key's name, or nothing."""
    code = F.regexp_extract(m, r"^\+\d{1,3}(?=[ .(-])[ .-]?", 0)
    code = F.when((code == "") & m.startswith("+"),
                  F.substring(m, F.lit(1), F.greatest(F.length(m) - 10, F.lit(1)))).otherwise(code)
    name = F.regexp_extract(m, r"^(?:AKIA(?=[0-9A-Z]{16}$)|" + _KEY_HEAD + "|" + _ASSIGN + r"[ ]?[=:][ ]?[\"']?)", 0)
    return F.when(kind == "phone", code).when(kind == "credential", name).otherwise(F.lit(""))


def _body(m: Column, kind: Column, head: Column) -> Column:
    """The part whose characters are permuted one by one."""
    rest = F.substring(m, F.length(head) + 1, F.length(m))
    plain = F.regexp_replace(m, " ", "")
    return (F.when(kind == "email", F.substring_index(m, "@", 1))
            .when(kind == "card", F.substring(_digits(m), F.lit(1), F.length(_digits(m)) - 1))
            .when(kind == "iban", F.substring(plain, F.lit(5), F.length(plain))).otherwise(rest))


def _symbols_of(m: Column, kind: Column, body: Column) -> Column:
    octets = F.split(m, r"\.")
    area = _part(m, 1, 3)
    years, days = YEARS_DAYS
    hexes = F.filter(F.split(F.replace(m, F.lit(":"), F.lit("")), ""), lambda c: c != "")
    return (F.when(kind == "ip", _numbers(*[(F.get(octets, i), 256) for i in range(4)]))
            .when(kind == "ip6", F.transform(hexes, lambda c: F.struct(
                F.conv(c, 16, 10).cast("long").alias("v"), F.lit(16).cast("long").alias("m"))))
            .when(kind == "date", _let(_day_number(m), lambda n: _numbers(
                (F.floor(n / days), years), (n % days, days))))
            .when(kind == "ssn", _numbers((area - 1 - F.when(area > 666, 1).otherwise(0), 898),
                                          (_part(m, 5, 2) - 1, 99), (_part(m, 8, 4) - 1, 9999)))
            .otherwise(_symbols(body)))


def _iban_text(m: Column, new: Column) -> Column:
    """Country, new check digits and new body, with the blanks of ``m``."""
    check = F.lpad((98 - _mod97(F.upper(F.concat(new, F.substring(m, 1, 2), F.lit("00"))))).cast("string"), 2, "0")
    return _let(F.split(F.concat(F.substring(m, 1, 2), check, new), ""), lambda chars: F.array_join(F.transform(
        F.split(m, ""), lambda c, i: F.when(c == " ", c).otherwise(F.get(
            chars, F.length(F.regexp_replace(F.substring(m, F.lit(1), i), " ", ""))))), ""))


def _ip6_text(m: Column, values: Column) -> Column:
    """The hexadecimal digits of ``m`` replaced in order, in its letter case."""
    place = lambda i: F.length(F.replace(F.substring(m, F.lit(1), i), F.lit(":"), F.lit("")))
    new = F.array_join(F.transform(F.split(m, ""), lambda c, i: F.when(c.isin("", ":"), c).otherwise(
        F.lower(F.hex(F.get(values, place(i)))))), "")
    return F.when(m.rlike("[A-F]"), F.upper(new)).otherwise(new)


def _text(m: Column, kind: Column, head: Column, body: Column, values: Column) -> Column:
    area = F.get(values, 0) + 1
    padded = lambda c, n: F.lpad(c.cast("string"), n, "0")
    moved = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.get(values, 0) * YEARS_DAYS[1] + F.get(values, 1)).cast("int"))
    check = _let(F.array_join(values, ""), lambda d: (10 - luhn_sum(d, True) % 10) % 10)
    return (F.when(kind == "ip", F.array_join(values, "."))
            .when(kind == "ip6", _ip6_text(m, values))
            .when(kind == "date", _let(moved, lambda d: _day_text(m, d)))
            .when(kind == "ssn", F.concat(padded(area + F.when(area >= 666, 1).otherwise(0), 3), F.substring(m, 4, 1),
                                          padded(F.get(values, 1) + 1, 2), F.substring(m, 7, 1),
                                          padded(F.get(values, 2) + 1, 4)))
            .when(kind == "card", _let(F.array_append(values, check.cast("long")), lambda v: _rendered(m, v)))
            .otherwise(_let(_rendered(body, values), lambda new: F.when(kind == "iban", _iban_text(m, new)).otherwise(
                F.concat(head, new, F.substring(m, F.length(head) + F.length(body) + 1, F.length(m)))))))


def _long_text(m: Column, head: Column, key: Column) -> Column:
    """A credential whose parts are permuted one by one: short ones in one part."""
    parts = F.regexp_extract_all(F.substring(m, F.length(head) + 1, F.length(m)), F.lit(_LONG_PARTS), F.lit(0))
    new = F.transform(parts, lambda part, i: _let(
        permute(_symbols(part), F.concat(F.lit("credential"), F.when(i > 0, i.cast("string")).otherwise("")), key),
        lambda values: _rendered(part, values)))
    return F.concat(head, F.array_join(new, ""))


def _form(m: Column) -> Column:
    """(kind, length) of the longest valid form of a candidate: all of it, or
    what stands before one of its blanks, dots or hyphens; else null."""
    size = F.length(m)
    ends = F.filter(F.sequence(size - 1, F.lit(1), F.lit(-1)),
                    lambda n: F.substring(m, n + 1, F.lit(1)).isin(" ", ".", "-"))
    form = lambda kind, n: F.struct(kind.alias("kind"), n.cast("int").alias("size"))
    shorter = F.get(F.filter(F.transform(ends, lambda n: form(_kind(F.substring(m, F.lit(1), n)), n)),
                             lambda f: f["kind"].isNotNull()), 0)
    return _let(_kind(m), lambda kind: F.when(kind.isNotNull(), form(kind, size)).otherwise(shorter))


def _replaced(c: Column, key: Column) -> Column:
    """(kind, new text, length of what it replaces) of a candidate; (null,
    empty, 0) if no form of it is valid."""
    def known(kind: Column, m: Column) -> Column:
        return _let(_head(m, kind), lambda head: F.when(kind == "credential", _long_text(m, head, key)).otherwise(
            _let(_body(m, kind, head), lambda body: _let(
                permute(_symbols_of(m, kind, body), kind, key), lambda v: _text(m, kind, head, body, v)))))

    def new(form: Column) -> Column:
        text = _let(F.substring(c, F.lit(1), form["size"]), lambda m: known(form["kind"], m))
        return F.struct(form["kind"].alias("kind"), F.when(form.isNull(), "").otherwise(text).alias("text"),
                        F.coalesce(form["size"], F.lit(0)).alias("size"))
    return _let(_form(c), new)


KEY_SETTING = "spark.rowforge.pseudonym.key"
_drawn: dict[str, str] = {}


def session_key(spark: SparkSession) -> str:
    """The secret that the session is set to, or one drawn for it."""
    drawn = _drawn.setdefault(spark.sparkContext.applicationId, secrets.token_hex(16))
    return spark.conf.get(KEY_SETTING, None) or drawn


def pseudonymise(docs: DataFrame, key: str, *, text_col: str = "text") -> DataFrame:
    """``docs`` with the text rewritten, and ``pseudonyms`` (kind and new
    value of every replacement, in order)."""
    held = docs.sparkSession.createDataFrame(pa.table({"key": [key]}))     # one row, no RDD
    docs, key = docs.withColumn("__key", held.scalar()), F.col("__key")
    text = F.col(f"`{text_col}`").cast("string")
    # before each place where a candidate starts: a mark, the candidate, a mark
    marked = F.regexp_replace(F.replace(text, F.lit(_MARK), F.lit(_MARK + "0")), f"(?=({_ANY}))",
                              _MARK + "1$1" + _MARK + "2")
    unmarked = lambda piece: F.replace(piece, F.lit(_MARK + "0"), F.lit(_MARK))

    def step(acc: Column, piece: Column) -> Column:
        """acc: characters that the last value still covers, and what is done:
        (kind, new value, text behind it)."""
        def after(candidate: Column, behind: Column) -> Column:
            none = F.struct(F.lit(None).cast("string").alias("kind"), F.lit("").alias("text"), acc["covered"].alias("size"))
            return _let(F.when(acc["covered"] > 0, none).otherwise(_replaced(candidate, key)), lambda r: F.struct(
                F.greatest(r["size"] - F.length(behind), F.lit(0)).alias("covered"),
                F.array_append(acc["done"], F.struct(r["kind"].alias("kind"), r["text"].alias("text"), F.substring(
                    behind, r["size"] + 1, F.length(behind)).alias("rest"))).alias("done")))
        return _let(F.substring_index(piece, _MARK + "2", 1), lambda candidate: _let(
            F.substring(piece, F.length(candidate) + 3, F.length(piece)), lambda behind: after(candidate, behind)))

    cut = docs.withColumn("__pieces", F.split(marked, _MARK + "1", -1))
    start = F.struct(F.lit(0).alias("covered"), F.array().cast(
        "array<struct<kind: string, text: string, rest: string>>").alias("done"))
    cut = cut.withColumn("__done", F.when(F.size("__pieces") > 1, F.aggregate(
        F.slice("__pieces", F.lit(2), F.size("__pieces")), start, step, lambda acc: acc["done"])))
    found = F.transform(F.filter("__done", lambda p: p["kind"].isNotNull()),
                        lambda p: F.struct(p["kind"].alias("kind"), p["text"].alias("text")))
    whole = F.concat(F.get("__pieces", F.lit(0)), F.array_join(F.transform(
        "__done", lambda p: F.concat(p["text"], p["rest"])), ""))
    return (cut.withColumn(text_col, F.when(F.col("__done").isNull(), text).otherwise(unmarked(whole)))
            .withColumn("pseudonyms", F.coalesce(found, F.array().cast(
                "array<struct<kind: string, text: string>>"))).drop("__pieces", "__done", "__key"))
