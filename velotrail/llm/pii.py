"""Personal data: regular expressions propose spans, checksums confirm them, words nearby adjust the score.

Every kind has a pattern, a test on the match and a base score; all of it is built-in functions.  Patterns are written so
that a failing start costs no more than its own run of characters: runs are possessive, and a match begins where such a run
begins or where the last match ended.  The positions of the matches follow from the pieces that the pattern splits the
text into.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries summed one by one; longer arrays are summed block by block.
RUN = 64
#: Code points on either side that are searched for context words.
NEAR = 40


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn test: from the right, every other digit is doubled and reduced by 9 beyond 9."""
    places = F.sequence(F.lit(1), F.length(digits))
    digit = lambda k: F.substring(F.reverse(digits), k, F.lit(1)).cast("int")
    value = lambda k: F.when(k % 2 == 1, digit(k)).otherwise(digit(k) * 2 - F.when(digit(k) > 4, 9).otherwise(0))
    return F.aggregate(places, F.lit(0), lambda total, k: total + value(k)) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without spaces passes mod-97: four characters to the end, letters as 10 to 35, rest 1."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))
    code = lambda c: F.when(c.between("0", "9"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda rest, c: (rest * F.when(code(c) > 9, 100).otherwise(10) + code(c)) % 97
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda rest, c: F.when(F.length(c) == 1, step(rest, c)).otherwise(rest)) == 1


# What the kinds look like, in the order in which they are listed.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Account numbers by the registered length of their country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
IBAN = (r"(?<![A-Za-z0-9])(?:" + "|".join(f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{length - 4}}}"
                                         for length, countries in IBAN_LENGTHS.items()) + r")(?![A-Za-z0-9])")


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A character or pattern without which the text is not searched.
    hint: str
    #: Score without context, and words nearby that raise it.
    score: float
    words: tuple[str, ...]

    def context(self) -> str:
        """One of the words, between characters that are no letters or digits."""
        return rf"[^\p{{L}}\p{{N}}](?:{'|'.join(self.words)})[^\p{{L}}\p{{N}}]"

    def valid(self, match: Column) -> Column:
        digits = _digits(match)
        if self.name == "ip":
            return match.rlike(IP_PARTS)
        if self.name == "card":
            return F.length(digits).between(14, 19) & luhn(digits)
        if self.name == "phone":
            return F.length(digits).between(10, 15)
        if self.name == "iban":
            return mod97(F.replace(match, F.lit(" "), F.lit("")))
        return F.lit(True)


KINDS = (
    Kind("email", EMAIL, "@", 0.9, ("email", "e-mail", "mail", "contact", "write to", "correo", "courriel", "kontakt")),
    Kind("ip", IP, ".", 0.6, ("ip", "address", "host", "server", "login", "client", "connect")),
    Kind("card", CARD, "[0-9]", 0.8, ("card", "visa", "mastercard", "amex", "credit", "payment", "karte", "carte", "tarjeta")),
    Kind("phone", PHONE, "+", 0.7, ("phone", "tel", "call", "mobile", "fax", "telefon", "teléfono", "téléphone")),
    Kind("iban", IBAN, "[A-Z]{2}[0-9]{2}", 0.85, ("iban", "account", "bank", "transfer", "konto", "compte", "cuenta")),
)
BASE = ("email", "ip", "card", "phone")


def running_sums(lengths: Column) -> Column:
    """Sums of the entries before each, in time that grows little faster than the array."""

    def within(own: Column) -> Column:
        return F.aggregate(own, F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("all")),
                           lambda acc, n: F.struct((acc["sum"] + n).alias("sum"), F.concat(acc["all"], F.array(acc["sum"])).alias("all")))

    def blocks(own: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / RUN).cast("int")),
                           lambda k: within(F.slice(own, k * RUN + 1, F.lit(RUN))))

    def offset(parts: Column) -> Column:
        before = within(F.transform(parts, lambda p: p["sum"]))["all"]
        return F.flatten(F.zip_with(parts, before, lambda p, b: F.transform(p["all"], lambda n: n + b)))

    return F.when(F.size(lengths) > 0, offset(blocks(lengths))).otherwise(F.array().cast("array<int>"))


def _searched(kind: Kind, text: Column) -> Column:
    return text.rlike(kind.hint) if kind.hint.startswith("[") else text.contains(kind.hint)


def _spans(number: int, kind: Kind) -> Column:
    """Spans of the valid matches of one kind, from its matches and the lengths of the pieces before them."""
    found, before = F.col(f"{kind.name}_found"), F.col(f"{kind.name}_at")
    steps = F.zip_with(before, found, lambda a, m: a + F.length(m))
    starts = F.zip_with(running_sums(steps), before, lambda s, a: s + a)
    spans = F.zip_with(starts, found, lambda s, m: F.struct(
        s.alias("start"), F.lit(number).alias("number"), F.lit(kind.name).alias("kind"), (s + F.length(m)).alias("end"), m.alias("match")))
    return F.filter(spans, lambda x: kind.valid(x["match"]))


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text, and spans, an array of (kind, start, end, match, score).

    Starts and ends are code points, ends exclusive.  Matches of a kind are its pattern's leftmost ones that don't overlap;
    those that fail the kind's test are dropped and not tried again.  The score is the kind's, raised by 0.1 (1 at most)
    when one of its context words stands, as a whole word, within NEAR code points.  Spans come by start, then by kind in the order of KINDS.
    Null counts as empty and has no spans; repeated rows are judged alike.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    found = {f"{k.name}_found": F.when(_searched(k, F.col("text")), F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))).otherwise(none) for k in KINDS}
    rows = rows.withColumns(found)
    # Lengths of the pieces before each match and of the match, summed up to each match's start.
    pieces = {f"{k.name}_at": F.when(F.size(f"{k.name}_found") > 0, F.transform(
        F.slice(F.split("text", k.pattern, -1), F.lit(1), F.size(f"{k.name}_found")), F.length)) for k in KINDS}
    rows = rows.withColumns(pieces)
    spans = {}
    for number, k in enumerate(KINDS):
        spans[f"{k.name}_spans"] = F.when(F.size(f"{k.name}_found") > 0, _spans(number, k))
    rows = rows.withColumns(spans)
    empty = F.array().cast("array<struct<start:int,number:int,kind:string,end:int,match:string>>")
    every = F.array_sort(F.concat(*[F.coalesce(f"{k.name}_spans", empty) for k in KINDS]))

    def scored(x: Column) -> Column:
        # One code point more on either side shows whether a word goes on there; a space stands for the end of the text.
        left = F.substring(F.col("text"), F.greatest(F.lit(1), x["start"] - NEAR), F.least(F.lit(NEAR + 1), x["start"]))
        right = F.substring(F.col("text"), x["end"] + 1, F.lit(NEAR + 1))
        near = F.lower(F.concat(F.when(x["start"] <= NEAR, " ").otherwise(""), left, F.lit(" "), right, F.when(F.length(right) <= NEAR, " ").otherwise("")))
        score = reduce(lambda rest, k: F.when(x["kind"] == k.name, F.least(F.lit(1.0), F.lit(k.score) + F.when(
            near.rlike(k.context()), 0.1).otherwise(0.0))).otherwise(rest), KINDS, F.lit(0.0))
        return F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"), score.alias("score"))

    return rows.select("doc_id", "text", every.alias("spans")).withColumn("spans", F.transform("spans", scored))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
