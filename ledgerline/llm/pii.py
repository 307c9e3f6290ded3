"""Personal data spans, with DataFrame functions only: propose, confirm, score.

Regular expressions propose spans; validators confirm them (address parts, Luhn,
digit counts, mod-97); words near a span, on either side, raise its score. A span's
offsets come from splitting the text at the same matches: the lengths of the parts
before it, in code points.

The expressions find what the plain ones of ``PLAIN`` find, but cannot run in
quadratic time or deep recursion on long texts: quantifiers are possessive where
nothing that follows could match what they took, and a start inside a run that
already failed is excluded by a look-behind (unless the last match ended there).

Kinds, in the order that breaks ties of a start: email, ip, card, phone (always
kept when valid), iban (length of its country, mod-97), ssn (kept when a context
word stands near). An IBAN's pattern takes its first four characters only; its end
is the last word's end at which it is valid, so what follows cannot spoil one.

Defined cases: a null or empty text has no spans; every input row gives one row;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import table, text_or_empty

#: Fixed patterns of the four base kinds, as the data contract states them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BASE = list(PLAIN)
#: Characters on each side of a span that are searched for context words.
NEAR = 40
#: Characters of the longest IBAN in groups of four, and what ends it: 34, 8 spaces, 2 more.
IBAN_REACH = 44
#: Length of an IBAN by country; other countries may have any length from 15 to 34.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "AO CV LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
LISTED = "|".join(" ".join(IBAN_LENGTHS.values()).split())


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a character (class) without which the pattern cannot match
    score: float
    context: str
    least: float = 0.0  # spans below this score are dropped


KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8, "mail|contact|write"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, "ip|address|host|server"),
    # Matches are maximal runs of digits with single separators; only those of 12 to 19 digits can be valid.
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])", "", 0.7, "card|visa|master|credit|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.6, "phone|call|tel|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Za-z0-9]){11})", "", 0.8, "iban|account|bank|konto"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.4, "ssn|social|security", 0.5),
]


def digits_of(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn sum of a digit string is a multiple of 10."""
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = back.substr(i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """The IBAN, its first four characters moved to the end and letters as 10 to 35, is 1 modulo 97."""
    plain = F.regexp_replace(iban, " ", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(turned.substr(i, F.lit(1)))
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def valid(kind: str, span: Column) -> Column:
    if kind == "ip":
        return span.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$")
    if kind == "card":
        return luhn(digits_of(span))
    if kind == "phone":
        return F.length(digits_of(span)).between(9, 15)
    if kind == "iban":
        of = [f"(?:{'|'.join(c.split())})[0-9]{{2}}[A-Z0-9]{{{n - 4}}}" for n, c in IBAN_LENGTHS.items()]
        other = f"(?!{LISTED})[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}"
        return (span.rlike(r"^[A-Z0-9]{4}(?:\x20?[A-Z0-9]{4})+(?:\x20?[A-Z0-9]{1,3})?$")
                & F.regexp_replace(span, " ", "").rlike(f"^(?:{'|'.join([*of, other])})$") & mod97(span))
    return F.lit(True)


def iban(reach: Column) -> Column:
    """The longest valid IBAN at the start of ``reach`` that ends where a word ends, or null."""
    words = F.split(F.regexp_extract(F.left(reach, F.lit(IBAN_REACH)), r"^(?:\x20?[A-Za-z0-9])++", 0), " ", -1)
    state = "struct<upto:string,best:string>"

    def step(acc: Column, word: Column) -> Column:
        upto = F.concat_ws(" ", acc["upto"], word)
        return F.struct(upto.alias("upto"), F.when(valid("iban", upto), upto).otherwise(acc["best"]).alias("best")).cast(state)

    begin = F.struct(F.lit(None).alias("upto"), F.lit(None).alias("best")).cast(state)
    return F.aggregate(words, begin, step, lambda acc: acc["best"])


def spans_of(kind: Kind, rank: int, text: Column, found: Column, after: Column) -> Column:
    """array<struct<start, rank, end, kind, score>> of a kind's confirmed spans; ``found``: its matches, ``after``: what follows each."""
    element = "struct<start:int,rank:int,end:int,kind:string,score:double>"
    state = f"struct<at:int,past:int,near:string,spans:array<{element}>>"
    span_of = lambda match, rest: iban(F.concat(match, rest)) if kind.name == "iban" else F.when(valid(kind.name, match), match)
    pairs = F.arrays_zip(F.split(text, kind.pattern, -1).alias("before"), found.alias("match"), after.alias("after"), F.zip_with(found, after, span_of).alias("span"))

    def step(acc: Column, pair: Column) -> Column:
        match, span = pair["match"], pair["span"]
        start = acc["at"] + F.length(pair["before"])
        end = start + F.length(span)
        near = F.right(F.concat(acc["near"], F.right(pair["before"], F.lit(NEAR))), F.lit(NEAR))
        rest = F.substring(pair["after"], F.length(span) - F.length(match) + 1, F.lit(NEAR))
        raised = F.lower(near).rlike(kind.context) | F.lower(rest).rlike(kind.context)
        score = F.when(raised, F.lit(min(1.0, kind.score + 0.2))).otherwise(F.lit(kind.score))
        one = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind.name).alias("kind"), score.alias("score")).cast(element))
        # Only an IBAN can begin inside another; a known country's is not hidden by an accidental one around it.
        apart = (start >= acc["past"]) | match.rlike(f"^(?:{LISTED})") if kind.name == "iban" else F.lit(True)
        keep = span.isNotNull() & apart & (score >= kind.least)
        return F.struct((start + F.coalesce(F.length(match), F.lit(0))).alias("at"), F.when(keep, end).otherwise(acc["past"]).alias("past"),
                        F.right(F.concat(near, F.coalesce(match, F.lit(""))), F.lit(NEAR)).alias("near"),
                        F.when(keep, F.concat(acc["spans"], one)).otherwise(acc["spans"]).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("past"), F.lit("").alias("near"), F.array().cast(f"array<{element}>").alias("spans")).cast(state)
    spans = F.aggregate(pairs, begin, lambda a, p: step(a, p).cast(state), lambda a: a["spans"])
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(f"array<{element}>"))


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``spans``: array<struct<start, rank, end, kind, score>> by start, then kind."""
    text = F.col("_text")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(f"`{text_col}`").alias("_text"))
    none = F.array().cast("array<string>")
    found = {f"_{k.name}": F.when(F.contains(text, F.lit(k.needs)), F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0))).otherwise(none) for k in KINDS}
    rows = rows.withColumns(found)
    # A second look, at texts with matches only, for the characters that follow each.
    reach = lambda k: NEAR + (IBAN_REACH if k.name == "iban" else 0)
    after = lambda k: F.regexp_extract_all(text, F.lit(f"(?:{k.pattern})(?=([\\s\\S]{{0,{reach(k)}}}))"), F.lit(1))
    after_of = {k.name: F.when(F.size(f"_{k.name}") > 0, after(k)).otherwise(none) for k in KINDS}
    spans = F.concat(*[spans_of(k, i, text, F.col(f"_{k.name}"), after_of[k.name]) for i, k in enumerate(KINDS)])
    return rows.select("doc_id", F.array_sort(spans).alias("spans"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_spans(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
                        F.sha2(joined(F.filter("spans", lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
