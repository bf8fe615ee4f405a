"""Personal data: patterns propose spans, checksums confirm them, context weighs them.

Column expressions only. Positions come from the text between matches: splitting by a
pattern gives the gaps, extracting gives the matches, and running lengths of both give
starts and ends in code points.

The patterns are the plain ones with possessive repeats, so no text makes the matcher
backtrack or recurse, and with a look-behind where a match cannot begin inside a run of
the characters it starts with; both leave the matches as they are. An IBAN has the
length of its country instead, as what follows it may look like a further group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.words import let, text_or_empty

LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
EMAIL = f"(?:\\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\\.{LABEL}++)++"
IP = "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
#: A card number is a whole run of digits with single separators; only runs of 16 to 19
#: digits are of use, and the look-arounds keep a longer run from giving a part of itself.
CARD = "(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])"
PHONE = "\\+[0-9][ ().0-9-]+[0-9]"
#: Characters of an IBAN by country, so that no match takes in the words after an account.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}


def _iban() -> str:
    """Accounts of the listed countries at their length; other codes as long as they go."""
    known = "|".join(IBAN_LENGTHS.values()).replace(" ", "|")
    forms = [f"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?"]
    for length, codes in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
        forms.append(f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}")
    return f"(?<![A-Za-z0-9])(?:{'|'.join(forms)})(?![A-Za-z0-9])"


IBAN = _iban()
NATIONAL_ID = "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = "(?<![0-9+)(] ?)\\([0-9]{3}\\) [0-9]{3}-[0-9]{4}(?![0-9-])"
BASE_KINDS = ("email", "ip", "card", "phone")


@dataclass(frozen=True)
class Scores:
    """How context decides on the spans that the method adds to the base ones."""

    reach: int = 40
    near: float = 0.4
    accept: float = 0.5


def digits(text: Column) -> Column:
    """A text without its characters other than 0-9, for short texts."""
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The Luhn check over a string of digits."""

    def doubled(d: Column) -> Column:
        return F.when(d > 4, 2 * d - 9).otherwise(2 * d)

    values = F.transform(F.split(F.reverse(number), ""), lambda c: c.cast("int"))
    weighed = F.transform(values, lambda d, i: F.when(i % 2 == 1, doubled(d)).otherwise(d))
    return F.aggregate(weighed, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def mod_97(account: Column) -> Column:
    """The check of an IBAN: its first four characters last, letters as 10 to 35, mod 97 is 1."""
    compact = F.translate(account, " ", "")
    turned = F.concat(F.substring(compact, 5, 100), F.substring(compact, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        digit = F.ascii(c) - 48
        return F.when(digit < 10, (rest * 10 + digit) % 97).otherwise((rest * 100 + digit - 7) % 97)

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def valid_ip(match: Column) -> Column:
    """Four parts of at most 255 each, leading zeros allowed."""
    return F.forall(F.split(match, "[.]"), lambda p: F.regexp_replace(p, "^0+", "").rlike("^([0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


SPANS = "array<struct<m:string,s:int,e:int>>"


def matches(text: Column, pattern: str, hint: str) -> Column:
    """All matches of a pattern with ``start`` and ``end``, leftmost and non-overlapping.

    ``hint`` is a cheap pattern without which a text has no match.
    """

    def placed(gaps: Column, found: Column) -> Column:
        begin = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("out"))

        def step(acc: Column, pair: Column) -> Column:
            start = acc["at"] + pair["g"]
            end = start + F.length(pair["m"])
            span = F.struct(pair["m"].alias("m"), start.alias("s"), end.alias("e"))
            return F.struct(end.alias("at"), F.array_append(acc["out"], span).alias("out"))

        pairs = F.transform(found, lambda m, i: F.struct(F.length(F.get(gaps, i)).alias("g"), m.alias("m")))
        return F.aggregate(pairs, begin, step, lambda acc: acc["out"])

    empty = F.array().cast(SPANS)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    some = let(
        found,
        lambda f: F.when(F.size(f) == 0, empty).otherwise(
            let(F.split(text, pattern, -1), lambda gaps: placed(gaps, f))
        ),
    )
    return F.when(text.rlike(hint), some).otherwise(empty)


def _kind(spans: Column, kind: str, score: Column | float) -> Column:
    """Spans as (kind, s, e, score)."""
    value = F.lit(score) if isinstance(score, float) else score
    return F.transform(
        spans, lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), value.alias("score"))
    )


def _in_context(text: Column, spans: Column, kind: str, base: float, cues: str, rule: Scores) -> Column:
    """Spans scored ``base``, more beside a cue word, and kept from ``rule.accept`` on."""

    def scored(x: Column) -> Column:
        left = F.greatest(x["s"] - rule.reach, F.lit(0))
        around = F.concat_ws(
            " ", F.substring(text, left + 1, x["s"] - left), F.substring(text, x["e"] + 1, F.lit(rule.reach))
        )
        score = F.lit(base) + F.when(F.lower(around).rlike(cues), F.lit(rule.near)).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), score.alias("score"))

    return F.filter(F.transform(spans, scored), lambda x: x["score"] >= rule.accept)


def base_spans(text: Column) -> Column:
    """The four base kinds by kind, then start; each with score 1 as checks confirm it."""
    count = lambda m: F.length(digits(m))
    email = matches(text, EMAIL, "@[A-Za-z0-9-]")
    ip = F.filter(matches(text, IP, "[0-9][.][0-9]"), lambda x: valid_ip(x["m"]))
    card = F.filter(matches(text, CARD, "[0-9][0-9 -]{14,}[0-9]"), lambda x: luhn(digits(x["m"])))
    phone = matches(text, PHONE, "[+][0-9]")
    phone = F.filter(phone, lambda x: count(x["m"]).between(8, 15))
    return F.concat(_kind(email, "email", 1.0), _kind(ip, "ip", 1.0), _kind(card, "card", 1.0), _kind(phone, "phone", 1.0))


def added_spans(text: Column, rule: Scores = Scores()) -> Column:
    """Spans of further kinds: what a checksum or a cue word nearby confirms.

    iban: mod-97 holds, which is enough. national_id and local_phone (without a country
    code): only beside a cue word, as their shape alone says little.
    """
    iban = F.filter(matches(text, IBAN, "[A-Z][A-Z][0-9][0-9] ?[A-Z0-9]{4}"), lambda x: mod_97(x["m"]))
    dashed = matches(text, NATIONAL_ID, "[0-9]-[0-9][0-9]-[0-9]")
    bracketed = matches(text, LOCAL_PHONE, "[(][0-9]{3}[)] [0-9]")
    return F.concat(
        _in_context(text, iban, "iban", 0.6, "iban|account|konto|cuenta|compte|bank", rule),
        _in_context(text, dashed, "national_id", 0.2, "ssn|social security|national id|identity|passport", rule),
        _in_context(text, bracketed, "local_phone", 0.3, "phone|tel|call|fax|mobile|cell", rule),
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def masked_text(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets.

    Spans that overlap are replaced once, by the kind of the one that starts first and,
    among those, ends last.
    """
    ordered = F.array_sort(
        spans,
        lambda a, b: F.when(a["s"] != b["s"], a["s"] - b["s"]).otherwise(b["e"] - a["e"]),
    )

    def step(acc: Column, x: Column) -> Column:
        overlaps = x["s"] < acc["at"]
        gap = F.substring(text, acc["at"] + 1, x["s"] - acc["at"])
        parts = F.concat(acc["parts"], F.array(gap, F.concat(F.lit("["), x["kind"], F.lit("]"))))
        return F.struct(
            F.greatest(acc["at"], x["e"]).alias("at"), F.when(overlaps, acc["parts"]).otherwise(parts).alias("parts")
        )

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    tail = lambda acc: F.concat(
        F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text))
    )
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, begin, step, tail))


def find_pii(docs: DataFrame, text: str = "text", rule: Scores = Scores()) -> DataFrame:
    """Add ``base_spans`` and ``added_spans``: arrays of (kind, s, e, score) per row.

    Positions count code points, the end is exclusive. Null and empty texts have no spans.
    Rows are searched one by one, so repeated rows and further columns do not matter; a
    column of the input with the name of one of the two is replaced.
    """
    body = text_or_empty(F.col(text))
    return docs.withColumns({"base_spans": base_spans(body), "added_spans": added_spans(body, rule)})


def mask_pii(docs: DataFrame, text: str = "text", rule: Scores = Scores()) -> DataFrame:
    """Replace all found spans in the text; null texts stay null, further columns stay."""
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text).alias("_text"))
    found = find_pii(rows, "_text", rule)
    masked = masked_text(F.col("_text"), F.concat("base_spans", "added_spans"))
    return found.select(*[(masked if c == text else F.col("_row")[c]).alias(c) for c in docs.columns])
