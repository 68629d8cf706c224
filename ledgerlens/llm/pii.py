"""Personal data: patterns propose spans, checksums confirm them, nearby words
adjust the score. DataFrame operations only; no shuffle.

Base kinds (leftmost, non-overlapping per kind; a match that fails its check is
dropped without a retry): email; ip, four parts of at most 255; card, 12 to 19
digits that pass Luhn; phone, 9 to 15 digits. They are always kept. Added kind:
iban, confirmed by its length and mod-97 remainder.

Every span has a score: a prior of its kind, raised by a word of its kind close
before or after it and lowered by a word that speaks of samples. Added spans
below ``least_score`` are dropped, base spans never: an iban beside a word of
samples goes, unless a word of its kind stands there too.

The patterns below match what the plain ones of the contract match, but in
linear time and without recursion on very long runs: runs are possessive, and a
run starts only where the character before is outside it (or where the last
match ended). ``split`` gives the text between the matches, so positions are
sums of lengths.

Edge cases: null and empty texts have no spans; repeated rows are scanned each
alone; positions count code points; other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

# the length of an IBAN by its country
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban(length: int, countries: str) -> str:
    """The pattern of the countries' IBANs, in one piece or in groups of four."""
    groups, rest = divmod(length - 4, 4)
    last = f" [A-Z0-9]{{{rest}}}" if rest else ""
    return (f"(?:{countries.replace(' ', '|')})[0-9]{{2}}"
            f"(?:[A-Z0-9]{{{length - 4}}}|(?: [A-Z0-9]{{4}}){{{groups}}}{last})(?![A-Za-z0-9])")


LOCAL = "A-Za-z0-9._%+-"
LABEL = "A-Za-z0-9-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[{LABEL}]++(?:\.[{LABEL}]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # by the country's length, so that a word or number after it is no part of it; other countries up to the last group
    "iban": r"(?<![A-Za-z0-9])(?:" + "|".join(_iban(n, c) for n, c in IBAN_LENGTHS.items())
            + r"|[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9]))",
}
BASE = ("email", "ip", "card", "phone")
KINDS = tuple(PATTERNS)
# what a text must hold for its pattern to be tried
HINTS = {"email": "@", "phone": "+"}
NEEDS = {"ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9 ]{11}"}

_DIGITS = "regexp_replace({x}, '[^0-9]', '')"
_N = f"char_length({_DIGITS})"
_LUHN = (f"aggregate(sequence(1, {_N}), 0, (s, i) -> s + "
         f"cast(substr({_DIGITS}, {_N} - i + 1, 1) as int) * if(i % 2 = 0, 2, 1) - "
         f"if(i % 2 = 0 AND cast(substr({_DIGITS}, {_N} - i + 1, 1) as int) > 4, 9, 0)) % 10 = 0")
_PLAIN = "replace({x}, ' ', '')"
_TURNED = f"concat(substr({_PLAIN}, 5), substr({_PLAIN}, 1, 4))"
CHECKS = {
    "email": "true",
    "ip": "forall(split({x}, '[.]'), p -> coalesce(try_cast(p as int) <= 255, false))",
    "card": f"CASE WHEN {_N} BETWEEN 12 AND 19 THEN {_LUHN} ELSE false END",
    "phone": f"{_N} BETWEEN 9 AND 15",
    # letters count 10 to 35; the remainder by 97 is 1
    "iban": (f"char_length({_PLAIN}) BETWEEN 15 AND 34 AND aggregate(split({_TURNED}, ''), 0L, (r, c) -> CASE "
             "WHEN c = '' THEN r WHEN c >= 'A' THEN (r * 100 + ascii(c) - 55) % 97 "
             "ELSE (r * 10 + ascii(c) - 48) % 97 END) = 1"),
}
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.6, "iban": 0.6}
NEARBY = 40
WORDS = {
    "email": "mail|contact|write|address", "ip": "ip|server|host|address|client",
    "card": "card|visa|credit|payment|karte|carte|tarjeta", "phone": "phone|call|tel|mobile|fax",
    "iban": "iban|account|bank|konto|compte|cuenta",
}
SAMPLES = "example|sample|dummy|version|test"


def _spans(kind: str) -> str:
    """SQL: the confirmed spans of a kind, from its gaps and hits."""
    order = KINDS.index(kind)
    start = "a.pos + char_length(z.g)"
    end = f"{start} + char_length(z.h)"
    return (f"aggregate(_parts_{kind}, "
            "named_struct('pos', 0, 'out', cast(array() as array<struct<s:int,o:int,e:int>>)), (a, z) -> "
            f"named_struct('pos', {start} + coalesce(char_length(z.h), 0), "
            f"'out', CASE WHEN z.h IS NULL THEN a.out WHEN {CHECKS[kind].format(x='z.h')} "
            f"THEN concat(a.out, array(named_struct('s', {start}, 'o', {order}, 'e', {end}))) ELSE a.out END), "
            "a -> a.out)")


def _score(kind: str) -> str:
    """SQL: the score of the span ``x`` of a kind."""
    around = f"lower(substring(_text, greatest(x.s - {NEARBY}, 0) + 1, x.e - greatest(x.s - {NEARBY}, 0) + {NEARBY}))"
    return (f"{PRIOR[kind]}D + if({around} rlike '(^|[^a-z])({WORDS[kind]})', 0.2D, 0D)"
            f" - if({around} rlike '(^|[^a-z])({SAMPLES})', 0.2D, 0D)")


def find_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               least_score: float = 0.5) -> DataFrame:
    """``doc_id`` and ``found``: structs (s start, o kind's place, e end, kind,
    score), by start, then kind."""
    rows = docs.select(F.col(id_column).alias("doc_id"), text_of(text_column).alias("_text"))
    text = F.col("_text")

    def may(kind: str) -> Column:
        return F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else text.rlike(NEEDS[kind])
    nothing = F.array().cast("array<string>")
    rows = rows.withColumns({f"_may_{k}": may(k) for k in KINDS})
    rows = rows.withColumns({
        f"_parts_{k}": F.when(F.col(f"_may_{k}"), F.arrays_zip(
            F.split(text, p, -1).alias("g"), F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias("h")))
        .otherwise(F.arrays_zip(nothing.alias("g"), nothing.alias("h"))) for k, p in PATTERNS.items()})
    rows = rows.withColumns({f"_spans_{k}": F.expr(_spans(k)) for k in KINDS})
    scored = [F.expr(f"transform(_spans_{k}, x -> named_struct('s', x.s, 'o', x.o, 'e', x.e, 'kind', '{k}', "
                     f"'score', round({_score(k)}, 2)))") for k in KINDS]
    return rows.select("doc_id", F.array_sort(F.concat(*scored)).alias("found")).withColumn(
        "found", F.expr(f"filter(found, x -> x.o < {len(BASE)} OR x.score >= {least_score}D)"))


def pii(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_score: float = 0.5) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores``."""
    rows = find_spans(docs, id_column, text_column, least_score)
    said = "transform({}, x -> concat(x.kind, ':', x.s, ':', x.e))"
    base = f"filter(found, x -> x.o < {len(BASE)})"
    return rows.select(
        "doc_id", *[F.expr(f"cast(size(filter(found, x -> x.o = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(BASE)],
        F.expr(f"sha2(array_join({said.format(base)}, ','), 256)").alias("base_sha256"),
        F.expr(f"array_join({said.format('found')}, ',')").alias("spans"),
        F.expr("array_join(transform(found, x -> cast(x.score as string)), ',')").alias("scores"))
