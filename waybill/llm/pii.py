"""Personal data in whole texts: patterns propose spans, checksums confirm them, words nearby adjust the score.

DataFrame functions only. The base kinds and their patterns:

    email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+
    ip     [0-9]+(\\.[0-9]+)(\\.[0-9]+)(\\.[0-9]+)      parts of at most 255
    card   [0-9]([ -]?[0-9])+                          12 to 19 digits that pass Luhn
    phone  \\+[0-9][ ().0-9-]+[0-9]                     9 to 15 digits

leftmost and not overlapping within a kind; a match that fails its validator is dropped and not tried again. They are
written below with possessive loops and a look behind, which match the same places without deep recursion and in time
linear in the text. Base spans stay whatever their score. The added kinds are kept from ``MIN_SCORE`` up:

    iban   country, check digits, 11 to 30 characters, compact or in fours; the number mod 97 is 1
    ssn    ddd-dd-dddd; needs a word about it in the 40 characters before

Offsets are code points, the end exclusive. Null and empty texts have no spans. Rows come back one to one. A text's spans
are held in one array; gathering n of them copies n^2 / 2 references, which is seconds for a hundred thousand in one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MIN_SCORE = 0.5
CONTEXT_CHARS = 40
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")

_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# a cheap test that any match of the kind passes
_HINT = {"email": "@", "ip": ".", "card": None, "phone": "+", "iban": None, "ssn": "-"}
_SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3}
_WORDS = {
    "email": "mail|contact|write",
    "ip": "ip|host|server|address|login",
    "card": "card|credit|visa|master|amex|payment|pay|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|cell|fax|telefon|appel|llam",
    "iban": "iban|bank|account|konto|compte|cuenta",
    "ssn": "ssn|social|security|tax|taxpayer",
}
_AGAINST = {"ip": "version|release|build", "card": "order|serial|isbn|tracking", "iban": "token|key|hash"}
_BONUS = 0.3


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(backwards, i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod_97(code: Column) -> Column:
    """The remainder by 97 of an account number, letters as 10 to 35, its first four characters moved to the end."""
    plain = F.regexp_replace(code, " ", "")
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        at = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(at < 58, rest * 10 + at - 48).otherwise(rest * 100 + at - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step)


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        # a part of more than three digits after its zeros is over 255; compared as text first, as it may be of any length
        parts = F.split(text, r"\.")
        short = F.transform(parts, lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(short, lambda p: F.when(F.length(p) > 3, False).otherwise(p.try_cast("int") <= 255))
    if kind == "card":
        return luhn(_digits(text))
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    if kind == "iban":
        return mod_97(text) == 1
    return F.lit(True)


def _matches(kind: str, text: Column) -> Column:
    """array<struct<start, rank, end, kind, score>> of the kind's valid matches."""
    pattern = F.lit(_PATTERNS[kind])
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.split(text, _PATTERNS[kind], -1)
    empty = F.array().cast("array<struct<at:int,end:int,hit:string>>")
    first = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def place(done: Column, pair: Column) -> Column:
        at = done["at"] + F.length(pair["gap"])
        to = at + F.length(pair["hit"])
        return F.struct(to.alias("at"), F.concat(done["spans"], F.array(F.struct(at.alias("at"), to.alias("end"), pair["hit"].alias("hit")))).alias("spans"))

    # as many gaps as matches, and one more
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    placed = F.aggregate(pairs, first, place, lambda done: done["spans"])
    valid = F.filter(placed, lambda s: _valid(kind, s["hit"]))

    def scored(s: Column) -> Column:
        start = F.greatest(s["at"] - CONTEXT_CHARS, F.lit(0))
        before = F.lower(F.substring(text, start + 1, s["at"] - start))
        score = F.lit(_SCORE[kind]) + F.when(before.rlike(rf"\b(?:{_WORDS[kind]})"), _BONUS).otherwise(0.0)
        if kind in _AGAINST:
            score = score - F.when(before.rlike(rf"\b(?:{_AGAINST[kind]})"), _BONUS).otherwise(0.0)
        return F.struct(
            s["at"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            F.least(score, F.lit(1.0)).alias("score"),
        )

    out = F.transform(valid, scored)
    if kind not in BASE:
        out = F.filter(out, lambda s: s["score"] >= MIN_SCORE)
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,score:double>>")
    hint = text.contains(_HINT[kind]) if _HINT[kind] else F.lit(True)
    if kind != "email":
        hint = F.col("digits") & hint
    return F.when(hint, F.when(F.size(found) > 0, out).otherwise(none)).otherwise(none)


def find(docs: DataFrame, *, text_col: str = "text", into: str = "pii_spans") -> DataFrame:
    """The rows with a column of spans, by start and then kind: array<struct<start, rank, end, kind, score>>."""
    others = [docs[f"`{c}`"] for c in docs.columns if c != into]
    rows = docs.select(F.struct(*others).alias("row"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    rows = rows.withColumn("digits", F.col("text").rlike("[0-9]"))
    spans = F.array_sort(F.concat(*[_matches(k, F.col("text")) for k in KINDS]))
    return rows.select("row.*", spans.alias(into))


def redact(found: DataFrame, *, text_col: str = "text", spans_col: str = "pii_spans") -> DataFrame:
    """The text with every span replaced by its kind in brackets; where spans overlap, by that of the first."""
    text = F.col(text_col)

    def cut(done: Column, s: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        put = F.when(s["start"] >= done["at"], F.concat(done["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), put.alias("out"))

    def rest(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.when(F.size(spans_col) > 0, F.aggregate(spans_col, first, cut, rest)).otherwise(text)
    return found.withColumn(text_col, clean)


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def written_out(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans, comma-joined."""
    chosen = of_kinds(spans, kinds) if kinds != KINDS else spans
    return F.concat_ws(",", F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
