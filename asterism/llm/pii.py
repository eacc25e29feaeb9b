"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterism.llm.common import bind, id_text
from asterism.llm.spans import find_spans, joined

#: In the order in which spans of one start are listed; the first four are always kept.
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE_KINDS = 4

# Possessive and anchored at the start of a run, so that long runs without a match
# cost one pass; the matches are those of the plain pattern in each comment.
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # [0-9]([\x20-]?[0-9])+ with 14 digits or more
    "card": r"[0-9](?:[ -]?[0-9]){13,}+",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
OCTETS = r"^0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"

#: Score in percent of a confirmed span, before context.
SCORES = {"email": 80, "ip": 50, "card": 80, "phone": 60, "iban": 80, "ssn": 40}
#: Whole words near a span (any case) that make its kind likelier, and words that speak for something else.
CONTEXT = {"email": "e?mail|contact|write to", "ip": "ip|host|server|address|login", "card": "card|visa|credit|payment",
           "phone": "phone|tel|call|mobile|fax", "iban": "iban|bank|account", "ssn": "ssn|social security|tax id"}
AGAINST = "version|example|order no|isbn|serial"
BONUS, MALUS = 20, 20
#: Kinds beyond the base ones are reported from this score on.
MIN_SCORE = 60


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return acc + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number without spaces passes the ISO 7064 mod-97 check."""
    moved = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))

    def add(acc: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), add) == 1


def _confirmed(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(OCTETS)
    if kind == "card":
        return bind(digits, lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return mod97(F.replace(hit, F.lit(" "), F.lit("")))
    if kind == "ssn":
        return ~hit.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _words(words: str) -> str:
    """Pattern of these as whole words, a plural ``s`` allowed."""
    return f"(?:^|[^a-z])(?:{words})s?(?:[^a-z]|$)"


def _score(kind: str, span: Column) -> Column:
    near = F.lower(F.concat_ws(" ", span["before"], span["after"]))
    raw = F.lit(SCORES[kind]) + F.when(near.rlike(_words(CONTEXT[kind])), BONUS).otherwise(0) - F.when(
        near.rlike(_words(AGAINST)), MALUS).otherwise(0)
    return F.least(raw, F.lit(100))


def pii_spans(text: Column) -> Column:
    """Array of (start, kind, end, score) sorted by start, then kind (an index into KINDS)."""
    def of(kind: str) -> Column:
        i = KINDS.index(kind)
        found = F.filter(find_spans(text, PATTERNS[kind], context=True), lambda s: _confirmed(kind, s["hit"]))
        if kind == "email":
            found = F.when(F.contains(text, F.lit("@")), found).otherwise(F.array())
        scored = F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind"),
                                                       s["end"].alias("end"), _score(kind, s).alias("score")))
        return scored if i < BASE_KINDS else F.filter(scored, lambda s: s["score"] >= MIN_SCORE)

    return F.array_sort(F.concat(*[of(k) for k in KINDS]))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``pii``, the array of (start, kind, end, score) of each whole text.

    Patterns propose spans, checks confirm them (octets up to 255, Luhn over 14 to 19
    digits, 10 to 15 digits of a phone number, mod-97 of an account number), and
    whole words within ``BEFORE`` characters before or ``AFTER`` after, other spans
    included, adjust the score (percent). E-mail, ip, card and phone spans are kept whatever the score; other
    kinds from ``MIN_SCORE``. One pass, no shuffle.

    Defined cases: null and empty texts have no spans; rows that repeat are judged
    alike; a null id stays null; an empty table gives an empty result; other columns
    are ignored.
    """
    return id_text(docs, id_col, text_col).select("doc_id", pii_spans(F.col("text")).alias("pii"))


def summary(found: DataFrame) -> DataFrame:
    """Counts, digest and text form of the spans of :func:`find_pii`."""
    pii = F.col("pii")
    count = lambda k: F.size(F.filter(pii, lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    base = F.filter(pii, lambda s: s["kind"] < BASE_KINDS)
    return found.select("doc_id", *[count(k) for k in KINDS[:BASE_KINDS]],
                        F.sha2(joined(base, KINDS), 256).alias("base_sha256"), joined(pii, KINDS).alias("spans"),
                        F.array_join(F.transform(pii, lambda s: s["score"].cast("string")), ",").alias("scores"))
