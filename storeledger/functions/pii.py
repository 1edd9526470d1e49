"""Detectors of personal data, as built-in expressions over whole texts: patterns, and a tagger for names.

Every quantifier has an upper bound, so a long run of letters or digits costs
time linear in its length.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from storeledger.functions.person import person_hits

EMAIL = r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,253}\.[A-Za-z]{2,63}"
PHONE = (
    r"(?<![0-9])(?<![0-9]\.)(?:"
    r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}"
    r"|\+[1-9][0-9]{7,14}"
    r")(?![0-9A-Za-z_])"
)
CARD = (
    r"(?<![0-9A-Za-z_])(?:"
    r"[0-9]{13,19}"
    r"|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
    r")(?![0-9A-Za-z_])"
)


def _luhn(card: Column) -> Column:
    """Checksum of card numbers: double every second digit from the right."""
    digits = F.split(F.reverse(F.regexp_replace(card, "[ -]", "")), "")
    weighted = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")
        ),
    )
    return F.aggregate(weighted, F.lit(0), lambda acc, d: acc + d) % 10 == 0


def _where(possible: Column, hits: Column) -> Column:
    """Hits, spared the long pattern where a plain test rules any out; null text has none."""
    return F.when(possible, hits).otherwise(0)


def email_hits(text: Column) -> Column:
    return _where(F.contains(text, F.lit("@")), F.regexp_count(text, F.lit(EMAIL)))


def phone_hits(text: Column) -> Column:
    return _where(text.rlike("[0-9]{4}"), F.regexp_count(text, F.lit(PHONE)))


def card_hits(text: Column) -> Column:
    candidates = F.regexp_extract_all(text, F.lit(CARD), F.lit(0))
    return _where(text.rlike("[0-9]{4}"), F.size(F.filter(candidates, _luhn)))


DETECTORS = {
    "PERSON": person_hits,
    "EMAIL_ADDRESS": email_hits,
    "PHONE_NUMBER": phone_hits,
    "CREDIT_CARD": card_hits,
}


def checked_types(blocked, waived=()) -> list[str]:
    """The blocked types; one that has no detector and is not waived is refused."""
    unknown = sorted(set(blocked) - set(DETECTORS) - set(waived))
    if unknown:
        raise ValueError(f"no detector for blocked personal data {unknown}; waive them in unchecked_pii")
    return [pii_type for pii_type in blocked if pii_type in DETECTORS]


def contains_pii(text: Column, types) -> Column:
    found = F.lit(False)
    for pii_type in types:
        found = found | (DETECTORS[pii_type](text) > 0)
    return F.coalesce(found, F.lit(False))
