"""Text expressions: normal forms, detection of personal data, redaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns and labels that results are compared by. The word class is spelled
# out, because \w alone is ASCII here while the data is Unicode.
EMAIL = r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+"
PHONE = r"\+?\p{Nd}[\p{Nd}\-. ]{7,}\p{Nd}"
ENTITIES = ("PERSON", "EMAIL_ADDRESS", "PHONE_NUMBER", "LOCATION", "CREDIT_CARD", "IBAN_CODE")

# An address exists exactly where this shorter pattern does, and it needs no look-back over runs
# of word characters.
EMAIL_PRESENT = r"[\p{L}\p{N}_.+-]@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]"
# 13 to 19 digits with single blanks or dashes between; two letters, two digits, 11 to 30 others.
WORD = r"[\p{L}\p{N}_]+"
CARD = r"\b\d(?:[ -]?\d){12,18}\b"
IBAN = r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b"


def normal_form(col: Column) -> Column:
    """Lower case, outer blanks removed, inner blanks collapsed."""
    return F.trim(F.regexp_replace(F.lower(col), r"(?U)\s+", " "))


def has_email(col: Column) -> Column:
    return F.contains(col, F.lit("@")) & F.regexp_like(col, F.lit(EMAIL_PRESENT))


def has_phone(col: Column) -> Column:
    return F.regexp_like(col, F.lit(PHONE))


def redact(col: Column) -> Column:
    """Mask addresses first, then phone numbers in what is left."""
    masked = F.when(F.contains(col, F.lit("@")), F.regexp_replace(col, EMAIL, "<EMAIL_ADDRESS>")).otherwise(col)
    return F.regexp_replace(masked, PHONE, "<PHONE_NUMBER>")


def luhn_valid(number: Column) -> Column:
    """Luhn checksum of a digit string (blanks and dashes ignored), 13 to 19 digits long."""
    digits = F.regexp_replace(number, "[^0-9]", "")
    size = F.length(digits)

    def weigh(place: Column) -> Column:
        digit = F.substring(digits, size - place, F.lit(1)).cast("int")
        doubled = digit * 2
        return F.when(place % 2 == 0, digit).when(doubled > 9, doubled - 9).otherwise(doubled)

    places = F.sequence(F.lit(0), size - 1)
    total = F.aggregate(places, F.lit(0), lambda acc, place: acc + weigh(place))
    return size.between(13, 19) & (total % 10 == 0)


def iban_valid(code: Column) -> Column:
    """Remainder 1 modulo 97 after moving the first four characters to the end, letters read as
    10 to 35."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def fold(acc: Column, char: Column) -> Column:
        point = F.ascii(char)
        return F.when(point >= 65, acc * 100 + point - 55).otherwise(acc * 10 + point - 48) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(fold(acc, c))) == 1


def card_numbers(col: Column) -> Column:
    return F.filter(F.regexp_extract_all(col, F.lit(CARD), F.lit(0)), luhn_valid)


def iban_codes(col: Column) -> Column:
    return F.filter(F.regexp_extract_all(col, F.lit(IBAN), F.lit(0)), iban_valid)


def words(col: Column) -> Column:
    """The distinct words of a text."""
    return F.array_distinct(F.regexp_extract_all(col, F.lit(WORD), F.lit(0)))


DETECTORS = {
    "EMAIL_ADDRESS": has_email,
    "PHONE_NUMBER": has_phone,
    "CREDIT_CARD": lambda col: F.size(card_numbers(col)) > 0,
    "IBAN_CODE": lambda col: F.size(iban_codes(col)) > 0,
}
# What is looked for unless the caller asks for more.
DEFAULT_ENTITIES = ("EMAIL_ADDRESS", "PHONE_NUMBER")
