"""Contract rules as column expressions.

Each rule takes the stripped, non-empty text of a cell and the rule's argument
from the contract, and gives back when the cell fails and what to say about it.
No rule needs a Python worker, so a whole contract is one pass of generated code.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any, NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from borderlake.functions.text import (
    INTEGER,
    digits_only,
    is_number,
    number,
    number_text,
    ordered_number,
)

# Accepted formats. \A and \z, because $ also matches before a
# final line break. (?U) makes \s cover Unicode whitespace, and the four
# separators from U+001C count as whitespace too.
EMAIL = r"(?U)\A[^@\s\x1C-\x1F]+@[^@\s\x1C-\x1F]+\.[^@\s\x1C-\x1F]+\z"
PHONE = r"\A\+27[0-9]{9}\z"
ID_NUMBER = r"\A[0-9]{13}\z"
ISO_DATE = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
ISO_TIMESTAMP = (
    r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?"
    r"(Z|[+-][0-9]{2}(:?[0-9]{2})?)?)?\z"
)

# The silver type of decimal columns; numbers it cannot hold are rejected.
MONEY = "decimal(12,2)"


class Test(NamedTuple):
    """When a cell passes a rule (NULL counts as failed) and, made only where it
    is wanted, what to say if it does not."""

    passes: Column
    reason: Callable[[], Column]


def quoted(before: str, text: Column, after: str = "") -> Callable[[], Column]:
    return lambda: F.concat(F.lit(f"{before}'"), text, F.lit(f"'{after}"))


def to_money(text: Column) -> Column:
    return digits_only(text).try_cast(MONEY)


def to_date(text: Column) -> Column:
    return F.when(text.rlike(ISO_DATE), text.try_cast("date"))


def to_timestamp(text: Column) -> Column:
    return F.when(text.rlike(ISO_TIMESTAMP), text.try_cast("timestamp_ntz"))


def at_least(text: Column, minimum: Any) -> Column:
    """``float(text) >= minimum``, never NULL."""
    return F.coalesce(ordered_number(text) >= F.lit(float(minimum)), F.lit(False))


def type_rule(text: Column, expected: str, spec: dict) -> Test | None:
    if expected in ("int", "integer"):
        passes = text.rlike(INTEGER)
    elif expected in ("float", "numeric"):
        passes = is_number(text)
    elif expected == "decimal":
        # A number that passes its other rule but does not fit the silver type
        # (inf, too wide) would break the typed build, so it is rejected here.
        fits = to_money(text).isNotNull()
        if active(spec, "min"):
            fits = fits | ~at_least(text, spec["min"])
        passes = is_number(text) & fits
    elif expected == "date":
        passes = to_date(text).isNotNull()
    elif expected == "timestamp":
        passes = to_timestamp(text).isNotNull()
    else:
        return None
    return Test(passes, quoted("Cannot read ", text, f" as {expected}"))


def allowed_values_rule(text: Column, allowed: list, _spec: dict) -> Test:
    members = [v for v in allowed if isinstance(v, str)]  # text never equals a non-text value
    return Test(text.isin(members), quoted("", text, f" not in allowed set {allowed}"))


def sa_id_rule(text: Column, _arg: Any, _spec: dict) -> Test:
    valid = (
        text.rlike(ID_NUMBER)
        & F.try_to_date(F.substring(text, 1, 6), "yyMMdd").isNotNull()
        & F.call_function("luhn_check", text)
    )
    return Test(valid, quoted("Invalid SA ID (format or checksum): ", text))


def email_rule(text: Column, _arg: Any, _spec: dict) -> Test:
    return Test(text.rlike(EMAIL), quoted("Invalid email: ", text))


def phone_rule(text: Column, _arg: Any, _spec: dict) -> Test:
    return Test(text.rlike(PHONE), quoted("Phone must be +27 then 9 digits: ", text))


def min_rule(text: Column, minimum: Any, _spec: dict) -> Test:
    def reason() -> Column:
        value = number(text)
        return F.when(value.isNull(), quoted("Not a number: ", text)()).otherwise(
            F.concat(number_text(value), F.lit(f" is below minimum {minimum}"))
        )

    return Test(at_least(text, minimum), reason)


RULES: dict[str, Callable[[Column, Any, dict], Test | None]] = {
    "type": type_rule,
    "allowed_values": allowed_values_rule,
    "sa_id": sa_id_rule,
    "email": email_rule,
    "phone": phone_rule,
    "min": min_rule,
}


def active(spec: dict, rule: str) -> bool:
    """A rule is on unless absent or switched off with ``false``; ``min: 0`` is on."""
    return rule in spec and spec[rule] is not False
