"""Masking of personal data."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted forms of phone numbers, identity cards and mail addresses.
PHONE = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
ID_CARD_18 = (
    r"^[1-9]\d{5}(18|19|([23]\d))\d{2}((0[1-9])|(10|11|12))"
    r"(([0-2][1-9])|10|20|30|31)\d{3}[0-9Xx]$"
)
ID_CARD_OLD = r"^[1-9]\d{5}\d{2}((0[1-9])|(10|11|12))(([0-2][1-9])|10|20|30|31)\d{2}$"
EMAIL = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(.[a-zA-Z0-9_-]+)+$"

# EMAIL lets its wildcard match word characters too, so a backtracking matcher needs
# exponential time on a long address that fails at its end. The same language, matched in
# one pass: word characters and single other characters, word characters at both ends,
# three characters or more.
_LINE_END = r"\n\r\u0085\u2028\u2029"
_WORD, _OTHER = "[a-zA-Z0-9_-]", rf"[^a-zA-Z0-9_{_LINE_END}-]"
_EMAIL_ONE_PASS = (
    rf"^{_WORD}+@{_WORD}(?:{_OTHER}{_WORD}|{_WORD}{_OTHER}?{_WORD})(?:{_OTHER}?{_WORD})*+$"
)


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _whole(text: Column, pattern: str) -> Column:
    """``rlike`` finds; ``$`` would also accept a trailing line break, ``\\z`` does not."""
    return text.rlike(pattern.removesuffix("$") + r"\z")


def mask_name(name) -> Column:
    """Keep the first character, a ``*`` for each of the rest."""
    name = _col(name)
    return F.concat(F.substring(name, 1, 1), F.regexp_replace(F.substring(name, 2, 1 << 30), ".", "*"))


def md5_hex(value) -> Column:
    return F.md5(_col(value))


def is_phone(value) -> Column:
    return _whole(_col(value), PHONE)


def is_id_card(value) -> Column:
    return _whole(_col(value), ID_CARD_18) | _whole(_col(value), ID_CARD_OLD)


def is_email(value) -> Column:
    return _whole(_col(value), _EMAIL_ONE_PASS)


def _hash_if(check: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda value: F.when(check(_col(value)), F.md5(_col(value)))


phone_hash = _hash_if(is_phone)
id_card_hash = _hash_if(is_id_card)
email_hash = _hash_if(is_email)

# Which columns of which table are masked, and how.
POLICY: Mapping[str, Mapping[str, Callable[[Column], Column]]] = {
    "employee_info": {
        "password": md5_hex,
        "real_name": mask_name,
        "id_card": id_card_hash,
        "phone": phone_hash,
    },
    "express_courier": {"working_phone": phone_hash},
    "truck_driver": {"license_no": md5_hex},
    "truck_info": {"truck_no": md5_hex, "device_gps_id": md5_hex, "engine_no": md5_hex},
    "truck_model": {"model_no": md5_hex},
    "user_address": {"phone": phone_hash},
    "user_info": {
        "passwd": md5_hex,
        "real_name": md5_hex,
        "phone_num": phone_hash,
        "email": email_hash,
    },
}


def mask_columns(table: str, columns: list[str]) -> list[Column]:
    """Select list for one table: masked where the policy says so."""
    rules = POLICY.get(table, {})
    return [rules[c](F.col(c)).alias(c) if c in rules else F.col(c) for c in columns]
