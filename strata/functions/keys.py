"""Surrogate-key expressions (Column -> Column), all JVM-side built-ins.

A key is ``base64(md5(text))``: md5 yields 32 hex characters and base64 is
applied to that *hex text*, so every key is 44 characters long.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_text(text: Column) -> Column:
    """``base64(md5(text))``; NULL text gives a NULL key."""
    return F.base64(F.md5(text))


def key_part(c: str | Column, lower: bool = True) -> Column:
    """One component of a key: optionally lower-cased, cast to text, NULL -> ''."""
    col = _col(c).cast("string")
    if lower:
        col = F.lower(col)
    return F.coalesce(col, F.lit(""))


def key_hash(c: str | Column, lower: bool = True) -> Column:
    """Key of a single text attribute (NULL hashes as the empty string)."""
    return hash_text(key_part(c, lower))


def key_composite(*parts: str | Column | tuple[str | Column, bool]) -> Column:
    """Key of several attributes concatenated without a separator.

    Each part is a column, or ``(column, lower)`` to control lower-casing.
    No separator is inserted, so ``('ab','c')`` and ``('a','bc')`` share a key.
    """
    cols = []
    for p in parts:
        c, low = p if isinstance(p, tuple) else (p, True)
        cols.append(key_part(c, low))
    return hash_text(F.concat(*cols))


def entity_key(c: str | Column) -> Column:
    """Key of an identifier (``cast(id as string)``), NULL stays NULL."""
    return hash_text(_col(c).cast("string"))


# Attribute keys of the customer dimensions.
def email_key(email: str | Column = "email") -> Column:
    return key_hash(email)


def name_key(first: str | Column = "firstname", last: str | Column = "lastname") -> Column:
    return key_composite(first, last)


def address_key(address1="address1", address2="address2", city="city", state="state",
                zippost="zippost", zipplus4="zipplus4") -> Column:
    # zippost and zipplus4 are not lower-cased.
    return key_composite(address1, address2, city, state, (zippost, False), (zipplus4, False))


def phone_key(phone: str | Column = "phone") -> Column:
    return key_hash(phone)
