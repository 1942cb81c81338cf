"""Date keys and surrogate keys computed from business values, without any global numbering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: str | Column) -> Column:
    """DATE -> YYYYMMDD integer."""
    day = F.col(day) if isinstance(day, str) else day
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def key_date(key: str | Column) -> Column:
    """YYYYMMDD integer -> DATE."""
    key = F.col(key) if isinstance(key, str) else key
    text = key.cast("string")
    return F.make_date(
        F.substring(text, 1, 4).cast("int"),
        F.substring(text, 5, 2).cast("int"),
        F.substring(text, 7, 2).cast("int"),
    )


def padded(number: Column, width: int = 6) -> Column:
    """Left-pad with zeros, never cutting a longer number."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def _canonical(identifier: Column, prefix: str, width: int, longest: int) -> tuple[Column, Column]:
    """(prefix code, digits) of an ``ABC000123`` identifier; digits are '' when it has another form.

    The declared prefix has code 0, every other one a code of its own, so no two identifiers
    share both.
    """
    digits = F.regexp_extract(identifier, rf"^[A-Z]{{3}}([0-9]{{{width}}}|[1-9][0-9]{{{width},{longest - 1}}})$", 1)
    letters = [F.ascii(F.substring(identifier, i, 1)).cast("bigint") - 65 for i in (1, 2, 3)]
    code = letters[0] * 676 + letters[1] * 26 + letters[2] + 1
    return F.when(identifier.startswith(prefix), F.lit(0).cast("bigint")).otherwise(code), digits


def surrogate_key(identifier: str | Column, prefix: str | None = None, width: int = 6) -> Column:
    """BIGINT key of a business identifier.

    Identifiers with the declared prefix keep their own number, so keys stay dense, comparable
    between runs and free of collisions. Another prefix of three letters is coded above the
    14 digits of the number. Any other text gets a negative 62-bit digest; the load gate checks
    uniqueness, so a collision stops the load instead of merging two entities. Without a declared
    prefix the column must hold one prefix only, and other text gets a 60-bit digest.
    """
    identifier = F.col(identifier) if isinstance(identifier, str) else identifier
    digest = F.md5(identifier)
    half = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    code, digits = _canonical(identifier, prefix or "", width, 14)
    if prefix is None:
        return F.when(identifier.isNotNull(), F.coalesce(digits.try_cast("bigint"), -half - 1))
    number = code * F.lit(10**14) + digits.try_cast("bigint")
    hashed = -(half * 4 + F.conv(F.substring(digest, 16, 1), 16, 10).cast("bigint") % 4) - 1
    return F.when(identifier.isNotNull(), F.coalesce(number, hashed))


def snapshot_key(identifier: str | Column, snapshot: Column, prefix: str) -> Column:
    """DECIMAL(38,0) key of (identifier, snapshot date key); 120 hash bits for text of another form."""
    identifier = F.col(identifier) if isinstance(identifier, str) else identifier
    code, digits = _canonical(identifier, prefix, 6, 22)
    number = (code.cast("decimal(5,0)") * F.lit(str(10**22)).cast("decimal(23,0)")).cast("decimal(29,0)") \
        + digits.try_cast("decimal(22,0)")
    natural = (number.cast("decimal(29,0)") * F.lit(100000000).cast("decimal(9,0)")).cast("decimal(38,0)") \
        + snapshot.cast("decimal(9,0)")
    digest = F.md5(F.concat_ws(":", identifier, snapshot.cast("string")))

    def part(start: int) -> Column:
        return F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(19,0)")

    hashed = -(part(1) * F.lit(2**60).cast("decimal(19,0)") + part(16)).cast("decimal(38,0)") - F.lit(1)
    return F.coalesce(natural.cast("decimal(38,0)"), hashed.cast("decimal(38,0)"))
