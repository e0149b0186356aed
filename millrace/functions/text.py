"""Masking, canonical values, rule texts, hash buckets."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Patterns of a valid mobile number and a valid mail address.
PHONE = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
EMAIL = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"


def masked_phone(col: Column) -> Column:
    """MD5 of a valid phone number, null for anything else."""
    return F.md5(F.when(col.rlike(PHONE), col))


def masked_email(col: Column) -> Column:
    return F.md5(F.when(col.rlike(EMAIL), col))


def masked_name(col: Column) -> Column:
    """First character followed by a star."""
    return F.concat(F.substring(col, 1, 1), F.lit("*"))


def filled(col: Column) -> Column:
    """Mandatory text field: neither null nor blank."""
    return col.isNotNull() & (F.trim(col) != "")


def canonical(col: Column, known: list[str], default: str) -> Column:
    return F.when(col.isin(known), col).otherwise(default)


def discount_rule(kind: Column, codes: tuple[str, str, str], third: Column,
                  amount: Column, number: Column, benefit: Column, discount: Column) -> Column:
    """Readable text of a promotion rule; a null part makes the text null."""
    return (
        F.when(kind == codes[0], F.concat(F.lit("满"), amount, F.lit("元减"), benefit, F.lit("元")))
        .when(kind == codes[1], F.concat(F.lit("满"), number, F.lit("件打"), discount, F.lit(" 折")))
        .when(kind == codes[2], third)
    )


def last_token(col: Column, sep: str = ",") -> Column:
    """Last token; empty tokens at the end do not count."""
    return F.element_at(F.split(F.regexp_replace(col, f"{sep}+$", ""), sep), -1)


def hash_bucket(col: Column, buckets: int = 128, pinned: dict[str, int] | None = None) -> Column:
    """Bucket text from the last three hex digits of the MD5; named hot keys get their own bucket.

    Pinned keys start at 9001, so a hot key never shares a bucket with others.
    """
    plain = F.lpad(
        (F.conv(F.right(F.md5(col), F.lit(3)), 16, 10).cast("int") % buckets).cast("string"), 4, "0"
    )
    out = plain
    for key, offset in (pinned or {}).items():
        out = F.when(col == key, F.lit(str(9001 + offset))).otherwise(out)
    return out


def percent_value(col: Column) -> Column:
    return F.regexp_replace(col, "%", "").cast("decimal(20,2)")
