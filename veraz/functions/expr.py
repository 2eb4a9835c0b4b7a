"""Reusable column builders: optional columns, typed reads, ordered reasons, keys and hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCENTED, PLAIN = "áàâãäéèêëíìîïóòôõöúùûüç", "aaaaaeeeeiiiiooooouuuuc"


def optional(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The column, or a typed null where the source doesn't have it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def text(df: DataFrame, name: str) -> Column:
    return F.trim(optional(df, name))


def decimal(df: DataFrame, name: str, scale: int) -> Column:
    """Malformed numbers become null instead of failing the job."""
    return F.trim(optional(df, name).cast("string")).try_cast(f"decimal(38,{scale})")


def timestamp(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string"))


def rfc1123(c: Column) -> Column:
    """An HTTP date such as ``Tue, 15 Nov 1994 08:12:31 GMT``; null if it is none."""
    return F.try_to_timestamp(F.substring(c, 6, 24), F.lit("dd MMM yyyy HH:mm:ss z"))


def embedded_timestamp(c: Column) -> Column:
    """A timestamp, alone or as the value of 'date' in text that looks like a Python dict."""
    inner = F.regexp_extract(c, "'date':\\s*'([^']+)'", 1)
    return timestamp(F.when(inner != "", inner).otherwise(c))


def blank(c: Column) -> Column:
    return c.isNull() | (c == "")


def digits(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def fold(c: Column) -> Column:
    """Lower case without accents, runs of white space as one blank."""
    return F.regexp_replace(F.translate(F.lower(F.trim(c)), ACCENTED, PLAIN), r"\s+", " ")


def first_reason(rules: Iterable[tuple[str, Column]]) -> Column:
    """The reason of the first rule that holds, null if none does."""
    return F.coalesce(*(F.when(holds, F.lit(reason)) for reason, holds in rules))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0.0 where the whole is not positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def key(*parts: str | Column, sep: str = "|") -> Column:
    """SHA-256 of the parts; null parts are skipped, as concat_ws does."""
    return F.sha2(F.concat_ws(sep, *(p if isinstance(p, Column) else F.lit(p) for p in parts)), 256)


def strict_key(prefix: str, c: Column) -> Column:
    """SHA-256 of prefix and value; null if the value is null."""
    return F.sha2(F.concat(F.lit(prefix), c), 256)


def content_hash(fields: Sequence[str], version: str) -> Column:
    """SHA-256 of the canonical JSON of a version tag and ordered fields, nulls included."""
    canonical = F.to_json(F.struct(F.lit(version).alias("versao"), *fields), {"ignoreNullFields": "false"})
    return F.sha2(canonical, 256)


def hmac_sha256(c: Column, secret: str) -> Column:
    """HMAC-SHA256 in hexadecimal, as two nested SHA-256 in the JVM; null for null and empty keys.

    The padded secret stands in the plan as a literal: keep plans of jobs with real secrets private.
    """
    raw = secret.encode()
    raw = (hashlib.sha256(raw).digest() if len(raw) > 64 else raw).ljust(64, b"\0")
    inner, outer = (bytes(b ^ pad for b in raw) for pad in (0x36, 0x5C))
    digest = F.sha2(F.concat(F.lit(inner), F.encode(c, "UTF-8")), 256)
    return F.when(F.length(c) > 0, F.sha2(F.concat(F.lit(outer), F.unhex(digest)), 256))


def require(df: DataFrame, *names: str) -> None:
    if missing := sorted({*names} - {*df.columns}):
        raise ValueError(f"missing columns: {', '.join(missing)}")
