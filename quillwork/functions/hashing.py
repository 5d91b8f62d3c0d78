"""Reproducible randomness: every draw is a pure function of a row key and a salt.

``rand(seed)`` depends on how rows are laid out in partitions, so a retried task
or another cluster size would change a sample. A digest of the key does not.
One MD5 digest carries two independent 52-bit uniforms, exact in a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13
_RANGE = float(16**_HEX_DIGITS)


def digest(salt, *key) -> Column:
    """MD5 of the salt and the key parts, as hex; order by it to shuffle.

    Each part carries its length, and a null is no text, so different keys are
    different inputs. The salt begins with the purpose of the draw ("split|42"):
    draws for different purposes are independent, even with one seed and one key.
    """
    parts = [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in key]
    told = [F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.md5(F.concat(F.lit(f"{salt}|"), *told))


def uniform(hex_digest: Column, part: int = 0) -> Column:
    """Uniform double in [0, 1) from one half (0 or 1) of a digest."""
    digits = F.substring(hex_digest, 1 + part * _HEX_DIGITS, _HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(_RANGE)


def uniform_index(hex_digest: Column, n, part: int = 0) -> Column:
    """Uniform integer in [0, n).

    Declared non-null, so that joins on a drawn index do not add a null check that
    would compute the digest a second time.
    """
    n = n if isinstance(n, Column) else F.lit(n)
    return F.coalesce(F.floor(uniform(hex_digest, part) * n).cast("bigint"), F.lit(0))


def bucket(hex_digest: Column, digits: int) -> Column:
    """Leading hex digits: an equi-sized bucket that is ordered like the digest."""
    return F.substring(hex_digest, 1, digits)
