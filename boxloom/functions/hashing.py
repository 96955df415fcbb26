"""Deterministic draws and splits from stable keys; the same numbers in any engine with MD5 and SHA-256."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def sha_uniform(seed: str, key: Column) -> Column:
    """`sha256(seed::key)`, its first 64 bits modulo 10,000, as a share; decimal because the bits are unsigned."""
    digest = F.sha2(F.concat(F.lit(f"{seed}::"), key.cast("string")), 256)
    bits = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    return (bits % F.lit(10000)).cast("double") / F.lit(10000.0)


def md5_uniform(text: Column) -> Column:
    """The first 32 bits of an MD5 as a share."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def split_of(seed: str, key: Column, test: float, val: float) -> Column:
    """test, val or train, by the share that the key draws."""
    u = sha_uniform(seed, key)
    return F.when(u < test, F.lit("test")).when(u < test + val, F.lit("val")).otherwise(F.lit("train"))


def stable_id(text: Column, length: int = 16) -> Column:
    """A prefix of the SHA-256 of a canonical text."""
    return F.substring(F.sha2(text, 256), 1, length)


def blake_uniform(seed: str, key: Column) -> Column:
    """The first 64 bits of a BLAKE2b of `seed:key` as a share. No built-in function has this hash, so Arrow batches go to Python."""

    @F.pandas_udf("double")
    def share(keys: pd.Series) -> pd.Series:
        return keys.map(lambda k: int.from_bytes(hashlib.blake2b(f"{seed}:{k}".encode(), digest_size=8).digest(), "big") / float(1 << 64))

    return share(F.coalesce(key.cast("string"), F.lit("")))
