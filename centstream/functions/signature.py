"""Webhook signatures: HMAC-SHA256 built from Spark's own ``sha2``."""

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 64


def key_pads(secret: str) -> tuple[bytearray, bytearray]:
    """Inner and outer HMAC pads of one endpoint secret."""
    key = secret.encode()
    if len(key) > BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(BLOCK, b"\0")
    return bytearray(b ^ 0x36 for b in key), bytearray(b ^ 0x5C for b in key)


def signing_keys(spark: SparkSession, secrets: Sequence[str]) -> DataFrame:
    """One row per secret. Several secrets may be live while one is rotated out."""
    if not secrets:
        raise ValueError("at least one endpoint secret is needed")
    return spark.createDataFrame([key_pads(s) for s in secrets], "ipad BINARY, opad BINARY")


def keys_value(keys: DataFrame) -> Column:
    """The live keys as one array value.

    A scalar subquery hands the pads to the tasks at run time, so no plan text
    or UI page prints them, and no join is needed.
    """
    return keys.agg(F.collect_list(F.struct("ipad", "opad"))).scalar()


def hmac_sha256(message: Column, ipad: Column, opad: Column) -> Column:
    """Lower-case hex HMAC-SHA256 of a text."""
    inner = F.sha2(F.concat(ipad, message.cast("binary")), 256)
    return F.sha2(F.concat(opad, F.unhex(inner)), 256)


def signed_at(header: Column) -> Column:
    """The header's ``t`` entry as text; empty when absent."""
    return F.regexp_extract(header, r"(?:^|,)t=(\d+)", 1)


def signatures(header: Column) -> Column:
    """Every ``v1`` entry of the header; a header may repeat it."""
    return F.regexp_extract_all(header, F.lit(r"(?:^|,)v1=([^,]*)"), 1)


def signed_message(timestamp: Column, body: Column) -> Column:
    return F.concat(timestamp, F.lit("."), body)


def sign(timestamp: Column, body: Column, keys: DataFrame) -> Column:
    """Header value a sender holding the first of ``keys`` would attach."""
    ipad = keys.select("ipad").limit(1).scalar()
    opad = keys.select("opad").limit(1).scalar()
    stamp = timestamp.cast("string")
    digest = hmac_sha256(signed_message(stamp, body), ipad, opad)
    return F.concat(F.lit("t="), stamp, F.lit(",v1="), digest)
