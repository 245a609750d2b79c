"""HMAC-SHA256 webhook signatures from built-in hash functions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64

# Fixed value: the text in front of the hex digest.
SIGNATURE_PREFIX = "sha256="


def hmac_sha256_hex(secret: bytes, message: Column) -> Column:
    """Lower-case hex HMAC-SHA256 of a BINARY column.

    Only the two pads derived from the key enter the plan. They are as
    sensitive as the key: do not log plans that contain them.
    """
    key = hashlib.sha256(secret).digest() if len(secret) > _BLOCK else secret
    key = key.ljust(_BLOCK, b"\0")
    inner_pad = F.lit(bytes(b ^ 0x36 for b in key))
    outer_pad = F.lit(bytes(b ^ 0x5C for b in key))
    inner = F.unhex(F.sha2(F.concat(inner_pad, message), 256))
    return F.sha2(F.concat(outer_pad, inner), 256)


def webhook_signature(secret: bytes, message: Column) -> Column:
    return F.concat(F.lit(SIGNATURE_PREFIX), hmac_sha256_hex(secret, message))
