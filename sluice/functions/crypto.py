"""Field encryption and pseudonyms as column expressions.

Ciphertext layout, Base64 encoded: 4-byte big-endian length of the wrapped data
key, the wrapped key, 12-byte IV, AES-GCM ciphertext with its 16-byte tag. Keys
come from the caller; set ``spark.redaction.string.regex`` so that key literals
stay out of plans and event logs.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

_HMAC_BLOCK = 64


def encrypt_field(value: Column, key: bytes, wrapped_key: bytes) -> Column:
    header = struct.pack(">i", len(wrapped_key)) + wrapped_key
    sealed = F.aes_encrypt(value.cast("string").cast("binary"), F.lit(key), F.lit("GCM"))
    return F.base64(F.concat(F.lit(header), sealed))


def decrypt_field(value: Column, key: bytes) -> Column:
    raw = F.unbase64(value)
    key_length = F.conv(F.hex(F.substring(raw, 1, 4)), 16, 10).cast("int")
    sealed = F.substring(raw, F.lit(5) + key_length, F.length(raw))
    return F.aes_decrypt(sealed, F.lit(key), F.lit("GCM")).cast("string")


def encrypt_fields(df: DataFrame, fields: Iterable[str], key: bytes | None, wrapped_key: bytes = b"", enabled: bool = True) -> DataFrame:
    """Nulls stay null; fields this schema lacks are skipped. A sensitive field
    that is no text becomes text."""
    present = [name for name in fields if name in df.columns]
    if not enabled or not present:
        return df
    if key is None or len(key) != 32:
        raise ValueError("encryption needs a 32-byte data key")
    return df.withColumns({name: encrypt_field(F.col(name), key, wrapped_key) for name in present})


def pseudonymize(value: Column, secret: bytes) -> Column:
    """HMAC-SHA256 in hex, equal to what any HMAC library gives."""
    import hashlib

    block = (hashlib.sha256(secret).digest() if len(secret) > _HMAC_BLOCK else secret).ljust(_HMAC_BLOCK, b"\0")
    inner_pad = bytes(b ^ 0x36 for b in block)
    outer_pad = bytes(b ^ 0x5C for b in block)
    inner = F.unhex(F.sha2(F.concat(F.lit(inner_pad), value.cast("string").cast("binary")), 256))
    return F.sha2(F.concat(F.lit(outer_pad), inner), 256)
