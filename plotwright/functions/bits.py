"""Bit signatures: hex text, bit text, bytes and 64-bit words, and Hamming similarity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of a signature, bits that make its bucket, similarity cut-off.
SIGNATURE_BITS = 256
BUCKET_BITS = 8
SIMILARITY = 0.85


def max_distance(n_bits: int, similarity: float = SIMILARITY) -> int:
    """The greatest Hamming distance whose similarity 1 - d/n still reaches the cut-off."""
    distance = int((1 - similarity) * n_bits) + 1
    while 1 - distance / n_bits < similarity:
        distance -= 1
    return distance


def _chunks(n_bits: int) -> list[tuple[int, int]]:
    """1-based start and length, in hex digits, of each word."""
    digits = (n_bits + 3) // 4
    return [(start + 1, min(16, digits - start)) for start in range(0, digits, 16)]


def hex_digits(signature: Column, n_bits: int = SIGNATURE_BITS) -> Column:
    """Signature text at its full width; text that is no hex number counts as zero."""
    digits = (n_bits + 3) // 4
    plain = F.regexp_replace(F.lower(F.trim(signature)), "^0+", "")
    valid = F.when(F.trim(signature).rlike("^[0-9A-Fa-f]+$"), plain).otherwise(F.lit(""))
    return F.lpad(valid, digits, "0")


def bits(signature: Column, n_bits: int = SIGNATURE_BITS) -> Column:
    """Hex text to `0`/`1` text of n_bits."""
    full = hex_digits(signature, n_bits)
    parts = [
        F.lpad(F.conv(F.substring(full, start, length), 16, 2), 4 * length, "0") for start, length in _chunks(n_bits)
    ]
    return F.substring(F.concat(*parts), 1, n_bits)


def bits_to_hex(text: Column, n_bits: int) -> Column:
    """`0`/`1` text to hex text, zero bits put in front to fill the first digit."""
    digits = (n_bits + 3) // 4
    full = F.lpad(text, 4 * digits, "0")
    parts = [
        F.lpad(F.lower(F.conv(F.substring(full, 4 * (start - 1) + 1, 4 * length), 2, 16)), length, "0")
        for start, length in _chunks(n_bits)
    ]
    return F.concat(*parts)


def words(signature: Column, n_bits: int = SIGNATURE_BITS) -> Column:
    """Hex text to 64-bit words, as array<bigint>."""
    full = hex_digits(signature, n_bits)
    return F.array(
        *[F.conv(F.substring(full, start, length), 16, -10).cast("bigint") for start, length in _chunks(n_bits)]
    )


def to_bytes(signature: Column, n_bits: int = SIGNATURE_BITS) -> Column:
    """Hex text to packed bytes, the last byte filled up with zero bits."""
    width = 8 * ((n_bits + 7) // 8)
    return F.unhex(bits_to_hex(F.rpad(bits(signature, n_bits), width, "0"), width))


def from_bytes(packed: Column, n_bits: int = SIGNATURE_BITS) -> Column:
    """Packed bytes to `0`/`1` text, cut or filled with zero bits to n_bits."""
    digits = 2 * ((n_bits + 7) // 8)
    return F.substring(bits(F.rpad(F.hex(packed), digits, "0"), 4 * digits), 1, n_bits)


def bucket(bit_text: Column, bucket_bits: int = BUCKET_BITS) -> Column:
    """The leading bits as a number, bit i weighing 2^i."""
    return F.conv(F.reverse(F.substring(bit_text, 1, bucket_bits)), 2, 10).cast("int")


def neighbor_buckets(b: Column, bucket_bits: int = BUCKET_BITS) -> Column:
    """The bucket itself and those one bit away."""
    return F.array(b, *[b.bitwiseXOR(F.lit(1 << i)) for i in range(bucket_bits)])


def distance(left: Column, right: Column, n_bits: int = SIGNATURE_BITS) -> Column:
    """Hamming distance of two word arrays."""
    per_word = [
        F.bit_count(F.get(left, F.lit(i)).bitwiseXOR(F.get(right, F.lit(i)))) for i in range(len(_chunks(n_bits)))
    ]
    return reduce(lambda a, b: a + b, per_word)


def similarity(left: Column, right: Column, n_bits: int = SIGNATURE_BITS) -> Column:
    """1 - d/n of two word arrays; 0 where either is missing."""
    return F.coalesce(1 - distance(left, right, n_bits) / F.lit(n_bits), F.lit(0.0))
