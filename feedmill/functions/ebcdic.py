"""Decoding of EBCDIC text and packed, zoned and binary numbers, as columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F, types as T

from feedmill.fields import Field


def _code_page(encoding: str) -> tuple[str, str]:
    """Characters of a single-byte code page where it differs from ISO 8859-1."""
    every = bytes(range(256))
    pairs = [(a, b) for a, b in zip(every.decode("latin-1"), every.decode(encoding)) if a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def decode_text(data: Column, encoding: str = "cp037") -> Column:
    """Bytes of a single-byte code page as text."""
    latin, page = _code_page(encoding)
    return F.translate(F.decode(data, "ISO-8859-1"), latin, page)


def encode_text(text: Column, encoding: str = "cp037") -> Column:
    """Text as bytes of a single-byte code page."""
    latin, page = _code_page(encoding)
    return F.encode(F.translate(text, page, latin), "ISO-8859-1")


def _scaled(digits: Column, negative: Column, precision: int) -> Column:
    unit = F.lit(Decimal(1).scaleb(-precision)).cast(T.DecimalType(precision + 1, precision))
    value = digits.try_cast(T.DecimalType(31, 0)) * unit
    value = value.try_cast(T.DecimalType(31, precision))
    return F.when(negative, -value).otherwise(value)


def packed_decimal(data: Column, precision: int = 0) -> Column:
    """Packed decimal: two digits a byte, the last half byte is the sign."""
    nibbles = F.hex(data)
    size = F.length(nibbles)
    sign = F.substring(nibbles, -1, 1)
    return _scaled(F.substring(nibbles, F.lit(1), size - 1), sign.isin("B", "D"), precision)


def pack_decimal(value: Column, length: int, precision: int = 0) -> Column:
    """A decimal as ``length`` packed bytes."""
    scaled = (value.cast(T.DecimalType(18, precision)) * F.lit(10**precision)).cast("bigint")
    digits = F.lpad(F.abs(scaled).cast("string"), 2 * length - 1, "0")
    return F.unhex(F.concat(digits, F.when(scaled < 0, "D").otherwise("C")))


def zoned_decimal(data: Column, precision: int = 0) -> Column:
    """Zoned decimal: one digit a byte, the zone of the last byte is the sign."""
    nibbles = F.hex(data)
    digits = F.regexp_replace(nibbles, "[0-9A-F]([0-9A-F])", "$1")
    zone = F.substring(nibbles, -2, 1)
    return _scaled(digits, zone.isin("B", "D"), precision)


def binary_integer(data: Column, length: int) -> Column:
    """Big-endian two's complement integer of up to eight bytes."""
    unsigned = F.conv(F.hex(data), 16, 10).cast(T.DecimalType(20, 0))
    top = F.conv(F.hex(F.substring(data, 1, 1)), 16, 10).cast("int")
    full = F.lit(Decimal(2) ** (8 * length)).cast(T.DecimalType(20, 0))
    return F.when(top >= 128, unsigned - full).otherwise(unsigned).cast("bigint")


def record_field(record: Column, field: Field, encoding: str = "cp037") -> Column:
    """A field of a record by its declared type.

    ``packed``, ``zoned`` and ``comp`` are numbers; all else is trimmed text.
    """
    data = F.substring(record, field.start, field.length)
    if field.type in ("packed", "comp-3"):
        value = packed_decimal(data, field.precision)
    elif field.type in ("zoned", "display"):
        value = zoned_decimal(data, field.precision)
    elif field.type == "comp":
        value = binary_integer(data, field.length)
    else:
        value = F.trim(decode_text(data, encoding))
    return value.alias(field.column)
