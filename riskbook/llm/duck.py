"""DuckDB SQL that several oracles of this package share."""

from __future__ import annotations

_POLYNOMIAL = 0xEDB88320  # fixed value: the reversed polynomial of the public CRC-32


def _table() -> list[int]:
    out = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ _POLYNOMIAL * (byte & 1)
        out.append(byte)
    return out


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text expression whose characters are below U+0800."""
    code = "ord(c)"
    utf8 = f"case when {code} < 128 then [{code}] else [192 + ({code} >> 6), 128 + ({code} & 63)] end"
    units = f"flatten(list_transform(string_split({text}, ''), lambda c: case when c = '' then []::int[] else {utf8} end))"
    step = f"xor(a >> 8, ({_table()}::bigint[])[(xor(a, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {units}::bigint[]), lambda a, b: {step}), 4294967295::bigint)"
