"""CRC-32 in the oracles' SQL, which has no function for it."""

#: One row: t, the 256 remainders of the reflected polynomial.
CRC_TABLE = "SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t"


def crc_sql(hex_text: str) -> str:
    """An expression: the unsigned CRC-32 of the bytes written in hex, where a column t of CRC_TABLE is in scope."""
    each = f"list_transform(range(1, length({hex_text}), 2), lambda i: ('0x' || substr({hex_text}, i, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {each}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
