"""CRC-32 in DuckDB SQL, which has no function for it: parts of the checks of operators that use it."""

#: One row with the 256 entries of the table of the reversed polynomial, as a list.
CRC_TABLE = """SELECT list(list_reduce([b, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crc_of
FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256))"""


def crc32(number: str, table: str = "crc_of") -> str:
    """The unsigned CRC-32 of a whole number's decimal digits, given the column that holds the table."""
    text = f"CAST({number} AS VARCHAR)"
    letters = f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ascii({text}[i]) AS BIGINT))"
    step = f"xor(c >> 8, {table}[xor(c, b) % 256 + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {letters}), lambda c, b: {step}), 4294967295)"
