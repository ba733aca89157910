"""DuckDB SQL that several checks of this package share."""

from __future__ import annotations

# Table crc_step(t): what one byte does to the lowest eight bits of a CRC-32, from its polynomial.
CRC_STEP = """crc_step AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce(list_prepend(i::UBIGINT, list_transform(range(8), lambda k: 0::UBIGINT)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v FROM range(256) r(i))
)"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a SQL expression, where crc_step is joined in."""
    codes = f"list_transform(range(1, strlen({text}) + 1), lambda i: ('0x' || substr(hex({text}), 2 * i - 1, 2))::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT)"


# A-Z alone in lower case.
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS_SQL = rf"regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
