"""Roll numbers and composite student keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed patterns: the state's two examination boards, with their roll lengths.
STATE_BOARD = r"\bBOARD OF SECONDARY EDUCATION,\s*ODISHA\b"
STATE_BOARD_SHORT = r"\bBSE\b(?! MADHYAMA).*ODISHA\b"
OTHER_BOARDS = r"\bICSE\b|\bCBSE\b"
STATE_COUNCIL = r"\bCOUNCIL OF HIGHER SECONDARY EDUCATION,\s*ODISHA\b"
STATE_COUNCIL_SHORT = r"\bCHSE\b.*ODISHA\b"
BOARD_ROLL_LENGTH = 9
COUNCIL_ROLL_LENGTH = 8


def decrypt_roll(col: Column, key: Column | str) -> Column:
    """Text behind base64 AES-ECB; "NA" for anything that does not decrypt.

    The key comes from the caller's secret store, never from code.
    """
    secret = F.lit(key) if isinstance(key, str) else key
    plain = F.try_aes_decrypt(F.try_to_binary(col, F.lit("base64")), secret, F.lit("ECB"), F.lit("PKCS"))
    return F.coalesce(F.trim(F.when(col != "", plain.cast("string"))), F.lit("NA"))


def valid_roll(roll: Column, board: Column) -> Column:
    """The roll number, or "NA" when a state board's roll has the wrong length."""
    name = F.upper(F.coalesce(board, F.lit("NA")))
    is_board = name.rlike(STATE_BOARD) | (
        name.rlike(STATE_BOARD_SHORT) & ~name.rlike(OTHER_BOARDS)
    )
    is_council = name.rlike(STATE_COUNCIL) | name.rlike(STATE_COUNCIL_SHORT)
    wrong = (is_board & (F.length(roll) != BOARD_ROLL_LENGTH)) | (
        is_council & (F.length(roll) != COUNCIL_ROLL_LENGTH)
    )
    return F.when(wrong, "NA").otherwise(roll)


def key_part(col: Column, lower: bool = True) -> Column:
    """One part of a key: trimmed, unquoted, MISSING for null or blank."""
    text = F.btrim(F.btrim(F.trim(col.cast("string")), F.lit('"')), F.lit("'"))
    body = F.lower(F.trim(text)) if lower else text
    return F.when(text.isNull() | (text == ""), "MISSING").when(text == "NA", "NA").otherwise(body)


def student_key(*parts: Column) -> Column:
    """Encoded parts joined by underscores; never null."""
    return F.concat_ws("_", *[key_part(p) for p in parts])


def strict_student_key(*parts: Column) -> Column:
    """Parts joined by hyphens; null as soon as one part is null."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        pieces += ([F.lit("-")] if i else []) + [part.cast("string")]
    return F.concat(*pieces)


def unified_person_id(module: Column, barcode: Column, person: Column) -> Column:
    """Application number for PDIS, else the hashed person id."""
    return F.when(module == "PDIS", barcode).otherwise(person)
