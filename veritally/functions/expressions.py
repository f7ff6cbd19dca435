"""SQL expressions for values that arrive as text."""

from __future__ import annotations

from veritally.config import Config

# Spark completes '1990' or '2026-09' to a date; those must stay unparsable.
STARTS_WITH_FULL_DATE = r"r'^\s*\d{4,}-\d{1,2}-\d{1,2}'"

# The texts the expectation loader reads as missing.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def quoted(*values: str) -> str:
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def blank(text: str) -> str:
    return f"coalesce(trim({text}), '') = ''"


def full_match(text: str, pattern: str) -> str:
    """The whole string matches; unlike ``$``, no trailing newline is forgiven."""
    return rf"{text} RLIKE r'\A(?:{pattern})\z'"


def money(text: str) -> str:
    return f"try_cast({text} AS DECIMAL(18, 2))"


def utc_timestamp(text: str) -> str:
    return (f"CASE WHEN {text} RLIKE {STARTS_WITH_FULL_DATE} "
            f"THEN try_cast(replace({text}, 'Z', '') AS TIMESTAMP_NTZ) END")


def calendar_date(text: str) -> str:
    return f"CASE WHEN {text} RLIKE {STARTS_WITH_FULL_DATE} THEN try_cast({text} AS DATE) END"


def business_day(ts_utc: str, cfg: Config) -> str:
    return f"CAST({ts_utc} + INTERVAL '{cfg.offset_minutes}' MINUTE AS DATE)"


def number(text: str) -> str:
    """Double or NULL; Java's type suffixes ('5d') are not numbers."""
    return rf"CASE WHEN NOT {text} RLIKE r'[0-9.][dDfF]\s*$' THEN try_cast({text} AS DOUBLE) END"


def missing_to_null(text: str) -> str:
    return f"CASE WHEN {text} NOT IN ({quoted(*MISSING_TEXTS)}) THEN {text} END"


def zero_padded(number_: str, width: int) -> str:
    """At least ``width`` digits; longer numbers are kept whole."""
    digits = f"CAST({number_} AS STRING)"
    return f"lpad({digits}, greatest({width}, length({digits})), '0')"


def iso_utc(ts: str) -> str:
    return f"""date_format({ts}, "yyyy-MM-dd'T'HH:mm:ss'Z'")"""


def money_text(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(18, 2)) AS STRING)"


def number_text(value: str) -> str:
    """Money with its hundredths; a number beyond that, or none, as it is."""
    return f"coalesce(CAST(try_cast({value} AS DECIMAL(18, 2)) AS STRING), CAST({value} AS STRING))"


def rotate(choices: list[str], turn: str) -> str:
    """The ``turn``-th choice, starting over after the last."""
    return f"element_at(array({quoted(*choices)}), CAST({turn} % {len(choices)} AS INT) + 1)"


def share(part: str, whole: str, places: int, empty: float) -> str:
    """``part / whole`` rounded half up on the exact fraction, ``empty`` for x / 0."""
    scale = 10**places
    rounded = f"(CAST({part} AS DECIMAL(20, 0)) * {2 * scale} + {whole}) div (CAST({whole} AS DECIMAL(20, 0)) * 2)"
    return f"CASE WHEN {whole} = 0 THEN {empty}D ELSE CAST({rounded} AS DOUBLE) / {scale} END"


def total(direction: str) -> str:
    return f"sum(CASE WHEN direction = '{direction}' THEN inr_amount ELSE 0 END)"


NET = "sum(CASE WHEN direction = 'CREDIT' THEN inr_amount ELSE -inr_amount END)"
