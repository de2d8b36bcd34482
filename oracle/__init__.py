"""The same results as plain SQL, for checking."""

from oracle.analytics import SQL as ANALYTICS
from oracle.etl import SQL as ETL
from oracle.models import SQL as MODELS
from oracle.star import STAR


def statement(sql: str) -> str:
    """Put the star-schema CTEs in front of a query that may bring CTEs of its own."""
    text = sql.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {STAR},\n{text[5:]}"
    return f"WITH {STAR}\n{text}"


def all_statements() -> dict[str, str]:
    return {key: statement(sql) for key, sql in {**ETL, **ANALYTICS, **MODELS}.items()}
