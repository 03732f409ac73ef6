"""Text search over the multi-valued columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import contains_ci, has_token_ci


def _terms(value: str | Sequence[str] | None) -> list[str]:
    if not value:
        return []
    return [value] if isinstance(value, str) else [t for t in value if t]


def search_titles(df: DataFrame, genres: str | Sequence[str] | None = None,
                  cast: str | Sequence[str] | None = None,
                  director: str | Sequence[str] | None = None,
                  sort_by: str = "vote_average", ascending: bool = False,
                  match: str = "substring") -> DataFrame:
    """AND of case-insensitive tests; every term of a list must match.
    ``match='substring'`` (default) tests literal substrings of the
    pipe-joined text, ``match='token'`` whole items. A null column never
    matches. Sorted by ``sort_by`` with nulls last, ties by id."""
    if match not in ("substring", "token"):
        raise ValueError(f"match must be 'substring' or 'token', not {match!r}")
    test = contains_ci if match == "substring" else has_token_ci
    cond = None
    for column, value in (("genres", genres), ("cast", cast), ("director", director)):
        for term in _terms(value):
            c = test(column, term)
            cond = c if cond is None else cond & c
    data = df if cond is None else df.where(cond)
    order = F.col(sort_by).asc_nulls_last() if ascending else F.col(sort_by).desc_nulls_last()
    return data.orderBy(order, F.col("id").asc())


def search_scifi_action_bruce_willis(df: DataFrame) -> DataFrame:
    """Science Fiction and Action titles with Bruce Willis, best rated first."""
    return search_titles(df, genres=["Science Fiction", "Action"], cast="Bruce Willis",
                         sort_by="vote_average", ascending=False) \
        .select("title", "vote_average", "genres", "cast")


def search_thurman_tarantino(df: DataFrame) -> DataFrame:
    """Titles with Uma Thurman directed by Quentin Tarantino, shortest first."""
    return search_titles(df, cast="Uma Thurman", director="Quentin Tarantino",
                         sort_by="runtime", ascending=True) \
        .select("title", "runtime", "director", "cast")
