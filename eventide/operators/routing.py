"""Derive the typed topics from page views, mask user fields, tag rows
(C12, C13, C20, D1-D3, D6, E5).

All functions are stateless except :func:`auth_attempts`, which needs the
previous page (see :mod:`eventide.operators.sessions` for batch and
:mod:`eventide.streaming.stateful` for streams).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: page names that route a page view to another topic
SONG_PAGE = "NextSong"
LEVEL_PAGES = ["Submit Downgrade", "Submit Upgrade"]
LOGIN_PAGE = "Login"
LOGGED_IN = "Logged In"

# fixed values: which auth states show user details (default config)
DEFAULT_SHOW = [("Logged In", True), ("Logged Out", False), ("Guest", False),
                ("Cancelled", True)]

USER_FIELDS = ["userid", "city", "zip", "state", "lastname", "firstname",
               "gender", "registration", "tag"]

SESSION_FIELDS = ["ts", "sessionid", "auth", "level", "iteminsession"]


def _present(df: DataFrame, cols: list[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def listens(page_views: DataFrame, page_col: str = "page",
            drop: tuple[str, ...] = ("page", "method", "status")) -> DataFrame:
    """Page views on the song page, without page/method/status."""
    out = page_views.where(F.col(page_col) == SONG_PAGE)
    return out.drop(*_present(out, list(drop)))


def status_changes(page_views: DataFrame, page_col: str = "page",
                   drop: tuple[str, ...] = ("page", "method", "status", "artist",
                                            "song", "duration")) -> DataFrame:
    """Page views on a level-change page, in the status-change shape."""
    out = page_views.where(F.col(page_col).isin(LEVEL_PAGES))
    return out.drop(*_present(out, list(drop)))


def login_success(auth_col: str = "auth") -> Column:
    """C20: login succeeded when the current auth is 'Logged In'."""
    return F.col(auth_col) == F.lit(LOGGED_IN)


def auth_attempts(with_previous: DataFrame, prev_col: str = "previous_page",
                  auth_col: str = "auth",
                  drop: tuple[str, ...] = ("page", "method", "status", "artist", "song",
                                           "duration", "auth")) -> DataFrame:
    """D3: events whose previous page is the login page, with ``success``.

    The input carries ``previous_page`` (G1); the auth column is dropped after
    it sets the flag.
    """
    out = with_previous.where(F.col(prev_col) == LOGIN_PAGE) \
        .withColumn("success", login_success(auth_col))
    return out.drop(*_present(out, list(drop) + [prev_col]))


def show_table(spark: SparkSession, rules=None) -> DataFrame:
    """E5: the auth -> show lookup. A literal list of a handful of rows, so a
    broadcast of it is bounded by construction."""
    return spark.createDataFrame(rules or DEFAULT_SHOW, "auth string, show boolean")


def mask_users(df: DataFrame, rules: DataFrame | None = None, auth_col: str = "auth",
               fields: list[str] | None = None) -> DataFrame:
    """Null the user fields (and tag) unless the row's auth state is
    flagged "show". An auth value missing from the rules is hidden."""
    spark = df.sparkSession
    rules = rules if rules is not None else show_table(spark)
    fields = _present(df, fields or USER_FIELDS)
    j = df.join(F.broadcast(rules.withColumnRenamed("auth", "_auth")),
                F.col(auth_col) == F.col("_auth"), "left")
    shown = F.coalesce(F.col("show"), F.lit(False))
    cols = [F.when(shown, F.col(c)).alias(c) if c in fields else F.col(c) for c in df.columns]
    return j.select(*cols)


def add_tag(df: DataFrame, tag: str | Column, shown: Column | None = None,
            out: str = "tag") -> DataFrame:
    """Tag each row for an A/B comparison; null when the user is hidden."""
    t = F.lit(tag) if isinstance(tag, str) else tag
    return df.withColumn(out, F.when(shown, t) if shown is not None else t)


def time_range(df: DataFrame, ts_col: str, start=None, end=None) -> DataFrame:
    """Rows strictly after ``start`` and strictly before ``end``. Written as
    plain comparisons so Parquet row-group pruning applies."""
    c = F.col(ts_col)
    if start is not None:
        df = df.where(c > F.lit(start))
    if end is not None:
        df = df.where(c < F.lit(end))
    return df
