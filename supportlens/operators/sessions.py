"""Sessions by inactivity: a user's hits with no gap longer than some minutes between them, over midnight too.

Hits are first joined to runs within a user's hours, then the runs of a user to sessions. Only runs are ever brought together for a
user, at most one for each gap in an hour, so that a user with very many hits is dealt over many tasks by hours. Daily loads keep the
sessions that may still go on in a table beside, and give the same sessions as one load of all days.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GAP_MINUTES = 30


def _minutes(n: int) -> Column:
    return F.expr(f"interval '{n}' minutes")


def _starts(order, gap: int, started: str, ended: str) -> Column:
    """Whether a row begins a session: all rows before it of the same key ended longer ago than the gap."""
    before = F.max(ended).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(F.col(started) > before + _minutes(gap), F.lit(True))


def _numbered(hits: DataFrame, user: str, ts: str, gap: int) -> DataFrame:
    """Hits with user and time, and with _run, the start of their run within the hour _slot."""
    timed = hits.where(F.col(user).isNotNull() & F.col(ts).isNotNull()).withColumn("_slot", F.date_trunc("hour", F.col(ts)))
    order = Window.partitionBy(user, "_slot").orderBy(ts)
    begun = timed.withColumn("_begun", F.when(_starts(order, gap, ts, ts), F.col(ts)))
    return begun.withColumn("_run", F.max("_begun").over(order)).drop("_begun")


def runs(hits: DataFrame, user: str = "user_id", ts: str = "ts", hit: str = "hit_id", page: str = "page_path", gap: int = GAP_MINUTES) -> DataFrame:
    """The runs of hits within hours, as rows like sessions' with the hits' order kept: user_id, started, ended, hits, _first, _last (time,
    hit, page). Hits without user or time belong to none."""
    at = F.struct(F.col(ts).alias("at"), F.col(hit).alias("hit"), F.col(page).alias("page"))
    rows = _numbered(hits, user, ts, gap).groupBy(F.col(user).alias("user_id"), "_slot", "_run")
    return rows.agg(F.min(ts).alias("started"), F.max(ts).alias("ended"), F.count(F.lit(1)).alias("hits"), F.min(at).alias("_first"), F.max(at).alias("_last")).drop("_slot", "_run")


def _merged(parts: DataFrame, gap: int) -> DataFrame:
    """`parts` (runs, or sessions that went on) with _session, the start of the session that each belongs to."""
    order = Window.partitionBy("user_id").orderBy("started", "ended")
    begun = parts.withColumn("_begun", F.when(_starts(order, gap, "started", "ended"), F.col("started")))
    return begun.withColumn("_session", F.max("_begun").over(order)).drop("_begun")


def merge_runs(parts: DataFrame, gap: int = GAP_MINUTES) -> DataFrame:
    """Sessions of runs and of open sessions: user_id, started, ended, hits, _first, _last."""
    sums = [F.max("ended").alias("ended"), F.sum("hits").alias("hits"), F.min("_first").alias("_first"), F.max("_last").alias("_last")]
    return _merged(parts, gap).groupBy("user_id", F.col("_session").alias("started")).agg(*sums)


def told(rows: DataFrame) -> DataFrame:
    """Sessions with their first and last page in place of the hits' order."""
    return rows.select("user_id", "started", "ended", "hits", F.col("_first.page").alias("first_page"), F.col("_last.page").alias("last_page"))


def sessions(hits: DataFrame, gap: int = GAP_MINUTES, **columns) -> DataFrame:
    """All sessions of the hits: user_id, started, ended, hits, first_page, last_page. Of hits at one time the smaller id is the earlier one."""
    return told(merge_runs(runs(hits, gap=gap, **columns), gap))


def load_part(hits: DataFrame, still_open: DataFrame | None, end: datetime, gap: int = GAP_MINUTES, **columns) -> tuple[DataFrame, DataFrame]:
    """(closed, open) sessions after a load of the hits before `end` that follow those of the last load. `still_open`: what the last load left
    open (None for the first). A session is open if a hit at `end` would belong to it. The frames keep the hits' order; `told` names the pages."""
    parts = runs(hits, gap=gap, **columns)
    done = merge_runs(parts if still_open is None else parts.unionByName(still_open), gap)
    open_ = F.col("ended") + _minutes(gap) >= F.lit(end).cast("timestamp_ntz")
    return done.where(~open_), done.where(open_)


def with_sessions(hits: DataFrame, user: str = "user_id", ts: str = "ts", gap: int = GAP_MINUTES) -> DataFrame:
    """Hits with session_id, made of the user and the session's start; null without user or time. It takes the place of a column of
    that name, so that the web reports count these sessions. Runs are joined by user and hour, so that no user's hits come together."""
    plain = hits.drop("session_id")
    numbered = _numbered(plain, user, ts, gap)
    found = numbered.groupBy(F.col(user).alias("user_id"), "_slot", "_run").agg(F.min(ts).alias("started"), F.max(ts).alias("ended"))
    named = _merged(found, gap).select(F.col("user_id").alias("_user"), F.col("_slot").alias("_of"), F.col("_run").alias("_from"), "_session")
    met = numbered.join(named, (F.col(user) == F.col("_user")) & (F.col("_slot") == F.col("_of")) & (F.col("_run") == F.col("_from")), "left")
    ident = F.concat_ws("#", F.col(user).cast("string"), F.date_format("_session", "yyyyMMddHHmmssSSSSSS"))
    rest = plain.where(F.col(user).isNull() | F.col(ts).isNull()).withColumn("session_id", F.lit(None).cast("string"))
    return met.select(*plain.columns, ident.alias("session_id")).unionByName(rest)
