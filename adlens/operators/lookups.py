"""Lookups over saved conversations, messages and reports (LK1-LK6, WN5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import plus_days
from .filters import search
from .windows import last_per_key, position_within


#: Sequence numbers in one numbering bucket of a list.
SEQ_RANGE = 10_000


def conversation_items(messages: DataFrame, user_of=None) -> DataFrame:
    """Conversation items from their messages: title = the first user
    message, message count, and the last sequence as the update order."""
    first_user = F.min(F.when(F.col("role") == "user", F.struct("seq", "content")))
    items = messages.groupBy("conversation_id").agg(
        first_user["content"].alias("title"),
        F.count(F.lit(1)).alias("n_messages"),
        F.max("seq").alias("last_seq"))
    if user_of is not None:
        items = items.withColumn("user_id", user_of)
    return items


def conversations_of(items: DataFrame, user: str | None = None) -> DataFrame:
    """LK1: a user's conversations, newest first (``position`` 1 = newest);
    without ``user``, every user's list at once."""
    f = items if user is None else items.filter(F.col("user_id") == user)
    return position_within(f, ["user_id"], [F.col("last_seq").desc(), F.col("conversation_id").asc()],
                           -F.floor(F.col("last_seq") / SEQ_RANGE))


def messages_of(messages: DataFrame, conversation: str | None = None) -> DataFrame:
    """LK2: messages of a conversation in time order (``position`` from 1);
    without ``conversation``, every conversation at once."""
    f = messages if conversation is None else messages.filter(F.col("conversation_id") == conversation)
    return position_within(f, ["conversation_id"], [F.col("seq").asc(), F.col("message_id").asc()],
                           F.floor(F.col("seq") / SEQ_RANGE))


def latest_message(messages: DataFrame) -> DataFrame:
    """WN5: the latest message of every conversation."""
    return last_per_key(messages, ["conversation_id"], "seq")


def title_search(items: DataFrame, text: str) -> DataFrame:
    """LK3: conversations whose title contains the text (any case)."""
    return search(items, "title", text)


def reports_by_month(reports: DataFrame) -> DataFrame:
    """LK4: reports grouped by year, then month of creation."""
    return (reports.groupBy(F.year("created_at").alias("year"), F.month("created_at").alias("month"))
                   .agg(F.count(F.lit(1)).alias("n_reports"),
                        F.min("created_at").alias("first_created"),
                        F.max("created_at").alias("last_created")))


def with_report_key(items: DataFrame, reports: DataFrame, key: str = "report_key") -> DataFrame:
    """LK5: each conversation with its report (left join on the key)."""
    r = reports.select(F.col("report_id").alias(key), "period_start", "period_end", "created_at")
    return items.join(r, on=key, how="left")


def active_reports(reports: DataFrame, as_of, user: str | None = None) -> DataFrame:
    """LK6: unexpired reports (``expires_at`` after ``as_of``) per user, by
    expiry; ``position`` 1 expires first."""
    t = F.lit(str(as_of)).cast("timestamp_ntz")
    f = reports.filter(F.col("expires_at") > t)
    if user is not None:
        f = f.filter(F.col("user_id") == user)
    return position_within(f, ["user_id"], [F.col("expires_at").asc(), F.col("report_id").asc()],
                           F.col("expires_at").cast("date"))


def report_row(df: DataFrame, days: int = 90, as_of=None) -> DataFrame:
    """SNK4 row shape: ``expires_at`` = ``created_at`` + 90 days (SC15). Where
    the columns are missing, ``report_id`` is made from the user, the type and
    the period (the same report gets the same id on a rerun) and
    ``created_at`` is ``as_of``."""
    if "report_id" not in df.columns:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("user_id", "type", "period_start", "period_end")]
        df = df.withColumn("report_id", F.sha2(F.concat_ws("\n", *parts), 256).substr(1, 32))
    if "created_at" not in df.columns:
        df = df.withColumn("created_at", F.lit(str(as_of)).cast("timestamp_ntz"))
    return df.withColumn("expires_at", plus_days("created_at", days))
