"""Readers (SRC1-SRC7): CSV text, landed API responses, partitioned fact
tables, SQL, and report documents. Schemas are always explicit."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import double_or_zero, long_trunc_or_zero, text_or_empty
from ..functions.dates import in_range
from ..operators.joins import file_order
from ..session import existing, isolated, scratch_path
from . import dialect
from ..schemas import ACCOUNT_LIST, GOOGLE_RESPONSE, KAKAO_RESPONSE, REPORT_DOCUMENT, TABLES

DEFAULT_ENCODINGS = ("UTF-8", "MS949", "EUC-KR")


#: Fixed names: an encoding's name as the JVM's decoder knows it.
_CHARSETS = {"UTF8": "UTF-8", "UTF8SIG": "UTF-8", "MS949": "MS949", "CP949": "MS949", "EUCKR": "EUC-KR"}


def read_csv_text(spark: SparkSession, path: str, sep: str | None = None, encodings=DEFAULT_ENCODINGS,
                  multi_line: bool = False, place: str | None = None, corrupt: str | None = None) -> DataFrame:
    """SRC1: header CSV with every field as text.

    One scan finds, for every file, the first encoding of ``encodings`` that
    decodes all its lines, its separator (comma, semicolon, tab or bar, unless
    ``sep`` is given) and its header (``dialect.survey``); a file that no
    encoding decodes, or whose separator is not clear, is an error. Files are
    then read in groups that look alike, and columns are matched by name: a
    column that a file lacks is NULL in its rows.

    Quotes inside quoted fields are doubled. ``multi_line`` admits line breaks
    in quoted fields, also within a file that several tasks read
    (``dialect.joined_records``). ``place`` adds a column with each row's place
    in the files (``joins.file_order``), ``corrupt`` one with the text of
    records that have too many or too few fields (else NULL).

    Files in another encoding than UTF-8 are read once, in a session of its own
    that admits such encodings, into a table under the shared folder."""
    names = [_CHARSETS.get(e.upper().replace("-", "").replace("_", ""), e) for e in encodings]
    legacy = {"spark.sql.legacy.javaCharsets": "true", "spark.sql.legacy.codingErrorAction": "true"}
    own = spark if set(names) <= {"UTF-8"} else isolated(spark, legacy)
    rows = dialect.lines(own, path)
    alike = dialect.groups(dialect.survey(dialect.joined_records(rows) if multi_line else rows, names, sep))
    for g in alike:
        if g["charset"] is None:
            raise ValueError(f"no encoding of {encodings} decodes {g['files'][0]}")
        if g["sep"] is None:
            raise ValueError(f"the separator of {g['files'][0]} is not clear: pass sep")
    if not alike:
        raise ValueError(f"no records in {path}")
    parts = [_read_alike(spark if g["charset"] == "UTF-8" else own, g, multi_line, place, corrupt) for g in alike]
    if any(g["charset"] != "UTF-8" for g in alike):
        copies = [scratch_path(spark, "decoded_csv") for _ in parts]
        for part, copy in zip(parts, copies):
            part.write.parquet(copy)
        parts = [spark.read.parquet(copy) for copy in copies]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _read_alike(spark: SparkSession, group, multi_line: bool, place: str | None, corrupt: str | None) -> DataFrame:
    """Files of one encoding, separator and header."""
    options = {"sep": group["sep"], "mode": "PERMISSIVE", "escape": '"', **({"columnNameOfCorruptRecord": corrupt} if corrupt else {})}
    files, charset = group["files"], group["charset"]
    r = spark.read.options(**options).option("encoding", charset).option("header", True)
    header = r.option("inferSchema", False).option("multiLine", multi_line).csv(files[0]).columns
    schema = ", ".join(f"`{c}` string" for c in header) + (f", `{corrupt}` string" if corrupt else "")
    if not multi_line:
        df = r.schema(schema).csv(files)
        return df.withColumn(place, file_order(df)) if place else df
    rows = dialect.joined_records(dialect.lines(spark, files)).where(F.trim(F.col("record")) != "")
    first = rows.groupBy("file").agg(F.min("row").alias("row"))
    text = F.col("record") if charset == "UTF-8" else F.decode(F.col("record").cast("binary"), charset)
    body = rows.join(first, ["file", "row"], "left_anti").select(
        F.from_csv(F.regexp_replace(text, "\r$", ""), F.lit(schema), options).alias("r"),
        F.struct("file", F.col("split").alias("block"), "row").alias("at"))
    return body.select("r.*", *([F.col("at").alias(place)] if place else []))


def read_responses(spark: SparkSession, path: str, platform: str) -> DataFrame:
    """Landed response documents (one JSON document per line)."""
    schema = {"google": GOOGLE_RESPONSE, "kakao": KAKAO_RESPONSE, "accounts": ACCOUNT_LIST}[platform]
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def flatten_google(docs: DataFrame, customer_id: str | None = None, date: str | None = None,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC2: google response documents to the 35 columns the batch path
    writes (the five creation_* columns are never filled). Missing text is
    '', missing numbers 0, integers truncated. ``basic_date`` is ``date``
    (the extract day) or each row's segment date, as ``yyyyMMdd``."""
    r = docs.select(*keep, F.explode("results").alias("r")).select(*keep, "r.*")
    s = lambda n: text_or_empty(F.col(n))
    day = F.lit(date) if date else F.col("segments.date")
    cols = [
        s("campaign.id").alias("camp_id"), s("campaign.name").alias("camp_name"),
        s("campaign.advertisingChannelType").alias("camp_advertising_channel_type"),
        s("campaign.status").alias("camp_status"),
        s("adGroup.id").alias("agroup_id"), s("adGroup.name").alias("agroup_name"),
        s("adGroup.type").alias("agroup_type"),
        s("adGroupCriterion.criterionId").alias("keyword_id"),
        s("adGroupCriterion.keyword.text").alias("keyword_text"),
        s("adGroupCriterion.keyword.matchType").alias("keyword_match_type"),
        s("segments.device").alias("device"), s("segments.network").alias("network_type"),
        s("segments.date").alias("date"), s("segments.quarter").alias("quarter"),
        s("segments.dayOfWeek").alias("day_of_week"), s("segments.week").alias("week"),
        F.regexp_replace(text_or_empty(day), "-", "").alias("basic_date"),
        (F.lit(customer_id.replace("-", "")) if customer_id else F.lit("")).alias("adv_id"),
    ]
    longs = {"impressions": "impressions", "clicks": "clicks", "video_views": "videoViews",
             "all_conversions": "allConversions", "conversions": "conversions"}
    doubles = {"cost_micros": "costMicros", "ctr": "ctr", "average_cpc": "averageCpc",
               "all_conversions_value": "allConversionsValue", "conversions_value": "conversionsValue",
               "value_per_conversion": "valuePerConversion", "cost_per_conversion": "costPerConversion",
               "conversions_from_interactions_rate": "conversionsFromInteractionsRate",
               "video_quartile_p25_rate": "videoQuartileP25Rate", "video_quartile_p50_rate": "videoQuartileP50Rate",
               "video_quartile_p75_rate": "videoQuartileP75Rate", "video_quartile_p100_rate": "videoQuartileP100Rate"}
    cols += [long_trunc_or_zero(F.col(f"metrics.{v}")).alias(k) for k, v in longs.items()]
    cols += [double_or_zero(F.col(f"metrics.{v}")).alias(k) for k, v in doubles.items()]
    return r.select(*keep, *cols)


def explode_accounts(docs: DataFrame) -> DataFrame:
    """SRC4: account list documents to one row per account id."""
    return docs.select(F.explode("adAccounts").alias("a")).select(F.col("a.id").alias("account_id"))


def flatten_kakao(docs: DataFrame, date: str | None = None, accounts: DataFrame | None = None,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """SRC3: per-account kakao responses to the 25 batch columns. Documents
    of failed accounts (``ok`` false) are skipped; the rest continue. With
    ``accounts`` only listed accounts are kept (semi join)."""
    d = docs.filter(F.coalesce(F.col("ok"), F.lit(False)))
    if accounts is not None:
        d = d.join(accounts, on="account_id", how="left_semi")
    r = (d.select("account_id", "date", *keep, F.explode("data").alias("k"))
          .select("account_id", "date", *keep, "k.*"))
    longs = {"imp": "imp", "click": "click", "rimp": "rimp", "rank": "rank",
             "conv_cmpt_reg_1d": "convCmptReg1d", "conv_cmpt_reg_7d": "convCmptReg7d",
             "conv_view_cart_1d": "convViewCart1d", "conv_view_cart_7d": "convViewCart7d",
             "conv_purchase_1d": "convPurchase1d", "conv_purchase_7d": "convPurchase7d",
             "conv_participation_1d": "convParticipation1d", "conv_participation_7d": "convParticipation7d",
             "conv_signup_1d": "convSignup1d", "conv_signup_7d": "convSignup7d",
             "conv_app_install_1d": "convAppInstall1d", "conv_app_install_7d": "convAppInstall7d"}
    doubles = {"spending": "spending", "ctr": "ctr", "ppc": "ppc",
               "conv_purchase_p_1d": "convPurchaseP1d", "conv_purchase_p_7d": "convPurchaseP7d"}
    day = F.lit(date) if date else F.col("date")
    cols = [text_or_empty(F.col("keywordId")).alias("kwd_id"), text_or_empty(F.col("adGroupId")).alias("agroup_id"),
            F.regexp_replace(text_or_empty(day), "-", "").alias("basic_date"),
            text_or_empty(F.col("account_id")).alias("adv_id")]
    cols += [long_trunc_or_zero(F.col(f"metrics.{v}")).alias(k) for k, v in longs.items()]
    cols += [double_or_zero(F.col(f"metrics.{v}")).alias(k) for k, v in doubles.items()]
    return r.select(*keep, *cols)


def day_folders(spark: SparkSession, path: str, start: str, end: str) -> list[str]:
    """The existing day folders of a date range; only the months of the range are listed."""
    first, last = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)
    found, month = [], first.replace(day=1)
    while month <= last:
        after = (month + _dt.timedelta(days=31)).replace(day=1)
        a, b = max(first, month).day, min(last, after - _dt.timedelta(days=1)).day
        days = ",".join(f"{d:02d}" for d in range(a, b + 1))
        found += existing(spark, f"{path.rstrip('/')}/year={month.year:04d}/month_p={month.month:02d}/day={{{days}}}")
        month = after
    return found


def scan_table(spark: SparkSession, path: str, platform: str, start=None, end=None) -> DataFrame:
    """SRC5: a partitioned fact table read with its fixed schema. The stored
    ``report_date`` is also the date of the row's partition.

    A range given as ``yyyy-MM-dd`` texts reads only the folders of its days
    (nothing else is listed) and filters rows by ``report_date``, which also
    reaches the Parquet scan. Open or computed ranges read the whole folder
    tree with a partition filter."""
    schema = TABLES[f"{platform}_ad_performance"]
    plain = isinstance(start, str) and isinstance(end, str)
    if plain:
        days = day_folders(spark, path, start, end)
        if not days:
            return spark.createDataFrame([], schema)
        df = spark.read.schema(schema).option("basePath", path).parquet(*days)
        return df.filter(F.col("report_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    df = spark.read.schema(schema).parquet(path)
    if start is not None or end is not None:
        df = in_range(df, start or "0001-01-01", end or "9999-12-31")
    return df


#: Statements that only read. First words of Spark SQL queries.
READING = ("SELECT", "WITH", "VALUES", "FROM", "TABLE", "SHOW", "DESCRIBE", "DESC", "EXPLAIN", "(")


def sql(spark: SparkSession, text: str, **values) -> DataFrame:
    """SRC6: ad-hoc SQL over catalog tables and temp views; errors raise.

    ``values`` are bound to ``:name`` markers as literals, so a text with
    quotes is a value and never a part of the statement. Only statements that
    read are admitted: the parsed plan may hold no command, wherever it stands
    (a WITH clause in front of an INSERT, too)."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    first = text.lstrip().upper()
    if not first.startswith(READING) or _writes(plan):
        raise ValueError("only statements that read are admitted")
    return spark.sql(text, args=values) if values else spark.sql(text)


def _writes(plan) -> bool:
    """Whether a node of a parsed plan is an insert, or a command that does more than tell."""
    name = plan.nodeName()
    if name.startswith(("Show", "Describe", "Explain")):
        return False
    if name.startswith(("Insert", "Create", "Drop", "Replace", "Delete", "Update", "Merge", "Alter", "Append", "Overwrite",
                        "Truncate", "Set", "Reset", "Cache", "Uncache", "Refresh", "Load", "Add", "Analyze", "Repair",
                        "Recover", "Rename", "CTAS", "Compound")) or name.endswith("Command"):
        return True
    children = plan.children()
    return any(_writes(children.apply(i)) for i in range(children.size()))


def read_report_docs(spark: SparkSession, path: str) -> DataFrame:
    """SRC7: report documents, one per file, named ``{report_id}.json`` or
    kept in a ``report_id=<id>/`` folder; the id comes from the path."""
    d = spark.read.schema(REPORT_DOCUMENT).option("multiLine", True).json(path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"report_id=([^/]+)/", 1)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.json$", 1)
    rid = F.when(folder != "", folder).otherwise(name)
    return d.select(rid.alias("report_id"), "title", F.col("createdAt").alias("created_at"), "messages")


__all__ = ["read_csv_text", "read_responses", "flatten_google", "flatten_kakao", "explode_accounts",
           "scan_table", "sql", "read_report_docs"]
