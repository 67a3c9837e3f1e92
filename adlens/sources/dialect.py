"""What CSV files look like (SRC1): encoding, separator and header of every
file from one scan, and records whose quoted fields hold line breaks, read by
as many tasks as the files have splits.

A record's border is a line end outside quotes: one with an even number of
quotes before it in the file. Each split adds up its quotes, the sums are
carried over the splits of a file (one row a split), and every line then knows
whether it begins inside quotes and which record it belongs to. Only lines of
records with line breaks are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: Separators that are tried, in no order of preference.
SEPARATORS = (",", ";", "\t", "|")
#: Share of a file's records that must have as many separators as its header, where the header holds other candidates
#: too, and where it holds no other.
AGREEMENT, ALONE = 0.9, 0.5
#: Encodings in which bytes below 128 are the characters of ASCII.
ASCII_BASED = {"UTF-8", "MS949", "EUC-KR"}
#: Stands for bytes that an encoding cannot read.
UNREADABLE = "�"


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, row, record): the lines of the files as raw bytes, with their places."""
    t = spark.read.option("lineSep", "\n").text(path)
    return t.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                    F.monotonically_increasing_id().alias("row"), F.col("value").alias("record"))


def _count(text: Column, char: str) -> Column:
    raw = text.cast("binary")
    return F.octet_length(raw) - F.octet_length(F.replace(text, F.lit(char), F.lit("")).cast("binary"))


def joined_records(rows: DataFrame) -> DataFrame:
    """``rows`` (``lines``) with the lines of one record joined by line ends; ``split`` 0 and ``row`` the record's
    number in its file. A file whose last quote is never closed is an error."""
    marked = rows.withColumn("odd", _count(F.col("record"), '"') % 2)
    own = Window.partitionBy("file", "split").orderBy("row")
    before = F.coalesce(F.sum("odd").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    narrow = marked.select("file", "split", "row", "odd").withColumn("before", before)
    by_split = narrow.groupBy("file", "split").agg(
        F.sum("odd").alias("odd"), F.count(F.lit(1)).alias("n"), F.sum(F.lit(1) - F.col("before")).alias("even"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    carried = by_split.withColumn("open", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    starts = F.when(F.col("open") == 0, F.col("even")).otherwise(F.col("n") - F.col("even"))
    carried = carried.withColumn("starts", starts).select(
        "file", "split", "open", F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("records"))
    unclosed = by_split.groupBy("file").agg((F.sum("odd") % 2).alias("odd")).where("odd = 1").select("file").limit(1).collect()
    if unclosed:
        raise ValueError(f"a quote is never closed in {unclosed[0]['file']}")
    told = marked.withColumn("before", before).join(carried, ["file", "split"])
    inside = (F.col("open") + F.col("before")) % 2
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = told.withColumn("inside", inside).withColumn(
        "number", F.col("records") + F.sum(F.lit(1) - F.col("inside")).over(upto))
    whole = (F.col("inside") == 0) & (F.col("odd") == 0)
    one = told.where(whole).select("file", F.lit(0).cast("bigint").alias("split"), F.col("number").alias("row"), "record")
    many = told.where(~whole).groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("split", "row", "record"))).alias("parts"))
    return one.unionByName(many.select("file", F.lit(0).cast("bigint").alias("split"), F.col("number").alias("row"),
                                       F.array_join(F.col("parts.record"), "\n").alias("record")))


def survey(rows: DataFrame, charsets: list[str], sep: str | None = None) -> DataFrame:
    """(file, charset, sep, header) of every file from one scan of ``rows``.

    charset: the first that decodes all records (NULL: none). sep: the
    candidate that stands outside quotes as often in the records as in the
    header, in the largest share of them; NULL where the best two agree equally
    or the best has too little of them (``AGREEMENT``, ``ALONE``); a file without any is one column.
    header: the first record, raw."""
    cands = SEPARATORS if sep is None else (sep,)
    record = F.col("record")
    plain = F.when(F.contains(record, F.lit('"')), F.regexp_replace(record, '"[^"]*"', "")).otherwise(record)
    valid = F.call_function("is_valid_utf8", record)
    # Plain ASCII reads the same in these encodings and need not be decoded.
    ascii = F.lit(set(charsets) <= ASCII_BASED) & valid & (F.octet_length(record) == F.char_length(record))
    good = {c: valid if c == "UTF-8" else ascii | ~F.decode(record.cast("binary"), c).contains(UNREADABLE) for c in charsets}
    full = rows.where(F.trim(F.col("record")) != "")
    told = full.select("file", F.struct("split", "row", "record").alias("place"),
                       F.array(*[_count(plain, c) for c in cands]).alias("counts"),
                       *[(~g).cast("int").alias(f"bad{i}") for i, g in enumerate(good.values())])
    bad = [f"bad{i}" for i in range(len(good))]
    # Distinct counts are few; their first places make the header's the least.
    hist = told.groupBy("file", "counts").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"),
                                              *[F.max(b).alias(b) for b in bad])
    out = scratch_path(rows.sparkSession, "csv_survey")   # written, as the steps below read it three times
    hist.write.parquet(out)
    hist = rows.sparkSession.read.schema(hist.schema).parquet(out)
    head = hist.groupBy("file").agg(F.min(F.struct("first", "counts")).alias("head"), F.sum("n").alias("total"),
                                    *[F.max(b).alias(b) for b in bad])
    agree = hist.join(head.select("file", "head"), "file").groupBy("file").agg(
        *[F.sum(F.when(F.col("counts")[i] == F.col("head.counts")[i], F.col("n"))).alias(f"agree{i}") for i in range(len(cands))])
    per = head.join(agree, "file")
    scores = F.array_sort(F.filter(F.array(*[
        F.struct((-F.col(f"agree{i}") / F.col("total")).alias("share"), F.lit(c).alias("sep"), F.col("head.counts")[i].alias("n"))
        for i, c in enumerate(cands)]), lambda x: x["n"] > 0))
    best, second = F.get(scores, F.lit(0)), F.get(scores, F.lit(1))
    clear = F.when(second.isNull(), -best["share"] >= ALONE).otherwise(
        (-best["share"] >= AGREEMENT) & (second["share"] > best["share"]))
    found = F.lit(sep) if sep is not None else F.when(F.size(scores) == 0, F.lit(",")).when(clear, best["sep"])
    charset = F.coalesce(*[F.when(F.col(b) == 0, F.lit(c)) for b, c in zip(bad, good)])
    return per.select("file", charset.alias("charset"), found.alias("sep"), F.col("head.first.record").alias("header"))


def groups(told: DataFrame) -> list:
    """Files that look alike: (charset, sep, header, files), in the order of their first files. File names and one
    header a group reach the driver."""
    alike = told.groupBy("charset", "sep", "header").agg(F.array_sort(F.collect_list("file")).alias("files"))
    return sorted(alike.collect(), key=lambda r: r["files"][0])
