"""Awkward documents that every operator must take: nulls in any column, empty
and very long texts, repeated rows, exact copies, clashing column names."""

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS * 60)                       # 24,000 words
UNSPLIT = "abcde" * 30_000 + "1"                  # one run of letters, with a digit
EXTRA = ("n long, sid string, tokens string, score string, shard string, kept string, ids string, m string, "
         "_e string, _new string, _rid string, rid string, _rk string, place string, replaced string, kept_ string, digest string, "
         "_digest string")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + EXTRA


def rows():
    extra = (1, "x", "y", "z", "s", "k", "i", "m", *"abcdefghij")
    base = " ".join(WORDS[:60])
    texts = [(1, base), (2, base + " tail"), (3, None), (4, ""), (5, "  \n\t "), (6, "one two"), (6, "one two"),
             (7, LONG), (8, base), (None, "lonely words without an id and more of them here"), (9, "ÉCOLE été ßtraße 日本 😀"),
             (10, UNSPLIT), (11, "!!! ... ???")]
    out = [(i, t, "en" if k % 3 else None, f"src{k % 2}" if k % 4 else None, None, *extra) for k, (i, t) in enumerate(texts)]
    return out + [(None, None, None, None, None, *([None] * 18))]


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(row):
    return tuple((v is None, str(v)) for v in row)
