"""Deletes runs of lines that stand earlier already, in DataFrame operations only.

A run is long enough if it has RUN lines, or fewer that have more than LONG words
together. Every line is hashed; of each window of RUN lines, and of each shorter
one of more than LONG words, the smallest hash is a fingerprint, so two equal runs
that are long enough always share one. Lines
whose fingerprint occurs in one place only are left alone. Around each shared
fingerprint the match is extended to both sides: every window that chose it is
compared by the hashes of all its lines with the earliest window that has the
same lines. A window that stands later is deleted; neighbouring deleted windows
make up the longest repeated run.

Earlier means: smaller id, or earlier in the same text. Blank lines are no
lines: they are kept and looked through. Words are what white space parts.
Hashes have 128 bits.

Defined results: a null text stays null, an empty one empty; texts without a run
that is long enough stay as they are; with long=None only lines count; a null id comes before all others; rows that
repeat id and text are one place and are treated alike; an empty table gives an
empty one; all other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.tables import BUILD_SIDE, stored

RUN = 3
# A passage of more words counts however few lines it has.
LONG = 50
_PLACE = ("__id", "__hash")


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn("__id", F.col("doc_id")).withColumn("__hash", F.xxhash64(text))


def _windows(docs: DataFrame, text: str, long: int | None) -> DataFrame:
    """One row for each window: fingerprint, a, b (hash of its lines), at (its
    number) and lines (their places in the text)."""
    lines = docs.select(*_PLACE, F.split(text, "\n", -1).alias("lines"))
    plain = F.transform("lines", lambda line, i: F.struct(
        i.alias("i"), F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"),
        F.trim(F.regexp_replace(line, r"\s+", " ")).alias("plain")))
    full = F.filter(plain, lambda x: x["plain"] != "")
    if long is None:
        several = lines.select(*_PLACE, full.alias("lines")).filter(F.size("lines") >= RUN)
    else:
        words = lambda x: F.length(x["plain"]) - F.length(F.translate(x["plain"], " ", "")) + 1
        several = lines.select(*_PLACE, F.transform(full, lambda x: F.struct(x["i"], x["a"], x["b"], words(x).alias("words"))).alias("lines"))

    def window(at: Column, length: int) -> Column:
        own = [F.get("lines", at + j) for j in range(length)]
        least = F.least(*(x["a"] for x in own)) if length > 1 else own[0]["a"]
        return F.struct(
            # Windows of other lengths have fingerprints of their own.
            (least if length == RUN else F.xxhash64(least, F.lit(length))).alias("fingerprint"),
            F.xxhash64(*(x["a"] for x in own)).alias("a"), F.xxhash64(*(x["b"] for x in own)).alias("b"),
            at.alias("at"), F.array(*(x["i"] for x in own)).alias("lines"))

    def windows(length: int) -> Column:
        places = F.when(F.size("lines") >= length, F.sequence(F.lit(0), F.size("lines") - length)).otherwise(F.array().cast("array<int>"))
        if length < RUN:
            places = F.filter(places, lambda at: sum((F.get("lines", at + j)["words"] for j in range(1, length)), F.get("lines", at)["words"]) > long)
        return F.transform(places, lambda at: window(at, length))

    lengths = range(1 if long is not None else RUN, RUN + 1)
    return several.select(*_PLACE, F.inline(F.concat(*(windows(n) for n in lengths))))


def repeated_lines(docs: DataFrame, text: str = "text", long: int | None = LONG) -> DataFrame:
    """__id, __hash of a text and the numbers of its lines to delete."""
    windows = _windows(_keyed(docs, text), text, long)
    # Windows that chose one line count once for it, so a fingerprint is shared
    # if two different windows' texts or places have it.
    shared = windows.groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1").select("fingerprint")
    near = stored(windows.join(stored(shared, "shared-fingerprints"), "fingerprint", "left_semi"), "extended-windows")
    place = F.struct(*_PLACE, "at")
    first = near.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").select("a", "b", "first")
    later = near.join(stored(first, "first-windows"), ["a", "b"]).filter(place > F.col("first"))
    return later.select(*_PLACE, F.explode("lines").alias("line")).groupBy(*_PLACE).agg(F.collect_set("line").alias("__gone"))


def delete_repeated_lines(docs: DataFrame, text: str = "text", long: int | None = LONG) -> DataFrame:
    """The documents with their text shortened; all columns are kept."""
    gone = stored(repeated_lines(docs, text, long), "repeated-lines").withColumnsRenamed({p: f"{p}_gone" for p in _PLACE})
    both = _keyed(docs, text).join(gone.hint(BUILD_SIDE), F.col("__id").eqNullSafe(F.col("__id_gone")) & F.col("__hash").eqNullSafe(F.col("__hash_gone")), "left")
    lines = F.split(text, "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__gone")
    short = F.array_join(F.transform(left, lambda i: F.get("__lines", i)), "\n")
    cut = both.withColumn("__lines", F.when(F.col("__gone").isNotNull(), lines))
    return cut.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(short)).select(*docs.columns)
