"""Lines that recur across documents, found without moving their text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinfold.llm.common import BLANKS, hot_keys, lower_ascii, partitions, salt

WORD = 64


def _documents(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """A document is known by its id and a hash of its text: repeated rows are one document."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    return docs.select(F.col(id_column).alias("doc_id"), F.xxhash64(F.col(id_column), text).alias("_row"), text.alias("_text"))


def line_bitmaps(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, share: float = 0.5) -> DataFrame:
    """``doc_id, _row, n_dropped, keep``: for each document that loses lines, a bitmap of the lines that stay.

    Bit i of word w of ``keep`` (array of 64-bit words) stands for line 64 * w + i; words that drop nothing at the
    end are left out, and documents that lose nothing have no row. A line's key is the line stripped of ASCII white
    space and with A-Z in lower case; keys of at least ``min_chars`` code points that are found in at least ``min_docs``
    documents lose all their lines, or with ``keep_first`` all but the first (smallest document, then position).

    Lines travel as two 64-bit hashes with document and position, range-partitioned by hash with sampled splitters
    and sorted inside by document and position: a pass over the sorted lines counts documents and sees first lines.
    A key that would fill more than ``share`` of a task is dealt over all tasks by document; the few such keys
    (2 * tasks / share at most) are summed up over their parts before.
    """
    tasks = partitions(docs.sparkSession)
    source = _documents(docs, id_column, text_column)
    lines = source.select("doc_id", "_row", F.posexplode(F.split("_text", "\n")).alias("_at", "_line"))
    # Trim first: lower-casing then sees less.
    lines = lines.select("doc_id", "_row", "_at", F.trim("_line", F.lit(BLANKS)).alias("_key")).filter(F.char_length("_key") >= min_chars)
    key = lower_ascii(F.col("_key"))
    lines = lines.select("doc_id", "_row", "_at", F.xxhash64(key).alias("_h"), F.xxhash64(F.lit(min_chars), key).alias("_g"))
    hot = hot_keys(lines.select("_h"), "_h", F.lit(1), tasks, share)
    keys = ["_h", "_g", *(["_part"] if hot else [])]
    dealt = lines.withColumn("_part", salt(F.col("_h"), hot, F.col("_row"), tasks)).repartitionByRange(*keys)
    same = Window.partitionBy(*keys)
    ordered = same.orderBy(F.asc_nulls_last("doc_id"), "_row", "_at")
    new = F.lag("_row").over(ordered)
    streamed = dealt.select("*", (new.isNull() | (new != F.col("_row"))).cast("int").alias("_new"), (F.row_number().over(ordered) == 1).alias("_first"))
    counted = streamed.withColumn("_docs", F.sum("_new").over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    if hot:
        place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_row", "_at")
        per_doc = lines.filter(F.col("_h").isin(hot)).groupBy("_h", "_g", "doc_id", "_row").agg(F.min(place).alias("_place"))
        over_all = per_doc.groupBy("_h", "_g").agg(F.count(F.lit(1)).alias("_all"), F.min("_place").alias("_least"))
        is_least = F.col("_row").eqNullSafe(F.col("_least._row")) & (F.col("_at") == F.col("_least._at")) & F.col("doc_id").eqNullSafe(F.col("_least.doc_id"))
        counted = counted.join(F.broadcast(over_all), ["_h", "_g"], "left").withColumns(
            {"_docs": F.coalesce("_all", "_docs"), "_first": F.col("_first") & (F.col("_all").isNull() | is_least)}
        )
    dropped = counted.filter((F.col("_docs") >= min_docs) & ~(F.lit(keep_first) & F.col("_first")))
    # Repeated rows give the same bits again; bit_or takes them once.
    words = dropped.groupBy("doc_id", "_row", F.floor(F.col("_at") / WORD).cast("int").alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, _at % 64)")).alias("_bits"))
    maps = words.groupBy("doc_id", "_row").agg(F.sum(F.bit_count("_bits")).cast("bigint").alias("n_dropped"), F.array_sort(F.collect_list(F.struct("_word", "_bits"))).alias("_words"))
    filled = "flatten(transform(_words, (e, i) -> concat(array_repeat(-1L, e._word - if(i = 0, -1, _words[i - 1]._word) - 1), array(~e._bits))))"
    return maps.select("doc_id", "_row", "n_dropped", F.expr(filled).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` of each row: its text without the lines that the bitmaps drop.

    A null or empty text is one empty line and stays empty.
    """
    source = _documents(docs, id_column, text_column).withColumn("_lines", F.split("_text", "\n"))
    marks = bitmaps.select(F.col("doc_id").alias("_doc"), F.col("_row").alias("_mark"), "n_dropped", "keep")
    joined = source.join(marks, (F.col("_row") == F.col("_mark")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    kept = F.expr("filter(_lines, (x, i) -> (shiftright(coalesce(get(keep, i div 64), -1L), i % 64) & 1L) = 1L)")
    text = F.when(F.col("keep").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n"))
    return joined.select("doc_id", F.size("_lines").cast("bigint").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"), text.alias("kept_text"))
