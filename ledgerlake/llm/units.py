"""Lines (or paragraphs) of documents: cutting, hashing, and taking some out again.

SQL functions only. A document is known by its id and a hash of its whole row;
rows equal in all columns count as one document and share its fate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ascii_lower, replace_columns, row_hash, small, stage

DOC = ["_doc", "_tie"]
LINE = ["_h1", "_h2"]


def blanks(c: Column) -> Column:
    """Tab, vertical tab, form feed and return as blanks; most lines have none, and pay for the test only."""
    some = c.contains("\t") | c.contains("\r") | c.contains("\x0b") | c.contains("\x0c")
    return F.when(some, F.translate(c, "\t\x0b\x0c\r", "    ")).otherwise(c)


def worded(docs: DataFrame, text: str, doc_id: str, separator: str) -> DataFrame:
    """One row per unit: document, position, length in characters, and its words (A-Z lower-cased, parted at white space)."""
    whole = docs.select(F.col(doc_id).alias("_doc"), row_hash(docs).alias("_tie"), F.col(text).alias("_text"))
    pieces = whole.select(*DOC, F.posexplode(F.split("_text", separator)).alias("_pos", "_unit"))
    words = F.array_remove(F.split(ascii_lower(blanks(F.col("_unit"))), " "), "")
    return pieces.select(*DOC, "_pos", F.char_length("_unit").alias("_len"), words.alias("_words"))


def hashes(min_words: int) -> list[Column]:
    """128 bits of the words, null below ``min_words``."""
    counts = F.size("_words") >= min_words
    return [F.when(counts, F.xxhash64("_words")).alias("_h1"), F.when(counts, F.xxhash64(F.lit(7), F.col("_words"))).alias("_h2")]


def first_places(units: DataFrame) -> DataFrame:
    """Per unit hash: number of places, and the first by id, row hash and position. Added up before the shuffle."""
    return units.where("_h1 is not null").groupBy(*LINE).agg(F.count("*").alias("places"), F.min(F.struct(*DOC, "_pos")).alias("first"))


def texts_at(docs: DataFrame, places: DataFrame, text: str, doc_id: str, separator: str) -> DataFrame:
    """``places`` (staged: _doc, _tie, _pos and more) with the normalised unit there (``_norm``)."""
    pieces = docs.select(F.col(doc_id).alias("_doc"), row_hash(docs).alias("_tie"), F.posexplode(F.split(text, separator)).alias("_pos", "_unit"))
    p = places.withColumnsRenamed({"_doc": "_d", "_tie": "_t", "_pos": "_p"})
    found = pieces.join(small(p), (F.col("_tie") == F.col("_t")) & (F.col("_pos") == F.col("_p")) & F.col("_doc").eqNullSafe(F.col("_d")))
    words = F.array_remove(F.split(ascii_lower(blanks(F.col("_unit"))), " "), "")
    return found.dropDuplicates([*DOC, "_pos"]).withColumn("_norm", F.array_join(words, " ")).drop(*DOC, "_pos", "_d", "_t", "_p", "_unit")


def take_out(docs: DataFrame, units: DataFrame, kept: DataFrame, text: str, doc_id: str, separator: str) -> DataFrame:
    """``docs`` without the units that are not the kept place of their class.

    ``kept``: (_h1, _h2, first) of the classes with several places. Adds
    n_removed, removed ("start-end" character offsets in the original text,
    comma-joined), dup_of (smallest id that holds a kept place).
    """
    kept = stage(kept, "units-kept")
    in_doc = Window.partitionBy(*DOC).orderBy("_pos")
    started = units.select(*DOC, "_pos", "_len", *LINE).repartition(*DOC).dropDuplicates([*DOC, "_pos"]).withColumn(
        "_start", (F.sum(F.col("_len") + len(separator)).over(in_doc) - F.col("_len") - len(separator)).cast("long"))
    gone = started.join(small(kept), LINE).where(~F.coalesce(F.struct(*DOC, "_pos").eqNullSafe(F.col("first")), F.lit(False)))
    span = F.struct("_pos", F.concat_ws("-", F.col("_start"), F.col("_start") + F.col("_len")).alias("span"), F.col("first._doc").alias("of"))
    per_doc = gone.groupBy(*DOC).agg(F.sort_array(F.collect_list(span)).alias("_cuts")).withColumnsRenamed({"_doc": "_d", "_tie": "_t"})
    keyed = replace_columns(docs.withColumns({"_tie": row_hash(docs), "_doc": F.col(doc_id)}), ["n_removed", "removed", "dup_of"])
    joined = keyed.join(per_doc, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_tie") == F.col("_t")), "left")
    lines, at = F.split(F.col(text), separator), F.col("_cuts._pos")
    pieces = F.transform(F.sequence(F.lit(0), F.size(at)), lambda k: F.slice(
        lines, F.when(k == 0, 1).otherwise(F.get(at, k - 1) + 2),
        F.coalesce(F.get(at, k), F.size(lines)) - F.when(k == 0, 0).otherwise(F.get(at, k - 1) + 1)))
    none = F.col("_cuts").isNull()
    return (joined.withColumns({
        "n_removed": F.when(none, 0).otherwise(F.size("_cuts")).cast("long"), "removed": F.when(none, "").otherwise(F.array_join(F.col("_cuts.span"), ",")),
        "dup_of": F.array_min("_cuts.of"), text: F.when(none, F.col(text)).otherwise(F.array_join(F.flatten(pieces), separator))})
        .drop(*DOC, "_d", "_t", "_cuts"))
