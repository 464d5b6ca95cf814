"""Substring dedup: hash normalised pieces, group the hashes, keep earliest places, take out repeated runs.

A text is cut after every line end, full stop and question mark. A passage that another
document has too is then a run of pieces that all occur earlier, one behind
the other; single pieces repeat by chance and stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import ascii_lower, replace_columns, row_hash, shielded, stage
from ledgerlake.llm.units import DOC, LINE, blanks, hashes

#: Words that a run must have together to be taken out.
MIN_WORDS = 30
#: A piece whose words are longer than this on average is in a script without blanks: LETTERS characters count as a word.
LONG_WORD, LETTERS = 16, 5
#: Text up to the next line end, full stop or question mark, which are part of the piece.
PIECE = r"[^.?\u3002\n]*[.?\u3002\n]+|[^.?\u3002\n]+"
WHITE = " \t\n\x0b\x0c\r"


def pieces_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PIECE), F.lit(0))


def has_words(piece: Column) -> Column:
    return F.translate(piece, WHITE, "") != ""


def cut(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """One row per piece with words: document, place among its pieces, 128-bit hash, words."""
    whole = docs.select(F.col(doc_id).alias("_doc"), row_hash(docs).alias("_tie"), F.filter(pieces_of(F.col(text)), has_words).alias("_pieces"))
    pieces = whole.select(*DOC, F.posexplode("_pieces").alias("_rank", "_piece"))
    words = F.array_remove(F.split(ascii_lower(blanks(F.translate("_piece", "\n", " "))), " "), "")
    pieces = pieces.select(*DOC, "_rank", words.alias("_words"))
    n, letters = F.size("_words"), F.char_length(F.array_join("_words", " "))
    return pieces.select(*DOC, "_rank", *hashes(1), F.when(letters > LONG_WORD * n, F.floor(letters / LETTERS)).otherwise(n).cast("int").alias("_n"))


def repeated_runs(pieces: DataFrame, min_words: int) -> DataFrame:
    """Per document the runs to take out: (from, to: places, of: id of the earlier document), in order.

    A run is pieces one behind the other whose earliest places (by id, null
    first, then row hash, then position) are elsewhere and one behind the
    other too, in one document, with ``min_words`` words together. A piece
    whose earliest place is in a third document, or earlier in the same
    passage, ends a run: such a passage goes in parts, or stays.
    """
    place = F.struct(*DOC, "_rank")
    first = pieces.groupBy(*LINE).agg(F.count("*").alias("_places"), F.min(place).alias("_first")).where("_places > 1").drop("_places")
    first = stage(first, "substring-first")  # so that the join below reads two plain shuffles, which Spark splits where a piece is very frequent
    again = pieces.join(first, LINE).where(~place.eqNullSafe(F.col("_first")))
    # Rows equal in all columns are one document: reduced to one before a document's pieces come together.
    again = again.groupBy(*DOC, "_rank").agg(F.max("_n").alias("_n"), F.min("_first").alias("_first"))
    in_doc = Window.partitionBy(*DOC).orderBy("_rank")

    def before(c: str) -> Column:
        return F.lag(c).over(in_doc)

    goes_on = ((before("_rank") == F.col("_rank") - 1) & (before("_first._rank") == F.col("_first._rank") - 1)
               & before("_first._doc").eqNullSafe(F.col("_first._doc")) & (before("_first._tie") == F.col("_first._tie")))
    again = again.withColumn("_new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1))
    again = again.withColumn("_run", F.sum("_new").over(in_doc))
    runs = again.groupBy(*DOC, "_run").agg(F.sum("_n").alias("_words"), F.min("_rank").alias("from"), F.max("_rank").alias("to"), F.min("_first._doc").alias("of"))
    return runs.where(F.col("_words") >= min_words).groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("from", "to", "of"))).alias("_runs"))


def dedup_substrings(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with every passage left in its earliest place only.

    Passages: runs of at least ``min_words`` words (see :func:`repeated_runs`)
    of normalised pieces (A-Z lower-cased, white space as one blank); in a
    script without blanks five characters count as a word. The text becomes
    what remains of it; added are n_removed (pieces taken out), removed
    (original character offsets, "start-end", comma-joined) and dup_of (the
    smallest id that holds an earlier place).

    A null text stays null and has no pieces, an empty or blank one has none.
    Rows equal in all columns count as one document and share its fate. Very
    long texts are cut like others; one document's pieces pass through one
    task. An empty table gives no rows. Input columns named like the added
    ones are replaced.
    """
    docs, back = shielded(docs)
    runs = stage(repeated_runs(stage(cut(docs, text, doc_id), "substring-pieces"), min_words), "substring-runs").withColumnsRenamed({"_doc": "_d", "_tie": "_t"})
    keyed = replace_columns(docs.withColumns({"_tie": row_hash(docs), "_doc": F.col(doc_id)}), ["n_removed", "removed", "dup_of"])
    joined = keyed.join(runs, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_tie") == F.col("_t")), "left")
    none = F.col("_runs").isNull()
    joined = joined.withColumn("_pieces", F.when(~none, pieces_of(F.col(text))))
    # Piece numbers of the places, blank pieces counted; a blank piece inside a run goes with it.
    number = F.filter(F.sequence(F.lit(0), F.size("_pieces") - 1), lambda i: has_words(F.get(F.col("_pieces"), i)))
    joined = joined.withColumn("_number", F.when(~none, number))
    joined = joined.withColumn("_cuts", F.transform("_runs", lambda r: F.struct(F.get(F.col("_number"), r["from"]).alias("a"), (F.get(F.col("_number"), r["to"]) + 1).alias("z"))))

    def length(begin: Column, end: Column) -> Column:
        return F.char_length(F.array_join(F.slice("_pieces", begin + 1, end - begin), ""))

    def before_cut(k: Column) -> Column:
        """Pieces behind the cut before the k-th, up to the k-th."""
        begin = F.when(k == 0, 0).otherwise(F.get(F.col("_cuts.z"), k - 1))
        return F.slice("_pieces", begin + 1, F.coalesce(F.get(F.col("_cuts.a"), k), F.size("_pieces")) - begin)

    left = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size("_cuts")), before_cut)), "")
    spans = F.transform("_cuts", lambda c: F.concat_ws("-", length(F.lit(0), c["a"]), length(F.lit(0), c["z"])))
    gone = F.aggregate("_runs", F.lit(0).cast("long"), lambda n, r: n + r["to"] - r["from"] + 1)
    return (joined.withColumns({
        "n_removed": F.when(none, F.lit(0)).otherwise(gone).cast("long"), "removed": F.when(none, "").otherwise(F.array_join(spans, ",")),
        "dup_of": F.array_min("_runs.of"), text: F.when(none, F.col(text)).otherwise(left)})
        .drop(*DOC, "_d", "_t", "_runs", "_pieces", "_number", "_cuts").withColumnsRenamed(back))
