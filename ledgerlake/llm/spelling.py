"""Spelling variants: words one edit from a far more frequent word, found over a reduced alphabet.

Letters are hashed to a few symbols. Two words within one edit have reduced
words within one edit, so the full one-edit neighbourhood of each reduced word,
joined with the reduced vocabulary, meets every such pair; the pairs met are
verified on the words themselves. The number of symbols follows from the size
of the vocabulary and the shortest length, so that the reduced words stay about
as spread as the vocabulary grows.

Neighbourhoods are 64-bit polynomial hashes, each made in one step from the
hashes of a prefix and a suffix. So a word of a million letters has as many
keys as it has edits, not a million words of a million letters. A hash that two
reduced words share costs a verification and changes no result.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import UPPER, share, stage

LEAST_LETTERS = 7
#: Maximal runs of letters, after lower-casing. A deletion takes one letter at most, so shorter runs cannot count.
RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LETTERS)
LOWER = bytes.maketrans(UPPER.encode(), UPPER.lower().encode())
LEAST_COUNT = 2
#: A form must be at least so many times as frequent.
RATIO = 10
#: An occurrence whose hash is a multiple of this loses a letter.
SLIP = 31
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Numbers that a batch of neighbourhoods holds at once, about.
CELLS = 1 << 20
#: Distinct words that a task counts before it sends its counts on.
HELD = 200_000


def spelt(doc_id: str | None, run: str) -> str:
    """The lower-cased run as it counts: some occurrences, by a hash of id and run, lose one letter."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode("utf-8", "surrogatepass"))
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(word, n): words of at least 7 letters and 2 occurrences. Tasks add up before the shuffle, so a frequent word is no hot key."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for key, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if body is None:
                    continue
                for run, n in Counter(RUN.findall(body.translate(LOWER).decode("utf-8", "replace"))).items():
                    if len(word := spelt(key, run)) >= LEAST_LETTERS:
                        seen[word] += n
                if len(seen) > HELD:
                    yield counted()
                    seen.clear()
        yield counted()

    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def alphabet(words: DataFrame) -> tuple[dict[int, int], int]:
    """Symbol of each code point, and the number of symbols.

    As many symbols as give words one letter longer than the shortest about as
    many reduced words as the vocabulary has. Letters are dealt to symbols by falling frequency, to and fro,
    so that no symbol has most of the letters; at most 90 letters reach the driver.
    """
    size = words.count()
    k = min(64, max(4, math.ceil(max(size, 1) ** (1 / (LEAST_LETTERS + 1)))))
    # Counted by position in the word's distinct letters: one row a letter of the alphabet.
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").groupBy("c").count().collect()
    ranked = [ord(r["c"]) for r in sorted(letters, key=lambda r: (-r["count"], r["c"]))]
    return {c: i % k if i // k % 2 == 0 else k - 1 - i % k for i, c in enumerate(ranked)}, k


def powers(n: int) -> np.ndarray:
    out = np.full(n, BASE, "uint64")
    out[:1] = 1
    return np.multiply.accumulate(out)


def own_keys(symbols: np.ndarray) -> np.ndarray:
    """Hash of each row of ``symbols`` (words x letters, symbols from 1)."""
    return (symbols * powers(symbols.shape[1])).sum(axis=1, dtype="uint64")


def neighbour_keys(symbols: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words themselves, their deletions and their replacements (a row a word), and which of them to send.

    With both words of a pair sending, an insertion is the other word's
    deletion and a replacement by a lower symbol the other's by a higher one,
    so the whole neighbourhood is met by half of it. Of a run of equal symbols
    only the first is deleted, as the others give the same word.
    """
    m, n = symbols.shape
    p = powers(n)
    before = np.zeros((m, n + 1), "uint64")  # hash of the first i letters
    np.cumsum(symbols * p, axis=1, dtype="uint64", out=before[:, 1:])
    whole = before[:, -1:]
    # The letters behind a deletion move one place to the left: divided by BASE, which is odd and has an inverse.
    deleted = before[:, :n] + (whole - before[:, 1:]) * np.uint64(pow(int(BASE), -1, 1 << 64))
    c = np.arange(1, k + 1, dtype="uint64")
    replaced = (whole[..., None] + p[:, None] * (c - symbols[..., None])).reshape(m, -1)
    first = np.ones((m, n), bool)
    first[:, 1:] = symbols[:, 1:] != symbols[:, :-1]
    higher = (c > symbols[..., None]).reshape(m, -1)
    return np.concatenate([whole, deleted, replaced], axis=1), np.concatenate([np.ones((m, 1), bool), first, higher], axis=1)


def by_length(words: list[str], symbol: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in ``words``, their symbols) for the words of each length."""
    lengths = np.array([len(w) for w in words])
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        points = np.frombuffer("".join(words[i] for i in at).encode("utf-32-le"), "uint32").reshape(len(at), n)
        yield at, symbol[points]


def reduced(words: DataFrame, symbols: dict[int, int], k: int, *, near: bool) -> DataFrame:
    """(word, n, key, own): the hash of each reduced word (``own``); with ``near`` those of its neighbourhood too."""
    symbol = np.zeros(256, "uint64")  # letters end at U+00FF
    for c, s in symbols.items():
        symbol[c] = s + 1
    shared = share(words.sparkSession, symbol)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for at, rows in by_length(batch.column(0).to_pylist(), shared()):
                step = max(1, CELLS // ((rows.shape[1] + 1) * (k + 2))) if near else len(at)
                for i in range(0, len(at), step):
                    part, of = rows[i:i + step], at[i:i + step]
                    if near:
                        found, sent = neighbour_keys(part, k)
                        first = np.zeros(sent.shape, bool)
                        first[:, 0] = True
                        of, found, first = np.repeat(of, sent.sum(axis=1)), found[sent], first[sent]
                    else:
                        found, first = own_keys(part), np.ones(len(of), bool)
                    places = pa.array(of)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(places), batch.column(1).take(places), pa.array(found.view("int64")), pa.array(first)],
                                                     names=["word", "n", "key", "own"])

    return words.select("word", "n").mapInArrow(keys, "word string, n long, key long, own boolean")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n): all pairs that differ by exactly one edit, in both directions.

    ``words``: a written vocabulary (word, n).
    """
    symbols, k = alphabet(words)
    probes = reduced(words, symbols, k, near=True)
    held = reduced(words, symbols, k, near=False).select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    # Words of one reduced word meet from both sides: once is enough.
    met = probes.join(held, "key").where((~F.col("own") | (F.col("word") < F.col("near"))) & (F.abs(F.char_length("word") - F.char_length("near")) <= 1))
    pairs = met.where(F.levenshtein("word", "near", 1) == 1)
    both = F.array(F.struct("word", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return pairs.select(F.inline(both))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's chain of forms. ``forms``: (word, form), written, one row a word.

    Chains cannot turn back, since each step is to a word ten times as
    frequent; every round doubles the steps taken, so a handful end it.
    """
    reached = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = stage(reached.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        reached = further.select("word", "root")
        if not further.where("moved").head(1):
            return reached


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for each word of the vocabulary: word, n, n_near, form, form_n, root.

    ``form``: the most frequent word one edit away (of ties the smallest in
    code-point order) if it is ten times as frequent, else null; ``root``: the
    end of the chain of forms, the word itself without one. Null texts have no
    words; a null id counts as the empty text in the hash; repeated rows count
    each time; very long runs are compared whole. An empty table gives no rows.
    Other columns of ``docs`` are not read, so their names cannot clash.
    """
    words = stage(vocabulary(docs, text, doc_id), "spelling-words")
    # min of (-n, word): the largest count first, then the smallest word in code-point order.
    best = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("down"), F.col("near"))).alias("best"))
    found = words.join(best, "word", "left")
    holds = -F.col("best.down") >= RATIO * F.col("n")
    found = stage(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(holds, F.col("best.near")).alias("form"),
                               F.when(holds, -F.col("best.down")).alias("form_n")), "spelling-forms")
    ends = roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
