"""Spelling variants: words one edit apart, found by pivotal grams.

1. Words are counted over all texts (``word_counts``); those with at least
   ``MIN_COUNT`` occurrences are the vocabulary.
2. A word's bigrams are ordered by how many words hold them, rarest first.  Its
   prefix is the first three of them (with further places of the third one).
   Dynamic programming chooses the two disjoint bigrams of the prefix that are
   rarest together: the pivots.  One edit leaves a pivot of either word as it
   is; of two near words, the pivots of the one whose prefix ends earlier in the
   order meet the prefix of the other.
3. Pivots are joined with the prefixes of other words on place, length and the
   word's part up to the gram, or from it on.  An edit right of the gram leaves
   the left part and the place as they are, one left of it the right part, and it
   shifts the place by the difference in length.  The edit distance is verified
   inside the join, so no candidate leaves it.  A word of more than ``LONG``
   letters is met by gram and length alone, and has one row per distinct gram, as
   it may hold a gram very often; all of two such words that follows their first
   difference is compared at once.
4. A word's form is its most frequent near word, if that is at least ``RATIO``
   times as frequent; roots follow forms by doubling (a form's count grows
   by ``RATIO`` a step, so chains are short).

Gram counts are the only table sent to the driver: at most one per pair of the
90 letters that words can hold.  Tables with a row per word or gram are merged, never
broadcast: Spark takes them for as small as their compressed files, though each of
their rows becomes several.

Defined cases: null and empty texts have no words; a null ``doc_id`` counts as an
empty one in the checksum; rows with the same ``doc_id`` count each; of equally
frequent near words the first in code-point order is the form; an empty table
gives an empty result; only ``doc_id`` and ``text`` are read, so other columns
cannot clash.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import CRC_CTES, by_batch, crc_sql, discard, stored

# --- fixed values of the contract ---------------------------------------------
MIN_LENGTH = 6
MIN_COUNT = 5
SLIP_EVERY = 199
RATIO = 5

Q, EDITS = 2, 1
PREFIX = Q * EDITS + 1
LONG = 64                                                  # beyond, grams of a word are not told apart by place
_HELD_WORDS = 200_000                                      # words that a task counts before it hands them on
#: (side of a gram that one edit leaves as it is, shift of the gram, difference in length).
_MOVES = (("left", 0, 0), ("right", 0, 0), ("left", 0, 1), ("left", 0, -1), ("right", 1, 1), ("right", -1, -1))
#: Maximal runs of at least MIN_LENGTH letters: a shorter one gives no word.
_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}")


def _lower(text: str) -> str:
    """A-Z lower-cased, all else kept."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def words_of(doc_id: int | None, text: str | None) -> dict[str, int]:
    """Occurrences of each word of a text, after the slips that its id and the run decide."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: dict[str, int] = {}
    for run, n in Counter(_RUN.findall(_lower(text or ""))).items():
        h = zlib.crc32(run.encode(), start)
        if h % SLIP_EVERY == 0:
            cut = h % len(run)
            run = run[:cut] + run[cut + 1:]
            if len(run) < MIN_LENGTH:
                continue
        out[run] = out.get(run, 0) + n
    return out


def word_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``min_count`` occurrences in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])
        for b in batches:
            for i, t in zip(b.column(0), b.column(1)):
                for w, n in words_of(i.as_py(), t.as_py()).items():
                    held[w] = held.get(w, 0) + n
                if len(held) >= _HELD_WORDS:
                    yield rows()
                    held = {}
        yield rows()
    parts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _gram_counts(words: DataFrame) -> dict[str, int]:
    """{bigram: words that hold it}; at most one per pair of letters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for b in batches:
            for w in b.column(0).to_pylist():
                held.update({w[i:i + Q] for i in range(len(w) - Q + 1)})
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                         names=["gram", "n"])
    rows = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    return {r["gram"]: r["n"] for r in rows}


def pivots(prefix: list[tuple[int, int]], k: int = EDITS + 1) -> list[int]:
    """Places of the ``k`` disjoint grams of least total weight among (place, weight), by dynamic programming.

    ``best[j][i]`` is the least weight of j disjoint grams among the first i by place.
    """
    p = sorted(prefix)
    places = [i for i, _ in p]
    before = [bisect_right(places, i - Q) for i in places]
    none = (float("inf"), ())
    best = [(0, ())] * (len(p) + 1)
    for _ in range(k):
        row = [none]
        for i, (place, weight) in enumerate(p):
            total, chosen = best[before[i]]
            row.append(min(row[-1], (total + weight, (*chosen, place))))
        best = row
    return list(best[-1][1])


def signature(word: str, counts: dict[str, int]) -> tuple[list[int], list[int]]:
    """(places of the prefix, places of the pivots) of a word's bigrams."""
    order = sorted((counts[word[i:i + Q]], word[i:i + Q], i) for i in range(len(word) - Q + 1))
    last = order[min(PREFIX, len(order)) - 1][:2]
    prefix = [(i, n) for n, g, i in order if (n, g) <= last]
    return [i for i, _ in prefix], pivots(prefix)


def _one_edit(x: Column, y: Column) -> Column:
    """Whether two different words are one edit apart; ``levenshtein`` would take the square of a long word's length."""
    least = F.least(F.length(x), F.length(y))
    same = F.aggregate(F.array(*[F.lit(1 << k) for k in reversed(range(31))]), F.lit(0), lambda at, more: F.when(
        (at + more <= least) & (x.substr(at + 1, more) == y.substr(at + 1, more)), at + more).otherwise(at))
    rest = [F.substring(w, same + 1 + (F.length(w) - least) + (F.length(x) == F.length(y)).cast("int"), F.length(w)) for w in (x, y)]
    return rest[0] == rest[1]


def near_words(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n) of all pairs a < b of ``words`` (word, n) that differ by one edit."""
    counts = _gram_counts(words)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            prefix, pivot = signature(w, counts)
            if len(w) > LONG:
                prefix = sorted({*pivot, *{w[i:i + Q]: i for i in prefix}.values()})
            out += [(w[i:i + Q], i, len(w), w, n, i in pivot) for i in prefix]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                          names=["gram", "place", "length", "word", "n", "pivot"])
    rows = stored(words.select("word", "n").mapInArrow(
        by_batch(run), "gram string, place int, length int, word string, n long, pivot boolean"), "grams")
    gram = F.struct(F.lit("gram").alias("side"), F.xxhash64("gram").alias("half"))
    side = {"left": F.expr("substring(word, 1, place + 2)"), "right": F.expr("substring(word, place + 1)")}
    half = {k: F.struct(F.lit(k).alias("side"), F.xxhash64(v).alias("half")) for k, v in side.items()}
    moves = F.inline(F.array(*[F.struct(half[k].alias("part"), F.lit(d).alias("shift"), F.lit(e).alias("more")) for k, d, e in _MOVES]))
    left = rows.filter("pivot").select("*", gram.alias("gram_only"), moves)
    far = F.col("length") + F.col("more") > LONG
    left = left.filter(~far | (F.col("part.side") == "left"))               # one of each difference in length
    part = F.when(far, F.col("gram_only")).otherwise(F.col("part"))
    left = left.select(part["side"].alias("side"), part["half"].alias("half"), (F.col("length") + F.col("more")).alias("length"),
                       F.when(far, F.lit(-1)).otherwise(F.col("place") + F.col("shift")).alias("place"),
                       F.col("word").alias("x"), F.col("n").alias("x_n"))
    long = F.col("length") > LONG
    right = rows.select("*", F.explode(F.when(long, F.array(gram)).otherwise(F.array(*half.values()))).alias("part")).select(
        F.col("part.side").alias("s"), F.col("part.half").alias("h"), F.col("length").alias("l"),
        F.when(long, F.lit(-1)).otherwise(F.col("place")).alias("p"), F.col("word").alias("y"), F.col("n").alias("y_n"))
    near = F.when(F.col("l") > LONG, _one_edit(F.col("x"), F.col("y"))).otherwise(F.levenshtein("x", "y", EDITS) == EDITS)
    met = left.join(right.hint("merge"), (F.col("side") == F.col("s")) & (F.col("half") == F.col("h")) & (F.col("place") == F.col("p"))
                    & (F.col("length") == F.col("l")) & (F.col("x") != F.col("y")) & near)
    low = F.col("x") < F.col("y")
    return met.select(F.when(low, F.col("x")).otherwise(F.col("y")).alias("a"),
                      F.when(low, F.col("x_n")).otherwise(F.col("y_n")).alias("a_n"),
                      F.when(low, F.col("y")).otherwise(F.col("x")).alias("b"),
                      F.when(low, F.col("y_n")).otherwise(F.col("x_n")).alias("b_n")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of (word, form), by doubling."""
    cur = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = cur.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = stored(cur.join(step.hint("merge"), "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        moved = not new.filter("moved").isEmpty()
        discard(cur)
        cur = new
        if not moved:
            return cur.select("word", "root")


def groups(docs: DataFrame, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the vocabulary."""
    words = stored(word_counts(docs, min_count), "words")
    pairs = stored(near_words(words), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    out = stored(words.join(best.hint("merge"), "word", "left").select(
        "word", F.when(enough, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, -F.col("best.less")).alias("form_n")), "forms")
    roots = _roots(out.filter("form is not null"))
    discard(words, pairs)
    return out.join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL = f"""WITH RECURSIVE {CRC_CTES},
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
per AS (SELECT d, run, count(*) AS n FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY d, run),
hashed AS (SELECT run, n, {crc_sql("d || ':' || run")} AS h FROM per, crc_table),
slipped AS (SELECT CASE WHEN h % {SLIP_EVERY} = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
                        ELSE run END AS word, n FROM hashed),
voc AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
shorter AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM voc)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word != b.word
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN voc b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM shorter a JOIN voc b ON a.rest = b.word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k, count(*) OVER (PARTITION BY word) AS n_near FROM pairs),
formed AS (SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= {RATIO} * v.n THEN r.near END AS form,
                  CASE WHEN r.near_n >= {RATIO} * v.n THEN r.near_n END AS form_n FROM voc v LEFT JOIN ranked r ON r.word = v.word AND r.k = 1),
follow(word, here) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT f.word, g.form FROM follow f JOIN formed g ON f.here = g.word WHERE g.form IS NOT NULL)
SELECT f.word, f.form, r.here AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM formed f JOIN follow r ON r.word = f.word JOIN formed e ON e.word = r.here AND e.form IS NULL"""
