"""Question -> ranked songs, for one question or a whole table of questions.

Single question: the rule intent of the literal is constant-folded by
Catalyst, then one scan computes each song's match count and a
TakeOrderedAndProject keeps the top k.

Many questions: the score of a song for a question depends only on the
song's tag signature (which tags it carries, with multiplicity for repeated
song rows) and on the question's requested-tag multiset.  So the k smallest
song ids of each signature are the only candidates any question can rank;
they are found with ``row_number() <= k`` per signature, which Spark plans
with a partial WindowGroupLimit before the shuffle.  Questions and
candidates then meet through an equi-join on tag.  The cost does not grow
with the number of questions beyond that join, and no group is gathered
whole into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import TAG_ORDER, Thresholds
from ..functions.intent import reply_intent, rule_intent
from ..functions.tags import tag_predicates
from .semantic import AROUSAL, VALENCE, top_k

NO_MATCH_MESSAGE = "(No songs matched the requested tags.)"


def intent_of(question: str) -> Column:
    """Rule intent of a literal question as a (constant-folded) column."""
    return rule_intent(F.lit(question))


def resolve_intent(spark, question: str) -> tuple[list[str], str]:
    """Evaluate the rule intent of one literal question (a one-row job)."""
    it = spark.range(1).select(intent_of(question).alias("i")).first()["i"]
    return list(it["tags"]), it["explanation"]


def answer(predictions: DataFrame, question: str, k: int = 20, id_col: str = "song_id",
           arousal: str = AROUSAL, valence: str = VALENCE, t: Thresholds = Thresholds()) -> DataFrame:
    """(rank, song_id, match_count, explanation) for one question.

    The requested tags are resolved first, so the per-row match count is a
    sum of plain tag predicates that whole-stage codegen compiles.
    """
    requested, explanation = resolve_intent(predictions.sparkSession, question)
    preds = tag_predicates(F.col(arousal), F.col(valence), t)
    n = sum((F.when(preds[tag], 1).otherwise(0) for tag in requested if tag in preds), F.lit(0))
    counts = (predictions.select(F.col(id_col).alias("song_id"), n.alias("_n")).filter(F.col("_n") > 0)
              .groupBy("song_id").agg(F.sum("_n").cast("bigint").alias("match_count")))
    return top_k(counts, k).select("rank", "song_id", "match_count", F.lit(explanation).alias("explanation"))


def question_intents(questions: DataFrame, replies: DataFrame | None = None,
                     id_col: str = "question_id", text_col: str = "text",
                     content_col: str = "content") -> DataFrame:
    """(question_id, tags, explanation): replies when given (validated), else rules."""
    q = questions.select(F.col(id_col).alias("question_id"), F.col(text_col).alias("text"))
    if replies is None:
        it = rule_intent(F.col("text"))
        return q.select("question_id", it.getField("tags").alias("tags"),
                        it.getField("explanation").alias("explanation"))
    r = replies.select(F.col(id_col).alias("question_id"), F.col(content_col).alias("content"))
    j = q.join(r, "question_id", "left")
    it = F.when(F.col("content").isNull(), rule_intent(F.col("text"))).otherwise(
        reply_intent(F.col("content"), F.col("text")))
    return j.select("question_id", it.getField("tags").alias("tags"),
                    it.getField("explanation").alias("explanation"))


def _multiplicity(arr: Column, name: str) -> Column:
    """How often ``name`` occurs in ``arr``."""
    return F.size(F.filter(arr, lambda x: x == F.lit(name)))


def _signature_candidates(predictions: DataFrame, k: int, id_col: str, arousal: str, valence: str,
                          t: Thresholds) -> DataFrame:
    """(song_id, tag, n) rows for the k smallest ids of every tag signature."""
    preds = tag_predicates(F.col(arousal), F.col(valence), t)
    per_song = predictions.groupBy(F.col(id_col).alias("song_id")).agg(
        *[F.count_if(preds[name]).alias(f"n{i}") for i, name in enumerate(TAG_ORDER)])
    sig_cols = [f"n{i}" for i in range(len(TAG_ORDER))]
    matched = per_song.filter(sum((F.col(c) for c in sig_cols), F.lit(0)) > 0)
    w = Window.partitionBy(*sig_cols).orderBy("song_id")
    cands = matched.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    return cands.select("song_id", F.inline(F.array(*[
        F.struct(F.lit(name).alias("tag"), F.col(f"n{i}").alias("n")) for i, name in enumerate(TAG_ORDER)
    ]))).filter(F.col("n") > 0)


def answer_batch(questions: DataFrame, predictions: DataFrame, k: int = 20,
                 replies: DataFrame | None = None, id_col: str = "song_id", arousal: str = AROUSAL,
                 valence: str = VALENCE, t: Thresholds = Thresholds()) -> DataFrame:
    """(question_id, rank, song_id, match_count, explanation, message) for every question.

    Questions with no matching song keep one row with NULL song and rank and
    the no-match message.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    intents = question_intents(questions, replies)
    # requested-tag multiset as 7 multiplicities; identical multisets share work
    mult = [_multiplicity(F.col("tags"), name).alias(f"m{i}") for i, name in enumerate(TAG_ORDER)]
    qm = intents.select("question_id", "explanation", *mult)
    mcols = [f"m{i}" for i in range(len(TAG_ORDER))]
    distinct_req = qm.select(*mcols).distinct()
    req_tags = distinct_req.select(*mcols, F.inline(F.array(*[
        F.struct(F.lit(name).alias("tag"), F.col(f"m{i}").alias("m")) for i, name in enumerate(TAG_ORDER)
    ]))).filter(F.col("m") > 0)
    cands = _signature_candidates(predictions, k, id_col, arousal, valence, t)
    if replies is None:
        # rule intents: at most len(INTENT_RULES) + 1 distinct multisets, a proven
        # bound, so the requested-tag table is broadcast; with free-form replies
        # the size is left to AQE (broadcast if small, skew-split join if not).
        req_tags = F.broadcast(req_tags)
    scored = (req_tags.join(cands, "tag")
              .groupBy(*mcols, "song_id").agg(F.sum(F.col("m") * F.col("n")).cast("bigint").alias("match_count")))
    w = Window.partitionBy(*mcols).orderBy(F.desc("match_count"), F.asc("song_id"))
    ranked = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    if replies is None:
        ranked = F.broadcast(ranked)  # <= (rules + 1) * k rows
    out = qm.join(ranked, mcols, "left")
    return out.select(
        "question_id", F.col("rank").cast("int").alias("rank"), "song_id", "match_count", "explanation",
        F.when(F.col("song_id").isNull(), F.lit(NO_MATCH_MESSAGE)).alias("message"),
    )
