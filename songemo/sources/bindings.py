"""Logical song tables bound to the benchmark parquet tables.

The engine's operators take column names as parameters, so the same code
serves real song tables and these bindings.  Each binding is a projection
(plus, where noted, an aggregation) over one driver table; nothing is
sampled or capped, so the work grows with the tables.  The same bindings are
written in SQL in ``songemo.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CHROMA_METHODS
from ..functions.keys import key_templates
from .frames_csv import BAND_NAMES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sid(c: str):
    return F.col(c).cast("string")


# --------------------------------------------------------------- predictions
def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """emotion_predictions(song_id, predicted_arousal, predicted_valence) from orders.

    arousal = 1 + (key % 33) * 0.25 (NaN if key % 101 = 0, else NULL if
    key % 103 = 0); valence = 1 + (custkey % 17) * 0.5.  Multiples of .25 are
    exact in binary and land on every threshold.
    """
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    arousal = (
        F.when(k % 101 == 0, F.lit(float("nan")))
        .when(k % 103 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(1.0) + (k % 33).cast("double") * F.lit(0.25))
    )
    valence = F.lit(1.0) + (F.col("o_custkey") % 17).cast("double") * F.lit(0.5)
    return o.select(_sid("o_orderkey").alias("song_id"),
                    arousal.alias("predicted_arousal"), valence.alias("predicted_valence"))


def order_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """song_labels(song_id, arousal, valence) as numbers, from the same orders rule.

    NaN stays NaN here; label loading normalises it (see labels_clean).
    """
    p = predictions(spark, sf_dir)
    return p.select("song_id", F.col("predicted_arousal").alias("arousal"),
                    F.col("predicted_valence").alias("valence"))


# -------------------------------------------------------------------- frames
# frame measures of lineitem, one song per order
FRAME_BINDING: dict[str, str] = {
    "spectral_centroid": "l_quantity",
    "energy": "l_extendedprice",
    "mfcc_coef1": "l_discount",
    "zcr": "l_tax",
}
BAND_BINDING: tuple[str, ...] = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """frames(song_id, frame_idx, measures...) from lineitem (song = order; id kept numeric)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("song_id"),
                     F.col("l_linenumber").cast("bigint").alias("frame_idx"),
                     *[F.col(c) for c in BAND_BINDING])


def band_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bands(song_id, frame_idx, one column per band name) from embeddings: band i sums the elements i, i + 26, ..."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(_sid("label").alias("song_id"), F.col("vec_id").alias("frame_idx"),
                    *[_folded(i, len(BAND_NAMES)).alias(n) for i, n in enumerate(BAND_NAMES)])


def _folded(i: int, n: int, each=lambda x: x) -> Column:
    """Sum of every n-th element of the vector from element i on (all n sums use the whole vector, whatever its length)."""
    mine = F.filter("embedding", lambda x, j: j % n == i)
    return F.aggregate(mine, F.lit(0.0), lambda total, x: total + each(x.cast("double")))


def chroma_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chroma_frames(song_id, method, frame_idx, chroma ARRAY<DOUBLE>[12]) from embeddings.

    chroma class i sums |element i|, |element i + 12|, ...; method = stft/cqt/cens by vec_id % 3.  For songs
    (labels) divisible by 3 the stft frames are negated, so their stft sum
    is unusable and the method fallback is exercised.
    """
    e = table(spark, sf_dir, "embeddings")
    method = F.element_at(F.array(*[F.lit(m) for m in CHROMA_METHODS]),
                          (F.col("vec_id") % 3 + 1).cast("int"))
    neg = (F.col("label") % 3 == 0) & (method == F.lit(CHROMA_METHODS[0]))
    chroma = F.array(*[_folded(i, 12, F.abs) for i in range(12)])
    chroma = F.when(neg, F.transform(chroma, lambda x: -x)).otherwise(chroma)
    return e.select(_sid("label").alias("song_id"), method.alias("method"),
                    F.col("vec_id").alias("frame_idx"), chroma.alias("chroma"))


# ------------------------------------------------------------- songs / audio
KEY_CYCLE: tuple[str, ...] = tuple(n for n, _ in key_templates()) + ("unknown", "", "Bb minor", "H major")


def audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """audio-derived (song_id, tempo_bpm, key) from part.

    tempo = p_size * 5 (NULL when p_partkey % 11 = 0); key cycles through the
    24 key names, 'unknown', '', 'Bb minor' and 'H major' by p_partkey % 28.
    """
    p = table(spark, sf_dir, "part")
    tempo = F.when(F.col("p_partkey") % 11 == 0, F.lit(None).cast("double")).otherwise(
        (F.col("p_size") * 5).cast("double"))
    key = F.element_at(F.array(*[F.lit(k) for k in KEY_CYCLE]), (F.col("p_partkey") % 28 + 1).cast("int"))
    return p.select(_sid("p_partkey").alias("song_id"), tempo.alias("tempo_bpm"), key.alias("key"))


# ------------------------------------------------------------------- onsets
def onsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """onsets(song_id, ts TIMESTAMP, onset_id) from events (song = user)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(_sid("user_id").alias("song_id"), F.col("ts").cast("timestamp").alias("ts"),
                     F.col("event_id").alias("onset_id"))


# ---------------------------------------------------------- static labels
def annotation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Static annotation rows as text, from events.

    file = event_type (files are read in name order), line = event_id,
    song = user; arousal text = value ('n/a' when event_id % 13 = 0);
    valence text = 1 + event_id % 9.
    """
    ev = table(spark, sf_dir, "events")
    a_txt = F.when(F.col("event_id") % 13 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    v_txt = (F.col("event_id") % 9 + 1).cast("string")
    return ev.select(F.col("event_type").alias("file_name"), F.col("event_id").alias("line_no"),
                     _sid("user_id").alias("song_id"), a_txt.alias("arousal"), v_txt.alias("valence"))


def order_annotation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second annotation file from orders: song = customer, arousal text = priority's digit, valence text = year."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.lit("orders").alias("file_name"), F.col("o_orderkey").alias("line_no"),
                    _sid("o_custkey").alias("song_id"), F.substring("o_orderpriority", 1, 1).alias("arousal"),
                    F.year("o_orderdate").cast("string").alias("valence"))


# ---------------------------------------------------- dynamic (wide) labels
def dynamic_arousal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs-as-rows arousal matrix: one row per order, t1..t4 = mean measures."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(_sid("l_orderkey").alias("song_id")).agg(
        *[F.avg(c).alias(f"t{i + 1}") for i, c in enumerate(BAND_BINDING)])


def dynamic_valence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs-as-rows valence matrix from orders: t1 = totalprice / 1e4, t2 = 1 + custkey % 9."""
    o = table(spark, sf_dir, "orders")
    return o.select(_sid("o_orderkey").alias("song_id"),
                    (F.col("o_totalprice") / 10000.0).alias("t1"),
                    (F.col("o_custkey") % 9 + 1).cast("double").alias("t2"))


def dynamic_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs-as-columns matrix already in long form: (t, song_id, value).

    Time step = l_linenumber, song = order, value = l_quantity (NULL when
    l_linenumber = 7, an empty cell).
    """
    li = table(spark, sf_dir, "lineitem")
    val = F.when(F.col("l_linenumber") == 7, F.lit(None).cast("double")).otherwise(F.col("l_quantity"))
    return li.select(F.col("l_linenumber").cast("bigint").alias("t"), _sid("l_orderkey").alias("song_id"),
                     val.alias("value"))


# ----------------------------------------------------------------- questions
QUESTION_PHRASES: tuple[str, ...] = (
    "Find calm music for studying",
    "upbeat and dark",
    "calmly",
    "a crusade",
    "Which songs are energetic and positive?",
    "hello",
    "something chill and subdued",
    "music for a melancholic evening",
)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """questions(question_id, text): user turns, each prefixed by a phrase chosen by turn."""
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    phrase = F.element_at(F.array(*[F.lit(p) for p in QUESTION_PHRASES]),
                          (F.col("turn") % len(QUESTION_PHRASES) + 1).cast("int"))
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("question_id"),
                    F.concat_ws(" ", phrase, F.col("text")).alias("text"))


REPLY_TAG_TEXT: tuple[str, ...] = (
    '["Calm Focus"]',
    '"Positive, Dramatic"',
    '["Happy", "Negative"]',
    '["Happy"]',
    '[]',
)


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """replies(question_id, content): model-style replies, one per user turn.

    Shapes by (conv_id + turn) % 8: fenced JSON, plain JSON, empty
    explanation, no valid tag, not JSON at all, a JSON array, fenced JSON
    after a newline with a newline in its explanation, and a numeric explanation.
    """
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    shape = (F.col("conv_id") + F.col("turn")) % 8
    tags = F.element_at(F.array(*[F.lit(t) for t in REPLY_TAG_TEXT]),
                        (F.col("turn") % len(REPLY_TAG_TEXT) + 1).cast("int"))
    expl = F.concat(F.lit("Reply for conversation "), F.col("conv_id").cast("string"))
    obj = F.concat(F.lit('{"tags": '), tags, F.lit(', "explanation": "'), expl, F.lit('"}'))
    content = (
        F.when(shape == 0, F.concat(F.lit("```json\n"), obj, F.lit("\n```")))
        .when(shape == 1, obj)
        .when(shape == 2, F.concat(F.lit('{"tags": '), tags, F.lit(', "explanation": ""}')))
        .when(shape == 3, F.lit('{"tags": ["Loud"], "explanation": "  none  "}'))
        .when(shape == 4, F.concat(F.lit("I think "), tags))
        .when(shape == 5, F.concat(F.lit("["), tags, F.lit("]")))
        .when(shape == 6, F.concat(F.lit("\n```json\n"), F.regexp_replace(obj, '"}$', F.lit('\\\\n"}')), F.lit("\n```")))
        .otherwise(F.concat(F.lit('{"tags": '), tags, F.lit(', "explanation": 5}')))
    )
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("question_id"), content.alias("content"))


# ------------------------------------------------------------------ runs
def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """runs(owner, run_id): one run folder name per event; errors get 'latest'."""
    ev = table(spark, sf_dir, "events")
    rid = F.when(F.col("event_type") == "error", F.lit("latest")).otherwise(
        F.date_format(F.col("ts"), "yyyyMMdd_HHmmss"))
    return ev.select(_sid("user_id").alias("owner"), rid.alias("run_id"))


# ------------------------------------------------------------- regression
REGRESSION_COEFS: dict[str, float] = {"l_quantity": 950.0, "l_discount": -2000.0, "l_tax": 1500.0}
REGRESSION_INTERCEPT = 1200.0


def regression_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row key, y, features) from lineitem: y = l_extendedprice."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_extendedprice").alias("y"),
                     *[F.col(c) for c in REGRESSION_COEFS])
