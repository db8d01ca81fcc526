"""DuckDB SQL for every named query: the correctness oracle.

Written independently of the Spark operators, as plain (often brute-force)
SQL over the pre-registered views.  Doubles are rounded to 9 decimals and
integers cast to BIGINT, like ``songemo.plans.report.finalize`` does.
"""

from __future__ import annotations

# ------------------------------------------------------------------ bindings
PRED = """predictions AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS song_id,
         CASE WHEN o_orderkey % 101 = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN o_orderkey % 103 = 0 THEN NULL
              ELSE 1.0::DOUBLE + CAST(o_orderkey % 33 AS DOUBLE) * 0.25::DOUBLE END AS predicted_arousal,
         1.0::DOUBLE + CAST(o_custkey % 17 AS DOUBLE) * 0.5::DOUBLE AS predicted_valence
  FROM orders)"""

QUESTIONS = """questions AS (
  SELECT conv_id * 1000 + turn AS question_id,
         concat_ws(' ', ['Find calm music for studying', 'upbeat and dark', 'calmly', 'a crusade',
                         'Which songs are energetic and positive?', 'hello',
                         'something chill and subdued', 'music for a melancholic evening'][turn % 8 + 1],
                   text) AS text
  FROM conversations WHERE role = 'user')"""

# tag flags of a point (a, v) -- NaN compares high, so check isfinite first
def _flags(a: str, v: str) -> str:
    ok = f"(coalesce(isfinite({a}), false) AND coalesce(isfinite({v}), false))"
    return f"""{ok} AND {a} >= 6 AS t_he,
       {ok} AND {a} <= 4 AS t_le,
       {ok} AND {v} >= 6 AS t_pos,
       {ok} AND {v} <= 4 AS t_neg,
       {ok} AND {a} <= 4 AND {v} >= 5 AS t_calm,
       {ok} AND {a} >= 6 AND {v} <= 4 AS t_dram,
       {ok} AND {a} > 4 AND {a} < 6 AND {v} > 4 AND {v} < 6 AS t_neu"""


TAG_LIST = """list_filter([CASE WHEN t_he THEN 'High Energy' END, CASE WHEN t_le THEN 'Low Energy' END,
              CASE WHEN t_pos THEN 'Positive' END, CASE WHEN t_neg THEN 'Negative' END,
              CASE WHEN t_calm THEN 'Calm Focus' END, CASE WHEN t_dram THEN 'Dramatic' END,
              CASE WHEN t_neu THEN 'Neutral' END], lambda x: x IS NOT NULL)"""

PRED_TAGGED = PRED + f""",
tagged AS (SELECT *, {_flags('predicted_arousal', 'predicted_valence')} FROM predictions),
pt AS (SELECT *, {TAG_LIST} AS tl FROM tagged)"""

# Unicode word boundary around the first alternative (RE2 has no lookaround)
_NW = r"[^\pL\pN_]"


def _wb(word: str) -> str:
    return f"(^|{_NW}){word}({_NW}|$)"


RULES = [
    (_wb("calm") + "|studying|focus", "['Calm Focus']", "Calm Focus"),
    (_wb("energetic") + "|high energy|upbeat", "['High Energy', 'Positive']", "High Energy, Positive"),
    (_wb("dramatic") + "|tense|dark", "['Dramatic']", "Dramatic"),
    (_wb("positive") + "|happy|uplifting", "['Positive']", "Positive"),
    (_wb("negative") + "|sad|melancholic", "['Negative']", "Negative"),
    (_wb("low energy") + "|chill|subdued", "['Low Energy']", "Low Energy"),
    (_wb("neutral") + "|middle", "['Neutral']", "Neutral"),
]


def _rule_case(text: str, what: str) -> str:
    parts = ["CASE"]
    for pat, lst, names in RULES:
        val = lst if what == "tags" else f"'Songs matching: {names} (rule-based).'"
        parts.append(f"  WHEN regexp_matches(lower({text}), '{pat}') THEN {val}")
    default = "['Neutral']" if what == "tags" else "'Songs from the middle of the emotion space (no key match).'"
    parts.append(f"  ELSE {default} END")
    return "\n".join(parts)


RULE_TAGS = _rule_case("text", "tags")
RULE_EXPL = _rule_case("text", "explanation")

SQL: dict[str, str] = {}

# ----------------------------------------------------------- semantic layer
SQL["tags"] = f"""WITH {PRED_TAGGED}
SELECT song_id, array_to_string(tl, '|') AS tags FROM pt"""

SQL["tags_with_nan"] = f"""WITH {PRED_TAGGED}
SELECT song_id,
       CASE WHEN predicted_arousal IS NULL THEN 'null' WHEN isnan(predicted_arousal) THEN 'nan' ELSE 'other' END
         AS arousal_state,
       array_to_string(tl, '|') AS tags, CAST(len(tl) AS BIGINT) AS n_tags
FROM pt
WHERE NOT (coalesce(isfinite(predicted_arousal), false) AND coalesce(isfinite(predicted_valence), false))"""

SQL["tag_counts"] = f"""WITH {PRED_TAGGED},
dim(tag_order, tag) AS (VALUES (1, 'High Energy'), (2, 'Low Energy'), (3, 'Positive'), (4, 'Negative'),
                               (5, 'Calm Focus'), (6, 'Dramatic'), (7, 'Neutral')),
ex AS (SELECT unnest(tl) AS tag FROM pt)
SELECT CAST(dim.tag_order AS BIGINT) AS tag_order, dim.tag, CAST(count(ex.tag) AS BIGINT) AS n_songs
FROM dim LEFT JOIN ex ON dim.tag = ex.tag GROUP BY dim.tag_order, dim.tag"""

SQL["filter_calm_focus"] = f"""WITH {PRED_TAGGED}
SELECT song_id, round(predicted_arousal, 9) AS predicted_arousal, round(predicted_valence, 9) AS predicted_valence
FROM pt WHERE t_calm"""

SQL["filter_unknown_tag"] = f"""WITH {PRED}
SELECT song_id, round(predicted_arousal, 9) AS predicted_arousal, round(predicted_valence, 9) AS predicted_valence
FROM predictions WHERE false"""

SQL["calm_focus_head"] = f"""WITH {PRED_TAGGED}
SELECT song_id FROM pt WHERE t_calm ORDER BY song_id LIMIT 5"""

# ------------------------------------------------------------------ analyst
SQL["intent_rules"] = f"""WITH {QUESTIONS}
SELECT question_id, array_to_string({RULE_TAGS}, '|') AS tags, {RULE_EXPL} AS explanation FROM questions"""

SQL["analyst_match_count"] = f"""WITH {PRED_TAGGED}
SELECT song_id, CAST(sum(n) AS BIGINT) AS match_count
FROM (SELECT song_id, CAST(t_he AS INT) + CAST(t_pos AS INT) AS n FROM pt) WHERE n > 0 GROUP BY song_id"""

SQL["analyst_topk"] = f"""WITH {PRED_TAGGED},
c AS (SELECT song_id, sum(CAST(t_calm AS INT)) AS match_count FROM pt WHERE t_calm GROUP BY song_id)
SELECT CAST(row_number() OVER (ORDER BY match_count DESC, song_id) AS BIGINT) AS rank, song_id,
       CAST(match_count AS BIGINT) AS match_count,
       'Songs matching: Calm Focus (rule-based).' AS explanation
FROM c ORDER BY match_count DESC, song_id LIMIT 20"""

SQL["analyst_union"] = f"""WITH {PRED_TAGGED}
SELECT song_id FROM pt WHERE t_he UNION SELECT song_id FROM pt WHERE t_pos"""

SQL["analyst_batch"] = f"""WITH {PRED_TAGGED}, {QUESTIONS},
qi AS (SELECT question_id, {RULE_TAGS} AS req, {RULE_EXPL} AS explanation FROM questions),
s AS (SELECT qi.question_id, pt.song_id,
             sum(len(list_filter(qi.req, lambda x: list_contains(pt.tl, x)))) AS match_count
      FROM qi, pt GROUP BY qi.question_id, pt.song_id HAVING sum(len(list_filter(qi.req, lambda x: list_contains(pt.tl, x)))) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY match_count DESC, song_id) AS rank FROM s)
SELECT qi.question_id, CAST(r.rank AS BIGINT) AS rank, r.song_id, CAST(r.match_count AS BIGINT) AS match_count,
       qi.explanation,
       CASE WHEN r.song_id IS NULL THEN '(No songs matched the requested tags.)' END AS message
FROM qi LEFT JOIN (SELECT * FROM r WHERE rank <= 5) r ON qi.question_id = r.question_id"""


# ---------------------------------------------------------------- features
# two-pass sample variance of non-NULL band means (mean first, then squared
# deviations), the way pandas computes it
FEAT_RICH = """feat0 AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS song_id, avg(l_quantity) AS b0, avg(l_extendedprice) AS energy,
         avg(l_discount) AS b1, avg(l_tax) AS b2
  FROM lineitem GROUP BY l_orderkey),
feat AS (
  SELECT song_id, b0 AS spectral_centroid, energy, b1 AS mfcc_coef1,
         ((b0 - (b0 + b1 + b2) / 3) * (b0 - (b0 + b1 + b2) / 3) + (b1 - (b0 + b1 + b2) / 3) * (b1 - (b0 + b1 + b2) / 3)
          + (b2 - (b0 + b1 + b2) / 3) * (b2 - (b0 + b1 + b2) / 3)) / 2 AS auditory_band_variance,
         NULL::DOUBLE AS spectral_rolloff50, b2 AS zcr, NULL::DOUBLE AS spectral_flux,
         NULL::DOUBLE AS spectral_variance, NULL::DOUBLE AS spectral_entropy, NULL::DOUBLE AS spectral_harmonicity
  FROM feat0)"""

_PITCH = ["C", "C#", "D", "D#", "E", "F", "F#", "G", "G#", "A", "A#", "B"]
_KEYS = [f"{p} {m}" for p in _PITCH for m in ("major", "minor")] + ["unknown", "", "Bb minor", "H major"]
KEY_LIST = "[" + ", ".join(f"'{k}'" for k in _KEYS) + "]"

AUDIO = f"""audio AS (
  SELECT CAST(p_partkey AS VARCHAR) AS song_id,
         CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size * 5 AS DOUBLE) END AS tempo_bpm,
         {KEY_LIST}[p_partkey % 28 + 1] AS key
  FROM part)"""


def _parse_key_cols(key: str) -> str:
    s = f"regexp_replace(regexp_replace({key}, '^\\s+', ''), '\\s+$', '')"
    root = f"regexp_extract({s}, '^(\\S+)', 1)"
    rest = f"regexp_extract({s}, '^\\S+\\s+(.*)$', 1)"
    unknown = f"({key} IS NULL OR {s} = '' OR lower({s}) = 'unknown')"
    head = f"(CASE WHEN {root} LIKE '%#' OR {root} LIKE '%b' THEN left({root}, length({root}) - 1) ELSE {root} END)"
    note = f"upper(regexp_replace(regexp_replace({head}, '^\\s+', ''), '\\s+$', ''))"
    mode = f"(CASE WHEN {unknown} THEN 'major' WHEN contains(lower({rest}), 'minor') THEN 'minor' ELSE 'major' END)"
    return f"""CASE WHEN {unknown} THEN 'Unknown' WHEN {note} IN ('A','B','C','D','E','F','G') THEN {note}
              ELSE 'Unknown' END AS key_note,
       {mode} AS key_mode,
       CASE WHEN {unknown} THEN 'natural' WHEN {root} LIKE '%#' THEN 'sharp' WHEN {root} LIKE '%b' THEN 'flat'
            ELSE 'natural' END AS key_signature,
       {mode} = 'major' AS is_major"""


TEMPO_BUCKET = """CASE WHEN tempo_bpm IS NULL OR isnan(tempo_bpm) THEN 'Unknown'
     WHEN tempo_bpm < 80 THEN 'Slow  (<80 BPM)' WHEN tempo_bpm < 120 THEN 'Mid   (80–120 BPM)'
     WHEN tempo_bpm < 160 THEN 'Fast  (120–160 BPM)' ELSE 'Very Fast  (160+ BPM)' END"""

ENRICHED = FEAT_RICH + ",\n" + AUDIO + f""",
enriched AS (
  SELECT f.*, a.tempo_bpm, 'unknown' AS genre, coalesce(a.key, 'unknown') AS key,
         {_parse_key_cols("coalesce(a.key, 'unknown')")}
  FROM feat f LEFT JOIN audio a ON f.song_id = a.song_id)"""

RICH_COLS = ("spectral_centroid, energy, mfcc_coef1, auditory_band_variance, spectral_rolloff50, zcr, "
             "spectral_flux, spectral_variance, spectral_entropy, spectral_harmonicity")


def _r(cols: str, prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{c.strip()}, 9) AS {c.strip()}" for c in cols.split(","))


LABELS_CLEAN = PRED + """,
labels AS (
  SELECT song_id, CASE WHEN isnan(predicted_arousal) THEN NULL ELSE predicted_arousal END AS arousal,
         CASE WHEN isnan(predicted_valence) THEN NULL ELSE predicted_valence END AS valence
  FROM predictions),
labels_ok AS (SELECT * FROM labels WHERE arousal IS NOT NULL AND valence IS NOT NULL)"""

SQL["scan_frames_count"] = """SELECT count(*) AS n_frames, count(DISTINCT CAST(l_orderkey AS VARCHAR)) AS n_songs
FROM lineitem"""

SQL["song_features_rich"] = f"""WITH {FEAT_RICH}
SELECT song_id, {_r(RICH_COLS)} FROM feat"""

SQL["song_features_minimal"] = f"""WITH {FEAT_RICH}
SELECT song_id, NULL::DOUBLE AS tempo, {_r("spectral_centroid, energy, mfcc_coef1, auditory_band_variance")}
FROM feat"""

_BANDS = ", ".join("avg(" + " + ".join(f"CAST(embedding[{j + 1}] AS DOUBLE)" for j in range(i, 64, 26)) + ")"
                   for i in range(26))
SQL["band_variance"] = f"""SELECT CAST(label AS VARCHAR) AS song_id,
       round(list_aggregate([{_BANDS}], 'var_samp'), 9) AS auditory_band_variance,
       CAST(len(list_filter([{_BANDS}], lambda x: x IS NOT NULL)) AS BIGINT) AS n_bands
FROM embeddings GROUP BY label"""

# ------------------------------------------------------------------- joins
SQL["enrich_left_join"] = f"""WITH {ENRICHED}
SELECT song_id, {_r(RICH_COLS)}, round(tempo_bpm, 9) AS tempo_bpm, genre, key, key_note, key_mode,
       key_signature, is_major
FROM enriched"""

SQL["modeling_dataset"] = f"""WITH {FEAT_RICH}, {LABELS_CLEAN}
SELECT f.song_id, {_r(RICH_COLS, "f.")}, round(l.arousal, 9) AS arousal, round(l.valence, 9) AS valence
FROM feat f JOIN labels_ok l ON f.song_id = l.song_id"""

MAP_TABLE = PRED + ",\n" + ENRICHED + f""",
map_t AS (
  SELECT p.*, e.key, e.tempo_bpm, e.genre, e.key_note, e.key_mode, e.key_signature, e.is_major,
         {TEMPO_BUCKET.replace("tempo_bpm", "e.tempo_bpm")} AS tempo_bucket
  FROM predictions p LEFT JOIN enriched e ON p.song_id = e.song_id)"""

SQL["map_metadata_join"] = f"""WITH {MAP_TABLE}
SELECT song_id, round(CASE WHEN isnan(predicted_arousal) THEN NULL ELSE predicted_arousal END, 9) AS predicted_arousal, round(predicted_valence, 9) AS predicted_valence,
       key, round(tempo_bpm, 9) AS tempo_bpm, genre, key_note, key_mode, key_signature, is_major, tempo_bucket
FROM map_t"""

SQL["parse_key"] = f"""WITH {AUDIO}
SELECT song_id, key, {_parse_key_cols("key")} FROM audio"""

SQL["tempo_bucket"] = f"""WITH {AUDIO}
SELECT song_id, round(tempo_bpm, 9) AS tempo_bpm, {TEMPO_BUCKET} AS tempo_bucket FROM audio"""

ANNOT = """annot AS (
  SELECT event_type AS file_name, event_id AS line_no, CAST(user_id AS VARCHAR) AS song_id,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE value END AS arousal,
         CAST(event_id % 9 + 1 AS DOUBLE) AS valence
  FROM events)"""

SQL["numeric_coerce"] = f"""WITH {ANNOT}
SELECT file_name, line_no, song_id, round(arousal, 9) AS arousal, round(valence, 9) AS valence FROM annot"""

# ------------------------------------------------------------------ labels
SQL["labels_clean"] = f"""WITH {LABELS_CLEAN}
SELECT song_id, round(arousal, 9) AS arousal, round(valence, 9) AS valence FROM labels_ok"""

SQL["labels_keep_first"] = f"""WITH {ANNOT},
ok AS (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY file_name, line_no) AS rn
       FROM annot WHERE arousal IS NOT NULL AND valence IS NOT NULL AND song_id IS NOT NULL)
SELECT song_id, round(arousal, 9) AS arousal, round(valence, 9) AS valence FROM ok WHERE rn = 1"""

SQL["labels_union_all"] = f"""WITH {ANNOT}
SELECT file_name, line_no, song_id, round(arousal, 9) AS arousal, round(valence, 9) AS valence
FROM annot
UNION ALL
SELECT 'orders', o_orderkey, CAST(o_custkey AS VARCHAR), TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE),
       CAST(year(CAST(o_orderdate AS DATE)) AS DOUBLE) FROM orders"""

SQL["ids_intersect"] = """SELECT CAST(l_orderkey AS VARCHAR) AS song_id FROM lineitem
INTERSECT SELECT CAST(o_orderkey AS VARCHAR) FROM orders"""

SQL["dynamic_rows_layout"] = """WITH a AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS song_id,
         (avg(l_quantity) + avg(l_extendedprice) + avg(l_discount) + avg(l_tax)) / 4 AS arousal
  FROM lineitem GROUP BY l_orderkey),
v AS (SELECT CAST(o_orderkey AS VARCHAR) AS song_id,
             (o_totalprice / 10000.0 + CAST(o_custkey % 9 + 1 AS DOUBLE)) / 2 AS valence FROM orders)
SELECT a.song_id, round(arousal, 9) AS arousal, round(valence, 9) AS valence
FROM a JOIN v ON a.song_id = v.song_id WHERE arousal IS NOT NULL AND valence IS NOT NULL"""

SQL["dynamic_cols_layout"] = """WITH a AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS song_id,
         avg(CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity END) AS arousal,
         avg(l_tax * 100) AS valence
  FROM lineitem GROUP BY l_orderkey)
SELECT song_id, round(arousal, 9) AS arousal, round(valence, 9) AS valence
FROM a WHERE arousal IS NOT NULL AND valence IS NOT NULL"""

# ----------------------------------------------------------------- quality
SQL["duplicate_keys"] = """SELECT 'annotations' AS "table", CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS duplicate_rows
FROM (SELECT user_id, count(*) AS c FROM events GROUP BY user_id)
UNION ALL
SELECT 'frames', CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1)"""

_MODEL = ["spectral_centroid", "energy", "mfcc_coef1", "auditory_band_variance", "spectral_rolloff50", "zcr",
          "spectral_flux", "spectral_variance", "spectral_entropy", "spectral_harmonicity", "tempo_bpm"]
SQL["null_profile"] = f"""WITH {ENRICHED},
n AS (SELECT count(*) AS total, {", ".join(f"count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS m_{c}" for c in _MODEL)}
      FROM enriched),
u AS ({" UNION ALL ".join(f"SELECT '{c}' AS \"column\", m_{c} AS n_null, total FROM n" for c in _MODEL)})
SELECT "column", CAST(n_null AS BIGINT) AS n_null, round(round(n_null * 100.0 / total, 1), 9) AS pct_null
FROM u WHERE n_null > 0"""

COVERAGE = """cov AS (
  SELECT count(*) AS n_rows,
         count(*) FILTER (WHERE tempo_bpm IS NOT NULL AND NOT isnan(tempo_bpm)) AS n_tempo,
         count(*) FILTER (WHERE tempo_bpm IS NOT NULL AND NOT isnan(tempo_bpm)
                          AND (tempo_bpm < 20 OR tempo_bpm > 300)) AS n_tempo_out_of_range,
         count(*) FILTER (WHERE key IS NOT NULL AND trim(key) <> '' AND lower(key) <> 'unknown') AS n_key_known
  FROM enriched)"""

SQL["coverage_stats"] = f"""WITH {ENRICHED}, {COVERAGE}
SELECT CAST(n_rows AS BIGINT) AS n_rows, CAST(n_tempo AS BIGINT) AS n_tempo,
       round(CASE WHEN n_rows > 0 THEN n_tempo * 100.0 / n_rows ELSE 0.0 END, 9) AS tempo_pct,
       CAST(n_tempo_out_of_range AS BIGINT) AS n_tempo_out_of_range, CAST(n_key_known AS BIGINT) AS n_key_known,
       round(CASE WHEN n_rows > 0 THEN n_key_known * 100.0 / n_rows ELSE 0.0 END, 9) AS key_pct
FROM cov"""


def _report_row(table: str, check: str, level: str, value: str, message: str) -> str:
    return (f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", {level} AS level, "
            f"round(CAST({value} AS DOUBLE), 9) AS value, {message} AS message FROM st")


def _pct1(x: str) -> str:
    return f"format('{{:,.1f}}', CASE WHEN n > 0 THEN {x} * 100.0 / n ELSE 0.0 END)"


def _basic(table: str, key: str) -> list[str]:
    return [
        _report_row(table, "row_count", "CASE WHEN n = 0 THEN 'error' ELSE 'info' END", "n",
                    "CASE WHEN n = 0 THEN 'Table is empty' ELSE 'Row count: ' || n END"),
        _report_row(table, "duplicate_keys", "CASE WHEN dup > 0 THEN 'error' ELSE 'ok' END", "dup",
                    f"'Duplicate {key}: ' || dup || ' rows'"),
    ]


_FEATS10 = _MODEL[:10]
_VF_ROWS = _basic("song_features", "song_id") + [
    _report_row("song_features", f"nan:{c}", f"CASE WHEN m_{c} > 0 THEN 'info' ELSE 'ok' END", f"m_{c}",
                f"'{c}: ' || m_{c} || ' NaN (' || {_pct1(f'm_{c}')} || '%)'") for c in _FEATS10
] + [
    _report_row("song_features", "tempo_coverage", "'info'", "CASE WHEN n > 0 THEN tv * 100.0 / n ELSE 0.0 END",
                f"'tempo_bpm: ' || tv || ' non-NaN (' || {_pct1('tv')} || '%)'"),
    _report_row("song_features", "tempo_out_of_range", "CASE WHEN tout > 0 THEN 'info' ELSE 'ok' END", "tout",
                "'tempo_bpm: ' || tout || ' values outside 20.0-300.0 BPM'"),
    _report_row("song_features", "key_coverage", "'info'", "CASE WHEN n > 0 THEN kk * 100.0 / n ELSE 0.0 END",
                f"'key: ' || kk || ' non-unknown (' || {_pct1('kk')} || '%)'"),
    _report_row("song_features", "audio_coverage",
                "CASE WHEN n > 0 AND (tv * 100.0 / n < 90 OR kk * 100.0 / n < 90) THEN 'error' ELSE 'ok' END",
                "least(CASE WHEN n > 0 THEN tv * 100.0 / n ELSE 0.0 END, CASE WHEN n > 0 THEN kk * 100.0 / n ELSE 0.0 END)",
                "'Audio-derived data missing or failed: tempo_bpm and/or key coverage below the minimum'"),
]
VF_STATS = f"""st AS (
  SELECT count(*) AS n, count(*) - count(DISTINCT song_id) - CASE WHEN count(*) > count(song_id) THEN 1 ELSE 0 END
           + CASE WHEN count(*) > count(song_id) THEN count(*) - count(song_id) - 1 + 1 ELSE 0 END AS dup0,
         {", ".join(f"count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS m_{c}" for c in _FEATS10)},
         count(*) FILTER (WHERE tempo_bpm IS NOT NULL AND NOT isnan(tempo_bpm)) AS tv,
         count(*) FILTER (WHERE tempo_bpm IS NOT NULL AND NOT isnan(tempo_bpm)
                          AND (tempo_bpm < 20 OR tempo_bpm > 300)) AS tout,
         count(*) FILTER (WHERE key IS NOT NULL AND trim(key) <> '' AND lower(key) <> 'unknown') AS kk,
         (SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM enriched GROUP BY song_id)) AS dup
  FROM enriched)"""
VALIDATE_FEATURES = f"""WITH {ENRICHED}, {VF_STATS}
{" UNION ALL ".join(_VF_ROWS)}"""
SQL["validate_features"] = VALIDATE_FEATURES

KEEP_FIRST = ANNOT + """,
ok AS (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY file_name, line_no) AS rn
       FROM annot WHERE arousal IS NOT NULL AND valence IS NOT NULL AND song_id IS NOT NULL),
firsts AS (SELECT song_id, arousal, valence FROM ok WHERE rn = 1)"""
VL_STATS = """st AS (SELECT count(*) AS n,
  (SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM firsts GROUP BY song_id)) AS dup FROM firsts)"""
SQL["validate_labels"] = f"""WITH {KEEP_FIRST}, {VL_STATS}
{" UNION ALL ".join(_basic("song_labels", "song_id"))}"""

_VP = ["predicted_arousal", "predicted_valence"]
VP_STATS = f"""st AS (SELECT count(*) AS n,
  (SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM predictions GROUP BY song_id)) AS dup,
  {", ".join(f"count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS m_{c}" for c in _VP)},
  (SELECT count(*) FROM enriched) AS expected FROM predictions)"""
_VP_ROWS = _basic("emotion_predictions", "song_id") + [
    _report_row("emotion_predictions", f"nan:{c}", f"CASE WHEN m_{c} > 0 THEN 'error' ELSE 'ok' END", f"m_{c}",
                f"'Column ''{c}'' has ' || m_{c} || ' NaN values'") for c in _VP
] + [
    _report_row("emotion_predictions", "row_count_match", "CASE WHEN expected <> n THEN 'error' ELSE 'ok' END",
                "n - expected", "'Row count ' || n || ' vs expected ' || expected"),
]
SQL["validate_predictions"] = f"""WITH {PRED}, {ENRICHED}, {VP_STATS}
{" UNION ALL ".join(_VP_ROWS)}"""

SQL["validation_summary"] = f"""WITH {PRED}, {ENRICHED}, {KEEP_FIRST},
f AS (WITH {VF_STATS} {" UNION ALL ".join(_VF_ROWS)}),
l AS (WITH {VL_STATS} {" UNION ALL ".join(_basic("song_labels", "song_id"))}),
p AS (WITH {VP_STATS} {" UNION ALL ".join(_VP_ROWS)}),
rep AS (SELECT * FROM f UNION ALL SELECT * FROM l UNION ALL SELECT * FROM p)
SELECT "table", bool_and(level <> 'error') AS passed FROM rep GROUP BY "table"
UNION ALL SELECT 'overall', coalesce(bool_and(level <> 'error'), false) FROM rep"""

# ------------------------------------------------------------------- views
FINITE = "coalesce(isfinite(predicted_arousal), false) AND coalesce(isfinite(predicted_valence), false)"
IN_RANGE = ("predicted_arousal BETWEEN 3.0 AND 7.0 AND predicted_valence BETWEEN 2.0 AND 8.0 "
            "AND NOT isnan(predicted_arousal) AND NOT isnan(predicted_valence)")

SQL["map_range_filter"] = f"""WITH {PRED}
SELECT song_id, round(predicted_arousal, 9) AS predicted_arousal, round(predicted_valence, 9) AS predicted_valence
FROM predictions WHERE {IN_RANGE}"""

SQL["map_extent"] = f"""WITH {PRED},
g AS (SELECT min(CASE WHEN isnan(predicted_arousal) THEN NULL ELSE predicted_arousal END) AS amin,
             max(CASE WHEN isnan(predicted_arousal) THEN NULL ELSE predicted_arousal END) AS amax,
             min(CASE WHEN isnan(predicted_valence) THEN NULL ELSE predicted_valence END) AS vmin,
             max(CASE WHEN isnan(predicted_valence) THEN NULL ELSE predicted_valence END) AS vmax
      FROM predictions)
SELECT round(amin, 9) AS arousal_min, round(amax, 9) AS arousal_max, round(vmin, 9) AS valence_min,
       round(vmax, 9) AS valence_max,
       round(round_even((amax - amin) / 100, 3), 9) AS arousal_step, round(round_even((vmax - vmin) / 100, 3), 9) AS valence_step,
       round(CASE WHEN (amax - amin) * 0.05 = 0 THEN 0.3 ELSE (amax - amin) * 0.05 END, 9) AS arousal_pad,
       round(CASE WHEN (vmax - vmin) * 0.05 = 0 THEN 0.3 ELSE (vmax - vmin) * 0.05 END, 9) AS valence_pad,
       round((amin + amax) / 2, 9) AS arousal_mid, round((vmin + vmax) / 2, 9) AS valence_mid
FROM g"""

SQL["map_extent_ui"] = f"""WITH {PRED},
p3 AS (SELECT CASE WHEN isnan(predicted_arousal) THEN NULL ELSE predicted_arousal / 3 END AS a, predicted_valence AS v
       FROM predictions),
g AS (SELECT min(a) AS amin, max(a) AS amax, min(v) AS vmin, max(v) AS vmax FROM p3)
SELECT round_even(amin, 2) AS arousal_min, round_even(amax, 2) AS arousal_max, round_even(vmin, 2) AS valence_min,
       round_even(vmax, 2) AS valence_max,
       round(round_even((amax - amin) / 100, 3), 9) AS arousal_step, round(round_even((vmax - vmin) / 100, 3), 9) AS valence_step,
       round(CASE WHEN (amax - amin) * 0.05 = 0 THEN 0.3 ELSE (amax - amin) * 0.05 END, 9) AS arousal_pad,
       round(CASE WHEN (vmax - vmin) * 0.05 = 0 THEN 0.3 ELSE (vmax - vmin) * 0.05 END, 9) AS valence_pad,
       round((amin + amax) / 2, 9) AS arousal_mid, round((vmin + vmax) / 2, 9) AS valence_mid
FROM g"""

SQL["map_counts"] = f"""WITH {PRED},
g AS (SELECT count(*) FILTER (WHERE {IN_RANGE}) AS n_shown, count(*) AS n_total FROM predictions)
SELECT CAST(n_shown AS BIGINT) AS n_shown, CAST(n_total AS BIGINT) AS n_total,
       'Showing ' || format('{{:,}}', n_shown) || ' of ' || format('{{:,}}', n_total) || ' songs' AS text FROM g"""

SQL["color_groups"] = f"""WITH {MAP_TABLE}
SELECT coalesce(tempo_bucket, 'Unknown') AS color_group, count(*) AS n_songs FROM map_t GROUP BY 1"""


def _quad(src: str, where: str) -> str:
    return f"""pts AS (SELECT * FROM {src} WHERE {where}),
mids AS (SELECT (min(predicted_arousal) + max(predicted_arousal)) / 2 AS am,
                (min(predicted_valence) + max(predicted_valence)) / 2 AS vm FROM pts),
q AS (SELECT pts.*, CASE WHEN predicted_arousal >= am AND predicted_valence < vm THEN 'Tense / Angry'
                         WHEN predicted_arousal >= am AND predicted_valence >= vm THEN 'Happy / Euphoric'
                         WHEN predicted_arousal < am AND predicted_valence < vm THEN 'Sad / Somber'
                         ELSE 'Calm / Peaceful' END AS quadrant FROM pts, mids)"""


SQL["quadrants"] = f"""WITH {PRED}, {_quad("predictions", FINITE)}
SELECT song_id, quadrant FROM q"""

SQL["map_points"] = f"""WITH {MAP_TABLE}, {_quad("map_t", IN_RANGE)}
SELECT song_id, round(predicted_valence, 9) AS valence, round(predicted_arousal, 9) AS arousal,
       coalesce(key_note, 'Unknown') AS color_group, quadrant FROM q"""

SQL["song_table_view"] = f"""WITH {MAP_TABLE}
SELECT song_id, round(round_even(predicted_arousal, 3), 9) AS predicted_arousal,
       round(round_even(predicted_valence, 3), 9) AS predicted_valence,
       key, key_note, key_mode, key_signature, is_major, round(tempo_bpm, 9) AS tempo_bpm, genre, tempo_bucket
FROM map_t WHERE {IN_RANGE}"""

# ------------------------------------------------------------------- audio
_NEG = "(label % 3 = 0 AND vec_id % 3 = 0)"
_FOLD = [" + ".join(f"abs(CAST(embedding[{j + 1}] AS DOUBLE))" for j in range(i, 64, 12)) for i in range(12)]
_CH = ", ".join(f"CASE WHEN {_NEG} THEN -({x}) ELSE {x} END AS x{i}" for i, x in enumerate(_FOLD))
CHROMA = f"""cf AS (SELECT CAST(label AS VARCHAR) AS song_id, ['stft', 'cqt', 'cens'][vec_id % 3 + 1] AS method,
                  vec_id AS frame_idx, {_CH} FROM embeddings),
sums AS (SELECT song_id, method, {", ".join(f"sum(x{i}) AS s{i}" for i in range(12))}, count(*) AS n_frames
         FROM cf GROUP BY song_id, method),
sums_u AS (SELECT *, greatest({", ".join(f"s{i}" for i in range(12))}) > 0 AS usable,
                  list_position(['stft', 'cqt', 'cens'], method) AS mrank FROM sums),
chosen AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY song_id ORDER BY mrank) AS rn
                          FROM sums_u WHERE usable) WHERE rn = 1)"""

SQL["chroma_sum"] = f"""WITH {CHROMA}
SELECT song_id, method, {", ".join(f"round(s{i}, 9) AS c{i}" for i in range(12))},
       CAST(n_frames AS BIGINT) AS n_frames, usable FROM sums_u"""

SQL["chroma_fallback"] = f"""WITH {CHROMA}
SELECT song_id, method FROM chosen"""


def _templates():
    import math
    maj = [6.35, 2.23, 3.48, 2.33, 4.38, 4.09, 2.52, 5.19, 2.39, 3.66, 2.29, 2.88]
    mnr = [6.33, 2.68, 3.52, 5.38, 2.60, 3.53, 2.54, 4.75, 3.98, 2.69, 3.34, 3.17]
    def unit(v):
        n = math.sqrt(sum(x * x for x in v))
        return [x / (n + 1e-12) for x in v]
    maj, mnr = unit(maj), unit(mnr)
    out = []
    for sh in range(12):
        out.append((f"{_PITCH[sh]} major", [maj[(i - sh) % 12] for i in range(12)]))
        out.append((f"{_PITCH[sh]} minor", [mnr[(i - sh) % 12] for i in range(12)]))
    return out


_T = _templates()
_SC = ", ".join("(" + " + ".join(f"u{i} * {p[i]!r}" for i in range(12)) + ")" for _, p in _T)
_NAMES = "[" + ", ".join(f"'{n}'" for n, _ in _T) + "]"
SQL["key_estimation"] = f"""WITH {CHROMA},
nrm AS (SELECT *, sqrt({" + ".join(f"s{i} * s{i}" for i in range(12))}) AS nr FROM chosen),
dn AS (SELECT *, CASE WHEN nr < 1e-12 THEN greatest({", ".join(f"s{i}" for i in range(12))}) + 1e-12 ELSE nr END AS d
       FROM nrm),
un AS (SELECT song_id, method, {", ".join(f"s{i} / d AS u{i}" for i in range(12))} FROM dn),
sc AS (SELECT song_id, method, [{_SC}] AS k FROM un),
rk AS (SELECT song_id, method, k, list_transform(k, lambda x: round(x, 9)) AS kr, list_reverse_sort(k) AS ks FROM sc)
SELECT song_id, method, {_NAMES}[list_position(kr, list_max(kr))] AS key,
       round(ks[1], 9) AS score, round(ks[1] - ks[2], 9) AS margin FROM rk"""

SQL["middle_segment"] = """WITH f AS (
  SELECT CAST(label AS VARCHAR) AS song_id, vec_id AS frame_idx, ['stft', 'cqt', 'cens'][vec_id % 3 + 1] AS method,
         row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos,
         count(*) OVER (PARTITION BY label) AS n
  FROM embeddings)
SELECT song_id, frame_idx, method FROM f WHERE n < 10 OR (pos >= n // 4 AND pos < (3 * n) // 4)"""

SQL["tempo_from_onsets"] = """WITH g AS (
  SELECT CAST(user_id AS VARCHAR) AS song_id,
         (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6 AS gap
  FROM events),
m AS (SELECT song_id, count(*) AS n_onsets, median(gap) AS med FROM g GROUP BY song_id)
SELECT song_id, CAST(n_onsets AS BIGINT) AS n_onsets, round(med, 9) AS median_gap_s,
       round(CASE WHEN med IS NULL OR med = 0 THEN NULL ELSE 60.0 / med END, 9) AS tempo_bpm FROM m"""

SQL["clip_first_seconds"] = """WITH f AS (SELECT user_id, min(ts) AS t0 FROM events GROUP BY user_id)
SELECT CAST(e.user_id AS VARCHAR) AS song_id, count(*) AS n_in_clip
FROM events e JOIN f ON e.user_id = f.user_id
WHERE e.ts < f.t0 + INTERVAL 259200 SECOND GROUP BY e.user_id"""

SQL["latest_run"] = """SELECT CAST(user_id AS VARCHAR) AS owner,
       coalesce(max(CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y%m%d_%H%M%S') END), '') AS latest_run
FROM events GROUP BY user_id"""

# -------------------------------------------------------------- similarity
SQL["similar_songs"] = f"""WITH {PRED},
ok AS (SELECT * FROM predictions WHERE {FINITE}),
seeds AS (SELECT song_id AS seed_id, predicted_arousal AS a0, predicted_valence AS v0 FROM ok
          WHERE song_id IN ('1', '2', '3')),
d AS (SELECT seed_id, ok.song_id, (predicted_arousal - a0) ^ 2 + (predicted_valence - v0) ^ 2 AS distance
      FROM seeds JOIN ok ON ok.song_id <> seeds.seed_id),
r AS (SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY distance, song_id) AS rank FROM d)
SELECT seed_id, CAST(rank AS BIGINT) AS rank, song_id, round(distance, 9) AS distance FROM r WHERE rank <= 10"""

SQL["similar_to_calm_focus"] = f"""WITH {PRED_TAGGED},
ok AS (SELECT song_id, predicted_arousal AS a, predicted_valence AS v FROM pt WHERE {FINITE}),
seeds AS (SELECT song_id AS seed_id, predicted_arousal AS a0, predicted_valence AS v0 FROM pt WHERE t_calm),
d AS (SELECT seed_id, ok.song_id, (a - a0) ^ 2 + (v - v0) ^ 2 AS distance
      FROM seeds JOIN ok ON ok.song_id <> seeds.seed_id),
r AS (SELECT *, row_number() OVER (PARTITION BY seed_id ORDER BY distance, song_id) AS rank FROM d)
SELECT seed_id, CAST(rank AS BIGINT) AS rank, song_id, round(distance, 9) AS distance FROM r WHERE rank <= 5"""

SQL["song_profile"] = f"""WITH {PRED_TAGGED},
mids AS (SELECT (min(CASE WHEN isnan(predicted_arousal) THEN NULL ELSE predicted_arousal END)
                 + max(CASE WHEN isnan(predicted_arousal) THEN NULL ELSE predicted_arousal END)) / 2 AS am,
                (min(CASE WHEN isnan(predicted_valence) THEN NULL ELSE predicted_valence END)
                 + max(CASE WHEN isnan(predicted_valence) THEN NULL ELSE predicted_valence END)) / 2 AS vm
         FROM predictions)
SELECT song_id, round(CASE WHEN isnan(predicted_arousal) THEN NULL ELSE predicted_arousal END, 9) AS arousal,
       round(CASE WHEN isnan(predicted_valence) THEN NULL ELSE predicted_valence END, 9) AS valence,
       array_to_string(tl, '|') AS tags,
       CASE WHEN NOT ({FINITE}) THEN NULL
            WHEN predicted_arousal >= am AND predicted_valence < vm THEN 'Tense / Angry'
            WHEN predicted_arousal >= am AND predicted_valence >= vm THEN 'Happy / Euphoric'
            WHEN predicted_arousal < am AND predicted_valence < vm THEN 'Sad / Somber'
            ELSE 'Calm / Peaceful' END AS quadrant
FROM pt, mids WHERE song_id IN ('1', '2', '3', '4', '5', '101', '103')"""


# ------------------------------------------------------------ replies
REPLIES = """replies AS (
  SELECT conv_id * 1000 + turn AS question_id,
         ['["Calm Focus"]', '"Positive, Dramatic"', '["Happy", "Negative"]', '["Happy"]', '[]'][turn % 5 + 1] AS tg,
         'Reply for conversation ' || CAST(conv_id AS VARCHAR) AS ex, (conv_id + turn) % 8 AS shape
  FROM conversations WHERE role = 'user'),
replies2 AS (
  SELECT question_id,
         CASE shape WHEN 0 THEN '```json' || chr(10) || '{"tags": ' || tg || ', "explanation": "' || ex || '"}' || chr(10) || '```'
                    WHEN 1 THEN '{"tags": ' || tg || ', "explanation": "' || ex || '"}'
                    WHEN 2 THEN '{"tags": ' || tg || ', "explanation": ""}'
                    WHEN 3 THEN '{"tags": ["Loud"], "explanation": "  none  "}'
                    WHEN 4 THEN 'I think ' || tg
                    WHEN 5 THEN '[' || tg || ']'
                    WHEN 6 THEN chr(10) || '```json' || chr(10) || '{"tags": ' || tg || ', "explanation": "' || ex
                                || chr(92) || 'n"}' || chr(10) || '```'
                    ELSE '{"tags": ' || tg || ', "explanation": 5}' END AS content
  FROM replies)"""

_VALID = "('High Energy', 'Low Energy', 'Positive', 'Negative', 'Calm Focus', 'Dramatic', 'Neutral')"
_STRIP = r"regexp_replace(%s, '^\s+|\s+$', '', 'g')"
REPLY_CTES = f"""j AS (SELECT q.question_id, q.text,
             CASE WHEN starts_with(r.c, '```')
                  THEN regexp_replace(regexp_replace(r.c, '^```\\w*\\n?', ''), '\\n?```\\s*$', '')
                  ELSE r.c END AS body
      FROM questions q JOIN (SELECT question_id, {_STRIP % "content"} AS c FROM replies2) r ON q.question_id = r.question_id),
k0 AS (SELECT *, coalesce(json_valid(body), false) AS ok_json FROM j),
k1 AS (SELECT *, CASE WHEN ok_json THEN body ELSE '0' END AS safe FROM k0),
k2 AS (SELECT *, ok_json AND json_type(safe) = 'OBJECT'
               AND coalesce(json_type(safe, '$.explanation'), 'NULL') IN ('NULL', 'VARCHAR') AS is_obj FROM k1),
k AS (SELECT question_id, text, is_obj, CASE WHEN is_obj THEN body ELSE '{{}}' END AS body FROM k2),
t AS (SELECT *,
        CASE WHEN NOT is_obj THEN NULL
             WHEN json_type(body, '$.tags') = 'ARRAY' THEN CAST(json_extract_string(body, '$.tags[*]') AS VARCHAR[])
             WHEN json_extract(body, '$.tags') IS NULL OR json_type(body, '$.tags') = 'NULL' THEN []::VARCHAR[]
             ELSE list_transform(string_split(json_extract_string(body, '$.tags'), ','), lambda x: trim(x)) END
          AS raw_tags FROM k),
v AS (SELECT *, list_filter(raw_tags, lambda x: x IN {_VALID}) AS kept FROM t),
rv AS (SELECT question_id,
       CASE WHEN is_obj THEN (CASE WHEN len(kept) > 0 THEN kept ELSE ['Neutral'] END) ELSE {RULE_TAGS} END AS req,
       CASE WHEN is_obj THEN {_STRIP % """CASE WHEN coalesce(json_extract_string(body, '$.explanation'), '') = ''
                                       THEN 'Songs matching your request.'
                                       ELSE json_extract_string(body, '$.explanation') END"""}
            ELSE {RULE_EXPL} END AS explanation
FROM v)"""

SQL["reply_validation"] = f"""WITH {QUESTIONS}, {REPLIES}, {REPLY_CTES}
SELECT question_id, array_to_string(req, '|') AS tags, explanation FROM rv"""

SQL["analyst_batch_replies"] = f"""WITH {PRED_TAGGED}, {QUESTIONS}, {REPLIES}, {REPLY_CTES},
s AS (SELECT rv.question_id, pt.song_id,
             sum(len(list_filter(rv.req, lambda x: list_contains(pt.tl, x)))) AS match_count
      FROM rv, pt GROUP BY rv.question_id, pt.song_id
      HAVING sum(len(list_filter(rv.req, lambda x: list_contains(pt.tl, x)))) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY match_count DESC, song_id) AS rank FROM s)
SELECT rv.question_id, CAST(r.rank AS BIGINT) AS rank, r.song_id, CAST(r.match_count AS BIGINT) AS match_count,
       rv.explanation,
       CASE WHEN r.song_id IS NULL THEN '(No songs matched the requested tags.)' END AS message
FROM rv LEFT JOIN (SELECT * FROM r WHERE rank <= 5) r ON rv.question_id = r.question_id"""


# ---------------------------------------------------------------- modelling
SPLIT = """('0x' || substr(md5(song_id), 1, 8))::BIGINT % 5 = 0 AS is_test,
       CAST(('0x' || substr(md5(song_id), 9, 8))::BIGINT % 5 AS BIGINT) AS fold"""

SQL["train_test_split"] = f"""WITH {PRED}
SELECT song_id, {SPLIT} FROM predictions"""

SQL["kfold_sizes"] = f"""WITH {PRED}, s AS (SELECT song_id, {SPLIT} FROM predictions)
SELECT fold, count(*) AS n_rows FROM s WHERE NOT is_test GROUP BY fold"""

MODELING = ENRICHED + ",\n" + LABELS_CLEAN + """,
modeling AS (SELECT e.*, l.arousal, l.valence FROM enriched e JOIN labels_ok l ON e.song_id = l.song_id)"""

SQL["validate_modeling_dataset"] = f"""WITH {MODELING},
st AS (SELECT count(*) AS n, (SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM modeling GROUP BY song_id)) AS dup
       FROM modeling)
{" UNION ALL ".join(_basic("modeling_dataset", "song_id"))}"""

SQL["validate_wrong_columns"] = f"""WITH {PRED},
st AS (SELECT count(*) AS n, (SELECT coalesce(sum(c - 1), 0) FROM (SELECT count(*) AS c FROM predictions GROUP BY song_id)) AS dup
       FROM predictions)
{" UNION ALL ".join(_basic("song_labels", "song_id"))}
UNION ALL SELECT 'song_labels', 'missing_columns', 'error', 2.0::DOUBLE, 'Missing columns: [''arousal'', ''valence'']'
UNION ALL SELECT 'song_labels', 'unexpected_columns', 'info', 2.0::DOUBLE,
                 'Unexpected columns: [''predicted_arousal'', ''predicted_valence'']'"""

_STD = ["spectral_centroid", "energy", "mfcc_coef1", "zcr", "auditory_band_variance", "tempo_bpm", "spectral_flux"]
SQL["standardize"] = f"""WITH {MODELING},
tr AS (SELECT * FROM modeling WHERE NOT (('0x' || substr(md5(song_id), 1, 8))::BIGINT % 5 = 0))
{" UNION ALL ".join(f"SELECT '{c}' AS feature, round(avg({c}), 9) AS mean, round(CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1.0 END, 9) AS std FROM tr" for c in _STD)}"""

SQL["median_impute"] = f"""WITH {MODELING}
{" UNION ALL ".join(f"SELECT '{c}' AS feature, round(coalesce(median(CASE WHEN isnan({c}) THEN NULL ELSE {c} END), 0.0), 9) AS median FROM modeling" for c in _MODEL)}"""

REG = """reg AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS y,
                     1200.0::DOUBLE + l_quantity * 950.0::DOUBLE + l_discount * (-2000.0)::DOUBLE
                     + l_tax * 1500.0::DOUBLE AS yhat FROM lineitem)"""

SQL["linear_score"] = f"""WITH {REG}
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(y, 9) AS y, round(yhat, 9) AS score FROM reg"""

SQL["regression_metrics"] = f"""WITH {REG},
m AS (SELECT count(*) AS n, sum((y - yhat) * (y - yhat)) AS sse, sum(y) AS sy, sum(y * y) AS syy,
             sum(yhat) AS sp, sum(yhat * yhat) AS spp, sum(y * yhat) AS syp FROM reg)
SELECT n, round(sqrt(sse / n), 6) AS rmse,
       round(CASE WHEN syy - sy * sy / n > 0 THEN 1 - sse / (syy - sy * sy / n)
                  WHEN sse = 0 THEN 1.0 ELSE 0.0 END, 6) AS r2,
       round((syp - sy * sp / n) / (sqrt(syy - sy * sy / n) * sqrt(spp - sp * sp / n)), 6) AS pearson_r
FROM m"""

# Ridge from moments, solved by Cramer's rule: columns x1 to x3 (standardised), penalty alpha.
_X = {"x1": "l_quantity", "x2": "l_discount", "x3": "l_tax"}
_PRICE = f"""price AS (SELECT CAST(l_orderkey % 5 AS INTEGER) AS fold, CAST(l_extendedprice AS DOUBLE) AS y,
                 {", ".join(f"CAST({c} AS DOUBLE) AS {x}" for x, c in _X.items())} FROM lineitem)"""


def _ridge(rows: str, key: str) -> str:
    """CTEs after ``rows``: ``solved`` holds per ``key`` and alpha the plain weights v1 to v3 and the intercept."""
    return f"""moments AS (SELECT {key}, count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3,
    stddev_pop(x1) AS s1, stddev_pop(x2) AS s2, stddev_pop(x3) AS s3, covar_pop(x1, x2) AS c12, covar_pop(x1, x3) AS c13,
    covar_pop(x2, x3) AS c23, covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2, covar_pop(x3, y) AS c3 FROM {rows} GROUP BY {key}),
scaled AS (SELECT *, 1 + alpha / n AS d, c12 / (s1 * s2) AS a, c13 / (s1 * s3) AS b, c23 / (s2 * s3) AS c,
    c1 / s1 AS q1, c2 / s2 AS q2, c3 / s3 AS q3 FROM moments, (VALUES (0.1::DOUBLE), (100.0), (10000.0)) AS p(alpha)),
dets AS (SELECT *, d * (d * d - c * c) - a * (a * d - c * b) + b * (a * c - d * b) AS det FROM scaled),
weights AS (SELECT *, (q1 * (d * d - c * c) - a * (q2 * d - c * q3) + b * (q2 * c - d * q3)) / det / s1 AS v1,
    (d * (q2 * d - c * q3) - q1 * (a * d - c * b) + b * (a * q3 - q2 * b)) / det / s2 AS v2,
    (d * (d * q3 - q2 * c) - a * (a * q3 - q2 * b) + q1 * (a * c - d * b)) / det / s3 AS v3 FROM dets),
solved AS (SELECT *, my - v1 * m1 - v2 * m2 - v3 * m3 AS intercept FROM weights)"""


_PAIRS = [(a, b) for i, a in enumerate([*_X, "y"]) for b in [*_X, "y"][i:]]
SQL["gram_moments"] = f"""WITH {_PRICE}
{" UNION ALL ".join(f"SELECT '{_X.get(a, a)}' AS a, '{_X.get(b, b)}' AS b, round(covar_pop({a}, {b}), 6) AS co_moment, count(*) AS n FROM price" for a, b in _PAIRS)}"""

SQL["ridge_coefficients"] = f"""WITH {_PRICE}, every AS (SELECT 0 AS one, * FROM price), {_ridge("every", "one")}
{" UNION ALL ".join(f"SELECT alpha, '{c}' AS feature, round(v{x[1]}, 5) AS weight FROM solved" for x, c in _X.items())}"""

SQL["cv_fold_rmse"] = f"""WITH {_PRICE},
others AS (SELECT f.fold AS held, price.* FROM price JOIN (SELECT DISTINCT fold FROM price) f ON price.fold <> f.fold),
{_ridge("others", "held")}
SELECT CAST(held AS BIGINT) AS fold, alpha, round(sqrt(avg(pow(p.y - intercept - v1 * x1 - v2 * x2 - v3 * x3, 2))), 6) AS rmse, count(*) AS n_held
FROM solved JOIN price p ON p.fold = held GROUP BY held, alpha"""

# A node table walked node by node.
_NODES = [(0, 0, 0, 25.0, 1, 2, 0.0), (0, 1, 1, 0.05, 3, 4, 0.0), (0, 2, 2, 0.02, 5, 6, 0.0), (0, 3, -1, 0.0, 0, 0, -310.25),
          (0, 4, -1, 0.0, 0, 0, -95.5), (0, 5, 0, 40.0, 7, 8, 0.0), (0, 6, -1, 0.0, 0, 0, 410.75), (0, 7, -1, 0.0, 0, 0, 120.0),
          (0, 8, -1, 0.0, 0, 0, 333.125), (1, 0, 1, 0.03, 1, 2, 0.0), (1, 1, -1, 0.0, 0, 0, 20.5), (1, 2, 2, 0.04, 3, 4, 0.0),
          (1, 3, -1, 0.0, 0, 0, -7.75), (1, 4, -1, 0.0, 0, 0, 64.0), (2, 0, -1, 0.0, 0, 0, 0.5)]

SQL["tree_score"] = f"""WITH RECURSIVE
nodes(tree, node, feature, threshold, l, r, value) AS (VALUES {", ".join(f"({t}, {n}, {f}, {x}::DOUBLE, {a}, {b}, {v}::DOUBLE)" for t, n, f, x, a, b, v in _NODES)}),
li AS (SELECT row_number() OVER () AS id, l_orderkey, l_linenumber, [l_quantity::DOUBLE, l_discount::DOUBLE, l_tax::DOUBLE] AS x FROM lineitem),
walk AS (
  SELECT id, l_orderkey, l_linenumber, x, n.* FROM li, nodes n WHERE n.node = 0
  UNION ALL
  SELECT id, l_orderkey, l_linenumber, x, n.* FROM walk w JOIN nodes n
  ON n.tree = w.tree AND n.node = CASE WHEN w.x[w.feature + 1] <= w.threshold THEN w.l ELSE w.r END WHERE w.feature >= 0)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(1200.5::DOUBLE + sum(value), 9) AS score
FROM walk WHERE feature < 0 GROUP BY id, l_orderkey, l_linenumber"""


def _first_cut(columns: list[tuple[str, list[str]]], target: str, alpha: float, lam: float) -> str:
    def score(g: str, h: str) -> str:
        return f"power(greatest(abs({g}) - {alpha}::DOUBLE, 0), 2) / ({h} + {lam}::DOUBLE)"
    bins = " UNION ALL ".join(
        f"SELECT {i} AS c, '{f}' AS feature, {' + '.join(f'CAST({f} > {e}::DOUBLE AS INTEGER)' for e in edges)} AS bin, g FROM grad"
        for i, (f, edges) in enumerate(columns))
    return f"""WITH grad AS (SELECT *, (SELECT avg({target}::DOUBLE) FROM lineitem) - {target}::DOUBLE AS g FROM lineitem),
rows AS ({bins}),
per AS (SELECT c, feature, bin, count(*) AS n, sum(g) AS sg, sum(g * g) AS gg FROM rows GROUP BY c, feature, bin),
run AS (SELECT *, sum(sg) OVER (PARTITION BY c ORDER BY bin) AS gl, sum(n) OVER (PARTITION BY c ORDER BY bin) AS hl,
               sum(sg) OVER (PARTITION BY c) AS g, sum(n) OVER (PARTITION BY c) AS h, sum(gg) OVER (PARTITION BY c) AS all_gg FROM per),
gains AS (SELECT *, CASE WHEN hl < h THEN ({score("gl", "hl")} + {score("(g - gl)", "(h - hl)")} - {score("g", "h")}) / all_gg END AS share FROM run)
SELECT feature, CAST(bin AS BIGINT) AS bin, CAST(n AS BIGINT) AS n, round(sg / n, 6) AS g_mean, round(share, 9) AS gain_share,
       row_number() OVER (ORDER BY round(share, 9) DESC NULLS LAST, c, bin) = 1 AS best FROM gains"""


SQL["tree_first_cut"] = _first_cut(
    [("l_quantity", [f"{5.0 * i}" for i in range(1, 10)]), ("l_discount", [repr(0.01 * i) for i in range(10)]),
     ("l_tax", [repr(0.01 * i) for i in range(8)])], "l_extendedprice", 0.1, 1.0)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
