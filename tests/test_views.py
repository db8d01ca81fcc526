"""Emotion-map views on a hand-made table with known answers."""

import pytest

from songemo.operators import views


@pytest.fixture(scope="module")
def table(spark):
    rows = [("a", 2.0, 2.0, "C", 70.0), ("b", 8.0, 8.0, None, 125.0), ("c", 5.0, 5.0, "D", None),
            ("d", 8.0, 2.0, "C", 80.0), ("e", float("nan"), 4.0, "E", 160.0), ("f", 2.0, 8.0, "G", 119.9),
            ("g", 3.0625, 3.0625, "A", 20.0)]
    df = spark.createDataFrame(rows, "song_id string, predicted_arousal double, predicted_valence double, "
                                     "key_note string, tempo_bpm double")
    return views.with_tempo_bucket(df)


def test_extent_and_counts(table):
    e = views.extent(table).first()
    assert (e.arousal_min, e.arousal_max, e.valence_min, e.valence_max) == (2.0, 8.0, 2.0, 8.0)
    assert e.arousal_step == 0.06 and e.arousal_pad == pytest.approx(0.3) and e.arousal_mid == 5.0
    c = views.count_in_view(table, (2.0, 5.0), (2.0, 8.0)).first()
    assert (c.n_shown, c.n_total, c.text) == (4, 7, "Showing 4 of 7 songs")


def test_quadrants_and_colors(table):
    pts = {r.song_id: (r.quadrant, r.color_group) for r in views.map_points(table, "key_note").collect()}
    assert "e" not in pts                                # NaN point is not drawn
    assert pts["c"] == ("Happy / Euphoric", "D")         # on both midpoints -> high / high
    assert pts["a"] == ("Sad / Somber", "C")
    assert pts["d"] == ("Tense / Angry", "C")
    assert pts["f"] == ("Calm / Peaceful", "G")
    assert pts["b"][1] == "Unknown"
    groups = [(r.color_group, r.n_songs) for r in views.color_groups(table, "tempo_bucket").collect()]
    assert groups == [("Fast  (120–160 BPM)", 1), ("Mid   (80–120 BPM)", 2), ("Slow  (<80 BPM)", 2),
                      ("Unknown", 1), ("Very Fast  (160+ BPM)", 1)]
    none = {r.color_group for r in views.map_points(table, "genre").collect()}
    assert none == {None}                                # option not present -> no colouring


def test_song_table_rounding(table):
    t = {r.song_id: r for r in views.song_table(table).collect()}
    assert t["g"].predicted_arousal == 3.062             # half-even on 3.0625
    assert list(views.song_table(table).columns) == ["song_id", "predicted_arousal", "predicted_valence",
                                                     "key_note", "tempo_bpm", "tempo_bucket"]
