"""File-edge fixtures: frame CSVs by header name, static and dynamic annotations."""

import os
import tempfile

import pytest

from songemo.operators import features as FT
from songemo.sources import annotations, frames_csv

C = "pcm_fftMag_spectralCentroid_sma_amean"
E = "pcm_RMSenergy_sma_amean"
B0, B1, B2 = (f"audSpec_Rfilt_sma[{i}]_amean" for i in range(3))
B26 = "audSpec_Rfilt_sma[26]_amean"


def _write(d, name, text):
    p = os.path.join(d, name)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w") as f:
        f.write(text)
    return p


@pytest.fixture(scope="module")
def frame_dir():
    d = tempfile.mkdtemp(prefix="songemo-f1-")
    _write(d, "10.csv", f"frameTime;{C};{E};{B0};{B1};{B2}\n0;100;1;1;2;4\n1;;3;1;2;4\n2;300;5;1;2;4\n")
    _write(d, "11.csv", f"{E};frameTime;{C}\n7;0;10\n9;1;30\n")           # other column order
    _write(d, "12.csv", f"frameTime;{E}\n0;2\n")                           # centroid missing
    _write(d, "13.csv", f"frameTime;{C};{E}\n")                            # header only
    _write(d, "14.csv", "")                                                # zero bytes
    _write(d, "15.csv", f"{B0};{B26}\n5;100\n7;300\n")                     # one band (+ ignored 26)
    _write(d, "a.b.csv", f"{C}\nabc\n4\n")                                 # non-numeric cell
    return d


def test_frames_by_header_name(spark, frame_dir):
    frames = frames_csv.scan_frames(spark, frame_dir)
    sf = {r.song_id: r for r in FT.song_features(frames, rich=True).collect()}
    assert set(sf) == {"10", "11", "12", "13", "15", "a.b"}
    assert sf["10"].spectral_centroid == 200.0 and sf["10"].energy == 3.0
    assert sf["10"].auditory_band_variance == pytest.approx(7 / 3)
    assert sf["11"].spectral_centroid == 20.0 and sf["11"].energy == 8.0
    assert sf["12"].spectral_centroid is None and sf["12"].energy == 2.0
    assert sf["13"].spectral_centroid is None and sf["13"].energy is None
    assert sf["15"].auditory_band_variance is None  # a single band has no variance
    assert sf["a.b"].spectral_centroid == 4.0
    mini = FT.song_features(frames, rich=False)
    assert mini.columns == ["song_id", "tempo", "spectral_centroid", "energy", "mfcc_coef1",
                            "auditory_band_variance"]


@pytest.fixture(scope="module")
def ann_dir():
    d = tempfile.mkdtemp(prefix="songemo-f2-")
    s = os.path.join("annotations averaged per song", "song_level")
    _write(d, os.path.join(s, "static_annotations_averaged_songs_1_2000.csv"),
           "song_id; arousal_mean; valence_mean\n2;x;5\n3;4.5;6\n")
    _write(d, os.path.join(s, "static_annotations_averaged_songs_2000_2058.csv"),
           "song_id,arousal_mean,valence_mean\n2,4.0,5.0\n2,9.0,9.0\n 4 ,1,2\n")
    _write(d, os.path.join(s, "static_annotations_averaged_songs_3.csv"), "song_id;arousal\n9;1\n")
    dy = os.path.join("annotations averaged per song", "dynamic (per second annotations)")
    _write(d, os.path.join(dy, "arousal.csv"), "time;2;3\n0;1;5\n1;3;\n")
    _write(d, os.path.join(dy, "valence.csv"), "time;3;2\n0;7;1\n1;9;2\n")
    return d


def test_static_keep_first_and_aliases(spark, ann_dir):
    got = {r.song_id: (r.arousal, r.valence) for r in annotations.static_labels(spark, ann_dir).collect()}
    assert got == {"2": (4.0, 5.0), "3": (4.5, 6.0), "4": (1.0, 2.0)}


def test_dynamic_columns_by_name(spark, ann_dir):
    got = {r.song_id: (r.arousal, r.valence) for r in annotations.dynamic_labels(spark, ann_dir).collect()}
    assert got == {"2": (2.0, 1.5), "3": (5.0, 8.0)}


def test_dynamic_rows_and_fallback(spark):
    d = tempfile.mkdtemp(prefix="songemo-f3-")
    dy = os.path.join("annotations averaged per song", "dynamic (per second annotations)")
    _write(d, os.path.join(dy, "arousal.csv"), "song_id;t1;t2\n1;1;3\n2;5;\n4;1;1\n")
    _write(d, os.path.join(dy, "valence.csv"), "song_id;t1;t2\n2;2;4\n1;6;8\n")
    got = {r.song_id: (r.arousal, r.valence) for r in annotations.load_labels(spark, d).collect()}
    assert got == {"1": (2.0, 7.0), "2": (5.0, 3.0)}
    d2 = tempfile.mkdtemp(prefix="songemo-f3b-")
    _write(d2, os.path.join(dy, "arousal.csv"), "time;a;b\n0;1;5\n1;3;7\n")
    _write(d2, os.path.join(dy, "valence.csv"), "time;x;y\n0;2;4\n1;4;6\n")
    got2 = {r.song_id: (r.arousal, r.valence) for r in annotations.dynamic_labels(spark, d2).collect()}
    assert got2 == {"a": (2.0, 3.0), "b": (6.0, 5.0)}   # matched by position
    with pytest.raises(FileNotFoundError):
        annotations.load_labels(spark, tempfile.mkdtemp(prefix="songemo-none-"))


def test_bom_and_quotes(spark):
    d = tempfile.mkdtemp(prefix="songemo-bom-")
    s = os.path.join("annotations averaged per song", "song_level")
    _write(d, os.path.join(s, "static_annotations_averaged_songs_1.csv"),
           '﻿"song_id","arousal","valence"\n"5","3.5","6"\n')
    got = {r.song_id: (r.arousal, r.valence) for r in annotations.static_labels(spark, d).collect()}
    assert got == {"5": (3.5, 6.0)}


def _annotations(tmp_path, static=True, dynamic=True):
    import os
    from songemo.sources import annotations as an
    root = str(tmp_path / "an notations")
    if static:
        os.makedirs(f"{root}/{an.SONG_LEVEL_SUBDIR}")
        with open(f"{root}/{an.SONG_LEVEL_SUBDIR}/static_annotations_averaged_songs_1.csv", "w") as f:
            f.write('note;song_id;arousal_mean;valence_mean\n"a;b ""c""";1;5;4\nplain;2;3;2.5\n;3;1;1\n')
    if dynamic:
        os.makedirs(f"{root}/{an.DYNAMIC_SUBDIR}")
        for n, text in (("arousal", "time,1,2\n0.5,1,2\n"), ("valence", "time,1\n0.5,1\n")):       # these do not match
            with open(f"{root}/{an.DYNAMIC_SUBDIR}/{n}.csv", "w") as f:
                f.write(text)
    return root


def test_quoted_cells_and_static_labels_first(spark, tmp_path):
    from songemo.sources import annotations as an
    root = _annotations(tmp_path)
    want = {("1", 5.0, 4.0), ("2", 3.0, 2.5), ("3", 1.0, 1.0)}
    for path in (root, root + "/", "file://" + root.replace(" ", "%20")):
        rows = an.load_labels(spark, path.replace("%20", " ")).select("song_id", "arousal", "valence").collect()
        assert {tuple(r) for r in rows} == want


def test_mismatched_dynamic_files_fail_only_when_used(spark, tmp_path):
    import pytest
    from songemo.sources import annotations as an
    with pytest.raises(ValueError):
        an.load_labels(spark, _annotations(tmp_path, static=False)).collect()
    with pytest.raises(FileNotFoundError):
        an.load_labels(spark, str(tmp_path / "nothing"))


def test_split_cells(spark):
    from pyspark.sql import functions as F
    from songemo.sources.text_tables import _split
    lines = ['a;b', 'a;b;', ';', '"x;y";z', '"x;y";', '"q ""r"";";1;"2"', 'a"b;c', '"open;1']
    got = [r.c for r in spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, v string").orderBy("i").select(
        _split(F.col("v"), F.lit(";")).alias("c")).collect()]
    assert got == [["a", "b"], ["a", "b", ""], ["", ""], ['"x;y"', "z"], ['"x;y"', ""], ['"q ""r"";"', "1", '"2"'],
                   ['a"b', "c"], ['"open', "1"]]


def test_wide_dynamic_matrix_keeps_every_column(spark, tmp_path):
    from songemo.sources import annotations as an
    h = spark.createDataFrame([("p", ["t"] + [f"c{i}" for i in range(5)])], "path string, names array<string>")
    d = spark.createDataFrame([("p", 1, ["0"] + [str(i) for i in range(5)])], "path string, line_key int, cells array<string>")
    got = an._long(h, d).orderBy("pos").select("pos", "name", "value").collect()
    assert [tuple(r) for r in got] == [(i + 1, f"c{i}", float(i)) for i in range(5)]


def test_headers_in_groups(spark, tmp_path, monkeypatch):
    """Files of several headers, a name with glob characters, quotes, blank lines, header-only and empty files: both ways agree."""
    from songemo.sources import text_tables as t
    files = {"1.csv": "a;b;c\n1;2;3\n\n4;x;6\n", "2.csv": "c;b;a\n3;2;1\n", "3.csv": "a;b;c\n", "4.csv": "",
             "5 [x].csv": "c;b;a\n30;\"20\";10\n", "6.csv": "\ufeffb;a\n7;8\n9\n", "7.csv": "a;a;b;\"n;o\"\n1;2;3;4\n", "8.csv": "z\n1\n",
             "9.csv": "a;b;c\r\n5;6;7\r\n   \n"}
    for n, text in files.items():
        (tmp_path / n).write_text(text, encoding="utf-8", newline="")
    got = []
    for limit in (64, 0):
        monkeypatch.setattr(t, "GROUPS", limit)
        df = t.read_by_header(spark, f"{tmp_path}/*.csv", ["a", "b", "c"])
        got.append(sorted((tuple(r) for r in df.select("song_id", "a", "b", "c").collect()), key=str))
        plan = df._jdf.queryExecution().analyzed().toString()
        assert ("Join" in plan) == (limit == 0)
    assert got[0] == got[1] and len(got[0]) == 10
    assert {r for r in got[0] if r[0] in ("2", "6")} == {("2", 1.0, 2.0, 3.0), ("6", 8.0, 7.0, None), ("6", None, 9.0, None)}
    assert [r for r in got[0] if r[0] == "3"] == [("3", None, None, None)]
    assert [r[1:] for r in got[0] if r[0].startswith("5")] == [(10.0, 20.0, 30.0)]


def test_very_wide_file(spark, tmp_path):
    from songemo.sources import text_tables as t
    n = 100_000
    (tmp_path / "w.csv").write_text(";".join(f"c{i}" for i in range(n)) + "\n" + ";".join(str(i) for i in range(n)) + "\n")
    assert tuple(t.read_by_header(spark, f"{tmp_path}/*.csv", ["c99999", "c7"]).select("c99999", "c7").first()) == (99999.0, 7.0)
