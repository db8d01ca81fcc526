"""Command line on a predictions table written from the smallest benchmark binding."""

import os
import tempfile

from conftest import SF001
from songemo import cli
from songemo.sources import bindings as B


def test_cli_ask_and_tags(spark, capsys):
    d = tempfile.mkdtemp(prefix="songemo-cli-")
    path = os.path.join(d, "emotion_predictions")
    B.predictions(spark, SF001).write.parquet(path)
    assert cli.main(["ask", "Find", "calm", "music", "--predictions", path, "-k", "3"]) == 0
    out = capsys.readouterr().out.splitlines()
    assert out[0] == "Songs matching: Calm Focus (rule-based)."
    assert len([x for x in out[2:] if x]) == 3
    assert cli.main(["tags", "--predictions", path]) == 0
    out = capsys.readouterr().out
    assert "  Calm Focus: " in out and "first 5 'Calm Focus'" in out
