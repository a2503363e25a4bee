import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from duelframe.__main__ import main

REPO = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("pipeline_stays", [True, False])
def test_queries_without_the_corpus_operators(tmp_path, pipeline_stays):
    """The rest of the repository works when they are taken out, whether corpus_pipeline.py goes too or not."""
    for name in ("__spark_entry__.py", "bench.py") + ("corpus_pipeline.py",) * pipeline_stays:
        if (REPO / name).exists():
            shutil.copy(REPO / name, tmp_path)
    shutil.copytree(REPO / "duelframe", tmp_path / "duelframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copytree(REPO / "tests", tmp_path / "tests", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'battles' in q and set(o) <= set(q) and not any(k.startswith('op') or k == 'pipeline' for k in q); print(len(q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, env=env)
    assert said.returncode == 0, said.stderr
    if not pipeline_stays:  # and its other tests pass there
        run = [sys.executable, "-B", "-m", "pytest", "-x", "-q", "-p", "no:cacheprovider", "tests/test_functions.py"]
        said = subprocess.run(run, cwd=tmp_path, capture_output=True, text=True, env=env)
        assert said.returncode == 0, said.stdout[-2000:]


def test_other_import_errors_show(tmp_path):
    """Only a missing package takes its queries out."""
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    shutil.copytree(REPO / "duelframe", tmp_path / "duelframe", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    (tmp_path / "duelframe/llm").mkdir()
    (tmp_path / "duelframe/llm/__init__.py").write_text("")
    (tmp_path / "corpus_pipeline.py").write_text("import a_package_that_is_not_installed")
    said = subprocess.run([sys.executable, "-B", "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode and "a_package_that_is_not_installed" in said.stderr


def test_entry(spark):
    import __spark_entry__ as e

    rows = e.entry(spark)
    assert rows.count() > 0 and "matchup" in rows.columns
    assert set(e.oracle_sql()) <= set(e.queries())


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "youtube_videos.json").write_text(json.dumps([{"id": "a", "title": "Top - Flip vs Y", "upload_date": "2019-01-01T00:00:00Z", "duration": "PT1S", "url": "u"}]))
    (tmp_path / "matchup_events_metadata.csv").write_text("matchup,event_name,event_description,video_id\n")
    (tmp_path / "names.json").write_text('{"Y": "Why"}')
    assert main(["battles", "--raw", str(tmp_path), "--output", f"{tmp_path}/b", "--league", "Top", "--rename-map", f"{tmp_path}/names.json"], spark) == 0
    assert spark.read.csv(f"{tmp_path}/b", header=True).first().matchup == "Flip vs Why"
    assert main(["emcees", "--raw", str(tmp_path), "--output", f"{tmp_path}/e", "--league", "Top"], spark) == 0
    assert [tuple(r) for r in spark.read.csv(f"{tmp_path}/e", header=True).collect()] == [("1", "Flipzydot1"), ("2", "Y")]
    with pytest.raises(SystemExit):
        main(["events", "--start", "2021", "--end", "2020", "--base", "http://x"], spark)
    with pytest.raises(SystemExit):
        main(["battles", "--output", "x", "--format", "xml"], spark)
    (tmp_path / "names.json").write_text("[]")
    assert main(["emcees", "--raw", str(tmp_path), "--output", f"{tmp_path}/f", "--rename-map", f"{tmp_path}/names.json"], spark) == 1
    assert "JSON object" in capsys.readouterr().err
