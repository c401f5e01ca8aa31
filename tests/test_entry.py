"""The entry module without the optional part: its folders may be left out, in any mixture."""

from __future__ import annotations

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
OPTIONAL = ("quirelake/llm", "tests/llm", "corpus_pipeline.py")
LIST = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def names(folder) -> list[list[str]]:
    out = subprocess.run([sys.executable, "-W", "error", "-c", LIST], cwd=folder, capture_output=True, text=True, check=True)
    return json.loads(out.stdout)


def copy(target: Path, without: tuple[str, ...]) -> Path:
    left_out = {REPO / name for name in without}

    def skipped(folder, found):
        return [n for n in found if n in (".git", "__pycache__") or Path(folder, n) in left_out]

    shutil.copytree(REPO, target, ignore=skipped)
    return target


@pytest.mark.parametrize("without", [OPTIONAL, OPTIONAL[:2]])
def test_import_without_the_optional_folders(tmp_path, without):
    queries, checks = names(copy(tmp_path / "copy", without))
    assert not [n for n in queries if n.startswith("op") or n == "pipeline"]
    assert len(queries) >= 111 and set(checks) <= set(queries)
    assert "gold_kpi_category" in queries


def test_import_with_an_empty_folder_left_behind(tmp_path):
    folder = copy(tmp_path / "copy", OPTIONAL)
    (folder / "quirelake/llm/__pycache__").mkdir(parents=True)
    assert len(names(folder)[0]) >= 111


def test_a_missing_package_leaves_the_other_queries(tmp_path):
    """The optional part needs tokenizer files; without their package the rest still works, with a warning."""
    block = "import sys; sys.modules['public_tokenizers'] = None; "
    out = subprocess.run([sys.executable, "-c", block + LIST], cwd=REPO, capture_output=True, text=True, check=True)
    assert len(json.loads(out.stdout)[0]) >= 111 and "left out" in out.stderr
