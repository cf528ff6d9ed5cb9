"""The library without its training-data part."""

from __future__ import annotations

import shutil
import subprocess
import sys

from conftest import ROOT


def test_entry_points_without_the_training_part(tmp_path):
    copy = tmp_path / "copy"
    left_out = shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse", "llm")
    shutil.copytree(ROOT, copy, ignore=left_out)
    code = (
        "import __spark_entry__ as e; from lotwise.plans.registry import QUERIES; "
        "assert e.queries() == QUERIES and e.oracle_sql().keys() == QUERIES.keys(); print('whole')"
    )
    for pipeline in (True, False):
        if not pipeline:
            (copy / "corpus_pipeline.py").unlink()
        ran = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
        assert ran.stdout.strip() == "whole", ran.stderr
