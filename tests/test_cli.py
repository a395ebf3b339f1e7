"""The command line runs the shipped registries over the fixture drop."""

import json
import os
import shutil
import subprocess
import sys

from conftest import FIXTURES, ROOT


def test_cli_runs_shipped_steps(tmp_root):
    inp = os.path.join(tmp_root, "input")
    shutil.copytree(os.path.join(FIXTURES, "input"), inp)
    cat = os.path.join(tmp_root, "catalog.yaml")
    with open(cat, "w", encoding="utf-8") as fh:
        fh.write(f"static.parts: {{path: {FIXTURES}/static/parts.csv, format: csv, required: true, "
                 f"options: {{escape: '\"', multiLine: 'true'}}}}\n"
                 f"static.seen_parts: {{path: {tmp_root}/seen, versioned: true}}\n")
    out = subprocess.run([sys.executable, "-m", "dropgate", "--input", inp, "--root", f"{tmp_root}/out",
                          "--catalog", cat, "--run-id", "cli", "--master", "local[2]"],
                         cwd=ROOT, capture_output=True, text=True, timeout=900)
    lines = [json.loads(x) for x in out.stdout.splitlines() if x.startswith("{")]
    assert out.returncode == 0, out.stderr[-2000:]
    assert [x["step"] for x in lines] == ["check_input", "sort", "complete", "check_limits", "deliver"]
    assert lines[-1]["passed"] == 6
