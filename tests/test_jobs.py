import json
import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "jobs"))

import compare as compare_job  # noqa: E402
import transform as transform_job  # noqa: E402

from tests.fixtures import DEPOT_RECORDS, create_snapshot  # noqa: E402


def test_transform_and_compare_clis(spark, scratch, capsys):
    snapshot = create_snapshot(os.path.join(scratch, "snap"))
    first, second = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    assert transform_job.main(["--snapshot", snapshot, "--output", first, "--env", "UAT",
                               "--database-pattern", "^depot$", "--max-file-size", "1k"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["mcps"] == DEPOT_RECORDS
    assert transform_job.main(["--snapshot", snapshot, "--output", second, "--env", "PROD",
                               "--database-pattern", "^depot$", "--single-file"]) == 0
    capsys.readouterr()
    report = os.path.join(scratch, "report")
    assert compare_job.main(["--baseline", first, "--candidate", first, "--exact"]) == 0
    assert "equal=True" in capsys.readouterr().out
    # Different environment: every dataset URN differs.
    assert compare_job.main(["--baseline", first, "--candidate", second, "--report", report]) == 1
    out = capsys.readouterr().out
    assert "equal=False" in out
    summary = json.load(open(os.path.join(report, "summary.json")))
    assert summary["missing_in_candidate"] == summary["extra_in_candidate"] > 0
    assert compare_job.main(["--baseline", os.path.join(scratch, "nope"), "--candidate", first]) == 2
