"""Command-line entry points: measure writes the warehouse, validate reads it back."""

import os
import tempfile

import pytest

from liftkit.plans import cli

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables absent")
def test_measure_then_validate(spark, capsys):
    out = os.path.join(tempfile.mkdtemp(prefix="liftkit-cli-"), "out")
    cli.main(["measure", "--sf-dir", SF, "--database", "liftkit_cli_wh", "--out", out])
    text = capsys.readouterr().out
    assert "decision=" in text and "estimated_incremental_margin=" in text
    assert sorted(os.listdir(os.path.join(out, "warehouse"))) == sorted(
        ["decision_metrics", "experience_opportunity_scores", "marketing_experiment_panel", "neighborhood_demand_panel"])
    cli.main(["validate", "--sf-dir", SF, "--warehouse-path", os.path.join(out, "warehouse")])
    text = capsys.readouterr().out
    assert "table marketing_experiment_panel: 150" in text and "validation_status=" in text
