"""The sketch / bucket code paths used at scale, checked against SQL on real data.

With a direct limit of 40 every group above 40 values takes the distributed path
(bucketed prefix sums for quantiles, ranks and AUC; ranges for ties at a cut)."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_oracles_hold_on_the_scale_paths():
    names = ["sample_weight", "period_threshold_flag", "yearly_features", "risk_percentile", "flag_top_quartile",
             "roc_auc", "score_distribution", "calibration_deciles", "roc_points", "monthly_features"]
    out = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "oracle_check.py"), "--direct-limit", "40", *names],
                         capture_output=True, text=True, timeout=1500)
    assert out.returncode == 0, out.stdout[-3000:]
    assert out.stdout.count(" OK ") == len(names)
