"""Training and scoring steps of the language model reuse the memory of the steps before them."""

import subprocess
import sys
from pathlib import Path

STEPS = """
import resource
import numpy as np
from braidwork.llm import attention_lm
from braidwork.llm.common import roomy

roomy()
rng = np.random.default_rng(0)
classes = rng.integers(0, 91, 50258)
classes[0] = 90
network = attention_lm.Network(classes, 40, rng.integers(0, 6100, 50258)).ready()
windows, faults = rng.integers(0, 50257, (64, 49)), []
for _ in range(12):
    network.slopes(windows[:, :-1], windows[:, 1:], np.ones((64, 48), bool))
    network.chances(windows[:, :-1], windows[:, 13:], 12)
    faults.append(resource.getrusage(resource.RUSAGE_SELF).ru_minflt)
print((faults[-1] - faults[-9]) // 8)
"""


def test_steps_reuse_memory():
    run = subprocess.run([sys.executable, "-c", STEPS], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    # without roomy() a step cost 2,766 page faults
    assert int(run.stdout.split()[-1]) < 100
