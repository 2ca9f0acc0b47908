"""What a round of the connected components costs the executors, and what a worker keeps of its memory."""

import os
import platform
import random
import subprocess
import sys

import pytest

from stratalog.llm._components import components

NODE = "struct<id: long, tag: long>"


def test_rounds_take_few_tasks_and_find_the_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 400)] + [(rng.randrange(500, 900), rng.randrange(500, 900)) for _ in range(200)] + [(7, 7), (3, 2), (3, 2)]
    tag = {k: rng.randrange(-(1 << 62), 1 << 62) for k in range(1000)}
    least = {k: k for e in edges for k in e if e[0] != e[1]}
    while any(least[a] != least[b] for a, b in edges if a != b):
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    df = spark.createDataFrame([((a, tag[a]), (b, tag[b])) for a, b in edges], f"a {NODE}, b {NODE}")
    context = spark.sparkContext
    context.setJobGroup("rounds", "rounds")
    try:
        got = components(df).collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert sorted((tuple(r.id), tuple(r.component)) for r in got) == sorted(((k, tag[k]), (m, tag[m])) for k, m in least.items())
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("rounds") for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))
    assert tasks < 80, tasks


@pytest.mark.skipif(platform.libc_ver()[0] != "glibc", reason="reads what glibc holds")
def test_a_worker_gives_back_what_a_group_took():
    code = """
import re
from stratalog.functions.shared import lean

def anon():
    return int(re.search(r"Pss_Anon: +([0-9]+)", open("/proc/self/smaps_rollup").read())[1]) // 1024

def work(key, table):
    parts = [bytearray(b"x" * 60_000) for _ in range(3_000)]
    return parts[-1]  # the last lies above the others, which glibc would hold

before = anon()
out = lean(work)(None, None)
print(anon() - before)
"""
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=os.environ | {"PYTHONPATH": os.getcwd()}, timeout=100)
    assert int(run.stdout) < 60, (run.stdout, run.stderr)
