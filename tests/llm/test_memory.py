"""Memory that a Python worker keeps between batches."""

import os
import subprocess
import sys

import pytest

PROGRAM = """
import ctypes, gc, random, re
import pyarrow as pa
import public_tokenizers
from treelens.llm import bpe_codec, line_blocks

def held():
    return int(re.search(r"Anonymous:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

rng = random.Random(3)
words = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 9))) for _ in range(200000)]
texts = pa.array([" ".join(rng.choice(words) for _ in range(60)) for _ in range(20000)])
of = {"bpe": bpe_codec._encoder(public_tokenizers.path("byte_bpe_50k.json")), "lines": lambda texts: sum(b.num_rows for b in line_blocks._line_rows(0.8)([batch]))}["KIND"]
batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), texts], names=["doc_id", "text"])
out = of(texts)
now = held()
gc.collect()
pa.default_memory_pool().release_unused()
ctypes.CDLL(None).malloc_trim(0)
print(now - held())
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
@pytest.mark.parametrize("kind", ["bpe", "lines"])
def test_workers_keep_no_freed_memory(kind):
    env = os.environ | {"PYTHONPATH": os.pathsep.join(p for p in sys.path if p)}
    done = subprocess.run([sys.executable, "-c", PROGRAM.replace("KIND", kind)], capture_output=True, text=True, env=env, timeout=300)
    assert done.returncode == 0, done.stderr
    kept = float(done.stdout)
    print(kind, kept)
    assert kept < 25
