"""What Python workers still hold once a stage is over."""

import subprocess
import sys
from pathlib import Path

# MB; a fresh worker holds about 60.
LIMIT_MB = 85
# A session of its own: workers that other tests have used hold what those left.
SCRIPT = r'''
import re, time
from pathlib import Path

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from earshot.llm import bpe
from earshot.session import local_session

spark = local_session(2, "earshot-test-memory")
word = lambda k: F.concat(F.lit("Word"), (F.col("id") * 7 + k * k) % 3_000)
text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(400)), word), " ")
documents = spark.range(0, 10_000, 1, 2).select(F.col("id").alias("doc_id"), text.alias("text"))
encoded = bpe.encode_documents(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)
assert encoded.agg(F.sum("n_tokens")).first()[0] > 8_000_000


def held(batches):
    for batch in batches:
        time.sleep(2)  # so that no worker does two of the tasks
        said = Path("/proc/self/smaps_rollup").read_text()
        yield pa.RecordBatch.from_arrays([pa.array([int(re.search(r"\nPss_Anon:\s+(\d+)", said)[1]) // 1024])], ["mb"])


print("held", max(r.mb for r in spark.range(0, 2, 1, 2).mapInArrow(held, "mb long").collect()))
'''


def test_workers_give_back_what_the_tokens_stage_took():
    top = str(Path(__file__).resolve().parents[2])
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=top, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.split("held ")[1]) < LIMIT_MB
