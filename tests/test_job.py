import uuid

import pytest

from talkmill.operators.records import run_stats
from talkmill.plans.generation import GenerationConfig, dry_run_table
from talkmill.plans.job import run
from talkmill.session import checkpoint_dir

DOCS = "/root/testdata/sf0.001/documents.parquet"


def test_dry_run_job(spark):
    out = f"{checkpoint_dir(spark)}/job-{uuid.uuid4().hex}"
    stats = run(["--dataset-dir", DOCS, "--output", out, "--dry-run"])
    assert stats == run_stats(dry_run_table(spark, DOCS, GenerationConfig())).first().asDict()
    assert spark.read.json(out).count() == stats["conversations_kept"]
    with pytest.raises(FileExistsError):
        run(["--dataset-dir", DOCS, "--output", out, "--dry-run"])
    again = run(["--dataset-dir", DOCS, "--output", out, "--dry-run", "--overwrite",
                 "--prompt-style", "debate", "--max-samples", "5"])
    assert again["samples_seen"] == 5 and again["chunks_generated"] * 1 == \
        again["conversations_kept"] + again["conversations_filtered"]


def test_job_validates_before_output(spark):
    out = f"{checkpoint_dir(spark)}/job-{uuid.uuid4().hex}"
    with pytest.raises(ValueError):
        run(["--dataset-dir", DOCS, "--output", out, "--dry-run", "--prompt-style", "nope"])
    with pytest.raises(ValueError):
        run(["--dataset-dir", DOCS, "--output", out, "--chunk-size", "10", "--chunk-overlap", "10",
             "--dry-run"])
    with pytest.raises(ValueError):
        run(["--dataset-dir", DOCS, "--output", out])


def test_client_job(spark):
    out = f"{checkpoint_dir(spark)}/job-{uuid.uuid4().hex}"
    stats = run(["--dataset-dir", DOCS, "--output", out, "--client",
                 "talkmill.plans.echo_client:echo_client_factory", "--max-attempts", "1",
                 "--prompt-style", "interview"])
    assert stats["conversations_failed"] > 0
    assert stats["conversations_kept"] + stats["conversations_filtered"] + \
        stats["conversations_failed"] + stats["conversations_empty"] == stats["chunks_generated"]
