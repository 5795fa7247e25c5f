"""Uploads as a stream: each file is checked on its own, epochs are idempotent."""

import os

from strata.streaming import uploads as U


def test_upload_stream(spark, scratch):
    inbox = os.path.join(scratch, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "good.csv"), "w") as f:
        f.write("t|d|l|p\n1|time|Day|Ad Week\n1|time|Ad Week|Ad Year\n")
    with open(os.path.join(inbox, "bad.csv"), "w") as f:
        f.write("t|d|l|p\n1|time|Day|Ad Week\n1|time|Ad Week|Day\n")
    out = os.path.join(scratch, "out")
    q = U.start_upload_checks(spark, inbox, out, os.path.join(scratch, "chk"))
    q.awaitTermination(300)
    rows = spark.read.parquet(out).collect()
    got = {(os.path.basename(r.upload), r.dimension_id): r.answer for r in rows}
    assert got == {("good.csv", "time"): "The dimension is valid.",
                   ("bad.csv", "time"): "The dimension is not valid."}
