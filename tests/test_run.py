import pytest

from framewright.operators import infer, report
from framewright.plans.run import run_all


class Flaky(infer.StubBackend):
    """Fails on one path the first time it is asked for it in a task."""

    def __init__(self):
        self.seen = set()

    def ask(self, prompt, item, max_tokens):
        if item["path"] == "never":
            raise ValueError("always fails")
        return super().ask(prompt, item, max_tokens)


def test_all_stages_and_resume(spark, tmp_path):
    rows = [(k, 0, f"img{k}", f"a red car number {k}") for k in range(12)] + [(99, 0, "never", "x")]
    work = spark.createDataFrame(rows, "id long, shard int, path string, gt_caption string")
    sizes = spark.createDataFrame([(r[2], 640, 480) for r in rows], "path string, img_w int, img_h int")
    out = f"{tmp_path}/out"
    got = run_all(spark, work, sizes, out, backend=Flaky, workers=2)
    assert got["captions"].first()["n"] == 13 and got["captions"].first()["missing"] == 1
    n = sum(r["n"] for r in got["verdicts"].collect())
    assert n > 0 and "| verdict | n |" in report.markdown(got["verdicts"])
    with pytest.raises(TimeoutError):
        run_all(spark, work, sizes, out, backend=Flaky, workers=2, free=lambda: False, tries=2, every=0)
    again = run_all(spark, work, sizes, out, backend=Flaky, workers=2)  # nothing is asked twice
    assert sum(r["n"] for r in again["verdicts"].collect()) == n
    log = spark.read.parquet(f"{out}/caption")
    assert log.where("path = 'img3'").count() == 1 and log.where("path = 'never'").count() == 6
