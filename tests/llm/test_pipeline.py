"""The pipeline, stage by stage, against plain re-computations of each stage on its input."""

import random

import corpus_pipeline
from framewright.llm import decontaminate, toxicity

from .test_decontaminate import plain as plain_contamination
from .test_packing import check
from .test_simhash import plain_fingerprint
from .helpers import plain_components, sentence
from .test_suffix import plain_words

SF = "/root/testdata/sf0.001"


def test_stages_do_what_they_decide(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before, after = docs.columns, docs.collect(), None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        ids = {r["doc_id"] for r in after}
        if name == "toxicity":
            model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), toxicity.learnable(spark.read.parquet(f"{SF}/labels.parquet")))
            score = model.scorer()
            assert ids == {r["doc_id"] for r in before if score(r["text"])[0] < 0.3}
        elif name == "simhash_near_dedup":
            fp = {r["doc_id"]: plain_fingerprint(r["text"]) for r in before}
            comp = plain_components(set(fp.values()), lambda a, b: (a ^ b).bit_count() <= 4)
            least = {}
            for i in sorted(fp, reverse=True):
                least[comp[fp[i]]] = i
            assert ids == set(least.values())
        elif name == "suffix_array_dedup":
            assert ids == {r["doc_id"] for r in before}
            want = dict(zip((r["doc_id"] for r in before), plain_words([r["text"] for r in before], 51)))
            assert {r["doc_id"]: r["text"] for r in after} == want
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "decontamination":
            items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            bad = {r[0] for r in plain_contamination([(r["doc_id"], r["text"]) for r in before], items) if r[3] > 0}
            assert ids == {r["doc_id"] for r in before} - bad
        else:
            check([(r["doc_id"], r["text"]) for r in before], after)
        before = after
    assert all(r["length"] > 0 for r in after)


def test_planted_cases_go(spark):
    """A passage of one benchmark item, a passage of 51 short words in two documents; what has neither stays as it is."""
    rng = random.Random(3)
    item = sentence(rng, 30)
    shared = " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + str(k % 7) for k in range(51))
    assert len(shared) < 200
    texts = [sentence(rng, 80) for _ in range(6)]
    words = texts[1].split()
    rows = [(0, f"{texts[0]} {item} end"), (1, " ".join([*words[:20], shared, *words[20:]])), (2, f"{shared}\n{texts[2]}"), (3, texts[3]), (4, texts[4] + " " + shared.rsplit(" ", 1)[0]), (5, texts[5])]
    docs = spark.createDataFrame([(k, t, len(t)) for k, t in rows], "doc_id long, text string, n_chars long")
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.strip_repeats(spark, docs, SF).collect()}
    assert left == {0: rows[0][1], 1: texts[1], 2: texts[2], 3: texts[3], 4: rows[4][1], 5: texts[5]}
    benchmark = spark.createDataFrame([(1, item), (2, sentence(rng, 12) + " elsewhere")], "item_id long, text string")
    assert {r["doc_id"] for r in decontaminate.screen(docs, benchmark, min_items=1).collect()} == {1, 2, 3, 4, 5}
