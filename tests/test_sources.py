"""Readers, sinks, streams and model stages on small files."""

import base64
import json
import struct
import threading
import urllib.error
import urllib.request

import pytest
from pyspark.sql import functions as F

from framewright import review
from framewright.functions import images
from framewright.functions import text as txt
from framewright.operators import calibrate, infer, reconcile
from framewright.plans import run
from framewright.sources import readers, schemas, writers
from framewright.streaming import incremental


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_worklist(spark, tmp_path):
    write(tmp_path / "part-7.tsv", ["a.jpg\ta cat\twith tab", "b.jpg", "c.jpg\t"])
    got = readers.worklist(spark, f"{tmp_path}/*.tsv").orderBy("id").collect()
    assert [tuple(r) for r in got] == [("a.jpg", "a cat\twith tab", 0, 7), ("b.jpg", "", 1, 7), ("c.jpg", "", 2, 7)]
    assert readers.worklist(spark, f"{tmp_path}/*.tsv", 2).count() == 2


def test_json_lines(spark, tmp_path):
    path = write(tmp_path / "shard0.jsonl", ['{"path": "a", "id": 1}', '{"path": "b", "id', '{"path": "c", "id": "x"}', "", '{"path": "d", "error": "E"}'])
    assert sorted(r["path"] for r in readers.json_lines(spark, path, schemas.CAPTION).collect()) == ["a", "c", "d"]
    assert tuple(readers.corrupt_count(spark, path, schemas.CAPTION).first()) == (4, 1)


def test_log_order_and_compaction(spark, tmp_path):
    write(tmp_path / "shard0.jsonl", ['{"path": "a", "id": 1, "error": "E"}', '{"path": "a", "id": 2}', '{"path": "b", "id": 3}', '{"path": "c", "id": 9, "error": "1"}'])
    write(tmp_path / "shard1.jsonl", ['{"path": "b", "id": 4, "error": "E"}', '{"path": "a", "id": 5}', '{"path": "c", "id": 8, "error": "2"}'])
    log = readers.log_lines(spark, f"{tmp_path}/*.jsonl", schemas.CAPTION)
    won = reconcile.compact(log, "path")
    assert {r["path"]: r["id"] for r in won.collect()} == {"a": 5, "b": 3, "c": 8}
    assert sorted(map(tuple, reconcile.compact(won, "path").select("path", "id").collect())) == sorted(map(tuple, won.select("path", "id").collect()))
    assert [r["path"] for r in reconcile.pending(log.select("path").distinct(), log, "path").collect()] == ["c"]


def test_groundings_keep_order_and_last_value(spark, tmp_path):
    path = write(tmp_path / "g.jsonl", ['{"id": 1, "shard": 0, "path": "p", "img_wh": [4, 5], "grounding": {"b": [[1, 2, 3, 4]], "a": [], "b": [[0, 0, 1, 1]]}}', '{"path": "q", "img_wh": null}'])
    rows = {r["path"]: r for r in readers.groundings(spark, path).collect()}
    assert [(g["phrase"], g["boxes"]) for g in rows["p"]["grounding"]] == [("b", [[0.0, 0.0, 1.0, 1.0]]), ("a", [])]
    assert (rows["q"]["img_w"], rows["q"]["img_h"]) == (0, 0)


def test_adjudication_and_prefilter(spark, tmp_path):
    doc = tmp_path / "adj.json"
    doc.write_text(json.dumps({"N_YES": 7, "N_NO": 3, "answers": [{"path": "p", "phrase": "x", "auto": "YES", "human": "NO", "crop_frac": 0.1}]}, indent=1))
    assert tuple(readers.adjudication(spark, str(doc)).first())[:6] == (7, 3, "p", "x", "YES", "NO")
    path = write(tmp_path / "s.jsonl", ['{"path": "d/one.jpg"}', '{"path": "d/two.jpg"}', '{"path": "d/three.jpg", "error": "one"}'])
    got = readers.prefiltered(spark, path, schemas.CAPTION, spark.createDataFrame([("d/one.jpg",)], "path string"))
    assert [r["path"] for r in got.collect()] == ["d/one.jpg"]


def test_image_sizes(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + struct.pack(">II", 300, 70000))
    (tmp_path / "b.gif").write_bytes(b"GIF89a" + struct.pack("<HH", 321, 12) + b"\0")
    (tmp_path / "c.jpg").write_bytes(b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 48, 64) + b"\3\1")
    (tmp_path / "d.txt").write_bytes(b"no image")
    got = {r["path"].rsplit("/", 1)[1]: (r["img_w"], r["img_h"]) for r in readers.image_sizes(spark, str(tmp_path)).collect()}
    assert got == {"a.png": (300, 70000), "b.gif": (321, 12), "c.jpg": (64, 48), "d.txt": (0, 0)}


def test_image_sizes_past_metadata(spark, tmp_path):
    """Frames behind more than 64 KB of metadata, in which a thumbnail has a frame of its own."""
    frame = lambda marker, h, w: b"\xff" + marker + b"\x00\x11\x08" + struct.pack(">HH", h, w) + b"\3" + bytes(9)
    segment = lambda body: b"\xff\xe1" + struct.pack(">H", len(body) + 2) + body
    thumbnail = segment(b"Exif" + b"\xff\xd8" + frame(b"\xc0", 120, 160) + bytes(60_000))
    (tmp_path / "a.jpg").write_bytes(b"\xff\xd8" + segment(bytes(65_000)) * 40 + frame(b"\xc2", 480, 640))
    (tmp_path / "b.jpg").write_bytes(b"\xff\xd8" + thumbnail * 3 + b"\xff" + frame(b"\xc1", 48, 64) + b"\xff\xd9")
    (tmp_path / "c.jpg").write_bytes(b"\xff\xd8" + thumbnail)
    (tmp_path / "d.jpg").write_bytes(b"\xff\xd8")
    (tmp_path / "e.txt").write_bytes(b"x")
    got = {r["path"].rsplit("/", 1)[1]: (r["img_w"], r["img_h"]) for r in readers.image_sizes(spark, str(tmp_path)).collect()}
    assert got == {"a.jpg": (640, 480), "b.jpg": (64, 48), "c.jpg": (0, 0), "d.jpg": (0, 0), "e.txt": (0, 0)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("p", 3, 4, [("x", [[1.0, 2.0, 3.0, 4.0]]), ("a", [])])], "path string, img_w int, img_h int, grounding array<struct<phrase: string, boxes: array<array<double>>>>")
    out = f"{tmp_path}/out"
    writers.append_json(writers.as_record(df), out)
    writers.append_json(writers.as_record(df), out)
    assert spark.read.text(out).count() == 2 and '"grounding":{"x":[[1.0,2.0,3.0,4.0]],"a":[]}' in spark.read.text(out).first()[0]
    assert writers.replace_json(spark.read.schema("path string").json(out).distinct(), out)
    assert spark.read.json(out).count() == 1
    assert not writers.replace_json(spark.read.schema("path string").json(out), out)


def test_stream_of_two_batches(spark, tmp_path):
    schema = "seq long, path string, ok boolean"
    rows = [(1, "a", True), (2, "b", False)], [(3, "a", False), (4, "b", True), (5, "c", False)]
    for k, part in enumerate(rows):
        spark.createDataFrame(part, schema).write.mode("append").parquet(f"{tmp_path}/in")
        log = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        incremental.latest_stream(log, ["path"], f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = {r["path"]: r["seq"] for r in incremental.latest(spark, f"{tmp_path}/out").collect()}
    assert got == {"a": 1, "b": 4, "c": 5}


def test_model_stages(spark):
    class Failing(infer.StubBackend):
        def ask(self, prompt, item, max_tokens):
            if item["path"] == "bad":
                raise ValueError("no")
            return super().ask(prompt, item, max_tokens)

    work = spark.createDataFrame([(1, 0, "p", "a cat"), (2, 0, "bad", "x")], "id long, shard int, path string, gt_caption string")
    rows = {r["path"]: r for r in infer.caption(work, Failing).collect()}
    assert rows["p"]["error"] is None and rows["p"]["gemma_dense"].startswith("a cat number")
    assert rows["bad"]["error"] == "ValueError: no"
    tasks = spark.createDataFrame([("p", "dog", [0.0, 0.0, 100.0, 100.0], 1, 640, 480), ("bad", "x", [0.0, 0.0, 90.0, 90.0], 1, 640, 480), ("p", "dot", [0.0, 0.0, 3.0, 3.0], 1, 640, 480)], "path string, phrase string, box array<double>, n_box int, img_w int, img_h int")
    got = {r["phrase"]: r["verdict"] for r in infer.verify(tasks, Failing).collect()}
    assert got["x"] == "ERROR" and got["dot"] == "TOO_SMALL" and got["dog"] in ("YES", "NO", "UNPARSED")

    def detect(batch):
        if len(batch) > 1 or batch[0]["path"] == "bad":
            raise RuntimeError("out of memory")
        return infer.grounding_stub(batch)

    caps = spark.createDataFrame([("p", "a cat sat"), ("bad", "x y")], "path string, gemma_dense string")
    found = {r["path"]: r for r in infer.ground(caps, detect).collect()}
    assert len(found["p"]["grounding"]) == 3 and found["bad"]["grounding"] is None and "out of memory" in found["bad"]["error"]


def test_retries_wait_and_change_endpoints():
    calls, waits = [], []

    def call(endpoint):
        calls.append(endpoint)
        if len(calls) < 4:
            raise OSError
        return "ok"

    assert infer.retried(["a", "b"], call, sleep=waits.append) == "ok"
    assert calls == ["a", "b", "a", "b"] and waits == [1.0, 2.0, 4.0]


def test_text_scalars(spark):
    df = spark.createDataFrame([("<think>x</think>  Yes sir</s>rest", "d/a12.b.jpg")], "s string, p string")
    row = df.select(txt.after_thinking(F.col("s")), txt.until_end_mark(F.col("s")), txt.parse_verdict(txt.after_thinking(F.col("s"))), txt.file_stem(F.col("p")), txt.file_number(F.col("p"))).first()
    assert tuple(row) == ("Yes sir</s>rest", "<think>x</think>  Yes sir</s>", "YES", "a12", 12)


def test_lines_are_numbered_over_many_splits(spark, tmp_path):
    """Files of many splits, line ends of all kinds, blank lines that count but don't come."""
    want = []
    for name, end in (("shard0.txt", "\n"), ("shard1.txt", "\r\n")):
        lines = [f"{name} {k} " + "x" * (k * 37 % 300) if k % 11 else "" for k in range(4000)]
        (tmp_path / name).write_bytes((end.join(lines) + end).encode())
        want += [(name, k, v) for k, v in enumerate(lines) if v]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1000")
    try:
        assert spark.read.text(f"{tmp_path}/*.txt").rdd.getNumPartitions() > 10
        got = readers.numbered_lines(spark, f"{tmp_path}/*.txt").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted((r["file"].rsplit("/", 1)[1], r["line"], r["value"]) for r in got) == sorted(want)


def test_prefilter_reads_escaped_values(spark, tmp_path):
    path = write(tmp_path / "s.jsonl", ['{"path": "x/caf\\u00e9.jpg"}', '{"path": "x/b.jpg"}'])
    for n in (0, 40):
        wanted = spark.createDataFrame([("x/café.jpg",)] + [(f"other{k}",) for k in range(n)], "path string")
        assert [r["path"] for r in readers.prefiltered(spark, path, schemas.CAPTION, wanted).collect()] == ["x/café.jpg"]


def test_compaction_in_place(spark, tmp_path):
    for shard, lines in {"a.jsonl": ['{"path": "p", "id": 1}', '{"path": "q", "id": 2, "error": "E"}', '{"path": "r",  "id": 3}'], "b.jsonl": ['{"path": "q", "id": 4}', '{"path": "p", "id": 5, "error": "E"}'], "c.jsonl": ['{"path": "s", "id": 6}']}.items():
        (tmp_path / "log" / shard).mkdir(parents=True)
        write(tmp_path / "log" / shard / "part-0.txt", lines)
    root, before = f"{tmp_path}/log", (tmp_path / "log/c.jsonl/part-0.txt").stat().st_mtime_ns
    told = lambda df: {r["shard"]: (r["lines"], r["kept"], r["changed"]) for r in df.collect()}
    want = {"a.jsonl": (3, 2, True), "b.jsonl": (2, 1, True), "c.jsonl": (1, 1, False)}
    assert told(writers.rewrite_shards(spark, root, schemas.CAPTION, dry=True)) == want
    assert spark.read.text(f"{root}/*").count() == 6
    assert told(writers.rewrite_shards(spark, root, schemas.CAPTION)) == want
    left = {k: [r[0] for r in spark.read.text(f"{root}/{k}").collect()] for k in want}
    assert left == {"a.jsonl": ['{"path": "p", "id": 1}', '{"path": "r",  "id": 3}'], "b.jsonl": ['{"path": "q", "id": 4}'], "c.jsonl": ['{"path": "s", "id": 6}']}
    assert (tmp_path / "log/c.jsonl/part-0.txt").stat().st_mtime_ns == before
    assert not any(changed for _, _, changed in told(writers.rewrite_shards(spark, root, schemas.CAPTION)).values())


def test_failed_calls_are_tried_on_the_next_endpoint(spark):
    class Dead:
        def ask(self, prompt, item, max_tokens):
            raise ConnectionError("down")

    class Once(infer.StubBackend):
        """Fails the first time it is asked about each path."""

        def __init__(self):
            self.seen = set()

        def ask(self, prompt, item, max_tokens):
            if (prompt, item["path"]) not in self.seen:
                self.seen.add((prompt, item["path"]))
                raise TimeoutError("busy")
            return super().ask(prompt, item, max_tokens)

    work = spark.createDataFrame([(k, 0, f"p{k}", "cat") for k in range(20)], "id long, shard int, path string, gt_caption string")
    good = sorted(map(tuple, infer.caption(work).collect()))
    calm = lambda s: None
    for backend in (lambda: [Dead(), infer.StubBackend()], Once, lambda: [Dead(), Once()]):
        assert sorted(map(tuple, infer.caption(work, backend, sleep=calm).collect())) == good
    failed = infer.caption(work, Dead, tries=2, sleep=calm).collect()
    assert len(failed) == 20 and all(r["error"] == "ConnectionError: down" for r in failed)
    assert all(r["error"] for r in infer.caption(work, Once, tries=1, sleep=calm).collect())


def test_waits_between_tries():
    waits, calls = [], []

    def call(endpoint):
        calls.append(endpoint)
        raise ValueError("no")

    try:
        infer.retried(["a", "b", "c"], call, 4, waits.append, first=1)
        raise AssertionError
    except ValueError:
        assert waits == [1.0, 2.0, 4.0] and calls == ["b", "c", "a", "b"]


def test_nested_types_in_stages(spark):
    work = spark.createDataFrame([(1, "p")], "id long, path string")
    out = infer.mapped(work, lambda model, item: item | {"boxes": [[1.0, 2.0]], "x": {"a": 1, "b": "c"}}, infer.StubBackend, "id long, boxes array<array<double>>, x struct<a: int, b: string>, error string", workers=1)
    assert out.first().asDict(recursive=True) == {"id": 1, "boxes": [[1.0, 2.0]], "x": {"a": 1, "b": "c"}, "error": None}


def test_serial_keeps_order_and_progress_counts():
    def work(item):
        if item["k"] == 2:
            raise ValueError("bad")
        return [item, item] if item["k"] == 1 else item

    assert list(infer.serial(iter({"k": k} for k in range(4)), work)) == [{"k": 0}, {"k": 1}, {"k": 1}, {"k": 2, "error": "ValueError: bad"}, {"k": 3}]
    assert infer.progress("cap", 30, 90, 60.0) == "[cap] 30/90, 2.00 s each, 2.0 min left"
    assert infer.progress("cap", 100, 200, 5.0) == "[cap] 100/200, 50 ms each, 0.1 min left"


def test_readiness(spark, tmp_path):
    waits, left = [], iter([False, False, True])
    assert run.ready(lambda: next(left), tries=5, every=7, sleep=waits.append) and waits == [7, 7]
    assert not run.ready(lambda: False, tries=3, every=1, sleep=waits.append)
    spark.range(0).write.parquet(f"{tmp_path}/a")
    spark.range(2).write.parquet(f"{tmp_path}/b")
    assert run.has_rows(spark, f"{tmp_path}/b") and not run.has_rows(spark, f"{tmp_path}/a", f"{tmp_path}/b") and not run.has_rows(spark, f"{tmp_path}/c")


def test_calibration_needs_answers_to_both_verdicts(spark):
    rows = spark.createDataFrame([("YES", "YES"), ("YES", "NO")], "auto string, human string")
    assert calibrate.calibration(rows, 10, 5, strict=False).first()["precision"] is None
    with pytest.raises(Exception, match="nothing to restore"):
        calibrate.calibration(rows, 10, 5).collect()


def test_review_server(spark, tmp_path):
    (tmp_path / "index.html").write_text("<p>page</p>")
    answers = f"{tmp_path}/saved/answers.json"

    def asked(port, path, body=None):
        with urllib.request.urlopen(urllib.request.Request(f"http://127.0.0.1:{port}{path}", body), timeout=20) as r:
            return r.read().decode()

    def running(**more):
        http = review.server(spark, str(tmp_path), answers, **more)
        threading.Thread(target=http.serve_forever, daemon=True).start()
        return http

    http = running(allowed=["127.0.0.0/8"])
    port = http.server_address[1]
    assert asked(port, "/index.html") == "<p>page</p>" and asked(port, "/load") == '{"answers":[]}'
    for n in (3, 20, 21):
        document = {"answers": [{"path": f"p{k}", "human": "YES" if k < n else None} for k in range(30)], "note": "ñ"}
        assert json.loads(asked(port, "/save", json.dumps(document).encode())) == {"ok": True, "count": n}
        assert json.loads(asked(port, "/load")) == document
    assert {p.name for p in (tmp_path / "saved").iterdir() if not p.name.startswith(".")} == {"answers.json", "answers.json.0020"}
    for path, body in (("/other", b"{}"), ("/save", b"no json")):
        with pytest.raises(urllib.error.HTTPError):
            asked(port, path, body)
    http.shutdown()
    http = running(allowed=["10.0.0.0/8"])
    for path, body in (("/load", None), ("/save", b"{}"), ("/index.html", None)):
        with pytest.raises(urllib.error.HTTPError, match="403"):
            asked(http.server_address[1], path, body)
    http.shutdown()


def test_jpeg_where_the_library_is_there(spark):
    pytest.importorskip("PIL")
    import io

    from PIL import Image

    out = io.BytesIO()
    Image.new("RGB", (1000, 500), "red").save(out, format="PNG")
    df = spark.createDataFrame([(bytearray(out.getvalue()), [[0.0, 0.0, 10.0, 10.0]]), (None, None)], "content binary, boxes array<array<double>>")
    got = df.select(images.jpeg_base64(768)("content").alias("a"), images.drawn_jpeg(460)("content", "boxes").alias("b")).collect()
    assert Image.open(io.BytesIO(base64.b64decode(got[0]["a"]))).size == (768, 384) and got[1]["a"] is None
    assert Image.open(io.BytesIO(base64.b64decode(got[0]["b"]))).size == (460, 230) and got[1]["b"] is None
