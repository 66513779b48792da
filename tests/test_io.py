"""Readers, writers, pipelines and streaming: round trips."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from quern.operators import tokenize
from quern.plans import pipelines
from quern.plans.tokenizer_queries import tokenizer_path
from quern.sources import readers, writers
from quern.streaming import ingest


def test_json_readers(spark, tmp_path):
    good, bad, many = tmp_path / "a.jsonl", tmp_path / "b.jsonl.gz", tmp_path / "c.json"
    good.write_text('{"text": "x", "n": 1}\n{"text": "y"}\n')
    with gzip.open(bad, "wt") as f:
        f.write('{"text": "x"}\nnot json\n')
    many.write_text('[{"text": "p"}, {"text": "q"}]')
    assert [r.text for r in readers.jsonl(spark, str(good), "text string, n int").collect()] == ["x", "y"]
    with pytest.raises(Exception):
        readers.jsonl(spark, str(bad), "text string").collect()
    assert [r.text for r in readers.jsonl(spark, str(bad), "text string", tolerant=True).collect()] == ["x"]
    assert [r.line for r in readers.bad_lines(spark, str(bad), "text string").collect()] == ["not json"]
    assert sorted(r.text for r in readers.json_array(spark, str(many), "text string").collect()) == ["p", "q"]
    assert readers.open_records(spark, str(good)).select(F.variant_get("record", "$.n", "int").alias("n")).where("n = 1").count() == 1
    assert [r.text for r in readers.load(spark, "jsonl", str(good), order="text", max_samples=1, schema="text string").collect()] == ["x"]
    with pytest.raises(ValueError):
        readers.load(spark, "jsonl", str(good), max_samples=1, schema="text string")
    with pytest.raises(ValueError):
        readers.load(spark, "nowhere", "x")


def test_prompts_and_vocabulary(spark, tmp_path):
    a, b, c, v = (tmp_path / n for n in ("a.json", "b.json", "c.json", "v.tsv"))
    a.write_text('["one", "two"]')
    b.write_text('{"prompts": ["three"]}')
    c.write_text('{"categories": {"x": ["four"], "y": ["five", "six"]}}')
    v.write_text("<unk>\t0\n▁the\t-1.5\nbroken\ning\t-2\n")
    got = [tuple(r) for p in (a, b, c) for r in readers.prompts(spark, str(p)).collect()]
    assert sorted(got, key=str) == sorted([(None, "one"), (None, "two"), (None, "three"), ("x", "four"), ("y", "five"), ("y", "six")], key=str)
    assert [tuple(r) for r in readers.vocabulary(spark, str(v)).orderBy("id").collect()] == [(0, "<unk>", 0.0, 5, True, False, 5), (1, "▁the", -1.5, 4, False, True, 3), (3, "ing", -2.0, 3, False, False, 3)]


def test_retried():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 4:
            raise OSError("again")
        return "done"

    assert readers.retried(flaky, 5, 2.0, 5.0, waits.append) == "done" and waits == [2.0, 4.0, 5.0]
    with pytest.raises(ZeroDivisionError):
        readers.retried(lambda: 1 / 0, 1, 0.0, 0.0, waits.append)


def test_shards_and_manifest(spark, tmp_path):
    d = spark.createDataFrame([(i, f"text {i}", i % 5) for i in range(25)], "i bigint, text string, tokens int")
    out = str(tmp_path / "corpus")
    m = writers.write_shards(d, out, "i", 10, "tokens", {"a": 1})
    assert [s["num_documents"] for s in m["shards"]] == [10, 10, 5] and m["total_tokens"] == 50
    assert writers.write_shards(d.limit(1), out, "i") == m
    assert sorted(r.text for r in readers.shards(spark, out).collect()) == sorted(f"text {i}" for i in range(25))
    assert {r.status for r in writers.verify_shards(spark, out).collect()} == {"ok"}
    first, second = (tmp_path / "corpus" / s["path"] for s in m["shards"][:2])
    first.unlink()
    second.write_bytes(gzip.compress(b"{}"))
    (second.parent / f".{second.name}.crc").unlink()  # else the local file system itself refuses to read it
    assert sorted(r.status for r in writers.verify_shards(spark, out).collect()) == ["changed", "missing", "ok"]
    assert [len(writers.subset(m, t)["shards"]) for t in (1, 17, 1000)] == [1, 2, 3]


def test_split_shards(spark, tmp_path):
    d = spark.createDataFrame([(i, f"t{i}", "train" if i < 7 else "val") for i in range(9)], "i bigint, text string, split string")
    out = str(tmp_path / "sft")
    m = writers.write_split_shards(d, out, "split", "i", 3)
    assert {k: (v["rows"], len(v["shards"])) for k, v in m["splits"].items()} == {"train": (7, 3), "val": (2, 1)}
    assert sorted(r.text for r in readers.sft_split(spark, out, "val").collect()) == ["t7", "t8"]
    assert readers.sft_split_faults(spark, out, "train").count() == 0
    first, second = (tmp_path / "sft" / p for p in m["splits"]["train"]["shards"][:2])
    first.unlink()
    second.write_text(second.read_text() + "not json\n")
    (second.parent / f".{second.name}.crc").unlink()
    with pytest.warns(UserWarning, match="1 shards"):
        assert readers.sft_split(spark, out, "train").count() == 4
    assert sorted((r.missing, r.bad_lines) for r in readers.sft_split_faults(spark, out, "train").collect()) == [(False, 1), (True, 0)]
    with pytest.raises(ValueError):
        readers.sft_split(spark, out, "test")


def test_token_shards(spark, tmp_path):
    for name, ids in (("train_1", [4]), ("train_0", [1, 2, 3]), ("val_0", [5])):
        (tmp_path / f"{name}.jsonl").write_text(json.dumps({"input_ids": ids, "labels": ids}))
    got = lambda split: sorted((r.input_ids, r.attention_mask) for r in readers.token_shards(spark, str(tmp_path), split).collect())
    assert got("train") == [([1, 2, 3], [1, 1, 1]), ([4], [1])]
    (tmp_path / "manifest.json").write_text(json.dumps({"train_shards": ["train_1.jsonl"]}))
    assert got("train") == [([4], [1])]
    for split in ("val", "test"):
        with pytest.raises(ValueError):
            readers.token_shards(spark, str(tmp_path), split)


def test_cache(spark, tmp_path):
    path, built = str(tmp_path / "cache"), []

    def build():
        built.append(1)
        return spark.createDataFrame([(1, 5), (2, 6)], "i int, n int")

    for config in ({"v": 1}, {"v": 1}, {"v": 2}):
        assert writers.cached(spark, path, config, build, "n").count() == 2
    assert len(built) == 2
    newer = tmp_path / "source.txt"
    newer.write_text("x")
    for at, n in ((0, 2), (4_000_000_000, 3)):
        os.utime(newer, (at, at))
        assert writers.cached(spark, path, {"v": 2}, build, "n", [str(newer)]).count() == 2 and len(built) == n
    assert writers.cache_listing(spark, str(tmp_path)).select("rows", "tokens").first() == (2, 11)
    writers.clear_cache(spark, path)
    assert not writers.exists(spark, path)


def test_packed_binary(spark, tmp_path):
    rows = [(i, [i, 65535 - i, 7]) for i in range(11)]
    path = str(tmp_path / "bin")
    n = writers.write_packed(spark.createDataFrame(rows, "i bigint, t array<int>").repartition(4), path, "i", "t", 3)
    assert n == 11 and json.loads((tmp_path / "bin.idx").read_text())["shape"] == [11, 3]
    assert sorted(r.tokens for r in readers.packed_binary(spark, path, 3).collect()) == [t for _, t in rows]
    assert writers.write_packed(spark.createDataFrame(rows[:2], "i bigint, t array<int>"), path, "i", "t", 3, {"corpus_hash": "c"}) == 2
    assert sorted(r.tokens for r in readers.packed_binary(spark, path, 3, rows_per_task=1).collect()) == [t for _, t in rows[:2]]
    assert json.loads((tmp_path / "bin.idx").read_text())["corpus_hash"] == "c"
    assert readers.packed_binary(spark, str(tmp_path / "nothing"), 3).count() == 0
    with pytest.raises(Exception):
        readers.packed_binary(spark, path, 4).collect()
    with pytest.raises(Exception):
        writers.write_packed(spark.createDataFrame([(1, [70000, 1, 1])], "i bigint, t array<int>"), str(tmp_path / "bad"), "i", "t", 3)


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"])
def test_tokenizers(spark, name):
    path = os.path.join(os.path.dirname(tokenizer_path()), name)
    if not os.path.exists(path):
        pytest.skip("no vocabulary files")
    d = spark.createDataFrame([(1, "Plain text, twice."), (2, None), (3, "")], "i int, t string")
    got = {r.i: (r.ids, r.decoded) for r in tokenize.decoded(tokenize.encoded(d, "t", path), "ids", path).collect()}
    assert got[1][1] == "Plain text, twice." and got[2][0] == [] and got[3][0] == []


def test_vocabulary_facts(spark):
    path = tokenizer_path()
    if not os.path.exists(path):
        pytest.skip("no vocabulary files")
    f = tokenize.facts(path)
    assert f.size > 1000 and f.unknown == f.special["unk"] and tokenize.verify(path, f.sha256, f.size, f.special) == []
    assert len(tokenize.verify(path, "other", 7, {"unk": -5})) == 3
    v = tokenize.vocabulary_table(spark, path)
    assert v.count() == f.size and v.where("is_special").count() >= 1
    d = spark.createDataFrame([(1, "Plain text, twice."), (2, None)], "i int, t string")
    ids = tokenize.encoded(d, "t", path).select("i", F.explode("ids").alias("id"))
    assert "".join(r.piece for r in tokenize.with_pieces(ids, v).collect()).replace("▁", " ").strip() == "Plain text, twice."
    by = {k: {r.i: r.tokens for r in tokenize.counted(d, "t", **k_).collect()} for k, k_ in (("file", {"path": path}), ("smart", {}), ("chars", {"smart": False}))}
    assert by["file"][1] == ids.count() and by["chars"] == {1: 4, 2: 0} and by["smart"][2] == 0 < by["smart"][1]
    assert tokenize.rates({"docs": 10, "tokens": 50}, 2.0) == {"docs_per_second": 5.0, "tokens_per_second": 25.0, "tokens_per_doc": 5.0}


def test_manifests_and_cards(spark, tmp_path):
    d = spark.createDataFrame([(i, "train", [1, 2]) for i in range(4)], "i bigint, split string, input_ids array<int>")
    m = writers.write_split_shards(d, str(tmp_path / "packed"), "split", "i", 2, "3.0", {"length": 2}, {"real_tokens": 8, "efficiency": 100.0}, {"sha256": "h"})
    assert (m["total_sequences"], m["total_tokens"]) == (4, 8) and "| efficiency | 100.0 |" in writers.finetuning_card(m)
    p = writers.packed_manifest(spark, str(tmp_path / "final.json"), 2, {"rows": 4}, "c", "t")
    assert readers.manifest(spark, str(tmp_path), "final.json") == p
    assert writers.incompatible({"a": p, "b": {}, "c": p | {"tokenizer_config_hash": "u"}}) == ["b", "c"]
    (tmp_path / "hub").mkdir()
    d.write.parquet(str(tmp_path / "hub" / "small" / "val"))
    assert readers.load(spark, "folders", str(tmp_path / "hub"), subset="small", split="val").count() == 4


def test_pretraining_pipeline(spark, tmp_path):
    words = [" ".join(f"{c}{i}" for i in range(30)) for c in "abcdef"]
    for name, rows in (("one", [0, 1, 1, 2]), ("two", [2, 3, 4, 0])):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"id": k, "text": words[w]}) for k, w in enumerate(rows)))
    source = lambda n, **k: pipelines.Source(n, "jsonl", str(tmp_path / f"{n}.jsonl"), "id", options={"schema": "id bigint, text string"}, **k)
    c = pipelines.Pretraining((source("one", token_budget=40), source("two")), near="words")
    got = sorted((r.source, r.row) for r in pipelines.pretraining_corpus(spark, c).collect())
    assert got == [("one", 0), ("one", 1), ("two", 0), ("two", 1), ("two", 2)]  # the budget shuts out the third text of one, so two's copy stays
    # texts of fewer than five words are never remembered: all stay, in each source
    for name in ("one", "two"):
        (tmp_path / f"{name}.jsonl").write_text("\n".join([json.dumps({"id": k, "text": t}) for k, t in enumerate([words[0], words[0] + " more", "x" * 30 + " and " + "y" * 30, "x" * 30 + " and " + "y" * 30])]))
    for near, expected in (("words", [("one", 0), ("one", 2), ("one", 3), ("two", 2), ("two", 3)]), (None, [("one", 0), ("one", 1), ("one", 2)])):
        got = sorted((r.source, r.row) for r in pipelines.pretraining_corpus(spark, pipelines.Pretraining((source("one"), source("two")), near=near)).collect())
        assert got == expected
    for name, rows in (("one", [0, 1, 1, 2]), ("two", [2, 3, 4, 0])):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"id": k, "text": words[w]}) for k, w in enumerate(rows)))
    m = pipelines.prepare_pretraining(spark, c, str(tmp_path / "out"))
    assert m["statistics"] == {"one": {"processed": 4, "documents": 2, "shut_out": 2, "tokens": m["statistics"]["one"]["tokens"]}, "two": {"processed": 4, "documents": 3, "shut_out": 1, "tokens": m["statistics"]["two"]["tokens"]}}
    assert m["total_documents"] == 5 and pipelines.prepare_pretraining(spark, c, str(tmp_path / "out")) == m
    with pytest.raises(ValueError):
        pipelines.Pretraining(()).check()


def test_finetuning_and_preference_pipelines(spark, tmp_path):
    pairs = [(i, f"What is {i} and {i + 1} made of here?", f"It is made of {'x' * (i + 1)} and many other fine things {i}.") for i in range(20)] + [(20, "", "r"), (21, "p", None)]
    d = spark.createDataFrame(pairs, "i bigint, prompt string, response string")
    m = pipelines.prepare_finetuning(d, "i", pipelines.Finetuning(near=False), str(tmp_path / "sft"))
    assert {k: v["rows"] for k, v in m["splits"].items()} == {"train": 18, "val": 2}
    assert readers.sft_split(spark, str(tmp_path / "sft"), "train").where("text like '<|im_start|>user%'").count() == 18
    t = spark.createDataFrame([(1, "p", "a", "b"), (2, "p", "a", "a"), (3, None, "a", "b")], "i bigint, prompt string, chosen string, rejected string")
    assert pipelines.prepare_preferences(t, "i", str(tmp_path / "dpo"))["funnel"] == {"kept": 1, "same": 1, "missing_prompt": 1}
    assert [tuple(r) for r in readers.preference_shards(spark, str(tmp_path / "dpo")).collect()] == [("p", "a", "b")]
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "manifest.json").write_text("{}")
    (tmp_path / "old" / "shard_000.jsonl").write_text('{"prompt": "q", "chosen": "c", "rejected": "r"}')
    assert [tuple(r) for r in readers.preference_shards(spark, str(tmp_path / "old")).collect()] == [("q", "c", "r")]
    assert "| same | 1 |" in writers.preference_card(readers.manifest(spark, str(tmp_path / "dpo")))
    named = d.withColumn("dataset", F.when(F.col("i") % 2 == 0, "even").otherwise("odd"))
    weights = spark.createDataFrame([("even", 3.0, 4), ("odd", 1.0, None)], "dataset string, weight double, max_samples int")
    for c, even, odd in ((pipelines.Finetuning(near=False, sampling="target_conversations", sampling_total=8), 6, 2), (pipelines.Finetuning(near=False, sampling="max_samples"), 4, 10)):
        got = [r.i % 2 for r in pipelines.finetuning_corpus(named, "i", c, weights).collect()]
        assert (got.count(0), got.count(1)) == (even, odd)
    for c in (pipelines.Finetuning(template="none"), pipelines.Finetuning(sampling="some"), pipelines.Finetuning(sampling="target_tokens")):
        with pytest.raises(ValueError):
            c.check()


def test_streaming(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = lambda i, t: json.dumps({"i": i, "t": t})
    long = ["first text " * 8, "second text " * 8]
    (tmp_path / "in" / "a.json").write_text("\n".join([line(1, long[0]), line(2, long[0]), line(3, "short")]))
    run = lambda: ingest.ingest(spark.readStream.schema("i bigint, t string").json(str(tmp_path / "in")), "i", "t", str(tmp_path / "out")).awaitTermination()
    run()
    (tmp_path / "in" / "b.json").write_text("\n".join([line(4, long[0]), line(5, long[1])]))
    run()
    assert sorted(r.ord for r in spark.read.parquet(str(tmp_path / "out" / "documents")).collect()) == [1, 5]


def test_event_windows_stream(spark, tmp_path):
    d = spark.createDataFrame([(i, "a" if i % 3 else "b", float(i)) for i in range(50)], "s bigint, kind string, v double").withColumn("ts", F.timestamp_seconds(F.col("s") * 600))
    d.write.parquet(str(tmp_path / "ev"))
    s = ingest.event_windows(spark.readStream.schema(d.schema).parquet(str(tmp_path / "ev")), "ts", "kind", "v")
    q = s.writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, ingest.event_windows(d, "ts", "kind", "v").collect()))


def test_cards_and_checkpoints(spark):
    assert writers.markdown_card("T", {"A": {"k": 1}, "B": ["x"]}).splitlines()[2:5] == ["## A", "", "| k | 1 |"]
    d = spark.createDataFrame([("s1", 1, True), ("s9", 9, False), ("s5", 5, True)], "path string, step int, valid boolean")
    assert writers.latest_valid(d, "path", "step", "valid").first()[0] == "s5"
