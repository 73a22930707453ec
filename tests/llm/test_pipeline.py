import corpus_pipeline
import public_tokenizers
from campfin.llm.components import stored
from campfin.llm.decontaminate import PER_EDIT, best_match, normalise
from tokenizers import Tokenizer

from .test_packing import check as check_packing
from .test_pii import check as check_pii, matches
from .test_pipeline_near import brute as brute_near
from .test_quality import brute as brute_quality, brute_threshold

DIR = "/root/testdata/sf0.001"


def leaks(text, items):
    t = normalise(text)
    for item in items:
        masks = {}
        for i, ch in enumerate(item):
            masks[ch] = masks.get(ch, 0) | 1 << i
        if best_match(item, masks, t)[0] <= len(item) // PER_EDIT:
            return True
    return False


def test_each_stage_equals_brute_force_on_its_input(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    labels = [tuple(r) for r in spark.read.parquet(f"{DIR}/labels.parquet").select("doc_id", "quality").collect()]
    items = [normalise(r["text"]) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "pii", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stored(stage(spark, docs, DIR), "test-" + name)
        rows = out.collect()
        pairs = [(i, r["text"]) for i, r in before.items()]
        if name == "packing":
            check_packing(rows, dict(pairs), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))
            break
        assert out.columns == columns
        after = {r["doc_id"]: r for r in rows}
        assert len(after) == len(rows)
        if name == "quality":
            assert set(after) == {r[0] for r in brute_quality(pairs, labels, brute_threshold(pairs, labels)) if r[-1]}
        elif name == "near_duplicates":
            assert set(after) == brute_near(pairs)
        elif name == "decontamination":
            assert set(after) == {i for i, t in pairs if not leaks(t, items)}
        if name == "pii":
            assert set(after) == set(before)
            check_pii([(t, after[i]["text"], len(matches(t)), ",".join(sorted({k for k, _ in matches(t)})))
                       for i, t in pairs])
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        else:
            assert len(after) < len(before)
            assert all(after[i] == before[i] for i in after)
        docs = out


def test_run_returns_the_packed_sequences(spark):
    got = corpus_pipeline.run(spark, DIR)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
    assert got.count() > 100


def test_stages_handle_hard_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (2, "", "en"), (None, "a b c d e f g h i j k l", None),
            (3, "word " * 50, "en"), (4, "x" * 50000, "en"), (5, " ".join(f"v{i}" for i in range(9000)), "en"),
            (5, " ".join(f"v{i}" for i in range(9000)), "en")]
    schema = "doc_id long, text string, lang string"
    for table in (rows, []):
        docs = stored(spark.createDataFrame(table, schema), "hard")
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, DIR), "hard-" + name)
            if name != "packing":
                assert out.columns == docs.columns
                assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in docs.collect()}
            if name != "quality":
                docs = out
